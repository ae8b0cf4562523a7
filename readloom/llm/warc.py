"""WARC archives of pages, and an index of their captures merged from sorted runs.

Writing. Each page becomes one record; an equal payload of at least ``REVISIT`` bytes is stored once, in
the record of the largest id, and the others revisit it. Spark's text writer puts the records into gzip files,
since tasks reach the shared folder only through Spark. A file holds at most ``FILE_BYTES`` of payload.

Reading. A task streams a file record by record along Content-Length and checks digest and length.

Index. Captures are sorted by URL key, time and id within each task and written as runs. A range exchange
deals every run to the tasks of the ranges, also within one URL, so a URL with very many captures is no single
task. There a loser tree merges the pieces of k runs: the loser of each match stays in its node, so the next
capture costs one comparison per level. Partition after partition holds the history of captures in order.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.llm.common import stored
from readloom.session import fresh_path

REVISIT = 1000
FILE_BYTES, FILE_RECORDS = 256 << 20, 20_000
CRLF = "\r\n"
# Fixed value: the HTTP head of each stored response.
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
CAPTURE = "page_id long, url string, captured string, record_type string, refers_to long, payload_bytes long, payload_digest string"
KEY = ["url_key", "captured", "page_id"]
URN = re.compile(r"<urn:page:(-?\d*)>")


def url_key(url: Column) -> Column:
    """Host parts from the last to the first, then the rest: ``com,example)/path``."""
    lower = F.lower(F.coalesce(url, F.lit("")))
    host = F.regexp_extract(lower, r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1)
    rest = F.regexp_replace(lower, r"^[a-z][a-z0-9+.-]*://[^/?#]*", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)


def with_revisits(pages: DataFrame, id_col: str, url_col: str, html_col: str, date_col: str, least: int = REVISIT) -> DataFrame:
    """Pages with payload, digest and, for revisits, the id they refer to."""
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.translate(F.coalesce(F.col(url_col), F.lit("")), CRLF, "  ").alias("url"),
        F.col(date_col).cast("string").alias("captured"),
        payload.alias("payload"),
    )
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha1(F.col("payload").cast("binary"))})
    long = rows.where(F.col("payload_bytes") >= least)
    same = long.groupBy("payload_digest").agg(F.max("page_id").alias("kept"), F.count("*").alias("n")).where("n > 1")
    joined = rows.join(same.select("payload_digest", "kept"), "payload_digest", "left")
    refers = F.when(F.coalesce(F.col("page_id") < F.col("kept"), F.col("kept").isNotNull() & F.col("page_id").isNull()), F.col("kept"))
    return joined.withColumn("refers_to", F.when(F.col("payload_bytes") >= least, refers)).drop("kept")


def records(rows: DataFrame) -> DataFrame:
    """``value``: one WARC record per row, up to the empty lines that end it."""
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    revisit = F.col("refers_to").isNotNull()
    block = F.concat(F.lit(HTTP_HEAD), F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    field = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    head = F.concat(
        F.lit("WARC/1.1" + CRLF),
        field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        field("WARC-Record-ID", urn("page_id")),
        field("WARC-Target-URI", F.col("url")),
        field("WARC-Date", F.coalesce("captured", F.lit(""))),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        field("WARC-Payload-Length", F.col("payload_bytes").cast("string")),
        F.when(revisit, field("WARC-Refers-To", urn("refers_to"))).otherwise(F.lit("")),
        field("Content-Type", F.lit("application/http; msgtype=response")),
        field("Content-Length", F.octet_length(block).cast("string")),
        F.lit(CRLF),
    )
    return rows.select(F.concat(head, block).alias("value"))


def write_warc(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date_col: str = "captured"
) -> None:
    """Write the archives. The longest payload sets how many records a file may hold."""
    longest = pages.agg(F.max(F.octet_length(html_col))).first()[0] or 0
    per_file = max(1, min(FILE_RECORDS, FILE_BYTES // max(1, longest)))
    out = records(with_revisits(pages, id_col, url_col, html_col, date_col))
    out.write.option("lineSep", CRLF * 2).option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path)


def parse_warc(content: bytes) -> Iterator[tuple]:
    """Captures of one gzip file: id, URL, date, type, id referred to, payload length and digest."""
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content)))
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError("a WARC record was expected")
        fields = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.partition(b":")
            fields[name.decode()] = value.strip().decode()
        block = stream.read(int(fields["Content-Length"]))
        stream.read(4)
        number = lambda name: int(x) if name in fields and (x := URN.match(fields[name])[1]) else None
        digest, length = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["WARC-Payload-Length"])
        if fields["WARC-Type"] == "response":
            payload = block[block.index(b"\r\n\r\n") + 4 :]
            if (hashlib.sha1(payload).hexdigest(), len(payload)) != (digest, length):
                raise ValueError(f"{fields['WARC-Record-ID']} does not match its digest")
        yield number("WARC-Record-ID"), fields["WARC-Target-URI"], fields["WARC-Date"], fields["WARC-Type"], number("WARC-Refers-To"), length, digest


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives in ``path``."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("captured", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for content in part["content"]:
                if rows := list(parse_warc(content.as_py())):
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt.gz").load(path)
    return files.select("content").mapInArrow(run, CAPTURE)


class LoserTree:
    """Merge of k sorted lists of keys; iterating gives (list, position) in order of key, then list."""

    def __init__(self, runs: list[list]):
        self.runs, self.at = runs, [0] * len(runs)

    def _before(self, a: int, b: int) -> bool:
        """Whether list a's next key comes before list b's; a finished list comes last."""
        x, y = self.at[a] < len(self.runs[a]), self.at[b] < len(self.runs[b])
        if not (x and y):
            return x or (not y and a < b)
        return (self.runs[a][self.at[a]], a) < (self.runs[b][self.at[b]], b)

    def __iter__(self) -> Iterator[tuple[int, int]]:
        k = len(self.runs)
        if not k:
            return
        losers, winners = [0] * k, [0] * k + list(range(k))
        for node in range(k - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], losers[node] = (a, b) if self._before(a, b) else (b, a)
        top = winners[1] if k > 1 else 0
        while self.at[top] < len(self.runs[top]):
            yield top, self.at[top]
            self.at[top] += 1
            node = (top + k) // 2
            while node:
                if self._before(losers[node], top):
                    losers[node], top = top, losers[node]
                node //= 2


def capture_index(captures: DataFrame) -> DataFrame:
    """Captures with ``url_key``, in global order of URL key, time and id; repeated captures stay."""
    keyed = captures.withColumn("url_key", url_key(F.col("url"))).withColumn("run", F.spark_partition_id())
    runs = stored(keyed.sortWithinPartitions(*KEY), "capture-runs")
    fields = runs.columns

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [p for p in parts if p.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held).combine_chunks()
        pieces: dict[int, list[int]] = {}
        for i, r in enumerate(rows["run"].to_pylist()):
            pieces.setdefault(r, []).append(i)
        # A null id comes first, as in Spark's order.
        keys = [(k, c or "", p is not None, p or 0) for k, c, p in zip(*(rows[n].to_pylist() for n in KEY))]
        lists = list(pieces.values())
        order = [lists[r][i] for r, i in LoserTree([[keys[i] for i in piece] for piece in lists])]
        yield from rows.take(pa.array(order)).to_batches(max_chunksize=8192)

    placed = runs.repartitionByRange(*KEY).sortWithinPartitions("run", *KEY)
    return placed.mapInArrow(run, runs.schema).select(*(f for f in fields if f != "run"))


def capture_date(page_id: Column) -> Column:
    """A time for pages that have none: their id as seconds from the start of 2020, in turns of ten years."""
    second = F.pmod(F.coalesce(page_id, F.lit(0)), F.lit(315_360_000))
    day = F.date_add(F.lit("2020-01-01").cast("date"), F.floor(second / 86400).cast("int")).cast("string")
    two = lambda n: F.lpad(n.cast("long").cast("string"), 2, "0")
    rest = second % 86400
    return F.concat(day, F.lit("T"), two(F.floor(rest / 3600)), F.lit(":"), two(F.floor(rest % 3600 / 60)), F.lit(":"), two(rest % 60), F.lit("Z"))


def op7_warc(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    path = fresh_path(spark, "warc")
    write_warc(pages.withColumn("captured", capture_date(F.col("page_id"))), path)
    index = capture_index(read_warc(spark, path))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured")


ORACLE = """
WITH p AS (
  SELECT page_id, lower(coalesce(url, '')) AS u, coalesce(html, '') AS h, page_id % 315360000 AS s,
         sha1(coalesce(html, '')) AS payload_digest, strlen(coalesce(html, '')) AS payload_bytes FROM pages),
k AS (SELECT h, max(page_id) AS kept FROM p WHERE payload_bytes >= 1000 GROUP BY h)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id < kept THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < kept THEN kept END AS refers_to,
       array_to_string(list_reverse(string_split(regexp_extract(u, '^[a-z][a-z0-9+.-]*://([^/?#]*)', 1), '.')), ',') || ')'
         || regexp_replace(u, '^[a-z][a-z0-9+.-]*://[^/?#]*', '') AS url_key,
       strftime(TIMESTAMP '2020-01-01' + to_seconds(s), '%Y-%m-%dT%H:%M:%SZ') AS captured
FROM p LEFT JOIN k ON p.h = k.h AND payload_bytes >= 1000
"""
