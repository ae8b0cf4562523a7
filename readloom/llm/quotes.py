"""Conversations from messages that quote each other.

A line's quote level is the number of ``>`` before it. The lines of level 0 are a message's own text, those of
level 1 what it replies to, those of level 2 what that replied to. Passages are normalised (blanks, case) and
hashed. A message is found by its own text together with what it quotes, else by its own text, else by one of
its paragraphs; a reply looks for the same one level down, in this order. Where that finds nothing, as the message
it replies to is missing, edited or blank, it looks for what is quoted at level 2, then 3 and so on: the shallowest
level that hits counts.

Originals are summed up by hash first: the smallest id stands for all messages of equal passage, so a phrase that
a third of all messages share is one row of the join. Links lead to earlier messages only, so they form trees. Roots
and depths come from doubling the jumps, in as many joins as the depth has binary digits.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from readloom.llm.common import stored

MARKS = re.compile(r"^(?:[ \t]*>)+[ \t]?")
# A line of one's own that begins like a quote has a backslash before it where marks are escaped.
ESCAPED = re.compile(r"^\\+[ \t]*>")
FULL, OWN, PARAGRAPH = 0, 1, 2
# Bits for the turns of a conversation in an id.
WIDTH = 20


def levels(text: str, escaped: bool = False) -> list[tuple[int, str]]:
    """Quote level and bare text of each line; ``escaped`` takes one backslash from what ``escape`` has put before it."""
    out = []
    for line in text.split("\n"):
        marks = MARKS.match(line)
        level, bare = (marks[0].count(">"), line[marks.end() :]) if marks else (0, line)
        out.append((level, bare[1:] if escaped and ESCAPED.match(bare) else bare))
    return out


def escape(text: Column) -> Column:
    """Text whose lines are all of level 0 for ``levels(..., escaped=True)``, which gives them back."""
    return F.regexp_replace(text, r"(?m)^(?=\\*[ \t]*>)", r"\\")


def normal(lines: list[str]) -> str:
    return " ".join(" ".join(lines).lower().split())


def digest(*passages: str) -> bytes:
    return hashlib.md5("\x00".join(passages).encode()).digest()


def passages(lines: list[tuple[int, str]], level: int) -> list[tuple[int, bytes]]:
    """Kinds and hashes of what stands at ``level``; none if that is empty."""
    at = lambda k: normal([t for n, t in lines if n == k])
    own = at(level)
    if not own:
        return []
    out = {(FULL, digest(own, at(level + 1))), (OWN, digest(own))}
    run: list[str] = []
    for n, t in [*lines, (-1, "")]:
        if n == level and t.strip():
            run.append(t)
        elif run:
            out.add((PARAGRAPH, digest(normal(run))))
            run = []
    return sorted(out)


def parsed(messages: DataFrame, id_col: str, text_col: str, escaped: bool = False) -> DataFrame:
    """``message_id, own, side, kind, hash``: own text with no quotes, and a row for each passage; side is its quote level."""
    schema = pa.schema([("message_id", pa.int64()), ("own", pa.string()), ("side", pa.int32()), ("kind", pa.int32()), ("hash", pa.binary())])
    rows = messages.select(F.col(id_col).cast("long").alias("message_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            out = []
            for i, text in zip(part["message_id"].to_pylist(), part["text"].to_pylist()):
                lines = levels(text, escaped)
                out.append((i, "\n".join(t for n, t in lines if n == 0).strip(), -1, 0, None))
                out += [(i, None, side, *p) for side in sorted({n for n, _ in lines}) for p in passages(lines, side)]
            if out:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return rows.mapInArrow(run, "message_id long, own string, side int, kind int, hash binary")


def links(found: DataFrame, times: DataFrame | None = None) -> DataFrame:
    """``message_id, parent_id, level`` of the messages whose quote, at ``level``, is found in an earlier one.

    Earlier is what has the smaller ``at`` in ``times``, rows ``message_id, at``, then the smaller id; by id alone
    without ``times``. A message without a time is later than those that have one.
    """
    if times is None:
        timed = found.withColumn("at", F.lit(0).cast("long"))
    else:
        # Of repeated rows the earliest time counts, so that a message has one place in the order.
        first = times.groupBy("message_id").agg(F.min("at").alias("at"))
        timed = found.join(first.where("message_id is not null"), "message_id", "left")
    spot = F.struct(F.col("at").isNull().alias("none"), "at", "message_id")
    originals = timed.where("side = 0 and message_id is not null").groupBy("kind", "hash").agg(F.min(spot).alias("parent"))
    quotes = timed.where("side > 0 and message_id is not null").select("message_id", "side", "kind", "hash", spot.alias("spot")).distinct()
    hits = quotes.join(originals, ["kind", "hash"]).where(F.col("parent") < F.col("spot"))
    votes = hits.groupBy("message_id", "side", "kind", F.col("parent.message_id").alias("parent_id")).agg(F.count("*").alias("n"), F.min("parent").alias("parent"))
    best = F.min(F.struct("side", "kind", (-F.col("n")).alias("n"), "parent")).alias("best")
    return votes.groupBy("message_id").agg(best).select("message_id", F.col("best.parent.message_id").alias("parent_id"), F.col("best.side").alias("level"))


def roots(parents: DataFrame) -> DataFrame:
    """``message_id, conversation_id, depth`` of every message that is linked."""
    now = parents.select("message_id", F.col("parent_id").alias("top"), F.lit(1).cast("long").alias("depth"), F.lit(True).alias("open"))
    now = stored(now, "jumps")
    while now.where("open").limit(1).count():
        up = now.select(
            F.col("message_id").alias("top"), F.col("top").alias("further"), F.col("depth").alias("more"), F.col("open").alias("goes_on")
        )
        # Only rows whose top may have a parent jump again.
        joined = now.where("open").join(up, "top", "left").select(
            "message_id",
            F.coalesce("further", "top").alias("top"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            F.coalesce("goes_on", F.lit(False)).alias("open"),
        )
        now = stored(joined.unionByName(now.where("not open")), "jumps")
    return now.select("message_id", F.col("top").alias("conversation_id"), "depth")


def conversations(
    messages: DataFrame, id_col: str = "message_id", text_col: str = "text", time_col: str | None = None, escaped: bool = False
) -> DataFrame:
    """``message_id, parent_id, conversation_id, depth, level, own`` of every message.

    Parents are earlier by ``time_col`` and id, by id alone without such a column. ``level`` is the quote level at which
    the parent was found: 1 for the message replied to, more where only an earlier one was found.

    A message without a found quote starts a conversation of its own. ``own`` has no quotes; null and empty texts
    are empty, quote nothing and are quoted by none. Repeated rows stay; rows of a null id are never linked.
    ``escaped`` is for texts whose own lines went through ``escape``.
    """
    found = stored(parsed(messages, id_col, text_col, escaped), "passages")
    times = time_col and messages.select(F.col(id_col).cast("long").alias("message_id"), F.col(time_col).alias("at"))
    parents = stored(links(found, times), "links")
    own = found.where("side = -1").select("message_id", "own")
    tree = parents.join(roots(parents), "message_id")
    return own.join(tree, "message_id", "left").select(
        "message_id", "parent_id", F.coalesce("conversation_id", "message_id").alias("conversation_id"),
        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"), "level", "own",
    )


def numbered(turns: DataFrame, width: int = WIDTH) -> DataFrame:
    """``message_id, text, one, two`` of rows ``conv_id, turn, text``: a number and the two texts before in the conversation.

    Rows are sorted by conversation, turn and text over ranges, whatever the size of a conversation. A range counts on
    from those before it and gets copies of the last two rows of a conversation that it goes on with. The number of
    ranges, not of rows, comes to the driver. The id is ``conv_id * 2^width + k`` for the k-th turn if that is unique for
    all rows and fits 64 bits, else the position in the order, from 1; both rise in the order.
    """
    keys = ["conv_id", "turn", "text", "salt"]
    rows = turns.select(F.col("conv_id").cast("long"), "turn", "text", F.monotonically_increasing_id().alias("salt"))
    rows = stored(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("spot", F.monotonically_increasing_id()), "turns")
    rows = rows.select("conv_id", "text", F.shiftright("spot", 33).alias("range"), F.col("spot").bitwiseAND((1 << 33) - 1).alias("place"))
    runs = rows.groupBy("range", "conv_id").agg(F.count("*").alias("n")).groupBy("range")
    ends = runs.agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.min(F.struct("conv_id", "n")).alias("lo"), F.max(F.struct("conv_id", "n")).alias("hi"))
    ranges, guests, start, most, last, carried = [], [], 0, 0, None, 0
    fits, before = True, []
    for r in sorted(ends.collect(), key=lambda r: r["range"]):
        carry = carried if r.lo.conv_id == last else 0
        known = before[-min(2, carry):] if carry else []
        guests += [(r["range"], k - len(known), *at) for k, at in enumerate(known)]
        ranges.append((r["range"], start, carry, len(known), r.lo.conv_id))
        most = max(most, r.most, carry + r.lo.n)
        fits = fits and -(1 << 63 - width) <= r.lo.conv_id and r.hi.conv_id < 1 << 63 - width
        start, last, carried = start + r.n, r.hi.conv_id, r.hi.n + (carry if r.lo.conv_id == r.hi.conv_id else 0)
        before = (before + [(r["range"], k) for k in range(max(0, r.n - 2), r.n)])[-2:]
    fits = fits and most < 1 << width
    spark = turns.sparkSession
    ranges = F.broadcast(spark.createDataFrame(ranges, "range long, start long, carry long, known long, lo long"))
    guests = F.broadcast(spark.createDataFrame(guests, "to long, spot long, range long, place long"))
    copied = rows.join(guests, ["range", "place"]).select("conv_id", "text", F.col("to").alias("range"), F.col("spot").alias("place"))
    order = W.partitionBy("range", "conv_id").orderBy("place")
    lagged = [F.lag("text", k).over(order) for k in (1, 2)]
    found = rows.unionByName(copied).select("*", F.row_number().over(order).alias("k"), lagged[0].alias("one"), lagged[1].alias("two"))
    found = found.where("place >= 0").join(ranges, "range")
    k = F.col("k") + F.when(F.col("conv_id") == F.col("lo"), F.col("carry") - F.col("known")).otherwise(0)
    number = F.col("conv_id") * (1 << width) + k if fits else F.col("start") + F.col("place") + 1
    return found.select(number.alias("message_id"), "text", "one", "two")


def quoting_messages(turns: DataFrame) -> DataFrame:
    """Conversation turns as messages that quote the two turns before them: ``message_id, text``.

    A turn's own lines that begin like a quote are escaped. A turn without ``conv_id`` belongs to no conversation: it
    is a message of null id that quotes nothing. Turns of equal number follow each other by text; null texts are empty.
    """
    text = F.coalesce(escape(F.col("text")), F.lit("")).alias("text")
    own = turns.select("conv_id", "turn", text)
    rows = numbered(own.where("conv_id is not null"))
    quoted = lambda c, mark: F.when(F.col(c).isNull(), F.lit("")).otherwise(F.concat(F.lit(mark), F.replace(F.col(c), F.lit("\n"), F.lit("\n" + mark)), F.lit("\n")))
    messages = rows.select("message_id", F.concat(quoted("two", ">> "), quoted("one", "> "), "text").alias("text"))
    return messages.unionByName(own.where("conv_id is null").select(F.lit(None).cast("long").alias("message_id"), "text"))


def op8_quotes(spark, sf_dir: str) -> DataFrame:
    messages = quoting_messages(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    found = conversations(messages, escaped=True)
    return found.select("message_id", "parent_id", "conversation_id", "depth", F.char_length("own").cast("long").alias("own_chars"))
