"""Helpers that the operators of this folder share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.session import fresh_path

# Keys of more rows than this, and than one in COPIES of all rows, are joined apart.
MANY, COPIES = 1000, 10_000
# A stored side of at most so many rows, of numbers only, is broadcast.
FEW = 1 << 18

Query = Callable[[SparkSession, str], DataFrame]

# Words are what stands between blanks: space, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text`` alone, whatever else the table has; null texts become empty."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))


def one_per_id(rows: DataFrame) -> DataFrame:
    """``doc_id, text`` once for each id of repeated rows: the text of the least hash, then the least text."""
    least = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least")
    return rows.groupBy("doc_id").agg(least).select("doc_id", "least.text")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a step to the shared folder and read it back, so that lost executors cost no recomputation."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Arrow batches of at most ``size`` rows from row tuples."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.record_batch(list(map(list, zip(*held))), schema=schema)
            held = []
    if held:
        yield pa.record_batch(list(map(list, zip(*held))), schema=schema)


def unused(df: DataFrame, name: str) -> str:
    """``name``, longer by as many marks as it takes to clash with no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def if_few(table: DataFrame, most: int = FEW) -> DataFrame:
    """A stored table of numbers, to be broadcast if it has at most ``most`` rows; else Spark chooses the join."""
    return F.broadcast(table) if table.count() <= most else table


def joined_apart(rows: DataFrame, table: DataFrame, keys: list[str], n_rows: int) -> DataFrame:
    """``rows`` joined with ``table``, which has a row for each key and says in ``copies`` how many rows have it.

    Keys of very many rows are at most ``COPIES`` by their bound; they are sent to the rows, which stay where they are.
    """
    many = F.col("copies") > max(MANY, n_rows / COPIES)
    hot, cold = F.broadcast(table.where(many).drop("copies")), table.where(~many).drop("copies")
    others = rows.join(hot.select(*keys), keys, "left_anti").join(cold, keys)
    return rows.join(hot, keys).unionByName(others)


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the undirected edges ``a, b``: root is the smallest reachable node.

    Large-star and small-star steps alternate until the edges are stars around the smallest nodes. Each
    step takes the smallest neighbour by a hash aggregate and joins it back, so a hub with very many
    neighbours is summed up in the tasks and split by the skew join; nothing is gathered per node.
    """

    def star(pairs: DataFrame, mark: str) -> DataFrame:
        least = pairs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        joined = pairs.join(least, "a")
        if mark == "large":
            return joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        up = joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
        return up.union(least.select("a", F.col("m").alias("b")))

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b")
    now = stored(down.distinct(), "edges")
    before = state(now)
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = star(both, "large").where("a > b").distinct()
        now = stored(star(large, "small").where("a > b").distinct(), "edges")
        after = state(now)
        if after == before:
            break
        before = after
    tops = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(tops)
