"""Mixing sources to target weights by pivotal dependent rounding.

A document of a source with target t and size s is wanted t / s times. The whole part is certain; the
fractions meet in pairs within their source. A random transfer of words, fair on average, moves as much
from one document to the other as makes one of the two integral; that one is settled and the other
meets the next. Words are conserved by each transfer, so a source ends within one document of its target.

Reduction tree. Documents are dealt into buckets of about ``BUCKET`` by a hash of their id, whatever their
source, so a source with a third of all rows is spread like any other. Each bucket leaves at most one
unsettled document for a source; these meet in groups of ``FAN`` buckets, level by level, up to one root.
Random numbers are hashes of ids and the order in a bucket is fixed, so reruns agree.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from readloom.llm.common import WORD, documents, stored, unused

BUCKET, FAN, SEED = 4096, 64, 6
# Fixed values of the mix: weights by the order of the sources, and the most often a source is taken.
WEIGHTS, MOST = (1.0, 2.0, 3.0), 3
TINY = 1e-12
ROUNDED = "doc_id long, tag long, no int, source string, size long, whole int, part double, bucket long, settled boolean"


def row_tag(docs: DataFrame) -> Column:
    """A hash of the whole row, which tells a null from any value; columns that can't be hashed take no part."""
    names = [f.name for f in docs.schema if not isinstance(f.dataType, MapType)]
    columns = [F.col(f"`{c}`") for c in names]
    return F.xxhash64(*(c.isNull() for c in columns), *columns)


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``doc_id, tag, no, source, size``: words of each text. ``tag`` tells rows of equal id apart, ``no`` equal rows.

    Equal rows are counted, in the tasks first, and numbered from their count, so no window holds them.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        row_tag(docs).alias("tag"),
        F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )
    counted = rows.groupBy("doc_id", "tag", "source", "size").agg(F.count("*").cast("int").alias("n"))
    return counted.select("doc_id", "tag", F.explode(F.sequence(F.lit(1), "n")).alias("no"), "source", "size")


def targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source, source_size, target``: shares of all words by weight, none above ``most`` times its source.

    A source is full once its share at the common level reaches its bound. Taken in the order of bound over
    weight, the level after the full ones is what is left over the weights that are left, in closed form. The
    window sees one row for each source.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = W.orderBy(F.col("source").asc_nulls_last())
    turn = F.array(*map(F.lit, weights))
    per = per.select(
        "source", "source_size",
        F.element_at(turn, ((F.row_number().over(ordered) - 1) % len(weights) + 1).cast("int")).alias("weight"),
        (F.col("source_size") * most).alias("bound"),
    )
    by = W.orderBy(F.col("bound") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by.rowsBetween(W.unboundedPreceding, -1)
    after = by.rowsBetween(0, W.unboundedFollowing)
    every = by.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("bound").over(before), F.lit(0))
    per = per.withColumn("level", left / F.sum("weight").over(after))
    open_level = F.when(F.col("level") * F.col("weight") < F.col("bound"), F.col("level"))
    level = F.first(open_level, ignorenulls=True).over(by.rowsBetween(W.unboundedPreceding, 0))
    target = F.coalesce(level * F.col("weight"), F.col("bound").cast("double"))
    return per.select("source", "source_size", target.alias("target"))


def transfer(a: list, b: list, u: float) -> None:
    """Move words between two fractions ``[..., size, part]`` at random until one is 0 or 1."""
    ratio = b[-2] / a[-2]
    up, down = min(1 - a[-1], b[-1] * ratio), min(a[-1], (1 - b[-1]) * ratio)
    move = up if u * (up + down) < down else -down
    a[-1], b[-1] = a[-1] + move, b[-1] - move / ratio
    for x in (a, b):
        if x[-1] < TINY or x[-1] > 1 - TINY:
            x[-1] = float(round(x[-1]))


def _level(df: DataFrame, level: int, last: bool) -> DataFrame:
    """Meet the unsettled documents of each bucket and source."""
    schema = df.sparkSession.createDataFrame([], ROUNDED).schema
    arrow = pa.schema([("doc_id", pa.int64()), ("tag", pa.int64()), ("no", pa.int32()), ("source", pa.string()), ("size", pa.int64()), ("whole", pa.int32()), ("part", pa.float64()), ("bucket", pa.int64()), ("settled", pa.bool_())])
    names = [f.name for f in arrow][:-1]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, held_u = None, None, 0.0
        for batch in parts:
            out: list[tuple] = []

            def settle(row, sure):
                out.append((*row["id"], row["v"][0], row["whole"] + (int(row["v"][1]) if sure else 0), 0.0 if sure else row["v"][1], row["bucket"], sure))

            for *fields, u in zip(*(batch[n].to_pylist() for n in [*names, "u"])):
                doc_id, tag, no, source, size, whole, part, bucket = fields
                row = {"id": (doc_id, tag, no, source), "whole": whole, "v": [size, part], "bucket": bucket}
                if key != (bucket, source):
                    if held is not None:
                        finish(held, held_u, settle)
                    key, held = (bucket, source), None
                if part <= 0 or size <= 0:
                    row["v"][1] = 0.0
                    settle(row, True)
                elif held is None:
                    held, held_u = row, u
                else:
                    transfer(held["v"], row["v"], u)
                    done, left = (held, row) if held["v"][1] in (0.0, 1.0) else (row, held)
                    settle(done, True)
                    held, held_u = (None if left["v"][1] in (0.0, 1.0) else left), u
                    if held is None:
                        settle(left, True)
            if out:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)
        if held is not None:
            out = []
            finish(held, held_u, lambda row, sure: out.append((*row["id"], row["v"][0], row["whole"] + (int(row["v"][1]) if sure else 0), 0.0 if sure else row["v"][1], row["bucket"], sure)))
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    def finish(row, u, settle):
        if last:
            row["v"][1] = float(u < row["v"][1])
        settle(row, last)

    chance = F.shiftrightunsigned(F.xxhash64(F.lit(SEED + level), "doc_id", "tag", "no"), 11) / float(1 << 53)
    order = ["bucket", "source", "u", "doc_id", "size", "tag", "no"]
    placed = df.select(*names, chance.alias("u")).repartition("bucket").sortWithinPartitions(*order)
    return placed.mapInArrow(run, schema)


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    most: int = MOST,
) -> DataFrame:
    """``doc_id, tag, no, source, size, source_size, target, copies``, one row for each row of ``docs``.

    Null and empty texts have size 0, target no words and are taken zero times or as the whole part says. Null
    sources are one source, the last. Repeated rows and equal ids are documents of their own. Words of an
    empty table or of a source without words are none.
    """
    sized = stored(sizes(docs, id_col, text_col, source_col), "sizes")
    goal = targets(sized, weights, most)
    goal = goal.withColumnRenamed("source", "of")
    wanted = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most))))
    wanted = F.coalesce(wanted, F.lit(0.0))
    buckets = max(1, math.ceil(sized.count() / BUCKET))
    start = sized.join(goal, sized.source.eqNullSafe(goal.of)).select(
        "doc_id", "tag", "no", "source", "size",
        F.floor(wanted).cast("int").alias("whole"),
        (wanted - F.floor(wanted)).alias("part"),
        F.pmod(F.xxhash64(F.lit(SEED), "doc_id", "tag", "no"), F.lit(buckets)).alias("bucket"),
    )
    level, settled = 0, []
    while True:
        done = stored(_level(start, level, buckets == 1), "mixed")
        settled.append(done.where("settled"))
        if buckets == 1:
            break
        start = done.where("not settled").withColumn("bucket", F.expr(f"bucket DIV {FAN}"))
        buckets, level = math.ceil(buckets / FAN), level + 1
    copies = settled[0]
    for more in settled[1:]:
        copies = copies.unionByName(more)
    return copies.join(goal, copies.source.eqNullSafe(goal.of)).select(
        "doc_id", "tag", "no", "source", "size", "source_size", "target", F.col("whole").alias("copies")
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with the columns of ``docs``, whatever they are called.

    Equal rows are reduced to one that is taken as often as all of them.
    """
    id_col = options.get("id_col", "doc_id")
    taken = mix(docs, **options).groupBy("doc_id", "tag").agg(F.sum("copies").alias("times"), F.count("*").alias("rows")).where("times > 0")
    taken = stored(taken.select(F.col("doc_id").alias("other_id"), F.col("tag").alias("other_tag"), "times", "rows"), "taken")
    names = [unused(docs, c) for c in ("key_id", "key_tag", "times_taken", "copy_no")]
    keyed = docs.withColumns({names[0]: F.col(id_col).cast("long"), names[1]: row_tag(docs)})

    def repeated(df: DataFrame, other: DataFrame) -> DataFrame:
        # It has a row for each document taken, so it is never broadcast.
        other = other.withColumnRenamed("times", names[2]).hint("merge")
        both = df.join(other, F.col(names[0]).eqNullSafe(F.col(other_id)) & (F.col(names[1]) == F.col(other_tag)))
        often = F.explode(F.sequence(F.lit(1).cast("long"), F.col(names[2]))).alias(names[3])
        return both.select(*(F.col(f"`{c}`") for c in docs.columns), often).drop(names[3])

    other_id, other_tag = unused(docs, "other_id"), unused(docs, "other_tag")
    taken = taken.withColumnsRenamed({"other_id": other_id, "other_tag": other_tag})
    twice = taken.where("rows > 1").drop("rows")
    of_twice = F.col(names[0]).eqNullSafe(F.col(other_id)) & (F.col(names[1]) == F.col(other_tag))
    one = keyed.join(twice, of_twice, "left_semi").dropDuplicates(names[:2])
    return repeated(keyed, taken.where("rows = 1").drop("rows")).union(repeated(one, twice))


def op6_mixing(spark, sf_dir: str) -> DataFrame:
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", taken, "source", "copies")
