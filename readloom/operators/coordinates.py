"""SAM header rewrite, mapped reads, coordinate order and per-partition blocks."""

from __future__ import annotations

from collections.abc import Iterator
from io import TextIOWrapper
from itertools import chain, groupby, pairwise
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from readloom.functions.cigar import reference_span
from readloom.operators.external import command_lines, line_batches
from readloom.session import fresh_path
from readloom.sources.sam import SAM_FIELDS

SORT_KEYS = ["rname", "pos", "qname", "flag"]
REGION = 1 << 20


def sam_split_counts(header: DataFrame, sam: DataFrame) -> DataFrame:
    """One row: header lines and alignment lines."""
    part = lambda df, is_header: df.select(F.lit(is_header).alias("h"))
    both = part(header, True).unionByName(part(sam, False))
    return both.agg(F.count_if("h").alias("header_lines"), F.count_if(~F.col("h")).alias("body_lines"))


def mapped_reads(sam: DataFrame) -> DataFrame:
    return sam.where(F.col("rname") != "*")


def sam_header_sorted(header: DataFrame) -> DataFrame:
    """Distinct header lines, marked sorted, ordered by their second field."""
    second = F.split_part("line", F.lit("\t"), F.lit(2))
    return (
        header.select("line")
        .distinct()
        .orderBy(second, "line")
        .select(F.replace("line", F.lit("unsorted"), F.lit("sorted")).alias("line"))
    )


def coordinate_sort(sam: DataFrame) -> DataFrame:
    """Global order by reference name and numeric position.

    The range exchange splits on name, position and read name together, so neither a large
    chromosome nor one crowded position has to fit a single task.
    """
    return sam.orderBy(*SORT_KEYS)


def with_coordinate_rank(sam: DataFrame) -> DataFrame:
    """``rank``, the place of a read within its reference name in the order of ``coordinate_sort``.

    A window per reference name would put a whole chromosome into one task. Instead the sort keys alone are range
    partitioned first, which yields the largest key of each range and the reads of each name in it. The bounds, one for
    each of Spark's partitions, are then constants by which every read knows its range: reads are shuffled by name and
    range, numbered there, and add the reads of the name in earlier ranges. Equal keys share a range, in any order.
    """
    spark, key = sam.sparkSession, F.struct(*SORT_KEYS)
    parted = sam.select(*SORT_KEYS).repartitionByRange(*SORT_KEYS).select(*SORT_KEYS, F.spark_partition_id().alias("part"))
    path = fresh_path(spark, "ranges")
    parted.groupBy("part", "rname").agg(F.count("*").alias("n"), F.max(F.struct(*SORT_KEYS[1:])).alias("top")).write.parquet(path)
    held = spark.read.parquet(path)
    tops = held.groupBy("part").agg(F.max(F.struct("rname", "top")).alias("top")).orderBy("part").collect()
    bounds = [(r.top.rname, *r.top.top) for r in tops]

    # The ranges that have rows are numbered in order, as a search among their bounds numbers them.
    numbers = spark.createDataFrame([(r.part, i) for i, r in enumerate(tops)], "part int, range int")
    earlier = W.partitionBy("rname").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    before = held.join(F.broadcast(numbers), "part").select(
        F.col("rname").alias("_name"), F.col("range").alias("_of"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before")
    )
    placed = sam.withColumn("_range", _range_of(key, bounds, sam.select(*SORT_KEYS).schema))
    place = F.row_number().over(W.partitionBy("rname", "_range").orderBy(*SORT_KEYS))
    found = placed.withColumn("_place", place).join(before, F.col("rname").eqNullSafe(F.col("_name")) & (F.col("_range") == F.col("_of")))
    return found.select(*sam.columns, (F.col("_before") + F.col("_place")).alias("rank"))


def _range_of(key: Column, bounds: list[tuple], schema: StructType) -> Column:
    """How many of the ascending ``bounds`` are smaller than ``key``, searched in two steps."""
    if not bounds:
        return F.lit(0)
    wide = max(1, round(len(bounds) ** 0.5))
    groups = [bounds[i : i + wide] for i in range(0, len(bounds), wide)]
    literal = lambda b: F.struct(*(F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(b, schema)))
    smaller = lambda some: F.size(F.filter(some, lambda b: b < key))
    outer = smaller(F.array(*(literal(g[-1]) for g in groups)))
    return outer * wide + F.coalesce(smaller(F.get(F.array(*(F.array(*map(literal, g)) for g in groups)), outer)), F.lit(0))


def sam_lines(sam: DataFrame) -> DataFrame:
    """SAM text of alignments, as ``value``."""
    fields = [F.col(c).cast("string") for c in SAM_FIELDS]
    return sam.select(F.concat_ws("\t", *fields, F.col("tags")).alias("value"))


def sam_partition_blocks(header: DataFrame, sam: DataFrame, whole_names: bool = True) -> DataFrame:
    """Lines to feed a SAM tool: in every partition the header, then its alignments in order.

    ``whole_names`` keeps each reference name in one partition; rows stream through a spilling
    sort and are never gathered. Otherwise partitions are ranges of positions, for tools that
    treat reads one by one. A tool that counts per position scales with ``pileup_by_region``.
    Empty partitions stay empty.
    """
    if whole_names:
        ordered = sam.repartitionByRange("rname").sortWithinPartitions(*SORT_KEYS)
    else:
        ordered = coordinate_sort(sam)
    return _headed(header, ordered)


def _headed(header: DataFrame, ordered: DataFrame) -> DataFrame:
    """SAM text of sorted partitions, each that has rows led by the header."""
    path = _stored_header(header)

    def with_header(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        started = False
        for batch in batches:
            if batch.num_rows and not started:
                started = True
                yield from line_batches(_header_lines(path))
            yield pa.record_batch([batch.column(0)], names=["value"])

    return sam_lines(ordered).mapInArrow(with_header, "value string")


def pileup_by_region(header: DataFrame, sam: DataFrame, command: str, width: int = REGION, sums: bool = False) -> DataFrame:
    """Output of a pileup command that prints ``name<tab>position...``, run once per region.

    A large chromosome is cut into regions of ``width`` bases. A read goes to every region it touches,
    so the command sees all reads over a position; of its output only the positions inside the region
    count, which makes the result that of whole chromosomes. A task takes its regions one after the other
    from a sorted, spilling exchange, so regions may be as many as they like.

    ``sums`` states that the command prints name, position and a count that adds up over reads, as a depth does. A read
    then goes to the region of its start alone, REBALANCE splits a crowded region over tasks, each with a run of the
    command over its part in coordinate order, and the counts of a position are added up. So no region has to fit a task.
    """
    first = F.floor((F.col("pos") - 1) / width)
    last = F.floor((F.col("pos") + F.greatest(reference_span(F.col("cigar")), F.lit(1)) - 2) / width)
    touched = sam.select("*", F.explode(F.array(first) if sums else F.sequence(first, last)).alias("region"))
    spot = ["rname", "region"]
    spread = touched.where("region is not null").hint("rebalance", *spot) if sums else touched.repartition(*spot)
    ordered = spread.sortWithinPartitions(*spot, *SORT_KEYS)
    fields = [F.col(c).cast("string") for c in SAM_FIELDS]
    keyed = ordered.select(*spot, F.concat_ws("\t", *fields, F.col("tags")).alias("value"))
    path = _stored_header(header)

    def inside(line: str, name: str, region: int) -> bool:
        parts = line.split("\t", 2)
        return parts[0] == name and len(parts) > 1 and parts[1].isdigit() and (int(parts[1]) - 1) // width == region

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (name, region), group in groupby(_stretches(batches), key=itemgetter(0, 1)):
            found = command_lines(command, chain(_header_lines(path), (lines for _, _, lines in group)))
            yield from line_batches(found if sums else (x for x in found if inside(x, name, region)))

    printed = keyed.mapInArrow(run, "value string")
    if not sums:
        return printed
    parts = F.split("value", "\t")
    counts = printed.select(parts[0].alias("name"), parts[1].cast("long").alias("at"), parts[2].cast("long").alias("n"), F.size(parts).alias("size"))
    added = counts.groupBy("name", "at").agg(F.sum("n").alias("n"), F.max("size").alias("size"))
    whole = F.when(F.col("size") == 3, F.col("n")).otherwise(F.raise_error(F.lit("the command prints more than a count")))
    return added.select(F.concat_ws("\t", "name", "at", whole).alias("value"))


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, str]]:
    """Name, region and text of each stretch of rows with one region, as it lies in a batch."""
    for batch in batches:
        if batch.num_rows:
            name = batch.column(0).dictionary_encode()
            number, region = name.indices.to_numpy(), batch.column(1).to_numpy()
            ends = np.flatnonzero((number[1:] != number[:-1]) | (region[1:] != region[:-1])) + 1
            for start, end in pairwise([0, *ends.tolist(), batch.num_rows]):
                yield name[start].as_py(), int(region[start]), "\n".join(batch.column(2)[start:end].to_pylist())


def _stored_header(header: DataFrame) -> str:
    """The sorted header as text in the shared folder."""
    path = fresh_path(header.sparkSession, "header")
    sam_header_sorted(header).select(F.col("line").alias("value")).write.text(path)
    return path


def _header_lines(path: str) -> Iterator[str]:
    """A stored header, streamed by a task from the shared folder."""
    store, inner = fs.FileSystem.from_uri(path) if ":" in path else (fs.LocalFileSystem(), path)
    inner = inner.removeprefix("file:")
    for info in sorted(store.get_file_info(fs.FileSelector(inner)), key=lambda f: f.path):
        if info.base_name.startswith("part-"):
            with store.open_input_stream(info.path) as stream:
                for line in TextIOWrapper(stream, encoding="utf-8", newline="\n"):
                    yield line.rstrip("\n")
