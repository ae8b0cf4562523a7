"""Quality control: summary, per-cycle statistics, box plot and text report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from readloom.functions.bases import gc_count
from readloom.functions.quality import decides_offset, decisive_offset, phred
from readloom.functions.text import basename, rounded, two_decimals

# Reported shares of reads, in percent; cycles shown alone; cycles per later group.
SHARES = (10, 25, 50, 75, 90)
SINGLE_CYCLES, GROUP = 9, 5

STATS = [f"p{s}" for s in SHARES] + ["avg_q"]


def phred_offset(reads: DataFrame, *order: str, sample: int | None = None) -> DataFrame:
    """One row ``offset``: 33, 64, or 0 when no quality character decides.

    The first read under ``order`` with a decisive character decides; ``sample`` looks at the
    first reads only, as sniffing a file does.
    """
    if sample is not None:
        reads = reads.orderBy(*order).limit(sample)
    qual = F.col("qual")
    found = reads.where(decides_offset(qual)).select(decisive_offset(qual).alias("offset"), *order)
    first = F.min_by("offset", F.struct(*order)) if order else F.first("offset")
    return found.agg(F.coalesce(first, F.lit(0)).alias("offset"))


def phred_long(reads: DataFrame, offset: int = 33) -> DataFrame:
    """One row per base: the columns of ``reads`` but for the strings, ``cycle`` (from 1), ``q``."""
    keep = [c for c in reads.columns if c not in ("bases", "qual")]
    long = reads.select(*keep, F.posexplode(F.split("qual", "")).alias("i", "ch"))
    return long.select(*keep, (F.col("i") + 1).alias("cycle"), phred(F.col("ch"), offset).alias("q"))


def qc_summary(reads: DataFrame) -> DataFrame:
    """One row: reads, bases, GC bases, shortest and longest read, GC percentage."""
    size = F.length("bases").cast("long")
    sums = reads.agg(
        F.count("*").alias("reads"),
        F.sum(size).alias("bases"),
        F.sum(gc_count(F.col("bases")).cast("long")).alias("gc_bases"),
        F.min(size).alias("min_len"),
        F.max(size).alias("max_len"),
    )
    share = F.col("gc_bases").cast("double") / F.col("bases").cast("double") * 100
    return sums.withColumn("gc_pct", rounded(share))


def cycle_quality_hist(reads: DataFrame, offset: int = 33) -> DataFrame:
    """``cycle, q, n``. Partial aggregation leaves each task with one row per cycle and quality."""
    long = phred_long(reads.select("qual"), offset)
    return long.groupBy("cycle", "q").agg(F.count("*").alias("n"))


def quality_maps(hist: DataFrame) -> DataFrame:
    """The histogram as one ``counts`` map (quality to reads) per cycle."""
    entries = F.collect_list(F.struct("q", "n"))  # one entry per quality value
    return hist.groupBy("cycle").agg(F.map_from_entries(entries).alias("counts"))


def cycle_quantiles(hist: DataFrame) -> DataFrame:
    """Per cycle: reads, the largest q reached by at least each share of reads, the mean q.

    Works on the histogram, so a window holds one row per quality value. Shares are compared in
    whole numbers, which keeps them exact.
    """
    cycle = W.partitionBy("cycle")
    running = hist.select(
        "*",
        F.sum("n").over(cycle.orderBy(F.desc("q"))).alias("at_least"),
        F.sum("n").over(cycle).alias("total"),
    )
    reached = [
        F.max(F.when(F.col("at_least") * 100 >= F.col("total") * share, F.col("q"))).alias(f"p{share}")
        for share in SHARES
    ]
    mean = F.sum(F.col("q") * F.col("n")).cast("double") / F.sum("n").cast("double")
    return running.groupBy("cycle").agg(F.sum("n").alias("n"), *reached, rounded(mean).alias("avg_q"))


def avg_quality(hist: DataFrame) -> DataFrame:
    """One row: the true mean quality, and the report's mean of cut-off cycle means."""
    per_cycle = hist.groupBy("cycle").agg(
        F.sum(F.col("q") * F.col("n")).alias("sum_q"), F.sum("n").alias("n")
    )
    mean = F.col("sum_q").cast("double") / F.col("n").cast("double")
    cycles = per_cycle.select("sum_q", "n", F.floor(rounded(mean)).alias("whole"))
    return cycles.agg(
        (F.sum("sum_q").cast("double") / F.sum("n").cast("double")).alias("avg_quality"),
        F.floor(F.sum("whole") / F.count("*")).alias("avg_quality_trunc"),
    )


def qc_boxplot(quantiles: DataFrame) -> DataFrame:
    """Cycles 1 to 9 alone, then groups of five with averaged statistics.

    A last group of fewer than five cycles shows its last cycle only.
    """
    first_of_group = SINGLE_CYCLES + 1 + GROUP * F.floor((F.col("cycle") - SINGLE_CYCLES - 1) / GROUP)
    group = F.when(F.col("cycle") <= SINGLE_CYCLES, F.col("cycle")).otherwise(first_of_group).cast("int")
    full = F.count("*") == GROUP

    def stat(name: str) -> Column:
        last = F.max_by(F.col(name).cast("double"), "cycle")
        return F.when(full, rounded(F.sum(name).cast("double") / GROUP)).otherwise(last).alias(name)

    return (
        quantiles.groupBy(group.alias("group"))
        .agg(
            F.when(full, F.min("cycle")).otherwise(F.max("cycle")).alias("first_cycle"),
            F.max("cycle").alias("last_cycle"),
            *[stat(name) for name in STATS],
        )
        .drop("group")
    )


def qc_report_lines(
    path: str, summary: DataFrame, average: DataFrame, boxplot: DataFrame
) -> DataFrame:
    """The text report as ``line_no, line``; spaces before line ends belong to the format.

    ``path`` is shown by its last part.
    """
    length = F.when(F.col("min_len") == F.col("max_len"), F.concat(F.col("max_len"), F.lit(" "))).otherwise(
        F.concat(F.col("min_len"), F.lit("-"), F.col("max_len"), F.lit("  "))
    )
    # The labels of the report, in order.
    head = [
        F.lit("Measure value "),
        F.concat(F.lit("Filename:"), basename(F.lit(path)), F.lit(" ")),
        F.concat(F.lit("Total reads:"), F.col("reads"), F.lit(" ")),
        F.concat(F.lit("Total Sequences:"), F.col("bases"), F.lit(" ")),
        F.concat(F.lit("Sequence length:"), length),
        F.concat(F.lit("Average quality:"), two_decimals(F.col("avg_quality_trunc")), F.lit(" ")),
        F.concat(F.lit("%GC:"), two_decimals(F.col("gc_pct")), F.lit(" ")),
        F.lit("----------For Box plot----------"),
    ]
    # Both inputs are one-row aggregates.
    one_row = summary.join(average, how="cross").select(F.posexplode(F.array(*head)).alias("i", "line"))
    header = one_row.select((F.col("i") + 1).alias("line_no"), "line")

    first, last = F.col("first_cycle"), F.col("last_cycle")
    label = F.when(first == last, F.concat(last, F.lit("\t"))).otherwise(F.concat(first, F.lit("-"), last, F.lit(" ")))
    in_groups = SINGLE_CYCLES + 1 + F.floor((last - SINGLE_CYCLES - 1) / GROUP)
    place = F.when(last <= SINGLE_CYCLES, last).otherwise(in_groups)
    table = boxplot.select(
        (place + len(head)).cast("int").alias("line_no"),
        F.concat(label, F.concat_ws(" ", *[two_decimals(F.col(s)) for s in STATS])).alias("line"),
    )
    return header.unionByName(table)
