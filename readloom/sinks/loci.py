"""A store of locus counts: parquet, partitioned by reference name, to which batches are added."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.session import fresh_path
from readloom.sinks.text import LOCUS_COLUMNS

COUNTS = LOCUS_COLUMNS[3:]
STORED = ", ".join(["chrom string", "pos int", "ref string", *(f"{c} long" for c in COUNTS)])


def read_locus_store(spark: SparkSession, path: str) -> DataFrame:
    """The counts of a store, one row for each locus."""
    return spark.read.schema(STORED).parquet(path).select(*LOCUS_COLUMNS)


def add_to_locus_store(loci: DataFrame, path: str) -> None:
    """Add the counts of a batch to those at ``path``; a store that is not there yet is begun.

    Only reference names that the batch has are read and written anew, the others stay as they are. The sums are
    written beside the store first, as Spark can't overwrite what it reads; a run that is lost before its last write
    leaves the store as it was. One batch is added at a time.
    """
    spark = loci.sparkSession
    new = _written(loci.select(*LOCUS_COLUMNS), spark)
    try:
        # Which names a store has is known from its folders; its rows are read only where the batch has the name.
        old = read_locus_store(spark, path).join(F.broadcast(new.select("chrom").distinct()), "chrom", "left_semi")
        sums = [F.sum(c).alias(c) for c in COUNTS]
        new = _written(old.select(*LOCUS_COLUMNS).union(new).groupBy("chrom", "pos", "ref").agg(*sums), spark)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    placed = new.repartition("chrom", F.expr("pos DIV 1048576")).sortWithinPartitions("chrom", "pos")
    placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("chrom").parquet(path)


def _written(loci: DataFrame, spark: SparkSession) -> DataFrame:
    path = fresh_path(spark, "locus-sums")
    loci.write.parquet(path)
    return spark.read.schema(loci.schema).parquet(path)
