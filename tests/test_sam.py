import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from readloom.operators import coordinates, external, partitioning
from readloom.sources import parse_sam, sam_header

HEADER = ["@HD\tVN:1.4\tSO:unsorted", "@SQ\tSN:chr2\tLN:9", "@SQ\tSN:chr1\tLN:9", "@HD\tVN:1.4\tSO:unsorted"]


def body(n: int) -> list[str]:
    rng = random.Random(n)
    rows = []
    for i in range(n):
        name = "chr1" if i % 3 else rng.choice(["chr1", "chr10", "chr2", "*"])
        pos = 5 if i % 4 == 0 else rng.randint(1, 300)
        rows.append(f"q{i}\t0\t{name}\t{pos}\t60\t4M\t*\t0\t0\tACGT\tIIII" + ("\tNM:i:0\tXX:Z:a b" if i % 2 else ""))
    return rows


def lines_of(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string").repartition(4)


def test_parse_and_split(spark):
    lines = lines_of(spark, HEADER + body(20))
    sam = parse_sam(lines)
    assert sam.count() == 20 and sam_header(lines).count() == 4
    tags = {r.qname: r.tags for r in sam.collect()}
    assert tags["q0"] == [] and tags["q1"] == ["NM:i:0", "XX:Z:a b"]
    assert sorted(r.value for r in coordinates.sam_lines(sam).collect()) == sorted(body(20))


def test_header(spark):
    rows = coordinates.sam_header_sorted(sam_header(lines_of(spark, HEADER))).collect()
    assert [r.line for r in rows] == ["@SQ\tSN:chr1\tLN:9", "@SQ\tSN:chr2\tLN:9", "@HD\tVN:1.4\tSO:sorted"]


def test_order_and_rank(spark):
    sam = coordinates.mapped_reads(parse_sam(lines_of(spark, body(400))))
    got = [(r.rname, r.pos, r.qname) for r in coordinates.coordinate_sort(sam).collect()]
    assert got == sorted(got) and len(got) == sam.count()
    ranks = {(r.rname, r["rank"]): (r.rname, r.pos, r.qname) for r in coordinates.with_coordinate_rank(sam).collect()}
    want, seen = {}, {}
    for row in got:
        seen[row[0]] = seen.get(row[0], 0) + 1
        want[(row[0], seen[row[0]])] = row
    assert ranks == want


def test_rank_of_ties_and_nulls(spark):
    """A position with a third of all reads, whole rows that repeat, null keys, one range with rows, no rows."""
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", "b", None]), rng.choice([None, 7, 7, rng.randint(1, 99)]), f"q{rng.randint(1, 60)}", 0) for _ in range(900)]
    sam = spark.createDataFrame(rows, "rname string, pos int, qname string, flag int").repartition(6)
    key = lambda r: (r[1] is not None, r[1] or 0, r[2])
    for frame, some in ((sam, rows), (sam.limit(1), None), (sam.limit(0), [])):
        got = sorted(map(tuple, coordinates.with_coordinate_rank(frame).collect()), key=lambda r: (r[0] or "", r[4]))
        if some is None:
            assert [r[4] for r in got] == [1]
            continue
        want = []
        for name in (None, "a", "b"):
            group = sorted((r for r in some if r[0] == name), key=key)
            want += [(*r, i) for i, r in enumerate(group, 1)]
        assert got == want


def test_rank_keeps_no_copy(spark):
    sam = coordinates.mapped_reads(parse_sam(lines_of(spark, body(50))))
    plan = coordinates.with_coordinate_rank(sam)._jdf.queryExecution().optimizedPlan().toString()
    assert "InMemoryRelation" not in plan and "Sort" not in plan


def test_blocks(spark):
    lines = lines_of(spark, HEADER + body(100))
    sam = coordinates.mapped_reads(parse_sam(lines))
    for whole in (True, False):
        blocks = coordinates.sam_partition_blocks(sam_header(lines), sam, whole)
        parts = [p for p in blocks.rdd.map(lambda r: r.value).glom().collect() if p]
        names = []
        for part in parts:
            top = [x for x in part if x.startswith("@")]
            assert len(top) == 3 and part[:3] == top
            keys = [(x.split("\t")[2], int(x.split("\t")[3])) for x in part[3:]]
            assert keys == sorted(keys) and keys
            names += {k[0] for k in keys}
        assert sum(len(p) - 3 for p in parts) == sam.count()
        if whole:
            assert len(names) == len(set(names))


def test_no_rows_no_block(spark):
    lines = lines_of(spark, HEADER)
    blocks = coordinates.sam_partition_blocks(sam_header(lines), parse_sam(lines))
    assert blocks.count() == 0
    assert external.pipe_lines(blocks, "cat").count() == 0


def test_pipe(spark):
    df = spark.createDataFrame([("a\nb",), ("c",)], "value string")
    assert sorted(r.value for r in external.pipe_lines(df, "tr a-z A-Z").collect()) == ["A", "B", "C"]


def test_partition_by_id(spark):
    df = spark.createDataFrame([(i if i < 9 else None,) for i in range(10)], "k int")
    placed = partitioning.partition_by_id(df, 3, "k").select("k", F.spark_partition_id().alias("p"))
    assert placed.rdd.getNumPartitions() == 3
    assert {(r.k, r.p) for r in placed.collect()} == {(i, i % 3) for i in range(9)} | {(None, 0)}


DEPTH = (
    "awk -F'\\t' '!/^@/ {for (p = $4; p < $4 + 4; p++) n[$3 FS p]++} "
    "END {for (k in n) print k FS n[k]}'"
)


def test_regions_agree_with_whole_names(spark):
    lines = lines_of(spark, HEADER + body(300))
    sam = coordinates.mapped_reads(parse_sam(lines))
    whole = external.pipe_lines(coordinates.sam_partition_blocks(sam_header(lines), sam), DEPTH)
    want = sorted(r.value for r in whole.collect())
    for width in (3, 50, 1000):
        got = coordinates.pileup_by_region(sam_header(lines), sam, DEPTH, width)
        assert sorted(r.value for r in got.collect()) == want
    assert coordinates.pileup_by_region(sam_header(lines), sam.limit(0), DEPTH).count() == 0


def test_a_crowded_region_is_dealt_to_tasks(spark):
    """Counts that add up: one region, many runs of the command, the same sums; other output is an error."""
    lines = lines_of(spark, HEADER + body(2000)).repartition(8)
    sam = coordinates.mapped_reads(parse_sam(lines))
    want = sorted(r.value for r in coordinates.pileup_by_region(sam_header(lines), sam, DEPTH, 1000).collect())
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
    try:
        got = coordinates.pileup_by_region(sam_header(lines), sam, DEPTH, 1000, sums=True)
        assert sorted(r.value for r in got.collect()) == want
        # Every run of the command says that it ran.
        runs = coordinates.pileup_by_region(sam_header(lines), sam, "awk 'END {print \"chr1\\t1\\t1\"}'", 1000, sums=True)
        assert int(runs.head().value.split("\t")[2]) > 10
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    for width in (3, 50):
        some = coordinates.pileup_by_region(sam_header(lines), sam, DEPTH, width, sums=True)
        assert sorted(r.value for r in some.collect()) == want
    with pytest.raises(PySparkException, match="more than a count"):
        coordinates.pileup_by_region(sam_header(lines), sam, "awk 'END {print \"chr1\\t1\\t1\\tA\"}'", 1000, sums=True).collect()
