import random
import re

import pytest

from readloom.operators import pileup
from readloom.sources import parse_alignments, read_reference, reference_bases, valid_alignments

ALN = "chrom string, pos int, mapq int, cigar string, bases string, qual string"


@pytest.fixture
def aligned(spark):
    return lambda *rows: spark.createDataFrame(
        [("chr1", pos, 60, cigar, bases, qual or "I" * len(bases)) for pos, cigar, bases, qual in rows], ALN
    )


@pytest.fixture
def ref(spark):
    rng = random.Random(8)
    seq = "".join(rng.choices("ACGT", k=500))
    return seq, spark.createDataFrame([("chr1", seq)], "chrom string, seq string")


@pytest.mark.parametrize(
    ("cigar", "bases", "loci"),
    [
        ("5M", "ACGTA", {10: "A", 11: "C", 12: "G", 13: "T", 14: "A"}),
        ("3M2D2M", "ACGTA", {10: "A", 11: "C", 12: "G", 15: "T", 16: "A"}),
        ("3M1I2M", "ACGTAC", {10: "A", 11: "C", 12: "G", 13: "A", 14: "C"}),
        ("2S3M", "ACGTA", {10: "G", 11: "T", 12: "A"}),
        ("2H1=1X1N1P2M3S", "ACGTTTT", {10: "A", 11: "C", 13: "G", 14: "T"}),
    ],
)
def test_loci_of_cigars(aligned, cigar, bases, loci):
    rows = pileup.pileup_counts(aligned((10, cigar, bases, None))).collect()
    assert {r.pos: next(b for b in "ACGT" if r[b.lower()]) for r in rows} == loci
    assert all(r.total == 1 and r.n == 0 for r in rows)


def test_quality_threshold_and_classes(aligned, ref):
    seq, frame = ref
    reads = aligned((1, "4M", "ANaT", "5555"), (1, "4M", "CCCC", "5!54"))
    rows = pileup.pileup_counts(reads, frame, min_q=20).orderBy("pos").collect()
    got = [(r.pos, r.ref, r.total, r.a, r.t, r.c, r.g, r.n) for r in rows]
    assert got == [
        (1, seq[0], 2, 1, 0, 1, 0, 0), (2, seq[1], 1, 0, 0, 0, 0, 1),
        (3, seq[2], 2, 0, 0, 1, 0, 1), (4, seq[3], 1, 0, 1, 0, 0, 0),
    ]


def test_gather_changes_nothing(aligned):
    rng = random.Random(2)
    rows = [(rng.randint(1, 5000), "8M", "".join(rng.choices("ACGT", k=8)), None) for _ in range(300)]
    some, other = (
        sorted(map(tuple, pileup.pileup_counts(aligned(*rows), gather=g).collect())) for g in (True, False)
    )
    assert some == other


def test_operation_offsets(aligned):
    rows = pileup.cigar_ops(aligned((1, "4S3M2I1D5N6M2H", "A" * 15, None))).orderBy("op_index").collect()
    assert [(r.len, r.op, r.read_off, r.ref_off) for r in rows] == [
        (4, "S", 0, 0), (3, "M", 4, 0), (2, "I", 7, 3), (1, "D", 9, 3), (5, "N", 9, 4), (6, "M", 9, 9), (2, "H", 15, 15),
    ]


@pytest.mark.parametrize(("tile", "overlap"), [(4096, 1024), (16, 8), (16, 0), (64, 40), (7, 300)])
def test_reference_under_alignments(aligned, ref, tile, overlap):
    seq, frame = ref
    rng = random.Random(5)
    rows = []
    for _ in range(200):
        span = rng.choice([1, 7, 8, 9, 39, 40, 41, 200])
        rows.append((rng.randint(1, 500 - span), f"2S1M{span - 1}D" if span > 1 else "1M", "ACG", None))
    got = pileup.with_reference(aligned(*rows), frame, tile, overlap).collect()
    assert len(got) == len(rows)
    for r in got:
        span = 1 if r.cigar == "1M" else int(r.cigar[4:-1]) + 1
        assert r.ref_seq == seq[r.pos - 1 : r.pos - 1 + span]


def test_reference_under_spliced_reads(spark):
    """Introns of 200,000 bases, repeated starts, ends beyond the sequence, starts outside it and missing CIGARs."""
    rng = random.Random(9)
    seqs = {name: "".join(rng.choices("ACGT", k=450_000)) for name in ("c1", "c2")}
    frame = spark.createDataFrame(list(seqs.items()), "chrom string, seq string")
    rows = [("c1", rng.randint(1, 240_000), "5M200000N5M", i) for i in range(6)] + [("c2", 4097, "5M8192N5M", i) for i in range(40)]
    rows += [("c2", 4096, "5M", 0), ("c2", 449_999, "5M3000N5M", 0)]
    lost = [("c1", 450_000 + 8192, "5M2000N5M", 0), ("c1", 0, "5M2000N5M", 0), ("c3", 1, "5M2000N5M", 0), ("c1", None, "5M2000N5M", 0)]
    reads = spark.createDataFrame([*rows, *lost, ("c1", 7, None, 0)], "chrom string, pos int, cigar string, level int").repartition(4)
    got = pileup.with_reference(reads, frame)
    span = lambda cigar: sum(map(int, re.findall(r"\d+", cigar)))
    want = [(*r, seqs[r[0]][r[1] - 1 : r[1] - 1 + span(r[2])]) for r in rows]
    assert sorted(map(tuple, got.where("cigar is not null").collect())) == sorted(want)
    assert [tuple(r) for r in got.where("cigar is null").collect()] == [("c1", 7, None, 0, None)]
    assert pileup.with_reference(reads.limit(0), frame).count() == pileup.with_reference(reads, frame.limit(0)).count() == 0


def test_tiles_are_shuffled_once(spark, aligned, ref):
    """Without broadcasts the tiles of short and of spliced reads are one exchange."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = pileup.with_reference(aligned((5, "5M", "ACGTA", None), (9, "2M30N3M", "ACGTA", None)), ref[1], 16, 8)
        assert got.count() == 2
        rows = got.collect()
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert len(rows) == 2 and plan.split("Initial Plan")[0].count("ReusedExchange") == 1


def test_gapped_strings(aligned, ref):
    seq, frame = ref
    rows = pileup.with_reference(aligned((5, "2S3M1I2D2M", "NNACGTCA", None)), frame)
    row = pileup.gapped_alignments(rows).head()
    w = seq[4:11]
    assert row.read_gapped == "ACGT__CA" and row.ref_gapped == f"{w[:3]}_{w[3:]}" and row.ops == "MMMIDDMM"


def test_reference_text(spark, tmp_path):
    path = tmp_path / "ref.txt"
    path.write_bytes(b"chr1 ACGTA\rchr2 GG\r\nchr3 T\n")
    ref = read_reference(spark, str(path))
    rows = reference_bases(ref, tile=2).orderBy("chrom", "pos").collect()
    assert "".join(r.ref for r in rows) == "ACGTAGGT"
    assert [r.pos for r in rows] == [1, 2, 3, 4, 5, 1, 2, 1]


def test_valid_alignments_keep_star_qualities(spark):
    lines = ["chr1 5 60 2M AC I*", "* 5 60 2M AC II", "chr1 5 60 * AC II", 'chr2 7 1 3M ACG "I"', "scaffold 1 1 1M A I"]
    rows = valid_alignments(parse_alignments(spark.createDataFrame([(x,) for x in lines], "value string"))).collect()
    assert [(r.chrom, r.pos, r.qual) for r in rows] == [("chr1", 5, "I*"), ("chr2", 7, '"I"')]


def test_missing_qualities_bases_and_reference(spark):
    rows = [
        ("c", 3, "4M", "ACGT", "IIII"), ("c", 3, "4M", "ACGT", "*"), ("c", 3, "4M", "*", "*"), ("c", 3, "1M", "A", "*"),
        ("d", 1, "2M", "AC", "II"), ("c", 9, "4M", "ACGT", "IIII"),
    ]
    reads = spark.createDataFrame(rows, "chrom string, pos int, cigar string, bases string, qual string")
    ref = spark.createDataFrame([("c", "TTACGTTTAC")], "chrom string, seq string")
    got = {(r.chrom, r.pos): (r.ref, r.total) for r in pileup.pileup_counts(reads, ref).collect()}
    want = {("c", 3): ("A", 3), ("c", 4): ("C", 2), ("c", 5): ("G", 2), ("c", 6): ("T", 2), ("d", 1): (None, 1), ("d", 2): (None, 1)}
    assert got == want | {("c", 9): ("A", 1), ("c", 10): ("C", 1), ("c", 11): (None, 1), ("c", 12): (None, 1)}
    high = {(r.chrom, r.pos): r.total for r in pileup.pileup_counts(reads, ref, min_q=20).collect()}
    assert high["c", 3] == high["c", 4] == 1


def test_no_row_stands_for_a_base(aligned):
    """Tasks count the bases of whole batches; nothing is exploded."""
    counted = pileup.pileup_counts(aligned((10, "5M", "ACGTA", None)))
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Generate" not in plan


def test_counts_of_odd_alignments(spark):
    """Bases or qualities shorter than the CIGAR, other alphabets, missing positions, names and CIGARs, far positions."""
    rows = [
        ("c", 1, "4M", "AC", "IIII"), ("c", 1, "4M", "ACGT", "I!"), ("c", 1, "2M", "Ä\u4e00", "Iß"), ("c", None, "2M", "AC", "II"),
        (None, 5, "1M", "T", "I"), ("c", 7, None, "T", "I"), ("d", 2_000_000_000, "2S1M2I1M", "NNGAAC", "!!IIII"), ("d", 1, "1M", "g", "I"),
        ("e", 3, "2M2D1M", "AC", "III"),
    ]
    reads = spark.createDataFrame(rows, "chrom string, pos int, cigar string, bases string, qual string").coalesce(1)
    got = {(r.chrom, r.pos): tuple(r)[2:] for r in pileup.pileup_counts(reads, min_q=20).collect()}
    assert got == {
        ("c", 1): (3, 2, 0, 0, 0, 1), ("c", 2): (2, 0, 0, 1, 0, 1), ("c", 3): (1, 0, 0, 0, 0, 0), ("c", 4): (1, 0, 0, 0, 0, 0),
        ("c", None): (2, 1, 0, 1, 0, 0), (None, 5): (1, 0, 1, 0, 0, 0), ("d", 1): (1, 0, 0, 0, 0, 1),
        ("d", 2_000_000_000): (1, 0, 0, 0, 1, 0), ("d", 2_000_000_001): (1, 0, 0, 1, 0, 0),
        ("e", 3): (1, 1, 0, 0, 0, 0), ("e", 4): (1, 0, 0, 1, 0, 0), ("e", 7): (1, 0, 0, 0, 0, 1),
    }
