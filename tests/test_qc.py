import math
import random
from collections import Counter

import pytest

from readloom.operators import qc


@pytest.fixture
def hist_of(spark):
    return lambda rows: spark.createDataFrame(rows, "cycle int, q int, n long")


def test_quantile_example(hist_of):
    row = qc.cycle_quantiles(hist_of([(1, 32, 4), (1, 27, 1)])).head()
    assert (row.p10, row.p25, row.p50, row.p75, row.p90, row.avg_q) == (32, 32, 32, 32, 27, 31.0)


def test_quantiles_of_zero_quality(hist_of):
    row = qc.cycle_quantiles(hist_of([(1, 0, 9), (1, 2, 1)])).head()
    assert (row.p10, row.p25, row.p90) == (2, 0, 0)


@pytest.mark.parametrize(
    ("cycles", "tail"),
    [(9, [(9, 9)]), (12, [(9, 9), (12, 12)]), (14, [(9, 9), (10, 14)]), (16, [(9, 9), (10, 14), (16, 16)])],
)
def test_boxplot_groups(hist_of, cycles, tail):
    hist = hist_of([(c, 20 + c, 1) for c in range(1, cycles + 1)])
    rows = qc.qc_boxplot(qc.cycle_quantiles(hist)).orderBy("last_cycle").collect()
    assert [(r.first_cycle, r.last_cycle) for r in rows] == [(c, c) for c in range(1, 9)] + tail
    values = {(r.first_cycle, r.last_cycle): (r.p10, r.avg_q) for r in rows}
    assert values[(3, 3)] == (23.0, 23.0)
    if cycles >= 14:
        assert values[(10, 14)] == (32.0, 32.0)
    if cycles == 16:
        assert values[(16, 16)] == (36.0, 36.0)


def test_maps(hist_of):
    rows = qc.quality_maps(hist_of([(1, 30, 5), (1, 2, 7), (2, 30, 1)])).collect()
    assert {r.cycle: r.counts for r in rows} == {1: {30: 5, 2: 7}, 2: {30: 1}}


def test_two_averages(hist_of):
    row = qc.avg_quality(hist_of([(1, 30, 1), (1, 31, 1), (2, 31, 1), (2, 32, 1), (3, 20, 2)])).head()
    assert row.avg_quality == pytest.approx((61 + 63 + 40) / 6)
    assert row.avg_quality_trunc == (30 + 31 + 20) // 3


@pytest.mark.parametrize(
    ("quals", "offset"),
    [(["55T", "IIhI"], 64), (["5555", "TTTT"], 0), (["TT4T", "hhhh"], 33), (["AAAh4"], 64)],
)
def test_phred_offset(spark, quals, offset):
    reads = spark.createDataFrame([(i, q) for i, q in enumerate(quals)], "record_no long, qual string")
    assert qc.phred_offset(reads, "record_no").head().offset == offset


def test_phred_offset_sample(spark):
    reads = spark.createDataFrame([(i, "hh" if i == 25 else "AA") for i in range(30)], "record_no long, qual string")
    assert qc.phred_offset(reads, "record_no", sample=20).head().offset == 0
    assert qc.phred_offset(reads, "record_no").head().offset == 64


def test_statistics_do_not_depend_on_partitions(spark):
    rng = random.Random(3)
    rows = []
    for i in range(200):
        size = rng.randint(1, 20)
        rows.append(("@r", "".join(rng.choices("ACGTNacgt", k=size)), "".join(rng.choices("!5@IJ", k=size))))
    want = Counter((c + 1, ord(ch) - 33) for _, _, q in rows for c, ch in enumerate(q))
    df = spark.createDataFrame(rows, "header string, bases string, qual string")
    for parts in (1, 7):
        got = qc.cycle_quality_hist(df.repartition(parts)).collect()
        assert {(r.cycle, r.q): r.n for r in got} == want
        row = qc.qc_summary(df.repartition(parts)).head()
        bases = "".join(b for _, b, _ in rows)
        gc = bases.count("G") + bases.count("C")
        assert (row.reads, row.bases, row.gc_bases) == (200, len(bases), gc)
        assert (row.min_len, row.max_len) == (min(len(b) for _, b, _ in rows), max(len(b) for _, b, _ in rows))
        assert math.isclose(row.gc_pct, 100 * gc / len(bases), abs_tol=0.006)


def test_report_text(reads_of):
    reads = reads_of([("@a/1", "GATTACAGAT", "IIIIIIIII5"), ("@b/1", "GAT", "II5")])
    hist = qc.cycle_quality_hist(reads)
    boxplot = qc.qc_boxplot(qc.cycle_quantiles(hist))
    lines = qc.qc_report_lines("/data/run/x.fastq", qc.qc_summary(reads), qc.avg_quality(hist), boxplot)
    got = [r.line for r in lines.orderBy("line_no").collect()]
    assert got[:8] == [
        "Measure value ",
        "Filename:x.fastq ",
        "Total reads:2 ",
        "Total Sequences:13 ",
        "Sequence length:3-10  ",
        "Average quality:37.00 ",
        "%GC:30.77 ",
        "----------For Box plot----------",
    ]
    assert got[8] == "1\t40.00 40.00 40.00 40.00 40.00 40.00"
    assert got[10] == "3\t40.00 40.00 40.00 20.00 20.00 30.00"
    assert got[17] == "10\t20.00 20.00 20.00 20.00 20.00 20.00"
    assert len(got) == 18
