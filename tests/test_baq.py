import random

import numpy as np
import pytest

from readloom.operators import baq


def all_paths(read: str, quals: list[int], ref: str) -> tuple[float, dict[tuple[int, int], float]]:
    """Total probability and the share matched at each (base, column), one path at a time."""
    l, width = len(read), len(ref)
    a, b, r = 0.001, 0.1, 1 / (2 * l)
    total, matched = 0.0, {}

    def emit(i, k):
        p = 10 ** (-quals[i] / 10)
        return 1 - p if read[i] == ref[k] else p / 3

    def walk(state, i, k, p, seen):
        nonlocal total
        if i == l - 1 and state in "MI":
            total += p * r
            for cell in seen:
                matched[cell] = matched.get(cell, 0.0) + p * r
        go = {
            "M": {"M": (1 - 2 * a) * (1 - r), "I": a * (1 - r), "D": a * (1 - r)},
            "I": {"M": (1 - b) * (1 - r), "I": b * (1 - r)},
            "D": {"M": 1 - b, "D": b},
        }[state]
        for nxt, t in go.items():
            i2, k2 = i + (nxt != "D"), k + (nxt != "I")
            if i2 >= l or k2 >= width:
                continue
            e = {"M": lambda: emit(i2, k2), "I": lambda: 0.25, "D": lambda: 1.0}[nxt]()
            walk(nxt, i2, k2, p * t * e, [*seen, (i2, k2)] if nxt == "M" else seen)

    for k in range(width):
        walk("M", 0, k, (1 - a) / width * emit(0, k), [(0, k)])
        walk("I", 0, k, a / width * 0.25, [])
    return total, matched


def codes(texts):
    return np.array([list(t.encode()) for t in texts], np.uint8)


@pytest.mark.parametrize("seed", range(12))
def test_against_path_enumeration(seed):
    rng = random.Random(seed)
    l, width = rng.randint(1, 4), rng.randint(1, 4)
    reads = ["".join(rng.choices("ACGTN", k=l)) for _ in range(5)]
    refs = ["".join(rng.choices("ACGT", k=width)) for _ in range(5)]
    quals = [[rng.randint(2, 40) for _ in range(l)] for _ in range(5)]
    for k in range(width):
        columns = np.full((5, l), k)
        post, fwd, back = baq.posteriors(codes(reads), np.array(quals), codes(refs), columns)
        for n in range(5):
            total, matched = all_paths(reads[n], quals[n], refs[n])
            assert 10 ** fwd[n] == pytest.approx(total, rel=1e-9)
            assert 10 ** back[n] == pytest.approx(total, rel=1e-9)
            for i in range(l):
                assert post[n, i] == pytest.approx(matched.get((i, k), 0.0) / total, rel=1e-9, abs=1e-300)


def test_totals_agree_on_long_reads():
    rng = np.random.default_rng(0)
    refs = rng.choice(np.frombuffer(b"ACGT", np.uint8), (7, 310))
    reads = refs[:, 5:305].copy()
    reads[:, ::50] = ord("N")
    quals = rng.integers(2, 41, reads.shape)
    columns = np.broadcast_to(np.arange(5, 305), reads.shape)
    post, fwd, back = baq.posteriors(reads, quals, refs, columns)
    assert np.allclose(fwd, back, rtol=1e-9)
    assert (post <= 1 + 1e-9).all() and (post >= 0).all()
    assert (baq.cap_quality(post, quals) <= quals).all()


def cases(seed, n, l, width, errors=2, low=2):
    """Reads off references of a base in a row, a repeated word or any bases, with errors, and the columns they come from."""
    rng = np.random.default_rng(seed)
    letters = np.frombuffer(b"ACGT", np.uint8)
    words = [rng.choice(letters, size) for size in rng.choice([1, 3, 7, width], n)]
    refs = np.stack([np.resize(word, width) for word in words])
    columns = np.minimum(np.arange(l) + rng.integers(0, max(0, width - l) + 1, (n, 1)), width - 1)
    reads = np.take_along_axis(refs, columns, 1)
    for _ in range(errors):
        reads[np.arange(n), rng.integers(0, l, n)] = rng.choice(np.frombuffer(b"ACGTN", np.uint8), n)
    return reads, rng.integers(low, 41, reads.shape), refs, columns


@pytest.mark.parametrize("l, width", [(1, 1), (1, 30), (40, 40), (60, 67), (67, 60), (120, 130), (150, 150), (40, 90), (90, 40)])
def test_a_band_gives_the_whole_matrix(monkeypatch, l, width):
    monkeypatch.setattr(baq, "SHORT", 0)
    for seed in range(4):
        # Quality 0 has no chance of a match; it stands in half of the cases.
        rows = cases(seed, 9, l, width, low=2 * (seed % 2))
        want, total, _ = baq.posteriors(*rows)
        assert np.allclose(baq.match_posteriors(*rows), want, rtol=0, atol=1e-9)
        # A band of all diagonals is the matrix.
        post, fwd, back = baq.banded(*rows, max(l, width))
        assert np.allclose(post, want, rtol=1e-9, atol=1e-300)
        assert np.allclose(fwd, total, rtol=1e-9) and np.allclose(back, total, rtol=1e-9)


@pytest.mark.parametrize("l, width", [(50, 50), (50, 56), (56, 50)])
def test_what_a_band_leaves_out_is_below_the_bound(l, width):
    rows = cases(5, 20, l, width, errors=4)
    total = baq.posteriors(*rows)[1]
    for half in (1, 2, 4, 8, 16):
        banded = baq.banded(*rows, half, forward_only=True)[1]
        outside = 1 - 10 ** (banded - total)
        enough = baq.halves_needed(*rows[:3], banded) <= half
        assert (outside[enough] <= baq.OUTSIDE + 1e-10).all()
        assert (outside >= -1e-10).all()
    assert enough.any()


def test_long_reads_use_a_narrow_band(monkeypatch):
    rows = cases(3, 2, 10_000, 10_010, errors=3, low=30)
    widths = []
    whole = baq.banded
    monkeypatch.setattr(baq, "banded", lambda *a, **k: widths.append(a[4]) or whole(*a, **k))
    monkeypatch.setattr(baq, "posteriors", None)
    post = baq.match_posteriors(*rows)
    assert max(widths) <= 64 and ((post >= 0) & (post <= 1 + 1e-9)).all()


def test_certain_bases_keep_their_quality():
    assert baq.cap_quality(np.array([1.0, 1.5, 0.9]), np.array([30, 30, 30])).tolist() == [30, 30, pytest.approx(10)]


def test_columns_of_shapes():
    assert baq.base_columns("3M1I2M", 6, 5).tolist() == [0, 1, 2, -1, 3, 4]
    assert baq.base_columns("2M2D2M", 4, 6).tolist() == [0, 1, 4, 5]
    assert baq.base_columns("4M", 4, 3).tolist() == [0, 1, 2, -1]


def test_long_reads_in_a_table(spark):
    rng = random.Random(1)
    seq = "".join(rng.choices("ACGT", k=4000))
    ref = spark.createDataFrame([("chr1", seq)], "chrom string, seq string")
    long = seq[100:1600] + seq[1605:3000]
    rows = [
        ("chr1", 101, 60, "1500M5D1395M", long, "I" * len(long)),
        ("chr1", 11, 60, "200M2I100M", seq[10:210] + "GT" + seq[210:310], "5" * 302),
    ]
    reads = spark.createDataFrame(rows, "chrom string, pos int, mapq int, cigar string, bases string, qual string")
    scored = baq.baq_bases(reads, ref).collect()
    assert len(scored) == len(long) + 300
    assert all(r.ref == seq[r.pos - 1] == r.base and 0 <= r.baq <= r.q for r in scored)
    assert sum(r.baq == r.q for r in scored) > 2800


def test_bases_and_pileup(spark):
    seq = "ACGTTGCAAGCTTAGGCTAACCGT" * 3
    ref = spark.createDataFrame([("chr1", seq)], "chrom string, seq string")
    rows = [
        ("chr1", 5, 60, "20M", seq[4:24], "I" * 20),
        ("chr1", 5, 60, "2S18M", "NN" + seq[4:22], "I" * 20),
        ("chr1", 9, 60, "8M2I10M", seq[8:16] + "GT" + seq[16:26], "5" * 20),
        ("chr1", 9, 60, "8M3D9M3H", seq[8:16] + seq[19:28], "?" * 17),
    ]
    reads = spark.createDataFrame(rows, "chrom string, pos int, mapq int, cigar string, bases string, qual string")
    scored = baq.baq_bases(reads, ref).collect()
    assert len(scored) == 20 + 18 + 18 + 17
    for r in scored:
        assert r.ref == seq[r.pos - 1] == r.base
        assert r.baq <= r.q
    loci = {r.pos: r for r in baq.baq_pileup(reads, ref, min_baq=15).collect()}
    want: dict[int, int] = {}
    for r in scored:
        if r.baq >= 15:
            want[r.pos] = want.get(r.pos, 0) + 1
    assert {p: r.total for p, r in loci.items()} == want
    assert all(r.ref == seq[p - 1] for p, r in loci.items())


def test_short_reads_use_a_band(monkeypatch):
    """Clean reads of 64 bases need fewer diagonals than half of the matrix, and get what the matrix gives."""
    rows = cases(4, 40, 64, 64, errors=1, low=20)
    rows = (rows[0], rows[1], rows[2], np.broadcast_to(np.arange(64), rows[3].shape))
    want = baq.posteriors(*rows)[0]
    monkeypatch.setattr(baq, "posteriors", None)
    assert np.allclose(baq.match_posteriors(*rows), want, rtol=0, atol=2e-12)


@pytest.mark.parametrize("seed", range(8))
def test_the_path_of_an_alignment_is_a_lower_bound(seed):
    rng = random.Random(seed)
    cigar, l, width = rng.choice([("4M", 4, 4), ("2M1I1M", 4, 3), ("1M2D2M", 3, 5), ("1I2M", 3, 3), ("2M2I", 4, 2), ("1M1I1D1M", 3, 3)])
    read, ref = "".join(rng.choices("ACGTN", k=l)), "".join(rng.choices("ACGT", k=width))
    quals = [rng.randint(2, 40) for _ in range(l)]
    rows = (codes([read]), np.array([quals]), codes([ref]), baq.base_columns(cigar, l, width)[None])
    found = 10 ** baq.path_total(*rows)[0]
    total, matched = all_paths(read, quals, ref)
    assert 0 <= found <= total * (1 + 1e-12)
    if cigar == "4M":
        # The path that matches each base on the diagonal is no more than the least share of these.
        assert 0 < found <= min(matched[i, i] for i in range(l)) * (1 + 1e-12)


def test_alignments_are_derived_once(spark):
    """Short and long alignments read one exchange."""
    ref = spark.createDataFrame([("chr1", "ACGT" * 2000)], "chrom string, seq string")
    rows = [("chr1", 5, 60, "8M", "ACGTACGT", "I" * 8), ("chr1", 9, 60, "4M1500N4M", "ACGTACGT", "I" * 8)]
    reads = spark.createDataFrame(rows, "chrom string, pos int, mapq int, cigar string, bases string, qual string")
    for scored, n in ((baq.baq_bases(reads, ref), 16), (baq.baq_pileup(reads, ref, 0), 12)):
        assert len(scored.collect()) == n
        plan = scored._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        shuffles = [line for line in plan.splitlines() if "REBALANCE_PARTITIONS_BY_COL" in line]
        assert len(shuffles) == 3 and sum("ReusedExchange" in line for line in shuffles) == 2
