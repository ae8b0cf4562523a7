import pytest

from readloom.operators.trim import trim_reads

GOOD, LOW = "I", "#"


@pytest.mark.parametrize(
    ("qual", "strict", "kept"),
    [
        (GOOD * 29 + LOW + GOOD * 10, False, None),
        (GOOD * 30 + LOW + GOOD * 10, False, 30),
        (GOOD * 31 + LOW, False, 31),
        (GOOD * 30, False, None),
        (GOOD * 30, True, 30),
        (GOOD * 29, True, None),
        (GOOD * 31, False, 31),
        (LOW + GOOD * 60, False, None),
        ("", False, None),
        ("4" + GOOD * 40, False, None),
        ("5" * 40 + "4" * 20, False, 40),
    ],
)
def test_length_rules(reads_of, qual, strict, kept):
    bases = ("ACGT" * 40)[: len(qual)]
    rows = trim_reads(reads_of([("@r/1", bases, qual)]), strict_len=strict).collect()
    assert [r.kept_len for r in rows] == ([] if kept is None else [kept])
    for r in rows:
        assert (r.bases, r.qual) == (bases[:kept], qual[:kept])


def test_small_bounds(reads_of):
    rows = reads_of([("@a", "A", "I"), ("@b", "A", "#"), ("@c", "AC", "I#")])
    assert {r.header: r.kept_len for r in trim_reads(rows, min_len=0).collect()} == {"@a": 1, "@c": 1}
    assert {r.header: r.kept_len for r in trim_reads(rows, min_len=1).collect()} == {"@c": 1}


def test_offset_64(reads_of):
    rows = reads_of([("@a", "ACGTA", "hhhSh"), ("@b", "ACGTA", "TTTTS")])
    got = {r.header: r.bases for r in trim_reads(rows, offset=64, min_len=2).collect()}
    assert got == {"@a": "ACG", "@b": "ACGT"}
