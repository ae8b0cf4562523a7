import pytest

from readloom.operators import pairing
from readloom.sinks import write_paired_fastq


def names(df):
    return sorted((r.read_name, r.bases1, r.bases2) for r in df.collect())


ROWS = [
    ("@a/1", "A", "I"), ("@a/2", "C", "I"),  # a pair
    ("@b/1", "A", "I"), ("@b/1", "C", "I"),  # two first mates
    ("@c/1", "A", "I"), ("@c/2", "C", "I"), ("@c/2", "G", "I"),  # three reads
    ("@d/2", "T", "I"),  # a single read
]


def test_group_needs_one_of_each(reads_of):
    assert names(pairing.pair_mates(reads_of(ROWS))) == [("@a", "A", "C")]


def test_join_multiplies(reads_of):
    want = [("@a", "A", "C"), ("@c", "A", "C"), ("@c", "A", "G")]
    assert names(pairing.pair_mates(reads_of(ROWS), method="join")) == want


def test_methods_agree_on_unique_names(reads_of):
    first = reads_of([(f"@r{i} 1:N", "A" * i, "I" * i) for i in range(1, 40)])
    second = reads_of([(f"@r{i} 2:N", "C" * i, "I" * i) for i in range(20, 60)])
    grouped = names(pairing.pair_mates(first, second, "group", " "))
    assert grouped == names(pairing.pair_mates(first, second, "join")) and len(grouped) == 20


def test_unknown_method(reads_of):
    with pytest.raises(ValueError):
        pairing.pair_mates(reads_of(ROWS), method="guess")


@pytest.mark.parametrize(
    ("header", "sep", "name", "mate"),
    [
        ("@id/1", None, "@id", 1), ("@id_2", None, "@id", 2), ("@id 1:N:0:X", None, "@id", 1),
        ("@a_b/2", None, "@a", None), ("@a_b/2", "/", "@a_b", 2), ("@plain", None, "@plain", None),
    ],
)
def test_keys(reads_of, header, sep, name, mate):
    row = pairing.with_read_keys(reads_of([(header, "A", "I")]), sep).head()
    assert (row.read_name, row.mate) == (name, mate)


def test_interleave(reads_of):
    row = pairing.interleave(pairing.pair_mates(reads_of(ROWS[1::-1]))).head()
    assert row.value == "@a/1\nA\n+\nI\n@a/2\nC\n+\nI"


def test_compare_counts_copies(reads_of):
    first = reads_of([("@a", "A", "I")] * 3 + [("@b", "A", "I"), ("@c", "A", "I")])
    second = reads_of([("@a", "A", "I"), ("@c", "A", "J"), ("@b", "A", "I"), ("@b", "A", "I")])
    row = pairing.fastq_compare(first, second).head()
    assert (row.reads_first, row.reads_second, row.reads_common) == (5, 4, 4)
    empty = pairing.fastq_compare(first.limit(0), second).head()
    assert (empty.reads_first, empty.reads_second, empty.reads_common) == (0, 4, 0)


def test_paired_files_line_up(spark, reads_of, tmp_path):
    rows = [(f"@r{i % 97}/{m}", "ACGT"[m] * (i % 7 + 1), "I" * (i % 7 + 1)) for i in range(300) for m in (1, 2)]
    pairs = pairing.pair_mates(reads_of(rows).repartition(5), method="join")
    out = [str(tmp_path / m) for m in "ab"]
    write_paired_fastq(pairs, *out)
    parts = [sorted(p.name[:10] for p in (tmp_path / m).glob("part-*")) for m in "ab"]
    assert parts[0] == parts[1]
    total = 0
    for name in parts[0]:
        both = [next((tmp_path / m).glob(name + "*")).read_text().split("\n") for m in "ab"]
        heads = [[line.split("/") for line in lines[:-1:4]] for lines in both]
        assert [h[0] for h in heads[0]] == [h[0] for h in heads[1]]
        assert {h[1] for h in heads[0]} <= {"1"} and {h[1] for h in heads[1]} <= {"2"}
        total += len(heads[0])
    assert total == pairs.count()
