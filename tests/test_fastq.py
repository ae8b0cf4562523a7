import gzip
import random

import pytest

from readloom.sources import number_records, read_fastq, read_fastq_ranges


def make(seed: int, n: int) -> list[tuple[str, str, str]]:
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        size = rng.randint(1, 12)
        qual = "".join(rng.choice("@@@+I!#") for _ in range(size))
        rows.append((f"@r{i}/1", "".join(rng.choice("ACGTN") for _ in range(size)), qual))
    return rows


def text(rows, end="\n", plus=lambda h: "+") -> str:
    return "".join(end.join((h, b, plus(h), q)) + end for h, b, q in rows)


def triples(df):
    return sorted((r.header, r.bases, r.qual) for r in df.collect())


@pytest.fixture
def splits(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(k) for k in keys]

    def use(size: int) -> None:
        spark.conf.set(keys[0], str(size))
        spark.conf.set(keys[1], "1")

    yield use
    for key, value in zip(keys, before):
        spark.conf.set(key, value)


@pytest.mark.parametrize("size", [3, 5, 11, 17, 40, 101, 1 << 20])
def test_same_reads_for_any_split(spark, splits, tmp_path, size):
    rows = make(size, 60)
    path = tmp_path / "a.fastq"
    path.write_text(text(rows))
    splits(size)
    assert triples(read_fastq(spark, str(path))) == sorted(rows)
    if size > 3:
        assert triples(read_fastq_ranges(spark, str(path), size)) == sorted(rows)


@pytest.mark.parametrize("seed", range(6))
def test_order_and_numbers(spark, splits, tmp_path, seed):
    rows = make(seed, 40)
    path = tmp_path / "a.fastq"
    path.write_text(text(rows))
    splits(29 + seed)
    got = number_records(read_fastq(spark, str(path))).orderBy("record_no").collect()
    assert [r.record_no for r in got] == list(range(40))
    assert [(r.header, r.bases, r.qual) for r in got] == rows
    ranged = read_fastq_ranges(spark, str(path), 53).orderBy("block", "seq").collect()
    assert [(r.header, r.bases, r.qual) for r in ranged] == rows


@pytest.mark.parametrize("reader", [read_fastq, read_fastq_ranges])
def test_line_ends_names_and_broken_tail(spark, tmp_path, reader):
    rows = [("@a 1:N", "ACGT", "@@II"), ("@b 1:N", "A", "@"), ("@c 1:N", "AC", "@I")]
    (tmp_path / "crlf.fastq").write_bytes(text(rows, "\r\n").encode())
    (tmp_path / "named.fastq").write_text(text(rows, plus=lambda h: "+" + h[1:]))
    (tmp_path / "open.fastq").write_text(text(rows)[:-1])
    (tmp_path / "blank.fastq").write_text(text(rows) + "\n\n")
    (tmp_path / "short.fastq").write_text(text(rows) + "@d\nACG\n+\n")
    with gzip.open(tmp_path / "packed.fastq.gz", "wt") as out:
        out.write(text(rows))
    for name in ("crlf.fastq", "named.fastq", "open.fastq", "blank.fastq", "short.fastq", "packed.fastq.gz"):
        assert triples(reader(spark, str(tmp_path / name))) == sorted(rows), name


def test_many_files(spark, tmp_path):
    rows = make(9, 30)
    for i in range(3):
        (tmp_path / f"{i}.fastq").write_text(text(rows[i * 10 : i * 10 + 10]))
    for reader in (read_fastq, read_fastq_ranges):
        assert triples(reader(spark, str(tmp_path))) == sorted(rows)
        two = [str(tmp_path / "0.fastq"), str(tmp_path / "2.fastq")]
        assert triples(reader(spark, two)) == sorted(rows[:10] + rows[20:])


def test_unequal_lengths_are_dropped_by_ranges(spark, tmp_path):
    path = tmp_path / "a.fastq"
    path.write_text("@a\nACGT\n+\nIII\n@b\nAC\n+\n@I\n")
    assert triples(read_fastq_ranges(spark, str(path))) == [("@b", "AC", "@I")]


def test_broken_records_do_not_depend_on_splits(spark, tmp_path):
    path = tmp_path / "a.fastq"
    whole = "".join(f"@r{i}\nACGTACGTAC\n+\nIIIIIIIIII\n" for i in range(40))
    path.write_text("@broken\nACGT\n+\n" + whole + "@IIIIIIIII\n" + whole)
    want = triples(read_fastq(spark, str(path)))
    for size in (64, 100, 333):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        try:
            assert triples(read_fastq(spark, str(path))) == want
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert all(len(b) == len(q) for _, b, q in want) and len(want) == 80


def test_compressed_files(spark, tmp_path):
    import bz2

    rows = make(4, 30)
    (tmp_path / "a.fastq.bz2").write_bytes(bz2.compress(text(rows).encode()))
    (tmp_path / "b.fastq.xz").write_bytes(b"x")
    assert triples(read_fastq_ranges(spark, str(tmp_path / "a.fastq.bz2"))) == sorted(rows)
    with pytest.raises(Exception, match="codec"):
        read_fastq_ranges(spark, str(tmp_path / "b.fastq.xz")).count()
