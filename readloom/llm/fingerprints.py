"""Document fingerprints: a Merkle tree over the sections and paragraphs of a text.

A paragraph is a line. Its leaves are its phrases, runs of words that end with one whose hash is 0 modulo ``PHRASE``;
a section is a run of paragraphs that ends with one whose hash is 0 modulo ``SECTION``. So an edit moves no later border
of either. A section's hash is that of its paragraphs' hashes, and the root's that of the sections' hashes. Equal roots
mean equal texts. Differing sections, then differing paragraphs below them, locate an edit.

A fingerprint is one string: ``root:phrases``, the root as SHA-256 and eight digits for each phrase,
sections divided by ``/`` and paragraphs by ``,``. The likeness of two fingerprints walks down both trees: 1 for equal
roots; else sections that both have count whole, the others are opened, paragraphs that both have count whole, and
only the phrases of the others are compared. Each branch is matched as often as both have it, so the result is the share
of phrases, with repeats, that the two have in common. Texts without a word are like nothing but their equals.

Everything is a Spark expression on one row. To find each document's neighbour, ids alone are range
partitioned; the largest id of each range is its bound, and the first document of a range is copied to
the range before it. One shuffle then brings every text beside the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from readloom.llm.common import documents, texts

PHRASE, SECTION = 6, 8
RANGES = 4
NO_ID = -(1 << 63)


def tree(text: Column) -> Column:
    """``root string, sections array<string>, phrases string`` of a text.

    A section holds its paragraphs' hashes divided by commas, ``phrases`` the digits of all phrases.
    """
    word, border = F.lit(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"), "\x00"
    digits = lambda c: F.substring(F.lpad(F.lower(F.hex(F.xxhash64(c))), 16, "0"), 9, 8)

    def paragraph(line: Column) -> Column:
        # The line itself is hashed, for its blanks before the first word.
        ends = lambda w: F.when(F.xxhash64(w) % PHRASE == 0, F.concat(w, F.lit(border))).otherwise(w)
        marked = F.array_join(F.transform(F.regexp_extract_all(line, word, F.lit(0)), ends), "")
        phrases = F.filter(F.split(marked, border), lambda p: p != "")
        return F.struct(F.sha2(line.cast("binary"), 256).alias("hash"), F.array_join(F.transform(phrases, digits), "").alias("phrases"))

    def whole(paragraphs: Column) -> Column:
        mark = lambda p: F.when(F.conv(F.substring(p["hash"], 1, 4), 16, 10).cast("int") % SECTION == 0, "/").otherwise(",")
        line = lambda part: F.array_join(F.transform(paragraphs, lambda p: F.concat(p[part], mark(p))), "")
        return F.struct(F.rtrim(line("hash"), F.lit("/,")).alias("hashes"), line("phrases").alias("phrases"))

    def rooted(lines: Column) -> Column:
        sections = F.split(lines["hashes"], "/")
        root = F.sha2(F.array_join(F.transform(sections, section_hash), "").cast("binary"), 256)
        return F.struct(root.alias("root"), sections.alias("sections"), lines["phrases"].alias("phrases"))

    return _named(_named(F.transform(F.split(text, "\n", -1), paragraph), whole), rooted)


def _named(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value as the one element of an array, so that it is computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def section_hash(section: Column) -> Column:
    return F.sha2(section.cast("binary"), 256)


def fingerprint(text: Column) -> Column:
    """The tree of a text as a string."""
    return _named(tree(text), lambda t: F.concat(t["root"], F.lit(":"), t["phrases"]))


def _copies(parts: Column, mark: str) -> Column:
    """``part:k`` for the k-th copy of each part; ``mark`` is in none of them."""
    # Sorted copies are one run of the joined text, so each part is looked at once.
    runs = F.regexp_extract_all(F.array_join(F.array_append(F.array_sort(parts), ""), mark), F.lit(rf"([^{mark}]*+{mark})\1*+"), F.lit(0))

    def numbered(run: Column) -> Column:
        part = F.substring_index(run, mark, 1)
        times = (F.length(run) / (F.length(part) + 1)).cast("int")
        return F.transform(F.sequence(F.lit(1), times), lambda k: F.concat(part, F.lit(":"), k.cast("string")))

    return F.flatten(F.transform(runs, numbered))


def likeness(a: Column, b: Column) -> Column:
    """From 0 to 1 for two fingerprint strings."""
    bare = lambda c: F.substring_index(c, ":", 1)
    n_digits = lambda c: F.length(F.translate(c, ",/", ""))

    def level(cut: Callable[[Column], Column], mark: str) -> Callable[[Column], Column]:
        """Counts what both sides have and leaves the rest, to be opened."""

        def matched(p: Column) -> Column:
            both = F.array_intersect(p["a"], p["b"])
            return F.struct(p["a"].alias("a"), p["b"].alias("b"), p["common"].alias("common"), both.alias("both"))

        def rest(p: Column) -> Column:
            left = lambda side: F.array_join(F.transform(F.array_except(p[side], p["both"]), bare), ",").alias(side)
            shared = F.aggregate(p["both"], F.lit(0), lambda total, part: total + n_digits(bare(part)))
            return F.struct(left("a"), left("b"), (p["common"] + shared).alias("common"))

        def step(p: Column) -> Column:
            sides = (_copies(cut(p[side]), mark).alias(side) for side in ("a", "b"))
            return _named(_named(F.struct(*sides, p["common"].alias("common")), matched), rest)

        return step

    phrases = lambda c: F.substring_index(c, ":", -1)
    state = F.struct(phrases(a).alias("a"), phrases(b).alias("b"), F.lit(0).alias("common"))
    state = _named(state, level(lambda c: F.split(c, "/"), "/"))
    state = _named(state, level(lambda c: F.split(c, ","), ","))
    state = _named(state, level(lambda c: F.regexp_extract_all(c, F.lit("[0-9a-f]{8}"), F.lit(0)), ","))
    total = n_digits(phrases(a)) + n_digits(phrases(b))
    dice = F.when(total == 0, 0.0).otherwise(2.0 * state["common"] / total)
    return F.when(F.substring(a, 1, 64) == F.substring(b, 1, 64), 1.0).otherwise(dice)


def edited_paragraphs(a: Column, b: Column) -> Column:
    """Numbers from 0 of the paragraphs of tree ``b`` that are not in tree ``a``, below sections that differ."""
    known = F.flatten(F.transform(a["sections"], lambda s: F.split(s, ",")))

    def below(s: Column) -> Column:
        same = F.array_contains(a["sections"], s)
        return F.transform(F.split(s, ","), lambda h: ~same & ~F.array_contains(known, h))

    marks = F.flatten(F.transform(b["sections"], below))
    edits = F.filter(F.transform(marks, lambda m, i: F.when(m, i)), lambda i: i.isNotNull())
    return F.when(a["root"] == b["root"], F.array().cast("array<int>")).otherwise(edits)


def _bounds(rows: DataFrame) -> list[int]:
    """The largest id of each of some ranges of about equal size, ascending; as many as Spark's partitions."""
    spark = rows.sparkSession
    ranges = RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    parted = rows.select("key").repartitionByRange(ranges, "key").groupBy(F.spark_partition_id()).agg(F.max("key").alias("top"))
    return sorted(r.top for r in parted.collect())


def _place(key: Column, bounds: list[int]) -> tuple[Column, Column]:
    """Number of the first bound that is no smaller than ``key``, and that bound, by a search in two steps."""
    wide = max(1, round(len(bounds) ** 0.5))
    rows = [bounds[i : i + wide] for i in range(0, len(bounds), wide)]
    longs = lambda values: F.array(*(F.lit(v).cast("long") for v in values))
    outer = F.size(F.filter(longs([r[-1] for r in rows]), lambda b: b < key))
    inner = F.size(F.filter(F.get(F.array(*map(longs, rows)), outer), lambda b: b < key))
    return outer * wide + inner, F.get(F.get(F.array(*map(longs, rows)), outer), inner)


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, next_text``: the text that follows in descending order of id, the first after the last.

    Rows of equal id follow each other in descending order of text; null ids come last. The next of a single row is
    itself. The number of ranges, not of documents, comes to the driver.
    """
    rows = texts(docs, id_col, text_col).withColumn("key", F.coalesce("doc_id", F.lit(NO_ID).cast("long")))
    bounds = _bounds(rows)
    if not bounds:
        return rows.select("doc_id", "text", F.col("text").alias("next_text"))
    number, bound = _place(F.col("key"), bounds)
    # The head of a range, its largest id, is also a guest at the end of the range before it.
    own = F.struct(F.col("range"), F.lit(False).alias("guest"))
    guest = F.struct(F.pmod(F.col("range") + 1, F.lit(len(bounds))).alias("range"), F.lit(True).alias("guest"))
    placed = rows.select("*", number.alias("range"), bound.alias("bound"))
    placed = placed.select("doc_id", "key", "text", F.explode(F.when(F.col("key") == F.col("bound"), F.array(own, guest)).otherwise(F.array(own))).alias("to"))
    placed = placed.select("doc_id", "key", "text", "to.range", "to.guest")
    order = W.partitionBy("range").orderBy("guest", F.col("key").desc(), F.col("text").desc())
    return placed.withColumn("next_text", F.lead("text").over(order)).where("not guest").select("doc_id", "text", "next_text")


def op1_fingerprints(spark, sf_dir: str) -> DataFrame:
    rows = with_next(documents(spark, sf_dir)).withColumn("n_chars", F.char_length("text"))
    edited = F.concat(F.expr("left(text, n_chars - n_chars DIV 2)"), F.expr("left(next_text, n_chars DIV 2)"))
    rows = rows.select("doc_id", F.col("n_chars").cast("long").alias("n_chars"), "text", "next_text", edited.alias("edited"))
    prints = [fingerprint(F.col(c)).alias(p) for c, p in (("text", "fingerprint"), ("edited", "edited_fingerprint"), ("next_text", "next_fingerprint"))]
    rows = rows.select(F.inline(F.array(F.struct("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), *prints))))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
