"""N-gram Jaccard join on a token-group matrix: components of documents whose shingle sets are alike.

Sets. A document's tokens are the hashes of its distinct word shingles. Equal sets are one unit, however many documents
have them.

Order. Tokens are ordered by how frequent they are, rarest first, as a table of ``1 << BITS`` counters over all tokens of
all documents tells; any order is right, this one keeps frequent tokens out of the prefixes. Two linked sets share a
token of their prefixes: the larger set asks with the n - ceil(17 n / 20) + 1 first tokens, the smaller one is found by
its n - ceil(34 n / 37) + 1 first ones.

Counts. The prefixes of linked sets share more tokens the more alike their sizes are: of n and m tokens, n the larger, what
the prefixes leave out of a set holds at most ceil(17 n / 20) - 1 common ones, and the rest of ceil(17 (n + m) / 37) stands in both
prefixes. A unit that shares fewer tokens with all others together than any set of its rows asks for is linked with none.

Groups. Units that share a prefix token and have a like size meet the one in which it comes first, their leader; a unit
goes to the leader that it shares most tokens with. So the groups are a partition of similar units, cut into chunks of about
``GROUP``. A chunk is opened once by itself, with the leader as a guest, and yields a spanning forest of its links.

Matrix. The rows (token, group) of the prefixes tell which groups a unit of another component may have a partner in, by
size and by the place of the token in both orders. An asked group holds its members' tokens sorted, its token union: if
fewer than 17/20 of the query's tokens are in the union, no member can be linked and the group stays closed. In an
open one the overlap with every member is exact. Units of one component never ask each other, so a cluster of a third
of all documents costs one row for each token, and no pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import connected_components, documents, if_few, joined_apart, stored

WORDS, SEED = 4, 42
# Linked: 100 * both >= 85 * union, that is 37 * both >= 17 * (a + b); then 20 * smaller >= 17 * larger as well.
BITS, SLICE = 20, 1 << 12
GROUP, TOKENS = 64, 1 << 21
# So many rows before and after a row are looked at for a set that it can be linked with; rows of more sets stay.
NEAR = 64
# A token above LIMIT, and above HOT times the mean counter, is dealt to several tasks.
LIMIT, HOT = 2048, 8


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """The sorted distinct hashes of the word shingles; of all words, if there are fewer."""
    parts = text.lower().split()
    grams = map(b" ".join, zip(*(parts[i:] for i in range(words)))) if len(parts) >= words else iter([b" ".join(parts)] if parts else [])
    n = max(len(parts) - words + 1, min(1, len(parts)))
    return np.unique(np.fromiter(map(xxhash.xxh3_64_intdigest, grams, repeat(SEED)), np.uint64, n))


def name(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed numbers."""
    both = xxhash.xxh3_128_digest(tokens.tobytes(), SEED)
    return int.from_bytes(both[:8], "big", signed=True), int.from_bytes(both[8:], "big", signed=True)


def counters(tokens: np.ndarray) -> np.ndarray:
    return (tokens & np.uint64((1 << BITS) - 1)).astype(np.int64)


def asking(n):
    """How many first tokens a set of ``n`` asks with."""
    return n + 1 - -(-17 * n // 20)


def found_by(n):
    """How many first tokens a set of ``n`` is found by, by sets no smaller."""
    return n + 1 - -(-34 * n // 37)


def in_common(n, m):
    """How many tokens the first ``asking`` ones of two linked sets share at least; ``n`` is the larger size."""
    return -(-17 * (n + m) // 37) - (n - asking(n))


def _bytes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("tag"), text.alias("text"))


def described(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id, tag, n, u, v`` of each text, and the counters of each task as ``slice, counts``."""
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "tag", "n", "u", "v")] + [("slice", pa.int32()), ("counts", pa.binary())])

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << BITS, np.uint32)
        for part in parts:
            for at in range(0, part.num_rows, 1024):
                rows = []
                for doc_id, tag, text in zip(*(part.column(c).slice(at, 1024) for c in range(3))):
                    tokens = shingles(text.as_py(), words)
                    np.add.at(counts, counters(tokens), 1)
                    rows.append((doc_id.as_py(), tag.as_py(), len(tokens), *name(tokens), None, None))
                yield batch(rows)
        for k, some in enumerate(counts.reshape(-1, SLICE)):
            if some.any():
                yield batch([(None, None, None, None, None, k, some.tobytes())])

    return docs.mapInArrow(run, "doc_id long, tag long, n long, u long, v long, slice int, counts binary")


def frequencies(slices: DataFrame) -> np.ndarray:
    """The level of each counter, a quarter of a power of two; the sums over all tasks, added up in tasks."""
    schema = pa.schema([("slice", pa.int32()), ("levels", pa.binary())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for part in parts:
            for k, some in zip(part["slice"].to_pylist(), part["counts"]):
                total = sums.setdefault(k, np.zeros(SLICE, np.int64))
                total += np.frombuffer(some.as_py(), np.uint32)
        for k, total in sums.items():
            levels = np.round(4 * np.log2(total + 1.0)).astype(np.uint8)
            yield pa.record_batch([pa.array([k], pa.int32()), pa.array([levels.tobytes()])], schema=schema)

    out = np.zeros((1 << BITS) // SLICE * SLICE, np.uint8).reshape(-1, SLICE)
    for row in slices.select("slice", "counts").repartition("slice").mapInArrow(run, "slice int, levels binary").collect():
        out[row.slice] = np.frombuffer(row.levels, np.uint8)
    return out.ravel()


def prefixes(docs: DataFrame, levels: np.ndarray, salts: np.ndarray, words: int) -> DataFrame:
    """``token, salt, salts, u, n, pos``: the tokens that each set asks with, by their place in the order."""
    fields = [("token", pa.int64()), ("salt", pa.int32()), ("salts", pa.int32()), ("u", pa.int64()), ("n", pa.int32()), ("pos", pa.int32())]
    schema = pa.schema(fields)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        held: list[tuple] = []
        for part in parts:
            for text in part["text"]:
                tokens = shingles(text.as_py(), words)
                n, unit = len(tokens), name(tokens)
                if not n or unit in seen:
                    continue
                seen.add(unit)
                level = levels[counters(tokens)]
                first = np.lexsort((tokens, level))[: asking(n)]
                deal = salts[level[first]]
                held.append((tokens[first].view(np.int64), unit[0] % deal, deal, *(np.full(len(first), x) for x in (unit[0], n)), np.arange(len(first))))
                if len(held) == 512:
                    yield pa.record_batch([pa.array(np.concatenate(c), f.type) for c, f in zip(zip(*held), schema)], schema=schema)
                    held = []
        if held:
            yield pa.record_batch([pa.array(np.concatenate(c), f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    return docs.mapInArrow(run, "token long, salt int, salts int, u long, n int, pos int")


def shared(rows: DataFrame) -> DataFrame:
    """The rows of tokens that sets of a like size share.

    A task reads its rows in order of token and size, and holds one of them back. A set has a partner of like size
    if the one before or after it is one. Rows of hot tokens stay, as their partners may be in other tasks.
    """
    names = ["token", "salt", "salts", "u", "n", "pos"]
    kinds = dict(zip(names, [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32()]))
    schema = pa.schema(list(kinds.items()))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, alive = None, False
        for part in parts:
            x = {c: part[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in names}
            if held is not None:
                x = {c: np.concatenate([held[c], x[c]]) for c in names}
            same = (np.diff(x["token"]) == 0) & (np.diff(x["salt"]) == 0)
            # Copies of a set in several tasks come as equal rows.
            fresh = np.concatenate([[True], ~(same & (np.diff(x["u"]) == 0))])
            if not fresh.all():
                x = {c: v[fresh] for c, v in x.items()}
                same = (np.diff(x["token"]) == 0) & (np.diff(x["salt"]) == 0)
            if not len(x["n"]):
                continue
            near = same & (20 * x["n"][:-1] >= 17 * x["n"][1:])
            live = np.concatenate([[alive], near]) | (x["salts"] > 1)
            live[:-1] |= near
            yield pa.record_batch([pa.array(x[c][:-1][live[:-1]], kinds[c]) for c in names], schema=schema)
            held, alive = {c: v[-1:] for c, v in x.items()}, live[-1]
        if held is not None and alive:
            yield pa.record_batch([pa.array(held[c], kinds[c]) for c in names], schema=schema)

    placed = rows.repartition("token", "salt").sortWithinPartitions("token", "salt", "n", "u")
    return placed.mapInArrow(run, "token long, salt int, salts int, u long, n int, pos int")


def linkable(rows: DataFrame) -> DataFrame:
    """The rows of ``shared`` whose token is shared with a set that both sets' numbers of rows let the row's be linked with.

    Linked sets have at least ``in_common`` rows of the same tokens, all of which stay. Rows of tokens that more than
    ``NEAR`` sets share stay too, as do those of hot tokens. A task holds the rows of one token.
    """
    names = ["token", "salt", "salts", "u", "n", "pos"]
    schema = pa.schema(list(zip(names, [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32()])))

    def live(x: dict[str, np.ndarray]) -> pa.RecordBatch:
        starts = np.concatenate([[True], (np.diff(x["token"]) != 0) | (np.diff(x["salt"]) != 0)])
        of = np.cumsum(starts) - 1
        live = (np.bincount(of)[of] > NEAR) | (x["salts"] > 1)
        for k in range(1, NEAR):
            same = np.flatnonzero(of[k:] == of[:-k])
            if not len(same):
                break
            small, large = same, same + k
            n, m = x["n"][large], x["n"][small]
            ok = (20 * m >= 17 * n) & (in_common(n, m) <= np.minimum(x["left"][large], x["left"][small]))
            live[small[ok]] = live[large[ok]] = True
        return pa.record_batch([pa.array(x[f.name][live], f.type) for f in schema], schema=schema)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, np.ndarray]] = []
        for part in parts:
            x = {c: part[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in [*names, "left"]}
            if not len(x["n"]):
                continue
            begun = np.flatnonzero((np.diff(x["token"]) != 0) | (np.diff(x["salt"]) != 0)) + 1
            if held and (held[-1]["token"][-1], held[-1]["salt"][-1]) != (x["token"][0], x["salt"][0]):
                begun = np.concatenate([[0], begun])
            if len(begun):
                # All tokens but the last one of the batch are whole.
                done = [*held, {c: v[: begun[-1]] for c, v in x.items()}]
                yield live({c: np.concatenate([h[c] for h in done]) for c in x})
                held, x = [], {c: v[begun[-1] :] for c, v in x.items()}
            held.append(x)
        if held:
            yield live({c: np.concatenate([h[c] for h in held]) for c in held[0]})

    left = stored(rows.groupBy("u").agg(F.count("*").alias("left")), "left")
    placed = rows.join(if_few(left), "u").select(*names, "left").repartition("token", "salt").sortWithinPartitions("token", "salt", "n", "u")
    return placed.mapInArrow(run, "token long, salt int, salts int, u long, n int, pos int")


def sets_of(docs: DataFrame, units: DataFrame, words: int) -> DataFrame:
    """``id, tokens`` of stored ``units``, from one text of each; a unit whose text stands in repeated rows comes repeatedly."""
    schema = pa.schema([("id", pa.int64()), ("tokens", pa.list_(pa.int64()))])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for at in range(0, part.num_rows, 256):
                some = part.slice(at, 256)
                found = [(i, shingles(t.as_py(), words)) for i, t in zip(some["id"].to_pylist(), some["text"])]
                right = [(i, s.view(np.int64)) for (i, s), *uv in zip(found, some["u"].to_pylist(), some["v"].to_pylist()) if name(s) == tuple(uv)]
                if right:
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*right), schema)], schema=schema)

    one = units.select("id", "u", "v", F.col("rep").alias("of"), F.col("tag").alias("of_tag"))
    rows = docs.join(if_few(one), docs.doc_id.eqNullSafe(one["of"]) & (docs.tag == one["of_tag"])).select("id", "u", "v", "text")
    return rows.mapInArrow(run, "id long, tokens array<long>")


class Group:
    """Members of a group and the matrix of their tokens."""

    def __init__(self, members: list[tuple[int, int, np.ndarray]]):
        self.ids, self.comps = (np.array([m[k] for m in members], np.int64) for k in (0, 1))
        self.sizes = np.array([len(m[2]) for m in members], np.int64)
        tokens = np.concatenate([m[2] for m in members])
        order = np.argsort(tokens, kind="stable")
        self.tokens, self.of = tokens[order], np.repeat(np.arange(len(members)), self.sizes)[order]

    def linked(self, query: np.ndarray) -> np.ndarray:
        """The numbers of the members that are linked with a query's tokens."""
        a, b = np.searchsorted(self.tokens, query), np.searchsorted(self.tokens, query, "right")
        hit = b > a
        # The union bound: too few of the query's tokens stand in any member.
        if 20 * np.count_nonzero(hit) < 17 * len(query):
            return np.empty(0, np.int64)
        a, wide = a[hit], (b - a)[hit]
        at = np.repeat(a - np.concatenate([[0], np.cumsum(wide)[:-1]]), wide) + np.arange(wide.sum())
        both = np.bincount(self.of[at], minlength=len(self.ids))
        return np.flatnonzero(37 * both >= 17 * (len(query) + self.sizes))

    def forest(self, members: list[tuple[int, int, np.ndarray]]) -> Iterator[tuple[int, int]]:
        """Links among the members that join them, one less than there are in a component."""
        top = list(range(len(members)))

        def root(k: int) -> int:
            while top[k] != k:
                top[k] = top[top[k]]
                k = top[k]
            return k

        for k, (_, _, tokens) in enumerate(members):
            for other in self.linked(tokens).tolist():
                if (a := root(k)) != (b := root(other)):
                    top[a] = b
                    yield int(self.ids[k]), int(self.ids[other])


def opened(rows: DataFrame, own: bool) -> DataFrame:
    """Links ``a, b`` of rows ``g, c, query, id, comp, tokens``: of the members of a group among themselves, or of its queries with them."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, members, group, out, last = None, [], None, [], None
        for part in parts:
            lists = part["tokens"]
            offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy()
            for k, (g, c, query, i, comp) in enumerate(zip(*(part[x].to_pylist() for x in ("g", "c", "query", "id", "comp")))):
                if (g, c, query, i) == last:
                    continue
                last = (g, c, query, i)
                # A copy, so that what is held does not keep its batch.
                tokens = values[offsets[k] : offsets[k + 1]].copy()
                if (g, c) != key:
                    if own and len(members) > 1:
                        out += Group(members).forest(members)
                    key, members, group = (g, c), [], None
                if not query:
                    members.append((i, comp, tokens))
                elif members:
                    group = group or Group(members)
                    hit = group.linked(tokens)
                    other, first = np.unique(group.comps[hit], return_index=True)
                    out += [(i, int(group.ids[hit[f]])) for o, f in zip(other, first) if o != comp]
            if len(out) > 4096:
                yield pa.record_batch([pa.array(x, pa.int64()) for x in zip(*out)], schema=schema)
                out = []
        if own and len(members) > 1:
            out += Group(members).forest(members)
        if out:
            yield pa.record_batch([pa.array(x, pa.int64()) for x in zip(*out)], schema=schema)

    placed = rows.select("g", "c", "query", "id", "comp", "tokens").repartition("g", "c").sortWithinPartitions("g", "c", "query", "id")
    return placed.mapInArrow(run, "a long, b long")


def in_groups(units: DataFrame, matrix: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``id, u, n, g, c``: the group and chunk of each unit, and the guests ``id, g, c``, leaders in the chunks of their groups."""
    # Of the sets of a token and size, the leader has fewest tokens of its own before the shared one: it differs least
    # from what they have in common, so that a cluster has most links to it.
    size = F.floor(F.log("n") / math.log(20 / 17)).alias("size")
    first = F.shiftleft(F.col("pos").cast("long"), 32) + F.pmod("u", F.lit(1 << 32))
    leaders = matrix.select("token", size, "u", "salts", first.alias("first")).groupBy("token", "size")
    leaders = leaders.agg(F.min_by("u", "first").alias("leader"), F.max("salts").alias("salts"))
    leaders = leaders.select("token", "size", "leader", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    met = matrix.select("token", size, "salt", "u").join(leaders, ["token", "size", "salt"])
    met = met.where("leader != u").groupBy("u", "leader").agg(F.count("*").alias("times"))
    best = met.groupBy("u").agg(F.max_by("leader", F.col("times")).alias("leader"))
    leaders = units.select(F.col("u").alias("leader"), F.col("id").alias("to"))
    home = best.join(leaders, "leader").groupBy("u").agg(F.min("to").alias("to"))
    home = units.join(home, "u", "left").select("id", "u", "n", F.coalesce("to", "id").alias("g"))
    sizes = home.groupBy("g").agg(F.count("*").alias("members"), F.sum("n").alias("tokens"), F.min("id").alias("one"))
    chunks = F.ceil(F.greatest(F.col("members") / GROUP, F.col("tokens") / TOKENS)).cast("int")
    sizes = sizes.select("g", chunks.alias("chunks"), ((F.col("members") > 1) | (F.col("one") != F.col("g"))).alias("met"))
    home = home.join(sizes, "g").select("id", "u", "n", "g", F.pmod(F.xxhash64("id"), "chunks").cast("int").alias("c"))
    guests = sizes.where("met").select(F.col("g").alias("id"), "g", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("c"))
    return home, guests


def asked(rows: DataFrame) -> DataFrame:
    """``id, g, c``: the groups of other components that a unit has to ask, from matrix rows with ``id, comp, g, c``."""
    index = rows.where(F.col("pos") < F.expr("n + 1 - ceil(34 * cast(n AS long) / 37)"))
    most = lambda a, b: 20 * a >= 17 * b
    groups = index.groupBy("token", "comp").agg(
        F.min("n").alias("lo"), F.max("n").alias("hi"), F.max(F.col("n") - F.col("pos")).alias("far"), F.max("salts").alias("salts")
    )
    groups = groups.select("token", F.col("comp").alias("other"), "lo", "hi", "far", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    # The overlap is at most what is left from the first shared token on, in both orders.
    reach = 37 * F.least(F.col("n") - F.col("pos"), F.col("far")) >= 17 * (F.col("n") + F.greatest(F.col("lo"), 17 * F.col("n") / 20))
    other = rows.join(groups, ["token", "salt"]).where((F.col("comp") != F.col("other")) & (F.col("lo") <= F.col("n")) & most(F.col("hi"), F.col("n")) & reach)
    members = index.select("token", F.col("comp").alias("other"), F.col("n").alias("m"), F.col("pos").alias("at"), F.col("g").alias("to"), F.col("c").alias("part"))
    pairs = other.select("token", "other", "id", "n", "pos").join(members, ["token", "other"])
    reach = F.least(F.col("n") - F.col("pos"), F.col("m") - F.col("at"))
    pairs = pairs.where((F.col("m") <= F.col("n")) & most(F.col("m"), F.col("n")) & (37 * reach >= 17 * (F.col("n") + F.col("m"))))
    return pairs.select("id", F.col("to").alias("g"), F.col("part").alias("c")).distinct()


def deal(levels: np.ndarray, n_tokens: int, limit: int) -> np.ndarray:
    """How many tasks the rows of a token of each level are dealt to."""
    often = 2.0 ** (np.arange(256) / 4) / max(limit, HOT * n_tokens / len(levels))
    return np.clip(np.ceil(often), 1, 1 << 16).astype(np.int64)


def alike(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, limit: int = LIMIT
) -> DataFrame:
    """``doc_id, n_shingles, component_id``, one row for each row: the smallest id that links reach.

    Null and empty texts and those without a word have no shingles and are linked with nothing, not with each other
    either. Repeated rows and rows of equal id stay rows, and are linked by their texts. A null id counts for no smallest
    id, but its document links others; a component of null ids alone has a null. An empty table gives an empty result.
    """
    rows = _bytes(docs, id_col, text_col)
    each = stored(described(rows, words), "sets")
    own = each.where("slice is null")
    n_docs, n_tokens = own.agg(F.count("*"), F.sum("n")).first()
    levels = frequencies(each.where("slice is not null"))
    salts = deal(levels, n_tokens or 0, limit)
    units = own.where("n > 0").groupBy("u", "v").agg(
        F.max("n").alias("n"), F.count("*").alias("copies"), F.min("doc_id").alias("least"),
        F.min("tag").alias("tag"), F.min_by("doc_id", "tag").alias("rep"),
    )
    units = stored(units.withColumn("id", F.monotonically_increasing_id()), "units")
    matrix = stored(shared(prefixes(rows, levels, salts, words)), "shared")
    matrix = stored(linkable(matrix), "matrix")
    active = stored(units.join(matrix.select("u").distinct(), "u", "left_semi"), "active")
    tokens = stored(sets_of(rows, active, words), "tokens")
    home, guests = in_groups(active, matrix)
    home = stored(home, "home")
    met = home.join(guests.select("g").distinct(), "g", "left_semi").select("id", "g", "c").union(guests).distinct()
    nobody = [F.lit(False).alias("query"), F.lit(0).cast("long").alias("comp")]
    # Who goes where is written first: sets are shuffled once, to their groups, while these tables are few.
    met = stored(met.select("id", "g", "c", *nobody), "met")
    found = stored(opened(tokens.join(if_few(met), "id"), own=True), "links")
    comps = stored(connected_components(found), "components")
    placed = home.join(comps, home.id == comps.node, "left").select("id", "u", "g", "c", F.coalesce("root", "id").alias("comp"))
    wanted = stored(asked(stored(matrix.join(placed, "u"), "placed")), "asked")
    members = placed.join(wanted.select("g", "c").distinct(), ["g", "c"], "left_semi").select("id", "g", "c", "comp", F.lit(False).alias("query"))
    queries = wanted.join(placed.select("id", "comp"), "id").select("id", "g", "c", "comp", F.lit(True).alias("query"))
    needed = stored(members.union(queries), "needed")
    more = opened(tokens.join(if_few(needed), "id"), own=False)
    comps = stored(connected_components(stored(found.union(more), "links")), "components")
    return _named(own, units, comps, n_docs)


def _named(own: DataFrame, units: DataFrame, comps: DataFrame, n_docs: int) -> DataFrame:
    linked = units.join(comps, units.id == comps.node, "left").select("u", "v", "copies", "least", F.coalesce("root", "id").alias("root"))
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stored(linked.join(least, "root").select("u", "v", "copies", "component_id"), "named")
    found = joined_apart(own.where("n > 0"), named, ["u", "v"], n_docs).select("doc_id", "n", "component_id")
    alone = own.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return found.union(alone).withColumnRenamed("n", "n_shingles")


def op12_jaccard(spark, sf_dir: str) -> DataFrame:
    return alike(documents(spark, sf_dir))
