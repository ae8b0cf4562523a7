"""BPE encoding and decoding with a public tokenizer file (byte-level symbols, word ends, merges by rank).

A word of at most ``SHORT`` symbols is a list of parts, whose boundaries lie between neighbours, beside a
contiguous list of the ranks of adjacent parts. The smallest rank is looked up by a scan, the boundary between
its parts is deleted, and the ranks to its left and right are read anew. Longer words, such as runs of signs, would
make the scans quadratic; they take the same merges from a heap over linked parts.

Words repeat, so each task keeps the ids of up to ``WORDS`` of them. Rows stay in their partition: there is no
shuffle, and a batch is as large as Arrow's byte limit allows.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import documents, texts

SHORT, WORDS, ROWS = 64, 1 << 16, 256
LATIN = 0x250
NEVER = 1 << 60
# Printable bytes stand for themselves, the others for code points from 256 on.
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


def byte_letters() -> dict[int, str]:
    other = iter(range(256, 512))
    return {b: chr(b if b in set(PRINTABLE) else next(other)) for b in range(256)}


class Bpe:
    """Encoder and decoder of one tokenizer file, given as its JSON text."""

    def __init__(self, spec: str):
        spec = json.loads(spec)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.ranks = {(self.vocab[a], self.vocab[b]): rank for rank, (a, b) in enumerate(pairs)}
        self.merged = [self.vocab[a + b] for a, b in pairs]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = token_strings(spec)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        kinds = {n["type"] for n in spec["normalizer"]["normalizers"]}
        self.nfc, self.lower = "NFC" in kinds, "Lowercase" in kinds
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        # White space as the tokenizer's pattern engine has it.
        blank = r"\t-\r \x85\xa0  -     　"
        self.pieces = regex.compile(split["pattern"]["Regex"].replace(r"\s", blank)).findall
        # The same pattern for Python's faster engine, for texts with Latin letters only.
        latin = lambda kind: "".join(map(re.escape, (c for c in map(chr, range(LATIN)) if unicodedata.category(c)[0] == kind)))
        plain = re.sub(r"\\p\{([LN])\}", lambda m: latin(m[1]), split["pattern"]["Regex"]).replace(r"\s", blank)
        self.latin_pieces, self.beyond_latin = re.compile(plain).findall, re.compile(f"[^\\x00-{chr(LATIN - 1)}]").search
        letters = byte_letters()
        self.inner = [self.vocab[letters[b]] for b in range(256)]
        self.last = [self.vocab[letters[b] + self.end] for b in range(256)]
        self.known: dict[str, bytes] = {}

    def merge_short(self, parts: list[int]) -> list[int]:
        """Ids of the parts of a word after all merges. A boundary lies between neighbours in ``parts``."""
        rank, merged = self.ranks.get, self.merged
        ranks = [rank(pair, NEVER) for pair in zip(parts, parts[1:])]
        while ranks and (least := min(ranks)) != NEVER:
            at = ranks.index(least)
            parts[at] = merged[least]
            del parts[at + 1], ranks[at]
            if at:
                ranks[at - 1] = rank((parts[at - 1], parts[at]), NEVER)
            if at < len(ranks):
                ranks[at] = rank((parts[at], parts[at + 1]), NEVER)
        return parts

    def merge_long(self, parts: list[int | None]) -> list[int]:
        """The same merges, smallest rank and leftmost first, from a heap."""
        left, right = list(range(-1, len(parts) - 1)), list(range(1, len(parts) + 1))
        heap = [(self.ranks[p], i, p) for i, p in enumerate(zip(parts, parts[1:])) if p in self.ranks]
        heapq.heapify(heap)
        while heap:
            rank, i, pair = heapq.heappop(heap)
            j = right[i]
            if parts[i] != pair[0] or j >= len(parts) or parts[j] != pair[1]:
                continue
            parts[i], parts[j] = self.merged[rank], None
            right[i] = right[j]
            if right[i] < len(parts):
                left[right[i]] = i
            for a, b in ((left[i], i), (i, right[i])):
                if a >= 0 and b < len(parts) and (new := (parts[a], parts[b])) in self.ranks:
                    heapq.heappush(heap, (self.ranks[new], a, new))
        return [p for p in parts if p is not None]

    def word_ids(self, piece: str) -> bytes:
        found = self.known.get(piece)
        if found is None:
            *front, last = piece.encode("utf-8")
            parts = [*map(self.inner.__getitem__, front), self.last[last]]
            merged = (self.merge_short if len(parts) <= SHORT else self.merge_long)(parts)
            found = array("I", merged).tobytes()
            if len(self.known) >= WORDS:
                self.known.clear()
            self.known[piece] = found
        return found

    def plain_ids(self, text: str) -> bytes:
        if self.nfc and not text.isascii():
            text = unicodedata.normalize("NFC", text)
        if self.lower:
            # Letter by letter: a sigma at the end of a word is no special case.
            text = text.replace("Σ", "σ").lower()
        pieces = self.pieces if self.beyond_latin(text) else self.latin_pieces
        return b"".join(map(self.word_ids, pieces(text)))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit integers; strings of special tokens become these."""
        parts = self.specials.split(text) if self.special else [text]
        return b"".join(
            np.array([self.special[p]], "<u4").tobytes() if k % 2 else self.plain_ids(p) for k, p in enumerate(parts)
        )

    def decode(self, ids: bytes) -> str:
        return joined(ids, self.tokens)


def token_strings(spec: dict) -> list[str | None]:
    """Token strings by id, special tokens included."""
    ids = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
    tokens: list[str | None] = [None] * (max(ids.values()) + 1)
    for token, i in ids.items():
        tokens[i] = token
    return tokens


def joined(ids: bytes, tokens: list[str | None]) -> str:
    """Token strings joined by blanks; ids that are no token have none."""
    numbers = np.frombuffer(ids, "<u4")
    known = numbers[numbers < len(tokens)].tolist()
    return " ".join(filter(None, map(tokens.__getitem__, known)))


def vocabulary(path: str) -> str:
    """The JSON of a tokenizer file on the driver; it travels to the tasks with the job."""
    return Path(path).read_text(encoding="utf-8")


def bpe_encode(docs: DataFrame, spec: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids``: the ids of each text as little-endian 32-bit integers.

    One row per row. Null and empty texts have no ids. Texts are encoded whole, of any length.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(spec)
        for part in parts:
            ids = [bpe.encode(t) for t in part["text"].to_pylist()]
            counts = pa.array([len(i) // 4 for i in ids], pa.int64())
            yield pa.record_batch([part["doc_id"], counts, pa.array(ids, pa.binary())], schema=schema)

    return texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def bpe_decode(encoded: DataFrame, spec: str) -> DataFrame:
    """``encoded`` with the column ``decoded``; null ids decode to the empty text."""
    fields = [f.name for f in encoded.schema]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = token_strings(json.loads(spec))
        for part in parts:
            decoded = pa.array([joined(i or b"", tokens) for i in part["ids"].to_pylist()], pa.string())
            yield pa.record_batch([*part.columns, decoded], names=[*fields, "decoded"])

    return encoded.mapInArrow(run, encoded.withColumn("decoded", F.lit("")).schema)


def bpe_round_trip(docs: DataFrame, spec: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids, decoded``: what ``bpe_encode`` and ``bpe_decode`` give, by one worker for each task.

    A worker holds ``ROWS`` texts at a time, with their ids and what these decode to, not a whole batch of each.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(spec)
        for part in parts:
            for at in range(0, part.num_rows, ROWS):
                some = part.slice(at, ROWS)
                ids = [bpe.encode(t.as_py()) for t in some["text"]]
                counts = pa.array([len(i) // 4 for i in ids], pa.int64())
                decoded = pa.array(map(bpe.decode, ids), pa.string())
                yield pa.record_batch([some["doc_id"], counts, pa.array(ids, pa.binary()), decoded], schema=schema)

    return texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded string")


def public_vocabulary() -> str:
    import public_tokenizers

    return vocabulary(public_tokenizers.path("word_bpe_49k.json"))


def op2_bpe(spark, sf_dir: str) -> DataFrame:
    both = bpe_round_trip(documents(spark, sf_dir), public_vocabulary())
    decoded = F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), decoded)
