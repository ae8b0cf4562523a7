"""Token counts of a unigram vocabulary without building the tokens.

An Aho-Corasick automaton over the vocabulary enumerates, in one pass over a text, all pieces that end at each
character. The dynamic program keeps for each end only the best score and the number of tokens on the path to it.
Where no piece covers one character, an unknown token of that character does, at ``UNKNOWN`` below the lowest
score of the vocabulary.

Ties are the tokenizer's: an end takes a path only if it scores more than what it has, and pieces are tried in
the order of their starts, so of equal paths the one with the longest last piece stays. Scores add up in the
same order as in the tokenizer. Neighbouring unknown tokens count as one where they are fused.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import documents, texts

# The penalty of an unknown character, the mark of a blank.
UNKNOWN, BLANK = 10.0, "▁"


class Counter:
    """Counts for one vocabulary of (piece, score); the piece numbered ``unk`` is no text."""

    def __init__(self, vocab: list[tuple[str, float]], unk: int, fuse: bool = True):
        self.fuse = fuse
        self.unknown = min(score for _, score in vocab) - UNKNOWN
        self.automaton = ahocorasick.Automaton()
        for i, (piece, score) in enumerate(vocab):
            if i != unk and piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        texts = [piece for i, (piece, _) in enumerate(vocab) if i != unk]
        self.letters, self.singles = set("".join(texts)), {p for p in texts if len(p) == 1}
        self.pairs = {p[i : i + 2] for p in texts for i in range(len(p) - 1)}
        # Sums of whole numbers do not depend on where they start, so a text may be counted in parts.
        self.parts = all(float(score).is_integer() for _, score in vocab)
        self.known: dict[str, int] = {}

    def cut(self, text: str) -> list[str]:
        """Parts of a text that no piece and no run of unknown characters joins."""
        at = [0]
        for i in range(1, len(text)):
            a, b = text[i - 1], text[i]
            if a in self.singles and (b not in self.letters or b in self.singles and a + b not in self.pairs):
                at.append(i)
            elif a not in self.letters and b in self.singles:
                at.append(i)
        return [text[i:j] for i, j in zip(at, [*at[1:], len(text)])]

    def __call__(self, text: str) -> int:
        """Tokens of a text, from the counts of its parts where these repeat."""
        if not self.parts:
            return self.count(text)
        total = 0
        for part in self.cut(text) if text else []:
            n = self.known.get(part)
            if n is None:
                if len(self.known) >= 1 << 17:
                    self.known.clear()
                n = self.known[part] = self.count(part)
            total += n
        return total

    def count(self, text: str) -> int:
        n = len(text)
        if not n:
            return 0
        if self.singles.issuperset(text):
            # No character is unknown: matches come by their ends, the longest first.
            best, count = [0.0] + [-math.inf] * n, [0] * (n + 1)
            for last, (size, score) in self.automaton.iter(text):
                total = best[last + 1 - size] + score
                if total > best[last + 1]:
                    best[last + 1], count[last + 1] = total, count[last + 1 - size] + 1
            return count[n]
        # Of the best path to each end: score, tokens, and whether the last one is unknown.
        best, count, odd = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        matches: Iterator = iter(self.automaton.iter(text)) if len(self.automaton) else iter(())
        ahead = next(matches, None)
        for end in range(1, n + 1):
            found = []
            while ahead is not None and ahead[0] == end - 1:
                found.append(ahead[1])
                ahead = next(matches, None)
            found.sort(reverse=True)  # the longest piece starts first
            top = None
            for size, score in found:
                total = best[end - size] + score
                if top is None or total > top:
                    top, count[end], odd[end] = total, count[end - size] + 1, False
            if not found or found[-1][0] != 1:
                total = best[end - 1] + self.unknown
                if top is None or total > top:
                    joins = self.fuse and odd[end - 1]
                    top, count[end], odd[end] = total, count[end - 1] + (not joins), True
            best[end] = top
        return count[n]


def words(text: str) -> list[str]:
    """A text cut before each blank, which is marked; a text that starts with none gets a mark."""
    marked = text.replace(" ", BLANK)
    marked = marked if marked.startswith(BLANK) else BLANK + marked
    return [BLANK + w for w in marked.split(BLANK)[1:]]


def token_counts(
    docs: DataFrame, vocab: list[tuple[str, float]], unk: int = 0, fuse: bool = True, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_tokens`` of every row; null and empty texts have none. Whole texts of any length are counted.

    Words repeat, so a task keeps the counts of up to 131,072 of them and of their parts. There is no shuffle.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, known = Counter(vocab, unk, fuse), {}

        def count(word: str) -> int:
            n = known.get(word)
            if n is None:
                if len(known) >= 1 << 17:
                    known.clear()
                n = known[word] = counter(word)
            return n

        for part in parts:
            made = [sum(map(count, words(t))) if t else 0 for t in part["text"].to_pylist()]
            yield pa.record_batch([part["doc_id"], pa.array(made, pa.int64())], schema=schema)

    return texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long")


def public_pieces() -> tuple[list[tuple[str, float]], int]:
    """Pieces and scores of a public vocabulary file, control and byte pieces left out, and the unknown one's number."""
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    usable = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_byte(i) or model.is_unused(i))]
    pieces = [(model.id_to_piece(i), float(model.get_score(i))) for i in usable]
    return pieces, usable.index(model.unk_id())


def op4_token_counts(spark, sf_dir: str) -> DataFrame:
    pieces, unk = public_pieces()
    return token_counts(documents(spark, sf_dir), pieces, unk).select("doc_id", F.col("n_tokens"))
