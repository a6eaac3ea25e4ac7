"""Exact token counts at every prefix.

The same prefix states as in :mod:`barsmith.llm.bpe` give the number of
tokens of every prefix of a word: ``count[d] = count[start[d]] + 1``, and as a
word of its own ``count[s] + 1`` for the start s of the token that ends there
with the end-of-word mark. Each distinct word keeps its counts at all its
prefixes; a piece's count at a prefix is the sum of the last entries of the
words before and one entry of the word it ends in, a text's count the sum over
its pieces. The running sums at the piece ends tell in which piece a budget is
used up, and its words' tables at which character.
"""

from __future__ import annotations

import re
import unicodedata
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import REMEMBER as STATES
from .bpe import Vocabulary

#: Pieces, and words, that a worker remembers: half of them from the last blocks, half from before.
REMEMBER = 600_000
#: Distinct pieces of the texts that are counted together.
BLOCK = 50_000

#: Characters that str.split() takes for white space and the vocabulary's pattern does not.
_NOT_SPACE = re.compile("[\x1c-\x1f]")
#: Characters that the composed form may join to, or order with, those before them.
_JOINS = regex.compile(r"[\p{M}\u1100-\u11FF]")
#: Words of the pattern whose prefixes are split otherwise: the apostrophe stands alone.
_SHORT = {"'s", "'t", "'re", "'ve", "'m", "'ll", "'d"}
_LETTERS = {"'", "l", "r", "v"}
#: Marks that are a word of the pattern when they stand after letters at a piece's end.
_MARKS = frozenset(".,;:!?)]")


class Counter:
    """Token counts of white-space separated pieces, for a vocabulary with end-of-word marks."""

    #: Fixed value: the splitting pattern of the word vocabulary.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

    def __init__(self, path: str):
        self.vocab = Vocabulary(path)
        self.split = regex.compile(self.PATTERN).findall
        self.space = regex.compile(r"\s+")
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.vocab.special)) + ")")
        self.totals: dict[str, int] = {}  # tokens of a piece
        self.older: dict[str, int] = {}
        self.tables: dict[str, bytes | array] = {}  # tokens of a word's first 0, 1, 2, ... characters
        self.older_tables: dict[str, bytes | array] = {}

    @staticmethod
    def normal(piece: str) -> str:
        """Composed form, lower case character by character."""
        if piece.isascii():
            return piece.lower()
        return "".join([c.lower() for c in unicodedata.normalize("NFC", piece)])

    def cut(self, text: str) -> list[str]:
        """White-space separated pieces; special strings stand alone."""
        if "<|" in text:
            return [p for s in self.special.split(text) for p in ([s] if s in self.vocab.special else self._cut(s))]
        return self._cut(text)

    def _cut(self, text: str) -> list[str]:
        return [p for p in self.space.split(text) if p] if _NOT_SPACE.search(text) else text.split()

    def words_of(self, norm: str) -> list[str]:
        """The pattern's words of a normal form; plain ones, and those with a mark at the end, without the pattern."""
        if norm < "\u0590" and max(norm, default="") < "\u0590":
            if norm.isalpha():
                return [norm]
            if norm[-1:] in _MARKS and norm[:-1].isalpha():
                return [norm[:-1], norm[-1]]
        return self.split(norm)

    def learn(self, pieces: set[str]) -> None:
        """Count the pieces not yet known, all their new words in one walk. What a block used last stays known;
        the tables before are dropped (they bound the worker's memory, not its results)."""
        if len(self.totals) > REMEMBER // 2:
            self.older, self.totals = self.totals, {}
        if len(self.vocab.next) > 2 * STATES:
            self.vocab.next.clear()
        get, new = self.older.get, {}
        for p in pieces.difference(self.totals):
            n = get(p)
            if n is None:
                new[p] = self.words_of(self.normal(p))
            else:
                self.totals[p] = n
        tables = self.learn_words({w for ws in new.values() for w in ws})
        for p, ws in new.items():
            self.totals[p] = tables[ws[0]][-1] if len(ws) == 1 else sum([tables[w][-1] for w in ws])
        for p in self.vocab.special.keys() & new.keys():
            self.totals[p] = 1

    def learn_words(self, words: set[str]) -> dict[str, bytes | array]:
        """The tables of these words (and others)."""
        if len(self.tables) > REMEMBER // 2:
            self.older_tables, self.tables = self.tables, {}
        tables, get, by = self.tables, self.older_tables.get, {}
        for w in (words | _LETTERS).difference(tables):
            t = get(w)
            if t is None:
                by[w.encode()] = w
            else:
                tables[w] = t
        for raw, whole in self.vocab.prefixes(by):
            w = by[raw]
            counts = whole if len(w) == len(raw) else [0, *filter(None, whole)]
            tables[w] = bytes(counts) if counts[-1] < 200 and len(counts) < 200 else array("i", counts)
        for w in _SHORT.intersection(by.values()):  # the apostrophe stands alone in the prefixes
            first = tables["'"][-1]
            tables[w] = array("i", [0, first, *[first + tables[c][-1] for c in w[1:-1]], tables[w][-1]])
        return tables

    def _split(self, piece: str) -> tuple[list[str], list | None]:
        """(words of the normal form, where each prefix of the piece ends in it). None: character by character.

        A prefix that ends between characters which the normal form joins has
        a normal form of its own; for it stand (place, words of the rest from
        there). The rest starts two words before the joined characters, as
        far back as the pattern's words can depend on what follows.
        """
        norm = self.normal(piece)
        words = self.split(norm)
        if piece.isascii() or len(norm) == len(piece) and not _JOINS.search(piece):
            return words, None
        starts = list(accumulate(map(len, words), initial=0))
        ends, at, since = [0], 0, 0
        for i in range(1, len(piece) + 1):
            own = self.normal(piece[since:i])
            if i < len(piece) and _JOINS.match(piece[i]):
                back = starts[max(0, bisect_left(starts, at) - 2)]
                ends.append((back, self.split(norm[back:at] + own)))
            else:
                at, since = at + len(own), i
                ends.append(at)
        return words, ends

    def counts(self, texts: list[str]) -> Iterator[list[int]]:
        """Per text, the token count at every piece's end, piece after piece."""
        at = 0
        while at < len(texts):
            block, seen = [], set()
            while at < len(texts) and len(seen) < BLOCK:
                block.append(self.cut(texts[at]))
                seen.update(block[-1])
                at += 1
            self.learn(seen)
            for pieces in block:
                yield list(accumulate(map(self.totals.__getitem__, pieces)))

    def within(self, piece: str) -> list[int]:
        """Token count of each prefix of one piece, character by character."""
        # a special string is one token; its prefixes are ordinary text
        special = piece in self.vocab.special
        own, ends = self._split(piece[:-1] if special else piece)
        tables = self.learn_words({*own, *(w for e in ends or () if isinstance(e, tuple) for w in e[1])})
        counts = [0]
        for w in own:
            so_far = counts[-1]
            counts += [so_far + n for n in tables[w][1:]]
        if ends is not None:
            counts = [counts[e] if isinstance(e, int) else counts[e[0]] + sum([tables[w][-1] for w in e[1]]) for e in ends]
        return counts + [1] if special else counts

    def fit(self, text: str, ends: list[int], budget: int) -> tuple[int, int]:
        """(tokens, characters) of the longest prefix of at most ``budget`` tokens, without white space at its
        end if it is not the whole text; ``ends`` are the text's :meth:`counts`."""
        at = bisect_right(ends, budget)
        if at == len(ends):
            return (ends[-1] if ends else 0), len(text)
        pieces, starts, to = self.cut(text)[:at + 2], [], 0
        for p in pieces:
            starts.append(text.index(p, to))
            to = starts[-1] + len(p)
        special = self.vocab.special
        joined = lambda i: starts[i] + len(pieces[i]) == starts[i + 1]
        # the beginning of a special string is ordinary text that continues the piece before it
        if pieces[at] in special and at and pieces[at - 1] not in special and joined(at - 1):
            at -= 1
        run = pieces[at]
        if run not in special and at + 1 < len(pieces) and pieces[at + 1] in special and joined(at):
            run += pieces[at + 1][:-1]
        base = ends[at - 1] if at else 0
        table = self.within(run)
        best = max(i for i, n in enumerate(table) if base + n <= budget)
        if not best:
            return base, starts[at - 1] + len(pieces[at - 1]) if at else 0
        return base + table[best], starts[at] + best


@lru_cache(1)
def counter(path: str) -> Counter:
    """One per Python worker."""
    return Counter(path)


def prefix_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, counts array<int>) per row of ``docs``.

    ``counts[i]`` is the exact number of tokens of the text up to the end of
    its i-th white-space separated piece (the last one: of the whole text).
    A null or empty text has no pieces. Null or repeated doc_ids and repeated
    rows pass through; other columns are not read. Nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                counts = list(count.counts([t or "" for t in part.column(2).to_pylist()]))
                flat = np.fromiter((x for c in counts for x in c), np.int32)
                ends = np.cumsum([0, *map(len, counts)])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))],
                    names=["doc_id", "n_bytes", "counts"])

    text = F.col(text_col).cast("string")
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                         F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), text.alias("text"))
    return chosen.mapInArrow(run, "doc_id long, n_bytes long, counts array<int>")


def truncate(docs: DataFrame, path: str, budget: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, kept_tokens, kept) per row of ``docs``: the tokens of the whole text, and
    its longest prefix of at most ``budget`` tokens with the number of its tokens.

    The cut may fall at any character; white space before a cut goes. A null
    text counts as empty. Rows pass through as in :func:`prefix_counts`.
    """
    if budget < 0:
        raise ValueError("budget >= 0")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                texts = [t or "" for t in part.column(1).to_pylist()]
                counts = list(count.counts(texts))
                fits = [count.fit(t, c, budget) for t, c in zip(texts, counts)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([c[-1] if c else 0 for c in counts], pa.int64()), pa.array([n for n, _ in fits], pa.int64()),
                     pa.array([t[:i] for t, (_, i) in zip(texts, fits)], pa.string())], names=["doc_id", "n_tokens", "kept_tokens", "kept"])

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(run, "doc_id long, n_tokens long, kept_tokens long, kept string")


def total(counts: str = "counts") -> F.Column:
    """Tokens of the whole text."""
    return F.when(F.size(counts) > 0, F.element_at(counts, -1)).otherwise(0).cast("long")


def pieces_within(budget: int, counts: str = "counts") -> F.Column:
    """How many whole leading pieces fit a budget of tokens, without encoding again; :func:`truncate` also cuts inside a piece."""
    return F.size(F.filter(counts, lambda c: c <= budget)).cast("long")
