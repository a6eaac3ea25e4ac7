"""Byte-pair encoding by a depth-first walk over the trie of distinct words.

The encoding of a word's prefix is fixed by its last token: the one
vocabulary token that ends the prefix and stands validly beside the last
token of the shorter prefix before it. Each trie node therefore needs only
(last token, where that token starts). The distinct words of a batch are
visited in sorted order, which is the depth-first order of their trie; a
stack holds the states of the current path, so the states of a shared prefix
are computed once for all words below it.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import lru_cache
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pieces that a worker remembers before it starts afresh (bounds its memory, not its results).
REMEMBER = 200_000


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable
    Latin-1 letters stand for themselves, the others are numbered from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(1)
def token_bytes(path: str) -> list[bytes]:
    """The bytes of each token id; special tokens are their strings."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letters = byte_letters()
    raw = {i: bytes(letters[c] for c in token) for token, i in spec["model"]["vocab"].items()}
    raw.update({t["id"]: t["content"].encode() for t in spec["added_tokens"]})
    return [raw.get(i, b"") for i in range(max(raw) + 1)]


class Vocabulary:
    """Tokens as bytes, the merge that makes each token, and which neighbours are valid."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        letters, end = byte_letters(), model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.inner: dict[bytes, int] = {}  # tokens without, and with, the end-of-word mark
        self.final: dict[bytes, int] = {} if end else self.inner
        self.text: dict[int, bytes] = {i: s.encode() for s, i in self.special.items()}
        for token, i in model["vocab"].items():
            if i in self.text:
                continue
            marked = bool(end) and token.endswith(end)
            raw = bytes(letters[c] for c in (token[: -len(end)] if marked else token))
            (self.final if marked else self.inner)[raw] = i
            self.text[i] = raw
        ids = model["vocab"]
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b, made = ids[left], ids[right], ids[left + right]
            self.rank.setdefault((a, b), rank)
            self.parts.setdefault(made, (a, b, rank))
        self.beside: dict[int, bool] = {}
        self.edges: dict[tuple[int, bool], list] = {}
        for own in {id(self.inner): self.inner, id(self.final): self.final}.values():
            for raw in [raw for raw, i in own.items() if not self._reachable(i)]:
                del own[raw]
        # Suffix automaton: a state is the longest end of a prefix that begins some token;
        # transitions and the tokens that end in a state are filled in as they are met.
        self.state: dict[bytes, int] = {b"": 0}
        for raw in [*self.inner, *self.final]:
            for n in range(1, len(raw) + 1):
                self.state.setdefault(raw[:n], len(self.state))
        self.suffix = list(self.state)
        self.next: dict[int, int] = {}
        self.ends: dict[int, list[tuple[int, int]]] = {}
        self.final_ends: dict[int, list[tuple[int, int]]] = {}

    def _step(self, state: int, byte: int) -> int:
        end = self.suffix[state] + bytes([byte])
        while end not in self.state:
            end = end[1:]
        to = self.next[state << 8 | byte] = self.state[end]
        if to not in self.ends:
            ends = [end[i:] for i in range(len(end))]
            self.ends[to] = [(len(e), self.inner[e]) for e in ends if e in self.inner]
            self.final_ends[to] = [(len(e), self.final[e]) for e in ends if e in self.final]
        return to

    def _reachable(self, token: int) -> bool:
        """Whether the merges turn the token's own bytes into it."""
        if token not in self.parts:
            return len(self.text[token]) == 1
        a, b, _ = self.parts[token]
        return self._reachable(a) and self._reachable(b) and self._apart(a, b, self.parts[token][2])

    def _edge(self, token: int, right: bool) -> list[tuple[int, float, float]]:
        """(symbol, rank that makes it, rank that consumes it) along one edge of a token's merge tree."""
        got = self.edges.get((token, right))
        if got is None:
            got, consumed, t = [], float("inf"), token
            while True:
                made = self.parts.get(t)
                got.append((t, made[2] if made else -1, consumed))
                if not made:
                    break
                consumed, t = made[2], made[1 if right else 0]
            self.edges[token, right] = got
        return got

    def _apart(self, left: int, right: int, before: float) -> bool:
        """Whether no merge ranked under ``before`` joins symbols across the border of two tokens.

        A merge across the border happens if both symbols are there when its
        rank comes up; of equal pairs the leftmost is merged first.
        """
        ranks, edge = self.rank, self._edge(right, False)
        for a, made_a, gone_a in self._edge(left, True):
            for b, made_b, gone_b in edge:
                r = ranks.get((a, b))
                if r is not None and r < before and made_a < r < gone_a and made_b < r <= gone_b:
                    return False
        return True

    def stand(self, left: int, right: int) -> bool:
        key = left << 20 | right
        got = self.beside.get(key)
        if got is None:
            if len(self.beside) > 2 * REMEMBER:
                self.beside.clear()
            got = self.beside[key] = self._apart(left, right, float("inf"))
        return got

    def _last(self, d: int, ends: list[tuple[int, int]], last: list[int]) -> tuple[int, int]:
        """(last token of the encoding of a prefix of d bytes, length of the prefix before it)."""
        for n, t in ends:
            if n == d or self.stand(last[d - n], t):
                return t, d - n
        raise ValueError("bytes without an encoding")

    def _descend(self, words: Iterable[bytes]) -> Iterator[tuple[bytes, int, list[int], list[int], list[int], list[int]]]:
        """Depth-first walk over distinct words: (word, bytes it shares with the word before, state, last, start, count).

        ``last[d]``, ``start[d]`` and ``count[d]`` are the last token, its
        start and the number of tokens of the word's first d bytes (without
        the end-of-word mark). The lists are reused for the next word.
        """
        last, start, count, state, before = [-1], [0], [0], [0], b""
        step, ends_of, beside = self.next.get, self.ends, self.beside.get
        for word in sorted(words):
            shared, most = 0, min(len(before), len(word))
            while shared < most and before[shared] == word[shared]:
                shared += 1
            del last[shared + 1:], start[shared + 1:], count[shared + 1:], state[shared + 1:]
            at, d = state[shared], shared
            for byte in word[shared:]:
                d += 1
                to = step(at << 8 | byte)
                at = self._step(at, byte) if to is None else to
                for n, t in ends_of[at]:
                    s = d - n
                    if not s:
                        break
                    ok = beside(last[s] << 20 | t)
                    if ok or ok is None and self.stand(last[s], t):
                        break
                else:
                    raise ValueError(f"no encoding of {word[:d]!r}")
                state.append(at)
                last.append(t)
                start.append(s)
                count.append(count[s] + 1)
            yield word, shared, state, last, start, count
            before = word

    def walk(self, words: Iterable[bytes]) -> Iterator[tuple[bytes, list[int], list[int], list[int], list[int]]]:
        """(word, last, start, count, ids) per distinct word; ``ids`` is the encoding of the whole word."""
        marked = self.final is not self.inner
        for word, _, state, last, start, count in self._descend(words):
            ids, d = [], len(word)
            if marked and d:
                t, d = self._last(d, self.final_ends[state[d]], last)
                ids.append(t)
            while d:
                ids.append(last[d])
                d = start[d]
            ids.reverse()
            yield word, last, start, count, ids

    def prefixes(self, words: Iterable[bytes]) -> Iterator[tuple[bytes, list[int]]]:
        """(word, whole) per distinct word: ``whole[d]`` is the number of tokens of its first d bytes as a word
        of their own: the count where their last token, with the end-of-word mark, starts, and one; 0 inside a
        character. Found in the walk of :meth:`_descend`; the list is reused for the next word."""
        final_of = self.final_ends
        last, count, state, whole, before = [-1], [0], [0], [0], b""
        step, ends_of, beside = self.next.get, self.ends, self.beside.get
        for word in sorted(words):
            shared, most = 0, min(len(before), len(word))
            while shared < most and before[shared] == word[shared]:
                shared += 1
            del last[shared + 1:], count[shared + 1:], state[shared + 1:]
            del whole[shared + 1:]
            at, d, size = state[shared], shared, len(word)
            for byte in word[shared:]:
                d += 1
                to = step(at << 8 | byte)
                at = self._step(at, byte) if to is None else to
                for n, t in ends_of[at]:
                    s = d - n
                    if not s:
                        break
                    ok = beside(last[s] << 20 | t)
                    if ok or ok is None and self.stand(last[s], t):
                        break
                else:
                    raise ValueError(f"no encoding of {word[:d]!r}")
                state.append(at)
                last.append(t)
                count.append(count[s] + 1)
                if d < size and word[d] & 0xC0 == 0x80:
                    whole.append(0)
                    continue
                for n, t in final_of[at]:
                    s = d - n
                    if not s:
                        break
                    ok = beside(last[s] << 20 | t)
                    if ok or ok is None and self.stand(last[s], t):
                        break
                else:
                    raise ValueError(f"no encoding of {word[:d]!r}")
                whole.append(count[s] + 1)
            yield word, whole
            before = word


class Encoder:
    """Exact byte-level BPE of whole texts, as the vocabulary file's own library gives it."""

    #: Fixed value: the splitting pattern of byte-level vocabularies.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, path: str):
        self.vocab = Vocabulary(path)
        self.split = regex.compile(self.PATTERN).findall
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.vocab.special)) + ")") if self.vocab.special else None
        self.pieces: dict[str, bytes] = {}

    @staticmethod
    def special_ids(path: str) -> list[int]:
        with open(path, encoding="utf-8") as f:
            return [t["id"] for t in json.load(f)["added_tokens"]]

    @staticmethod
    def cut(text: str) -> list[str]:
        """Pieces that the pattern never matches across: cut before each space
        that a character other than white space follows; the space is the
        start of the next piece."""
        parts = text.split(" ")
        out = [parts[0]]
        for p in parts[1:]:
            if p and not p[0].isspace():
                out.append(" " + p)
            else:
                out[-1] += " " + p
        return out

    def segments(self, text: str) -> list[str]:
        return self.special.split(text) if self.special and "<|" in text else [text]

    def learn(self, pieces: set[str]) -> None:
        """Encode the pieces not yet known, all their distinct words in one walk."""
        if len(self.pieces) > REMEMBER:
            self.pieces.clear()
        if len(self.vocab.next) > 2 * REMEMBER:
            self.vocab.next.clear()
        new = {p: self.split(p) for p in pieces.difference(self.pieces)}
        by = {w.encode(): w for ws in new.values() for w in ws}
        known = {by[raw]: pack(f"<{len(ids)}I", *ids) for raw, _, _, _, ids in self.vocab.walk(by)}
        for p, ws in new.items():
            self.pieces[p] = known[ws[0]] if len(ws) == 1 else b"".join([known[w] for w in ws])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Token ids of each text, as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        at = 0
        while at < len(texts):
            block, seen = [], set()
            while at < len(texts) and len(seen) < REMEMBER // 4:
                segments = [s if s in self.vocab.special else self.cut(s) for s in self.segments(texts[at])]
                for s in segments:
                    if isinstance(s, list):
                        seen.update(s)
                block.append(segments)
                at += 1
            self.learn(seen)
            get = self.pieces.__getitem__
            for segments in block:
                out.append(b"".join(
                    np.array([self.vocab.special[s]], "<u4").tobytes() if isinstance(s, str) else b"".join(map(get, s))
                    for s in segments))
        return out


@lru_cache(1)
def encoder(path: str) -> Encoder:
    """One per Python worker: later tasks of a worker find its pieces known."""
    return Encoder(path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids binary) per row: the token ids of the whole text as little-endian
    unsigned 32-bit integers; special strings inside a text become their token.

    A null text counts as empty and has no ids. Null or repeated doc_ids and
    repeated rows pass through; other columns are not read. Nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                ids = enc.encode([t or "" for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(run, "doc_id long, ids binary")


def _texts(ids: list[bytes | None], raw: list[bytes]) -> list[str]:
    return [b"".join(map(raw.__getitem__, np.frombuffer(x or b"", "<u4").tolist())).decode("utf-8", "replace") for x in ids]


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, text): :func:`encode` and :func:`decode` of its ids, by one worker a task instead of two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, raw = encoder(path), token_bytes(path)
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                ids = enc.encode([t or "" for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()), pa.array(_texts(ids, raw), pa.string())],
                                                 names=["doc_id", "ids", "text"])

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(run, "doc_id long, ids binary, text string")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, text) from the rows of :func:`encode`; special tokens become their strings.
    Bytes that are not UTF-8 become U+FFFD; null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = token_bytes(path)
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                text = _texts(part.column(1).to_pylist(), raw)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(text, pa.string())],
                                                 names=["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, text string")
