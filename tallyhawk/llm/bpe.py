"""Byte-level BPE encoding by longest matches and backtracking, and decoding.

The vocabulary's byte strings are mapped to Latin-1 text and put into an Aho-Corasick automaton
(pyahocorasick). A piece of text is encoded left to right with the longest token that starts at each
place; a token is accepted if the merges would leave it beside the one before (a memoised test of
the two tokens alone), else the next shorter token is tried, else the last accepted token is taken
back. A bit per place remembers dead ends, so each place is left at most once: the work is linear in
the piece's length. The result is exactly that of merging pairs by rank.

Text is split by the tokenizer's pattern; where every space stands before a non-space, the text may be
cut before each space first, because no match of the pattern spans such a cut. Recurring cuts are
remembered in a bounded table of each worker.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhawk.llm.common import prepare

CACHE_WORDS = 600_000
SLICE_CHARS = 1 << 20
_ENDS = (".", ",")
_IRREGULAR = re.compile(r" (?:\s|\Z)")


class Codec:
    """Encoder and decoder for one rank file and one splitting pattern."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pattern = regex.compile(pattern)
        self.tokens = {r: t for t, r in self.ranks.items()}
        self.automaton = ahocorasick.Automaton()
        for t, r in self.ranks.items():
            self.automaton.add_word(t.decode("latin-1"), r)
        self.automaton.make_automaton()
        self.shorter = {r: self._next_shorter(t) for t, r in self.ranks.items()}  # longest proper prefix, or -1
        self.sizes = {r: len(t) for t, r in self.ranks.items()}
        self.beside: dict[tuple[int, int], bool] = {}
        self.split: dict[int, tuple[int, int] | None] = {}
        lengths = np.zeros(max(self.tokens, default=0) + 1, dtype=np.int64)
        for r, t in self.tokens.items():
            lengths[r] = len(t)
        self.lengths = lengths
        self.decimal = [b"%d" % r for r in range(len(lengths))]
        self.starts = np.concatenate(([0], np.cumsum(lengths)))
        self.bytes = np.frombuffer(b"".join(self.tokens.get(r, b"") for r in range(len(lengths))), dtype=np.uint8)

    def merge(self, piece: bytes, below: float = float("inf")) -> list[bytes]:
        """The defining merges, lowest rank first, using ranks under ``below``."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            rank, i = min((self.ranks.get(a + b, below), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank >= below:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``; None for a token that no merge makes."""
        if token not in self.split:
            parts = self.merge(self.tokens[token], token)
            self.split[token] = (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None
        return self.split[token]

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges of the two tokens' joined bytes end with exactly these two tokens.

        Undo the merges of both sides from the latest back; were a pair across the border of lower rank
        than the merge undone, the merges would have taken it first.
        """
        if len(self.beside) > CACHE_WORDS:
            self.beside.clear()
        found = self.beside[left, right] = self._holds(left, right)
        return found

    def _holds(self, a: int, b: int) -> bool:
        limit = float("inf")
        while True:
            if self.ranks.get(self.tokens[a] + self.tokens[b], limit) < limit:
                return False
            for of_left in (a > b, a <= b):  # the later merge first
                if pair := self.halves(a if of_left else b):
                    limit, a, b = (a, pair[1], b) if of_left else (b + 1, a, pair[0])
                    break
            else:
                return True

    def _next_shorter(self, token: bytes) -> int:
        return next((self.ranks[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in self.ranks), -1)

    def piece(self, piece: bytes) -> list[int]:
        """Ids of one match of the pattern."""
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        text = piece.decode("latin-1")
        sizes, shorter, beside = self.sizes, self.shorter, self.beside
        n, at, token = len(text), 0, next(self.automaton.iter_long(text))[1]
        alive = bytearray(b"\x01") * (n + 1)
        out: list[int] = []
        while True:
            after = at + sizes[token]
            if alive[after]:
                fits = not out or beside.get((out[-1], token))
                if fits is None:
                    fits = self.compatible(out[-1], token)
                if fits:
                    out.append(token)
                    if after == n:
                        return out
                    at, token = after, next(self.automaton.iter_long(text, after))[1]
                    continue
            token = shorter[token]
            while token < 0:
                alive[at] = 0
                last = out.pop()
                at -= sizes[last]
                token = shorter[last]

    def encode(self, text: str) -> list[int]:
        """Ids of a text, each match of the pattern on its own."""
        return [i for m in self.pattern.findall(text) for i in self.piece(m.encode("utf-8"))]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of ``ids``."""
        if not len(ids):
            return b""
        n = self.lengths[ids]
        to = np.cumsum(n)
        return self.bytes[np.arange(to[-1]) + np.repeat(self.starts[ids] - (to - n), n)].tobytes()


def encode_texts(texts: list[str], many: Callable[[list[str]], list[bytes]], whole: Callable[[str], bytes],
                 cache: dict[str, bytes], limit: int = CACHE_WORDS) -> Iterator[bytes]:
    """Little-endian 32-bit ids of each text. ``many`` encodes cuts, given without their leading space.

    ``whole`` encodes any text; it serves texts in which a space stands before white space or at the end,
    and each text's first cut, which has no leading space.
    """
    ends = {e: whole(e) for e in _ENDS}
    lo = 0
    while lo < len(texts):
        hi, chars = lo, 0
        while hi < len(texts) and (hi == lo or chars < SLICE_CHARS):
            chars += len(texts[hi])
            hi += 1
        cuts = [None if _IRREGULAR.search(t) else t.split(" ") for t in texts[lo:hi]]
        new = set()
        for c in cuts:
            if c:
                new.update(c[1:])
        known = {w: i for w in new if (i := cache.get(w)) is not None}
        new -= known.keys()
        ended = [w for w in new if w[-1:] in _ENDS and w[:-1].isalpha()]  # a word, then one match more
        new.difference_update(ended)
        new.update(w[:-1] for w in ended if w[:-1] not in cache)
        made = dict(zip(new, many(list(new)), strict=True))
        cache.update(made)
        made.update([(w, cache[w[:-1]] + ends[w[-1]]) for w in ended])
        cache.update(made)
        known.update(made)
        for t, c in zip(texts[lo:hi], cuts, strict=True):
            if c is None:
                yield whole(t)
            else:
                c[0] = whole(c[0])
                c[1:] = map(known.__getitem__, c[1:])
                yield b"".join(c)
        if len(cache) > limit:
            cache.clear()
        lo = hi


_codecs: dict[tuple[str, str], tuple[Codec, dict[str, bytes]]] = {}


def codec(path: str, pattern: str) -> tuple[Codec, dict[str, bytes]]:
    """The worker's codec for a rank file, and its table of known words."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = (Codec(path, pattern), {})
    return _codecs[path, pattern]


def bpe_encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids (array of int) for every whole text; null and empty texts have no ids."""
    return _encoded(docs, path, pattern, lambda c, ids: ids, "ids array<int>", pa.list_(pa.int32()))


def bpe_round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids joined by a space), decoded_sha256 (of the ids' bytes).

    One row per row of ``docs``, repeats included; a null text counts as empty; other columns are ignored.
    """
    def digest(c: Codec, ids: np.ndarray) -> tuple[int, str, str]:
        return (len(ids), hashlib.sha256(b" ".join(map(c.decimal.__getitem__, ids.tolist()))).hexdigest(),
                hashlib.sha256(c.decode(ids)).hexdigest())

    rows = _encoded(docs, path, pattern, digest, "d struct<n_tokens: long, ids_sha256: string, decoded_sha256: string>",
                    pa.struct([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]))
    return rows.select("doc_id", "d.*")


def _encoded(docs: DataFrame, path: str, pattern: str, use: Callable, ddl: str, kind: pa.DataType) -> DataFrame:
    prepare(docs.sparkSession)
    names = ["doc_id", ddl.split()[0]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, cache = codec(path, pattern)

        def pack(text: str) -> bytes:
            return array("I", c.encode(text)).tobytes()

        def many(words: list[str]) -> list[bytes]:
            return [array("I", c.piece(b" " + w.encode())).tobytes() if w.isalpha() else pack(" " + w) for w in words]

        for b in batches:
            texts = pc.fill_null(b.column("text"), "").to_pylist()
            made = [use(c, np.frombuffer(x, np.uint32)) for x in
                    encode_texts(texts, many, pack, cache)]
            if isinstance(kind, pa.StructType):
                made = [dict(zip(kind.names, x, strict=True)) for x in made]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(made, kind)], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, f"doc_id long, {ddl}")
