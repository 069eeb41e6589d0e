"""Best-two-fit packing of tokenized documents into sequences of a fixed length.

A sequence starts with the longest piece left and is filled greedily, each time with the longest
piece that fits. While a gap remains, its smallest piece is replaced by two unpacked pieces that fill
the gap grown by that piece more tightly, as tightly as any two can. Pieces are dealt by a hash into
groups of about ``GROUP_PIECES`` that are packed on their own, so a task's work is bounded; a group
wastes a few sequences at most. Only lengths are moved, never ids or texts.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhawk.llm.common import cut, kept, prepare
from tallyhawk.llm.text import buffers, slices

GROUP_PIECES = 60_000
#: Cuts whose ids a worker remembers.
KNOWN_CUTS = 600_000
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"

# Classes of bytes: ASCII letters, marks that end a word, ASCII that is no white space, what may begin white space.
_LETTER, _MARK, _SOLID = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK[list(b".,;:!?")] = True
_SOLID[33:127] = True

#: A space before white space or at the end: cuts before spaces are not the tokenizer's there.
_IRREGULAR = re.compile(r" (?:\s|\Z)")
#: What may begin white space in UTF-8.
_MAY_BE_SPACE = np.zeros(256, dtype=bool)
_MAY_BE_SPACE[[*range(9, 14), *range(28, 33), 0xC2, 0xE1, 0xE2, 0xE3]] = True


class _Encoder:
    """The ids of texts, made by the tokenizer once for each new cut.

    Texts are cut where no match of the tokenizer's pattern spans the place: before a space, between a letter and a
    mark, around a line break between visible characters. Texts in which white space follows a space, and those that
    hold a special token, are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.spaced = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)  # ids that start with a space
        for token, i in self.tokenizer.get_vocab().items():
            self.spaced[i] = token.startswith("Ġ")
        self.line = self._whole("\n")[0]
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.start, self.size, self.pool = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<u4")

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _learn(self, cuts: list[str]) -> None:
        """Add the ids of new cuts; those that begin with a space many at a time."""
        names, ids, sizes = [], [], []
        spaced = [c for c in cuts if c[0] == " "]
        lines = [c for c in cuts if c[0] != " " and not any(map(str.isspace, c))]
        plain = [c for c in cuts if c[0] != " " and any(map(str.isspace, c))]
        for lo in range(0, len(spaced), 500):
            some = spaced[lo:lo + 500]
            made = self._whole("".join(some))
            at = np.flatnonzero(self.spaced[made])
            if len(at) == len(some) and at[0] == 0:  # a cut's first id starts with a space and no other does
                names += some
                ids.append(made)
                sizes.append(np.diff(np.append(at, len(made))))
            else:
                plain += some
        for lo in range(0, len(lines), 500):
            some = lines[lo:lo + 500]
            made = self._whole("\n".join(some))
            between = made == self.line
            if between.sum() == len(some) - 1:
                names += some
                ids.append(made[~between])
                sizes.append(np.diff(np.concatenate(([-1], np.flatnonzero(between), [len(made)]))) - 1)
            else:
                plain += some
        single = [self._whole(c) for c in plain]
        size = np.concatenate([*sizes, np.fromiter(map(len, single), np.int64, len(single))])
        self.known.update(zip([*names, *plain], range(len(self.known), len(self.known) + len(size))))
        self.start = np.concatenate((self.start, len(self.pool) + np.cumsum(size) - size))
        self.size = np.concatenate((self.size, size))
        self.pool = np.concatenate((self.pool, *ids, *single))

    def _odd(self, text: pa.Array, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Rows to encode whole."""
        odd = np.zeros(len(text), dtype=bool)
        for token in self.special:
            odd |= pc.match_substring(text, token).to_numpy(zero_copy_only=False)
        space = np.flatnonzero(data == 32)
        follows = np.append(data, 32)[space + 1]
        row = np.searchsorted(offsets, space, "right") - 1
        maybe = np.flatnonzero(np.bincount(row[_MAY_BE_SPACE[follows] | (space + 1 == offsets[row + 1])], minlength=1))
        odd[[i for i in maybe.tolist() if not odd[i] and _IRREGULAR.search(text[i].as_py())]] = True
        return odd

    @staticmethod
    def _cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where a text or a cut begins, and the end."""
        n = len(data)
        edge = np.append(data == 32, True)
        edge[offsets] = True
        letter = _LETTER[data]
        after = data[:-1] == 0xC3  # the Latin letters of two bytes, without the signs for times and divided by
        letter[1:] |= after & (data[1:] != 0x97) & (data[1:] != 0xB7)
        visible = letter | _SOLID[data]
        line = data == 10
        edge[1:n] |= letter[:-1] & _MARK[data[1:]] | visible[:-1] & line[1:]
        edge[2:n] |= visible[:-2] & line[1:-1] & (_SOLID[data[2:]] | (data[2:] == 0xC3))
        return np.flatnonzero(edge)

    def encode(self, text: pa.Array, closing: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by ``closing``, one after the other; and where each text's begin and end."""
        data, offsets = buffers(text)
        data, offsets = data[offsets[0]:offsets[-1]], offsets - offsets[0]
        odd = self._odd(text, data, offsets)
        cut = self._cuts(data, offsets)
        cuts = pa.Array.from_buffers(pa.large_string(), len(cut) - 1, [None, pa.py_buffer(cut.tobytes()), pa.py_buffer(data)])
        first = np.searchsorted(cut, offsets)  # of each text
        count = np.where(odd, 0, np.diff(first))
        regular = np.repeat(~odd, np.diff(first))
        coded = cuts.filter(pa.array(regular)).dictionary_encode()
        names = coded.dictionary.to_pylist()
        if new := [c for c in names if c not in self.known]:
            if len(self.known) > KNOWN_CUTS:
                self._forget()
                new = names
            self._learn(new)
        code = np.fromiter(map(self.known.__getitem__, names), np.int64, len(names))[coded.indices.to_numpy()]
        size, start = self.size[code], self.start[code]
        upto = np.concatenate(([0], np.cumsum(size)))
        ids = self.pool[np.repeat(start - upto[:-1], size) + np.arange(upto[-1])]  # of all cuts, one after the other
        of_text = upto[np.concatenate(([0], np.cumsum(count)))]
        parts, ends = [], []
        for i in range(len(text)):
            parts += [self._whole(text[i].as_py()) if odd[i] else ids[of_text[i]:of_text[i + 1]], _CLOSE[closing:closing + 1]]
            ends.append(len(parts[-2]) + 1)
        return np.concatenate(parts) if parts else ids, np.concatenate(([0], np.cumsum(ends))).astype(np.int64)


_CLOSE = np.arange(1 << 8, dtype="<u4")


def _encoder(path: str) -> _Encoder:
    if path not in kept:
        kept[path] = _Encoder(path)
    return kept[path]


def token_pieces(docs: DataFrame, path: str, capacity: int = 2048) -> DataFrame:
    """Pieces of every document's ids with the closing id 0: doc_id, piece, start, length, ids_crc32.

    Ids are those of the ``tokenizers`` library with add_special_tokens=False: a special token that stands in a text
    is its own id. A document of more than ``capacity`` ids is cut into pieces of that length, of which only the first
    may be shorter; a null or empty text is the one id 0. Repeated rows, and rows that share an id or have none, each
    have their own pieces; other columns are ignored; an empty table gives no rows.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for b in batches:
            texts = pc.fill_null(b.column("text"), "")
            for lo, hi, _, _ in slices(texts):
                ids, edge = encoder.encode(texts[lo:hi], 0)
                n = np.diff(edge)
                pieces = -(-n // capacity)
                doc = np.repeat(np.arange(hi - lo), pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = np.maximum(0, n[doc] - (pieces[doc] - piece) * capacity)
                length = n[doc] - (pieces[doc] - piece - 1) * capacity - start
                at, raw = (4 * (edge[doc] + start)).tolist(), memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[a:a + 4 * k]) for a, k in zip(at, length.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id")[lo:hi].take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length),
                     pa.array(crc, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _PIECES)


def best_two_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of indexes of ``lengths`` (each 1 to ``capacity``).

    Which lengths are left is kept as the bits of one integer, and the same bits reversed, so the longest
    that fits and the best pair are a few operations on 2,048 bits.
    """
    left: list[list[int]] = [[] for _ in range(capacity + 1)]
    for i in range(len(lengths) - 1, -1, -1):
        left[lengths[i]].append(i)
    bits = sum(1 << n for n in range(1, capacity + 1) if left[n])
    mirror = sum(1 << (capacity - n) for n in range(1, capacity + 1) if left[n])

    def take(n: int) -> int:
        nonlocal bits, mirror
        i = left[n].pop()
        if not left[n]:
            bits ^= 1 << n
            mirror ^= 1 << (capacity - n)
        return i

    def give(n: int, i: int) -> None:
        nonlocal bits, mirror
        if not left[n]:
            bits ^= 1 << n
            mirror ^= 1 << (capacity - n)
        left[n].append(i)

    def pair(most: int, least: int) -> tuple[int, int] | None:
        """Two lengths left whose sum is the largest from ``least`` to ``most``."""
        for total in range(most, least - 1, -1):
            both = bits & (mirror >> (capacity - total)) & ((1 << total) - 1) if total <= capacity else 0
            while both:
                a = both.bit_length() - 1
                if 2 * a != total or len(left[a]) > 1:
                    return a, total - a
                both ^= 1 << a
        return None

    bins = []
    while bits:
        n = bits.bit_length() - 1
        held, gap = [(n, take(n))], capacity - n
        while True:
            while gap and (fits := bits & ((1 << (gap + 1)) - 1)):
                n = fits.bit_length() - 1
                held.append((n, take(n)))
                gap -= n
            if not gap:
                break
            small = min(held)
            if not (two := pair(min(gap + small[0], capacity), small[0] + 1)):
                break
            held.remove(small)
            held += [(n, take(n)) for n in two]
            give(*small)
            gap += small[0] - sum(two)
        bins.append([i for _, i in held])
    return bins


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """``pieces`` (of ``token_pieces``) with sequence_id and offset; an empty table packs to no rows."""
    prepare(pieces.sparkSession)
    pieces = cut(pieces)
    groups = max(1, -(-pieces.count() // GROUP_PIECES))

    def one(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], ignore_index=True)
        bins = best_two_fit(rows["length"].tolist(), capacity)
        order = np.concatenate([np.array(b) for b in bins])
        size = np.array([len(b) for b in bins])
        out = rows.iloc[order].reset_index(drop=True)
        out["sequence_id"] = np.repeat(np.arange(len(bins)) + (int(key[0]) << 32), size)
        before = out["length"].cumsum() - out["length"]
        first = np.cumsum(size) - size
        out["offset"] = before - np.repeat(before.to_numpy()[first], size)
        return out.drop(columns="_group")

    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)))
    return dealt.groupBy("_group").applyInPandas(one, f"{_PIECES}, sequence_id long, offset long")
