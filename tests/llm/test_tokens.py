"""BPE against tiktoken, packing against the tokenizer and its own laws, sharding laws."""

import base64
import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from brute import none, odd, rows  # noqa: F401
from tallyhawk.llm import bpe, packing, shuffle

RANKS, JSON = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    import tiktoken
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return bpe.codec(RANKS, public_tokenizers.PATTERN)[0]


def encoded(codec, texts):
    whole = lambda t: np.array(codec.encode(t), np.uint32).tobytes()
    return [np.frombuffer(x, np.uint32).tolist()
            for x in bpe.encode_texts(texts, lambda ws: [whole(" " + w) for w in ws], whole, {})]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(list(" \n\t'stredl,.1é\x1c　")), st.characters(codec="utf-8")),
                        max_size=60), max_size=5))
def test_encoding_equals_the_library(codec, library, texts):
    got = encoded(codec, texts)
    assert got == [library.encode_ordinary(t) for t in texts]
    assert [codec.decode(np.array(g, dtype=np.int64)) for g in got] == [t.encode() for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["the", "ing", "an", "er", "xq", "aaa", "zz", "tion", "un"]), max_size=40))
def test_backtracking_equals_the_merges(codec, parts):
    piece = "".join(parts).encode()
    if piece and piece not in codec.ranks:
        assert [codec.tokens[i] for i in codec.piece(piece)] == codec.merge(piece)


def test_round_trip(odd, rows, library, none):
    got = sorted(tuple(r) for r in bpe.bpe_round_trip(odd, RANKS, public_tokenizers.PATTERN).collect())
    want = []
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want)
    assert bpe.bpe_round_trip(none, RANKS, public_tokenizers.PATTERN).count() == 0


def test_pieces_and_packing(odd, rows, none):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(JSON)
    got = packing.pack(packing.token_pieces(odd, JSON, 256), 256).collect()
    by_doc = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got)
    want = Counter()
    for i, t in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        head = (len(ids) - 1) % 256 + 1
        for p, (a, b) in enumerate(zip([0, *range(head, len(ids), 256)], [*range(head, len(ids) + 1, 256)])):
            want[i, p, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert by_doc == want
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        b.sort()
        assert [o for o, _ in b] == np.cumsum([0, *(n for _, n in b[:-1])]).tolist() and sum(n for _, n in b) <= 256
    assert len(bins) <= -(-sum(r.length for r in got) // 256) + 1
    assert packing.pack(packing.token_pieces(none, JSON)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_best_two_fit(lengths):
    bins = packing.best_two_fit(lengths, 50)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in b) <= 50 for b in bins)
    assert sum(sum(lengths[i] for i in b) <= 25 for b in bins) <= 1


def test_replaces_the_smallest_by_two():
    # 10 and 7 leave a gap of 3; without the 7 two fives fill it
    assert sorted(sorted(b) for b in packing.best_two_fit([10, 7, 5, 5], 20)) == [[0, 2, 3], [1]]


def test_shards(odd, rows, none):
    out = shuffle.two_pass_shuffle(odd, 7, seed=3, bucket_bytes=20_000)
    got = [(r.doc_id, r.text, r.size, r.text_crc32, r.shard, r.slot) for r in out.collect()]
    assert Counter((g[0], g[1]) for g in got) == Counter(rows)
    for i, t, size, crc, _, _ in got:
        raw = (t or "").encode()
        assert (size, crc) == (len(raw) + 16, zlib.crc32(raw))
    counts = Counter(g[4] for g in got)
    assert set(counts) == set(range(7)) and max(counts.values()) - min(counts.values()) <= 1
    for s, n in counts.items():
        assert sorted(g[5] for g in got if g[4] == s) == list(range(n))
    again = shuffle.two_pass_shuffle(odd.repartition(3), 7, seed=3, bucket_bytes=20_000)
    assert sorted(map(str, got)) == sorted(str((r.doc_id, r.text, r.size, r.text_crc32, r.shard, r.slot)) for r in again.collect())
    assert out.columns.count("shard") == 1 and "keep_id" in out.columns
    assert shuffle.two_pass_shuffle(none, 7).count() == 0
    few = shuffle.two_pass_shuffle(odd.filter("doc_id in (4, 5)"), 7).collect()
    assert sorted((r.shard, r.slot) for r in few) == [(0, 0), (1, 0)]


def test_written_shards_are_in_slot_order(spark, odd, tmp_path):
    import glob
    import pyarrow.parquet as pq
    shuffle.write_shards(shuffle.two_pass_shuffle(odd, 3), str(tmp_path / "out"))
    slots = [pq.ParquetFile(f).read(["slot"])["slot"].to_pylist() for f in sorted(glob.glob(str(tmp_path / "out/shard=*/*.parquet")))]
    assert all(s == sorted(s) for s in slots) and sum(map(len, slots)) == odd.count()


def test_fisher_yates_is_uniform():
    seen = Counter(tuple(shuffle.fisher_yates(4, 1, b)) for b in range(6000))
    assert len(seen) == 24 and min(seen.values()) > 170
