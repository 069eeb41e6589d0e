"""Suffix-array dedup, source divergence and phrase collocations against brute force."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import brute
from brute import none, odd, rows  # noqa: F401
from tallyhawk.llm import collocation, divergence, suffix_array


def spans(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in df.collect()), key=repr)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=70))
def test_suffix_array(symbols):
    got = suffix_array.suffix_array(np.array(symbols, dtype=np.int64))
    assert got.tolist() == sorted(range(len(symbols)), key=lambda i: symbols[i:])


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(max_size=60).map(lambda b: bytes(x % 2 for x in b)), max_size=6), st.integers(2, 17))
def test_repeated_windows(texts, length):
    texts = [t for t in texts if len(t) >= length]
    seen = brute.Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    got = suffix_array.repeated_windows(texts, length) if texts else []
    assert [g.tolist() for g in got] == [[seen[t[i:i + length]] > 1 for i in range(len(t) - length + 1)] for t in texts]


@pytest.mark.parametrize("length", [200, 40, 7])
def test_byte_repeats(odd, rows, length):
    got = spans(suffix_array.without_repeats(odd, length))
    assert got == brute.without_byte_repeats(rows, length) and sum(g[2] for g in got) > 1000


def test_byte_repeats_with_split_anchors_and_small_pieces(odd, rows, monkeypatch):
    """Anchors whose windows are counted one by one, many shards, documents longer than a stretch."""
    monkeypatch.setattr(suffix_array, "ANCHOR_BYTES", 0)
    monkeypatch.setattr(suffix_array, "STRETCH", 1000)
    assert spans(suffix_array.without_repeats(odd, 60)) == brute.without_byte_repeats(rows, 60)
    monkeypatch.setattr(suffix_array, "ANCHOR_BYTES", 1 << 30)
    monkeypatch.setattr(suffix_array, "SHARD_BYTES", 500)
    assert spans(suffix_array.without_repeats(odd, 60)) == brute.without_byte_repeats(rows, 60)


def test_one_passage_in_a_third_of_the_documents(spark):
    """Under different neighbours: one anchor with as many strings as documents."""
    r = random.Random(3)
    text = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    passage = text(150)
    rows = [(i, text(r.randint(0, 90)) + (passage if i % 3 == 0 else "") + text(r.randint(0, 90))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = spans(suffix_array.without_repeats(docs, 100))
    assert got == brute.without_byte_repeats(rows, 100) and sum(g[3] for g in got) == 100


def test_ids_rows_and_columns_of_byte_repeats(spark, none):
    """Null and repeated ids are documents of their own; repeated rows repeat each other; columns pass through."""
    copy, own = "spoken words " * 20, "words of one document alone, " + "".join(map(str, range(90)))
    rows = [(None, copy), (None, copy), (None, own), (7, own[:150]), (7, "short"), (8, "short"), (9, None), (9, None), (None, None)]
    docs = spark.createDataFrame([(i, t, t, 5, "s") for i, t in rows], "doc_id long, text string, row string, n_bytes int, key string")
    got = suffix_array.without_repeats(docs, 100)
    assert spans(got) == brute.without_byte_repeats(rows, 100)
    assert {"row", "key"} <= set(got.columns) and got.filter("key <> 's' or not row <=> text").count() == 0
    assert suffix_array.without_repeats(none).count() == 0
    assert dict(got.dtypes)["kept"] == "binary" and dict(got.dtypes)["n_bytes"] == "bigint"


def _labelled(rows):
    r = random.Random(11)
    return [(i, t, r.choice([None, "en", "en", "fr", ""]), r.choice([None, "a", "b", "ç", "z"])) for i, t in rows]


def test_source_divergence(spark, rows, none):
    made = [*_labelled(rows), (900, None, "xx", "s"), (901, "12 34", "xx", "t"), (902, None, "alone", None)]
    made += [(i, "a term of many documents" + " tie" * (i % 3), "en", "abc"[i % 3]) for i in range(40)]
    docs = spark.createDataFrame([(*m, "x") for m in made], "doc_id long, text string, lang string, source string, item string").repartition(5)
    for least in (1, 3, 10):
        got = sorted((r.lang, r.source, r.part, r["item"], r.value, r["rank"]) for r in divergence.source_divergence(docs, least, 10).collect())
        assert got == brute.source_divergence([m[1:] for m in made], least, 10)
    assert divergence.source_divergence(none).count() == 0


def test_source_divergence_in_many_shards(spark, rows, monkeypatch):
    monkeypatch.setattr(divergence, "SHARD_CELLS", 40)
    made = _labelled(rows)
    docs = spark.createDataFrame(made, "doc_id long, text string, lang string, source string")
    got = sorted((r.lang, r.source, r.part, r["item"], r.value, r["rank"]) for r in divergence.source_divergence(docs, 2, 5).collect())
    assert got == brute.source_divergence([m[1:] for m in made], 2, 5)


def test_term_counts_are_handed_on_in_parts():
    """A task that holds few counts at a time adds up to the same."""
    import pyarrow as pa
    from tallyhawk.llm.common import combined
    r = random.Random(2)
    tables = [pa.table({"k": [r.randrange(50) for _ in range(20)], "n": [1] * 20}) for _ in range(30)]
    want = brute.Counter(k for t in tables for k in t["k"].to_pylist())
    for held in (1, 30, 1000):
        got = brute.Counter()
        for b in combined(iter(tables), ["k"], ["n"], held):
            for k, n in zip(b["k"].to_pylist(), b["n"].to_pylist()):
                got[k] += n
        assert got == want


def _phrased(rows):
    r = random.Random(4)
    few = ["the", "of", "New", "york", "city", "a,b", "x.", "the\tend", "É"]
    made = [(r.choice([None, "en", "fr"]), t) for _, t in rows]
    return made + [(r.choice(["en", "fr"]), " ".join(r.choice(few) for _ in range(r.randint(0, 40)))) for _ in range(60)]


@pytest.mark.parametrize("longest, least, top, contained, shards", [(3, 10, 2000, 50, 3), (4, 3, 25, 80, 2), (2, 2, 2000, 50, 5), (3, 4, 2000, 1, 1)])
def test_collocations(spark, rows, longest, least, top, contained, shards):
    made = _phrased(rows)
    docs = spark.createDataFrame([(*m, "x") for m in made], "lang string, text string, phrase string").repartition(4)
    found = collocation.collocations(docs, longest, least, top, contained, shards)
    got = sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in found.collect())
    want = brute.collocations(made, longest, least, top, contained)
    assert got == want and len(got) > 20


def test_collocations_of_nothing(spark, none):
    assert collocation.collocations(none).count() == 0
    docs = spark.createDataFrame([("en", None), (None, ""), ("en", " .,; ")], "lang string, text string")
    assert collocation.collocations(docs, least=1).count() == 0


def test_words_and_pieces(rows):
    import pyarrow as pa
    texts = [t or "" for _, t in rows] + ["a b.c", "d", "", "é.F g", " x", "y "]
    t = collocation.Tokens(pa.array(texts))
    got = [(d, p, w) for d, p, w in zip(t.doc.tolist(), t.piece.tolist(), t.dictionary.take(pa.array(t.code)).to_pylist())]
    want, n = [], 0
    for d, text in enumerate(texts):
        for piece in brute.re.split("[.,;:!?\x0a-\x0d]", text.translate(brute.LOWER)):
            want += [(d, n, w) for w in brute.re.split("[\x20\x09]+", piece) if w]
            n += 1
    assert [(d, w) for d, _, w in got] == [(d, w) for d, _, w in want]
    assert [a == b for (_, a, _), (_, b, _) in zip(got, got[1:])] == [a == b for (_, a, _), (_, b, _) in zip(want, want[1:])]
