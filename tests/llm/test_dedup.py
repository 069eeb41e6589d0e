"""Exact dedup, Jaccard join and substring dedup against brute force on odd documents."""

import numpy as np
import pytest

import brute
from brute import none, odd, rows  # noqa: F401
from tallyhawk.llm import dedup, jaccard, substring
from tallyhawk.llm.text import Words, buffers


def as_rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def unnamed(spark):
    """Documents whose ids are missing or name several rows, with columns that begin as the operators' own do."""
    made = spark.createDataFrame([(i, t, "en", "s", 0, "p", "q") for i, t in brute.odd_ids()],
                                 "doc_id long, text string, lang string, source string, n_chars long, _id string, _Key string")
    return made.repartition(4, "text").cache()


def test_missing_and_repeated_ids(unnamed):
    rows = brute.odd_ids()
    assert as_rows(dedup.exact_dedup(unnamed, digests=True), "doc_id", "keep_id", "group_size", "kept", "text_sha256") == brute.exact_groups(rows)
    for k, percent in ((3, 90), (5, 80)):
        assert as_rows(jaccard.jaccard_components(unnamed, k, percent), "doc_id", "n_shingles", "component_id") == \
            brute.jaccard_components(rows, k, percent)
    got = substring.without_repeats(unnamed)
    assert as_rows(got, "doc_id", "n_words", "n_removed", "kept") == brute.without_repeats(rows)
    assert got.filter("_id <> 'p' or _Key <> 'q'").count() == 0 and {"_id", "_Key"} <= set(got.columns)


def test_exact_dedup(odd, rows):
    got = as_rows(dedup.exact_dedup(odd, digests=True), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert got == brute.exact_groups(rows)


def test_exact_dedup_reads_survivors_only(odd, rows):
    got = dedup.exact_dedup(odd).collect()
    assert {r.doc_id for r in got if r.group_size > 1} <= {r.doc_id for r in got if r.text_sha256}
    assert any(r.text_sha256 is None for r in got)


@pytest.mark.parametrize("k, percent", [(3, 90), (5, 80)])
def test_jaccard_components(odd, rows, k, percent):
    got = as_rows(jaccard.jaccard_components(odd, k, percent), "doc_id", "n_shingles", "component_id")
    assert got == brute.jaccard_components(rows, k, percent)


def test_jaccard_ties_of_signatures_that_are_not_sketched(odd, rows, monkeypatch):
    monkeypatch.setattr(jaccard, "SKETCHED", 1)
    got = as_rows(jaccard.jaccard_components(odd, 5, 80), "doc_id", "n_shingles", "component_id")
    assert got == brute.jaccard_components(rows, 5, 80)


def test_jaccard_blocks_join_as_one(odd, rows, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_ELEMENTS", 300)
    got = as_rows(jaccard.jaccard_components(odd), "doc_id", "n_shingles", "component_id")
    assert got == brute.jaccard_components(rows, 3, 90)


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(1)
    for percent in (80, 90):
        bands = jaccard.Bands(percent, 1 << 20)
        for _ in range(300):
            n = int(rng.integers(1, 400))
            a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            b = a.copy()
            for _ in range(int(rng.integers(0, n // 4 + 1))):  # swaps, additions and losses
                what = rng.integers(3)
                if what == 0:
                    b[rng.integers(len(b))] = rng.integers(1 << 63)
                elif what == 1 or len(b) == 1:
                    b = np.append(b, rng.integers(0, 1 << 63, 1, dtype=np.uint64))
                else:
                    b = np.delete(b, rng.integers(len(b)))
            a, b = np.unique(a), np.unique(b)
            both = len(np.intersect1d(a, b))
            if 100 * both >= percent * (len(a) + len(b) - both):
                assert set(jaccard.signatures(a, bands)) & set(jaccard.signatures(b, bands))


def test_similar_sets_show_each_other_enough():
    rng = np.random.default_rng(3)
    for percent in (10, 80, 90, 100):
        for _ in range(600):
            n = int(rng.integers(1, 60))
            a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            gone = rng.random(len(a)) < rng.random() * (100 - percent) / 50
            b = np.unique(np.concatenate((a[~gone], rng.integers(0, 1 << 63, int(rng.integers(0, n // 5 + 2)), dtype=np.uint64))))
            both = len(np.intersect1d(a, b))
            if both and 100 * both >= percent * (len(a) + len(b) - both):
                found = np.intersect1d(a[:jaccard.shown(len(a), percent)], b[:jaccard.shown(len(b), percent)])
                assert len(found) >= max(jaccard.needed(len(a), percent), jaccard.needed(len(b), percent))


def test_sketches_join_similar_sets_and_not_strangers():
    rng = np.random.default_rng(5)
    make = lambda n: rng.integers(0, 1 << 63, n, dtype=np.uint64)
    for percent in (80, 90):
        for n in (1, 5, 31, 32, 33, 400, 2050):
            one = np.unique(make(n))
            near = [np.unique(np.append(one, make(m))) for m in range(0, n * (100 - percent) // percent + 1, n // 8 + 1)]
            near += [one[m:] for m in range(1, n * (100 - percent) // 100 + 1, n // 8 + 1)]
            strangers = [np.unique(np.concatenate((one[:n // 3], make(n - n // 3)))) for _ in range(4)] if n >= 400 else []
            sets = near + strangers
            order = rng.permutation(len(sets))
            ids, size = np.arange(len(sets))[order], np.array([len(sets[i]) for i in order])
            links = jaccard.sketched_links(ids, size, [jaccard.sketch(sets[i]) for i in order], percent)
            label = list(range(len(sets)))
            for a, b in links:
                label = [label[b] if x == label[a] else x for x in label]
            assert len({label[i] for i in range(len(near))}) == 1
            assert len({label[i] for i in range(len(near), len(sets))} | {label[0]}) == len(strangers) + 1


@pytest.mark.parametrize("k, percent", [(3, 90), (5, 80)])
def test_strangers_that_share_a_passage_make_no_signatures(spark, monkeypatch, k, percent):
    rng = np.random.default_rng(4)
    word = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 10 ** 9, n))
    passage, near = word(40), word(400)
    texts = [f"{word(300)} {passage} {word(100)}" for _ in range(30)] + [near, f"{near} end"]
    marked, made = [], jaccard._sets

    def sets(docs, *rest):
        if rest[-1].startswith("mark "):
            marked.append(docs.count())
        return made(docs, *rest)

    monkeypatch.setattr(jaccard, "_sets", sets)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = as_rows(jaccard.jaccard_components(docs, k, percent), "doc_id", "n_shingles", "component_id")
    assert got == brute.jaccard_components(list(enumerate(texts)), k, percent)
    assert marked and max(marked) == 2


def test_substring_dedup(odd, rows):
    got = as_rows(substring.without_repeats(odd), "doc_id", "n_words", "n_removed", "kept")
    assert got == brute.without_repeats(rows)
    assert sum(r[2] for r in got) > 500


def test_substring_dedup_deals_windows_of_a_hot_anchor(odd, rows, monkeypatch):
    monkeypatch.setattr(substring, "SHARD_RUNS", 1)
    got = as_rows(substring.without_repeats(odd), "doc_id", "n_words", "n_removed", "kept")
    assert got == brute.without_repeats(rows)


def test_other_columns_pass_through(odd):
    got = substring.without_repeats(odd)
    assert {"keep_id", "shard", "row", "source"} <= set(got.columns)
    assert got.filter("keep_id <> 'x' or row <> 'k'").count() == 0


def test_empty_tables(none):
    assert dedup.exact_dedup(none).count() == 0
    assert jaccard.jaccard_components(none).count() == 0
    assert substring.without_repeats(none).count() == 0


def test_suffix_automaton_matches_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(40):
        texts = [rng.integers(0, 3, rng.integers(1, 40)).tolist() for _ in range(6)]
        automaton = substring.SuffixAutomaton()
        for d, t in enumerate(texts):
            automaton.add(t, 10 * d)
        automaton.close()
        for n in (2, 5):
            for t in [*texts, rng.integers(0, 3, 30).tolist()]:
                want = [min([10 * d for d, x in enumerate(texts) if any(x[j:j + n] == t[i:i + n] for j in range(len(x) - n + 1))],
                            default=1 << 62) for i in range(len(t) - n + 1)]
                assert automaton.stream(t, n) == want


def test_words_split_as_specified(rows):
    import pyarrow as pa
    data, offsets = buffers(pa.array([t for _, t in rows]))
    found = Words(data, offsets, lower=False)
    raw = data.tobytes()
    for d, (_, t) in enumerate(rows):
        a, b = found.first[d], found.first[d + 1]
        assert [raw[s:e].decode() for s, e in zip(found.start[a:b], found.end[a:b])] == brute.words(t)
