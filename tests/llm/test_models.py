"""Language ID, language-model scores, toxicity and top-k."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

import brute
from brute import SF_ORACLE, none, odd, rows  # noqa: F401
from tallyhawk.llm import language, queries, suffix_tree_lm, topk, toxicity


def test_language_held_out_accuracy(spark):
    got = {r.doc_id: r for r in queries.op2_nearest_centroid_language(spark, SF_ORACLE).collect()}
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "lang").collect()
    held = [r for r in docs if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert all(got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in docs)
    assert sum(got[r.doc_id].lang_pred == r.lang for r in held) >= 0.98 * len(held)
    # what is rejected is mostly junk, a few words over and over; nearly all documents in prose stay
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_ORACLE}/documents.parquet").collect()}
    rejected = [texts[i].split() for i, r in got.items() if r.rejected]
    assert len(rejected) <= 0.01 * len(got)
    prose = [w for w in rejected if len(set(w)) > 0.2 * len(w)]
    assert len(prose) <= 0.005 * len(got)


def test_language_rejects_noise_and_languages_not_learned(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "text", "lang")
    r = random.Random(7)
    noise = [(i, "".join(r.choice("abcdefghijklmnopqrstuvwxyz     ") for _ in range(r.choice([60, 200, 1000])))) for i in range(100)]
    noise = spark.createDataFrame(noise, "doc_id long, text string")
    for left_out in ("fr", "de", "es"):
        model = language.fit(docs.filter(F.col("lang") != left_out))
        assert left_out not in model.names
        strange = [x.rejected for x in language.identify(docs.filter(F.col("lang") == left_out), model).collect()]
        assert sum(strange) >= 0.25 * len(strange)   # the README has the figures
    assert sum(x.rejected for x in language.identify(noise, model).collect()) >= 90
    # stretches of the documents that were learned, some of a few words only
    short = docs.filter("lang <> 'es'").select("doc_id", F.expr("substring(text, 1, 20 + doc_id % 200)").alias("text")).filter("text rlike '[a-z]{3}'")
    kept = [x.rejected for x in language.identify(short, model).collect()]
    assert len(kept) > 500 and sum(kept) <= 0.01 * len(kept)


def test_language_edges(spark, odd, rows, none):
    train = spark.createDataFrame([("the thing and the other thing", "en"), ("le chat et la chatte", "fr"), (None, "fr"), ("123", None)],
                                  "text string, lang string")
    model = language.fit(train)
    got = {r.doc_id: r for r in language.identify(odd.drop("lang"), model).collect()}
    for i, t in rows:
        assert (got[i].lang_pred == "und") == (not regex.search(r"\p{L}", t or "")) and 0 <= got[i].lang_score <= 1
    assert got[10].rejected  # another script
    signs = spark.createDataFrame([(i, t) for i, t in enumerate(["½ ² ³", "Ⅷ ① 12", "五", "a½", "_", "٣"])], "doc_id long, text string")
    assert {r.doc_id: r.lang_pred == "und" for r in language.identify(signs, model).collect()} == \
        {0: True, 1: True, 2: False, 3: False, 4: True, 5: True}
    assert language.identify(none, model).count() == 0
    empty = language.fit(train.limit(0))
    assert {r.lang_pred for r in language.identify(odd, empty).collect()} == {"und"}


def test_lm_baseline_and_normalisation(spark, odd, rows, none):
    train = odd.filter("doc_id % 3 <> 0")
    tree, table = suffix_tree_lm.fit(train)
    got = {r.doc_id: r for r in suffix_tree_lm.score(odd, tree, table).collect()}
    counts = Counter()
    for i, t in rows:
        if i % 3:
            counts.update([*brute.words((t or "").translate(brute.LOWER)), None])
    total, distinct = sum(counts.values()), len(counts)
    for i, t in rows:
        tokens = [*brute.words((t or "").translate(brute.LOWER)), None]
        assert got[i].n_tokens == len(tokens) and got[i].n_known == sum(w in counts for w in tokens)
        assert got[i].train_tokens == total
        assert math.isclose(got[i].base_score, sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in tokens), rel_tol=1e-9)
        assert got[i].score <= 0
    assert sum(r.score for r in got.values()) > sum(r.base_score for r in got.values())
    assert len(tree.suffix) > 3  # "is on is on" and "x x x" diverge
    for state in range(len(tree.suffix)):  # every state's distribution over the alphabet sums to one
        mass = 0.0
        for s in range(len(tree.root)):
            at, rest = state, 0.0
            while at and not (hit := suffix_tree_lm._find(tree.entry, np.array([at * len(tree.root) + s])))[1][0]:
                rest += tree.left[at]
                at = tree.suffix[at]
            mass += 10 ** (rest + (tree.value[hit[0][0]] if at else tree.root[s]))
        assert math.isclose(mass, 1, rel_tol=1e-6)
    assert suffix_tree_lm.score(none, tree, table).count() == 0
    blank, no_words = suffix_tree_lm.fit(none)
    assert {(r.base_score, r.score, r.n_known) for r in suffix_tree_lm.score(odd, blank, no_words).collect()} == {(0.0, 0.0, 0)}


def test_lm_rare_words_meet_their_counts_in_the_join(odd, monkeypatch):
    tree, table = suffix_tree_lm.fit(odd)
    want = {r.doc_id: r for r in suffix_tree_lm.score(odd, tree, table).collect()}
    monkeypatch.setattr(suffix_tree_lm, "HEAD", 20)
    monkeypatch.setattr(suffix_tree_lm, "ALPHABET", 20)
    tree, table = suffix_tree_lm.fit(odd)
    for r in suffix_tree_lm.score(odd, tree, table).collect():
        assert math.isclose(r.base_score, want[r.doc_id].base_score, rel_tol=1e-9) and r.n_known == want[r.doc_id].n_known


def test_lm_keeps_contexts_however_large_the_table(spark, monkeypatch):
    # "qua" is always followed by "vex", in 30 texts; more and more other texts must not take that away
    few = [("qua vex pol", 30), *((f"w{i % 50} w{i % 7} w{i % 11}", 1) for i in range(300))]
    many = [*few, *((f"w{i % 50} w{i % 7} w{i % 11} " * 20, 1) for i in range(4000))]
    docs = spark.createDataFrame([(1, "qua vex pol")], "doc_id long, text string")
    for rows in (few, many):
        train = spark.createDataFrame([(t,) for t, n in rows for _ in range(n)], "text string")
        tree, table = suffix_tree_lm.fit(train)
        want = suffix_tree_lm.score(docs, tree, table).first().score
        assert want > -3.5 - math.log10(len(rows) / 30)  # the first word costs its share of texts, the others next to nothing
        with monkeypatch.context() as m:  # all from the tables gives the same
            for name in ("HEAD_STATES", "HEAD_CELLS", "HEAD", "ALPHABET"):
                m.setattr(suffix_tree_lm, name, 1, raising=False)
            tree, table = suffix_tree_lm.fit(train)
            assert math.isclose(suffix_tree_lm.score(docs, tree, table).first().score, want, rel_tol=1e-9)


def test_lm_scores_without_a_row_for_each_token(spark, monkeypatch):
    texts = [" ".join(f"w{(i * j) % 23} v{j % 11}" for j in range(60)) for i in range(120)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    tree, table = suffix_tree_lm.fit(docs)
    want = {r.doc_id: r.score for r in suffix_tree_lm.score(docs, tree, table).collect()}
    for name in ("HEAD_STATES", "HEAD_CELLS", "HEAD", "ALPHABET"):  # nothing is settled without the tables
        monkeypatch.setattr(suffix_tree_lm, name, 1)
    tree, table = suffix_tree_lm.fit(docs)
    written, cut = [], suffix_tree_lm.cut
    monkeypatch.setattr(suffix_tree_lm, "cut", lambda df: (written.append(cut(df)), written[-1])[1])
    got = suffix_tree_lm.score(docs, tree, table).collect()
    assert {r.doc_id for r in got} == set(want) and all(math.isclose(r.score, want[r.doc_id], rel_tol=1e-9) for r in got)
    assert sum(df.count() for df in written if "doc_id" in df.columns) <= len(texts)  # 14,520 tokens


def test_lm_is_the_same_in_small_pieces(spark, odd, monkeypatch):
    docs = odd.union(odd.filter("doc_id % 2 = 0"))
    tree, table = suffix_tree_lm.fit(docs)
    want = sorted((r.doc_id, r.n_tokens, r.n_known, round(r.score, 6)) for r in suffix_tree_lm.score(docs, tree, table).collect())
    monkeypatch.setattr(suffix_tree_lm, "HELD", 30)
    monkeypatch.setattr(suffix_tree_lm, "CHUNK", 20)
    monkeypatch.setattr(suffix_tree_lm, "_parts", lambda spark, rows: 5)
    tree, table = suffix_tree_lm.fit(docs)
    assert sorted((r.doc_id, r.n_tokens, r.n_known, round(r.score, 6)) for r in suffix_tree_lm.score(docs, tree, table).collect()) == want


def test_lm_order_of_keys():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 1000):
        for high in (4, 1 << 20, (1 << 64) - 1):
            keys = rng.integers(0, high, n, dtype=np.uint64)
            order, got = suffix_tree_lm.ordered(keys)
            assert (got == np.sort(keys)).all() and (keys[order] == got).all() and sorted(order) == list(range(n))
            assert (suffix_tree_lm.unpacked_keys(suffix_tree_lm.packed_keys(got)) == got).all()
            found, at = suffix_tree_lm.distinct(keys)
            assert (found == np.unique(keys)).all() and (found[at] == keys).all()


def test_lm_beats_the_baseline_on_held_out_documents(spark):
    got = [r for r in queries.op6_suffix_tree_lm(spark, SF_ORACLE).collect() if r.held_out]
    assert sum(r.score for r in got) > 0.9 * sum(r.base_score for r in got)
    assert sum(r.score > r.base_score for r in got) > 0.75 * len(got)


def test_segments_are_the_maximal_ones():
    rng = np.random.default_rng(3)
    for _ in range(200):
        scores = rng.integers(-4, 4, rng.integers(1, 14)).tolist()
        want, parts = [], [(0, len(scores))]
        while parts:  # the definition: the best segment (shortest, first), then left and right of it
            a, b = parts.pop()
            best = max(((sum(scores[i:j]), i - j, -i, i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=None)
            if best and best[0] > 0:
                want.append(best[0])
                parts += [(a, best[3]), (best[4], b)]
        assert sorted(s for s, _, _ in toxicity.segments(scores)) == sorted(want)
        assert all(sum(scores[a:b]) == s for s, a, b in toxicity.segments(scores))


def test_toxicity_finds_the_passages(spark, odd, none):
    clean = [(i, f"a quiet text about number words and rivers {i}", 0) for i in range(200)]
    toxic = [(500 + i, f"a quiet text you grumbling grumbler grumblest snarkish snark of rivers {i}", 1) for i in range(40)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in clean + toxic], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in clean + toxic] + [(9999, 1), (None, 1), (3, None)], "doc_id long, toxic int")
    train = toxicity.labelled(docs, labels)
    assert train.count() == 240
    model = toxicity.fit(train)
    test = spark.createDataFrame([(1, "we like rivers"), (2, "quiet rivers, then you grumbling snark grumblers and text"), (3, None), (4, "")],
                                 "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.score(test, model).collect()}
    assert [got[i].predicted for i in (1, 2, 3, 4)] == [0, 1, 0, 0] and got[2].passages and not got[1].passages
    assert all(0 <= r.score <= 1 for r in toxicity.score(odd, model).collect())
    assert toxicity.score(none, model).count() == 0
    assert {r.predicted for r in toxicity.score(test, toxicity.fit(train.filter("toxic = 0"))).collect()} == {0}


def test_toxicity_finds_a_passage_whose_words_came_before():
    model = toxicity.Model({w: 4.0 for w in ("grumbling", "snarkish", "sneering")}, 1.0, 0.5)
    passage = ["you", "grumbling", "snarkish", "sneering", "snarkish", "thing"]
    early = [w for t in ("grumbling", "snarkish", "sneering") for w in [t, *["river"] * 60]]
    text = [*early, *passage, *["river"] * 60, *passage, *["river"] * 200]
    assert [(a, b) for _, a, b in model.passages(text, {})] == [(184, 187), (250, 253)]
    assert [s for s, _, _ in model.scan(["grumbling"] * 20, {})[1]] == [4.0]  # a repeat is no more evidence than one


@pytest.mark.parametrize("head", [2, 200_000])
def test_toxicity_keeps_rare_words_of_a_large_vocabulary(spark, monkeypatch, head):
    # many frequent words with a tilt too slight to score, each of which outranks the rare decisive ones
    monkeypatch.setattr(toxicity, "HEAD", head, raising=False)
    monkeypatch.setattr(toxicity, "MAX_TOKENS", 50, raising=False)
    letters = "abcdefghijklmnop"
    tilted = [a + b + "x" for a in letters for b in letters][:100]
    rare = ["grumbling", "snarkish", "sneering", "hateful"]
    clean = [(" ".join(["river", *(tilted if i % 2 else [])]), 0) for i in range(4000)]
    toxic = [(" ".join(["river", *tilted, *(rare if i < 8 else []), str(i)]), 1) for i in range(400)]
    train = spark.createDataFrame(clean + toxic, "text string, toxic int")
    model = toxicity.fit(train)
    assert (getattr(model, "rest", None) is not None) == (head == 2)
    test = spark.createDataFrame([(1, "river then " + " ".join(rare)), (2, "river " + " ".join(tilted)), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.score(test, model).collect()}
    assert got[1].passages and not got[2].passages and not got[3].passages and len(got) == 3
    assert (got[1].passages[0].start, got[1].passages[0].stop) == (2, 6)


def test_toxicity_held_out(spark):
    sf_dir = "/root/testdata/sf0.1"  # the smaller tables hold out a handful of toxic documents
    got = {r.doc_id: r for r in queries.op10_segment_toxicity(spark, sf_dir).collect()}
    labels = [r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect() if got[r.doc_id].held_out]
    hits = [r.toxic for r in labels if got[r.doc_id].predicted]
    assert sum(hits) >= 0.9 * len(hits) and sum(hits) >= 0.9 * sum(r.toxic for r in labels)


@pytest.mark.parametrize("block", [64, topk.BLOCK_ROWS])
def test_top_k_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK_ROWS", block)
    rng = np.random.default_rng(4)
    vectors = [(i, rng.normal(0, 0.3, 8).tolist()) for i in range(300)]
    vectors += [(i, [0.25] * 8) for i in range(300, 400)]  # ties
    vectors += [(400, None), (450, []), (500, [0.1] * 7 + [None]), (550, [0.1] * 7 + [float("nan")]),
                (600, [float("inf")] + [0.1] * 7), (650, [0.5] * 3), (700, [0.4] * 3), (None, [0.1] * 8), (10, [0.2] * 8)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in vectors], "vec_id long, embedding array<float>, ids string, block int")
    got = [tuple(r) for r in topk.top_k(df, every=10, k=5).collect()]
    whole = [(i, tuple(math.floor(256 * float(np.float32(x))) for x in v)) for i, v in vectors
             if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    queries_of = {}
    for i, v in whole:
        if i % 10 == 0:
            queries_of[i] = min(v, queries_of.get(i, v))
    want = []
    for i, q in queries_of.items():
        scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in whole if j != i and len(v) == len(q))
        want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:5])]
    assert sorted(got) == sorted(want)
    assert topk.top_k(df.limit(0), 10).count() == 0
