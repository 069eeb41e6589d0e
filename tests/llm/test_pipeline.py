"""The pipeline's stages on odd documents against brute force, and the whole run."""

import __spark_entry__ as E
import brute
import corpus_pipeline as cp
from brute import SF_SMALL, none, odd, rows  # noqa: F401


def test_entry_registers_all():
    names = list(E.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14))


def test_stages_against_brute_force(spark, odd, rows):
    kept = cp.drop_exact_copies(spark, odd, "")
    assert kept.columns == list(cp.COLUMNS)
    stay = {i for i, keep, _, _, _ in brute.exact_groups(rows) if i == keep}
    rows = sorted({(i, t or "") for i, t in rows if i in stay})   # of a repeated row one stays
    assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == sorted((i, t or "") for i, t in rows)
    near = cp.drop_near_copies(spark, kept, "")
    stay = {i for i, _, c in brute.jaccard_components(rows, 5, 80) if i == c}
    rows = [(i, t) for i, t in rows if i in stay]
    assert sorted(r.doc_id for r in near.collect()) == sorted(i for i, _ in rows)
    cleaned = cp.remove_repeated_passages(spark, near, "")
    want = {i: (k if n else dict(rows)[i]) for i, _, n, k in brute.without_repeats(rows)}
    assert {r.doc_id: r.text or "" for r in cleaned.collect()} == want
    packed = cp.pack_sequences(spark, cleaned, "").collect()
    assert {r.doc_id for r in packed} == set(want)


def test_rows_without_id_and_ids_of_several_texts(spark):
    """One row of each group stays, whatever its id names besides; clean texts all stay."""
    rows = brute.odd_ids()
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = [(r.doc_id, r.text) for r in cp.drop_exact_copies(spark, docs.repartition(3, "text"), "").collect()]
    lower = [(t or "").translate(brute.LOWER) for _, t in kept]
    assert len(lower) == len(set(lower)) and set(lower) == {(t or "").translate(brute.LOWER) for _, t in rows}
    best = {}
    for i, t in rows:
        t = (t or "").translate(brute.LOWER)
        best[t] = max(i if i is not None else -1, best.get(t, -1))
    assert {t: i if i is not None else -1 for (i, _), t in zip(kept, lower)} == best
    assert (9, "other words entirely") in kept and set(kept) <= set(rows)

    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in kept], docs.schema)
    near = [(r.doc_id, r.text) for r in cp.drop_near_copies(spark, docs, "").collect()]
    sets = [brute.shingles(t, 5) for _, t in kept]
    similar = lambda a, b: bool(a & b) and 100 * len(a & b) >= 80 * len(a | b)
    assert set(near) <= set(kept) and (21, "a clean text of its own") in near and (9, "other words entirely") in near
    left = [brute.shingles(t, 5) for _, t in near]
    assert not any(similar(a, b) for n, a in enumerate(left) for b in left[:n])
    alone = [r for r, s in zip(kept, sets) if sum(similar(s, x) for x in sets) < 2]
    assert set(alone) <= set(near) and sum(len(s) > 100 for s in left) == 1
    assert [i for (i, t), s in zip(near, left) if len(s) > 100] == [20]

    cleaned = {(r.doc_id, r.text) for r in cp.remove_repeated_passages(
        spark, spark.createDataFrame([(i, t, "en", "s", 0) for i, t in near], docs.schema), "").collect()}
    want = brute.without_repeats(near)
    assert len(cleaned) == len(near) and sorted(len(brute.words(t)) for _, t in cleaned) == sorted(n - gone for _, n, gone, _ in want)


def test_language_stage_keeps_clean_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    more = spark.createDataFrame([(10_000, "12 34", "en", "s", 5), (10_001, None, None, "s", 0)], docs.schema)
    got = {r.doc_id for r in cp.identify_language(spark, docs.unionByName(more), "").collect()}
    assert not {10_000, 10_001} & got and len(got) >= docs.count() - 1


def test_run(spark):
    got = cp.run(spark, SF_SMALL)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(got.columns) and got.count() > 100
    assert all(f(spark, spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0), SF_SMALL).count() == 0 for _, f in cp.STAGES)


def test_sql_oracles(spark):
    from oracle_harness import compare, duck
    from tallyhawk.llm import queries
    con = duck(SF_SMALL)
    for name, sql in queries.ORACLE.items():
        problems, _, _ = compare(spark, con, name, queries.QUERIES[name], sql, SF_SMALL)
        assert not problems, (name, problems)
