"""FIXTURES §2.1 and §2.2: hand-made SCD2 sequences in both semantics."""

import datetime as dt

import pytest
from pyspark.sql import types as T

from tallyhawk.operators import scd2
from tallyhawk.plans import history
from tallyhawk.schemas import OPEN_END, REFERENCE, STRICT

D = [dt.date(2021, 3, i) for i in range(1, 7)]
SNAPS = [
    [("T1", "Moscow"), ("T2", "SPB"), ("T3", "Kazan")],
    [("T1", "Tver"), ("T3", "Kazan"), ("T4", "Omsk")],
    [("T1", "Tver"), ("T2", "SPB"), ("T3", "Kazan")],
    [("T2", "SPB"), ("T3", "Kazan")],
    [("T2", "SPB"), ("T3", "Kazan")],
    [("T1", "Tver"), ("T2", "SPB"), ("T3", "Kazan")],
]
SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("s", T.StringType())])
O = OPEN_END


def _sorted(rows):
    return sorted(rows, key=repr)


def _run(spark, n_days, semantics, staging=history.SNAPSHOT, snaps=SNAPS):
    dfs = [spark.createDataFrame(s, SCHEMA) for s in snaps[:n_days]]
    h = history.fold_days(spark, D[:n_days], dfs, "k", ["s"], staging, semantics)
    rows = [(r.k, r.s, r.effective_from.day, r.effective_to if r.effective_to == O else r.effective_to.day,
             r.deleted_flg) for r in h.collect()]
    return sorted(rows, key=repr)


def test_snapshot_after_d3_reference(spark):
    assert _run(spark, 3, REFERENCE) == _sorted([
        ("T1", "Moscow", 1, 1, False), ("T1", "Tver", 2, O, False), ("T2", "SPB", 1, 1, True),
        ("T3", "Kazan", 1, O, False), ("T4", "Omsk", 2, 2, True)])


def test_snapshot_after_d3_strict(spark):
    assert _run(spark, 3, STRICT) == _sorted([
        ("T1", "Moscow", 1, 1, False), ("T1", "Tver", 2, O, False), ("T2", "SPB", 1, 1, True),
        ("T2", "SPB", 3, O, False), ("T3", "Kazan", 1, O, False), ("T4", "Omsk", 2, 2, True)])


def test_snapshot_after_d5_reference_restamps(spark):
    assert _run(spark, 5, REFERENCE) == _sorted([
        ("T1", "Moscow", 1, 4, True), ("T1", "Tver", 2, 4, True), ("T2", "SPB", 1, 1, True),
        ("T3", "Kazan", 1, O, False), ("T4", "Omsk", 2, 4, True)])


def test_snapshot_after_d5_strict(spark):
    assert _run(spark, 5, STRICT) == _sorted([
        ("T1", "Moscow", 1, 1, False), ("T1", "Tver", 2, 3, True), ("T2", "SPB", 1, 1, True),
        ("T2", "SPB", 3, O, False), ("T3", "Kazan", 1, O, False), ("T4", "Omsk", 2, 2, True)])


@pytest.mark.parametrize("semantics", [REFERENCE, STRICT])
def test_snapshot_d6_return(spark, semantics):
    rows = _run(spark, 6, semantics)
    assert ("T1", "Tver", 6, O, False) in rows
    if semantics == REFERENCE:
        assert ("T4", "Omsk", 2, 5, True) in rows
    else:
        assert ("T4", "Omsk", 2, 2, True) in rows


def test_snapshot_staging_reference(spark):
    """D1 stages T1,T2,T3; D2 stages T1,T4; D3-D5 stage T2 only; watermark = run day."""
    staged_keys = []
    hist = history.empty_like(spark, spark.createDataFrame([], SCHEMA), "k", ["s"])
    wm = None
    for i in range(5):
        src = spark.createDataFrame(SNAPS[i], SCHEMA)
        staged = scd2.stage_snapshot(src, hist, "k", ["s"], wm, D[i])
        staged_keys.append(sorted(r.k for r in staged.collect()))
        assert staged.agg({"update_dt": "max"}).first()[0] == D[i]
        hist = scd2.scd2_merge(hist, staged, src.select("k"), D[i], "k", ["s"]).checkpoint()
        wm = D[i]
    assert staged_keys == [["T1", "T2", "T3"], ["T1", "T4"], ["T2"], ["T2"], ["T2"]]


CARD = [[("C1", "A1")], [("C1", "A2")], [("C1", "A2")], [("C1", "A2")]]


def test_restage_null_update_dt_reference(spark):
    rows = _run(spark, 4, REFERENCE, history.RESTAGE_ALL, CARD)
    assert rows == [("C1", "A1", 1, 1, False), ("C1", "A2", 2, 2, False), ("C1", "A2", 3, 3, False),
                    ("C1", "A2", 4, O, False)]


def test_restage_null_update_dt_strict(spark):
    rows = _run(spark, 4, STRICT, history.RESTAGE_ALL, CARD)
    assert rows == [("C1", "A1", 1, 1, False), ("C1", "A2", 2, O, False)]


@pytest.mark.parametrize("semantics", [REFERENCE, STRICT])
def test_null_transitions(spark, semantics):
    """value -> NULL and NULL -> value are changes; NULL -> NULL is not."""
    snaps = [[("a", "x"), ("b", None), ("c", None)], [("a", None), ("b", "y"), ("c", None)]]
    rows = _run(spark, 2, semantics, history.SNAPSHOT, snaps)
    assert ("a", None, 2, O, False) in rows and ("a", "x", 1, 1, False) in rows
    assert ("b", "y", 2, O, False) in rows and ("b", None, 1, 1, False) in rows
    assert [r for r in rows if r[0] == "c"] == [("c", None, 1, O, False)]


def test_incremental_staging_boundary(spark):
    """``update_dt > watermark`` is strict; NULL update_dt is always staged."""
    src = spark.createDataFrame(
        [("c1", "a", dt.date(2021, 3, 1)), ("c2", "b", dt.date(2021, 3, 2)), ("c3", "c", None)],
        "card_num string, account_num string, update_dt date")
    got = scd2.stage_incremental(src, "card_num", ["account_num"], dt.date(2021, 3, 1), dt.date(2021, 3, 5))
    assert sorted((r.card_num, r.update_dt) for r in got.collect()) == [
        ("c2", dt.date(2021, 3, 5)), ("c3", dt.date(2021, 3, 5))]
    strict = scd2.stage_incremental(src, "card_num", ["account_num"], dt.date(2021, 3, 1),
                                    dt.date(2021, 3, 5), semantics=STRICT)
    assert sorted((r.card_num, r.update_dt) for r in strict.collect()) == [
        ("c2", dt.date(2021, 3, 2)), ("c3", None)]


def test_full_name_null_part(spark):
    from tallyhawk.functions.scalars import full_name
    df = spark.createDataFrame([("Ivanov", "Ivan", "Ivanovich"), ("Petrov", "Petr", None)],
                               "l string, f string, p string")
    assert [r[0] for r in df.select(full_name("l", "f", "p")).collect()] == ["Ivanov Ivan Ivanovich", None]


def test_merge_shuffles_history_once(spark):
    """The history is shuffled once; staged rows and source keys are first collapsed to one row per key."""
    h = history.empty_like(spark, spark.createDataFrame([], SCHEMA), "k", ["s"])
    src = spark.createDataFrame(SNAPS[0], SCHEMA)
    merged = scd2.scd2_merge(h, scd2.stage_all(src, "k", ["s"], D[0]), src.select("k"), D[0], "k", ["s"])
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2, plan
    assert "partial_max" in plan and "partial_sum" in plan       # copies collapse map-side


def test_copied_key_fails_fast_and_small(spark):
    """A key repeated in a third of the source collapses to a count before the shuffle, then fails the merge."""
    from pyspark.sql import functions as F
    h = history.empty_like(spark, spark.createDataFrame([], SCHEMA), "k", ["s"])
    src = spark.range(30000).select(F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string"))
                                    .alias("k"), F.lit("x").alias("s"))
    merged = scd2.scd2_merge(h, scd2.stage_all(src, "k", ["s"], D[0]), src.select("k"), D[0], "k", ["s"])
    with pytest.raises(Exception, match="duplicate key k=HOT"):
        merged.write.format("noop").mode("overwrite").save()


def test_as_of_stats_and_length_assertion(spark):
    from tallyhawk.operators.checks import ConstraintError, assert_lengths
    h = history.fold_days(spark, D[:3], [spark.createDataFrame(s, SCHEMA) for s in SNAPS[:3]], "k", ["s"],
                          history.SNAPSHOT, STRICT)
    on_d2 = sorted((r.k, r.s) for r in scd2.as_of(h, D[1]).collect())
    assert on_d2 == [("T1", "Tver"), ("T3", "Kazan"), ("T4", "Omsk")]      # the D2 snapshot, replayed
    st = scd2.history_stats(h).first()
    assert (st.rows, st.open, st.deleted) == (6, 3, 2)
    assert_lengths(h, {"k": 2}, "hist")
    with pytest.raises(ConstraintError):
        assert_lengths(h, {"s": 4}, "hist")
