"""Plan shapes: exchanges, pushdown, anti joins, no Python in the core."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tallyhawk.operators import asof, chain, fraud, scd2, sequence
from tallyhawk.operators.chain import dim_chain
from tallyhawk.plans import asof_catalog, catalog
from tallyhawk.plans import fixtures as fx
from tallyhawk.operators.facts import write_day
from tallyhawk.plans.state import FACTS, Warehouse

PY_NODES = ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rule4_unsplit_is_one_exchange(spark):
    df = fraud.amount_probes(fx.tx(spark, SF_SMALL), hot=None)
    assert _plan(df).count("Exchange hashpartitioning") == 1


def test_fact_day_prunes_partitions(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    load_day = dt.date(2024, 2, 1)
    write_day(fx.tx_as_facts(spark, SF_SMALL), wh.day_path(FACTS, load_day, 1), "trans_day")
    wh.commit(load_day, {}, days={FACTS: [1]})
    plan = _plan(wh.read_facts(dt.date(2024, 1, 15)))
    assert "PartitionFilters: [isnotnull(trans_day" in plan and "2024-01-15" in plan


def test_scans_read_only_needed_columns(spark):
    plan = _plan(catalog.q_fraud_expired_contract(spark, SF_SMALL))
    events_scans = [l for l in plan.splitlines() if "events.parquet" in l]
    assert events_scans and all("props" not in l and "event_type" not in l for l in events_scans)


def test_new_keys_use_anti_join(spark):
    h = fx.snapshot(spark, SF_SMALL, 1).withColumn("effective_from", F.lit(dt.date(2024, 1, 1)))
    s = fx.snapshot(spark, SF_SMALL, 2)
    assert "LeftAnti" in _plan(scd2.scd2_new(h, s, "k"))


def test_core_plans_have_no_python(spark):
    for name in ("fraud_report", "scd2_three_days", "fraud_city_hop", "asof_join", "fraud_report_asof"):
        plan = _plan(catalog.QUERIES[name](spark, SF_SMALL))
        assert not any(n in plan for n in PY_NODES), name


def test_report_prefilters_cards_for_rules_1_2(spark):
    """Operations meet only the cards that can hit rules 1-2; the blacklist is joined per card."""
    chain = dim_chain(fx.cards(spark, SF_SMALL), fx.accounts(spark, SF_SMALL), fx.clients(spark, SF_SMALL))
    rep = fraud.fraud_report(fx.tx(spark, SF_SMALL), chain, fx.blacklist(spark, SF_SMALL),
                             fx.terminals(spark, SF_SMALL))
    plan = rep._jdf.queryExecution().optimizedPlan().toString()
    assert "_listed" in plan and "passport_valid_to" in plan
    # the blacklist's left join has the chain (card -> account -> client) on its left
    left_join = plan[plan.index("Join LeftOuter"):]
    assert left_join.index("Join Inner") < left_join.index("Relation")


def test_report_without_broadcast_matches(spark):
    """Above the row bound nothing is broadcast; the shuffle-join plan gives the same rows."""
    args = (fx.tx(spark, SF_SMALL), fx.blacklist(spark, SF_SMALL), fx.terminals(spark, SF_SMALL))
    cards, accounts, clients = fx.cards(spark, SF_SMALL), fx.accounts(spark, SF_SMALL), fx.clients(spark, SF_SMALL)
    want = sorted(map(tuple, catalog.q_fraud_report(spark, SF_SMALL).collect()), key=repr)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        rep = fraud.fraud_report(args[0], dim_chain(cards, accounts, clients), args[1], args[2], hot=None)
        plan = _plan(rep)
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
        assert sorted(map(tuple, rep.collect()), key=repr) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_building_a_report_starts_no_job(spark):
    chain = dim_chain(fx.cards(spark, SF_SMALL), fx.accounts(spark, SF_SMALL), fx.clients(spark, SF_SMALL))
    tx, blacklist, terminals = (f(spark, SF_SMALL) for f in (fx.tx, fx.blacklist, fx.terminals))
    spark.sparkContext.setJobGroup("building", "building", False)
    try:
        fraud.fraud_report(tx, chain, blacklist, terminals, hot=None)   # what the daily run passes: its load named the hot cards
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_asof_report_has_no_join_without_an_equality(spark):
    plan = _plan(catalog.QUERIES["fraud_report_asof"](spark, SF_SMALL))
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_snapshot_merge_moves_the_history_once(spark, tmp_path):
    """A snapshot is staged within the merge: one scan and one exchange of the history, one scan of the snapshot."""
    from tallyhawk.plans import history
    snaps = [fx.snapshot(spark, SF_SMALL, n) for n in (1, 2)]
    for n, df in enumerate([history.fold_days(spark, fx.SCD2_DAYS[:1], snaps[:1], "k", ["s"]), snaps[1]]):
        df.write.parquet(str(tmp_path / f"t{n}"))
    hist, snap = (spark.read.parquet(str(tmp_path / f"t{n}")) for n in (0, 1))
    plan = _plan(scd2.scd2_merge(hist, snap, None, fx.SCD2_DAYS[1], "k", ["s"], since=dt.date(2024, 3, 1)))
    scans = [l for l in plan.splitlines() if "Scan parquet" in l]
    assert sum("/t0" in l for l in scans) == 1 and sum("/t1" in l for l in scans) == 1
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 2   # the snapshot's keys, then everything once


def test_history_of_snapshots_sorts_once(spark):
    """The rows are moved by key and sorted once, without an aggregate that holds a task's whole input."""
    snaps = fx.snapshot(spark, SF_SMALL, 1).withColumn("day", F.lit(dt.date(2024, 1, 1)))
    days = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 2),)], "day date")
    plan = _plan(asof.scd2_from_snapshots(snaps, "k", ["s"], days=days)).split("== Subqueries")[0]
    assert "SortAggregate" not in plan and plan.count("Exchange hashpartitioning(k#") == 1
    assert plan.count("Sort [k#") == 1


def test_known_rows_bound_the_rows_of_a_task(spark):
    snaps = fx.snapshot(spark, SF_SMALL, 1).withColumn("day", F.lit(dt.date(2024, 1, 1)))
    days = spark.createDataFrame([(dt.date(2024, 1, 1),)], "day date")
    assert "hashpartitioning(k#" in (p := _plan(asof.scd2_from_snapshots(snaps, "k", ["s"], days=days, rows=7 * asof.ROWS_PER_TASK)))
    assert ", 7), REPARTITION_BY_NUM" in p
    daily = asof_catalog.snapshots(spark, SF_SMALL, customers=asof.ROWS_PER_TASK)["cards"]
    assert f"RoundRobinPartitioning({asof_catalog.DAYS})" in _plan(daily)


@pytest.mark.parametrize("key", [1, None])
def test_key_twice_in_a_snapshot_fails(spark, key):
    day = dt.date(2024, 1, 1)
    snaps = spark.createDataFrame([(key, "x", day), (key, "x", day), (2, "y", day)], "k int, s string, day date")
    with pytest.raises(Exception):
        asof.scd2_from_snapshots(snaps, "k", ["s"]).collect()


def test_broadcasts_are_bounded_by_counted_rows(spark):
    """A dimension counted beyond the bound is shuffled, though its files are small enough for Spark's own broadcast."""
    dims = fx.cards(spark, SF_SMALL), fx.accounts(spark, SF_SMALL), fx.clients(spark, SF_SMALL)
    assert "BroadcastHashJoin" in _plan(dim_chain(*dims))
    many = chain.BROADCAST_MAX_ROWS + 1
    plan = _plan(dim_chain(*dims, known_rows=(many, many, many)))
    assert "Broadcast" not in plan and plan.count("SortMergeJoin") == 2
    # a chain row is about 120 bytes; a day's broadcasts all pass through the driver
    assert chain.BROADCAST_MAX_ROWS * 120 <= 10_000_000


def test_sketch_of_hot_cards_is_small(spark):
    """Every task of a load sends its sketch to the driver: below 0.3 MB however many cards it meets."""
    many = spark.range(400_000, numPartitions=1).select(F.col("id").cast("string").alias("card_num"))
    sketch = many.agg(F.expr(f"approx_top_k_accumulate(card_num, {sequence.TRACKED})").alias("s")).select(F.length("s.sketch")).first()[0]
    assert sketch < 300_000
