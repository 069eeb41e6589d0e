"""Windows cut into stretches equal plain windows on the driver data."""

import pytest

from tallyhawk.operators import fraud, sequence
from tallyhawk.plans import fixtures as fx
from tallyhawk.schemas import REFERENCE, STRICT
from conftest import SF_ORACLE, cut_every


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("semantics", [REFERENCE, STRICT])
def test_city_hops_split_equals_plain(spark, semantics):
    tx, term = fx.tx(spark, SF_ORACLE), fx.terminals(spark, SF_ORACLE)
    plain = _rows(fraud.city_hops(tx, term, semantics=semantics, hot=None))
    for split in ["10 minutes", "1 hour"]:
        assert _rows(fraud.city_hops(tx, term, semantics=semantics, hot=cut_every(tx, split))) == plain


@pytest.mark.parametrize("span,per_day", [("1 day", True), ("3 days", False), ("6 hours", True)])
def test_amount_probes_split_equals_plain(spark, span, per_day):
    tx = fx.tx(spark, SF_ORACLE)
    plain = _rows(fraud.amount_probes(tx, max_span=span, per_day=per_day, hot=None))
    for split in ["30 minutes", "2 hours"]:
        assert _rows(fraud.amount_probes(tx, max_span=span, per_day=per_day, hot=cut_every(tx, split))) == plain


def test_with_next_split_equals_plain(spark):
    tx = fx.tx(spark, SF_ORACLE).select("trans_id", "card_num", "trans_day", "trans_date", "terminal")
    part, order = ["card_num", "trans_day"], ["trans_date", "trans_id"]
    plain = _rows(sequence.with_next(tx, part, order, ["trans_date", "terminal"]))
    rows = sequence.chunked(tx, cut_every(tx, "5 minutes"), "card_num", "trans_date")
    cut = sequence.with_next(rows, part, order, ["trans_date", "terminal"])
    assert _rows(cut.select(*tx.columns, "next_trans_date", "next_terminal")) == plain


def _hot_card_tx(spark):
    """A third of all operations moved onto one card (derived from the driver events)."""
    from pyspark.sql import functions as F
    tx = fx.tx(spark, SF_ORACLE)
    return tx.withColumn("card_num", F.when(F.col("trans_id") % 3 == 0, F.lit(-1)).otherwise(F.col("card_num")))


def test_hot_card_is_found_and_results_equal(spark):
    tx, term = _hot_card_tx(spark), fx.terminals(spark, SF_ORACLE)
    hot = sequence.find_hot(tx, "card_num", "trans_date", hot_rows=300)
    assert [r.card_num for r in hot.collect()] == [-1]
    for sem in (REFERENCE, STRICT):
        assert _rows(fraud.city_hops(tx, term, semantics=sem, hot_rows=300)) == \
            _rows(fraud.city_hops(tx, term, semantics=sem, hot=None))
    assert _rows(fraud.amount_probes(tx, max_span="1 day", hot_rows=300)) == \
        _rows(fraud.amount_probes(tx, max_span="1 day", hot=None))


def test_a_hot_card_hour_is_cut_into_even_stretches(spark):
    """A third of all operations in one hour of one card: no group of the windows holds much more than it should."""
    from pyspark.sql import functions as F
    tx = fx.tx(spark, SF_ORACLE)
    third = F.col("trans_id") % 3 == 0
    moment = F.make_dt_interval(hours=F.lit(12), secs=(F.col("trans_id") % 3600).cast("decimal(18,6)"))
    tx = tx.withColumn("card_num", F.when(third, F.lit(-1)).otherwise(F.col("card_num"))) \
        .withColumn("trans_date", F.when(third, (F.lit("2024-01-10").cast("timestamp_ntz") + moment)).otherwise(F.col("trans_date"))) \
        .withColumn("trans_day", F.to_date("trans_date"))
    hot = sequence.find_hot(tx, "card_num", "trans_date", hot_rows=200)
    rows = sequence.chunked(tx, hot, "card_num", "trans_date").filter("card_num = -1")
    sizes = [r["count"] for r in rows.groupBy("card_num", "trans_day", sequence._CHUNK).count().collect()]
    assert sum(sizes) > 3000 and len(sizes) > 10 and max(sizes) < 2.5 * 200
    assert _rows(fraud.amount_probes(tx, max_span="1 day", hot=hot)) == _rows(fraud.amount_probes(tx, max_span="1 day", hot=None))


def test_no_hot_card_leaves_the_plain_plan(spark):
    """Without a hot card the rules read their input once and move it once."""
    tx = fx.tx(spark, SF_ORACLE)
    assert sequence.find_hot(tx, "card_num", "trans_date") is None
    plan = fraud.amount_probes(tx)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
