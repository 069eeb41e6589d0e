"""Random sequences: windows cut into stretches equal plain windows for rules 3 and 4."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallyhawk.operators import fraud
from tallyhawk.schemas import REFERENCE, STRICT
from conftest import cut_every

BASE = dt.datetime(2021, 3, 1, 9, 0)
TERMS = [("M", "Moscow"), ("S", "SPB"), ("K", "Kazan"), ("X", "Omsk")]

ops = st.lists(st.tuples(st.sampled_from(["a", "b"]),            # card
                         st.integers(min_value=0, max_value=240),  # minute offset
                         st.sampled_from(["M", "S", "K", "X"]),    # terminal (X is closed)
                         st.sampled_from(["REJECT", "SUCCESS"]),
                         st.integers(min_value=1, max_value=5)),   # amount
               min_size=1, max_size=40)


def _frames(spark, rows):
    tx = spark.createDataFrame(
        [(f"{i:04d}", BASE + dt.timedelta(minutes=m), (BASE + dt.timedelta(minutes=m)).date(), float(a), c, r, t)
         for i, (c, m, t, r, a) in enumerate(rows)],
        "trans_id string, trans_date timestamp_ntz, trans_day date, amt double, card_num string, "
        "oper_result string, terminal string")
    term = spark.createDataFrame(
        [(t, city, dt.date(2021, 1, 1), dt.date(2999, 1, 1) if t != "X" else dt.date(2021, 2, 1), t == "X")
         for t, city in TERMS],
        "terminal_id string, terminal_city string, effective_from date, effective_to date, deleted_flg boolean")
    return tx, term


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ops, split=st.sampled_from(["7 minutes", "13 minutes", "1 hour"]),
       semantics=st.sampled_from([REFERENCE, STRICT]))
def test_city_hops_split_equals_plain(spark, rows, split, semantics):
    tx, term = _frames(spark, rows)
    plain = _rows(fraud.city_hops(tx, term, max_gap="10 minutes", semantics=semantics, hot=None))
    assert _rows(fraud.city_hops(tx, term, max_gap="10 minutes", semantics=semantics, hot=cut_every(tx, split))) == plain


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ops, split=st.sampled_from(["5 minutes", "11 minutes", "1 hour"]),
       per_day=st.booleans())
def test_amount_probes_split_equals_plain(spark, rows, split, per_day):
    tx, _ = _frames(spark, rows)
    plain = _rows(fraud.amount_probes(tx, max_span="9 minutes", per_day=per_day, hot=None))
    assert _rows(fraud.amount_probes(tx, max_span="9 minutes", per_day=per_day, hot=cut_every(tx, split))) == plain
