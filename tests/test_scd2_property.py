"""Random snapshot sequences: the Spark fold equals a row-by-row simulation of the daily steps."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from tallyhawk.plans import history
from tallyhawk.schemas import REFERENCE, STRICT

OPEN = dt.date(2999, 1, 1)
START = dt.date(1900, 1, 1)
SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("s", T.StringType())])

snapshot = st.dictionaries(st.sampled_from("abcd"), st.sampled_from(["x", "y", None]), max_size=4)
sequences = st.lists(snapshot, min_size=1, max_size=4)


def simulate(snaps, days, semantics, staging):
    """Plain-Python model of one load per day (rows: [k, s, from, to, deleted])."""
    hist, wm = [], START
    for day, snap in zip(days, snaps):
        live = {r[0]: r for r in hist if r[3] == OPEN and not r[4]}
        staged = {}
        for k, s in snap.items():
            if staging == history.SNAPSHOT:
                o = live.get(k)
                upd = o[2] if (o is not None and o[1] == s) else day
                if upd > wm:
                    staged[k] = (s, upd)
            else:
                staged[k] = (s, day)
        prev = day - dt.timedelta(days=1)
        if semantics == REFERENCE:
            keys = {r[0] for r in hist}
            new = [(k, s) for k, (s, _) in staged.items() if k not in keys]
            changed = [(k, s) for k, (s, _) in staged.items() if any(r[0] == k and r[1] != s for r in hist)]
            for r in hist:
                if r[0] in dict(changed) and r[3] == OPEN:
                    r[3] = prev
            hist += [[k, s, day, OPEN, False] for k, s in new + changed]
            for r in hist:
                if r[0] not in snap:
                    r[3], r[4] = prev, True
        else:
            adds = []
            for k, (s, _) in staged.items():
                o = live.get(k)
                if o is None:
                    adds.append([k, s, day, OPEN, False])
                elif o[1] != s:
                    o[3] = prev
                    adds.append([k, s, day, OPEN, False])
            for k, o in live.items():
                if k not in snap:
                    o[3], o[4] = prev, True
            hist += adds
        if staged:
            wm = max(u for _, u in staged.values())
    return sorted(map(tuple, hist), key=repr)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seq=sequences, semantics=st.sampled_from([REFERENCE, STRICT]),
       staging=st.sampled_from([history.SNAPSHOT, history.RESTAGE_ALL]))
def test_fold_matches_simulation(spark, seq, semantics, staging):
    days = [dt.date(2021, 3, 1) + dt.timedelta(days=i) for i in range(len(seq))]
    dfs = [spark.createDataFrame(sorted(s.items()), SCHEMA) for s in seq]
    got = history.fold_days(spark, days, dfs, "k", ["s"], staging, semantics)
    rows = sorted(((r.k, r.s, r.effective_from, r.effective_to, r.deleted_flg) for r in got.collect()), key=repr)
    assert rows == simulate(seq, days, semantics, staging)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seq=sequences)
def test_one_job_history_equals_strict_fold(spark, seq):
    """E1 (gaps and islands over all snapshots) equals the strict day-by-day fold."""
    from pyspark.sql import functions as F
    from tallyhawk.operators.asof import scd2_from_snapshots
    days = [dt.date(2021, 3, 1) + dt.timedelta(days=i) for i in range(len(seq))]
    dfs = [spark.createDataFrame(sorted(s.items()), SCHEMA).withColumn("day", F.lit(d)) for s, d in zip(seq, days)]
    allsnaps = dfs[0]
    for d in dfs[1:]:
        allsnaps = allsnaps.unionByName(d)
    cal = spark.createDataFrame([(d,) for d in days], "day date")
    got = scd2_from_snapshots(allsnaps, "k", ["s"], days=cal)
    rows = sorted(((r.k, r.s, r.effective_from, r.effective_to, r.deleted_flg) for r in got.collect()), key=repr)
    assert rows == simulate(seq, days, STRICT, history.SNAPSHOT)
