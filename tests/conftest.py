import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tallyhawk.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8)
    yield s
    s.stop()


def cut_every(tx, width, key="card_num", ts="trans_date"):
    """Every card taken for hot, its time cut into stretches of ``width`` (an interval); None cuts nothing."""
    from pyspark.sql import functions as F
    if width is None:
        return None
    return tx.groupBy(key).agg(F.expr(f"sequence(min({ts}), max({ts}), interval {width})").alias("borders"))
