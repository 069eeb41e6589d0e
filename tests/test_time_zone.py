"""Durations on timestamp_ntz are wall-clock, whatever the session time zone."""

import datetime as dt


from tallyhawk.functions.intervals import epoch_micros, micros_between


def test_ntz_durations_ignore_dst(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 1, 30), dt.datetime(2024, 3, 10, 3, 30))],
                                   "a timestamp_ntz, b timestamp_ntz")
        r = df.select(micros_between("a", "b").alias("d"), epoch_micros("a").alias("e")).first()
        assert r.d == 2 * 3600 * 1_000_000
        assert r.e == int((dt.datetime(2024, 3, 10, 1, 30) - dt.datetime(1970, 1, 1)).total_seconds()) * 1_000_000
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
