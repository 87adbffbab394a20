"""Point-in-time joins against brute force, with one key holding most rows."""

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tidemark.operators import asof as A


def stamps(rng, n):
    return [dt.datetime(2024, 1, 1) + dt.timedelta(minutes=int(m)) for m in rng.integers(0, 60 * 24 * 90, n)]


def test_backward_asof_matches_merge_asof(spark):
    rng = np.random.default_rng(3)
    keys = lambda n: np.where(rng.random(n) < 0.7, "hot", rng.choice(list("xyz"), n))
    left = pd.DataFrame({"k": keys(800), "t": stamps(rng, 800), "id": range(800)})
    right = pd.DataFrame({"k": keys(300), "t": stamps(rng, 300), "v": rng.normal(size=300)}).drop_duplicates(["k", "t"])
    ntz = lambda p: spark.createDataFrame(p).withColumn("t", F.col("t").cast("timestamp_ntz"))
    want = pd.merge_asof(left.sort_values("t"), right.sort_values("t"), on="t", by="k").set_index("id").v
    for unit in ("day", "month"):
        got = A.asof_backward(ntz(left), ntz(right), ["k"], "t", "t", ["v"], bucket_unit=unit).toPandas().set_index("id").v
        assert len(got) == 800
        assert np.allclose(got.sort_index().astype(float), want.sort_index(), equal_nan=True)


def test_backward_asof_keeps_null_values_of_the_match(spark):
    left = spark.createDataFrame([("a", "2024-01-05")], "k string, d string").withColumn("d", F.col("d").cast("timestamp_ntz"))
    right = spark.createDataFrame([("a", "2024-01-01", 1.0), ("a", "2024-01-04", None)], "k string, t string, v double").withColumn("t", F.col("t").cast("timestamp_ntz"))
    assert A.asof_backward(left, right, ["k"], "d", "t", ["v"]).collect()[0].v is None


def dates(spark, *days):
    return spark.createDataFrame([(dt.date.fromisoformat(d),) for d in days], "asof_date date")


def test_forward_asof(spark):
    spine = dates(spark, "2024-01-03", "2024-01-05", "2024-01-09")
    events = spark.createDataFrame([("early", dt.date(2020, 1, 1)), ("same", dt.date(2024, 1, 4)), ("gap", dt.date(2024, 1, 5)), ("late", dt.date(2024, 1, 9))], "n string, d date")
    got = {r.n: r.event_date for r in A.asof_forward(events, spine, "d", 1).collect()}
    assert got == {"early": dt.date(2024, 1, 3), "same": dt.date(2024, 1, 5), "gap": dt.date(2024, 1, 9)}


def test_monthly_release_lag(spark):
    spine = dates(spark, "2024-01-21", "2024-01-22", "2024-02-22", "2024-03-30")
    monthly = spark.createDataFrame([("s", dt.date(2024, 1, 1), 1.0), ("s", dt.date(2024, 2, 1), 2.0)], "series_id string, d date, value double")
    got = {r.asof_date.isoformat(): r.value for r in A.monthly_asof(spine, monthly, "series_id", "d", ["value"]).collect()}
    assert got == {"2024-01-22": 1.0, "2024-02-22": 2.0, "2024-03-30": 2.0}


def test_carry_forward_and_pit_shift(spark):
    d = spark.createDataFrame([("s", dt.date(2024, 1, 5), 1.0), ("s", dt.date(2024, 1, 8), 2.0)], "k string, d date, v double")
    rows = A.carry_forward_days(d, ["k"], "d", ["v"], F.lit("2024-01-09").cast("date")).orderBy("d").collect()
    assert [(r.d.day, r.v, r.point_type) for r in rows] == [(5, 1.0, "observed"), (6, 1.0, "carry_forward"), (7, 1.0, "carry_forward"), (8, 2.0, "observed"), (9, 2.0, "carry_forward")]
    weekend = spark.createDataFrame([(dt.date(2024, 1, 5), 1.0), (dt.date(2024, 1, 6), 2.0)], "src date, v double")
    shifted = A.pit_shift(weekend, "src", F.lit("2024-01-01").cast("date"), F.lit("2024-02-01").cast("date")).collect()
    assert [(r.asof_date, r.v) for r in shifted] == [(dt.date(2024, 1, 8), 2.0)]


def test_session_snapshot_tiers(spark):
    ts = lambda *xs: spark.createDataFrame([(x,) for x in xs], "w string").select(F.col("w").cast("timestamp_ntz").alias("w"))
    snaps = spark.createDataFrame([("2024-01-02 10:00", "live", 1.0), ("2024-01-03 09:00", "fallback_prev_close", 2.0)], "t string, status string, v double").withColumn("t", F.col("t").cast("timestamp_ntz"))
    want = ts("2024-01-02 09:00", "2024-01-02 11:00", "2024-01-03 12:00", "2024-01-04 12:00", "2024-01-20 12:00")
    out = {r.w.isoformat()[5:13]: (r.v, r.previous_session) for r in A.latest_session_snapshot(want, snaps, "w", "t", "status", ["v"]).collect()}
    assert out == {"01-02T09": (None, None), "01-02T11": (1.0, 0), "01-03T12": (2.0, 0), "01-04T12": (1.0, 1), "01-20T12": (None, None)}
