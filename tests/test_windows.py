"""Window operators against pandas on random series with gaps."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import windows as W
from tidemark.operators.windows import Axis

AX = Axis.of("k", "i")


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(7)
    parts = []
    for k in "ab":
        x = 100 + np.cumsum(rng.normal(size=400))
        x[rng.random(400) < 0.05] = np.nan
        x[100:150] = 50.0
        parts.append(pd.DataFrame({"k": k, "i": range(400), "x": x, "y": rng.normal(size=400)}))
    return pd.concat(parts, ignore_index=True)


@pytest.fixture(scope="module")
def df(spark, frame):
    d = spark.createDataFrame(frame)
    return d.withColumn("x", F.when(~F.isnan("x"), F.col("x")))


def check(df, expected, column, tol=1e-7):
    got = df.orderBy("k", "i").toPandas()[column].astype(float).to_numpy()
    want = expected.to_numpy(dtype=float)
    assert (np.isnan(got) == np.isnan(want)).all()
    assert np.allclose(got, want, atol=tol, equal_nan=True)


def by(frame, fn):
    return pd.concat([fn(g) for _, g in frame.groupby("k")])


@pytest.mark.parametrize("n, population", [(20, True), (60, False), (252, True)])
def test_running_moments(df, frame, n, population):
    out = W.with_running_moments(df, AX, "x", n, "cnt", "m", "s", population)
    check(out, by(frame, lambda g: g.x.rolling(n, min_periods=1).mean()), "m")
    want = by(frame, lambda g: g.x.rolling(n, min_periods=1 if population else 2).std(ddof=0 if population else 1))
    check(out, want, "s", 1e-6)


def test_constant_window_has_no_zscore(df):
    out = W.with_zscore(df, AX, "x", "z", 20, 10).where("k = 'a' and i between 125 and 145 and x is not null")
    assert out.where("z is not null").count() == 0 and out.count() > 10


def test_zscore_matches_direct_form(df):
    a = W.with_zscore(df, AX, "x", "z", 60, 20).withColumn("w", W.zscore(AX, "x", 60, 20))
    bad = a.where("(z is null) != (w is null) or abs(z - w) > 1e-6")
    assert bad.count() == 0


def test_percentile_rank(df, frame):
    out = df.withColumn("p", W.percentile_rank(AX, "x", 60, 20))
    check(out, by(frame, lambda g: g.x.rolling(60, min_periods=20).rank(pct=True)), "p")


def test_rolling_mdd(df, frame):
    def mdd(g):
        peak = g.x.rolling(60, min_periods=20).max()
        return (g.x / peak - 1).rolling(60, min_periods=20).min()

    check(W.with_rolling_mdd(df, AX, "x", 60, "m"), by(frame, mdd), "m")


def test_rolling_corr(df, frame):
    check(df.withColumn("c", W.rolling_corr(AX, "x", "y", 60)), by(frame, lambda g: g.x.rolling(60, min_periods=30).corr(g.y)), "c", 1e-6)


def test_streak_distance_and_change(spark):
    rows = [("a", i, f) for i, f in enumerate([1, 1, 0, 1, 1, 1, 0])]
    d = spark.createDataFrame(rows, "k string, i int, f int")
    s = W.with_streak(d, AX, F.col("f") == 1, "streak").orderBy("i").collect()
    assert [r.streak for r in s] == [1, 2, 0, 1, 2, 3, 0]
    e = W.with_event_distance(d.withColumn("z", (F.col("f") == 0).cast("int")), AX, "z", "since", "until").orderBy("i").collect()
    assert [(r.since, r["until"]) for r in e] == [(None, 2), (None, 1), (0, 0), (1, 3), (2, 2), (3, 1), (0, 0)]
    c = W.with_days_since_change(d.withColumn("z", (F.col("f") == 0).cast("int")), AX, "z", "days").orderBy("i").collect()
    assert [r.days for r in c] == [0, 1, 0, 1, 2, 3, 0]


def test_time_based_transitions(spark):
    rows = [("kr", f"2024-01-{d:02d} 00:00:00", s) for d, s in [(1, "a"), (2, "b"), (8, "a"), (9, "a"), (30, "b")]]
    d = spark.createDataFrame(rows, "m string, t string, s string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    out = {r.t.day: r for r in W.with_transition_stats(d, ["m"], "t", "s").collect()}
    assert (out[8].transitions_5d, out[8].transitions_20d) == (0, 2)
    assert (out[9].transitions_5d, out[9].state_hours) == (0, 24.0)
    assert out[30].transitions_20d == 0
    assert out[9].stability == pytest.approx(0.4 + 0.6 * 0.8)


def test_cross_section(spark):
    rows = [("d1", "a", 1.0, 1.0), ("d1", "b", 3.0, 3.0), ("d2", "a", 2.0, 5.0), ("d3", "a", 4.0, 1.0), ("d3", "b", 4.0, 1.0)]
    d = spark.createDataFrame(rows, "d string, k string, v double, w double")
    out = {(r.d, r.k): (r.cross_z, r.share) for r in W.with_cross_section(d, "d", "v", "w").collect()}
    assert out[("d1", "a")] == (-1.0, 0.25) and out[("d2", "a")] == (0.0, 1.0) and out[("d3", "b")] == (0.0, 0.5)


def test_no_look_ahead(sample):
    """Rows of a shortened input equal the same rows of the full input."""
    from tidemark.plans.context import proxy_features

    full = proxy_features(sample.scope_prices, "market_scope")
    cut = proxy_features(sample.scope_prices.where("date < '1999-01-01'"), "market_scope")
    assert cut.exceptAll(full.where("date < '1999-01-01'")).count() == 0
