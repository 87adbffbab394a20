"""Walk-forward fits and threshold tuning against direct computations."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.plans import backtest as B
from tidemark.plans import walkforward as WF


@pytest.fixture(scope="module")
def panel():
    rng = np.random.default_rng(11)
    parts = []
    for k in "ab":
        x = rng.normal(size=(160, 3))
        y = x @ [0.5, -0.2, 0.1] + rng.normal(scale=0.5, size=160)
        x[rng.random((160, 3)) < 0.1] = np.nan
        y[rng.random(160) < 0.1] = np.nan
        y[-5:] = np.nan
        parts.append(pd.DataFrame({"k": k, "d": [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(160)], "x1": x[:, 0], "x2": x[:, 1], "x3": x[:, 2], "y": y}))
    return pd.concat(parts, ignore_index=True)


def direct(g, min_rows, refit, alpha, embargo):
    cols = ["x1", "x2", "x3"]
    out = []
    g = g.sort_values("d").reset_index(drop=True)
    labelled = [i for i in range(len(g)) if not np.isnan(g.y[i])]
    for i in range(len(g)):
        known = [j for j in labelled if j <= i - 1 - embargo]
        if len(known) < min_rows:
            out.append(np.nan)
            continue
        train = g.loc[labelled[:min_rows + (len(known) - min_rows) // refit * refit]]
        med = train[cols].median()
        x = train[cols].fillna(med)
        mean, std = x.mean(), x.std(ddof=0)
        z = ((x - mean) / std).to_numpy()
        design = np.column_stack([np.ones(len(z)), z])
        penalty = np.eye(4) * alpha
        penalty[0, 0] = 0
        beta = np.linalg.solve(design.T @ design + penalty, design.T @ train.y.to_numpy())
        one = ((g.loc[i, cols].astype(float).fillna(med) - mean) / std).to_numpy()
        out.append(float(np.array([1.0, *one]) @ beta))
    return pd.Series(out, index=g.d)


@pytest.mark.parametrize("embargo", [0, 5])
def test_ridge_matches_row_by_row_fit(spark, panel, embargo):
    d = spark.createDataFrame(panel)
    d = d.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("x1", "x2", "x3", "y")})
    got = WF.walk_forward_ridge(d, ["k"], "d", ["x1", "x2", "x3"], "y", 40, 10, 1.0, embargo).toPandas()
    for k, g in panel.groupby("k"):
        mine = got[got.k == k].sort_values("d").predicted_forward_return.astype(float).to_numpy()
        want = direct(g, 40, 10, 1.0, embargo).to_numpy()
        assert (np.isnan(mine) == np.isnan(want)).all()
        assert np.allclose(mine, want, atol=1e-7, equal_nan=True)


def test_elastic_net_shrinks_to_zero(spark, panel):
    d = spark.createDataFrame(panel.dropna())
    got = WF.walk_forward_ridge(d, ["k"], "d", ["x1", "x2", "x3"], "y", 40, 20, l1=100.0, l2=0.1).where("coefficient_norm is not null")
    assert got.where("coefficient_norm > 1e-9").count() == 0 and got.count() > 0


def test_embargo_hides_unknown_labels(spark, panel):
    """Changing labels inside the embargo does not move a prediction."""
    last = panel.d.max()
    changed = panel.copy()
    changed.loc[(changed.d > last - dt.timedelta(days=15)), "y"] = 99.0
    day = last - dt.timedelta(days=10)
    run = lambda p: {r.k: r.predicted_forward_return for r in WF.walk_forward_ridge(spark.createDataFrame(p).withColumns(
        {c: F.when(~F.isnan(c), F.col(c)) for c in ("x1", "x2", "x3", "y")}), ["k"], "d", ["x1", "x2", "x3"], "y", 40, 10, 1.0, 5).where(F.col("d") == day).collect()}
    assert run(panel) == run(changed)


def brute_tuning(train, values):
    best = None
    for d in values:
        for u in values:
            pred = np.where((train.prob_down >= d) & (train.prob_down >= train.prob_up), "down", np.where((train.prob_up >= u) & (train.prob_up > train.prob_down), "up", "sideways"))
            rec, f1 = [], []
            for c in ("down", "sideways", "up"):
                tp, act, prd = ((pred == c) & (train.actual_label == c)).sum(), (train.actual_label == c).sum(), (pred == c).sum()
                if act:
                    rec.append(tp / act)
                f1.append(2 * tp / (act + prd) if act + prd else 0.0)
            row = (np.mean(rec), sum(f1) / 3, (pred == train.actual_label).mean())
            if best is None or tuple(np.round(row, 12)) > tuple(np.round(best[0], 12)):
                best = (row, d, u)
    return best[1], best[2]


def test_threshold_tuning_matches_grid_search(spark):
    rng = np.random.default_rng(2)
    n = 900
    w = rng.dirichlet([2, 2, 2], n)
    p = pd.DataFrame({"label_policy": "q", "model": "m", "market_scope": rng.choice(["A", "B"], n), "forecast_horizon": "5d", "test_year": rng.integers(2019, 2023, n),
                      "actual_label": rng.choice(["down", "sideways", "up"], n), "prob_down": w[:, 0], "prob_sideways": w[:, 1], "prob_up": w[:, 2]})
    values = [0.34, 0.38, 0.42, 0.5]
    got = {(r.market_scope, r.test_year): (r.down_threshold, r.up_threshold) for r in B.tune_thresholds(spark.createDataFrame(p), values).collect()}
    want = {(s, y): brute_tuning(g[g.test_year < y], values) for s, g in p.groupby("market_scope") for y in sorted(g.test_year.unique()) if (g.test_year < y).any()}
    assert got == want


def test_backtest_first_day_pays_for_entry(spark):
    rows = [("m", "K", dt.date(2024, 1, d), "up", 1.0, 0.0) for d in (1, 2)]
    d = spark.createDataFrame(rows, "model string, market_scope string, asof_date date, predicted_direction string, exposure double, low_confidence double")
    r = spark.createDataFrame([(dt.date(2024, 1, 1), "K", 0.10), (dt.date(2024, 1, 2), "K", -0.05)], "asof_date date, market_scope string, next_return double")
    trades, card = B.run_backtest(d, r, 10.0, ["model", "market_scope"])
    assert [round(t.strategy_return, 6) for t in trades.orderBy("asof_date").collect()] == [0.099, -0.05]
    c = card.collect()[0]
    assert c.cumulative_return == pytest.approx(1.099 * 0.95 - 1) and c.mdd == pytest.approx(-0.05) and c.total_turnover == 1.0


def test_handoff_quality(spark):
    from tidemark.plans.handoff import signal_quality

    s = spark.createDataFrame([(dt.date(2024, 1, 2), "KOSPI", "5d"), (dt.date(2024, 1, 2), "ALL", "5d")], "asof_date date, market_scope string, forecast_horizon string")
    src = spark.createDataFrame([("KOSPI", dt.date(2024, 1, 1))], "market_scope string, latest_date date")
    out = {(r.kind, r.check_name, r.detail) for r in signal_quality(s, F.lit("2024-02-01").cast("date"), 7, ["KOSPI"], ["5d", "20d"], src).collect()}
    assert out == {("error", "stale_signal", "2024-01-02"), ("error", "missing_market_horizon", "KOSPI:20d"), ("error", "non_investable_scope", "5d"),
                   ("warning", "daily_source_older_than_signal", "KOSPI:2024-01-01")}
