"""Boosted folds against a plain version that looks at every split."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.plans import boosting as B
from tidemark.plans import walkforward as WF


def plain(x, y, test, p):
    """Trees by trying every threshold between values of every feature in every leaf."""
    fitted, out = np.full(len(y), y.mean()), np.full(len(test), y.mean())
    for _ in range(p.rounds):
        g = fitted - y
        leaves = [(np.arange(len(y)), np.arange(len(test)))]
        while len(leaves) < p.leaves:
            best = (1e-14, None)
            for i, (rows, _) in enumerate(leaves):
                for f in range(x.shape[1]):
                    v = np.unique(x[:, f])
                    for cut in (v[:-1] + v[1:]) / 2:
                        a = x[rows, f] <= cut
                        if min(a.sum(), (~a).sum()) < p.min_leaf:
                            continue
                        s, n = [g[rows][a].sum(), g[rows][~a].sum()], [a.sum() + p.l2, (~a).sum() + p.l2]
                        gain = s[0] ** 2 / n[0] + s[1] ** 2 / n[1] - sum(s) ** 2 / (len(rows) + p.l2)
                        if gain > best[0] * (1 + 1e-9):
                            best = gain, (i, f, cut)
            if best[1] is None:
                break
            i, f, cut = best[1]
            rows, seen = leaves[i]
            a, b = x[rows, f] <= cut, test[seen, f] <= cut
            leaves[i:i + 1] = [(rows[a], seen[b]), (rows[~a], seen[~b])]
        if len(leaves) == 1:
            break
        for rows, seen in leaves:
            v = -p.rate * g[rows].sum() / (len(rows) + p.l2)
            fitted[rows] += v
            out[seen] += v
    return out


def test_trees(spark):
    rng = np.random.default_rng(1)
    x = np.column_stack([rng.normal(size=90), rng.integers(0, 6, 90), np.full(90, 2.0)])
    y = np.sin(2 * x[:, 0]) + (x[:, 1] > 2) + rng.normal(scale=0.1, size=90)
    test = np.column_stack([rng.normal(size=40), rng.integers(-1, 8, 40), rng.normal(size=40)])
    p = B.Boosting(rounds=6, rate=0.3, leaves=5, min_leaf=7)
    assert B.boosted_predictions(x, y, test, p) == pytest.approx(plain(x, y, test, p), abs=1e-9)


def test_many_values_fall_into_bins():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4000, 1))
    edges = B.bin_edges(x[:, 0], 255)
    assert len(edges) == 254 and np.bincount(np.searchsorted(edges, x[:, 0])).max() < 20
    y = (x[:, 0] > 0.5) * 2.0
    got = B.boosted_predictions(x, y, np.array([[-1.0], [2.0]]))
    assert got == pytest.approx([0, 2], abs=0.15)
    assert B.boosted_predictions(np.ones((30, 2)), np.arange(30.0), np.ones((2, 2))) == pytest.approx([14.5, 14.5])


@pytest.mark.parametrize("embargo", [0, 3])
def test_folds(spark, embargo):
    """Each fold's predictions are those of a fit of its own training rows, filled with their medians."""
    rng, parts = np.random.default_rng(3), []
    for k in "ab":
        x = rng.normal(size=(120, 2))
        y = (x[:, 0] > 0) + 0.3 * x[:, 1] + rng.normal(scale=0.1, size=120)
        x[rng.random((120, 2)) < 0.1] = np.nan
        y[rng.random(120) < 0.1] = np.nan
        parts.append(pd.DataFrame({"k": k, "d": [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(120)], "x1": x[:, 0], "x2": x[:, 1], "y": y}))
    p, settings = pd.concat(parts, ignore_index=True), {"rounds": 4, "rate": 0.3, "leaves": 4, "min_leaf": 5}
    df = spark.createDataFrame(p)
    df = df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("x1", "x2", "y")}).repartition(3)
    got = WF.walk_forward_candidates(df, ["k"], "d", ["x1", "x2"], "y", {"boosted": settings}, 50, 10, embargo).toPandas()
    assert len(got) == len(p) and set(got.model) == {"boosted"}
    for k, g in p.groupby("k"):
        g, mine = g.sort_values("d").reset_index(drop=True), got[got.k == k].sort_values("d").prediction.to_numpy()
        labelled = [i for i in range(len(g)) if not np.isnan(g.y[i])]
        for i in range(len(g)):
            known = [j for j in labelled if j <= i - 1 - embargo]
            if len(known) < 50:
                assert np.isnan(mine[i])
                continue
            train = g.loc[labelled[:50 + (len(known) - 50) // 10 * 10]]
            med = train[["x1", "x2"]].median()
            want = B.boosted_predictions(train[["x1", "x2"]].fillna(med).to_numpy(), train.y.to_numpy(), g.loc[[i], ["x1", "x2"]].fillna(med).to_numpy(), B.Boosting(**settings))
            assert mine[i] == pytest.approx(want[0], abs=1e-9)


def test_no_fold(spark):
    df = spark.createDataFrame([("a", dt.date(2020, 1, 1), 1.0, 2.0)], "k string, d date, x1 double, y double")
    assert [r.prediction for r in WF.walk_forward_candidates(df, ["k"], "d", ["x1"], "y", {"boosted": {}}).collect()] == [None]
