"""Logistic folds fitted together against one fit each, by Spark ML and by plain loops."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tidemark.plans import foldmodels as FM
from tidemark.plans import models as MD

NAMES = ["x1", "x2", "x3"]
CLASSES = ["down", "sideways", "up"]


def panel(n=900, classes=CLASSES, seed=4):
    rng, parts = np.random.default_rng(seed), []
    for k in ("a", "b"):
        x = rng.normal(size=(n, 3)) * [1, 0.01, 30] + [0, 0.5, -3]
        z = (x - [0, 0.5, -3]) @ np.array([[0.8, -0.4, 0.1], [20, 0, -30], [0.02, 0.03, -0.01]])[:, np.arange(len(classes)) % 3] + rng.gumbel(size=(n, len(classes)))
        y = np.array(classes, object)[z.argmax(1)]
        y[rng.random(n) < 0.1] = None
        x[rng.random((n, 3)) < 0.1] = np.nan
        parts.append(pd.DataFrame({"k": k, "d": [dt.date(2018, 1, 1) + dt.timedelta(days=2 * i) for i in range(n)], "x1": x[:, 0], "x2": x[:, 1], "x3": x[:, 2], "y": y}))
    return pd.concat(parts, ignore_index=True)


def frame(spark, p):
    d = spark.createDataFrame(p, "k string, d date, x1 double, x2 double, x3 double, y string")
    return d.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in NAMES}).repartition(3)


def prepared(train, rows):
    med = train[NAMES].median()
    x = train[NAMES].fillna(med)
    return [((p[NAMES].fillna(med) - x.mean()) / x.std(ddof=0)).to_numpy() for p in (train, rows)]


def ml(spark, x, y, classes, penalty):
    weight = {c: len(y) / (len(classes) * (y == c).sum()) for c in classes}
    rows = spark.createDataFrame([(*map(float, r), float(classes.index(c)), float(weight[c])) for r, c in zip(x, y, strict=True)], [*NAMES, "label", "w"])
    rows = VectorAssembler(inputCols=NAMES, outputCol="features").transform(rows)
    return LogisticRegression(family="multinomial", weightCol="w", regParam=penalty, standardization=False, tol=1e-13, maxIter=2000).fit(rows)


def softmax(z):
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


@pytest.fixture(scope="module")
def walked(spark):
    p = panel()
    out, rows = MD.walk_forward_logistic(frame(spark, p), ["k"], "d", NAMES, "y", 2020, 200)
    return p, out.cache(), rows.cache()


def test_walk_forward_equals_spark_ml(spark, walked):
    p, out, rows = walked
    got = out.toPandas()
    assert set(got.test_year) == {2020, 2021, 2022}
    keep = p[p.y.notna() & p[NAMES].notna().any(axis=1)]
    for (k, year), g in got.groupby(["k", "test_year"]):
        mine = keep[keep.k == k].sort_values("d")
        years = mine.d.map(lambda d: d.year)
        train, test = mine[years < year], mine[years == year]
        x, z = prepared(train, test)
        model = ml(spark, x, train.y.to_numpy(), CLASSES, 1 / len(train))
        want = softmax(z @ model.coefficientMatrix.toArray().T + model.interceptVector.toArray())
        assert list(g.sort_values("d").actual_label) == list(test.y)
        assert np.abs(g.sort_values("d")[MD.prob_names(CLASSES)].to_numpy() - want).max() < 1e-6
        own = {(r["class"], r.feature): r.coefficient for r in rows.where((F.col("k") == k) & (F.col("test_year") == year)).collect()}
        assert [own[c, f] for c in CLASSES for f in NAMES] == pytest.approx(model.coefficientMatrix.toArray().ravel().tolist(), abs=1e-5)


def test_packs_and_unused_features(spark, monkeypatch, walked):
    """Small packs give the same; a feature that is constant or too rare has no coefficient."""
    p, out, _ = walked
    monkeypatch.setattr(FM, "PACK", 100)
    df = frame(spark, p).withColumns({"same": F.lit(2.5), "rare": F.when(F.dayofyear("d") == 5, F.col("x1")), "never": F.lit(None).cast("double")})
    again, rows = MD.walk_forward_logistic(df, ["k"], "d", [*NAMES, "same", "rare", "never"], "y", 2020, 200)
    both = out.alias("a").join(again.alias("b"), ["k", "d"])
    assert both.count() == out.count()
    assert both.agg(F.max(F.abs(F.col("a.prob_up") - F.col("b.prob_up")))).first()[0] < 1e-8
    assert {r.feature for r in rows.select("feature").distinct().collect()} == set(NAMES)


def sigmoid(scores, hit):
    """Slope and offset by plain Newton steps on the softened targets."""
    t = np.where(hit, (hit.sum() + 1) / (hit.sum() + 2), 1 / ((~hit).sum() + 2))
    a = np.zeros(2)
    x = np.column_stack([scores, np.ones(len(scores))])
    for _ in range(200):
        q = 1 / (1 + np.exp(-x @ a))
        a = a - np.linalg.solve(x.T @ (x * (q * (1 - q))[:, None]), x.T @ (q - t)) * 0.8
    return a


def test_calibration_of_growing_heads(spark):
    p = panel(700)
    out, _ = MD.walk_forward_logistic(frame(spark, p), ["k"], "d", NAMES, "y", 2020, 200, parts=3)
    got = out.toPandas()
    keep = p[p.y.notna() & p[NAMES].notna().any(axis=1)]
    for (k, year), g in got.groupby(["k", "test_year"]):
        mine = keep[keep.k == k].sort_values("d")
        years = mine.d.map(lambda d: d.year)
        train, test = mine[years < year], mine[years == year]
        size, mean = len(train) // 4, 0
        for i in range(3):
            lo = len(train) - (3 - i) * size
            head, held = train[:lo], train[lo:lo + size]
            x, z = prepared(head, pd.concat([held, test]))
            model = ml(spark, x, head.y.to_numpy(), CLASSES, 1 / len(head))
            s = z @ model.coefficientMatrix.toArray().T
            b = model.interceptVector.toArray()
            s = s + b - b.mean()
            prob = np.column_stack([1 / (1 + np.exp(-(a[0] * s[size:, c] + a[1]))) for c, name in enumerate(CLASSES) for a in [sigmoid(s[:size, c], (held.y == name).to_numpy())]])
            mean = mean + prob / prob.sum(1, keepdims=True) / 3
        assert np.abs(g.sort_values("d")[MD.prob_names(CLASSES)].to_numpy() - mean).max() < 1e-5


def test_five_class_holdout(spark):
    five = ["c0", "c1", "c2", "c3", "c4"]
    p = panel(500, five, 6)
    got = MD.holdout_direction(frame(spark, p), ["k"], "d", NAMES, "y", five).toPandas()
    keep = p[p[NAMES].notna().any(axis=1)]
    for k, g in got.groupby("k"):
        rows = keep[keep.k == k].sort_values("d")
        mine = rows[rows.y.notna()]
        cut = min(max(int(len(mine) * 0.8), len(mine) - 500), len(mine) - 50)
        x, z = prepared(mine[:cut], pd.concat([mine[cut:], rows[-1:]]))
        model = ml(spark, x, mine.y[:cut].to_numpy(), five, 1 / cut)
        want = softmax(z @ model.coefficientMatrix.toArray().T + model.interceptVector.toArray())
        assert np.abs(g.sort_values(["latest", "d"])[MD.prob_names(five)].to_numpy() - want).max() < 1e-6


def test_no_folds(spark):
    p = panel(60)
    out, rows = MD.walk_forward_logistic(frame(spark, p), ["k"], "d", NAMES, "y", 2020, 200)
    assert out.count() == 0 and rows.count() == 0
    out, _ = MD.walk_forward_logistic(frame(spark, p).where("k = 'z'"), ["k"], "d", NAMES, "y", 2020, 200, parts=3)
    assert out.count() == 0
    assert MD.holdout_direction(frame(spark, p).where("k = 'z'"), ["k"], "d", NAMES, "y").count() == 0
