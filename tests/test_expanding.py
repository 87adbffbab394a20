"""Statistics of growing training sets against direct ones."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import expanding as X


def values(n=600, seed=1):
    rng = np.random.default_rng(seed)
    p = pd.DataFrame({"k": rng.choice(["a", "b", "hot", "hot", "hot"], n), "b": rng.integers(0, 30, n), "x": rng.normal(size=n), "y": rng.integers(0, 5, n).astype(float), "z": np.nan})
    p.loc[rng.random(n) < 0.2, "x"] = np.nan
    return p


def spark_frame(spark, p):
    d = spark.createDataFrame(p)
    return d.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("x", "y", "z")})


@pytest.mark.parametrize("n", [1, 7, 600, 3000])
def test_medians(spark, n):
    p = values(n)
    folds = [(k, int(f)) for k in p.k.unique() for f in (0, 1, 3, 12, 13, 40)]
    got = X.expanding_medians(spark_frame(spark, p), ["k"], "b", spark.createDataFrame(folds, "k string, f int"), "f", ["x", "y", "z"])
    assert got.schema["f"].dataType.simpleString() == "int"
    rows = {(r.k, r.f): r.medians for r in got.collect()}
    assert set(rows) == set(folds)
    for (k, f), m in rows.items():
        part = p[(p.k == k) & (p.b <= f)]
        assert m == [None if np.isnan(v) else v for v in (part.x.median(), part.y.median(), part.z.median())]


def test_medians_of_nothing(spark):
    none = spark_frame(spark, values(5)).where("b > 99")
    folds = spark.createDataFrame([("a", 1)], "k string, f int")
    assert X.expanding_medians(none, ["k"], "b", folds, "f", ["x"]).first().medians == [None]
    assert X.expanding_medians(none, ["k"], "b", folds.where("f > 1"), "f", ["x"]).count() == 0


def test_moments(spark):
    p = values(500, 3).fillna(0.5)
    got = X.block_moments(spark.createDataFrame(p).repartition(5), ["k"], "b", [F.col("x"), F.col("y"), F.lit(1.0)])
    sums = {(r.k, r.b, r.pair): r.s for r in got.collect()}
    for (k, b), g in p.groupby(["k", "b"]):
        z = np.column_stack([g.x, g.y, np.ones(len(g))])
        assert [sums[k, b, i] for i in range(6)] == pytest.approx((z.T @ z)[np.triu_indices(3)])


@pytest.mark.parametrize("n", [3, 800])
def test_modes(spark, n):
    rng = np.random.default_rng(5)
    p = pd.DataFrame({"k": rng.choice(["a", "b"], n), "b": rng.integers(0, 12, n), "c": rng.choice(["x", "y", "z", None], n), "d": rng.integers(0, 3, n).astype(str)})
    folds = [(k, f) for k in "ab" for f in (-1, 0, 4, 5, 20)]
    got = X.expanding_modes(spark.createDataFrame(p), ["k"], "b", spark.createDataFrame(folds, "k string, f int"), "f", ["c", "d"])
    want = set()
    for k, f in folds:
        for c in ("c", "d"):
            counts = p[(p.k == k) & (p.b <= f)][c].dropna().value_counts()
            want.add((k, f, c, min(counts[counts == counts.max()].index) if len(counts) else None))
    assert {tuple(r) for r in got.collect()} == want
