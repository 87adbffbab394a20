"""Order statistics without whole groups in one task, and the class metrics."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import metrics as M
from tidemark.operators import quality as Q
from tidemark.operators import relational as R


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(5)
    p = pd.DataFrame({"k": np.where(rng.random(6000) < 0.8, "hot", rng.choice(list("abc"), 6000)), "x": np.round(rng.lognormal(0, 3, 6000), 2), "y": rng.integers(0, 40, 6000).astype(float)})
    return p, spark.createDataFrame(p)


def test_exact_quantiles(skewed):
    p, d = skewed
    probs = {"a": 0.0, "b": 0.2, "c": 0.5, "d": 0.77, "e": 1.0}
    for bounded in (False, True):
        got = M.exact_quantiles(d, ["k"], "x", probs, bounded).toPandas().set_index("k")
        for name, q in probs.items():
            assert np.allclose(got[name].sort_index(), p.groupby("k").x.quantile(q).sort_index())


def test_average_ranks_and_spearman(skewed):
    p, d = skewed
    got = M.with_average_rank(d, ["k"], "y", "r").toPandas().sort_values(["k", "y"])
    want = p.assign(r=p.groupby("k").y.rank()).sort_values(["k", "y"])
    assert np.allclose(got.r.to_numpy(), want.r.to_numpy())
    rho = M.spearman(d, ["k"], "x", "y").toPandas().set_index("k").spearman.sort_index()
    want_rho = p.groupby("k").apply(lambda g: g.x.rank().corr(g.y.rank()), include_groups=False).sort_index()
    assert np.allclose(rho, want_rho)


def test_class_metrics(spark):
    rows = [("up", "up"), ("up", "down"), ("down", "down"), ("down", "down")]
    r = M.classification_scorecard(spark.createDataFrame(rows, "a string, p string").withColumn("k", F.lit(1)), ["k"], "a", "p").collect()[0]
    assert (r.accuracy, r.balanced_accuracy, r.majority_baseline) == (0.75, 0.75, 0.5)
    assert r.macro_f1 == pytest.approx((0.8 + 0.0 + 2 / 3) / 3)


def test_grouping_totals_and_priority_union(spark):
    d = spark.createDataFrame([("d", "K", "f", 1.0), ("d", "Q", "f", 2.0)], "d string, s string, i string, v double")
    got = {r.s: r.v for r in M.grouping_totals(d, "d", "s", "i", "v").collect()}
    assert got == {"K": 1.0, "Q": 2.0, "ALL": 3.0}
    a, b = d.where("s = 'K'").withColumn("v", F.lit(9.0)), d
    assert {r.s: r.v for r in R.union_by_priority([(a, 0), (b, 1)], ["s"]).collect()} == {"K": 9.0, "Q": 2.0}


def test_contract_checks(spark):
    d = spark.createDataFrame([("up", "KOSPI", "5d", 0.2, 0.3, 0.5, 0.5), ("x", "ALL", "5d", 0.2, 0.3, 0.6, None)],
                              "predicted_direction string, market_scope string, forecast_horizon string, prob_down double, prob_sideways double, prob_up double, confidence double")
    report = {r.check_name: r.failed_rows for r in Q.check(d, Q.signal_constraints(["down", "sideways", "up"], ["KOSPI"], ["5d"]), ["forecast_horizon"]).collect()}
    assert report == {"direction_enum": 1, "scope_enum": 1, "horizon_enum": 0, "probability_range": 0, "probability_sum": 1, "confidence_range": 1, "unique_key": 1}
