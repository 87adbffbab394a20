"""Axis research datasets and diagnostics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import labels as L
from tidemark.functions.numeric import ratio, row_mean, row_std
from tidemark.operators import asof as A
from tidemark.operators import metrics as M
from tidemark.operators import relational as R
from tidemark.operators import windows as W
from tidemark.operators.windows import Axis


def axis_features(df: DataFrame, ax: Axis, axes: Sequence[str]) -> DataFrame:
    """W43. Deltas, short means, pairwise products and spread across the axes."""
    cols = {}
    for a in axes:
        for n in (1, 5, 20):
            cols[f"{a}_delta_{n}d"] = W.lag_diff(ax, a, n)
        cols[f"{a}_ma_5d"] = W.rolling_mean(ax, a, 5, 3)
        cols[f"{a}_ma_20d"] = W.rolling_mean(ax, a, 20, 10)
    for i, a in enumerate(axes):
        for b in axes[i + 1:]:
            cols[f"{a}_x_{b}"] = F.col(a) * F.col(b)
    cols["axis_mean"] = row_mean(*axes)
    cols["axis_std"] = row_std(*axes)
    cols["axis_max"] = F.greatest(*axes)
    cols["axis_min"] = F.least(*axes)
    return df.withColumns(cols)


def predictive_power(df: DataFrame, keys: Sequence[str], features: Sequence[str], targets: Sequence[str]) -> DataFrame:
    """A16. Pearson and Spearman of each feature against each target, all pairs in one long frame."""
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(t).alias("target"), F.col(f).cast("double").alias("x"), F.col(t).cast("double").alias("y"))
                      for f in features for t in targets])
    long = df.select(*keys, F.explode(pairs).alias("__p")).select(*keys, "__p.*")
    long = long.where(F.col("x").isNotNull() & F.col("y").isNotNull())
    group = [*keys, "feature", "target"]
    linear = long.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), M.safe_corr("x", "y").alias("pearson"))
    return linear.join(M.spearman(long, group, "x", "y"), group, "left")


def combo_summary(df: DataFrame, axes: Sequence[str], result: str, keys: Sequence[str], min_rows: int = 10) -> DataFrame:
    """A17. Outcome per combination of axis buckets."""
    combo = F.concat_ws("|", *[L.axis_bucket(a) for a in axes])
    out = df.withColumn("combo", combo).where(F.col(result).isNotNull()).groupBy(*keys, "combo").agg(
        F.count(F.lit(1)).alias("n"), F.avg(result).alias("mean_return"), M.share(F.col(result) > 0).alias("win_rate"))
    return out.where(F.col("n") >= min_rows)


def importance_stability(df: DataFrame, keys: Sequence[str], coefficient: str) -> DataFrame:
    """A23. Mean and sign stability of coefficients over the years."""
    c = F.col(coefficient)
    return df.groupBy(*keys).agg(F.avg(c).alias("mean_coefficient"), F.avg(F.abs(c)).alias("mean_abs"), F.count_if(c > 0).alias("positive_years"),
                                 F.count_if(c < 0).alias("negative_years"), F.count(F.lit(1)).alias("years"))


def label_policy(df: DataFrame, keys: Sequence[str], order: str, forward: str, out: str, low: float, high: float, scale_window: int | None = None,
                 expanding_from: str | None = None) -> DataFrame:
    """M11. Three-class label of the forward return by its own quantiles.

    ``scale_window`` first divides by the rolling deviation of the forward return
    (a look-ahead the source accepts). Quantiles use the whole sample, or with
    ``expanding_from`` (a year column) only the years before the row's year.
    """
    ax = Axis.of(list(keys), order)
    value = F.col(forward)
    if scale_window:
        df = W.with_rolling_std(df, ax, forward, "__scale", scale_window, 60)
        value = ratio(value, "__scale")
    df = df.withColumn("__v", value)
    probs = {"__lo": low, "__hi": high}
    if expanding_from:
        years = df.select(*keys, expanding_from).distinct().withColumnRenamed(expanding_from, "__y")
        past = df.where(F.col("__v").isNotNull()).select(*keys, F.col(expanding_from).alias("__past"), "__v")
        pool = years.join(past, list(keys)).where(F.col("__past") < F.col("__y"))
        edges = M.exact_quantiles(pool, [*keys, "__y"], "__v", probs, bounded=True).withColumnRenamed("__y", expanding_from)
        df = df.join(edges, [*keys, expanding_from], "left")
    else:
        df = df.join(M.exact_quantiles(df, keys, "__v", probs, bounded=True), list(keys), "left")
    v = F.col("__v")
    label = F.when(v <= F.col("__lo"), "down").when(v <= F.col("__hi"), "sideways").when(v > F.col("__hi"), "up")
    return df.withColumn(out, label).drop("__v", "__lo", "__hi", "__scale")


def flow_features(df: DataFrame, ax: Axis, columns: Sequence[str]) -> DataFrame:
    """M12. 20- and 60-row z-scores, their spread and the 60-row percentile rank of each column."""
    for c in columns:
        for n in (20, 60):
            df = W.with_zscore(df, ax, c, f"{c}_z{n}d", n, max(10, n // 2), population=False, bound=None)
        df = df.withColumns({f"{c}_pctile_60d": W.percentile_rank(ax, c), f"{c}_z_spread": F.col(f"{c}_z20d") - F.col(f"{c}_z60d")})
    return df


def scope_forward_returns(prices: DataFrame, horizons: dict[int, str], members: Sequence[str] = ("KOSPI", "KOSDAQ")) -> DataFrame:
    """W24 per scope, with ALL as the equal-weight mean of the members (research definition)."""
    ax = Axis.of("market_scope", "date")
    rows = prices.select(F.col("date").alias("asof_date"), "market_scope", *[W.forward_return(ax, "close", n).alias(c) for n, c in horizons.items()])
    both = rows.where(F.col("market_scope").isin(list(members))).groupBy("asof_date").agg(*[F.avg(c).alias(c) for c in horizons.values()])
    return rows.unionByName(both.withColumn("market_scope", F.lit("ALL")))


def axis_dataset(prices: DataFrame, horizons: dict[int, str], scopes: Sequence[str] = ("ALL", "KOSPI", "KOSDAQ", "KOSPI200")) -> DataFrame:
    """K20. (day, scope) scaffold with forward returns and five- and three-class labels."""
    targets = scope_forward_returns(prices, horizons)
    base = A.grid(prices.select(F.col("date").alias("asof_date")).distinct(), "market_scope", list(scopes))
    df = base.join(targets, ["asof_date", "market_scope"], "left")
    for n, c in horizons.items():
        edges = M.exact_quantiles(df, ["market_scope"], c, {f"__q{q}": q / 100 for q in (20, 40, 60, 80)}, bounded=True)
        five = R.ladder_quantile_bucket(c, [f"__q{q}" for q in (20, 40, 60, 80)], ["strong_down", "mild_down", "sideways", "mild_up", "strong_up"])
        df = df.join(edges, "market_scope", "left").withColumn(f"direction_label_{n}d", five)
        df = df.withColumn(f"direction_label_3class_{n}d", L.three_class(f"direction_label_{n}d")).drop(*[f"__q{q}" for q in (20, 40, 60, 80)])
    return df
