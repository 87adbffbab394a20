"""Aggregates used to describe and judge series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.labels import CLASSES
from tidemark.functions.numeric import TRADING_DAYS, as_col, ratio
from tidemark.operators.relational import ladder_quantile_bucket
from tidemark.operators.windows import Axis


def share(condition: Column) -> Column:
    """Share of rows where the condition holds; null or false both count as no."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def breadth(value: str) -> list[Column]:
    """A3, A35. Advancers, decliners, unchanged, smoothed ratio and positive share."""
    v = F.col(value)
    up, down = F.count_if(v > 0), F.count_if(v < 0)
    return [up.alias("advancers"), down.alias("decliners"), F.count_if(v == 0).alias("flat_count"),
            ((up + 1) / (down + 1)).alias("adv_dec_ratio"), ratio(up, F.count(v)).alias("positive_ratio")]


def grouping_totals(df: DataFrame, date: str, scope: str, member: str, value: str) -> DataFrame:
    """A1, K29. Sums per (date, scope, member) and per (date, member) as scope ALL.

    The fine sums are made first; the ALL rows roll up those few sums.
    """
    fine = df.groupBy(date, scope, member).agg(F.sum(value).alias(value), F.count(F.lit(1)).alias("row_count"))
    total = fine.groupBy(date, member).agg(F.sum(value).alias(value), F.sum("row_count").alias("row_count"))
    return fine.unionByName(total.withColumn(scope, F.lit("ALL")))


# -- ranks and correlations ------------------------------------------------------

def with_average_rank(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Average rank (ties share the mean position) without sorting whole groups."""
    place = ((F.col("__first") + F.col("__last")) / 2.0 + 1.0).alias(out)
    return df.join(_positions(df, keys, value).select(*keys, value, place), [*keys, value], "left")


def spearman(df: DataFrame, keys: Sequence[str], a: str, b: str, out: str = "spearman", min_rows: int = 20) -> DataFrame:
    """A8. Correlation of average ranks over complete pairs; null under ``min_rows``."""
    pairs = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(*keys, a, b)
    ranked = with_average_rank(with_average_rank(pairs, keys, a, "__ra"), keys, b, "__rb")
    return ranked.groupBy(*keys).agg(safe_corr("__ra", "__rb", min_rows).alias(out))


def safe_corr(a: Column | str, b: Column | str, min_rows: int = 20) -> Column:
    """Pearson over complete pairs; null under ``min_rows`` or without spread."""
    x, y = as_col(a), as_col(b)
    both = x.isNotNull() & y.isNotNull()
    px, py = F.when(both, x), F.when(both, y)
    spread = (F.min(px) < F.max(px)) & (F.min(py) < F.max(py))
    return F.when((F.count(px) >= min_rows) & spread, F.corr(px, py))


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float],
                    bounded: bool = False) -> DataFrame:
    """A10, A18. Linear-interpolation quantiles.

    ``bounded`` groups (at most one row per day, as in the marts) use the
    built-in exact percentile. Otherwise equal values are counted first, one row
    per (key, distinct value) leaves the map side and a band of values is
    resolved per task, so no task holds a whole group.
    """
    if bounded:
        points = F.percentile(value, F.array(*[F.lit(float(p)) for p in probs.values()]))
        out = df.where(F.col(value).isNotNull()).groupBy(*keys).agg(points.alias("__p"))
        return out.select(*keys, *[F.col("__p")[i].alias(n) for i, n in enumerate(probs)])
    ranked = _positions(df, keys, value)
    total = df.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("__total"))
    pos = ranked.join(total, list(keys))
    aggs = []
    for name, p in probs.items():
        point = (F.col("__total") - 1) * F.lit(float(p))
        lo, hi = F.floor(point), F.ceil(point)
        at = lambda k: F.max(F.when((F.col("__first") <= k) & (F.col("__last") >= k), F.col(value)))
        frac = F.max(point - lo)
        aggs.append((at(lo) + (at(hi) - at(lo)) * frac).alias(name))
    return pos.groupBy(*keys).agg(*aggs)


BANDS = 64


def _positions(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """First and last zero-based position of every distinct value inside its group.

    Equal values are counted first. The distinct values of a group are cut into
    bands at approximate quantiles, so a group of any size and shape spreads over
    many tasks; positions inside a band are running counts on top of the counts of
    the bands below, hence exact wherever the cuts fall.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    cuts = counts.groupBy(*keys).agg(F.percentile_approx(value, [i / BANDS for i in range(1, BANDS)], 1000).alias("__cuts"))
    banded = counts.join(cuts, list(keys)).withColumn("__band", F.lit(0))
    step = BANDS // 2
    while step:
        above = F.col(value) > F.get("__cuts", F.col("__band") + (step - 1))
        banded = banded.withColumn("__band", F.col("__band") + F.when(above, step).otherwise(0))
        step //= 2
    banded = banded.drop("__cuts")
    sizes = banded.groupBy(*keys, "__band").agg(F.sum("__n").alias("__s"))
    before = Window.partitionBy(*keys).orderBy("__band").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, "__band", F.coalesce(F.sum("__s").over(before), F.lit(0)).alias("__off"))
    inside = Window.partitionBy(*keys, "__band").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    last = F.col("__off") + F.sum("__n").over(inside) - 1
    out = banded.join(offsets, [*keys, "__band"]).withColumn("__last", last)
    return out.select(*keys, value, (F.col("__last") - F.col("__n") + 1).alias("__first"), "__last")


def summary_stats(score: str, realised: str, min_rows: int = 20) -> list[Column]:
    """A8. Row count, mean, population deviation, win rate, Pearson."""
    r = F.col(realised)
    return [F.count(r).alias("n"), F.avg(r).alias("mean_return"), F.stddev_pop(r).alias("std_return"),
            F.avg(F.when(r > 0, 1.0).when(r.isNotNull(), 0.0)).alias("win_rate"),
            safe_corr(score, realised, min_rows).alias("pearson")]


def quantile_bucketed(df: DataFrame, keys: Sequence[str], score: str, labels: Sequence[str] = ("Q1", "Q2", "Q3", "Q4", "Q5"),
                      min_rows: int = 50, out: str = "quintile", bounded: bool = False) -> DataFrame:
    """A10. Bucket of each row by interpolated edges of its group; small groups drop out."""
    n = len(labels)
    probs = {f"__e{i}": i / n for i in range(1, n)}
    present = df.where(F.col(score).isNotNull())
    sizes = present.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"), F.count_distinct(score).alias("__d"))
    enough = sizes.where((F.col("__rows") >= min_rows) & (F.col("__d") >= n)).select(*keys)
    edges = exact_quantiles(present, keys, score, probs, bounded)
    rows = present.join(enough, list(keys), "left_semi").join(edges, list(keys))
    return rows.withColumn(out, ladder_quantile_bucket(score, list(probs), labels)).drop(*probs)


def regression_errors(pred: str, real: str, min_rows: int = 2) -> list[Column]:
    """A12. Error size, direction hits, correlation and means over complete pairs."""
    p, r = F.col(pred), F.col(real)
    both = p.isNotNull() & r.isNotNull()
    e = F.when(both, p - r)
    return [F.count(e).alias("n"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
            F.avg(F.when(both, (F.signum(p) == F.signum(r)).cast("double"))).alias("directional_hit"),
            safe_corr(pred, real, min_rows).alias("corr"),
            F.avg(F.when(both, p)).alias("mean_pred"), F.avg(F.when(both, r)).alias("mean_real")]


def class_counts(actual: str, predicted: str, classes: Sequence[str] = CLASSES) -> list[Column]:
    a, p = F.col(actual), F.col(predicted)
    out = [F.count(F.lit(1)).alias("n")]
    for c in classes:
        out += [F.count_if((a == c) & (p == c)).alias(f"tp_{c}"), F.count_if(a == c).alias(f"act_{c}"),
                F.count_if(p == c).alias(f"pred_{c}")]
    return out


def with_class_metrics(df: DataFrame, classes: Sequence[str] = CLASSES) -> DataFrame:
    """A13. Accuracy, balanced accuracy over supported classes, macro F1, majority baseline."""
    tp = {c: F.col(f"tp_{c}") for c in classes}
    act = {c: F.col(f"act_{c}") for c in classes}
    prd = {c: F.col(f"pred_{c}") for c in classes}
    total = lambda xs: sum(xs[1:], xs[0])
    recalls = [F.when(act[c] > 0, tp[c] / act[c]) for c in classes]
    supported = total([(act[c] > 0).cast("int") for c in classes])
    f1 = [F.coalesce(ratio(2.0 * tp[c], act[c] + prd[c]), F.lit(0.0)) for c in classes]
    return df.withColumns({
        "accuracy": ratio(total(list(tp.values())), F.col("n")),
        "balanced_accuracy": ratio(total([F.coalesce(r, F.lit(0.0)) for r in recalls]), supported),
        "macro_f1": total(f1) / len(classes),
        "majority_baseline": ratio(F.greatest(*act.values()), F.col("n")),
    })


def classification_scorecard(df: DataFrame, keys: Sequence[str], actual: str, predicted: str, classes: Sequence[str] = CLASSES) -> DataFrame:
    """A13. One row of counts per key on the map side, metrics on the result."""
    return with_class_metrics(df.groupBy(*keys).agg(*class_counts(actual, predicted, classes)), classes)


def confusion(df: DataFrame, keys: Sequence[str], actual: str, predicted: str, classes: Sequence[str] = CLASSES) -> DataFrame:
    """A14. Long confusion matrix with zero cells."""
    cells = [F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"),
                      F.count_if((F.col(actual) == a) & (F.col(predicted) == p)).alias("n"))
             for a in classes for p in classes]
    return df.groupBy(*keys).agg(F.array(*cells).alias("__c")).select(*keys, F.explode("__c").alias("__x")).select(*keys, "__x.*")


def dimension_performance(df: DataFrame, keys: Sequence[str], dimensions: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """A15. The same aggregates for each value of several dimensions."""
    values = [c for c in df.columns if c not in dimensions and c not in keys]
    long = df.withColumn("__d", F.explode(F.array(*[
        F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("dimension_value")) for d in dimensions])))
    return long.select(*keys, "__d.*", *values).groupBy(*keys, "dimension", "dimension_value").agg(*aggs)


# -- strategy ------------------------------------------------------------------------

def strategy_metrics(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A21, A22. Backtest row per key from the columns of ``with_strategy``."""
    n = F.count("strategy_return")
    year = F.lit(float(TRADING_DAYS))
    cum = F.product(1.0 + F.coalesce(F.col("strategy_return"), F.lit(0.0))) - 1.0
    hold = F.product(1.0 + F.coalesce(F.col("next_return"), F.lit(0.0))) - 1.0
    out = df.groupBy(*keys).agg(
        n.alias("days"), cum.alias("cumulative_return"), hold.alias("buyhold_cumulative_return"),
        (F.stddev_pop("strategy_return") * F.sqrt(year)).alias("annual_vol"),
        (F.stddev_pop("next_return") * F.sqrt(year)).alias("buyhold_annual_vol"),
        F.min("equity_drawdown").alias("mdd"), F.min("buyhold_drawdown").alias("buyhold_mdd"),
        F.avg("exposure").alias("avg_exposure"), F.avg("turnover").alias("avg_turnover"), F.sum("turnover").alias("total_turnover"),
        share(F.col("direction") == "up").alias("up_ratio"), share(F.col("direction") == "down").alias("down_ratio"),
        F.avg(F.when(F.col("exposure") > 0, (F.col("next_return") > 0).cast("double"))).alias("hit_rate"))

    def annual(c):
        return F.when((F.col("days") > 0) & (F.col(c) > -1.0), F.pow(1.0 + F.col(c), year / F.col("days")) - 1.0)

    out = out.withColumn("annual_return", annual("cumulative_return"))
    out = out.withColumn("buyhold_annual_return", annual("buyhold_cumulative_return"))
    out = out.withColumn("sharpe", ratio("annual_return", "annual_vol"))
    out = out.withColumn("buyhold_sharpe", ratio("buyhold_annual_return", "buyhold_annual_vol"))
    return out.withColumns({
        "sharpe_lift": F.col("sharpe") - F.col("buyhold_sharpe"),
        "mdd_improvement": F.col("mdd") - F.col("buyhold_mdd"),
        "return_capture": ratio("cumulative_return", "buyhold_cumulative_return"),
    })


def feature_usability(df: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """P22, P23. Non-null count and whether more than one value occurs, per feature, in one pass.

    Whether a feature varies is min < max, which combines map-side.
    """
    cells = [F.struct(F.lit(f).alias("feature"), F.count(f).alias("present"), F.count(F.lit(1)).alias("rows"),
                      (F.min(f) < F.max(f)).alias("varies")) for f in features]
    long = df.groupBy(*keys).agg(F.array(*cells).alias("__c")) if keys else df.agg(F.array(*cells).alias("__c"))
    return long.select(*keys, F.explode("__c").alias("__x")).select(*keys, "__x.*")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """A30. Null is a value of its own."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def series_span(df: DataFrame, keys: Sequence[str], date: str) -> DataFrame:
    """A32, Q3."""
    return df.groupBy(*keys).agg(F.min(date).alias("first_date"), F.max(date).alias("last_date"),
                                 F.count(F.lit(1)).alias("n"))


def axis_for(keys: Sequence[str], order: str) -> Axis:
    return Axis.of(list(keys), order)
