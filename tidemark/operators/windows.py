"""Row-count windows over ordered series.

Every window is partitioned by the series key. Callers first bring facts to one
row per key and day, so a partition holds at most one row per calendar day
however many raw rows the key has; a hot key is absorbed by the map-side part of
that aggregation, not by the window. All windows of one ``Axis`` share a single
shuffle and sort.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from tidemark.functions.numeric import TRADING_DAYS, as_col, clip, ratio


@dataclass(frozen=True)
class Axis:
    """Series key plus a total order inside the key."""

    keys: tuple[str, ...]
    order: tuple[str, ...]

    @classmethod
    def of(cls, keys: str | list[str], order: str | list[str]) -> "Axis":
        as_tuple = lambda x: (x,) if isinstance(x, str) else tuple(x)
        return cls(as_tuple(keys), as_tuple(order))

    @property
    def by(self) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy(*self.order)

    @property
    def whole(self) -> WindowSpec:
        return Window.partitionBy(*self.keys)

    def last(self, n: int) -> WindowSpec:
        return self.by.rowsBetween(-(n - 1), 0)

    @property
    def so_far(self) -> WindowSpec:
        return self.by.rowsBetween(Window.unboundedPreceding, 0)

    @property
    def from_here(self) -> WindowSpec:
        return self.by.rowsBetween(0, Window.unboundedFollowing)

    def ahead(self, n: int) -> WindowSpec:
        return self.by.rowsBetween(1, n)


# -- lags --------------------------------------------------------------------

def lag_return(ax: Axis, c: Column | str, n: int = 1) -> Column:
    """W1, W46. x / x[-n] - 1; null on a missing or zero base."""
    return ratio(c, F.lag(as_col(c), n).over(ax.by)) - 1.0


def pad_nulls(ax: Axis, c: Column | str) -> Column:
    """W35. Last non-null value so far; use before ``lag_return`` for padded changes."""
    return F.last(as_col(c), ignorenulls=True).over(ax.so_far)


def lag_diff(ax: Axis, c: Column | str, n: int = 1) -> Column:
    """W2. x - x[-n]."""
    return as_col(c) - F.lag(as_col(c), n).over(ax.by)


def year_over_year(ax: Axis, c: Column | str) -> Column:
    """W3. Ratio to the value twelve rows earlier, less one (monthly series)."""
    return lag_return(ax, c, 12)


def change_columns(ax: Axis, c: str) -> dict[str, Column]:
    """W26. Previous label, whether it changed."""
    prev = F.lag(c).over(ax.by)
    return {"previous": prev, "changed": F.coalesce((prev != F.col(c)).cast("int"), F.lit(0))}


# -- rolling statistics -------------------------------------------------------

def guarded(ax: Axis, value: Column, c: Column | str, n: int, min_periods: int) -> Column:
    """Value only where the frame holds ``min_periods`` non-null observations."""
    return F.when(F.count(as_col(c)).over(ax.last(n)) >= min_periods, value)


def rolling_mean(ax: Axis, c: Column | str, n: int, min_periods: int = 1) -> Column:
    """W4."""
    return guarded(ax, F.avg(as_col(c)).over(ax.last(n)), c, n, min_periods)


def rolling_sum(ax: Axis, c: Column | str, n: int, min_periods: int = 1) -> Column:
    """W19."""
    return guarded(ax, F.sum(as_col(c)).over(ax.last(n)), c, n, min_periods)


def rolling_max(ax: Axis, c: Column | str, n: int, min_periods: int = 1) -> Column:
    return guarded(ax, F.max(as_col(c)).over(ax.last(n)), c, n, min_periods)


def rolling_min(ax: Axis, c: Column | str, n: int, min_periods: int = 1) -> Column:
    return guarded(ax, F.min(as_col(c)).over(ax.last(n)), c, n, min_periods)


def rolling_std(ax: Axis, c: Column | str, n: int, min_periods: int = 2, population: bool = False) -> Column:
    fn = F.stddev_pop if population else F.stddev_samp
    return guarded(ax, fn(as_col(c)).over(ax.last(n)), c, n, max(min_periods, 1 if population else 2))


def annualised_vol(ax: Axis, ret: Column | str, n: int = 20, min_periods: int = 10) -> Column:
    """W5, W7. Sample deviation of (simple or log) returns x sqrt(252)."""
    return rolling_std(ax, ret, n, min_periods) * (TRADING_DAYS ** 0.5)


def realised_vol(ax: Axis, ret: Column | str, n: int = 20) -> Column:
    """W6. Population deviation of the last n simple returns."""
    return rolling_std(ax, ret, n, n, population=True)


def above_mean(ax: Axis, c: Column | str, n: int, min_periods: int) -> Column:
    """W4. 1 when the value exceeds its rolling mean; warm-up rows give 0."""
    return F.coalesce((as_col(c) > rolling_mean(ax, c, n, min_periods)).cast("double"), F.lit(0.0))


def touches_high(ax: Axis, c: Column | str, n: int, min_periods: int) -> Column:
    """W10."""
    return F.coalesce((as_col(c) >= rolling_max(ax, c, n, min_periods)).cast("double"), F.lit(0.0))


def touches_low(ax: Axis, c: Column | str, n: int, min_periods: int) -> Column:
    """W10."""
    return F.coalesce((as_col(c) <= rolling_min(ax, c, n, min_periods)).cast("double"), F.lit(0.0))


def expansion(ax: Axis, c: Column | str, n: int = 20, min_periods: int = 10) -> Column:
    """W11. Value over its rolling mean."""
    return ratio(c, rolling_mean(ax, c, n, min_periods))


def drawdown(ax: Axis, c: Column | str, n: int, min_periods: int = 1) -> Column:
    """W8. Distance from the peak of the window."""
    return ratio(c, rolling_max(ax, c, n, min_periods)) - 1.0


def with_rolling_mdd(df: DataFrame, ax: Axis, c: str, n: int, out: str) -> DataFrame:
    """W9. Rolling minimum of the rolling drawdown (two stacked windows, one sort)."""
    need = max(20, n // 3)
    tmp = f"__dd_{out}"
    return (df.withColumn(tmp, drawdown(ax, c, n, need))
            .withColumn(out, rolling_min(ax, tmp, n, need)).drop(tmp))


def zscore(ax: Axis, c: Column | str, n: int = 252, min_periods: int = 30, population: bool = True,
           bound: float | None = 3.0) -> Column:
    """W14, W16. Rolling z-score incl. the current row; null when the spread is zero. For short windows."""
    sd = rolling_std(ax, c, n, min_periods, population)
    z = ratio(as_col(c) - rolling_mean(ax, c, n, min_periods), sd)
    return z if bound is None else clip(z, -bound, bound)


def with_running_moments(df: DataFrame, ax: Axis, c: str, n: int, count: str, mean: str, std: str, population: bool = True) -> DataFrame:
    """Count, mean and deviation of the last n rows from running sums: one visit per row whatever n is.

    Sums run over differences from the first value of the series, which keeps the
    subtraction well conditioned. A window without any change of value gets an
    exact zero deviation.
    """
    x = F.col(c)
    df = df.withColumns({"__x0": F.first(x, True).over(ax.so_far), "__n": F.count(x).over(ax.so_far),
                         "__prev": F.last(x, True).over(ax.by.rowsBetween(Window.unboundedPreceding, -1))})
    d = F.coalesce(x - F.col("__x0"), F.lit(0.0))
    moved = F.when(x.isNotNull() & ~x.eqNullSafe(F.col("__prev")), F.col("__n"))
    df = df.withColumns({"__s1": F.sum(d).over(ax.so_far), "__s2": F.sum(d * d).over(ax.so_far), "__run": F.max(moved).over(ax.so_far)})
    part = lambda k: F.col(k) - F.lag(k, n, 0).over(ax.by)
    df = df.withColumns({"__wn": part("__n"), "__w1": part("__s1"), "__w2": part("__s2")})
    m = F.col("__w1") / F.nullif("__wn", F.lit(0))
    var = F.greatest(F.col("__w2") / F.nullif("__wn", F.lit(0)) - m * m, F.lit(0.0))
    steady = (F.col("__n") - F.col("__run") + 1) >= F.col("__wn")
    if not population:
        var = ratio(var * F.col("__wn"), F.col("__wn") - 1)
    df = df.withColumns({count: F.col("__wn"), mean: F.col("__x0") + m, std: F.when(steady, F.when(var.isNotNull(), 0.0)).otherwise(F.sqrt(var))})
    return df.drop("__x0", "__n", "__prev", "__s1", "__s2", "__run", "__wn", "__w1", "__w2")


def with_zscore(df: DataFrame, ax: Axis, c: str, out: str, n: int = 252, min_periods: int = 30, population: bool = True, bound: float | None = 3.0) -> DataFrame:
    """W14, W16. ``zscore`` for long windows, from running sums."""
    df = with_running_moments(df, ax, c, n, "__zn", "__zm", "__zs", population)
    z = F.when(F.col("__zn") >= min_periods, ratio(F.col(c) - F.col("__zm"), "__zs"))
    return df.withColumn(out, z if bound is None else clip(z, -bound, bound)).drop("__zn", "__zm", "__zs")


def with_rolling_std(df: DataFrame, ax: Axis, c: str, out: str, n: int, min_periods: int, population: bool = False) -> DataFrame:
    """W23. Long-window deviation from running sums."""
    df = with_running_moments(df, ax, c, n, "__zn", "__zm", "__zs", population)
    return df.withColumn(out, F.when(F.col("__zn") >= min_periods, F.col("__zs"))).drop("__zn", "__zm", "__zs")


def with_change_zscore(df: DataFrame, ax: Axis, c: str, lag: int, out: str, n: int = 252) -> DataFrame:
    """W15. z-score of the lag-n change."""
    tmp = f"__chg_{out}"
    return with_zscore(df.withColumn(tmp, lag_diff(ax, c, lag)), ax, tmp, out, n).drop(tmp)


def percentile_rank(ax: Axis, c: Column | str, n: int = 60, min_periods: int = 20) -> Column:
    """W17. Average-rank percentile of the current value inside its frame."""
    x = as_col(c)
    frame = F.collect_list(x).over(ax.last(n))
    less = F.size(F.filter(frame, lambda v: v < x))
    equal = F.size(F.filter(frame, lambda v: v == x))
    pct = (less + (equal + 1) / 2.0) / F.size(frame)
    return F.when(x.isNotNull() & (F.size(frame) >= min_periods), pct)


def with_expectation(df: DataFrame, ax: Axis, c: str, n: int = 24, min_periods: int = 12) -> DataFrame:
    """W18. Mean and population deviation of the n rows before, and the surprise z."""
    w = ax.by.rowsBetween(-n, -1)
    enough = F.count(c).over(w) >= min_periods
    df = df.withColumn("expected", F.when(enough, F.avg(c).over(w)))
    df = df.withColumn("expected_std", F.when(enough, F.stddev_pop(c).over(w)))
    return df.withColumn("surprise_z", ratio(F.col(c) - F.col("expected"), "expected_std"))


def positive_days(ax: Axis, c: Column | str, n: int) -> Column:
    """W20. Rows of the frame with a value above zero."""
    return F.sum(F.when(as_col(c) > 0, 1).otherwise(0)).over(ax.last(n))


def ratio_of_sums(ax: Axis, num: Column | str, den: Column | str, n: int) -> Column:
    """W42."""
    return ratio(F.sum(as_col(num)).over(ax.last(n)), F.sum(as_col(den)).over(ax.last(n)))


def rolling_corr(ax: Axis, a: str, b: str, n: int) -> Column:
    """W21. Pearson over rows where both are present; needs max(10, n/2) pairs."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    w = ax.last(n)
    x, y = F.when(both, F.col(a)), F.when(both, F.col(b))
    flat = (F.min(x).over(w) == F.max(x).over(w)) | (F.min(y).over(w) == F.max(y).over(w))
    return F.when((F.count(x).over(w) >= max(10, n // 2)) & ~flat, F.corr(x, y).over(w))


# -- cumulative ---------------------------------------------------------------

def cumulative_index(ax: Axis, ret: Column | str, base: float = 100.0) -> Column:
    """W12. Compounded index; a missing return counts as zero."""
    return F.product(1.0 + F.coalesce(as_col(ret), F.lit(0.0))).over(ax.so_far) * base


def running_peak(ax: Axis, c: Column | str) -> Column:
    """W13."""
    return F.max(as_col(c)).over(ax.so_far)


def rebased(ax: Axis, c: Column | str, base: float = 100.0) -> Column:
    """W41. First non-null value of the series becomes ``base``."""
    return ratio(c, F.first(as_col(c), ignorenulls=True).over(ax.so_far)) * base


# -- forward ------------------------------------------------------------------

def forward_return(ax: Axis, c: Column | str, n: int) -> Column:
    """W24, W44."""
    return ratio(F.lead(as_col(c), n).over(ax.by), c) - 1.0


def forward_drawdown(ax: Axis, c: Column | str, n: int) -> Column:
    """W25. Lowest of the next n rows over the current value (tail frames are partial)."""
    return ratio(F.min(as_col(c)).over(ax.ahead(n)), c) - 1.0


def forward_runup(ax: Axis, c: Column | str, n: int) -> Column:
    """W25."""
    return ratio(F.max(as_col(c)).over(ax.ahead(n)), c) - 1.0


# -- gaps and islands -----------------------------------------------------------

def row_index(ax: Axis) -> Column:
    return F.row_number().over(ax.by)


def with_days_since_change(df: DataFrame, ax: Axis, flag: str, out: str) -> DataFrame:
    """W28. Rows since the flag was last 1; the first row counts as a change."""
    df = df.withColumn("__rn", row_index(ax))
    start = F.when((F.col(flag) == 1) | (F.col("__rn") == 1), F.col("__rn"))
    return df.withColumn(out, F.col("__rn") - F.max(start).over(ax.so_far)).drop("__rn")


def with_streak(df: DataFrame, ax: Axis, condition: Column, out: str) -> DataFrame:
    """W29. Length of the running streak of a true condition; false gives 0.

    A row number less the row number of the last failing row, so one sort serves
    the whole operator.
    """
    df = df.withColumn("__ok", F.coalesce(condition, F.lit(False))).withColumn("__rn", row_index(ax))
    broken = F.coalesce(F.max(F.when(~F.col("__ok"), F.col("__rn"))).over(ax.so_far), F.lit(0))
    return df.withColumn(out, F.col("__rn") - broken).drop("__ok", "__rn")


def with_event_distance(df: DataFrame, ax: Axis, flag: str, since: str, until: str) -> DataFrame:
    """W38. Rows since the last and until the next raised flag."""
    df = df.withColumn("__rn", row_index(ax))
    hit = F.when(F.col(flag) == 1, F.col("__rn"))
    df = df.withColumn(since, F.col("__rn") - F.last(hit, True).over(ax.so_far))
    df = df.withColumn(until, F.first(hit, True).over(ax.from_here) - F.col("__rn"))
    return df.drop("__rn")


def with_neighbour_flags(df: DataFrame, ax: Axis, flag: str, before: str, after: str) -> DataFrame:
    """J22. Whether the next / previous row carries the flag."""
    return (df.withColumn(before, F.coalesce(F.lead(flag).over(ax.by), F.lit(0)))
            .withColumn(after, F.coalesce(F.lag(flag).over(ax.by), F.lit(0))))


def transition_counts(ax: Axis, changed: str, n: int) -> Column:
    """W27."""
    return F.sum(changed).over(ax.last(n))


def with_transition_stats(df: DataFrame, keys: list[str], ts: str, label: str) -> DataFrame:
    """W30. Changes in the trailing 5 / 20 calendar days, hours in the current state, stability."""
    ax = Axis.of(keys, ts)
    prev = F.lag(label).over(ax.by)
    df = df.withColumn("changed", (prev.isNotNull() & (prev != F.col(label))).cast("int"))
    for days in (5, 20):
        frame = (f"OVER (PARTITION BY {', '.join(keys)} ORDER BY {ts} "
                 f"RANGE BETWEEN INTERVAL {days} DAYS PRECEDING AND CURRENT ROW)")
        # The first row of the frame has no predecessor inside it.
        df = df.withColumn(f"transitions_{days}d", F.expr(f"sum(changed) {frame} - first(changed) {frame}"))
    start = F.when((F.col("changed") == 1) | prev.isNull(), F.col(ts))
    df = df.withColumn("state_since", F.last(start, True).over(ax.so_far))
    hours = F.timestamp_diff("SECOND", F.col("state_since"), F.col(ts)).cast("double") / 3600.0
    df = df.withColumn("state_hours", hours)
    stability = (0.4 * F.least(F.col("state_hours") / 24.0, F.lit(1.0))
                 + 0.6 * F.greatest(F.lit(0.0), 1.0 - F.col("transitions_20d") / 10.0))
    return df.withColumn("stability", stability)


# -- cross-section ----------------------------------------------------------------

def with_cross_section(df: DataFrame, date: str, value: str, weight: str | None = None,
                       z_out: str = "cross_z", share_out: str = "share") -> DataFrame:
    """W31, W32. Population z-score per date (0 when constant) and share of the date total.

    Date totals come from a partial aggregation joined back, so a date with very
    many members is never gathered in one task.
    """
    aggs = [F.count(value).alias("__n"), F.avg(value).alias("__m"), F.stddev_pop(value).alias("__s"),
            F.min(value).alias("__lo"), F.max(value).alias("__hi")]
    if weight:
        aggs.append(F.sum(weight).alias("__t"))
    totals = df.groupBy(date).agg(*aggs)
    out = df.join(totals, date, "left")
    spread = (F.col("__n") > 1) & (F.col("__hi") > F.col("__lo"))
    z = F.when(spread, clip((F.col(value) - F.col("__m")) / F.col("__s"))).otherwise(
        F.when(F.col(value).isNotNull(), F.lit(0.0)))
    out = out.withColumn(z_out, z)
    if weight:
        out = out.withColumn(share_out, ratio(weight, "__t"))
    return out.drop("__n", "__m", "__s", "__lo", "__hi", "__t")


def cross_rank(date: str, score: str, tie: str) -> Column:
    """W33. Position by score, best first; ``tie`` settles equal scores.

    For groups of a fixed membership (themes, assets, scopes).
    """
    return F.row_number().over(Window.partitionBy(date).orderBy(F.desc_nulls_last(score), F.asc(tie)))


# -- strategy -------------------------------------------------------------------------

def with_strategy(df: DataFrame, ax: Axis, exposure: str, next_return: str, cost_bps: float = 5.0) -> DataFrame:
    """W40. Turnover, cost, net return, equity, peak and drawdown of an exposure path."""
    turnover = F.abs(F.col(exposure) - F.coalesce(F.lag(exposure).over(ax.by), F.lit(0.0)))
    df = df.withColumn("turnover", turnover).withColumn("cost", F.col("turnover") * (cost_bps / 10000.0))
    df = df.withColumn("strategy_return", F.col(exposure) * F.col(next_return) - F.col("cost"))
    df = df.withColumn("equity", cumulative_index(ax, "strategy_return", 1.0))
    df = df.withColumn("buyhold_equity", cumulative_index(ax, next_return, 1.0))
    df = df.withColumn("equity_drawdown", ratio("equity", running_peak(ax, "equity")) - 1.0)
    return df.withColumn("buyhold_drawdown", ratio("buyhold_equity", running_peak(ax, "buyhold_equity")) - 1.0)
