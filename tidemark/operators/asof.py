"""Point-in-time joins and calendar expansion.

Dates are a discrete domain, so an as-of match on days is an equality join with
a calendar lookup, and an as-of match on instants is a bucketed carry-forward.
Neither plans a range join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.dates import next_business_day
from tidemark.operators.windows import Axis


def date_spine(df: DataFrame, date: str, out: str = "asof_date") -> DataFrame:
    """Distinct days of a fact; partial distinct runs before the shuffle."""
    return df.select(F.col(date).cast("date").alias(out)).where(F.col(out).isNotNull()).distinct()


def _calendar_order(date: str):
    """Order of the spine itself. One row per calendar day, so one task is enough."""
    return Window.partitionBy(F.lit(0)).orderBy(date)


def forward_lookup(days: DataFrame, spine: DataFrame, spine_date: str = "asof_date") -> DataFrame:
    """J12. For each wanted ``day`` the first spine day on or after it.

    Both sides are distinct days, so the ordered run has one row per calendar day.
    """
    marked = days.select("day").distinct().unionByName(
        spine.select(F.col(spine_date).alias("day"), F.col(spine_date).alias("spine_date")), allowMissingColumns=True)
    ahead = _calendar_order("day").rangeBetween(Window.currentRow, Window.unboundedFollowing)
    nearest = marked.withColumn("spine_date", F.first("spine_date", True).over(ahead))
    return nearest.where(F.col("spine_date").isNotNull()).distinct()


def asof_forward(df: DataFrame, spine: DataFrame, source_date: str, lag_days: int = 0, out: str = "event_date",
                 spine_date: str = "asof_date") -> DataFrame:
    """J12. First spine day >= source day + lag; rows past the end of the spine are dropped."""
    keyed = df.withColumn("day", F.date_add(source_date, lag_days))
    lookup = forward_lookup(keyed, spine, spine_date).withColumnRenamed("spine_date", out)
    return keyed.join(lookup, "day", "inner").drop("day")


def asof_backward(left: DataFrame, right: DataFrame, by: list[str], left_on: str, right_on: str, values: list[str],
                  bucket: Column | None = None, bucket_unit: str = "month") -> DataFrame:
    """J13, J15. Last row of ``right`` at or before the instant of each ``left`` row, per key.

    Rows are bucketed by (key, calendar period). The last value of each bucket is
    carried forward over the short list of buckets, and the exact match runs
    inside a bucket, so a key with a third of all rows spreads over as many tasks
    as it has periods. ``values`` arrive as one struct, so nulls inside a matched
    row stay nulls.
    """
    trunc = lambda c: F.date_trunc(bucket_unit, F.col(c).cast("timestamp_ntz"))
    payload = F.struct(*[F.col(v).alias(v) for v in values])
    keep = [c for c in left.columns if c not in by]
    facts = right.where(F.col(right_on).isNotNull()).select(
        *by, F.col(right_on).cast("timestamp_ntz").alias("__t"), trunc(right_on).alias("__b"), payload.alias("__v"))
    rows = left.select(*by, F.col(left_on).cast("timestamp_ntz").alias("__t"), trunc(left_on).alias("__b"),
                       F.struct(*keep).alias("__row"))
    closing = facts.groupBy(*by, "__b").agg(F.max_by("__v", "__t").alias("__v"))
    buckets = closing.unionByName(
        rows.select(*by, "__b").distinct().withColumn("__v", F.lit(None).cast(closing.schema["__v"].dataType)))
    per_bucket = buckets.groupBy(*by, "__b").agg(F.first("__v", ignorenulls=True).alias("__v"))
    before = Window.partitionBy(*by).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    opening = (per_bucket.withColumn("__v", F.last("__v", True).over(before)).where(F.col("__v").isNotNull())
               .select(*by, F.col("__b").alias("__t"), "__b", "__v", F.lit(0).alias("__side")))
    tagged = facts.withColumn("__side", F.lit(1)).unionByName(opening)
    tagged = tagged.unionByName(rows.withColumn("__side", F.lit(2)), allowMissingColumns=True)
    inside = Window.partitionBy(*by, "__b").orderBy("__t", "__side").rowsBetween(Window.unboundedPreceding, 0)
    matched = tagged.withColumn("__v", F.last("__v", True).over(inside)).where(F.col("__side") == 2)
    return matched.select(*by, "__row.*", *[F.col(f"__v.{v}").alias(v) for v in values])


def monthly_asof(spine: DataFrame, monthly: DataFrame, series: str, date: str, values: list[str], release_lag: int = 21,
                 spine_date: str = "asof_date") -> DataFrame:
    """J13. Monthly values usable ``release_lag`` calendar days after their date, on every spine day.

    Each observation is valid until the next one is released, so its validity is
    a run of calendar days and the match is an equality join on the day.
    """
    ax = Axis.of(series, "__from")
    last_day = spine.agg(F.max(spine_date)).scalar()
    valid = monthly.withColumn("__from", F.date_add(date, release_lag))
    valid = valid.withColumn("__next", F.date_sub(F.lead("__from").over(ax.by), 1)).withColumn("__end", last_day)
    until = F.coalesce("__next", F.greatest("__from", "__end"))
    valid = valid.withColumn("__until", until)
    days = valid.select(series, *values, F.explode(F.sequence("__from", "__until")).alias(spine_date))
    return spine.join(days, spine_date, "inner")


def threshold_by_year(rows: DataFrame, thresholds: DataFrame, keys: list[str], year: Column, tuned_year: str,
                      values: list[str]) -> DataFrame:
    """J14. Values of the latest tuned year at or before the row's year.

    Tuned years are few per key; each is valid until the next, so the match is an
    equality join on (keys, year) after exploding the validity.
    """
    ax = Axis.of(keys, tuned_year)
    last_year = rows.agg(F.max(year)).scalar()
    valid = thresholds.withColumn("__next", F.lead(tuned_year).over(ax.by) - 1).withColumn("__max", last_year)
    valid = valid.withColumn("__until", F.coalesce("__next", F.greatest(F.col(tuned_year), F.col("__max"))))
    spread = valid.select(*keys, *values, F.col(tuned_year).alias("threshold_year"),
                          F.explode(F.sequence(F.col(tuned_year), F.col("__until"))).alias("__year"))
    return rows.withColumn("__year", year).join(spread, [*keys, "__year"], "left").drop("__year")


def pit_shift(df: DataFrame, source_date: str, start, end, out: str = "asof_date", keys: list[str] | None = None) -> DataFrame:
    """J17. Move each row to the next business day; keep the latest source row per target day."""
    shifted = df.withColumn(out, next_business_day(source_date)).where(F.col(out).between(start, end))
    group = [*(keys or []), out]
    packed = shifted.groupBy(*group).agg(
        F.max_by(F.struct(*[c for c in shifted.columns if c not in group]), source_date).alias("__row"))
    return packed.select(*group, "__row.*")


def grid(spine: DataFrame, column: str, members: list) -> DataFrame:
    """J7. Spine days x a fixed member list, as a generator (no join)."""
    return spine.withColumn(column, F.explode(F.array(*[F.lit(m) for m in members])))


def forward_fill(spine: DataFrame, series: DataFrame, members: list[str], key: str, value: str,
                 date: str = "asof_date") -> DataFrame:
    """W35. Every series on every spine day, carrying the last value forward.

    Values dated between two spine days still count, as observations join the
    ordered run themselves.
    """
    wanted = grid(spine.select(date), key, members).withColumn("__grid", F.lit(1))
    both = wanted.join(series.select(key, date, value), [key, date], "full")
    filled = both.withColumn(value, F.last(value, True).over(Axis.of(key, date).so_far))
    return filled.where(F.col("__grid") == 1).drop("__grid")


def carry_forward_days(df: DataFrame, keys: list[str], date: str, values: list[str], until: Column,
                       provenance: str = "point_type") -> DataFrame:
    """W36. Fill the calendar days to the next point (or ``until``) with the last point."""
    ax = Axis.of(keys, date)
    stop = F.greatest(F.coalesce(F.date_sub(F.lead(date).over(ax.by), 1), until), F.col(date))
    days = df.withColumn("__stop", stop).select(
        *keys, *values, F.col(date).alias("source_date"), F.explode(F.sequence(F.col(date), F.col("__stop"))).alias(date))
    kind = F.when(F.col(date) == F.col("source_date"), "observed").otherwise("carry_forward")
    return days.withColumn(provenance, kind)


def carry_latest_to(df: DataFrame, keys: list[str], date: str, target: Column, source: str = "source") -> DataFrame:
    """W37. Rows of the newest date per key (a market), re-dated to ``target``, source prefixed."""
    past = df.where(F.col(date) < target)
    newest = past.groupBy(*keys).agg(F.max(date).alias(date))
    latest = past.join(newest, [*keys, date], "left_semi")
    return latest.withColumn(source, F.concat(F.lit("carry_forward:"), F.col(source))).withColumn(date, target)


def latest_session_snapshot(asofs: DataFrame, snapshots: DataFrame, asof: str, snap_ts: str, status: str,
                            values: list[str], fallback_days: int = 7) -> DataFrame:
    """J15. Newest snapshot of the same day at or before ``asof``; else newest live one of the last days.

    Snapshots are first reduced to the newest (and newest live) per day and minute
    bucket of interest through ``asof_backward``; no range join is planned.
    """
    snaps = snapshots.withColumn("__day", F.col(snap_ts).cast("date"))
    want = asofs.withColumn("__day", F.col(asof).cast("date"))
    same = asof_backward(want, snaps.withColumn("same_ts", F.col(snap_ts)), ["__day"], asof, snap_ts,
                         ["same_ts", *values])
    live = snaps.where(F.col(status).isin("live", "live_indexes_only")).withColumn("__all", F.lit(1)).withColumn("live_ts", F.col(snap_ts))
    live = live.select("__all", snap_ts, "live_ts", *[F.col(v).alias(f"live_{v}") for v in values])
    tiered = asof_backward(same.withColumn("__all", F.lit(1)), live, ["__all"], asof, snap_ts,
                           ["live_ts", *[f"live_{v}" for v in values]])
    recent = F.col("live_ts") >= F.col(asof).cast("timestamp_ntz") - F.expr(f"INTERVAL {fallback_days} DAYS")
    use_same = F.col("same_ts").isNotNull()
    use_live = ~use_same & recent
    picked = [F.when(use_same, F.col(v)).when(use_live, F.col(f"live_{v}")).alias(v) for v in values]
    return tiered.select(
        *asofs.columns, F.when(use_same, F.col("same_ts")).when(use_live, F.col("live_ts")).alias("snapshot_ts"),
        F.when(use_same, 0).when(use_live, 1).alias("previous_session"), *picked)
