"""Data-quality checks; every check is one aggregate over its table (Q1-Q11)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import count_present, ratio


def missing_rates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Q1. Share of nulls per column, as rows."""
    columns = list(columns or df.columns)
    cells = [F.struct(F.lit(c).alias("column_name"), F.round(F.avg(F.col(c).isNull().cast("double")), 6).alias("missing_rate"))
             for c in columns]
    return df.agg(F.array(*cells).alias("__c")).select(F.explode("__c").alias("__x")).select("__x.*")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q2. Rows sharing a key (all members) and rows beyond the first (extras)."""
    n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return n.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("all_members"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extras"))


def scope_coverage(df: DataFrame, scope: str, date: str) -> DataFrame:
    """Q3."""
    return df.groupBy(scope).agg(F.min(date).alias("first_date"), F.max(date).alias("last_date"),
                                 F.count_distinct(date).alias("days"))


def missing_days(df: DataFrame, spine: DataFrame, scope: str, members: Sequence[str], date: str) -> DataFrame:
    """Q3. Spine days without a row, per scope."""
    have = df.select(scope, date).distinct().groupBy(scope).agg(F.count(F.lit(1)).alias("have"))
    counts = spine.agg(F.count(F.lit(1)).alias("n")).withColumn(
        scope, F.explode(F.array(*[F.lit(m) for m in members])))
    out = counts.join(have, scope, "left")
    return out.select(scope, (F.col("n") - F.coalesce("have", F.lit(0))).alias("missing_dates"))


def with_coverage(df: DataFrame, groups: Mapping[str, Sequence[str]], label) -> DataFrame:
    """Q4. Per feature group: any present, ratio, nulls, expected; overall mean and label."""
    out, ratios = df, []
    for name, cols in groups.items():
        seen = count_present(*cols)
        out = out.withColumns({
            f"{name}_available": (seen > 0).cast("int"), f"{name}_coverage_ratio": F.round(seen / len(cols), 6),
            f"{name}_null_count": F.lit(len(cols)) - seen, f"{name}_expected_count": F.lit(len(cols))})
        ratios.append(F.col(f"{name}_coverage_ratio"))
    overall = reduce(lambda a, b: a + b, ratios) / len(ratios)
    out = out.withColumn("coverage_ratio", F.round(overall, 6))
    return out.withColumn("coverage_quality", label("coverage_ratio"))


def check(df: DataFrame, constraints: Mapping[str, Column], keys: Sequence[str] = ()) -> DataFrame:
    """Q5-Q7, Q9, Q11. Named row predicates (and key uniqueness) to a report of failures.

    Predicates that are null count as failed. All predicates share one scan.
    """
    cells = [F.struct(F.lit(name).alias("check_name"), F.count_if(~F.coalesce(ok, F.lit(False))).alias("failed_rows"),
                      F.count(F.lit(1)).alias("checked_rows")) for name, ok in constraints.items()]
    report = df.agg(F.array(*cells).alias("__c")).select(F.explode("__c").alias("__x")).select("__x.*")
    if keys:
        n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        unique = n.agg(F.lit("unique_key").alias("check_name"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("failed_rows"),
                       F.coalesce(F.sum("n"), F.lit(0)).alias("checked_rows"))
        report = report.unionByName(unique)
    return report.withColumn("status", F.when(F.col("failed_rows") == 0, "ok").otherwise("failed"))


def leakage_checks(df: DataFrame, asof: str, source_date: str, target_end: str, features: Sequence[str],
                   forbidden: Sequence[str] = ("target_", "forward_", "generated_at")) -> DataFrame:
    """Q5. Sources predate the row, targets end after it, no target column among the features."""
    bad = [f for f in features if any(f.startswith(p) for p in forbidden)]
    return check(df, {
        "source_before_asof": F.col(source_date).isNull() | (F.col(source_date) < F.col(asof)),
        "target_after_asof": F.col(target_end).isNull() | (F.col(target_end) > F.col(asof)),
        "no_target_in_features": F.lit(not bad),
    })


def signal_constraints(labels: Sequence[str], scopes: Sequence[str], horizons: Sequence[str]) -> dict[str, Column]:
    """Q7. Row predicates of the signal hand-over table."""
    p = [F.col(c) for c in ("prob_down", "prob_sideways", "prob_up")]
    total = p[0] + p[1] + p[2]
    inside = reduce(lambda a, b: a & b, [(x >= 0.0) & (x <= 1.0) for x in p])
    return {
        "direction_enum": F.col("predicted_direction").isin(list(labels)),
        "scope_enum": F.col("market_scope").isin(list(scopes)),
        "horizon_enum": F.col("forecast_horizon").isin(list(horizons)),
        "probability_range": inside,
        "probability_sum": F.abs(total - 1.0) <= 1e-4,
        "confidence_range": F.col("confidence").between(0.0, 1.0),
    }


def payload_checks(df: DataFrame, doc: str, required: Sequence[str], group: str) -> DataFrame:
    """Q10. Documents lacking a required key, and groups mixing several markets or times."""
    keys = F.coalesce(F.json_object_keys(doc), F.array().cast("array<string>"))
    lacking = F.size(F.array_except(F.array(*[F.lit(k) for k in required]), keys)) > 0
    per = df.select(F.col(group), lacking.cast("int").alias("lacking"), F.get_json_object(doc, "$.market").alias("m"))
    return per.groupBy(group).agg(F.count(F.lit(1)).alias("documents"), F.sum("lacking").alias("lacking_keys"),
                                  (F.count_distinct("m") <= 1).cast("int").alias("consistent_market"))


def coverage_ratio(part: Column, whole: Column) -> Column:
    return F.round(ratio(part, whole), 6)
