"""Joins, unions, latest-row and top-k selections."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.numeric import as_col


# -- selections ---------------------------------------------------------------

def pick_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int = 1, rank: str | None = None) -> DataFrame:
    """T3, T6, T8. First ``n`` rows per key in the given order.

    For ``n`` = 1 prefer ``latest_per_key``, which aggregates map-side.
    """
    name = rank or "__rk"
    out = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(name) <= n)
    return out if rank else out.drop(name)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], earliest: bool = False) -> DataFrame:
    """A7, J16, U4, W39. Last row per key as one aggregate.

    ``max_by`` combines map-side, so a hot key ships one row per task.
    """
    rest = [c for c in df.columns if c not in keys]
    by = F.struct(*order) if len(order) > 1 else F.col(order[0])
    chosen = (F.min_by if earliest else F.max_by)(F.struct(*rest), by)
    return df.groupBy(*keys).agg(chosen.alias("__row")).select(*keys, "__row.*").select(*df.columns)


def extremes(df: DataFrame, keys: Sequence[str], label: str, score: str) -> DataFrame:
    """T9. Strongest and weakest member of each group."""
    by = F.struct(score, label)
    return df.where(F.col(score).isNotNull()).groupBy(*keys).agg(
        F.max_by(label, by).alias("strongest"), F.max(score).alias("strongest_score"),
        F.min_by(label, by).alias("weakest"), F.min(score).alias("weakest_score"))


def top_structs(candidates: Column, k: int = 3) -> Column:
    """T1, T10. First k elements of an array of structs ordered by their leading field, best first."""
    return F.slice(F.sort_array(F.filter(candidates, lambda x: x.isNotNull()), asc=False), 1, k)


def rows_at_latest(df: DataFrame, keys: Sequence[str], date: str, upto: Column | None = None) -> DataFrame:
    """T12, A33, J25. All rows of the newest date (at or before ``upto``) per key."""
    pool = df if upto is None else df.where(F.col(date) <= upto)
    newest = pool.groupBy(*keys).agg(F.max(date).alias(date))
    return pool.join(newest, [*keys, date], "left_semi")


def last_n_ascending(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """T7. Newest n rows, returned oldest first."""
    return df.orderBy(*[F.desc(c) for c in order]).limit(n).orderBy(*order)


def near_best(df: DataFrame, keys: Sequence[str], score: str, tolerance: float, order: Sequence[Column]) -> DataFrame:
    """T4. Rows within ``tolerance`` of the group's best score, then the first in ``order``."""
    best = df.groupBy(*keys).agg(F.max(score).alias("__best"))
    close = df.join(best, list(keys)).where(F.col(score) >= F.col("__best") - tolerance).drop("__best")
    return pick_first(close, keys, order)


# -- joins ----------------------------------------------------------------------

def star_join(base: DataFrame, parts: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """J1-J3. Chain of left joins; AQE broadcasts the parts that turn out small."""
    return reduce(lambda left, part: left.join(part[0], list(part[1]), "left"), parts, base)


def overlay(base: DataFrame, actual: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """J11. Non-null actual values replace the base values."""
    a = actual.select(*keys, *[F.col(c).alias(f"__a_{c}") for c in columns])
    joined = base.join(a, list(keys), "left")
    return joined.select(*[
        (F.coalesce(f"__a_{c}", c).alias(c) if c in columns else F.col(c)) for c in base.columns])


def missing_keys(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """J9, Q8. Expected keys without an actual row."""
    return expected.select(*keys).distinct().join(actual, list(keys), "left_anti")


def attach_with_default(df: DataFrame, dim: DataFrame, keys: Sequence[str], defaults: dict[str, object]) -> DataFrame:
    """J19. Left join with fallback values for unmatched keys."""
    joined = df.join(dim, list(keys), "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def with_benchmark(df: DataFrame, keys: Sequence[str], scope: str, benchmark: str, value: str, out: str) -> DataFrame:
    """J18. Value of the benchmark scope on the same keys, through one aggregate joined back."""
    ref = df.where(F.col(scope) == benchmark).groupBy(*keys).agg(F.max(value).alias(out))
    return df.join(ref, list(keys), "left")


def explode_grid(df: DataFrame, rows: Sequence[dict]) -> DataFrame:
    """J24, R4. Each row times a literal parameter list, generated without a join."""
    entries = [F.struct(*[F.lit(v).alias(k) for k, v in row.items()]) for row in rows]
    return df.withColumn("__g", F.explode(F.array(*entries))).select(*df.columns, "__g.*")


# -- unions ----------------------------------------------------------------------

def union_by_priority(frames: Sequence[tuple[DataFrame, int]], keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """U3, S4, S21. Schema-tolerant union, best priority (lowest number) per key wins."""
    tagged = [df.withColumn("__p", F.lit(p)) for df, p in frames]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    rest = [c for c in merged.columns if c not in keys and c != "__p"]
    by = F.struct(F.col("__p"), *[F.col(c) for c in order])
    out = merged.groupBy(*keys).agg(F.min_by(F.struct(*rest), by).alias("__row"))
    return out.select(*keys, "__row.*")


def with_all_scope(df: DataFrame, scope: str, all_name: str = "ALL", out: str | None = None) -> DataFrame:
    """U5. Every row under its own scope and under the ALL scope."""
    return df.withColumn(out or scope, F.explode(F.array(F.col(scope), F.lit(all_name))))


def with_scope_alias(df: DataFrame, scope: str, of: str, alias: str) -> DataFrame:
    """U6. Rows of one scope repeated under an alias."""
    both = F.array(F.col(scope), F.lit(alias))
    return df.withColumn(scope, F.explode(F.when(F.col(scope) == of, both).otherwise(F.array(F.col(scope)))))


def append_later(base: DataFrame, extra: DataFrame, keys: Sequence[str], date: str) -> DataFrame:
    """U8. Base rows plus the extra rows dated after the last base row of the key."""
    ends = base.groupBy(*keys).agg(F.max(date).alias("__end"))
    later = extra.join(ends, list(keys), "left").where(F.col("__end").isNull() | (F.col(date) > F.col("__end")))
    return base.unionByName(later.drop("__end"), allowMissingColumns=True)


def select_tolerant(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """S7. Wanted columns in order; absent ones as typed nulls."""
    return df.select(*[
        (F.col(c).cast(t) if c in df.columns else F.lit(None).cast(t)).alias(c) for c, t in columns.items()])


# -- reshape ------------------------------------------------------------------------

def pivot_wide(df: DataFrame, keys: Sequence[str], column: str, members: Sequence[str], value: Column,
               prefix: str = "", suffix: str = "") -> DataFrame:
    """R1, R2. Fixed-member pivot in one aggregation."""
    out = df.groupBy(*keys).pivot(column, list(members)).agg(value)
    return out.select(*keys, *[F.col(f"`{m}`").alias(f"{prefix}{m}{suffix}") for m in members])


def unpivot_long(df: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    """R3, S16."""
    return df.unpivot(list(keys), list(columns), name, value)


def nest_points(df: DataFrame, keys: Sequence[str], fields: Sequence[str], out: str = "points") -> DataFrame:
    """R5. Series rows to one ordered points array per series (bounded by its days)."""
    return df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(out))


def unnest_points(df: DataFrame, keys: Sequence[str], doc: str, schema: str) -> DataFrame:
    """R6. JSON points array to rows."""
    return df.select(*keys, F.explode(F.from_json(doc, schema)).alias("__p")).select(*keys, "__p.*")


def ladder_quantile_bucket(value: Column | str, edges: Sequence[Column | str], labels: Sequence[str]) -> Column:
    """A10. Right-closed bucket by ascending edges; null stays null."""
    v = as_col(value)
    out = F.when(v.isNull(), F.lit(None).cast("string"))
    for edge, label in zip(edges, labels):
        out = out.when(v <= as_col(edge), F.lit(label))
    return out.otherwise(F.lit(labels[len(edges)]))
