"""Keyed sinks on plain Parquet: upserts, replacements, manifests."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.relational import union_by_priority
from tidemark.session import cut_lineage
from tidemark.sources.tables import optional_parquet


def merged(old: DataFrame, new: DataFrame, keys: Sequence[str], keep_first: Sequence[str] = ()) -> DataFrame:
    """S21, S29. New rows replace old rows of the same key; ``keep_first`` columns keep the old value.

    One aggregation by key over the union; no row is sorted.
    """
    out = union_by_priority([(new, 0), (old, 1)], keys)
    if keep_first:
        kept = old.select(*keys, *[F.col(c).alias(f"__{c}") for c in keep_first])
        out = out.join(kept, list(keys), "left").withColumns({c: F.coalesce(F.col(f"__{c}"), F.col(c)) for c in keep_first})
        out = out.drop(*[f"__{c}" for c in keep_first])
    return out


def upsert(spark: SparkSession, path: str, new: DataFrame, keys: Sequence[str], partition: str | None = None, keep_first: Sequence[str] = ()) -> None:
    """S21. Merge ``new`` into the Parquet folder.

    With a partition column only the partitions present in ``new`` are read and
    rewritten. The merged rows are cut from the files they came from in the shared
    checkpoint folder before the write, so a lost executor recomputes from there
    and never from files already replaced.
    """
    old = optional_parquet(spark, path, new.schema.simpleString()[7:-1])
    if partition and set(old.columns) >= {partition}:
        old = old.join(new.select(partition).distinct(), partition, "left_semi")
    result = cut_lineage(merged(old, new, keys, keep_first))
    writer = result.write.mode("overwrite")
    if partition:
        writer = writer.partitionBy(partition).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def replace_table(df: DataFrame, path: str, partition: str | None = None) -> None:
    """S22. Whole table."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition) if partition else writer).parquet(path)


def replace_days(df: DataFrame, path: str, date: str) -> None:
    """S31. All rows of the days present in ``df``; other days stay."""
    spread = df.repartition(date).sortWithinPartitions(date)
    spread.write.mode("overwrite").partitionBy(date).option("partitionOverwriteMode", "dynamic").parquet(path)


def days_replaced(old: DataFrame, new: DataFrame, date: str) -> DataFrame:
    """S31 as a frame."""
    return old.join(new.select(date).distinct(), date, "left_anti").unionByName(new, allowMissingColumns=True)


def write_csv_pair(df: DataFrame, full: str, current: str, is_current: Column | None = None) -> None:
    """S23. Full CSV and the current one (all rows, or those that ``is_current`` keeps) from one materialised frame."""
    once = cut_lineage(df)
    for path, rows in ((full, once), (current, once if is_current is None else once.where(is_current))):
        rows.write.mode("overwrite").option("header", True).csv(path)


def payload_rows(df: DataFrame, market: Column, asof: Column, kind: str, fields: Sequence[str]) -> DataFrame:
    """S24. Rows as JSON documents keyed (market, asof, payload_type)."""
    return df.select(market.alias("market"), asof.alias("asof"), F.lit(kind).alias("payload_type"), F.to_json(F.struct(*fields)).alias("payload_json"))


def manifest(df: DataFrame, name: str, keys: Sequence[str], date: str) -> DataFrame:
    """S25. Row count, date range and surplus key rows of one table."""
    distinct_keys = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(date).alias("lo"), F.max(date).alias("hi"))
    return distinct_keys.agg(F.lit(name).alias("table_name"), F.sum("n").alias("row_count"), F.min("lo").alias("first_date"),
                             F.max("hi").alias("last_date"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_keys"))


def schema_contract(schema: T.StructType, keys: Sequence[str]) -> str:
    """S25. Column contract as JSON text (driver only, no data)."""
    fields = [{"name": f.name, "type": f.dataType.simpleString(), "nullable": f.nullable and f.name not in keys, "metadata": f.metadata} for f in schema]
    return json.dumps({"primary_key": list(keys), "columns": fields}, ensure_ascii=False)


def evolve(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """S27. Added columns as typed nulls where absent."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns})


def run_log(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """S28. Collection status per key: rows, missing values, status."""
    rows, missing = F.count(F.lit(1)), F.count_if(F.col(value).isNull())
    status = F.when(missing == 0, "ok").when(missing < rows, "partial").otherwise("empty")
    return df.groupBy(*keys).agg(rows.alias("row_count"), missing.alias("missing_count"), status.alias("status"))


def context_audit(df: DataFrame, keys: Sequence[str], headlines: str, risk_headlines: str, urls: str) -> DataFrame:
    """S34. Sizes and flags of a context document."""
    return df.select(*keys, F.size(headlines).alias("headline_count"), F.size(risk_headlines).alias("risk_headline_count"),
                     F.size(F.array_distinct(urls)).alias("source_count"), (F.size(risk_headlines) > 0).cast("int").alias("caution_flag"))
