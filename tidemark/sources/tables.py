"""Typed scans: panels, seeds, universes, optional tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import text as X
from tidemark.functions.numeric import clean
from tidemark.operators.relational import latest_per_key, pick_first, union_by_priority

WARM_UP_DAYS = 520


def as_date(d) -> Column:
    return d if isinstance(d, Column) else F.lit(d).cast("date")


def price_panel(df: DataFrame, tickers: Sequence[str], start, end, warm_up: int = WARM_UP_DAYS) -> DataFrame:
    """S1. Wanted tickers with a warm-up before ``start``; rows without a close are dropped.

    All three tests are plain comparisons on columns and reach the Parquet scan;
    the lower bound is computed here, not per row.
    """
    keep = F.col("ticker").isin(list(tickers)) & F.col("date").between(F.date_sub(as_date(start), warm_up), as_date(end))
    return df.where(keep & F.col("close").isNotNull())


def latest_n(df: DataFrame, keys: Sequence[str], date: str, n: int = 120, upto=None) -> DataFrame:
    """S2. Newest n rows of every code up to a date."""
    pool = df if upto is None else df.where(F.col(date) <= as_date(upto))
    return pick_first(pool, keys, [F.desc(date)], n)


def asset_panel(df: DataFrame, start=None, end=None, date: str = "asof_date") -> DataFrame:
    """S3. Open-ended date range."""
    if start is not None:
        df = df.where(F.col(date) >= as_date(start))
    return df if end is None else df.where(F.col(date) <= as_date(end))


def series_with_priority(sources: Sequence[DataFrame], key: str = "series_id", date: str = "asof_date", value: str = "value") -> DataFrame:
    """S4. Best source per series and date, first listed wins; null values never override."""
    present = [(s.where(F.col(value).isNotNull()).select(key, date, value), i) for i, s in enumerate(sources)]
    return union_by_priority(present, [key, date])


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """S5. CSV with header; a byte-order mark in front of the first name is ignored."""
    raw = spark.read.csv(path, header=True, inferSchema=False)
    renamed = raw.toDF(*[c.replace("﻿", "").strip() for c in raw.columns])
    wanted = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    return renamed.select(*[
        (F.nullif(F.trim(F.col(f.name)), F.lit("")).try_cast(f.dataType) if f.name in renamed.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in wanted])


def optional_table(spark: SparkSession, name: str, schema: str) -> DataFrame:
    """S6. The table, or no rows of its schema."""
    return spark.table(name) if spark.catalog.tableExists(name) else spark.createDataFrame([], schema)


def optional_parquet(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """S6 for a folder on shared storage."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
    return spark.read.parquet(path) if there else spark.createDataFrame([], schema)


def normalised_prices(df: DataFrame, names: dict[str, str], required: str = "close") -> DataFrame:
    """S18. Rename vendor columns, NaN to null, drop rows without the required value."""
    out = df.withColumnsRenamed(names)
    doubles = [f.name for f in out.schema if isinstance(f.dataType, T.DoubleType)]
    return out.withColumns({c: clean(c) for c in doubles}).dropna(subset=[required])


def universe(df: DataFrame, aliases: Sequence[str], order: str, limit: int | None = None) -> DataFrame:
    """S19. Ticker from the first alias column present, one row each, optional limit."""
    present = [c for c in aliases if c in df.columns]
    code = X.ticker_code(F.coalesce(*[F.col(c).cast("string") for c in present]))
    rows = df.select(code.alias("ticker"), F.col(order).alias("__o")).where(F.col("ticker").isNotNull())
    out = rows.groupBy("ticker").agg(F.min("__o").alias("__o"))
    return (out.orderBy("__o", "ticker").limit(limit) if limit else out).select("ticker")


def manual_rates(df: DataFrame, names: dict[str, str], source: str = "manual_seed") -> DataFrame:
    """S20. Seed rows with default names and source; incomplete rows are dropped."""
    text = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    known = F.try_element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), text("rate_code"))
    out = df.select(F.try_to_date(text("date"), "yyyy-MM-dd").alias("date"), text("rate_code").alias("rate_code"),
                    F.coalesce(text("rate_name"), known, text("rate_code")).alias("rate_name"), text("value").try_cast("double").alias("value"),
                    F.coalesce(text("source"), F.lit(source)).alias("source"))
    return out.where(F.col("date").isNotNull() & F.col("rate_code").isNotNull() & F.col("value").isNotNull())


def incremental_start(codes: DataFrame, stored: DataFrame, key: str, date: str, asof, overlap: int = 5, default: int = 120) -> DataFrame:
    """S26. Next collection start per code: last stored day less the overlap, else a default history."""
    last = stored.groupBy(key).agg(F.max(date).alias("__last"))
    return codes.select(key).distinct().join(last, key, "left").select(
        key, F.coalesce(F.date_sub("__last", overlap), F.date_sub(as_date(asof), default)).alias("start_date"))


def flow_scan(df: DataFrame, start, end, investors: Sequence[str]) -> DataFrame:
    """S30. Flow rows of the wanted investors in a date range, ticker padded."""
    rows = df.where(F.col("date").between(as_date(start), as_date(end)) & F.col("investor").isin(list(investors)))
    return rows.withColumn("ticker", X.ticker_code("ticker"))


def latest_document(df: DataFrame, keys: Sequence[str], asof: str, kind: str, wanted: str, doc: str, guard: str) -> DataFrame:
    """S33. Newest document of one type per key, kept only where its guard field is true."""
    newest = latest_per_key(df.where(F.col(kind) == wanted).select(*keys, asof, doc), keys, [asof])
    return newest.where(F.get_json_object(doc, f"$.{guard}") == "true")


def universe_or_instruments(listed: DataFrame, instruments: DataFrame, day: str, asof) -> DataFrame:
    """S35. Tickers of the dated list; when that day has none, the active stocks."""
    dated = listed.where(F.col(day) == as_date(asof)).select("ticker")
    count = dated.agg(F.count(F.lit(1))).scalar()
    active = instruments.where((F.col("is_active") == 1) & (F.col("asset_type") == "STOCK")).select("ticker")
    return dated.unionByName(active.where(count == 0)).distinct()


def unite(frames: Sequence[DataFrame]) -> DataFrame:
    """U1, U2. Schema-tolerant union of several frames."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
