"""Adapters from the sample star schema onto the input tables of the marts.

Each adapter is one aggregation that first brings raw rows to one row per key
and day. Prices are summed as whole cents, so results do not depend on the order
in which tasks finish or are retried.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.specs import ASSET_CODES, DAILY_SERIES, MONTHLY_SERIES

# Fixed mapping of sample codes onto market roles.
STATUS_SCOPE = {"F": "KOSPI", "O": "KOSDAQ", "P": "KOSPI200"}
PRIORITY_ROLE = {"1-URGENT": "USDKRW", "2-HIGH": "GOLD", "3-MEDIUM": "BOND", "4-NOT SPECIFIED": "INVERSE", "5-LOW": "CASH"}
EVENT_INVESTOR = {"purchase": "foreign", "click": "institution", "view": "retail", "signup": "pension", "error": "program"}
EVENT_CODE = {"click": "1001", "view": "2001", "purchase": "1028", "signup": "USDKRW", "error": "FUT"}


def cents(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("bigint")


def mapped(mapping: dict[str, str], c: str) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv]), F.col(c))


def listed(names: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), (index + 1).cast("int"))


def mean_price(c: str) -> Column:
    return (F.sum(cents(c)).cast("double") / F.count(F.lit(1)) / 100.0).alias("close")


def total_price(c: str) -> Column:
    return (F.sum(cents(c)).cast("double") / 100.0).alias("value")


class Sample:
    """The sample tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def stock_prices(self) -> DataFrame:
        """A3: one row per ticker and day, ticker = supplier; grows with the supplier count."""
        ticker = F.lpad(F.col("l_suppkey").cast("string"), 6, "0")
        return self.table("lineitem").groupBy(ticker.alias("ticker"), F.col("l_shipdate").cast("date").alias("date")).agg(
            mean_price("l_extendedprice"), total_price("l_extendedprice"), F.sum("l_quantity").alias("volume"))

    @cached_property
    def scope_prices(self) -> DataFrame:
        """A1: index level per market scope and day."""
        scope = mapped(STATUS_SCOPE, "o_orderstatus")
        return self.table("orders").groupBy(scope.alias("market_scope"), F.col("o_orderdate").cast("date").alias("date")).agg(
            mean_price("o_totalprice"), total_price("o_totalprice"))

    @cached_property
    def market_prices(self) -> DataFrame:
        """A3: index and risk proxies; each order counts for its scope and for its role."""
        roles = F.array(mapped(STATUS_SCOPE, "o_orderstatus"), mapped(PRIORITY_ROLE, "o_orderpriority"))
        rows = self.table("orders").select(
            F.explode(roles).alias("ticker"), F.col("o_orderdate").cast("date").alias("date"), "o_totalprice")
        return rows.groupBy("ticker", "date").agg(mean_price("o_totalprice"), total_price("o_totalprice"))

    @cached_property
    def theme_prices(self) -> DataFrame:
        bucket = F.concat(F.lit("theme_"), F.col("l_linenumber").cast("string"))
        return self.table("lineitem").groupBy(bucket.alias("theme_bucket"), F.col("l_shipdate").cast("date").alias("date")).agg(
            mean_price("l_extendedprice"), total_price("l_extendedprice"))

    @cached_property
    def daily_obs(self) -> DataFrame:
        """A4, daily series."""
        series = listed(DAILY_SERIES, F.col("l_partkey") % len(DAILY_SERIES))
        return self.table("lineitem").groupBy(series.alias("series_id"), F.col("l_shipdate").cast("date").alias("asof_date")).agg(
            (F.sum("l_quantity") / F.count(F.lit(1))).alias("value"))

    @cached_property
    def monthly_obs(self) -> DataFrame:
        """A4, monthly series."""
        series = listed(MONTHLY_SERIES, F.col("l_suppkey") % len(MONTHLY_SERIES))
        month = F.trunc(F.col("l_shipdate").cast("date"), "month")
        return self.table("lineitem").groupBy(series.alias("series_id"), month.alias("asof_date")).agg(
            F.sum("l_quantity").alias("value"))

    @cached_property
    def asset_prices(self) -> DataFrame:
        """A6."""
        code = listed(ASSET_CODES, F.col("l_partkey") % len(ASSET_CODES))
        rows = self.table("lineitem").groupBy(code.alias("asset_code"), F.col("l_shipdate").cast("date").alias("asof_date")).agg(
            mean_price("l_extendedprice"))
        return rows.withColumn("adj_close", F.when(F.dayofmonth("asof_date") % 5 != 0, F.col("close") * 0.98))

    @cached_property
    def flows(self) -> DataFrame:
        """Net value of each (day, ticker, investor), summed before anything else."""
        rows = self.table("events").select(
            F.col("ts").cast("date").alias("date"), F.lpad(F.col("user_id").cast("string"), 6, "0").alias("ticker"),
            mapped(EVENT_INVESTOR, "event_type").alias("investor"),
            F.when(F.col("user_id") % 2 == 0, "KOSPI").otherwise("KOSDAQ").alias("market"),
            (cents("value") - 5000).alias("net"))
        return rows.groupBy("date", "ticker", "investor", "market").agg(
            (F.sum("net").cast("double") / 100.0).alias("net_value"), F.count(F.lit(1)).alias("net_volume"))

    @cached_property
    def classification(self) -> DataFrame:
        """A8."""
        c, n, r = self.table("customer"), self.table("nation"), self.table("region")
        joined = c.join(n, c["c_nationkey"] == n["n_nationkey"]).join(r, n["n_regionkey"] == r["r_regionkey"])
        return joined.select(F.lpad(F.col("c_custkey").cast("string"), 6, "0").alias("ticker"),
                             F.col("r_name").alias("market"), F.col("n_name").alias("theme_bucket"),
                             F.col("c_mktsegment").alias("asset_type"))

    @cached_property
    def snapshots(self) -> DataFrame:
        """One row per event."""
        return self.table("events").select(
            "event_id", F.col("ts").alias("asof_ts"), F.col("ts").cast("date").alias("session_date"),
            mapped(EVENT_CODE, "event_type").alias("signal_code"), ((cents("value") - 5000) / 500000.0).alias("change_pct"),
            F.col("value").alias("metric_value"), F.col("props").alias("detail_json"), "user_id")

    @cached_property
    def bars(self) -> DataFrame:
        """Fifteen-minute means per code; bounded by the calendar."""
        slot = F.window(F.col("ts"), "15 minutes")["start"]
        return self.table("events").groupBy(slot.alias("asof_ts"), mapped(EVENT_CODE, "event_type").alias("signal_code")).agg(
            (F.sum(cents("value") - 5000).cast("double") / F.count(F.lit(1)) / 500000.0).alias("change_pct"),
            F.count(F.lit(1)).alias("n"))

    @cached_property
    def spine(self) -> DataFrame:
        return self.table("orders").select(F.col("o_orderdate").cast("date").alias("asof_date")).distinct()

    @cached_property
    def predictions(self) -> DataFrame:
        """Class weights summed per (model, scope, horizon, day) and normalised to one."""
        k = F.col("o_orderkey")
        horizon = F.explode(F.array(F.lit(5), F.lit(20)))
        rows = self.table("orders").select(
            "*", horizon.alias("h")).select(
            F.concat(F.lit("m"), (k % 2).cast("string")).alias("model"), mapped(STATUS_SCOPE, "o_orderstatus").alias("market_scope"),
            F.concat(F.col("h").cast("string"), F.lit("d")).alias("forecast_horizon"),
            F.col("o_orderdate").cast("date").alias("asof_date"),
            (1 + (k * 7 + F.col("h")) % 11).alias("wd"), (1 + (k * 13 + F.col("h")) % 7).alias("ws"),
            (1 + (k * 17 + F.col("h")) % 13).alias("wu"), cents("o_totalprice").alias("c"))
        keys = ["model", "market_scope", "forecast_horizon", "asof_date"]
        g = rows.groupBy(*keys).agg(F.sum("wd").alias("wd"), F.sum("ws").alias("ws"), F.sum("wu").alias("wu"), F.sum("c").alias("c"))
        total = (F.col("wd") + F.col("ws") + F.col("wu")).cast("double")
        label = F.when(F.col("c") % 3 == 0, "down").when(F.col("c") % 3 == 1, "sideways").otherwise("up")
        return g.select(*keys, F.lit("q40_q60").alias("label_policy"), F.year("asof_date").alias("test_year"),
                        label.alias("actual_label"), (F.col("wd") / total).alias("prob_down"),
                        (F.col("ws") / total).alias("prob_sideways"), (F.col("wu") / total).alias("prob_up"))

    @cached_property
    def scores(self) -> DataFrame:
        """Three score-like columns per event on [-3.5, 3.5) with nulls, plus small ratios."""
        c, k = cents("value"), F.col("event_id")

        def spread(x: Column, hole: int) -> Column:
            return F.when(k % hole != 0, (x % 700 - 350) / 100.0)

        return self.table("events").select(
            "event_id", "event_type", "user_id", "ts", spread(c, 17).alias("s1"), spread(c * 3 + k, 19).alias("s2"),
            spread(c * 7 + k * 11, 23).alias("s3"), (c % 101 / 100.0).alias("u1"), ((c + k) % 101 / 100.0).alias("u2"))
