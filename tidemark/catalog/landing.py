"""Scan, landing and sink queries.

Vendor documents are built by Spark from the sample tables (one document per
series, so their number and size follow the tables) and parsed back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.expressions import rd
from tidemark.catalog.registry import query, r
from tidemark.session import scratch_folder
from tidemark.sources import landed as G
from tidemark.sources import sinks as K
from tidemark.sources import tables as B
from tidemark.sources import versions as V


def document(df, keys, element, shape_name):
    """One JSON document per key holding an array of the element structs."""
    rows = df.groupBy(*keys).agg(F.sort_array(F.collect_list(element)).alias("__a"))
    return rows.select(*keys, F.to_json(shape_name(F.col("__a"))).alias("payload"))


def text(c):
    return F.col(c).cast("string")


@query("s1_price_panel_scan", """
SELECT ticker, date, close FROM stock_prices WHERE ticker IN ('000001', '000002', '000016') AND date BETWEEN DATE '1998-01-01' - 520 AND DATE '2000-12-31' AND close IS NOT NULL""")
def s1(t):
    return B.price_panel(t.stock_prices, ["000001", "000002", "000016"], "1998-01-01", "2000-12-31").select("ticker", "date", "close")


@query("s2_latest_n_series", """
SELECT ticker, date, close FROM stock_prices WHERE date <= DATE '2001-06-30' QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) <= 120""")
def s2(t):
    return B.latest_n(t.stock_prices.select("ticker", "date", "close"), ["ticker"], "date", 120, "2001-06-30")


@query("s3_asset_panel_scan", "SELECT asset_code, asof_date, close, adj_close FROM asset_prices WHERE asof_date >= DATE '1999-01-01'")
def s3(t):
    return B.asset_panel(t.asset_prices, start="1999-01-01").select("asset_code", "asof_date", "close", "adj_close")


@query("s4_source_priority", """
SELECT series_id, asof_date, coalesce(CASE WHEN series_id IN ('DGS2', 'DGS10') AND day(asof_date) % 2 = 0 THEN value * 2 END, value) AS value FROM daily_obs""")
def s4(t):
    override = t.daily_obs.where(F.col("series_id").isin("DGS2", "DGS10")).withColumn("value", F.when(F.dayofmonth("asof_date") % 2 == 0, F.col("value") * 2))
    return B.series_with_priority([override, t.daily_obs])


@query("s7_tolerant_select", "SELECT o_orderkey, o_totalprice, CAST(NULL AS DOUBLE) AS adj_close FROM orders")
def s7(t):
    from tidemark.operators.relational import select_tolerant

    return select_tolerant(t.table("orders"), {"o_orderkey": "bigint", "o_totalprice": "double", "adj_close": "double"})


@query("s8_fred_documents", "SELECT series_id, asof_date, CASE WHEN day(asof_date) % 7 <> 0 THEN value END AS value FROM daily_obs")
def s8(t):
    element = F.struct(text("asof_date").alias("date"), F.when(F.dayofmonth("asof_date") % 7 != 0, text("value")).otherwise(".").alias("value"))
    docs = document(t.daily_obs, ["series_id"], element, lambda a: F.struct(a.alias("observations")))
    return G.fred_observations(docs, ["series_id"]).select("series_id", "asof_date", "value")


@query("s9_bls_documents", "SELECT series_id, asof_date, value FROM monthly_obs")
def s9(t):
    el = F.struct(F.year("asof_date").cast("string").alias("year"), F.date_format("asof_date", "'M'MM").alias("period"), text("value").alias("value"))
    annual = t.monthly_obs.groupBy("series_id", F.year("asof_date").alias("y")).agg(F.avg("value").alias("value"))
    rows = t.monthly_obs.select("series_id", el.alias("e")).unionByName(
        annual.select("series_id", F.struct(text("y").alias("year"), F.lit("M13").alias("period"), text("value").alias("value")).alias("e")))
    docs = rows.groupBy("series_id").agg(F.collect_list("e").alias("data"))
    docs = docs.select(F.to_json(F.struct(F.struct(F.array(F.struct(F.col("series_id").alias("seriesID"), "data")).alias("series")).alias("Results"))).alias("payload"))
    return G.bls_observations(docs)


@query("s10_bea_documents", """
SELECT series_id, make_date(year(asof_date), ((month(asof_date) - 1) // 3) * 3 + 1, 1) AS asof_date, sum(value) AS value FROM monthly_obs GROUP BY 1, 2""")
def s10(t):
    q = t.monthly_obs.groupBy("series_id", F.concat(F.year("asof_date"), F.lit("Q"), F.quarter("asof_date")).alias("TimePeriod")).agg(F.sum("value").alias("v"))
    el = F.struct(F.col("series_id").alias("SeriesCode"), "TimePeriod", F.format_number("v", 1).alias("DataValue"))
    docs = document(q, ["series_id"], el, lambda a: F.struct(F.struct(F.struct(a.alias("Data")).alias("Results")).alias("BEAAPI")))
    return G.bea_observations(docs.select("payload"))


@query("s11_eia_documents", "SELECT series_id, asof_date, value FROM monthly_obs UNION ALL SELECT series_id || '_D', asof_date, value FROM daily_obs WHERE series_id = 'VIXCLS'")
def s11(t):
    el = lambda fmt: F.struct(F.date_format("asof_date", fmt).alias("period"), text("value").alias("value"))
    shape = lambda a: F.struct(F.struct(a.alias("data")).alias("response"))
    monthly = document(t.monthly_obs, ["series_id"], el("yyyyMM"), shape)
    daily = t.daily_obs.where(F.col("series_id") == "VIXCLS").withColumn("series_id", F.concat("series_id", F.lit("_D")))
    return G.eia_observations(monthly.unionByName(document(daily, ["series_id"], el("yyyy-MM-dd"), shape)), ["series_id"])


@query("s12_treasury_entries", """
SELECT d AS asof_date, unnest(['DGS3MO', 'DGS2', 'DGS10', 'DGS30']) AS series_id, unnest([a, b, c, CAST(NULL AS DOUBLE)]) AS value FROM (
  SELECT date AS d, max(value) FILTER (theme_bucket = 'theme_1') AS a, max(value) FILTER (theme_bucket = 'theme_2') AS b, max(value) FILTER (theme_bucket = 'theme_3') AS c FROM theme_prices GROUP BY 1)""")
def s12(t):
    pick = lambda n: F.max(F.when(F.col("theme_bucket") == n, F.col("value")))
    wide = t.theme_prices.groupBy("date").agg(pick("theme_1").alias("a"), pick("theme_2").alias("b"), pick("theme_3").alias("c"))
    tag = lambda name, c: F.when(F.col(c).isNotNull(), F.concat(F.lit(f"<{name}>"), F.format_string("%.2f", c), F.lit(f"</{name}>"))).otherwise("")
    entry = F.concat(F.lit("<entry><content><properties><NEW_DATE>"), text("date"), F.lit("T00:00:00</NEW_DATE>"), tag("BC_3MONTH", "a"), tag("BC_2YEAR", "b"),
                     tag("BC_10YEAR", "c"), F.lit("</properties></content></entry>"))
    return G.treasury_yields(wide.select(entry.alias("entry")))


@query("s13_ecos_documents", "SELECT 'M' AS cycle, series_id AS item_code, asof_date, value FROM monthly_obs UNION ALL SELECT 'D', series_id, asof_date, value FROM daily_obs")
def s13(t):
    el = lambda fmt: F.struct(F.date_format("asof_date", fmt).alias("TIME"), text("value").alias("DATA_VALUE"), F.col("series_id").alias("ITEM_CODE1"))
    shape = lambda a: F.struct(F.struct(a.alias("row")).alias("StatisticSearch"))
    m = document(t.monthly_obs.withColumn("cycle", F.lit("M")), ["cycle", "series_id"], el("yyyyMM"), shape)
    d = document(t.daily_obs.withColumn("cycle", F.lit("D")), ["cycle", "series_id"], el("yyyyMMdd"), shape)
    return G.ecos_observations(m.unionByName(d).drop("series_id"), ["cycle"])


def charts(t):
    rows = t.asset_prices.withColumn("ts", F.unix_date("asof_date").cast("bigint") * 86400 + 3600)
    a = rows.groupBy("asset_code").agg(F.array_sort(F.collect_list(F.struct("ts", "close", "adj_close"))).alias("a"))
    close = F.transform("a", lambda x: F.when(x["ts"] % 11 != 0, x["close"]))
    quote = F.struct(close.alias("open"), close.alias("high"), close.alias("low"), close.alias("close"), F.transform("a", lambda x: x["close"] * 0 + 5.0).alias("volume"))
    adj = F.when(F.col("asset_code") != "SPY", F.array(F.struct(F.transform("a", lambda x: x["adj_close"]).alias("adjclose"))))
    meta = F.struct(F.when(F.col("asset_code") == "QQQ", 123.5).alias("regularMarketPrice"), F.lit(100.0).alias("chartPreviousClose"))
    doc = F.to_json(F.struct(meta.alias("meta"), F.transform("a", lambda x: x["ts"]).alias("timestamp"), F.struct(F.array(quote).alias("quote"), adj.alias("adjclose")).alias("indicators")))
    return a.select("asset_code", doc.alias("payload"))


CHART = "(SELECT *, (asof_date - DATE '1970-01-01') * 86400 + 3600 AS ts FROM asset_prices)"


@query("s14_chart_rows", f"SELECT asset_code, asof_date, close, CASE WHEN asset_code = 'SPY' THEN close ELSE adj_close END AS adj_close, 5.0::DOUBLE AS volume FROM {CHART} WHERE ts % 11 <> 0")
def s14(t):
    return G.chart_rows(charts(t), ["asset_code"]).select("asset_code", "asof_date", "close", "adj_close", "volume")


@query("s15_chart_quotes", f"""
SELECT asset_code, CASE WHEN asset_code = 'QQQ' THEN 123.5::DOUBLE ELSE last END AS price, {r("CASE WHEN asset_code = 'QQQ' THEN 123.5::DOUBLE ELSE last END / 100 - 1")} AS change_pct FROM (
  SELECT asset_code, arg_max(close, ts) FILTER (ts % 11 <> 0) AS last FROM {CHART} GROUP BY 1)""")
def s15(t):
    return G.chart_quote(charts(t), ["asset_code"]).select("asset_code", "price", rd("change_pct").alias("change_pct"))


INVESTORS = ["foreign", "institution", "retail", "pension", "program"]


@query("s16_investor_wide_to_long", f"SELECT d.date, i.investor, f.net_buy_value FROM (SELECT DISTINCT date FROM flows) d CROSS JOIN (SELECT unnest({INVESTORS}) AS investor) i LEFT JOIN (SELECT date, investor, {r('sum(net_value)', 0)} AS net_buy_value FROM flows GROUP BY 1, 2) f USING (date, investor)")
def s16(t):
    wide = t.flows.groupBy("date").pivot("investor", INVESTORS).agg(F.format_number(F.round(F.sum("net_value"), 0), 0))
    return G.investor_wide_to_long(wide, ["date"], {c: c for c in INVESTORS})


@query("s17_amount_quantity_merge", f"""
SELECT date, ticker, k.investor, v.net_volume, v.net_value FROM (SELECT DISTINCT date, ticker FROM flows) d CROSS JOIN (VALUES ('외국인', 'foreign'), ('기관합계', 'institution')) k(investor, src)
LEFT JOIN (SELECT date, ticker, investor AS src, sum(net_volume)::DOUBLE AS net_volume, {r('sum(net_value)', 0)} * 1000000 AS net_value FROM flows GROUP BY 1, 2, 3) v USING (date, ticker, src)""")
def s17(t):
    fields = {"외국인": "foreign", "기관합계": "institution"}
    wide = lambda agg: t.flows.groupBy("date", "ticker").pivot("investor", list(fields.values())).agg(agg)
    return G.amount_quantity_records(wide(F.format_number(F.round(F.sum("net_value"), 0), 0)), wide(F.sum("net_volume").cast("string")), ["date", "ticker"], fields)


@query("s18_normalised_index", "SELECT o_orderstatus AS index_code, o_orderdate::DATE AS date, count(*) AS n, min(o_totalprice) AS low FROM orders WHERE o_totalprice > 1000 GROUP BY 1, 2")
def s18(t):
    raw = t.table("orders").select(F.col("o_orderstatus").alias("code"), F.col("o_orderdate").cast("date").alias("Date"),
                                   F.when(F.col("o_totalprice") > 1000, F.col("o_totalprice")).otherwise(F.lit(float("nan"))).alias("Close"))
    rows = B.normalised_prices(raw, {"code": "index_code", "Date": "date", "Close": "close"})
    return rows.groupBy("index_code", "date").agg(F.count(F.lit(1)).alias("n"), F.min("close").alias("low"))


@query("s19_universe", "SELECT ticker FROM (SELECT lpad(s_suppkey::VARCHAR, 6, '0') AS ticker, min(s_nationkey) AS o FROM supplier GROUP BY 1) ORDER BY o, ticker LIMIT 40")
def s19(t):
    return B.universe(t.table("supplier").withColumnRenamed("s_suppkey", "code"), ["ticker", "code", "stock_code"], "s_nationkey", 40)


@query("s20_manual_rates", """
SELECT asof_date AS date, series_id AS rate_code, CASE series_id WHEN 'FEDFUNDS' THEN 'Base Rate' ELSE series_id END AS rate_name, value, CASE WHEN month(asof_date) = 1 THEN 'desk' ELSE 'manual_seed' END AS source FROM monthly_obs WHERE month(asof_date) <> 2""")
def s20(t):
    raw = t.monthly_obs.select(text("asof_date").alias("date"), F.col("series_id").alias("rate_code"), F.lit(" ").alias("rate_name"),
                               F.when(F.month("asof_date") != 2, text("value")).otherwise("").alias("value"), F.when(F.month("asof_date") == 1, "desk").alias("source"))
    return B.manual_rates(raw, {"FEDFUNDS": "Base Rate"})


@query("s21_keyed_upsert", "SELECT series_id, asof_date, CASE WHEN asof_date >= DATE '2001-01-01' THEN value + 1 ELSE value END AS value FROM daily_obs WHERE asof_date >= DATE '2001-01-01' OR asof_date < DATE '2001-06-01'")
def s21(t):
    old = t.daily_obs.where(F.col("asof_date") < "2001-06-01")
    new = t.daily_obs.where(F.col("asof_date") >= "2001-01-01").withColumn("value", F.col("value") + 1)
    return K.merged(old, new, ["series_id", "asof_date"])


@query("s21_published_upsert", "SELECT series_id, asof_date, CASE WHEN asof_date >= DATE '2001-01-01' THEN value + 1 ELSE value END AS value, 2 AS version FROM daily_obs WHERE asof_date >= DATE '2001-01-01' OR asof_date < DATE '2001-06-01'")
def s21_published(t):
    """Written and read back: the second version holds the merged rows."""
    root = scratch_folder(t.spark, "daily-obs")
    V.upsert(t.daily_obs.where(F.col("asof_date") < "2001-06-01"), root, ["series_id", "asof_date"])
    V.upsert(t.daily_obs.where(F.col("asof_date") >= "2001-01-01").withColumn("value", F.col("value") + 1), root, ["series_id", "asof_date"])
    return V.read(t.spark, root).select("series_id", "asof_date", "value", F.lit(V.latest(t.spark, root).number).alias("version"))


@query("s22_replace_all", """
SELECT 1 AS version, count(*) AS row_count, min(asof_date) AS first_date, max(asof_date) AS last_date, false AS is_latest FROM daily_obs
UNION ALL SELECT 2, count(*), min(asof_date), max(asof_date), true FROM monthly_obs""")
def s22(t):
    """A table replaced whole: readers follow the manifest to the second version, the first stays readable."""
    root = scratch_folder(t.spark, "observations")
    first, second = V.replace(t.daily_obs, root), V.replace(t.monthly_obs, root)
    latest = V.latest(t.spark, root).number
    frames = [V.read(t.spark, root, v.number).agg(F.lit(v.number).alias("version"), F.count(F.lit(1)).alias("row_count"), F.min("asof_date").alias("first_date"), F.max("asof_date").alias("last_date"),
                                                  F.lit(v.number == latest).alias("is_latest")) for v in (first, second)]
    return frames[0].unionByName(frames[1])


@query("s23_csv_pair", "SELECT market_scope, date, close, which FROM scope_prices, (VALUES ('full'), ('current')) w(which) WHERE which = 'full' OR date >= DATE '1997-01-01'")
def s23(t):
    """Full and current CSV, both written and read back."""
    full, current = scratch_folder(t.spark, "csv-full"), scratch_folder(t.spark, "csv-current")
    schema = "market_scope string, date date, close double"
    K.write_csv_pair(t.scope_prices.select("market_scope", "date", "close"), full, current, F.col("date") >= "1997-01-01")
    return B.read_csv(t.spark, full, schema).withColumn("which", F.lit("full")).unionByName(B.read_csv(t.spark, current, schema).withColumn("which", F.lit("current")))


@query("s5_csv_scan", "SELECT series_id, asof_date, value FROM daily_obs")
def s5(t):
    """A CSV file whose header begins with a byte-order mark."""
    folder = scratch_folder(t.spark, "csv")
    t.daily_obs.select(F.col("series_id").alias("\ufeffseries_id"), "asof_date", "value").write.option("header", True).csv(folder)
    return B.read_csv(t.spark, folder, "series_id string, asof_date date, value double")


@query("s6_optional_scan", "SELECT series_id, asof_date, value, 'there' AS origin FROM monthly_obs")
def s6(t):
    """A folder that is there and one that is not: the absent one gives no rows of its schema."""
    there, absent = scratch_folder(t.spark, "monthly"), scratch_folder(t.spark, "absent")
    t.monthly_obs.write.parquet(there)
    schema = "series_id string, asof_date date, value double"
    read = lambda path, origin: B.optional_parquet(t.spark, path, schema).select("series_id", "asof_date", "value", F.lit(origin).alias("origin"))
    return read(there, "there").unionByName(read(absent, "absent"))


@query("s24_payload_rows", """
SELECT 'KR' AS market, count(*) AS documents, count(DISTINCT date) AS days, min(date) AS first_day FROM scope_prices GROUP BY 1""")
def s24(t):
    docs = K.payload_rows(t.scope_prices, F.lit("KR"), F.col("date"), "state", ["market_scope", "close"])
    return docs.groupBy("market").agg(F.count("payload_json").alias("documents"), F.count_distinct("asof").alias("days"), F.min("asof").alias("first_day"))


@query("s25_manifest", """
SELECT 'flows' AS table_name, sum(n)::BIGINT AS row_count, min(lo) AS first_date, max(hi) AS last_date, sum(n - 1)::BIGINT AS duplicate_keys FROM (
  SELECT count(*) AS n, min(date) AS lo, max(date) AS hi FROM flows GROUP BY date, ticker)""")
def s25(t):
    return K.manifest(t.flows, "flows", ["date", "ticker"], "date")


@query("s26_incremental_start", """
SELECT n_name AS series_id, coalesce(max(o.asof_date) - 5, DATE '2001-12-31' - 120)::DATE AS start_date FROM (SELECT 'VIXCLS' AS n_name UNION ALL SELECT unnest(['FEDFUNDS', 'DGS2', 'DGS10'])) LEFT JOIN daily_obs o ON o.series_id = n_name GROUP BY 1""")
def s26(t):
    wanted = t.daily_obs.where(F.col("series_id").isin("VIXCLS", "DGS2", "DGS10")).select("series_id").unionByName(
        t.monthly_obs.where(F.col("series_id") == "FEDFUNDS").select("series_id"))
    return B.incremental_start(wanted, t.daily_obs, "series_id", "asof_date", "2001-12-31")


@query("s27_additive_evolution", "SELECT series_id, asof_date, value, CAST(NULL AS DOUBLE) AS raw FROM daily_obs UNION ALL SELECT series_id, asof_date, value, value FROM monthly_obs")
def s27(t):
    return K.evolve(t.daily_obs, {"raw": "double"}).unionByName(t.monthly_obs.withColumn("raw", F.col("value")))


@query("s28_run_log", """
SELECT event_type, count(*) AS row_count, count(*) FILTER (s1 IS NULL) AS missing_count, CASE WHEN count(*) FILTER (s1 IS NULL) = 0 THEN 'ok' WHEN count(*) FILTER (s1 IS NULL) < count(*) THEN 'partial' ELSE 'empty' END AS status FROM scores GROUP BY 1""")
def s28(t):
    return K.run_log(t.scores, ["event_type"], "s1")


@query("s29_registry_upsert", """
SELECT s_suppkey, s_name || CASE WHEN s_suppkey % 2 = 0 THEN '*' ELSE '' END AS s_name, CASE WHEN s_suppkey % 3 = 0 AND s_suppkey % 2 = 0 THEN 2 ELSE 1 END AS created FROM supplier WHERE s_suppkey % 3 <> 0 OR s_suppkey % 2 = 0""")
def s29(t):
    s = t.table("supplier").select("s_suppkey", "s_name")
    old = s.where(F.col("s_suppkey") % 3 != 0).withColumn("created", F.lit(1))
    new = s.where(F.col("s_suppkey") % 2 == 0).select("s_suppkey", F.concat("s_name", F.lit("*")).alias("s_name"), F.lit(2).alias("created"))
    return K.merged(old, new, ["s_suppkey"], keep_first=["created"])


@query("s30_flow_scan", "SELECT date, ticker, investor, net_value FROM flows WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' AND investor IN ('foreign', 'institution', 'retail')")
def s30(t):
    return B.flow_scan(t.flows, "2024-01-05", "2024-01-20", ["foreign", "institution", "retail"]).select("date", "ticker", "investor", "net_value")


@query("s31_replace_by_date", "SELECT series_id, asof_date, value FROM daily_obs WHERE asof_date < DATE '2001-01-01' UNION ALL SELECT series_id, asof_date, value * 2 FROM daily_obs WHERE asof_date >= DATE '2001-01-01' AND value > 10 UNION ALL SELECT series_id, asof_date, value FROM daily_obs o WHERE asof_date >= DATE '2001-01-01' AND NOT EXISTS (SELECT 1 FROM daily_obs p WHERE p.asof_date = o.asof_date AND p.value > 10)")
def s31(t):
    new = t.daily_obs.where((F.col("asof_date") >= "2001-01-01") & (F.col("value") > 10)).withColumn("value", F.col("value") * 2)
    return K.days_replaced(t.daily_obs, new, "asof_date")


@query("s32_expected_assets", """
SELECT d.date, k.ticker, m.close AS price, (m.close IS NULL)::INT AS is_fallback FROM (SELECT asof_date AS date FROM spine) d CROSS JOIN (VALUES ('GOLD'), ('BOND'), ('OIL')) k(ticker) LEFT JOIN market_prices m USING (date, ticker)""")
def s32(t):
    from tidemark.operators.asof import grid

    expected = grid(t.spine.withColumnRenamed("asof_date", "date"), "ticker", ["GOLD", "BOND", "OIL"])
    return G.expected_assets(expected, t.market_prices.select("date", "ticker", F.col("close").alias("price")), ["date", "ticker"])


@query("s33_latest_document", """
SELECT user_id, ts, props FROM (SELECT user_id, max(ts) AS ts, arg_max(event_id, ts) AS event_id, arg_max(props, ts) AS props FROM events WHERE event_type = 'click' GROUP BY 1) WHERE event_id % 4 <> 0""")
def s33(t):
    doc = F.to_json(F.struct(F.when(F.col("event_id") % 4 != 0, F.lit(True)).otherwise(F.lit(False)).alias("enabled"), F.col("props")))
    out = B.latest_document(t.table("events").withColumn("doc", doc), ["user_id"], "ts", "event_type", "click", "doc", "enabled")
    return out.select("user_id", "ts", F.get_json_object("doc", "$.props").alias("props"))


@query("s34_context_audit", """
SELECT doc_id, len(string_split(text, '. ')) AS headline_count, len(list_filter(string_split(text, '. '), lambda x: contains(lower(x), 'risk'))) AS risk_headline_count,
  len(list_distinct(string_split(text, '. '))) AS source_count, (len(list_filter(string_split(text, '. '), lambda x: contains(lower(x), 'risk'))) > 0)::INT AS caution_flag FROM documents""")
def s34(t):
    lines = F.split("text", "\\. ")
    docs = t.table("documents").select("doc_id", lines.alias("h"), F.filter(lines, lambda x: F.lower(x).contains("risk")).alias("risk"))
    return K.context_audit(docs, ["doc_id"], "h", "risk", "h")


@query("s35_universe_or_instruments", "SELECT ticker FROM classification WHERE asset_type = 'BUILDING'")
def s35(t):
    listed = t.stock_prices.select("ticker", "date")
    instruments = t.classification.withColumns({"is_active": F.lit(1), "asset_type": F.when(F.col("asset_type") == "BUILDING", "STOCK").otherwise("ETF")})
    return B.universe_or_instruments(listed, instruments, "date", "1980-01-01")
