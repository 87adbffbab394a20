"""Landed vendor payloads to typed rows.

A landing table has one text document per request. Parsing stays in the JVM
(``from_json`` / ``from_xml``), so documents are parsed where they are read and a
skewed vendor only makes more input splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import dates as D
from tidemark.functions import text as X
from tidemark.functions.numeric import ratio

# Shapes of the vendor documents.
FRED_SHAPE = "observations array<struct<date:string,value:string,realtime_start:string,realtime_end:string>>"
BLS_SHAPE = "Results struct<series:array<struct<seriesID:string,data:array<struct<year:string,period:string,value:string>>>>>"
BEA_SHAPE = "BEAAPI struct<Results:struct<Data:array<struct<SeriesCode:string,TimePeriod:string,DataValue:string>>>>"
EIA_SHAPE = "response struct<data:array<struct<period:string,value:string>>>"
ECOS_SHAPE = "StatisticSearch struct<row:array<struct<TIME:string,DATA_VALUE:string,ITEM_CODE1:string>>>"
CHART_SHAPE = (
    "meta struct<regularMarketPrice:double,chartPreviousClose:double,previousClose:double,regularMarketOpen:double,"
    "regularMarketDayHigh:double,regularMarketDayLow:double,regularMarketVolume:double,regularMarketTime:bigint>,"
    "timestamp array<bigint>,indicators struct<quote:array<struct<open:array<double>,high:array<double>,low:array<double>,"
    "close:array<double>,volume:array<double>>>,adjclose:array<struct<adjclose:array<double>>>>")
TREASURY_FIELDS = {"BC_3MONTH": "DGS3MO", "BC_2YEAR": "DGS2", "BC_10YEAR": "DGS10", "BC_30YEAR": "DGS30"}
INVESTOR_FIELDS = {
    "개인": "ind_invsr", "외국인": "frgnr_invsr", "기관합계": "orgn", "금융투자": "fnnc_invt", "보험": "insrnc", "투신": "invtrt",
    "기타금융": "etc_fnnc", "은행": "bank", "연기금": "penfnd_etc", "사모": "samo_fund", "국가": "natn", "기타법인": "etc_corp", "기타외국인": "natfor",
}


def _rows(df: DataFrame, keys: Sequence[str], payload: str, shape: str, path: str) -> DataFrame:
    doc = df.select(*keys, F.from_json(payload, shape).alias("__d"))
    return doc.select(*keys, F.explode(F.col(f"__d.{path}")).alias("__r")).select(*keys, "__r.*")


def read_documents(spark: SparkSession, path: str, column: str = "payload") -> DataFrame:
    """Whole files as one document each, with their path."""
    return spark.read.text(path, wholetext=True).select(F.col("value").alias(column), F.input_file_name().alias("file"))


def fred_observations(df: DataFrame, keys: Sequence[str], payload: str = "payload") -> DataFrame:
    """S8. Observations with vintage columns; ``.`` is a missing value and is kept as raw text."""
    r = _rows(df, keys, payload, FRED_SHAPE, "observations")
    return r.select(*keys, F.try_to_date("date", "yyyy-MM-dd").alias("asof_date"), X.clean_text_number("value").alias("value"),
                    F.col("value").alias("raw_value"), F.try_to_date("realtime_start", "yyyy-MM-dd").alias("realtime_start"),
                    F.try_to_date("realtime_end", "yyyy-MM-dd").alias("realtime_end")).where(F.col("asof_date").isNotNull())


def bls_observations(df: DataFrame, keys: Sequence[str] = (), payload: str = "payload") -> DataFrame:
    """S9. Monthly rows; annual averages (M13) are dropped."""
    series = _rows(df, keys, payload, BLS_SHAPE, "Results.series")
    r = series.select(*keys, F.col("seriesID").alias("series_id"), F.explode("data").alias("__x")).select(*keys, "series_id", "__x.*")
    return r.select(*keys, "series_id", D.month_from_period("year", "period").alias("asof_date"), X.clean_text_number("value").alias("value"),
                    ).where(F.col("asof_date").isNotNull())


def bea_observations(df: DataFrame, keys: Sequence[str] = (), payload: str = "payload") -> DataFrame:
    """S10. Quarterly, monthly or yearly periods; thousands separators in the values."""
    r = _rows(df, keys, payload, BEA_SHAPE, "BEAAPI.Results.Data")
    return r.select(*keys, F.col("SeriesCode").alias("series_id"), D.date_from_period("TimePeriod").alias("asof_date"),
                    X.clean_text_number("DataValue").alias("value")).where(F.col("asof_date").isNotNull())


def eia_observations(df: DataFrame, keys: Sequence[str], payload: str = "payload") -> DataFrame:
    """S11. The length of the period text tells its form."""
    r = _rows(df, keys, payload, EIA_SHAPE, "response.data")
    return r.select(*keys, D.date_from_length("period").alias("asof_date"), X.clean_text_number("value").alias("value")).where(
        F.col("asof_date").isNotNull())


def treasury_yields(df: DataFrame, entry: str = "entry") -> DataFrame:
    """S12. One Atom entry text per row to (asof_date, series_id, value), four tenors."""
    fields = ",".join(f"{f}:string" for f in TREASURY_FIELDS)
    shape = f"content struct<properties:struct<NEW_DATE:string,{fields}>>"
    p = df.select(F.from_xml(F.col(entry), shape).alias("__x")).select("__x.content.properties.*")
    return _tenors(p)


def read_treasury_feed(spark: SparkSession, path: str) -> DataFrame:
    """S12. The feed file itself, split at its property records by the XML reader."""
    shape = ", ".join(f"{c} string" for c in ("NEW_DATE", *TREASURY_FIELDS))
    return _tenors(spark.read.format("xml").option("rowTag", "properties").option("ignoreNamespace", "true").schema(shape).load(path))


def _tenors(p: DataFrame) -> DataFrame:
    wide = p.select(F.try_to_date(F.substring("NEW_DATE", 1, 10), "yyyy-MM-dd").alias("asof_date"),
                    *[F.col(f).try_cast("double").alias(s) for f, s in TREASURY_FIELDS.items()]).where(F.col("asof_date").isNotNull())
    return wide.unpivot(["asof_date"], list(TREASURY_FIELDS.values()), "series_id", "value")


def ecos_observations(df: DataFrame, keys: Sequence[str], payload: str = "payload") -> DataFrame:
    """S13. Daily (8 digits) and monthly (6 digits) rows of the central bank service."""
    r = _rows(df, keys, payload, ECOS_SHAPE, "StatisticSearch.row")
    return r.select(*keys, F.col("ITEM_CODE1").alias("item_code"), D.date_from_length("TIME").alias("asof_date"),
                    X.clean_text_number("DATA_VALUE").alias("value")).where(F.col("asof_date").isNotNull())


def _chart(df: DataFrame, keys: Sequence[str], payload: str) -> DataFrame:
    c = df.select(*keys, F.from_json(payload, CHART_SHAPE).alias("__c"))
    return c.select(*keys, F.col("__c.meta").alias("meta"), F.col("__c.timestamp").alias("ts"), F.col("__c.indicators.quote")[0].alias("q"),
                    F.col("__c.indicators.adjclose")[0]["adjclose"].alias("adj"))


def chart_rows(df: DataFrame, keys: Sequence[str], payload: str = "payload") -> DataFrame:
    """S14. Parallel arrays to daily rows; rows without a close are dropped, adj_close past its array is the close."""
    c = _chart(df, keys, payload)
    zipped = F.arrays_zip("ts", "q.open", "q.high", "q.low", "q.close", "q.volume")
    r = c.select(*keys, F.size(F.coalesce("adj", F.array().cast("array<double>"))).alias("__n"), "adj", F.posexplode(zipped).alias("i", "z"))
    adj = F.when(F.col("i") < F.col("__n"), F.get("adj", F.col("i"))).otherwise(F.col("z.close"))
    return r.where(F.col("z.close").isNotNull()).select(
        *keys, D.epoch_day("z.ts").alias("asof_date"), "z.open", "z.high", "z.low", "z.close", adj.alias("adj_close"), "z.volume")


def _last_present(c: str) -> Column:
    return F.try_element_at(F.filter(F.col(c), lambda x: x.isNotNull()), F.lit(-1))


def chart_quote(df: DataFrame, keys: Sequence[str], payload: str = "payload") -> DataFrame:
    """S15. Latest quote: vendor summary first, else the last non-null element of each array."""
    c = _chart(df, keys, payload)
    prev = F.nullif(F.coalesce("meta.chartPreviousClose", "meta.previousClose"), F.lit(0.0))
    out = c.select(
        *keys, F.coalesce("meta.regularMarketPrice", _last_present("q.close")).alias("price"), prev.alias("prev_close"),
        F.coalesce("meta.regularMarketOpen", _last_present("q.open")).alias("open"),
        F.coalesce("meta.regularMarketDayHigh", _last_present("q.high")).alias("high"),
        F.coalesce("meta.regularMarketDayLow", _last_present("q.low")).alias("low"),
        F.coalesce("meta.regularMarketVolume", _last_present("q.volume"), F.lit(0.0)).alias("volume"),
        F.timestamp_seconds(F.coalesce(F.try_element_at("ts", F.lit(-1)), "meta.regularMarketTime")).alias("quote_time"))
    return out.withColumns({"change_value": F.col("price") - F.col("prev_close"), "change_pct": ratio("price", "prev_close") - 1.0})


def investor_wide_to_long(df: DataFrame, keys: Sequence[str], investors: dict[str, str]) -> DataFrame:
    """S16. One column per investor (column -> name) to rows, numbers parsed from text."""
    named = df.select(*keys, *[X.compact_number(c).alias(n) for c, n in investors.items()])
    return named.unpivot(list(keys), list(investors.values()), "investor", "net_buy_value")


def amount_quantity_records(amounts: DataFrame, quantities: DataFrame, keys: Sequence[str], fields: dict[str, str] = INVESTOR_FIELDS) -> DataFrame:
    """S17. Two feeds met by key and date, unpivoted by investor; amounts are in millions."""
    a = amounts.unpivot([*keys], list(fields.values()), "field", "amount_text")
    q = quantities.unpivot([*keys], list(fields.values()), "field", "quantity_text")
    both = a.join(q, [*keys, "field"], "full")
    names = F.create_map(*[F.lit(x) for n, f in fields.items() for x in (f, n)])
    return both.select(*keys, F.try_element_at(names, F.col("field")).alias("investor"), X.parse_number("quantity_text").alias("net_volume"),
                       (X.parse_number("amount_text") * 1_000_000.0).alias("net_value"))


def expected_assets(expected: DataFrame, quotes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """S32. Every expected asset; those without a price stay as null rows flagged as fallback."""
    present = quotes.where(F.col("price").isNotNull()).withColumn("is_fallback", F.lit(0))
    return expected.join(present, list(keys), "left").withColumn("is_fallback", F.coalesce("is_fallback", F.lit(1)))
