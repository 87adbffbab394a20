"""Landed files, seeds and Parquet sinks."""

import datetime as dt
import json

from pyspark.sql import functions as F

from tidemark.sources import landed as G
from tidemark.sources import sinks as K
from tidemark.sources import tables as B


def test_csv_with_byte_order_mark(spark, tmp_path):
    f = tmp_path / "seed.csv"
    f.write_bytes("﻿date,rate_code,rate_name,value,source\n2026-03-23,BASE,,2.75,\n2026-03-23,CD91,CD 91D,,x\n,KTB3Y,,1,\n".encode())
    raw = B.read_csv(spark, str(f), "date string, rate_code string, rate_name string, value string, source string")
    rows = B.manual_rates(raw, {"BASE": "Base Rate"}).collect()
    assert [(r.rate_code, r.rate_name, r.value, r.source) for r in rows] == [("BASE", "Base Rate", 2.75, "manual_seed")]


def test_fred_missing_marker(spark, tmp_path):
    doc = {"observations": [{"date": "2024-01-02", "value": "4.1", "realtime_start": "2024-02-01", "realtime_end": "9999-12-31"}, {"date": "2024-01-03", "value": "."}]}
    (tmp_path / "DGS10.json").write_text(json.dumps(doc))
    rows = G.fred_observations(G.read_documents(spark, str(tmp_path)).withColumn("series_id", F.lit("DGS10")), ["series_id"]).orderBy("asof_date").collect()
    assert [(r.value, r.raw_value) for r in rows] == [(4.1, "4.1"), (None, ".")] and rows[0].realtime_start == dt.date(2024, 2, 1)


def test_treasury_feed(spark, tmp_path):
    body = """<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom" xmlns:m="urn:m" xmlns:d="urn:d"><entry><content><m:properties>
    <d:NEW_DATE>2024-01-02T00:00:00</d:NEW_DATE><d:BC_3MONTH>5.4</d:BC_3MONTH><d:BC_10YEAR>3.9</d:BC_10YEAR></m:properties></content></entry></feed>"""
    (tmp_path / "t.xml").write_text(body)
    rows = {r.series_id: r.value for r in G.read_treasury_feed(spark, str(tmp_path / "t.xml")).collect()}
    assert rows == {"DGS3MO": 5.4, "DGS2": None, "DGS10": 3.9, "DGS30": None}


def test_chart_payload(spark):
    doc = {"meta": {"chartPreviousClose": 10.0}, "timestamp": [86400, 172800, 259200],
           "indicators": {"quote": [{"open": [1, 2, 3], "high": [1, 2, 3], "low": [1, 2, 3], "close": [11.0, None, 12.0], "volume": [5, 6, None]}], "adjclose": [{"adjclose": [10.5]}]}}
    d = spark.createDataFrame([("SPY", json.dumps(doc))], "asset_code string, payload string")
    rows = G.chart_rows(d, ["asset_code"]).orderBy("asof_date").collect()
    assert [(r.asof_date.day, r.close, r.adj_close) for r in rows] == [(2, 11.0, 10.5), (4, 12.0, 12.0)]
    q = G.chart_quote(d, ["asset_code"]).collect()[0]
    assert (q.price, q.volume, round(q.change_pct, 6)) == (12.0, 6.0, 0.2)


def test_upsert_rewrites_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "table")
    mk = lambda rows: spark.createDataFrame(rows, "code string, value double, created int, day string")
    K.upsert(spark, path, mk([("a", 1.0, 1, "d1"), ("b", 2.0, 1, "d2")]), ["code", "day"], "day", ["created"])
    before = {p.name for p in (tmp_path / "table" / "day=d1").iterdir()}
    K.upsert(spark, path, mk([("b", 5.0, 2, "d2"), ("c", 6.0, 2, "d2")]), ["code", "day"], "day", ["created"])
    rows = {(r.code, r.day): (r.value, r.created) for r in spark.read.parquet(path).collect()}
    assert rows == {("a", "d1"): (1.0, 1), ("b", "d2"): (5.0, 1), ("c", "d2"): (6.0, 2)}
    assert {p.name for p in (tmp_path / "table" / "day=d1").iterdir()} == before


def test_replace_days_and_csv_pair(spark, tmp_path):
    path = str(tmp_path / "days")
    mk = lambda rows: spark.createDataFrame(rows, "day string, v int")
    K.replace_table(mk([("d1", 1), ("d2", 2)]), path, "day")
    K.replace_days(mk([("d2", 7)]), path, "day")
    assert {(r.day, r.v) for r in spark.read.parquet(path).collect()} == {("d1", 1), ("d2", 7)}
    K.write_csv_pair(mk([("d1", 1)]), str(tmp_path / "full"), str(tmp_path / "current"))
    assert spark.read.csv(str(tmp_path / "current"), header=True).count() == 1


def test_optional_inputs_and_manifest(spark, tmp_path):
    assert B.optional_parquet(spark, str(tmp_path / "none"), "a int").count() == 0
    assert B.optional_table(spark, "no_such_table", "a int").columns == ["a"]
    d = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "k string, d int")
    m = K.manifest(d, "t", ["k"], "d").collect()[0]
    assert (m.row_count, m.first_date, m.last_date, m.duplicate_keys) == (3, 1, 2, 1)
    assert json.loads(K.schema_contract(d.schema, ["k"]))["columns"][0] == {"name": "k", "type": "string", "nullable": False, "metadata": {}}
