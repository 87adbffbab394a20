"""Boundaries of the ladders and rule labels."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import dates as D
from tidemark.functions import labels as L
from tidemark.functions import numeric as N
from tidemark.functions import text as X


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).coalesce(1).select(column).collect()]


@pytest.mark.parametrize("make, cases", [
    (lambda: L.market_state("v"), {1.5: "strong_up", 1.4999: "up", 0.4: "up", 0.3999: "neutral", -0.4: "down", -1.5: "strong_down", None: None}),
    (lambda: L.volatility_regime("v"), {0.1199: "low", 0.12: "normal", 0.22: "high", 0.35: "stress", None: None}),
    (lambda: L.forecast("v"), {1.1: "bullish", 0.35: "mild_bullish", 0.3499: "neutral", -0.35: "mild_bearish", -1.1: "bearish"}),
    (lambda: L.state_bucket("v"), {2.0: "강상승", 1.0: "상승", 0.3: "강보합", 0.2999: "중립", -0.3: "중립", -0.3001: "약보합", -1.0: "약보합", -2.0: "하락", -2.0001: "강하락"}),
    (lambda: L.score_band("v"), {-2.0: 1, -1.0: 2, -0.3: 3, 0.2999: 4, 0.3: 5, 1.0: 6, 2.0: 7, None: 0}),
    (lambda: L.tone("v"), {1.0: "good", 0.3: "weak_good", 0.0: "neutral", -0.3: "weak_bad", -1.0: "bad", None: "unknown"}),
    (lambda: L.flow_strength("v"), {10000.0: "강함", -3000.0: "보통", 2999.9: "약함", None: "약함"}),
    (lambda: L.preview("v"), {1.2: "장초반 우호 가능성", 0.4: "장초반 우호 흐름", 0.0: "혼조 출발 가능성", -0.4: "장초반 경계 흐름", -1.2: "장초반 부담 가능성"}),
])
def test_ladder_bounds(spark, make, cases):
    got = values(spark, [(v,) for v in cases], "v double", make())
    assert got == list(cases.values())


def test_risk_regime_order_and_option(spark):
    rows = [(-0.5, -0.5, 2.5)]
    assert values(spark, rows, "a double, b double, c double", L.risk_regime("a", "b", "c")) == ["risk_on_moderate"]
    assert values(spark, rows, "a double, b double, c double", L.risk_regime("a", "b", "c", strict_first=True)) == ["risk_on_high"]


def test_zero_ratio_counts_as_one(spark):
    assert values(spark, [(0.55, 0.0), (0.55, None)], "a double, b double", L.breadth_regime("a", "b")) == ["완만한 강세"] * 2


def test_clip_and_means_keep_nulls(spark):
    rows = [(None, 5.0), (None, None), (-9.0, 1.0)]
    assert values(spark, rows, "a double, b double", N.clip("a")) == [None, None, -3.0]
    assert values(spark, rows, "a double, b double", N.row_mean("a", "b")) == [5.0, None, -4.0]
    assert values(spark, rows, "a double, b double", N.weighted_mean([("a", 0.5), ("b", 0.5)], signed=True, empty=0.0)) == [5.0, 0.0, -4.0]
    assert values(spark, rows, "a double, b double", N.row_mean(F.col("a"), F.col("b"))) == [5.0, None, -4.0]


def test_argmax_first_wins_and_threshold(spark):
    rows = [(0.4, 0.2, 0.4), (0.3, 0.4, 0.3)]
    probs = {"down": "d", "sideways": "s", "up": "u"}
    assert values(spark, rows, "d double, s double, u double", L.argmax_label(probs)) == ["down", "sideways"]
    assert values(spark, rows, "d double, s double, u double", L.threshold_label("d", "u", F.lit(0.4), F.lit(0.3))) == ["down", "sideways"]


def test_disclosure_rules(spark):
    rows = [("주권매매거래정지해제",), ("횡령 혐의 유상증자",), ("유상증자 결정",), ("사업보고서",), ("기타",), (None,)]
    got = values(spark, rows, "t string", L.classify_text("t")["category_key"])
    assert got == ["general", "risk", "funding", "earnings", "general", "general"]


def test_business_days_and_sessions(spark):
    days = [dt.date(2024, 1, 5), dt.date(2024, 1, 6), dt.date(2024, 1, 7), dt.date(2024, 1, 8)]
    assert values(spark, [(d,) for d in days], "d date", D.next_business_day("d")) == [dt.date(2024, 1, 8)] * 3 + [dt.date(2024, 1, 9)]
    stamps = [(dt.datetime(2024, 1, 5, 8, 30),), (dt.datetime(2024, 1, 5, 18, 0),), (dt.datetime(2024, 1, 6, 7, 0),)]
    assert values(spark, stamps, "t timestamp_ntz", D.reference_session("t")) == [dt.date(2024, 1, 5), dt.date(2024, 1, 8), dt.date(2024, 1, 8)]
    assert values(spark, stamps, "t timestamp_ntz", D.in_preview_window("t")) == [True, True, True]


def test_number_parsing(spark):
    rows = [("1,234.5",), ("▼12.5%",), ("▲3",), ("-",), ("",), ("-7",), (".",)]
    assert values(spark, rows, "t string", X.parse_number("t")) == [1234.5, -12.5, 3.0, None, None, -7.0, None]
    assert values(spark, [("A5930",), ("",)], "t string", X.ticker_code("t")) == ["005930", None]


def test_period_texts(spark):
    rows = [("2020Q3",), ("2020M11",), ("2019",), ("x",)]
    assert values(spark, rows, "t string", D.date_from_period("t")) == [dt.date(2020, 7, 1), dt.date(2020, 11, 1), dt.date(2019, 1, 1), None]
    assert values(spark, [("2020", "M01"), ("2020", "M13")], "y string, p string", D.month_from_period("y", "p")) == [dt.date(2020, 1, 1), None]
    texts = [("2020-02-03",), ("20200203",), ("202002",), ("2020",), ("2020-02",)]
    assert values(spark, texts, "t string", D.date_from_length("t")) == [dt.date(2020, 2, 3)] * 2 + [dt.date(2020, 2, 1), dt.date(2020, 1, 1), dt.date(2020, 2, 1)]
