"""Threshold ladders and rule-based labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.numeric import as_col, ratio, row_mean

# Label sets of the tables handed to consumers.
STATE_BUCKETS = [(2.0, "강상승"), (1.0, "상승"), (0.3, "강보합"), (-0.3, "중립"), (-1.0, "약보합"), (-2.0, "하락")]
STATE_FLOOR = "강하락"
INTRADAY_LABELS = ["강세", "소폭 강세", "혼조", "약세", "강한 약세"]
BREADTH_REGIMES = ["확산 강세", "완만한 강세", "확산 약세", "완만한 약세", "혼조"]
SIGNAL_DIRECTIONS = ["순매수 우위", "순매도 우위", "중립"]
SIGNAL_STRENGTHS = ["강함", "보통", "약함"]
PREVIEW_LABELS = ["장초반 우호 가능성", "장초반 우호 흐름", "장초반 부담 가능성", "장초반 경계 흐름", "혼조 출발 가능성"]
CLASSES = ["down", "sideways", "up"]

# Disclosure categories with their keywords, first match wins.
DISCLOSURE_EXEMPT = ["거래정지해제", "매매거래정지해제"]
DISCLOSURE_RULES = [
    ("risk", "리스크 공시", 1, "high",
     ["관리종목", "상장폐지", "영업정지", "횡령", "배임", "회생절차", "파산", "감사의견", "소송", "부도",
      "거래정지", "실질심사", "상장적격성", "이의신청"]),
    ("funding", "자금조달", 0, "medium",
     ["유상증자", "무상증자", "전환사채", "신주인수권부사채", "교환사채", "사채", "증권신고서", "유무상증자"]),
    ("shareholder", "지분/자사주", 0, "medium",
     ["자기주식", "주식등의대량보유", "임원ㆍ주요주주", "최대주주", "주요주주", "소유상황보고"]),
    ("earnings", "실적/정기보고", 0, "normal",
     ["잠정실적", "매출액또는손익구조", "사업보고서", "반기보고서", "분기보고서", "감사보고서"]),
    ("governance", "지배구조/의사결정", 0, "normal",
     ["합병", "분할", "주주총회", "영업양수", "영업양도", "타법인주식", "해산"]),
]
DISCLOSURE_DEFAULT = ("general", "일반 공시", 0, "normal")

_TESTS = {
    ">=": lambda c, t: c >= t,
    ">": lambda c, t: c > t,
    "<=": lambda c, t: c <= t,
    "<": lambda c, t: c < t,
}


def ladder(c: Column | str, rungs: Sequence[tuple[str, float, str]], default: str, missing: str | None = None) -> Column:
    """P2. First rung whose test holds gives the label; null gives ``missing``."""
    c = as_col(c)
    out = F.when(c.isNull(), F.lit(missing))
    for op, bound, label in rungs:
        out = out.when(_TESTS[op](c, F.lit(float(bound))), F.lit(label))
    return out.otherwise(F.lit(default))


def market_state(c):  # P2
    return ladder(c, [(">=", 1.5, "strong_up"), (">=", 0.4, "up"), ("<=", -1.5, "strong_down"), ("<=", -0.4, "down")],
                  "neutral")


def volatility_regime(c):  # P2
    return ladder(c, [("<", 0.12, "low"), ("<", 0.22, "normal"), ("<", 0.35, "high")], "stress")


def _five_step(c, outer: float, inner: float) -> Column:
    return ladder(c, [(">=", outer, "bullish"), (">=", inner, "mild_bullish"), (">", -inner, "neutral"),
                      (">", -outer, "mild_bearish")], "bearish")


def forecast(c):  # P2
    return _five_step(c, 1.1, 0.35)


def calibrated(c):  # P4
    return _five_step(c, 0.75, 0.2)


def prediction(pred, train_std):
    """P5. Five-step label of prediction / training deviation; null without spread."""
    std = as_col(train_std)
    return _five_step(F.when(std > 0, ratio(pred, std)), 0.75, 0.2)


def state_bucket(c):  # P3
    return ladder(c, [(">=", t, label) for t, label in STATE_BUCKETS], STATE_FLOOR)


def risk_regime(risk_off, external_pressure, risk_on, strict_first: bool = False) -> Column:
    """P6. Regime from mean pressure and risk appetite.

    The stronger risk-on test cannot be reached behind the weaker one; the order
    is kept unless ``strict_first``.
    """
    pressure, on = row_mean(risk_off, external_pressure), as_col(risk_on)
    moderate = (on >= 1.2) & (pressure <= 0.2), "risk_on_moderate"
    high = (on >= 2.0) & (pressure <= -0.2), "risk_on_high"
    out = (F.when(pressure.isNull(), F.lit(None).cast("string")).when(pressure >= 1.6, "risk_off_high")
           .when(pressure >= 0.65, "risk_off_moderate"))
    for test, label in ([high, moderate] if strict_first else [moderate, high]):
        out = out.when(test, label)
    return out.otherwise("neutral")


def monitoring_quality(corr, hit) -> Column:  # P7
    corr, hit = as_col(corr), as_col(hit)
    return (F.when(corr.isNull() | hit.isNull(), "insufficient_history")
            .when((corr >= 0.2) & (hit >= 0.56), "strong")
            .when((corr >= 0.1) & (hit >= 0.53), "usable")
            .when((corr <= -0.05) | (hit < 0.48), "weak").otherwise("watch"))


def coverage_quality(c):  # P8
    return ladder(c, [(">=", 0.85, "high"), (">=", 0.65, "medium"), (">=", 0.35, "low")], "very_low")


def regime_direction(delta, threshold: float = 0.1):  # P9
    return ladder(delta, [(">", threshold, "improving"), ("<", -threshold, "deteriorating")], "unchanged", "unknown")


def regime_momentum(delta_5d, acceleration_5d) -> Column:  # P9
    delta, accel = as_col(delta_5d), F.coalesce(as_col(acceleration_5d), F.lit(0.0))
    return (F.when(delta.isNull(), "unknown")
            .when((delta > 0.2) & (accel > 0), "improving_accelerating").when(delta > 0.2, "improving")
            .when((delta < -0.2) & (accel < 0), "deteriorating_accelerating").when(delta < -0.2, "deteriorating")
            .otherwise("stable"))


def sign_label(c, positive: str, negative: str, zero: str, missing: str | None = None):
    return ladder(c, [(">", 0.0, positive), ("<", 0.0, negative)], zero, missing)


def surprise_direction(c, positive: str = "upside", negative: str = "downside"):  # P10
    return sign_label(c, positive, negative, "inline")


def surprise_bias(c):  # P10
    return ladder(c, [(">=", 1.0, "risk_off_surprise"), ("<=", -1.0, "risk_on_surprise")], "mixed_or_inline")


def axis_bucket(c):  # P11
    return ladder(c, [(">=", 0.3, "positive"), ("<=", -0.3, "negative")], "neutral", "missing")


def tone(c):  # P11
    return ladder(c, [(">=", 1.0, "good"), (">=", 0.3, "weak_good"), (">", -0.3, "neutral"), (">", -1.0, "weak_bad")],
                  "bad", "unknown")


def score_band(c):
    """P11. Seven levels with the low bound inclusive on the negative side; level 0 when missing."""
    return ladder(c, [("<=", -2.0, "1"), ("<=", -1.0, "2"), ("<=", -0.3, "3"), ("<", 0.3, "4"), ("<", 1.0, "5"),
                      ("<", 2.0, "6")], "7", "0").cast("int")


def breadth_regime(above_ratio, adv_dec) -> Column:
    """P12. A zero or missing advance/decline ratio counts as one."""
    breadth = F.coalesce(as_col(above_ratio), F.lit(0.0))
    adv = F.coalesce(F.when(as_col(adv_dec) != 0, as_col(adv_dec)), F.lit(1.0))
    names = BREADTH_REGIMES
    return (F.when((breadth >= 0.6) & (adv >= 1.1), names[0]).when((breadth >= 0.5) & (adv >= 1.0), names[1])
            .when((breadth <= 0.35) & (adv < 0.9), names[2]).when((breadth <= 0.45) & (adv < 1.0), names[3])
            .otherwise(names[4]))


def change_direction(c):  # P12
    return sign_label(c, "up", "down", "flat", "unavailable")


def quote_status(is_fallback, change_pct) -> Column:  # P12
    return (F.when(F.coalesce(as_col(is_fallback), F.lit(0)) != 0, "fallback")
            .when(as_col(change_pct).isNull(), "missing").otherwise("live"))


def source_tier(source, fallback_flag=None) -> Column:  # P12
    text = F.lower(F.coalesce(as_col(source), F.lit("")))
    raised = F.coalesce(as_col(fallback_flag), F.lit(0)) != 0 if fallback_flag is not None else F.lit(False)
    return (F.when(raised, "fallback")
            .when(text.startswith("fdr:") | text.startswith("krx:") | text.contains("official"), "official")
            .when(text.startswith("carry_forward:"), "official_delayed")
            .when(text.startswith("naver:") | text.startswith("yahoo:"), "proxy")
            .when(text.startswith("fallback") | (text == ""), "fallback").otherwise("proxy"))


def catalogue_source_tier(source) -> Column:  # P12, series catalogue variant
    text = F.lower(F.coalesce(as_col(source), F.lit("")))
    official = text.startswith("fdr:") | text.startswith("krx:") | text.startswith("bok_ecos:") | (text == "fred")
    return (F.when(official, "official")
            .when(text.startswith("manual") | text.startswith("sample") | (text == ""), "fallback").otherwise("proxy"))


def intraday_direction(c):  # P13
    n = INTRADAY_LABELS
    return ladder(c, [(">=", 1.0, n[0]), (">=", 0.2, n[1]), (">", -0.2, n[2]), (">", -1.0, n[3])], n[4])


def flow_direction(c):  # P13
    pos, neg, flat = SIGNAL_DIRECTIONS
    return sign_label(c, pos, neg, flat, flat)


def flow_strength(c):  # P13
    strong, medium, weak = SIGNAL_STRENGTHS
    return ladder(F.abs(F.coalesce(as_col(c), F.lit(0.0))), [(">=", 10000.0, strong), (">=", 3000.0, medium)], weak)


def preview(c):  # K27
    n = PREVIEW_LABELS
    return ladder(c, [(">=", 1.2, n[0]), (">=", 0.4, n[1]), ("<=", -1.2, n[2]), ("<=", -0.4, n[3])], n[4])


def argmax_label(probabilities: Mapping[str, Column | str]) -> Column:
    """P24. Label of the largest probability; the first listed wins a tie."""
    best = F.greatest(*[as_col(c) for c in probabilities.values()])
    out = None
    for label, c in probabilities.items():
        out = F.when(as_col(c) == best, label) if out is None else out.when(as_col(c) == best, label)
    return out


def threshold_label(prob_down, prob_up, down, up) -> Column:
    """P25. Down when its bound is met and it is at least up; else up; else sideways."""
    pd_, pu, d, u = (as_col(c) for c in (prob_down, prob_up, down, up))
    return F.when((pd_ >= d) & (pd_ >= pu), "down").when((pu >= u) & (pu > pd_), "up").otherwise("sideways")


def lookup(mapping: Mapping[str, object], key: Column | str, default=None) -> Column:
    """Literal dictionary as a map expression (fixed, small)."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    found = F.try_element_at(F.create_map(*pairs), as_col(key))
    return found if default is None else F.coalesce(found, F.lit(default))


def exposure(direction, confidence, profile: Mapping[str, float], floor, fallback) -> Column:
    """P26. Exposure of the direction, or the fallback under the confidence floor."""
    floor = floor if isinstance(floor, Column) else F.lit(float(floor))
    fallback = fallback if isinstance(fallback, Column) else F.lit(float(fallback))
    return F.when(as_col(confidence) < floor, fallback).otherwise(lookup(profile, direction, 0.0))


def _any_of(words: Sequence[str]) -> str:
    return "|".join(words)


def classify_text(text, rules: Sequence[tuple] = DISCLOSURE_RULES, exempt: Sequence[str] = DISCLOSURE_EXEMPT,
                  default: tuple = DISCLOSURE_DEFAULT) -> Column:
    """P27. Ordered keyword rules with an exemption; returns a struct of the four fields.

    Keywords are plain words (no regular-expression characters).
    """
    text = F.trim(F.coalesce(as_col(text), F.lit("")))

    def outcome(row):
        key, label, flag, severity = row[:4]
        return F.struct(F.lit(key).alias("category_key"), F.lit(label).alias("category_label"),
                        F.lit(flag).alias("risk_flag"), F.lit(severity).alias("severity_label"))

    out = F.when(text.rlike(_any_of(exempt)), outcome(default))
    for rule in rules:
        out = out.when(text.rlike(_any_of(rule[4])), outcome(rule))
    return out.otherwise(outcome(default))


def mentions_any(text, words: Sequence[str]) -> Column:
    """P28. Case-insensitive test for any of the words."""
    return F.lower(as_col(text)).rlike(_any_of([w.lower() for w in words]))


# Collapse of five direction labels to three classes.
THREE_CLASS = {"strong_down": "down", "mild_down": "down", "sideways": "sideways", "mild_up": "up", "strong_up": "up"}


def three_class(label) -> Column:  # P30
    return lookup(THREE_CLASS, label)


def market_side(c) -> Column:
    return ladder(F.coalesce(as_col(c), F.lit(0.0)), [(">=", 0.3, "bullish"), ("<=", -0.3, "bearish")], "neutral")


def alignment(medium, intraday) -> Column:
    """P34. Whether the medium-term and intraday sides agree."""
    a, b = market_side(medium), market_side(intraday)
    return F.when((a == "neutral") | (b == "neutral"), "mixed").when(a == b, "aligned").otherwise("divergent")


def signal_agreement(a, b) -> Column:  # P19
    a, b = as_col(a), as_col(b)
    return (F.when(a.isNull() & b.isNull(), "unavailable").when(a.isNull() | b.isNull(), "single_source")
            .when(F.signum(a) == F.signum(b), "aligned").otherwise("mixed"))


def status_badge(c):  # P38
    return ladder(c, [(">=", 1.0, "good"), (">", -0.5, "neutral")], "bad")


def axis_status(c):  # P38
    return ladder(c, [(">=", 0.3, "positive"), ("<=", -0.3, "negative")], "neutral", "unknown")


def public_intraday_label(label, session_status) -> Column:  # P38
    text = F.trim(F.coalesce(as_col(label), F.lit("")))
    mixed = INTRADAY_LABELS[2]
    return (F.when(text.isin(INTRADAY_LABELS), text)
            .when(as_col(session_status) == "fallback_prev_close", mixed)
            .otherwise(F.coalesce(F.nullif(text, F.lit("")), F.lit(mixed))))


def considerations(env, medium, short) -> Column:
    """P39. Codes of the three considerations raised by the axis scores."""
    env, medium, short = as_col(env), as_col(medium), as_col(short)
    return F.array(
        F.when(env < -0.3, "environment_warning").when(env > 0.3, "environment_positive")
        .otherwise("environment_neutral"),
        F.when(medium >= 1.0, "medium_positive").when(medium <= -1.0, "medium_warning").otherwise("medium_neutral"),
        F.when(short <= -0.3, "short_warning").when(short >= 0.3, "short_positive").otherwise("short_neutral"),
    )


def change_side(current, previous, tolerance: float = 1e-9) -> Column:
    """W26. Stronger / weaker / unchanged against the previous score."""
    cur, prev = as_col(current), as_col(previous)
    return (F.when(prev.isNull(), "unchanged").when(cur > prev + tolerance, "stronger")
            .when(cur < prev - tolerance, "weaker").otherwise("unchanged"))
