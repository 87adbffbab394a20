"""Window queries over keyed series."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.expressions import rd
from tidemark.catalog.registry import query, r, sql_clip, sql_mean, sql_roll
from tidemark.functions import labels as L
from tidemark.functions import numeric as N
from tidemark.operators import asof as A
from tidemark.operators import relational as R
from tidemark.operators import windows as W
from tidemark.operators.windows import Axis

TICK = Axis.of("ticker", "date")
SCOPE = Axis.of("market_scope", "date")
P = "PARTITION BY ticker ORDER BY date"
PS = "PARTITION BY market_scope ORDER BY date"
RET = f"close / nullif(lag(close) OVER ({P}), 0) - 1"


def ret_sql(n: int, c: str = "close", win: str = P) -> str:
    return f"{c} / nullif(lag({c}, {n}) OVER ({win}), 0) - 1"


def roll(fn: str, x: str, n: int, mp: int, win: str = P) -> str:
    return sql_roll(fn, x, n, mp, win)


def returns(t):
    return t.market_prices.withColumn("ret", W.lag_return(TICK, "close"))


RETURNS = f"(SELECT *, {RET} AS ret FROM market_prices)"


@query("w1_lag_returns", f"SELECT ticker, date, {', '.join(r(ret_sql(n)) + f' AS ret_{n}d' for n in (1, 5, 20, 60))} FROM stock_prices")
def w1(t):
    return t.stock_prices.select("ticker", "date", *[rd(W.lag_return(TICK, "close", n)).alias(f"ret_{n}d") for n in (1, 5, 20, 60)])


@query("w2_lag_differences", f"SELECT ticker, date, {', '.join(r(f'close - lag(close, {n}) OVER ({P})', 4) + f' AS diff_{n}' for n in (1, 5, 20))} FROM stock_prices")
def w2(t):
    return t.stock_prices.select("ticker", "date", *[rd(W.lag_diff(TICK, "close", n), 4).alias(f"diff_{n}") for n in (1, 5, 20)])


@query("w3_year_over_year", f"SELECT series_id, asof_date, {r(ret_sql(12, 'value', 'PARTITION BY series_id ORDER BY asof_date'))} AS yoy FROM monthly_obs")
def w3(t):
    ax = Axis.of("series_id", "asof_date")
    return t.monthly_obs.select("series_id", "asof_date", rd(W.year_over_year(ax, "value")).alias("yoy"))


SMA = {20: 10, 60: 20, 120: 40}


@query("w4_rolling_means", "SELECT ticker, date, " + ", ".join(
    f"{r('close / ' + roll('avg', 'close', n, mp))} AS to_sma{n}, coalesce((close > {roll('avg', 'close', n, mp)})::INT, 0) AS above{n}" for n, mp in SMA.items()) + " FROM stock_prices")
def w4(t):
    cols = []
    for n, mp in SMA.items():
        cols += [rd(N.ratio("close", W.rolling_mean(TICK, "close", n, mp))).alias(f"to_sma{n}"), W.above_mean(TICK, "close", n, mp).cast("int").alias(f"above{n}")]
    return t.stock_prices.select("ticker", "date", *cols)


@query("w5_annualised_vol", f"SELECT ticker, date, {r(roll('stddev_samp', 'ret', 20, 10) + ' * sqrt(252)')} AS vol_20d FROM {RETURNS}")
def w5(t):
    return returns(t).select("ticker", "date", rd(W.annualised_vol(TICK, "ret")).alias("vol_20d"))


@query("w6_realised_vol", f"SELECT ticker, date, {r(roll('stddev_pop', 'ret', 20, 20))} AS vol FROM {RETURNS}")
def w6(t):
    return returns(t).select("ticker", "date", rd(W.realised_vol(TICK, "ret")).alias("vol"))


@query("w7_log_return_vol", f"SELECT ticker, date, {r(roll('stddev_samp', 'lret', 20, 20) + ' * sqrt(252)')} AS vol FROM (SELECT *, ln(close / lag(close) OVER ({P})) AS lret FROM market_prices)")
def w7(t):
    rows = t.market_prices.withColumn("lret", F.log(N.ratio("close", F.lag("close").over(TICK.by))))
    return rows.select("ticker", "date", rd(W.annualised_vol(TICK, "lret", 20, 20)).alias("vol"))


@query("w8_rolling_drawdown", f"SELECT ticker, date, {r('close / ' + roll('max', 'close', 5, 1) + ' - 1')} AS dd_5d, {r('close / ' + roll('max', 'close', 20, 1) + ' - 1')} AS dd_20d FROM stock_prices")
def w8(t):
    return t.stock_prices.select("ticker", "date", rd(W.drawdown(TICK, "close", 5)).alias("dd_5d"), rd(W.drawdown(TICK, "close", 20)).alias("dd_20d"))


@query("w9_rolling_max_drawdown", f"SELECT ticker, date, {r(roll('min', 'dd', 60, 20))} AS mdd_3m FROM (SELECT *, close / {roll('max', 'close', 60, 20)} - 1 AS dd FROM stock_prices)")
def w9(t):
    return W.with_rolling_mdd(t.stock_prices, TICK, "close", 60, "mdd").select("ticker", "date", rd("mdd").alias("mdd_3m"))


@query("w10_high_low_touches", f"SELECT ticker, date, coalesce((close >= {roll('max', 'close', 20, 10)})::INT, 0) AS high, coalesce((close <= {roll('min', 'close', 20, 10)})::INT, 0) AS low FROM stock_prices")
def w10(t):
    return t.stock_prices.select("ticker", "date", W.touches_high(TICK, "close", 20, 10).cast("int").alias("high"), W.touches_low(TICK, "close", 20, 10).cast("int").alias("low"))


@query("w11_expansion_ratio", f"SELECT ticker, date, {r('value / nullif(' + roll('avg', 'value', 20, 10) + ', 0)')} AS expansion FROM stock_prices")
def w11(t):
    return t.stock_prices.select("ticker", "date", rd(W.expansion(TICK, "value")).alias("expansion"))


BLEND = f"""blend AS (SELECT date, sum(CASE WHEN market_scope = 'KOSPI' THEN 0.6::DOUBLE * ret WHEN market_scope = 'KOSDAQ' THEN 0.4::DOUBLE * ret END) AS ret
  FROM (SELECT market_scope, date, close / lag(close) OVER ({PS}) - 1 AS ret FROM scope_prices) WHERE market_scope <> 'KOSPI200' GROUP BY 1)"""


@query("w12_cumulative_index", f"""SELECT ticker, date, {r(f'sum(ln(1 + coalesce(ret, 0) / 100)) OVER ({P}) + ln(100)')} AS log_level FROM {RETURNS}""")
def w12(t):
    return returns(t).select("ticker", "date", rd(F.log(W.cumulative_index(TICK, F.col("ret") / 100))).alias("log_level"))


@query("w13_running_peak", f"SELECT ticker, date, {r(f'max(close) OVER ({P})', 4)} AS peak, {r(f'close / max(close) OVER ({P}) - 1')} AS drawdown FROM stock_prices")
def w13(t):
    peak = W.running_peak(TICK, "close")
    return t.stock_prices.select("ticker", "date", rd(peak, 4).alias("peak"), rd(N.ratio("close", peak) - 1).alias("drawdown"))


def z_sql(x: str, n: int, mp: int, win: str, sd: str = "stddev_pop", bound: bool = True) -> str:
    z = f"(({x} - {sql_roll('avg', x, n, mp, win)}) / nullif({sql_roll(sd, x, n, mp, win)}, 0))"
    return sql_clip(z) if bound else z


@query("w14_rolling_zscore", f"SELECT ticker, date, {r(z_sql('close', 252, 30, P))} AS z FROM stock_prices")
def w14(t):
    return W.with_zscore(t.stock_prices, TICK, "close", "z").select("ticker", "date", rd("z").alias("z"))


@query("w15_change_zscore", f"SELECT ticker, date, {r(z_sql('chg', 252, 30, P))} AS z FROM (SELECT *, close - lag(close, 20) OVER ({P}) AS chg FROM market_prices)")
def w15(t):
    return W.with_change_zscore(t.market_prices, TICK, "close", 20, "z").select("ticker", "date", rd("z").alias("z"))


@query("w16_scope_zscores", f"SELECT market_scope, date, {r(z_sql('value', 20, 10, PS, 'stddev_samp', False))} AS z20, {r(z_sql('value', 60, 30, PS, 'stddev_samp', False))} AS z60 FROM scope_prices")
def w16(t):
    out = t.scope_prices
    for n in (20, 60):
        out = W.with_zscore(out, SCOPE, "value", f"z{n}", n, max(10, n // 2), population=False, bound=None)
    return out.select("market_scope", "date", rd("z20").alias("z20"), rd("z60").alias("z60"))


@query("w17_rolling_percentile_rank", f"""
SELECT market_scope, date, {r('CASE WHEN len(xs) >= 20 THEN (len(list_filter(xs, lambda v: v < value)) + (len(list_filter(xs, lambda v: v = value)) + 1) / 2.0::DOUBLE) / len(xs) END')} AS pctile
FROM (SELECT *, list(value) OVER ({PS} ROWS BETWEEN 59 PRECEDING AND CURRENT ROW) AS xs FROM scope_prices)""")
def w17(t):
    return t.scope_prices.select("market_scope", "date", rd(W.percentile_rank(SCOPE, "value")).alias("pctile"))


@query("w18_lagged_expectation", f"""
SELECT series_id, asof_date, {r('CASE WHEN n >= 12 THEN m END', 4)} AS expected, {r('CASE WHEN n >= 12 THEN (value - m) / nullif(s, 0) END')} AS surprise_z FROM (
  SELECT *, count(value) OVER w AS n, avg(value) OVER w AS m, stddev_pop(value) OVER w AS s FROM monthly_obs
  WINDOW w AS (PARTITION BY series_id ORDER BY asof_date ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING))""")
def w18(t):
    out = W.with_expectation(t.monthly_obs, Axis.of("series_id", "asof_date"), "value")
    return out.select("series_id", "asof_date", rd("expected", 4).alias("expected"), rd("surprise_z").alias("surprise_z"))


FL = "PARTITION BY ticker, investor ORDER BY date"
FLOW = Axis.of(["ticker", "investor"], "date")


@query("w19_rolling_sums", "SELECT ticker, investor, date, " + ", ".join(r(f"sum(net_value) OVER ({FL} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)", 4) + f" AS sum_{n}" for n in (3, 5, 20, 63)) + " FROM flows")
def w19(t):
    return t.flows.select("ticker", "investor", "date", *[rd(W.rolling_sum(FLOW, "net_value", n), 4).alias(f"sum_{n}") for n in (3, 5, 20, 63)])


@query("w20_positive_days", f"SELECT ticker, investor, date, CAST(sum((net_value > 0)::INT) OVER ({FL} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS BIGINT) AS positive_days, {r(roll('avg', 'net_value', 20, 1, FL))} AS mean_20 FROM flows")
def w20(t):
    return t.flows.select("ticker", "investor", "date", W.positive_days(FLOW, "net_value", 5).alias("positive_days"), rd(W.rolling_mean(FLOW, "net_value", 20)).alias("mean_20"))


@query("w21_rolling_correlation", "SELECT ticker, date, " + ", ".join(
    r(f"CASE WHEN count(x) OVER ({P} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) >= {max(10, n // 2)} AND min(x) OVER ({P} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) < max(x) OVER ({P} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) THEN corr(x, y) OVER ({P} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) END", 5) + f" AS corr_{n}d" for n in (20, 60, 120)) + """
FROM (SELECT ticker, date, CASE WHEN a IS NOT NULL THEN b END AS y, CASE WHEN b IS NOT NULL THEN a END AS x FROM (
  SELECT ticker, date, value AS a, close / nullif(lag(close) OVER (PARTITION BY ticker ORDER BY date), 0) - 1 AS b FROM market_prices))""")
def w21(t):
    return returns(t).select("ticker", "date", *[rd(W.rolling_corr(TICK, "value", "ret", n), 5).alias(f"corr_{n}d") for n in (20, 60, 120)])


@query("w22_rolling_hit_and_mae", f"""
SELECT ticker, date, {r(roll('avg', 'hit', 60, 30))} AS hit_60d, {r(roll('avg', 'err', 60, 30))} AS mae_60d, {r(roll('avg', 'err', 60, 30) + ' - ' + roll('avg', 'base', 60, 30))} AS mae_spread
FROM (SELECT *, CASE WHEN ret IS NOT NULL AND p IS NOT NULL THEN (sign(p) = sign(ret))::INT::DOUBLE END AS hit, abs(p - ret) AS err, CASE WHEN p IS NOT NULL THEN abs(ret) END AS base
  FROM (SELECT *, lag(ret) OVER ({P}) AS p FROM {RETURNS}))""")
def w22(t):
    rows = returns(t).withColumn("p", F.lag("ret").over(TICK.by))
    both = F.col("p").isNotNull() & F.col("ret").isNotNull()
    rows = rows.withColumns({"hit": F.when(both, (F.signum("p") == F.signum("ret")).cast("double")),
                             "err": F.abs(F.col("p") - F.col("ret")), "base": F.when(F.col("p").isNotNull(), F.abs("ret"))})
    m = lambda c: W.rolling_mean(TICK, c, 60, 30)
    return rows.select("ticker", "date", rd(m("hit")).alias("hit_60d"), rd(m("err")).alias("mae_60d"), rd(m("err") - m("base")).alias("mae_spread"))


@query("w23_forward_return_std", f"SELECT market_scope, date, {r(roll('stddev_samp', 'fwd', 252, 60, PS))} AS scale FROM (SELECT *, lead(close, 5) OVER ({PS}) / close - 1 AS fwd FROM scope_prices)")
def w23(t):
    rows = t.scope_prices.withColumn("fwd", W.forward_return(SCOPE, "close", 5))
    return W.with_rolling_std(rows, SCOPE, "fwd", "scale", 252, 60).select("market_scope", "date", rd("scale").alias("scale"))


@query("w24_forward_returns", f"SELECT ticker, date, {', '.join(r(f'lead(close, {n}) OVER ({P}) / close - 1') + f' AS fwd_{n}d' for n in (1, 5, 20))}, lead(date, 5) OVER ({P}) AS end_date FROM stock_prices")
def w24(t):
    return t.stock_prices.select("ticker", "date", *[rd(W.forward_return(TICK, "close", n)).alias(f"fwd_{n}d") for n in (1, 5, 20)], F.lead("date", 5).over(TICK.by).alias("end_date"))


@query("w25_forward_extremes", f"SELECT ticker, date, {r(f'min(close) OVER ({P} ROWS BETWEEN 1 FOLLOWING AND 20 FOLLOWING) / close - 1')} AS fwd_mdd, {r(f'max(close) OVER ({P} ROWS BETWEEN 1 FOLLOWING AND 20 FOLLOWING) / close - 1')} AS fwd_runup FROM stock_prices")
def w25(t):
    return t.stock_prices.select("ticker", "date", rd(W.forward_drawdown(TICK, "close", 20)).alias("fwd_mdd"), rd(W.forward_runup(TICK, "close", 20)).alias("fwd_runup"))


LABELLED = f"(SELECT market_scope, date, close, CASE WHEN z IS NULL THEN NULL WHEN z >= 0.5 THEN 'up' WHEN z > -0.5 THEN 'flat' ELSE 'down' END AS label FROM (SELECT *, {z_sql('close', 60, 20, PS)} AS z FROM scope_prices))"


def labelled(t):
    z = W.zscore(SCOPE, "close", 60, 20)
    return t.scope_prices.select("market_scope", "date", "close", L.ladder(z, [(">=", 0.5, "up"), (">", -0.5, "flat")], "down").alias("label"))


CHANGED = f"(SELECT *, lag(label) OVER ({PS}) AS previous, coalesce(lag(label) OVER ({PS}) <> label, false)::INT AS changed FROM {LABELLED})"


def changed(t):
    return labelled(t).withColumns(W.change_columns(SCOPE, "label"))


@query("w26_label_changes", f"SELECT market_scope, date, label, previous, changed FROM {CHANGED}")
def w26(t):
    return changed(t).select("market_scope", "date", "label", "previous", "changed")


@query("w27_transition_counts", f"""SELECT market_scope, date, CAST(sum(changed) OVER ({PS} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS BIGINT) AS t5,
  CAST(sum(changed) OVER ({PS} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS BIGINT) AS t20,
  {r(f'1 - greatest(0, least(1, sum(changed) OVER ({PS} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)::DOUBLE / 5))')} AS stability FROM {CHANGED}""")
def w27(t):
    t20 = W.transition_counts(SCOPE, "changed", 20)
    return changed(t).select("market_scope", "date", W.transition_counts(SCOPE, "changed", 5).alias("t5"), t20.alias("t20"),
                             rd(1 - N.clip(t20 / 5.0, 0, 1)).alias("stability"))


@query("w28_days_since_change", f"""SELECT market_scope, date, rn - max(CASE WHEN changed = 1 OR rn = 1 THEN rn END) OVER ({PS}) AS days_since_change
FROM (SELECT *, row_number() OVER ({PS}) AS rn FROM {CHANGED})""")
def w28(t):
    return W.with_days_since_change(changed(t), SCOPE, "changed", "days_since_change").select("market_scope", "date", "days_since_change")


@query("w29_persistence_streak", f"""SELECT ticker, date, CASE WHEN ok THEN row_number() OVER (PARTITION BY ticker, ok, island ORDER BY date) ELSE 0 END AS streak FROM (
  SELECT *, sum((NOT ok)::INT) OVER ({P}) AS island FROM (SELECT ticker, date, coalesce({ret_sql(20)} > 0, false) AS ok FROM stock_prices))""")
def w29(t):
    rows = t.stock_prices.withColumn("ret_20d", W.lag_return(TICK, "close", 20))
    return W.with_streak(rows, TICK, F.col("ret_20d") > 0, "streak").select("ticker", "date", "streak")


W30 = "PARTITION BY signal_code ORDER BY asof_ts"


@query("w30_time_based_transitions", f"""
SELECT signal_code, asof_ts, CAST(sum(changed) OVER d5 - first(changed) OVER d5 AS BIGINT) AS transitions_5d, CAST(sum(changed) OVER d20 - first(changed) OVER d20 AS BIGINT) AS transitions_20d,
  {r('hours', 4)} AS state_hours,
  {r('0.4::DOUBLE * least(hours / 24.0::DOUBLE, 1) + 0.6::DOUBLE * greatest(0, 1 - (sum(changed) OVER d20 - first(changed) OVER d20)::DOUBLE / 10)', 5)} AS stability
FROM (SELECT *, date_diff('second', max(CASE WHEN changed = 1 OR opening THEN asof_ts END) OVER ({W30}), asof_ts) / 3600.0::DOUBLE AS hours FROM (
  SELECT *, coalesce(lag(label) OVER ({W30}) <> label, false)::INT AS changed, lag(label) OVER ({W30}) IS NULL AS opening FROM (
    SELECT asof_ts, signal_code, CASE WHEN change_pct * 120 >= 0.4 THEN 'up' WHEN change_pct * 120 > -0.4 THEN 'flat' ELSE 'down' END AS label FROM bars)))
WINDOW d5 AS ({W30} RANGE BETWEEN INTERVAL 5 DAYS PRECEDING AND CURRENT ROW), d20 AS ({W30} RANGE BETWEEN INTERVAL 20 DAYS PRECEDING AND CURRENT ROW)""")
def w30(t):
    label = L.ladder(F.col("change_pct") * 120, [(">=", 0.4, "up"), (">", -0.4, "flat")], "down")
    out = W.with_transition_stats(t.bars.withColumn("label", label), ["signal_code"], "asof_ts", "label")
    return out.select("signal_code", "asof_ts", "transitions_5d", "transitions_20d", rd("state_hours", 4).alias("state_hours"), rd("stability", 5).alias("stability"))


CROSS = f"""(SELECT date, ticker, value, raw, {sql_clip('CASE WHEN raw IS NULL THEN NULL WHEN count(raw) OVER d > 1 AND max(raw) OVER d > min(raw) OVER d THEN (raw - avg(raw) OVER d) / stddev_pop(raw) OVER d ELSE 0 END')} AS z,
  value / sum(value) OVER d AS share FROM (SELECT *, {ret_sql(20)} AS raw FROM stock_prices) WINDOW d AS (PARTITION BY date))"""


def crossed(t):
    rows = t.stock_prices.withColumn("raw", W.lag_return(TICK, "close", 20))
    return W.with_cross_section(rows, "date", "raw", "value", "z", "share")


@query("w31_cross_section_zscore", f"SELECT ticker, date, {r('z', 5)} AS z FROM {CROSS}")
def w31(t):
    return crossed(t).select("ticker", "date", rd("z", 5).alias("z"))


@query("w32_cross_section_share", f"SELECT ticker, date, {r('share')} AS share FROM {CROSS}")
def w32(t):
    return crossed(t).select("ticker", "date", rd("share").alias("share"))


@query("w33_cross_section_rank", "SELECT theme_bucket, date, row_number() OVER (PARTITION BY date ORDER BY value DESC, theme_bucket) AS rnk FROM theme_prices")
def w33(t):
    return t.theme_prices.select("theme_bucket", "date", W.cross_rank("date", "value", "theme_bucket").alias("rnk"))


@query("w34_rotation", f"SELECT ticker, date, {r(f'z - lag(z, 20) OVER ({P})', 5)} AS rotation FROM {CROSS}")
def w34(t):
    return crossed(t).select("ticker", "date", rd(W.lag_diff(TICK, "z", 20), 5).alias("rotation"))


MEMBERS = ["DGS10", "DGS2", "VIXCLS", "DEXKOUS"]


@query("w35_forward_fill", f"""
SELECT series_id, s.asof_date, last_value(value IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY s.asof_date) AS value
FROM (SELECT DISTINCT asof_date FROM daily_obs) s CROSS JOIN (SELECT unnest({MEMBERS}) AS series_id) m LEFT JOIN daily_obs o USING (series_id, asof_date)""")
def w35(t):
    return A.forward_fill(A.date_spine(t.daily_obs, "asof_date"), t.daily_obs.where(F.col("series_id").isin(MEMBERS)), MEMBERS, "series_id", "value")


@query("w36_calendar_carry_forward", """
SELECT series_id, unnest(generate_series(asof_date, greatest(coalesce(nxt - 1, DATE '2001-12-31'), asof_date), INTERVAL 1 DAY))::DATE AS asof_date, value, asof_date AS source_date,
  CASE WHEN unnest(generate_series(asof_date, greatest(coalesce(nxt - 1, DATE '2001-12-31'), asof_date), INTERVAL 1 DAY))::DATE = asof_date THEN 'observed' ELSE 'carry_forward' END AS point_type
FROM (SELECT *, lead(asof_date) OVER (PARTITION BY series_id ORDER BY asof_date) AS nxt FROM monthly_obs)""")
def w36(t):
    return A.carry_forward_days(t.monthly_obs, ["series_id"], "asof_date", ["value"], F.lit("2001-12-31").cast("date"))


@query("w37_carry_latest_rates", """
SELECT series_id, DATE '2002-01-15' AS asof_date, value, 'carry_forward:obs' AS source FROM daily_obs WHERE asof_date = (SELECT max(asof_date) FROM daily_obs)""")
def w37(t):
    rates = t.daily_obs.withColumns({"source": F.lit("obs"), "market": F.lit("KR")})
    return A.carry_latest_to(rates, ["market"], "asof_date", F.lit("2002-01-15").cast("date")).drop("market")


EVENTS = f"(SELECT ticker, date, row_number() OVER ({P}) AS rn, (coalesce(abs({ret_sql(1)}), 0) >= 0.5)::INT AS evt FROM market_prices)"


def with_events(t):
    return returns(t).withColumn("evt", (F.coalesce(F.abs("ret"), F.lit(0.0)) >= 0.5).cast("int"))


@query("w38_event_distance", f"""SELECT ticker, date, rn - last_value(CASE WHEN evt = 1 THEN rn END IGNORE NULLS) OVER ({P}) AS since,
  first_value(CASE WHEN evt = 1 THEN rn END IGNORE NULLS) OVER ({P} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) - rn AS until FROM {EVENTS}""")
def w38(t):
    return W.with_event_distance(with_events(t), TICK, "evt", "since", "until").select("ticker", "date", "since", "until")


@query("w39_latest_row_per_day", """SELECT session_date, signal_code, asof_ts, event_id, metric_value FROM snapshots
QUALIFY row_number() OVER (PARTITION BY session_date, signal_code ORDER BY asof_ts DESC, event_id DESC) = 1""")
def w39(t):
    rows = t.snapshots.select("session_date", "signal_code", "asof_ts", "event_id", "metric_value")
    return R.latest_per_key(rows, ["session_date", "signal_code"], ["asof_ts", "event_id"])


STRATEGY = f"""(SELECT *, equity / max(equity) OVER ({PS}) - 1 AS dd FROM (
  SELECT *, exposure * next_return - turnover * 0.0005::DOUBLE AS strategy_return, exp(sum(ln(1 + coalesce(exposure * next_return - turnover * 0.0005::DOUBLE, 0))) OVER ({PS})) AS equity FROM (
    SELECT *, abs(exposure - coalesce(lag(exposure) OVER ({PS}), 0)) AS turnover FROM (
      SELECT market_scope, date, (lead(close) OVER ({PS}) / close - 1) / 50 AS next_return, CASE WHEN close >= {roll('avg', 'close', 20, 10, PS)} THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END AS exposure FROM scope_prices))))"""


def strategy(t):
    rows = t.scope_prices.withColumn("next_return", W.forward_return(SCOPE, "close", 1) / 50)
    rows = rows.withColumn("exposure", F.when(F.col("close") >= W.rolling_mean(SCOPE, "close", 20, 10), 1.0).otherwise(0.5))
    return W.with_strategy(rows, SCOPE, "exposure", "next_return")


@query("w40_strategy_path", f"SELECT market_scope, date, {r('turnover')} AS turnover, {r('strategy_return', 8)} AS strategy_return, {r('equity', 5)} AS equity, {r('dd', 5)} AS drawdown FROM {STRATEGY}")
def w40(t):
    return strategy(t).select("market_scope", "date", rd("turnover").alias("turnover"), rd("strategy_return", 8).alias("strategy_return"),
                              rd("equity", 5).alias("equity"), rd("equity_drawdown", 5).alias("drawdown"))


@query("w41_rebased_index", f"SELECT ticker, date, {r(f'close / first_value(close) OVER ({P}) * 100', 4)} AS level FROM market_prices")
def w41(t):
    return t.market_prices.select("ticker", "date", rd(W.rebased(TICK, "close"), 4).alias("level"))


@query("w42_ratio_of_sums", "SELECT ticker, investor, date, " + ", ".join(r(f"sum(net_value) OVER ({FL} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) / nullif(sum(abs(net_value)) OVER ({FL} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW), 0)") + f" AS ratio_{n}d" for n in (5, 20)) + " FROM flows")
def w42(t):
    return t.flows.select("ticker", "investor", "date", *[rd(W.ratio_of_sums(FLOW, "net_value", F.abs("net_value"), n)).alias(f"ratio_{n}d") for n in (5, 20)])


@query("w43_axis_features", f"""
WITH wide AS (SELECT date, max(close) FILTER (market_scope = 'KOSPI') / 1000 AS a, max(close) FILTER (market_scope = 'KOSDAQ') / 1000 AS b, max(close) FILTER (market_scope = 'KOSPI200') / 1000 AS c FROM scope_prices GROUP BY 1)
SELECT date, {r('a - lag(a, 5) OVER (ORDER BY date)', 9)} AS a_delta_5d, {r(sql_roll('avg', 'a', 5, 3, 'ORDER BY date'), 9)} AS a_ma_5d, {r('ln(a * b)', 9)} AS a_x_b,
  {r(sql_mean('a', 'b', 'c'), 9)} AS axis_mean, greatest(a, b, c) AS axis_max, least(a, b, c) AS axis_min,
  {r('''sqrt((coalesce(pow(a - m, 2), 0) + coalesce(pow(b - m, 2), 0) + coalesce(pow(c - m, 2), 0)) / nullif((a IS NOT NULL)::INT + (b IS NOT NULL)::INT + (c IS NOT NULL)::INT - 1, 0))''', 9)} AS axis_std
FROM (SELECT *, {sql_mean('a', 'b', 'c')} AS m FROM wide)""")
def w43(t):
    from tidemark.plans.research import axis_features

    wide = R.pivot_wide(t.scope_prices.withColumn("k", F.lit("axis")), ["k", "date"], "market_scope", ["KOSPI", "KOSDAQ", "KOSPI200"], F.max("close") / 1000)
    named = wide.withColumnsRenamed({"KOSPI": "a", "KOSDAQ": "b", "KOSPI200": "c"})
    out = axis_features(named, Axis.of("k", "date"), ["a", "b", "c"])
    return out.select("date", *[rd(c, 9).alias(c) for c in ("a_delta_5d", "a_ma_5d", "axis_mean", "axis_std")],
                      rd(F.log("a_x_b"), 9).alias("a_x_b"), "axis_max", "axis_min")


@query("w44_next_day_returns", f"""
WITH s AS (SELECT market_scope, date, lead(close) OVER ({PS}) / close - 1 AS nxt FROM scope_prices WHERE market_scope <> 'KOSPI200')
SELECT market_scope, date, {r('nxt')} AS next_return FROM s UNION ALL SELECT 'ALL', date, {r('avg(nxt)')} FROM s GROUP BY date""")
def w44(t):
    rows = t.scope_prices.where(F.col("market_scope") != "KOSPI200").withColumn("nxt", W.forward_return(SCOPE, "close", 1))
    both = rows.select("market_scope", "date", "nxt").unionByName(
        rows.groupBy("date").agg(F.avg("nxt").alias("nxt")).withColumn("market_scope", F.lit("ALL")))
    return both.select("market_scope", "date", rd("nxt").alias("next_return"))


@query("w45_trend_of_last_two", f"""
SELECT ticker, CASE WHEN close > prev THEN 'up' WHEN close < prev THEN 'down' ELSE 'flat' END AS trend FROM (
  SELECT *, lag(close) OVER ({P}) AS prev FROM stock_prices) QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) = 1""")
def w45(t):
    rows = t.stock_prices.withColumn("delta", W.lag_diff(TICK, "close", 1)).select("ticker", "date", "delta")
    last = R.latest_per_key(rows, ["ticker"], ["date"])
    return last.select("ticker", L.sign_label("delta", "up", "down", "flat", "flat").alias("trend"))


@query("w46_window_return", f"SELECT ticker, {r('close / nullif(base, 0) - 1')} AS ret_20d FROM (SELECT *, lag(close, 20) OVER ({P}) AS base FROM stock_prices) QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) = 1")
def w46(t):
    rows = t.stock_prices.withColumn("ret", W.lag_return(TICK, "close", 20)).select("ticker", "date", "ret")
    return R.latest_per_key(rows, ["ticker"], ["date"]).select("ticker", rd("ret").alias("ret_20d"))
