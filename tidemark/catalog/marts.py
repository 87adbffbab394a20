"""Composite marts K1-K19, K29 over the sample tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.expressions import FIVE, rd
from tidemark.catalog.registry import CTES, query, r, sql_clip, sql_mean, sql_roll
from tidemark.plans import context as C
from tidemark.plans import macro as M
from tidemark.plans.specs import (
    ASSET_CODES, CYCLICAL_SECTORS, DAILY_SERIES, DAILY_SHOCKS, DEFENSIVE_SECTORS, FORECAST_TERMS, FORECAST_WEIGHTS, MARKET_SCOPES, MONTHLY_EVENTS, SURPRISE_GROUPS,
    SURPRISE_SPECS)

START, END = "1995-06-01", "2001-06-30"


def day(d: str):
    return F.lit(d).cast("date")


def d_(x: float) -> str:
    return f"({x})::DOUBLE"


def direction_sql(c: str) -> str:
    """Reading of a score by its name."""
    words = " OR ".join(f"contains({c}, '{w}')" for w in ("pressure", "stress", "risk_off", "drawdown", "aversion", "volatility"))
    return f"CASE WHEN {words} THEN 'higher_is_riskier' WHEN ends_with({c}, '_score') OR ends_with({c}, '_ratio') THEN 'higher_is_better' ELSE 'descriptive' END"


# -- K1, K2 -----------------------------------------------------------------------------

def proxy_sql(source: str, key: str) -> str:
    p = f"PARTITION BY {key} ORDER BY date"
    ret = lambda n: f"close / nullif(lag(close, {n}) OVER ({p}), 0) - 1"
    flag = lambda cond: f"coalesce(({cond})::INT, 0)::DOUBLE"
    return f"""SELECT *, {sql_roll('stddev_samp', 'dr', 20, 10, p)} * sqrt(252) AS vol_20d, {sql_roll('min', 'dd', 60, 20, p)} AS mdd_3m, {flag('ret_1m > 0')} AS ret_pos_1m FROM (
      SELECT *, {ret(1)} AS dr, {ret(20)} AS ret_1m, {ret(60)} AS ret_3m, {flag('close > ' + sql_roll('avg', 'close', 20, 10, p))} AS above_sma20,
        {flag('close > ' + sql_roll('avg', 'close', 60, 20, p))} AS above_sma60, {flag('close > ' + sql_roll('avg', 'close', 120, 40, p))} AS above_sma120,
        {flag('close >= ' + sql_roll('max', 'close', 20, 10, p))} AS new_high_ratio_20d, {flag('close <= ' + sql_roll('min', 'close', 20, 10, p))} AS new_low_ratio_20d,
        value / nullif({sql_roll('avg', 'value', 20, 10, p)}, 0) AS trading_value_expansion_ratio, close / {sql_roll('max', 'close', 60, 20, p)} - 1 AS dd FROM {source})"""


CTES["k1_members"] = proxy_sql("(SELECT ticker AS market_scope, date, close, value FROM market_prices WHERE ticker IN ('KOSPI', 'KOSDAQ'))", "market_scope")
CTES["k1_pair"] = "SELECT a.date, a.close AS ca, b.close AS cb, a.value + b.value AS value, " + ", ".join(
    f"(a.{f} + b.{f}) / 2 AS m_{f}" for f in C.FLAGS) + " FROM k1_members a JOIN k1_members b ON a.date = b.date AND a.market_scope = 'KOSPI' AND b.market_scope = 'KOSDAQ'"
CTES["k1_level"] = """SELECT 'ALL' AS market_scope, date, product(1 + r) OVER (ORDER BY date) * 100 AS close, value, m_ret_pos_1m, m_above_sma20, m_above_sma60, m_above_sma120, m_new_high_ratio_20d, m_new_low_ratio_20d
FROM (SELECT *, coalesce(ca / nullif(lag(ca) OVER (ORDER BY date), 0) - 1, 0) * 0.6::DOUBLE + coalesce(cb / nullif(lag(cb) OVER (ORDER BY date), 0) - 1, 0) * 0.4::DOUBLE AS r FROM k1_pair)"""
CTES["k1_all"] = proxy_sql("k1_level", "market_scope")
K1_COLS = ["ret_1m", "ret_3m", "vol_20d", "mdd_3m", "trading_value_expansion_ratio"]
CTES["k1_every"] = f"""SELECT market_scope, date, {', '.join(K1_COLS + C.FLAGS)} FROM k1_members UNION ALL
SELECT market_scope, date, {', '.join(K1_COLS)}, {', '.join(f'm_{f}' for f in C.FLAGS)} FROM k1_all"""


def stress_sql(v: str, d: str) -> str:
    return f"CASE WHEN {v} IS NOT NULL AND {d} IS NOT NULL THEN " + r(sql_clip(
        f"(greatest(0::DOUBLE, ({v} - 0.12::DOUBLE) / 0.18::DOUBLE) + abs(least({d}, 0::DOUBLE)) / 0.15::DOUBLE) * 1.5::DOUBLE", 0, 3), 4) + " END"


CTES["k2_risk"] = f"""
SELECT *, {stress_sql('vol_20d', 'mdd_3m')} AS market_stress_score, {r(sql_clip(sql_mean('gold_proxy_ret_1m', 'bond_proxy_ret_1m', 'inverse_etf_ret_1m') + ' * 30'), 4)} AS defensive_asset_strength_score,
  CASE WHEN mdd_3m IS NOT NULL THEN {r(sql_clip('abs(least(mdd_3m, 0::DOUBLE)) / 0.15::DOUBLE * 3', 0, 3), 4)} END AS drawdown_pressure_score,
  CASE WHEN vol_20d IS NULL THEN NULL WHEN vol_20d < 0.12 THEN 'low' WHEN vol_20d < 0.22 THEN 'normal' WHEN vol_20d < 0.35 THEN 'high' ELSE 'stress' END AS volatility_regime_label
FROM (SELECT a.date AS asof_date, a.vol_20d, a.mdd_3m, w.* EXCLUDE (date) FROM k1_all a LEFT JOIN (
  SELECT date, max(ret) FILTER (ticker = 'USDKRW') AS usdkrw_ret_1m, max(ret) FILTER (ticker = 'GOLD') AS gold_proxy_ret_1m, max(ret) FILTER (ticker = 'BOND') AS bond_proxy_ret_1m,
    max(ret) FILTER (ticker = 'INVERSE') AS inverse_etf_ret_1m FROM (SELECT ticker, date, close / nullif(lag(close, 20) OVER (PARTITION BY ticker ORDER BY date), 0) - 1 AS ret FROM market_prices) GROUP BY 1) w ON w.date = a.date
  WHERE a.date BETWEEN DATE '{START}' AND DATE '{END}')"""
CTES["k1_scored"] = f"""
SELECT *, {r(sql_mean('trend_score', 'breadth_score', '-stress', 'defensive_flow_score'), 4)} AS market_state_score,
  {r(sql_clip('(trend_score + breadth_score) / 2.0::DOUBLE - stress', 0, 3), 4)} AS risk_on_score, {r(sql_clip('stress - (trend_score + breadth_score) / 4.0::DOUBLE', 0, 3), 4)} AS risk_off_score
FROM (SELECT e.*, e.date AS asof_date, k.* EXCLUDE (date), d.defensive_asset_strength_score AS defensive_flow_score, {r(sql_clip('e.ret_1m * 18 + e.ret_3m * 8'), 4)} AS trend_score,
  {r(sql_clip('(' + sql_mean('e.above_sma20', 'e.above_sma60', 'e.above_sma120', 'e.ret_pos_1m') + ' - 0.5) * 6'), 4)} AS breadth_score, {stress_sql('e.vol_20d', 'e.mdd_3m')} AS stress
  FROM k1_every e LEFT JOIN (SELECT date, max(ret_1m) FILTER (market_scope = 'KOSPI') AS kospi_ret_1m, max(ret_1m) FILTER (market_scope = 'KOSDAQ') AS kosdaq_ret_1m,
    max(ret_3m) FILTER (market_scope = 'KOSPI') AS kospi_ret_3m, max(ret_3m) FILTER (market_scope = 'KOSDAQ') AS kosdaq_ret_3m FROM k1_members GROUP BY 1) k ON k.date = e.date
  LEFT JOIN k2_risk d ON d.asof_date = e.date WHERE e.date BETWEEN DATE '{START}' AND DATE '{END}')"""
STATE = """CASE WHEN {0} IS NULL THEN NULL WHEN {0} >= 1.5 THEN 'strong_up' WHEN {0} >= 0.4 THEN 'up' WHEN {0} <= -1.5 THEN 'strong_down' WHEN {0} <= -0.4 THEN 'down' ELSE 'neutral' END"""
K1_SCORES = ["market_state_score", "trend_score", "breadth_score", "defensive_flow_score", "risk_on_score", "risk_off_score"]
K1_RATIOS = ["kospi_ret_1m", "kospi_ret_3m", "kosdaq_ret_1m", "kosdaq_ret_3m"]


def k1_frames(t):
    return C.market_context(t.market_prices, day(START), day(END))


@query("k1_market_context", f"""
SELECT asof_date, market_scope, {STATE.format('market_state_score')} AS market_state_label, {', '.join(r(c, 4) + f' AS {c}' for c in K1_SCORES)}, {r('-stress', 4)} AS risk_score,
  {', '.join(r(c) + f' AS {c}' for c in K1_RATIOS)}, {r('vol_20d')} AS market_vol_20d, {r('mdd_3m')} AS market_mdd_3m, above_sma20 AS market_breadth_above_sma20, new_high_ratio_20d,
  {r('trading_value_expansion_ratio')} AS trading_value_expansion_ratio FROM k1_scored""")
def k1(t):
    market, _ = k1_frames(t)
    return market.select("asof_date", "market_scope", "market_state_label", *K1_SCORES, "risk_score", *[rd(c).alias(c) for c in K1_RATIOS],
                         rd("market_vol_20d").alias("market_vol_20d"), rd("market_mdd_3m").alias("market_mdd_3m"), "market_breadth_above_sma20", "new_high_ratio_20d",
                         rd("trading_value_expansion_ratio").alias("trading_value_expansion_ratio"))


K2_OUT = ["usdkrw_ret_1m", "gold_proxy_ret_1m", "bond_proxy_ret_1m", "inverse_etf_ret_1m"]


@query("k2_risk_context", f"""
SELECT asof_date, {', '.join(r(c) + f' AS {c}' for c in K2_OUT)}, defensive_asset_strength_score, market_stress_score, drawdown_pressure_score, volatility_regime_label,
  (coalesce(market_stress_score >= 2.2, false) OR coalesce(mdd_3m <= -0.15, false))::INT AS crash_warning_flag FROM k2_risk""")
def k2(t):
    _, risk = k1_frames(t)
    return risk.select("asof_date", *[rd(c).alias(c) for c in K2_OUT], "defensive_asset_strength_score", "market_stress_score", "drawdown_pressure_score",
                       "volatility_regime_label", "crash_warning_flag")


# -- K3 ------------------------------------------------------------------------------------

TB = "PARTITION BY theme_bucket ORDER BY date"
tret = lambda n: f"close / nullif(lag(close, {n}) OVER ({TB}), 0) - 1"
CTES["k3_raw"] = f"""SELECT *, coalesce(theme_ret_1m, 0) * 0.65::DOUBLE + coalesce(theme_ret_3m, 0) * 0.35::DOUBLE AS raw FROM (
  SELECT *, CASE WHEN ok THEN row_number() OVER (PARTITION BY theme_bucket, ok, island ORDER BY date) ELSE 0 END AS theme_persistence_days FROM (
    SELECT *, sum((NOT ok)::INT) OVER ({TB}) AS island FROM (SELECT *, {tret(5)} AS theme_ret_1w, {tret(20)} AS theme_ret_1m, {tret(60)} AS theme_ret_3m, coalesce({tret(20)} > 0, false) AS ok,
      coalesce((close > {sql_roll('avg', 'close', 60, 20, TB)})::INT, 0)::DOUBLE AS theme_above_sma60_ratio FROM theme_prices))) WHERE date BETWEEN DATE '{START}' AND DATE '{END}'"""
CTES["k3_theme"] = f"""SELECT *, m - lag(m, 20) OVER ({TB}) AS rotation, row_number() OVER (PARTITION BY date ORDER BY m DESC, theme_bucket) AS rk FROM (
  SELECT *, {sql_clip('CASE WHEN count(raw) OVER d > 1 AND max(raw) OVER d > min(raw) OVER d THEN (raw - avg(raw) OVER d) / stddev_pop(raw) OVER d ELSE 0 END')} AS m, value / sum(value) OVER d AS conc
  FROM k3_raw WINDOW d AS (PARTITION BY date))"""


@query("k3_theme_context", f"""
SELECT theme_bucket, date AS asof_date, {r('theme_ret_1w')} AS theme_ret_1w, {r('theme_ret_1m')} AS theme_ret_1m, {r('theme_ret_3m')} AS theme_ret_3m, {r('m', 5)} AS theme_momentum_score, {r('rotation', 5)} AS theme_rotation_score,
  theme_persistence_days, {r('conc')} AS theme_concentration_score, rk AS leading_theme_rank, theme_above_sma60_ratio FROM k3_theme""")
def k3(t):
    out = C.theme_context(t.theme_prices, day(START), day(END))
    return out.select("theme_bucket", "asof_date", *[rd(c).alias(c) for c in ("theme_ret_1w", "theme_ret_1m", "theme_ret_3m", "theme_concentration_score")],
                      rd("theme_momentum_score", 5).alias("theme_momentum_score"), rd("theme_rotation_score", 5).alias("theme_rotation_score"), "theme_persistence_days",
                      "leading_theme_rank", "theme_above_sma60_ratio")


@query("k3_crosswalk_themes", f"""
SELECT r_name AS quant_theme_bucket, theme_bucket, date AS asof_date, {r('m', 5)} AS theme_momentum_score FROM k3_theme JOIN region ON 'theme_' || (r_regionkey % 3 + 1) = theme_bucket WHERE r_regionkey <> 4""")
def k3_walk(t):
    walk = t.table("region").select(F.col("r_name").alias("quant_theme_bucket"), F.concat(F.lit("theme_"), (F.col("r_regionkey") % 3 + 1).cast("string")).alias("theme_bucket"),
                                    F.col("r_name").alias("theme_name"), (F.col("r_regionkey") != 4).cast("int").alias("is_active"))
    out = C.crosswalk_themes(C.theme_context(t.theme_prices, day(START), day(END)), walk)
    return out.select("quant_theme_bucket", "theme_bucket", "asof_date", rd("theme_momentum_score", 5).alias("theme_momentum_score"))


# -- K4 ------------------------------------------------------------------------------------

CODES = {"foreign": "1001", "institution": "2001", "retail": "1028"}
FDAYS = ("2024-01-03", "2024-01-28")
CTES["k4_close"] = "SELECT session_date AS asof_date, " + ", ".join(
    f"arg_max(metric_value, asof_ts) FILTER (signal_code = '{c}') - 50 AS {k}" for k, c in CODES.items()) + f" FROM snapshots WHERE session_date BETWEEN DATE '{FDAYS[0]}' AND DATE '{FDAYS[1]}' GROUP BY 1"
CTES["k4_flow"] = f"""
SELECT s.asof_date, g.scope AS market_scope, a.f, a.i, a.re, a.sm, a.co, coalesce((a.asof_date IS NOT NULL)::INT, 0) AS flow_context_available, CASE WHEN a.asof_date IS NOT NULL THEN 'intraday_aggregate_recent_only' ELSE 'not_available' END AS source_quality
FROM (SELECT DISTINCT ts::DATE AS asof_date FROM events) s CROSS JOIN (VALUES ('ALL'), ('KOSPI'), ('KOSDAQ')) g(scope) LEFT JOIN (
  SELECT asof_date, "foreign" / den AS f, institution / den AS i, retail / den AS re, ("foreign" + institution - coalesce(retail, 0)) / den AS sm, greatest(abs("foreign") / den, abs(institution) / den, abs(retail) / den) AS co FROM (
    SELECT *, nullif(coalesce(abs("foreign"), 0) + coalesce(abs(institution), 0) + coalesce(abs(retail), 0), 0) AS den FROM k4_close)) a ON a.asof_date = s.asof_date AND g.scope = 'ALL'
WHERE s.asof_date BETWEEN DATE '{FDAYS[0]}' AND DATE '{FDAYS[1]}'""".replace('"foreign"', "foreign_")
CTES["k4_close"] = CTES["k4_close"].replace(" AS foreign", " AS foreign_")


def k4_frame(t):
    days = t.table("events").select(F.col("ts").cast("date").alias("asof_date")).distinct()
    signals = t.snapshots.withColumn("metric_value", F.col("metric_value") - 50)
    return C.flow_context(signals, days, MARKET_SCOPES, CODES, day(FDAYS[0]), day(FDAYS[1]))


@query("k4_flow_context", f"""
SELECT asof_date, market_scope, {r('f')} AS foreign_net_buy_ratio, {r('i')} AS institution_net_buy_ratio, {r('re')} AS retail_net_buy_ratio, {r('sm')} AS smart_money_score, {r('co')} AS flow_concentration_score,
  flow_context_available, source_quality FROM k4_flow""")
def k4(t):
    return k4_frame(t).select("asof_date", "market_scope", *[rd(c).alias(c) for c in ("foreign_net_buy_ratio", "institution_net_buy_ratio", "retail_net_buy_ratio", "smart_money_score",
                                                                                      "flow_concentration_score")], "flow_context_available", "source_quality")


# -- K5 ------------------------------------------------------------------------------------

SP = "PARTITION BY series_id ORDER BY asof_date"
CTES["k5_filled"] = f"""SELECT series_id, asof_date, last_value(value IGNORE NULLS) OVER ({SP}) AS v FROM (SELECT DISTINCT asof_date FROM daily_obs) CROSS JOIN (SELECT unnest({DAILY_SERIES}) AS series_id)
 LEFT JOIN daily_obs USING (series_id, asof_date)"""


def z252(x: str) -> str:
    return sql_clip(f"(({x} - {sql_roll('avg', x, 252, 30, SP)}) / nullif({sql_roll('stddev_pop', x, 252, 30, SP)}, 0))")


CTES["k5_z"] = f"SELECT *, {z252('v')} AS z, {z252('c')} AS dz FROM (SELECT *, v - lag(v, 20) OVER ({SP}) AS c FROM k5_filled)"
CTES["k5_monthly"] = f"""SELECT s.asof_date, m.series_id, m.value, m.yoy, m.c3 FROM (SELECT * FROM (SELECT DISTINCT asof_date FROM daily_obs) CROSS JOIN (SELECT DISTINCT series_id FROM monthly_obs)) s
ASOF JOIN (SELECT *, asof_date + 21 AS usable, value / nullif(lag(value, 12) OVER ({SP}), 0) - 1 AS yoy, value - lag(value, 3) OVER ({SP}) AS c3 FROM monthly_obs) m ON s.series_id = m.series_id AND s.asof_date >= m.usable"""
fz = lambda s: f"max(z) FILTER (series_id = '{s}')"
fdz = lambda s: f"max(dz) FILTER (series_id = '{s}')"
fv = lambda s: f"max(v) FILTER (series_id = '{s}')"
CTES["k5_wide"] = f"""SELECT d.*, m.* EXCLUDE (asof_date) FROM (SELECT asof_date, {sql_mean(fz('DGS10'), fz('DGS2'), fz('DFII10'), fdz('DGS10'))} AS rate_p, {sql_mean(fz('DTWEXBGS'), fz('DEXKOUS'), fdz('DTWEXBGS'))} AS usd_p,
  {sql_mean(fz('BAMLH0A0HYM2'), fz('BAMLC0A0CM'), fdz('BAMLH0A0HYM2'))} AS credit_p, {sql_mean(fz('VIXCLS'), fdz('VIXCLS'), fz('GVZCLS'))} AS risk_p, {fz('T10YIE')} AS z_infl, {sql_mean(fz('DCOILWTICO'), fdz('DCOILWTICO'))} AS comm_p,
  {fv('DGS10')} - {fv('DGS2')} AS yield_curve_10y_2y, {fv('DGS10')} - {fv('DGS3MO')} AS yield_curve_10y_3m, {fv('VIXCLS')} AS vix_level FROM k5_z GROUP BY 1) d
LEFT JOIN (SELECT asof_date, max(yoy) FILTER (series_id = 'CPIAUCSL') AS cpi_yoy, max(yoy) FILTER (series_id = 'CPILFESL') AS core_cpi_yoy, max(yoy) FILTER (series_id = 'PPIACO') AS ppi_yoy,
  max(value) FILTER (series_id = 'UNRATE') AS unrate, max(c3) FILTER (series_id = 'PAYEMS') AS payrolls_3m_change FROM k5_monthly GROUP BY 1) m ON m.asof_date = d.asof_date"""
CTES["k5_macro"] = f"""SELECT *, {sql_mean('rate_p', 'usd_p', 'credit_p', 'risk_p', 'infl_p', 'comm_p')} AS pressure FROM (
  SELECT *, {sql_mean('z_infl', 'cpi_yoy', 'core_cpi_yoy', 'ppi_yoy')} AS infl_p FROM k5_wide)"""
K5_MAP = {"rate_pressure_score": "rate_p", "usd_pressure_score": "usd_p", "credit_stress_score": "credit_p", "risk_aversion_score": "risk_p", "inflation_pressure_score": "infl_p",
          "commodity_pressure_score": "comm_p", "global_risk_on_score": "-pressure", "external_macro_pressure_score": "pressure"}
K5_RAW = ["yield_curve_10y_2y", "yield_curve_10y_3m", "vix_level", "cpi_yoy", "core_cpi_yoy", "ppi_yoy", "unrate", "payrolls_3m_change"]


@query("k5_macro_context", f"SELECT asof_date, {', '.join(r(sql_clip(v), 5) + f' AS {k}' for k, v in K5_MAP.items())}, {', '.join(r(c, 5) + f' AS {c}' for c in K5_RAW)} FROM k5_macro")
def k5(t):
    return M.macro_context(t.daily_obs, t.monthly_obs).select("asof_date", *[rd(c, 5).alias(c) for c in [*K5_MAP, *K5_RAW]])


# -- K6 ------------------------------------------------------------------------------------

AP = "PARTITION BY asset_code ORDER BY asof_date"
CTES["k6_feat"] = f"""SELECT asset_code, asof_date, price / nullif(lag(price, 20) OVER ({AP}), 0) - 1 AS r1, price / nullif(lag(price, 60) OVER ({AP}), 0) - 1 AS r3,
  coalesce((price > {sql_roll('avg', 'price', 60, 20, AP)})::INT, 0)::DOUBLE AS up FROM (SELECT *, coalesce(adj_close, close) AS price FROM asset_prices)"""
SECTORS = CYCLICAL_SECTORS + DEFENSIVE_SECTORS
FAR = sorted({a for _, _, far, _ in M.ASSET_SCORES for a in far})
CTES["k6_wide"] = "SELECT asof_date, " + ", ".join(
    [f"max(r1) FILTER (asset_code = '{a}') AS r1_{a}" for a in ASSET_CODES] + [f"max(r3) FILTER (asset_code = '{a}') AS r3_{a}" for a in FAR]
    + [f"max(up) FILTER (asset_code = '{a}') AS up_{a}" for a in SECTORS]) + " FROM k6_feat GROUP BY 1"
CTES["k6_parts"] = f"""SELECT *, {sql_mean(*[f'r1_{a}' for a in CYCLICAL_SECTORS])} - {sql_mean(*[f'r1_{a}' for a in DEFENSIVE_SECTORS])} AS cyc_def, {sql_mean(*[f'r1_{a}' for a in DEFENSIVE_SECTORS])} AS dfn,
  {sql_mean(*[f'(r1_{a} > 0)::INT' for a in SECTORS])} AS pos, {sql_mean(*[f'up_{a}' for a in SECTORS])} AS ups, r1_HYG - r1_LQD AS spread FROM k6_wide"""


def scale_sql(cols: list[str], scale: float) -> str:
    return r(sql_clip(f"{sql_mean(*cols)} * {d_(scale)}"), 4)


K6_SQL = {name: scale_sql([f"r1_{a}" for a in one] + [f"r3_{a}" for a in far], s) for name, one, far, s in M.ASSET_SCORES}
K6_SQL |= {"us_sector_risk_on_score": scale_sql(["cyc_def"], 20), "us_defensive_sector_score": scale_sql(["dfn"], 15), "credit_proxy_score": scale_sql(["spread"], 25),
           "global_breadth_proxy_score": r(sql_clip("((pos - 0.5::DOUBLE) + (ups - 0.5::DOUBLE)) * 3"), 4), "em_vs_dm_score": r(sql_clip("(r1_EEM - r1_EFA) * 20"), 4),
           "low_vol_defensive_pressure_score": r(sql_clip("(r1_USMV - r1_SPY) * 20"), 4)}
CTES["k6_scores"] = "SELECT asof_date, cyc_def, pos, ups, " + ", ".join(f"{v} AS {k}" for k, v in K6_SQL.items()) + " FROM k6_parts"
CTES["k6_assets"] = f"SELECT *, {r(sql_clip(sql_mean(*M.RISK_ON_PARTS, *[f'-{c}' for c in M.RISK_OFF_PARTS])), 4)} AS external_asset_risk_on_score FROM k6_scores"


@query("k6_asset_context", f"SELECT asof_date, {', '.join(K6_SQL)}, external_asset_risk_on_score, {r('cyc_def')} AS sector_cyclical_vs_defensive_1m, {r('pos')} AS sector_positive_ratio_1m FROM k6_assets")
def k6(t):
    return M.asset_context(t.asset_prices).select("asof_date", *K6_SQL, "external_asset_risk_on_score", rd("sector_cyclical_vs_defensive_1m").alias("sector_cyclical_vs_defensive_1m"),
                                                  rd("sector_positive_ratio_1m").alias("sector_positive_ratio_1m"))


# -- K7, K8 ----------------------------------------------------------------------------------

NEXT = "(asof_date + CASE isodow(asof_date) WHEN 5 THEN 3 WHEN 6 THEN 2 ELSE 1 END::INT)::DATE"
CTES["k7_macro"] = f"""SELECT * FROM (SELECT * EXCLUDE (asof_date), asof_date AS source_date, {NEXT} AS asof_date FROM k5_macro) WHERE asof_date BETWEEN DATE '{START}' AND DATE '{END}'
QUALIFY row_number() OVER (PARTITION BY asof_date ORDER BY source_date DESC) = 1"""
CTES["k7_assets"] = CTES["k7_macro"].replace("k5_macro", "k6_assets")


def k7_macro(t):
    return M.usable_next_day(M.macro_context(t.daily_obs, t.monthly_obs), day(START), day(END))


def k7_assets(t):
    return M.usable_next_day(M.asset_context(t.asset_prices), day(START), day(END))


@query("k7_shifted_macro", f"SELECT asof_date, source_date, {r(sql_clip('pressure'), 5)} AS external_macro_pressure_score FROM k7_macro")
def k7(t):
    return k7_macro(t).select("asof_date", "source_date", rd("external_macro_pressure_score", 5).alias("external_macro_pressure_score"))


@query("k7_shifted_assets", "SELECT asof_date, source_date, external_asset_risk_on_score FROM k7_assets")
def k7b(t):
    return k7_assets(t).select("asof_date", "source_date", "external_asset_risk_on_score")


CTES["k8_base"] = f"""
SELECT m.asof_date, m.market_scope, m.market_state_score AS state, m.trend_score AS trend, m.breadth_score AS breadth, m.risk_on_score AS risk_on, m.risk_off_score AS risk_off, {sql_clip('-g.pressure')} AS global_risk_on,
  a.external_asset_risk_on_score AS external_asset_risk_on, {sql_clip('g.pressure')} AS external_pressure, f.sm AS smart_money, k.market_stress_score AS stress_score, {sql_clip('g.risk_p')} AS aversion, k.drawdown_pressure_score AS ddp
FROM k1_scored m LEFT JOIN k2_risk k ON k.asof_date = m.asof_date LEFT JOIN k7_macro g ON g.asof_date = m.asof_date LEFT JOIN k7_assets a ON a.asof_date = m.asof_date LEFT JOIN k4_flow f ON f.asof_date = m.asof_date AND f.market_scope = m.market_scope"""


def weight_sql(weights: list[float]) -> str:
    num = " + ".join(f"coalesce({t} * {d_(w)}, 0)" for t, w in zip(FORECAST_TERMS, weights))
    den = " + ".join(f"(CASE WHEN {t} IS NOT NULL THEN {d_(abs(w))} ELSE 0 END)" for t, w in zip(FORECAST_TERMS, weights))
    return r(sql_clip(f"({num}) / nullif({den}, 0)"), 4)


CTES["k8_long"] = " UNION ALL ".join(f"SELECT *, '{h}' AS forecast_horizon, {weight_sql(w)} AS score FROM k8_base" for h, w in FORECAST_WEIGHTS.items())
CTES["k8_forecast"] = f"""
SELECT *, {r(sql_clip(f"avail / 9.0::DOUBLE * 0.62::DOUBLE + least(abs(coalesce(score, 0)) / 2.0::DOUBLE, 1) * 0.25::DOUBLE + (1 - CASE WHEN vol IS NULL THEN 0.35::DOUBLE ELSE least(vol / 3.0::DOUBLE, 1) END) * 0.13::DOUBLE", 0, 1), 4)} AS confidence
FROM (SELECT *, {r(sql_clip(sql_mean('stress_score', 'aversion'), 0, 3), 4)} AS vol, {r(sql_clip(sql_mean('trend', 'breadth')), 4)} AS upside, {' + '.join(f'({t} IS NOT NULL)::INT' for t in FORECAST_TERMS)} AS avail,
  {sql_mean('risk_off', 'external_pressure')} AS press FROM k8_long)"""
REGIME = """CASE WHEN press IS NULL THEN NULL WHEN press >= 1.6 THEN 'risk_off_high' WHEN press >= 0.65 THEN 'risk_off_moderate' WHEN risk_on >= 1.2 AND press <= 0.2 THEN 'risk_on_moderate'
WHEN risk_on >= 2.0 AND press <= -0.2 THEN 'risk_on_high' ELSE 'neutral' END"""


def k8_frame(t):
    market, risk = k1_frames(t)
    return C.forecast_context(market, risk, k4_frame(t), k7_macro(t), k7_assets(t))


@query("k8_market_forecast", f"""
SELECT asof_date, market_scope, forecast_horizon, {r('score', 4)} AS market_forecast_score, {FIVE.format('score', 1.1, 0.35)} AS market_forecast_label, {REGIME} AS risk_regime_label, vol AS expected_volatility_score,
  upside AS upside_participation_score, confidence AS confidence_score FROM k8_forecast""")
def k8(t):
    return k8_frame(t).select("asof_date", "market_scope", "forecast_horizon", "market_forecast_score", "market_forecast_label", "risk_regime_label", "expected_volatility_score",
                              "upside_participation_score", "confidence_score")


# -- K10, K11 ----------------------------------------------------------------------------------

rel_case = "CASE series_id " + " ".join(f"WHEN '{s}' THEN '{f}'" for s, f in MONTHLY_EVENTS.items()) + " END"
shock_rows = " UNION ALL ".join(
    f"SELECT series_id, asof_date AS src, '{f}' AS flag, asof_date + 1 AS usable FROM k10_moves WHERE series_id = '{s}' AND abs({'pct' if m == 'pct' else 'diff'}) >= {d_(x)}"
    for s, (f, m, x) in DAILY_SHOCKS.items())
CTES["k10_moves"] = f"SELECT *, value / nullif(lag(value) OVER ({SP}), 0) - 1 AS pct, value - lag(value) OVER ({SP}) AS diff FROM daily_obs"
CTES["k10_events"] = f"""SELECT e.series_id, e.flag, (SELECT min(s.asof_date) FROM spine s WHERE s.asof_date >= e.usable) AS day FROM (
  SELECT series_id, asof_date AS src, {rel_case} AS flag, asof_date + 21 AS usable FROM monthly_obs UNION ALL {shock_rows}) e"""
ALL_FLAGS = M.SCHEDULED_FLAGS + M.SHOCK_FLAGS
CTES["k10_days"] = f"""SELECT s.asof_date, {', '.join(f"count(*) FILTER (e.flag = '{f}') AS {f}" for f in ALL_FLAGS)}, count(DISTINCT e.series_id) AS macro_event_source_count,
  {' + '.join(f"count(*) FILTER (e.flag = '{f}')" for f in M.SCHEDULED_FLAGS)} AS sched, {' + '.join(f"count(*) FILTER (e.flag = '{f}')" for f in M.SHOCK_FLAGS)} AS shock, row_number() OVER (ORDER BY s.asof_date) AS rn
FROM spine s LEFT JOIN k10_events e ON e.day = s.asof_date GROUP BY s.asof_date"""


@query("k10_event_calendar", f"""
SELECT *, {r('greatest(0, least(1, 0.15::DOUBLE * scheduled_macro_event_count + 0.35::DOUBLE * macro_shock_event_count + 0.10::DOUBLE * macro_event_risk_window_flag))')} AS macro_event_pressure_score FROM (
  SELECT asof_date, {', '.join(ALL_FLAGS)}, macro_event_source_count, sched AS scheduled_macro_event_count, shock AS macro_shock_event_count, (sched + shock > 0)::INT AS major_macro_event_flag,
    coalesce(lead((sched > 0)::INT) OVER w, 0) AS pre_macro_event_1d_flag, coalesce(lag((sched > 0)::INT) OVER w, 0) AS post_macro_event_1d_flag,
    greatest((sched > 0)::INT, coalesce(lead((sched > 0)::INT) OVER w, 0), coalesce(lag((sched > 0)::INT) OVER w, 0)) AS macro_event_risk_window_flag,
    rn - last_value(CASE WHEN sched > 0 THEN rn END IGNORE NULLS) OVER w AS days_since_scheduled_macro_event,
    first_value(CASE WHEN sched > 0 THEN rn END IGNORE NULLS) OVER (ORDER BY asof_date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) - rn AS days_to_next_scheduled_macro_event,
    CAST(sum(sched + shock) OVER (ORDER BY asof_date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS BIGINT) AS macro_event_density_5d FROM k10_days WINDOW w AS (ORDER BY asof_date))""")
def k10(t):
    out = M.event_calendar(t.daily_obs, t.monthly_obs, t.spine)
    return out.drop("macro_event_count").withColumn("macro_event_pressure_score", rd("macro_event_pressure_score"))


spec = lambda i: "CASE series_id " + " ".join(f"WHEN '{s}' THEN " + (f"'{v[i]}'" if i < 2 else d_(v[i])) for s, v in SURPRISE_SPECS.items()) + " END"
CTES["k11_events"] = f"""SELECT *, z * {spec(2)} AS roz, (SELECT min(s.asof_date) FROM spine s WHERE s.asof_date >= e.asof_date + 21) AS day, {spec(0)} AS grp FROM (
  SELECT *, CASE WHEN n >= 12 THEN m END AS expected, CASE WHEN n >= 12 THEN (metric - m) / nullif(sd, 0) END AS z FROM (SELECT *, count(metric) OVER w AS n, avg(metric) OVER w AS m, stddev_pop(metric) OVER w AS sd FROM (
    SELECT *, CASE WHEN {spec(1)} = 'yoy' THEN value / nullif(lag(value, 12) OVER ({SP}), 0) - 1 ELSE value - lag(value) OVER ({SP}) END AS metric FROM monthly_obs)
    WINDOW w AS (PARTITION BY series_id ORDER BY asof_date ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING))) e"""


@query("k11_surprise_events", f"""
SELECT series_id AS source_series_id, asof_date AS source_observation_date, day AS asof_date, {r('metric')} AS actual_metric_value, {r('expected')} AS expected_proxy_value, {r('z', 5)} AS proxy_surprise_zscore,
  CASE WHEN z IS NULL THEN NULL WHEN z > 0 THEN 'upside' WHEN z < 0 THEN 'downside' ELSE 'inline' END AS surprise_direction_label,
  CASE WHEN roz IS NULL THEN NULL WHEN roz >= 1 THEN 'risk_off_surprise' WHEN roz <= -1 THEN 'risk_on_surprise' ELSE 'mixed_or_inline' END AS risk_bias_label FROM k11_events WHERE day IS NOT NULL""")
def k11(t):
    return M.surprise_events(t.monthly_obs, t.spine).select("source_series_id", "source_observation_date", "asof_date", rd("actual_metric_value").alias("actual_metric_value"),
                                                            rd("expected_proxy_value").alias("expected_proxy_value"), rd("proxy_surprise_zscore", 5).alias("proxy_surprise_zscore"),
                                                            "surprise_direction_label", "risk_bias_label")


SIGNED = sql_clip("roz / 3", -1, 1)


@query("k11_surprise_context", f"""
SELECT asof_date, n AS macro_surprise_event_count, {r('mx', 5)} AS macro_surprise_abs_zscore_max, {r('sc', 5)} AS macro_surprise_risk_off_score, {', '.join(r(f'g_{g}', 5) + f' AS {g}_surprise_risk_off_score' for g in SURPRISE_GROUPS)},
  {r(sql_clip('sc', 0, 1), 5)} AS macro_surprise_pressure_score, CAST(sum(n) OVER (ORDER BY asof_date ROWS BETWEEN 62 PRECEDING AND CURRENT ROW) AS BIGINT) AS macro_surprise_event_density_63d FROM (
  SELECT s.asof_date, count(e.series_id) AS n, max(abs(z)) AS mx, avg({SIGNED}) AS sc, {', '.join(f"avg({SIGNED}) FILTER (grp = '{g}') AS g_{g}" for g in SURPRISE_GROUPS)}
  FROM spine s LEFT JOIN k11_events e ON e.day = s.asof_date GROUP BY 1)""")
def k11b(t):
    out = M.surprise_context(M.surprise_events(t.monthly_obs, t.spine), t.spine)
    return out.select("asof_date", "macro_surprise_event_count", *[rd(c, 5).alias(c) for c in ("macro_surprise_abs_zscore_max", "macro_surprise_risk_off_score", *[f"{g}_surprise_risk_off_score" for g in SURPRISE_GROUPS],
                                                                                             "macro_surprise_pressure_score")], "macro_surprise_event_density_63d")


# -- K9, K29 -----------------------------------------------------------------------------------

from tidemark.plans import flow as FL  # noqa: E402
from tidemark.plans import model_input as I  # noqa: E402
from tidemark.plans import targets as T  # noqa: E402

INTRA = {"program": "USDKRW", "foreign": "1001", "institution": "2001", "retail": "1028"}
CTES["k9_long"] = "SELECT date AS asof_date, s.scope AS market_scope, ticker, investor, net_value, net_volume, (net_value > 0)::INT AS pos FROM flows, LATERAL (SELECT unnest([market, 'ALL']) AS scope) s WHERE day(date) % 6 <> 0"
inv = lambda x, k: f"{x} FILTER (investor = '{k}')"
CTES["k9_daily"] = "SELECT asof_date, market_scope, " + ", ".join(
    f"{inv('sum(net_value)', k)} AS v_{k}, {inv('sum(pos)', k)}::DOUBLE / nullif({inv('count(DISTINCT ticker)', k)}, 0) AS b_{k}" for k in FL.INVESTORS) + " FROM k9_long GROUP BY 1, 2"
CTES["k9_ratio"] = "SELECT *, v_foreign / den AS r_foreign, (v_foreign + v_institution - coalesce(v_retail, 0)) / den AS smart, greatest(abs(v_foreign) / den, abs(v_institution) / den, abs(v_retail) / den) AS conc FROM (SELECT *, nullif(coalesce(abs(v_foreign), 0) + coalesce(abs(v_institution), 0) + coalesce(abs(v_retail), 0), 0) AS den FROM k9_daily)"
W5 = "(PARTITION BY market_scope ORDER BY asof_date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"
CTES["k9_investor"] = f"SELECT *, sum(v_foreign) OVER {W5} AS f5, sum(v_foreign) OVER {W5} / nullif(sum(den) OVER {W5}, 0) AS fr5, sum((coalesce(v_foreign, 0) > 0)::INT) OVER {W5} AS fd5, avg(smart) OVER {W5} AS sm5 FROM k9_ratio"
CTES["k9_deriv"] = "SELECT session_date AS asof_date, " + ", ".join(
    f"arg_max(metric_value - 50, asof_ts) FILTER (signal_code = '{c}') AS i_{k}" for k, c in INTRA.items()) + ", arg_max(change_pct, asof_ts) FILTER (signal_code = 'FUT') AS fut FROM snapshots GROUP BY 1"
CTES["k9_mart"] = f"""SELECT *, {sql_clip(sql_mean('smart2 * 1.5::DOUBLE', 'fut_score', 'prog_score'))} AS score FROM (
  SELECT s.asof_date, g.scope AS market_scope, i.f5, i.fr5, i.fd5, i.sm5, i.b_foreign, {sql_clip('d.fut * 50')} AS fut_score, {sql_clip('d.i_program * 100000000 / 1000000000000.0::DOUBLE')} AS prog_score,
    CASE WHEN i.den IS NULL AND g.scope = 'ALL' THEN (coalesce(d.i_foreign, 0) + coalesce(d.i_institution, 0) - coalesce(d.i_retail, 0)) / nullif(coalesce(abs(d.i_foreign), 0) + coalesce(abs(d.i_institution), 0) + coalesce(abs(d.i_retail), 0), 0) ELSE i.smart END AS smart2,
    CASE WHEN i.den IS NULL AND g.scope = 'ALL' THEN d.i_foreign / nullif(coalesce(abs(d.i_foreign), 0) + coalesce(abs(d.i_institution), 0) + coalesce(abs(d.i_retail), 0), 0) ELSE i.r_foreign END AS fr
  FROM (SELECT DISTINCT ts::DATE AS asof_date FROM events) s CROSS JOIN (VALUES ('ALL'), ('KOSPI'), ('KOSDAQ')) g(scope)
  LEFT JOIN k9_investor i ON i.asof_date = s.asof_date AND i.market_scope = g.scope LEFT JOIN k9_deriv d ON d.asof_date = s.asof_date)"""
K9_MAP = {"foreign_net_buy_ratio": "fr", "smart_money_score": "smart2", "smart_money_score_5d": "sm5", "foreign_net_buy_ratio_5d": "fr5", "futures_direction_score": "fut_score",
          "program_pressure_score": "prog_score", "domestic_flow_derivatives_score": "score", "foreign_buying_breadth": "b_foreign"}


def k9_frame(t):
    days = t.table("events").select(F.col("ts").cast("date").alias("asof_date")).distinct()
    flows = t.flows.where(F.dayofmonth("date") % 6 != 0).withColumnRenamed("date", "asof_date").withColumn("source", F.lit("feed"))
    signals = t.snapshots.withColumn("metric_value", F.col("metric_value") - 50)
    return FL.flow_mart(days, flows, t.snapshots.where(F.col("signal_code") == "FUT"), signals, INTRA)


@query("k9_domestic_flow", f"SELECT asof_date, market_scope, {', '.join(r(v) + f' AS {k}' for k, v in K9_MAP.items())}, {r('f5', 2)} AS foreign_net_buy_value_5d_krw FROM k9_mart")
def k9(t):
    return k9_frame(t).select("asof_date", "market_scope", *[rd(c).alias(c) for c in K9_MAP], rd("foreign_net_buy_value_5d_krw", 2).alias("foreign_net_buy_value_5d_krw"))


@query("k29_investor_aggregate", f"""
SELECT date, market AS market_scope, investor, {r('sum(net_value)', 2)} AS net_value FROM flows GROUP BY 1, 2, 3 UNION ALL SELECT date, 'ALL', investor, {r('sum(net_value)', 2)} FROM flows GROUP BY 1, 3
UNION ALL SELECT DATE '2023-12-29', market, investor, {r('sum(net_value)', 2)} FROM flows WHERE date = DATE '2024-01-02' GROUP BY 2, 3""")
def k29(t):
    scoped = t.flows.withColumnRenamed("market", "market_scope")
    kept = scoped.where(F.col("date") == "2024-01-02").withColumn("date", F.lit("2023-12-29").cast("date"))
    stale = scoped.where(F.col("date") >= "2024-01-20").withColumn("net_value", F.lit(0.0))
    stored = kept.unionByName(stale).groupBy("date", "market_scope", "investor").agg(F.sum("net_value").alias("net_value"))
    return FL.recompute_aggregate(stored, scoped).withColumn("net_value", rd("net_value", 2))


# -- K12-K14 --------------------------------------------------------------------------------------

CTES["k12_close"] = "SELECT date AS asof_date, market_scope, close FROM k1_members UNION ALL SELECT date, 'ALL', close FROM k1_level"
KP = "PARTITION BY market_scope ORDER BY asof_date"
CTES["k12_target"] = " UNION ALL ".join(
    f"""SELECT asof_date, market_scope, '{h}' AS forecast_horizon, {T.DRAWDOWN_LIMITS[h]} AS lim, lead(close, {n}) OVER ({KP}) / close - 1 AS ret, lead(asof_date, {n}) OVER ({KP}) AS end_date,
  min(close) OVER ({KP} ROWS BETWEEN 1 FOLLOWING AND {n} FOLLOWING) / close - 1 AS lo, max(close) OVER ({KP} ROWS BETWEEN 1 FOLLOWING AND {n} FOLLOWING) / close - 1 AS hi FROM k12_close"""
    for h, n in T.FORECAST_HORIZONS.items())


def k12_closes(t):
    members = C.proxy_features(t.market_prices.where(F.col("ticker").isin("KOSPI", "KOSDAQ")).withColumnRenamed("ticker", "market_scope"), "market_scope")
    level = C.composite_scope(members, "market_scope", {"KOSPI": 0.6, "KOSDAQ": 0.4})
    pick = [F.col("date").alias("asof_date"), "market_scope", "close"]
    return members.select(*pick).unionByName(level.select(*pick))


@query("k12_forecast_targets", f"""
SELECT t.asof_date, t.market_scope, t.forecast_horizon, {r('t.ret')} AS target_forward_return, {r("CASE WHEN t.market_scope = 'ALL' THEN 0 ELSE t.ret - b.ret END")} AS target_excess_return_vs_all, {r('t.lo')} AS target_forward_max_drawdown,
  {r('t.hi')} AS target_forward_max_runup, CASE WHEN t.ret > 0 THEN 'up' WHEN t.ret IS NOT NULL THEN 'down_or_flat' END AS target_direction_label, (t.lo <= -t.lim)::INT AS target_downside_risk_flag,
  (t.hi >= t.lim)::INT AS target_large_upside_flag, (t.ret IS NOT NULL)::INT AS target_available_flag, t.end_date AS target_end_asof_date
FROM k12_target t LEFT JOIN (SELECT * FROM k12_target WHERE market_scope = 'ALL') b USING (asof_date, forecast_horizon)""")
def k12(t):
    out = T.forecast_targets(k12_closes(t))
    return out.select("asof_date", "market_scope", "forecast_horizon", *[rd(c).alias(c) for c in ("target_forward_return", "target_excess_return_vs_all", "target_forward_max_drawdown", "target_forward_max_runup")],
                      "target_direction_label", "target_downside_risk_flag", "target_large_upside_flag", "target_available_flag", "target_end_asof_date")


# Stand-in forecast of the validation queries: the trend of the level, and yesterday's score as the model.
SC = "PARTITION BY market_scope, forecast_horizon ORDER BY asof_date"
CTES["k13_forecast"] = f"SELECT *, lag(market_forecast_score) OVER ({SC}) / 10 AS predicted_forward_return FROM (SELECT asof_date, market_scope, forecast_horizon, lag(ret, 20) OVER ({SC}) AS market_forecast_score FROM k12_target)"
CTES["k13_valid"] = """SELECT f.*, t.ret, CASE WHEN t.ret IS NOT NULL THEN coalesce((f.market_forecast_score > 0) = (t.ret > 0), false)::INT END AS bh, f.market_forecast_score - t.ret AS be,
  CASE WHEN t.ret IS NOT NULL THEN coalesce((f.predicted_forward_return > 0) = (t.ret > 0), false)::INT END AS ah, f.predicted_forward_return - t.ret AS ae FROM k13_forecast f JOIN k12_target t USING (asof_date, market_scope, forecast_horizon)"""


def k13_frame(t):
    from tidemark.operators.windows import Axis

    target = T.forecast_targets(k12_closes(t))
    ax = Axis.of(["market_scope", "forecast_horizon"], "asof_date")
    forecast = target.select(*T.KEYS, F.lag("target_forward_return", 20).over(ax.by).alias("market_forecast_score"))
    calibrated = forecast.select(*T.KEYS, (F.lag("market_forecast_score").over(ax.by) / 10).alias("predicted_forward_return"))
    return T.forecast_validation(forecast, calibrated, target), target


@query("k13_forecast_validation", f"SELECT asof_date, market_scope, forecast_horizon, bh AS baseline_direction_hit_flag, {r('be')} AS baseline_forecast_error, ah AS ai_direction_hit_flag, {r('ae')} AS ai_forecast_error FROM k13_valid")
def k13(t):
    return k13_frame(t)[0].select(*T.KEYS, "baseline_direction_hit_flag", rd("baseline_forecast_error").alias("baseline_forecast_error"), "ai_direction_hit_flag", rd("ai_forecast_error").alias("ai_forecast_error"))


def mon(x: str, n: int) -> str:
    return sql_roll("avg", x, n, max(10, n // 2), SC)


def mcorr(x: str, n: int) -> str:
    w = f"({SC} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({x}) FILTER (ret IS NOT NULL) OVER {w} >= {max(10, n // 2)} THEN corr({x}, ret) OVER {w} END"


@query("k14_forecast_monitoring", f"""
SELECT *, CASE WHEN ai_corr_60d IS NULL OR ai_hit_rate_60d IS NULL THEN 'insufficient_history' WHEN ai_corr_60d >= 0.2 AND ai_hit_rate_60d >= 0.56 THEN 'strong' WHEN ai_corr_60d >= 0.1 AND ai_hit_rate_60d >= 0.53 THEN 'usable'
  WHEN ai_corr_60d <= -0.05 OR ai_hit_rate_60d < 0.48 THEN 'weak' ELSE 'watch' END AS monitoring_quality_label FROM (
  SELECT asof_date, market_scope, forecast_horizon, {r(mcorr('market_forecast_score', 60), 5)} AS baseline_corr_60d, {r(mcorr('predicted_forward_return', 60), 5)} AS ai_corr_60d, {r(mon('ah', 60), 5)} AS ai_hit_rate_60d,
    {r(mon('abs(ae)', 20), 5)} AS ai_mae_20d, {r(mon('ah', 120) + ' - ' + mon('bh', 120), 5)} AS ai_minus_baseline_hit_rate_120d FROM k13_valid)""")
def k14(t):
    out = T.forecast_monitoring(k13_frame(t)[0])
    return out.select(*T.KEYS, *[rd(c, 5).alias(c) for c in ("baseline_corr_60d", "ai_corr_60d", "ai_hit_rate_60d", "ai_mae_20d", "ai_minus_baseline_hit_rate_120d")], "monitoring_quality_label")


# -- K16, K17 -----------------------------------------------------------------------------------------

GROUPS = {"market": ["market_state_score", "trend_score", "breadth_score", "risk_on_score", "risk_off_score"], "risk": ["market_stress_score", "drawdown_pressure_score", "defensive_asset_strength_score"],
          "target_free": ["kospi_ret_1m", "kosdaq_ret_1m"]}
CTES["k16_base"] = f"SELECT m.*, h.h AS forecast_horizon, {STATE.format('m.market_state_score')} AS market_state_label, k.market_stress_score, k.drawdown_pressure_score, k.defensive_asset_strength_score AS das FROM k1_scored m CROSS JOIN (VALUES ('5d'), ('20d')) h(h) LEFT JOIN k2_risk k ON k.asof_date = m.asof_date"
pres = lambda cs: " + ".join(f"({c} IS NOT NULL)::INT" for c in cs)
G1, G2, G3 = GROUPS["market"], ["market_stress_score", "drawdown_pressure_score", "das"], GROUPS["target_free"]
CTES["k16_change"] = f"""SELECT *, row_number() OVER ({SC}) AS rn, coalesce(lag(market_state_label) OVER ({SC}) <> market_state_label, false)::INT AS chg, {r(f'market_state_score - lag(market_state_score) OVER ({SC})')} AS d1,
  {r(f'market_state_score - lag(market_state_score, 5) OVER ({SC})')} AS d5, {r(f'risk_on_score - lag(risk_on_score, 20) OVER ({SC})')} AS ro20 FROM k16_base"""


def k16_frame(t):
    from tidemark.operators.asof import grid

    market, risk = k1_frames(t)
    base = grid(market.select("asof_date", "market_scope", (F.col("market_state_score") * 0).alias("market_forecast_score")), "forecast_horizon", ["5d", "20d"])
    none = base.select(*T.KEYS).where(F.lit(False)).withColumn("calibrated_forecast_score", F.lit(0.0))
    return I.model_input(base, [market], [risk], none, GROUPS)


@query("k16_model_input", f"""
SELECT asof_date, market_scope, forecast_horizon, d1 AS market_state_score_delta_1d, d5 AS market_state_score_delta_5d, ro20 AS risk_on_score_delta_20d, chg AS state_change_flag,
  CASE WHEN d1 IS NULL THEN 'unknown' WHEN d1 > 0.1 THEN 'improving' WHEN d1 < -0.1 THEN 'deteriorating' ELSE 'unchanged' END AS state_change_direction,
  CAST(sum(chg) OVER ({SC} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS BIGINT) AS transition_count_20d, rn - max(CASE WHEN chg = 1 OR rn = 1 THEN rn END) OVER ({SC}) AS days_since_state_change,
  {r(f'({pres(G1)}) / 5.0::DOUBLE')} AS market_coverage_ratio, ({pres(G2)} > 0)::INT AS risk_available,
  {r(f"({r(f'({pres(G1)}) / 5.0::DOUBLE')} + {r(f'({pres(G2)}) / 3.0::DOUBLE')} + {r(f'({pres(G3)}) / 2.0::DOUBLE')}) / 3")} AS coverage_ratio FROM k16_change""")
def k16(t):
    return k16_frame(t).select(*T.KEYS, "market_state_score_delta_1d", "market_state_score_delta_5d", "risk_on_score_delta_20d", "state_change_flag", "state_change_direction", "transition_count_20d",
                               "days_since_state_change", "market_coverage_ratio", "risk_available", "coverage_ratio")


@query("k17_regime_performance", f"""
SELECT v.market_scope, v.forecast_horizon, m.market_state_label AS dimension_value, count(*) AS n, {r('avg(v.ret)', 5)} AS mean_target_forward_return, {r('avg(v.bh)', 5)} AS baseline_hit_rate
FROM k13_valid v LEFT JOIN k16_base m USING (asof_date, market_scope, forecast_horizon) WHERE v.ret IS NOT NULL GROUP BY 1, 2, 3""")
def k17(t):
    validation, target = k13_frame(t)
    inputs = k16_frame(t).withColumn("source_date", F.date_sub("asof_date", 1))
    pack = I.readiness(inputs.drop("market_forecast_score"), target, validation, ["market_state_label"], "source_date")
    out = pack["regime"].drop("dimension").withColumnRenamed("rows", "n")
    return out.select("market_scope", "forecast_horizon", "dimension_value", "n", rd("mean_target_forward_return", 5).alias("mean_target_forward_return"), rd("baseline_hit_rate", 5).alias("baseline_hit_rate"))


@query("k17_leakage_report", """
SELECT unnest(['source_before_asof', 'target_after_asof', 'no_target_in_features']) AS check_name, unnest([count(*) FILTER (source_date >= asof_date), count(*) FILTER (end_date <= asof_date), 0]) AS failed_rows, count(*) AS checked_rows,
  unnest([CASE WHEN count(*) FILTER (source_date >= asof_date) = 0 THEN 'ok' ELSE 'failed' END, CASE WHEN count(*) FILTER (end_date <= asof_date) = 0 THEN 'ok' ELSE 'failed' END, 'ok']) AS status
FROM (SELECT asof_date, asof_date - 1 AS source_date, t.end_date FROM k16_base JOIN k12_target t USING (asof_date, market_scope, forecast_horizon) WHERE t.ret IS NOT NULL)""")
def k17_leak(t):
    validation, target = k13_frame(t)
    inputs = k16_frame(t).withColumn("source_date", F.date_sub("asof_date", 1))
    return I.readiness(inputs.drop("market_forecast_score"), target, validation, ["market_state_label"], "source_date")["leakage"]


# -- K15, K18, K19 ---------------------------------------------------------------------------------------

from tidemark.plans import panels as PN  # noqa: E402
from tidemark.plans import state as S  # noqa: E402
from tidemark.catalog.fits import ridge_sql  # noqa: E402
from tidemark.plans import walkforward as WF  # noqa: E402

RIDGE_FEATURES = ["trend_score", "breadth_score", "risk_on_score", "risk_off_score", "market_vol_20d", "kospi_ret_1m"]


CTES["k15_rows"] = """SELECT t.asof_date, t.market_scope, t.forecast_horizon, t.ret AS target_forward_return, m.trend_score, m.breadth_score, m.risk_on_score, m.risk_off_score, m.vol_20d AS market_vol_20d, m.kospi_ret_1m
FROM k12_target t JOIN k1_scored m USING (asof_date, market_scope)"""


@query("k15_calibrated_forecast", ridge_sql("SELECT * FROM k15_rows", ["market_scope", "forecast_horizon"], "asof_date", RIDGE_FEATURES, "target_forward_return", f"""
SELECT asof_date, market_scope, forecast_horizon, known AS training_sample_count, {r('pred')} AS predicted_forward_return, {r('score', 4)} AS calibrated_forecast_score, label AS calibrated_forecast_label,
  confidence AS calibration_confidence_score FROM p""", embargo=20))
def k15(t):
    market, _ = k1_frames(t)
    target = T.forecast_targets(k12_closes(t)).select(*T.KEYS, "target_forward_return")
    rows = target.join(market.select("asof_date", "market_scope", *RIDGE_FEATURES), ["asof_date", "market_scope"])
    out = WF.walk_forward_ridge(rows, ["market_scope", "forecast_horizon"], "asof_date", RIDGE_FEATURES, "target_forward_return", embargo_rows=20)
    return out.select(*T.KEYS, "training_sample_count", rd("predicted_forward_return").alias("predicted_forward_return"), rd("calibrated_forecast_score", 4).alias("calibrated_forecast_score"),
                      "calibrated_forecast_label", "calibration_confidence_score")


def feat_sql(source: str, key: str, date: str, value: str) -> str:
    p = f"PARTITION BY {key} ORDER BY {date}"
    ret = lambda n: f"coalesce({value} / nullif(lag({value}, {n}) OVER ({p}), 0) - 1, 0) AS r{n}"
    return f"""SELECT {key} AS k, {date} AS d, {', '.join(ret(n) for n in (1, 5, 20, 60))}, coalesce({value} - lag({value}, 20) OVER ({p}), 0) AS c20, coalesce({sql_roll('stddev_pop', 'r', 20, 20, p)}, 0) AS vol,
      {value} / {sql_roll('max', value, 5, 1, p)} - 1 AS dd5, {value} / {sql_roll('max', value, 20, 1, p)} - 1 AS dd20, row_number() OVER ({p}) AS rn FROM (SELECT *, {value} / nullif(lag({value}) OVER ({p}), 0) - 1 AS r FROM {source})"""


CTES["k18_f"] = feat_sql("market_prices", "ticker", "date", "close")
CTES["k18_r"] = feat_sql("daily_obs", "series_id", "asof_date", "value")
from tidemark.catalog.aggregates import BREADTH  # noqa: E402

CTES["k18_b"] = f"""SELECT date AS d, count(*) AS universe, avg((close > ma20)::INT) AS a20, avg((close > ma60)::INT) AS a60, (count(*) FILTER (chg > 0) + 1)::DOUBLE / (count(*) FILTER (chg < 0) + 1) AS adr,
  count(*) FILTER (close >= hi) AS highs, count(*) FILTER (close <= lo) AS lows FROM {BREADTH} WHERE rn >= 60 GROUP BY 1"""
asof = lambda name, cte, key: f"ASOF LEFT JOIN (SELECT * FROM {cte} WHERE k = '{key}') {name} ON s.asof_date >= {name}.d"
CTES["k18_wide"] = f"""SELECT s.asof_date, m.r1 AS m1, m.r5 AS m5, m.r20 AS m20, m.r60 AS m60, g.r20 AS g20, g.r60 AS g60, l.r20 AS l20, m.vol, m.dd5, m.dd20, coalesce(x.r20, 0) AS fx20, coalesce(i.r20, 0) AS i20, coalesce(b.r20, 0) AS b20,
  coalesce(o.r20, 0) AS o20, coalesce(sr.c20, 0) AS sc, coalesce(br.c20, 0) AS bc, u.* EXCLUDE (d) FROM (SELECT date AS asof_date FROM market_prices WHERE ticker = 'KOSPI') s
{asof('m', 'k18_f', 'KOSPI')} {asof('g', 'k18_f', 'KOSDAQ')} {asof('l', 'k18_f', 'KOSPI200')} {asof('x', 'k18_f', 'USDKRW')} {asof('i', 'k18_f', 'INVERSE')} {asof('b', 'k18_f', 'BOND')} {asof('o', 'k18_f', 'GOLD')}
{asof('sr', 'k18_r', 'DGS2')} {asof('br', 'k18_r', 'DGS10')} ASOF LEFT JOIN k18_b u ON s.asof_date >= u.d WHERE m.rn >= 61 AND g.rn >= 61 AND l.rn >= 21"""
CTES["k18_score"] = f"""SELECT *, {sql_clip('0.35::DOUBLE * trend + 0.30::DOUBLE * breadth + 0.20::DOUBLE * risk + 0.15::DOUBLE * defensive')} AS total FROM (SELECT asof_date, m20, g20, fx20, b20, o20, i20,
  {sql_clip('8.0::DOUBLE * m20 + 5.0::DOUBLE * m60 + 6.0::DOUBLE * g20 + 4.0::DOUBLE * g60 + 5.0::DOUBLE * l20 + 3.0::DOUBLE * m5')} AS trend,
  {sql_clip('3.2::DOUBLE * (a20 - 0.5::DOUBLE) + 2.8::DOUBLE * (a60 - 0.5::DOUBLE) + 0.9::DOUBLE * ln(greatest(adr, 0.000001::DOUBLE)) + 10.0::DOUBLE * (highs - lows)::DOUBLE / greatest(universe, 1)')} AS breadth,
  {sql_clip('-55.0::DOUBLE * vol + 18.0::DOUBLE * dd5 + 10.0::DOUBLE * dd20')} AS risk,
  {sql_clip('-15.0::DOUBLE * fx20 - 4.5::DOUBLE * i20 - 6.0::DOUBLE * b20 - 5.0::DOUBLE * o20 - 1.5::DOUBLE * sc - 1.2::DOUBLE * bc')} AS defensive FROM k18_wide)"""


def k18_features(t):
    return S.state_features(t.market_prices.select("ticker", "date", "close"), t.daily_obs, S.universe_breadth(t.stock_prices, "ticker", "date", "close"))


@query("k18_component_scores", f"""
SELECT asof_date, {r('trend', 3)} AS trend_score, {r('breadth', 3)} AS breadth_score, {r('risk', 3)} AS risk_score, {r('defensive', 3)} AS defensive_flow_score, {r('total', 3)} AS total_score,
  CASE WHEN total IS NULL THEN NULL WHEN total >= 2 THEN '강상승' WHEN total >= 1 THEN '상승' WHEN total >= 0.3 THEN '강보합' WHEN total >= -0.3 THEN '중립' WHEN total >= -1 THEN '약보합' WHEN total >= -2 THEN '하락' ELSE '강하락' END AS state_label FROM k18_score""")
def k18(t):
    df = k18_features(t)
    from tidemark.functions import numeric as N

    parts = N.state_components({**{c: F.col(c) for c in df.columns}, "regime": F.lit(None).cast("double")})
    from tidemark.functions import labels as L

    return df.withColumns(parts).select("asof_date", *[F.round(c, 3).alias(c) for c in parts], L.state_bucket("total_score").alias("state_label"))


@query("k18_state_history", f"""
SELECT asof_date, label AS state_label, lag(label) OVER (ORDER BY asof_date) AS prev_state_label, CASE WHEN lag(v) OVER (ORDER BY asof_date) IS NULL THEN 'unchanged' WHEN v > lag(v) OVER (ORDER BY asof_date) + 1e-9 THEN 'stronger'
  WHEN v < lag(v) OVER (ORDER BY asof_date) - 1e-9 THEN 'weaker' ELSE 'unchanged' END AS state_change_direction FROM (SELECT asof_date, v, CASE WHEN total IS NULL THEN NULL WHEN total >= 2 THEN '강상승' WHEN total >= 1 THEN '상승' WHEN total >= 0.3 THEN '강보합' WHEN total >= -0.3 THEN '중립'
  WHEN total >= -1 THEN '약보합' WHEN total >= -2 THEN '하락' ELSE '강하락' END AS label FROM (SELECT asof_date, {r('total', 4)} AS v, total FROM k18_score))""")
def k18_hist(t):
    return S.state_history(S.state_scores(k18_features(t))).drop("market", "state_score")


@query("k19_relative_strength", f"""
SELECT asof_date, asset_group, {r('ret', 5)} AS ret_20d, {r('z', 4)} AS strength_score, row_number() OVER (PARTITION BY asof_date ORDER BY ret DESC, o) AS strength_rank, CASE WHEN z >= 0.5 THEN '강함' WHEN z <= -0.5 THEN '약함' ELSE '중립' END AS strength_label FROM (
  SELECT *, coalesce((ret - avg(ret) OVER d) / nullif(stddev_pop(ret) OVER d, 0), 0) AS z FROM (SELECT asof_date, unnest(['KOSPI', 'KOSDAQ', 'USDKRW', 'BOND', 'GOLD', 'INVERSE']) AS asset_group, unnest([0, 1, 2, 3, 4, 5]) AS o, unnest([m20, g20, fx20, b20, o20, i20]) AS ret FROM k18_score)
  WINDOW d AS (PARTITION BY asof_date))""")
def k19(t):
    out = S.relative_strength(k18_features(t))
    return out.withColumns({"ret_20d": rd("ret_20d", 5), "strength_score": rd("strength_score", 4)})


# -- K23-K28 -----------------------------------------------------------------------------------------------

@query("k23_series_catalogue", f"""
SELECT series_id, min(asof_date) AS start_date, max(asof_date) AS latest_date, count(*) AS point_count, {r('arg_max(value, asof_date)')} AS latest_value, {r('arg_max(coalesce(chg, 1e9), asof_date)')} AS latest_change_value, 'official' AS source_tier,
  count(*) FILTER (asof_date >= DATE '1999-01-01') AS recent_points FROM (SELECT *, value - lag(value) OVER ({SP}) AS chg FROM daily_obs) GROUP BY 1""")
def k23(t):
    out = PN.series_catalogue(t.daily_obs, "series_id", "asof_date", "value", F.lit("fred"), day("1999-01-01"))
    return out.select("series_id", "start_date", "latest_date", "point_count", rd("latest_value").alias("latest_value"), rd("latest_change_value").alias("latest_change_value"), "source_tier", "recent_points")


CTES["k24_points"] = f"""SELECT 'financial_environment' AS series_id, m.asof_date AS date, {r(sql_clip(sql_mean(sql_clip('-pressure'), 'external_asset_risk_on_score', 'us_equity_momentum_score', 'korea_proxy_momentum_score') + ' - ' + sql_mean(sql_clip('pressure'), sql_clip('rate_p'), sql_clip('comm_p'), sql_clip('risk_p'), sql_clip('credit_p')) + ' * 0.7::DOUBLE'), 4)} AS value
FROM k5_macro m JOIN k6_assets a USING (asof_date)"""


@query("k24_composite_chart", """
SELECT series_id, unnest(generate_series(date, greatest(coalesce(nxt - 1, DATE '2001-12-31'), date), INTERVAL 1 DAY))::DATE AS date, value, date AS source_date,
  CASE WHEN unnest(generate_series(date, greatest(coalesce(nxt - 1, DATE '2001-12-31'), date), INTERVAL 1 DAY))::DATE = date THEN 'observed' ELSE 'carry_forward' END AS point_type
FROM (SELECT *, lead(date) OVER (PARTITION BY series_id ORDER BY date) AS nxt FROM k24_points WHERE value IS NOT NULL)""")
def k24(t):
    macro, assets = M.macro_context(t.daily_obs, t.monthly_obs), M.asset_context(t.asset_prices)
    axes = PN.axis_scores(macro.join(assets, "asof_date").drop("unrate"))
    return PN.composite_chart(axes.select("asof_date", *PN.AXES), day("2001-12-31"))


@query("k24_rebased_indices", f"SELECT market_scope, date, {r('close / first_value(close) OVER (PARTITION BY market_scope ORDER BY date) * 100', 4)} AS level FROM scope_prices WHERE date >= DATE '1998-01-01'")
def k24_idx(t):
    return PN.rebased_indices(t.scope_prices, "market_scope", "date", "close", day("1998-01-01")).withColumn("level", rd("level", 4))


@query("k25_timeline_history", f"""
SELECT a.asof_ts, a.signal_code, {r('a.change_pct')} AS change_pct, b.n FROM bars a JOIN bars b USING (asof_ts, signal_code) WHERE a.asof_ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-25'""")
def k25(t):
    lo, hi = F.lit("2024-01-10").cast("timestamp_ntz"), F.lit("2024-01-25").cast("timestamp_ntz")
    out = PN.panel_history(t.bars.select("signal_code", "asof_ts", "change_pct"), t.bars.select("signal_code", "asof_ts", "n"), ["signal_code"], lo, hi, "asof_ts")
    return out.withColumn("change_pct", rd("change_pct"))


PSQ = "PARTITION BY market_scope ORDER BY date"


@query("k26_index_panel", f"""
SELECT market_scope, date, {r('r1')} AS ret_1d, {r('r20')} AS ret_20d, {r('vol')} AS realized_vol_20d, {r('dd')} AS drawdown_20d, CASE WHEN r1 > 0 THEN 'up' WHEN r1 < 0 THEN 'down' ELSE 'flat' END AS direction FROM (
  SELECT *, {sql_roll('stddev_samp', 'lr', 20, 20, PSQ)} * sqrt(252) AS vol, close / {sql_roll('max', 'close', 20, 1, PSQ)} - 1 AS dd FROM (
    SELECT *, close / lag(close) OVER ({PSQ}) - 1 AS r1, close / lag(close, 20) OVER ({PSQ}) - 1 AS r20, ln(close / lag(close) OVER ({PSQ})) AS lr FROM scope_prices WHERE date <= DATE '2001-06-30'))
QUALIFY row_number() OVER (PARTITION BY market_scope ORDER BY date DESC) = 1""")
def k26(t):
    out = PN.index_panel(t.scope_prices, "market_scope", "date", "close", day("2001-06-30"))
    return out.select("market_scope", "date", *[rd(c).alias(c) for c in ("ret_1d", "ret_20d", "realized_vol_20d", "drawdown_20d")], "direction")


@query("k28_disclosure_summary", """
SELECT source, lang, count(*) AS filing_count_total, count(*) FILTER (k = 'risk')::BIGINT AS risk_event_count, count(*) FILTER (k = 'funding') AS funding_count, count(*) FILTER (k = 'general') AS general_count,
  coalesce(array_to_string(list_transform(list_slice(list_sort(list({'o': CASE k WHEN 'risk' THEN 0 ELSE 1 END, 'd': -doc_id}) FILTER (k IN ('risk', 'funding'))), 1, 5), lambda x: (-x.d)::VARCHAR), ','), '') AS highlights FROM (
  SELECT *, CASE WHEN text LIKE '%exempt%' THEN 'general' WHEN text LIKE '%secret%' OR text LIKE '%password%' OR text LIKE '%error%' THEN 'risk' WHEN text LIKE '%license%' OR text LIKE '%copyright%' THEN 'funding'
    WHEN text LIKE '%the%' OR text LIKE '%der%' THEN 'general_note' ELSE 'general' END AS k FROM documents) GROUP BY 1, 2""")
def k28(t):
    from tidemark.catalog.expressions import SAMPLE_RULES

    events = PN.disclosure_events(t.table("documents").select("doc_id", "source", "lang", "text"), "text", SAMPLE_RULES, ["exempt"]).drop("text")
    out = PN.disclosure_summary(events, ["source", "lang"], "doc_id", 5)
    return out.withColumn("highlights", F.array_join(F.transform("highlights", lambda x: x.cast("string")), ","))


# -- K27, Q6, P23 -----------------------------------------------------------------------------------------

PREVIEW_CODES = {"click": "KOSPI200_NIGHT_FUT", "view": "KOREA_PROXY_EWY", "purchase": "SP500_FUT", "signup": "NASDAQ100_FUT", "error": "WTI"}
PREVIEW_COLS = {"click": "night", "view": "proxy", "purchase": "sp", "signup": "nq", "error": "oil"}
CTES["k27_wide"] = "SELECT date_trunc('hour', ts) AS h, " + ", ".join(
    f"sum(CAST(round(value * 100) AS BIGINT) - 5000) FILTER (event_type = '{e}')::DOUBLE / count(*) FILTER (event_type = '{e}') / 500000.0::DOUBLE AS {c}" for e, c in PREVIEW_COLS.items()) + ", count(*) FILTER (event_type = 'error') AS risk FROM events GROUP BY 1"
num = lambda pairs: " + ".join(f"coalesce({x} * {d_(w)}, 0)" for x, w in pairs)
den = lambda pairs: " + ".join(f"(CASE WHEN {x} IS NOT NULL THEN {d_(w)} ELSE 0 END)" for x, w in pairs)
FUTS = [("10 * night", 0.4), ("10 * proxy", 0.2), ("10 * sp", 0.2), ("10 * nq", 0.2)]
WORLD = [("8 * sp", 0.45), ("8 * nq", 0.45), ("-3 * coalesce(oil, 0)", 0.10)]
CTES["k27_bias"] = f"""SELECT h, night, proxy, {r('fut', 4)} AS futures_bias, {r('world', 4)} AS global_risk_bias, {r(sql_clip('0.45::DOUBLE * fut + 0.35::DOUBLE * world'), 4)} AS score FROM (SELECT *,
  {sql_clip(f'coalesce(({num(FUTS)}) / nullif({den(FUTS)}, 0), 0::DOUBLE)')} AS fut, {sql_clip(f'coalesce(({num(WORLD)}) / nullif({den(WORLD)}, 0), 0::DOUBLE) - (greatest(5 * coalesce(oil, 0), 0::DOUBLE) + least(0.25::DOUBLE * risk, 1::DOUBLE))')} AS world FROM k27_wide)"""
CTES["k27_label"] = "SELECT *, CASE WHEN score >= 1.2 THEN '장초반 우호 가능성' WHEN score >= 0.4 THEN '장초반 우호 흐름' WHEN score <= -1.2 THEN '장초반 부담 가능성' WHEN score <= -0.4 THEN '장초반 경계 흐름' ELSE '혼조 출발 가능성' END AS label FROM k27_bias"


@query("k27_preview_states", """
SELECT h, futures_bias, global_risk_bias, score AS next_day_score, label AS preview_label, CASE WHEN night IS NULL AND proxy IS NULL THEN 'unavailable' WHEN night IS NULL OR proxy IS NULL THEN 'single_source' WHEN sign(night) = sign(proxy) THEN 'aligned' ELSE 'mixed' END AS alignment,
  (h::TIME >= TIME '18:00:00' OR h::TIME <= TIME '08:30:00')::INT AS active, CASE WHEN lag(score) OVER w IS NULL THEN 1 WHEN label <> lag(label) OVER w OR abs(score - lag(score) OVER w) >= 0.35 OR sign(futures_bias) <> sign(lag(futures_bias) OVER w) THEN 1 ELSE 0 END AS material_change
FROM k27_label WINDOW w AS (ORDER BY h)""")
def k27(t):
    from tidemark.sources.sample import cents, mapped

    e = t.table("events").withColumns({"h": F.date_trunc("hour", "ts").cast("timestamp_ntz"), "market": F.lit("KR"), "asset_code": mapped(PREVIEW_CODES, "event_type")})
    change = F.sum(cents("value") - 5000).cast("double") / F.count(F.lit(1)) / 500000.0
    assets = e.groupBy("market", "h", "asset_code").agg(change.alias("change_pct"))
    news = e.groupBy("market", "h").agg(F.count_if(F.col("event_type") == "error").alias("risk_headlines"))
    out = PN.preview_states(assets, news, ["market"], "h")
    return out.select("h", "futures_bias", "global_risk_bias", "next_day_score", "preview_label", "alignment", "active", "material_change")


@query("q6_signal_quality", """
WITH s AS (SELECT DISTINCT market_scope, forecast_horizon, asof_date FROM predictions WHERE asof_date = (SELECT max(asof_date) FROM predictions))
SELECT 'error' AS kind, 'stale_signal' AS check_name, max(asof_date)::VARCHAR AS detail FROM s HAVING DATE '2002-01-01' - max(asof_date) > 7
UNION ALL SELECT 'error', 'missing_market_horizon', g.m || ':' || h.h FROM (VALUES ('KOSPI'), ('KOSDAQ'), ('KOSPI200')) g(m), (VALUES ('5d'), ('20d'), ('60d')) h(h) WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.market_scope = g.m AND s.forecast_horizon = h.h)
UNION ALL SELECT 'error', 'non_investable_scope', forecast_horizon FROM s WHERE market_scope = 'KOSPI200'
UNION ALL SELECT 'warning', 'daily_source_older_than_signal', market_scope || ':' || latest::VARCHAR FROM (SELECT market_scope, max(date) - 3 AS latest FROM scope_prices GROUP BY 1) WHERE latest < (SELECT max(asof_date) FROM s)""")
def q6(t):
    from tidemark.plans.handoff import signal_quality

    p = t.predictions
    newest = p.where(F.col("asof_date") == p.agg(F.max("asof_date")).scalar()).select("market_scope", "forecast_horizon", "asof_date").distinct()
    sources = t.scope_prices.groupBy("market_scope").agg(F.date_sub(F.max("date"), 3).alias("latest_date"))
    return signal_quality(newest, day("2002-01-01"), 7, ["KOSPI", "KOSDAQ", "KOSPI200"], ["5d", "20d", "60d"], sources, forbidden="KOSPI200")


@query("p23_feature_cap", """
SELECT feature FROM (SELECT unnest(['s1', 's2', 's3', 'u1']) AS feature, unnest([1, 2, 3, 4]) AS o, unnest([count(s1), count(s2), count(s3), count(u1)]) AS n, unnest([min(s1) < max(s1), min(s2) < max(s2), min(s3) < max(s3), min(u1) < max(u1)]) AS v, count(*) AS total FROM scores)
WHERE n >= total * 0.95 AND v ORDER BY o LIMIT 2""")
def p23(t):
    from tidemark.plans.models import feature_cap

    return feature_cap(t.scores, ["s1", "s2", "s3", "u1"], 0.95, 2).select("feature")


P41_COLUMNS = {**{c: c for c in [*K1_SCORES, *K1_RATIOS]}, "risk_score": "stress", "market_vol_20d": "vol_20d", "market_mdd_3m": "mdd_3m", **{f"market_breadth_{c}": c for c in ("ret_pos_1m", "above_sma20", "above_sma60", "above_sma120")},
               **{c: c for c in ("new_high_ratio_20d", "new_low_ratio_20d", "trading_value_expansion_ratio")}}


@query("p41_score_directions", f"""
SELECT column_name, {direction_sql('column_name')} AS direction, present FROM (SELECT unnest([{', '.join(f"'{c}'" for c in P41_COLUMNS)}]) AS column_name, unnest([{', '.join(f'count({c})' for c in P41_COLUMNS.values())}]) AS present FROM k1_scored)""")
def p41(t):
    market, _ = k1_frames(t)
    tagged = I.with_directions(market)
    cells = [F.struct(F.lit(f.name).alias("column_name"), F.lit(f.metadata["score_direction"]).alias("direction"), F.count(f.name).alias("present"))
             for f in tagged.schema if "score_direction" in f.metadata]
    return tagged.agg(F.array(*cells).alias("c")).select(F.explode("c").alias("x")).select("x.*")
