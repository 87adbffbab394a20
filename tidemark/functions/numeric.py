"""Null-safe arithmetic: clips, row means, weighted means, score formulas."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

EOK = 1e8  # fixed unit: one eok is 1e8 KRW
TRADING_DAYS = 252


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean(c: Column | str) -> Column:
    """NaN becomes null, so that comparisons and aggregates skip it."""
    c = as_col(c)
    return F.when(~F.isnan(c), c)


def clip(c: Column | str, low: float = -3.0, high: float = 3.0) -> Column:
    """P1. Bound a value; null stays null (``greatest`` alone would return the bound)."""
    c = as_col(c)
    return F.when(c.isNotNull(), F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), c)))


def score(c: Column, low: float = -3.0, high: float = 3.0, digits: int = 4) -> Column:
    return F.round(clip(c, low, high), digits)


def ratio(a: Column | str, b: Column | str) -> Column:
    """Division that yields null on a zero or null denominator."""
    return F.try_divide(as_col(a).cast("double"), as_col(b).cast("double"))


def _add(cols: Sequence[Column]) -> Column:
    return reduce(lambda x, y: x + y, cols)


def _all_names(cols: Sequence[Column | str]) -> bool:
    return all(isinstance(c, str) for c in cols)


def _sum_text(cols: Sequence[str]) -> str:
    return " + ".join(f"coalesce(cast(`{c}` AS double), 0D)" for c in cols)


def _count_text(cols: Sequence[str]) -> str:
    return " + ".join(f"cast(`{c}` IS NOT NULL AS int)" for c in cols)


def count_present(*cols: Column | str) -> Column:
    """How many of the inputs are not null."""
    if _all_names(cols):
        return F.expr(_count_text(cols))
    return _add([as_col(c).isNotNull().cast("int") for c in cols])


def any_present(*cols: Column | str) -> Column:
    """P20. True when at least one input is not null."""
    return F.coalesce(*[as_col(c).cast("double") for c in cols]).isNotNull()


def row_sum(*cols: Column | str) -> Column:
    if _all_names(cols):
        return F.expr(_sum_text(cols))
    return _add([F.coalesce(as_col(c).cast("double"), F.lit(0.0)) for c in cols])


def row_mean(*cols: Column | str) -> Column:
    """P14. Mean over the non-null inputs of one row; null when none is present."""
    if _all_names(cols):
        return F.expr(f"try_divide({_sum_text(cols)}, {_count_text(cols)})")
    return ratio(row_sum(*cols), count_present(*cols))


def row_std(*cols: Column | str) -> Column:
    """Sample deviation across the non-null inputs of one row."""
    mean = row_mean(*cols)
    squares = _add([F.coalesce(F.pow(as_col(c) - mean, 2), F.lit(0.0)) for c in cols])
    return F.sqrt(ratio(squares, count_present(*cols) - 1))


def weighted_mean(terms: Sequence[tuple[Column | str, float]], signed: bool = False, empty: float | None = None) -> Column:
    """P15. Weighted mean over present terms, weights renormalised.

    The denominator is the sum of absolute weights, or of signed weights when
    ``signed``. ``empty`` is the value when no term is present.
    """
    num = _add([F.coalesce(as_col(c).cast("double") * F.lit(float(w)), F.lit(0.0)) for c, w in terms])
    den = _add([
        F.when(as_col(c).isNotNull(), F.lit(float(w if signed else abs(w)))).otherwise(F.lit(0.0)) for c, w in terms
    ])
    out = ratio(num, den)
    return out if empty is None else F.coalesce(out, F.lit(float(empty)))


def scaled_return_score(*cols: Column | str, scale: float) -> Column:
    """P16. Mean of the returns times a scale, clipped to three and rounded."""
    return score(row_mean(*cols) * F.lit(float(scale)))


def trend_score(ret_1m: Column | str, ret_3m: Column | str) -> Column:
    """P17. 18 x one-month return + 8 x three-month return."""
    return score(as_col(ret_1m) * 18.0 + as_col(ret_3m) * 8.0)


def breadth_score(*flags: Column | str) -> Column:
    """P17. Share of raised flags centred on one half, times six."""
    return score((row_mean(*flags) - 0.5) * 6.0)


def stress_score(vol: Column | str, drawdown: Column | str) -> Column:
    """P17. Volatility above 12 % and drawdown in units of 15 %, on [0, 3]."""
    vol, drawdown = as_col(vol), as_col(drawdown)
    vol_part = F.greatest(F.lit(0.0), (vol - 0.12) / 0.18)
    dd_part = F.abs(F.least(drawdown, F.lit(0.0))) / 0.15
    return F.when(vol.isNotNull() & drawdown.isNotNull(), score((vol_part + dd_part) * 1.5, 0.0, 3.0))


def drawdown_pressure(drawdown: Column | str) -> Column:
    d = as_col(drawdown)
    return F.when(d.isNotNull(), score(F.abs(F.least(d, F.lit(0.0))) / 0.15 * 3.0, 0.0, 3.0))


def state_components(f: dict[str, Column]) -> dict[str, Column]:
    """P18. Four component scores and their weighted total.

    ``f`` maps the feature names of the hourly table to columns. A zero regime
    reference counts as missing and takes one half.
    """
    regime = F.coalesce(F.when(f["regime"] != 0, f["regime"]), F.lit(0.5))
    trend = (
        8.0 * f["main_ret_20d"] + 5.0 * f["main_ret_60d"] + 6.0 * f["growth_ret_20d"] + 4.0 * f["growth_ret_60d"]
        + 5.0 * f["large_ret_20d"] + 3.0 * f["main_ret_5d"] + 0.6 * (regime - 0.5)
    )
    breadth = (
        3.2 * (f["above_ma20"] - 0.5) + 2.8 * (f["above_ma60"] - 0.5)
        + 0.9 * F.log(F.greatest(f["adv_dec_ratio"], F.lit(1e-6)))
        + 10.0 * ratio(f["highs"] - f["lows"], F.greatest(f["universe"], F.lit(1)))
    )
    risk = -55.0 * f["vol_20d"] + 18.0 * f["dd_5d"] + 10.0 * f["dd_20d"]
    defensive = (
        -15.0 * f["fx_ret_20d"] - 4.5 * f["inverse_ret_20d"] - 6.0 * f["bond_ret_20d"] - 5.0 * f["gold_ret_20d"]
        - 1.5 * f["short_rate_chg"] - 1.2 * f["bond_rate_chg"]
    )
    parts = {"trend_score": clip(trend), "breadth_score": clip(breadth), "risk_score": clip(risk),
             "defensive_flow_score": clip(defensive)}
    total = clip(0.35 * parts["trend_score"] + 0.30 * parts["breadth_score"] + 0.20 * parts["risk_score"]
                 + 0.15 * parts["defensive_flow_score"])
    return {**parts, "total_score": total}


def overnight_biases(f: dict[str, Column]) -> dict[str, Column]:
    """P19. Overnight futures, global-risk and currency biases and their blend."""
    futures = clip(weighted_mean(
        [(10.0 * f["night"], 0.4), (10.0 * f["proxy"], 0.2), (10.0 * f["sp500"], 0.2), (10.0 * f["nasdaq"], 0.2)],
        signed=True, empty=0.0))
    base = weighted_mean(
        [(8.0 * f["sp500"], 0.45), (8.0 * f["nasdaq"], 0.45), (-3.0 * F.coalesce(f["oil"], F.lit(0.0)), 0.10)],
        signed=True, empty=0.0)
    zero = F.lit(0.0)
    penalty = (F.greatest(5.0 * F.coalesce(f["oil"], zero), zero) + F.greatest(4.0 * F.coalesce(f["us10y"], zero), zero)
               + F.least(0.25 * f["risk_headlines"], F.lit(1.0)))
    world = clip(base - penalty)
    fx = clip(-12.0 * F.coalesce(f["fx"], zero))
    blend = clip(0.45 * futures + 0.35 * world + 0.20 * fx)
    return {"futures_bias": futures, "global_risk_bias": world, "fx_bias": fx, "next_day_score": blend}


def display_scalings(c: Column | str) -> dict[str, Column]:
    """P31. Gauge on 0..100 for a [-3, 3] score; percent from a ratio; bp from percent points."""
    c = as_col(c)
    return {
        "gauge": F.round((clip(c) + 3.0) / 6.0 * 100.0, 1),
        "pct": F.round(c * 100.0, 2),
        "bp": F.round(c * 100.0, 1),
    }


def change_against(price: Column | str, prev: Column | str, fallback: Column | str) -> dict[str, Column]:
    """P36. Change and percent change versus previous close, else a reference close."""
    base = F.coalesce(as_col(prev), as_col(fallback))
    return {"base_close": base, "change_value": as_col(price) - base, "change_pct": ratio(price, base) - 1.0}


def unpercent(c: Column | str, detector: Column | str, threshold: float) -> Column:
    """P37. Divide by 100 where the detector says the value is in percent units."""
    c = as_col(c)
    return F.when(as_col(detector) > threshold, c / 100.0).otherwise(c)
