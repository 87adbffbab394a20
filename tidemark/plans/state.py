"""Hourly market state: universe breadth, feature row, scores, history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions import labels as L
from tidemark.functions import numeric as N
from tidemark.operators import asof as A
from tidemark.operators import windows as W
from tidemark.operators.relational import pick_first, star_join
from tidemark.operators.windows import Axis


def universe_breadth(prices: DataFrame, ticker: str, date: str, close: str, min_rows: int = 60) -> DataFrame:
    """A5, A6. Breadth of the universe for every date, from windows per ticker and one sum per date."""
    ax = Axis.of(ticker, date)
    rows = prices.select(
        ticker, date, close, W.rolling_mean(ax, close, 20, 20).alias("ma20"), W.rolling_mean(ax, close, 60, 60).alias("ma60"),
        W.lag_diff(ax, close, 1).alias("chg"), W.rolling_max(ax, close, 252, 60).alias("hi"), W.rolling_min(ax, close, 252, 60).alias("lo"),
        W.row_index(ax).alias("rn")).where(F.col("rn") >= min_rows)
    up, down = F.count_if(F.col("chg") > 0), F.count_if(F.col("chg") < 0)
    return rows.groupBy(date).agg(
        F.count(F.lit(1)).alias("universe"), F.avg((F.col(close) > F.col("ma20")).cast("int")).alias("above_ma20"),
        F.avg((F.col(close) > F.col("ma60")).cast("int")).alias("above_ma60"), ((up + 1) / (down + 1)).alias("adv_dec_ratio"),
        F.count_if(F.col(close) >= F.col("hi")).alias("new_highs"), F.count_if(F.col(close) <= F.col("lo")).alias("new_lows"))


def representative(df: DataFrame, keys: list[str], ticker: str, preferred: list[str], liquidity: str) -> DataFrame:
    """T8. Preferred ticker first, then the most liquid."""
    place = F.array_position(F.array(*[F.lit(p) for p in preferred]), F.col(ticker))
    order = F.when(place > 0, place).otherwise(999)
    return pick_first(df.withColumn("__pref", order), keys, [F.asc("__pref"), F.desc(liquidity), F.asc(ticker)]).drop("__pref")


def strength_panel(df: DataFrame, date: str, member: str, score: str, top: int = 3, bottom: int = 2) -> DataFrame:
    """T13. Leaders and laggards of every date (fixed membership per date)."""
    w = Window.partitionBy(date)
    rows = df.withColumn("place", F.row_number().over(w.orderBy(F.desc(score), F.asc(member))))
    rows = rows.withColumn("__low", F.row_number().over(w.orderBy(F.asc(score), F.asc(member))))
    keep = rows.where((F.col("place") <= top) | (F.col("__low") <= bottom))
    return keep.withColumn("side", F.when(F.col("place") <= top, "top").otherwise("bottom")).drop("__low")


# Roles of the state features: main, growth and large index, currency and defensive assets.
STATE_ROLES = {"main": "KOSPI", "growth": "KOSDAQ", "large": "KOSPI200", "fx": "USDKRW", "inverse": "INVERSE", "bond": "BOND", "gold": "GOLD"}


def series_features(prices: DataFrame, key: str = "ticker", date: str = "date", value: str = "close") -> DataFrame:
    """Per-series returns, volatility and drawdowns; short histories give zero."""
    ax = Axis.of(key, date)
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    df = prices.withColumn("__r", W.lag_return(ax, value, 1))
    return df.select(key, date, *[zero(W.lag_return(ax, value, n)).alias(f"ret_{n}d") for n in (1, 5, 20, 60)], zero(W.lag_diff(ax, value, 20)).alias("chg_20d"),
                     zero(W.realised_vol(ax, "__r", 20)).alias("vol_20d"), zero(W.drawdown(ax, value, 5)).alias("dd_5d"), zero(W.drawdown(ax, value, 20)).alias("dd_20d"),
                     W.row_index(ax).alias("rn"))


def _latest_on(spine: DataFrame, rows: DataFrame, key: str, members: list[str], date: str) -> DataFrame:
    """Last known feature struct of each member on every spine day."""
    body = [c for c in rows.columns if c not in (key, date)]
    packed = rows.where(F.col(key).isin(members)).select(key, F.col(date).alias("asof_date"), F.struct(*body).alias("f"))
    return A.forward_fill(spine, packed, members, key, "f")


def state_features(prices: DataFrame, rates: DataFrame, breadth: DataFrame, roles: dict[str, str] | None = None, short_rate: str = "DGS2", bond_rate: str = "DGS10") -> DataFrame:
    """K18. One feature row per day of the main index, from values known on that day.

    ``prices``: ticker, date, close; ``rates``: series_id, asof_date, value; ``breadth``: output of ``universe_breadth`` (date first).
    """
    roles = roles or STATE_ROLES
    feats = series_features(prices)
    spine = prices.where(F.col("ticker") == roles["main"]).select(F.col("date").alias("asof_date")).distinct()
    known = _latest_on(spine, feats, "ticker", list(roles.values()), "date")
    changes = series_features(rates, "series_id", "asof_date", "value").select("series_id", "asof_date", "chg_20d")
    moves = _latest_on(spine, changes, "series_id", [short_rate, bond_rate], "asof_date")
    share = _latest_on(spine, breadth.withColumn("k", F.lit("KR")), "k", ["KR"], "date")
    get = lambda role, c: F.max(F.when(F.col("ticker") == roles[role], F.col(f"f.{c}")))
    wide = known.groupBy("asof_date").agg(
        *[get(role, f"ret_{n}d").alias(f"{role}_ret_{n}d") for role, ns in (("main", (1, 5, 20, 60)), ("growth", (1, 5, 20, 60)), ("large", (20,))) for n in ns],
        *[F.coalesce(get(role, "ret_20d"), F.lit(0.0)).alias(f"{role}_ret_20d") for role in ("fx", "inverse", "bond", "gold")],
        *[get("main", c).alias(c) for c in ("vol_20d", "dd_5d", "dd_20d")], *[get(role, "rn").alias(f"__n_{role}") for role in ("main", "growth", "large")])
    rate = moves.groupBy("asof_date").agg(*[F.coalesce(F.max(F.when(F.col("series_id") == s, F.col("f.chg_20d"))), F.lit(0.0)).alias(n)
                                            for s, n in ((short_rate, "short_rate_chg"), (bond_rate, "bond_rate_chg"))])
    wide = wide.where((F.col("__n_main") >= 61) & (F.col("__n_growth") >= 61) & (F.col("__n_large") >= 21)).drop("__n_main", "__n_growth", "__n_large")
    df = star_join(wide, [(rate, ["asof_date"]), (share.select("asof_date", "f.*"), ["asof_date"])])
    return df.withColumnsRenamed({"new_highs": "highs", "new_lows": "lows"})


def state_scores(features: DataFrame, market: str = "KR") -> DataFrame:
    """K18. Component scores and state label per day."""
    cols = {c: F.col(c) for c in features.columns}
    parts = N.state_components({**cols, "regime": cols.get("regime", F.lit(None).cast("double"))})
    df = features.withColumn("market", F.lit(market)).withColumns(parts)
    return df.select("market", "asof_date", *[F.round(c, 4).alias(c) for c in parts], L.state_bucket("total_score").alias("state_label"))


def state_history(scores: DataFrame) -> DataFrame:
    """K18, W26, J26. State with previous label and direction of change."""
    ax = Axis.of("market", "asof_date")
    prev = F.lag("total_score").over(ax.by)
    return scores.select("market", "asof_date", "state_label", F.col("total_score").alias("state_score"), F.lag("state_label").over(ax.by).alias("prev_state_label"),
                         L.change_side("total_score", prev).alias("state_change_direction"))


def relative_strength(features: DataFrame) -> DataFrame:
    """K19, W31, W33. Strength z-score, rank and label of the six assets per day."""
    groups = [("KOSPI", "main"), ("KOSDAQ", "growth"), ("USDKRW", "fx"), ("BOND", "bond"), ("GOLD", "gold"), ("INVERSE", "inverse")]
    cells = F.array(*[F.struct(F.lit(n).alias("asset_group"), F.lit(i).alias("ordinal"), F.col(f"{r}_ret_20d").alias("ret_20d")) for i, (n, r) in enumerate(groups)])
    long = features.select("asof_date", F.explode(cells).alias("__x")).select("asof_date", "__x.*")
    day = Window.partitionBy("asof_date")
    spread = F.stddev_pop("ret_20d").over(day)
    z = F.coalesce(N.ratio(F.col("ret_20d") - F.avg("ret_20d").over(day), spread), F.lit(0.0))
    df = long.withColumns({"strength_score": z, "strength_rank": W.cross_rank("asof_date", "ret_20d", "ordinal")}).drop("ordinal")
    return df.withColumn("strength_label", L.ladder("strength_score", [(">=", 0.5, "강함"), ("<=", -0.5, "약함")], "중립"))
