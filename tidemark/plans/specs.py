"""Fixed values shared by the marts: series lists, weights, thresholds, horizons."""

from __future__ import annotations

# Daily and monthly macro series.
DAILY_SERIES = ["DGS3MO", "DGS2", "DGS10", "DGS30", "DFII10", "T10YIE", "VIXCLS", "BAMLH0A0HYM2", "BAMLC0A0CM",
                "DTWEXBGS", "DEXKOUS", "DCOILWTICO", "GVZCLS"]
MONTHLY_SERIES = ["FEDFUNDS", "CPIAUCSL", "CPILFESL", "PPIACO", "UNRATE", "PAYEMS", "CES0500000003"]

# Assets of the external-asset context.
CYCLICAL_SECTORS = ["XLK", "XLY", "XLI", "XLF", "XLE", "XLB", "XLC", "XLRE"]
DEFENSIVE_SECTORS = ["XLV", "XLP", "XLU"]
ASSET_CODES = ["SPY", "QQQ", "IWM", "EWY", "HYG", "LQD", "TLT", "GLD", "USO", "UUP", "VIX", "SOXX", "ACWX", "EFA", "EEM",
               "FXI", "EWJ", "EWT", "INDA", "KRE", "XHB", "IYT", "USMV", "DXY", "BTCUSD",
               *CYCLICAL_SECTORS, *DEFENSIVE_SECTORS]

# Scopes and horizons.
MARKET_SCOPES = ["ALL", "KOSPI", "KOSDAQ"]
RESEARCH_SCOPES = ["ALL", "KOSPI", "KOSDAQ", "KOSPI200"]
FORECAST_HORIZONS = {"1d": 1, "5d": 5, "20d": 20}
RESEARCH_HORIZONS = [5, 10, 20, 60]
DRAWDOWN_LIMITS = {"1d": 0.02, "5d": 0.04, "20d": 0.07}

# Weights of the baseline forecast, by horizon.
FORECAST_TERMS = ["state", "trend", "breadth", "risk_on", "risk_off", "global_risk_on", "external_asset_risk_on",
                  "external_pressure", "smart_money"]
FORECAST_WEIGHTS = {
    "1d": [0.24, 0.12, 0.10, 0.16, -0.18, 0.16, 0.18, -0.14, 0.10],
    "5d": [0.28, 0.18, 0.16, 0.15, -0.15, 0.14, 0.16, -0.12, 0.07],
    "20d": [0.30, 0.24, 0.20, 0.12, -0.12, 0.10, 0.12, -0.10, 0.04],
}

# Event flag and group of each monthly release; shock test of each daily series.
RELEASE_LAG_DAYS = 21
MONTHLY_EVENTS = {
    "CPIAUCSL": "inflation_release_flag", "CPILFESL": "inflation_release_flag", "PPIACO": "producer_price_release_flag",
    "UNRATE": "employment_release_flag", "PAYEMS": "employment_release_flag", "CES0500000003": "wage_release_flag",
    "FEDFUNDS": "policy_rate_release_flag",
}
DAILY_SHOCKS = {
    "VIXCLS": ("vix_shock_event_flag", "pct", 0.10), "DGS10": ("rate_shock_event_flag", "diff", 0.10),
    "DEXKOUS": ("fx_shock_event_flag", "pct", 0.01), "DCOILWTICO": ("commodity_shock_event_flag", "pct", 0.03),
    "BAMLH0A0HYM2": ("credit_shock_event_flag", "diff", 0.10),
}
SURPRISE_SPECS = {
    "CPIAUCSL": ("inflation", "yoy", 1.0), "CPILFESL": ("inflation", "yoy", 1.0), "PPIACO": ("inflation", "yoy", 1.0),
    "CES0500000003": ("wage", "yoy", 1.0), "PAYEMS": ("employment", "mom_diff", -1.0),
    "UNRATE": ("employment", "mom_diff", 1.0), "FEDFUNDS": ("policy", "mom_diff", 1.0),
}
SURPRISE_GROUPS = ["inflation", "employment", "policy", "wage"]

# Exposure profiles, confidence floors and the threshold grid.
DIRECTION_EXPOSURE = {"up": 1.0, "sideways": 0.5, "down": 0.0}
RULE_PROFILES = {
    "baseline_100_50_0": {"up": 1.0, "sideways": 0.5, "down": 0.0, "fallback": 0.5},
    "defensive_100_30_0": {"up": 1.0, "sideways": 0.3, "down": 0.0, "fallback": 0.3},
    "moderate_80_40_0": {"up": 0.8, "sideways": 0.4, "down": 0.0, "fallback": 0.4},
    "cash_heavy_70_20_0": {"up": 0.7, "sideways": 0.2, "down": 0.0, "fallback": 0.2},
    "up_only_100_0_0": {"up": 1.0, "sideways": 0.0, "down": 0.0, "fallback": 0.0},
}
CONFIDENCE_FLOORS = [0.0, 0.30, 0.35, 0.40, 0.45, 0.50, 0.55, 0.60]
THRESHOLD_GRID = [round(0.34 + 0.02 * i, 2) for i in range(14)]
NEAR_BEST_TOLERANCE = 0.05
