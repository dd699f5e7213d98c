"""Default configuration: plain dicts, no loader.

Thresholds below are fixed values that must equal the reference's detector
settings for results to agree; everything else is our own default.
"""

from __future__ import annotations

import copy

# ---------------------------------------------------------------------------
# Fixed values (reference detector thresholds and symbol list).
#   symbols: btcusdt, ethusdt, solusdt
#   volume anomaly: z medium 2.5, z high 3.5, window 60 s, rolling 3600 s
#   whale: min quote volume 100000, high 500000, critical 1000000
#   spread: threshold 0.5 %, window 30 s, watermark 15 s
#   quality: DLQ retention 7 days, quality score alarm below 95
# ---------------------------------------------------------------------------
DEFAULTS: dict = {
    "symbols": ["btcusdt", "ethusdt", "solusdt"],
    "exchanges": ["binance", "coinbase"],
    "quality": {
        "dlq_retention_days": 7,
        "quality_score_alarm_threshold": 95,
        "late_seconds": 300,
        "dedup_seconds": 3600,
        "consistency_tolerance": 0.001,
        "custom_rules": [],
    },
    "volume_anomaly": {
        "z_score_medium": 2.5,
        "z_score_high": 3.5,
        "window_seconds": 60,
        "rolling_window_seconds": 3600,
        "watermark_seconds": 30,
        "min_windows": 5,
    },
    "whale_detector": {
        "min_quote_volume_usd": 100000,
        "severity_high_usd": 500000,
        "severity_critical_usd": 1000000,
    },
    "spread_calculator": {
        "spread_threshold_pct": 0.5,
        "spread_high_pct": 1.0,
        "window_seconds": 30,
        "watermark_seconds": 15,
    },
    "wallet_scorer": {"days": 30, "period_days": 1, "min_trades": 5, "high_alpha_pct": 0.95, "score_delta": 1.0},
    "labels": {"min_quote_volume_usd": 100000, "severity_high_usd": 500000},
    "flow": {"window_seconds": 300, "accumulation": 0.7, "distribution": 0.3,
             "strong_accumulation": 0.85, "strong_distribution": 0.15},
    "consensus": {"window_seconds": 300, "weights": [0.3, 0.3, 0.4], "threshold": 70, "high": 85},
    "onchain": {"large_transfer_usd": 50000, "high_transfer_usd": 1000000,
                "routers": ["uniswap", "jupiter", "sushiswap", "raydium"]},
    "dex": {"window_seconds": 60, "large_swap_usd": 100000, "high_swap_usd": 1000000,
            "liquidity_change_pct": 50.0, "liquidity_window_seconds": 60},
    "predictive": {"window_seconds": 900, "alert_p": 0.7, "update_delta": 0.1,
                   "move_pct": 2.0, "outcome_seconds": 14400},
    "backtest": {"horizons_seconds": [3600, 14400, 86400], "degradation_drop": 0.1, "date": None},
    "alerts": {"ttl_hours": 24},
}

# Module ids and detector names of the reference module registry (fixed values).
MODULES: dict = {
    "MOD-001": "volume-anomaly",
    "MOD-002": "whale-detector",
    "MOD-003": "spread-calculator",
    "MOD-004": "wallet-scorer",
    "MOD-005": "wallet-labeler",
    "MOD-006": "flow-direction",
    "MOD-007": "consensus-signal",
    "MOD-008": "onchain-ingester",
    "MOD-009": "dex-tracker",
    "MOD-010": "predictive-scorer",
    "MOD-011": "backtester",
}

# Alert type registry (fixed values): alert type, module, allowed severities.
ALERT_REGISTRY: list[tuple[str, str, str]] = [
    ("volume_spike", "MOD-001", "medium,high"),
    ("whale_trade", "MOD-002", "medium,high,critical"),
    ("spread_divergence", "MOD-003", "medium,high"),
    ("high_alpha_wallet", "MOD-004", "medium,high"),
    ("score_change", "MOD-004", "low"),
    ("known_whale_activity", "MOD-005", "medium,high"),
    ("accumulation_signal", "MOD-006", "medium,high"),
    ("distribution_signal", "MOD-006", "medium,high"),
    ("consensus_bullish", "MOD-007", "medium,high"),
    ("consensus_bearish", "MOD-007", "medium,high"),
    ("large_transfer", "MOD-008", "medium,high"),
    ("dex_swap", "MOD-008", "low,medium"),
    ("large_dex_swap", "MOD-009", "medium,high"),
    ("liquidity_change", "MOD-009", "medium,high"),
    ("high_probability_move", "MOD-010", "high"),
    ("score_update", "MOD-010", "low"),
    ("backtest_complete", "MOD-011", "low"),
    ("signal_degradation", "MOD-011", "high"),
]

# Module dependencies of the reference registry (fixed values).
DEPENDENCIES: dict = {
    "MOD-001": [], "MOD-002": [], "MOD-003": [],
    "MOD-004": [], "MOD-005": [], "MOD-006": ["MOD-002"],
    "MOD-007": ["MOD-001", "MOD-002", "MOD-006"],
    "MOD-008": [], "MOD-009": ["MOD-008"],
    "MOD-010": ["MOD-004", "MOD-007"],
    "MOD-011": ["MOD-001", "MOD-002", "MOD-003"],
}


def make_config(overrides: dict | None = None) -> dict:
    """Deep copy of DEFAULTS with a shallow per-section merge of ``overrides``."""
    cfg = copy.deepcopy(DEFAULTS)
    for key, value in (overrides or {}).items():
        if isinstance(value, dict) and isinstance(cfg.get(key), dict):
            cfg[key].update(value)
        else:
            cfg[key] = value
    return cfg
