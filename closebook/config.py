"""Project variables, frozen so that every plan sees the same values."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class FreshnessRule:
    source: str
    warn_after_hours: int
    error_after_hours: int


@dataclass(frozen=True)
class MartConfig:
    # Fixed values that the marts are defined by (revenue policy, scope, tiers).
    completed_statuses: tuple[str, ...] = ("shipped", "delivered")
    start_date: dt.date = dt.date(2020, 1, 1)
    # Replaces current_date() so results are repeatable.
    as_of: dt.date = dt.date(2026, 9, 1)
    # Lifetime-revenue tiers, checked top-down; anything <= 0 or null is a prospect.
    tiers: tuple[tuple[int, str], ...] = (
        (10000, "platinum"), (5000, "gold"), (1000, "silver"),
    )
    bronze_tier: str = "bronze"
    prospect_tier: str = "prospect"
    churn_lookback_months: int = 12
    churn_quiet_days: int = 90
    balance_sheet_subtypes: tuple[str, ...] = (
        "current_asset", "fixed_asset", "liability", "equity",
    )
    revenue_subtype: str = "operating_revenue"
    refund_subtype: str = "refund"
    refunded_status: str = "refunded"
    # Manual entries are posted up to this many days after their month.
    posting_lag_days: int = 7
    # A month is unusual above this multiple of the month before.
    anomaly_factor: int = 3
    budget_account: str = "REV_TOTAL"
    # SCD2 customer history: key and the columns whose change makes a version.
    snapshot_key: str = "customer_id"
    snapshot_check_cols: tuple[str, ...] = ("customer_segment", "country", "city")
    # Join work per task: an order is spread over ceil(lines / this) tasks of the
    # line-to-order join (operators/skew.py).
    rows_per_join_task: int = 10_000_000
    reconciliation_tolerance: float = 0.01
    reconciliation_high: float = 0.05
    freshness: tuple[FreshnessRule, ...] = field(default_factory=lambda: (
        FreshnessRule("orders", 24, 48),
        FreshnessRule("gl_entries", 168, 336),
    ))


DEFAULT_CONFIG = MartConfig()
