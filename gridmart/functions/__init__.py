"""Column helpers: everything here returns a Column and stays inside Catalyst."""

from gridmart.functions.arithmetic import (
    change_pct,
    mean,
    pct_of_total,
    ratio,
    rounded,
    safe_divide,
    share_pct,
    yoy_change_pct,
)
from gridmart.functions.classify import (
    carbon_category,
    confidence_at,
    fuel_category,
    known_or,
    price_signal,
)
from gridmart.functions.periods import (
    code,
    period_date,
    period_month,
    period_year,
    trailing_period,
)

__all__ = [
    "carbon_category",
    "change_pct",
    "code",
    "confidence_at",
    "fuel_category",
    "known_or",
    "mean",
    "pct_of_total",
    "period_date",
    "period_month",
    "period_year",
    "price_signal",
    "ratio",
    "rounded",
    "safe_divide",
    "share_pct",
    "trailing_period",
    "yoy_change_pct",
]
