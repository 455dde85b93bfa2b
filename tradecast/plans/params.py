"""Query parameters.  Defaults fit the driver tables (orders 1995-01 … 2001-08,
2001 being the partial year); the as-of date is always a parameter, never the
clock."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Params:
    # Q07 retention: bought in ``retention_year`` but not in the next year up to ``as_of``.
    retention_year: int = 2000
    as_of: str = "2001-12-31"
    # Q10/Q14: complete years for the normal season, years with peak data.
    normal_years: tuple = (1995, 1996, 1997, 1998, 1999, 2000)
    peak_years: tuple = (1995, 1996, 1997, 1998, 1999, 2000, 2001)
    # Weeks per season band used as the weekly-mean divisor.
    normal_weeks: int = 44
    peak_weeks: int = 4
    # Q04 top-k.
    top_sites: int = 3
    # E5 top-k.
    top_products: int = 15
    # M4 split by target date.
    train_end: str = "1999-12-31"
    val_start: str = "2000-01-01"
    val_end: str = "2000-06-30"
    mid_start: str = "2000-07-01"
    mid_end: str = "2000-12-31"
    test_start: str = "2001-01-01"
    # M2 direct strategy.
    horizons: int = 12
    first_origin: int = 52
    # Asymmetric costs per unit and ship window bounds (weeks).
    cost_under_peak: float = 0.60
    cost_under_normal: float = 0.35
    cost_over: float = 0.28
    window_lo: float = -4.5
    window_hi: float = 0.5
    # Capacity model.
    daily_yield_per_area: int = 2000
    days_per_week: int = 7
    cut_factor: float = 0.85
    peak_multiplier: float = 1.8
    post_harvest_factor: float = 0.9
    # The forecasting series: a product attribute, or the product itself.
    series_col: str = "product_color"


DEFAULT = Params()
PER_PRODUCT = replace(DEFAULT, series_col="product_id")
