"""All tunable numbers of the analysis in one place."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    # The calendar of the source data and the rules of the method.
    first_week: int = 9            # first and last week covered by promotion data
    last_week: int = 101
    last_day: int = 711            # "today"
    min_sale_weeks: int = 8        # a product-store needs this many weeks with a sale
    min_normal_weeks: int = 13     # and this many weeks without a promotion
    season_floor: float = 0.5
    season_cap: float = 2.0
    z95: float = 1.96
    placebo_runs: int = 20
    placebo_max_weeks: int = 10
    min_report_subcat_stores: int = 30
    min_department_subcat_stores: int = 500
    before_days: int = 56          # the 8 weeks before a campaign, and the 8 before those
    event_weeks: int = 8
    quarter_days: int = 91
    default_gap: int = 14
    min_quiet_days: int = 28
    backtest_day: int = 620
    complete_week_days: int = 7
    mover_min_sales: int = 100
    movers: int = 10
    years: int = 2
    scenarios: tuple[float, ...] = (0.10, 0.20, 0.30)
    churn_if_flagged: float = 0.32
    churn_if_not: float = 0.048
    min_cannibalised_pct: float = 30.0
    lifts: tuple[float, ...] = (0.05, 0.10, 0.15, 0.20)
    keep_rate_gain: float = 0.05
    pool_first_week: int = 94
    pool_last_week: int = 101

    @property
    def tracked_weeks(self) -> int:
        return self.last_week - self.first_week + 1
