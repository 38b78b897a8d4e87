"""Parameters of the models: thresholds, as-of dates and the calendar bounds."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date
from decimal import Decimal


@dataclass(frozen=True)
class Settings:
    # The defaults every model uses unless told otherwise.
    spine_start: date = date(2023, 1, 1)
    spine_end: date = date(2024, 12, 31)
    as_of: date = date(2024, 12, 31)
    active_since: date = date(2024, 10, 1)
    lapsing_since: date = date(2024, 1, 1)
    match_threshold: Decimal = Decimal("1.00")
    warn_threshold: Decimal = Decimal("100.00")
    low_stock_below: int = 10
    high_value_from: int = 1000
    medium_value_from: int = 300
    fiscal_year_start_month: int = 1
    low_volume_share: Decimal = Decimal("0.70")
    refund_rate_target: float = 0.03
    on_time_target: float = 0.95

    def but(self, **changes) -> Settings:
        return replace(self, **changes)
