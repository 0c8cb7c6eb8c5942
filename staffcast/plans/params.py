"""Settings of a plan."""

from __future__ import annotations

from dataclasses import dataclass

from staffcast.operators.capacity import TICKETS_PER_HOUR
from staffcast.operators.forecasts import MIN_DAYS, MIN_MONTHS

# Default scope of a plan.
VERTICALS = ("Payments", "Partners", "Hospitality")
EXCLUDED_TOKENS = ("PROJ", "DIST", "KEY", "PROXIMIS")


@dataclass(frozen=True)
class PlanParams:
    """``as_of`` (ISO date) replaces the clock, so a run can be repeated exactly.

    ``uplift_by_calls`` adds calls not indexed to the monthly actuals before the
    rates are taken; off by default because the calls are added again in the
    workload. ``forecast_base`` is the column shown as "Forecast".
    ``fit_series=False`` repeats the last week and holds the last backlog value
    instead of fitting.
    """

    as_of: str
    verticals: tuple[str, ...] | None = VERTICALS
    exclude_tokens: tuple[str, ...] = EXCLUDED_TOKENS
    horizon_days: int = 365
    horizon_months: int = 12
    min_days: int = MIN_DAYS
    min_months: int = MIN_MONTHS
    fit_series: bool = True
    uplift_by_calls: bool = False
    deflection_zero_as: float | None = None
    tickets_per_hour: float = TICKETS_PER_HOUR
    productivity_from_agents: bool = True
    forecast_base: str = "forecast_p50"
    board_first: str | None = None
    board_last: str | None = None
    board_zero_fill: bool = False

    @property
    def year(self) -> int:
        return int(self.as_of[:4])

    @property
    def board_range(self) -> tuple[str, str]:
        """First and last month of the boards: January of this year to February of the next, unless given."""
        return self.board_first or f"{self.year}-01-01", self.board_last or f"{self.year + 1}-02-01"

    @property
    def board_suffix(self) -> str:
        """Two digits of each year of the board range, e.g. ``2627``."""
        return "".join(month[2:4] for month in self.board_range)
