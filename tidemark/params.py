"""Thresholds and fixed values of the analytics.

Every number that decides a classification lives here so that a caller can
tune it per run.  Comparisons against integer columns use ``Decimal`` so the
test ``points >= 0.90 * max`` is exact in Spark and in the SQL oracle alike.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal


@dataclass(frozen=True)
class Thresholds:
    # --- fixed values that must equal the reference's for equal results ---
    points_base: int = 201                      # chart points = 201 - daily rank
    peak_share: Decimal = Decimal("0.90")       # Peak: points >= 0.90 * best week
    growth_up: Decimal = Decimal("0.20")        # Growing: growth >= 0.20
    growth_down: Decimal = Decimal("-0.20")     # Declining: growth <= -0.20
    revival_gap_days: int = 90                  # Revived: gap to previous charted week > 90 days
    spike_min_growth: Decimal = Decimal("0.20")  # spike needs growth >= 0.20 ...
    spike_multiple: int = 3                     # ... and growth >= 3 x market average (> 0)
    multi_market_min: int = 5                   # cross-market count for "multi market" / Cross-Market Growth
    champion_min: int = 8                       # cross-market count for "champion"
    stream_value_eur: Decimal = Decimal("0.004")  # ROAS proxy value of one stream
    alert_multiple: int = 2                     # efficiency alert: cost > 2 x channel average
    positive_roas: int = 1                      # Positive ROAS Proxy: roas >= 1
    lift_size_floor: float = 0.01               # smallest bubble size in the spend chart
    ingest_days_back: int = 90                  # ingest window: max date - 90 days .. max date
    ingest_markets: tuple = ("DE", "FR", "IT", "GB", "US", "JP", "BR", "ES")
    # --- end of fixed values ---

    # Scale used to turn growth rates into exact decimals before summing them
    # per (item, week); makes the market average independent of summation order.
    growth_decimal_scale: int = 12


DEFAULT_THRESHOLDS = Thresholds()

# Lifecycle stages, repertoire signals and campaign signals.
LIFECYCLE_STAGES = ("Debut", "Growing", "Peak", "Declining", "Revived", "Stable")
REPERTOIRE_SIGNALS = (
    "Catalog Revival Opportunity",
    "Market Spike",
    "Cross-Market Growth",
    "Local Growth",
    "Declining Attention Needed",
    "Peak Performance",
    "Monitor",
)
CAMPAIGN_SIGNALS = ("Positive ROAS Proxy", "Efficient Growth", "High Cost Alert", "Monitor")

# Campaign channels and their cost per thousand impressions (EUR).
CHANNEL_CPM = {"Spotify Ads": 8.0, "TikTok": 6.0, "Meta": 5.0, "Editorial Push": 2.0}


@dataclass(frozen=True)
class DashboardFilter:
    """Selection of the dashboard: markets plus an inclusive chart-week range.

    ``countries=None`` selects every market (the dashboard's default
    selection); an empty tuple is rejected like the app rejects it.
    """

    countries: tuple | None = None
    start: str | None = None
    end: str | None = None

    def validate(self) -> None:
        if self.countries is not None and len(self.countries) == 0:
            raise ValueError("Please select at least one market.")
        if (self.start is None) != (self.end is None):
            raise ValueError("Please select a start and end date.")
