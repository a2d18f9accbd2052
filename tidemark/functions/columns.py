"""Metric and classification expressions of the chart and campaign models."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.params import DEFAULT_THRESHOLDS, Thresholds

__all__ = [
    "col_", "week_of", "chart_points", "growth_rate", "lifecycle_stage",
    "catalog_revival_flag", "market_spike_flag", "repertoire_signal",
    "cost_per_stream", "roas_proxy", "lift_vs_control", "release_age_days",
    "lift_bubble_size", "campaign_efficiency_alert", "campaign_performance_signal",
    "growth_as_decimal", "dec",
]


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dec(value) -> Column:
    """Exact decimal literal (keeps integer comparisons exact)."""
    return F.lit(value)


def week_of(d) -> Column:
    """Monday of the week of a DATE (``DATE_TRUNC('week', d)`` as DATE)."""
    return F.trunc(col_(d), "week")


def chart_points(rank="daily_rank", t: Thresholds = DEFAULT_THRESHOLDS) -> Column:
    return F.lit(t.points_base) - col_(rank)


def growth_rate(points="weekly_chart_points", prev="previous_week_chart_points") -> Column:
    """(points - prev) / prev as DOUBLE; null when prev is null or 0."""
    p, q = col_(points), col_(prev)
    return F.when(q.isNull() | (q == 0), F.lit(None).cast("double")) \
        .otherwise((p - q).cast("double") / q.cast("double"))


def growth_as_decimal(g="wow_growth_rate", t: Thresholds = DEFAULT_THRESHOLDS) -> Column:
    """Growth rounded to a fixed scale as an exact decimal.

    Sums of these are independent of summation order, so the market average
    and the spike test give the same answer on every partitioning.
    """
    s = t.growth_decimal_scale
    return F.round(col_(g), s).cast(f"decimal({12 + s},{s})")


def lifecycle_stage(points="weekly_chart_points", prev_points="previous_week_chart_points",
                    gap_days="gap_days", max_points="max_weekly_chart_points",
                    growth="wow_growth_rate", t: Thresholds = DEFAULT_THRESHOLDS) -> Column:
    """First match wins: Debut, Revived, Peak, Growing, Declining, Stable."""
    g = col_(growth)
    return (F.when(col_(prev_points).isNull(), "Debut")
            .when(col_(gap_days) > t.revival_gap_days, "Revived")
            .when(col_(points) >= dec(t.peak_share) * col_(max_points), "Peak")
            .when(g >= dec(t.growth_up), "Growing")
            .when(g <= dec(t.growth_down), "Declining")
            .otherwise("Stable"))


def catalog_revival_flag(gap_days="gap_days", t: Thresholds = DEFAULT_THRESHOLDS) -> Column:
    return F.coalesce(col_(gap_days) > t.revival_gap_days, F.lit(False))


def market_spike_flag(growth="wow_growth_rate", growth_dec="_growth_dec",
                      market_sum="_market_growth_sum", market_n="_market_growth_n",
                      t: Thresholds = DEFAULT_THRESHOLDS) -> Column:
    """growth >= 0.20 AND avg > 0 AND growth >= 3 * avg, never null.

    ``avg`` = market_sum / market_n (own market included); the last test is
    evaluated as ``n * growth >= 3 * sum`` on exact decimals.
    """
    cond = ((col_(growth) >= dec(t.spike_min_growth))
            & (col_(market_sum) > 0)
            & (col_(market_n) * col_(growth_dec) >= F.lit(t.spike_multiple) * col_(market_sum)))
    return F.coalesce(cond, F.lit(False))


def repertoire_signal(stage="lifecycle_stage", revival="catalog_revival_flag",
                      spike="market_spike_flag", markets="cross_market_count",
                      t: Thresholds = DEFAULT_THRESHOLDS) -> Column:
    s = col_(stage)
    return (F.when(col_(revival) == F.lit(True), "Catalog Revival Opportunity")
            .when(col_(spike) == F.lit(True), "Market Spike")
            .when((s == "Growing") & (col_(markets) >= t.multi_market_min), "Cross-Market Growth")
            .when(s == "Growing", "Local Growth")
            .when(s == "Declining", "Declining Attention Needed")
            .when(s == "Peak", "Peak Performance")
            .otherwise("Monitor"))


def cost_per_stream(spend="spend_eur", streams="attributed_streams") -> Column:
    return col_(spend).cast("double") / F.nullif(col_(streams), F.lit(0)).cast("double")


def roas_proxy(spend="spend_eur", streams="attributed_streams",
               t: Thresholds = DEFAULT_THRESHOLDS) -> Column:
    value = (col_(streams) * dec(t.stream_value_eur)).cast("double")
    return value / F.nullif(col_(spend).cast("double"), F.lit(0.0))


def lift_vs_control(own="campaign_market_wow_growth", control="control_market_avg_wow_growth") -> Column:
    return col_(own) - col_(control)


def release_age_days(week="chart_week", release="album_release_date") -> Column:
    return F.datediff(col_(week), col_(release))


def lift_bubble_size(lift="lift_vs_control", t: Thresholds = DEFAULT_THRESHOLDS) -> Column:
    return F.greatest(F.abs(F.coalesce(col_(lift).cast("double"), F.lit(0.0))), F.lit(t.lift_size_floor))


def campaign_efficiency_alert(cps="cost_per_stream", bench="channel_avg_cost_per_stream",
                              t: Thresholds = DEFAULT_THRESHOLDS) -> Column:
    return F.coalesce(col_(cps) > F.lit(t.alert_multiple) * col_(bench), F.lit(False))


def campaign_performance_signal(roas="roas_proxy", lift="lift_vs_control", cps="cost_per_stream",
                                bench="channel_avg_cost_per_stream",
                                t: Thresholds = DEFAULT_THRESHOLDS) -> Column:
    return (F.when(col_(roas) >= t.positive_roas, "Positive ROAS Proxy")
            .when((col_(lift) > 0) & (col_(cps) <= col_(bench)), "Efficient Growth")
            .when(col_(cps) > F.lit(t.alert_multiple) * col_(bench), "High Cost Alert")
            .otherwise("Monitor"))
