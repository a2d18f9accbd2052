"""Lifecycle stage, revival and spike flags on hand fixtures (every CASE branch)."""

from helpers import weekly_frame

from tidemark.operators import lifecycle as L
from tidemark.operators import weekly as W


def _life(spark, rows):
    growth = W.weekly_growth(weekly_frame(spark, rows), keep_history=True)
    return {(r.spotify_id, r.country, str(r.chart_week)): r for r in L.lifecycle(growth).collect()}


def test_every_stage_in_order(spark):
    rows = [("A", "X", "2025-03-10", 500), ("A", "X", "2025-03-17", 650), ("A", "X", "2025-03-24", 625),
            ("A", "X", "2025-03-31", 450), ("A", "X", "2025-04-07", 1000), ("A", "X", "2025-07-14", 250)]
    life = _life(spark, rows)
    stages = [life[("A", "X", w)].lifecycle_stage for _, _, w, _ in rows]
    assert stages == ["Debut", "Growing", "Stable", "Declining", "Peak", "Revived"]
    assert life[("A", "X", "2025-07-14")].catalog_revival_flag is True
    assert life[("A", "X", "2025-03-17")].catalog_revival_flag is False
    assert abs(life[("A", "X", "2025-03-17")].wow_growth_rate - 0.3) < 1e-12


def test_gap_84_vs_91_days(spark):
    life = _life(spark, [("B", "X", "2025-01-06", 100), ("B", "X", "2025-03-31", 100),    # 84 days
                         ("C", "X", "2025-01-06", 100), ("C", "X", "2025-04-07", 100)])   # 91 days
    assert life[("B", "X", "2025-03-31")].lifecycle_stage != "Revived"
    assert life[("B", "X", "2025-03-31")].catalog_revival_flag is False
    assert life[("C", "X", "2025-04-07")].lifecycle_stage == "Revived"


def test_growth_thresholds_inclusive_and_peak_share(spark):
    life = _life(spark, [("G", "X", "2025-01-06", 500), ("G", "X", "2025-01-13", 600), ("G", "X", "2025-01-20", 1000),
                         ("H", "X", "2025-01-06", 1000), ("H", "X", "2025-01-13", 500), ("H", "X", "2025-01-20", 400),
                         ("P", "X", "2025-01-06", 1000), ("P", "X", "2025-01-13", 900)])
    assert life[("G", "X", "2025-01-13")].lifecycle_stage == "Growing"     # exactly +0.20
    assert life[("H", "X", "2025-01-20")].lifecycle_stage == "Declining"   # exactly -0.20
    assert life[("P", "X", "2025-01-13")].lifecycle_stage == "Peak"        # 900 >= 0.90 * 1000


def test_previous_zero_points_gives_null_growth(spark):
    life = _life(spark, [("Z", "X", "2025-01-06", 0), ("Z", "X", "2025-01-13", 5), ("Z", "X", "2025-01-20", 100)])
    row = life[("Z", "X", "2025-01-13")]
    assert row.wow_growth_rate is None and row.lifecycle_stage == "Stable"


def _spike(spark, growths):
    rows = []
    for market, g in growths.items():
        if g is None:
            rows.append(("S", market, "2025-01-13", 100))
        else:
            rows += [("S", market, "2025-01-06", 100), ("S", market, "2025-01-13", int(round(100 * (1 + g))))]
    life = _life(spark, rows)
    return {m: life[("S", m, "2025-01-13")] for m in growths}


def test_spike_cases(spark):
    assert _spike(spark, {"X": 0.60, "Y": -0.30})["X"].market_spike_flag is True
    assert _spike(spark, {"X": 0.60, "Y": 0.10})["X"].market_spike_flag is False
    assert _spike(spark, {"X": 0.60})["X"].market_spike_flag is False
    assert _spike(spark, {"X": 0.60, "Y": -0.60})["X"].market_spike_flag is False
    debut = _spike(spark, {"X": None, "Y": 0.5})
    assert debut["X"].market_spike_flag is False and debut["X"].lifecycle_stage == "Debut"
    tie = _spike(spark, {"X": 0.6, "Y": 0.0, "Z": 0.0})   # 0.6 >= 3 * 0.2 exactly
    assert tie["X"].market_spike_flag is True
    assert tie["X"].cross_market_count == 3
    assert abs(tie["X"].selected_market_avg_wow_growth - 0.2) < 1e-12


def test_window_form_equals_join_form(spark):
    from tidemark.plans.models import Models
    from conftest import SF001
    m = Models(spark, SF001)
    life = m.life.select("spotify_id", "chart_week", "cross_market_count").distinct()
    pen = L.penetration_join_form(m.growth)
    diff = life.exceptAll(pen.select("spotify_id", "chart_week", "cross_market_count"))
    assert diff.count() == 0
