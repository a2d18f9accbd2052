"""Quality checks on seeded bad rows; dashboard guards and rollups."""

import datetime as dt

import pytest

from tidemark.operators import dashboard as D
from tidemark.operators import quality as Q
from tidemark.params import DashboardFilter


def test_quality_counts_seeded_failures(spark):
    df = spark.createDataFrame([("c1", "Debut"), ("c1", "Unknown"), (None, None), ("c2", "Peak")],
                               "campaign_id string, lifecycle_stage string")
    nn = Q.not_null(df, "t", ["campaign_id", "lifecycle_stage"]).collect()
    assert {r.column_name: r.failing_rows for r in nn} == {"campaign_id": 1, "lifecycle_stage": 1}
    assert Q.unique(df, "t", "campaign_id").first().failing_rows == 1
    assert Q.accepted_values(df, "t", "lifecycle_stage").first().failing_rows == 1   # null passes
    assert Q.grain(df, "t", ["campaign_id"]).first().failing_rows == 1


def test_filter_guard():
    with pytest.raises(ValueError, match="at least one market"):
        D.filter_guard(DashboardFilter(countries=()))
    with pytest.raises(ValueError, match="start and end"):
        D.filter_guard(DashboardFilter(countries=("DE",), start="2025-01-01"))
    D.filter_guard(DashboardFilter(countries=("DE",), start="2025-01-01", end="2025-02-01"))


def test_kpi_catalog(spark):
    from tidemark.operators.marts import kpi_catalog
    kpi = kpi_catalog(spark)
    rows = D.kpi_sorted(kpi).collect()
    assert len(rows) == 15 and sum(r.computed_in_project for r in rows) == 9
    tiers = [r.kpi_tier[:6] for r in rows]
    assert tiers.count("Tier 1") == 6 and tiers.count("Tier 2") == 3 and tiers.count("Tier 3") == 6
    assert Q.unique(kpi, "kpi", "kpi_name").first().failing_rows == 0


def test_dashboard_filters(spark):
    from conftest import SF001
    from tidemark.plans.models import Models
    m = Models(spark, SF001)
    life = m.life
    countries = [r.country for r in D.countries(life).collect()]
    some = DashboardFilter(countries=tuple(countries[:2]), start="1996-01-01", end="1996-12-31")
    rows = D.filter_rep(life, some).collect()
    assert rows and all(r.country in countries[:2] and 1996 == r.chart_week.year for r in rows)
    assert D.top_tracks(life).count() <= 10


def test_sort_orders_and_null_markets(spark):
    weeks = [(dt.date(2025, 6, 9), "DE", 5), (dt.date(2025, 6, 2), "FR", 7), (dt.date(2025, 6, 2), "DE", 9), (dt.date(2025, 6, 2), None, 1)]
    mkt = spark.createDataFrame(weeks, "chart_week date, country string, total_chart_points long").repartition(3)
    shown = D.filter_mkt(mkt, DashboardFilter())
    assert shown.count() == 3                      # no selection: every market with a name
    assert D.filter_mkt(mkt, DashboardFilter(countries=("FR",))).count() == 1
    series = D.market_series(shown).collect()
    assert [(r.country, r.chart_week) for r in series] == sorted((r.country, r.chart_week) for r in series)
    assert [r.country for r in D.countries(mkt).collect()] == ["DE", "FR"]
    assert D.filter_camp(mkt, DashboardFilter()).count() == 3


def test_campaign_ids_do_not_collide_beyond_999(spark):
    from conftest import SF001
    from tidemark.operators.construction import generate_campaigns
    from tidemark.plans import registry
    made = generate_campaigns(registry.tables(spark, SF001).charts, n=1200).select("campaign_id").collect()
    assert len(made) == 1200 == len({r.campaign_id for r in made})


def test_latest_week_order(spark):
    mkt = spark.createDataFrame([(dt.date(2025, 6, 9), "DE", 5), (dt.date(2025, 6, 9), "FR", 7), (dt.date(2025, 6, 2), "SE", 9)],
                                "chart_week date, country string, total_chart_points long").repartition(3)
    assert [r.country for r in D.latest_week(mkt).collect()] == ["FR", "DE"]


def test_compiled_checks_take_one_scan(spark, tmp_path):
    import collections
    import random

    from tidemark.operators import quality as Q
    rng = random.Random(4)
    pick = lambda n: rng.choice([None, *range(n)])
    data = [(pick(40), pick(3), rng.choice(["Debut", "Peak", "odd", None])) for _ in range(200)]
    spark.createDataFrame(data, "a int, b int, s string").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    checks = Q.Checks(("a", "b"), ("a",), (("s", ("Debut", "Peak")),), (("a",), ("a", "b")))
    out = Q.compiled(df, "t", checks)
    got = {(r.column_name, r.check_name): r.failing_rows for r in out.collect()}
    one, two = collections.Counter(r[0] for r in data), collections.Counter(r[:2] for r in data)
    assert got == {("a", "not_null"): one[None], ("b", "not_null"): sum(r[1] is None for r in data),
                   ("s", "accepted_values"): sum(r[2] == "odd" for r in data),
                   ("a", "unique"): sum(n > 1 for v, n in one.items() if v is not None),
                   ("a", "grain"): sum(n > 1 for n in one.values()), ("a,b", "grain"): sum(n > 1 for n in two.values())}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1
    for c in (Q.Checks(("a",)), Q.Checks(unique=("a",)), Q.Checks(accepted=(("s", ("Debut",)),))):
        assert {r.failing_rows for r in Q.compiled(df.limit(0), "t", c).collect()} == {0}


def test_quality_queries_scan_each_table_once(spark):
    from conftest import SF001

    from tidemark.plans import registry
    for key, n in (("dq_not_null", 8), ("dq_unique", 2), ("dq_accepted_values", 2), ("dq_grain", 4), ("dq_report", 8)):
        plan = registry.REG[key].build(spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") == n, key
