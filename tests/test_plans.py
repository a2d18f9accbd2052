"""Physical plan checks: pushdown, exchanges, no cartesian products."""

from conftest import SF001

from tidemark.operators import ingest as I
from tidemark.plans.models import Models
from tidemark.sources.tables import read_table


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_in_list_reaches_parquet_scan(spark):
    df = I.market_filter(read_table(spark, SF001, "nation", ["n_name"]), ["NATION_1", "NATION_2"], "n_name")
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(n_name), In(n_name" in plan or "In(n_name" in plan


def test_lifecycle_chain_exchanges(spark):
    m = Models(spark, SF001)
    plan = m.life._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # growth + history windows share the (item, market) exchange; market stats need (item, week)
    assert "hashpartitioning(spotify_id" in plan


def test_chart_rank_keeps_every_row(spark):
    """The market-day rank is native and cuts nothing: ranks are gapless per market-day."""
    from pyspark.sql import functions as F

    from tidemark.sources.binding import chart_rows
    df = chart_rows(spark, SF001)
    plan = _plan(df)
    assert "WindowGroupLimit" not in plan and "MapInArrow" not in plan
    gaps = df.groupBy("country", "snapshot_date").agg(F.max("daily_rank").alias("top"), F.count(F.lit(1)).alias("n")).where("top <> n")
    assert gaps.count() == 0


def test_scan_prunes_columns(spark):
    from tidemark.sources.binding import campaign_rows
    plan = _plan(campaign_rows(spark, SF001))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint" in plan
    assert "l_comment" not in plan and "l_returnflag" not in plan


def test_no_cross_joins_in_registered_queries(spark):
    from tidemark.plans import registry
    qs = registry.queries()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for k in sorted(qs):
            plan = _plan(qs[k](spark, SF001))
            assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, k
            assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, k   # no row UDFs
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
