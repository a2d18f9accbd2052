"""The model chain as lazy DataFrames: charts -> weekly -> growth -> life -> marts.

``Models`` wires the operators over one binding (the driver's tables at
``sf_dir``, or any staged chart/campaign DataFrames).  Nothing runs until an
action.  ``materialize_life`` writes the lifecycle table once into the
shared checkpoint folder so the three marts read it instead of recomputing
the chain (the reference inlines the view into each mart).
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import campaigns as C
from tidemark.operators import lifecycle as L
from tidemark.operators import marts as M
from tidemark.operators import weekly as W
from tidemark.params import DEFAULT_THRESHOLDS, Thresholds
from tidemark.session import checkpoint_dir
from tidemark.sources import binding


def _given(rows: DataFrame | Callable[[], DataFrame]) -> DataFrame:
    """Rows, or a function that is asked for them when a model first needs them."""
    return rows if isinstance(rows, DataFrame) else rows()


class Models:
    def __init__(self, spark: SparkSession, sf_dir: str | None = None, *,
                 charts: DataFrame | Callable[[], DataFrame] | None = None,
                 campaigns: DataFrame | Callable[[], DataFrame] | None = None,
                 life: DataFrame | None = None, thresholds: Thresholds = DEFAULT_THRESHOLDS):
        self.spark = spark
        self.sf_dir = sf_dir
        self.t = thresholds
        self._charts = charts
        self._campaigns = campaigns
        self._life_override = life

    # -- inputs ---------------------------------------------------------
    @cached_property
    def charts(self) -> DataFrame:
        return _given(self._charts) if self._charts is not None else binding.chart_rows(self.spark, self.sf_dir)

    @cached_property
    def campaigns(self) -> DataFrame:
        return _given(self._campaigns) if self._campaigns is not None else binding.campaign_rows(self.spark, self.sf_dir)

    # -- intermediate models -------------------------------------------
    @cached_property
    def weekly(self) -> DataFrame:
        return W.weekly_aggregates(self.charts, self.t)

    @cached_property
    def growth(self) -> DataFrame:
        return W.weekly_growth(self.weekly)

    @cached_property
    def growth_history(self) -> DataFrame:
        """Growth plus ``previous_chart_week`` (shares the LAG window)."""
        return W.weekly_growth(self.weekly, keep_history=True)

    @property
    def life(self) -> DataFrame:
        return self._life_override if self._life_override is not None else self._life_lazy

    @cached_property
    def _life_lazy(self) -> DataFrame:
        return L.lifecycle(self.growth_history, self.t)

    @property
    def growth_rates(self) -> DataFrame:
        """Key and growth rate of the lifecycle rows; charts need the columns of ``weekly.RATE_CHART_COLUMNS`` alone."""
        if self._life_override is None:
            weekly = W.weekly_aggregates(self.charts, self.t, W.RATE_WEEKLY_COLUMNS)
            return L.lifecycle(W.weekly_growth(weekly, keep_history=True, columns=W.RATE_COLUMNS), self.t, L.RATE_COLUMNS)
        return self._life_override.select(*L.RATE_COLUMNS)

    # -- marts ------------------------------------------------------------
    @property
    def rep(self) -> DataFrame:
        return M.repertoire(self.life, self.t)

    @property
    def mkt(self) -> DataFrame:
        return M.market_trends(self.life, self.t)

    @property
    def camp(self) -> DataFrame:
        return C.campaign_performance(self.campaigns, self.life, self.t)

    def kpi(self) -> DataFrame:
        return M.kpi_catalog(self.spark)

    # -- materialisation ----------------------------------------------------
    def materialize_life(self, folder: str | None = None) -> DataFrame:
        """Write the lifecycle table once and read it back.

        The folder defaults to a fresh directory under ``spark.checkpoint.dir``
        (shared storage on a cluster), so a lost executor never loses it.
        """
        base = folder or os.path.join(checkpoint_dir(self.spark), "life-" + uuid.uuid4().hex[:12])
        self._life_lazy.write.mode("overwrite").parquet(base)
        self._life_override = self.spark.read.parquet(base)
        return self._life_override
