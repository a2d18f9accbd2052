"""tidemark — chart and campaign analytics on Spark DataFrames.

Daily "item x market x rank" tables are staged, rolled up by week, scored
for week-over-week growth, classified into lifecycle stages, flagged for
market spikes and catalogue revivals, and summarised into dashboard marts.
Campaign rows are scored for cost per stream, return on spend and lift
against control markets.  Everything is a lazy ``DataFrame -> DataFrame``
function built from native Spark expressions.
"""

from tidemark.params import Thresholds, DEFAULT_THRESHOLDS

__all__ = ["Thresholds", "DEFAULT_THRESHOLDS"]
