"""Relational operators of the chart and campaign pipeline."""
