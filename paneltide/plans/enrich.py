"""Joining health indicators to the periods of a panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneltide.operators.relational import (
    group_periods, join_indicators, non_null_cells,
)
from paneltide.sources.odata import INDICATORS, Indicator, parse_responses, select_indicators
from paneltide.spec import PanelSpec


def enrich(
    panel: DataFrame, responses: DataFrame, spec: PanelSpec,
    indicators: Sequence[Indicator] = INDICATORS,
) -> DataFrame:
    """The (group, period) keys of a panel with one column per indicator.

    All indicators go through one scan, one reduction to the first row per key, one
    pivot and one join; an indicator without data is a null column.
    """
    rows = select_indicators(parse_responses(responses, spec), spec, indicators)
    return join_indicators(group_periods(panel, spec), rows, spec, [i.col for i in indicators])


def enrichment_report(enriched: DataFrame, indicators: Sequence[Indicator] = INDICATORS) -> DataFrame:
    """One row: keys, and cells that an indicator filled."""
    return enriched.agg(
        F.count("*").alias("n_rows"),
        non_null_cells(enriched, [i.col for i in indicators]).alias("total_entries"))
