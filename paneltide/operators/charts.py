"""The tables behind the charts, for all groups at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneltide.operators.features import CORONA_YEARS, yearly_trend
from paneltide.operators.gaps import global_grid
from paneltide.spec import PanelSpec


def one_group(df: DataFrame, spec: PanelSpec, *group: object) -> DataFrame:
    """Rows of one group; reading them fails if there are none."""
    wanted = dict(zip(spec.groups, group, strict=True))
    rows = df
    for column, value in wanted.items():
        rows = rows.where(F.col(column) == F.lit(value))
    missing = F.raise_error(F.lit(f"no rows for {wanted}")).cast("boolean")
    # An empty slice has no row that could fail, so the check sits on a one-row aggregate.
    check = rows.agg(F.when(F.count("*") == 0, missing).otherwise(F.lit(True)).alias("ok"))
    return rows.where(check.scalar())


def gap_series(
    df: DataFrame, spec: PanelSpec,
    period_range: tuple[int, int] | None = None,
    value_range: tuple[float, float] | None = None,
) -> DataFrame:
    """Every group on the common time axis, null where nothing is observed, with limits.

    Pass the rows of one group together with the range of all to draw a single chart.
    """
    known = df.where(F.col(spec.time).isNotNull())
    if period_range is None:
        x = (known.agg(F.min(spec.time)).scalar(), known.agg(F.max(spec.time)).scalar())
    else:
        x = tuple(F.lit(b) for b in period_range)
    if value_range is None:
        y = (df.agg(F.min(spec.value)).scalar(), df.agg(F.max(spec.value)).scalar())
    else:
        y = tuple(F.lit(float(b)) for b in value_range)
    return global_grid(df, spec, period_range).select(
        *spec.keys, spec.value,
        x[0].alias("x_min"), x[1].alias("x_max"), y[0].alias("y_min"), y[1].alias("y_max"))


def break_series(
    df: DataFrame, spec: PanelSpec, breaks: DataFrame, **limits: object
) -> DataFrame:
    """``gap_series`` with ``is_break_year``; ``breaks`` has one row per (group, period)."""
    marks = breaks.select(*spec.keys).distinct().withColumn("_mark", F.lit(1))
    return gap_series(df, spec, **limits).join(marks, spec.keys, "left").withColumn(
        "is_break_year", F.coalesce("_mark", F.lit(0))).drop("_mark")


def trend_series(
    df: DataFrame, spec: PanelSpec, period_range: tuple[int, int] | None = CORONA_YEARS
) -> DataFrame:
    """Yearly mean and count, with a mark on the periods of the shaded range."""
    trend = yearly_trend(df, spec)
    marked = F.lit(False) if period_range is None else F.col(spec.time).between(*period_range)
    return trend.withColumn("in_range", marked.cast("int"))
