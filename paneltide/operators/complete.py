"""Groups without a null value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneltide.functions.blocks import add_block
from paneltide.functions.skew import give_back
from paneltide.spec import PanelSpec


def filter_complete_series(df: DataFrame, spec: PanelSpec, unique: bool = False) -> DataFrame:
    """Rows of the groups that have no null value; gaps do not matter.

    A period may have any number of rows: nulls are counted by an aggregate, and the counts
    go back to rows that need not be gathered by group.  With ``unique`` the caller knows
    that it has one, and if a time range is declared the filter then shares the shuffle of
    the steps around it.
    """
    rows = add_block(df.where(spec.has_group()), spec)
    nulls = F.count_if(F.col(spec.value).isNull())
    if unique and spec.bounded:
        known = rows.withColumn("_nulls", nulls.over(spec.whole()))
    else:
        facts = df.where(spec.has_group()).groupBy(*spec.groups).agg(
            nulls.alias("_nulls"), F.count("*").alias("_n"))
        known = give_back(rows, facts, spec.groups, "_n")
    return known.where("_nulls = 0").select(*df.columns)
