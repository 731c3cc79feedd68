"""Splitting series into blocks, and moving facts between blocks and whole series.

A series operator keeps its rows partitioned by (group, block).  What a block needs
to know about the rest of its series is computed on a *block table*: one row per
(group, block), made by a partial aggregation, windowed per group, and joined back
on (group, block).  The block table is smaller than the panel by the number of rows
per block, so a group that holds a third of all rows is still spread evenly.

In a panel with a declared time range a series is one piece, and the same facts are
window expressions over it, with no block table and no join.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paneltide.spec import BLOCK, DEALT, PanelSpec

# Block number of rows without a time: after every real block.
NO_TIME_BLOCK = 2**63 - 1
# Longest array that one step of a range expansion builds.
RANGE_STEP = 65_536


def add_block(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Rows ready to be shuffled by ``spec.task_keys``."""
    time = F.col(spec.time)
    if spec.bounded and spec.checked:
        return df
    if spec.bounded:
        first, last = spec.time_range
        outside = F.raise_error(F.concat(
            F.lit(f"period outside {first}..{last}: "), time.cast("string")))
        return df.withColumn(spec.time, F.when(
            spec.has_group() & ((time < first) | (time > last)), outside).otherwise(time))
    number = F.expr(f"cast(`{spec.time}` as bigint) div {spec.block}L")
    return df.withColumn(BLOCK, F.coalesce(number, F.lit(NO_TIME_BLOCK).cast("bigint")))


def with_facts(
    rows: DataFrame, spec: PanelSpec,
    by_block: Callable[[], DataFrame], bounded: dict[str, Column],
) -> DataFrame:
    """Add what rows have to know of their series.

    ``by_block`` makes the block table with these facts; ``bounded`` has the same facts
    as expressions for a series that is in one piece.
    """
    if spec.bounded:
        return rows.withColumns(bounded)
    return rows.join(by_block(), spec.task_keys, "left")


def spread(rows: DataFrame, facts: DataFrame, spec: PanelSpec, how: str = "left") -> DataFrame:
    """Join facts (one row per group) to rows without gathering a long group.

    The facts are first joined to the distinct blocks of each group, then to the
    rows on (group, block), so the join keys of a long series are spread as well.
    """
    if spec.bounded:
        return rows.join(facts, spec.groups, how)
    blocks = rows.select(*spec.task_keys).distinct().join(facts, spec.groups, "inner")
    return rows.join(blocks, spec.task_keys, how)


def reject_duplicates(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Fail, when the rows are read, if a (group, time) occurs twice.  Needs ``add_block``.

    Rows without a group may repeat a period.
    """
    if spec.checked:
        return df
    time = F.col(spec.time)
    group = F.concat_ws(", ", *[F.col(g).cast("string") for g in spec.groups if g != DEALT])
    message = F.concat(F.lit("duplicate period in panel: "), group, F.lit(" @ "),
                       F.coalesce(time.cast("string"), F.lit("null")))
    window = spec.in_order()
    seen = spec.has_group() & (F.row_number().over(window) > 1) & time.eqNullSafe(F.lag(spec.time).over(window))
    # A filter leaves the time column and so the sort order as they are.
    checked = df.withColumn("_seen", seen).where(
        F.when(F.col("_seen"), F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
    return checked.drop("_seen")


def nearest_items(
    blocks: DataFrame, spec: PanelSpec, items: str, n: int, later: bool = False
) -> DataFrame:
    """Replace the sorted list ``items`` of every block by the last n items up to its end.

    With ``later``, by the first n items from its start on.  Every block must have an item,
    so n blocks are enough; they are combined pairwise, in steps of 1, 2, 4, ... blocks.
    """
    window = spec.over_blocks_backwards() if later else spec.over_blocks()
    step = 1
    while step < n:
        other = F.lag(items, step).over(window)
        blocks = blocks.withColumn("_other", other)
        pair = ("_other", items) if not later else (items, "_other")
        both = F.when(F.col("_other").isNull(), F.col(items)).otherwise(F.concat(*pair))
        first = F.lit(1) if later else F.greatest(F.size("_both") - n + 1, F.lit(1))
        blocks = blocks.withColumn("_both", both).withColumn(
            items, F.slice("_both", first, F.lit(n))).drop("_other", "_both")
        step *= 2
    return blocks


def explode_range(
    df: DataFrame, start: Column, stop: Column, name: str, spec: PanelSpec
) -> DataFrame:
    """One row for every integer from ``start`` to ``stop``; none if stop < start.

    Ranges that may be long are cut into steps first, so no array is longer than RANGE_STEP.
    """
    ranges = (
        df.withColumn("_start", start.cast("bigint"))
        .withColumn("_stop", stop.cast("bigint"))
        .where(F.col("_start") <= F.col("_stop"))
    )
    if spec.bounded and spec.time_range[1] - spec.time_range[0] < RANGE_STEP:
        return ranges.withColumn(name, F.explode(F.sequence("_start", "_stop"))).drop("_start", "_stop")
    first = F.col("_start") + F.col("_step") * F.lit(RANGE_STEP).cast("bigint")
    last = F.least(first + RANGE_STEP - 1, F.col("_stop"))
    return (
        ranges.withColumn("_step", F.explode(F.expr(
            f"sequence(0L, (_stop - _start) div {RANGE_STEP}L)")))
        .withColumn(name, F.explode(F.sequence(first, last)))
        .drop("_start", "_stop", "_step")
    )
