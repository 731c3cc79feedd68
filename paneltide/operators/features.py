"""Feature columns: lags, rolling means, period flags, yearly trend."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paneltide.functions.blocks import add_block, nearest_items, reject_duplicates, with_facts
from paneltide.functions.skew import PIECES, hashable
from paneltide.operators.status import add_d_flag, add_status_flag
from paneltide.spec import BLOCK, DEALT, PanelSpec

# The years of the pandemic flag, both included.
CORONA_YEARS = (2020, 2021)


def add_time_features(
    df: DataFrame, spec: PanelSpec, lags: Sequence[int] = (), windows: Sequence[int] = (),
    keep_groupless: bool = True,
) -> DataFrame:
    """``lag_<n>`` and ``roll_mean_<w>`` per group, counted in rows, from one shuffle.

    A rolling mean takes the row itself and the rows before it and skips nulls.  A period that
    occurs twice in a group stops the query: which of its rows is before the other is not
    defined.  Rows without a group get null; they are left out if ``keep_groupless`` is off.  They
    go through the same pass, dealt out over PIECES by their own hash, as they are no series.  The
    first rows of a block look back into the last values of earlier blocks, which travel as one
    short array per block.
    """
    if any(n < 1 for n in (*lags, *windows)):
        raise ValueError("lags and windows must be at least 1")
    depth = max([*lags, *[w - 1 for w in windows]], default=0)
    if depth == 0 and not windows:
        return df
    names = [f"lag_{n}" for n in lags] + [f"roll_mean_{w}" for w in windows]
    columns = [c for c in df.columns if c not in names]
    value = F.col(spec.value)
    known_group = spec.has_group()
    if keep_groupless:
        piece = F.pmod(F.xxhash64(*hashable(df)), F.lit(PIECES)).cast("int")
        if spec.bounded:
            df = df.withColumn(DEALT, F.when(known_group, 0).otherwise(piece))
            spec = spec.with_(group=(*spec.groups, DEALT))
        rows = add_block(df, spec)
        if not spec.bounded:
            rows = rows.withColumn(BLOCK, F.when(known_group, F.col(BLOCK)).otherwise(piece))
    else:
        rows = add_block(df.where(known_group), spec)
    window = spec.in_order()

    def by_block() -> DataFrame:
        numbered = rows.select(
            *spec.task_keys, spec.value,
            F.row_number().over(spec.backwards()).alias("_rank_from_end"))
        item = F.struct((-F.col("_rank_from_end")).alias("at"), value.alias("v"))
        tails = (
            numbered.where(F.col("_rank_from_end") <= max(depth, 1))
            .groupBy(*spec.task_keys)
            .agg(F.sort_array(F.collect_list(item)).alias("_tail"))
        )
        nearest = nearest_items(tails, spec, "_tail", max(depth, 1))
        before = F.lag("_tail", 1).over(spec.over_blocks())
        return nearest.select(*spec.task_keys, F.coalesce(
            F.transform(before, lambda x: x["v"]), F.array()).alias("_history"))

    kind = df.schema[spec.value].dataType.simpleString()
    known = with_facts(
        reject_duplicates(rows, spec).withColumn("_rank", F.row_number().over(window)), spec, by_block,
        {"_history": F.array().cast(f"array<{kind}>")})
    rank, past = F.col("_rank"), F.col("_history")

    out = known
    for n in lags:
        # Item -1 of the history is the row before the block.
        carried = F.try_element_at(past, rank - n - 1)
        out = out.withColumn(
            f"lag_{n}",
            F.when(rank > n, F.lag(spec.value, n).over(window)).otherwise(carried))
    for w in windows:
        frame = window.rowsBetween(-(w - 1), Window.currentRow)
        taken = F.greatest(F.least(F.lit(w) - rank, F.size(past)), F.lit(0))
        carried = F.filter(
            F.slice(past, F.size(past) - taken + 1, taken), lambda x: x.isNotNull())
        total = F.coalesce(F.sum(value).over(frame), F.lit(0.0)) + F.aggregate(
            carried, F.lit(0.0), lambda a, x: a + x)
        out = out.withColumn(
            f"roll_mean_{w}", F.try_divide(total, F.count(value).over(frame) + F.size(carried)))
    if keep_groupless:
        out = out.withColumns({n: F.when(known_group, F.col(n)) for n in names})
    return out.select(*columns, *names)


def add_lag_features(df: DataFrame, spec: PanelSpec, lags: Sequence[int] = (1, 2)) -> DataFrame:
    return add_time_features(df, spec, lags=lags)


def add_rolling_features(df: DataFrame, spec: PanelSpec, window: int = 3) -> DataFrame:
    return add_time_features(df, spec, windows=(window,))


def add_period_flag(
    df: DataFrame, spec: PanelSpec, flag_col: str = "Corona-Flag",
    period_range: tuple[int, int] = CORONA_YEARS,
) -> DataFrame:
    """1 if the period lies in the range, both ends included, else 0."""
    inside = F.coalesce(F.col(spec.time).between(*period_range), F.lit(False))
    return df.withColumn(flag_col, inside.cast("int"))


def build_features(df: DataFrame, spec: PanelSpec, keep_groupless: bool = True) -> DataFrame:
    """Definition flag, status flag, lags 1 and 2, and the rolling mean over 3 rows."""
    return (
        df.transform(add_d_flag, spec)
        .transform(add_status_flag, spec)
        .transform(add_time_features, spec, lags=(1, 2), windows=(3,),
                   keep_groupless=keep_groupless)
    )


def yearly_trend(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Mean and number of values over all groups, per period."""
    return (
        df.where(F.col(spec.time).isNotNull())
        .groupBy(spec.time)
        .agg(F.avg(spec.value).alias("mean"), F.count(spec.value).alias("count"))
    )
