"""Imputation per group: linear by row position, and polynomial or spline by time."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paneltide.functions import bspline
from paneltide.functions.blocks import add_block, nearest_items, reject_duplicates, with_facts
from paneltide.functions.bspline import HALO, interpolate, smooth
from paneltide.functions.materialize import cut
from paneltide.spec import BLOCK, PanelSpec

# Above this degree smoothing splines are not defined, and the line is taken instead.
MAX_ORDER = 5

# Curves beyond the polynomial: through all values, or smoothing, as close as the allowance asks for.
CURVES = {"through": interpolate, "smooth": smooth}
# Longest series, in rows, that one task smooths where no time range is declared.
WHOLE = 65_536

# Executors get the spline code with the task, so they need not have this package.
cloudpickle.register_pickle_by_value(bspline)


def _linear_values(rows: DataFrame, spec: PanelSpec) -> DataFrame:
    """Rows with ``_linear``: the value on the line between the neighbours.

    Places are counted in rows, not in periods.  Before the first value and after the
    last one that value itself is taken.
    """
    value, window, back = F.col(spec.value), spec.in_order(), spec.backwards()
    rank = F.row_number().over(window)
    point = f"struct<at:bigint,v:{rows.schema[spec.value].dataType.simpleString()}>"

    def by_block() -> DataFrame:
        ranked = rows.select(*spec.task_keys, spec.value, rank.alias("_rank"))
        valued = F.when(value.isNotNull(), F.col("_rank"))
        edges = ranked.groupBy(*spec.task_keys).agg(
            F.count("*").alias("_rows"),
            F.min(valued).alias("_first_at"), F.min_by(spec.value, valued).alias("_first"),
            F.max(valued).alias("_last_at"), F.max_by(spec.value, valued).alias("_last"),
        )
        earlier = spec.over_blocks().rowsBetween(Window.unboundedPreceding, -1)
        later = spec.over_blocks_backwards().rowsBetween(Window.unboundedPreceding, -1)

        def place(at: str, v: str) -> Column:
            return F.when(F.col(v).isNotNull(), F.struct(
                (F.col("_offset") + F.col(at)).alias("at"), F.col(v).alias("v")))

        return (
            edges.withColumn("_offset", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
            .withColumn("_before", F.last(place("_last_at", "_last"), True).over(earlier))
            .withColumn("_after", F.last(place("_first_at", "_first"), True).over(later))
            .select(*spec.task_keys, "_offset", "_before", "_after")
        )

    to_here = (Window.unboundedPreceding, Window.currentRow)
    own = F.when(value.isNotNull(), F.struct(F.col("_at").alias("at"), value.alias("v")))
    nothing = F.lit(None).cast(point)
    near = (
        with_facts(rows.withColumn("_rank", rank), spec, by_block, {
            "_offset": F.lit(0).cast("bigint"), "_before": nothing, "_after": nothing})
        .withColumn("_at", F.col("_offset") + F.col("_rank"))
        .withColumn("_own", own)
        .withColumn("_p", F.coalesce(F.last("_own", True).over(window.rowsBetween(*to_here)), "_before"))
        .withColumn("_n", F.coalesce(F.last("_own", True).over(back.rowsBetween(*to_here)), "_after"))
    )
    slope = (F.col("_n.v") - F.col("_p.v")) / (F.col("_n.at") - F.col("_p.at"))
    line = (
        F.when(value.isNotNull(), value)
        .when(F.col("_p").isNull(), F.col("_n.v"))
        .when(F.col("_n").isNull(), F.col("_p.v"))
        .otherwise(F.col("_p.v") + slope * (F.col("_at") - F.col("_p.at")))
    )
    return near.withColumn("_linear", line)


def interpolate_linear(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Nulls replaced by linear interpolation; ``was_filled`` marks them.

    Existing rows only: fill the time axis first if gaps are to be imputed.
    """
    rows = reject_duplicates(add_block(df.where(spec.has_group()), spec), spec)
    filled = F.col(spec.value).isNull() & F.col("_linear").isNotNull()
    return _linear_values(rows, spec).select(*[
        F.col("_linear").alias(c) if c == spec.value else F.col(c) for c in df.columns
    ], filled.alias("was_filled"))


def fill_linear(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """``interpolate_linear`` without the rows that stay null."""
    return interpolate_linear(df, spec).dropna(subset=[spec.value])


def filled_points(filled: DataFrame, spec: PanelSpec) -> DataFrame:
    """The imputed (group, period, value) of a filled panel."""
    return filled.where("was_filled").select(*spec.keys, spec.value)


def scaled(time: Column) -> Column:
    """A time as a place between -1 and 1 in its series, from ``_lo`` to ``_hi``."""
    middle, half = (F.col("_lo") + F.col("_hi")) / 2, F.greatest((F.col("_hi") - F.col("_lo")) / 2, F.lit(0.5))
    return (time - middle) / half


def legendre(x: Column, order: int) -> list[Column]:
    basis = [F.lit(1.0), x]
    for i in range(1, order):
        basis.append(((2 * i + 1) * x * basis[i] - i * basis[i - 1]) / (i + 1))
    return basis[:order + 1]


def products(order: int) -> dict[str, Column]:
    """Sums of products of the basis ``_b<i>`` with itself and with ``_y``."""
    terms = range(order + 1)
    return {
        "_yy": F.sum(F.col("_y") * F.col("_y")),
        **{f"_r{i}": F.sum(F.col(f"_b{i}") * F.col("_y")) for i in terms},
        **{f"_g{i}{j}": F.sum(F.col(f"_b{i}") * F.col(f"_b{j}")) for i in terms for j in range(i + 1)},
    }


def solve(sums: DataFrame, order: int) -> DataFrame:
    """Adds the coefficients ``_c<i>`` of the least-squares polynomial, and ``_path``.

    The normal equations are solved by a Cholesky factor l and the forward solution z,
    column by column.  Terms above ``_degree`` are left out.
    """
    terms = range(order + 1)

    def total(columns: list[Column]) -> Column:
        return sum(columns[1:], columns[0]) if columns else F.lit(0.0)

    for j in terms:
        used = F.col("_degree") >= j
        pivot = F.col(f"_g{j}{j}") - total([F.col(f"_l{j}{k}") * F.col(f"_l{j}{k}") for k in range(j)])
        sums = sums.withColumn(f"_l{j}{j}", F.when(used, F.sqrt(pivot)).otherwise(1.0))
        rest = F.col(f"_r{j}") - total([F.col(f"_l{j}{k}") * F.col(f"_z{k}") for k in range(j)])
        sums = sums.withColumns({
            f"_z{j}": F.when(used, rest / F.col(f"_l{j}{j}")).otherwise(0.0),
            **{
                f"_l{i}{j}": (
                    F.col(f"_g{i}{j}")
                    - total([F.col(f"_l{i}{k}") * F.col(f"_l{j}{k}") for k in range(j)])
                ) / F.col(f"_l{j}{j}")
                for i in range(j + 1, order + 1)
            },
        })
    for j in reversed(terms):
        higher = total([F.col(f"_l{i}{j}") * F.col(f"_c{i}") for i in range(j + 1, order + 1)])
        sums = sums.withColumn(f"_c{j}", F.when(
            F.col("_degree") >= j, (F.col(f"_z{j}") - higher) / F.col(f"_l{j}{j}")).otherwise(0.0))
    residual = F.col("_yy") - total([F.col(f"_z{j}") * F.col(f"_z{j}") for j in terms])
    smooth = (F.col("_count") <= F.col("_degree") + 1) | (residual <= F.col("_count"))
    return sums.withColumn("_path", F.when(smooth, "poly").otherwise("spline"))


def _halo(rows: DataFrame, spec: PanelSpec) -> DataFrame:
    """Up to HALO values right before and right after every block, one row per block."""
    ends = rows.select(
        *spec.task_keys, spec.time, spec.value,
        F.count(spec.value).over(spec.in_order()).alias("_nth"),
        F.count(spec.value).over(spec.backwards()).alias("_nth_back"))
    valued = F.col(spec.value).isNotNull()
    point = F.struct(F.col(spec.time).cast("double").alias("t"), F.col(spec.value).alias("v"))
    blocks = cut(ends.groupBy(*spec.task_keys).agg(
        F.sort_array(F.collect_list(F.when(valued & (F.col("_nth") <= HALO), point))).alias("_head"),
        F.sort_array(F.collect_list(F.when(valued & (F.col("_nth_back") <= HALO), point))).alias("_tail")))
    # Blocks without a value take no part in the lists, but get the nearest ones.
    filled, empty = blocks.where(F.size("_head") > 0), blocks.where(F.size("_head") == 0)
    nearest = nearest_items(nearest_items(filled, spec, "_tail", HALO), spec, "_head", HALO, later=True)
    nothing = F.lit(None).cast(blocks.schema["_head"].dataType)
    every = nearest.union(empty.select(*spec.task_keys, nothing, nothing))
    others = (Window.unboundedPreceding, -1)
    before = F.last("_tail", True).over(spec.over_blocks().rowsBetween(*others))
    after = F.last("_head", True).over(spec.over_blocks_backwards().rowsBetween(*others))
    return every.select(*spec.task_keys, *[
        F.coalesce(side, F.array()).alias(name) for side, name in ((before, "_before"), (after, "_after"))])


def _series_by_series(spec: PanelSpec, order: int, curve: str, by: list[str], around: Sequence[str] = ()):
    """Fills the nulls of all series whose rows are marked ``_spline``, in rows sorted by the columns ``by``.

    With ``around`` they are blocks of series, and the first row of a block has in these columns
    the values around it.
    """
    along = CURVES[curve]
    time, value = spec.time, spec.value
    extra = [*around, *[k for k in by if k == BLOCK]]

    def starts(rows: pa.Table) -> np.ndarray:
        changed = np.zeros(rows.num_rows, bool)
        changed[:1] = True
        for key in by:
            keys = rows[key].combine_chunks()
            changed[1:] |= pc.fill_null(pc.not_equal(keys[1:], keys[:-1]), True).to_numpy(zero_copy_only=False)
        return np.flatnonzero(changed)

    def filled(rows: pa.Table, at: np.ndarray) -> pa.Table:
        marked = rows["_spline"].to_numpy()
        if marked.any():
            t = rows[time].cast(pa.float64()).to_numpy()
            v = rows[value].cast(pa.float64()).to_numpy().copy()
            for a, z in zip(at, [*at[1:], rows.num_rows]):
                here = a + np.flatnonzero(marked[a:z])
                known = here[~np.isnan(v[here])]
                unknown = here[np.isnan(v[here])]
                if len(unknown):
                    x, y = [t[known]], [v[known]]
                    for side in around:
                        points = rows[side].slice(a, 1).combine_chunks().flatten()
                        x.append(points.field("t").to_numpy(zero_copy_only=False))
                        y.append(points.field("v").cast(pa.float64()).to_numpy(zero_copy_only=False))
                    x, y = np.concatenate(x), np.concatenate(y)
                    in_time = np.argsort(x)
                    v[unknown] = along(x[in_time], y[in_time], order, t[unknown])
            place = rows.schema.get_field_index(value)
            field = rows.schema.field(place)
            rows = rows.set_column(place, field, pa.array(v, field.type, from_pandas=True))
        return rows.drop_columns(["_spline", *extra])

    def task(batches):
        rest = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if rest is None else pa.concat_tables([rest, rows])
            if rows.num_rows == 0:
                continue
            at = starts(rows)
            # The last series may go on in the next batch.
            rest = rows.slice(at[-1])
            if at[-1]:
                yield from filled(rows.slice(0, at[-1]), at[:-1]).to_batches()
        if rest is not None and rest.num_rows:
            yield from filled(rest, np.array([0])).to_batches()

    return task


def interpolate_spline(
    df: DataFrame, spec: PanelSpec, order: int = 3, too_few: str = "linear", curve: str = "through"
) -> DataFrame:
    """Nulls replaced by a smooth curve over time; ``fill_path`` says which one.

    ``poly``: the least-squares polynomial of degree ``min(order, values - 1)`` if its
    squared residuals sum up to at most the number of values, which is where a smoothing
    spline with that allowance stops as well.  ``spline``: else the spline through all
    values; or ``smooth``, if ``curve`` is ``smooth``: the spline with the smallest jumps of
    its highest derivative whose squared residuals are the number of values.  ``linear``: the only value of its group, unless ``too_few`` is ``none``; and
    the line by position if ``order`` and the values ask for a degree above MAX_ORDER.
    Rows without a period have no place on a curve and stay null (``none``).

    Without a declared time range small tables, of one row per block, are written when this
    is called, and series of more than WHOLE rows are not smoothed: their curve goes through
    all values.
    """
    if curve not in CURVES:
        raise ValueError(f"curve must be one of {tuple(CURVES)}")
    if order < 1:
        raise ValueError("order must be at least 1")
    too_high, order = order > MAX_ORDER, min(order, MAX_ORDER)
    if too_few not in ("linear", "none"):
        raise ValueError("too_few must be 'linear' or 'none'")
    value, here = F.col(spec.value), F.col(spec.time).cast("double")
    rows = add_block(df.where(spec.has_group()), spec)
    usable = value.isNotNull() & here.isNotNull()
    when_usable, whole = F.when(usable, here), spec.whole()
    facts = {
        "_nulls": F.count_if(value.isNull()),
        "_count": F.count(when_usable),
        "_lo": F.min(when_usable), "_hi": F.max(when_usable),
        "_sum": F.sum(F.when(usable, value)),
    }

    def by_block() -> DataFrame:
        blocks = rows.groupBy(*spec.task_keys).agg(*[e.alias(n) for n, e in facts.items()])
        combine = {"_lo": F.min, "_hi": F.max}
        return blocks.select(*spec.task_keys, *[
            combine.get(n, F.sum)(n).over(whole).alias(n) for n in facts])

    def placed(known: DataFrame) -> DataFrame:
        return known.withColumns({
            "_x": scaled(here),
            "_mean": F.try_divide("_sum", "_count"),
            "_degree": F.least(F.lit(order), F.col("_count") - 1),
        }).withColumn("_curved", (F.col("_nulls") > 0) & (F.col("_count") >= 2))

    def based(known: DataFrame) -> DataFrame:
        """The basis and the centred value; null, and so no part of a sum, without a value."""
        return known.withColumns({
            "_y": F.when(usable, value - F.col("_mean")),
            **{f"_b{i}": F.when(usable, b) for i, b in enumerate(legendre(F.col("_x"), order))},
        })

    coefficients = [f"_c{i}" for i in range(order + 1)]
    checked = reject_duplicates(rows, spec)
    if too_high:
        checked = _linear_values(checked, spec).select(*rows.columns, "_linear")
    if spec.bounded:
        known = placed(checked.withColumns({n: e.over(whole) for n, e in facts.items()}))
        sums = based(known).withColumns({n: e.over(whole) for n, e in products(order).items()})
        # Window results are taken as they are, so the solution is not worked out again in
        # every expression that uses it.
        solved = solve(sums, order).withColumns({
            n: F.max(n).over(whole) for n in (*coefficients, "_path")})
    else:
        # Each branch below needs the facts of every block, so this small table is written.
        blocks = cut(by_block())
        points = placed(rows.join(blocks, spec.task_keys, "inner").where(usable)).where("_curved")
        per_group = based(points).groupBy(*spec.groups).agg(
            F.max("_degree").alias("_degree"), F.max("_count").alias("_count"),
            *[e.alias(n) for n, e in products(order).items()])
        fits = solve(per_group, order).select(*spec.groups, *coefficients, "_path")
        block_facts = cut(blocks.join(fits, spec.groups, "left"))
        solved = placed(checked.join(block_facts, spec.task_keys, "left"))

    unknown = value.isNull() & here.isNotNull()
    single = F.lit(too_few == "linear") & (F.col("_nulls") > 0) & (F.col("_count") == 1)
    by_line = F.lit(too_high) & F.col("_curved") & (F.col("_count") > MAX_ORDER + 1)
    path = F.when(by_line, "line").when(F.col("_curved"), F.col("_path")).when(single, "linear").otherwise("none")
    line = F.col("_linear") if too_high else F.lit(None).cast("double")
    polynomial = F.col("_mean") + sum(
        (F.col(c) * b for c, b in zip(coefficients, legendre(F.col("_x"), order))), F.lit(0.0))
    planned = solved.withColumn("_plan", path)
    on_spline = (F.col("_plan") == "spline") & here.isNotNull()
    columns = [
        F.when(unknown & (F.col("_plan") == "poly"), polynomial)
        .when(unknown & (F.col("_plan") == "linear"), F.col("_mean"))
        .when(unknown & (F.col("_plan") == "line"), line)
        .otherwise(value).cast(df.schema[c].dataType).alias(c) if c == spec.value else F.col(c) for c in df.columns]
    drawn = "smooth" if curve == "smooth" else "spline"
    named = F.when(unknown, F.when(F.col("_plan") == "line", "linear").when(F.col("_plan") == "spline", drawn)
                   .otherwise(F.col("_plan"))).otherwise("none")

    shape = df.withColumn("fill_path", F.lit("")).schema

    def walked(marked: DataFrame, kind: str, by: list[str], around: Sequence[str] = ()) -> DataFrame:
        ordered = marked.sortWithinPartitions(*by, F.col(spec.time).asc_nulls_last())
        return ordered.mapInArrow(_series_by_series(spec, order, kind, by, around), shape)

    if spec.bounded:
        # One pass: the windows have put every series together, in order of time.
        result = walked(planned.select(*columns, named.alias("fill_path"), on_spline.alias("_spline")), curve, spec.groups)
        return result.withColumn("was_filled", F.col("fill_path") != "none")
    smoothed = F.coalesce((F.lit(curve) == "smooth") & (F.col("_nulls") + F.col("_count") <= WHOLE), F.lit(False))
    through = on_spline & ~smoothed
    # One pass as well: the values around a block come with its facts and stay on its first row.
    near = _halo(planned.where(through).select(*rows.columns), spec)
    beside = placed(checked.join(block_facts.join(near, spec.task_keys, "left"), spec.task_keys, "left")).withColumn("_plan", path)
    first = F.row_number().over(spec.in_order()) == 1
    sides = ["_before", "_after"]
    pieces = beside.withColumn("_first", first).where(~(on_spline & smoothed)).select(
        *columns, BLOCK, F.when(unknown & through, "spline").otherwise(named).alias("fill_path"), through.alias("_spline"),
        *[F.when(F.col("_first"), F.col(side)).alias(side) for side in sides])
    result = walked(pieces, "through", spec.task_keys, sides)
    if curve == "smooth":
        # The work is heavy for its bytes, so its tasks are not put together by their size.
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        whole_series = planned.where(on_spline & smoothed).select(*columns, named.alias("fill_path"), on_spline.alias("_spline"))
        result = result.union(walked(whole_series.repartition(tasks, *spec.groups), curve, spec.groups))
    return result.withColumn("was_filled", F.col("fill_path") != "none")


def fill_spline(df: DataFrame, spec: PanelSpec, order: int = 3, curve: str = "through") -> DataFrame:
    """``interpolate_spline`` without the rows that stay null; one value fills nothing."""
    return interpolate_spline(df, spec, order, "none", curve).dropna(subset=[spec.value])
