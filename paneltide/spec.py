"""The description of a panel that every operator takes."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

# Column that holds the block number of a row while an operator works on it.
BLOCK = "_block"
# Column that deals out rows without a group while an operator works on them.
DEALT = "_dealt"


@dataclass(frozen=True)
class PanelSpec:
    """Names the columns of a panel and says how long its series may get.

    ``group`` is one column or several; ``time`` is any integral axis (year, month
    number, day number).  There are two ways to run a series operator:

    * ``time_range=(first, last)`` declares a time axis.  With one row per (group, time)
      it bounds the rows of a series, so whole series are shuffled by group once, and
      operators in a row share that shuffle.  Rows outside the range and repeated
      periods stop the query; nothing is dropped.
    * Without it series may have any length.  Rows are partitioned by (group, time div
      ``block``), so no series has to fit in one task, and what crosses a block border
      is passed on as one small row per block.
    """

    group: str | tuple[str, ...] = "REF_AREA"
    time: str = "TIME_PERIOD"
    value: str = "OBS_VALUE"
    status: tuple[str, ...] = ("OBS_STATUS", "OBS_STATUS2", "OBS_STATUS3")
    time_range: tuple[int, int] | None = None
    block: int = 65_536
    # Longest gap that is filled with rows, and longest axis of a grid; a longer one, as from a
    # mistyped period, stops the query.
    max_span: int = 10_000_000
    # Rows are known to be unique and in range, as after filling the time axis.
    checked: bool = False

    def __post_init__(self) -> None:
        if self.block < 1:
            raise ValueError("block must be at least 1")
        if self.time_range is not None and self.time_range[0] > self.time_range[1]:
            raise ValueError("time_range must be (first, last)")

    def with_(self, **changes: object) -> PanelSpec:
        return replace(self, **changes)

    @property
    def bounded(self) -> bool:
        return self.time_range is not None

    @property
    def groups(self) -> list[str]:
        return [self.group] if isinstance(self.group, str) else list(self.group)

    @property
    def keys(self) -> list[str]:
        """Group columns and time: one row each in a panel."""
        return [*self.groups, self.time]

    @property
    def task_keys(self) -> list[str]:
        """What rows are shuffled by: the group, or the group and the block."""
        return self.groups if self.bounded else [*self.groups, BLOCK]

    def has_group(self) -> Column:
        return reduce(lambda a, b: a & b, [F.col(g).isNotNull() for g in self.groups])

    def has_key(self) -> Column:
        return self.has_group() & F.col(self.time).isNotNull()

    def in_order(self) -> WindowSpec:
        """Rows that are worked on together, in time order, null times last."""
        return Window.partitionBy(*self.task_keys).orderBy(F.col(self.time).asc_nulls_last())

    def backwards(self) -> WindowSpec:
        return Window.partitionBy(*self.task_keys).orderBy(F.col(self.time).desc_nulls_first())

    def over_blocks(self) -> WindowSpec:
        """The block rows (one per block) of one series in time order."""
        return Window.partitionBy(*self.groups).orderBy(BLOCK)

    def over_blocks_backwards(self) -> WindowSpec:
        return Window.partitionBy(*self.groups).orderBy(F.col(BLOCK).desc())

    def whole(self) -> WindowSpec:
        """All rows of a bounded series, or all block rows of a long one."""
        return Window.partitionBy(*self.groups)
