"""Giving facts of a group back to its rows, where a group may hold any share of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A group with more than this share of all rows is spread; there are fewer such groups than
# the share says, so the list of them is small at any size.
SHARE = 1024
PIECES = 256
# Groups up to this many rows are never spread.
SMALL = 10_000


def hashable(rows: DataFrame) -> list[Column]:
    """The columns that a hash of a row can be made of."""
    return [F.col(f"`{f.name}`") for f in rows.schema
            if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]


def give_back(rows: DataFrame, facts: DataFrame, keys: Sequence[str], weight: str) -> DataFrame:
    """Left join of facts, one row per key, whose column ``weight`` counts the rows of the key.

    Rows of a frequent key are dealt out over PIECES copies of its facts, so no task gets
    all of them.  The list of such keys is broadcast: fewer than SHARE rows.  Null keys have
    no facts and are dealt out too.
    """
    total = facts.agg(F.sum(weight)).scalar()
    # The piece comes from the row itself, so a task that runs again deals out the same.
    frequent = (F.col(weight) > SMALL) & (F.col(weight) * SHARE > F.coalesce(total, F.lit(0)))
    named = facts.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    lookup = [f"_key_{k}" for k in keys]

    def same(other: Sequence[str]) -> Column:
        match = F.lit(True)
        for key, name in zip(keys, other, strict=True):
            match = match & (F.col(key) == F.col(name))
        return match

    hot = named.where(frequent).select(*[F.col(n).alias(f"_hot{n}") for n in lookup])
    marked = rows.join(F.broadcast(hot), same(hot.columns), "left")
    null_key = F.lit(False)
    for key in keys:
        null_key = null_key | F.col(key).isNull()
    piece = F.pmod(F.xxhash64(*hashable(rows)), F.lit(PIECES)).cast("int")
    dealt = marked.withColumn(
        "_piece", F.when(F.col(hot.columns[0]).isNotNull() | null_key, piece).otherwise(0)).drop(*hot.columns)
    every = F.sequence(F.lit(0), F.lit(PIECES - 1))
    copies = named.withColumn("_copy", F.explode(F.when(frequent, every).otherwise(F.array(F.lit(0)))))
    return dealt.join(copies, same(lookup) & (F.col("_piece") == F.col("_copy")), "left").drop(
        "_piece", "_copy", weight, *lookup)
