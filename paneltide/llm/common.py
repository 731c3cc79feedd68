"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import sys

import pyspark.cloudpickle as cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paneltide.functions.materialize import new_folder

WHITE = r"[\x20\x09-\x0D]+"
BLOCK = 1024


def by_value(module: str) -> None:
    """Sends the functions of a module with the tasks, so executors need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows from a table in the shared folder, written now; it goes when the session ends."""
    folder = new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_of(column: str | Column) -> Column:
    """Null counts as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def offsets(totals: DataFrame, part: str, values: list[str]) -> DataFrame:
    """Adds before_<value>: the sum over all smaller parts. One row per part comes in.

    Parts are summed in blocks of 1,024 and then the blocks, so the one task that sees
    all blocks has a row for each 1,024 parts.
    """
    block = F.floor(F.col(part) / BLOCK)
    blocked = totals.withColumn("_block", block)
    inner = Window.partitionBy("_block").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    sums = blocked.groupBy("_block").agg(*[F.sum(v).alias(f"_sum_{v}") for v in values])
    before = sums.select("_block", *[F.coalesce(F.sum(f"_sum_{v}").over(outer), zero).alias(f"_before_{v}") for v in values])
    return (
        blocked.withColumns({f"before_{v}": F.coalesce(F.sum(v).over(inner), zero) for v in values})
        .join(before, "_block")
        .withColumns({f"before_{v}": F.col(f"before_{v}") + F.col(f"_before_{v}") for v in values})
        .drop("_block", *[f"_before_{v}" for v in values])
    )


def join_hot(left: DataFrame, right: DataFrame, key: str, weight: str, total: int, pieces: int = 64,
             how: str = "inner") -> DataFrame:
    """left joined with right, which has one row per key and in `weight` the left rows of the key.

    A key with more than 1 / 1,024 of all left rows is spread over `pieces` keys. There are
    fewer than 1,024 such keys, so the list of them is broadcast. The piece of a row comes from the
    row itself, so a task that runs again deals out the same. `weight` is dropped.
    """
    hot = (F.col(weight) * BLOCK > F.lit(total)) & (F.col(weight) > 1000)
    keys = F.broadcast(right.filter(hot).select(F.col(key).alias("_hot")))
    spread = F.when(F.col("_hot").isNotNull(), F.pmod(F.xxhash64(*left.columns), F.lit(pieces))).otherwise(0)
    salted = left.join(keys, F.col(key).eqNullSafe(F.col("_hot")), "left").withColumn("_salt", spread.cast("int")).drop("_hot")
    every = F.sequence(F.lit(0), F.lit(pieces - 1))
    copies = right.withColumn("_salt", F.explode(F.when(hot, every).otherwise(F.array(F.lit(0))))).drop(weight)
    copies = copies.withColumnRenamed(key, "_key").withColumnRenamed("_salt", "_copy")
    match = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_salt") == F.col("_copy"))
    return salted.join(copies, match, how).drop("_key", "_copy", "_salt")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the smallest node it is connected with.

    Alternating large and small stars: each round hangs the neighbours of a node on the
    smallest of them, in a logarithmic number of rounds, until no edge changes. Every round is
    written to the shared folder, so a lost executor costs one round.
    """
    def smallest(pairs: DataFrame) -> DataFrame:
        least = pairs.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        return least.withColumn("m", F.least("a", "m"))

    def state(pairs: DataFrame) -> tuple:
        row = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return tuple(row)

    now = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = state(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = join_hot(both, smallest(both), "a", "n", 2 * seen[0]).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        small = join_hot(large, smallest(large), "a", "n", seen[0])
        small = small.select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        now = written(small.select("e.a", "e.b").filter("a <> b").distinct(), "edges")
        found = state(now)
        if found == seen:
            break
        seen = found
    roots = now.groupBy("a").agg(F.min("b").alias("root"))
    return roots.select(F.col("a").alias("node"), "root").unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def split_words(text: Column) -> Column:
    """The words of a text in lower case, as an array; select it before using it twice."""
    bare = F.btrim(F.lower(text), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, WHITE))
