"""Sharding: contiguous shards of nearly equal bytes, cut from global prefix sums.

Rows are put in order of their id by range partitions. The byte and row totals of the
partitions (one row each) give every partition its place; within a partition a running sum
does. A document goes to the shard in whose equal share of all bytes it starts, so a shard
differs from its share by one document at most. Only ids, sizes and checksums are shuffled.

Results for odd input: a null text has no bytes; a null id comes first in the order; rows
that are equal in all of id, size and checksum stand next to each other in file order; a
table without rows gives no rows; columns other than id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paneltide.llm.common import offsets, text_of, written


def assign(docs: DataFrame, shards: int = 24, overhead: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): size in bytes with `overhead`; slots count from 0 in each shard."""
    text = text_of(text_col)
    sized = docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + overhead).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.monotonically_increasing_id().alias("_row"))
    order = ["doc_id", "size", "text_crc32", "_row"]
    rows = written(sized.repartitionByRange(*order).withColumn("_part", F.spark_partition_id().cast("long")), "sized")
    totals = rows.groupBy("_part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = written(offsets(totals, "_part", ["bytes", "rows"]), "offsets")
    parts, whole = before.agg(F.count("*"), F.sum("bytes")).first()
    if parts <= 250_000:  # 40 bytes a partition: 10 MB at most
        before = F.broadcast(before)
    inner = Window.partitionBy("_part").orderBy(*order)
    upto = inner.rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        rows.withColumns({"_sum": F.sum("size").over(upto), "_index": F.row_number().over(inner) - 1})
        .join(before, "_part")
        .withColumns({"_at": F.col("before_bytes") + F.col("_sum") - F.col("size"), "_index": F.col("before_rows") + F.col("_index")})
        .withColumn("shard", F.expr(f"cast((_at * {shards}) div {max(whole or 0, 1)} as int)"))
    )
    placed = written(placed.select("doc_id", "size", "text_crc32", "shard", "_index"), "placed")
    first = placed.groupBy("shard").agg(F.min("_index").alias("_first"))  # one row a shard
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("_index") - F.col("_first")).alias("slot"))
