"""A long SDMX-JSON message read in pieces, by as many tasks as its bytes ask for.

The text reader cuts files where a series ends: ``}}`` in a message without blanks, as services send
them.  A file then splits like any text with lines.  Most pieces are one series each; the
others, joined in order, are the message with all but the first of its series left out.  That frame is
parsed as a whole, which tells the lists of values and, by a marker in place of each run of series,
which of them belong to the first data set.  It grows with the lists and not with the observations.

In a message whose series end in another way (blanks between the braces, attributes after the
observations) no piece is a series, so the frame is the whole message: the same rows, from one task.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paneltide.functions.materialize import cut
from paneltide.functions.skew import give_back
from paneltide.sources import landed

END = "}}"
# Series that are looked up together, so the lists of a message are copied once for as many.
BATCH = 64

# A piece that is a series without its end: after a comma an index key and two braces that stay open.
# Outside of a text such a piece, with its end, is a whole member of an object; inside of one it
# cannot be, as the quote of its key would close the text.
_TEXT = r'"(?:[^"\\]|\\.)*+"'
_PLAIN = rf'(?:[^"{{}}]++|{_TEXT})*+'
_ONE_SERIES = rf'\A\s*,\s*"\d+(?::\d+)*+"\s*:\s*\{{{_PLAIN}\{{{_PLAIN}\z'


def read_pieces(spark: SparkSession, path: str, end: str = END, files: DataFrame | None = None) -> DataFrame:
    """Pieces of messages, one message per file, as column ``value``.

    ``end`` is how a series ends: two closing braces, with the blanks between them if the messages have any.
    ``files`` are the files to read (``landed.needed_files``).
    """
    if end.split() not in (["}}"], ["}", "}"]):
        raise ValueError(f"a series ends with two braces, not with {end!r}")
    return landed.read_text(spark, path, files, lineSep=end)


def _placed(pieces: DataFrame, text: str) -> tuple[DataFrame, DataFrame]:
    """Pieces with their place in their file, and the number of pieces per file.

    Pieces are written once, so that their split into blocks is the same for all that follows.
    """
    found = cut(pieces.select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"), F.col(text).alias("_text"),
        F.col(text).rlike(_ONE_SERIES).alias("_is_series")))
    # Rows of a block are numbered without gaps, so its first one and its size place them all.
    blocks = found.groupBy("_file", "_block").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    upto = Window.partitionBy("_file").orderBy("_block")
    offsets = blocks.select(
        "_file", "_block", (F.sum("_n").over(upto) - F.col("_n") - F.col("_first")).alias("_offset"))
    placed = found.join(offsets, ["_file", "_block"]).select(
        "_file", (F.col("_row") + F.col("_offset")).alias("_place"), "_text", "_is_series")
    return placed, blocks.groupBy("_file").agg(F.sum("_n").alias("_pieces"))


def _frames(placed: DataFrame, end: str, message: str, mark: str) -> DataFrame:
    """(file, structure, entries, from, to): a message without the series between two places."""
    following = F.lead("_place").over(Window.partitionBy("_file").orderBy("_place"))
    marker = F.when(
        F.col("_next") > F.col("_place") + 1,
        F.concat(F.lit(f',"{mark} '), F.col("_place"), F.lit(" "), F.col("_next"), F.lit('":{}')))
    parts = placed.where(~F.col("_is_series")).withColumn("_next", following).select(
        "_file", F.struct("_place", F.concat("_text", F.lit(end), F.coalesce(marker, F.lit(""))).alias("text")).alias("_part"))
    whole = parts.groupBy("_file").agg(F.array_sort(F.collect_list("_part"))["text"].alias("_texts"))
    data = F.from_json(F.array_join("_texts", ""), message)["data"]
    parsed = whole.select("_file", data.alias("_data")).select(
        "_file", F.col("_data.structure").alias("_structure"),
        F.map_entries(F.get(F.col("_data.dataSets"), F.lit(0))["series"]).alias("_all"))

    def is_mark(entry: Column) -> Column:
        return entry["key"].startswith(mark)

    def bound(at: int) -> Column:
        return F.transform(F.filter("_all", is_mark), lambda e: F.split(e["key"], " ")[at].cast("long"))

    return parsed.select(
        "_file", "_structure", F.filter("_all", lambda e: ~is_mark(e)).alias("_entries"),
        F.array_min(bound(1)).alias("_from"), F.array_max(bound(2)).alias("_to"))


def batches(structure: Column, entries: Column) -> tuple[Column, Column]:
    """``_structure`` and, in stretches of BATCH, the ``_entries`` of a parsed message."""
    starts = F.when(F.size(entries) > 0, F.sequence(F.lit(1), F.size(entries), F.lit(BATCH)))
    return structure.alias("_structure"), F.explode(
        F.transform(starts, lambda i: F.slice(entries, i, BATCH))).alias("_entries")


def series_of(pieces: DataFrame, message: str, series: str, end: str = END, text: str = "value") -> DataFrame:
    """Series of the first data set by the batch: their ``_file``, the ``_structure`` of their message and ``_entries`` (key, value).

    ``message`` and ``series`` are the schemas to parse with.  A message whose frame cannot be parsed gives no
    rows; a series that cannot be parsed leaves only itself out.  The pieces are written when this is
    called, and so are the frames.
    """
    placed, sizes = _placed(pieces, text)
    frames = cut(_frames(placed, end, message, uuid.uuid4().hex).join(sizes, "_file"))
    first = frames.select("_file", *batches(F.col("_structure"), F.col("_entries")))
    facts = frames.where("_from is not null").select("_file", "_structure", "_from", "_to", "_pieces")
    member = F.concat(F.lit("{"), F.regexp_replace("_text", r"\A\s*,", ""), F.lit(end), F.lit("}"))
    parsed = placed.where("_is_series").select("_file", "_place", member.alias("_member"))
    together = parsed.groupBy("_file", F.expr(f"_place div {BATCH}L").alias("_batch")).agg(
        F.collect_list(F.struct("_place", "_member")).alias("_members"))

    def inside(member: Column) -> Column:
        return (member["_place"] > F.col("_from")) & (member["_place"] < F.col("_to"))

    entries = F.flatten(F.transform(F.filter("_members", inside), lambda m: F.coalesce(
        F.map_entries(F.from_json(m["_member"], f"map<string,{series}>")), F.array().cast(f"array<struct<key:string,value:{series}>>"))))
    others = give_back(together, facts, ["_file"], "_pieces").where("_from is not null").select(
        "_file", "_structure", entries.alias("_entries"))
    return first.unionByName(others)
