"""Which landed files can hold what is asked for.

An index has a row for each group in each file, with the span of its periods, so it grows with the
series and not with the observations.  It is a table: build it once with ``index_files``,
write it, and add to it the index of files that land later.  A file that the index does not know, or
that has changed since, is always read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paneltide.spec import PanelSpec

_FILE = ["source", "modified", "size"]


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(source, path, modified, size) of the files below a folder; their content is not read."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(
        F.col("_metadata.file_path").alias("source"), "path",
        F.col("modificationTime").alias("modified"), F.col("length").alias("size"))


def read_text(
    spark: SparkSession, path: str, files: DataFrame | None = None, **options: object
) -> DataFrame:
    """The texts below a folder, or of some of its files (``needed_files``); all others are left alone.

    The names of the files pass through the driver, as those of a listing do.
    """
    if files is None:
        return spark.read.text(path, **options)
    names = [r["path"] for r in files.select("path").collect()]
    if not names:
        return spark.read.text(path, **options).where(F.lit(False))
    return spark.read.option("basePath", path).text(names, **options)


def with_source(texts: DataFrame) -> DataFrame:
    """Adds ``source``, the file that a text is from, by which ``index_files`` knows it."""
    return texts.withColumn("source", F.col("_metadata.file_path"))


def index_files(files: DataFrame, rows: DataFrame, spec: PanelSpec) -> DataFrame:
    """(source, modified, size, group, first, last) of parsed rows with their ``source``.

    A file without rows has one row without a group.
    """
    spans = rows.groupBy("source", *spec.groups).agg(
        F.min(spec.time).alias("first"), F.max(spec.time).alias("last"))
    return files.select(*_FILE).join(spans, "source", "left")


def needed_files(files: DataFrame, index: DataFrame, wanted: DataFrame, spec: PanelSpec) -> DataFrame:
    """The files that may have rows of the wanted (group, period): of a wanted group, within its span.

    A group whose periods are all null counts as any period.  Without any wanted rows only
    files that the index does not know are left.
    """
    spans = wanted.groupBy(*spec.groups).agg(F.min(spec.time).alias("_from"), F.max(spec.time).alias("_to"))
    apart = (F.col("first") > F.col("_to")) | (F.col("last") < F.col("_from"))
    # Neither side of a null span can be told to be apart.
    found = index.join(spans, spec.groups, "inner").where(~F.coalesce(apart, F.lit(False))).select("source").distinct()
    idle = index.select(*_FILE).distinct().join(found, "source", "left_anti")
    return files.join(idle, _FILE, "left_anti")
