"""Panel tables that keep their series together, so that series operators need no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paneltide.spec import PanelSpec


def _clustered(df: DataFrame, spec: PanelSpec, buckets: int) -> DataFrame:
    """Rows where their bucket is written, so that a bucket of a code is one file."""
    return df.repartition(buckets, *spec.groups)


def write_clustered(
    df: DataFrame, name: str, path: str, spec: PanelSpec, buckets: int,
    code: str | None = None, overwrite: bool = False,
) -> None:
    """Parquet table ``name`` at ``path``: series by hash of the group in ``buckets``, in order of time.

    A scan of it is partitioned by group, so operators with a declared time range work on it without an
    exchange; that range bounds the rows of a series, and so a bucket grows with its
    series alone.  There are as many tasks as buckets, so take enough of them for the table as it
    will be.  ``code`` makes a folder per value of that column, which can be replaced alone.
    """
    if not spec.bounded:
        raise ValueError("series of any length do not fit a bucket; declare a time range")
    writer = _clustered(df, spec, buckets).write.format("parquet").option("path", path).mode(
        "overwrite" if overwrite else "errorifexists")
    if code is not None:
        writer = writer.partitionBy(code)
    writer.bucketBy(buckets, *spec.groups).sortBy(*spec.keys).saveAsTable(name)


def replace_codes(df: DataFrame, name: str, spec: PanelSpec) -> None:
    """Replaces in a table with folders by code those codes that ``df`` has; all others stay."""
    spark = df.sparkSession
    buckets = next(int(r["data_type"]) for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()
                   if r["col_name"] == "Num Buckets")
    # The table has its folder column last.
    rows = df.select(*spark.table(name).columns)
    # The session says which folders an insert replaces; an option of the writer does not reach it.
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        _clustered(rows, spec, buckets).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(mode, before)


def read_clustered(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
