"""Document fingerprints: bottom-k sketches of hashed word shingles.

A sketch is the sorted array of the k smallest different hashes of a document's shingles (five
words; fewer words make one shingle). The k smallest of two sketches together are the sketch
of both documents together, so sketches of parts merge into that of the whole. From two
sketches come resemblance and containment, and from one the number of different shingles.

Results for odd input: a null text is an empty one; a text without words has an empty
sketch; two empty sketches resemble each other fully, an empty one and another not at all;
equal texts have equal sketches; tables without rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 64
SPACE = float(1 << 64)


def sketch(words: str, k: int = K, shingle: int = 5) -> Column:
    """The sketch of a column that holds an array of words (see common.split_words)."""
    column = F.col(words)
    count = F.greatest(F.size(column) - (shingle - 1), F.lit(1))
    grams = F.transform(F.sequence(F.lit(1), count), lambda i: F.xxhash64(F.slice(column, i, F.lit(shingle))))
    least = F.slice(F.array_sort(F.array_distinct(grams)), 1, k)
    return F.when(F.size(column) == 0, F.array().cast("array<long>")).otherwise(least)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of both documents' shingles together."""
    return F.slice(F.array_sort(F.array_union(a, b)), 1, k)


def merge_by(sketches: DataFrame, key: str, column: str, k: int = K) -> DataFrame:
    """(key, column): one sketch for the parts of each key. Ranks are cut off before the shuffle too."""
    rows = sketches.select(key, F.explode_outer(column).alias("_h")).distinct()
    ranked = rows.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(F.col("_h").asc_nulls_last()))).filter(f"_r <= {k}")
    return ranked.groupBy(key).agg(F.array_sort(F.collect_list("_h")).alias(column))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of different shingles; exact below k."""
    share = (F.element_at(a, -1).cast("double") + SPACE / 2) / SPACE
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of common shingles among all shingles of both."""
    both = merge(a, b, k)
    common = F.size(F.array_intersect(F.array_intersect(a, b), both))
    return F.when(F.size(both) == 0, F.lit(1.0)).otherwise(common / F.size(both))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has too; 1 if a has none."""
    like = resemblance(a, b, k)
    common = like * distinct_shingles(merge(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), common / distinct_shingles(a, k)))


def as_text(a: Column) -> Column:
    """16 hex digits for each hash."""
    return F.concat_ws("", F.transform(a, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))))
