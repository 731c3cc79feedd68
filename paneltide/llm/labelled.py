"""What the classifiers share: folds, bounded training samples, and texts as arrays of words."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paneltide.llm.common import join_hot, text_of, written

SAMPLE_ROWS = 2000  # different texts of each class
SAMPLE_CHARS = 20_000
SLICE_CHARS = 4 << 20


def in_fold(folds: int, fold: int, id_col: str = "doc_id") -> Column:
    """Whether a row is held out. A null id is not."""
    hashed = F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold
    return F.coalesce(hashed, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS, id_col: str = "doc_id", text_col: str = "text") -> tuple[list[str], list[int], list[float]]:
    """(texts, labels, weights) to learn from: at most `rows` different texts of each class, of `chars` characters at most.

    Equal texts are one and weigh as one, however many ids or rows have them. A text takes the
    label of most of its labelled ids; an id with both labels counts as 1, and so does a tie. The
    texts are those with the smallest hashes, so the sample is the same on every run, and are
    labelled outside the held-out fold. Weights give the classes their shares of all such texts.
    """
    kept = F.col("_id").isNotNull() & ~in_fold(folds, fold, "_id")
    known = labels.select(F.col(id_col).alias("_id"), F.col(label).alias("label")).filter(F.col("label").isNotNull() & kept)
    known = known.groupBy("_id").agg(F.max("label").cast("int").alias("label"))
    text = text_of(text_col)
    held = docs.select(F.col(id_col).alias("_id"), text.alias("text")).filter(kept & (F.length("text") <= chars))
    held = written(held.select("_id", F.xxhash64("text").alias("h")).distinct(), "held")
    known = known.join(held.groupBy("_id").agg(F.count("*").alias("n")), "_id")
    found = join_hot(held, known, "_id", "n", held.count()).groupBy("h").agg(F.avg("label").alias("share"))
    found = written(found.select("h", (F.col("share") >= 0.5).cast("int").alias("label")), "labels")
    picked, shares = [], {}
    for value in (0, 1):
        one = found.filter(F.col("label") == value)
        shares[value] = one.count()
        picked += [tuple(r) for r in one.orderBy(F.xxhash64("h"), "h").limit(rows).collect()]
    if not picked:
        return [], [], []
    chosen = docs.sparkSession.createDataFrame(picked, "h long, label int")  # 2 x rows at most
    texts = docs.select(text.alias("text")).filter(F.length("text") <= chars).withColumn("h", F.xxhash64("text"))
    texts = texts.join(F.broadcast(chosen.select("h")), "h").groupBy("h").agg(F.min("text").alias("text"))
    texts = {r["h"]: r["text"] for r in texts.collect()}  # one for each chosen hash
    got = sorted((texts[h], value) for h, value in picked)
    counts = [sum(1 for g in got if g[1] == v) for v in (0, 1)]
    return [g[0] for g in got], [g[1] for g in got], [shares[g[1]] / counts[g[1]] for g in got]


def slices(batch: pa.RecordBatch, text_at: int, chars: int = SLICE_CHARS) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of consecutive rows of a batch, some megabytes at a time."""
    texts, size, first = [], 0, 0
    for row, text in enumerate(batch.column(text_at)):
        texts.append(text.as_py() or "")
        size += len(texts[-1])
        if size >= chars:
            yield first, texts
            texts, size, first = [], 0, row + 1
    if texts:
        yield first, texts


def numbered(texts: list[list[str]]):
    """(different words, place of each word among them, number of words of each text)."""
    import numpy as np

    counts = np.fromiter(map(len, texts), np.int64, len(texts))
    different: dict[str, int] = {}
    for words in texts:
        different.update(dict.fromkeys(words))
    vocabulary = list(different)
    different.update(zip(vocabulary, range(len(vocabulary)), strict=True))
    places = np.fromiter(map(different.__getitem__, chain.from_iterable(texts)), np.int64, int(counts.sum()))
    return vocabulary, places, counts
