"""Quality: votes of the nearest labelled documents in a latent semantic space.

Terms of a document are the shapes of its words (runs of lower-case letters, capitals and
digits written as one sign each, other signs as they are; a long one counts in overlapping pieces of
LONGEST signs, down to its end), pairs of neighbouring shapes, and
whether a word repeats the one before; shapes hold in every language. Terms are hashed into
TERMS columns, weighted by logarithmic counts and inverse document frequencies, and projected
on the strongest singular directions of the labelled sample. The labelled vectors go along with
every task: they are bounded by the sample, two times SAMPLE_ROWS rows of DIMENSIONS numbers. Every document gets its
exact cosines with all of them, block by block as a matrix product, and the labels of its
nearest neighbours vote with the fourth power of their cosines.

Results for odd input: null and empty texts have the vector 0 and score as the labelled sample
does on the whole; repeated rows score alike; without any labelled row every score is 1 and
nothing is rejected; with labels of one class every score is that class; other columns are
not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneltide.llm import labelled
from paneltide.llm.common import by_value, fresh, text_of

TERMS, DIMENSIONS, NEIGHBOURS, POWER = 1024, 48, 25, 4
LONGEST = 12
BLOCK_ROWS = 512

_RUNS = re.compile(r"(.)\1+", re.DOTALL)


def shape(word: str) -> list[str]:
    """The shape of a word, in pieces that overlap by half if it has more than LONGEST signs."""
    signs = "".join("x" if c.islower() else "X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c for c in word)
    whole, step = _RUNS.sub(r"\1", signs), LONGEST // 2
    return [whole[a:a + LONGEST] for a in range(0, max(len(whole) - step, 1), step)]


def _column(term: str) -> int:
    return zlib.crc32(term.encode("utf-8", "surrogatepass")) % TERMS


def counts(texts: list[str]):
    """Term counts, one row for each text."""
    import numpy as np

    vocabulary, places, lengths = labelled.numbered([t.split() for t in texts])
    shapes = [shape(w) for w in vocabulary]
    pieces = [s for of in shapes for s in of]
    kinds = {s: k for k, s in enumerate(dict.fromkeys(pieces))}
    names = list(kinds)
    row = np.repeat(np.arange(len(texts)), lengths)
    again = row[1:][(row[1:] == row[:-1]) & (places[1:] == places[:-1])] if len(places) > 1 else row[:0]
    if len(places):
        # From words to the pieces of their shapes, in order.
        many = np.fromiter(map(len, shapes), np.int64, len(shapes))
        first, each = (np.cumsum(many) - many)[places], many[places]
        within = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        kind = np.fromiter((kinds[s] for s in pieces), np.int64, len(pieces))[np.repeat(first, each) + within]
        row, places = np.repeat(row, each), kind
    single = np.fromiter(map(_column, names), np.int64, len(names))
    cells = [row * TERMS + single[kind]] if len(places) else []
    if len(places) > 1:
        inside = row[1:] == row[:-1]
        pair = kind[:-1] * len(names) + kind[1:]
        different, which = np.unique(pair, return_inverse=True)
        column = np.fromiter((_column(f"{names[p // len(names)]} {names[p % len(names)]}") for p in different.tolist()), np.int64, len(different))
        cells.append((row[1:] * TERMS + column[which])[inside])
        cells.append(again * TERMS + _column("again"))
    found = np.bincount(np.concatenate(cells), minlength=len(texts) * TERMS) if cells else np.zeros(len(texts) * TERMS)
    return found.reshape(len(texts), TERMS)


class Model:
    """Labelled vectors and the way to them."""

    def __init__(self, texts: list[str], labels: list[int], weights: list[float]):
        import numpy as np

        self.constant = None if len(set(labels)) == 2 else float(labels[0]) if labels else 1.0
        if self.constant is not None:
            return
        tf = np.vstack([np.log1p(counts(texts[a:a + BLOCK_ROWS])) for a in range(0, len(texts), BLOCK_ROWS)])
        self.idf = np.log((1 + len(texts)) / (1 + (tf > 0).sum(axis=0))) + 1
        x = self._unit(tf * self.idf)
        value, vector = np.linalg.eigh(x.T @ x)
        self.basis = vector[:, ::-1][:, :DIMENSIONS].astype(np.float32)
        self.vectors = self._unit(x @ self.basis).astype(np.float32)
        self.labels = np.array(labels, np.float32)
        self.weights = np.array(weights, np.float32)
        self.prior = float((self.labels * self.weights).sum() / self.weights.sum())

    @staticmethod
    def _unit(x):
        import numpy as np

        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def scores(self, texts: list[str]):
        import numpy as np

        if self.constant is not None:
            return np.full(len(texts), self.constant)
        out = np.empty(len(texts))
        for at in range(0, len(texts), BLOCK_ROWS):
            x = self._unit(np.log1p(counts(texts[at:at + BLOCK_ROWS])) * self.idf).astype(np.float32) @ self.basis
            cosine = self._unit(x).astype(np.float32) @ self.vectors.T
            k = min(NEIGHBOURS, cosine.shape[1])
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            vote = np.maximum(np.take_along_axis(cosine, near, axis=1), 0).astype(float) ** POWER * self.weights[near]
            total = vote.sum(axis=1)
            share = (vote * self.labels[near]).sum(axis=1) / np.maximum(total, 1e-12)
            out[at:at + len(x)] = np.where(total > 1e-9, share, self.prior)
        return out


def _score(model: Model, name: str):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in labelled.slices(batch, batch.num_columns - 1):
                kept = [batch.column(c).slice(first, len(texts)) for c in range(batch.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(model.scores(texts), pa.float64())], [*batch.schema.names[:-1], name])

    return task


def scored(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, fold: int = 0, name: str = "score", id_col: str = "doc_id", text_col: str = "text", **bounds) -> DataFrame:
    """`docs` with the column `name`: the share of votes for label 1. Learns outside the held-out fold."""
    by_value(__name__)
    by_value(labelled.__name__)
    model = Model(*labelled.sample(docs, labels, label, folds, fold, id_col=id_col, text_col=text_col, **bounds))
    texts = docs.select("*", text_of(text_col).alias(fresh(docs, "_text")))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return texts.mapInArrow(_score(model, name), f"{fields}, `{name}` double")


def classify(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = scored(plain, labels.withColumnRenamed(id_col, "doc_id"), folds=folds, fold=fold, **options)
    return found.select("doc_id", labelled.in_fold(folds, fold).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **options) -> DataFrame:
    """The rows of `docs` that are not rejected."""
    name = fresh(docs, "score")
    return scored(docs, labels, name=name, **options).filter(F.col(name) >= threshold).drop(name)
