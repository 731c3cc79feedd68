"""Packing by concatenate and cut: fixed windows over one stream of all token ids.

Two passes. The first encodes every text once and writes its ids with the number of tokens
before it in its task. The totals of the tasks (one row each) give every document its place
in the stream by a prefix sum. The second pass cuts each document where the stream passes a
multiple of the window, so a document that crosses a border leaves one record on either side.
No sequence has padding but the last one.

Results for odd input: a null text is an empty one and leaves the end id alone; rows with the
same id are documents of their own; a table without rows gives no rows; columns other than id
and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneltide.llm.common import by_value, offsets, text_of, written

ENCODED = "doc_id long, part long, before long, n long, ids binary"
BATCH_BYTES = 16 << 20


@dataclass(frozen=True)
class Vocabulary:
    """The file of a tokenizer, and if there is one the same vocabulary as ranks with its split pattern.

    The tokenizer's file says what the ids are. Byte-level pairs merged by rank are the same ids in a
    third of the time, so ranks are used where given; each task holds the first text to both,
    and every text with an added token.
    """

    tokenizer: str
    ranks: str | None = None
    pattern: str | None = None


class Encoder:
    """Texts to their ids, as unsigned 32-bit integers, those of added tokens in a text included."""

    def __init__(self, vocabulary: Vocabulary):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary.tokenizer)
        added = {token.content: (k, token) for k, token in self.tokenizer.get_added_tokens_decoder().items()}
        # Ranks know no tokens that take white space along or stand for whole words only.
        plain = not any(t.lstrip or t.rstrip or t.single_word or t.normalized for _, t in added.values())
        self.added, self.fast = list(added), None
        if vocabulary.ranks and plain:
            import base64

            import tiktoken

            with open(vocabulary.ranks, "rb") as lines:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=vocabulary.pattern, mergeable_ranks=ranks, special_tokens={c: k for c, (k, _) in added.items()})

    def whole(self, text: str):
        import numpy as np

        return np.asarray(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def encode(self, text: str, check: bool = False):
        if self.fast is None:
            return self.whole(text)
        ids = self.fast.encode_to_numpy(text, allowed_special="all")
        if (check or any(token in text for token in self.added)) and ids.tolist() != self.whole(text).tolist():
            raise ValueError("the ranks are not those of the tokenizer")
        return ids


_ENCODERS: dict[Vocabulary, Encoder] = {}


def _encode(vocabulary: Vocabulary, end_id: int):
    def encode_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = _ENCODERS.get(vocabulary) or _ENCODERS.setdefault(vocabulary, Encoder(vocabulary))
        part, before, end = TaskContext.get().partitionId(), 0, end_id.to_bytes(4, "little")
        rows, size = [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = encoder.encode(text.as_py(), check=not before).astype("<u4", copy=False).tobytes() + end
                rows.append((doc_id.as_py(), part, before, len(ids) // 4, ids))
                before += len(ids) // 4
                size += len(ids)
                if size >= BATCH_BYTES:
                    yield _batch(rows)
                    rows, size = [], 0
        if rows:
            yield _batch(rows)

    return encode_task


def _batch(rows: list) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "part", "before", "n", "ids"])


def pack(docs: DataFrame, vocabulary: Vocabulary, length: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces (doc_id, start, length, doc_tokens, sequence_id, offset, ids) of sequences of `length` ids.

    `ids` holds the piece as little-endian unsigned 32-bit integers. Every executor reads the
    files of the vocabulary at their paths.
    """
    by_value(__name__)
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    encoded = written(plain.mapInArrow(_encode(vocabulary, end_id), ENCODED), "encoded")
    totals = written(offsets(encoded.groupBy("part").agg(F.sum("n").alias("n")), "part", ["n"]).select("part", "before_n"), "offsets")
    parts = totals.count()
    if parts <= 500_000:  # 16 bytes a task: 8 MB at most
        totals = F.broadcast(totals)
    placed = encoded.join(totals, "part").withColumn("at", F.col("before") + F.col("before_n"))
    last = F.expr(f"(at + n - 1) div {length}")
    pieces = placed.withColumn("sequence_id", F.explode(F.sequence(F.expr(f"at div {length}"), last)))
    start = F.greatest(F.lit(0).cast("long"), F.col("sequence_id") * length - F.col("at"))
    cut = pieces.withColumn("start", start).withColumn(
        "length", F.least(F.col("n"), (F.col("sequence_id") + 1) * length - F.col("at")) - F.col("start"))
    return cut.select(
        "doc_id", "start", "length", F.col("n").alias("doc_tokens"), "sequence_id",
        (F.col("at") + F.col("start") - F.col("sequence_id") * length).alias("offset"),
        F.expr("substring(ids, cast(4 * start + 1 as int), cast(4 * length as int))").alias("ids"),
    )
