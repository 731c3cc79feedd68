"""Merkle manifest of a dataset: a digest per row, a tree per group, a tree over the groups, and a proof per row.

Rows of a group are numbered in order of their id by range partitions and prefix sums. Trees
join three neighbours at a time. They are worked on by time-forward processing: every node has
a label (its level and number), children come before parents, and what a node has to say to
another one waits in a queue ordered by the label of the receiver. Between tasks that queue is
the shuffle, sorted by label; it holds any number of messages. Within a task it is a heap over
one block of BLOCK neighbours, six levels of a tree. So a round of six levels is one
shuffle, each block is a small piece of work whatever its group holds, and a table of
10^10 rows has four rounds. The first sweep sends digests from children to parents up to the
root. The reversed sweep sends to every child the rest of its proof: its neighbours
followed by the proof of its parent. A row's text is read once, for its digest; only digests
are shuffled.

Results for odd input: a null field is `-` in the digest, so it differs from an empty one; rows
without a group are a group of their own, before all others; rows without an id come first in
their group and are never altered by the query; rows with the same id stand in order of their
digests, and each has its own leaf and proof; a table without rows gives no rows; columns
other than the fields are not read.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paneltide.llm.common import by_value, written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN = 3
LEVELS = 6
BLOCK = FAN ** LEVELS
NODE = "tree string, idx long, total long, digest string, key string, id long, altered string"
SENT = "tree string, idx long, key string, digest string, rest string, subroot string"
PROVED = "id long, leaf string, subroot string, steps string, proof_sha256 string, folded_root string"
ROWS = 2_000


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _height(total: int) -> int:
    """Levels that a block of a tree over `total` nodes has: all of them, or those of a whole block."""
    levels = 0
    while total > 1 and levels < LEVELS:
        total, levels = -(-total // FAN), levels + 1
    return levels


def _forward(digests: Sequence[str], levels: int) -> list[list[str]]:
    """Digests of a block by level; children send theirs to the label of their parent."""
    nodes = [list(digests), *([] for _ in range(levels))]
    queue = [(1, i // FAN, i, d) for i, d in enumerate(digests)] if levels else []  # in order, so a heap
    while queue:
        level, number = queue[0][:2]
        parts = []
        while queue and queue[0][:2] == (level, number):
            parts.append(heapq.heappop(queue)[3])
        digest = _sha("".join(parts))
        nodes[level].append(digest)
        if level < levels:
            heapq.heappush(queue, (level + 1, number // FAN, number, digest))
    return nodes


def _backward(nodes: list[list[str]], rest) -> Iterator[tuple[int, tuple]]:
    """(number, proof) of each node of the lowest level, the last first.

    A proof is (place among its neighbours, the neighbours, proof of the parent), so proofs share
    what they have in common.
    """
    top = len(nodes) - 1
    queue = [(-top, -i, rest) for i in reversed(range(len(nodes[top])))]
    while queue:
        level, number, proof = heapq.heappop(queue)
        level, number = -level, -number
        if level == 0:
            yield number, proof
            continue
        children = nodes[level - 1][FAN * number:FAN * number + FAN]
        for place in range(len(children)):
            others = (*children[:place], *children[place + 1:])
            heapq.heappush(queue, (1 - level, -(FAN * number + place), (place, others, proof)))


def _as_text(proof) -> str:
    steps = []
    while proof:
        steps.append(f"{proof[0]}:{','.join(proof[1])}")
        proof = proof[2]
    return ";".join(steps)


def _of_text(text: str):
    proof = None
    for step in reversed(text.split(";") if text else []):
        place, _, others = step.partition(":")
        proof = (int(place), tuple(others.split(",")) if others else (), proof)
    return proof


def fold(digest: str, proof) -> str:
    """The root that a leaf's digest leads to by its proof."""
    while proof:
        place, others, proof = proof
        digest = _sha("".join((*others[:place], digest, *others[place:])))
    return digest


def _neighbours(proof) -> str:
    """Digest over all neighbours, from the leaf to the root."""
    seen = hashlib.sha256()
    while proof:
        for other in proof[1]:
            seen.update(other.encode())
        proof = proof[2]
    return seen.hexdigest()


def _numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the task and the place of a row among those of its tree in the task; rows come in order."""
    import numpy as np
    import pyarrow.compute as pc
    from pyspark import TaskContext

    part, last, count = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        tree = batch.column("tree")
        starts = np.ones(n, bool)
        starts[1:] = pc.not_equal(tree[1:], tree[:-1]).to_numpy(zero_copy_only=False)
        if tree[0].as_py() == last:
            starts[0] = False
        first = np.maximum.accumulate(np.where(starts, np.arange(n), -1))
        at = np.where(first >= 0, np.arange(n) - first, np.arange(n) + count)
        last, count = tree[n - 1].as_py(), int(at[-1]) + 1
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(n, part)), pa.array(at)], [*batch.schema.names, "part", "at"])


def _numbered(rows: DataFrame, order: list[str], name: str) -> tuple[DataFrame, int]:
    """Rows (tree, ...) with `idx`, their place in their tree, and its `total`; and the largest total."""
    by = ["tree", *order]
    placed = rows.withColumn("_row", F.monotonically_increasing_id())  # deals out rows that are equal in all else
    placed = placed.repartitionByRange(*by, "_row").sortWithinPartitions(*by, "_row").drop("_row")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in placed.schema)
    placed = written(placed.mapInArrow(_numbers, f"{kinds}, part long, at long"), f"{name}-placed")
    whole = Window.partitionBy("tree")
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("tree", "part").agg(F.count("*").alias("n")).select(
        "tree", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"), F.sum("n").over(whole).alias("total"))
    sizes = written(sizes, f"{name}-sizes")
    numbered = placed.join(sizes, ["tree", "part"]).withColumn("idx", F.col("at") + F.col("before"))
    return numbered, sizes.agg(F.max("total")).first()[0] or 0


def _blocks(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[list[tuple]]:
    """The rows of one block after the other, from rows in order of (tree, block)."""
    block, key = [], None
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
            if row[:2] != key:
                if block:
                    yield block
                block, key = [], row[:2]
            block.append(row)
    if block:
        yield block


def _batches(rows: Iterator[tuple], names: list[str], kinds: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    held = []

    def batch() -> pa.RecordBatch:
        columns = zip(*held, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    for row in rows:
        held.append(row)
        if len(held) == ROWS:
            yield batch()
            held = []
    if held:
        yield batch()


def _names(schema: str) -> tuple[list[str], list[pa.DataType]]:
    pairs = [part.split() for part in schema.split(", ")]
    return [n for n, _ in pairs], [pa.int64() if k == "long" else pa.string() for _, k in pairs]


def _fold_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def parents() -> Iterator[tuple]:
        for block in _blocks(batches, ["tree", "block", "idx", "total", "digest"]):
            tree, number, _, total, _ = block[0]
            top = _forward([row[4] for row in block], _height(total))[-1]
            yield tree, number, -(-total // BLOCK), top[0], None, None, None

    yield from _batches(parents(), *_names(NODE))


def _in_blocks(nodes: DataFrame) -> DataFrame:
    """Nodes gathered by block and sorted by label; what is sent to a block has idx -1 and comes first."""
    return nodes.repartition("tree", "block").sortWithinPartitions("tree", "block", "idx")


def _blocked(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"idx div {BLOCK}"))


def _up(leaves: DataFrame, largest: int, name: str) -> list[DataFrame]:
    """Tables of nodes, six levels apart, the leaves first. The top of a tree has a total of one."""
    levels = [leaves]
    while largest > 1:
        nodes = _blocked(levels[-1].where("total > 1").select("tree", "idx", "total", "digest"))
        levels.append(written(_in_blocks(nodes).mapInArrow(_fold_blocks, NODE), f"{name}-nodes"))
        largest = -(-largest // BLOCK)
    return levels


def _tops(levels: list[DataFrame]) -> DataFrame:
    """(tree, digest, level) of the top of every tree."""
    found = [nodes.where("total = 1").select("tree", "digest", F.lit(k).alias("level")) for k, nodes in enumerate(levels)]
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    return result


def _deliver(proved: bool, steps: bool):
    columns = ["tree", "block", "idx", "total", "digest", "key", "id", "altered", "rest", "subroot"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for block in _blocks(batches, columns):
            sent, *nodes = block
            if sent[2] != -1 or not nodes or nodes[0][2] == -1:
                raise ValueError(f"block {sent[:2]} of the manifest has not exactly one message")
            rest, subroot = _of_text(sent[8]), sent[9]
            tree, number = sent[:2]
            for i, proof in _backward(_forward([n[4] for n in nodes], _height(nodes[0][3])), rest):
                digest, key, id, altered = nodes[i][4:8]
                if proved:
                    yield id, digest, subroot, _as_text(proof) if steps else None, _neighbours(proof), fold(altered or digest, proof)
                else:
                    yield tree, nodes[i][2], key, digest, _as_text(proof), subroot

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(rows(batches), *_names(PROVED if proved else SENT))

    return task


def _down(levels: list[DataFrame], messages: DataFrame, name: str, proved: bool = False, steps: bool = False) -> DataFrame:
    """What the reversed sweep brings to the lowest level; `messages` (tree, level, rest, subroot) start it."""
    nothing = {"total": "long", "digest": "string", "key": "string", "id": "long", "altered": "string"}
    sent = None
    for k in reversed(range(len(levels))):
        here = messages.where(F.col("level") == k).select("tree", F.lit(0).cast("long").alias("block"), "rest", "subroot")
        if sent is not None:
            here = here.unionByName(sent.select("tree", F.col("idx").alias("block"), "rest", "subroot"))
        here = here.withColumns({"idx": F.lit(-1).cast("long"), **{c: F.lit(None).cast(t) for c, t in nothing.items()}})
        nodes = _blocked(levels[k]).withColumns({c: F.lit(None).cast("string") for c in ("rest", "subroot")})
        lowest = k == 0 and proved
        sent = _in_blocks(nodes.unionByName(here)).mapInArrow(_deliver(lowest, steps), PROVED if lowest else SENT)
        if not lowest:
            sent = written(sent, f"{name}-sent")
    return sent


def digest(columns: dict[str, Column]) -> Column:
    """Hexadecimal SHA-256 over fields: `-` for null, else the number of UTF-8 bytes, a colon and the value."""
    texts = [c.cast("string") for c in columns.values()]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def manifest(
    docs: DataFrame, fields: Sequence[str] = FIELDS, group_col: str = "source", id_col: str = "doc_id",
    altered: dict[str, Column] | None = None, is_altered: Column | None = None, steps: bool = False,
) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified), one row per row.

    `altered` gives fields a later value in the rows where `is_altered` holds; their digest then
    takes the place of the leaf in `folded_root`. `steps` adds the proof itself as text: place and
    neighbours per level, which `check_steps` folds.
    """
    by_value(__name__)
    values = {f: F.col(f"`{f}`") for f in fields}
    later = F.lit(None).cast("string")
    if altered:
        later = F.when(F.lit(True) if is_altered is None else is_altered, digest({**values, **altered}))
    # "=" before the name of a group sorts like the name, and after the empty text of rows without one.
    tree = F.coalesce(F.concat(F.lit("="), F.col(f"`{group_col}`").cast("string")), F.lit(""))
    leaves = docs.select(
        tree.alias("tree"), F.col(f"`{id_col}`").cast("long").alias("id"), digest(values).alias("digest"),
        later.alias("altered"), F.lit(None).cast("string").alias("key"))
    columns = [part.split()[0] for part in NODE.split(", ")]

    numbered, largest = _numbered(leaves, ["id", "digest"], "leaves")
    levels = _up(written(numbered.select(*columns), "leaves"), largest, "tree")
    tops = written(_tops(levels), "subroots")
    # The tree over the groups is one more tree, whose leaves are the tops of theirs.
    groups = tops.select(
        F.lit("").alias("tree"), F.col("tree").alias("key"), "digest", F.lit(None).cast("long").alias("id"),
        F.lit(None).cast("string").alias("altered"))
    numbered, largest = _numbered(groups, ["key"], "groups")
    upper = _up(written(numbered.select(*columns), "groups"), largest, "upper")
    top = written(_tops(upper), "root")  # one row
    first = top.select("tree", "level", F.lit("").alias("rest"), F.lit(None).cast("string").alias("subroot"))
    sent = _down(upper, first, "upper")
    start = sent.select(F.col("key").alias("tree"), "rest", F.col("digest").alias("subroot")).join(
        tops.select("tree", "level"), "tree")
    proved = _down(levels, written(start, "start"), "tree", proved=True, steps=steps)
    root = F.lit(row.digest if (row := top.first()) else None).cast("string")
    result = proved.select(
        F.col("id").alias(id_col), "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root",
        (F.col("folded_root") == root).alias("verified"), "steps")
    return result if steps else result.drop("steps")


def check_steps(leaf: str, steps: str) -> str:
    """The root that a leaf leads to by the proof in `steps`."""
    return fold(leaf, _of_text(steps))
