"""SimHash near-duplicates: pigeonring candidates, Hamming check, connected components.

The 64 bits are cut into 2 t + 1 segments in a ring for a distance of t. If two
fingerprints differ in t bits at most, some segment starts a chain of consecutive segments
whose first l differ in at most l t / (2 t + 1) bits, for every l. The first two of the chain
must then be equal, so they are the key of a bucket; a pair of a bucket is dropped as soon
as its longer chains pass their share, and the full distance is checked last.

Only different fingerprints are compared. A bucket with more than `wide` of them is split by
the next segments of its chain, all but the last one, in the one bit by which they may differ: each
member owns the bucket of its own value and visits those one bit away, and owners are paired
with owners and visitors. A part that is still wide is split by the last segment as well: owners go
to their value and those one bit away in it, visitors to their value only. All that meet there are
one bit from that value at most, so there are 65 of them at most, any two are within two bits, and hanging them on
the smallest one links what the pairs would. So the rows of a member are bounded at any size.

Results for odd input: a null text is an empty one; texts without words have fingerprint 0;
repeated rows and ids are rows of their own; a null id never names a component unless all
ids of it are null; a table without rows gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paneltide.llm.common import by_value, components, fresh, join_hot, text_of, written

SLICE = 8192


def fingerprint(data: bytes, shingle: int, seed: int) -> int:
    """A bit is 1 if it is set in over half of the shingles' hashes."""
    import numpy as np
    from xxhash import xxh64_intdigest

    words = data.lower().split()  # of bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = list(map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)))
    hashes = np.fromiter((xxh64_intdigest(g, seed) for g in grams), "<u8", len(grams))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), SLICE):
        octets = hashes[at:at + SLICE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def _fingerprints(shingle: int, seed: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), shingle, seed) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.int64())], ["doc_id", "text_hash", "fp"])

    return task


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, fp) of every row; fp as a signed 64-bit integer."""
    by_value(__name__)
    text = text_of(text_col)
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.cast("binary").alias("text"))
    return plain.mapInArrow(_fingerprints(shingle, seed), "doc_id long, text_hash long, fp long")


def _masks(distance: int) -> list[list[int]]:
    """For each start, the masks of the chains of 1, 2, ... segments."""
    count = 2 * distance + 1
    edges = [64 * i // count for i in range(count + 1)]
    segments = [sum(1 << b for b in range(edges[i], edges[i + 1])) for i in range(count)]
    chains = [[0] for _ in range(count)]
    for start, chain in enumerate(chains):
        for step in range(count):
            chain.append(chain[-1] | segments[(start + step) % count])
    return [chain[1:] for chain in chains]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _long(value: int) -> Column:
    return F.lit(_signed(value)).cast("long")


def _by_start(values: list) -> Column:
    """The value of the chain's start, from one constant array."""
    return F.element_at(F.array(*values), F.col("start") + 1)


def _bits(masks: list[int]) -> Column:
    """For the chain's start the bits of its mask, each as a mask of its own."""
    none = F.array().cast("array<bigint>")
    return _by_start([F.concat(none, *[F.array(_long(1 << b)) for b in range(64) if m >> b & 1]) for m in masks])


def links(fps: DataFrame, distance: int = 2, wide: int = 64) -> DataFrame:
    """Edges (a, b) that connect all of the given different fingerprints (fp) within `distance` bits (0, 1 or 2)."""
    if distance not in (0, 1, 2):
        raise ValueError("distance is 0, 1 or 2")
    if distance == 0:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    masks, count = _masks(distance), 2 * distance + 1
    equal = -(-count // distance) - 2  # index of the longest chain that may not differ at all
    keys = F.array(*[F.struct(F.lit(i).alias("start"), F.col("fp").bitwiseAND(_long(masks[i][equal])).alias("key")) for i in range(count)])
    keyed = fps.select("fp", F.explode(keys).alias("k")).select("fp", "k.start", "k.key")
    buckets = keyed.groupBy("start", "key").agg(F.count("*").alias("members")).filter("members > 1")
    shared = written(keyed.join(buckets, ["start", "key"]), "buckets")

    few = shared.filter(F.col("members") <= wide)
    right = few.select("start", "key", F.col("fp").alias("other"))
    apart = F.col("fp").bitwiseXOR(F.col("other"))

    def chain(step: int) -> Column:
        return F.bit_count(apart.bitwiseAND(_by_start([_long(masks[i][step]) for i in range(count)]))) <= (step + 1) * distance // count

    pairs = few.join(right, ["start", "key"]).filter(F.col("fp") > F.col("other"))
    for step in range(equal + 1, count):
        pairs = pairs.filter(chain(step))
    near = pairs.filter(F.bit_count(apart) <= distance).select(F.col("fp").alias("a"), F.col("other").alias("b"))

    # Wide buckets, by the chain without its last segment.
    before_last = [chain[-2] for chain in masks]
    own = F.col("fp").bitwiseAND(_by_start([_long(m) for m in before_last]))
    steps = _bits([m & ~chain[equal] for m, chain in zip(before_last, masks, strict=True)])
    visits = F.transform(steps, lambda bit: F.struct(own.bitwiseXOR(bit).alias("value"), F.lit(False).alias("owner")))
    places = F.concat(F.array(F.struct(own.alias("value"), F.lit(True).alias("owner"))), visits)
    placed = shared.filter(F.col("members") > wide).select("fp", "start", F.explode(places).alias("p")).select("fp", "start", "p.value", "p.owner")
    parts = placed.groupBy("start", "value").agg(F.count("*").alias("members"), F.count_if("owner").alias("owners")).filter("members > 1 AND owners > 0")
    split = written(placed.join(parts, ["start", "value"]), "split")

    few = split.filter(F.col("members") <= wide)
    right = few.select("start", "value", F.col("fp").alias("other"), F.col("owner").alias("owner_too"))
    near_too = (
        few.filter("owner").join(right, ["start", "value"])
        .filter(~F.col("owner_too") | (F.col("fp") > F.col("other")))
        .filter(F.bit_count(apart) <= distance).select(F.col("fp").alias("a"), F.col("other").alias("b"))
    )

    last = [chain[-1] ^ m for m, chain in zip(before_last, masks, strict=True)]
    whole = F.col("value").bitwiseOR(F.col("fp").bitwiseAND(_by_start([_long(m) for m in last])))
    around = F.transform(_bits(last), lambda bit: whole.bitwiseXOR(bit))
    centres = F.when(F.col("owner"), F.concat(F.array(whole), around)).otherwise(F.array(whole))
    groups = (
        split.filter(F.col("members") > wide).select("fp", F.explode(centres).alias("centre"))
        .groupBy("centre").agg(F.collect_set("fp").alias("fps"))  # 65 at most: the centre and its neighbours
        .filter(F.size("fps") > 1)
    )
    if distance == 2:
        star = groups.select(F.explode("fps").alias("a"), F.array_min("fps").alias("b"))
    else:
        star = groups.filter(F.array_contains("fps", F.col("centre"))).select(F.explode("fps").alias("a"), F.col("centre").alias("b"))
    return near.unionByName(near_too).unionByName(star.filter("a <> b")).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 2, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, fp, component_id, first_hash) of every row.

    component_id is the smallest doc_id that can be reached over links of `distance` bits or
    fewer; first_hash is the smallest text_hash under that doc_id, so (component_id,
    first_hash) names one text of the component.
    """
    found = written(fingerprints(docs, shingle, seed, id_col, text_col), "fingerprints")
    lead = F.min(F.struct(F.col("doc_id").isNull().alias("no"), F.col("doc_id"), F.col("text_hash")))
    classes = written(found.groupBy("fp").agg(lead.alias("lead"), F.count("*").alias("n")), "classes")
    total = found.count()
    roots = components(links(classes.select("fp"), distance))
    rooted = written(
        classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")), "rooted")
    best = rooted.groupBy("root").agg(F.min("lead").alias("best"), F.count("*").alias("fps"))
    named = join_hot(rooted.select("fp", "root", "n"), best, "root", "fps", total)
    return join_hot(found, named.select("fp", "best", "n"), "fp", "n", total).select(
        "doc_id", "text_hash", "fp", F.col("best.doc_id").alias("component_id"), F.col("best.text_hash").alias("first_hash"))


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs` without near-duplicates: of each component the text that near_duplicates names, once."""
    groups = near_duplicates(docs, **options)
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    own, first, first_hash = fresh(docs, "_text_hash"), fresh(docs, "_id"), fresh(docs, "_hash")
    kept = groups.select(F.col("component_id").alias(first), F.col("first_hash").alias(first_hash)).distinct()
    hashed = docs.withColumn(own, F.xxhash64(text_of(text_col)))
    match = F.col(id_col).eqNullSafe(F.col(first)) & F.col(own).eqNullSafe(F.col(first_hash))
    return hashed.join(kept, match, "left_semi").dropDuplicates([id_col, own]).drop(own)
