"""Benchmark decontamination: SimHash of item-sized windows, then exact similarity.

A window of a document has as many words as a benchmark item. Its fingerprint is the SimHash of
its shingles (five words, or the whole of a shorter item), each weighted by how often it
occurs. Fingerprints are cut into distance + 1 blocks, and a window and an item meet
where any block is equal, so no pair within `distance` bits is missed. Further apart a pair may
still reach the similarity, above all where few shingles are repeated often. A bit can only differ
in such a pair if the shingles of the item that have it and those that have not are about as many:
their difference is at most the weight that the two do not share. So an item has firm bits, which
are equal in every window that passes, and pairs beyond `distance` count if these are equal.
Pairs are then held to the exact similarity: the shared weight of shingles over the weight of either.

Every item-sized window counts, wherever it starts and in whatever order the shingles of the item
stand in it. At a similarity s a window of a shingles and an item of b share at least
s (a + b) / (1 + s), so the windows in which fewer positions hold a shingle of the item cannot
pass; the others are found from the positions alone, and the item stays with them. So the work
follows the shared shingles, however many items have one size. Copies of one passage are
fingerprinted and compared once, and so are items with equal words.

The index of the benchmark is broadcast up to a checked number of rows and shuffled beyond.

Results for odd input: null and empty texts of documents or items have no words and match
nothing; rows with equal id and text give their matches once; a document shorter than the
item is one window; items with equal texts all match; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paneltide.llm.common import fresh, join_hot, split_words, text_of, written

SHINGLE = 5
DISTANCE = 24  # at similarity 0.8 a bit differs with chance 0.15, so few pairs are left for the firm bits
BROADCAST_ROWS = 500_000  # of 32 bytes or less: 16 MB

SIMHASH = """aggregate(sequence(0, 63), 0L, (acc, b) -> acc + if(
    2 * aggregate(grams, 0, (n, h) -> n + cast(shiftright(h, b) & 1 as int)) > size(grams), shiftleft(1L, b), 0L))"""

# For each bit, how many more shingles have it than have not; it is set if that is above 0.
FIRM = """aggregate(sequence(0, 63), 0L, (acc, b) -> acc + if(
    2 * aggregate(grams, 0, (n, h) -> n + cast(shiftright(h, b) & 1 as int)) - size(grams) between 1 - unshared and unshared, 0L, shiftleft(1L, b)))"""


def _grams(words: str, wide: Column) -> Column:
    """Hashes of all runs of `wide` words."""
    column = F.col(words)
    last = F.size(column) - wide + 1
    runs = F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice(column, i, wide)))
    return F.when(last > 0, runs).otherwise(F.array().cast("array<long>"))


def _blocks(fp: Column, distance: int) -> Column:
    edges = [64 * i // (distance + 1) for i in range(distance + 2)]
    masks = [sum(1 << b for b in range(x, y)) for x, y in zip(edges, edges[1:])]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    every = F.array(*[F.lit(m).cast("long") for m in signed])  # one constant, so the generated code stays small
    return F.transform(every, lambda m, i: F.struct(i.alias("block"), fp.bitwiseAND(m).alias("value")))


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _starts(similarity: float) -> Column:
    """Runs (from, to) of all starts of windows with enough positions `at`, sorted, that hold a shingle of the item."""
    at, grams = F.col("at"), F.col("size") - F.col("wide") + 1
    both = F.least(grams, F.col("n") - F.col("wide") + 1) + grams
    # A little less than the bound, so that rounding loses no window; a window without a shared shingle never passes.
    need = F.greatest(F.lit(1), F.ceil(both * F.lit(similarity / (1 + similarity)) - 1e-6).cast("int"))

    def run(first: Column, i: Column) -> Column:
        # Windows whose first such position is this one and that reach the last one they need.
        after = F.when(i > 0, F.get(at, i - 1) + 1).otherwise(0)
        return F.struct(
            F.col("item"), F.col("size"), F.greatest(after, F.get(at, i + need - 1) - grams + 1, F.lit(0)).alias("from"),
            F.least(first, F.greatest(F.lit(0), F.col("n") - F.col("size"))).alias("to"))

    runs = F.transform(F.slice(at, F.lit(1), F.greatest(F.lit(0), F.size(at) - need + 1)), run)
    return F.filter(runs, lambda r: r["from"] <= r["to"])


def _unshared(similarity: float) -> Column:
    """The most weight that a window and the item, of as many shingles at least, do not share at the similarity."""
    # A little more than the bound, so that rounding loses no window.
    return F.floor(2 * F.size("grams") * F.lit((1 - similarity) / (1 + similarity)) + 1e-6).cast("int")


def matches(docs: DataFrame, items: DataFrame, distance: int = DISTANCE, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, item_id, start, words, similarity): the best window of each document for each item it holds."""
    worded = items.select(F.col("item_id"), split_words(text_of("text")).alias("words")).filter(F.size("words") > 0)
    named = written(worded.select("item_id", F.xxhash64("words").alias("item"), "words"), "named")
    sized = named.groupBy("item").agg(F.first("words").alias("words")).select(
        "item", F.size("words").alias("size"), _grams("words", F.least(F.lit(SHINGLE), F.size("words"))).alias("grams"))
    sized = sized.withColumn("unshared", _unshared(similarity))
    bench = written(sized.withColumn("fp", F.expr(SIMHASH)).withColumn("firm", F.expr(FIRM)), "items")
    wide = F.least(F.lit(SHINGLE), F.col("size"))
    anchors = written(bench.select("item", wide.alias("wide"), "size", F.explode(F.array_distinct("grams")).alias("h")), "anchors")
    count = anchors.count()
    sizes = sorted(r[0] for r in anchors.select("wide").distinct().collect())  # five at most

    text = text_of(text_col)
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    rows = keyed.select("doc_id", "text_hash", split_words(F.col("text")).alias("words"))
    hits = None
    for w in sizes or [SHINGLE]:
        here = _small(anchors.filter(F.col("wide") == w), count)
        grams = rows.select("doc_id", "text_hash", F.size("words").alias("n"), _grams("words", F.lit(w)).alias("grams"))
        # The outer form, as the plain one adds a filter that would split the text again for each shingle.
        found = grams.select("doc_id", "text_hash", "n", F.posexplode_outer("grams").alias("pos", "h")).join(here, "h").drop("h")
        hits = found if hits is None else hits.unionByName(found)
    by_item = hits.groupBy("doc_id", "text_hash", "n", "item", "size", "wide").agg(F.sort_array(F.collect_set("pos")).alias("at"))
    runs = by_item.select("doc_id", "text_hash", _starts(similarity).alias("runs"))
    # The windows of a document in one array, so its text is split once for all of them.
    places = written(runs.groupBy("doc_id", "text_hash").agg(F.flatten(F.collect_list("runs")).alias("places")), "windows")

    place = places.filter(F.size("places") > 0).withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))

    def windows(words: Column) -> Column:
        return F.flatten(F.transform("places", lambda p: F.transform(F.sequence(p["from"], p["to"]), lambda start: F.struct(
            start.alias("start"), p["size"].alias("size"), p["item"].alias("item"), F.slice(words, start + 1, p["size"]).alias("words")))))

    each = F.get(F.transform(F.array(split_words(F.col("text"))), windows), 0)
    cut = keyed.join(place, same).select("doc_id", "text_hash", F.explode(each).alias("w")).select("doc_id", "text_hash", "w.*")
    cut = cut.select("doc_id", "text_hash", "start", "size", "item", F.xxhash64("words").alias("content"), _grams("words", wide).alias("grams"))
    cut = written(cut, "cut")
    contents = cut.groupBy("content", "size").agg(F.first("grams").alias("grams"), F.count("*").alias("n"))
    contents = written(contents.withColumn("fp", F.expr(SIMHASH)), "contents")

    items_by = bench.select("item", "size", F.col("fp").alias("item_fp"), F.explode(_blocks(F.col("fp"), distance)).alias("b")).select("item", "size", "item_fp", "b.block", "b.value")
    met = cut.select("content", "size", "item").distinct().join(contents.select("content", "size", "fp"), ["content", "size"])
    met = written(met, "met")
    by = met.select("content", "size", "item", "fp", F.explode(_blocks(F.col("fp"), distance)).alias("b")).select("content", "size", "item", "fp", "b.block", "b.value")
    several = bench.count()
    near = by.join(_small(items_by, several * (distance + 1)), ["item", "size", "block", "value"])
    apart = F.col("fp").bitwiseXOR(F.col("item_fp"))
    near = near.filter(F.bit_count(apart) <= distance)
    firm = _small(bench.select("item", F.col("fp").alias("item_fp"), "firm"), several)
    far = met.join(firm, "item").filter((F.bit_count(apart) > distance) & (apart.bitwiseAND(F.col("firm")) == 0))
    pairs = near.select("content", "size", "item").distinct().unionByName(far.select("content", "size", "item"))
    pairs = written(pairs, "pairs")

    weights = contents.select("content", "size", F.size("grams").alias("n_window"), F.explode("grams").alias("h")).groupBy("content", "size", "n_window", "h").agg(F.count("*").alias("w"))
    item_weights = bench.select("item", F.size("grams").alias("n_item"), F.explode("grams").alias("h")).groupBy("item", "n_item", "h").agg(F.count("*").alias("v"))
    shared = pairs.join(weights, ["content", "size"]).join(item_weights, ["item", "h"])
    shared = shared.groupBy("content", "size", "item", "n_window", "n_item").agg(F.sum(F.least("w", "v")).alias("both"))
    like = shared.withColumn("similarity", F.col("both") / (F.col("n_window") + F.col("n_item") - F.col("both"))).filter(F.col("similarity") >= similarity)
    counts = contents.select(F.struct("content", "size").alias("window"), "n")
    verified = like.groupBy(F.struct("content", "size").alias("window")).agg(F.collect_list(F.struct("item", "similarity")).alias("found")).join(counts, "window")
    # A window meets each of its items in a row of its own; here it is wanted once.
    own = cut.select("doc_id", "text_hash", "start", F.struct("content", "size").alias("window")).distinct()
    whole = join_hot(own, verified, "window", "n", cut.count())
    each = whole.select("doc_id", "text_hash", "start", F.col("window.size").alias("words"), F.explode("found").alias("f"))
    best = F.max(F.struct(F.col("f.similarity").alias("similarity"), (-F.col("start")).alias("start"), F.col("words"))).alias("best")
    items_of = named.select("item_id", "item")
    found = each.groupBy("doc_id", "text_hash", F.col("f.item").alias("item")).agg(best).join(_small(items_of, count), "item")
    return found.select(
        "doc_id", "text_hash", "item_id", (-F.col("best.start")).alias("start"), "best.words", "best.similarity")


def clean(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that hold no benchmark item."""
    bad = matches(docs, items, **options).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    own = fresh(docs, "_text_hash")
    names = {"_id": fresh(docs, "_id"), "_hash": fresh(docs, "_hash")}
    hashed = docs.withColumn(own, F.xxhash64(text_of(text_col)))
    match = F.col(id_col).eqNullSafe(F.col(names["_id"])) & (F.col(own) == F.col(names["_hash"]))
    return hashed.join(written(bad, "leaks").withColumnsRenamed(names), match, "left_anti").drop(own)
