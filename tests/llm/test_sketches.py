import random

import duckdb
import pytest
import xxhash
from pyspark.sql import functions as F

from paneltide.llm import sketches
from paneltide.llm.common import split_words
from paneltide.llm.queries import QUERIES


def signed(v):
    return v - (1 << 64) if v >> 63 else v


def hashes(text, shingle=5):
    words = text.lower().split()
    if not words:
        return set()
    out = set()
    for i in range(max(1, len(words) - shingle + 1)):
        h = 42
        for w in words[i:i + shingle]:
            h = xxhash.xxh64_intdigest(w.encode(), h)
        out.add(signed(h))
    return out


def sketched(docs, k=8):
    return docs.select("doc_id", split_words(F.coalesce("text", F.lit(""))).alias("w")).select("doc_id", sketches.sketch("w", k).alias("s"))


def texts(n, words, seed=0):
    rng = random.Random(seed)
    return [" ".join(rng.choices("abcdefgh", k=rng.randint(0, words))) for _ in range(n)]


def test_sketch_and_merge(docs):
    every = texts(60, 30)
    got = {r.doc_id: r.s for r in sketched(docs(*every)).collect()}
    assert got == {k: sorted(hashes(t))[:8] for k, t in enumerate(every)}
    pairs = sketched(docs(*every)).withColumn("key", F.col("doc_id") % 5)
    merged = {r.key: r.s for r in sketches.merge_by(pairs, "key", "s", 8).collect()}
    for key in range(5):
        assert merged[key] == sorted(set().union(*[hashes(t) for t in every[key::5]]))[:8]


def test_estimates(docs):
    words = [f"w{k}" for k in range(4000)]
    both = docs(" ".join(words), " ".join(words[:2000]), "", "w1 w2")
    a, b, none, few = (r.s for r in sketched(both, 256).orderBy("doc_id").collect())
    row = both.sparkSession.createDataFrame([(a, b, none, few)], "a array<long>, b array<long>, n array<long>, f array<long>").select(
        sketches.resemblance(F.col("a"), F.col("b"), 256).alias("like"), sketches.containment(F.col("b"), F.col("a"), 256).alias("part"),
        sketches.distinct_shingles(F.col("a"), 256).alias("many"), sketches.distinct_shingles(F.col("f"), 256).alias("few"),
        sketches.resemblance(F.col("n"), F.col("n"), 256).alias("empty"), sketches.resemblance(F.col("n"), F.col("a"), 256).alias("half")).first()
    assert abs(row.like - 0.5) < 0.12 and row.part > 0.8 and abs(row.many / 3996 - 1) < 0.2
    assert (row.few, row.empty, row.half) == (1.0, 1.0, 0.0)


def test_query_equals_brute_force(spark):
    import hashlib

    rows = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet' ORDER BY doc_id DESC").fetchall()
    got = {r.doc_id: r for r in QUERIES["op7_document_fingerprints"](spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(rows)
    for (doc_id, text), (_, after) in zip(rows, [*rows[1:], rows[0]], strict=True):
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        own, other, following = (sorted(hashes(t))[:sketches.K] for t in (text, edited, after))
        r = got[doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == "".join(f"{h % (1 << 64):016x}" for h in own)
        assert r.edited_fingerprint == "".join(f"{h % (1 << 64):016x}" for h in other)

        def like(a, b):
            least = sorted({*a, *b})[:sketches.K]
            return len({*a} & {*b} & {*least}) / len(least) if least else 1.0

        assert r.near_edited == pytest.approx(like(own, other)) and r.near_next == pytest.approx(like(own, following))


def test_query_on_odd_tables(spark, odd_docs, no_docs, tmp_path):
    odd_docs.write.parquet(f"{tmp_path}/a/documents.parquet")
    rows = QUERIES["op7_document_fingerprints"](spark, f"{tmp_path}/a").collect()
    assert len(rows) == odd_docs.count()
    assert len({r.fingerprint for r in rows if r.doc_id in (5, 7)}) == 1
    no_docs.write.parquet(f"{tmp_path}/b/documents.parquet")
    assert QUERIES["op7_document_fingerprints"](spark, f"{tmp_path}/b").collect() == []
