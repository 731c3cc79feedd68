import zlib

from paneltide.llm.sharding import assign


def check(rows, texts, shards):
    sizes = sorted((len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for t in texts)
    assert sorted((r.size, r.text_crc32) for r in rows) == sizes
    whole, at = sum(s for s, _ in sizes), 0
    for r in sorted(rows, key=lambda r: (r.shard, r.slot)):
        assert r.shard == at * shards // whole
        at += r.size
    for s in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))


def test_shards_are_equal_shares_in_order(docs):
    texts = [f"text {k} " * (k % 37) for k in range(500)]
    rows = assign(docs(*texts), shards=7).collect()
    check(rows, texts, 7)
    assert [r.doc_id for r in sorted(rows, key=lambda r: (r.shard, r.slot))] == list(range(500))


def test_one_id_in_most_rows(spark):
    rows = [(9, "same text")] * 400 + [(k, "x" * k) for k in range(100)]
    got = assign(spark.createDataFrame(rows, "doc_id long, text string").repartition(8), shards=5).collect()
    check(got, [t for _, t in rows], 5)


def test_odd_and_empty(odd_docs, no_docs):
    rows = assign(odd_docs).collect()
    check(rows, [r.text for r in odd_docs.collect()], 24)
    assert sorted(rows, key=lambda r: (r.shard, r.slot))[0].doc_id is None
    assert assign(no_docs).collect() == []
