"""The pipeline against stages in plain Python, on the smallest tables."""

import itertools

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from paneltide.llm import labelled, quality
from paneltide.llm.packing import Encoder
from paneltide.llm.queries import vocabulary

import test_decontamination
import test_line_dedup
import test_simhash

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.written(stage(spark, docs, SF), name)
        out.append((before, docs))
    return out


def rows(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


def test_quality(spark, stages):
    before, after = stages[0]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.Model(*labelled.sample(before, labels, "quality", 5, 0))
    known = rows(before)
    assert rows(after) == [r for r, s in zip(known, model.scores([t for _, t in known]), strict=True) if s >= 0.3]
    assert after.columns == before.columns and 0 < after.count() < before.count()


def test_line_dedup_stage(stages):
    before, after = stages[1]
    want = test_line_dedup.naive(rows(before), short_runs=True)
    kept = [(d, want[d]) for d, t in rows(before) if want[d] or not t]
    assert rows(after) == kept and kept != rows(before)
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_near_dedup_stage(stages):
    before, after = stages[2]
    fps = {d: test_simhash.naive(t) for d, t in rows(before)}
    near = [(a, b) for a, b in itertools.combinations(fps, 2) if bin(fps[a] ^ fps[b]).count("1") <= 2]
    roots = test_simhash.groups(fps, near)
    assert rows(after) == [(d, t) for d, t in rows(before) if roots[d] == d]


def test_decontamination_stage(stages):
    before, after = stages[3]
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    bad = {d for d, _ in test_decontamination.naive(rows(before), items)}
    assert rows(after) == [r for r in rows(before) if r[0] not in bad]


def test_decontamination_stage_looks_at_every_window(spark, tmp_path):
    words = [f"w{k}" for k in range(40)]
    spark.createDataFrame([(1, " ".join(words))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    around = " ".join(f"x{k}" for k in range(50))
    rows_in = [(1, " ".join([around, *words[20:], *words[:20], around])), (2, " ".join([around, *words[:20], around]))]
    docs = spark.createDataFrame(rows_in, "doc_id long, text string")
    assert [r.doc_id for r in corpus_pipeline.decontaminate(spark, docs, str(tmp_path)).collect()] == [2]


def test_decontamination_stage_loses_no_window_of_repeated_words(spark, tmp_path):
    item, turned = " ".join(["ab", "cd"] * 10 + ["ab"]), " ".join(["cd", "ab"] * 10 + ["cd"])
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(1, turned), (2, "ab cd " * 3)], "doc_id long, text string")
    assert [r.doc_id for r in corpus_pipeline.decontaminate(spark, docs, str(tmp_path)).collect()] == [2]


def test_packing_stage(stages):
    before, after = stages[4]
    encoder = Encoder(vocabulary())
    want = {d: [*encoder.tokenizer.encode(t, add_special_tokens=False).ids, 1] for d, t in rows(before)}
    got = {}
    for r in after.orderBy("doc_id", "start").collect():
        got.setdefault(r.doc_id, []).extend(np.frombuffer(r.ids, "<u4").tolist())
    assert got == want


def test_run_gives_the_last_stage(spark, stages):
    key = ["doc_id", "start", "length", "ids"]
    got, want = (sorted(map(tuple, df.select("doc_id", "doc_tokens").distinct().collect())) for df in (corpus_pipeline.run(spark, SF), stages[-1][1]))
    assert got == want and set(key) <= set(stages[-1][1].columns)


def test_odd_and_empty(spark, odd_docs, no_docs, tmp_path):
    for k, docs in enumerate((odd_docs, no_docs)):
        folder = f"{tmp_path}/{k}"
        docs.selectExpr("*", "length(text) as n_chars", "'en' as lang", "'s' as source").write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        ids = {r.doc_id for r in corpus_pipeline.run(spark, folder).collect()}
        assert ids == ({1, 2, 4, 5, 8} if docs is odd_docs else set())
