import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from paneltide.llm import manifest
from paneltide.llm.queries import ORACLES, QUERIES

COLUMNS = "doc_id long, source string, lang string, n_chars long, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes):
    """Root of a list of digests, and per node the neighbours before and after it, level by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i:i + 3] for i in range(0, len(nodes), 3)]
        for k, place in enumerate(at):
            run, inner = runs[place // 3], place % 3
            paths[k].append((run[:inner], run[inner + 1:]))
            at[k] = place // 3
        nodes = [sha("".join(run)) for run in runs]
    return nodes[0], paths


def naive(rows):
    """Sorted result rows of plain recursion over lists."""
    groups = {}
    for row in rows:
        groups.setdefault((row[1] is not None, (row[1] or "").encode()), []).append(row)
    trees = []
    for name in sorted(groups):
        members = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append((members, *climb([leaf(r) for r in members])))
    root, upper = climb([tree[1] for tree in trees])
    out = []
    for (members, subroot, paths), above in zip(trees, upper, strict=True):
        for row, path in zip(members, paths, strict=True):
            now = leaf(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None:
                now = leaf((*row[:4], row[4].replace("\n", "")))
            for before, after in path + above:
                now = sha("".join([*before, now, *after]))
            proof = sha("".join("".join(b + a) for b, a in path + above))
            out.append((row[0], leaf(row), subroot, root, proof, now, now == root))
    return sorted(out, key=str)


def got(df):
    later = {"text": F.replace(F.col("text"), F.lit("\n"), F.lit(""))}
    rows = manifest.manifest(df, altered=later, is_altered=F.crc32(F.col("doc_id").cast("string")) % 2 == 0)
    return sorted((tuple(r) for r in rows.collect()), key=str)


@pytest.mark.parametrize("sizes", [[1], [2], [3], [4], [9, 1, 10], [27, 28, 1, 1, 2], [1] * 13, [729, 730], [2_300, 5]])
def test_equals_plain_recursion(spark, sizes):
    rows = [(1_000 * s + k, f"s{s}", "en", k, f"line {k}\nline\n{s}") for s, n in enumerate(sizes) for k in range(n)]
    result = got(spark.createDataFrame(rows, COLUMNS).repartition(5))
    assert result == naive(rows)
    assert {r[6] for r in result if zlib.crc32(str(r[0]).encode()) % 2} <= {True}
    assert not any(r[6] for r in result if zlib.crc32(str(r[0]).encode()) % 2 == 0)


def test_many_groups_need_rounds_of_their_own(spark):
    rows = [(k, f"g{k % 800}", None, 1, "a\nb" if k % 3 else None) for k in range(1_000)]
    assert got(spark.createDataFrame(rows, COLUMNS)) == naive(rows)


def test_nulls_ties_repeats_and_names(spark):
    rows = [
        (1, None, None, None, None), (1, "", "", 0, ""), (None, None, "en", 5, "a\nb"), (None, "x", None, 1, "é\n"),
        (7, "é", "en", 3, "\n\n"), (7, "é", "en", 3, "\n\n"), (7, "é", "de", 3, "\n\n"), (8, "z", "en", 2, "no end"), (9, "Z", None, 9, "word " * 50_000 + "\n"),
    ]
    clashing = ("tree", "idx", "digest", "part", "at", "_row", "id", "total", "rest", "leaf", "steps")
    extra = ", ".join(f"`{c}` string" for c in clashing)
    df = spark.createDataFrame([(*r, *["x"] * len(clashing)) for r in rows], f"{COLUMNS}, {extra}")
    assert got(df) == naive(rows)


def test_no_rows(spark):
    assert got(spark.createDataFrame([], COLUMNS)) == []


def test_most_rows_equal(spark):
    rows = [(5, "hot", "en", 1, "a\nb")] * 900 + [(k, "hot", "en", 1, "c") for k in range(100)]
    assert got(spark.createDataFrame(rows, COLUMNS).repartition(7)) == naive(rows)


def test_proofs_fold_to_the_root(spark):
    rows = [(k, f"s{k % 3}", "en", k, f"t{k}") for k in range(60)]
    for r in manifest.manifest(spark.createDataFrame(rows, COLUMNS), steps=True).collect():
        assert manifest.check_steps(r.leaf, r.steps) == r.root == r.folded_root and r.verified
        assert manifest.check_steps("0" * 64, r.steps) != r.root


def test_query_equals_plain_recursion(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    result = QUERIES["op13_merkle_manifest"](spark, folder)
    assert result.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((tuple(r) for r in result.collect()), key=str) == naive(rows)
    assert "op13_merkle_manifest" in ORACLES
