import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from paneltide.llm import periodic
from paneltide.llm.queries import QUERIES

SHAPE = periodic.Shape()
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words):
    """All runs by comparing the words at every lag."""
    n, runs = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(24, 3 * q):
                runs.setdefault((i, length), q)  # lags ascend, so the smallest period comes first
            i = j
    return sorted(((s, n, q) for (s, n), q in runs.items()), key=lambda r: (r[0], r[2]))


def naive(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def found(words):
    return periodic.find([w.encode() for w in words], SHAPE)


def made(rng):
    """Texts of few words with periodic stretches, also nested, overlapping and broken ones."""
    kinds = [f"w{k}" for k in range(rng.choice([1, 2, 3, 8, 200]))]
    words = []
    for _ in range(rng.randint(1, 6)):
        period = [rng.choice(kinds) for _ in range(rng.choice([1, 2, 3, 5, 8, 9, 16, 17, 31, 33, 40]))]
        if rng.random() < 0.3:
            period = period * rng.randint(2, 4) + [rng.choice(kinds)]
        stretch = (period * 12)[:rng.randint(1, 5 * len(period) + 25)]
        if rng.random() < 0.2:
            stretch[rng.randrange(len(stretch))] = "odd"
        words += stretch + [rng.choice(kinds) for _ in range(rng.choice([0, 1, 7, 40]))]
    return words


@pytest.mark.parametrize("seed", range(300))
def test_equals_comparing_all_lags(seed):
    words = made(random.Random(seed))
    assert found(words) == brute(words)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=90))
def test_words_of_three_kinds(numbers):
    words = [f"w{k}" for k in numbers]
    assert found(words) == brute(words)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(1, 30)), max_size=20))
def test_stretches_of_one_word(stretches):
    words = [f"w{k}" for k, n in stretches for _ in range(n)]
    assert found(words) == brute(words)


def stable(words, lo, hi):
    """Segments by the plain recursion: count, split, go on."""
    if hi - lo < 24:
        return []
    counts = {}
    for w in words[lo:hi]:
        counts[w] = counts.get(w, 0) + 1
    cuts = [i for i in range(lo, hi) if counts[words[i]] < 3]
    if not cuts:
        return [(lo, hi)]
    return [s for a, b in zip([lo - 1, *cuts], [*cuts, hi]) for s in stable(words, a + 1, b)]


@pytest.mark.parametrize("seed", range(60))
def test_segments_are_those_of_the_plain_recursion(seed):
    rng = random.Random(seed)
    words = made(rng) + [f"v{int(rng.paretovariate(0.6)) % 300}" for _ in range(600)]
    assert periodic.segments(*periodic.numbers([w.encode() for w in words]), SHAPE) == stable(words, 0, len(words))


def test_a_long_text_of_nested_rare_words_is_split_in_time():
    # Each word but the innermost is rare only once its neighbours outside are gone.
    words = [b"w%d" % (abs(k) // 2) for k in range(-150_000, 150_000)]
    assert periodic.find(words, SHAPE) == []


def test_a_long_periodic_text():
    words = [b"w%d" % (k % 99_991) for k in range(400_000)]
    assert periodic.find(words, SHAPE) == [(0, 400_000, 99_991)]


def test_odd_rows(spark, odd_docs, no_docs):
    got = periodic.periodic_runs(odd_docs).collect()
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert len(got) == odd_docs.count() and by_id[3].runs == [] and by_id[3].collapsed == by_id[2].collapsed == by_id[6].collapsed == ""
    assert [tuple(r) for r in by_id[4].runs] == [(0, 30_000, 1)] and by_id[4].collapsed == "word end"
    want = sorted((naive(r.doc_id, r.text) for r in odd_docs.collect() if r.doc_id != 4), key=str)
    planted = periodic.digests(periodic.periodic_runs(odd_docs, with_planted=True))
    assert sorted((tuple(r) for r in planted.where("doc_id is null or doc_id <> 4").collect()), key=str) == want
    assert periodic.digests(periodic.periodic_runs(no_docs)).collect() == []


def test_white_space_is_ascii_only(docs):
    text = "a b c\x1cd\x85e " * 30
    assert [tuple(r) for r in periodic.periodic_runs(docs(text)).first().runs] == [(0, 30, 1)]


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = QUERIES["op12_periodic_runs"](spark, folder)
    assert rows.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = {r.doc_id: tuple(r) for r in rows.collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    short = [r for r in docs if len(r.text.split()) <= 1_500]  # comparing all lags is quadratic
    assert len(got) == len(docs) and len(short) > 0.9 * len(docs)
    for r in short:
        assert got[r.doc_id] == naive(r.doc_id, r.text)
    assert sum(g[1] > 0 for g in got.values()) >= 10
