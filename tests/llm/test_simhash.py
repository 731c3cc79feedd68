import itertools
import random
import re

import pytest
import xxhash
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from paneltide.llm import simhash
from paneltide.llm.common import components


def naive(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def signed(v):
    return v - (1 << 64) if v >> 63 else v


def groups(nodes, edges):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


@settings(max_examples=80)
@given(st.text(alphabet="aAbB zÉ\n\t\x0b\x85 ", max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode(), 3, 42) % (1 << 64) == naive(text)


@pytest.mark.parametrize("distance", [0, 1, 2])
@pytest.mark.parametrize("wide", [1, 4, 16, 1000])
def test_links_connect_all_within_the_distance(spark, distance, wide):
    rng = random.Random(distance)
    values = set()
    for _ in range(6):  # dense groups and chains around a few centres, and loners
        centre = rng.getrandbits(64)
        for _ in range(25):
            values.add(centre)
            flips = rng.sample(range(64), rng.randint(1, 3))
            values.add(centre := centre ^ sum(1 << f for f in flips)) if rng.random() < 0.3 else values.add(centre ^ sum(1 << f for f in flips))
    centre = rng.getrandbits(64)  # a bucket that stays wide when it is split by all segments but one
    values |= {centre ^ (1 << i) ^ (1 << j) for i in range(13) for j in range(13)}
    values |= {centre ^ (1 << i) ^ (1 << j) for i in range(13) for j in range(13, 40, 5)}
    values = [signed(v) for v in values]
    found = simhash.links(spark.createDataFrame([(v,) for v in values], "fp long"), distance, wide).collect()
    near = [(a, b) for a, b in itertools.combinations(values, 2) if bin((a ^ b) % (1 << 64)).count("1") <= distance]
    allowed = {frozenset(p) for p in near}
    assert all(frozenset((r.a, r.b)) in allowed for r in found)
    assert groups(values, [tuple(r) for r in found]) == groups(values, near)


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {n for a, b in edges if a != b for n in (a, b)}
    assert got == groups(nodes, edges)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_near_duplicates_of_odd_documents(odd_docs):
    rows = simhash.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {(r.doc_id, r.fp % (1 << 64)): r.component_id for r in rows}
    same = naive("alpha beta gamma delta epsilon zeta eta theta")
    assert by_id[1, same] == by_id[None, same] == 1
    assert by_id[2, 0] == by_id[3, 0] == by_id[6, 0] == by_id[None, 0] == 2
    assert {r.component_id for r in rows if r.doc_id in (5, 7)} == {5}


def test_one_of_each(odd_docs, no_docs):
    kept = simhash.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 4, 5, 8]
    assert simhash.one_of_each(no_docs).collect() == []
    assert simhash.near_duplicates(no_docs).collect() == []


def test_near_copies(docs):
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(4000)]
    texts = [" ".join(words)]
    for k in range(40):
        other = list(words)
        other[rng.randrange(4000)] = f"changed{k}"
        texts.append(" ".join(other))
    texts += [" ".join(rng.sample(words, 300)) for _ in range(5)]
    fps = [naive(t) for t in texts]
    edges = [(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if bin(fps[i] ^ fps[j]).count("1") <= 2]
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs(*texts)).collect()}
    assert got == groups(range(len(texts)), edges)
    assert len(edges) > 20


settings.register_profile("llm", deadline=None, suppress_health_check=list(HealthCheck))
settings.load_profile("llm")
