import random
from collections import Counter

import pytest

from paneltide.llm import decontamination


def grams(words):
    n = min(5, len(words))
    return Counter(tuple(words[i:i + n]) for i in range(len(words) - n + 1))


def naive(docs, items):
    """Best exact similarity of any item-sized window, for every pair that reaches 0.8."""
    found = {}
    for d, text in docs:
        words = (text or "").lower().split()
        for i, item in items:
            want = (item or "").lower().split()
            if not want:
                continue
            size, n = len(want), min(5, len(want))
            b = grams(want)
            for s in range(max(0, len(words) - size) + 1):
                window = words[s:s + size]
                a = Counter(tuple(window[k:k + n]) for k in range(len(window) - n + 1))
                both = sum((a & b).values())
                like = both / (sum(a.values()) + sum(b.values()) - both)
                if like >= 0.8 and like > found.get((d, i), (0,))[0]:
                    found[d, i] = (like, s)
    return found


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdef", k=4))
    items = [(k, " ".join(word() for _ in range(rng.choice([3, 8, 20, 21, 40, 60])))) for k in range(25)]
    items += [(25, items[0][1]), (26, ""), (27, None), (28, "la " * 30)]
    docs = []
    for d in range(120):
        words = [word() for _ in range(rng.randint(0, 150))]
        if d % 3:
            item = (rng.choice(items)[1] or "").split()
            for _ in range(rng.choice([0, 0, 1, 2, 5])):  # some words changed, put in or left out
                if item:
                    at = rng.randrange(len(item))
                    item[at:at + rng.choice([0, 1])] = [word()] if rng.random() < 0.7 else []
            at = rng.randint(0, len(words))
            words[at:at] = [w.upper() if rng.random() < 0.1 else w for w in item]
        docs.append((d, "\n ".join(words)))
    return [*docs, (200, None), (201, ""), (202, "la la " * 400), (203, docs[1][1])], items


def test_matches_equal_brute_force(spark, corpus):
    docs, items = corpus
    want = naive(docs, items)
    found = decontamination.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), distance=20)
    got = {(r.doc_id, r.item_id): r.similarity for r in found.collect()}
    # A window may start a few words from where a shared shingle puts the item, never better.
    assert {k: pytest.approx(v) for k, v in got.items() if k in want} == {k: want[k][0] for k in got if k in want}
    assert set(got) == set(want) and len(want) > 40


def test_default_distance_misses_none_of_the_copies(spark, corpus):
    docs, items = corpus
    found = decontamination.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.doc_id, r.item_id) for r in found.collect()}
    want = naive(docs, items)
    assert got <= set(want) and {k for k, v in want.items() if v[0] > 0.99} <= got and len(got) > 0.9 * len(want)


def test_many_items_of_one_size_meet_only_what_shares_a_shingle(spark, monkeypatch):
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    items = [(k, " ".join(word() for _ in range(20))) for k in range(1_000)] + [(1_000 + k, None) for k in range(3)]
    items += [(2_000, items[7][1]), (2_001, items[7][1].upper())]
    docs = [(k, " ".join([*(word() for _ in range(30)), *items[k][1].split()[:12], *(word() for _ in range(8))])) for k in range(300)]
    docs += [(300 + k, f"{word()} {items[k][1]} {word()}") for k in range(40)]
    sizes, real = {}, decontamination.written

    def kept(df, name):
        out = real(df, name)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(decontamination, "written", kept)
    found = decontamination.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.doc_id, r.item_id) for r in found.collect()}
    assert got == {(300 + k, k) for k in range(40)} | {(307, 2_000), (307, 2_001)}
    assert sizes["windows"] == 340 and sizes["cut"] <= 345 and sizes["pairs"] <= 345


def test_a_long_document_of_copies_is_split_once(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    item = " ".join(word() for _ in range(20))
    text = " ".join(f"{item} {word()}" for _ in range(4_000))
    found = decontamination.matches(
        spark.createDataFrame([(1, text)], "doc_id long, text string"), spark.createDataFrame([(5, item)], "item_id long, text string"))
    assert [(r.doc_id, r.item_id, r.start, r.similarity) for r in found.collect()] == [(1, 5, 0, 1.0)]


def test_clean_keeps_the_rest(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "beta gamma delta epsilon zeta eta"), (2, "one"), (3, None)], "item_id long, text string")
    kept = decontamination.clean(odd_docs, items)
    assert kept.columns == odd_docs.columns
    assert sorted(kept.collect(), key=str) == sorted((r for r in odd_docs.collect() if "gamma" not in (r.text or "") and "one" not in (r.text or "")), key=str)
    assert decontamination.clean(no_docs, items).collect() == []
    assert decontamination.clean(odd_docs, items.limit(0)).count() == odd_docs.count()


def test_default_distance_equals_brute_force_at_the_least_similarity(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    items = [(k, " ".join(word() for _ in range(22))) for k in range(300)]
    docs = [(k, " ".join([*item.split()[:-2], word(), word()])) for k, item in items]  # 16 shingles of 20 are shared
    want = naive(docs, items)
    found = decontamination.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.doc_id, r.item_id): r.similarity for r in found.collect()}
    assert len(want) == 300 and got == {k: pytest.approx(v[0]) for k, v in want.items()}


def test_every_window_is_looked_at(spark):
    """Passages whose parts changed places: no shared shingle stands where the item has it, and the best window starts elsewhere."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    items = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate([40, 60, 80, 41, 75])]
    docs = []
    for k, item in items:
        w = item.split()
        half = len(w) // 2
        docs.append((k, " ".join([*(word() for _ in range(50)), *w[half:], *w[:half], *(word() for _ in range(50))])))
        docs.append((100 + k, " ".join([*w[half:], *w[:half]])))
        docs.append((200 + k, " ".join([*(word() for _ in range(7)), *w[half:], *w[:half]])))
    docs += [(300, " ".join([word(), *items[0][1].split()[2:], word()])), (301, items[1][1].rsplit(" ", 4)[0])]
    want = naive(docs, items)
    found = decontamination.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.doc_id, r.item_id): (r.similarity, r.start) for r in found.collect()}
    assert got == {k: (pytest.approx(v), s) for k, (v, s) in want.items()} and len(want) >= 14


def test_matches_and_starts_equal_brute_force(spark, corpus):
    docs, items = corpus
    want = naive(docs, items)
    found = decontamination.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.doc_id, r.item_id): (r.similarity, r.start) for r in found.collect()}
    assert got == {k: (pytest.approx(v), s) for k, (v, s) in want.items()}


def test_no_window_is_lost_beyond_the_distance(spark):
    """Repeated shingles weigh as much as they occur, so one copy more or less may turn half of the bits."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    pairs = [(word(), word()) for _ in range(20)]
    items = [(k, " ".join([a, b] * 10 + [a])) for k, (a, b) in enumerate(pairs)]
    docs = [(k, " ".join([b, a] * 10 + [b])) for k, (a, b) in enumerate(pairs)]  # 16 of 18 shingles are shared
    want = naive(docs, items)
    found = decontamination.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.doc_id, r.item_id): (r.similarity, r.start) for r in found.collect()}
    assert len(want) == 20 and got == {k: (pytest.approx(v), s) for k, (v, s) in want.items()}
    few = decontamination.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), distance=2)
    assert {(r.doc_id, r.item_id) for r in few.collect()} == set(want)


def test_texts_of_few_words_equal_brute_force_by_firm_bits(spark):
    rng = random.Random(13)
    items, docs = [], []
    for k in range(60):
        few = ["ab", "cd", "ef"][:rng.choice([2, 3])]
        item = (rng.choices(few, k=rng.randint(1, 6)) * 40)[:rng.randint(6, 50)]
        items.append((k, " ".join(item)))
        for j in range(4):
            turn = rng.randrange(len(item))
            words = [*item[turn:], *item[:turn]][rng.randint(0, 2):]
            words[rng.randrange(len(words))] = rng.choice(few)
            docs.append((10 * k + j, " ".join([*rng.choices(few, k=rng.choice([0, 9])), *words, *rng.choices(few, k=rng.choice([0, 9]))])))
    want = naive(docs, items)
    found = decontamination.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), distance=2)
    got = {(r.doc_id, r.item_id): (r.similarity, r.start) for r in found.collect()}
    assert len(want) > 200 and got == {k: (pytest.approx(v), s) for k, (v, s) in want.items()}
