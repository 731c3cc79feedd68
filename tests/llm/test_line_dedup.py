import random
import re

from hypothesis import given
from hypothesis import strategies as st

from paneltide.llm import line_dedup


@given(st.lists(st.sampled_from("abcdefg"), max_size=14), st.lists(st.sampled_from("abcdefg"), max_size=14))
def test_blocks_are_common_and_in_order(a, b):
    i = j = 0
    for x, y, n in line_dedup.align(a, b):
        assert x >= i and y >= j and n > 0 and a[x:x + n] == b[y:y + n]
        i, j = x + n, y + n
    if a == b:
        assert line_dedup.align(a, b) == ([(0, 0, len(a))] if a else [])


def test_patience_keeps_the_longest_order():
    a, b = list("xpqrsy"), list("upzqrsw")
    assert line_dedup.align(a, b) == [(1, 1, 1), (2, 3, 3)]
    assert line_dedup.align(list("abcd"), list("cdab")) in ([(0, 2, 2)], [(2, 0, 2)])


# Letters of scripts without spaces between words.
ALONE = re.compile("[\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u9FFF\uF900-\uFAFF\U00020000-\U0003FFFF]")
SPACE = re.compile("[ \t\n\x0b\f\r]+")


def words_of(line):
    """How many words a line counts as."""
    bare = ALONE.sub(lambda c: f" {c[0]} ", line).strip(" ")
    return len(SPACE.split(bare)) if SPACE.search(bare) else max(1, len(bare) // 5)


def naive(rows, short_runs=False, least=5):
    """Texts after deletion, by the rule: a line goes if it is in a run of `least` words or more that
    stands anywhere in the lines of a document that owns one of its keys."""
    texts = {d: (t or "").split("\n") for d, t in rows}
    lines = {d: [x.strip(" ") for x in own] for d, own in texts.items()}
    sizes = {d: [words_of(x) for x in own] for d, own in texts.items()}

    def keys(d):
        for i in range(len(lines[d])):
            if not short_runs:
                if sizes[d][i] >= least:
                    yield (lines[d][i],)
                continue
            n = next((n for n in range(1, len(lines[d]) - i + 1) if sum(sizes[d][i:i + n]) >= least), None)
            if n:
                yield tuple(lines[d][i:i + n])

    owner = {}
    for d in sorted(lines):
        for key in keys(d):
            owner.setdefault(key, d)
    out = {}
    for d, a in lines.items():
        gone = set()
        for o in {owner[key] for key in keys(d)} - {d}:
            b = lines[o]
            for i in range(len(a)):
                for j in range(len(b)):
                    if a[i] != b[j] or (i and j and a[i - 1] == b[j - 1]):
                        continue
                    n = 1
                    while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                        n += 1
                    if sum(sizes[d][i:i + n]) >= least:
                        gone.update(range(i, i + n))
        out[d] = "\n".join(x for k, x in enumerate(texts[d]) if k not in gone)
    return out


def test_equals_brute_force(spark):
    rng = random.Random(4)
    pool = [" ".join(rng.choices(["la", "le", "lo", "lu"], k=rng.randint(1, 9))) for _ in range(60)]
    rows = []
    for d in range(150):
        own = [f"line {d} {k} of its own here" for k in range(rng.randint(0, 6))]
        at, n = rng.randrange(60), rng.randint(1, 8)
        place = rng.randint(0, len(own))
        own[place:place] = pool[at:at + n]
        rows.append((d, "\n".join(own)))
    rows += [(200, rows[5][1]), (201, rows[5][1]), (202, "\n".join([rows[7][1], rows[9][1]]))]
    want = naive(rows)
    got = {r.doc_id: r for r in line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {d: r.text for d, r in got.items()} == want
    assert all(r._gone == r.text.count("\n") * 0 + r._lines - (len(r.text.split("\n")) if r._gone < r._lines else 0) for r in got.values())
    earlier, total = set(), 0
    for d, text in rows:  # whatever went stands in an earlier document
        left = {}
        for x in got[d].text.split("\n"):
            left[x] = left.get(x, 0) + 1
        for x in text.split("\n"):
            if left.get(x, 0):
                left[x] -= 1
            else:
                assert x in earlier
                total += 1
        earlier.update(text.split("\n"))
    assert total > 100


def test_long_passage_in_many_documents(docs):
    passage = "\n".join(f"passage line {k} with quite a few words in it" for k in range(8))
    rows = line_dedup.dedup(docs(*[f"start of document {k} is its own\n{passage}\nand end of {k} is too" for k in range(300)])).collect()
    assert sum(passage in r.text for r in rows) == 1
    assert all(f"start of document {r.doc_id} is its own" in r.text for r in rows)


def test_odd_and_empty(odd_docs, no_docs):
    rows = line_dedup.dedup(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        if r.doc_id is None and r.text is not None:
            assert r.text == "" and r._gone_ == 1 if "_gone_" in r else r.text == ""
    kept = line_dedup.rest(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(map(str, kept.collect())) == sorted(str(r) for r in odd_docs.collect() if not (r.doc_id is None and r.text))
    assert line_dedup.rest(no_docs).collect() == []


def test_moved_and_repeated_passages_leave_nothing(docs):
    rng = random.Random(8)
    passages = [[f"passage {p} line {k} with quite a few words" if k % 2 else f"p {p} {k}" for k in range(6)] for p in range(6)]
    texts = ["\n".join(sum(passages, []) + passages[2])]
    for d in range(60):
        parts = [rng.choice(passages) for _ in range(5)] + [[f"own line {d} {k} of this document"] for k in range(2)]
        rng.shuffle(parts)
        texts.append("\n".join(sum(parts, [])))
    rows = {r.doc_id: r.text for r in line_dedup.dedup(docs(*texts)).collect()}
    assert rows[0] == texts[0]
    for d in range(60):
        assert sorted(rows[d + 1].split("\n")) == [f"own line {d} {k} of this document" for k in range(2)]


@given(st.lists(st.sampled_from("abcd"), max_size=14), st.lists(st.sampled_from("abcd"), max_size=14), st.integers(1, 4))
def test_common_lines_are_those_in_runs_of_the_owner(a, b, least):
    def stands(run):
        return any(b[j:j + len(run)] == run for j in range(len(b)))

    want = {k for i in range(len(a)) for until in range(i + least, len(a) + 1) if stands(a[i:until]) for k in range(i, until)}
    assert {k for i, until in line_dedup.common(a, [1] * len(a), b, least) for k in range(i, until)} == want


def test_passages_of_short_lines_pair_documents(docs):
    verse = "\n".join(["so it goes", "on and on", "till", "the end", "comes"])
    menu = "\n".join(["soup of day", "a sea fish", "tea"])
    chinese = "这是一行没有空格的文字"
    code = "for(i=0;i<n;i++){total+=values[i];}"
    texts = [verse, menu, chinese, code, f"first line\n{verse}\nlast", f"{menu}\nmine", f"{chinese}\n独有", f"x = 1\n{code}\ny = 2", "tea\nsoup of day"]
    texts += ["a line of more than five words", "short one\nother\na line of more than five words", "new\nshort one\nother\na line of more than five words"]
    rows = {r.doc_id: r.text for r in line_dedup.dedup(docs(*texts), short_runs=True).collect()}
    assert [rows[k] for k in range(4)] == texts[:4]
    assert [rows[k] for k in range(4, 9)] == ["first line\nlast", "mine", "独有", "x = 1\ny = 2", "tea\nsoup of day"]
    assert [rows[k] for k in range(9, 12)] == [texts[9], "short one\nother", "new"]


def test_short_runs_equal_brute_force(spark):
    rng = random.Random(6)
    pool = [" ".join(rng.choices(["la", "le", "lo"], k=rng.randint(1, 6))) for _ in range(40)]
    rows = [(d, "\n".join(pool[at] if rng.random() < 0.9 else f"own {d}" for at in range(a, a + rng.randint(1, 6)))) for d, a in ((d, rng.randrange(34)) for d in range(100))]
    rows += [(100, "这是一行没有空格的文字\nla\nle"), (101, "x\n这是一行没有空格的文字\nla"), (102, f"{rows[3][1]}\n{rows[3][1]}\n\n{rows[4][1]}")]
    want = naive(rows, short_runs=True)
    got = {r.doc_id: r.text for r in line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string"), short_runs=True).collect()}
    assert got == want and sum(t != dict(rows)[d] for d, t in got.items()) > 40


@given(st.lists(st.sampled_from("abcd"), max_size=14), st.lists(st.sampled_from("abcd"), max_size=14), st.lists(st.integers(1, 3), min_size=4, max_size=4), st.integers(1, 5))
def test_blocks_from_shared_runs_are_those_in_runs_of_the_owner(a, b, widths, least):
    sizes = [widths["abcd".index(x)] for x in a]
    want, shared = set(), []
    for i in range(len(a)):
        for until in range(i + 1, len(a) + 1):
            j = next((j for j in range(len(b)) if b[j:j + until - i] == a[i:until]), None)
            if sum(sizes[i:until]) >= least and j is not None:
                want.update(range(i, until))
                if sum(sizes[i:until - 1]) < least or sum(sizes[i + 1:until]) < least:
                    shared.append((i, until - i, j))
    assert {k for i, until in line_dedup.shared_blocks(a, sizes, shared, least) for k in range(i, until)} == want


def test_a_very_long_owner_is_not_sent_to_its_later_documents(docs):
    import time

    long = [f"line {k} of the very long document here" for k in range(200_000)]
    texts = ["\n".join(long)] + ["\n".join([f"own {d}", *long[100 * d:100 * d + 20]]) for d in range(1000)]
    start = time.perf_counter()
    rows = {r.doc_id: r.text for r in line_dedup.dedup(docs(*texts), anywhere=True).collect()}
    assert time.perf_counter() - start < 60
    assert rows[0] == texts[0] and all(rows[d + 1] == f"own {d}" for d in range(1000))


def test_texts_of_one_id_do_not_run_into_one_another(spark):
    one = "\n".join(f"first text line {k} has words" for k in range(6))
    two = "\n".join(f"second text line {k} has words" for k in range(6))
    rows = [(1, one), (1, two), (1, one), (2, f"{two}\nmine\n{one}"), (2, f"{two}\nmine\n{one}"), (None, one)]
    got = line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string"), anywhere=True).collect()
    assert sorted((str(r.doc_id), r.text) for r in got) == sorted([("1", one), ("1", two), ("1", one), ("2", "mine"), ("2", "mine"), ("None", "")])


def test_anywhere_equals_brute_force(spark):
    rng = random.Random(9)
    pool = [" ".join(rng.choices(["la", "le", "lo"], k=rng.randint(1, 6))) for _ in range(40)]
    rows = [(d, "\n".join(rng.choice(pool[at:at + 2]) if rng.random() < 0.9 else f"own {d}" for at in range(a, a + rng.randint(1, 9)))) for d, a in ((d, rng.randrange(30)) for d in range(120))]
    rows += [(200, "这是一行没有空格的文字\nla\nle"), (201, "x\n这是一行没有空格的文字\nla"), (202, f"{rows[3][1]}\n{rows[3][1]}\n\n{rows[4][1]}"), (203, None), (204, "")]
    lines = {d: [x.strip(" ") for x in (t or "").split("\n")] for d, t in rows}
    want = {}
    for d, own in lines.items():
        gone = set()
        for i in range(len(own)):
            for until in range(i + 1, len(own) + 1):
                if sum(map(words_of, own[i:until])) >= 5 and any(
                        b[j:j + until - i] == own[i:until] for o, b in lines.items() if o < d for j in range(len(b))):
                    gone.update(range(i, until))
        want[d] = "\n".join(x for k, x in enumerate((dict(rows)[d] or "").split("\n")) if k not in gone)
    got = {r.doc_id: r.text or "" for r in line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string"), anywhere=True).collect()}
    assert got == want and sum(t != (dict(rows)[d] or "") for d, t in got.items()) > 60


def test_anywhere_odd_and_empty(odd_docs, no_docs):
    rows = line_dedup.dedup(odd_docs, anywhere=True).collect()
    assert len(rows) == odd_docs.count() and all(r.text == "" for r in rows if r.doc_id is None and r.text is not None)
    assert line_dedup.rest(no_docs, anywhere=True).collect() == []
    assert line_dedup.rest(odd_docs, anywhere=True).columns == odd_docs.columns
