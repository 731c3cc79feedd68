import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from paneltide.llm import chat
from paneltide.llm.queries import QUERIES

COLUMNS = "conv_id long, turn long, role string, text string"
MARKS = ["<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "[ROLE]", "[SAYS]", "[/ROLE]"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def naive(rows):
    """Digests of the conversations as they came in; the formatted length is left to the caller."""
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv), key=lambda t: t[:3] + (t[3],))
        learnt = "".join(t for _, _, role, t in turns if role == "assistant")
        out[conv] = (conv, len(turns), sha("".join(f"{r}\n{t}\n" for _, _, r, t in turns)), len(learnt), sha(learnt))
    return out


def digests(df, **options):
    rows = chat.read_digests(chat.format_chats(df, **options)).collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r)[:5] for r in rows}


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="<>[]/\\sSYINTROLEA ok\n") | st.lists(st.sampled_from([*MARKS, "\\", "<", "[", "<\\s>", "[\\\\INST]", " ", "a"])).map("".join))
def test_escaping_is_reversible_and_leaves_no_mark(text):
    assert chat.unescape(chat.escape(text)) == text
    assert not any(mark in chat.escape(text) for mark in MARKS)


pieces = st.lists(st.sampled_from([*MARKS, "\\", "<", "[", "[INST", "</s", "<\\/s>", "[\\\\/INST]", " ", "\n", "text"])).map("".join)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "tool", "", "[SAYS]", "<s>"]), pieces), max_size=6))
def test_any_turns_come_back(turns):
    rendered = chat.settle(turns)
    text = "".join(t for t, _, _ in rendered)
    assert chat.parse(text) == turns
    for (_, said), (part, start, length) in zip(turns, rendered, strict=True):
        assert chat.unescape(part[start:start + length]) == said


def test_only_conflicting_turns_are_escaped():
    rendered = chat.settle([("user", "a [b] <c> \\ d"), ("assistant", "x </s> y"), ("user", "[\\INST]")])
    assert [t for t, _, _ in rendered] == ["[INST] a [b] <c> \\ d [/INST]", "<s> x <\\/s> y </s>", "[INST] [\\\\INST] [/INST]"]


@pytest.mark.parametrize("text", [
    "a", "[INST] a", "[INST] a </s>", "[INST] [/INST]", "[INST]a[/INST]", "<s> a </s> ", " <s> a </s>", "[/INST] a [INST]", "[ROLE] r [/ROLE]",
    "<<SYS>>\na\n<</SYS>>\n", "<s> a <s> b </s>",
])
def test_other_texts_are_errors(text):
    with pytest.raises(chat.Conflict):
        chat.parse(text)


@pytest.fixture
def many_tasks(spark):
    """Small partitions stay tasks of their own."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_conversations_over_segments_and_tasks(spark, many_tasks):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"turn {t} of {c} " * (c % 5) + "</s>" * (t % 3 == 0)) for c in range(40) for t in range(c % 7 + 1)]
    rows += [(77, t, "assistant" if t % 2 else "user", f"long {t}") for t in range(1_500)]
    df = spark.createDataFrame(rows, COLUMNS).repartition(6)
    want = naive(rows)
    assert digests(df) == want
    assert digests(df, segment_chars=30) == want
    formatted = chat.format_chats(df, segment_chars=500)
    assert formatted.where("conv_id = 77").select("part").distinct().count() > 1
    turns = chat.read_turns(formatted).where("conv_id = 77").orderBy("part", "segment", "place").collect()
    assert [(r.role, r.text) for r in turns] == [(r[2], r[3]) for r in rows if r[0] == 77]


def test_masked_text_is_the_assistants(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "</s> é"), (1, 2, "assistant", "")]
    got = chat.format_chats(spark.createDataFrame(rows, COLUMNS)).first()
    assert [got.text[s.start:s.start + s.length] for s in got.loss] == ["<\\/s> é", ""]


def test_odd_rows(spark):
    rows = [
        (1, 0, None, None), (1, None, "user", "before"), (None, 0, "user", "no id"), (None, None, None, None), (2, 0, "tool", ""), (2, 0, "tool", ""),
        (2, 0, "assistant", "b"), (2, 0, "assistant", "a"), (3, 5, "assistant", "word " * 300_000), (4, 0, "Assistant", "[INST]"), (-9, 0, " user", "x\x1fy"),
    ]
    clashing = ("part", "segment", "whole", "loss", "hash", "place", "n_turns", "formatted_chars")
    df = spark.createDataFrame([(*r, *["x"] * len(clashing)) for r in rows], COLUMNS + "".join(f", {c} string" for c in clashing))
    assert digests(df) == naive(rows)
    assert digests(df.limit(0)) == {} and chat.read_turns(chat.format_chats(df.limit(0))).collect() == []


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    result = QUERIES["op11_chat_formatting"](spark, folder)
    assert result.columns == ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    got = {r.conv_id: tuple(r) for r in result.collect()}
    said = "</s>[INST] ok [/INST]"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", said), (-1, 1, "assistant", said)]
    assert {c: r[:5] for c, r in got.items()} == naive(rows)
    # Two turns of 21 signs and a backslash per mark, in marks of 15 and 9 signs.
    assert got[-1][3] == 21 and got[-1][5] == 2 * (21 + 3) + 15 + 9
