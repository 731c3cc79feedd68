import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

from paneltide.llm.packing import Encoder, Vocabulary, pack
from paneltide.llm.queries import vocabulary


@pytest.fixture(scope="module")
def encoder():
    return Encoder(vocabulary())


@pytest.fixture(scope="module")
def untouched():
    """The tokenizer as its file says."""
    return Tokenizer.from_file(vocabulary().tokenizer)


def whole(encoder, text):
    return list(getattr(encoder, "tokenizer", encoder).encode(text or "", add_special_tokens=False).ids)


@pytest.mark.parametrize("text", ["x <|endoftext|> y", "<|endoftext|>", "<|endoftext|><|endoftext|>\n", "a<|endoftext|", "é<|endoftext|>é" * 50])
def test_added_tokens_are_read_as_the_file_says(docs, encoder, untouched, text):
    assert encoder.encode(text).tolist() == whole(untouched, text)
    assert ids(pack(docs(text), vocabulary()).first().ids) == [*whole(untouched, text), 1]


def test_added_tokens_have_ids_of_their_own(untouched):
    assert whole(untouched, "x <|endoftext|> y") == [87, 220, 50256, 331]


def ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


@pytest.mark.parametrize("text", [
    "", " ", "\n", "a", " a", "a ", "a \n", "a\n\nb", "a  b", "\ta", "it's we'll\nI'm", "\na\n", "x <|endoftext|> y",
    "é b", "12 345\n6 7", "!!! ???", "a\r\nb", "日本 語\nテ", "a b c"])
def test_ranks_give_the_ids_of_the_tokenizer(encoder, untouched, text):
    assert encoder.encode(text, check=True).tolist() == whole(untouched, text)


def test_all_documents_have_the_ids_of_the_tokenizer(encoder):
    for (text,) in duckdb.sql("SELECT text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall():
        encoder.encode(text, check=True)


def test_without_ranks(docs, encoder):
    texts = ["a b", "", "x " * 200]
    alone = pack(docs(*texts), Vocabulary(vocabulary().tokenizer), length=64)
    assert sorted(alone.collect()) == sorted(pack(docs(*texts), vocabulary(), length=64).collect())


def test_pieces_hold_every_id_once(odd_docs, encoder):
    rows = pack(odd_docs, vocabulary(), length=64).collect()
    texts = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in odd_docs.collect())
    want = sorted(tuple(whole(encoder, t) + [1]) for *_, t in texts)
    stream = {}
    for r in rows:
        got = ids(r.ids)
        assert len(got) == r.length and r.offset + r.length <= 64
        for k, token in enumerate(got):
            place = (r.sequence_id, r.offset + k)
            assert place not in stream
            stream[place] = token
    flat = [stream[p] for p in sorted(stream)]
    total = sum(map(len, want))
    assert sorted(stream) == [(k // 64, k % 64) for k in range(total)]  # full sequences but for the last
    documents, start = [], 0
    for k, token in enumerate(flat):
        if token == 1:
            documents.append(tuple(flat[start:k + 1]))
            start = k + 1
    assert sorted(documents) == want


def test_starts_follow_one_another(docs):
    rows = pack(docs("a b c " * 500, "", "x y"), vocabulary(), length=128).orderBy("doc_id", "start").collect()
    at = {}
    for r in rows:
        assert r.start == at.get(r.doc_id, 0)
        at[r.doc_id] = r.start + r.length
        assert r.doc_tokens >= at[r.doc_id]


def test_empty_table(no_docs):
    assert pack(no_docs, vocabulary()).collect() == []
