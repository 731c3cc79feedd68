import base64
import hashlib
import random

import pytest

from paneltide.llm import warc

KIND = "page_id long, url string, html string, kind string"


def naive(rows):
    first = {}
    for page, _, html, *_ in rows:
        data = (html or "").encode()
        if page is not None:
            first[data] = min(page, first.get(data, page))
    out = []
    for page, _, html, *_ in rows:
        data = (html or "").encode()
        again = page != first.get(data)
        out.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response", first.get(data) if again else None))
    return sorted(out, key=str)


def pages(seed=0):
    rng = random.Random(seed)
    rows = [(k, f"http://x.example/{k}", "é😀\r\n\r\nWARC/1.1\r\n0\r\n" * rng.choice([0, 1, 7, 900, 9000]) + str(rng.randint(0, 4)), "x") for k in range(60)]
    return [*rows, (100, None, None, "x"), (101, "a b\r\nc: d", "", "x"), (101, "u", "", "x"), (100, None, None, "x"), (None, "u", "only here", "x")]


def test_round_trip_of_the_digest(spark):
    rows = [r for r in pages() if r[0] is not None]
    got = warc.round_trip(spark.createDataFrame(rows, KIND))
    assert sorted((tuple(r) for r in got.collect()), key=str) == naive(rows)


def test_payloads_come_back_whole(spark, tmp_path):
    rows = pages(1)
    warc.write(spark.createDataFrame(rows, KIND).repartition(3), f"{tmp_path}/w", segment=5000)
    kinds = [r.kind for r in warc.records(spark, f"{tmp_path}/w").select("kind").collect()]
    assert kinds.count("continuation") > 50
    responses, revisits = warc.read(spark, f"{tmp_path}/w")
    got = [(r.page_id, bytes(r.payload)) for r in responses.collect()]
    by_digest = {base64.b32encode(hashlib.sha1(p).digest()).decode(): p for _, p in got}
    got += [(r.page_id, by_digest[r.digest]) for r in revisits.collect()]
    assert sorted(got, key=str) == sorted(((p, (h or "").encode()) for p, _, h, _ in rows), key=str)


def test_least_length_of_revisits(spark):
    rows = [(1, "u", "short", "x"), (2, "u", "short", "x"), (3, "u", "long enough", "x"), (4, "u", "long enough", "x")]
    got = {r.page_id: r.record_type for r in warc.round_trip(spark.createDataFrame(rows, KIND), least=10).collect()}
    assert got == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_empty(spark):
    assert warc.round_trip(spark.createDataFrame([], KIND)).collect() == []


@pytest.mark.parametrize("damage", [lambda b: b[:-30], lambda b: b.replace(b"WARC-Segment-Number: 2", b"WARC-Segment-Number: 7"), lambda b: b.replace(b"Total-Length: ", b"Total-Length: 1"), lambda b: b.replace(b"aaaa", b"bbbb", 1)])
def test_damage_is_found(spark, tmp_path, damage):
    import gzip

    warc.write(spark.createDataFrame([(1, "u", "a" * 9000, "x")], KIND).coalesce(1), f"{tmp_path}/w", segment=5000)
    for part in (tmp_path / "w").glob("part-*"):
        (tmp_path / "w" / f".{part.name}.crc").unlink(missing_ok=True)
        part.write_bytes(gzip.compress(damage(gzip.decompress(part.read_bytes()))))
    with pytest.raises(Exception, match="(?s)ends within|not whole|differs|broken chunk|no record"):
        responses, _ = warc.read(spark, f"{tmp_path}/w")
        responses.collect()


def test_extra_columns_with_clashing_names(spark):
    rows = [r for r in pages(2) if r[0] is not None][:20]
    kind = KIND + ", payload string, digest string, first long, n long, record string, _hot string"
    wide = spark.createDataFrame([(*r, "p", "d", 7, 8, "r", "h") for r in rows], kind)
    assert sorted((tuple(r) for r in warc.round_trip(wide).collect()), key=str) == naive(rows)
