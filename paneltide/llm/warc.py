"""WARC archives: writing, and reading back with segments put together.

Writing: each row becomes a response record with an HTTP message in chunked transfer framing,
or a revisit record that names the response if a smaller id has the same payload. A block
over `segment` bytes is cut: the first piece is the response record with segment number 1, the
others are continuation records that carry the origin's record id, and the last of them the
total length. Records are the lines of Spark's text writer, whose separator is the empty
lines that end a WARC record, so archives go wherever Spark can write, gzip-compressed.

Reading: files are parsed by their Content-Length fields. Continuation records are grouped by
origin id, ordered by segment number, checked for gaps and for the stated total length and
joined; then the HTTP header is cut off and the chunks are decoded. A damaged record raises.

Results for odd input: a null payload is an empty one; ids may be null or repeated, each row
gets a record of its own, and rows equal in id and payload to the first are responses too;
a null id is larger than any other; an empty table gives an archive without records.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paneltide.functions.materialize import new_folder
from paneltide.llm.common import by_value, join_hot, text_of, written

LEAST = 0
SEGMENT = 32 << 10
CHUNK = 8 << 10
RECORDS = 10_000  # of an archive, so with segments of 32 KB one has some hundred MB at most
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
RECORD = "kind string, record_id string, origin_id string, page_id long, refers_to long, digest string, segment int, total long, length long, block binary"
FIELDS = ("WARC-Type", "WARC-Record-ID", "WARC-Segment-Origin-ID", "X-Page-ID", "X-Refers-To-Page-ID", "WARC-Payload-Digest", "WARC-Segment-Number", "WARC-Segment-Total-Length")


def _base32(digest: str) -> str:
    import base64

    return base64.b32encode(bytes.fromhex(digest)).decode()


def _framed(payload: bytes) -> bytes:
    chunks = [payload[i:i + CHUNK] for i in range(0, len(payload), CHUNK)]
    return HTTP + b"".join(b"%x\r\n%b\r\n" % (len(c), c) for c in chunks) + b"0\r\n\r\n"


def unframed(block: bytes) -> bytes:
    """The payload of an HTTP message in chunked transfer framing."""
    head, _, body = block.partition(b"\r\n\r\n")
    if b"transfer-encoding: chunked" not in head.lower():
        return body
    parts, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        if not size:
            return b"".join(parts)
        parts.append(body[line + 2:line + 2 + size])
        at = line + 2 + size
        if len(parts[-1]) != size or body[at:at + 2] != b"\r\n":
            raise ValueError("broken chunk")
        at += 2


def _record(block: bytes, **fields) -> bytes:
    lines = [f"{k.replace('_', '-')}: {v}" for k, v in fields.items() if v is not None]
    head = "\r\n".join(["WARC/1.1", *lines, f"WARC-Date: {DATE}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"])
    return head.encode() + b"\r\n\r\n" + block


def _records(segment: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        from pyspark import TaskContext

        part, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            out = []
            for page_id, url, digest, first, revisit, payload in zip(*batch.columns, strict=True):
                page_id, url, digest, first, payload = (x.as_py() for x in (page_id, url, digest, first, payload))
                record_id = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{part}/{row}/{page_id}/{digest}')}>"
                row += 1
                known = {"WARC_Record_ID": record_id, "WARC_Target_URI": " ".join(url.split()) if url else None, "X_Page_ID": page_id, "WARC_Payload_Digest": f"sha1:{_base32(digest)}"}
                if revisit.as_py():
                    out.append(_record(b"", WARC_Type="revisit", X_Refers_To_Page_ID=first, WARC_Profile="http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", **known))
                    continue
                block = _framed(payload)
                cuts = [block[i:i + segment] for i in range(0, len(block), segment)]
                out.append(_record(cuts[0], WARC_Type="response", WARC_Segment_Number=1 if len(cuts) > 1 else None, **known))
                for number, cut in enumerate(cuts[1:], 2):
                    own = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{record_id}/{number}')}>"
                    total = len(block) if number == len(cuts) else None
                    out.append(_record(cut, WARC_Type="continuation", WARC_Record_ID=own, WARC_Segment_Origin_ID=record_id, WARC_Segment_Number=number, WARC_Segment_Total_Length=total))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    return task


def write(pages: DataFrame, folder: str, segment: int = SEGMENT, least: int = LEAST, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> None:
    """Archives of all rows below `folder`. Payloads under `least` bytes are always responses."""
    by_value(__name__)
    payload = text_of(payload_col).cast("binary")
    keyed = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.sha1(payload).alias("digest"), payload.alias("payload"))
    small = written(keyed.select("page_id", "digest"), "digests")
    firsts = written(small.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")), "firsts")
    ranked = join_hot(keyed, firsts, "digest", "n", small.count())
    again = (F.octet_length("payload") >= least) & ~F.col("page_id").eqNullSafe(F.col("first"))
    rows = ranked.select("page_id", "url", "digest", "first", again.alias("revisit"), F.when(~again, F.col("payload")).alias("payload"))
    records = rows.mapInArrow(_records(segment), "record binary").select(F.col("record").cast("string").alias("value"))
    records.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", RECORDS).text(folder)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import gzip
    import io

    schema = pa.schema([("kind", pa.string()), ("record_id", pa.string()), ("origin_id", pa.string()), ("page_id", pa.int64()), ("refers_to", pa.int64()), ("digest", pa.string()), ("segment", pa.int32()), ("total", pa.int64()), ("length", pa.int64()), ("block", pa.binary())])

    def whole(text):
        return None if text is None else int(text)

    for batch in batches:
        for content in batch.column(0):
            data = content.as_buffer()
            packed = bytes(data[:2]) == b"\x1f\x8b"
            stream = io.BufferedReader(gzip.open(pa.BufferReader(data)) if packed else pa.BufferReader(data), 1 << 20)
            rows, size = [], 0
            while line := stream.readline():
                if not line.startswith(b"WARC/"):
                    raise ValueError(f"no record at {line[:40]!r}")
                fields = {}
                while (line := stream.readline()) not in (b"\r\n", b""):
                    name, _, value = line.decode().partition(":")
                    fields[name] = value.strip()
                length = int(fields["Content-Length"])
                block = stream.read(length)
                if len(block) != length or stream.read(4) != b"\r\n\r\n":
                    raise ValueError("the archive ends within a record")
                kind, own, origin, page, refers, digest, number, total = (fields.get(f) for f in FIELDS)
                rows.append((kind, own, origin or own, whole(page), whole(refers), (digest or "").removeprefix("sha1:") or None, whole(number), whole(total), length, block))
                size += length
                if size > 4 << 20:
                    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema)


def records(spark: SparkSession, folder: str) -> DataFrame:
    """All records of the archives below `folder`, as they stand there."""
    by_value(__name__)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content")
    return files.mapInArrow(_parse, RECORD)


def _joined(rows):
    """One block from the segments of an origin."""
    rows = rows.sort_by("segment")
    numbers, total = rows["segment"].to_pylist(), rows["total"].to_pylist()[-1]
    blocks = rows["block"].to_pylist()
    if numbers != list(range(1, len(numbers) + 1)) or total != sum(map(len, blocks)):
        raise ValueError(f"segments {numbers} of {rows['record_id'][0]} are not whole")
    kept = ("kind", "record_id", "page_id", "refers_to", "digest")
    return pa.table({c: rows[c].slice(0, 1) for c in kept} | {"block": pa.array([b"".join(blocks)], pa.binary())})


def _payloads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import base64
    import hashlib

    for batch in batches:
        payloads = [unframed(b.as_py()) for b in batch.column("block")]
        digests = [base64.b32encode(hashlib.sha1(p).digest()).decode() for p in payloads]
        if digests != batch.column("digest").to_pylist():
            raise ValueError("a payload differs from its digest")
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("digest"), pa.array(payloads, pa.binary())], ["page_id", "digest", "payload"])


def read(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(responses, revisits): (page_id, digest, payload) and (page_id, refers_to, digest)."""
    every = written(records(spark, folder), "records")  # archives are parsed once
    shape = "kind string, record_id string, page_id long, refers_to long, digest string, block binary"
    cut = every.filter(F.col("segment").isNotNull()).groupBy("origin_id").applyInArrow(_joined, shape)
    single = every.filter((F.col("kind") == "response") & F.col("segment").isNull()).select(*cut.columns)
    responses = single.unionByName(cut).mapInArrow(_payloads, "page_id long, digest string, payload binary")
    return responses, every.filter("kind = 'revisit'").select("page_id", "refers_to", "digest")


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every row, read from archives just written."""
    spark = pages.sparkSession
    folder = new_folder(spark, "warc")
    write(pages, folder, **options)
    responses, revisits = read(spark, folder)
    sized = written(responses.select("page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), F.col("digest").alias("payload_digest")), "payloads")
    again = written(revisits.select("page_id", "refers_to", F.col("digest").alias("payload_digest")), "revisits")
    lengths = sized.groupBy("payload_digest").agg(F.first("payload_bytes").alias("payload_bytes"))
    counts = again.groupBy("payload_digest").agg(F.count("*").alias("n"))
    known = join_hot(again, lengths.join(counts, "payload_digest"), "payload_digest", "n", again.count())
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return sized.withColumns({"record_type": F.lit("response"), "refers_to": F.lit(None).cast("long")}).select(columns).unionByName(
        known.withColumn("record_type", F.lit("revisit")).select(columns))
