"""Runs of words that repeat with a period, found by recursive frequency splitting and a lag scan.

A run with period q is a longest stretch of words in which words q apart are identical, q the
smallest such number. A run of at least `repeats` periods holds each of its words at least
`repeats` times, so a word that occurs less often within the current segment is in no run of
it: it splits the segment. Pieces are split again by their own counts until nothing changes.
Of two pieces the counts of the longer follow from those of the whole less the shorter, so the
work is n log n words, however deep the splits go. Ordinary text is gone after that.

The lag scan of a segment that is left takes its lags from repeated windows. In a run of period
q the window of k >= q words at any place comes again q words later and not before. So the lags up to
16 are the distances at which windows of 16 words come again next, those of 17 to 32 are those of
windows of 32 words, and so on; windows are numbered by doubling. From each place so named the
words are compared at that lag in both directions as far as they agree, which gives the whole run.

Each text is worked on by itself, in one pass without a shuffle.

Results for odd input: a null text has no words, an empty list of runs and empty collapsed
text, as an empty one has; rows with the same id are texts of their own; a table without
rows gives no rows; columns other than id and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneltide.llm.common import by_value, text_of

FOUND = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
SLICE_BYTES = 8 << 20


class Shape:
    """What counts as a run: at least `words` words and `repeats` periods."""

    def __init__(self, words: int = 24, repeats: int = 3):
        if repeats < 3 or words < 24:
            raise ValueError("the lag scan needs runs of three periods and 24 words")
        self.words, self.repeats = words, repeats


def numbers(words: list[bytes]):
    """A number for every word, the same for the same word, and how many there are."""
    import numpy as np

    coded = pa.array(words, pa.large_binary()).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(coded.dictionary)


def segments(ids, kinds: int, shape: Shape) -> list[tuple[int, int]]:
    """The stretches (begin, end) that are left when no word is too rare in its stretch."""
    import numpy as np

    places = np.argsort(ids, kind="stable")
    first = np.searchsorted(ids[places], np.arange(kinds + 1))
    tally = np.zeros(kinds, np.int64)
    work, left = [(0, len(ids))], []
    while work:
        lo, hi = work.pop()
        if hi - lo < shape.words:
            continue
        used, counts = np.unique(ids[lo:hi], return_counts=True)
        tally[used] = counts
        cuts = lo + np.flatnonzero(tally[ids[lo:hi]] < shape.repeats)
        while len(cuts):
            begins, ends = np.append(lo, cuts + 1), np.append(cuts, hi)
            longest = int(np.argmax(ends - begins))
            for k in np.flatnonzero(ends - begins >= shape.words):
                if k != longest:
                    work.append((int(begins[k]), int(ends[k])))
            a, b = int(begins[longest]), int(ends[longest])
            gone, counts = np.unique(np.concatenate([ids[lo:a], ids[b:hi]]), return_counts=True)
            tally[gone] -= counts
            lo, hi = a, b
            if hi - lo < shape.words:
                break
            rare = gone[(tally[gone] > 0) & (tally[gone] < shape.repeats)]
            # Fewer than `repeats` places each, found among all places of the word.
            found = []
            for word in rare:
                at = places[first[word]:first[word + 1]]
                found.append(at[np.searchsorted(at, lo):np.searchsorted(at, hi)])
            cuts = np.sort(np.concatenate(found)) if found else np.empty(0, np.int64)
        if hi - lo >= shape.words:
            left.append((lo, hi))
        tally[used] = 0
    return sorted(left)


def _agree(a, b) -> int:
    """How many leading elements of two arrays are equal."""
    import numpy as np

    n, done, step = min(len(a), len(b)), 0, 32
    a, b = a[:n], b[:n]
    while done < n:
        differs = np.flatnonzero(a[done:done + step] != b[done:done + step])
        if len(differs):
            return done + int(differs[0])
        done, step = done + step, step * 2
    return n


def lag_scan(ids, shape: Shape) -> dict[tuple[int, int], int]:
    """(start, length) of every run of one segment, with its smallest period."""
    import numpy as np

    runs: dict[tuple[int, int], int] = {}
    n, width, window = len(ids), 1, ids
    low = 0
    while low < n // shape.repeats:
        # Numbers of windows of twice the words, from those of the two halves.
        while width < 16 or width <= low:
            if len(window) <= width:
                return runs
            pairs = window[:-width] * (int(window.max()) + 1) + window[width:]
            window = np.unique(pairs, return_inverse=True)[1].reshape(-1)
            width *= 2
        order = np.argsort(window, kind="stable")
        again = window[order[1:]] == window[order[:-1]]
        places, lags = order[:-1][again], (order[1:] - order[:-1])[again]
        near = (lags > low) & (lags <= min(width, n // shape.repeats))
        places, lags = places[near], lags[near]
        # Neighbouring places with the same lag name the same run.
        sort = np.lexsort((places, lags))
        places, lags = places[sort], lags[sort]
        new = np.ones(len(places), bool)
        new[1:] = (np.diff(places) != 1) | (np.diff(lags) != 0)
        seen, lag = -1, -1
        for i, q in zip(places[new].tolist(), lags[new].tolist(), strict=True):
            if q == lag and i < seen:
                continue
            forward = _agree(ids[i:], ids[i + q:])
            back = _agree(ids[:i][::-1], ids[:i + q][::-1][:i])
            start, length = i - back, back + forward + q
            lag, seen = q, i + forward
            if length >= max(shape.words, shape.repeats * q):
                runs[start, length] = min(q, runs.get((start, length), q))
        low = width
    return runs


def find(words: list[bytes], shape: Shape) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, in order of start and period."""
    if len(words) < shape.words:
        return []
    ids, kinds = numbers(words)
    found = []
    for lo, hi in segments(ids, kinds, shape):
        for (start, length), period in lag_scan(ids[lo:hi], shape).items():
            found.append((lo + start, length, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that any run holds after its first period."""
    import numpy as np

    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    kept = np.cumsum(change[:-1]) == 0
    return [words[k] for k in np.flatnonzero(kept)] if runs else words


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """Every tenth id, by its checksum, gets a periodic end; a row without an id stays as it is."""
    n = len(words)
    if doc_id is None or n == 0:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def _scan(shape: Shape, with_planted: bool):
    kinds = [
        pa.int64(), pa.int64(),
        pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])), pa.string()]

    def batch(rows: list) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "n_words", "runs", "collapsed"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for texts in batches:
            for doc_id, text in zip(texts.column(0), texts.column(1), strict=True):
                doc_id = doc_id.as_py()
                # Splitting bytes without an argument cuts at the six ASCII white characters and no others.
                words = text.as_py().encode().split()
                if with_planted:
                    words = planted(words, doc_id)
                runs = find(words, shape)
                collapsed = b" ".join(collapse(words, runs)).decode()
                rows.append((doc_id, len(words), [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs], collapsed))
                size += len(collapsed) + 100 * len(runs)
                if size >= SLICE_BYTES:
                    yield batch(rows)
                    rows, size = [], 0
        if rows:
            yield batch(rows)

    return task


def periodic_runs(
    docs: DataFrame, words: int = 24, repeats: int = 3, with_planted: bool = False, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): all runs by start and period, and the text without their repeats.

    Words are separated by ASCII white space. `with_planted` first makes the ends of some texts
    periodic, by their id.
    """
    by_value(__name__)
    plain = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_of(F.col(f"`{text_col}`")).alias("text"))
    return plain.mapInArrow(_scan(Shape(words, repeats), with_planted), FOUND)


def digests(found: DataFrame) -> DataFrame:
    """One row per text: number of runs, the one with most periods, and digests of the runs and of the collapsed text."""
    # The run with the greatest length / period; products of two 64-bit numbers are exact as decimals.
    def longer(best, run):
        ours = run["length"].cast("decimal(19,0)") * best["period"].cast("decimal(19,0)")
        theirs = best["length"].cast("decimal(19,0)") * run["period"].cast("decimal(19,0)")
        return F.when(best.isNull() | (ours > theirs), run).otherwise(best)

    # Runs come in order of start and period, so the first of equals stays.
    nothing = F.lit(None).cast("struct<start:long,length:long,period:long>")
    listed = F.concat_ws("", F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))))
    best = found.withColumn("best", F.aggregate("runs", nothing, longer))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("cast(1000 * best.length div best.period as long)").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
