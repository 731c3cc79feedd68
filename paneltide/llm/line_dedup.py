"""Line dedup by pairwise alignment: common blocks go from the later document.

Each line of `words` words or more is hashed. The smallest id that has a line owns it; every
other document with the line is paired with the owner. So a line found in a handful of
documents and one found in millions give one pair for each document that has it, and all
pairs together are no more than the lines. The two documents of a pair are aligned by patience
diff: common ends first, then lines that occur once in both, in their longest increasing order,
and the same between these. Aligned lines that stand together in both documents form a
block; a block of `words` words or more is deleted from the later document. Lines that are
left are then held to the whole owner: a run of `words` words or more that stands anywhere in
it goes too, so passages in another order and repeated ones leave nothing. Whatever is
deleted from a document stands in an earlier one, and the owner's copy of a line stays.

With `short_runs` the owned keys are runs instead: from each line on, the shortest run that
has `words` words. So documents are also paired through passages of shorter lines.

With `anywhere` a line goes if it is in a run of `words` words or more that stands in any earlier
document, its owners or others. The owned keys are the shortest runs of `words` words that begin or end
at each line, and the aligner gets the lines of shared runs only, of both documents, with a gap
wherever others stood between. An owner's lines come with the keys and the places that it has them
at: its own lines are not sent, and a document goes to the aligner once, with all its owners. So work
and shuffled rows follow the lines of the later documents, however long an owner is. Runs that the
alignment leaves, moved or repeated ones, are aligned again with the stretch of the owner
that they have their keys from.

Letters of scripts without spaces count as words, and so do each CHARS characters of a line without any.

Results for odd input: a null text is an empty one; rows with the same id count as one
document and are not compared with one another; a null id is later than any other; an empty
text has one empty line, which is never deleted; empty tables give no rows; other columns are
handed on as they are.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate, groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paneltide.llm.common import by_value, fresh, join_hot, text_of, written

WORDS = 5
CHARS = 5  # of a line without spaces that count as a word
SCRIPTS = r"[\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{3400}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}]"  # Thai, Lao, Myanmar, Khmer, kana, Han
LAST = (1 << 63) - 1


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest part of pairs, sorted by the first, in which the second increases too."""
    tops, at, before = [], [], []
    for k, (_, j) in enumerate(pairs):
        pile = bisect_left(tops, j)
        if pile == len(tops):
            tops.append(j)
            at.append(k)
        else:
            tops[pile], at[pile] = j, k
        before.append(at[pile - 1] if pile else -1)
    found, k = [], at[-1] if at else -1
    while k >= 0:
        found.append(pairs[k])
        k = before[k]
    return found[::-1]


def align(a: list, b: list) -> list[tuple[int, int, int]]:
    """Blocks (i, j, n) with a[i:i+n] == b[j:j+n], in order, by patience diff."""
    matched, open_ranges = [], [(0, len(a), 0, len(b))]
    while open_ranges:
        i, m, j, n = open_ranges.pop()
        while i < m and j < n and a[i] == b[j]:
            matched.append((i, j))
            i, j = i + 1, j + 1
        while i < m and j < n and a[m - 1] == b[n - 1]:
            m, n = m - 1, n - 1
            matched.append((m, n))
        if i == m or j == n:
            continue
        in_a, in_b = Counter(a[i:m]), Counter(b[j:n])
        place = {b[k]: k for k in range(j, n) if in_b[b[k]] == 1}
        anchors = _increasing([(k, place[a[k]]) for k in range(i, m) if in_a[a[k]] == 1 and a[k] in place])
        if not anchors:
            continue
        matched += anchors
        for (i0, j0), (i1, j1) in zip([(i - 1, j - 1), *anchors], [*anchors, (m, n)], strict=True):
            if i1 > i0 + 1 and j1 > j0 + 1:
                open_ranges.append((i0 + 1, i1, j0 + 1, j1))
    blocks: list[tuple[int, int, int]] = []
    for i, j in sorted(matched):
        if blocks and blocks[-1][0] + blocks[-1][2] == i and blocks[-1][1] + blocks[-1][2] == j:
            blocks[-1] = (*blocks[-1][:2], blocks[-1][2] + 1)
        else:
            blocks.append((i, j, 1))
    return blocks


def longest_runs(a: list, b: list) -> list[tuple[int, int]]:
    """(first, until) of all runs of a that stand somewhere in b and cannot be longer, by a suffix automaton of b."""
    steps, link, length, last = [{}], [-1], [0], 0
    for x in b:
        now = len(steps)
        steps.append({})
        link.append(0)
        length.append(length[last] + 1)
        p, last = last, now
        while p >= 0 and x not in steps[p]:
            steps[p][x] = now
            p = link[p]
        if p < 0:
            continue
        q = steps[p][x]
        if length[p] + 1 < length[q]:
            copy = len(steps)
            steps.append(dict(steps[q]))
            link.append(link[q])
            length.append(length[p] + 1)
            while p >= 0 and steps[p].get(x) == q:
                steps[p][x] = copy
                p = link[p]
            link[q] = q = copy
        link[now] = q
    runs, state, n = [], 0, 0
    for k, x in enumerate(a):
        while state and x not in steps[state]:
            state = link[state]
            n = length[state]
        state, n = (steps[state][x], n + 1) if x in steps[state] else (0, 0)
        if n and runs and runs[-1][0] == k + 1 - n:
            runs[-1] = (k + 1 - n, k + 1)
        elif n:
            runs.append((k + 1 - n, k + 1))
    return runs


def stretches(flags) -> list[tuple[int, int]]:
    """(first, until) of neighbouring true flags."""
    out, k = [], 0
    for value, same in groupby(flags, bool):
        n = sum(1 for _ in same)
        if value:
            out.append((k, k + n))
        k += n
    return out


def common(a: list, sizes: list[int], b: list, least: int) -> list[tuple[int, int]]:
    """(first, until) of the lines of a to delete: aligned blocks of `least` words or more, then what they
    leave of other runs of that size that stand anywhere in b, moved or repeated."""
    before = [0, *accumulate(sizes)]
    out = [(i, i + n) for i, _, n in align(a, b) if before[i + n] - before[i] >= least]
    left = [True] * len(a)
    for i, until in out:
        left[i:until] = [False] * (until - i)
    held = set(b)
    if any(any(left[i:until]) and before[until] - before[i] >= least for i, until in stretches(x in held for x in a)):
        edges = [0] * (len(a) + 1)
        for i, until in longest_runs(a, b):
            if before[until] - before[i] >= least:
                edges[i] += 1
                edges[until] -= 1
        out += stretches(n > 0 and rest for n, rest in zip(accumulate(edges), left))
    return sorted(out)


def _align(least: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, text_hash, a, sizes, owner, b in zip(*batch.columns, strict=True):
                sizes = sizes.as_py()
                for i, until in common(a.as_py(), sizes, b.as_py(), least):
                    out.append((key.as_py(), text_hash.as_py(), owner.as_py(), i, until))
            if out:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["key", "text_hash", "owner", "first", "until"])

    return task


def _gapped(lines: dict[int, int]) -> tuple[list, list[int]]:
    """Lines by their places, in order, with a line like no other wherever places are left out; and the places."""
    out, places = [], []
    for at in sorted(lines):
        if places and places[-1] + 1 != at:
            out.append(("gap", id(lines), at))
            places.append(at - 1)
        out.append(lines[at])
        places.append(at)
    return out, places


def shared_blocks(a: list, sizes: list[int], shared: list[tuple[int, int, int]], least: int) -> list[tuple[int, int]]:
    """(first, until) of the lines of a to delete, given the shared runs (i, n, j): n lines that
    stand at i in a and at j in its owner."""
    before = [0, *accumulate(sizes)]
    shared = sorted(shared)
    mine, kept = {}, {}
    for i, n, j in shared:
        for k in range(n):
            mine[i + k] = kept[j + k] = a[i + k]
    x, at = _gapped(mine)
    y, _ = _gapped(kept)
    found = [(at[i], at[i] + n) for i, _, n in align(x, y)]
    out = [(i, until) for i, until in found if before[until] - before[i] >= least]
    covered = {k for i, until in out for k in range(i, until)}
    stretch = None  # first line, place in the owner, end
    again = []
    for i, n, j in shared:
        if all(k in covered for k in range(i, i + n)):
            continue
        if stretch and i <= stretch[2] and i - stretch[0] == j - stretch[1]:
            stretch[2] = max(stretch[2], i + n)
        else:
            stretch = [i, j, i + n]
            again.append(stretch)
    for i, j, until in again:
        out += [(i + k, i + k + n) for k, _, n in align(a[i:until], [kept[j + k] for k in range(until - i)])]
    return sorted(set(out))


REMOVED = "array<struct<first:int,until:int,owner:long>>"


def _align_runs(least: int):
    kind = pa.list_(pa.struct([("first", pa.int32()), ("until", pa.int32()), ("owner", pa.int64())]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed = []
            for hashes, sizes, shared in zip(*batch.columns[2:], strict=True):
                hashes, sizes, by_owner = hashes.as_py(), sizes.as_py(), {}
                for s in shared.as_py():
                    by_owner.setdefault(s["owner"], []).append((s["i"], s["n"], s["place"]))
                found = [(i, until, o) for o, own in by_owner.items() for i, until in shared_blocks(hashes, sizes, own, least)]
                removed.append([{"first": i, "until": until, "owner": o} for i, until, o in sorted(found)])
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(removed, kind)], ["key", "text_hash", "removed"])

    return task


def _by_runs(sequences: DataFrame, words: int) -> DataFrame:
    """(key, text_hash, removed) of the documents that share runs with earlier ones."""
    each = sequences.select("key", "text_hash", F.explode(runs(words)).alias("r")).select("key", "text_hash", "r.*")
    # A place says which text of an id it is in as well, so texts of one id do not run into one another.
    place = F.shiftleft("text_hash", 32) + F.col("i")
    first = each.groupBy("h").agg(F.min("key").alias("owner"), F.max("key").alias("last"), F.min_by(place, "key").alias("place"), F.count("*").alias("rows"))
    owners = written(first.filter("owner <> last").drop("last"), "owners")
    total = owners.agg(F.sum("rows")).first()[0] or 0
    shared = join_hot(each, owners, "h", "rows", total).filter("key <> owner")
    found = shared.groupBy("key", "text_hash").agg(F.collect_set(F.struct("i", "n", "owner", "place")).alias("shared"))
    once = sequences.dropDuplicates(["key", "text_hash"])
    both = once.join(found, ["key", "text_hash"]).select("key", "text_hash", "hashes", "sizes", "shared")
    return both.mapInArrow(_align_runs(words), f"key long, text_hash long, removed {REMOVED}")


def apart(text: Column) -> Column:
    """The text with spaces around each letter of a script that has none between words."""
    return F.when(text.rlike(SCRIPTS), F.regexp_replace(text, f"({SCRIPTS})", " $1 ")).otherwise(text)


def size(line: Column) -> Column:
    """How many words a line counts as: a line without spaces has one for each CHARS characters, or one."""
    bare = F.trim(line)
    return F.when(bare.rlike(r"\s"), F.size(F.split(bare, r"\s+"))).otherwise(F.greatest(F.lit(1), F.floor(F.length(bare) / CHARS).cast("int")))


def windows(words: int) -> Column:
    """For each line the hash of the shortest run from it that has `words` words; null where the text ends before.

    A line that has them alone has its own hash. Every line counts as a word at least, so a
    run has `words` lines at most. A shared run of that size has the key of its first line.
    """
    def key(h: Column, i: Column) -> Column:
        sizes, hashes = [F.get("sizes", i)], [h]
        found = F.when(sizes[0] >= words, h)
        for n in range(1, words):
            sizes.append(sizes[-1] + F.get("sizes", i + n))
            hashes.append(F.get("hashes", i + n))
            found = found.when(sizes[-1] >= words, F.xxhash64(*hashes))
        return found

    return F.transform("hashes", key)


def runs(words: int) -> Column:
    """(i, n, h) of the shortest runs with `words` words that begin or end at each line; h is the hash of their n lines.

    A line that has them alone has its own hash. Every line counts as a word at least, so a run
    has `words` lines at most. Any longer run is made of those that begin at its lines and the one
    that ends with it, so these say whether a line is in a run that stands elsewhere.
    """
    def run(i: Column, n: int) -> Column:
        lines = [F.get("hashes", i + k) for k in range(n)]
        return F.struct(i.alias("i"), F.lit(n).alias("n"), (F.xxhash64(*lines) if n > 1 else lines[0]).alias("h"))

    def both(_: Column, i: Column) -> Column:
        size = F.get("sizes", i)
        begins, ends, ahead, back = F.when(size >= words, run(i, 1)), F.when(size >= words, None), size, size
        for n in range(2, words + 1):
            ahead, back = ahead + F.get("sizes", i + n - 1), back + F.get("sizes", i - n + 1)
            begins = begins.when(ahead >= words, run(i, n))
            # The shortest run that ends here may be the shortest from its first line, too.
            ends = ends.when(back >= words, F.when(back - size >= words, run(i - n + 1, n)))
        return F.array(begins, ends)

    return F.filter(F.flatten(F.transform("hashes", both)), lambda r: r.isNotNull())


def blocks(docs: DataFrame, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text", short_runs: bool = False, anywhere: bool = False) -> DataFrame:
    """(key, text_hash, removed): removed lists (first, until, owner), the lines to delete and who keeps them.

    key is the id, or the largest integer for a null id.
    """
    by_value(__name__)
    text = text_of(text_col)
    lines = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("key"), F.xxhash64(text).alias("text_hash"), F.split(text, "\n", -1).alias("lines"), F.transform(F.split(apart(text), "\n", -1), size).alias("sizes"))
    hashed = lines.select("key", "text_hash", F.transform("lines", lambda x: F.xxhash64(F.trim(x))).alias("hashes"), "sizes")
    sequences = written(hashed, "sequences")
    if anywhere:
        return _by_runs(sequences, words)
    if short_runs:
        each = sequences.select("key", F.explode(windows(words)).alias("h")).filter("h is not null")
    else:
        each = sequences.select("key", F.explode(F.arrays_zip("hashes", "sizes")).alias("x")).filter(F.col("x.sizes") >= words).select("key", F.col("x.hashes").alias("h"))
    owners = written(each.groupBy("h").agg(F.min("key").alias("owner"), F.max("key").alias("last"), F.count("*").alias("n")).filter("owner <> last").drop("last"), "owners")
    total = owners.agg(F.sum("n")).first()[0] or 0
    pairs = written(join_hot(each, owners, "h", "n", total).filter("key <> owner").select("key", "owner").distinct(), "pairs")
    later = pairs.join(sequences, "key")
    held = pairs.groupBy("owner").agg(F.count("*").alias("n"))
    owned = sequences.select(F.col("key").alias("owner"), F.col("hashes").alias("kept")).join(held, "owner")
    aligned = join_hot(later, owned, "owner", "n", pairs.count()).select("key", "text_hash", "hashes", "sizes", "owner", "kept")
    found = aligned.mapInArrow(_align(words), "key long, text_hash long, owner long, first int, until int")
    return found.groupBy("key", "text_hash").agg(F.array_sort(F.collect_set(F.struct("first", "until", "owner"))).alias("removed"))


def _delete(place: int, names: list[str]):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, gone = [], [], []
            for text, removed in zip(batch.column(place), batch.columns[-1], strict=True):
                text = text.as_py()
                if removed.as_py() is None:
                    texts.append(text)
                    counts.append((text or "").count("\n") + 1)
                    gone.append(0)
                    continue
                kept, at, lines = [], 0, text.split("\n")
                for r in removed.as_py():  # in order of their first lines
                    kept += lines[at:r["first"]]
                    at = max(at, r["until"])
                kept += lines[at:]
                texts.append("\n".join(kept))
                counts.append(len(lines))
                gone.append(len(lines) - len(kept))
            columns = [*batch.columns[:-1], pa.array(counts, pa.int32()), pa.array(gone, pa.int32()), batch.columns[-1]]
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], *names])

    return task


def dedup(docs: DataFrame, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text", short_runs: bool = False, anywhere: bool = False) -> DataFrame:
    """`docs` with shorter texts, and _lines, _gone (counts of lines) and _removed (see blocks; null if none)."""
    key, text_hash, removed, own, own_hash = (fresh(docs, n) for n in ("_key", "_hash", "_removed", "_own", "_own_hash"))
    found = written(blocks(docs, words, id_col, text_col, short_runs, anywhere), "removed").withColumnsRenamed({"key": key, "text_hash": text_hash, "removed": removed})
    keyed = docs.withColumns({own: F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)), own_hash: F.xxhash64(text_of(text_col))})
    joined = keyed.join(found, (F.col(own) == F.col(key)) & (F.col(own_hash) == F.col(text_hash)), "left").select(*docs.columns, removed)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    names = [fresh(docs, "_lines"), fresh(docs, "_gone"), removed]
    shape = f"{fields}, `{names[0]}` int, `{names[1]}` int, `{names[2]}` {REMOVED}"
    return joined.mapInArrow(_delete(docs.columns.index(text_col), names), shape)


def rest(docs: DataFrame, **options) -> DataFrame:
    """`docs` with shorter texts, without the documents that lost all they had."""
    text_col = options.get("text_col", "text")
    gone = fresh(docs, "_gone")
    kept = dedup(docs, **options).filter((F.col(gone) == 0) | (F.col(text_col) != ""))
    return kept.select(*docs.columns)
