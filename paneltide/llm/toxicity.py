"""Toxicity: a support vector machine on a gap-weighted subsequence kernel with Nyström landmarks.

The kernel compares words by their subsequences of three letters (the beginning of a word
counts as a letter); a subsequence that stretches over more letters than three weighs DECAY
for each of the others, up to SPAN letters. So words that share a stem, or have letters put
in between, stay alike. Signs within a word are left out, look-alike digits and signs are read
as letters, and letters spaced out one by one are joined, before words are compared.

Landmarks are stems (words or their beginnings): those whose document frequencies differ between the two labels by more
than chance brings among as many stems,
picked by pivoted Cholesky steps of the kernel matrix until every such stem is close to what is
picked, and some usual words. The inverse root of the landmarks' kernel matrix turns kernel values with the
landmarks into Nyström features, on which a linear machine is trained. Labels are given for
documents, so the machine learns from the words of each toxic document that it finds toxic,
one at least, and the worst few of each other document; the choice is made anew after each
training. One
word may look like an insult by chance, several hardly do, and long texts have more chances: a
logistic curve over the values of a text's words of ranks TOPS and the logarithm of their number, fitted on the same sample, is the score.

Results for odd input: null and empty texts score as a sentence without words; repeated rows
score alike; without any labelled row every score is 0, with labels of one class only every
score is that class; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneltide.llm import labelled
from paneltide.llm.common import by_value, text_of

DECAY, SPAN, LONGEST = 0.6, 6, 24
USUAL_LANDMARKS, RESIDUAL, LOWEST = 2, 0.05, -2.0
STEM = 4
CHANCE = 0.01  # of any stem that tells nothing to be taken for a telling one
TOPS = (1, 2, 3, 5, 8)  # a text is judged by its words of these ranks, the worst first
LETTERS = 41
TRAIN_CELLS = 1_000_000  # of the kernel matrix at a time
ENDS = ".,;:!?\"'()[]{}*#$%&|-_"
LOOKALIKES = str.maketrans("013457@$", "oieastas")
SPACED = re.compile(r"(?<!\S)[^\W_](?: [^\W_]){3,}(?!\S)")


def bare(word: str) -> str:
    """The letters of a lower-case word, without what stands before and after them."""
    inner = word.strip(ENDS)
    if inner.isalpha():
        return inner
    inner = re.sub(r"^[\W_]+|[\W_]+$", "", inner)
    if any(c.isalpha() for c in inner):
        inner = inner.translate(LOOKALIKES)
    return "".join(c for c in inner if c.isalpha())


def words_of(texts: list[str]):
    """(different words without signs, place of each word among them, first word of each text).

    Letters spaced out one by one are joined. A text has one word at least, be it empty.
    """
    import numpy as np

    split = [t.lower().split() or [""] for t in texts]
    vocabulary, places, counts = labelled.numbered(split)
    single = np.fromiter((len(w) == 1 for w in vocabulary), bool, len(vocabulary))[places]
    if len(single) > 3 and (run := single[:-3] & single[1:-2] & single[2:-1] & single[3:]).any():
        for k in np.unique(np.searchsorted(np.cumsum(counts), np.flatnonzero(run), side="right")):
            split[k] = SPACED.sub(lambda m: m[0].replace(" ", ""), " ".join(split[k])).split()
        vocabulary, places, counts = labelled.numbered(split)
    letters = [bare(w) for w in vocabulary]
    different = {w: k for k, w in enumerate(dict.fromkeys(letters))}
    places = np.fromiter((different[w] for w in letters), np.int64, len(letters))[places]
    return list(different), places, np.cumsum(counts) - counts


class Kernel:
    """Kernel values of words against landmarks."""

    def __init__(self, landmarks: list[str]):
        import numpy as np

        self.landmarks = landmarks
        triples, rows, weights, norms = self.triples(landmarks)
        self.slots = np.full(LETTERS ** 3, -1, np.int32)
        used = np.unique(triples)
        self.slots[used] = np.arange(len(used))
        table = np.zeros((len(used), len(landmarks)), np.float32)
        np.add.at(table, (self.slots[triples], rows), weights)
        self.table = table / np.sqrt(np.maximum(norms, 1e-9)).astype(np.float32)

    @staticmethod
    def triples(words: list[str], slots=None):
        """(triple, row, weight) of all subsequences, and each word's norm as if they all differed.

        A word over LONGEST letters is cut into overlapping pieces before (see `values`).
        """
        import numpy as np

        letters = np.frombuffer("".join(["^" + w for w in words]).encode("utf-32-le"), "<u4")
        lengths = np.fromiter((len(w) + 1 for w in words), np.int64, len(words))
        codes = np.where((letters >= 97) & (letters <= 122), letters - 96, np.where(letters == 94, 40, 27 + letters % 13)).astype(np.int64)
        start = np.repeat(np.cumsum(lengths) - lengths, lengths)
        place = np.arange(len(codes)) - start
        left = np.repeat(lengths, lengths) - place  # letters from here to the end
        row = np.repeat(np.arange(len(words)), lengths)
        found, norms = [], np.zeros(len(words))
        for b in range(2, SPAN):
            at = np.flatnonzero(left > b)
            if not len(at):
                break
            ends = codes[at] * LETTERS * LETTERS + codes[at + b]
            weight = DECAY ** (b - 2)
            norms += np.maximum(lengths - b, 0) * (b - 1) * weight ** 2
            for a in range(1, b):
                triple, rows = ends + codes[at + a] * LETTERS, row[at]
                if slots is not None:
                    hit = slots[triple] >= 0
                    triple, rows = triple[hit], rows[hit]
                found.append((triple, rows, np.full(len(triple), weight, np.float32)))
        if not found:
            none = np.zeros(0, np.int64)
            return none, none, none.astype(np.float32), norms
        return (*(np.concatenate(c) for c in zip(*found, strict=True)), norms)

    @staticmethod
    def pieces(words: list[str]) -> tuple[list[str], list[int]]:
        """Words, long ones as overlapping parts, and the place of each one's first part."""
        pieces, first = [], []
        for word in words:
            first.append(len(pieces))
            if len(word) <= LONGEST:
                pieces.append(word)
            else:
                pieces += [word[at:at + LONGEST] for at in range(0, len(word) - LONGEST // 2, LONGEST // 2)]
        return pieces, first

    def sums(self, words: list[str], weights):
        """The weighted sum of the values with all landmarks for each word, without working out each."""
        import numpy as np

        pieces, first = self.pieces(words)
        triples, rows, parts, norms = self.triples(pieces, self.slots)
        found = np.bincount(rows, parts * (self.table @ weights)[self.slots[triples]], len(pieces))
        return np.maximum.reduceat(found / np.sqrt(np.maximum(norms, 1e-9)), first)

    def values(self, words: list[str]):
        """One row for each word, one column for each landmark; 0 to about 1."""
        import numpy as np

        pieces, first_piece = self.pieces(words)
        triples, rows, weights, norms = self.triples(pieces, self.slots)
        out = np.zeros((len(pieces), len(self.landmarks)), np.float32)
        if len(triples):
            order = np.argsort(rows, kind="stable")
            rows = rows[order]
            parts = weights[order, None] * self.table[self.slots[triples[order]]]
            first = np.flatnonzero(np.diff(rows, prepend=-1))
            out[rows[first]] = np.add.reduceat(parts, first, axis=0)
            out /= np.sqrt(np.maximum(norms, 1e-9)).astype(np.float32)[:, None]
        if len(pieces) == len(words):
            return out
        return np.maximum.reduceat(out, first_piece, axis=0)


def _likelihood(one, zero, n: list[int]):
    """How much likelier the counts are with a rate for each label than with one for both; 0 where label 1 has the lower."""
    import numpy as np

    def part(k, of, rate):
        return np.where(k > 0, k * np.log(np.maximum(k, 1e-9) / np.maximum(of * rate, 1e-9)), 0)

    rate = (one + zero) / max(1, sum(n))
    gain = part(one, n[1], rate) + part(zero, n[0], rate) + part(n[1] - one, n[1], 1 - rate) + part(n[0] - zero, n[0], 1 - rate)
    return np.where(one * n[0] > zero * n[1], gain, 0)


def _landmarks(words: list[str], held: list, labels: list[int]) -> tuple[list[str], int]:
    """Stems that tell the labels apart, unlike one another, then usual words; and how many the first are.

    Stems are the words and all their beginnings of STEM letters or more. One counts as telling if
    its likelihood gain is beyond what the luckiest of that many stems would reach by chance, so the
    bar follows from the number of stems tested; one that is too rare to reach the bar is no test.
    """
    import numpy as np

    n = [labels.count(v) for v in (0, 1)]
    stems: dict[str, int] = {}
    of_word = [[stems.setdefault(w[:k], len(stems)) for k in range(STEM, min(len(w), LONGEST) + 1)] for w in words]
    seen = np.zeros((2, len(stems)), np.int64)
    for h, label in zip(held, labels, strict=True):
        seen[label, list({s for w in h.tolist() for s in of_word[w]})] += 1
    gap = _likelihood(seen[1].astype(float), seen[0].astype(float), n)
    total = seen.sum(axis=0).astype(float)
    at_most, tested = _likelihood(np.minimum(total, n[1]), np.maximum(total - n[1], 0), n), len(stems)
    while (fewer := int((at_most > math.log(max(1, tested) / CHANCE)).sum())) < tested:
        tested = fewer
    least = math.log(max(1, tested) / CHANCE)
    names = list(stems)
    # Of a stem and its continuation in the same documents the longer one stays.
    shorter = {stems[s[:-1]] for s, k in stems.items() if len(s) > STEM and (seen[:, stems[s[:-1]]] == seen[:, k]).all()}
    telling = [k for k in np.argsort(-gap, kind="stable").tolist() if gap[k] > least and k not in shorter]
    common = np.bincount(np.concatenate([h for h, v in zip(held, labels, strict=True) if not v]), minlength=len(words))
    long = np.fromiter((len(w) >= 3 for w in words), bool, len(words))
    usual = [words[k] for k in np.argsort(-common * long, kind="stable")[:USUAL_LANDMARKS].tolist()]
    picked: list[int] = []
    if telling:
        names = [names[k] for k in telling]
        worth = np.sqrt(gap[telling])
        rest, columns = np.ones(len(names)), np.zeros((len(names), 0))
        rest[:] = [Kernel([n]).values([n])[0, 0] for n in names]
        while (rest >= RESIDUAL).any():
            k = int(np.argmax(np.where(rest >= RESIDUAL, rest * worth, -1)))
            column = Kernel([names[k]]).values(names)[:, 0].astype(float) - columns @ columns[k]
            columns = np.hstack([columns, (column / math.sqrt(rest[k]))[:, None]])
            rest = np.maximum(rest - columns[:, -1] ** 2, 0)
            rest[k] = 0
            picked.append(k)
    return [names[k] for k in picked] + usual, len(picked)


def _machine(x, rows, y, weights, penalty: float = 1e-4):
    """Weights of a linear machine under the squared hinge loss, by Newton steps; the last is the bias.

    Examples are rows of x, which may be used more than once.
    """
    import numpy as np

    x = np.hstack([x, np.ones((len(x), 1))])
    ridge = penalty * weights.sum() * np.eye(x.shape[1])
    w, active = np.zeros(x.shape[1]), np.ones(len(rows), bool)
    for _ in range(30):
        each = np.bincount(rows[active], weights[active], len(x))
        signed = np.bincount(rows[active], weights[active] * y[active], len(x))
        w = np.linalg.solve((x * each[:, None]).T @ x + ridge, x.T @ signed)
        now = y * (x @ w)[rows] < 1
        if (now == active).all():
            break
        active = now
    return w


def _curve(x, y, weights):
    """Weights of the logistic curve with the least loss over the columns of x; the last is the offset."""
    import numpy as np

    x = np.hstack([x, np.ones((len(x), 1))])
    w, ridge = np.zeros(x.shape[1]), 1e-3 * weights.sum() * np.eye(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weights * (p - y)) + ridge @ w
        bend = (x * (weights * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge
        w = w - np.linalg.solve(bend, slope)
    return w


def _tops(f, first):
    """For each text the values of its words of ranks TOPS and the logarithm of their number.

    A text with fewer words has the value LOWEST for those it lacks.
    """
    import numpy as np

    lengths = np.diff(np.append(first, len(f)))
    text = np.repeat(np.arange(len(first)), lengths)
    order = np.lexsort((-f, text))
    sorted_f = np.maximum(f[order], LOWEST)
    columns = []
    for rank in TOPS:
        at = first + rank - 1
        columns.append(np.where(rank <= lengths, sorted_f[np.minimum(at, len(f) - 1)], LOWEST))
    return np.stack([*columns, np.log1p(lengths)], axis=1)


class Model:
    """Scores texts; small enough to go along with every task."""

    def __init__(self, texts: list[str], labels: list[int], weights: list[float], rounds: int = 4):
        import numpy as np

        self.constant = None if len(set(labels)) == 2 else float(labels[0]) if labels else 0.0
        if self.constant is not None:
            return
        words, places, first = words_of(texts)
        ends = [*first[1:], len(places)]
        held = [np.unique(places[a:b]) for a, b in zip(first, ends, strict=True)]
        landmarks, telling = _landmarks(words, held, labels)
        self.kernel = Kernel(landmarks)
        m = self.kernel.values(landmarks).astype(float)
        value, vector = np.linalg.eigh((m + m.T) / 2)
        good = value > 1e-3
        root = (vector[:, good] / np.sqrt(value[good])) @ vector[:, good].T
        y, weights = np.array(labels), np.array(weights)
        step = max(1, TRAIN_CELLS // len(landmarks))

        def each_part(work, of):
            return np.concatenate([work(of[a:a + step]) for a in range(0, len(of), step)])

        # Before any training: likeness to a telling word.
        f = each_part(lambda part: self.kernel.values(part)[:, :max(1, telling)].max(axis=1), words)
        least = 0.9
        for _ in range(rounds):
            rows, sign = [], []
            for of, label in zip(held, labels, strict=True):
                top = of[np.argsort(-f[of], kind="stable")[:4]]
                if label:
                    top = of[f[of] >= min(least, f[top[0]])]
                rows.append(top)
                sign += [2.0 * label - 1] * len(top)
            sign, least = np.array(sign), 0.0
            each = np.where(sign > 0, 0.5 / (sign > 0).sum(), 0.5 / (sign < 0).sum())
            used, where = np.unique(np.concatenate(rows), return_inverse=True)
            features = each_part(lambda part: self.kernel.values(part) @ root.astype(np.float32), [words[k] for k in used])
            w = _machine(features.astype(float), where, sign, each)
            f = each_part(lambda part: self.kernel.sums(part, (root @ w[:-1]).astype(np.float32)), words) + w[-1]
        self.weights, self.bias = (root @ w[:-1]).astype(np.float32), float(w[-1])
        self.curve = _curve(_tops(f[places].astype(float), first), y, weights / weights.mean())

    def scores(self, texts: list[str]):
        import numpy as np

        if self.constant is not None:
            return np.full(len(texts), self.constant)
        words, places, first = words_of(texts)
        f = (self.kernel.sums(words, self.weights) + self.bias)[places].astype(float)
        return 1 / (1 + np.exp(-np.clip(_tops(f, first) @ self.curve[:-1] + self.curve[-1], -30, 30)))


def _score(model: Model):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in labelled.slices(batch, 2):
                ids, folds = (batch.column(c).slice(first, len(texts)) for c in (0, 1))
                yield pa.RecordBatch.from_arrays([ids, folds, pa.array(model.scores(texts), pa.float64())], ["doc_id", "held_out", "score"])

    return task


def classify(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 4, fold: int = 2, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text", **bounds) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; learns outside the held-out fold."""
    by_value(__name__)
    by_value(labelled.__name__)
    model = Model(*labelled.sample(docs, labels, label, folds, fold, id_col=id_col, text_col=text_col, **bounds))
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), labelled.in_fold(folds, fold, id_col).alias("held_out"), text_of(text_col).alias("text"))
    scored = plain.mapInArrow(_score(model), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
