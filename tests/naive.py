"""Plain Python restatements of the operators for small panels: {group: {t: v or None}}."""

from __future__ import annotations

import hashlib
import random


def random_panel(seed: int, groups: int = 25, length: int = 14, low: int = -3) -> dict:
    rng = random.Random(seed)
    panel = {}
    for g in range(groups):
        first = rng.randint(low, low + 4)
        keep, null = rng.choice([0.3, 0.6, 0.9, 1.0]), rng.choice([0.0, 0.2, 0.7, 1.0])
        series = {
            t: None if rng.random() < null else round(rng.uniform(-50, 50), 3)
            for t in range(first, first + rng.randint(1, length)) if rng.random() < keep
        }
        if series:
            panel[f"g{g:02d}"] = series
    return panel


def rows(panel: dict) -> list:
    return [(g, t, v) for g, series in panel.items() for t, v in series.items()]


def dense(series: dict) -> dict:
    return {t: series.get(t) for t in range(min(series), max(series) + 1)}


def missing_runs(series: dict) -> list:
    out, start = [], None
    full = dense(series)
    for t, v in full.items():
        if v is None and start is None:
            start = t
        if v is not None and start is not None:
            out.append((start, t - 1))
            start = None
    if start is not None:
        out.append((start, max(full)))
    return out


def trim(series: dict, threshold: float):
    """(kept dense series, (from, to) of the cut or None); takes away from the front."""
    full = dense(series)
    gaps = len(full) - len(series)
    if gaps / len(full) <= threshold:
        return full, None
    rest, missing = list(full.items()), gaps
    while rest and missing / len(rest) > threshold:
        missing -= rest[0][1] is None
        rest = rest[1:]
    while rest and rest[0][1] is None:
        rest = rest[1:]
    last = rest[0][0] - 1 if rest else max(full)
    return dict(rest), (min(full), last)


def linear(values: list) -> list:
    known = [i for i, v in enumerate(values) if v is not None]
    out = []
    for i, v in enumerate(values):
        before, after = [k for k in known if k < i], [k for k in known if k > i]
        if v is not None or not known:
            out.append(v)
        elif not before:
            out.append(values[after[0]])
        elif not after:
            out.append(values[before[-1]])
        else:
            p, n = before[-1], after[0]
            out.append(values[p] + (values[n] - values[p]) / (n - p) * (i - p))
    return out


def lag(values: list, n: int) -> list:
    return [None] * min(n, len(values)) + values[:max(len(values) - n, 0)]


def rolling(values: list, width: int) -> list:
    out = []
    for i in range(len(values)):
        seen = [v for v in values[max(i - width + 1, 0):i + 1] if v is not None]
        out.append(sum(seen) / len(seen) if seen else None)
    return out


def greedy(lengths: dict, ratio: float, seed: int, trial: int, width: int) -> set:
    """Chosen (group, position): a plain walk over all candidates in priority order."""
    distance, shortest, free = (2, 3, 2) if width == 1 else (3, 7, 4)
    candidates = [
        (hashlib.md5(f"{seed}|{trial}|{g}|{p}".encode()).hexdigest(), g, p)
        for g, n in lengths.items() if n >= shortest for p in range(1, n - free + 1)
    ]
    if not candidates:
        return set()
    target = min(max(round(len(candidates) * ratio), 1), len(candidates))
    chosen: dict = {}
    count = 0
    for _, g, p in sorted(candidates):
        if count == target:
            break
        if all(abs(p - q) >= distance for q in chosen.get(g, ())):
            chosen.setdefault(g, []).append(p)
            count += 1
    return {(g, p) for g, ps in chosen.items() for p in ps}
