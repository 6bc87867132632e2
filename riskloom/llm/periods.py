"""Periodic runs of words, found from Lyndon roots.

A run is a longest stretch with one smallest period. Every run holds a Lyndon root: a stretch of one period that is the
longest Lyndon word starting at its first word, under the order of the words or under the reverse one. The longest Lyndon
word at every place comes from the first phase of Baier's suffix sorter, which groups suffixes, from the greatest group
down: each suffix of a finished group extends the nearest unfinished suffix before it, and what was extended equally
often, from one group, becomes the next greater group. The size of the last group's common prefix is the Lyndon length;
no suffix array is needed. Roots are extended to both sides as far as words one period apart agree.

A run of at least ``exponent`` periods holds each of its words that often, and each of its word triples once less (of
period one: as often as the least length leaves room). All other words and triples lie outside every run and cut a text
into pieces; only the pieces are grouped. Time grows with the words of a text, sorted triples aside.

Words are what lies between spaces and the ASCII controls tab to carriage return, compared byte by byte.

Defined results: a null or wordless text has no runs and an empty collapsed text; repeated rows are read alike; a text of
any length is read whole, in memory of some hundred bytes a word; runs are listed by start, then period; other columns
pass through, those named like a result are replaced; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Least:
    """What a run must have: words, and whole periods (two or more)."""

    words: int = 6
    exponent: int = 4

    def __post_init__(self):
        if self.words < 4 or self.exponent < 2:
            raise ValueError("runs need at least 4 words and 2 periods")

    @property
    def triples(self) -> int:
        """How often, at least, a run holds each of its word triples."""
        return min(self.words - 2, self.exponent - 1)


def lyndon_lengths(symbols: list[int]) -> list[int]:
    """Length of the longest Lyndon word that starts at each place, by Baier's grouping."""
    n = len(symbols)
    places: dict[int, list[int]] = {}
    for i, s in enumerate(symbols):
        places.setdefault(s, []).append(i)
    # Groups by number; each knows its size of common prefix and the groups next to it in order.
    members = [places[s] for s in sorted(places)]
    size = [1] * len(members)
    lower, upper = list(range(-1, len(members) - 1)), list(range(1, len(members) + 1))
    group = [0] * n
    for g, own in enumerate(members):
        for i in own:
            group[i] = g
    # Unfinished suffixes are a chain in text order.
    left, right = list(range(-1, n)), list(range(1, n + 2))
    g = len(members) - 1
    while g >= 0:
        extended: dict[tuple[int, int], list[int]] = {}
        last, times = -1, 0
        for i in members[g]:
            if group[i] != g:
                continue
            before, after = left[i], right[i]
            left[after] = before
            if before < 0:
                continue
            right[before] = after
            if before == last:
                times += 1
                continue
            if times:
                extended.setdefault((times, group[last]), []).append(last)
            last, times = before, 1
        if times:
            extended.setdefault((times, group[last]), []).append(last)
        for times, old in sorted(extended, reverse=True):
            own = extended[times, old]
            new, above = len(members), upper[old]
            members.append(own)
            size.append(size[old] + times * size[g])
            lower.append(old)
            upper.append(above)
            upper[old] = lower[above] = new
            for i in own:
                group[i] = new
        g = lower[g]
    return [size[g] for g in group]


# A prime below 2**31 and a base for comparing stretches by their hashes.
PRIME = np.uint64(2_147_483_629)
BASE = np.uint64(1_103_515_245)


class Stretches:
    """Words by number, with prefix hashes. Unequal hashes prove that stretches differ; equal ones are followed up."""

    def __init__(self, ids: np.ndarray):
        self.ids = ids
        n = len(ids)
        powers = np.ones(n + 1, dtype=np.uint64)
        step, done = BASE, 1
        while done <= n:
            powers[done : 2 * done] = powers[: min(done, n + 1 - done)] * step % PRIME
            step, done = step * step % PRIME, 2 * done
        spread = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
        self.powers = powers
        self.prefix = np.concatenate([[np.uint64(0)], np.cumsum(spread % PRIME * powers[:n] % PRIME) % PRIME])

    def alike(self, at: np.ndarray, other: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the hashes of the stretches at ``at`` and, further on, at ``other`` are equal."""
        first = (self.prefix[at + length] + PRIME - self.prefix[at]) % PRIME
        second = (self.prefix[other + length] + PRIME - self.prefix[other]) % PRIME
        return first * self.powers[other - at] % PRIME == second

    def forward(self, i: int, j: int) -> int:
        """How many words from ``i`` and from ``j`` > ``i`` on agree."""
        ids, n, total, width = self.ids, len(self.ids), 0, 64
        while j < n:
            width = min(width, n - j)
            differ = ids[i : i + width] != ids[j : j + width]
            k = int(differ.argmax())
            if differ[k]:
                return total + k
            i, j, total, width = i + width, j + width, total + width, 2 * width
        return total

    def backward(self, i: int, j: int) -> int:
        """How many words before ``i`` and before ``j`` > ``i`` agree."""
        ids, total, width = self.ids, 0, 64
        while i > 0:
            width = min(width, i)
            differ = (ids[i - width : i] != ids[j - width : j])[::-1]
            k = int(differ.argmax())
            if differ[k]:
                return total + k
            i, j, total, width = i - width, j - width, total + width, 2 * width
        return total


def _rooted(symbols: np.ndarray, ids: np.ndarray, least: Least) -> set[tuple[int, int, int]]:
    """(start, length, period) of all runs of ``ids``, whose order is that of ``symbols`` or its reverse."""
    found: set[tuple[int, int, int]] = set()
    words, n = Stretches(ids), len(ids)
    # A symbol below zero ends a piece: it comes first in both orders, so no Lyndon word reaches across.
    for ordered in (symbols, np.where(symbols < 0, symbols, symbols.max() - symbols)):
        period = np.array(lyndon_lengths(ordered.tolist()), dtype=np.int64)
        root = np.arange(n)
        # One side of the root must agree over half of what a run needs beyond one period.
        need = np.maximum(least.words, least.exponent * period) - period
        half = (need + 1) // 2
        after, before = root + period + half <= n, root >= half
        after[after] = words.alike(root[after], root[after] + period[after], half[after])
        before[before] = words.alike(root[before] - half[before], root[before] + (period - half)[before], half[before])
        some = np.flatnonzero(after | before)
        # By period, then place: a root inside the last stretch of its period has that stretch's run.
        some = some[np.argsort(period[some], kind="stable")]
        last, end = 0, 0
        for i, p in zip(some.tolist(), period[some].tolist(), strict=True):
            if p == last and i + p <= end:
                continue
            start = i - words.backward(i, i + p)
            last, end = p, i + p + words.forward(i, i + p)
            if end - start >= max(least.words, least.exponent * p):
                found.add((start, end - start, p))
    return found


def _pieces(ids: np.ndarray, least: Least) -> Iterator[tuple[int, int]]:
    """Starts and ends of the stretches whose words and triples are as frequent as those of a run."""
    often = np.bincount(ids)[ids] >= least.exponent
    starts = np.flatnonzero(often[:-2] & often[1:-1] & often[2:])
    if len(starts) <= least.words - 3:
        return
    pairs = np.unique(ids[starts] * len(ids) + ids[starts + 1], return_inverse=True)[1]
    _, which, counts = np.unique(pairs * len(ids) + ids[starts + 2], return_inverse=True, return_counts=True)
    starts = starts[counts[which] >= least.triples]
    if not len(starts):
        return
    breaks = np.flatnonzero(np.diff(starts) != 1)
    first = starts[np.concatenate([[0], breaks + 1])]
    last = starts[np.concatenate([breaks, [len(starts) - 1]])]
    keep = last + 3 - first >= least.words
    yield from zip(first[keep].tolist(), (last[keep] + 3).tolist(), strict=True)


def word_runs(words: list[bytes], least: Least = Least()) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start, then period."""
    if len(words) < least.words:
        return []
    known = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))
    # All pieces in one row, each with an end of its own behind it.
    places = [np.r_[start:end, -1] for start, end in _pieces(ids, least)]
    if not places:
        return []
    places = np.concatenate(places)
    inside = places >= 0
    ends = len(words) + np.arange(len(places))
    found = _rooted(np.where(inside, ids[places], -1), np.where(inside, ids[places], ends), least)
    return sorted(((int(places[s]), n, p) for s, n, p in found), key=lambda r: (r[0], r[2]))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The text with only the first period of every run."""
    if runs:
        change = np.zeros(len(words) + 1, dtype=np.int64)
        for start, length, period in runs:
            change[start + period] += 1
            change[start + length] -= 1
        words = compress(words, (np.cumsum(change[:-1]) == 0).tolist())
    return b" ".join(words).decode()


FOUND = "struct<runs: array<struct<start: bigint, length: bigint, period: bigint>>, collapsed: string, n_words: bigint>"


def find_runs(docs: DataFrame, text: Column | str = "text", least: Least = Least()) -> DataFrame:
    """Add ``runs`` (word number, words, period), ``collapsed`` (the text with one period of each run kept, words joined
    by one space) and ``n_words``."""

    @F.pandas_udf(FOUND)
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            runs, collapsed, sizes = [], [], []
            for t in texts:
                words = t.encode().split()
                own = word_runs(words, least)
                runs.append([{"start": s, "length": n, "period": p} for s, n, p in own])
                collapsed.append(collapse(words, own))
                sizes.append(len(words))
            yield pd.DataFrame({"runs": runs, "collapsed": collapsed, "n_words": sizes})

    text = F.col(text) if isinstance(text, str) else text
    rows = docs.drop("runs", "collapsed", "n_words")
    found = rows.withColumn("_found", read(F.coalesce(text, F.lit(""))))
    return found.select(*rows.columns, "_found.*")


def strongest(runs: Column) -> Column:
    """The run with the greatest length per period; of equal ones the first that is listed; null without runs."""
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    # Lengths per period are compared exactly, as products.
    more = lambda a, b: a["length"].cast("decimal(19,0)") * b["period"] > b["length"].cast("decimal(19,0)") * a["period"]
    return F.reduce(runs, none, lambda best, r: F.when(best.isNull() | more(r, best), r).otherwise(best))
