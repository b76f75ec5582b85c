"""Periodic runs of words, found by Kruskal's union-find in descending order of common prefixes.

A run is a stretch of words with smallest period q, at least ``max(least, times * q)`` words
long, that neither neighbour extends with the same period. For every text:

1. Only positions whose first words (as many as a run must repeat) occur again in the text can
   begin a run. Their suffixes are sorted by prefix doubling; the ranks of all rounds give the
   exact length of the common prefix (LCP) of neighbours.
2. A class of suffixes that begin alike holds no run if no two of its positions are near enough
   to each other for the greatest LCP in it; such classes are left out.
3. The neighbours of the others are united in descending order of their LCP. Every class keeps
   its positions as an ordered set, the smaller set goes into the larger one, and two positions
   that become next to each other at level L have exactly L words in common. If their distance d
   is small enough, d + L words from the first on have the period d, the next word breaks it, and
   there is no shorter period, or a position would stand between the two. If the word before
   breaks it too, this is a run. Every run is found so, once, by its start.

Texts are worked on one chunk of whole texts at a time, so memory follows the longest text. Rows
need nothing of each other: there is no shuffle, and a lost task is its texts done again.

Words are runs of everything but the six ASCII white-space characters, compared as they are.
Null and empty texts have no runs and collapse to an empty text. Very long texts are worked on
whole, in about n log n steps. Repeated rows are worked on each on its own. Ties for the strongest
run go to the smallest start, then period. An empty table gives no rows. Columns other than id
and text are not read, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cooccur.llm.frames import arrow_rows
from cooccur.llm.text import CASED, U64, chunks, grams_of, joined, list_array, mixed, words_of

#: An ordered set keeps its positions in parts of at most so many.
PART = 512


class Positions:
    """An ordered set of positions, in sorted parts of bounded length."""

    __slots__ = ("parts", "least", "size")

    def __init__(self, position: int) -> None:
        self.parts, self.least, self.size = [[position]], [position], 1

    def __iter__(self) -> Iterator[int]:
        for part in self.parts:
            yield from part

    def add(self, position: int) -> tuple[int, int]:
        """Put in a new position; returns those before and after it, -1 where there is none."""
        at = max(0, bisect_right(self.least, position) - 1)
        part = self.parts[at]
        i = bisect_left(part, position)
        before = part[i - 1] if i else -1
        after = part[i] if i < len(part) else self.least[at + 1] if at + 1 < len(self.parts) else -1
        part.insert(i, position)
        if not i:
            self.least[at] = position
        if len(part) > PART:
            self.parts.insert(at + 1, part[PART // 2:])
            self.least.insert(at + 1, part[PART // 2])
            del part[PART // 2:]
        self.size += 1
        return before, after


def _root(parent: dict[int, int], x: int) -> int:
    top = x
    while top in parent:
        top = parent[top]
    while x != top:
        parent[x], x = top, parent[x]
    return top


def unite(left: list[int], right: list[int], lcp: list[int], times: int) -> list[tuple[int, int, int]]:
    """(start, distance, LCP) of positions that come next to each other at a distance of at most LCP / (times - 1).

    ``left`` and ``right`` are neighbouring suffixes in descending order of their LCP. Of the
    pairs of one level only those count that are still next to each other at its end.
    """
    parent: dict[int, int] = {}
    sets: dict[int, Positions] = {}
    found: list[tuple[int, int, int]] = []
    next_to: dict[int, int] = {}
    level = lcp[0] if lcp else 0
    for x, y, now in zip(left, right, lcp):
        if now != level:
            found += [(first, second - first, level) for first, second in next_to.items()]
            next_to, level = {}, now
        reach = level // (times - 1)
        a, b = _root(parent, x), _root(parent, y)
        own, other = sets.pop(a, None) or Positions(a), sets.pop(b, None) or Positions(b)
        if own.size < other.size:
            a, b, own, other = b, a, other, own
        parent[b], sets[a] = a, own
        moving = list(other)
        for i, position in enumerate(moving):
            before, after = own.add(position)
            # What stood next to it in the smaller set is not new.
            if before >= 0 and position - before <= reach and not (i and moving[i - 1] == before):
                next_to[before] = min(position, next_to.get(before, position))
            if after >= 0 and after - position <= reach and not (i + 1 < len(moving) and moving[i + 1] < after):
                next_to[position] = min(after, next_to.get(position, after))
    return found + [(first, second - first, level) for first, second in next_to.items()]


def _first_of(changes: np.ndarray) -> np.ndarray:
    """For every element the place where its group begins; ``changes`` marks the beginnings."""
    return np.maximum.accumulate(np.where(changes, np.arange(len(changes)), 0))


def suffix_neighbours(words: np.ndarray, ends: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(positions, LCP, class) of the suffixes whose first ``start`` words occur again, in sorted order.

    ``words`` are numbers that differ between texts, ``ends`` the end of each word's text. The LCP
    is that with the next suffix, 0 where that one begins differently. Suffixes are ordered by
    their words' numbers.
    """
    n = len(words)
    none = np.zeros(0, np.int64)
    grams = grams_of(words, start)
    whole = np.flatnonzero(np.arange(len(grams)) + start <= ends[: len(grams)])
    order = whole[np.argsort(grams[whole], kind="stable")]
    same = grams[order[1:]] == grams[order[:-1]]
    again = np.zeros(n + start, bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    active = np.flatnonzero(again[:n])
    if not len(active):
        return none, none, none
    # Ranks are needed of these and of what follows the first words of these, inside the text.
    follows = active + start
    again[follows[follows < ends[active]]] = True
    places = np.flatnonzero(again)
    slot = np.full(n + 1, len(places))  # the last slot stands for everything else
    slot[places] = np.arange(len(places))
    letters = [np.where(places + i < ends[places], words[np.minimum(places + i, n - 1)], U64(0)) for i in range(start)]
    order = np.lexsort(letters[::-1])
    changes = np.ones(len(order), bool)
    changes[1:] = np.any([x[order[1:]] != x[order[:-1]] for x in letters], axis=0)
    rank = np.zeros(len(places) + 1, np.int64)
    rank[order] = _first_of(changes) + 1
    ranks, sizes = [rank], [start]

    def at(rank: np.ndarray, position: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Rank of the suffixes there, 0 behind the end."""
        return np.where(position < end, rank[slot[np.minimum(position, n)]], 0)

    while True:
        rank, size = ranks[-1], sizes[-1]
        own = rank[slot[active]]
        second = at(rank, active + size, ends[active])
        order = np.lexsort((second, own))
        own, second = own[order], second[order]
        outer, inner = np.ones(len(order), bool), np.ones(len(order), bool)
        outer[1:] = own[1:] != own[:-1]
        inner[1:] = outer[1:] | (second[1:] != second[:-1])
        finer = rank.copy()
        finer[slot[active[order]]] = own + _first_of(inner) - _first_of(outer)
        shared = np.zeros(len(order), bool)
        shared[1:] = ~inner[1:]
        shared[:-1] |= ~inner[1:]
        active = active[order][shared]
        if not len(active):
            break
        ranks.append(finer)
        sizes.append(2 * size)
    kept = np.flatnonzero(again[:n])
    kept = kept[np.argsort(finer[slot[kept]], kind="stable")]
    group = ranks[0][slot[kept]]
    left, right = kept[:-1], kept[1:]
    both = np.minimum(ends[left] - left, ends[right] - right)
    lcp = np.zeros(len(left), np.int64)
    alike = group[1:] == group[:-1]
    for rank, size in zip(reversed(ranks), reversed(sizes)):
        a, b = at(rank, left + lcp, ends[left]), at(rank, right + lcp, ends[right])
        lcp += np.where(alike & (a == b) & (a > 0), size, 0)
    open_ = alike
    for _ in range(start - 1):
        open_ = open_ & (lcp < both)
        open_ = open_ & (words[np.minimum(left + lcp, n - 1)] == words[np.minimum(right + lcp, n - 1)])
        lcp += open_
    return kept, np.append(lcp, 0), group


def runs_of(words: np.ndarray, first: np.ndarray, least: int, times: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, by start, then period; text i is words ``first[i]`` to ``first[i + 1]``."""
    sizes = np.diff(first)
    begins, ends = np.repeat(first[:-1], sizes), np.repeat(first[1:], sizes)
    words = mixed(words + mixed(begins.astype(np.uint64) + U64(1))) | U64(1)
    start = min(max(least - d, (times - 1) * d, 1) for d in range(1, least + 1))
    order, lcp, group = suffix_neighbours(words, ends, start)
    none = np.zeros(0, np.int64)
    if not len(order):
        return none, none, none
    # Whether two positions of a class are near enough to each other for its greatest LCP.
    heads = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    sorted_in = order[np.lexsort((order, group))]
    gaps = np.append(np.diff(sorted_in), len(words))
    gaps[np.append(heads[1:], len(order)) - 1] = len(words) + 1
    near = np.minimum.reduceat(gaps, heads) <= np.maximum.reduceat(lcp, heads) // (times - 1)
    pairs = np.flatnonzero((lcp >= start) & np.repeat(near, np.diff(np.append(heads, len(order)))))
    pairs = pairs[np.argsort(-lcp[pairs], kind="stable")]
    seeds = unite(order[pairs].tolist(), order[pairs + 1].tolist(), lcp[pairs].tolist(), times)
    if not seeds:
        return none, none, none
    at, period, common = np.array(sorted(seeds), np.int64).T
    fits = (period + common >= np.maximum(least, times * period)) & (
        (at == begins[at]) | (words[at - 1] != words[at - 1 + period]))
    return at[fits], (period + common)[fits], period[fits]


def periodic_runs(
    docs: DataFrame, *, least: int = 6, times: int = 4, text: str = "text", doc_id: str = "doc_id",
) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): a row for each row of ``docs``.

    ``runs`` are structs (start, length, period) in words from 0, by start, then period. ``collapsed``
    is the text's words joined by one space, without those that any run contains after its first
    period. A run has at least ``least`` words and ``times`` (2 or more) periods.
    """
    if least < 2 or times < 2:
        raise ValueError("a run has at least two words and two periods")
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batch.column(1)):
            words = words_of(chunk, CASED)
            start, length, period = runs_of(words.hash, words.first, least, times)
            steps = np.zeros(len(words.hash) + 1, np.int64)
            np.add.at(steps, start + period, 1)
            np.add.at(steps, start + length, -1)
            kept = np.flatnonzero(np.cumsum(steps[:-1]) == 0)
            owner = np.searchsorted(words.first, start, "right") - 1
            found = pa.StructArray.from_arrays(
                [pa.array(start - words.first[owner]), pa.array(length), pa.array(period)], ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays([
                batch.column(0)[chunk.first: chunk.last], pa.array(np.diff(words.first)),
                list_array(found, np.bincount(owner, minlength=chunk.last - chunk.first)),
                joined(chunk.raw, words.start[kept], words.end[kept], np.diff(np.searchsorted(kept, words.first))),
            ], ["doc_id", "n_words", "runs", "collapsed"])

    return arrow_rows(
        rows, work, f"doc_id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def strongest(runs: str | Column) -> Column:
    """The run with the greatest exact length / period, null without runs; ties to the smallest start, then period."""
    runs = F.col(runs) if isinstance(runs, str) else runs
    return F.aggregate(runs, F.get(runs, F.lit(0)), lambda best, run: F.when(
        run["length"] * best["period"] > best["length"] * run["period"], run).otherwise(best))


def collapsed(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """(doc_id, text) with repetitions inside the texts reduced to their first period."""
    found = periodic_runs(docs, text=text, doc_id=doc_id, **options)
    return found.select(F.col("doc_id").alias(doc_id), F.col("collapsed").alias(text))
