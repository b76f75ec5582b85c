"""Scores of texts under a class-based bigram model (Brown classes found by exchange).

The probability of a word is that of its class after the class of the word before, times that of
the word in its class. Words and an end after each text are the tokens.

* Counts. Every word of every text that may be learned from is counted, by a number of
  occurrences per batch and a sum per word. The table of counts grows with the corpus and stays
  distributed; only its most frequent words, at most
  ``HEAD``, go out to all tasks. Rarer words of a text
  meet their counts in a join.
* Units. Every word counted ``MIN_COUNT`` times or more is a unit of its own, up to the ``HEAD``
  words that go out to tasks; their number grows with the corpus until then. Rarer
  and unseen words, which have no contexts to go by, belong to the unit of their ending, one of ``ENDINGS``.
* Contexts. Pairs of units are counted over the whole corpus, are added up in each task, and stay a
  distributed table of compressed parts without a shuffle. In each round tasks turn the pairs into
  counts of the classes beside each unit, and these only are shuffled, as a compressed value for each
  block of units, which adds them up one after the other.
* Classes. Exchange: a unit moves to the class in which the likelihood of the pairs is highest.
  Their number is ``classes_for`` the units. Units are dealt to blocks of at most about ``BLOCK``; in a round the
  blocks of one half move their units, each on its own copy of the class counts, frequent units
  one at a time and rarer ones in growing steps. The round counts only if the likelihood of all pairs rose.
* Smoothing. Words in their class: an added ``ALPHA`` for every word and one unseen word. Classes
  after classes: ``BETA`` counts dealt out by how frequent the classes are.

Null and empty texts have no words and one end. Rows without an id are never learned from.
Repeated rows count as often as they occur. Without texts to learn from every token is unseen.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cooccur.llm.frames import arrow_rows, freeze, learnable
from cooccur.llm.packing import packed, unpacked
from cooccur.llm.text import SPACED, U64, Chunk, Words, chunks, list_array, mixed, words_of

HEAD = 1 << 18
MIN_COUNT = 2
COMMON = 8192
ENDINGS = 1024
CLASSES = 256
BLOCK = 4096
STEP = 256
PAIRS_HELD = 1 << 22
PAIRS_PACKED = 1 << 20
ROUNDS = 10
ALPHA = 0.1
BETA = 50.0
FOLDS = 10

_FOLD = np.arange(256, dtype=np.uint64)
_FOLD[65:91] += U64(32)
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def ending_units(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The number of each word's last three bytes, below ``ENDINGS``."""
    code = np.zeros(len(start), np.uint64)
    for back in (1, 2, 3):
        at = end - back
        code = code * U64(257) + np.where(at >= start, _FOLD[raw[np.maximum(at, 0)]] + U64(1), U64(0))
    return (mixed(code) % U64(ENDINGS)).astype(np.int64)


def _word(chunk: Chunk, start: int, end: int) -> str:
    return chunk.raw[start:end].tobytes().translate(_LOWER).decode("utf-8", "replace")


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over a column of texts."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        hashes, counts, names = [], [], []
        for chunk in chunks(batch.column(0)):
            words = words_of(chunk, SPACED)
            distinct, first, n = np.unique(words.hash, return_index=True, return_counts=True)
            hashes.append(distinct)
            counts.append(n)
            names += [_word(chunk, s, e) for s, e in zip(words.start[first].tolist(), words.end[first].tolist(), strict=True)]
        distinct, first, inverse = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
        total = np.bincount(inverse, np.concatenate(counts), len(distinct)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in first.tolist()], pa.string()), pa.array(total)], ["word", "n"])

    return arrow_rows(texts, work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Head(NamedTuple):
    """The most frequent words by hash, with their ranks and counts; the first ``owned`` ranks are units of their own."""

    hash: np.ndarray
    rank: np.ndarray
    n: np.ndarray
    owned: int

    @property
    def units(self) -> int:
        """All units: words, endings and, as the last one, the end of a text."""
        return self.owned + ENDINGS + 1

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Places in this table, -1 if a hash is not in it."""
        if not len(self.hash):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hash, hashes), len(self.hash) - 1)
        return np.where(self.hash[at] == hashes, at, -1)


def head_of(counts: DataFrame, size: int | None = None) -> Head:
    """The most frequent words, at most ``size``, in the order of their counts and spelling.

    A histogram of the counts by sixteenths of a doubling (at most 64 * 16 rows) tells from which
    count on the words are few enough, so no more than these words leave their tasks.
    """
    step = F.floor(F.log2("n") * 16)
    steps = counts.groupBy(step.alias("step")).agg(F.count("*").alias("words")).orderBy(F.desc("step")).collect()
    total, lowest = 0, float("inf")
    for row in steps:
        total += row["words"]
        if total > (HEAD if size is None else size):
            break
        lowest = row["step"]
    rows = counts.where(step >= lowest).toPandas().sort_values(["n", "word"], ascending=[False, True])
    found = [np.zeros(0, np.uint64)]
    for chunk in chunks(pa.array(rows["word"], pa.string())):
        found.append(words_of(chunk, SPACED).hash)
    hashes = np.concatenate(found)
    order = np.argsort(hashes)
    n = rows["n"].to_numpy(np.int64)
    return Head(hashes[order], order, n[order], int(np.count_nonzero(n >= MIN_COUNT)))


def units_of(chunk: Chunk, words: Words, head: Head) -> np.ndarray:
    """The unit of each word of a chunk."""
    distinct, first, inverse = np.unique(words.hash, return_index=True, return_inverse=True)
    return _own_units(chunk, words, first, head, head.find(distinct))[inverse]


def _own_units(chunk: Chunk, words: Words, first: np.ndarray, head: Head, at: np.ndarray) -> np.ndarray:
    """Units of the words that begin a chunk's distinct ones, which stand ``at`` places of the head."""
    owned = head.owned
    rank = np.where(at >= 0, head.rank[at] if len(head.rank) else 0, owned)
    return np.where(rank < owned, rank, ending_units(chunk.raw, words.start[first], words.end[first]) + owned)


def _with_ends(units: np.ndarray, first: np.ndarray, end: int) -> np.ndarray:
    """Units of several texts in a row, with an end before the first and after each."""
    return np.insert(units, first, end)


def _added(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order and the sums of their counts."""
    every, n = np.concatenate(codes), np.concatenate(counts)
    order = np.argsort(every, kind="stable")
    every, n = every[order], n[order]
    starts = np.flatnonzero(np.diff(every, prepend=-1))
    return every[starts], np.add.reduceat(n, starts) if len(starts) else n


def _parts(counted: Iterable[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(codes, counts) added up and in the order of the codes, in parts of about ``PAIRS_HELD`` at most."""
    codes, counts, held = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    for code, n in counted:
        codes.append(code)
        counts.append(n)
        held += len(code)
        if held > PAIRS_HELD:
            code, n = _added(codes, counts)
            if len(code) > PAIRS_HELD // 2:
                yield code, n
                code, n = code[:0], n[:0]
            codes, counts, held = [code], [n], len(code)
    yield _added(codes, counts)


def _pair_values(parts: Iterable[tuple[np.ndarray, np.ndarray]], units: int) -> Iterator[pa.RecordBatch]:
    """Parts of pairs, coded u * units + v, as values of (steps of u, v, n)."""
    for code, n in parts:
        for at in range(0, len(code), PAIRS_PACKED):
            now = slice(at, at + PAIRS_PACKED)
            value = packed(np.diff(code[now] // units, prepend=0), code[now] % units, n[now])
            yield pa.RecordBatch.from_arrays([pa.array([value], pa.binary())], ["pairs"])


def _pairs_in(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(u, v, n) of a batch of values, or of a batch of single pairs."""
    if batch.num_columns == 1:
        for value in batch.column(0):
            steps, v, n = unpacked(value, 3)
            yield np.cumsum(steps), v, n
    elif batch.num_rows:
        u, v, n = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns)
        yield u, v, n


def unit_pairs(texts: DataFrame, head: Head) -> DataFrame:
    """How often unit v follows unit u, as values in parts: a task adds up to ``PAIRS_HELD`` pairs before it returns them."""
    units = head.units
    shared = texts.sparkSession.sparkContext.broadcast(head)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for batch in batches:
                for chunk in chunks(batch.column(0)):
                    words = words_of(chunk, SPACED)
                    line = _with_ends(units_of(chunk, words, shared.value), words.first, units - 1)
                    yield np.unique(line[:-1] * units + line[1:], return_counts=True)

        yield from _pair_values(_parts(counted()), units)

    return texts.mapInArrow(task, "pairs binary")


def pairs_among(pairs: DataFrame, owned: int, units: int) -> DataFrame:
    """The pairs of the ``COMMON`` most frequent words and the endings with each other, each added up over the corpus."""
    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for u, v, n in _pairs_in(batch):
                at = np.flatnonzero(((u < COMMON) | (u >= owned)) & ((v < COMMON) | (v >= owned)))
                yield pa.RecordBatch.from_arrays([pa.array(u[at] * units + v[at]), pa.array(n[at])], ["code", "n"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _pair_values(_parts(tuple(c.to_numpy() for c in batch.columns) for batch in batches), units)

    added = pairs.mapInArrow(some, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    return added.mapInArrow(task, "pairs binary")


# ---------------------------------------------------------------------------- exchange

def classes_for(units: int) -> int:
    """How many classes the units are put into: a quarter of the root of their number, from 8 to ``CLASSES``."""
    return int(np.clip(np.sqrt(units) / 4, 8, CLASSES))


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-12))


def _more(x: np.ndarray, by: np.ndarray) -> np.ndarray:
    """How much x log x grows when x grows."""
    x = np.maximum(x, 0)
    return _xlogx(x + by) - _xlogx(x)


def likelihood(matrix: np.ndarray) -> float:
    """The part of the pairs' log likelihood that depends on the classes."""
    return float(_xlogx(matrix).sum() - _xlogx(matrix.sum(0)).sum() - _xlogx(matrix.sum(1)).sum())


def gains(matrix: np.ndarray, own: np.ndarray, left: np.ndarray, right: np.ndarray, itself: np.ndarray) -> np.ndarray:
    """(units, classes): the likelihood that each unit brings to each class, the unit having left its ``own``.

    A row of ``right`` and ``left`` counts the classes after and before a unit, without pairs of the
    unit with itself, which ``itself`` counts. Only classes that occur beside a unit are looked at.
    """
    unit = np.arange(len(own))
    gain = np.zeros((len(own), len(matrix)))
    # Sums do not change by the other words' pairs with the unit, whichever class it is in.
    for total, n in ((matrix.sum(1), right.sum(1) + itself), (matrix.sum(0), left.sum(1) + itself)):
        gain -= _xlogx(total + n[:, None]) - _xlogx(total)
        at_home = total[own]
        gain[unit, own] += _more(at_home, n) - _more(at_home - n, n)
    for side, other, counts in ((right, left, matrix.T), (left, right, matrix)):
        u, c = np.nonzero(side)
        if not len(u):
            continue
        n = side[u, c]
        grown = counts[c]
        grown += n[:, None]
        grown *= np.log(grown)
        grown -= _xlogx(counts)[c]
        # Without the unit itself its own class counts less: in one column, and in the row of that class.
        grown[np.arange(len(u)), own[u]] = _more(counts[c, own[u]] - n, n)
        at_home = np.flatnonzero(c == own[u])
        home = u[at_home]
        bare = counts[own[home]] - other[home]
        bare[np.arange(len(home)), own[home]] -= n[at_home] + itself[home]
        grown[at_home] = _more(bare, n[at_home, None])
        starts = np.flatnonzero(np.diff(u, prepend=-1))
        gain[u[starts]] += np.add.reduceat(grown, starts, axis=0)
    # The corner where both sides meet counts once, with all that falls there.
    u, c = np.nonzero(right + left + itself[:, None])
    r, l, i = right[u, c], left[u, c], itself[u]
    loop = matrix[c, c] - np.where(c == own[u], r + l + i, 0)
    gain[u, c] += _more(loop, r + l + i) - _more(loop, r) - _more(loop, l)
    return gain


def best_classes(
    matrix: np.ndarray, own: np.ndarray, left: np.ndarray, right: np.ndarray, itself: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The class in which each unit does best on its own, and the class counts with all of them there.

    The last class holds the end only.
    """
    gain = gains(matrix, own, left, right, itself)
    unit = np.arange(len(own))
    best = gain[:, :-1].argmax(1)
    best = np.where(gain[unit, best] <= gain[unit, own] + 1e-9, own, best)
    found = matrix.copy()
    for of, sign in ((own, -1), (best, 1)):
        np.add.at(found, of, sign * right)
        np.add.at(found.T, of, sign * left)
        np.add.at(found, (of, of), sign * itself)
    return best, np.maximum(found, 0)


def _class_matrix(pairs: DataFrame, classes: np.ndarray) -> np.ndarray:
    size = int(classes.max()) + 1
    shared = pairs.sparkSession.sparkContext.broadcast(classes)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, np.int64)
        for batch in batches:
            for u, v, n in _pairs_in(batch):
                total += np.bincount(shared.value[u] * size + shared.value[v], n, size * size).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    matrix = np.zeros(size * size)
    for row in pairs.mapInArrow(task, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():  # bounded by the number of classes
        matrix[row["at"]] = row["n"]
    shared.unpersist()
    return matrix.reshape(size, size)


def packed_contexts(pairs: DataFrame, classes: np.ndarray, blocks: int, half: int) -> DataFrame:
    """(block, counts): the contexts of the units in every second block, but the end, in parts of a task each.

    Unit i is number i // ``blocks`` of block i % ``blocks``. A value has (steps of codes, n); a code is the number
    of the unit, times 2 * ``size`` + 1, and c: from 0 on the class after the unit, from ``size`` on the class before it,
    2 * ``size`` the unit itself.
    """
    end, size = len(classes) - 1, int(classes.max()) + 1
    codes = 2 * size + 1
    width = (len(classes) // blocks + 1) * codes
    shared = pairs.sparkSession.sparkContext.broadcast(classes)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for batch in batches:
                for u, v, n in _pairs_in(batch):
                    for unit, c, more in (
                        (u, np.where(u == v, 2 * size, shared.value[v]), True), (v, size + shared.value[u], u != v)):
                        at = np.flatnonzero((unit != end) & (unit % blocks % 2 == half) & more)
                        yield unit[at] % blocks * width + unit[at] // blocks * codes + c[at], n[at]

        for code, n in _parts(counted()):
            block = code // width
            starts = np.flatnonzero(np.diff(block, prepend=-1))
            values = [packed(np.diff(code[at] % width, prepend=0), n[at]) for at in np.split(np.arange(len(code)), starts[1:]) if len(at)]
            yield pa.RecordBatch.from_arrays([pa.array(block[starts].astype(np.int32)), pa.array(values, pa.binary())], ["block", "counts"])

    return pairs.mapInArrow(task, "block int, counts binary")


def contexts(pairs: DataFrame, classes: np.ndarray, blocks: int, half: int) -> DataFrame:
    """(unit, c, n) of :func:`packed_contexts`, added up."""
    codes = 2 * (int(classes.max()) + 1) + 1

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for block, value in zip(batch.column(0).to_pylist(), batch.column(1)):
            steps, n = unpacked(value, 2)
            code = np.cumsum(steps)
            yield pa.RecordBatch.from_arrays(
                [pa.array((code // codes * blocks + block).astype(np.int32)), pa.array((code % codes).astype(np.int32)), pa.array(n)], ["unit", "c", "n"])

    return arrow_rows(packed_contexts(pairs, classes, blocks, half), work, "unit int, c int, n long").groupBy("unit", "c").agg(F.sum("n").alias("n"))


def _mover(matrix: np.ndarray, classes: np.ndarray, blocks: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Moves the units of a block, given their :func:`packed_contexts`, frequent ones first."""
    size = len(matrix)

    def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        beside = np.zeros((len(classes) // blocks + 1, 2 * size + 1))
        block = 0
        for batch in batches:
            for block, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                steps, n = unpacked(value, 2)
                beside.reshape(-1)[np.cumsum(steps)] += n
        units = np.flatnonzero(beside.any(1))
        beside = beside[units]
        units = units * blocks + block
        order = np.lexsort([units, -beside.sum(1)])
        counts, best, done = matrix, classes[units], 0
        while done < len(units):
            now = order[done:done + min(STEP, 1 + done // 16)]
            best[now], counts = best_classes(counts, best[now], beside[now, size:2 * size], beside[now, :size], beside[now, -1])
            done += len(now)
        yield pa.RecordBatch.from_arrays([pa.array(units.astype(np.int32)), pa.array(best.astype(np.int32))], ["unit", "class"])

    return moved


def _improved(pairs: DataFrame, classes: np.ndarray, moving: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """(classes, class counts) after some rounds over pairs of about ``moving`` units."""
    blocks = max(8, 2 * -(-moving // (2 * BLOCK)))
    matrix = _class_matrix(pairs, classes)
    for turn in range(rounds):
        moves = packed_contexts(pairs, classes, blocks, turn % 2).groupBy("block").applyInArrow(
            _mover(matrix, classes, blocks), "unit int, class int")
        tried = classes.copy()
        rows = moves.toPandas()  # a row per unit, at most HEAD + ENDINGS
        tried[rows["unit"].to_numpy()] = rows["class"].to_numpy()
        found = _class_matrix(pairs, tried)
        if likelihood(found) <= likelihood(matrix) + 1e-6 and turn % 2:
            break
        if likelihood(found) > likelihood(matrix):
            classes, matrix = tried, found
    return classes, matrix


def exchange(pairs: DataFrame, owned: int, units: int, *, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(class of each unit, class counts). Frequent units start in turn in the classes; the end is the last unit.

    The ``COMMON`` most frequent words and the endings settle first, by their pairs with each other. Then
    all units move, each half of the blocks once, by all pairs: a rare word has few contexts, mostly settled ones.
    """
    number = classes_for(units)
    classes = np.arange(units) % number
    classes[-1] = number
    if owned <= COMMON:
        return _improved(pairs, classes, units, rounds)
    among = freeze(pairs_among(pairs, owned, units))
    classes, _ = _improved(among, classes, COMMON + units - owned, rounds)
    return _improved(pairs, classes, units, min(rounds, 2))


# ---------------------------------------------------------------------------- model and scores

class Model(NamedTuple):
    """What every task needs to score texts; bounded by HEAD and the number of classes."""

    head: Head
    classes: np.ndarray
    transition: np.ndarray
    emission: np.ndarray
    tokens: int
    types: int
    ends: int


def class_sizes(counts: DataFrame, head: Head, classes: np.ndarray) -> np.ndarray:
    """Occurrences and number of the words of each class, from the table of counts."""
    size = int(classes.max()) + 1
    shared = counts.sparkSession.sparkContext.broadcast((head, classes))

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        own, classes = shared.value
        units = [np.zeros(0, np.int64)]
        for chunk in chunks(batch.column(0)):
            units.append(units_of(chunk, words_of(chunk, SPACED), own))
        of = classes[np.concatenate(units)]
        n = np.bincount(of, batch.column(1).to_numpy(), size).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(n), pa.array(np.bincount(of, minlength=size))], ["class", "n", "v"])

    sizes = np.zeros((2, size))
    rows = arrow_rows(counts.select("word", "n"), work, "class long, n long, v long")
    for row in rows.groupBy("class").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():
        sizes[:, row["class"]] = row["n"], row["v"]
    return sizes


def fit(texts: DataFrame, *, rounds: int = ROUNDS) -> tuple[Model, DataFrame]:
    """(model, counts of words) from a column of texts."""
    counts = freeze(word_counts(texts))
    head = head_of(counts)
    pairs = freeze(unit_pairs(texts, head))
    classes, matrix = exchange(pairs, head.owned, head.units, rounds=rounds)
    sizes = class_sizes(counts, head, classes)
    ends = int(matrix[:, -1].sum())
    share = (matrix.sum(0) + 1) / (matrix.sum() + len(matrix))
    transition = np.log10((matrix + BETA * share) / (matrix.sum(1, keepdims=True) + BETA))
    # log10 of what a class's words divide their counts by; the end is sure in its class.
    emission = np.log10(sizes[0] + ALPHA * (sizes[1] + 1))
    emission[-1] = 0.0
    return Model(head, classes, transition, emission, int(sizes[0].sum()) + ends, int(sizes[1].sum()) + (ends > 0), ends), counts


def scores(docs: DataFrame, model: Model, vocabulary: DataFrame, *, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """(keep, n_tokens, n_known, base_score, score, perplexity) of every row.

    base_score is the log10 probability under single words, score under the class model.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias("_lm_text"))
    names = [*keep, "row", "n_tokens", "head_known", "log_head", "log_divisors", "log_classes", "rare"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Model = shared.value
        row = TaskContext.get().partitionId() << 40
        log_n = np.log10(own.head.n + ALPHA)
        log_end = np.log10(own.ends + ALPHA)
        for batch in batches:
            for chunk in chunks(batch.column(len(keep))):
                words = words_of(chunk, SPACED)
                distinct, first, inverse = np.unique(words.hash, return_index=True, return_inverse=True)
                at = own.head.find(distinct)
                known = at >= 0
                units = _own_units(chunk, words, first, own.head, at)[inverse]
                logs = np.where(known, log_n[at] if len(log_n) else 0.0, 0.0)[inverse]
                spelled = {i: _word(chunk, int(words.start[first[i]]), int(words.end[first[i]])) for i in np.flatnonzero(~known).tolist()}
                rare_at = np.flatnonzero(~known[inverse])
                line = own.classes[_with_ends(units, words.first, own.head.units - 1)]
                steps = np.concatenate([[0.0], np.cumsum(own.transition[line[:-1], line[1:]])])
                # In the line, text i runs from its words' place plus i, to its end.
                low = words.first[:-1] + np.arange(len(words.first) - 1)
                high = words.first[1:] + np.arange(1, len(words.first))
                sums = [np.concatenate([[0.0], np.cumsum(x)]) for x in (known[inverse], logs, own.emission[own.classes[units]])]
                size = len(words.first) - 1
                head_known, log_head, divisors = (s[words.first[1:]] - s[words.first[:-1]] for s in sums)
                columns = [batch.column(c).slice(chunk.first, chunk.last - chunk.first) for c in range(len(keep))]
                rare = pa.array([spelled[i] for i in inverse[rare_at].tolist()], pa.string())
                yield pa.RecordBatch.from_arrays([
                    *columns, pa.array(np.arange(row, row + size)), pa.array(np.diff(words.first) + 1),
                    pa.array((head_known + (own.ends > 0)).astype(np.int64)), pa.array(log_head + log_end), pa.array(divisors + log_end),
                    pa.array(steps[high] - steps[low]), list_array(rare, np.diff(np.searchsorted(rare_at, words.first))),
                ], names)
                row += size

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    seen = freeze(rows.mapInArrow(task, ", ".join([
        *fields, "row long, n_tokens long, head_known long, log_head double, log_divisors double, log_classes double, rare array<string>"])))
    rare = seen.select("row", F.explode("rare").alias("word")).join(vocabulary.select("word", "n"), "word", "left")
    sums = rare.groupBy("row").agg(
        F.sum(F.log10(F.coalesce("n", F.lit(0)) + ALPHA)).alias("log_rare"), F.count("n").alias("rare_known"))
    log_n = F.col("log_head") + F.coalesce("log_rare", F.lit(0.0))
    base = log_n - F.col("n_tokens") * float(np.log10(model.tokens + ALPHA * (model.types + 1)))
    # The end is sure in its class: its count and its divisor cancel.
    score = log_n - F.col("log_divisors") + F.col("log_classes")
    return seen.join(sums, "row", "left").select(
        *[F.col(f"`{c}`") for c in keep], "n_tokens", (F.col("head_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        base.alias("base_score"), score.alias("score"), F.pow(F.lit(10.0), -score / F.col("n_tokens")).alias("perplexity"))


def score_texts(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", folds: int = FOLDS, rounds: int = ROUNDS) -> DataFrame:
    """Learn from the rows whose id's remainder is not 0, score all rows."""
    texts = docs.where(learnable(doc_id, folds)).select(F.col(f"`{text}`").cast("string").alias("text"))
    model, vocabulary = fit(texts, rounds=rounds)
    return scores(docs, model, vocabulary, keep=(doc_id,), text=text).withColumn(
        "held_out", ~learnable(doc_id, folds)).withColumn("train_tokens", F.lit(model.tokens).cast("long"))
