import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from cooccur.llm import classlm
from tests.llm.conftest import SCHEMA


def brute(rows):
    tokens = {}
    counts = Counter()
    for i, (doc, text) in enumerate(rows):
        own = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]
        tokens[i] = own
        if zlib.crc32(("" if doc is None else str(doc)).encode()) % 10:
            counts.update(own)
    total, types = sum(counts.values()), len(counts)
    out = []
    for i, (doc, _) in enumerate(rows):
        own = tokens[i]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (types + 1))) for w in own)
        out.append((doc, len(own), sum(counts[w] > 0 for w in own), total, round(base, 6)))
    return sorted(out, key=repr)


@pytest.fixture
def small(monkeypatch):
    """So few frequent words that most words take the way of the rare ones."""
    monkeypatch.setattr(classlm, "HEAD", 50)
    return classlm


def test_base_scores_equal_brute_force(spark, odd_rows, odd, small):
    found = small.score_texts(odd, rounds=1).collect()
    assert sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in found), key=repr) == brute(
        [r[:2] for r in odd_rows])
    assert all(r["score"] < 0 and r["perplexity"] > 1 for r in found if r["n_tokens"] > 1)


def test_classes_beat_single_words_on_held_out_text(spark):
    rng = np.random.default_rng(5)
    first, second = [f"alpha{i}" for i in range(40)], [f"beta{i}" for i in range(40)]
    rows = [(i, " ".join(w for _ in range(60) for w in (rng.choice(first), rng.choice(second))), "en", "s", 0) for i in range(120)]
    held = [r for r in classlm.score_texts(spark.createDataFrame(rows, SCHEMA)).collect() if r["held_out"]]
    assert held and all(r["score"] > r["base_score"] + 0.1 * r["n_tokens"] for r in held)


def counted(pairs, of, size):
    total = np.zeros((size, size))
    np.add.at(total, (of[:, None], of[None, :]), pairs)
    return total


def beside(pairs, of, units, size):
    """Left, right and own counts of units, as the exchange gets them."""
    left, right = np.zeros((2, len(units), size))
    for i, unit in enumerate(units):
        others = np.arange(len(pairs)) != unit
        right[i] = np.bincount(of[others], pairs[unit, others], size)
        left[i] = np.bincount(of[others], pairs[others, unit], size)
    return left, right, pairs[units, units]


def test_moves_are_the_best_of_all_classes():
    rng = np.random.default_rng(6)
    units, size = 30, 6
    pairs = rng.integers(0, 9, (units, units)).astype(float) * (rng.random((units, units)) < 0.3)
    classes = np.arange(units) % (size - 1)
    classes[-1] = size - 1
    for unit in range(units - 1):
        tried = [classlm.likelihood(counted(pairs, np.where(np.arange(units) == unit, c, classes), size)) for c in range(size - 1)]
        own = beside(pairs, classes, np.array([unit]), size)
        gain = classlm.gains(counted(pairs, classes, size), classes[[unit]], *own)[0, :-1]
        assert np.allclose(gain - gain[0], np.array(tried) - tried[0])
        best, counts = classlm.best_classes(counted(pairs, classes, size), classes[[unit]], *own)
        classes[unit] = best[0]
        assert tried[best[0]] >= max(tried) - 1e-6
        assert np.allclose(counts, counted(pairs, classes, size))


def test_several_units_at_a_time_equal_one_by_one():
    rng = np.random.default_rng(8)
    pairs, classes = rng.integers(0, 5, (20, 20)).astype(float), np.arange(20) % 4
    matrix, units = counted(pairs, classes, 5), np.arange(12)
    together = classlm.gains(matrix, classes[units], *beside(pairs, classes, units, 5))
    for unit in units:
        assert np.allclose(together[unit], classlm.gains(matrix, classes[[unit]], *beside(pairs, classes, units[[unit]], 5))[0])


def test_contexts_equal_brute_force(spark):
    rng = np.random.default_rng(9)
    counts = rng.integers(0, 3, (12, 12))
    classes = np.arange(12) % 3
    classes[-1] = 3
    u, v = np.nonzero(counts)
    rows = spark.createDataFrame([(int(a), int(b), int(counts[a, b])) for a, b in zip(u, v)], "u int, v int, n long").repartition(3)
    found = np.zeros((12, 9))
    for half in (0, 1):
        for row in classlm.contexts(rows, classes, 4, half).collect():
            assert row["unit"] % 4 % 2 == half
            found[row["unit"], row["c"]] = row["n"]
    left, right, own = beside(counts, classes, np.arange(11), 4)
    assert np.array_equal(found[:11], np.hstack([right, left, own[:, None]])) and not found[11].any()
    assert np.array_equal(classlm._class_matrix(rows, classes), counted(counts, classes, 4))


def test_common_units_first(spark, monkeypatch):
    monkeypatch.setattr(classlm, "COMMON", 8)
    rng = np.random.default_rng(10)
    units, owned = 40, 34
    counts = rng.integers(0, 4, (units, units)) * (np.add.outer(np.arange(units), np.arange(units)) % 2)
    u, v = np.nonzero(counts)
    rows = spark.createDataFrame([(int(a), int(b), int(counts[a, b])) for a, b in zip(u, v)], "u int, v int, n long").repartition(2)
    classes, matrix = classlm.exchange(rows, owned, units, rounds=2)
    start = np.append(np.arange(units - 1) % 8, 8)
    assert classes[-1] == 8 and classes[:-1].max() < 8
    assert np.array_equal(matrix, counted(counts, classes, 9))
    assert (classes[8:owned] != start[8:owned]).any() and (classes[:8] != start[:8]).any()


def test_score_equals_brute_force(spark, odd_rows, odd, small):
    """The class model's probabilities, token by token from the fitted classes."""
    model, vocabulary = small.fit(odd.select("text"), rounds=2)
    found = {(r["doc_id"], r["n_tokens"]): r["score"] for r in small.scores(odd, model, vocabulary).collect()}
    n = {r["word"]: r["n"] for r in vocabulary.collect()}
    head = {int(h): int(r) for h, r in zip(model.head.hash, model.head.rank)}

    def unit(word):
        [chunk] = classlm.chunks(classlm.pa.array([word]))
        words = classlm.words_of(chunk, classlm.SPACED)
        rank = head.get(int(words.hash[0]), model.head.owned)
        return rank if rank < model.head.owned else model.head.owned + int(classlm.ending_units(chunk.raw, words.start, words.end)[0])

    end = len(model.classes) - 1
    for doc, text, *_ in odd_rows:
        own = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        line = model.classes[[end, *map(unit, own), end]]
        score = sum(model.transition[a, b] for a, b in zip(line[:-1], line[1:]))
        score += sum(math.log10(n.get(w, 0) + 0.1) - model.emission[model.classes[unit(w)]] for w in own)
        assert abs(found[doc, len(own) + 1] - score) < 1e-6 * max(1, abs(score))


def test_probabilities_of_a_class_sum_to_one(spark):
    texts = spark.createDataFrame([("a b c a b",), ("c a",)], "text string")
    model, vocabulary = classlm.fit(texts, rounds=1)
    rows = vocabulary.collect()
    assert np.allclose((10 ** model.transition).sum(1), 1)
    sizes = classlm.class_sizes(vocabulary, model.head, model.classes)
    assert sizes[0].sum() == sum(r["n"] for r in rows) and sizes[1].sum() == len(rows)
    assert np.allclose(10 ** model.emission[:-1], sizes[0][:-1] + classlm.ALPHA * (sizes[1][:-1] + 1))


def test_empty(empty, odd):
    assert classlm.score_texts(empty, rounds=1).count() == 0
    assert classlm.score_texts(odd.where("doc_id is null"), rounds=1).count() == 2  # nothing to learn from
