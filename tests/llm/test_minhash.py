import random
import re

import pytest
from pyspark.sql import functions as F

from cooccur.llm import minhash
from cooccur.llm.components import components
from tests.llm.conftest import SCHEMA, words


def shingle_set(text, size):
    own = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(own[i:i + size]) for i in range(len(own) - size + 1)) or frozenset([tuple(own)] if own else [])


def brute(rows, size, percent):
    sets = [shingle_set(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    group = {}
    for i, (doc, _) in enumerate(rows):
        group.setdefault(root(i), []).append(doc)
    least = {r: min((d for d in ids if d is not None), default=None) for r, ids in group.items()}
    return sorted(((doc, len(sets[i]), least[root(i)]) for i, (doc, _) in enumerate(rows)), key=repr)


def near_copies(n, seed, length=120):
    """Copies of one text with more and more words changed: some reach each other over others only."""
    rng = random.Random(seed)
    base = words(length, seed).split()
    out = []
    for i in range(n):
        own = list(base)
        for _ in range(rng.randint(0, 9)):
            own[rng.randrange(length)] = f"new{rng.randrange(10**6)}"
        out.append((1000 * seed + i, " ".join(own)))
    return out


@pytest.mark.parametrize(("size", "percent", "tile"), [(3, 85, 512), (3, 85, 8), (5, 80, 512)])
def test_equals_brute_force(spark, odd_rows, size, percent, tile, monkeypatch):
    monkeypatch.setattr(minhash, "TILE_CLASSES", tile)
    rows = [r[:2] for r in odd_rows] + near_copies(60, 1) + near_copies(25, 2, 60)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = minhash.near_duplicates(docs, size=size, percent=percent).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found), key=repr) == brute(rows, size, percent)


def test_one_of_each_group_stays(clashing, empty):
    kept = minhash.deduplicate(clashing)
    assert kept.columns == clashing.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=repr)
    # 3 twice and 103 are one text; rows without words stay, as do those without an id and a different text.
    assert ids.count(3) == 1 and 103 not in ids and {100, 101, 102} <= set(ids) and ids.count(None) == 2
    assert minhash.deduplicate(empty).count() == 0


def test_estimate_corrects_for_chance():
    assert minhash.estimated(96) == 1 and abs(minhash.estimated(6)) < 1e-9


def test_components_of_long_chains(spark):
    rng = random.Random(2)
    nodes = [f"n{i:05d}" for i in range(300)]
    rng.shuffle(nodes)
    links = [(nodes[i], nodes[i + 1]) for i in range(299) if i % 100 != 99] + [("x", "y"), ("y", "x"), ("z", "z")]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a string, b string")).collect()}
    for part in (nodes[:100], nodes[100:200], nodes[200:]):
        assert {found[n] for n in part} == {min(part)}
    assert found["x"] == found["y"] == "x" and "z" not in found


def test_copies_of_one_text_do_not_meet_in_one_task(spark):
    """A third of the rows are one text; the rows that sets are made from are one for each text."""
    rows = [(i, words(40, 1), "en", "s", 0) for i in range(300)] + [(1000 + i, words(40, i // 2 + 2) + f" tail{i}", "en", "s", 0) for i in range(600)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6)
    signed = minhash.signatures(docs, 5).cache()
    first = signed.groupBy("class").agg(F.min(F.struct("doc_id", "text_key")).alias("r")).select("class", "r.*")
    sets = minhash.class_sets(docs, first, 5)
    assert sets.count() == sets.select("class").distinct().count() == signed.select("class").distinct().count()
    found = minhash.near_duplicates(docs, size=5, percent=80)
    assert found.where("component_id = 0").count() == 300
    assert {r["n"] for r in found.where("doc_id >= 1000").groupBy("component_id").agg(F.count("*").alias("n")).collect()} == {2}
