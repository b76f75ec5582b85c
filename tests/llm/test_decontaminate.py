import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cooccur.llm import decontaminate as d
from tests.llm.conftest import SCHEMA, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(docs, items):
    low = str.maketrans({c: c + 32 for c in range(65, 91)})
    windows = {}
    for item, text in items:
        own = WORD.findall((text or "").translate(low))
        n = min(13, len(own))
        for a in range(len(own) - n + 1) if n else ():
            windows.setdefault(tuple(own[a:a + n]), set()).add(item)
    out = []
    for doc, text in docs:
        own = WORD.findall((text or "").translate(low))
        hit, found = set(), set()
        for n in {len(w) for w in windows}:
            for a in range(len(own) - n + 1):
                items_here = windows.get(tuple(own[a:a + n]))
                if items_here:
                    hit |= set(range(a, a + n))
                    found |= {str(i) for i in items_here if i is not None}
        out.append((doc, len(own), len(hit), tuple(sorted(found))))
    return sorted(out, key=repr)


def result(docs, items, **options):
    found, hits, named = d.contamination(docs, items, **options)
    ids = named.groupBy("text_key").agg(F.sort_array(F.collect_set("item_id")).alias("ids"))
    rows = found.join(hits, "text_key", "left").join(ids, "text_key", "left").collect()
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"] or 0, tuple(r["ids"] or ())) for r in rows), key=repr)


@pytest.fixture(scope="module")
def bench(spark):
    long = words(40, 77)
    rows = [(1, long), (2, "Red Fox; jumps"), (3, "solo"), (4, None), (5, "..."), (None, words(20, 3)), (6, " ".join(long.split()[:20]) + " tail"), (1, long)]
    return rows, spark.createDataFrame(rows, "item_id long, text string")


@pytest.mark.parametrize("block", [1 << 20, 5])
def test_equals_brute_force(spark, odd_rows, bench, block):
    rows, items = bench
    passage = words(40, 77).split()
    planted = [(200, "x y " + " ".join(passage[5:25]).upper() + " z", "en", "s", 0), (201, "the red, fox! jumps and red fox jumps SOLO", "en", "s", 0),
               (202, " ".join(passage[:12]), "en", "s", 0), (203, words(900, 5) + " " + " ".join(passage[3:17]), "en", "s", 0), (204, " ".join(passage * 3), "en", "s", 0)]
    docs = spark.createDataFrame(odd_rows + planted, SCHEMA).repartition(3)
    assert result(docs, items, block=block) == brute([r[:2] for r in odd_rows + planted], rows)


def test_winnowing_guarantee():
    rng = np.random.default_rng(1)
    for length in (1, 2, 5, 12, 13):
        text = rng.integers(0, 1 << 60, 200, dtype=np.uint64)
        places, prints = d.winnow(text, length)
        for at in range(0, 200 - length):
            assert set(d.winnow(text[at:at + length], length)[1]) & set(prints)
        assert len(places) == len(prints)


def test_stage_keeps_clean_documents(clashing, bench, empty):
    kept = d.decontaminate(clashing, bench[1])
    assert kept.columns == clashing.columns
    gone = {r["doc_id"] for r in clashing.collect()} - {r["doc_id"] for r in kept.collect()}
    assert gone == {3, 103}  # their words are those of an item
    assert d.decontaminate(empty, bench[1]).count() == 0
    assert d.decontaminate(clashing, bench[1].where("false")).count() == clashing.count()
