import math
import random

import numpy as np
import pytest

from cooccur.llm import toxicity
from cooccur.llm.frames import learnable
from tests.llm.conftest import SCHEMA

SYLLABLES = ["ra", "to", "mi", "len", "vor", "sta", "que", "dil", "pon", "ure"]


@pytest.fixture(scope="module")
def corpus(spark):
    """A third of the texts toxic: half of those by listed words, half by stems that only labels tell."""
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(400):
        own = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(60)]
        toxic = int(i % 3 == 0)
        if toxic:
            for _ in range(3):
                own[rng.randrange(60)] = rng.choice(["idiot", "moron", "scum"] if i % 2 else ["xylgo" + rng.choice(SYLLABLES), "bakdu" + rng.choice(SYLLABLES)])
        rows.append((i, " ".join(own), "en", "s", 0))
        if i % 4:
            labels.append((i, 1, toxic))
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(corpus):
    docs, labels = corpus
    rows = toxicity.scored(docs, labels).withColumn("fit", learnable("doc_id", toxicity.FOLDS)).collect()
    assert len(rows) == 400 and all(0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if not r["fit"]]
    right = sum((r["score"] >= 0.5) == (r["doc_id"] % 3 == 0) for r in held)
    assert right >= 0.95 * len(held)
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert kept.where("doc_id % 3 <> 0").count() >= 0.97 * docs.where("doc_id % 3 <> 0").count()


def test_labels_of_the_held_out_fold_are_not_used(corpus):
    docs, labels = corpus
    flipped = labels.selectExpr("doc_id", "quality", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 1 - toxic, toxic) as toxic")
    one = {r["doc_id"]: r["score"] for r in toxicity.scored(docs, labels).collect()}
    assert one == {r["doc_id"]: r["score"] for r in toxicity.scored(docs, flipped).collect()}


def test_label_model_divides_the_weight_of_copies(spark):
    rng = np.random.default_rng(4)
    rows = []
    for _ in range(2000):
        toxic = rng.random() < 0.3
        a, b = rng.random() < (0.7 if toxic else 0.02), rng.random() < (0.6 if toxic else 0.03)
        rows.append(([0] if a else []) + ([2] if b else []))

    copied = [[0, 1, *r[1:]] if r[:1] == [0] else r for r in rows]  # voter 1 copies voter 0
    counted = spark.createDataFrame([(r,) for r in copied], "fired array<int>").groupBy("fired").count().withColumnRenamed("count", "n")
    found = toxicity.label_model(counted, 3, 0.3, np.full(3, 0.6), np.full(3, 0.05)).weights
    assert found[2] > 1 and abs(found[0] - found[1]) < 1e-6
    # Two voters of these rates that did not repeat each other would be worth twice the log of their ratio.
    assert found[0] + found[1] < 0.75 * 2 * math.log(0.7 / 0.02)


def test_odd_rows(odd, clashing, labels, empty):
    found = {r["doc_id"]: r["score"] for r in toxicity.scored(odd, labels).collect()}
    assert found[108] > 0.5 > found[3] and found[100] == found[101] == found[102] < 0.5
    assert toxicity.without_toxic(clashing, labels.where("false")).columns == clashing.columns
    assert toxicity.scored(empty, labels).count() == 0
