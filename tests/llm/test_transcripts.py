import hashlib
import itertools
from collections import Counter

import numpy as np
import pytest

from cooccur.llm import transcripts as t

SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.fixture(scope="module")
def talks(spark):
    rows = []
    for c in range(60):
        rows.append((c, 0, "system", "You follow rules."))
        for k in range(1, 7):
            asks = k % 2 == 1
            rows.append((c, k, "user" if asks else "assistant", f"What is {c + k}?" if asks else f"It is {c + k}.\nHere is a longer explanation of it.\n- a list\n- and more"))
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_held_out_roles(talks):
    found = t.recovered(talks).collect()
    truth = {(r["conv_id"], r["turn"]): r["role"] for r in talks.collect()}
    first = [r for r in found if r["part"] == 0]
    assert len(first) == len(truth)
    assert sum(truth[r["conv_id"], r["turn"]] == r["role"] for r in first) >= 0.97 * len(first)
    assert all(r["rendered"].startswith(f"<|{r['role']}|>\n") and r["rendered"].endswith("\n<|end|>\n") for r in found)


def test_path_is_the_best_of_all():
    rng = np.random.default_rng(2)
    matrices, entry = rng.normal(size=(5, t.STATES, t.STATES)), rng.normal(size=t.STATES)
    for last in (-1, 3):
        score = lambda p: entry[p[0]] + sum(matrices[i][p[i], p[i + 1]] for i in range(5))
        want = max((p for p in itertools.product(range(t.STATES), repeat=6) if last < 0 or p[-1] == last), key=score)
        assert tuple(t.best_path(matrices, entry, last)) == want[1:]
    product = t.product(matrices)
    assert np.isclose(product[want[0], 3], score(want) - entry[want[0]])


def test_levels_do_not_change_the_path(spark, talks, monkeypatch):
    long = spark.createDataFrame([(7, k, None, ("Why so?" if k % 2 else "Because it is.\nAnd that is all there is to say.")) for k in range(60)], SCHEMA)
    model = t.fit(talks)
    rows = lambda: sorted(map(tuple, t.parse_transcripts(long, model).collect()))
    one = rows()
    monkeypatch.setattr(t, "SPAN", 3)
    assert rows() == one
    assert [r[3] for r in one if r[1] % 2] == ["user"] * 30


def test_markers_in_a_whole_transcript(spark):
    text = "System: Be kind.\nUser: Hello there\nAssistant: Hi.\nHow are you?\n\nHuman: Fine.\nAI: Good."
    learned = spark.createDataFrame(
        [(c, k, r, m) for c in range(20) for k, (r, m) in enumerate([("system", "System: Be kind."), ("user", "User: Hello you"), ("assistant", "Assistant: Hi.\nHow are you?\n\nTell me.\n"), ("user", "Human: Fine."), ("assistant", "AI: Good.")])], SCHEMA)
    found = sorted(t.parse_transcripts(spark.createDataFrame([(1, None, None, text)], SCHEMA), t.fit(learned)).collect(), key=lambda r: r["part"])
    assert [r["role"] for r in found] == ["system", "user", "assistant", "user", "assistant"]
    assert found[0]["text"] == "Be kind." and found[2]["text"] == "Hi.\nHow are you?\n" and found[0]["turn"] is None


def test_odd_rows(spark, talks):
    odd = spark.createDataFrame([(None, None, None, None), (1, 5, "user", ""), (1, 5, "user", ""), (1, 5, "user", "x"), (1, -3, "alien", "y\n" * 3000), (2, 10**12, "user", "z")], SCHEMA)
    found = t.parse_transcripts(odd.selectExpr("*", "1 as place", "2 as tie", "3 as conv"), t.fit(talks)).where("part = 0").collect()
    assert sorted(((r["conv_id"], r["turn"]) for r in found), key=repr) == sorted([(None, None), (1, 5), (1, 5), (1, None), (2, 10**12)], key=repr)
    assert t.recovered(talks.where("false")).count() == 0


def test_equal_turns_of_a_null_conversation_are_numbered(spark, talks, monkeypatch):
    said = [("Why so?" if k % 2 else f"Because it is {k}.\nAnd that is all there is to say.") + f" {k}" for k in range(90)]
    rows = [(None, (None, None, 4)[k % 3], None, text) for k, text in enumerate(said)] + [(9, k, None, "Why?") for k in range(30)]
    many = spark.createDataFrame(rows, SCHEMA).repartition(5)
    order = sorted(((-1 if r[1] is None else r[1]), hashlib.md5(r[3].encode()).hexdigest(), r[3]) for r in rows if r[0] is None)
    model = t.fit(talks)
    found = lambda: sorted(map(tuple, t.parse_transcripts(many, model).collect()), key=repr)
    one = found()
    assert len([r for r in one if r[2] == 0]) == len(rows)
    monkeypatch.setattr(t, "SPAN", 8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the conversation runs through all sort partitions
    try:
        places = t._messages(many, "conv_id", "turn", "text").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [(r["place"], r["text"], r["first"]) for r in sorted(places, key=lambda r: r["place"]) if r["conv_id"] is None] == [
        (i, text, i == 0) for i, (_, _, text) in enumerate(order)]
    assert max(Counter((r["conv"], r["place"] // t.SPAN) for r in places).values()) <= t.SPAN
    assert found() == one
