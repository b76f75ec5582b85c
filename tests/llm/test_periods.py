"""Periodic runs against a plain search, and the query against its contract."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from cooccur.llm import periods, queries


def plain_runs(words, least=6, times=4):
    """Every stretch that keeps a period and can't be made longer, smallest periods only."""
    found, n = [], len(words)
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(least, times * q) and not any(
                    all(words[x] == words[x + d] for x in range(i, i + length - d)) for d in range(1, q)):
                found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_collapsed(words, runs):
    return [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs)]


def texts():
    rng = random.Random(3)
    out = ["", None, "a", "a a a a a", "a a a a a a", "A a A a A a A a", "x " * 700, "ab\tab\nab\x0bab ab  ab", "é é é é é é ü"]
    for n in (12, 30, 60, 90):
        for letters in ("ab", "abc", "abcdefgh"):
            for _ in range(12):
                out.append(" ".join(rng.choice(letters) for _ in range(n)))
    for _ in range(40):
        unit = [rng.choice("abcdef") for _ in range(rng.randint(1, 9))]
        body = (unit * 12)[: rng.randint(6, 60)]
        edge = lambda: [rng.choice("abcdef") for _ in range(rng.randint(0, 6))]
        out.append(" ".join(edge() + body + edge() + body + edge()))
    inner = ["p", "q"] * 5
    out.append(" ".join((inner + ["z"]) * 6))
    out.append(" ".join(f"w{i % 300}" for i in range(4000)) + " end")
    return out


@pytest.fixture(scope="module")
def found(spark):
    rows = [(i, t) for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return {r["doc_id"]: r for r in periods.periodic_runs(docs).withColumn("best", periods.strongest("runs")).collect()}


def test_all_runs_are_found_once_and_exactly(found):
    for i, text in enumerate(texts()):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        want = plain_runs(words) if len(words) < 1000 else [(0, 4000, 300)]
        got = [tuple(r) for r in found[i]["runs"]]
        assert got == want, (i, text)
        assert found[i]["n_words"] == len(words)
        assert found[i]["collapsed"] == " ".join(plain_collapsed(words, want))


def test_strongest_run_breaks_ties_by_start(found):
    for row in found.values():
        runs = [tuple(r) for r in row["runs"]]
        want = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2])) if runs else None
        assert (tuple(row["best"]) if row["best"] else None) == want


@pytest.mark.parametrize("least,times", [(2, 2), (5, 2), (6, 3), (12, 5)])
def test_other_limits(spark, least, times):
    rows = [(i, t) for i, t in enumerate(texts()) if t and len(t) < 200]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for r in periods.periodic_runs(docs, least=least, times=times).collect():
        assert [tuple(x) for x in r["runs"]] == plain_runs(rows and dict(rows)[r["doc_id"]].split(), least, times), r


def test_a_long_text_of_one_word_and_a_long_period(spark):
    docs = spark.createDataFrame([(1, "na " * 60000), (2, " ".join(f"w{i % 9000}" for i in range(60000)))], "doc_id long, text string")
    got = {r["doc_id"]: r for r in periods.periodic_runs(docs).collect()}
    assert [tuple(r) for r in got[1]["runs"]] == [(0, 60000, 1)] and got[1]["collapsed"] == "na"
    assert [tuple(r) for r in got[2]["runs"]] == [(0, 60000, 9000)]


def test_odd_rows_and_names(odd, clashing, empty):
    got = periods.periodic_runs(odd).collect()
    assert len(got) == odd.count() and not any(r["runs"] for r in got)
    assert periods.collapsed(clashing).count() == odd.count()
    assert periods.periodic_runs(empty).count() == 0
    with pytest.raises(ValueError):
        periods.periodic_runs(odd, times=1)


def _altered(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def test_query_equals_its_contract(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, rng.choice([" ", "\n", " \t"]).join(rng.choice(["a", "b", "cc", "é", "D"]) for _ in range(rng.randint(0, 80)))) for i in range(300)]
    rows += [(300, None), (301, ""), (7, rows[7][1])]
    spark.createDataFrame(rows, "doc_id long, text string").withColumn("runs", F.lit(1)).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(queries.op13_periodic_runs(spark, str(tmp_path)).collect())
    want = []
    for doc_id, text in rows:
        words = _altered(doc_id, text)
        runs = plain_runs(words)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2])) if runs else (None,) * 3
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
                     sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(plain_collapsed(words, runs)))))
    assert [tuple(r) for r in got] == sorted(want)
    assert sum(r[1] > 0 for r in want) > 10
