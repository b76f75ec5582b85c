"""Phrases and their scores against plain counting."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cooccur.llm import phrases, queries


def plain(rows, longest=4, least=30, percent=80, top=2000):
    counts, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i: i + k])] += 1
    often = {key: n for key, n in counts.items() if n >= least}
    gone = set()
    for (lang, words), n in often.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                part = words[i: i + k]
                if 100 * n >= percent * often[lang, part]:
                    gone.add((lang, part))
    ranked = {}
    for (lang, words), a in often.items():
        if len(words) > 1 and (lang, words) not in gone:
            score, _, l, r = min(
                (2_000_000 * a // (often[lang, words[:k]] + often[lang, words[k:]]), k, often[lang, words[:k]], often[lang, words[k:]])
                for k in range(1, len(words)))
            ranked.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), l, r))
    return sorted(
        (lang, i + 1, p.decode(), -a, l, r, total[lang], -score)
        for lang, best in ranked.items() for i, (score, a, p, l, r) in enumerate(sorted(best)[:top]))


def texts():
    rng = random.Random(4)
    vocabulary = ["a", "B", "b", "cé", "日本", "don't", "x-y", "é", "Z", "\x1c", "\x00w"]
    rows = []
    for i in range(300):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 40))]
        glue = lambda: rng.choice([" ", " ", " ", "\t", "  ", ", ", ".", "\n", "\r\n", "?! ", ":"])
        rows.append(("".join(w + glue() for w in words), rng.choice(["en", "en", None, "fr", "und", ""])))
    rows += [("the quick brown fox jumps", "en")] * 60 + [("quick brown bear", "en")] * 20 + [(None, "en"), ("", None), (" \t\n", "fr")]
    rows += [("la la la la la la la " * 900, "fr")]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(texts())], "doc_id long, text string, lang string").repartition(5)


@pytest.mark.parametrize("options", [{}, {"least": 5}, {"longest": 3, "least": 8, "percent": 40}, {"top": 7}, {"longest": 2}])
def test_equals_plain_counting(docs, options):
    got = sorted(tuple(r) for r in phrases.collocations(docs, **options).collect())
    assert got == plain(texts(), **options) and len(got) > 5


def test_blocks_of_any_size_give_the_same(docs, monkeypatch):
    want = plain(texts())
    monkeypatch.setattr(phrases, "BLOCK_WORDS", 50)
    assert sorted(tuple(r) for r in phrases.collocations(docs.coalesce(1)).collect()) == want


def test_products_beyond_64_bits(spark):
    n = 5 * 10**12
    level = spark.createDataFrame([(2, 1, "en", ["a", "b"], n, [2 * n, n], [2 * n - 3, n])], "size int, id long, lang string, words array<string>, f long, begins array<long>, ends array<long>")
    assert phrases.scored(level).first()["score"] == 2_000_000 * n // (4 * n - 3)


def test_odd_rows_names_and_empty_tables(odd, odd_rows, clashing, empty):
    want = plain([(r[1], r[2]) for r in odd_rows], least=2)
    assert sorted(tuple(r) for r in phrases.collocations(odd, least=2).collect()) == want
    clash = clashing.withColumns({c: F.lit("x") for c in ("block", "code", "head", "tail", "f", "gaps")})
    assert sorted(tuple(r) for r in phrases.collocations(clash, least=2).collect()) == want
    assert phrases.collocations(empty).count() == 0


def test_query(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(tuple(r) for r in queries.op11_phrases(spark, str(tmp_path)).collect()) == plain(texts())
