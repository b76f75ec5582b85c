import random

import pytest
from pyspark.sql import functions as F

from cooccur.llm import secrets
from tests.llm.conftest import SCHEMA


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(3)
    rows = []
    for i in range(150):
        hidden = "".join(rng.choice("0123456789abcdef") for _ in range(40))
        number = "".join(rng.choice("0123456789") for _ in range(16))
        part = (f'then token = "{hidden}" follows', f"card {number} was used", "password: example-password-123 here", f"see https://site{i}.org/page/{i} now")[i % 4]
        rows.append((i, f"some words before it {part} and words after that", "en", f"dir{i % 3}/file", 0))
    return spark.createDataFrame(rows, SCHEMA)


def test_secrets_are_told_from_the_rest(docs):
    found = secrets.scan_secrets(docs).collect()
    by = {r["doc_id"]: r for r in found}
    assert all(by[i]["secret"] for i in range(0, 150, 4))
    assert not any(r["secret"] for r in found if r["doc_id"] % 4)


def test_labelled_findings_decide(docs):
    values = secrets.candidates(docs).select("doc_id", "value")
    labels = values.where("doc_id % 8 < 2").select("value", (F.col("doc_id") % 4 == 1).cast("int").alias("label"))
    found = secrets.scan_secrets(docs, labels).where("doc_id % 4 = 1 and doc_id % 8 > 2").collect()
    assert found and all(r["secret"] for r in found)  # the other way round


def test_odd_rows(odd, clashing, empty, odd_rows):
    assert secrets.scan_secrets(empty).count() == 0
    found = secrets.scan_secrets(odd)
    assert found.count() == secrets.scan_secrets(clashing.withColumn("value", F.lit(1))).count()
    assert found.where("doc_id in (100, 101, 102)").count() == 0


def test_no_python_in_tasks(docs):
    plan = secrets.features(secrets.candidates(docs), ["word"], [-1.0] * 676)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_every_secret_of_a_word_is_a_candidate(spark):
    one, two = "sk_live_0a1B2c3D4e5F6g7H", "ghp_9Z8y7X6w5V4u3T2s1R0q"
    texts = [
        f'{{"id":"7","api_key":"{one}","x":"y","token":"{two}"}}', f"a=1;token={one};b=2;secret={two}", f"https://host.org/p?u=1&api_key={one}&token={two}",
        f"7,alice,{one},{two},x", f"A=1,TOKEN={one},SECRET='{two}'", f'{{\\"api_key\\":\\"{one}\\",\\"token\\":\\"{two}\\"}}',
        f'{{"a":1,"api_key": "{one}","token": "{two}"}}', "password=ab&cd?ef,GH", 'x:1,"password":"ab,cd;ef-GH"', "a,b;password=hunter-Two"]
    rows = [(i, text, "en", "s", 0) for i, text in enumerate(texts)]
    got = {}
    for r in secrets.candidates(spark.createDataFrame(rows, SCHEMA)).collect():
        got.setdefault(r["doc_id"], []).append((r["name"], r["value"]))
    want = {
        0: [("api_key", one), ("token", two)], 1: [("token", one), ("secret", two)], 2: [("", "https://host.org/p"), ("api_key", one), ("token", two)],
        4: [("TOKEN", one), ("SECRET", two)], 5: [("api_key", one), ("token", two)],
        6: [("api_key", one), ("token", two)], 7: [("password", "ab&cd?ef,GH")], 8: [("password", "ab,cd;ef-GH")], 9: [("password", "hunter-Two")]}
    want[2] = want[2][1:]  # an address without a digit is none
    assert {i: sorted(x) for i, x in got.items() if i != 3} == {i: sorted(x) for i, x in want.items()}
    assert {("", one), ("", two)} <= set(got[3])  # and the whole word, which nothing assigns to a name


def test_secrets_of_one_word_are_told_from_the_rest(spark):
    rng = random.Random(4)
    key = lambda: "".join(rng.choice("0123456789abcdefABCDEF") for _ in range(32))
    rows = [(i, f'see {{"id":"{i}","api_key":"{key()}","at":"2024-01-02T03:04:05","token":"{key()}"}} or https://s.org/p?u=1&secret={key()} now', "en", "s", 0) for i in range(40)]
    found = secrets.scan_secrets(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["doc_id"], r["name"]) for r in found if r["secret"]) == sorted((i, n) for i in range(40) for n in ("api_key", "token", "secret"))
