import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cooccur.functions.scores import llr, unit_random
from cooccur.functions.typed import instant, typed_value


def entropy_llr(k11, ca, cb, n):
    def h(x):
        return x * math.log(x) if x > 0 else 0.0

    cells = [k11, cb - k11, ca - k11, n - ca - cb + k11]
    return 2 * (sum(map(h, cells)) - h(ca) - h(n - ca) - h(cb) - h(n - cb) + h(n))


def score(spark, tables):
    frame = spark.createDataFrame(tables, "k11 long, ca long, cb long, n long")
    return [r[0] for r in frame.select(llr(*[F.col(c) for c in frame.columns])).collect()]


def test_known_tables(spark):
    independent, dependent, all_users = score(spark, [(25, 50, 50, 100), (10, 10, 10, 100), (5, 100, 5, 100)])
    assert independent == 0.0
    assert math.isclose(dependent, round(entropy_llr(10, 10, 10, 100), 6))
    assert all_users == 0.0


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(*[st.integers(0, 400)] * 4), min_size=20, max_size=40))
def test_same_as_entropy_form(spark, cells):
    tables = [(a, a + b, a + c, a + b + c + d) for a, b, c, d in cells if a + b + c + d > 0]
    if tables:
        got = score(spark, tables)
        assert all(g >= 0 for g in got)
        assert all(abs(g - max(0.0, entropy_llr(*t))) < 2e-6 for g, t in zip(got, tables, strict=True))


def test_digits_survive_many_users(spark):
    """The entropy form is off by more than its rounding here; exact value from the series."""
    n = 4_000_000_000
    got = score(spark, [(200, 100_000, 100_000, n)])[0]
    expected = 100_000 * 100_000 / n
    exact = 2 * (200 * math.log(200 / expected) - (200 - expected))
    assert abs(got - exact) / exact < 1e-2


def test_unit_random_is_reproducible(spark):
    df = spark.range(200).select(F.col("id").cast("string").alias("item"))
    a = [r[0] for r in df.select(unit_random(3, "item")).collect()]
    b = [r[0] for r in df.repartition(5).orderBy(F.col("item").cast("int")).select(unit_random(3, "item")).collect()]
    assert a == b and all(0 <= x < 1 for x in a) and len(set(a)) == 200


def test_typing(spark):
    def one(text, kind):
        return spark.range(1).select(typed_value(F.lit(text), kind)).first()[0]

    assert one("1.5", "double") == 1.5 and one("x", "double") is None
    assert one("7", "bigint") == 7 and one("true", "boolean") is True
    assert one('["a","b"]', "array<string>") == ["a", "b"] and one("a", "array<string>") == ["a"]
    assert one("[1,2]", "array<bigint>") == [1, 2]
    zoned = spark.range(1).select(instant(F.lit("2024-01-01T02:00:00+02:00"))).first()[0]
    assert str(zoned) == "2024-01-01 00:00:00"
    assert spark.range(1).select(instant(F.lit("never"))).first()[0] is None
