import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(n, seed):
    """n different-looking words that depend on the seed."""
    return " ".join(f"w{(seed * 7919 + i * 104729) % 99991}x" for i in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Null and empty cells, repeated rows, ties, a long text, equal texts."""
    rows = [(i, words(30 + i, i), "en", f"s{i % 3}", 0) for i in range(12)]
    rows += [(100, None, "en", "s0", 0), (101, "", None, None, None), (102, " \n\t ", "en", None, 0), (None, words(40, 50), "en", "s1", 0),
             (None, None, None, None, None), (3, words(33, 3), "en", "s0", 0), (103, words(33, 3), "en", "s2", 0),
             (104, words(30000, 9), "en", "s2", 0), (105, "Ünï çødé — 日本語 👍 don't <|endoftext|>  x", "xx", "é", 0), (106, "one", "en", "s1", 0),
             (107, "one two", "en", "s1", 0), (108, "You are a pathetic IDIOT and a moron!", "en", "s0", 0)]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def clashing(odd):
    """The same rows with columns named like the operators' own."""
    from pyspark.sql import functions as F

    return odd.withColumns({c: F.lit(1) for c in ("_key", "text_key", "_text_key", "class", "size", "place", "_mix", "src", "target", "times", "_row", "word", "n")})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(i, 1, 0) for i in range(12)] + [(108, 0, 1), (None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
