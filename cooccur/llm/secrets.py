"""Secret scans: candidates by pattern, false positives removed by a random forest.

A candidate is a long run of token characters with a digit in it, or any value that is assigned
to a name. Its features are its length, how its characters follow each other (changes of kind,
and the likelihood of its letters under the pairs of letters of the corpus' words), how much of
it dictionary words cover, the path it was found under, and the words around it. A forest
trained on labelled findings separates secrets from the rest.

Labelled findings are an argument. Without them they are derived from the candidates: an
unbroken value of mixed letters and digits that is assigned to a credential's name is one; plain
numbers, words and placeholders are none; everything else has no label. The dictionary and the
pairs of letters are counted over all texts; the forest is fitted to at most about ``SAMPLE``
labelled findings. DataFrame functions and the JVM's forest only.

Null and empty texts have no candidates. Repeated rows have equal findings. If the labels are
all alike, their share is everyone's probability.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cooccur.llm.frames import freeze

SAMPLE = 20_000
#: Words of the dictionary, and the least letters of one.
DICTIONARY = 512
SHORTEST = 4
TREES, DEPTH = 24, 8
WORD_BUCKETS = 64
PATH_BUCKETS = 32

#: Least characters of a candidate with a digit, and of a value that is assigned to a name.
LONG, ASSIGNED = 16, 8
NAMED = r"^[^A-Za-z0-9]*([A-Za-z_.-]{2,40})[\"'`]?(?::=|=|:(?!//))"
EDGES = r"^[^A-Za-z0-9+/_]+|[^A-Za-z0-9+/_=]+$"
#: What a word is cut at, a name with its sign inside a word, one piece of a word, and a value in quotes.
QUOTES, CUTS = "\"'`", "\"'`,;{}?&"
SIGNED = r"([A-Za-z][A-Za-z0-9_.-]{1,39})\\{0,3}[" + QUOTES + r"]?(?::=|=|:(?!//))"
PIECE = rf"(?:[^A-Za-z0-9{CUTS}]*{SIGNED}\\{{0,3}}[{QUOTES}]?)?([^{CUTS}]+)"
QUOTED = rf"(?s)(?:[{QUOTES}]?{SIGNED})?\\{{0,3}}([{QUOTES}])(.+?)\2"
INNER = rf"[{CUTS}]{SIGNED}"
#: Fixed names of credentials and of placeholders.
CREDENTIAL = r"(?i)(token|secret|passw|pwd|api[_-]?key|access[_-]?key|auth|credential|private[_-]?key|bearer)"
PLACEHOLDER = r"(?i)(example|sample|dummy|placeholder|changeme|your[_-]|xxxx|test|1234567|abcdef)"


def candidates(docs: DataFrame, *, doc_id: str = "doc_id", path: str = "source", text: str = "text") -> DataFrame:
    """(doc_id, path, nth, before, name, value, after): every candidate of every text, in order.

    A text is split into words once; a word is looked at more closely only if it is long enough
    and has a digit or the sign of an assignment, or follows one. ``nth`` is the word's place.
    Such a word is cut into pieces, each with a name of its own if it has one; a value with signs
    of a cut in it is a candidate as a whole, too, unless there is another assignment in it.
    """
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{path}`").cast("string"), F.lit("")).alias("path"),
        F.split(F.col(f"`{text}`").cast("string"), r"[ \t\n\x0B\f\r]+").alias("words"))

    def wanted(i: Column) -> Column:
        word, before = F.get("words", i), F.get("words", i - 1)
        return (F.length(word) >= ASSIGNED) & (
            ((F.length(word) >= LONG) & word.rlike("[0-9]")) | word.rlike("[=:]") | F.coalesce(F.substring(before, -1, 1).isin("=", ":"), F.lit(False)))

    places = F.filter(F.sequence(F.lit(0), F.size("words") - 1), wanted)
    near = rows.select("doc_id", "path", F.explode(F.transform(places, lambda i: F.struct(
        i.alias("nth"), F.get("words", i).alias("word"), *[
            F.coalesce(F.get("words", i + k), F.lit("")).alias(n) for k, n in ((-2, "b2"), (-1, "b1"), (1, "after"))]))).alias("c")).select(
        "doc_id", "path", "c.*")
    sign = F.col("b1").isin("=", ":", ":=")
    # The name before a value that stands in the next word: the last piece, if that word has several.
    last = F.regexp_extract("b1", rf"([^{CUTS}=:]+)\\{{0,3}}[{QUOTES}]?[=:]+$", 1)
    outer = F.when(sign, F.regexp_extract(F.regexp_replace("b2", EDGES, ""), f"[^{CUTS}=:]*$", 0)).when(
        F.col("b1").rlike("[=:]$"), F.regexp_replace(F.when(last != "", last).otherwise(F.regexp_replace("b1", "[=:]+$", "")), EDGES, "")).otherwise("")
    near = near.withColumn("outer", outer)

    def pieces(pattern: str, at: int) -> Column:
        names, values = (F.regexp_extract_all("word", F.lit(pattern), F.lit(i)) for i in (1, at))
        return F.transform(F.arrays_zip(names.alias("inner"), values.alias("value")), lambda x, i: F.struct(
            x["inner"].alias("inner"), F.when(x["inner"] != "", x["inner"]).when(i == 0, F.col("outer")).otherwise("").alias("name"),
            F.regexp_replace(x["value"], EDGES, "").alias("value")))

    def candidate(x: Column) -> Column:
        value = x["value"]
        return ((F.length(value) >= LONG) & value.rlike("[0-9]")) | ((x["name"] != "") & (F.length(value) >= ASSIGNED) & value.rlike("[^a-z]"))

    def whole(x: Column) -> Column:
        return x["value"].rlike(f"[{CUTS}]") & ~x["value"].rlike(INNER) & candidate(x)

    start = F.regexp_extract("word", NAMED, 1)
    word = F.struct(
        start.alias("inner"), F.when(start != "", start).otherwise(F.col("outer")).alias("name"),
        F.regexp_replace(F.regexp_replace("word", NAMED, ""), EDGES, "").alias("value"))
    cut = near.withColumn("pieces", F.filter(pieces(PIECE, 2), candidate)).withColumn("quoted", F.filter(pieces(QUOTED, 3), whole)).withColumn("own", word)
    own = F.filter(F.array("own"), lambda x: whole(x) & ~F.col("word").rlike(INNER + "$") & ~F.exists("quoted", lambda q: q["value"] == x["value"]))
    found = cut.select("doc_id", "path", "nth", "b1", "b2", "after", F.explode(F.concat("pieces", "quoted", own)).alias("c"))
    before = F.when((F.col("c.inner") != "") | (F.col("c.name") == ""), F.col("b1")).otherwise(F.col("b2"))
    return found.select("doc_id", "path", "nth", before.alias("before"), "c.name", "c.value", "after")


def word_counts(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """(word, n) of the words of ASCII letters of all texts."""
    words = docs.select(F.explode(F.split(F.lower(F.col(f"`{text}`").cast("string")), "[^a-z]+")).alias("word"))
    return words.where(F.length("word") >= SHORTEST).groupBy("word").agg(F.count("*").alias("n"))


def dictionary(counts: DataFrame, size: int = DICTIONARY) -> list[str]:
    """The most frequent words, a bounded list; longer ones first, as they must match first."""
    words = [r["word"] for r in counts.orderBy(F.desc("n"), "word").limit(size).collect()]
    return sorted(words, key=lambda w: (-len(w), w))


def letter_pairs(counts: DataFrame) -> list[float]:
    """log P(next letter | letter) by 26 * letter + next: from pairs in all words."""
    at = F.explode(F.sequence(F.lit(1), F.length("word") - 1))
    pairs = counts.select("n", "word", at.alias("i")).groupBy(F.substr("word", F.col("i"), F.lit(2)).alias("pair")).agg(F.sum("n").alias("n"))
    n = [[0.5] * 26 for _ in range(26)]
    for row in pairs.collect():  # at most 26 * 26 rows
        n[ord(row["pair"][0]) - 97][ord(row["pair"][1]) - 97] += row["n"]
    from math import log

    return [log(x / sum(row)) for row in n for x in row]


def _share(part: Column, value: Column) -> Column:
    return part / F.greatest(F.length(value), F.lit(1))


def _word_likelihood(value: Column, pairs: list[float]) -> Column:
    """Mean log probability of the neighbouring letters in a value; that of chance if it has none."""
    table = F.array(*[F.lit(float(p)) for p in pairs])
    letters = F.lower(value)
    codes = F.transform(F.split(letters, ""), lambda c: F.ascii(c) - 97)
    steps = F.zip_with(codes, F.slice(F.concat(codes, F.array(F.lit(-1))), 2, F.size(codes)), lambda a, b: F.when(
        a.between(0, 25) & b.between(0, 25), F.get(table, (a * 26 + b).cast("int"))))
    known = F.filter(steps, lambda x: x.isNotNull())
    mean = F.aggregate(known, F.lit(0.0), lambda total, x: total + x) / F.size(known)
    return F.when(F.size(known) > 0, mean).otherwise(F.lit(-3.26))


def features(found: DataFrame, words: list[str], pairs: list[float]) -> DataFrame:
    """``found`` with a vector ``features``."""
    value = F.col("value")
    length = F.length(value).cast("double")
    pattern = "|".join(words) or "(?!)"
    uncovered = F.length(F.regexp_replace(F.lower(value), pattern, ""))

    def bucket(column: str, buckets: int) -> Column:
        return F.pmod(F.xxhash64(F.lower(F.col(column))), F.lit(buckets)).cast("double")

    parts = [
        length,
        _share(F.regexp_count(value, F.lit(r"(?<=[A-Za-z])(?=[0-9])")), value), _share(F.regexp_count(value, F.lit(r"(?<=[0-9])(?=[A-Za-z])")), value),
        _share(F.regexp_count(value, F.lit(r"(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])")), value),
        _share(F.regexp_count(value, F.lit(r"[0-9]")), value), _share(F.regexp_count(value, F.lit(r"[^A-Za-z0-9]")), value),
        _share(F.regexp_count(value, F.lit(r"(.)\1")), value), value.rlike(r"^[0-9a-fA-F]+$").cast("double"),
        F.size(F.array_distinct(F.split(value, ""))) / length,
        _word_likelihood(value, pairs),
        1 - _share(uncovered, value),
        F.regexp_count("path", F.lit("/")).cast("double"), bucket("path", PATH_BUCKETS),
        (F.length("name") > 0).cast("double"), F.concat_ws(" ", "before", "name").rlike(CREDENTIAL).cast("double"),
        F.concat_ws(" ", "before", "name", "after").rlike(PLACEHOLDER).cast("double"),
        bucket("before", WORD_BUCKETS), bucket("name", WORD_BUCKETS), bucket("after", WORD_BUCKETS),
    ]
    doubles = [F.coalesce(p.cast("double"), F.lit(0.0)) for p in parts]
    return found.withColumn("features", array_to_vector(F.array(*doubles)))


def derived_label() -> Column:
    """1 for certain secrets, 0 for what certainly is none, else null."""
    value, context = F.col("value"), F.concat_ws(" ", "before", "name")
    mixed = reduce(lambda a, b: a & b, [value.rlike(p) for p in (r"[0-9].*[0-9].*[0-9]", r"[A-Za-z].*[A-Za-z].*[A-Za-z]", r"^\S{16,}$")])
    plain = value.rlike(r"^[0-9.+/_=-]+$") | value.rlike(r"^(.)\1+$") | value.rlike(PLACEHOLDER) | value.rlike(r"^[A-Za-z]*[0-9]?$")
    dated = value.rlike(r"^(?:https?|www|[a-z]+\.[a-z]+)") | value.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}")
    return F.when(plain | dated | context.rlike(PLACEHOLDER), 0.0).when(mixed & context.rlike(CREDENTIAL), 1.0)


def scan_secrets(
    docs: DataFrame, labels: DataFrame | None = None, *, sample: int = SAMPLE, seed: int = 17,
    doc_id: str = "doc_id", path: str = "source", text: str = "text", threshold: float = 0.5,
) -> DataFrame:
    """(doc_id, nth, name, value, probability, secret) of every candidate.

    ``labels`` are labelled findings (value, label 0 or 1); without them labels are derived.
    """
    found = freeze(candidates(docs, doc_id=doc_id, path=path, text=text))
    counts = freeze(word_counts(docs, text=text))
    ready = freeze(features(found, dictionary(counts), letter_pairs(counts)))
    if labels is None:
        labelled = ready.withColumn("label", derived_label())
    else:
        labelled = ready.join(labels.groupBy("value").agg(F.max("label").cast("double").alias("label")), "value", "left")
    labelled = labelled.where("label is not null").select("features", "label", "value")
    # A finding that is copied a thousand times is one example.
    examples = labelled.groupBy("value", "label").agg(F.first("features").alias("features"))
    sizes = {r["label"]: r["count"] for r in examples.groupBy("label").count().collect()}  # a row per label
    total = sum(sizes.values())
    if len(sizes) < 2:
        scored = ready.withColumn("probability", F.lit(float(next(iter(sizes), 0.0))))
    else:
        share = F.lit(int((1 << 20) * min(1.0, sample / total)))
        fitted = examples.where(F.pmod(F.xxhash64("value"), F.lit(1 << 20)) < share).withColumn(
            "weight", F.when(F.col("label") == 1, total / (2 * sizes[1.0])).otherwise(total / (2 * sizes[0.0])))
        forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=seed, weightCol="weight", maxBins=64).fit(freeze(fitted))
        scored = forest.transform(ready).withColumn("probability", vector_to_array("probability")[1])
    return scored.select("doc_id", "nth", "name", "value", "probability", (F.col("probability") >= threshold).alias("secret"))
