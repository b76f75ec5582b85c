"""Toxicity by weak supervision.

1. Voters. Fixed word lists, patterns of style, and word stems mined from labelled documents
   that are free to be learned from (a bounded sample of them, ``SAMPLE`` rows). A voter fires
   on a text or abstains, which says nothing; one voter fires where no word or pattern does. One pass over all texts finds who fires.
2. Label model. The firing patterns of all documents, counted, are all it sees: expectation
   maximization estimates how often each voter fires on toxic and on other texts, then the
   correlations of voters given the label, by which the weight of voters that repeat each other
   is divided. It gives every pattern a posterior. Gold labels set the share of toxic texts and
   a prior of the voters' rates, which weighs as much as all documents do.
3. Linear classifier. A logistic regression on the firing voters and on dense features of style,
   trained on the posterior labels of a bounded sample of texts, half of them with votes, scores
   all texts.

A score depends on the text alone: equal texts get equal scores, null and empty ones the score
of a text on which nobody fires. Rows without a label, with a null id or a null label are never
learned from. Without any labels, the fixed voters and their prior are left.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cooccur.llm.frames import arrow_rows, freeze, learnable, text_digest
from cooccur.llm.text import chunks
from cooccur.session import scratch

#: Labelled rows that stems are mined from, and texts that the classifier is fitted to, at most (about).
SAMPLE = 12_000
#: Stems that become voters, at most.
STEMS = 64
FOLDS = 5
ROUNDS = 8
#: Texts that the assumed rates of a voter are worth, beside the labelled sample's.
PRIOR = 4.0

#: Fixed word lists: each list is a voter per word.
LEXICON = {
    "insult": "idiot moron imbecile loser clown scum trash pathetic worthless disgusting stupid dumb fool filth vermin",
    "abuse": "bastard bitch asshole fuck fucking shit crap whore slut",
    "german": "arschloch idioten dummkopf abschaum scheisse scheiße wichser",
    "french": "connard salope imbécile ordure merde enculé",
    "spanish": "imbécil idiota mierda puta cabrón basura",
}
#: Patterns of style, on a lower-case text with single spaces for punctuation.
PATTERNS = {
    "you_are": re.compile(r" you(?: are|r|re) (?:such )?(?:an? )?(?:idiot|moron|loser|clown|fool|stupid|pathetic|worthless|disgusting)"),
    "shut_up": re.compile(r" shut (?:the \w+ )?up "),
    "go_away": re.compile(r" (?:go to hell|drop dead|get lost|kill yourself) "),
    "hate": re.compile(r" (?:i|we) hate (?:you|them|those|these) "),
}
STYLE = ("shouting", "exclaiming", "starred", "calm")
DENSE = ("share_capitals", "share_marks", "log_hits", "log_voters")

_SPACED = bytes(c + 32 if 65 <= c <= 90 else c if c >= 0x80 or chr(c).isalnum() else 32 for c in range(256))


def _plain(text: str) -> str:
    """Lower case, with spaces for ASCII punctuation and at both ends."""
    return f" {text.lower().encode('utf-8', 'replace').translate(_SPACED).decode('utf-8', 'replace')} "


class Voters(NamedTuple):
    """Words fire where they stand whole, stems where a word begins with them; patterns and style follow."""

    words: tuple[str, ...]
    stems: tuple[str, ...]

    @property
    def names(self) -> list[str]:
        return [*self.words, *[f"{s}-" for s in self.stems], *PATTERNS, *STYLE]


def fixed_voters(stems: tuple[str, ...] = ()) -> Voters:
    words = dict.fromkeys(" ".join(LEXICON.values()).split())
    return Voters(tuple(w for w in words if not w.startswith(stems or ("\0",))), stems)


def _automaton(voters: Voters):
    import ahocorasick

    found = ahocorasick.Automaton()
    for place, word in enumerate(voters.words):
        found.add_word(f" {word} ", place)
    for place, stem in enumerate(voters.stems, len(voters.words)):
        found.add_word(f" {stem}", place)
    found.make_automaton()
    return found


def votes(docs: DataFrame, voters: Voters, keep: tuple[str, ...], text: str = "text") -> DataFrame:
    """(keep, text_key, fired: places of the voters that fire, in order, dense: features of style)."""
    rows = docs.select(
        *[F.col(f"`{c}`") for c in keep], text_digest(text).alias("text_key"), F.col(f"`{text}`").cast("string").alias("_votes_text"))
    n_words = len(voters.words) + len(voters.stems)

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        machine = _automaton(voters)
        fired, dense = [], []
        for chunk in chunks(batch.column(len(keep) + 1)):
            for low, high in zip(chunk.bounds[:-1].tolist(), chunk.bounds[1:].tolist(), strict=True):
                text = chunk.text(low, high)
                plain = _plain(text)
                hits = Counter(place for _, place in machine.iter(plain))
                own = sorted(hits)
                own += [n_words + i for i, pattern in enumerate(PATTERNS.values()) if pattern.search(plain)]
                raw = chunk.raw[low:high]
                capitals = int(((raw >= 65) & (raw <= 90)).sum())
                letters = max(1, int((((raw | 32) >= 97) & ((raw | 32) <= 122)).sum()))
                marks, stars = int((raw == 33).sum()), int((raw == 42).sum())
                style = (2 * capitals > letters, 50 * marks > len(raw), 100 * stars > len(raw) > 0, not own)
                own += [n_words + len(PATTERNS) + i for i, fires in enumerate(style) if fires]
                fired.append(own)
                dense.append([capitals / letters, min(1.0, marks / max(1, len(raw)) * 20), math.log1p(sum(hits.values())), math.log1p(len(hits))])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(fired, pa.list_(pa.int32())), pa.array(dense, pa.list_(pa.float64()))],
            [*keep, "text_key", "fired", "dense"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return arrow_rows(rows, work, ", ".join([*fields, "fired array<int>", "dense array<double>"]))


def labelled_sample(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE, text: str = "text") -> DataFrame:
    """(text, toxic): about ``sample`` of the labelled rows that may be learned from, by a hash of the id."""
    usable = labels.where(learnable("doc_id", FOLDS) & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    total = usable.count()
    if total > sample:
        usable = usable.where(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 20)) < int((1 << 20) * sample / total))
    return docs.select("doc_id", F.col(f"`{text}`").cast("string").alias("text")).join(usable, "doc_id").select("text", "toxic")


def mined_stems(sample: DataFrame, *, stems: int = STEMS) -> tuple[str, ...]:
    """Beginnings of words that mark toxic texts: in at least three and a 200th of them, and hardly in others."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = {w for w in _plain(text or "").split() if not w[0].isdigit()}
            counts[toxic].update({w[:n] for w in words for n in (4, 5, 6) if len(w) >= n})
        both = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_pydict({
            "stem": both, "toxic": [counts[1][s] for s in both], "other": [counts[0][s] for s in both]})

    totals = sample.agg(F.sum("toxic").alias("t"), F.count("*").alias("n")).first()
    if not totals["t"] or totals["t"] == totals["n"]:
        return ()
    toxic, other = totals["t"], totals["n"] - totals["t"]
    counted = arrow_rows(sample.select("text", F.col("toxic").cast("int").alias("toxic")), work, "stem string, toxic long, other long")
    lift = F.log((F.col("toxic") + 0.1) / (toxic + 1)) - F.log((F.col("other") + 0.1) / (other + 1))
    best = (
        counted.groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
        .where((F.col("toxic") >= max(3, toxic // 200)) & (F.col("toxic") >= 9 * F.col("other")))
        .withColumn("score", lift * F.sqrt("toxic"))
        .orderBy(F.desc("score"), "stem").limit(20 * stems).collect())  # a bounded list of the best
    chosen: list[str] = []
    for row in sorted(best, key=lambda r: (-round(r["score"], 6), len(r["stem"]), r["stem"])):
        if not any(row["stem"].startswith(c) or c.startswith(row["stem"]) for c in chosen):
            chosen.append(row["stem"])
        if len(chosen) == stems:
            break
    return tuple(chosen)


class LabelModel(NamedTuple):
    """The log odds of a text: bias plus the weights of the voters that fire."""

    bias: float
    weights: list[float]

    def log_odds(self, fired: str = "fired") -> Column:
        weights = F.array(*[F.lit(float(w)) for w in self.weights])
        return F.aggregate(fired, F.lit(float(self.bias)), lambda total, place: total + weights[place])


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def _model(on: np.ndarray, off: np.ndarray, share: float, redundancy: np.ndarray | float = 1.0) -> LabelModel:
    """Log odds of independent voters from their rates of firing; redundant voters share their weight."""
    return LabelModel(math.log(share / (1 - share)), (np.log(on / off) / redundancy).tolist())


def label_model(patterns: DataFrame, n_voters: int, share: float, on: np.ndarray, off: np.ndarray, *, rounds: int = ROUNDS) -> LabelModel:
    """Fit to the counted firing patterns (fired, n).

    ``on`` and ``off`` are the prior rates of firing on toxic and on other texts; the mean of
    them and of the rates found is taken, so that a group of voters that agrees with itself but
    not with the rest keeps its meaning. A round is one aggregation to a row per voter, under the model of the round before. Last come the
    correlations: of any two voters, how much more often than by chance they fire together
    given the label (a row per pair of voters that ever do), and the weights are divided by one
    plus the sum of a voter's positive correlations.
    """
    prior_on, prior_off = on.copy(), off.copy()
    model = _model(on, off, share)
    total = toxic = 0.0
    for _ in range(rounds):
        given = patterns.select("fired", "n", (F.col("n") * sigmoid(model.log_odds())).alias("t"))
        sums = given.agg(F.sum("n"), F.sum("t")).first()
        total, toxic = float(sums[0] or 0), float(sums[1] or 0)
        counts = np.zeros((2, n_voters))
        for row in given.select(F.explode("fired").alias("v"), "n", "t").groupBy("v").agg(F.sum("t").alias("t"), F.sum(F.col("n") - F.col("t")).alias("o")).collect():
            counts[:, row["v"]] = row["t"], row["o"]
        on = (counts[0] + toxic * prior_on) / max(1e-9, 2 * toxic)
        off = (counts[1] + (total - toxic) * prior_off) / max(1e-9, 2 * (total - toxic))
        on, off = np.clip(on, 1e-5, 1 - 1e-5), np.clip(off, 1e-5, 1 - 1e-5)
        model = _model(on, off, share)
    given = patterns.select("fired", "n", (F.col("n") * sigmoid(model.log_odds())).alias("t"))
    pairs = given.select(F.explode("fired").alias("v"), "fired", "n", "t").select("v", F.explode("fired").alias("w"), "n", "t").where("v < w")
    extra = np.zeros(n_voters)
    for row in pairs.groupBy("v", "w").agg(F.sum("t").alias("t"), F.sum(F.col("n") - F.col("t")).alias("o")).collect():
        v, w = row["v"], row["w"]
        strength = 0.0
        for both, a, b, size, part in ((row["t"], on[v], on[w], toxic, share), (row["o"], off[v], off[w], total - toxic, 1 - share)):
            if size > 0:
                strength += part * max(0.0, (both / size - a * b) / math.sqrt(a * (1 - a) * b * (1 - b)))
        extra[v] += min(1.0, strength)
        extra[w] += min(1.0, strength)
    return _model(on, off, share, 1 + extra)


def _priors(voters: Voters, learned: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Rates of firing on toxic and on other texts: assumed ones (words accurate, style less so), and the sample's."""
    n = len(voters.names)
    on, off = np.full(n, 0.1), np.full(n, 0.002)
    on[-len(STYLE):] = off[-len(STYLE):] = 0.05
    on[-1], off[-1] = 0.2, 0.95
    counts, sizes = np.zeros((2, n)), [0, 0]
    for row in learned.groupBy("toxic").count().collect():
        sizes[row["toxic"]] = row["count"]
    for row in learned.select("toxic", F.explode("fired").alias("v")).groupBy("toxic", "v").count().collect():
        counts[row["toxic"], row["v"]] = row["count"]
    return (counts[1] + PRIOR * on) / (sizes[1] + PRIOR), (counts[0] + PRIOR * off) / (sizes[0] + PRIOR)


class Scorer(NamedTuple):
    voters: Voters
    bias: float
    weights: list[float]
    dense: list[float]

    def score(self) -> Column:
        own = LabelModel(self.bias, self.weights).log_odds()
        for i, weight in enumerate(self.dense):
            own = own + F.col("dense")[i] * float(weight)
        return sigmoid(own)


def fit(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE, stems: int = STEMS, keep: tuple[str, ...] = (), text: str = "text") -> tuple[Scorer, DataFrame]:
    """(scorer, votes of all documents): mine stems, let all documents be voted on, fit both models."""
    learned = freeze(labelled_sample(docs, labels, sample=sample, text=text))
    voters = fixed_voters(mined_stems(learned, stems=stems))
    n = len(voters.names)
    voted = freeze(votes(docs, voters, keep, text))
    gold = learned.agg(F.sum("toxic").alias("t"), F.count("*").alias("n")).first()
    share = ((gold["t"] or 0) + 1) / ((gold["n"] or 0) + 10)
    patterns = freeze(voted.groupBy("fired").agg(F.count("*").alias("n")))
    voted_sample = freeze(votes(learned, voters, ("toxic",)))
    model = label_model(patterns, n, share, *_priors(voters, voted_sample))
    # Texts on which a word or pattern fires are few: they and the calm ones are sampled apart.
    calm = F.array_contains("fired", n - 1)
    texts = freeze(voted.groupBy("text_key").agg(F.first("fired").alias("fired"), F.first("dense").alias("dense"), F.count("*").alias("n")))
    sizes = {r["calm"]: r["count"] for r in texts.groupBy(calm.alias("calm")).count().collect()}
    part = F.lit(1.0)
    for kind, size in sizes.items():
        part = F.when(calm == F.lit(kind), min(1.0, sample / 2 / size)).otherwise(part)
    chosen = texts.where(F.pmod(F.xxhash64("text_key"), F.lit(1 << 20)) < part * (1 << 20)).withColumn("n", F.col("n") / part)
    rows = chosen.select(
        array_to_vector(F.concat(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.array_contains("fired", i).cast("double")), "dense")).alias("features"),
        sigmoid(model.log_odds()).alias("p"), "n")
    both = freeze(rows.select("features", F.explode(F.array(
        F.struct(F.lit(1.0).alias("label"), (F.col("p") * F.col("n")).alias("weight")),
        F.struct(F.lit(0.0).alias("label"), ((1 - F.col("p")) * F.col("n")).alias("weight")))).alias("_l")).select("features", "_l.*").where("weight > 0.001"))
    if both.select("label").distinct().count() < 2:
        return Scorer(voters, model.bias, model.weights, [0.0] * len(DENSE)), voted
    linear = LogisticRegression(weightCol="weight", regParam=1e-4, maxIter=60, standardization=False).fit(both)
    weights = linear.coefficients.toArray().tolist()
    return Scorer(voters, float(linear.intercept), weights[:n], weights[n:]), voted


def scored(docs: DataFrame, labels: DataFrame, *, keep: tuple[str, ...] = ("doc_id",), **options) -> DataFrame:
    """(keep, text_key, score) of every row."""
    scorer, voted = fit(docs, labels, keep=keep, **options)
    return voted.select(*[F.col(f"`{c}`") for c in keep], "text_key", scorer.score().alias("score"))


def without_toxic(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.5, text: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; all columns stay.

    A score is a function of the text alone, so it is found again in the pass that filters: texts
    are neither written nor shuffled.
    """
    with scratch(docs.sparkSession):
        scorer, _ = fit(docs, labels, text=text, **options)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text}`").alias("text"))
    return votes(rows, scorer.voters, ("row",)).where(scorer.score() < threshold).select("row.*")
