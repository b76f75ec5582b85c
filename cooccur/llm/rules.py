"""Quality rules as a short-circuit cascade.

On a sample of the documents every rule is timed and its rejections are counted; the rules then
run in the order of rejections per second, and a document leaves at the first rule that rejects
it, so most bad documents never reach the dear rules. The verdict is that no rule rejects, which
no order changes; the order only changes the cost, and which rule is named.

Null and empty texts have no words and are rejected as too short. Repeated rows get equal
verdicts. An empty table gives an empty result and keeps the rules in their given order.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from functools import cached_property
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cooccur.llm.frames import arrow_rows
from cooccur.llm.text import Chunk, Words, alphabet, chunks, grams_of, spans_hash, words_of
from cooccur.llm.text import SPACED as FOLDED

#: Rows on which costs and rejections are estimated, about.
SAMPLE = 2000

CASED = alphabet(FOLDED.member, fold=False)
_LINES = alphabet(np.ones(256, bool), fold=False, seed=2)
#: Characters that count as symbols.
SYMBOL = np.zeros(256, bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_UPPER, _LETTER = np.zeros(256, bool), np.zeros(256, bool)
_UPPER[ord("A"): ord("Z") + 1] = True
_LETTER[ord("A"): ord("Z") + 1] = _LETTER[ord("a"): ord("z") + 1] = _LETTER[0x80:] = True
_FIRST_BYTE = np.ones(256, bool)
_FIRST_BYTE[0x80: 0xC0] = False


def line_spans(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    breaks = np.flatnonzero(raw == 0x0A)
    return np.concatenate([[0], breaks + 1]), np.concatenate([breaks, [len(raw)]])


def duplicate_lines(raw: np.ndarray) -> tuple[int, int]:
    """(lines with a word, those of them that equal an earlier line)."""
    start, end = line_spans(raw)
    dark = np.concatenate([[0], np.cumsum(CASED.member[raw])])
    full = dark[end] > dark[start]
    start, end = start[full], end[full]
    if len(start) < 2:
        return len(start), 0
    return len(start), len(start) - len(np.unique(spans_hash(raw, start, end, _LINES.value) + (end - start).astype(np.uint64)))


def repeated_words(hashes: np.ndarray, size: int = 3) -> int:
    """Words inside runs of ``size`` words that the text has at least twice."""
    grams = grams_of(hashes, size)
    if len(grams) < 2:
        return 0
    _, inverse, counts = np.unique(grams, return_inverse=True, return_counts=True)
    again = counts[inverse] > 1
    inside = np.zeros(len(hashes), bool)
    for shift in range(size):
        inside[shift: shift + len(again)] |= again
    return int(inside.sum())


class Document:
    """A text's features, each computed when a rule first asks for it."""

    def __init__(self, raw: np.ndarray) -> None:
        self.raw = raw

    @cached_property
    def words(self) -> Words:
        return words_of(Chunk(0, 1, self.raw, np.array([0, len(self.raw)])), CASED, hashed=False)

    @cached_property
    def n_words(self) -> int:
        return len(self.words.start)

    @cached_property
    def hashes(self) -> np.ndarray:
        return spans_hash(self.raw, self.words.start, self.words.end, CASED.value)

    @cached_property
    def word_chars(self) -> int:
        return int((CASED.member & _FIRST_BYTE)[self.raw].sum())

    @cached_property
    def n_symbols(self) -> int:
        return int(SYMBOL[self.raw].sum())

    @cached_property
    def lines(self) -> tuple[int, int]:
        return duplicate_lines(self.raw)

    @cached_property
    def n_repeat_words(self) -> int:
        return repeated_words(self.hashes)

    @cached_property
    def letters(self) -> tuple[int, int]:
        """(ASCII capitals, letters)"""
        return int(_UPPER[self.raw].sum()), int((_LETTER & _FIRST_BYTE)[self.raw].sum())

    @cached_property
    def worded(self) -> int:
        """Words that hold a letter."""
        so_far = np.concatenate([[0], np.cumsum(_LETTER[self.raw])])
        return int((so_far[self.words.end] > so_far[self.words.start]).sum())

    @cached_property
    def commonest(self) -> int:
        return int(np.unique(self.hashes, return_counts=True)[1].max(initial=0))


class Rule(NamedTuple):
    name: str
    rejects: Callable[[Document], bool]


#: Every share is compared without division, so empty texts need no case of their own.
RULES: tuple[Rule, ...] = (
    Rule("few_words", lambda d: d.n_words < 50),
    Rule("repeated_words", lambda d: 100 * d.n_repeat_words > 50 * d.n_words),
    Rule("symbols", lambda d: d.n_symbols > d.n_words),
    Rule("capitals", lambda d: 2 * d.letters[0] > d.letters[1]),
    Rule("duplicate_lines", lambda d: 2 * d.lines[1] > d.lines[0]),
    Rule("word_length", lambda d: not 2 * d.n_words <= d.word_chars <= 40 * d.n_words),
    Rule("words_without_letters", lambda d: 2 * d.worded < d.n_words),
    Rule("commonest_word", lambda d: 3 * d.commonest > d.n_words),
)


def _texts(batch_column: pa.Array) -> Iterator[Document]:
    for chunk in chunks(batch_column):
        for low, high in zip(chunk.bounds[:-1].tolist(), chunk.bounds[1:].tolist(), strict=True):
            yield Document(chunk.raw[low:high])


def estimates(docs: DataFrame, rules: Sequence[Rule] = RULES, *, sample: int = SAMPLE, seed: int = 3, text: str = "text") -> DataFrame:
    """(rule, texts, rejected, seconds) over a sample: each rule starts from the bare text."""
    rules = tuple(rules)
    rows = docs.select(F.col(f"`{text}`").cast("string").alias("text"))
    total = rows.count()
    if total > sample:
        rows = rows.sample(sample / total, seed)

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rejected, seconds, n = [0] * len(rules), [0.0] * len(rules), 0
        for document in _texts(batch.column(0)):
            n += 1
            for i, rule in enumerate(rules):
                fresh, began = Document(document.raw), time.thread_time()
                rejected[i] += rule.rejects(fresh)
                seconds[i] += time.thread_time() - began
        yield pa.RecordBatch.from_pydict({"place": list(range(len(rules))), "n": [n] * len(rules), "r": rejected, "s": seconds})

    found = arrow_rows(rows, work, "place long, n long, r long, s double")
    names = F.array(*[F.lit(r.name) for r in rules])
    return found.groupBy("place").agg(F.sum("n").alias("texts"), F.sum("r").alias("rejected"), F.sum("s").alias("seconds")).select(
        names[F.col("place")].alias("rule"), "texts", "rejected", "seconds")


def ordered(docs: DataFrame, rules: Sequence[Rule] = RULES, **options) -> list[Rule]:
    """The rules by rejections per second, as estimated on a sample."""
    gain = {r["rule"]: r["rejected"] / max(r["seconds"], 1e-9) for r in estimates(docs, rules, **options).collect()}
    return sorted(rules, key=lambda rule: -gain.get(rule.name, 0.0))


def cascade(
    docs: DataFrame, rules: Sequence[Rule] | None = None, *, text: str = "text", keep: tuple[str, ...] | None = None,
    statistics: bool = False,
) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``rejected_by``, the first rule that rejects, null if none.

    Without rules, the standard ones are put in order on a sample. With ``statistics``, the columns
    n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words follow, for rejected texts too.
    """
    rules = tuple(rules if rules is not None else ordered(docs, text=text))
    names = list(docs.columns if keep is None else keep)
    rows = docs.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{text}`").cast("string").alias("_rules_text"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"] if statistics else []

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        verdicts, numbers = [], []
        for document in _texts(batch.column(len(names))):
            verdicts.append(next((rule.name for rule in rules if rule.rejects(document)), None))
            if counts:
                numbers.append((document.n_words, document.word_chars, document.n_symbols, document.lines[1], document.n_repeat_words))
        columns = [pa.array(c, pa.int64()) for c in (zip(*numbers, strict=True) if numbers else ())]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(verdicts, pa.string()), *columns], [*names, "rejected_by", *counts])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return arrow_rows(rows, work, ", ".join([*fields, "rejected_by string", *[f"{c} long" for c in counts]]))


def base_failed() -> Column:
    """Too few words, or more than half of them in repeated runs."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
