"""Benchmark decontamination by winnowing.

An item is cut into windows of ``span`` consecutive words (an item of fewer words is one
window). Of the hashes of all runs of k words, winnowing keeps the least in every sliding
window of w runs; texts that share w + k - 1 words share one of those fingerprints. With
w + k - 1 equal to a window's length, every occurrence of a window in a document has a
fingerprint in common with it, so the search loses nothing. Short windows are searched with
k and w for their own length.

The fingerprints of the benchmark go out in blocks of at most ``block`` windows, one pass over
the documents each, so what a task holds is bounded whatever the benchmark's size; one block
is the rule. A document's fingerprints are compared in the task that reads it. Around each
match the document's windows are extended in full, and joined with the item windows on their
exact words. Neither texts nor the fingerprints of documents are shuffled.

Null and empty texts have no words and no hits. Items without words have no windows. Equal
texts are searched once per row but counted once, under a digest of the text. An item id that
is null counts as no item, though its words are hits. Empty tables give no rows or no hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cooccur.llm.frames import arrow_rows, freeze, text_digest, without_texts
from cooccur.llm.text import ALNUM, Chunk, Words, chunks, grams_of, list_array, words_of

SPAN = 13
#: Most windows whose fingerprints are held at once.
BLOCK = 1 << 20


def runs_for(length: int) -> tuple[int, int]:
    """(k, w) of the search for windows of a length: k + w - 1 = length."""
    k = (length + 1) // 2
    return k, length - k + 1


def winnow(hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, fingerprints) of a text's words for windows of ``length`` words."""
    k, w = runs_for(length)
    grams = grams_of(hashes, k)
    if len(grams) < w:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if w == 1:
        return np.arange(len(grams)), grams
    low = grams
    kept = np.zeros(len(grams), bool)
    # The least of w runs by doubling: the minimum of two overlapping halves.
    size = 1
    while size * 2 <= w:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < w:
        low = np.minimum(low[: len(grams) - w + 1], low[w - size: len(grams) - size + 1])
    for shift in range(w):
        kept[shift: shift + len(low)] |= grams[shift: shift + len(low)] == low
    places = np.flatnonzero(kept)
    return places, grams[places]


def _joined(chunk: Chunk, words: Words, at: int, length: int) -> str:
    return " ".join(
        chunk.text(s, e) for s, e in zip(words.start[at: at + length].tolist(), words.end[at: at + length].tolist(), strict=True)
    ).translate(_LOWER)


_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def item_windows(items: DataFrame, span: int = SPAN, text: str = "text", item_id: str = "item_id") -> DataFrame:
    """(item_id, length, words): every window of every item."""
    rows = items.select(F.col(item_id).cast("string").alias("item_id"), F.col(text).cast("string").alias("text"))

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids = batch.column(0).to_pylist()
        for chunk in chunks(batch.column(1)):
            words = words_of(chunk, ALNUM, hashed=False)
            owner, lengths, texts = [], [], []
            for i in range(chunk.last - chunk.first):
                low, high = int(words.first[i]), int(words.first[i + 1])
                length = min(span, high - low)
                for at in range(low, high - length + 1) if length else ():
                    owner.append(ids[chunk.first + i])
                    lengths.append(length)
                    texts.append(_joined(chunk, words, at, length))
            yield pa.RecordBatch.from_arrays(
                [pa.array(owner, pa.string()), pa.array(lengths, pa.int32()), pa.array(texts, pa.string())],
                ["item_id", "length", "words"])

    return arrow_rows(rows, work, "item_id string, length int, words string")


def _prints_of(batch: pa.RecordBatch) -> np.ndarray:
    """The fingerprint of each window: a window has one, the least of its runs."""
    found = np.zeros(batch.num_rows, np.uint64)
    lengths = batch.column(0).to_numpy(zero_copy_only=False)
    for chunk in chunks(batch.column(1)):
        words = words_of(chunk, ALNUM)
        for i in range(chunk.last - chunk.first):
            low, high = words.first[i], words.first[i + 1]
            k, _ = runs_for(int(lengths[chunk.first + i]))
            found[chunk.first + i] = grams_of(words.hash[low:high], k).min()
    return found


def _blocks(windows: DataFrame, block: int) -> Iterator[dict[int, np.ndarray]]:
    """The fingerprints of the distinct windows by length, at most ``block`` windows at a time."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(_prints_of(batch).view(np.int64))], ["length", "fingerprint"])

    total = windows.count()
    parts = max(1, -(-total // block))
    prints = arrow_rows(windows.select("length", "words"), work, "length int, fingerprint long").distinct()
    if parts > 1:
        # By a hash, a block's size varies little around its mean; twice the parts keep it below the bound.
        prints = freeze(prints.withColumn("_block", F.pmod(F.hash("fingerprint"), F.lit(2 * parts))))
    for part in range(2 * parts if parts > 1 else 1):
        own = prints.where(F.col("_block") == part) if parts > 1 else prints
        rows = own.select("length", "fingerprint").toPandas()
        yield {
            int(length): np.sort(group.to_numpy(np.int64).view(np.uint64))
            for length, group in rows.groupby("length")["fingerprint"]
        }


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values


def _searched(docs: DataFrame, prints: dict[int, np.ndarray], key: Column, text: str) -> DataFrame:
    """Per document: key, number of words, and the windows around matching fingerprints (place, length, words)."""
    shared = docs.sparkSession.sparkContext.broadcast(prints)
    names = docs.columns
    rows = docs.select(*[F.col(f"`{c}`") for c in names if c != text], key.alias("_key"), F.col(f"`{text}`").alias("_text"))
    window = pa.struct([("place", pa.int32()), ("length", pa.int32()), ("words", pa.string())])
    kept = rows.columns[:-1]

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        for chunk in chunks(batch.column(len(kept))):
            words = words_of(chunk, ALNUM)
            sizes, found = [], []
            for i in range(chunk.last - chunk.first):
                low, high = int(words.first[i]), int(words.first[i + 1])
                before = len(found)
                for length, ordered in wanted.items():
                    places, hashes = winnow(words.hash[low:high], length)
                    hit = places[_among(hashes, ordered)] if len(places) else places
                    if not len(hit):
                        continue
                    _, w = runs_for(length)
                    around = np.unique((hit[:, None] - np.arange(w)).ravel())
                    for at in around[(around >= 0) & (around <= high - low - length)].tolist():
                        found.append((at, length, _joined(chunk, words, low + at, length)))
                sizes.append(len(found) - before)
            columns = [batch.column(c).slice(chunk.first, chunk.last - chunk.first) for c in range(len(kept))]
            flat = pa.array([{"place": a, "length": b, "words": c} for a, b, c in found], window)
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(np.diff(words.first)), list_array(flat, sizes)], [*kept, "_n_words", "_windows"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return arrow_rows(rows, work, ", ".join([*fields, "_n_words long", "_windows array<struct<place: int, length: int, words: string>>"]))


def contamination(
    docs: DataFrame, items: DataFrame, *, span: int = SPAN, block: int = BLOCK,
    keep: tuple[str, ...] = ("doc_id",), text: str = "text", item_text: str = "text", item_id: str = "item_id",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, hits, items hit).

    documents: the columns ``keep``, ``text_key`` (a digest of the text), ``n_words``;
    hits: (text_key, n_hit) for texts with hits; items: (text_key, item_id), distinct.
    """
    windows = freeze(item_windows(items, span, item_text, item_id))
    distinct = freeze(windows.select("length", "words").distinct())
    narrow = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`"))
    searched: DataFrame | None = None
    near = []
    for prints in _blocks(distinct, block):
        found = freeze(_searched(narrow, prints, text_digest(text), text))
        searched = searched or found
        near.append(found.where(F.size("_windows") > 0).select("_key", F.explode("_windows").alias("_w")).select("_key", "_w.*"))
    candidates = near[0]
    for more in near[1:]:
        candidates = candidates.unionByName(more)
    hits = freeze(candidates.distinct().join(distinct, ["length", "words"], "left_semi"))
    # Words inside any hit: each hit adds the words from where the hits before it end.
    last_end = "max(place + length) over (partition by _key order by place, length rows between unbounded preceding and 1 preceding)"
    covered = hits.selectExpr("_key", "place", "length", f"{last_end} as _till").groupBy(F.col("_key").alias("text_key")).agg(
        F.sum(F.greatest(F.lit(0), F.expr("place + length - greatest(place, coalesce(_till, 0))"))).cast("long").alias("n_hit"))
    owners = windows.where("item_id is not null").distinct()
    items_hit = hits.select("_key", "length", "words").distinct().join(owners, ["length", "words"]).select(
        F.col("_key").alias("text_key"), "item_id").distinct()
    documents = searched.select(*[F.col(f"`{c}`") for c in keep], F.col("_key").alias("text_key"), F.col("_n_words").alias("n_words"))
    return documents, covered, items_hit


def contaminated(n_hit: Column, n_words: Column) -> Column:
    """A twentieth of a document's words, and at least one, are inside item windows."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def decontaminate(docs: DataFrame, items: DataFrame, *, text: str = "text", **options) -> DataFrame:
    """``docs`` without the contaminated documents; all columns stay."""
    found, hits, _ = contamination(docs, items, keep=(), text=text, **options)
    bad = found.distinct().join(hits, "text_key").where(contaminated(F.col("n_hit"), F.col("n_words"))).select("text_key")
    return without_texts(docs, bad, text)
