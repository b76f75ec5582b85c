"""Frequent phrases and their collocation scores by set-oriented mining (SETM).

An occurrence relation holds (piece, position, phrase) in the order of piece and position. From
level to level

1. the relation is merge-joined with itself by piece and adjacent position, which gives the
   occurrences of phrases one word longer as pairs (head, tail) of frequent shorter phrases;
2. the occurrences are counted by phrase, first in every block of the relation, then by Spark;
3. phrases below the minimum count go, and a semi-join takes their occurrences out of the
   relation before it is extended again.

Every level's relation is a table in the shared folder, a row for a block: the positions and
phrases of about ``BLOCK_WORDS`` words of whole texts, in order. Positions skip one number where
a piece ends, so adjacent positions are of one piece and the merge join is a comparison of
neighbours. A block numbers its phrases on its own; what is counted are (block, phrase) rows, of which
there is one per block however often the phrase occurs, and only the frequent ones come back to
their blocks. So no task holds more than a block and its own phrases, nothing goes through the
driver, and no phrase's occurrences meet in one task. Phrases are equal if their words are, without
hashing, but for words inside one block, which are told apart by 64 bits.

Most pairs of frequent words are rare, so there are far more (block, pair) rows than frequent ones.
They are dealt to buckets by their pair, and a block's rows of one bucket are written and shuffled as one
compressed column-wise value. There are as many buckets as blocks (``BUCKETS`` at least), so a
bucket holds about as many pairs as a block.

Words are split by spaces and tabs inside pieces, pieces by sentence marks and line ends; A-Z
are lower-cased. Null and empty texts have no words; a null language is ``und``. Very long texts
are a block of their own. Repeated rows count as often as they are there. Ties in rank go to the
greater count, then to the phrase in byte order, and no two phrases of a language are equal. An
empty table gives no rows. Columns other than text and language are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cooccur.llm.frames import freeze
from cooccur.llm.packing import packed, unpacked
from cooccur.llm.text import FOLDED, U64, alphabet, chunks, joined, mixed, words_of
from cooccur.session import discard, group_limit, scratch

UNKNOWN = "und"
#: What ends a piece, and what parts words inside a piece.
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
GAPS = b" \t"
SCALE = 2_000_000
#: A block ends with the text that brings it to so many words.
BLOCK_WORDS = 1 << 20
#: Fewest buckets that the pairs of the blocks are dealt to.
BUCKETS = 64
#: Rows of frequent words that a task holds before it puts them into values.
PLACES = 1 << 20

_BREAK = np.isin(np.arange(256), list(BREAKS))
WORDS = alphabet(~_BREAK & ~np.isin(np.arange(256), list(GAPS)))


def _payload(positions: np.ndarray, codes: np.ndarray) -> tuple[bytes, bytes]:
    """Steps between positions, and phrases, as compressed numbers."""
    gaps = np.diff(positions, prepend=-1).astype("<i4").tobytes()
    return zstandard.compress(gaps, 1), zstandard.compress(codes.astype("<i4").tobytes(), 1)


def _numbers(value: pa.Scalar) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(value.as_buffer()), "<i4")


def _block(number: int, parts: list[tuple], langs: pa.Array) -> pa.RecordBatch:
    """A block's relation in the first row, then a row for each of its words with the block's number and count of it."""
    starts = np.cumsum([0, *(p[0][-1] + 2 for p in parts)])
    positions = np.concatenate([p[0] + s for p, s in zip(parts, starts)])
    keys, first, code = np.unique(np.concatenate([p[1] for p in parts]), return_index=True, return_inverse=True)
    local = np.cumsum([0, *(len(p[1]) for p in parts)])
    codes = np.concatenate([code[p[2] + s] for p, s in zip(parts, local)])
    own = np.concatenate([p[3] for p in parts])[first]
    words = pa.chunked_array([p[4] for p in parts]).combine_chunks().take(pa.array(first))
    gaps, phrases = _payload(positions, codes)
    n = len(keys)
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(n + 1, number)), pa.array([None, *range(n)], pa.int32()),
        pa.concat_arrays([pa.nulls(1, pa.string()), langs.take(pa.array(own))]), pa.concat_arrays([pa.nulls(1, pa.string()), words]),
        pa.concat_arrays([pa.nulls(1, pa.int64()), pa.array(np.bincount(codes, minlength=n).astype(np.int64))]),
        pa.concat_arrays([pa.array([gaps], pa.binary()), pa.nulls(n, pa.binary())]),
        pa.concat_arrays([pa.array([phrases], pa.binary()), pa.nulls(n, pa.binary())]),
    ], ["block", "code", "lang", "word", "n", "gaps", "codes"])


def occurrences(docs: DataFrame, *, text: str = "text", lang: str = "lang") -> DataFrame:
    """The relation of single words: (block, gaps, codes) rows and, with a ``code``, (block, code, lang, word, n) rows."""
    rows = docs.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(f"`{text}`").cast("string").alias("text"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            if not batch.num_rows:
                continue
            named = batch.column(0).dictionary_encode()
            lang_of = named.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            parts, held = [], 0
            for chunk in chunks(batch.column(1)):
                words = words_of(chunk, WORDS)
                if not len(words.hash):
                    continue
                doc = np.repeat(np.arange(chunk.last - chunk.first), np.diff(words.first))
                own = lang_of[chunk.first: chunk.last][doc]
                piece = np.cumsum(_BREAK[chunk.raw])[words.start]
                apart = np.append(False, (piece[1:] != piece[:-1]) | (doc[1:] != doc[:-1]))
                keys, first, code = np.unique(
                    mixed(words.hash + mixed(own.astype(np.uint64) + U64(1))), return_index=True, return_inverse=True)
                spelled = joined(FOLDED[chunk.raw], words.start[first], words.end[first], np.ones(len(first), np.int64))
                parts.append((np.arange(len(doc)) + np.cumsum(apart), keys, code, own[first], spelled))
                held += len(doc)
                if held >= BLOCK_WORDS:
                    yield _block(number, parts, named.dictionary)
                    number, parts, held = number + 1, [], 0
            if parts:
                yield _block(number, parts, named.dictionary)
                number += 1

    return rows.mapInArrow(task, "block long, code int, lang string, word string, n long, gaps binary, codes binary")


def frequent(counted: DataFrame, least: int) -> DataFrame:
    """The words with at least ``least`` occurrences: (lang, word, f, id) rows, and (block, places) rows.

    Each block has one row for a word, so the rows of a word are at most as many as there are
    blocks. A word's id is the least number of its rows, given to them after they met; the result
    is written once, so ids stay what they are. ``places`` holds (code, id) of some of a block's words, codes
    by their steps: those among ``PLACES`` rows of a task.
    """
    of = W.partitionBy("lang", "word")
    kept = counted.withColumn("f", F.sum("n").over(of)).where(F.col("f") >= least).withColumn("row", F.monotonically_increasing_id() + 1)
    rows = kept.withColumn("id", F.min("row").over(of)).select("lang", "word", "f", "id", "row", "block", "code")
    names = ["lang", "word", "f", "id", "block", "places"]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def placed(held: list[tuple]) -> pa.RecordBatch:
        block, code, of = (np.concatenate(c) for c in zip(*held))
        order = np.lexsort([code, block])
        block, code, of = block[order], code[order], of[order]
        starts = np.flatnonzero(np.diff(block, prepend=-1))
        values = [packed(np.diff(code[at], prepend=0), of[at]) for at in np.split(np.arange(len(block)), starts[1:])]
        return pa.RecordBatch.from_arrays(
            [pa.nulls(len(values), k) for k in kinds[:4]] + [pa.array(block[starts]), pa.array(values, pa.binary())], names)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            of, row, block, code = (batch.column(c).to_numpy() for c in range(3, 7))
            first = batch.filter(pa.array(of == row))
            yield pa.RecordBatch.from_arrays([*first.columns[:4], *(pa.nulls(first.num_rows, k) for k in kinds[4:])], names)
            held.append((block, code.astype(np.int64), of))
            n += len(of)
            if n >= PLACES:
                yield placed(held)
                held, n = [], 0
        if held:
            yield placed(held)

    return freeze(rows.mapInArrow(task, "lang string, word string, f long, id long, block long, places binary"))


def extended(relation: DataFrame, places: DataFrame, buckets: int, last: bool) -> DataFrame:
    """The relation of phrases one word longer: (block, gaps, codes) rows, and (block, bucket, counts) rows.

    ``places`` has the frequent phrases of the blocks; the others leave the relation here. ``counts`` holds (code, head, tail, n) of the block's phrases of a bucket, codes
    by their steps. The ``last`` relation is not extended again and its occurrences are not kept.
    """
    schema = "block long, bucket int, gaps binary, codes binary, counts binary"
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    names = ["block", "bucket", "gaps", "codes", "counts"]
    empty = pa.table([pa.nulls(0, k) for k in kinds], names=names)

    def work(blocks: pa.Table, found: pa.Table) -> pa.Table:
        if not blocks.num_rows or not found.num_rows:
            return empty
        number = blocks["block"][0].as_py()
        codes = _numbers(blocks["codes"][0])
        positions = np.cumsum(_numbers(blocks["gaps"][0]).astype(np.int64))
        ids = np.zeros(int(codes.max()) + 1, np.int64)
        for value in found["places"]:
            steps, of = unpacked(value, 2)
            ids[np.cumsum(steps)] = of
        kept = np.flatnonzero(ids[codes] > 0)
        positions, codes = positions[kept], codes[kept].astype(np.int64)
        pairs = np.flatnonzero(positions[1:] == positions[:-1] + 1)
        if not len(pairs):
            return empty
        longer, code, n = np.unique(codes[pairs] * len(ids) + codes[pairs + 1], return_inverse=True, return_counts=True)
        head, tail = ids[longer // len(ids)], ids[longer % len(ids)]
        bucket = (mixed(mixed(head.astype(np.uint64)) + tail.astype(np.uint64)) % U64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        starts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        counts = [packed(np.diff(at, prepend=0), head[at], tail[at], n[at]) for at in np.split(order, starts[1:])]
        rows = pa.table([
            pa.array(np.full(len(counts), number)), pa.array(bucket[order][starts]), pa.nulls(len(counts), pa.binary()),
            pa.nulls(len(counts), pa.binary()), pa.array(counts, pa.binary())], names=names)
        if last:
            return rows
        whole = [number, None, *_payload(positions[pairs], code), None]
        return pa.concat_tables([rows, pa.table([pa.array([x], k) for x, k in zip(whole, kinds)], names=names)])

    blocks = relation.where("gaps is not null").select("block", "gaps", "codes")
    return blocks.groupBy("block").cogroup(places.groupBy("block")).applyInArrow(work, schema)


def frequent_pairs(counted: DataFrame, least: int) -> DataFrame:
    """The phrases of :func:`extended` with at least ``least`` occurrences: (head, tail, f, id) rows, and (block, places) rows.

    ``places`` holds (code, id) of a block's frequent phrases of a bucket, codes by their steps. All rows of
    a phrase are in its bucket, which numbers its phrases.
    """
    names = ["head", "tail", "f", "id", "block", "places"]
    kinds = [pa.int64()] * 5 + [pa.binary()]

    def work(rows: pa.Table) -> pa.Table:
        parts = [unpacked(value, 4) for value in rows["counts"]]
        head, tail, n = (np.concatenate([p[i] for p in parts]) for i in (1, 2, 3))
        _, left = np.unique(head, return_inverse=True)
        tails, right = np.unique(tail, return_inverse=True)
        _, first, phrase = np.unique(left * len(tails) + right, return_index=True, return_inverse=True)
        f = np.zeros(len(first), np.int64)
        np.add.at(f, phrase, n)
        often = f >= least
        ids = np.where(often, np.cumsum(often) + (rows["bucket"][0].as_py() << 32), 0)
        found, of = first[often], np.split(ids[phrase], np.cumsum([p.shape[1] for p in parts])[:-1])
        blocks, places = [], []
        for block, part, own in zip(rows["block"].to_pylist(), parts, of):
            at = np.flatnonzero(own)
            if len(at):
                blocks.append(block)
                places.append(packed(np.diff(np.cumsum(part[0])[at], prepend=0), own[at]))
        return pa.concat_tables([
            pa.table([pa.array(x) for x in (head[found], tail[found], f[often], ids[often])]
                     + [pa.nulls(len(found), k) for k in kinds[4:]], names=names),
            pa.table([pa.nulls(len(blocks), k) for k in kinds[:4]] + [pa.array(blocks, pa.int64()), pa.array(places, pa.binary())], names=names)])

    schema = "head long, tail long, f long, id long, block long, places binary"
    return freeze(counted.groupBy("bucket").applyInArrow(work, schema))


def mine(
    docs: DataFrame, *, longest: int = 4, least: int = 30, text: str = "text", lang: str = "lang",
) -> tuple[DataFrame, DataFrame]:
    """The frequent phrases of 1 to ``longest`` words of each language, and the words of each language.

    Phrases: (size, id, lang, words, f, begins, ends, head, tail); ``begins`` and ``ends`` have the
    counts of the phrase's first and last 1, 2, ... words, ``head`` and ``tail`` the ids of the
    phrase without its last and first word. Words: (lang, n).
    """
    spark = docs.sparkSession
    own = F.array("f")
    none = F.lit(None).cast("long")
    levels: list[DataFrame] = []
    with scratch(spark):
        relation = freeze(occurrences(docs, text=text, lang=lang))
        counted = relation.where("code is not null")
        totals = freeze(counted.groupBy("lang").agg(F.sum("n").alias("n")), keep=True)
        found = frequent(counted, least)
        words, relation = relation, freeze(relation.where("gaps is not null").select("block", "gaps", "codes"))
        discard(words)
        buckets = max(BUCKETS, relation.count())
        levels.append(freeze(found.where("id is not null").select(
            F.lit(1).alias("size"), "id", "lang", F.array("word").alias("words"), "f", own.alias("begins"), own.alias("ends"),
            none.alias("head"), none.alias("tail")), keep=True))
        for size in range(2, longest + 1):
            places = found.where("places is not null").select("block", "places")
            longer = freeze(extended(relation, places, buckets, size == longest))
            discard(relation, found)
            relation, found = longer, frequent_pairs(longer.where("bucket is not null").select("block", "bucket", "counts"), least)
            heads = levels[-1].select(F.col("id").alias("head"), "lang", "words", "begins")
            tails = levels[-1].select(F.col("id").alias("tail"), F.element_at("words", -1).alias("word"), "ends")
            levels.append(freeze(found.where("id is not null").join(heads, "head").join(tails, "tail").select(
                F.lit(size).alias("size"), "id", "lang", F.array_append("words", F.col("word")).alias("words"), "f",
                F.array_append("begins", F.col("f")).alias("begins"), F.array_append("ends", F.col("f")).alias("ends"), "head", "tail"),
                keep=True))
    phrases = levels[0]
    for level in levels[1:]:
        phrases = phrases.unionByName(level)
    return phrases, totals


def _exact(count: str | Column) -> Column:
    return (F.col(count) if isinstance(count, str) else count).cast("decimal(20,0)")


def scored(phrases: DataFrame) -> DataFrame:
    """(size, id, lang, phrase, a, l, r, score) of the phrases of two words or more, by the cut that scores least.

    A cut scores floor(2,000,000 a / (l + r)); ties go to the shorter first part. The product is a
    decimal, which holds it whole.
    """
    cuts = F.transform(F.sequence(F.lit(1), F.col("size") - 1), lambda k: F.struct(
        k.alias("k"), F.get("begins", k - 1).alias("l"), F.get("ends", F.col("size") - k - 1).alias("r")))
    priced = F.transform(cuts, lambda c: F.struct(
        F.call_function("div", _exact("f") * SCALE, _exact(c["l"] + c["r"])).alias("score"), c["k"].alias("k"), c["l"].alias("l"), c["r"].alias("r")))
    best = phrases.where("size > 1").withColumn("cut", F.array_min(priced))
    return best.select(
        "size", "id", "lang", F.array_join("words", " ").alias("phrase"), F.col("f").alias("a"), "cut.l", "cut.r", "cut.score")


def not_absorbed(candidates: DataFrame, phrases: DataFrame, percent: int) -> DataFrame:
    """Candidates but those that occur within a longer phrase in at least ``percent`` of their occurrences.

    One more word is enough to look at: a phrase of two more words lies around one of one more
    that is at least as frequent.
    """
    within = phrases.where("size > 2").select((F.col("size") - 1).alias("size"), F.explode(F.array("head", "tail")).alias("id"), "f")
    most = within.groupBy("size", "id").agg(F.max("f").alias("_most"))
    return candidates.join(most, ["size", "id"], "left").where(
        F.col("_most").isNull() | (_exact("_most") * 100 < _exact("a") * percent)).drop("_most")


def collocations(
    docs: DataFrame, *, top: int = 2000, longest: int = 4, least: int = 30, percent: int = 80,
    text: str = "text", lang: str = "lang",
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases by score, count and phrase."""
    phrases, totals = mine(docs, longest=longest, least=least, text=text, lang=lang)
    candidates = not_absorbed(scored(phrases), phrases, percent)
    place = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = candidates.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top)
    with group_limit(docs.sparkSession, top):
        best = freeze(ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "score"))
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
