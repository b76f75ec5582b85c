"""Near-duplicate documents by b-bit MinHash.

1. Every text becomes the set of hashes of its word runs (shingles), ``BANDS * ROWS`` minima of
   that set, ``BANDS`` keys of ``ROWS`` minima each, and a signature that packs the low
   ``BITS`` bits of every minimum. Texts with equal sets are one class from here on.
2. Classes that share a band's key are candidates. In each such bucket the class that comes
   first in a seeded order is the pivot; every other class is paired with the pivot only. The
   same pair from several bands counts once.
3. A pair's similarity is estimated from the bits that agree, corrected for those that agree
   by chance. Pairs far below the threshold are dropped, the rest is confirmed on full sets.
   The links make components.
4. The group of a pivot is the classes paired with it, which contain all other pairs of its
   buckets. If a group still has several components, its classes outside the largest one are
   compared with each other and with the rest: in tiles of a bounded number of classes, each
   pair of tiles a task that estimates all its pairs by bit counts, confirms what is left on
   full sets, and returns no more links than it takes to connect them. So no pair of different
   texts goes unexamined, and no table holds the pairs of a group.

A pair with a similarity of 0.8 escapes all bands with a probability of 3e-6 (0.85: 2e-8), and
the estimate drops a pair at the threshold with about 1e-6.

Null and empty texts, and texts without words, have empty sets and are linked with nothing.
Repeated rows are equal sets. A null id is never the least of a component unless all are null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cooccur.llm.components import components
from cooccur.llm.frames import arrow_rows, freeze, unused
from cooccur.llm.text import SPACED, U64, chunks, grams_of, list_array, mixed, words_of
from cooccur.session import scratch

BANDS = 24
ROWS = 4
BITS = 4
#: How far below the threshold an estimate may be; five and a half standard errors at 0.85.
SLACK = 0.25
#: Numbers of a tile's sets, and classes of a tile, at most (a longer set is a tile of its own).
TILE_CLASSES = 512
TILE_NUMBERS = 1 << 18
#: Hashes that are turned into minima at a time.
PART = 4096

_SEEDS = np.random.default_rng(5).integers(1, 1 << 63, (2, BANDS * ROWS), dtype=np.uint64) | U64(1)


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """The set of a text's word runs, in order; fewer words are one run; no words are none."""
    if not len(hashes):
        return hashes
    return np.unique(grams_of(hashes, min(size, len(hashes))) + U64(min(size, len(hashes))))


def minima(ordered: np.ndarray) -> np.ndarray:
    """The least value of each hash function over a set."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(ordered), PART):
        part = ordered[at: at + PART, None]
        least = np.minimum(least, (((part ^ _SEEDS[0]) * _SEEDS[1]) >> U64(32)).astype(np.uint32).min(axis=0))
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for row in least.reshape(BANDS, ROWS).astype(np.uint64).T:
        keys = mixed(keys * U64(0x9E3779B97F4A7C15) + row)
    return keys


def packed(least: np.ndarray) -> bytes:
    """The low ``BITS`` = 4 bits of every minimum, two in a byte."""
    low = (least & 15).astype(np.uint8)
    return (low[::2] | (low[1::2] << 4)).tobytes()


def estimated(matches: np.ndarray | Column) -> np.ndarray | Column:
    """Similarity from the number of equal minima, corrected for chance agreement of ``BITS`` bits."""
    chance = 1 / (1 << BITS)
    return (matches / (BANDS * ROWS) - chance) / (1 - chance)


def _equal_nibbles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal 4-bit fields of packed signatures, for every row of a with every row of b."""
    different = a[:, None, :] ^ b[None, :, :]
    return ((different & 0x0F) == 0).sum(2, dtype=np.int16) + ((different & 0xF0) == 0).sum(2, dtype=np.int16)


def signatures(docs: DataFrame, size: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, text_key, n_shingles, class, bands, bits) of every row; class is a digest of the set, null if it is empty."""
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.md5(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")).alias("text_key"),
        F.col(f"`{text}`").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batch.column(2)):
            words = words_of(chunk, SPACED)
            n, digests, keys, bits = [], [], [], []
            for i in range(chunk.last - chunk.first):
                own = shingles(words.hash[words.first[i]: words.first[i + 1]], size)
                n.append(len(own))
                if not len(own):
                    digests.append(None)
                    bits.append(None)
                    continue
                least = minima(own)
                digests.append(_digest(own))
                keys.append(band_keys(least))
                bits.append(packed(least))
            flat = np.concatenate(keys).view(np.int64) if keys else np.zeros(0, np.int64)
            part = slice(chunk.first, chunk.last)
            yield pa.RecordBatch.from_arrays([
                batch.column(0)[part], batch.column(1)[part], pa.array(n, pa.int64()), pa.array(digests, pa.binary()),
                list_array(pa.array(flat), [BANDS * (d is not None) for d in digests]), pa.array(bits, pa.binary()),
            ], ["doc_id", "text_key", "n_shingles", "class", "bands", "bits"])

    return arrow_rows(
        rows, work, f"doc_id {kind}, text_key string, n_shingles long, class binary, bands array<long>, bits binary")


def _digest(ordered: np.ndarray) -> bytes:
    """128 bits for a set: its size, and two sums of differently mixed members."""
    a = int(mixed(ordered).sum()) & ((1 << 64) - 1)
    b = int(mixed(ordered ^ U64(0xD6E8FEB86659FD93)).sum()) & ((1 << 64) - 1)
    return len(ordered).to_bytes(4, "big") + a.to_bytes(8, "big") + b.to_bytes(8, "big")


def class_sets(docs: DataFrame, wanted: DataFrame, size: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(class, shingles): the full sets of the wanted classes. ``wanted`` has the (doc_id, text_key) of one row of each.

    Copies of a text differ in their ids, so they don't meet in one task; rows that don't are the
    same row. The wanted rows grow with the table, so texts always go to them by a shuffle.
    """
    keyed = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.md5(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")).alias("text_key"),
        F.col(f"`{text}`").cast("string").alias("text"))
    one = wanted.select(F.col("doc_id").alias("own_id"), F.col("text_key").alias("own_key"))
    rows = keyed.join(
        one.hint("merge"), F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("text_key") == F.col("own_key")), "left_semi",
    ).dropDuplicates(["doc_id", "text_key"])

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batch.column(0)):
            words = words_of(chunk, SPACED)
            sets = [shingles(words.hash[words.first[i]: words.first[i + 1]], size) for i in range(chunk.last - chunk.first)]
            flat = np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([_digest(s) for s in sets], pa.binary()), list_array(pa.array(flat), [len(s) for s in sets])],
                ["class", "shingles"])

    return arrow_rows(rows.select("text"), work, "class binary, shingles array<long>")


def _similar(common: Column, a: Column, b: Column, percent: int) -> Column:
    return 100 * common >= percent * (a + b - common)


def _estimate(a: str, b: str) -> Column:
    """The estimate of two packed signatures, from the hexadecimal digits that agree."""
    left, right = F.split(F.hex(a), ""), F.split(F.hex(b), "")
    same = F.aggregate(F.zip_with(left, right, lambda x, y: (x == y).cast("int")), F.lit(0), lambda total, x: total + x)
    return estimated(same)


def _pivot_pairs(classes: DataFrame) -> DataFrame:
    """(pivot, class): every class with the first class, in a seeded order, of each of its buckets."""
    members = classes.select("class", F.posexplode("bands").alias("band", "key"))
    first = members.groupBy("band", "key").agg(
        F.min(F.struct(F.xxhash64("class").alias("place"), F.col("class").alias("pivot"))).alias("first"),
        F.count("*").alias("size"),
    ).where("size > 1").select("band", "key", "first.pivot")
    return members.join(first, ["band", "key"]).where("class <> pivot").select("pivot", "class").distinct()


def _confirmed(pairs: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (pivot, class) whose full sets are similar enough."""
    bits = classes.select("class", "bits", "n_shingles")
    pivots = bits.select(F.col("class").alias("pivot"), F.col("bits").alias("p_bits"), F.col("n_shingles").alias("p_n"))
    sized = pairs.join(bits, "class").join(pivots, "pivot").where(
        100 * F.least("n_shingles", "p_n") >= percent * F.greatest("n_shingles", "p_n"))
    likely = sized.where(_estimate("bits", "p_bits") >= percent / 100 - SLACK)
    full = likely.join(sets, "class").join(
        sets.select(F.col("class").alias("pivot"), F.col("shingles").alias("p_set")), "pivot")
    common = F.size(F.array_intersect("shingles", "p_set"))
    return full.where(_similar(common, F.col("n_shingles"), F.col("p_n"), percent)).select(
        F.col("pivot").alias("a"), F.col("class").alias("b"))


def _connecting(members: pd.DataFrame, percent: int) -> list[tuple[bytes, bytes]]:
    """Links that connect the similar classes of two tiles that have different roots."""
    left, right = members[members["left"]], members[members["right"]]
    if left.empty or right.empty:
        return []
    bits = [np.frombuffer(b"".join(side["bits"]), np.uint8).reshape(len(side), -1) for side in (left, right)]
    n = [side["n_shingles"].to_numpy() for side in (left, right)]
    sets = [side["shingles"].tolist() for side in (left, right)]
    names = [side["class"].tolist() for side in (left, right)]
    parent = {root: root for root in {*left["root"], *right["root"]}}

    def root_of(x: bytes) -> bytes:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    found = []
    roots = [side["root"].tolist() for side in (left, right)]
    number = {root: i for i, root in enumerate(parent)}
    codes = [np.array([number[r] for r in side]) for side in roots]
    for i in range(len(left)):
        matches = _equal_nibbles(bits[0][i: i + 1], bits[1])[0]
        small, large = np.minimum(n[0][i], n[1]), np.maximum(n[0][i], n[1])
        likely = (estimated(matches) >= percent / 100 - SLACK) & (100 * small >= percent * large) & (codes[1] != codes[0][i])
        for j in np.flatnonzero(likely).tolist():
            a, b = root_of(roots[0][i]), root_of(roots[1][j])
            if a == b:
                continue
            common = len(np.intersect1d(sets[0][i], sets[1][j], assume_unique=True))
            if 100 * common >= percent * (n[0][i] + n[1][j] - common):
                parent[max(a, b)] = min(a, b)
                found.append((names[0][i], names[1][j]))
    return found


def _remaining_links(pairs: DataFrame, roots: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links inside the groups of pivots between classes that the pivots have not connected."""
    rooted = roots.select(F.col("node").alias("class"), "root")
    grouped = pairs.join(rooted, "class", "left").withColumn("root", F.coalesce("root", "class"))
    own = grouped.groupBy("pivot", "root").agg(F.count("*").alias("n"))
    # Of a group, the root with the most classes, which need no comparison with each other.
    largest = own.groupBy("pivot").agg(F.max(F.struct("n", "root")).alias("most"), F.count("*").alias("roots"))
    # Written before it is joined, so that a large group's rows can be split among tasks.
    open_groups = freeze(largest.where("roots > 1").select("pivot", F.col("most.root").alias("major")))
    rows = grouped.join(open_groups, "pivot").join(classes.select("class", "bits", "n_shingles"), "class")
    rows = rows.withColumn("minor", F.col("root") != F.col("major"))
    # A tile holds a share of a group's classes by a hash, small enough in number and in sizes.
    sizes = freeze(rows.groupBy("pivot", "minor").agg(F.count("*").alias("c"), F.sum("n_shingles").alias("s")))
    tiles = sizes.select(
        "pivot", "minor", F.ceil(F.greatest(F.col("c") / TILE_CLASSES, F.col("s") / TILE_NUMBERS)).cast("int").alias("tiles"))
    per = freeze(tiles.groupBy("pivot").agg(
        F.coalesce(F.max(F.when(F.col("minor"), F.col("tiles"))), F.lit(0)).alias("minors"),
        F.coalesce(F.max(F.when(~F.col("minor"), F.col("tiles"))), F.lit(0)).alias("majors")))
    placed = rows.join(per, "pivot").withColumn(
        "tile", F.pmod(F.xxhash64("class"), F.when(F.col("minor"), F.col("minors")).otherwise(F.col("majors"))))
    # Tasks (i, j): minor tile i with minor tile j >= i, or with major tile j (counted on).
    whole = F.expr("""
        if(minor,
           concat(transform(sequence(0L, minors + majors - 1L), j -> struct(least(tile, if(j < minors, j, tile)) as i,
                      if(j < minors, greatest(tile, j), j) as j,
                      if(j < minors, tile <= j, true) as left, if(j < minors, tile >= j, false) as right))),
           transform(sequence(0L, minors - 1L), i -> struct(i as i, minors + tile as j, false as left, true as right)))""")
    dealt = placed.select("pivot", "class", "root", "bits", "n_shingles", F.explode(whole).alias("at")).select(
        "pivot", "at.*", "class", "root", "bits", "n_shingles")
    full = dealt.join(sets, "class")

    def work(members: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(_connecting(members, percent), columns=["a", "b"])

    return full.groupBy("pivot", "i", "j").applyInPandas(work, "a binary, b binary")


def near_duplicates(
    docs: DataFrame, *, size: int = 5, percent: int = 80, text: str = "text", doc_id: str = "doc_id",
) -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id, first): a row for each row of ``docs``.

    Texts are linked if 100 * common >= percent * all of their ``size``-word shingles.
    component_id is the least doc_id that can be reached over links; ``first`` is the least
    (doc_id, text_key) of the component, nulls last, by which one row can be kept.
    """
    with scratch(docs.sparkSession):
        signed = freeze(signatures(docs, size, text, doc_id))
        first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_key"))
        classes = freeze(signed.where("class is not null").groupBy("class").agg(
            first.alias("row"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"),
            F.first("bits").alias("bits")).select("class", "row.doc_id", "row.text_key", "n_shingles", "bands", "bits"))
        pairs = freeze(_pivot_pairs(classes))
        used = pairs.select("class").union(pairs.select("pivot")).distinct()
        sets = freeze(class_sets(docs, classes.join(used, "class", "left_semi"), size, text, doc_id))
        links = freeze(_confirmed(pairs, classes, sets, percent))
        roots = components(links)
        more = freeze(_remaining_links(pairs, roots, classes, sets, percent))
        if more.head(1):
            roots = components(links.unionByName(more))
        # Only linked classes have roots; the others are components of their own.
        rooted = signed.join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn(
            "group", F.coalesce("root", "class"))
        # The order (doc_id, text_key) with null ids last.
        place = F.struct(F.col("doc_id").isNull().alias("unknown"), F.col("doc_id"), F.col("text_key"))
        least = freeze(rooted.where("group is not null").groupBy("group").agg(F.min(place).alias("least")))
        return freeze(rooted.join(least, "group", "left").select(
            "doc_id", "text_key", "n_shingles",
            F.when(F.col("group").isNull(), F.col("doc_id")).otherwise(F.col("least.doc_id")).alias("component_id"),
            F.when(F.col("group").isNull(), place).otherwise(F.col("least")).alias("first"),
            F.col("group").isNull().alias("alone")), keep=True)


def kept(found: DataFrame) -> Column:
    """Whether a row's id is that of its component."""
    return found["doc_id"].eqNullSafe(found["component_id"])


def deduplicate(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """One row of each component, with all columns: the first by (id, digest of the text).

    Of rows with equal ids and texts one is kept. Texts meet ids and digests of what goes, and
    are dealt out anew only if there are rows with equal ids and texts.
    """
    found = near_duplicates(docs, text=text, doc_id=doc_id, **options)
    key, own, mine = unused(docs, "text_key"), unused(docs, "id"), unused(docs, "digest")
    gone = found.where(~F.col("alone") & ~(
        F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key")))).select(
        F.col("doc_id").alias(own), F.col("text_key").alias(key)).distinct()
    gone = freeze(gone)
    keyed = docs.withColumn(mine, F.md5(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")))
    # What goes grows with the table, so texts always go to it by a shuffle.
    left = keyed.join(gone.hint("merge"), keyed[doc_id].eqNullSafe(gone[own]) & (keyed[mine] == gone[key]), "left_anti")
    if found.groupBy("doc_id", "text_key").count().where("count > 1").head(1):
        left = left.dropDuplicates([doc_id, mine])
    return left.select(*[F.col(f"`{c}`") for c in docs.columns])
