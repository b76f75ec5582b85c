"""Token ids as length-delimited binary records, with an offset index for shuffled reads.

A data file holds records end to end. A record is

    8 bytes   length of the body
    4 bytes   masked checksum of the length's bytes
    body      1 byte: 1 if the id is not null, 8 bytes: doc_id, 1 byte: width of a token id,
              then the token ids
    4 bytes   masked checksum of the body
    1 byte    0x0A

All numbers are little-endian. A checksum is the CRC-32 rotated right by 15 bits plus a
constant, so that a checksum of data that itself holds checksums stays useful. Token ids are
2 bytes wide if the vocabulary fits, else 4.

Files are written by Spark's text writer, row by row, under its commit protocol: a lost
executor or a second attempt leaves no half-written or doubled file, and any file system that
Spark writes to will do. The closing byte of a record is that writer's line separator. Files
are in ascending order of doc_id, null ids first, both inside a file and by the number in
their name. The index is derived from the committed files, a row per record: file, offset,
length, doc_id, number of ids before it and in it.

Null and empty texts are records with only the end id. Repeated rows are repeated records, rows
with equal ids stand in the order of their texts' digests; they may fill any number of files. A
very long text is one record. An empty table gives no records. Other columns of the input are not read.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cooccur.llm.frames import arrow_rows, freeze, fresh_path, text_digest
from cooccur.llm.text import Chunk, alphabet, chunks, spans_hash
from cooccur.session import batch_bytes

#: Fixed values of the record format.
MASK_DELTA = 0xA282EAD8
HEAD = struct.Struct("<QI")
BODY = struct.Struct("<BqB")
CLOSE = b"\n"

#: Pieces of text whose ids a Python worker remembers; beyond that it starts over.
REMEMBERED = 1 << 19
#: Pieces that the tokenizer encodes at a time.
LEARNED = 4096
#: Bytes of the texts that are cut into pieces at a time, and of the batches that tasks are sent; a longer text is one of its own.
PART_BYTES = 1 << 19
BATCH_BYTES = 4 << 20


def masked(checksum: int) -> int:
    return (((checksum >> 15) | (checksum << 17)) + MASK_DELTA) & 0xFFFFFFFF


def framed(doc_id: int | None, ids: np.ndarray) -> bytes:
    """One record but for its closing byte; ``ids`` is an array of 2- or 4-byte numbers."""
    body = BODY.pack(doc_id is not None, doc_id or 0, ids.itemsize) + ids.tobytes()
    length = struct.pack("<Q", len(body))
    return b"".join((length, struct.pack("<I", masked(zlib.crc32(length))), body, struct.pack("<I", masked(zlib.crc32(body)))))


def record_at(content: memoryview, offset: int) -> tuple[int | None, np.ndarray, int]:
    """(doc_id, ids, offset of the next record); a damaged record is an error."""
    size, check = HEAD.unpack_from(content, offset)
    if masked(zlib.crc32(content[offset: offset + 8])) != check:
        raise ValueError(f"damaged length at {offset}")
    start = offset + HEAD.size
    body = content[start: start + size]
    (body_check,) = struct.unpack_from("<I", content, start + size)
    if masked(zlib.crc32(body)) != body_check:
        raise ValueError(f"damaged record at {offset}")
    known, doc_id, width = BODY.unpack_from(body, 0)
    ids = np.frombuffer(body, f"<u{width}", offset=BODY.size)
    return doc_id if known else None, ids, start + size + 4 + len(CLOSE)


# ---------------------------------------------------------------------------- encoding

_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[ord("A"): ord("Z") + 1] = _ASCII_LETTER[ord("a"): ord("z") + 1] = True
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in ".,;:!?*$%&#()"]] = True
_ANY = alphabet(np.ones(256, bool), fold=False)


def _piece_starts(chunk: Chunk) -> np.ndarray:
    """Where a byte-level pre-tokenizer certainly begins a new token; a subset of its cuts.

    It keeps a single space with the word that follows, and never joins letters with marks or
    white space before them. So it always cuts before a single space and around a single line
    break between other characters, and between a letter and one of ``_MARK`` (which leaves out
    the apostrophe of contractions and the characters of special tokens). Only ASCII and
    Latin-1 letters count as such; next to other characters nothing is cut.
    """
    raw = chunk.raw
    n = len(raw)
    cut = np.zeros(n + 1, bool)
    if n > 2:
        latin = np.zeros(n, bool)
        latin[1:] = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] != 0x97) & (raw[1:] != 0xB7)
        letter = _ASCII_LETTER[raw] | latin
        dark = latin | ((raw > 0x20) & (raw < 0x7F))
        lone = np.zeros(n, bool)
        lone[1:-1] = dark[:-2] & (dark[2:] | (raw[2:] == 0xC3))
        line = lone & (raw == 0x0A)
        cut[:n] = line | (lone & (raw == 0x20))
        cut[1:n] |= line[:-1]
        cut[1:n] |= (letter[:-1] & _MARK[raw[1:]]) | (_MARK[raw[:-1]] & _ASCII_LETTER[raw[1:]])
    cut[chunk.bounds] = True
    return np.flatnonzero(cut[:n])


class PieceEncoder:
    """Ids of texts by a tokenizers file; ids of pieces seen before come from memory.

    Byte-level merging never crosses the cuts of the pre-tokenizer, so the ids of a text are
    the ids of its pieces one after the other.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.forget()

    def forget(self) -> None:
        # Hashes of remembered pieces in order, and which piece each is. As arrays a piece takes 12 bytes, in a dict above 100.
        self.known = np.zeros(0, np.uint64)
        self.nth = np.zeros(0, np.int32)
        self.flat = np.zeros(1 << 16, self.width)
        self.ends = np.zeros(1 << 14, np.int64)

    def _learn(self, chunk: Chunk, start: np.ndarray, end: np.ndarray) -> None:
        """Append the ids of these spans as further pieces."""
        first = len(self.known)
        for part in range(0, len(start), LEARNED):
            spans = zip(start[part: part + LEARNED].tolist(), end[part: part + LEARNED].tolist(), strict=True)
            encoded = self.tokenizer.encode_batch_fast([chunk.text(*span) for span in spans], add_special_tokens=False)
            found = [e.ids for e in encoded]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            used = int(self.ends[first])
            while first + len(found) + 1 > len(self.ends):
                self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
            while used + sizes.sum() > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
            self.flat[used: used + sizes.sum()] = np.fromiter((i for ids in found for i in ids), self.width, int(sizes.sum()))
            self.ends[first + 1: first + 1 + len(found)] = used + np.cumsum(sizes)
            first += len(found)

    def encode(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, end of each text's ids)."""
        start = _piece_starts(chunk)
        if not len(start):
            return np.zeros(0, self.width), np.zeros(len(chunk.bounds) - 1, np.int64)
        end = np.append(start[1:], len(chunk.raw))
        distinct, first, inverse = np.unique(
            spans_hash(chunk.raw, start, end, _ANY.value), return_index=True, return_inverse=True)
        if len(self.known) + len(distinct) > REMEMBERED:
            self.forget()
        at = np.searchsorted(self.known, distinct)
        new = np.ones(len(distinct), bool)
        inner = at < len(self.known)
        new[inner] = self.known[at[inner]] != distinct[inner]
        if new.any():
            self._learn(chunk, start[first[new]], end[first[new]])
            added = np.arange(len(self.known), len(self.known) + new.sum(), dtype=np.int32)
            self.known, self.nth = np.insert(self.known, at[new], distinct[new]), np.insert(self.nth, at[new], added)
        slots = self.nth[np.searchsorted(self.known, distinct)][inverse]
        sizes = self.ends[slots + 1] - self.ends[slots]
        until = np.cumsum(sizes)
        take = np.arange(until[-1]) + np.repeat(self.ends[slots] - (until - sizes), sizes)
        ends = np.concatenate([[0], until])[np.searchsorted(start, chunk.bounds[1:])]
        return self.flat[take], ends


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """This worker's encoder, kept for its next tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


# ---------------------------------------------------------------------------- files

def write_records(
    docs: DataFrame, path: str, *, tokenizer: str, end_id: int, files: int | None = None,
    text: str = "text", doc_id: str = "doc_id",
) -> None:
    """Encode every text, append ``end_id``, and write the records under ``path``/data and their index under ``path``/index."""
    # Rows with equal ids are ordered by their texts' digests, equal rows by numbers, so that no number
    # of equal ids or rows has to go into one file.
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    rows = rows.withColumn("digest", text_digest("text")).withColumn("nth", F.monotonically_increasing_id())
    order = [F.col("doc_id").asc_nulls_first(), "digest", "nth"]
    ranged = rows.repartitionByRange(files, *order) if files else rows.repartitionByRange(*order)

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        ids = batch.column(0).to_pylist()
        for chunk in chunks(batch.column(1), PART_BYTES):
            flat, ends = own.encode(chunk)
            end_mark = np.array([end_id], flat.dtype)
            out, at = [], 0
            for i, until in enumerate(ends.tolist()):
                out.append(framed(ids[chunk.first + i], np.concatenate([flat[at:until], end_mark])))
                at = until
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    framed_rows = arrow_rows(ranged.sortWithinPartitions(*order).select("doc_id", "text"), work, "record binary")
    with batch_bytes(docs.sparkSession, BATCH_BYTES):
        framed_rows.select(F.col("record").cast("string").alias("value")).write.text(f"{path}/data", lineSep=CLOSE.decode())
    scan_records(docs.sparkSession, path).select(
        "file", "offset", "length", "doc_id", "start", "n_tokens").write.parquet(f"{path}/index")


def _files(spark: SparkSession, path: str) -> DataFrame:
    """(file, number in order, content) of the data files; a file is one task's row."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/data")
    number = F.regexp_extract("path", r"part-(\d+)", 1).cast("long")
    return found.where("length > 0").select(F.col("path").alias("file"), number.alias("number"), "content")


SCANNED = "file string, number long, offset long, length long, doc_id long, before long, n_tokens long, ids_crc32 long"


def scan_records(spark: SparkSession, path: str) -> DataFrame:
    """A row for every record of the data files: where it is, its ids' start, number and CRC-32 (as 4-byte numbers)."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row in range(batch.num_rows):
            file, number = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
            content = memoryview(batch.column(2)[row].as_buffer())
            out, at, before = [], 0, 0
            while at < len(content):
                doc_id, ids, following = record_at(content, at)
                out.append((at, following - at, doc_id, before, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                at, before = following, before + len(ids)
            columns = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([file] * len(out), pa.string()), pa.array([number] * len(out), pa.int64()), *columns],
                ["file", "number", "offset", "length", "doc_id", "before", "n_tokens", "ids_crc32"])

    with batch_bytes(spark, BATCH_BYTES):
        records = freeze(arrow_rows(_files(spark, path), work, SCANNED))
    earlier = W.orderBy("number").rowsBetween(W.unboundedPreceding, -1)
    bases = records.groupBy("number").agg(F.sum("n_tokens").alias("_n")).select(
        "number", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    return records.join(bases, "number").withColumn("start", F.col("_base") + F.col("before")).drop("_base", "before")


def read_records(spark: SparkSession, path: str, *, seed: int | None = None) -> DataFrame:
    """(doc_id, ids) from the files through their index; with a seed, shuffled.

    The index rows of a file meet its content, and each record is read at its own offset. The
    shuffle deals records to partitions and orders them there by a seeded digest.
    """
    index = spark.read.parquet(f"{path}/index")
    wanted = index.groupBy("file").agg(F.sort_array(F.collect_list("offset")).alias("offsets"))
    found = _files(spark, path).join(wanted, "file").select("content", "offsets")

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row in range(batch.num_rows):
            content = memoryview(batch.column(0)[row].as_buffer())
            doc_ids, ids = [], []
            for offset in batch.column(1)[row].as_py():
                doc_id, own, _ = record_at(content, offset)
                doc_ids.append(doc_id)
                ids.append(own.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    records = arrow_rows(found, work, "doc_id long, ids array<int>")
    if seed is None:
        return records
    place = F.xxhash64(F.lit(seed), "doc_id", F.size("ids"))
    return records.withColumn("_place", place).repartition("_place").sortWithinPartitions("_place").drop("_place")


def token_records(docs: DataFrame, *, tokenizer: str, end_id: int, path: str | None = None, **options) -> DataFrame:
    """Write the records and read them back: a row per document with its place in the stream and its checksum."""
    spark = docs.sparkSession
    path = path or fresh_path(spark, "records")
    write_records(docs, path, tokenizer=tokenizer, end_id=end_id, **options)
    return scan_records(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32", "file", "offset", "length")
