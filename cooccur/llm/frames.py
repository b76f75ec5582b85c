"""Small helpers of the operators: output columns, scalars, clashing names, shared folders."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cooccur.session import freeze, fresh_path

__all__ = ["freeze", "fresh_path", "unused", "arrow_rows", "scalar_row", "learnable", "text_digest", "without_texts"]


def unused(df: DataFrame, label: str) -> str:
    """A column name that ``df`` doesn't have in any case."""
    taken = {c.lower() for c in df.columns}
    name = f"_{label}"
    while name.lower() in taken:
        name = f"_{label}_{uuid.uuid4().hex[:8]}"
    return name


def arrow_rows(df: DataFrame, work: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``work`` on every Arrow batch of every partition.

    Workers outlive their tasks; what Arrow holds unused at the end of one is given back, so that it
    doesn't add to the memory of the executor while others work.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from work(batch)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(task, schema)


def scalar_row(df: DataFrame) -> dict:
    """The single row of an aggregate."""
    return df.first().asDict()


def learnable(doc_id: str | Column, folds: int) -> Column:
    """Whether a row may be learned from: crc32 of the id's text is not 0 modulo ``folds``.

    A null id counts as an empty text, whose remainder is 0: such rows are never learned from.
    """
    text = F.coalesce((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds != 0


def text_digest(text: str) -> Column:
    """A digest by which equal texts are found again; a null text is an empty one."""
    return F.md5(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary"))


def without_texts(docs: DataFrame, bad: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the rows whose text has its digest in the only column of ``bad``.

    The digests are written before they are joined, so that the rows of a text with many copies
    can be split among tasks.
    """
    key = unused(docs, "text_key")
    return docs.withColumn(key, text_digest(text)).join(freeze(bad.toDF(key)), key, "left_anti").select(
        *[F.col(f"`{c}`") for c in docs.columns])
