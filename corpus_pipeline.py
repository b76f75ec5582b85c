"""From raw documents to token records: each stage applies one of the operators of ``cooccur.llm``.

Every stage works on what the one before kept; all but the last return the columns of
``documents``. Null, empty, repeated and very long texts and empty tables pass through as the
operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cooccur.llm import decontaminate, minhash, mixing, queries, records, toxicity
from cooccur.llm.frames import fresh_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below one half."""
    return toxicity.without_toxic(docs, queries.table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8."""
    return minhash.deduplicate(docs, size=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words less than a twentieth stand in windows of benchmark items."""
    return decontaminate.decontaminate(docs, queries.table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of their sources takes them."""
    return mixing.apply_mix(docs, queries.MIX_WEIGHTS, max_epochs=queries.MIX_EPOCHS)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token records of the mix in the shared folder; a row for each, read back from the files."""
    return records.token_records(docs, tokenizer=queries.tokenizer_path(), end_id=queries.END_ID)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix),
    ("token_records", write_tokens),
]

#: Classifiers and tokenizers are part of the stages, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between stages the rows are written and read again."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
