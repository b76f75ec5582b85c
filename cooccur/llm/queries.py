"""One query per operator over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cooccur.llm import classlm, decontaminate, licenses, minhash, mixing, periods, phrases, records, rules, secrets, topk, toxicity, transcripts
from cooccur.llm.frames import freeze, learnable
from cooccur.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]

#: Fixed by the contract of the mixing query: weights dealt to the sources in order, most repetitions.
MIX_WEIGHTS = (5, 2, 1)
MIX_EPOCHS = 3


#: Fixed by the contract of the near-duplicate query.
LINK_WORDS = 3
LINK_PERCENT = 85
#: Fixed by the contract of the token query.
TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
#: Fixed by the contract of the phrase query.
PHRASES, PHRASE_WORDS, PHRASE_COUNT, ABSORBED = 2000, 4, 30, 80
#: Fixed by the contract of the search: every how many ids are asked for, how many are found, steps of a component.
ASKED, MATCHES, SCALE = 20, 20, 64.0
#: Fixed by the contract of the query on periodic runs.
RUN_WORDS, RUN_TIMES = 6, 4


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text) as the contract of the query on periodic runs wants it: a tenth of the texts made periodic.

    With h = crc32 of the id's digits and g = floor(h / 10): if 10 divides h, the words from
    a = g % n on repeat the p words there, p = 1 + floor((n - a) / (3 + g % 8)). A null id has h = 0.
    """
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.regexp_extract_all("text", F.lit(mixing.WORD), F.lit(0))
    parts = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("w"), F.floor(h / 10).alias("g"))
    dealt = parts.withColumn("a", F.expr("g % size(w)")).withColumn("p", F.expr("1 + (size(w) - a) div (3 + g % 8)"))
    repeated = F.expr("array_join(transform(w, (x, i) -> if(i < a, x, w[int(a + (i - a) % p)])), ' ')")
    return dealt.select("doc_id", F.when(F.size("w") > 0, repeated).otherwise(F.col("text")).alias("text"))


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix_sources(table(spark, sf_dir, "documents"), MIX_WEIGHTS, max_epochs=MIX_EPOCHS)
    return mix.select("doc_id", "size", "source_size", "target", "taken", "times")


def op2_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = classlm.score_texts(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, hits, items = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    named = items.groupBy("text_key").agg(F.sort_array(F.collect_set("item_id")).alias("ids"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    # Written before it is joined, so that the rows of a text with many copies can be split among tasks.
    found = freeze(hits.join(named, "text_key", "left"))
    return docs.join(found, "text_key", "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"),
        F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("ids", ","), F.lit("")), 256).alias("items_sha256"),
        decontaminate.contaminated(n_hit, F.col("n_words")).alias("contaminated"))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), size=LINK_WORDS, percent=LINK_PERCENT)
    return found.select("doc_id", "n_shingles", "component_id", minhash.kept(found).alias("kept"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select(
        "doc_id", (~learnable("doc_id", toxicity.FOLDS)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_chat_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transcripts.recovered(table(spark, sf_dir, "conversations"))


def op8_rule_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rules.cascade(table(spark, sf_dir, "documents"), keep=("doc_id",), statistics=True)
    return found.withColumn("base_failed", rules.base_failed()).withColumn(
        "kept", F.col("rejected_by").isNull() & ~F.col("base_failed")).drop("rejected_by")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def op10_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = records.token_records(docs, tokenizer=tokenizer_path(), end_id=END_ID)
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(
        table(spark, sf_dir, "documents"), top=PHRASES, longest=PHRASE_WORDS, least=PHRASE_COUNT, percent=ABSORBED)


def op12_top_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_matches(vectors, F.col("vec_id") % ASKED == 0, k=MATCHES, scale=SCALE)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.periodic_runs(with_planted_periods(table(spark, sf_dir, "documents")), least=RUN_WORDS, times=RUN_TIMES)
    best = periods.strongest("runs")
    listed = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_class_lm": op2_class_lm,
    "op3_license_scan": op3_license_scan,
    "op4_decontaminate": op4_decontaminate,
    "op5_minhash": op5_minhash,
    "op6_toxicity": op6_toxicity,
    "op7_chat_roles": op7_chat_roles,
    "op8_rule_cascade": op8_rule_cascade,
    "op9_secret_scan": op9_secret_scan,
    "op10_token_records": op10_token_records,
    "op11_phrases": op11_phrases,
    "op12_top_matches": op12_top_matches,
    "op13_periodic_runs": op13_periodic_runs,
}
