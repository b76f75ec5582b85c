import corpus_pipeline
from tests.llm.conftest import words


def test_stages_on_a_small_corpus(spark, odd_rows, tmp_path):
    docs = [(i, words(60, i), "en", "abc"[i % 3], 0) for i in range(500, 530)] + list(odd_rows)
    names = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(docs, names).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i == 108)) for i in range(12)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, words(30, 505))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    ids = []
    for name, stage in corpus_pipeline.STAGES:
        before = now.columns
        stage(spark, now, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        ids.append(sorted((r["doc_id"] for r in now.select("doc_id").collect()), key=repr))
        if name != "token_records":
            assert now.columns == before
    toxic, near, clean, mixed, tokens = ids
    assert 108 not in toxic and len(toxic) == len(docs) - 1
    assert 103 not in near and near.count(3) == 1 and set(range(500, 530)) <= set(near)
    assert 505 not in clean and len(clean) == len(near) - 1
    assert set(mixed) <= set(clean) and tokens == mixed
    assert spark.read.parquet(f"{tmp_path}/token_records").count() == corpus_pipeline.run(spark, str(tmp_path)).count()
