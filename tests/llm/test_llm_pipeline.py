import corpus_pipeline
from pyspark.sql import functions as F

from leaguelake.llm import registry


def test_stages_keep_the_columns_and_take_effect(spark, tmp_path):
    sf_dir = "/root/testdata/sf0.001"
    docs = first = spark.read.parquet(f"{sf_dir}/documents.parquet")
    counts = [docs.count()]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        counts.append(docs.count())
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == first.columns
            assert docs.filter(F.col("n_chars") != F.length("text")).count() == first.filter(F.col("n_chars") != F.length("text")).count() == 0
    assert counts[0] > counts[1] >= counts[2] > counts[3] > counts[4] == counts[5] > 0
    run = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(tuple, run.collect())) == sorted(map(tuple, docs.collect()))


def test_stages_take_an_empty_table_and_extra_columns(spark, documents, tmp_path):
    docs = documents([(1, None), (2, "")], clashing=True).filter("doc_id > 5")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, "/root/testdata/sf0.001").write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
    assert docs.count() == 0


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in registry.QUERIES) == list(range(1, 11))
