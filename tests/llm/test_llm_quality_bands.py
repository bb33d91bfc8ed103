import random

from pyspark.sql import functions as F

from leaguelake.llm import quality_rules as q

SYLLABLES = ["ba", "ne", "lo", "tis", "ra", "mu", "ken", "da"]


def prose(rng, n):
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3))) for _ in range(n))


def verdicts(docs):
    return [(r["doc_id"], r["kept"]) for r in q.quality_rules(docs).filter("NOT base_failed").collect()]


def test_symbol_junk_of_the_tables_goes_and_clean_documents_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = q.quality_rules(docs).filter("NOT base_failed").join(labels, "doc_id").join(docs.select("doc_id", "text"), "doc_id")
    junk = judged.filter((F.col("quality") == 0) & F.col("text").rlike("[&*%$#]{3} [^ ]+[&*%$#]{3}"))
    assert junk.count() >= 10 and junk.filter("kept").count() == 0
    assert judged.filter("quality = 1").agg(F.avg(F.col("kept").cast("int"))).first()[0] >= 0.97


def test_long_junk_near_the_ordinary_level_goes(documents):
    rng = random.Random(8)
    menu = " ".join(f"{prose(rng, 1)} |" for _ in range(600))
    got = verdicts(documents([(i, prose(rng, rng.choice([30, 60, 600]))) for i in range(300)] + [(900, menu)]))
    assert len(got) == 301 and {d for d, kept in got if not kept} == {900}


def test_copies_and_small_languages_leave_other_documents_alone(documents):
    rng = random.Random(9)
    rows = [(i, prose(rng, 60)) for i in range(200)] + [(1000 + i, prose(random.Random(1), 60)) for i in range(700)]
    rows += [(2000, prose(rng, 60), "xx"), (3000, prose(rng, 60), None)]
    got = verdicts(documents(rows))
    assert len(got) == len(rows) and all(kept for d, kept in got if not 1000 <= d < 2000)
