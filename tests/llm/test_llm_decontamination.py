from pyspark.sql import functions as F

from leaguelake.llm import template_decontamination as t

ITEM = "A train leaves Boston at 9 and drives 120 km to the station where Alice waits for 45 minutes before Alice goes home"
BENCH = "item_id bigint, text string"


def found(spark, documents, docs, items, **kw):
    out = t.contaminated(documents(docs, **kw), spark.createDataFrame(items, BENCH))
    return {(r["doc_id"], r["item_id"]): r for r in out.collect()}


def test_copies_and_reparameterised_questions_are_found(spark, documents):
    other = ITEM.replace("Boston", "Denver").replace("120", "1,350").replace("Alice", "Carol").replace("45", "30")
    docs = [
        (1, f"Some words before it. {ITEM} and more words after."),
        (2, f"we read that {other} every day"),
        (3, "nothing here is like any question of the test set at all"),
        (4, f"so {ITEM.replace('before Alice', 'before Carol')}"),
        (5, " ".join(ITEM.split()[:7])),
    ]
    got = found(spark, documents, docs, [(7, ITEM)])
    assert set(got) == {(1, 7), (2, 7)}
    assert not got[1, 7]["reparameterised"] and got[1, 7]["changed_slots"] == 0
    assert got[2, 7]["reparameterised"] and got[2, 7]["covered"] >= t.MIN_COVERED


def test_ends_grown_together_with_their_neighbours(spark, documents):
    item = "one short question of twelve words that somebody asks about green birds"
    got = found(spark, documents, [(1, f"see{item}less"), (2, " ".join(item.split()[2:10]))], [(1, item)])
    assert set(got) == {(1, 1)} and got[1, 1]["covered"] == 10


def test_one_name_cannot_stand_for_two(spark, documents):
    item = "in the morning Alice gives her apples to Bob and then Bob gives some apples back to Alice again"
    swapped = item.replace("Alice", "Dora").replace("Bob", "Emil")
    merged = item.replace("Alice", "Dora").replace("Bob", "Dora")
    got = found(spark, documents, [(1, f"so {swapped}"), (2, f"so {merged}")], [(1, item)])
    assert set(got) == {(1, 1)}


def test_defined_cases(spark, documents):
    docs = [(1, None), (2, ""), (None, ITEM), (4, ITEM), (4, ITEM), (5, "word " * 30_000 + ITEM)]
    items = [(1, ITEM), (2, None), (3, ""), (4, "7 8 9"), (5, "only four words here")]
    got = t.contaminated(documents(docs, clashing=True), spark.createDataFrame(items, BENCH)).collect()
    assert sorted(((r["doc_id"], r["item_id"]) for r in got), key=str) == sorted([(None, 1), (4, 1), (5, 1)], key=str)
    short = found(spark, documents, [(1, "look: only four words here, said he")], items)
    assert set(short) == {(1, 5)}
    assert not found(spark, documents, [], items) and not found(spark, documents, docs, [])


def test_clean_documents_keep_all_columns(spark, documents):
    docs = documents([(1, ITEM), (2, "a clean text"), (3, None), (2, "a clean text")], clashing=True)
    left = t.clean_documents(docs, spark.createDataFrame([(1, ITEM)], BENCH))
    assert left.columns == docs.columns and sorted(r["doc_id"] for r in left.collect()) == [2, 2, 3]


def test_against_brute_force(spark, sample):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"]) for r in t.contaminated(sample, bench).collect()}
    canonical = [t._split(t._canonical(t._raw(F.col("text")))).alias("c")]
    docs = {r["doc_id"]: r["c"] for r in sample.select("doc_id", *canonical).collect()}
    items = {r["item_id"]: r["c"] for r in bench.select("item_id", *canonical).collect()}
    expected = set()
    windows = {d: {tuple(c[i : i + 8]) for i in range(len(c) - 7)} for d, c in docs.items()}
    for i, c in items.items():
        for d, seen in windows.items():
            places = {k + j for k in range(len(c) - 7) if tuple(c[k : k + 8]) in seen for j in range(8)}
            if places and len(places) >= min(t.MIN_COVERED, len(c) - 2):
                expected.add((d, i))
    assert got == expected and got


def test_join_without_broadcast_gives_the_same(spark, sample, monkeypatch):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    before = {(r["doc_id"], r["item_id"], r["covered"]) for r in t.contaminated(sample, bench).collect()}
    monkeypatch.setattr(t, "BROADCAST_WINDOWS", 0)
    assert {(r["doc_id"], r["item_id"], r["covered"]) for r in t.contaminated(sample, bench).collect()} == before
