import pytest

from leaguelake.llm import template_decontamination as t

BENCH = "item_id bigint, text string"


def found(spark, documents, docs, items):
    return {(r["doc_id"], r["item_id"]): r for r in t.contaminated(documents(docs), spark.createDataFrame(items, BENCH)).collect()}


ARITHMETIC = [
    (1, "What is 15 + 27 * 3?"),
    (2, "Compute 12 * 4 + 18 / 3 - 7 * 2 + 9."),
    (3, "Convert 5 km 300 m to cm."),
    (4, "Sort 12, 7, 19, 3, 25, 8, 14 and 2 from least to greatest."),
]


@pytest.mark.parametrize("threshold", [t.BROADCAST_WINDOWS, 0])
def test_number_dense_items_are_found_word_for_word(spark, documents, monkeypatch, threshold):
    monkeypatch.setattr(t, "BROADCAST_WINDOWS", threshold)
    docs = [(i, f"some words before it. {text} And more words after.") for i, text in ARITHMETIC]
    docs += [(9, "what is 16 + 27 * 3 and then compute 13 * 4 + 18 / 3 - 7 * 2 + 9 or convert 6 km 300 m to cm")]
    got = found(spark, documents, docs, [*ARITHMETIC, (5, "7 8")])
    assert set(got) == {(i, i) for i, _ in ARITHMETIC}
    assert not any(r["reparameterised"] for r in got.values())


ITEM = "A train leaves Boston at 9 and drives 120 km to the station where Alice waits for 45 minutes before Alice goes home. Bob stays."


def test_copies_with_other_case_or_without_punctuation_are_found(spark, documents):
    short = ITEM[: ITEM.index(".")]
    docs = [(1, f"so {ITEM.lower()}"), (2, f"so {ITEM.replace('.', '')}"), (3, f"so {short.lower()}"), (4, f"SO {ITEM.upper()}")]
    got = found(spark, documents, docs, [(1, ITEM), (2, short)])
    assert set(got) == {(d, i) for d in (1, 2, 3, 4) for i in (1, 2)}
    assert all(r["changed_slots"] == 0 for r in got.values())
