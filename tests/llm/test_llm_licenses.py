import re

import pytest
import regex

from leaguelake.llm import license_scan as l

FIELDS = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")


def scan(text):
    return dict(zip(FIELDS, l.Scanner().scan(None if text is None else text.encode())))


def base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places, labels = [], set()
    for phrase, label in l.BASE.items():
        sought = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(sought)] == sought:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


@pytest.mark.parametrize("text", [None, "", "CC BY", "cc by cc by cc  by-nc", "ÀLL RIGHTS RESERVED", "All rights\nreserved. ALL RIGHTS RESERVED!", "xcc by general public licenses", "2cc by"])
def test_base_phrases(text):
    got = scan(text)
    assert tuple(got[f] for f in FIELDS[:5]) == base(text)


def test_fuzzy_notices_and_spans():
    text = "Foo – bar. Licenced under the Apach License, Version 2.0! ALL RIGHTS RESERVED."
    got = scan(text)
    assert got["labels"] == "apache-2.0,reserved" and got["base_labels"] == "reserved" and got["score"] == 1.0
    assert [text[s["start"] : s["end"]] for s in got["spans"]] == ["Licenced under the Apach License, Version 2.0", "ALL RIGHTS RESERVED"]
    assert [s["edits"] for s in got["spans"]] == [2, 0]
    one = scan("Relesed under the MIT Licence")
    assert one["labels"] == "mit" and one["base_labels"] == "" and 0.8 < one["score"] < 1
    assert scan("licensed under cc by nc 4.0")["labels"] == "cc-by,cc-by-nc-4.0"
    assert scan("the license of a driver is under his reserved seat")["labels"] == ""


def test_no_occurrence_within_the_edits_is_lost():
    """Seeds find what a search without seeds finds."""
    import random

    rng, scanner = random.Random(2), l.Scanner()
    for number, (phrase, _) in enumerate(scanner.notices):
        for _ in range(25):
            chars = list(phrase)
            for _ in range(scanner.edits[number]):
                at = rng.randrange(len(chars))
                kind = rng.randrange(3)
                chars[at : at + (kind != 0)] = "" if kind == 1 else rng.choice("abcdefgh ")
            joined = f" begin {''.join(chars)} ending "
            assert regex.search(scanner.exact[number], joined)
            assert any(n == number or scanner.notices[n][0] != phrase for n, *_ in scanner.find(joined))


def test_tables_and_defined_cases(spark, documents, sample):
    docs = documents([(1, None), (2, ""), (None, "cc by"), (4, "word " * 100_000 + "cc by"), (4, "word " * 100_000 + "cc by")], clashing=True)
    rows = l.scan(docs.unionByName(sample, allowMissingColumns=True)).collect()
    texts = [r["text"] for r in docs.collect()] + [r["text"] for r in sample.collect()]
    assert sorted((tuple(r[f] for f in FIELDS[:5]) for r in rows), key=str) == sorted(map(base, texts), key=str)
    assert any("apache-2.0" in r["labels"] for r in rows) and all(0 <= r["score"] <= 1 for r in rows)
    assert l.scan(docs.limit(0)).count() == 0
