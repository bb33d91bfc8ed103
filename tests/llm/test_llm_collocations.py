import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from leaguelake.llm import collocations
from leaguelake.llm.collocations import Chunk, _verified, collocations as mine, frequent_phrases
from sql_compare import connect, differences

LOWER = {i: i + 32 for i in range(65, 91)}


def brute_force(rows, least=10, max_words=3, top=2000, covered=50):
    counts, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        total[lang] += 0
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for n in range(1, max_words + 1):
                counts[lang].update(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in candidates.items():
            longer = [b for q, b in candidates.items() if len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))]
            if any(100 * b >= covered * a for b in longer):
                continue
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def result(df, **options):
    return sorted(tuple(r) for r in mine(df, **options).collect())


def invented(seed, n_docs):
    rng = random.Random(seed)
    words = ["Der", "der", "new", "york", "Été", "東京", "a", "b", "b", "x-y", "🙂"]
    ends = [" ", "  ", "\t ", ", ", ".\n", "\r", "!", "\x0b", " \x0c "]
    return [("".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.randrange(0, 60))), rng.choice(["en", "de", None])) for _ in range(n_docs)]


SCHEMA = "doc_id bigint, text string, lang string"


@pytest.mark.parametrize("max_words, chunk, flush", [(3, 1 << 20, 1 << 21), (4, 40, 30)])
def test_equals_brute_force(spark, monkeypatch, max_words, chunk, flush):
    monkeypatch.setattr(collocations, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(collocations, "FLUSH", flush)
    monkeypatch.setattr(collocations, "RANGE_CHARS", 500)
    rows = invented(max_words, 150)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA)
    assert result(df, max_words=max_words) == brute_force(rows, max_words=max_words)


def test_equals_its_sql(spark):
    con = connect("/root/testdata/sf0.001")
    assert differences(mine(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")), con, collocations.SQL) == []


def test_ties_and_tops(spark):
    rows = [("z a. y b. x c", "en")] * 12 + [("p q r", "en")] * 11
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA)
    assert result(df) == brute_force(rows)
    assert result(df, top=2) == brute_force(rows, top=2)
    # the pairs inside the triple go
    assert [r[2] for r in result(df)] == ["x c", "y b", "z a", "p q r"]


def test_defined_cases(spark):
    rows = [(1, "Red Fox", "en")] * 6 + [(None, "red\tfox", "en")] * 6 + [(2, None, "en"), (3, "", None), (4, "red fox " * 40_000, "de"), (5, "a b " * 20, None)]
    wide = spark.createDataFrame([(*r, "k", "r", 1, 2) for r in rows], SCHEMA + ", key string, range string, f int, n int")
    assert result(wide) == brute_force([r[1:] for r in rows])
    assert result(spark.createDataFrame([], SCHEMA)) == []
    with pytest.raises(ValueError):
        frequent_phrases(wide, min_count=1)


def test_hot_language_and_copies(spark):
    rows = [("one two three four", "en")] * 3000 + invented(5, 60)
    df = spark.createDataFrame([(7 if i < 2000 else i, *r) for i, r in enumerate(rows)], SCHEMA).repartition(9)
    assert result(df) == brute_force(rows)


def test_occurrences_with_other_text_stay_apart():
    chunk = Chunk([(1, 5, 0, b"aa bb aa cc"), (2, 6, 0, b"aa dd")])
    first = chunk.firsts(1)
    same = np.zeros(len(first), np.uint64)  # all collide
    found = _verified(chunk, first, 1, same, same)
    texts = Counter()
    for key, place, count in zip(*(found[c].tolist() for c in ("key", "place", "count"))):
        texts[(key, {1: b"aa bb aa cc", 2: b"aa dd"}[key][place:place + 2])] += count
    assert texts == {(1, b"aa"): 2, (1, b"bb"): 1, (1, b"cc"): 1, (2, b"aa"): 1, (2, b"dd"): 1}


def test_fingerprints_do_not_depend_on_the_place():
    a, b = Chunk([(1, 5, 0, b"red fox jumps")]), Chunk([(1, 5, 0, b"the old red fox jumps; red fox")])
    for lane in collocations._LANES:
        (x, y), at_a, at_b = [lane.words(c.data, c.starts, c.ends) for c in (a, b)], np.array([0]), np.array([2, 5])
        one, two = lane.ngrams(x, at_a, 2, a.language[at_a]), lane.ngrams(y, at_b, 2, b.language[at_b])
        assert set(one) == set(two)


def test_documents_of_one_key_are_told_apart(spark, monkeypatch):
    """Two bits of key: most documents share theirs."""
    monkeypatch.setattr(collocations, "KEY_BITS", 2)
    rows = invented(9, 120)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA)
    assert result(df) == brute_force(rows)


def test_planes():
    for values in (np.array([1, 2**63, 5], np.uint64), np.array([7, 2**31], np.uint32), np.zeros(0, np.uint64)):
        assert (collocations._from_planes(collocations._planes(values), values.dtype.type) == values).all()
