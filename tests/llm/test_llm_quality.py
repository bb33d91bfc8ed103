import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from leaguelake.llm import quality_rules as q


def brute_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


@pytest.mark.parametrize("text", [None, "", "a", "\n\n", "x y\nx y\n \nx y", "a b c d e f g h " * 2, "a b c d e f g h " * 3 + "z", "one " * 100, "# * é | <> 　 x"])
def test_base_metrics(text):
    assert q.base_metrics(text) == brute_base(text)


def test_base_metrics_of_tables(sample):
    for r in sample.collect():
        assert q.base_metrics(r["text"]) == brute_base(r["text"])


def brute_kneser_ney(counts, order, alphabet):
    """Interpolated modified Kneser-Ney over tuples of symbols."""
    tables = {order: counts}
    for size in range(order - 1, 0, -1):
        tables[size] = Counter(g[1:] for g in tables[size + 1])
    probability = {(): 1.0 / alphabet}
    gammas = {}
    for size in range(1, order + 1):
        n = [sum(c == k for c in tables[size].values()) for k in range(5)]
        if all(n[1:]):
            y = n[1] / (n[1] + 2 * n[2])
            d = [max(0.0, min(float(k), k - (k + 1) * y * n[k + 1] / n[k])) for k in (1, 2, 3)]
        else:
            d = [0.5, 1.0, 1.5]
        lose = lambda c: min(d[min(int(c), 3) - 1], c)
        total, lost = defaultdict(float), defaultdict(float)
        for g, c in tables[size].items():
            total[g[:-1]] += c
            lost[g[:-1]] += lose(c)
        for ctx in total:
            gammas[ctx] = lost[ctx] / total[ctx]
        for g, c in tables[size].items():
            probability[g] = (c - lose(c)) / total[g[:-1]] + gammas[g[:-1]] * probability[g[1:] if size > 1 else ()]

    def p(g):
        if g in probability:
            return probability[g]
        return gammas.get(g[:-1], 1.0) * p(g[1:])

    return p


def symbols(alphabet, text):
    grams, begins = alphabet.grams([text])
    assert begins.tolist() == [0, len(grams)]
    out = []
    for g in grams.tolist():
        out.append(tuple(g // q.ALPHABET**k % q.ALPHABET for k in reversed(range(q.ORDER))))
    return out


def test_grams_of_several_texts():
    a = q.Alphabet()
    texts = ["", "ab", "  A  b!!c ", "", "é***x\U0001f600", " "]
    grams, begins = a.grams(texts)
    parts = [grams[x:y].tolist() for x, y in zip(begins, begins[1:])]
    assert parts == [a.grams([t])[0].tolist() for t in texts]
    assert [len(p) for p in parts] == [1, 3, 7, 1, 5, 1]
    assert symbols(a, "ab") == [(0, 0, 0, 1), (0, 0, 1, 2), (0, 1, 2, 0)]
    assert a.grams(["HE !!"])[0].tolist() == a.grams(["he  !"])[0].tolist()


def test_perplexity_against_brute_force(documents):
    rng = random.Random(5)
    rows = [(i, "".join(rng.choice("abcd .\n") for _ in range(rng.randrange(0, 60))), lang) for i, lang in enumerate(["en"] * 40 + ["de"] * 25 + [None] * 3)]
    docs = documents(rows)
    got = {r["row"]["doc_id"]: r["log_perplexity"] for r in q.scored(docs, q.train(docs)).collect()}
    a = q.Alphabet()
    for lang in ("en", "de", None):
        own = {i: symbols(a, text) for i, text, x in rows if x == lang}
        p = brute_kneser_ney(Counter(g for grams in own.values() for g in grams), q.ORDER, q.ALPHABET)
        for i, grams in own.items():
            assert got[i] == pytest.approx(-sum(math.log(p(g)) for g in grams) / len(grams), rel=1e-4)


def test_other_texts_and_language_groups_are_scored(documents, monkeypatch):
    docs = documents([(i, "some plain words of english text here", "en") for i in range(5)] + [(9, "ein paar deutsche worte", "de")])
    model = q.train(docs)
    new = documents([(1, "zzz qqq", "en"), (2, "some plain words", "en"), (3, "bonjour", "fr"), (4, "deutsche worte", "de")])
    first = {r["row"]["doc_id"]: r["log_perplexity"] for r in q.scored(new, model).collect()}
    assert first[1] > first[2] and first[3] == pytest.approx(math.log(q.ALPHABET), rel=1e-3)
    monkeypatch.setattr(q, "GROUP_ENTRIES", 1)
    assert {r["row"]["doc_id"]: r["log_perplexity"] for r in q.scored(new, model).collect()} == first


def test_model_arrays_are_sorted(documents):
    import numpy as np

    for r in q.train(documents([(1, "abc abd abe", "en"), (2, "xyz", "de")])).collect():
        hashes = np.frombuffer(r["hashes"], "<u4")
        assert len(hashes) == r["entries"] == len(np.frombuffer(r["weights"], "<f4")) and (np.diff(hashes.astype(int)) > 0).all()


def test_verdicts(documents):
    rng = random.Random(6)
    syllables = ["ba", "ne", "lo", "tis", "ra", "mu", "ken", "da"]
    text = lambda n: " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(n))
    rows = [(i, text(60)) for i in range(300)]
    noise = "".join(rng.choice("qxzjvw#*") + rng.choice("qxzjvw ") for _ in range(200))
    rows += [(900, noise), (901, None), (902, ""), (903, "only a few words"), (904, "the same eight words come again and again " * 20), (905, text(60)), (905, text(60)), (None, text(60))]
    docs = documents(rows, clashing=True)
    got = [(r["doc_id"], r["kept"], r["base_failed"]) for r in q.quality_rules(docs).collect()]
    assert len(got) == len(rows) and all(kept for d, kept, _ in got if d is None or d < 900 or d == 905)
    assert {d: (kept, failed) for d, kept, failed in got if d in (900, 901, 902, 903, 904)} == {
        900: (False, False), 901: (False, True), 902: (False, True), 903: (False, True), 904: (False, True)
    }
    left = q.kept_documents(docs)
    assert left.columns == docs.columns and left.count() == 303
    assert q.quality_rules(documents([])).count() == 0


def test_clean_documents_of_tables_are_kept(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    out = q.quality_rules(docs).join(labels, "doc_id").filter("NOT base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    kept = {r["quality"]: r["kept"] for r in out}
    assert kept[1] >= 0.97 and kept[0] < kept[1]
