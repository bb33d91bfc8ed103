import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from leaguelake.llm import simhash_dedup as s


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    """component of each (doc_id, fingerprint) row by comparing all pairs."""
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, (_, a) in enumerate(rows):
        for j in range(i):
            if (a ^ rows[j][1]).bit_count() <= 3:
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return [least.get(find(i)) for i in range(len(rows))]


def check(documents, rows):
    out = s.near_duplicates(documents(rows, clashing=True)).collect()
    prints = [fingerprint(text) for _, text in rows]
    expected = sorted(zip([d for d, _ in rows], ["%016x" % p for p in prints], brute_components(list(zip([d for d, _ in rows], prints)))), key=str)
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in out), key=str) == expected


def test_tables_against_brute_force(documents, sample):
    check(documents, [(r["doc_id"], r["text"]) for r in sample.collect()])


def test_defined_cases(spark, documents):
    check(documents, [(5, None), (3, ""), (9, "\t \n"), (1, "One"), (2, "one"), (2, "one"), (7, "a b"), (None, "lonely words stand here alone"), (4, "x y z"), (6, "Ärger MIT Ä")])
    assert s.near_duplicates(documents([])).count() == 0


def test_every_link_within_the_radius_counts(spark, monkeypatch):
    """Chains and dense groups, in one large bucket too; slices and units of all sizes."""
    rng = random.Random(1)
    centres = [rng.getrandbits(64) for _ in range(40)]
    values = set(centres)
    for c in centres[:20]:
        for _ in range(30):
            c ^= 1 << rng.randrange(64) | 1 << rng.randrange(64) | 1 << rng.randrange(64)
            values.add(c)
    values |= {centres[0] ^ 1 << i ^ 1 << j for i in range(20) for j in range(20, 40)}
    rows = sorted((i, v) for i, v in enumerate(sorted(values)))
    signed = [(i, int(np.uint64(v).astype(np.int64))) for i, v in rows]
    expected = brute_components(rows)
    for size in (s.SLICE, 50):
        monkeypatch.setattr(s, "SLICE", size)
        prints = spark.createDataFrame(signed, "doc_id bigint, fingerprint bigint").select(
            F.struct("doc_id", F.struct(F.col("doc_id").alias("id")).alias("key")).alias("row"), "fingerprint"
        )
        got = {r["fingerprint"]: r["component_id"] for r in s.classes(prints).collect()}
        assert [got[v] for _, v in signed] == expected


def test_bit_sliced_distances():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 1, dtype=np.uint64)[0]
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, k, replace=False)) for k in rng.integers(0, 8, 300)], np.uint64)
    values = flips ^ base
    for radius in (0, 1, 3, 5):
        planes = s.planes_of(values)
        ask = [np.where(base >> np.uint64(b) & np.uint64(1), s.FULL, np.uint64(0)) for b in range(64)]
        near = s.within(lambda b, at: (planes[b] if at is None else planes[b][at]) ^ ask[b], s.packed(np.ones(300, np.uint8)), radius)
        assert np.array_equal(s.unpacked(near, 300), np.bitwise_count(flips) <= radius)


def test_first_of_each_component(documents):
    text = "the quick brown fox jumps over the lazy dog near the river bank"
    docs = documents([(4, text), (2, text), (2, text), (9, "another text with quite other words inside"), (None, text), (11, None)], clashing=True)
    left = s.first_of_each(docs)
    assert left.columns == docs.columns and sorted(r["doc_id"] for r in left.collect()) == [2, 9, 11]
