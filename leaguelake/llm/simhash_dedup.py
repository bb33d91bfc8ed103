"""SimHash near-dedup with bit-sliced comparison.

A text's fingerprint has a bit set where more than half of its shingle hashes have it. Fingerprints that differ in at
most ``radius`` bits are linked; documents whose fingerprints are connected by links are one component.

Candidates. The 64 bits are cut into ``radius + 2`` blocks. Two fingerprints within the radius agree in at least two
blocks, so each pair of blocks gives a table keyed by the values of both, and every link is found in some bucket of
some table: no link is lost. Only different fingerprints are compared; copies share one.

Comparison. The fingerprints of a bucket are stored as bit planes (plane b holds bit b of 64 fingerprints in a word). For
each plane the differing bits are added to vertical counters with carry-save adders, two planes at a time, for 64
distances at once. The counters start so that they overflow exactly beyond the radius; words in which all 64
distances have overflowed are abandoned.

Skew. A bucket with more than SLICE fingerprints is cut into slices by hash, and every pair of slices is a unit of its
own, so no task holds a large bucket. A unit returns a star for each of its components instead of its pairs.

Defined cases. NULL and empty texts have no words and fingerprint zero, linked like any other. Repeated rows have equal
fingerprints and meet in one component. A component whose documents all have NULL ids has a NULL id. An empty table
gives an empty result. Columns other than ``doc_id`` and ``text`` may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from leaguelake.llm.common import batches_of, document_key, mapped
from leaguelake.llm.components import components
from leaguelake.session import held

BITS = 64
SHINGLE = 3
RADIUS = 3
SEED = 42
SLICE = 4096
SMALL_UNIT = 64
WORD = re.compile(rb"[^\x20\x09-\x0D]+")  # fixed by the contract
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_hashes(text: bytes, size: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """XXH64 of all word shingles, repeats included; bytes.lower() changes A-Z only."""
    words = WORD.findall(text.lower())
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed)], np.uint64)
    joined = b" ".join(words)
    ends, at = [], -1
    for word in words:
        at += len(word) + 1
        ends.append(at)
    starts = [0, *[end + 1 for end in ends[:-1]]]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[s:e], seed) for s, e in zip(starts, ends[size - 1 :])), np.uint64, len(words) - size + 1)


def majority(hashes: np.ndarray, block: int = 1 << 16) -> int:
    """Bits set in over half of the hashes."""
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), block):
        part = hashes[at : at + block].astype("<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    over = 2 * counts > len(hashes)
    return int(sum(1 << int(b) for b in np.flatnonzero(over)))


def _fingerprint_rows(size: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, (texts,) in batches_of(rows, "text"):
            prints = np.array([majority(shingle_hashes(t or b"", size)) for t in texts], np.uint64)
            yield pa.record_batch([piece.column(0), pa.array(prints.view(np.int64))], names=["row", "fingerprint"])

    return run


def fingerprints(docs: DataFrame, row: Column, size: int = SHINGLE) -> DataFrame:
    """(row, fingerprint) of every document; ``row`` is a struct of what is to be carried along."""
    texts = docs.select(row.alias("row"), F.col("text").cast("string").cast("binary").alias("text"))
    schema = StructType([texts.schema["row"], StructField("fingerprint", LongType())])
    return mapped(texts, _fingerprint_rows(size), schema)


def planes_of(values: np.ndarray) -> np.ndarray:
    """Bit planes: row b holds bit b of all values, 64 values to a word."""
    bits = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T
    return packed(bits)


def packed(bits: np.ndarray) -> np.ndarray:
    width = -(-bits.shape[-1] // BITS) * BITS
    padded = np.zeros((*bits.shape[:-1], width), np.uint8)
    padded[..., : bits.shape[-1]] = bits
    return np.packbits(padded, axis=-1, bitorder="little").view("<u8")


def unpacked(words: np.ndarray, n: int) -> np.ndarray:
    return np.unpackbits(words.astype("<u8").view(np.uint8), axis=-1, bitorder="little")[..., :n].astype(bool)


def within(differing: Callable[[int, np.ndarray | None], np.ndarray], valid: np.ndarray, radius: int) -> np.ndarray:
    """Words whose bits say which distances are at most ``radius``.

    ``differing(b, index)`` gives the differing bits of plane b for the words ``index`` (all of them if None); only
    distances marked in ``valid`` count.
    """
    size = max(1, radius.bit_length())
    offset = (1 << size) - 1 - radius
    counters = [np.full_like(valid, FULL if offset >> j & 1 else 0) for j in range(size)]
    over, index, out = ~valid, None, np.zeros_like(valid)
    for b in range(0, BITS, 2):
        first, second = differing(b, index), differing(b + 1, index)
        half = counters[0] ^ first
        carry = (counters[0] & first) | (half & second)
        counters[0] = half ^ second
        for j in range(1, size):
            carry, counters[j] = counters[j] & carry, counters[j] ^ carry
        over |= carry
        if b % 8 == 6:
            live = np.flatnonzero(over != FULL)
            if not len(live):
                return out
            if 2 * len(live) < len(over):
                index = live if index is None else index[live]
                over, counters = over[live], [c[live] for c in counters]
    out[slice(None) if index is None else index] = ~over
    return out


def _labels_of_pairs(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Least index in each item's component."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def small_units(values: np.ndarray, unit: np.ndarray, radius: int) -> np.ndarray:
    """Labels over consecutive units, comparing each value with the one ``d`` places on, for all places at once."""
    n, lefts, rights = len(values), [], []
    bits = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T
    for d in range(1, n):
        same = unit[:-d] == unit[d:]
        if not same.any():
            break
        a, b = packed(bits[:, : n - d]), packed(bits[:, d:])
        near = within(lambda p, at: a[p] ^ b[p] if at is None else a[p][at] ^ b[p][at], packed(same.astype(np.uint8)), radius)
        found = np.flatnonzero(unpacked(near, n - d))
        lefts.append(found)
        rights.append(found + d)
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return _labels_of_pairs(n, join(lefts), join(rights))


def large_unit(values: np.ndarray, radius: int, rows: int = 128) -> np.ndarray:
    """Labels of one unit, comparing ``rows`` values at a time with all values."""
    n, label = len(values), np.arange(len(values))
    planes = planes_of(values)
    width = planes.shape[1]
    whole = packed(np.ones(n, np.uint8))
    for start in range(0, n, rows):
        own = values[start : start + rows]
        ask = [np.where(own >> np.uint64(b) & np.uint64(1), FULL, np.uint64(0)) for b in range(BITS)]

        def differing(b: int, at: np.ndarray | None) -> np.ndarray:
            if at is None:
                return (planes[b][None, :] ^ ask[b][:, None]).ravel()
            return planes[b][at % width] ^ ask[b][at // width]

        near = within(differing, np.tile(whole, len(own)), radius).reshape(len(own), width)
        for hits in unpacked(near, n):
            roots = np.unique(label[hits])
            if len(roots) > 1:
                label[np.isin(label, roots)] = roots[0]
    return label


def _stars(radius: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Links (u, v) of sorted (unit, fingerprint) rows; units may run over several batches."""

    def solve(unit: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
        cuts = np.flatnonzero(np.append(True, unit[1:] != unit[:-1]))
        sizes = np.diff(np.append(cuts, len(unit)))
        number = np.repeat(np.arange(len(cuts)), sizes)
        is_small = np.repeat(sizes <= SMALL_UNIT, sizes)
        parts = [(values[is_small], small_units(values[is_small], number[is_small], radius))] if is_small.any() else []
        for start, size in zip(cuts, sizes):
            if size > SMALL_UNIT:
                own = values[start : start + size]
                parts.append((own, large_unit(own, radius)))
        for own, label in parts:
            linked = np.flatnonzero(label != np.arange(len(label)))
            if len(linked):
                yield pa.record_batch({"u": own[linked].view(np.int64), "v": own[label[linked]].view(np.int64)})

    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_unit, kept_values = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in rows:
            if not batch.num_rows:
                continue
            unit = np.concatenate([kept_unit, batch.column(0).to_numpy()])
            values = np.concatenate([kept_values, batch.column(1).to_numpy().view(np.uint64)])
            last = int(np.flatnonzero(np.append(True, unit[1:] != unit[:-1]))[-1])
            if last:
                yield from solve(unit[:last], values[:last])
            kept_unit, kept_values = unit[last:], values[last:]
        if len(kept_unit):
            yield from solve(kept_unit, kept_values)

    return run


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (u, v) that connect all of the different ``fingerprint`` values within ``radius`` bits of each other."""
    blocks = radius + 2
    edges = [BITS * i // blocks for i in range(blocks + 1)]

    def block(i: int) -> Column:
        low, size = edges[i], edges[i + 1] - edges[i]
        return F.shiftrightunsigned("fingerprint", low).bitwiseAND(F.lit((1 << size) - 1))

    tables = [F.xxhash64(F.lit(t), block(i), block(j)) for t, (i, j) in enumerate(combinations(range(blocks), 2))]
    keyed = distinct.select("fingerprint", F.explode(F.array(*tables)).alias("bucket"))
    sizes = held(keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "buckets")
    cut = keyed.join(sizes, "bucket").withColumn("slices", F.ceil(F.col("n") / SLICE).cast("int"))
    own = F.pmod(F.xxhash64(F.lit(-1), "fingerprint"), F.col("slices")).cast("int")
    units = cut.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    unit = F.when(F.col("slices") == 1, F.col("bucket")).otherwise(
        F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other"))
    )
    dealt = units.select(unit.alias("unit"), "fingerprint").repartition("unit").sortWithinPartitions("unit", "fingerprint")
    return mapped(dealt, _stars(radius), "u bigint, v bigint")


def classes(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fingerprint, component_id, first) from (row with doc_id and key, fingerprint).

    ``first`` is the key of the component's first document: lowest id, NULL last, then lowest key.
    """
    first = F.min(F.struct(F.col("row.doc_id").isNull().alias("no_id"), F.col("row.doc_id").alias("doc_id"), F.col("row.key").alias("key")))
    distinct = held(prints.groupBy("fingerprint").agg(first.alias("first")), "fingerprints")
    roots = held(components(links(distinct.select("fingerprint"), radius)).select(F.col("node").alias("fingerprint"), "root"), "roots")
    labelled = distinct.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    firsts = held(labelled.groupBy("root").agg(F.min("first").alias("least")), "firsts")
    joined = labelled.select("fingerprint", "root").join(firsts, "root")
    return held(
        joined.select("fingerprint", F.col("least.doc_id").alias("component_id"), F.col("least.key").alias("first")), "classes"
    )


def near_duplicates(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every document."""
    prints = held(fingerprints(docs, F.struct("doc_id", document_key().alias("key")), size), "prints")
    joined = prints.join(classes(prints, radius), "fingerprint")
    return joined.select(
        F.col("row.doc_id").alias("doc_id"), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def first_of_each(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that are the first document of their component, once each."""
    prints = held(fingerprints(docs, F.struct("doc_id", document_key().alias("key")), size), "prints")
    first = classes(prints, radius).select(F.col("first").alias("key")).distinct()
    rows = docs.select(F.struct("*").alias("row"), document_key().alias("key")).join(first, "key", "left_semi")
    return rows.dropDuplicates(["key"]).select("row.*")
