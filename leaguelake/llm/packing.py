"""Packing by optimal length buckets.

A document's length is its number of tokens with the end id. The lengths of all documents make a global histogram on a grid
with DETAIL steps for each doubling (exact up to twice DETAIL tokens), so it has at most a few thousand entries whatever the
input, and only it reaches the driver. Dynamic programming over the histogram chooses the ``buckets`` upper bounds,
from the grid, that minimise all padding. Inside a bucket documents are put in a seeded random order, numbered, and cut into
batches of ``budget // bound`` documents, so a batch never exceeds the token budget; a document longer than the
budget is a batch of its own, whole.

Numbers within a bucket come from a range-partitioned sort, so a bucket may hold any share of the documents.

Defined cases. NULL and empty texts have the end id alone. Repeated rows are packed as often as they occur. An empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from leaguelake.llm.common import batches_of, mapped
from leaguelake.llm.tokens import Encoder, tokenizer_json
from leaguelake.operators.ordered import number_rows
from leaguelake.session import held

DETAIL = 128
BUCKETS = 16
BUDGET = 32_768
SEED = 7


def _count_rows(sent) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.here(sent.value)
        for piece, (texts,) in batches_of(rows, "text"):
            n = [len(ids) // encoder.dtype.itemsize + 1 for ids in encoder.encode([t or "" for t in texts])]
            yield pa.record_batch([piece.column(0), piece.column(1), pa.array(n, pa.int64())], names=["doc_id", "tie", "n_tokens"])

    return run


def token_lengths(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, tie, n_tokens); ``tie`` is a hash of the text."""
    sent = docs.sparkSession.sparkContext.broadcast(tokenizer_json(tokenizer))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("tie"), F.col("text").cast("string").alias("text"))
    return mapped(rows, _count_rows(sent), "doc_id bigint, tie bigint, n_tokens bigint")


def on_grid(length: Column) -> Column:
    """The least grid value not below a positive ``length``: DETAIL steps for each doubling."""
    step = F.greatest(F.lit(0), F.length(F.bin(length - 1)) - DETAIL.bit_length())
    size = F.pow(F.lit(2.0), step).cast("bigint")
    return (F.ceil(length / size) * size).cast("bigint")


def optimal_bounds(values: list[int], counts: list[int], buckets: int) -> list[int]:
    """At most ``buckets`` of the ascending ``values``, the last one among them, that minimise the sum of each count's next bound."""
    value, total = np.array(values, np.float64), np.concatenate([[0.0], np.cumsum(counts, dtype=np.float64)])
    m = len(values)
    if not m:
        return []
    best = np.concatenate([[0.0], np.full(m, np.inf)])
    choice = np.zeros((min(buckets, m), m + 1), np.int64)
    for k in range(min(buckets, m)):
        new = np.full(m + 1, np.inf)
        new[0] = 0.0
        for j in range(1, m + 1):
            cost = best[:j] + (total[j] - total[:j]) * value[j - 1]
            at = int(np.argmin(cost))
            new[j], choice[k, j] = cost[at], at
        best = new
    bounds, j = [], m
    for k in reversed(range(min(buckets, m))):
        if j == 0:
            break
        bounds.append(int(values[j - 1]))
        j = int(choice[k, j])
    return bounds[::-1]


def pack(docs: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET, tokenizer: str | None = None, seed: int = SEED) -> DataFrame:
    """doc_id, n_tokens, bucket, bucket_tokens (its bound), batch (within the bucket), place (within the batch) and padding."""
    lengths = held(token_lengths(docs, tokenizer).withColumn("grid", on_grid(F.col("n_tokens"))), "lengths")
    histogram = lengths.groupBy("grid").agg(F.count(F.lit(1)).alias("n")).orderBy("grid").collect()
    bounds = optimal_bounds([r["grid"] for r in histogram], [r["n"] for r in histogram], buckets)
    bucket = sum([(F.col("grid") > b).cast("int") for b in bounds[:-1]], F.lit(0))
    placed = lengths.withColumn("bucket", bucket).withColumn("mix", F.xxhash64(F.lit(seed), "doc_id", "tie"))
    numbered = number_rows(placed.drop("grid"), ["bucket"], [F.col("mix"), F.col("doc_id"), F.col("tie"), F.col("n_tokens")], "number")
    bound = F.element_at(F.array(*[F.lit(b).cast("bigint") for b in bounds or [1]]), F.col("bucket") + 1)
    capacity = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.col("bucket_tokens"))).cast("bigint")
    at = F.col("number") - 1
    return (
        numbered.withColumn("bucket_tokens", bound)
        .withColumn("capacity", capacity)
        .select(
            "doc_id", "n_tokens", "bucket", "bucket_tokens", F.floor(at / F.col("capacity")).cast("bigint").alias("batch"),
            (at % F.col("capacity")).alias("place"), (F.col("bucket_tokens") - F.col("n_tokens")).alias("padding"),
        )
    )
