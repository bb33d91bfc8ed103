"""Phrase collocation mining with Rabin-Karp fingerprints of word n-grams.

Text is lower-cased (A-Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and into words ``[^\\x20\\x09]+``. Phrases lie within
a piece; everything is counted per language. The way there, with all arithmetic exact:

1. Prefix polynomials over the bytes of a chunk of text (numpy, modulo 2^64) give the fingerprint of every word, prefix
   polynomials over those the fingerprint of every n-gram, by one subtraction and one product each. Fingerprints include
   the language. First, words and pairs are counted by fingerprint alone, as sorted blocks for each range of
   fingerprints. The frequent ones set one bit each in a map of fixed size (FILTER_BITS, 16 MB), the only thing that is
   broadcast. Longer n-grams follow, a scan for each length, those whose parts all have a bit. A bit too many costs
   time, not rightness; none is missing.
2. In the last scan n-grams that have a bit are fingerprinted in two independent lanes (96 bits). In
   each chunk all occurrences of a fingerprint are compared byte by byte with the first; one that differs (a
   collision) stays apart. Sorted blocks of fingerprint, count and occurrence pointer (document, first byte) are shuffled
   by range of fingerprints, as byte planes, and summed.
3. Pointers of frequent fingerprints go back to their documents. Only there phrases become text; each text must give
   its fingerprint again, which also tells apart documents whose keys collide.
4. Cuts, scores and the removal of phrases inside longer ones are joins of the small table of frequent phrases.

A chunk is CHUNK_BYTES long at least and ends with a piece; tasks hold a chunk, FLUSH entries and one range of
fingerprints. Frequent words cost one entry for each task, so no fingerprint is hot.

Defined cases: NULL text is empty; NULL language is ``und``; repeated rows count each time; NULL and repeated ids are
allowed, since documents are told apart by a hash of id and text; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from leaguelake.llm.common import batches_of, mapped
from leaguelake.session import held

MIN_COUNT, MAX_WORDS, TOP = 10, 3, 2000
FILTER_BITS = 27
CHUNK_BYTES = 1 << 20
FLUSH = 1 << 21
# bits of a document's key in a pointer; a text must give its fingerprint again, which tells documents of one key apart
KEY_BITS = 40
# characters of all texts for each range of fingerprints
RANGE_CHARS = 8 << 20
UNKNOWN = "und"

BREAKS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
_NORMAL = bytes(32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
_KIND = np.array([2 if b in BREAKS else 1 if b in BLANKS else 0 for b in range(256)], np.uint8)
_BREAK, _RUN = re.compile(b"[" + re.escape(BREAKS) + b"]"), re.compile(b"  +")
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Lane:
    """Prefix polynomials with one odd base; two lanes have nothing in common."""

    def __init__(self, seed: int):
        values = _mix((np.arange(1, 259, dtype=np.uint64) + _U(seed * 1000)) * _U(0x9E3779B97F4A7C15))
        self.of_byte, self.base, self.salt = values[:256], int(values[256]) | 1, values[257]
        self.powers = self.inverse = np.zeros(0, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            steps = np.ones((2, n), np.uint64)
            steps[0, 1:], steps[1, 1:] = _U(self.base), _U(pow(self.base, -1, 1 << 64))
            self.powers, self.inverse = np.cumprod(steps, axis=1, dtype=np.uint64)

    def ranges(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The polynomial of each range of values, by differences of prefixes."""
        self._grow(len(values) + 1)
        prefix = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.powers[: len(values)], out=prefix[1:], dtype=np.uint64)
        return (prefix[ends] - prefix[starts]) * self.inverse[starts]

    def words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return _mix(self.ranges(self.of_byte[data], starts, ends) + (ends - starts).astype(np.uint64) * self.salt)

    def ngrams(self, words: np.ndarray, first: np.ndarray, n: int, language: np.ndarray) -> np.ndarray:
        return _mix(self.ranges(words, first, first + n) + language + _U(n * int(self.salt) % (1 << 64)))


_LANES = (_Lane(1), _Lane(2))


def normal(text: str) -> bytes:
    """UTF-8 with A-Z lower-cased and each run of blanks as one space; words and pieces stay the same."""
    return _RUN.sub(b" ", text.encode().translate(_NORMAL))


def language_hash(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode(), 11)


class Chunk:
    """Whole pieces of some documents, joined, with their words."""

    def __init__(self, parts: list[tuple[int, int, int, bytes]]):
        """``parts``: key of the document, hash of its language, place of the part in it, bytes."""
        self.data = np.frombuffer(b"\n".join(p[3] for p in parts), np.uint8)
        kinds = _KIND[self.data]
        inside = np.zeros(len(kinds) + 2, np.int8)
        inside[1:-1] = kinds == 0
        edges = np.diff(inside)
        self.starts, self.ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        self.piece = np.cumsum(kinds == 2, dtype=np.int32)[self.starts] if len(self.starts) else np.zeros(0, np.int32)
        lengths = np.array([len(p[3]) + 1 for p in parts], np.int64)
        begin = np.cumsum(lengths) - lengths
        part = np.searchsorted(begin, self.starts, "right") - 1
        self.keys = np.array([p[0] for p in parts], np.int64)[part]
        self.language = np.array([p[1] for p in parts], np.uint64)[part]
        self.places = self.starts - begin[part] + np.array([p[2] for p in parts], np.int64)[part]

    def firsts(self, n: int) -> np.ndarray:
        """Indexes of words at which n words of one piece begin."""
        last = len(self.starts) - n + 1
        return np.flatnonzero(self.piece[n - 1:] == self.piece[:last]) if last > 0 else np.zeros(0, np.int64)


def chunks(rows: Iterable[pa.RecordBatch]) -> Iterator[Chunk]:
    """Chunks of the documents (key, lang, text) of a task."""
    hashes: dict[str, int] = {}
    parts: list[tuple[int, int, int, bytes]] = []
    size = 0
    for _, (keys, langs, texts) in batches_of(rows, "key", "lang", "text"):
        for key, lang, text in zip(keys, langs, texts):
            code = hashes.get(lang)
            if code is None:
                code = hashes[lang] = language_hash(lang)
            data, at = normal(text), 0
            while at < len(data):
                cut = _BREAK.search(data, at + CHUNK_BYTES) if len(data) - at > CHUNK_BYTES else None
                end = cut.end() if cut else len(data)
                parts.append((key, code, at, data[at:end]))
                size, at = size + end - at, end
                if size >= CHUNK_BYTES:
                    yield Chunk(parts)
                    parts, size = [], 0
    if parts:
        yield Chunk(parts)


def _groups(order_of: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin in a sorted array."""
    return np.flatnonzero(np.concatenate(([True], order_of[1:] != order_of[:-1])))


def _planes(values: np.ndarray) -> bytes:
    """The bytes of the values by place: high bytes are alike in sorted or small values, so Spark's compression finds them."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def _from_planes(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).ravel()


def _ranges_of(fingerprints: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """Each range of sorted fingerprints that has any, by their first bits."""
    owner = (fingerprints >> _U(64 - bits)).astype(np.int64) if bits else np.zeros(len(fingerprints), np.int64)
    if len(owner):
        begin = _groups(owner)
        for a, b in zip(begin, [*begin[1:], len(owner)]):
            yield int(owner[a]), slice(int(a), int(b))


# --- first scans: fingerprints alone, counted up to the least count -------------------------------------------------------

def _has_bit(present: np.ndarray, fp: np.ndarray) -> np.ndarray:
    bit = (fp >> _U(64 - FILTER_BITS)).astype(np.int64)
    return (present[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1 == 1


def _levels(chunk: Chunk, words: np.ndarray, longest: int, present: np.ndarray | None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(n, first words, fingerprints) of the n-grams of each length whose shorter parts all have a bit; without a map, all."""
    known = np.ones(len(words), bool)
    for n in range(1, longest + 1):
        first = chunk.firsts(n)
        if n > 1:
            first = first[known[first] & known[first + 1]]
        fp = _LANES[0].ngrams(words, first, n, chunk.language[first])
        yield n, first, fp
        if present is not None:
            known = np.zeros(len(words), bool)
            known[first[_has_bit(present, fp)]] = True


def _saturated(fingerprints: list[np.ndarray], counts: list[np.ndarray], most: int) -> tuple[np.ndarray, np.ndarray]:
    every, n = np.concatenate(fingerprints), np.concatenate(counts)
    order = np.argsort(every, kind="stable")
    every, n = every[order], n[order].astype(np.int64)
    begin = _groups(every)
    return every[begin], np.minimum(np.add.reduceat(n, begin), most).astype(np.uint8)


def _count(bits: int, least: int, lengths: tuple[int, ...], shared):
    """Counts of the n-grams of some lengths; ``shared`` is the map of shorter ones."""
    most = min(least, 255)

    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present = shared.value if shared else None
        fingerprints: list[np.ndarray] = []
        counts: list[np.ndarray] = []

        def blocks(every: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            found = [(r, _planes(every[s]), n[s].tobytes()) for r, s in _ranges_of(every, bits)]
            for i in range(0, len(found), 64):
                part = list(zip(*found[i:i + 64]))
                yield pa.record_batch([pa.array(part[0], pa.int32()), pa.array(part[1], pa.binary()), pa.array(part[2], pa.binary())], ["range", "fingerprints", "counts"])

        waiting = 0
        for chunk in chunks(rows):
            words = _LANES[0].words(chunk.data, chunk.starts, chunk.ends)
            for n, first, fp in _levels(chunk, words, max(lengths), present):
                if n in lengths and len(first):
                    every, times = np.unique(fp, return_counts=True)
                    fingerprints.append(every)
                    counts.append(np.minimum(times, most).astype(np.uint8))
                    waiting += len(every)
            if waiting >= FLUSH:
                every, n = _saturated(fingerprints, counts, most)
                if len(every) > FLUSH // 2:
                    yield from blocks(every, n)
                    every, n = every[:0], n[:0]
                fingerprints, counts, waiting = [every], [n], len(every)
        if waiting:
            yield from blocks(*_saturated(fingerprints, counts, most))

    return run


def _by_range(rows: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, dict[str, list]]]:
    """The blocks of each range, from rows sorted by range."""
    now, held_blocks = None, {}
    for batch in rows:
        columns = batch.to_pydict()
        for i, r in enumerate(columns["range"]):
            if r != now:
                if held_blocks:
                    yield now, held_blocks
                now, held_blocks = r, {name: [] for name in columns}
            for name, values in columns.items():
                held_blocks[name].append(values[i])
    if held_blocks:
        yield now, held_blocks


def _frequent_bits(bits: int, least: int):
    """One row for each range of fingerprints: its part of the map of frequent ones."""
    most = min(least, 255)

    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r, blocks in _by_range(rows):
            every, n = _saturated(
                [_from_planes(b, np.uint64) for b in blocks["fingerprints"]], [np.frombuffer(b, np.uint8) for b in blocks["counts"]], most
            )
            flags = np.zeros(1 << (FILTER_BITS - bits), np.uint8)
            frequent = every[n >= most] >> _U(64 - FILTER_BITS)
            flags[frequent.astype(np.int64) - (r << (FILTER_BITS - bits))] = 1
            yield pa.record_batch([pa.array([r], pa.int32()), pa.array([np.packbits(flags).tobytes()], pa.binary())], ["range", "bits"])

    return run


def _frequent(docs: DataFrame, bits: int, least: int, lengths: tuple[int, ...], shared) -> np.ndarray:
    counted = mapped(docs, _count(bits, least, lengths, shared), "range int, fingerprints binary, counts binary")
    parts = mapped(counted.repartition("range").sortWithinPartitions("range"), _frequent_bits(bits, least), "range int, bits binary")
    out = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    width = len(out) >> bits
    for row in parts.toLocalIterator():  # 2^FILTER_BITS bits in all
        out[row["range"] * width:(row["range"] + 1) * width] = np.frombuffer(row["bits"], np.uint8)
    return out


def frequency_filter(docs: DataFrame, bits: int, least: int, longest: int) -> np.ndarray:
    """A map of 2^FILTER_BITS bits; every n-gram that is found ``least`` times or more has its bit set."""
    out = _frequent(docs, bits, least, (1, 2), None)
    for n in range(3, longest + 1):
        shared = docs.sparkSession.sparkContext.broadcast(out)
        out = out | _frequent(docs, bits, least, (n,), shared)
        shared.unpersist()
    return out


# --- last scan: fingerprints with pointers -------------------------------------------------------------------------------

_FIELDS = {"fp": np.uint64, "check": np.uint32, "key": np.uint64, "place": np.uint32, "words": np.uint8, "count": np.uint64}
BLOCKS = "range int, " + ", ".join(f"{name} binary" for name in _FIELDS)


def _same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether the ranges that begin at a and b agree, by pieces of bounded size."""
    out = np.ones(len(a), bool)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(a):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + (1 << 20), "right")))
        n = sizes[start:stop]
        begin = np.cumsum(n) - n
        inside = np.arange(int(n.sum())) - np.repeat(begin, n)
        wrong = data[np.repeat(a[start:stop], n) + inside] != data[np.repeat(b[start:stop], n) + inside]
        out[start:stop] = np.add.reduceat(wrong, begin) == 0
        start = stop
    return out


def _verified(chunk: Chunk, first: np.ndarray, n: int, fp: np.ndarray, check: np.ndarray) -> dict[str, np.ndarray]:
    """One entry for each fingerprint of a chunk; occurrences whose text differs from the first one's stay apart."""
    order = np.argsort(fp, kind="stable")
    first, fp, check = first[order], fp[order], check[order]
    start, size = chunk.starts[first], chunk.ends[first + n - 1] - chunk.starts[first]
    begin = _groups(fp)
    leader = np.repeat(begin, np.diff([*begin, len(fp)]))
    same = (size == size[leader]) & (chunk.language[first] == chunk.language[first[leader]])
    at = np.flatnonzero(same & (leader != np.arange(len(fp))))
    same[at] = _same_bytes(chunk.data, start[at], start[leader[at]], size[at])
    counts = np.where(same, 0, 1)
    counts[begin] = np.add.reduceat(same.astype(np.int64), begin)
    keep = np.flatnonzero(counts)
    return {
        "fp": fp[keep], "check": check[keep].astype(np.uint32), "key": chunk.keys[first[keep]].astype(np.uint64),
        "place": chunk.places[first[keep]].astype(np.uint32), "words": np.full(len(keep), n, np.uint8), "count": counts[keep].astype(np.uint64),
    }


def _summed(entries: dict[str, list[np.ndarray]]) -> dict[str, np.ndarray]:
    """Entries with the same bits in both lanes as one, with the pointer into the document of the least key."""
    every = {name: np.concatenate(parts) for name, parts in entries.items()}
    order = np.lexsort((every["place"], every["key"], every["check"], every["fp"]))
    every = {name: values[order] for name, values in every.items()}
    begin = np.flatnonzero(np.concatenate(([True], (every["fp"][1:] != every["fp"][:-1]) | (every["check"][1:] != every["check"][:-1]))))
    total = np.add.reduceat(every["count"], begin)
    return {name: values[begin] for name, values in every.items()} | {"count": total}


def _point(bits: int, max_words: int, shared):
    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present = shared.value

        entries: dict[str, list[np.ndarray]] = {name: [] for name in _FIELDS}
        waiting = 0

        def blocks(every: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
            found = list(_ranges_of(every["fp"], bits))
            for i in range(0, len(found), 64):
                some = found[i:i + 64]
                columns = [pa.array([_planes(every[name][s].astype(kind)) for _, s in some], pa.binary()) for name, kind in _FIELDS.items()]
                yield pa.record_batch([pa.array([r for r, _ in some], pa.int32()), *columns], ["range", *_FIELDS])

        for chunk in chunks(rows):
            words = [lane.words(chunk.data, chunk.starts, chunk.ends) for lane in _LANES]
            for n, first, fp in _levels(chunk, words[0], max_words, present):
                known = _has_bit(present, fp)
                first, fp = first[known], fp[known]
                if len(first):
                    check = _LANES[1].ngrams(words[1], first, n, chunk.language[first])
                    for name, values in _verified(chunk, first, n, fp, check).items():
                        entries[name].append(values)
                    waiting += len(entries["fp"][-1])
            if waiting >= FLUSH:
                every = _summed(entries)
                if len(every["fp"]) > FLUSH // 2:
                    yield from blocks(every)
                    every = {name: values[:0] for name, values in every.items()}
                entries = {name: [values] for name, values in every.items()}
                waiting = len(every["fp"])
        if waiting:
            yield from blocks(_summed(entries))

    return run


POINTERS = "key bigint, fp bigint, check bigint, place bigint, words int, count bigint"

POINTED = [field.split()[0] for field in POINTERS.split(", ")]
_WORD = b"[^ " + re.escape(BREAKS) + b"]+"


def _frequent_pointers(least: int):
    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, blocks in _by_range(rows):
            every = _summed({name: [_from_planes(b, kind) for b in blocks[name]] for name, kind in _FIELDS.items()})
            every = {name: values[every["count"] >= least] for name, values in every.items()}
            for start in range(0, len(every["fp"]), 1 << 16):
                part = {name: values[start:start + (1 << 16)] for name, values in every.items()}
                columns = [part["fp"].view(np.int64) if name == "fp" else part[name].astype(np.int32 if name == "words" else np.int64) for name in POINTED]
                yield pa.record_batch([pa.array(c) for c in columns], POINTED)

    return run


def _texts_of(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pointers (lang, at, text) as phrases; those whose text has another fingerprint belong to another document of that key."""
    for _, (langs, pointers, texts) in batches_of(rows, "lang", "at", "text"):
        for lang, points, text in zip(langs, pointers, texts):
            data = normal(text)
            at = {n: re.compile(_WORD + b"(?: " + _WORD + b"){%d}" % (n - 1)) for n in {p["words"] for p in points}}
            phrases = [found[0] if (found := at[p["words"]].match(data, p["place"])) else b"" for p in points]
            code = language_hash(lang)
            chunk = Chunk([(0, code, 0, p) for p in phrases])
            words = [lane.words(chunk.data, chunk.starts, chunk.ends) for lane in _LANES]
            n_words = np.array([len(p.split(b" ")) if p else 0 for p in phrases])
            begin = np.cumsum(n_words) - n_words
            out = []
            for n in np.unique([p["words"] for p in points]):
                mine = [i for i, p in enumerate(points) if p["words"] == n and n_words[i] == n]
                if len(chunk.starts) != n_words.sum() or not mine:
                    continue  # a place inside another text
                first = begin[mine]
                fp, check = (lane.ngrams(words[k], first, int(n), np.full(len(mine), code, np.uint64)).view(np.int64) for k, lane in enumerate(_LANES))
                out += [(int(n), phrases[i].decode(errors="replace"), points[i]["count"]) for i, a, b in zip(mine, fp, check) if (points[i]["fp"], points[i]["check"]) == (a, b % (1 << 32))]
            if out:
                ns, found, counts = zip(*out)
                yield pa.record_batch([pa.array([lang] * len(out)), pa.array(ns, pa.int32()), pa.array(found), pa.array(counts, pa.int64())], ["lang", "words", "phrase", "f"])


def _prepared(documents: DataFrame, text: str, lang: str, doc_id: str) -> DataFrame:
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return documents.select(
        F.xxhash64(F.col(doc_id), whole).bitwiseAND(F.lit((1 << KEY_BITS) - 1)).alias("key"), F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), whole.alias("text")
    )


def frequent_phrases(
    documents: DataFrame, *, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", min_count: int = MIN_COUNT, max_words: int = MAX_WORDS
) -> DataFrame:
    """(lang, words, phrase, f) for all phrases of 1 to ``max_words`` words found ``min_count`` times or more in a language."""
    if not 2 <= min_count <= 255 or max_words < 2:
        raise ValueError("min_count from 2 to 255 and two words at least")
    docs = _prepared(documents, text, lang, doc_id)
    total = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    bits = min(FILTER_BITS - 3, max(3, math.ceil(math.log2(max(1, total / RANGE_CHARS)))))
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(frequency_filter(docs, bits, min_count, max_words))
    blocks = mapped(docs, _point(bits, max_words, shared), BLOCKS).repartition("range").sortWithinPartitions("range")
    pointers = held(mapped(blocks, _frequent_pointers(min_count), POINTERS), "pointers")
    by_document = pointers.groupBy("key").agg(F.collect_list(F.struct("fp", "check", "place", "words", "count")).alias("at"))
    found = mapped(docs.join(by_document, "key").select("lang", "at", "text"), _texts_of, "lang string, words int, phrase string, f bigint")
    # a repeated document gives the same phrase again
    return found.groupBy("lang", "words", "phrase").agg(F.max("f").alias("f"))


def word_totals(documents: DataFrame, *, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, n): all word occurrences of a language."""
    words = F.regexp_count(F.col(text).cast("string"), F.lit(r"[^ \t\n\x0B\f\r.,;:!?]+"))
    return documents.groupBy(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang")).agg(
        F.coalesce(F.sum(words), F.lit(0)).cast("bigint").alias("n")
    )


def _exact(column: str) -> Column:
    return F.col(column).cast("decimal(16,0)")


def collocations(
    documents: DataFrame, *, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", min_count: int = MIN_COUNT, max_words: int = MAX_WORDS,
    top: int = TOP, covered_percent: int = 50
) -> DataFrame:
    """Each language's best phrases: lang, rank, phrase, a, l, r, n, score.

    score is floor(1000000 * a * a / (l * r)) at the cut of the phrase with the least score; l and r are the counts of
    both parts. Phrases that lie inside a longer one with ``covered_percent`` of their count are left out. Counts
    below 10^16 are exact.
    """
    phrases = held(frequent_phrases(documents, text=text, lang=lang, doc_id=doc_id, min_count=min_count, max_words=max_words), "phrases")
    candidates = phrases.filter("words >= 2").select("lang", "phrase", "words", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    cuts = candidates.select("lang", "phrase", "words", "a", "w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("w", F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("right"),
    )
    parts = phrases.select("lang", "phrase", "f")
    scored = (
        cuts.join(parts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
        .join(parts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
        .withColumn("product", F.lit(1000000).cast("decimal(7,0)") * _exact("a") * _exact("a"))
        .withColumn("score", F.expr("product div (cast(l as decimal(16,0)) * cast(r as decimal(16,0)))"))
    )
    lowest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("cut")).select("lang", "phrase", "cut.*")
    lengths = F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("m")
    inside = (
        candidates.filter("words > 2").select("lang", "words", "a", "w", lengths)
        .select("lang", "a", "w", "m", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("m") + 1)).alias("i"))
        .groupBy("lang", F.array_join(F.slice("w", F.col("i"), F.col("m")), " ").alias("phrase")).agg(F.max("a").alias("longer"))
    )
    kept = lowest.join(inside, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (_exact("longer") * 100 < _exact("a") * covered_percent)
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    totals = word_totals(documents, text=text, lang=lang)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\f\r]')) AS piece
  FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w FROM pieces),
grams AS (
  SELECT lang, m, unnest(list_transform(range(1, greatest(1, len(w) - m + 2)), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
  FROM worded, (VALUES (1), (2), (3)) AS sizes(m)),
phrases AS (SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 10),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM worded GROUP BY lang),
candidates AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM phrases WHERE m >= 2),
cuts AS (
  SELECT lang, m, phrase, a, k, array_to_string(w[1:k], ' ') AS lp, array_to_string(w[k + 1:m], ' ') AS rp
  FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates)),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r,
         (1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f) AS score
  FROM cuts c JOIN phrases x ON x.lang = c.lang AND x.phrase = c.lp JOIN phrases y ON y.lang = c.lang AND y.phrase = c.rp),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, a, array_to_string(w[i:i + 1], ' ') AS phrase FROM (SELECT *, unnest([1, 2]) AS i FROM candidates WHERE m = 3))
  GROUP BY ALL),
kept AS (
  SELECT s.* FROM lowest s LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR longer::HUGEINT * 100 < s.a::HUGEINT * 50)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n,
       CAST(score AS BIGINT) AS score
FROM kept JOIN totals USING (lang)
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) <= 2000
"""
