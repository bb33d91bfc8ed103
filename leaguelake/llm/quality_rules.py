"""Quality rules with n-gram perplexity.

A character n-gram model with modified Kneser-Ney smoothing is counted by Spark over all documents of a language.
Every task counts the n-grams of its own documents in arrays, Spark adds the counts up, derives the lower orders
(numbers of distinct left neighbours), the discounts and the smoothed probabilities, and stores them as arrays of
n-gram hashes in ascending order with their probabilities. The documents are then scored with the arrays of their
language, and those outside the perplexity band of their language are rejected.

Size of the model. Every character is a symbol of its own: characters are counted over all documents and numbered, so an
n-gram of ORDER symbols is one 64-bit number, without collisions. Only case is folded, and all white space is one symbol. Languages
are scored in groups whose arrays stay below GROUP_ENTRIES; more languages give more groups, each with a scan of its own
documents. A language with more than LARGE_ENTRIES n-grams (many thousand characters) is sent nowhere: its documents' n-grams
are joined to the model. The counts themselves cover all documents.

Defined cases. NULL text counts as empty. A NULL ``lang`` counts as the empty name. An empty text has no words and fails
the base rules. The range of every language is averaged with that of all documents, which weighs as much as BAND_DOCS
documents: one rule for languages of any size. Repeated rows are scored row by row and get equal verdicts. Columns other
than ``doc_id``, ``text`` and ``lang`` are carried along untouched and may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from leaguelake.llm.common import batches_of, mapped, slices, starts_of
from leaguelake.session import held

ORDER = 4
CODE_POINTS = 0x110000
ALPHABET = 55_108  # the most symbols whose n-grams are 64-bit numbers
SINGLE = 50_000  # characters with a symbol of their own; the rarer ones are told apart by two
GROUP_ENTRIES = 1 << 23
LARGE_ENTRIES = 1 << 23
LEAST = 1e-12  # smallest probability
HELD_ENTRIES = 1 << 22  # counts that a task holds
BAND_DOCS = 50
MAX_BROADCAST_LANGUAGES = 10_000
# width of a band: quartiles of the scaled log-perplexity, moved out by SPREAD interquartile ranges
SPREAD = 4.0
ROUNDING = 1e-9
MIN_WORDS = 20
WINDOW = 8
MAX_REPEAT_PERCENT = 30
SYMBOLS = "#*$%&|<>"  # fixed by the contract
WORD = re.compile(r"[^\x20\x09-\x0D]+")  # fixed by the contract

SPACE, FIRST_LETTER, FIRST_COUNTED, UNKNOWN = 0, 1, 27, ALPHABET - 1


@cache
def _normal() -> tuple[np.ndarray, np.ndarray]:
    """For every code point the one it counts as (lower case, a space for white space), and whether its runs count in full."""
    normal, in_full = np.arange(CODE_POINTS, dtype=np.uint32), np.ones(CODE_POINTS, bool)
    for code in range(0x20000):  # no case and no white space beyond
        char = chr(code)
        normal[code] = ord(" ") if char.isspace() else ord(char.lower()[0])
        in_full[code] = char.isalnum()
    return normal, in_full


def _codes(texts: list[str]) -> np.ndarray:
    return _normal()[0][np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)]


class Alphabet:
    """Symbols of characters: the space, a to z, the given code points in their order, and one for all not among these.

    Runs of spaces or marks count once.
    """

    def __init__(self, codes: Iterable[int] = ()) -> None:
        codes = np.asarray(codes, np.int64)
        self.symbol = np.full(CODE_POINTS, UNKNOWN, np.int32)
        self.symbol[ord(" ")] = SPACE
        self.symbol[ord("a") : ord("z") + 1] = np.arange(FIRST_LETTER, FIRST_COUNTED)
        number = np.arange(FIRST_COUNTED, FIRST_COUNTED + len(codes))
        self.symbol[codes] = np.where(number < SINGLE, number, SINGLE + number // SINGLE - 1)
        # second symbols of the code points beyond SINGLE
        self.second = np.full(CODE_POINTS if number.size and number[-1] >= SINGLE else 0, -1, np.int32)
        if len(self.second):
            self.second[codes] = np.where(number < SINGLE, -1, number % SINGLE)

    def grams(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """n-gram hashes of all texts, and where each text's begin. A text is preceded by ORDER - 1 spaces and ended by one."""
        code = _codes(texts)
        begin = starts_of([len(t) for t in texts])
        first = np.zeros(len(code), bool)
        first[begin[:-1][begin[:-1] < len(code)]] = True
        kept = _normal()[1][code] | first
        kept[1:] |= code[1:] != code[:-1]
        kept[first & (code == ord(" "))] = False
        length = kept.astype(np.int64)
        if len(self.second):
            length[kept & (self.second[code] >= 0)] = 2
        counts = np.add.reduceat(np.append(length, 0), begin[:-1]) if len(texts) else np.zeros(0, np.int64)
        counts[begin[1:] == begin[:-1]] = 0
        symbol = np.repeat(self.symbol[code], length)
        if len(self.second):
            ends = np.cumsum(length)[length == 2] - 1
            symbol[ends] = self.second[code[length == 2]]
        own = starts_of(counts)
        padded = np.zeros(len(symbol) + ORDER * len(texts), np.int64)
        document = np.repeat(np.arange(len(texts)), counts)
        padded[np.arange(len(symbol)) + (document + 1) * (ORDER - 1) + document] = symbol
        gram = np.zeros(len(padded) - ORDER + 1, np.int64) if len(padded) else np.zeros(0, np.int64)
        for k in range(ORDER if len(padded) else 0):
            gram = gram * ALPHABET + padded[k : len(padded) - ORDER + 1 + k]
        begins = own + np.arange(len(texts) + 1) * ORDER
        inside = np.zeros(len(gram) + ORDER, np.int8)
        np.add.at(inside, begins[:-1], 1)
        np.add.at(inside, begins[1:] - ORDER + 1, -1)
        return gram[np.cumsum(inside[: len(gram)]).astype(bool)], own + np.arange(len(texts) + 1)


def _characters_met(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(code, n) of the characters of a task."""
    total = np.zeros(CODE_POINTS, np.int64)
    for _, (texts,) in batches_of(rows, "text"):
        own = [p for t in texts for p in _pieces(t or "")]
        for start, stop in slices([len(t) for t in own]):
            total += np.bincount(_codes(own[start:stop]), minlength=CODE_POINTS)
    found = np.flatnonzero(total)
    yield pa.record_batch({"code": found.astype(np.int32), "n": total[found]})


def counted_characters(texts: DataFrame) -> np.ndarray:
    """Code points of all texts, most frequent first, without the space and a to z: fewer than there are code points."""
    met = mapped(texts.select("text"), _characters_met, "code int, n bigint").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    code, n = (met.column(c).to_numpy() for c in ("code", "n"))
    named = (code == ord(" ")) | ((code >= ord("a")) & (code <= ord("z")))
    order = np.lexsort((code, -n))
    return code[order[~named[order]]].astype(np.uint32)


def _pieces(text: str, limit: int = 1 << 22) -> list[str]:
    return [text[i : i + limit] for i in range(0, len(text), limit)] or [""]


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in ascending order with the sums of their counts."""
    hashes, n = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(hashes, kind="stable")
    hashes, n = hashes[order], n[order]
    firsts = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
    return hashes[firsts], np.add.reduceat(n, firsts)


def _counted_with(sent):
    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(lang, hash, n) of the n-grams of a task, added up as far as memory allows."""
        alphabet, sums = Alphabet(sent.value), {}
        waiting = 0

        def flushed() -> Iterator[pa.RecordBatch]:
            for lang, parts in sums.items():
                hashes, n = _added(parts)
                for at in range(0, len(hashes), 1 << 18):
                    part = slice(at, at + (1 << 18))
                    yield pa.record_batch({"lang": pa.array([lang] * len(n[part]), pa.string()), "hash": hashes[part], "n": n[part]})
            sums.clear()

        for _, (langs, texts) in batches_of(rows, "lang", "text"):
            by_lang: dict[str | None, list[str]] = {}
            for lang, text in zip(langs, texts):
                by_lang.setdefault(lang, []).extend(_pieces(text or ""))
            for lang, own in by_lang.items():
                for start, stop in slices([len(t) for t in own]):
                    found = np.unique(alphabet.grams(own[start:stop])[0], return_counts=True)
                    sums.setdefault(lang, []).append(found)
                    waiting += len(found[0])
                    if waiting > HELD_ENTRIES:
                        sums.update({x: [_added(parts)] for x, parts in sums.items()})
                        waiting = sum(len(parts[0][0]) for parts in sums.values())
                        if waiting > HELD_ENTRIES // 2:
                            yield from flushed()
                            waiting = 0
        yield from flushed()

    return run


def _language(column: str = "lang") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def _per_language(df: DataFrame) -> DataFrame:
    """A table with one row per language, stored and counted, so it is broadcast only where it is known to be small.

    A join on the language alone would otherwise deal most documents to the task of their language.
    """
    df = held(df, "languages")
    return F.broadcast(df) if df.count() <= MAX_BROADCAST_LANGUAGES else df


def _discount(n: str = "n") -> Column:
    return F.when(F.col(n) == 1, F.col("d1")).when(F.col(n) == 2, F.col("d2")).otherwise(F.col("d3"))


def kneser_ney(counts: DataFrame, order: int = ORDER, alphabet: int = ALPHABET) -> DataFrame:
    """(lang, size, hash, p, gamma) of all n-grams up to ``order`` from (lang, hash, n) of the longest ones.

    Interpolated modified Kneser-Ney: three discounts for each language and order from the counts of counts, lower
    orders from numbers of distinct left neighbours, shortest order mixed with the uniform distribution. ``gamma`` is the
    weight that the n-gram, taken as a context, leaves to the next shorter context (NULL at the longest). A language
    without the counts of counts that a discount needs takes 0.5, 1 and 1.5.
    """
    by_size = {order: counts.select("lang", "hash", F.col("n").cast("double").alias("n"))}
    for size in range(order - 1, 0, -1):
        longer = by_size[size + 1]
        shorter = longer.groupBy("lang", (F.col("hash") % alphabet**size).alias("hash")).agg(F.count(F.lit(1)).cast("double").alias("n"))
        by_size[size] = held(shorter, "grams")
    probabilities: DataFrame | None = None
    parts = []
    for size in range(1, order + 1):
        grams = by_size[size]
        of = [F.sum((F.col("n") == k).cast("double")).alias(f"n{k}") for k in range(1, 5)]
        y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
        usable = (F.col("n1") > 0) & (F.col("n2") > 0) & (F.col("n3") > 0) & (F.col("n4") > 0)

        def discount(k: int) -> Column:
            value = k - (k + 1) * y * F.col(f"n{k + 1}") / F.col(f"n{k}")
            return F.when(usable, F.greatest(F.lit(0.0), F.least(F.lit(float(k)), value))).otherwise(0.5 * k)

        discounts = grams.groupBy("lang").agg(*of).select("lang", *[discount(k).alias(f"d{k}") for k in (1, 2, 3)])
        grams = grams.join(_per_language(discounts), "lang").select(
            "lang", "hash", "n", F.least(_discount(), F.col("n")).alias("d"), F.expr(f"hash div {alphabet}").alias("context")
        )
        contexts = grams.groupBy("lang", "context").agg(F.sum("n").alias("total"), (F.sum("d") / F.sum("n")).alias("gamma"))
        raw = grams.join(contexts, ["lang", "context"]).select(
            "lang", "hash", ((F.col("n") - F.col("d")) / F.col("total")).alias("own"), "gamma", (F.col("hash") % alphabet ** (size - 1)).alias("suffix")
        )
        if probabilities is None:
            known = raw.select("lang", "hash", (F.col("own") + F.col("gamma") / alphabet).alias("p"))
        else:
            shorter = probabilities.select("lang", F.col("hash").alias("suffix"), F.col("p").alias("shorter"))
            known = raw.join(shorter, ["lang", "suffix"]).select(
                "lang", "hash", (F.col("own") + F.col("gamma") * F.col("shorter")).alias("p")
            )
        probabilities = held(known, "probabilities")
        parts.append(probabilities.select("lang", F.lit(size).alias("size"), "hash", "p", F.lit(None).cast("double").alias("gamma")))
        parts.append(
            contexts.select("lang", F.lit(size - 1).alias("size"), F.col("context").alias("hash"), F.lit(None).cast("double").alias("p"), "gamma")
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


ARRAYS = "lang string, kind string, size int, high bigint, entries bigint, hashes binary, weights binary"


def _packed(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrays of ascending hashes with their values, from rows sorted by language, kind, size and hash."""
    for batch in rows:
        lang, kind, size = (batch.column(i).to_pylist() for i in range(3))
        hashes = batch.column(3).to_numpy(zero_copy_only=False)
        values = batch.column(4).to_numpy(zero_copy_only=False).astype("<f4")
        high, low = hashes >> 32, (hashes & 0xFFFFFFFF).astype("<u4")
        keys = list(zip(lang, kind, size, high.tolist()))
        cuts = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
        spans = [(start, stop) for start, stop in zip(cuts, cuts[1:]) if stop > start]
        firsts = [start for start, _ in spans]
        yield pa.record_batch(
            {
                "lang": pa.array([lang[i] for i in firsts], pa.string()),
                "kind": pa.array([kind[i] for i in firsts], pa.string()),
                "size": pa.array([size[i] for i in firsts], pa.int32()),
                "high": pa.array(high[firsts], pa.int64()),
                "entries": pa.array([stop - start for start, stop in spans], pa.int64()),
                "hashes": pa.array([low[start:stop].tobytes() for start, stop in spans], pa.binary()),
                "weights": pa.array([values[start:stop].tobytes() for start, stop in spans], pa.binary()),
            }
        )


def _unpacked(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, kind, size, hash, value) of arrays."""
    for batch in rows:
        for r in batch.to_pylist():
            hashes = np.frombuffer(r["hashes"], "<u4").astype(np.int64) + (r["high"] << 32)
            same = {c: pa.array([r[c]] * r["entries"], t) for c, t in (("lang", pa.string()), ("kind", pa.string()), ("size", pa.int32()))}
            yield pa.record_batch(same | {"hash": hashes, "value": np.frombuffer(r["weights"], "<f4").astype(np.float64)})


def train(docs: DataFrame) -> DataFrame:
    """The model of every language as stored arrays: (lang, kind, size, high, entries, hashes, weights).

    ``kind`` is ``p`` for probabilities, ``gamma`` for context weights and ``symbol`` for the alphabet of all languages (code points
    and their ranks); ``hashes`` ascend within an array and are the low halves, little-endian unsigned 32-bit numbers, of hashes
    whose other half is ``high``; ``weights`` are little-endian 32-bit floats.
    """
    spark = docs.sparkSession
    texts = docs.select(_language().alias("lang"), F.col("text").cast("string").alias("text"))
    codes = counted_characters(texts)
    counts = mapped(texts, _counted_with(spark.sparkContext.broadcast(codes)), "lang string, hash bigint, n bigint")
    counts = counts.groupBy("lang", "hash").agg(F.sum("n").alias("n"))
    entries = kneser_ney(held(counts, "grams")).select(
        "lang", F.when(F.col("p").isNotNull(), "p").otherwise("gamma").alias("kind"), "size", "hash", F.coalesce("p", "gamma").alias("value")
    )
    order = ["lang", "kind", "size", "hash"]
    packed = entries.repartitionByRange(*order).sortWithinPartitions(*order)
    ranks = np.argsort(codes)
    symbols = (None, "symbol", 0, 0, len(codes), codes[ranks].astype("<u4").tobytes(), ranks.astype("<f4").tobytes())
    return held(mapped(packed, _packed, ARRAYS).unionByName(spark.createDataFrame([symbols], ARRAYS)), "arrays")


def _alphabet_of(arrays: DataFrame) -> np.ndarray:
    found = arrays.filter("kind = 'symbol'").first()
    return np.frombuffer(found["hashes"], "<u4")[np.argsort(np.frombuffer(found["weights"], "<f4"))]


class Scorer:
    """Log-probabilities of n-grams of one language, looked up in its arrays."""

    def __init__(self, arrays: list[tuple[str, int, int, bytes, bytes]]) -> None:
        self.found = {}
        for kind, size, high, hashes, values in sorted(arrays, key=lambda a: a[:3]):
            own = self.found.setdefault((kind, size), ([], []))
            own[0].append(np.frombuffer(hashes, "<u4").astype(np.int64) + (high << 32))
            own[1].append(np.frombuffer(values, "<f4"))
        for key, (hashes, values) in self.found.items():
            hashes, values = np.concatenate(hashes), np.concatenate(values)
            order = np.argsort(hashes, kind="stable")
            self.found[key] = hashes[order], values[order]

    def _values(self, kind: str, size: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of hashes, and which were found; others are 1."""
        keys, values = self.found.get((kind, size), (np.zeros(0, np.int64), np.zeros(0, np.float32)))
        if not len(keys):
            return np.ones(len(hashes)), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        met = keys[at] == hashes
        return np.where(met, values[at], 1.0), met

    def probability(self, hashes: np.ndarray, size: int = ORDER) -> np.ndarray:
        if not size:
            return np.full(len(hashes), 1.0 / ALPHABET)
        p, met = self._values("p", size, hashes)
        rest = hashes[~met]
        if len(rest):
            # the shorter n-gram of a hash is the hash without its first symbol
            p[~met] = self._values("gamma", size - 1, rest // ALPHABET)[0] * self.probability(rest % ALPHABET ** (size - 1), size - 1)
        return p

    def log(self, hashes: np.ndarray) -> np.ndarray:
        different, place = np.unique(hashes, return_inverse=True)
        return np.log(np.maximum(self.probability(different), LEAST))[place]


def base_metrics(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    seen: set[str] = set()
    repeated_lines = 0
    for line in text.split("\n"):
        if line in seen:
            repeated_lines += 1
        elif WORD.search(line):
            seen.add(line)
    repeated_words = 0
    if n > WINDOW:
        numbers = np.fromiter(map(hash, words), np.int64, n).astype(np.uint64)
        windows = np.zeros(n - WINDOW + 1, np.uint64)
        for k in range(WINDOW):
            windows = windows * np.uint64(0x9E3779B97F4A7C15) + (numbers[k : n - WINDOW + 1 + k] ^ (numbers[k : n - WINDOW + 1 + k] >> np.uint64(29)))
        order = np.sort(windows)
        twice = order[1:][order[1:] == order[:-1]]
        if len(twice):
            covered = np.zeros(n + 1, np.int64)
            places = np.flatnonzero(np.isin(windows, twice))
            covered[places] += 1
            covered[places + WINDOW] -= 1
            repeated_words = int(np.count_nonzero(np.cumsum(covered[:n])))
    symbols = sum(text.count(s) for s in SYMBOLS)
    return n, sum(map(len, words)), symbols, repeated_lines, repeated_words


METRICS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, log_perplexity double"


def scored(docs: DataFrame, arrays: DataFrame, with_text: bool = True) -> DataFrame:
    """One row per document: its columns as struct ``row``, the base metrics and ``log_perplexity``.

    Without ``with_text`` the struct has no text, which then need not be written or moved again.
    """
    spark = docs.sparkSession
    if with_text:
        columns, place = [F.struct("*").alias("row"), _language().alias("lang")], "row.text"
    else:
        rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
        columns, place = [F.struct(*rest).alias("row"), _language().alias("lang"), F.col("text").cast("string").alias("text")], "text"
    nested = docs.select(*columns)
    schema = StructType([nested.schema["row"], *StructType.fromDDL(METRICS).fields])
    sent = spark.sparkContext.broadcast(_alphabet_of(arrays))
    model = arrays.filter("kind <> 'symbol'")
    sizes = model.groupBy("lang").agg(F.sum("entries").alias("n")).orderBy("lang").collect()
    large, sizes = [r["lang"] for r in sizes if r["n"] > LARGE_ENTRIES], [r for r in sizes if r["n"] <= LARGE_ENTRIES]
    groups = [[r["lang"] for r in sizes[a:b]] for a, b in slices([r["n"] for r in sizes], GROUP_ENTRIES)] or [[]]

    def among(langs: list[str]) -> Column:
        return F.col("lang").isin(langs) if langs else F.lit(False)

    parts = []
    for i, group in enumerate(groups):
        models: dict[str | None, list] = {}
        for r in model.filter(among(group)).collect():
            models.setdefault(r["lang"], []).append((r["kind"], r["size"], r["high"], bytes(r["hashes"]), bytes(r["weights"])))
        # the first group also takes languages that the model has never met
        own = among(group) if i else ~among([x for other in groups[1:] for x in other] + large)
        parts.append(mapped(nested.filter(own), _scores_with(spark.sparkContext.broadcast(models), sent, place), schema))
    if large:
        parts.append(_scored_by_join(nested.filter(among(large)), model.filter(among(large)), sent, place, schema))
    return reduce(DataFrame.unionByName, parts)


def _metrics(texts: list[str]) -> dict[str, pa.Array]:
    metrics = list(zip(*map(base_metrics, texts)))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    columns = {n: pa.array(v, pa.int64()) for n, v in zip(names, metrics)}
    failed = [n < MIN_WORDS or 100 * r > MAX_REPEAT_PERCENT * n for n, r in zip(metrics[0], metrics[4])]
    return columns | {"base_failed": pa.array(failed, pa.bool_())}


def _scores_with(sent, characters, place: str):
    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alphabet, loaded = Alphabet(characters.value), {}
        for piece, (langs, texts) in batches_of(rows, "lang", place):
            texts = [t or "" for t in texts]
            score = np.zeros(len(texts))
            for lang in dict.fromkeys(langs):
                if lang not in loaded:
                    if len(loaded) >= 4:
                        loaded.clear()
                    loaded[lang] = Scorer(sent.value.get(lang, []))
                own = [i for i, x in enumerate(langs) if x == lang]
                parts = [(i, p) for i in own for p in _pieces(texts[i])]
                gram, begins = alphabet.grams([p for _, p in parts])
                sums = np.zeros(len(texts)), np.zeros(len(texts))
                owner = [i for i, _ in parts]
                np.add.at(sums[0], owner, np.add.reduceat(loaded[lang].log(gram), begins[:-1]))
                np.add.at(sums[1], owner, np.diff(begins))
                score[own] = -sums[0][own] / sums[1][own]
            columns = _metrics(texts) | {"log_perplexity": pa.array(score, pa.float64())}
            yield pa.record_batch([piece.column(0), *columns.values()], names=["row", *columns])

    return run


def _grams_with(characters):
    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(number, lang, hash, n) of the n-grams of each document."""
        alphabet = Alphabet(characters.value)
        for _, (numbers, langs, texts) in batches_of(rows, "number", "lang", "text"):
            for number, lang, text in zip(numbers, langs, texts):
                for part in _pieces(text or ""):
                    hashes, n = np.unique(alphabet.grams([part])[0], return_counts=True)
                    yield pa.record_batch(
                        {"number": np.full(len(n), number), "lang": pa.array([lang] * len(n), pa.string()), "hash": hashes, "n": n}
                    )

    return run


def _measured_with(place: str):
    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, (texts,) in batches_of(rows, place):
            columns = _metrics([t or "" for t in texts])
            row, number = (piece.column(piece.schema.get_field_index(c)) for c in ("row", "number"))
            yield pa.record_batch([row, number, *columns.values()], names=["row", "number", *columns])

    return run


def _probabilities(grams: DataFrame, model: DataFrame) -> DataFrame:
    """(lang, hash, p) of different n-grams by joins with the model, from the shortest order to the longest."""
    entries = mapped(model, _unpacked, "lang string, kind string, size int, hash bigint, value double")
    out = grams.withColumn("p", F.lit(1.0 / ALPHABET))
    for size in range(1, ORDER + 1):
        gammas = entries.filter((F.col("kind") == "gamma") & (F.col("size") == size - 1)).select("lang", F.col("hash").alias("context"), F.col("value").alias("gamma"))
        known = entries.filter((F.col("kind") == "p") & (F.col("size") == size)).select("lang", F.col("hash").alias("own"), F.col("value").alias("known"))
        out = out.withColumn("own", F.col("hash") % ALPHABET**size).withColumn("context", F.expr(f"own div {ALPHABET}"))
        out = out.join(gammas, ["lang", "context"], "left").join(known, ["lang", "own"], "left")
        out = out.select("lang", "hash", F.coalesce("known", F.coalesce("gamma", F.lit(1.0)) * F.col("p")).alias("p"))
    return out


def _scored_by_join(nested: DataFrame, model: DataFrame, characters, place: str, schema: StructType) -> DataFrame:
    """The same scores for languages whose model is too large to be sent: no task holds more than a text and its n-grams."""
    numbered = held(nested.withColumn("number", F.monotonically_increasing_id()), "numbered")
    texts = numbered.select("number", "lang", F.col(place).cast("string").alias("text"))
    grams = held(mapped(texts, _grams_with(characters), "number bigint, lang string, hash bigint, n bigint"), "grams")
    known = held(_probabilities(grams.select("lang", "hash").distinct(), model), "known")
    logs = F.sum(F.col("n") * F.log(F.greatest("p", F.lit(LEAST)))) / F.sum("n")
    scores = grams.join(known, ["lang", "hash"]).groupBy("number").agg((-logs).alias("log_perplexity"))
    fields = [f for f in schema.fields if f.name != "log_perplexity"]
    measured = mapped(numbered, _measured_with(place), StructType([fields[0], StructField("number", LongType()), *fields[1:]]))
    return measured.join(scores, "number").select(*schema.fieldNames())


def _characters() -> Column:
    return F.greatest(F.col("n_words") + F.col("word_chars"), F.lit(1))


def bands(scores: DataFrame) -> DataFrame:
    """(lang, centre, below, above): the band of a document of c characters is centre - below / sqrt(c) to centre + above / sqrt(c).

    A mean over c characters varies with 1 / sqrt(c), so the quartiles are taken from the distances to the language's median
    times sqrt(c), over the different scores that pass the base rules: copies of one document count once.
    """
    passed = scores.filter(~F.col("base_failed")).select(_language("row.lang").alias("lang"), "log_perplexity", _characters().alias("c")).distinct()
    centres = _per_language(passed.groupBy("lang").agg(F.percentile_approx("log_perplexity", 0.5, 10_000).alias("centre"), F.count(F.lit(1)).alias("n")))
    scaled = passed.join(centres, "lang").withColumn("z", (F.col("log_perplexity") - F.col("centre")) * F.sqrt("c"))
    quartiles = F.percentile_approx("z", [0.25, 0.75], 10_000)
    own = scaled.groupBy("lang", "centre", "n").agg(quartiles.alias("q"))
    both = own.crossJoin(F.broadcast(scaled.agg(quartiles.alias("of_all"))))
    low, high = ((F.col("n") * F.col("q")[i] + BAND_DOCS * F.col("of_all")[i]) / (F.col("n") + BAND_DOCS) for i in (0, 1))
    reach = SPREAD * (high - low)
    return both.select("lang", "centre", (reach - low).alias("below"), (reach + high).alias("above"))


def judge(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """Struct ``row`` of every document with base metrics, ``perplexity``, band and ``kept``."""
    scores = held(scored(docs, train(docs), with_text), "scores")
    limits = _per_language(bands(scores))
    joined = scores.withColumn("lang", _language("row.lang")).join(limits, "lang", "left")
    joined = joined.withColumn("lower", F.col("centre") - F.col("below") / F.sqrt(_characters()))
    joined = joined.withColumn("upper", F.col("centre") + F.col("above") / F.sqrt(_characters()))
    inside = F.coalesce(F.col("log_perplexity").between(F.col("lower") - ROUNDING, F.col("upper") + ROUNDING), F.lit(True))
    return joined.select(
        "row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.exp("log_perplexity").alias("perplexity"), F.exp("lower").alias("lower_perplexity"), F.exp("upper").alias("upper_perplexity"),
        (~F.col("base_failed") & inside).alias("kept"),
    )


def quality_rules(docs: DataFrame) -> DataFrame:
    """doc_id, the base metrics, perplexity with the band of its language, and the verdict, for every document."""
    judged = judge(docs.select("doc_id", "text", "lang"), with_text=False)
    return judged.select(F.col("row.doc_id").alias("doc_id"), *[c for c in judged.columns if c != "row"])


def kept_documents(docs: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns."""
    return judge(docs).filter("kept").select("row.*")

