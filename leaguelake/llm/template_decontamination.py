"""Benchmark decontamination by template canonicalisation.

Texts become tokens (runs of letters and digits, lower case) in which numbers, names and units after numbers are typed
placeholders. Windows of WINDOW tokens of benchmark items are hash-joined with all windows of the documents, so a question
with other numbers or names still meets its original. Windows of the raw lower-case tokens go through the same join, so a
word-for-word copy meets its original whatever its slots, case and punctuation. Where windows meet on one alignment (same distance between place
in the document and place in the item), the values in the slots are compared: one value of the item must always
stand for one value in the document, and different names must stay different. Alignments that fail this are not
re-parameterised copies and are left out. A document holds an item when the windows left cover MIN_COVERED of its
tokens, or all but two of a shorter one: its first and last word may be grown together with their neighbours, or
stand inside a sentence and so count as a name.

A name is a capitalised word inside a sentence (after a lower-case letter, digit, comma, semicolon or colon). An item
shorter than WINDOW tokens is one window of its own length. A window with placeholders needs MIN_LITERAL of its
tokens to be literal, and at least LEAST_LITERAL; otherwise anything would fit it. A raw window needs LEAST_LITERAL tokens of any kind.

DataFrame functions only. The windows of the benchmark are broadcast when they are at most BROADCAST_WINDOWS, else
the join shuffles; the result is the same. Only documents with a common window are read again for their slots.

Defined cases. NULL and empty texts hold nothing. An item without a window that has enough literal tokens is
found word for word only, an item of fewer than LEAST_LITERAL tokens never. A document is told by its id and text: repeated rows give one row per item, copies with other ids one each; the same holds for repeated
items. Other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from leaguelake.llm.common import document_key
from leaguelake.session import held

WINDOW = 8
MIN_COVERED = 13
MIN_LITERAL = 0.6
LEAST_LITERAL = 3
BROADCAST_WINDOWS = 1_000_000
NAME, NUMBER, UNIT = "\ue000", "\ue001", "\ue002"  # private characters, in no text token
# units that are recognised after a number
UNITS = (
    "mm cm m km in ft mi inch inches feet foot yard yards mile miles meter meters metre metres mg g kg lb lbs oz gram grams kilogram kilograms pound pounds "
    "ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years "
    "mph kph degree degrees percent dollar dollars euro euros cent cents eur usd w kw v hz khz mhz ghz kb mb gb tb"
)


def _raw(text: Column) -> Column:
    """Text in which a number with separators is one run of digits."""
    return F.when(text.rlike("[0-9]"), F.regexp_replace(text, r"(?<=\d)[.,](?=\d)", "")).otherwise(text)


def _canonical(raw: Column) -> Column:
    named = F.regexp_replace(raw, r"\p{Lu}(?<=[\p{Ll}\d,;:] .)\p{L}*", NAME)
    units = "|".join(UNITS.split())
    numbered = F.regexp_replace(named, r"\d+", NUMBER)
    united = F.regexp_replace(numbered, rf"(?<={NUMBER})(\s?)(?i:{units})(?!\p{{L}})", f"$1{UNIT}")
    return F.lower(F.when(raw.rlike("[0-9]"), united).otherwise(named))


def _split(text: Column) -> Column:
    return F.array_remove(F.split(text, rf"[^\p{{L}}\p{{N}}{NAME}{NUMBER}{UNIT}]+"), "")


def _is_slot(token: Column) -> Column:
    return token.rlike(f"[{NAME}{NUMBER}{UNIT}]")


def _windows(tokens: Column, size: int) -> Column:
    """Hashes of all windows of ``size`` tokens; none if there are fewer tokens."""
    last = F.size(tokens) - size + 1
    return F.when(last >= 1, F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.lit(size), F.slice(tokens, i, size))))


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """(item, item_id, item_raw, item_tokens, size): items with their tokens and the length of their windows."""
    text = F.col("text").cast("string")
    return (
        benchmark.filter(F.col("text").isNotNull())
        .select(document_key("item_id").alias("item"), "item_id", _split(F.lower(_raw(text))).alias("item_raw"), _split(_canonical(_raw(text))).alias("item_tokens"))
        .withColumn("size", F.least(F.size("item_tokens"), F.lit(WINDOW)))
        .filter("size > 0")
        .dropDuplicates(["item"])
    )


def meetings(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(key, item, shift, places): alignments of documents and items with the places in the item where windows meet."""
    parts = []
    for size in sorted(r["size"] for r in items.select("size").distinct().collect()):  # at most WINDOW values
        own = items.filter(F.col("size") == size)
        literal = F.size(F.filter(F.slice("item_tokens", F.col("at") + 1, size), lambda t: ~_is_slot(t)))
        of_items = (
            own.select("item", "item_tokens", F.posexplode(_windows(F.col("item_tokens"), size)).alias("at", "window"))
            .filter((literal >= MIN_LITERAL * size) & (literal >= LEAST_LITERAL))
            .select("item", "at", "window")
        )
        if size >= LEAST_LITERAL:
            of_items = of_items.unionByName(own.select("item", F.posexplode(_windows(F.col("item_raw"), size)).alias("at", "window")))
        of_items = held(of_items.distinct(), "windows")
        if of_items.count() <= BROADCAST_WINDOWS:
            of_items = F.broadcast(of_items)
        text = _raw(F.col("text").cast("string"))
        tokens = docs.filter(F.col("text").isNotNull()).select(
            document_key().alias("key"), _split(_canonical(text)).alias("tokens"), _split(F.lower(text)).alias("raw")
        )
        both = F.arrays_zip(_windows(F.col("tokens"), size).alias("window"), _windows(F.col("raw"), size).alias("raw"))
        # most windows have no slot and are the same in both forms
        forms = F.when(F.col("both.window") == F.col("both.raw"), F.array("both.window")).otherwise(F.array("both.window", "both.raw"))
        of_docs = tokens.select("key", F.posexplode(both).alias("place", "both")).select("key", "place", F.explode(forms).alias("window"))
        parts.append(
            of_docs.join(of_items, "window").select(
                "key", "item", (F.col("place") - F.col("at")).alias("shift"), F.explode(F.sequence(F.col("at"), F.col("at") + size - 1)).alias("covered")
            )
        )
    if not parts:
        return items.select(F.col("item").alias("key"), "item", F.lit(0).alias("shift"), F.array(F.lit(0)).alias("places")).limit(0)
    return reduce(DataFrame.unionByName, parts).groupBy("key", "item", "shift").agg(F.collect_set("covered").alias("places"))


def contaminated(docs: DataFrame, benchmark: DataFrame, min_covered: int = MIN_COVERED) -> DataFrame:
    """One row for each document and item that it holds.

    key, doc_id, item_id, ``covered`` (tokens of the item found), ``item_tokens`` (all of them), ``n_slots`` (slots
    found), ``changed_slots`` (those with another value than in the item) and ``reparameterised`` (any of them).
    """
    items = held(benchmark_items(benchmark), "items")
    met = held(meetings(docs, items), "meetings")
    raw = docs.select(document_key().alias("key"), "doc_id", "text").join(met.select("key").distinct(), "key", "left_semi")
    raw = raw.select("key", "doc_id", _split(F.lower(_raw(F.col("text").cast("string")))).alias("raw")).dropDuplicates(["key"])
    joined = met.join(raw, "key").join(items, "item")
    # the slots of an alignment, as kind of slot, value in the item and value in the document
    slots = F.transform(
        F.filter("places", lambda p: _is_slot(F.get("item_tokens", p))),
        lambda p: F.struct(
            F.get("item_tokens", p).alias("kind"), F.get("item_raw", p).alias("was"), F.get("raw", p + F.col("shift")).alias("now")
        ),
    )
    pairs = F.array_distinct("slots")
    names = F.filter(pairs, lambda s: s["kind"].contains(NAME))
    consistent = (F.size(F.array_distinct(F.transform(pairs, lambda s: F.struct(s["kind"], s["was"])))) == F.size(pairs)) & (
        F.size(F.array_distinct(F.transform(names, lambda s: s["now"]))) == F.size(names)
    )
    changed = F.filter("slots", lambda s: ~s["was"].eqNullSafe(s["now"]))
    checked = joined.withColumn("slots", slots).filter(consistent)
    found = checked.groupBy("key", "item").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("item_id").alias("item_id"),
        F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("covered"),
        F.first(F.size("item_tokens")).alias("item_tokens"),
        F.sum(F.size("slots")).alias("n_slots"),
        F.sum(F.size(changed)).alias("changed_slots"),
    )
    return found.filter(F.col("covered") >= F.least(F.lit(min_covered), F.col("item_tokens") - 2)).select(
        "key", "doc_id", "item_id", "covered", "item_tokens", "n_slots", "changed_slots", (F.col("changed_slots") > 0).alias("reparameterised")
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item."""
    bad = held(contaminated(docs, benchmark).select("key").distinct(), "contaminated")
    rows = docs.select(F.struct("*").alias("row"), document_key().alias("key"))
    return rows.join(bad, "key", "left_anti").select("row.*")
