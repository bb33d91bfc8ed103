"""Line dedup with a log-template tree.

Lines are parsed to a fixed depth: first by their number of tokens, then by their leading tokens; tokens with digits
are variable and become ``<*>``. The lines of a leaf are compared place by place. The most common token of each place (of equally
common ones the greatest) makes the leaf's template, and a line is an instance of it when enough of its tokens after the leading ones agree; the
places where it differs are variable fields. A line that agrees too little is its own template, with its digits
variable if half of it stays constant. A template that occurs in at least ``min_docs`` documents recurs: its first
line (lowest document id, then text hash, then place) stays as the one copy of the content, all others are dropped.

DataFrame functions only. Equal lines are counted once before anything else, so a line in a third of all documents is
one row in the tree. Only lines of leaves with several different lines are taken apart into tokens. Only (key, place)
rows are joined on templates; texts move once, to the lists of places to drop.

Defined cases. NULL text stays NULL and has no lines. Lines with fewer than ``min_tokens`` tokens stay. A document is
told by its id and text, so repeated rows of one document count as one and get the same result. Columns other than
``doc_id`` and ``text`` are carried along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from leaguelake.llm.common import document_key
from leaguelake.session import held, held_at, release

MIN_DOCS = 2
MIN_TOKENS = 4
LEADING = 3
MIN_CONSTANT = 0.7
HALF = 0.5
VARIABLE = "<*>"


def _lines(keyed: DataFrame) -> DataFrame:
    """(key, place, line) of all lines."""
    lines = keyed.select("key", F.posexplode(F.split("text", "\n", -1)).alias("place", "line"))
    return lines.withColumn("line", F.trim("line")).filter(F.length("line") > 0)


def _tokens(line: str) -> Column:
    """Tokens of a line, those with digits as ``<*>``."""
    masked = F.when(F.col(line).rlike("[0-9]"), F.regexp_replace(line, r"[^\s0-9]*[0-9][^\s]*", VARIABLE)).otherwise(F.col(line))
    return F.split(masked, r"\s+")


def _long_enough(min_tokens: int) -> Column:
    return F.col("line").rlike(r"\S(?:\s+\S+){%d}" % (min_tokens - 1))


def templates(lines: DataFrame, min_tokens: int, leading: int, min_constant: float) -> tuple[DataFrame, str]:
    """(line_hash, template) of the different lines in leaves with several of them, and the path of the held lines it reads.

    The different lines are shuffled once, by their hash. Crowded leaves are found from 16 bytes a line, and so are the
    hashes of their lines, which meet the lines where they are.
    """
    leaf = F.xxhash64(F.size("tokens"), F.slice("tokens", 1, leading))
    parsed = lines.filter(_long_enough(min_tokens)).withColumn("tokens", _tokens("line"))
    different = parsed.groupBy(F.xxhash64("line").alias("line_hash")).agg(F.first(leaf).alias("leaf"), F.first("line").alias("line"))
    # all three readers of ``different`` ask for the line, so that they share its one shuffle
    crowded = different.groupBy("leaf").agg(F.count("line").alias("lines")).filter("lines > 1").select("leaf")
    wanted = different.filter("line IS NOT NULL").select("line_hash", "leaf").join(crowded, "leaf", "left_semi").select("line_hash")
    alike, place = held_at(different.join(wanted.hint("shuffle_hash"), "line_hash", "left_semi").select("line", "leaf"), "alike")
    alike = alike.select(F.xxhash64("line").alias("line_hash"), "leaf", _tokens("line").alias("tokens"))
    consensus = (
        alike.select("leaf", F.posexplode("tokens").alias("at", "token"))
        .groupBy("leaf", "at", "token")
        .agg(F.count(F.lit(1)).alias("lines"))
        .groupBy("leaf", "at")
        .agg(F.max(F.struct("lines", "token")).alias("most"))
        .groupBy("leaf")
        .agg(F.sort_array(F.collect_list(F.struct("at", F.col("most.token").alias("token")))).alias("form"))
        .select("leaf", F.col("form.token").alias("form"))
    )
    after = F.size("tokens") - leading
    constant = F.filter("tokens", lambda t: t != VARIABLE)
    agree = F.filter(
        F.zip_with("tokens", "form", lambda t, f: (t != VARIABLE) & (t == f)), lambda same: same
    )
    shaped = alike.join(consensus, "leaf").withColumn(
        "agreeing", F.size(agree) - F.size(F.filter(F.slice("tokens", 1, leading), lambda t: t != VARIABLE))
    )
    named = shaped.select(
        "line_hash",
        F.when(F.col("agreeing") >= min_constant * after, F.col("leaf"))
        .when(F.size(constant) >= HALF * F.size("tokens"), F.xxhash64("tokens"))
        .otherwise(F.col("line_hash"))
        .alias("template"),
    )
    return named, place


def dropped_lines(
    docs: DataFrame, min_docs: int = MIN_DOCS, min_tokens: int = MIN_TOKENS, leading: int = LEADING, min_constant: float = MIN_CONSTANT
) -> DataFrame:
    """(key, places): for each document the places of its lines to drop."""
    keyed = docs.filter(F.col("text").isNotNull()).select(document_key().alias("key"), F.col("text").cast("string").alias("text"))
    lines = _lines(keyed)
    forms, forms_at = templates(lines.select("line"), min_tokens, leading, min_constant)
    named, named_at = held_at(forms, "templates")
    # a line of a crowded leaf goes by its template, any other by itself
    spots, spots_at = held_at(
        lines.filter(_long_enough(min_tokens))
        .select("key", "place", F.xxhash64("line").alias("line_hash"))
        .join(named, "line_hash", "left")
        .select("key", "place", F.coalesce("template", "line_hash").alias("template")),
        "spots",
    )
    first = F.struct(F.col("key.id").isNull().alias("no_id"), "key", "place")
    recurring, recurring_at = held_at(
        spots.groupBy("template", "key").agg(F.min("place").alias("place"))
        .groupBy("template")
        .agg(F.count(F.lit(1)).alias("docs"), F.min(first).alias("first"))
        .filter(F.col("docs") >= min_docs)
        .select("template", F.col("first.key").alias("first_key"), F.col("first.place").alias("first_place")),
        "recurring",
    )
    lost = spots.join(recurring, "template").filter(~((F.col("key") == F.col("first_key")) & (F.col("place") == F.col("first_place"))))
    places = held(lost.groupBy("key").agg(F.collect_set("place").alias("places")), "lost")
    release(docs.sparkSession, forms_at, named_at, spots_at, recurring_at)
    return places


def line_dedup(docs: DataFrame, **limits: float) -> DataFrame:
    """All rows of ``docs`` with ``text`` without its recurring lines, plus ``lines_dropped`` in a struct with the row.

    Returns (row, text, lines_dropped), where ``row`` holds the row as it came.
    """
    lost = dropped_lines(docs, **limits)
    rows = docs.select(F.struct("*").alias("row"), document_key().alias("key"))
    joined = rows.join(lost.hint("shuffle_hash"), "key", "left")
    text = F.col("row.text").cast("string")
    left = F.array_join(F.filter(F.split(text, "\n", -1), lambda line, i: ~F.array_contains("places", i)), "\n")
    return joined.select(
        "row", F.when(F.col("places").isNull(), text).otherwise(left).alias("text"), F.coalesce(F.size("places"), F.lit(0)).alias("lines_dropped")
    )


# the same in SQL (DuckDB dialect) over ``documents`` with different ids, for the default limits
SQL = r"""
WITH placed AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS whole, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS place
  FROM documents),
lines AS (SELECT doc_id, place, trim(whole, ' ') AS line FROM placed WHERE regexp_matches(trim(whole, ' '), '\S(?:\s+\S+){3}')),
parsed AS (
  SELECT line, string_split_regex(regexp_replace(line, '[^\s0-9]*[0-9][^\s]*', '<*>', 'g'), '\s+') AS tokens
  FROM (SELECT DISTINCT line FROM lines)),
leaves AS (SELECT *, len(tokens) AS n, tokens[1:3] AS lead FROM parsed),
alike AS (SELECT * FROM leaves QUALIFY COUNT(*) OVER (PARTITION BY n, lead) > 1),
tokens_of AS (SELECT n, lead, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS spot, line FROM alike),
common AS (
  SELECT n, lead, spot, token FROM (SELECT n, lead, spot, token, COUNT(*) AS lines FROM tokens_of GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY n, lead, spot ORDER BY lines DESC, token DESC) = 1),
agreeing AS (
  SELECT t.line, COUNT(*) FILTER (t.token <> '<*>' AND t.spot > 3 AND t.token = c.token) AS agree,
    COUNT(*) FILTER (t.token <> '<*>') AS constant
  FROM tokens_of t JOIN common c ON t.n = c.n AND t.lead = c.lead AND t.spot = c.spot GROUP BY t.line),
named AS (
  SELECT a.line, CASE WHEN g.agree >= 0.7 * (a.n - 3) THEN 'leaf ' || a.n || ' ' || CAST(a.lead AS VARCHAR)
    WHEN g.constant >= 0.5 * a.n THEN 'form ' || CAST(a.tokens AS VARCHAR) ELSE 'line ' || a.line END AS template
  FROM alike a JOIN agreeing g ON a.line = g.line),
spots AS (SELECT l.doc_id, l.place, COALESCE(m.template, 'line ' || l.line) AS template FROM lines l LEFT JOIN named m ON l.line = m.line),
lost AS (
  SELECT doc_id, place FROM spots
  QUALIFY dense_rank() OVER (PARTITION BY template ORDER BY doc_id DESC) + dense_rank() OVER (PARTITION BY template ORDER BY doc_id) > 2
    AND row_number() OVER (PARTITION BY template ORDER BY doc_id, place) > 1),
marked AS (SELECT p.*, l.place IS NOT NULL AS gone FROM placed p LEFT JOIN lost l ON p.doc_id = l.doc_id AND p.place = l.place)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN COALESCE(m.text, '') END AS text, COALESCE(m.n, 0) AS lines_dropped
FROM documents d LEFT JOIN (
  SELECT doc_id, string_agg(whole, chr(10) ORDER BY place) FILTER (NOT gone) AS text, CAST(COUNT(*) FILTER (gone) AS INTEGER) AS n
  FROM marked GROUP BY doc_id) m ON d.doc_id = m.doc_id
"""
