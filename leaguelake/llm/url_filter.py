"""URL filter by a weighted vocabulary, below rules for hosts and paths.

A rule (verdict, host, path) fits its host and all subdomains where the url's path starts with the rule's; of those that
fit the longest host and path together wins (at equal length the longer host). A url without a rule is judged by the
vocabulary: one Aho-Corasick automaton finds all terms in the url, a hit counts when no letter or digit stands beside it,
and the url is blocked when the weights of its distinct terms reach THRESHOLD: one strict term does, soft terms need
several. Repeated hits of a term count once.

The automaton reads host and path, A-Z lower-cased, each percent escape as one blank; the query and fragment say where a
visitor came from rather than what a page holds, so they are not read. Rules and terms are parameters of at most MOST entries each, which travel with the tasks; urls are judged where they
are read, without a shuffle, a batch at a time.

Defined cases: a url that is NULL or has no ``://`` has an empty host and path, no term and no rule (verdict ``allow``); very
long urls are read whole; an empty vocabulary allows what no rule blocks; repeated rows are judged each for itself;
empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Mapping, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from leaguelake.llm.common import batches_of, mapped

MOST = 1_000_000
THRESHOLD = 2
# fixed values: words of adult, gambling, drug and spam addresses; strict ones are enough alone
STRICT = (
    "blackjack", "camgirls", "casino", "cialis", "escorts", "hentai", "milf", "porn", "porno", "pornhub", "poker", "roulette", "slots", "spam", "spamfarm",
    "viagra", "warez", "xvideos", "xxx",
)
# fixed values: words that are harmless alone
SOFT = (
    "ads", "adult", "affiliate", "bet", "bets", "bonus", "cam", "cheap", "click", "clickbait", "coupon", "crack", "dating", "deal", "download", "farm", "free",
    "gamble", "girls", "hot", "keygen", "live", "loan", "loans", "naked", "nude", "offer", "payday", "pharmacy", "pills", "popup", "promo", "rx", "sex",
    "sexy", "sponsored", "torrent", "track", "tracker", "win", "x",
)
VOCABULARY: dict[str, int] = {term: THRESHOLD for term in STRICT} | {term: 1 for term in SOFT}
# the rules of the registered query
RULES: tuple[tuple[str, str, str], ...] = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

_LOWER = {i: i + 32 for i in range(65, 91)}
_AUTHORITY = re.compile(r"://([^/?#]*)([^?#]*)")
_ESCAPE = re.compile("%[0-9A-Fa-f]{2}")
RESULT = "page_id bigint, host string, path string, rule string, verdict string, weight int, terms string"


def host_and_path(url: str | None) -> tuple[str, str]:
    found = _AUTHORITY.search(url or "")
    return (found[1].translate(_LOWER), found[2]) if found else ("", "")


class Rules:
    """Rules by host, each host's paths from the longest to the shortest."""

    def __init__(self, rules: Sequence[tuple[str, str, str]]):
        self.by_host: dict[str, list[tuple[str, str]]] = {}
        for verdict, host, path in rules:
            self.by_host.setdefault(host.translate(_LOWER), []).append((path, verdict))
        for paths in self.by_host.values():
            paths.sort(key=lambda p: (-len(p[0]), p))

    def longest(self, host: str, path: str) -> tuple[str, str] | None:
        """The rule (its text, its verdict) that wins for a host and path."""
        best, place = None, 0
        while place >= 0:
            suffix = host[place:]
            for start, verdict in self.by_host.get(suffix, ()):
                if path.startswith(start):
                    if best is None or len(suffix) + len(start) > len(best[0]):
                        best = (suffix + start, verdict)
                    break
            dot = host.find(".", place)
            place = dot + 1 if dot >= 0 else -1
        return best


def automaton(vocabulary: Mapping[str, int]) -> ahocorasick.Automaton | None:
    found = ahocorasick.Automaton()
    for term, weight in vocabulary.items():
        if term:
            found.add_word(term.translate(_LOWER), (term.translate(_LOWER), weight))
    if not len(found):
        return None
    found.make_automaton()
    return found


def distinct_terms(terms: ahocorasick.Automaton | None, address: str) -> dict[str, int]:
    """The distinct terms of a host and path that have no letter or digit beside them."""
    if terms is None or not address:
        return {}
    text = _ESCAPE.sub(" ", address.translate(_LOWER))
    found = {}
    for end, (term, weight) in terms.iter(text):
        start = end + 1 - len(term)
        if not (start and text[start - 1].isalnum()) and not text[end + 1:end + 2].isalnum():
            found[term] = weight
    return found


def judged(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, vocabulary: Mapping[str, int] = VOCABULARY, *, threshold: int = THRESHOLD,
    url: str = "url", page_id: str = "page_id",
) -> DataFrame:
    """page_id, host, path, rule, verdict, and the distinct terms of every url with their weight."""
    if len(rules) > MOST or len(vocabulary) > MOST:
        raise ValueError(f"at most {MOST} rules and terms")
    rules, vocabulary = list(rules), dict(vocabulary)

    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen, terms = Rules(rules), automaton(vocabulary)
        for _, (ids, urls) in batches_of(rows, "page_id", "url"):
            out = []
            for page, address in zip(ids, urls):
                host, path = host_and_path(address)
                rule = chosen.longest(host, path)
                found = distinct_terms(terms, host + path)
                weight = min(sum(found.values()), 2**31 - 1)
                verdict = rule[1] if rule else "block" if weight >= threshold else "allow"
                out.append((page, host, path, rule and rule[0], verdict, weight, ",".join(sorted(found))))
            columns = list(zip(*out))
            kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.string())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], ["page_id", "host", "path", "rule", "verdict", "weight", "terms"])

    return mapped(pages.selectExpr(f"CAST(`{page_id}` AS BIGINT) AS page_id", f"CAST(`{url}` AS STRING) AS url"), run, RESULT)


def sql(rules: Sequence[tuple[str, str, str]] = RULES, vocabulary: Mapping[str, int] = VOCABULARY, threshold: int = THRESHOLD) -> str:
    """The same judgement in DuckDB SQL, for terms of letters and digits."""
    listed = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in rules)
    words = ", ".join(f"('{t}', {w})" for t, w in vocabulary.items())
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""
WITH rules(rule_verdict, rule_host, rule_path) AS (VALUES {listed}),
terms(term, term_weight) AS (VALUES {words}),
cut AS (
  SELECT row_number() OVER () AS row, page_id, CASE WHEN contains(url, '://') THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
parsed AS (
  SELECT row, page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{upper}', '{upper.lower()}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
         ' ' || regexp_replace(regexp_replace(translate(regexp_extract(rest, '^[^?#]*'), '{upper}', '{upper.lower()}'),
                               '%[0-9a-f][0-9a-f]', ' ', 'g'), '[^\p{{L}}\p{{N}}]', ' ', 'g') || ' ' AS seen
  FROM cut),
ruled AS (
  SELECT row, rule_host || rule_path AS rule, rule_verdict
  FROM parsed JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  QUALIFY row_number() OVER (PARTITION BY row ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) = 1),
hits AS (
  SELECT row, sum(term_weight) AS weight, string_agg(term, ',' ORDER BY term) AS terms
  FROM parsed JOIN terms ON contains(seen, ' ' || term || ' ')
  GROUP BY row)
SELECT page_id, host, path, rule,
       coalesce(rule_verdict, CASE WHEN coalesce(weight, 0) >= {threshold} THEN 'block' ELSE 'allow' END) AS verdict,
       CAST(coalesce(weight, 0) AS INTEGER) AS weight, coalesce(terms, '') AS terms
FROM parsed LEFT JOIN ruled USING (row) LEFT JOIN hits USING (row)
"""
