"""License scan: fuzzy search for short notices.

A notice of n characters may differ by k = max(1, n // EDIT_SPAN) edits. Cut into k + 1 pieces, one piece of any such
occurrence is unchanged, so exact pieces (found for all notices at once by Aho-Corasick) locate all candidates. The regex
library's bounded-error matching then verifies each candidate, which gives the edits and the span. Texts are compared as
their words, in lower case A-Z, joined by spaces; spans are character offsets in the text as it came.

Edits are for the common words. The words that tell a notice from its siblings (name, version, `by nc nd sa`) must stand in the
matched words exactly and side by side, else the match counts for nothing: a license that is not in the list gets no label of a
near sibling.

Beside the notices, base phrases are counted exactly at every place where their words stand consecutively.

Each document is a task-local row: there is no shuffle. A document's cost depends on its own text only.

Defined cases. NULL and empty texts have no words, empty labels and score 0. Repeated rows are scanned row by row. Other
columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from leaguelake.llm.common import batches_of, mapped

EDIT_SPAN = 12
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")  # fixed by the contract, over UTF-8
# fixed by the contract
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")
CC_KINDS = ("by", "by sa", "by nd", "by nc", "by nc sa", "by nc nd")
# short notices of well-known public licenses, as words
NOTICES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "licensed under the apache license version 1 1": "apache-1.1",
    "licensed under the apache license version 1 0": "apache-1.0",
    "released under the mit license": "mit",
    "licensed under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution noderivatives": "cc-by-nd",
    "creative commons attribution noncommercial sharealike": "cc-by-nc-sa",
    "creative commons attribution noncommercial noderivatives": "cc-by-nc-nd",
    "this work is licensed under the gnu general public license version 3": "gpl-3.0",
    "this work is licensed under the gnu general public license version 2": "gpl-2.0",
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license version 2 0": "mpl-2.0",
    "mozilla public license version 1 1": "mpl-1.1",
    "mozilla public license version 1 0": "mpl-1.0",
    "eclipse public license": "epl",
    "redistribution and use in source and binary forms": "bsd",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "free and unencumbered software released into the public domain": "unlicense",
    "spdx license identifier": "spdx",
    "all rights reserved": "reserved",
    **{
        f"licensed under cc {kind} {version}": f"cc-{kind.replace(' ', '-')}-{version.replace(' ', '.')}"
        for kind in CC_KINDS
        for version in CC_VERSIONS
    },
    **{f"creative commons attribution {version} international": f"cc-by-{version.replace(' ', '.')}" for version in CC_VERSIONS},
}
# words that tell a notice from its siblings, by its label; all of a notice's runs must be met word for word
DISTINCT = {
    "apache-2.0": ["2 0"], "apache-1.1": ["1 1"], "apache-1.0": ["1 0"], "mpl-2.0": ["2 0"], "mpl-1.1": ["1 1"], "mpl-1.0": ["1 0"],
    "gpl-3.0": ["version 3"], "gpl-2.0": ["version 2"],
}


def distinct_words(phrase: str, label: str) -> list[str]:
    """Runs of words that an occurrence of the notice must hold unchanged."""
    if phrase.startswith("licensed under cc "):
        return [phrase.removeprefix("licensed under ")]
    if phrase.startswith("creative commons attribution ") and phrase.endswith(" international"):
        return [" ".join(phrase.split()[-3:-1])]
    if label == "mit" and " mit " in phrase:
        return ["mit"]
    return DISTINCT.get(label, [])


COLUMNS = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, "
    "spans array<struct<label: string, start: bigint, end: bigint, edits: bigint>>"
)


class Scanner:
    """Seeds and verifiers of a set of notices."""

    def __init__(self, notices: dict[str, str] = NOTICES) -> None:
        self.notices = list(notices.items())
        self.distinct = [distinct_words(phrase, label) for phrase, label in self.notices]
        # of each notice, those whose phrase holds its own
        self.wider = [{n for n, (whole, _) in enumerate(self.notices) if phrase != whole and phrase in whole} for phrase, _ in self.notices]
        self.edits = [max(1, len(phrase) // EDIT_SPAN) for phrase, _ in self.notices]
        self.exact = [f"(?:{regex.escape(phrase)}){{e<={k}}}" for (phrase, _), k in zip(self.notices, self.edits)]
        self.verify = [regex.compile(p, regex.BESTMATCH) for p in self.exact]
        seeds: dict[str, list[tuple[int, int]]] = {}
        for number, ((phrase, _), k) in enumerate(zip(self.notices, self.edits)):
            cuts = [len(phrase) * i // (k + 1) for i in range(k + 2)]
            for a, b in zip(cuts, cuts[1:]):
                seeds.setdefault(phrase[a:b], []).append((number, a))
        self.automaton = ahocorasick.Automaton()
        for piece, places in seeds.items():
            self.automaton.add_word(piece, (len(piece), places))
        self.automaton.make_automaton()

    def _distinct(self, joined: str, number: int, start: int, end: int) -> bool:
        """Whether the whole words around a match hold all that tells its notice from siblings."""
        words = joined[joined.rfind(" ", 0, start + 1) : joined.find(" ", end - 1) + 1]
        return all(f" {run} " in words for run in self.distinct[number])

    def _matches(self, number: int, joined: str, low: int, high: int) -> Iterator[regex.Match]:
        """Matches of a notice: the best one of a stretch, and those before and behind it.

        A long range is searched in stretches that share the length of a match, so each match lies whole in one of them.
        """
        size, k = len(self.notices[number][0]), self.edits[number]
        shortest, longest = size - k, size + k
        ranges = [(a, min(high, a + 16 * longest)) for a in range(low, max(low + 1, high - longest), 15 * longest)]
        while ranges:
            low, high = ranges.pop()
            match = self.verify[number].search(joined, low, high) if high - low >= shortest else None
            if match:
                yield match
                ranges += [(low, match.start()), (match.end(), high)]

    def find(self, joined: str, exact: bool = False) -> list[tuple[int, int, int, int]]:
        """(notice, start, end, edits) of notices in words joined by spaces; of overlapping ones the closest, then longest.

        With ``exact`` a match counts only where the words that tell its notice from siblings are unchanged.
        """
        candidates: dict[int, list[list[int]]] = {}
        for last, (size, places) in self.automaton.iter(joined):
            for number, offset in places:
                begin = last + 1 - size - offset
                k, length = self.edits[number], len(self.notices[number][0])
                low, high = max(0, begin - k), min(len(joined), begin + length + k)
                spans = candidates.setdefault(number, [])
                if spans and low <= spans[-1][1]:
                    spans[-1] = [min(spans[-1][0], low), max(spans[-1][1], high)]
                else:
                    spans.append([low, high])
        found = []
        for number, spans in candidates.items():
            for low, high in spans:
                for match in self._matches(number, joined, low, high):
                    if not exact or self._distinct(joined, number, match.start(), match.end()):
                        found.append((number, match.start(), match.end(), sum(match.fuzzy_counts)))
        # a notice that is part of another's phrase gives way to it; matches of one notice do not overlap
        spans_of: dict[int, list[tuple[int, int]]] = {}
        for number, start, end, _ in sorted(found):
            spans_of.setdefault(number, []).append((start, end))

        def covered(hit: tuple[int, int, int, int]) -> bool:
            for number in self.wider[hit[0]] & spans_of.keys():
                before = bisect(spans_of[number], hit[1], key=lambda span: span[0])
                if before and spans_of[number][before - 1][1] >= hit[2]:
                    return True
            return False

        found = [hit for hit in found if not covered(hit)]
        kept: list[tuple[int, int, int, int]] = []
        for hit in sorted(found, key=lambda h: (h[3] / len(self.notices[h[0]][0]), h[1] - h[2], h)):
            place = bisect(kept, hit[1], key=lambda other: other[1])
            if (not place or kept[place - 1][2] <= hit[1]) and (place == len(kept) or kept[place][1] >= hit[2]):
                kept.insert(place, hit)
        return kept

    def scan(self, text: bytes | None) -> tuple:
        """All columns but the id, for UTF-8 text."""
        lowered = (text or b"").lower()
        words = WORD.findall(lowered)
        joined = b" " + b" ".join(words) + b" "
        places: list[int] = []
        base = set()
        for phrase, label in BASE.items():
            sought = b" " + phrase.encode() + b" "
            at, passed, word = joined.find(sought), 0, 0
            while at >= 0:
                word, passed = word + joined.count(b" ", passed, at), at
                places.append(word)
                base.add(label)
                at = joined.find(sought, at + 1)
        plain = joined.decode("utf-8")
        hits = self.find(plain, exact=True)
        labels = base | {self.notices[number][1] for number, *_ in hits}
        score = 1.0 if base else 0.0
        spans = []
        if hits:
            offsets = self._offsets(lowered)
            passed = spaces = 0
            for number, start, end, edits in hits:
                phrase, label = self.notices[number]
                score = max(score, 1.0 - edits / len(phrase))
                begin, stop = start + (plain[start] == " "), end - (plain[end - 1] == " ")
                spaces, passed = spaces + plain.count(" ", passed, begin), begin
                first = spaces - 1
                last = max(first, first + plain.count(" ", begin, stop))
                spans.append({"label": label, "start": offsets[max(0, first)][0], "end": offsets[min(last, len(offsets) - 1)][1], "edits": edits})
        first_last = (min(places), max(places)) if places else (None, None)
        return len(words), len(places), *first_last, ",".join(sorted(base)), ",".join(sorted(labels)), score, spans

    @staticmethod
    def _offsets(lowered: bytes) -> list[tuple[int, int]]:
        """Character offsets of the words in the text."""
        pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
        return [m.span() for m in pattern.finditer(lowered.decode("utf-8"))]


def _scan_rows(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scanner = Scanner()
    spans_type = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int64())]))
    types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), spans_type]
    names = [c.split()[0] for c in COLUMNS.split(", ")[:8]] + ["spans"]
    for piece, (texts,) in batches_of(rows, "text"):
        columns = list(zip(*(scanner.scan(t) for t in texts)))
        yield pa.record_batch([piece.column(0), *[pa.array(c, t) for c, t in zip(columns, types)]], names=names)


def scan(docs: DataFrame) -> DataFrame:
    """Words, base places, labels, score and the spans of notices of every document."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return mapped(texts, _scan_rows, COLUMNS)
