"""Format-preserving pseudonyms for personal data.

Numbers and dates are found by pattern, validated (check digits, number plans, calendar), and replaced by another valid
value of the same format. The replacement is a keyed permutation of the values of that kind: a Feistel network over the
numbers below N, repeated until the result is valid (cycle walking). Equal values get equal pseudonyms in all documents,
different values different ones, and the owner of the key can invert them. Separators, length and country or area
prefixes outside the permuted part stay.

| kind | validated by | permuted |
|---|---|---|
| card | 13 to 19 digits, Luhn | all digits but the first; the last is the check digit anew |
| iban | country, mod 97 | digits after the check digits, which are made anew |
| ssn | area, group and serial rules | all nine digits |
| phone | ten digits with separators, area and exchange from 200 | the ten digits; a country code stays |
| phone with + and a country code but 1 | 8 to 15 digits | digits after the country code and one more |
| ipv4 | four numbers up to 255 | all 32 bits |
| date | a calendar day from 1900 to 2099 in one of four layouts | the day, among days up to or beyond the 12th |
| email | letters or digits before the @ | these, each in its alphabet; the domain stays |

A pattern's find is only a candidate. Where it fails, the parts of it that end or begin at a word are tried too, so a value keeps
its pseudonym whatever numbers stand beside it: cards are sought in their printed groups first, an IBAN at its country's length.
With slashes the month is read first, and the day where that is no calendar day.

Each document is a task-local row: there is no shuffle, and the link between documents is the key alone. ``places`` says where the
pseudonyms stand, so that the owner of the key restores exactly these.

Defined cases. NULL text stays NULL and has no places. Values that fail validation stay as they are. Of overlapping finds the kind
first in ``KINDS`` wins. Letters outside the alphabets stay. Repeated rows are treated alike. Other columns are not read. Without a
key, a call draws a random one, which links values within that call and is then lost.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import re
import secrets
from bisect import bisect
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from leaguelake.llm.common import batches_of, mapped

ROUNDS = 10
# for the registered query, whose rows must be alike in all runs; a corpus needs a secret of its own
EXAMPLE_KEY = b"example key, not a secret"


class Feistel:
    """Keyed permutation of the numbers below ``size``."""

    def __init__(self, key: bytes, kind: str, size: int) -> None:
        self.size = size
        self.left = max(1, math.isqrt(size - 1) + 1) if size > 1 else 1
        self.right = -(-size // self.left)
        self.width = size.bit_length() // 8 + 1
        self.keyed = hashlib.shake_256(hashlib.sha256(key).digest() + f"{kind}:{size}:".encode())

    def _round(self, number: int, value: int, modulus: int) -> int:
        state = self.keyed.copy()
        state.update(bytes([number]) + value.to_bytes(self.width, "little"))
        return int.from_bytes(state.digest(self.width + 8), "little") % modulus

    def _once(self, value: int, back: bool) -> int:
        a, b = divmod(value, self.right)
        for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
            sign = -1 if back else 1
            if i % 2:
                b = (b + sign * self._round(i, a, self.right)) % self.right
            else:
                a = (a + sign * self._round(i, b, self.left)) % self.left
        return a * self.right + b

    def apply(self, value: int, valid: Callable[[int], bool] = lambda _: True, back: bool = False) -> int:
        """Image of a valid value among the valid values; ``back`` gives the value of an image."""
        while True:
            value = self._once(value, back)
            if value < self.size and valid(value):
                return value


def luhn(digits: str) -> int:
    """Luhn sum of digits, 0 modulo 10 for a valid number."""
    own = [int(c) for c in reversed(digits)]
    return (sum(own[0::2]) + sum(sum(divmod(2 * d, 10)) for d in own[1::2])) % 10


def _mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


def _refilled(found: str, chars: str) -> str:
    """``found`` with its letters and digits replaced in turn."""
    new = iter(chars)
    return "".join(next(new) if c.isalnum() else c for c in found)


def _ssn(n: int) -> bool:
    area, group, serial = n // 1_000_000, n // 10_000 % 100, n % 10_000
    return area not in (0, 666) and area < 900 and group > 0 and serial > 0


def _phone(n: int) -> bool:
    return n // 10**9 >= 2 and n // 10**6 % 10 >= 2


FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()
# month and day places of the layouts of each separator, in the order tried
DATES = {
    "-": [(re.compile(r"(?P<y>[0-9]{4})-(?P<m>[0-9]{2})-(?P<d>[0-9]{2})"), "%Y-%m-%d")],
    "/": [
        (re.compile(r"(?P<m>[0-9]{2})/(?P<d>[0-9]{2})/(?P<y>[0-9]{4})"), "%m/%d/%Y"),
        (re.compile(r"(?P<d>[0-9]{2})/(?P<m>[0-9]{2})/(?P<y>[0-9]{4})"), "%d/%m/%Y"),
    ],
    ".": [(re.compile(r"(?P<d>[0-9]{2})\.(?P<m>[0-9]{2})\.(?P<y>[0-9]{4})"), "%d.%m.%Y")],
}
EDGE, END = r"(?<![\w.@+-])", r"(?![\w@]|[.-][0-9])"
INTERNATIONAL = r"\+[2-9](?:(?: ?\(|\)[ -]?|[ ./-])?[0-9]){7,14}"
NORTH_AMERICAN = r"(?:\+?[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-]?)[0-9]{3}[ .-]?[0-9]{4}"
_LOCAL = r"\w.%+\u0300-\u036f-"
PATTERNS = {
    "email": re.compile(rf"(?<![{_LOCAL}])[{_LOCAL}]+@[\w-]+(?:\.[\w-]+)*\.[^\W\d_]{{2,}}(?![\w@])"),
    "iban": re.compile(EDGE + r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?" + END),
    "card": re.compile(EDGE + r"[0-9](?:[ -]?[0-9]){12,18}" + END),
    "ssn": re.compile(EDGE + r"[0-9]{3}-[0-9]{2}-[0-9]{4}" + END),
    "ipv4": re.compile(EDGE + r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}" + END),
    "phone": re.compile(EDGE + f"(?:{INTERNATIONAL}|{NORTH_AMERICAN})" + END),
    "date": re.compile(EDGE + r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})" + END),
}
# groups in which cards are printed, the usual one first
CARD_FORMS = [
    re.compile(EDGE + form + END)
    for form in (r"[0-9]{4}(?:([ -])[0-9]{4})(?:\1[0-9]{4}){2}", r"[0-9]{4}([ -])[0-9]{6}\1[0-9]{4,5}", r"[0-9]{4}(?:([ -])[0-9]{4})(?:\1[0-9]{4}){2}\1[0-9]{3}", r"[0-9]{13,19}")
]
# fixed values: characters of an IBAN by country
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "CH": 21, "CR": 22, "CY": 28, "CZ": 24,
    "DE": 22, "DK": 18, "DO": 28, "EE": 20, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28,
    "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LI": 21, "LT": 20, "LU": 20, "LV": 21,
    "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29,
    "RO": 24, "RS": 22, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TN": 24, "TR": 26, "UA": 29, "VG": 24, "XK": 20,
}
# fixed values: country codes of two digits; 1 and 7 have one, all others three
TWO_DIGIT_CODES = frozenset("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
# first and last small letter of runs of code points whose capitals are as many letters
ALPHABETS = [("a", "z"), ("à", "ö"), ("ø", "þ"), ("α", "ρ"), ("σ", "ω"), ("а", "я")]


def _alphabet(c: str) -> tuple[int, int] | None:
    """First code point and size of the run of digits or letters, of one case, that ``c`` belongs to."""
    if "0" <= c <= "9":
        return ord("0"), 10
    for first, last in ALPHABETS:
        for a, b in ((first, last), (first.upper(), last.upper())):
            if a <= c <= b:
                return ord(a), ord(b) - ord(a) + 1
    return None


KINDS = tuple(PATTERNS)
COUNTS = tuple(f"n_{kind}" for kind in KINDS)


class Pseudonyms:
    """Replacement of single values; ``back`` inverts."""

    def __init__(self, key: bytes, back: bool = False) -> None:
        self.key, self.back = key, back
        self.made: dict[tuple[str, int], Feistel] = {}

    def _permuted(self, kind: str, value: int, size: int, valid: Callable[[int], bool] = lambda _: True) -> int:
        if (kind, size) not in self.made:
            if len(self.made) > 10_000:
                self.made.clear()
            self.made[kind, size] = Feistel(self.key, kind, size)
        return self.made[kind, size].apply(value, valid, self.back)

    def email(self, found: str) -> str | None:
        local, domain = found.split("@")
        runs = [_alphabet(c) for c in local]
        if not any(runs):
            return None
        # one number in mixed radix, so that case, digits and letters stay where they are
        value, shape = 0, ""
        for c, run in zip(local, runs):
            if run:
                value = value * run[1] + ord(c) - run[0]
                shape += "9" if run[1] == 10 else chr(run[0]).lower()
        value = self._permuted(f"email {shape}", value, math.prod(run[1] for run in runs if run))
        out = []
        for c, run in zip(reversed(local), reversed(runs)):
            if run:
                value, rest = divmod(value, run[1])
                c = chr(run[0] + rest)
            out.append(c)
        return "".join(reversed(out)) + "@" + domain

    def card(self, found: str) -> str | None:
        digits = re.sub(r"\D", "", found)
        if luhn(digits):
            return None
        body = digits[:1] + f"{self._permuted('card', int(digits[1:-1]), 10 ** (len(digits) - 2)):0{len(digits) - 2}d}"
        return _refilled(found, body + str(-luhn(body + "0") % 10))

    def iban(self, found: str) -> str | None:
        plain = found.replace(" ", "")
        if not 15 <= len(plain) <= 34 or _mod97(plain[4:] + plain[:4]) != 1:
            return None
        account = plain[4:]
        digits = "".join(c for c in account if c.isdigit())
        if not digits:
            return None
        new = iter(f"{self._permuted('iban', int(digits), 10 ** len(digits)):0{len(digits)}d}")
        account = "".join(next(new) if c.isdigit() else c for c in account)
        return _refilled(found, f"{plain[:2]}{98 - _mod97(account + plain[:2] + '00'):02d}{account}")

    def ssn(self, found: str) -> str | None:
        value = int(found.replace("-", ""))
        return _refilled(found, f"{self._permuted('ssn', value, 10**9, _ssn):09d}") if _ssn(value) else None

    def phone(self, found: str) -> str | None:
        digits = re.sub(r"\D", "", found)
        if digits == found:  # a bare run of digits may be anything
            return None
        if found[0] == "+" and digits[0] != "1":
            stay = 1 + (1 if digits[0] == "7" else 2 if digits[:2] in TWO_DIGIT_CODES else 3)
            size = len(digits) - stay
            return _refilled(found, digits[:stay] + f"{self._permuted(f'phone {digits[:stay]}', int(digits[stay:]), 10**size):0{size}d}")
        value = int(digits[-10:])
        return _refilled(found, digits[:-10] + f"{self._permuted('phone', value, 10**10, _phone):010d}") if _phone(value) else None

    def ipv4(self, found: str) -> str | None:
        parts = [int(p) for p in found.split(".")]
        if max(parts) > 255 or any(len(p) > 1 and p[0] == "0" for p in found.split(".")):
            return None
        value = self._permuted("ipv4", int.from_bytes(bytes(parts), "big"), 1 << 32)
        return ".".join(map(str, value.to_bytes(4, "big")))

    def date(self, found: str) -> str | None:
        for pattern, layout in DATES[next(c for c in found if not c.isdigit())]:
            match = pattern.fullmatch(found)
            try:
                day = dt.date(int(match["y"]), int(match["m"]), int(match["d"]))
            except ValueError:
                continue
            if not FIRST_DAY <= day.toordinal() <= LAST_DAY:
                return None
            # a day beyond the 12th stays beyond it, so the layout is read alike in the pseudonym
            alike = lambda n: (dt.date.fromordinal(FIRST_DAY + n).day > 12) == (day.day > 12)
            return dt.date.fromordinal(FIRST_DAY + self._permuted("date", day.toordinal() - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, alike)).strftime(layout)
        return None

    def _parts(self, kind: str, text: str, a: int, b: int) -> Iterator[tuple[int, int]]:
        """Parts of a candidate that may be a value, in the order in which they are tried."""
        if kind == "card":
            for begin in range(a, b):
                for form in CARD_FORMS:
                    match = form.match(text, begin)
                    if match:
                        yield match.span()
        if kind == "iban":
            ends = [b, *[i for i in range(b - 1, a, -1) if text[i] == " "]]
            size = IBAN_LENGTHS.get(text[a : a + 2])
            for end in sorted(ends, key=lambda e: e - a - text.count(" ", a, e) != size):
                yield a, end
        else:
            yield a, b

    def replace(self, text: str) -> tuple[str, list[int]]:
        """Text with pseudonyms, and the number of replacements of each kind."""
        new, places = self.located(text)
        return new, _counts(places)

    def located(self, text: str) -> tuple[str, list[tuple[int, int, int]]]:
        """Text with pseudonyms, and the kind (by place in ``KINDS``), start and end of each in it, by start."""
        spans: list[tuple[int, int, int, str]] = []  # in order, not overlapping
        for i, kind in enumerate(KINDS):
            if kind == "email" and "@" not in text:
                continue
            pattern, value, at = PATTERNS[kind], getattr(self, kind), 0
            while match := pattern.search(text, at):
                at = match.start() + 1
                for a, b in self._parts(kind, text, *match.span()):
                    place = bisect(spans, (a, b))
                    if (place and spans[place - 1][1] > a) or (place < len(spans) and spans[place][0] < b):
                        continue
                    new = value(text[a:b])
                    if new is not None:
                        spans.insert(place, (a, b, i, new))
                        at = b
                        break
        return _spliced(text, spans)

    def restore(self, text: str, places: Iterable[tuple[int, int, int]]) -> tuple[str, list[tuple[int, int, int]]]:
        """As ``located``, of the values at known places."""
        return _spliced(text, [(a, b, i, getattr(self, KINDS[i])(text[a:b])) for i, a, b in places])


def _counts(places: Iterable[tuple[int, int, int]]) -> list[int]:
    counts = [0] * len(KINDS)
    for i, *_ in places:
        counts[i] += 1
    return counts


def _spliced(text: str, spans: list[tuple[int, int, int, str]]) -> tuple[str, list[tuple[int, int, int]]]:
    out, places, at, size = [], [], 0, 0
    for a, b, i, new in spans:
        out += [text[at:a], new]
        size += a - at + len(new)
        places.append((i, size - len(new), size))
        at = b
    return "".join([*out, text[at:]]), places


SUSPECT = re.compile(r"[0-9@]")
PLACES = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _replace_rows(key: bytes, back: bool, known: bool) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pseudonyms = Pseudonyms(key, back)
        for piece, (*given, texts) in batches_of(rows, *(["places"] if known else []), "text"):
            out, places = [], []
            for i, text in enumerate(texts):
                if known and text is not None:
                    new, at = pseudonyms.restore(text, [(KINDS.index(p["kind"]), p["start"], p["end"]) for p in given[0][i] or ()])
                else:
                    new, at = pseudonyms.located(text) if text and SUSPECT.search(text) else (text, [])
                out.append(new)
                places.append(at)
            counts = [pa.array(c, pa.int64()) for c in zip(*map(_counts, places))]
            found = pa.array([[{"kind": KINDS[i], "start": a, "end": b} for i, a, b in at] for at in places], PLACES)
            yield pa.record_batch([piece.column(0), pa.array(out, pa.string()), *counts, found], names=["doc_id", "text", *COUNTS, "places"])

    return run


def pseudonymised(docs: DataFrame, key: bytes | None = None, back: bool = False) -> DataFrame:
    """doc_id, text with pseudonyms, the number of replacements of each kind, and their places in the text.

    ``back`` restores the values: at ``places`` where ``docs`` has the column as given out here, else where values are found.
    """
    found = "places array<struct<kind: string, start: bigint, end: bigint>>"
    known = back and dict(docs.dtypes).get("places") == found.removeprefix("places ").replace(": ", ":").replace(", ", ",")
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), *(["places"] if known else []), F.col("text").cast("string").alias("text")
    )
    schema = ", ".join(["doc_id bigint", "text string", *[f"{c} bigint" for c in COUNTS], found])
    return mapped(rows, _replace_rows(key or secrets.token_bytes(32), back, known), schema)
