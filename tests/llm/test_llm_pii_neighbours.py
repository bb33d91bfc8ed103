"""Values beside other digits and words, further layouts, and a plain search over all parts of a text."""

import random

import pytest

from leaguelake.llm import pii_pseudonyms as q

KEY = b"k"
NEIGHBOURS = [
    ("card", "4111 1111 1111 1111", ["{} 12/27", "{} 123", "order 12 {}", "12 {} 12/27", "{} {}", "call 212 555 0123 {}"]),
    ("card", "3782 822463 10005", ["{} 12", "7 {}"]),
    ("iban", "AT61 1904 3002 3457 3201", ["{} BIC", "IBAN {} BIC", "{} 2020", "{} {}"]),
    ("iban", "ES91 2100 0418 4502 0005 1332", ["{} VISA", "{} 12 A"]),
    ("phone", "+49 30 1234567", ["{}", "tel {}.", "{}, {}"]),
    ("phone", "+33 1 42 68 53 00", ["{}", "({})"]),
    ("phone", "+49 (0)30 1234567", ["{}"]),
    ("date", "25/12/2020", ["{}", "on {}.", "05/12/2020 {}"]),
    ("email", "jörg@example.com", ["{}", "<{}>"]),
    ("email", "müller.anna@example.com", ["{}"]),
    ("email", "ЮРИЙ.7²@пример.com", ["{}"]),
    ("email", "jörg@example.com", ["{}"]),
]


@pytest.mark.parametrize(("kind", "value", "around"), [(k, v, a) for k, v, every in NEIGHBOURS for a in every])
def test_neighbours(kind, value, around):
    there, back = q.Pseudonyms(KEY), q.Pseudonyms(KEY, back=True)
    text = around.replace("{}", value)
    new, places = there.located(text)
    alone = there.replace(value)[0]
    assert alone != value
    assert [new[a:b] for i, a, b in places if q.KINDS[i] == kind].count(alone) == around.count("{}")
    assert value not in new and back.restore(new, places)[0] == text


def test_dates_link_across_four_layouts():
    p = q.Pseudonyms(KEY)
    for day in ("13", "25", "31"):
        y, m, d = p.replace(f"2020-12-{day}")[0].split("-")
        assert p.replace(f"{day}/12/2020")[0] == f"{d}/{m}/{y}" and p.replace(f"12/{day}/2020")[0] == f"{m}/{d}/{y}"
        assert p.replace(f"{day}.12.2020")[0] == f"{d}.{m}.{y}" and int(d) > 12
    assert int(p.replace("2020-12-05")[0][-2:]) <= 12


def valid(kind, text):
    return getattr(q.Pseudonyms(KEY), kind)(text) is not None


def test_no_valid_value_in_printed_form_is_left():
    """Every part of a text that is a printed card, a mail address or an IBAN of its country's length lies in some place."""
    rng = random.Random(9)
    pieces = ["4111 1111 1111 1111", "5500-0000-0000-0004", "3782 822463 10005", "340000000000009", "AT61 1904 3002 3457 3201", "DE89370400440532013000",
              "12", "123", "12/27", "BIC", "VISA", "2020", "1234", "0000", "a@b.cd", "order", "7", "2021-02-28"]
    for _ in range(400):
        text = " ".join(rng.choice(pieces) for _ in range(rng.randrange(1, 9)))
        new, places = q.Pseudonyms(KEY).located(text)
        back, old = q.Pseudonyms(KEY, back=True).restore(new, places)
        assert back == text
        borders = [0, *[i + 1 for i, c in enumerate(text) if c == " "]]
        ends = [*[i for i, c in enumerate(text) if c == " "], len(text)]
        for a in borders:
            for b in ends:
                part = text[a:b]
                kinds = [k for k in ("iban", "email") if q.PATTERNS[k].fullmatch(part)] + ["card"] * any(f.fullmatch(part) for f in q.CARD_FORMS)
                sized = "iban" not in kinds or len(part.replace(" ", "")) == q.IBAN_LENGTHS.get(part[:2])
                if b > a and kinds and sized and any(valid(k, part) for k in kinds):
                    assert any(s < b and a < e for _, s, e in old), (text, part)


def test_clean_numbers_stay():
    for text in ("1 2 3 4 5 6 7 8", "+49", "+49 12", "31/02/2020", "32/12/2020", "12/13/1850", "1900 12 2100", "١٢٣-٤٥-٦٧٨٩ 1", "@", "²@x.org 1"):
        assert q.Pseudonyms(KEY).replace(text) == (text, [0] * len(q.KINDS))


def test_tables_restore_by_places(documents):
    texts = ["1234 4111 1111 1111 1111 12/27", "25/12/2020 +49 30 1234567 12", "8.8.8.8 jörg@example.com", None, "", "none"] * 20
    docs = documents(list(enumerate(texts)), clashing=True)
    there = q.pseudonymised(docs, KEY).cache()
    got = {r["doc_id"]: r for r in there.collect()}
    assert all(got[i]["places"] == [] for i, t in enumerate(texts) if not t or t == "none")
    assert all(got[i]["text"] != t for i, t in enumerate(texts) if t and t != "none")
    assert {r["doc_id"]: r["text"] for r in q.pseudonymised(there, KEY, back=True).collect()} == dict(enumerate(texts))


def test_a_call_without_key_keeps_no_key(documents):
    docs = documents([(1, "4111 1111 1111 1111 and 4111-1111-1111-1111"), (2, "4111111111111111")])
    digits = lambda s: "".join(c for c in s if c.isdigit())
    first, second = (sorted(digits(r["text"]) for r in q.pseudonymised(docs).collect()) for _ in range(2))
    assert first[0] * 2 == first[1] and first != second
