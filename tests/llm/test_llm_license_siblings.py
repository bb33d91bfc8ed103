"""Licenses and versions that differ in one word get their own label or none."""

import pytest

from leaguelake.llm import license_scan as l


def labels(text):
    return l.Scanner().scan(text.encode())[5]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("released under the MPL license", ""),
        ("released under the MIT license", "mit"),
        ("licensed under the Apache License, Version 1.0", "apache-1.0"),
        ("licensed under the Apache License, Version 3.0", ""),
        ("Licenced under the Apach License, Version 2.0", "apache-2.0"),
        ("licensed under CC BY-ND 4.0", "cc-by,cc-by-nd-4.0"),
        ("licensed under CC BY 3.0", "cc-by,cc-by-3.0"),
        ("licensed under CC BY 9.0", "cc-by"),
        ("licensed under CC BY-NC-ND 4.0", "cc-by,cc-by-nc-nd-4.0"),
        ("licenced under CC BY-NC-SA 3.0", "cc-by,cc-by-nc-sa-3.0"),
        ("Mozilla Public License, version 1.1", "mpl-1.1"),
        ("Mozila Public License, version 2.0", "mpl-2.0"),
        ("Mozilla Public License, version 3.0", ""),
        ("Creative Commons Attribution-NonCommercial 4.0 International", "cc-by-nc"),
        ("Creative Commons Attribution-NonCommercial-ShareAlike 4.0", "cc-by-nc-sa"),
        ("Creative Commons Attribution 3.0 International", "cc-by-3.0"),
        ("this work is licensed under the GNU General Public License version 2", "gpl,gpl-2.0"),
        ("this work is licenced under the GNU General Public License version 3", "gpl,gpl-3.0"),
    ],
)
def test_siblings(text, want):
    assert labels(text) == want


def test_every_notice_finds_its_own_label_alone():
    """Also with an edit in each of its common words."""
    scanner = l.Scanner()
    for phrase, label in l.NOTICES.items():
        base = {v for k, v in l.BASE.items() if f" {k} " in f" {phrase} "}
        assert set(scanner.scan(phrase.encode())[5].split(",")) == base | {label}, phrase
        kept = set(" ".join(l.distinct_words(phrase, label)).split())
        for word in set(phrase.split()) - kept:
            if len(word) > 5 and len(phrase) >= 2 * l.EDIT_SPAN:
                changed = phrase.replace(word, word[:2] + word[3:], 1)
                assert label in scanner.scan(changed.encode())[5].split(","), changed


def test_close_matches_before_and_behind_the_best_one():
    text = "licensd under cc by 4 0 licensed under cc by 4 0 licensed undr cc by 4 0"
    spans = l.Scanner().scan(text.encode())[7]
    assert [(s["label"], s["edits"]) for s in spans] == [("cc-by-4.0", 1), ("cc-by-4.0", 0), ("cc-by-4.0", 1)]


def test_a_text_full_of_notices_takes_linear_time():
    import time

    scanner, took = l.Scanner(), []
    for n in (2_000, 8_000):
        begin = time.perf_counter()
        out = scanner.scan(b"this work is licenced under the gnu general public license version 3. all rights reserved. " * n)
        took.append(time.perf_counter() - begin)
        assert out[5] == "gpl,gpl-3.0,reserved" and len(out[7]) == 2 * n
    assert took[1] < 10 * took[0]
