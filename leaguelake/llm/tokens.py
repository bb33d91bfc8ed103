"""Encoding of whole texts with a public tokenizer, word by word where that gives the same ids."""

from __future__ import annotations

import json
import os
import re
import sys
import types
import unicodedata
from array import array

import numpy as np

TOKENIZER = "word_bpe_49k.json"
# words kept per worker process; later words are encoded each time they come
MAX_WORDS = 500_000
# ASCII punctuation between a letter or digit and white space is a piece of its own
_END = re.compile(r"(?<=[^\W_])[!-/:-@\[-^`{-~]+(?=[ \n]|$)")


def _joining() -> re.Pattern:
    """Combining marks, and letters whose composed lower-case form ends in one: a mark joins the punctuation behind it."""
    letters = filter(str.isalnum, map(chr, range(0xC0, sys.maxunicode + 1)))
    joining = [c for c in letters if not unicodedata.normalize("NFC", c).lower()[-1].isalnum()]
    return re.compile("[\u0300-\u036f" + "".join(joining) + "]")


def tokenizer_json(path: str | None = None) -> str:
    """Content of a tokenizer file, to be sent to the tasks; by default the public one for words."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    with open(path, encoding="utf-8") as file:
        return file.read()


def process_state() -> dict:
    """Values that live as long as the Python worker, shared by the tasks it runs."""
    return vars(sys.modules.setdefault("_leaguelake_worker", types.ModuleType("_leaguelake_worker")))


class Encoder:
    """Ids of texts as little-endian bytes, two to an id below 65,536 ids and else four.

    A tokenizer that lower-cases, drops white space and never joins what white space parts gives a text the ids of its
    words one after another. For such a one, texts are cut at spaces and line ends and each different word is encoded once.
    Texts where cutting or lower-casing A-Z first could change ids (special token strings, combining marks, letters that are
    composed or lower-cased to end in a mark) are encoded whole.
    """

    def __init__(self, content: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        spec = json.loads(content)
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        normalizers = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        self.by_word = "Lowercase" in normalizers and steps[0].get("type") == "Split" and steps[0].get("behavior") == "Removed" and bool(steps[0].get("invert"))
        # the model sees bytes as printable characters: itself where printable in Latin-1, else the next of U+0100 and on
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        hidden = [b for b in range(256) if b not in shown]
        self.shown = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.words: dict[str, bytes] = {}
        self.joining = _joining()

    @classmethod
    def here(cls, content: str) -> Encoder:
        """The encoder of this worker process."""
        state = process_state()
        if state.get("content") != content:
            state["content"], state["encoder"] = content, cls(content)
        return state["encoder"]

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [array(self.dtype.char, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of different words. A word of Latin-1 letters is one piece that only lower-casing changes, so it goes to the
        tokenizer's model directly."""
        found: dict[str, bytes] = {}
        rest = []
        tokenize, code = self.tokenizer.model.tokenize, self.dtype.char
        for word in words:
            if word.isascii() and word.isalpha():
                found[word] = array(code, [t.id for t in tokenize(word)]).tobytes()
            elif word.isalpha() and max(word) < "\u0100":
                found[word] = array(code, [t.id for t in tokenize(word.lower().encode().decode("latin-1").translate(self.shown))]).tobytes()
            else:
                rest.append(word)
        found.update(zip(rest, self._whole(rest)))
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return self._whole(texts)
        out: list[bytes] = []
        for text in texts:
            if "<|" in text or self.joining.search(text):
                out += self._whole([text])
                continue
            lowered = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
            words = _END.sub(r" \g<0>", lowered).replace("\n", " ").split(" ")
            ids = list(map(self.words.get, words))
            if None in ids:
                new = self._encode_words(list({w for w, known in zip(words, ids) if known is None}))
                if len(self.words) < MAX_WORDS:
                    self.words.update(new)
                ids = [new[w] if known is None else known for w, known in zip(words, ids)]
            out.append(b"".join(ids))
        return out
