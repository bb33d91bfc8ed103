"""Edit-aware token counts.

The tokenizer cuts a text into pieces by a pattern and encodes each piece by itself. A document's pieces are kept in
blocks of BLOCK pieces under a segment tree that sums characters, pieces and tokens. An edit finds its place by
descending the tree, cuts the text anew from two pieces before the edit, and stops at the first new cut beyond the edit that
falls on an old one: from there on the pattern sees the same text, so all further pieces and their counts stay. Only the
new pieces are encoded; the sums above the touched blocks are updated.

Documents travel with their edits in an array column, so there is no shuffle and no group; what a task holds is one
slice of documents. The trees can be stored as two arrays per document (``trees``) and edited later (``edited``).

Defined cases. NULL text counts as empty: no pieces, no tokens. NULL or empty edits change nothing. Edits are applied in the
order listed, each to the text that the ones before it left; places beyond the text are moved to its end. Repeated rows are
counted row by row. Other columns are not read.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from leaguelake.llm.common import batches_of, mapped
from leaguelake.llm.tokens import process_state

TOKENIZER = "byte_bpe_50k.tiktoken"
BLOCK = 64
MAX_PIECES = 400_000


def tokenizer_ranks(path: str | None = None) -> tuple[bytes, str]:
    """Content of a rank file and its pattern, to be sent to the tasks; by default the public byte-level one."""
    import public_tokenizers

    with open(path or public_tokenizers.path(TOKENIZER), "rb") as file:
        return file.read(), public_tokenizers.PATTERN


class PieceCounter:
    """Cuts texts into pieces and counts the tokens of each; counts of frequent pieces are kept."""

    def __init__(self, content: bytes, pattern: str) -> None:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}
        self.encoding = tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.known: dict[str, int] = {}

    @classmethod
    def here(cls, content: bytes, pattern: str) -> PieceCounter:
        state = process_state()
        if state.get("ranks") != (content, pattern):
            state["ranks"], state["counter"] = (content, pattern), cls(content, pattern)
        return state["counter"]

    def counts(self, pieces: list[str]) -> list[int]:
        new = {p: len(self.encoding.encode_ordinary(p)) for p in set(pieces).difference(self.known)}
        if len(self.known) + len(new) <= MAX_PIECES:
            self.known.update(new)
            return list(map(self.known.__getitem__, pieces))
        known = self.known.get
        return [known(p) or new[p] for p in pieces]


class CountTree:
    """Pieces of one document in blocks, with a segment tree of characters and tokens over them."""

    def __init__(self, counter: PieceCounter, text: str, lengths: list[int] | None = None, tokens: list[int] | None = None) -> None:
        self.counter = counter
        if lengths is None or tokens is None:
            pieces = counter.pattern.findall(text)
            lengths, tokens = list(map(len, pieces)), counter.counts(pieces)
        self.blocks: list[list] = []  # text, lengths, tokens
        at = 0
        for i in range(0, len(lengths), BLOCK):
            own = lengths[i : i + BLOCK]
            size = sum(own)
            self.blocks.append([text[at : at + size], own, tokens[i : i + BLOCK]])
            at += size
        self.blocks = self.blocks or [["", [], []]]
        self.leaves = 1 << (len(self.blocks) - 1).bit_length()
        self.chars, self.tokens = [0] * 2 * self.leaves, [0] * 2 * self.leaves
        for i, (own, _, n) in enumerate(self.blocks):
            self.chars[self.leaves + i], self.tokens[self.leaves + i] = len(own), sum(n)
        for i in range(self.leaves - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]
        self.encoded = 0  # pieces encoded by edits

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    def text(self) -> str:
        return "".join(b[0] for b in self.blocks)

    def arrays(self) -> tuple[list[int], list[int]]:
        return [n for b in self.blocks for n in b[1]], [n for b in self.blocks for n in b[2]]

    def _place(self, char: int) -> tuple[int, int]:
        """Block that holds a character, and where the block begins."""
        node, begin = 1, 0
        while node < self.leaves:
            node *= 2
            if char >= begin + self.chars[node]:
                begin += self.chars[node]
                node += 1
        return min(node - self.leaves, len(self.blocks) - 1), begin

    def _refresh(self, block: int) -> None:
        node = self.leaves + block
        self.chars[node], self.tokens[node] = len(self.blocks[block][0]), sum(self.blocks[block][2])
        while node > 1:
            node //= 2
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace characters ``start`` to ``end`` by ``new``."""
        total = self.chars[1]
        start = min(max(0, start), total)
        end = min(max(start, end), total)
        # the first block to cut anew, and the place in it: two pieces before the one that the edit touches or follows
        block, begin = self._place(max(0, start - 1))
        place, piece = begin, 0
        lengths = self.blocks[block][1]
        while piece < len(lengths) and place + lengths[piece] < start:
            place += lengths[piece]
            piece += 1
        back = 2
        while back and (piece or block):
            if not piece:
                block -= 1
                piece = len(self.blocks[block][1])
                continue
            piece -= 1
            place -= self.blocks[block][1][piece]
            back -= 1
        # characters of further blocks join the window until the cuts meet again
        begin = place - sum(self.blocks[block][1][:piece])
        last, stop = block, begin + len(self.blocks[block][0])
        while stop < end and last + 1 < len(self.blocks):
            last += 1
            stop += len(self.blocks[last][0])
        step = 1
        while True:
            whole = "".join(self.blocks[i][0] for i in range(block, last + 1))
            window = whole[place - begin : start - begin] + new + whole[end - begin :]
            shift = len(new) - (end - start)
            lengths = [n for i in range(block, last + 1) for n in self.blocks[i][1]]
            counts = [n for i in range(block, last + 1) for n in self.blocks[i][2]]
            old, at = {}, begin
            for i, n in enumerate(lengths):
                if at >= end:
                    old[at + shift] = i
                at += n
            at_end = last + 1 == len(self.blocks)
            pieces, at, meet = [], place, None
            for match in self.counter.pattern.finditer(window):
                if at >= start + len(new) and at in old:
                    meet = old[at]
                    break
                if match.end() == len(window) and not at_end:
                    break
                pieces.append(match.group())
                at += match.end() - match.start()
            else:
                if at_end:
                    meet = len(lengths)
            if meet is not None:
                break
            last = min(len(self.blocks) - 1, last + step)
            step *= 2
        kept = whole[: place - begin]
        rest_chars = sum(lengths[meet:])
        rest = whole[len(whole) - rest_chars :] if rest_chars else ""
        self.encoded += len(pieces)
        self.blocks[block] = [
            kept + "".join(pieces) + rest,
            lengths[:piece] + list(map(len, pieces)) + lengths[meet:],
            counts[:piece] + self.counter.counts(pieces) + counts[meet:],
        ]
        for i in range(block + 1, last + 1):
            self.blocks[i] = ["", [], []]
            self._refresh(i)
        self._refresh(block)


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")


def cleaning_edits(text: str) -> list[tuple[int, int, str]]:
    """Edits that drop lines equal to an earlier line and put a placeholder for mail addresses, from the back of the text."""
    edits, seen, at = [], set(), 0
    for line in text.split("\n"):
        if line.strip():
            if line in seen:
                edits.append((max(0, at - 1), at + len(line), ""))
            else:
                edits += [(at + m.start(), at + m.end(), "<email>") for m in EMAIL.finditer(line)]
            seen.add(line)
        at += len(line) + 1
    return edits[::-1]


TREE = "doc_id bigint, text string, lengths array<int>, tokens array<int>, n_tokens bigint"
COUNTS = "doc_id bigint, n_pieces bigint, n_tokens_before bigint, n_edits bigint, n_encoded bigint, n_tokens bigint"


def _table(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _mapped(docs: DataFrame, columns: list, tokenizer: str | None, names: tuple[str, ...], row: Callable, schema: str) -> DataFrame:
    """``row(counter, *values)`` of every document; ``names`` are its columns, the last one its text."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    sent = docs.sparkSession.sparkContext.broadcast(tokenizer_ranks(tokenizer))
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounter.here(*sent.value)
        for _, lists in batches_of(rows, *names):
            yield _table(arrow, [row(counter, *values) for values in zip(*lists)])

    return mapped(docs.select(*columns), run, schema)


def _text() -> list:
    return [F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")]


def trees(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id, text and the pieces' characters and tokens, from which a tree is set up again without the tokenizer."""

    def row(counter: PieceCounter, doc_id: int | None, text: str | None) -> tuple:
        tree = CountTree(counter, text or "")
        return doc_id, text, *tree.arrays(), tree.n_tokens

    return _mapped(docs, _text(), tokenizer, ("doc_id", "text"), row, TREE)


def edited(kept: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``trees`` after the edits in column ``edits``, an array of (start, end, text); only touched pieces are encoded."""

    def row(counter: PieceCounter, doc_id: int | None, lengths: list, tokens: list, edits: list | None, text: str | None) -> tuple:
        tree = CountTree(counter, text or "", lengths or [], tokens or [])
        for edit in edits or ():
            tree.edit(edit["start"], edit["end"], edit["text"] or "")
        return doc_id, text if not edits else tree.text(), *tree.arrays(), tree.n_tokens

    columns = [*_text()[:1], "lengths", "tokens", "edits", *_text()[1:]]
    return _mapped(kept, columns, tokenizer, ("doc_id", "lengths", "tokens", "edits", "text"), row, TREE)


def cleaned_counts(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Token counts of every document before and after the edits of a cleaning pass, with the pieces that had to be encoded."""

    def row(counter: PieceCounter, doc_id: int | None, text: str | None) -> tuple:
        text = text or ""
        tree, edits = CountTree(counter, text), cleaning_edits(text)
        before, pieces = tree.n_tokens, sum(len(b[1]) for b in tree.blocks)
        for edit in edits:
            tree.edit(*edit)
        return doc_id, pieces, before, len(edits), tree.encoded, tree.n_tokens

    return _mapped(docs, _text(), tokenizer, ("doc_id", "text"), row, COUNTS)
