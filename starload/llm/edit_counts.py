"""Token counts that follow edits: segment trees over the pre-tokens of each text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.llm.common import chunks
from starload.llm.tokens import Tokenizer

# Characters a leaf has at least, but for the last one.
LEAF = 256
TREE = "struct<leaves: array<int>, chars: array<long>, tokens: array<long>>"
EDIT = "array<struct<at: long, removed: long, inserted: string>>"


class SegmentTree:
    """Characters and tokens of a text, as sums over a binary tree of leaves.

    Node 1 is the root, node i has the children 2 i and 2 i + 1. A leaf stands for a stretch of
    whole pre-tokens; its own sums are all it keeps of them.
    """

    def __init__(self, chars: list[int], tokens: list[int]) -> None:
        self.width = 1
        while self.width < len(chars):
            self.width *= 2
        self.used = len(chars)
        self.chars = [0] * (2 * self.width)
        self.tokens = [0] * (2 * self.width)
        self.chars[self.width: self.width + len(chars)] = chars
        self.tokens[self.width: self.width + len(tokens)] = tokens
        for node in range(self.width - 1, 0, -1):
            self._sum(node)

    def _sum(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character, and where it starts; the last one at the end."""
        node, start = 1, 0
        place = min(place, self.chars[1] - 1)
        while node < self.width:
            node *= 2
            if place >= start + self.chars[node]:
                start += self.chars[node]
                node += 1
        return node - self.width, start

    def put(self, first: int, last: int, chars: int, tokens: int) -> None:
        """Leaf ``first`` gets these sums and those up to ``last`` none; their roots follow."""
        for leaf in range(first, last + 1):
            self.chars[self.width + leaf] = chars if leaf == first else 0
            self.tokens[self.width + leaf] = tokens if leaf == first else 0
        low, high = (self.width + first) // 2, (self.width + last) // 2
        while low:
            for node in range(low, high + 1):
                self._sum(node)
            low, high = low // 2, high // 2

    def sums(self) -> tuple[list[int], list[int]]:
        end = self.width + self.used
        return self.chars[self.width:end], self.tokens[self.width:end]


def grown(text: str, count) -> SegmentTree:
    """The tree of a text.

    Leaves are cut before a space that follows something else. A pre-token always begins there,
    and neither side has a say in how the other one is split, so the counts add up.
    """
    chars, tokens, start = [], [], 0
    while True:
        end = text.find(" ", start + LEAF)
        while end > 0 and text[end - 1].isspace():
            end = text.find(" ", end + 1)
        end = len(text) if end < 0 else end
        chars.append(end - start)
        tokens.append(count(text[start:end]))
        if end == len(text):
            return SegmentTree(chars, tokens)
        start = end


def edited(text: str, tree: SegmentTree, at: int, removed: int, inserted: str, count) -> tuple[str, int]:
    """The text after one edit, and how many characters were encoded anew for ``tree``.

    Encoded are the leaves the edit touches: where it begins with a leaf, the one before too,
    and the one that holds what follows it, as the cuts there may be cuts no longer.
    """
    stop = min(at + removed, len(text))
    new = text[:at] + inserted + text[stop:]
    first, start = tree.leaf_at(at)
    if start == at and at:
        first, start = tree.leaf_at(at - 1)
    last, last_start = tree.leaf_at(stop)
    end = last_start + tree.chars[tree.width + last] + len(new) - len(text)
    tree.put(first, last, end - start, count(new[start:end]))
    return new, end - start


def counter(path: str):
    encode = Tokenizer(path)
    return lambda text: len(encode(text)) if text else 0


def with_trees(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``docs`` (doc_id, text, edits) with ``tree``: the sums of the leaves of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer)
        for ids, texts, edits in chunks(batches):
            rows = []
            for text in texts:
                chars, tokens = grown(text, count).sums()
                rows.append({"leaves": [len(chars)], "chars": chars, "tokens": tokens})
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(texts, pa.string()), pa.array(edits, _EDITS),
                 pa.array(rows, _TREE)], ["doc_id", "text", "edits", "tree"])

    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"),
                       F.col("edits").cast(EDIT)).mapInArrow(
        run, f"doc_id long, text string, edits {EDIT}, tree {TREE}")


_EDITS = pa.list_(pa.struct([("at", pa.int64()), ("removed", pa.int64()), ("inserted", pa.string())]))
_TREE = pa.struct([("leaves", pa.list_(pa.int32())), ("chars", pa.list_(pa.int64())),
                   ("tokens", pa.list_(pa.int64()))])


def after_edits(trees: DataFrame, tokenizer: str) -> DataFrame:
    """Rows of ``with_trees`` after their edits: doc_id, text, tree, n_tokens (before),
    n_tokens_after, n_chars_after and n_reencoded (characters encoded for the edits)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer)
        for ids, texts, edits, trees in chunks(batches):
            out = []
            for text, changes, sums in zip(texts, edits, trees):
                tree = SegmentTree(sums["chars"], sums["tokens"])
                before, again = tree.tokens[1], 0
                for e in changes or []:
                    if e is None or e["at"] is None:
                        continue
                    at = min(max(e["at"], 0), len(text))
                    text, n = edited(text, tree, at, max(e["removed"] or 0, 0), e["inserted"] or "",
                                     count)
                    again += n
                chars, tokens = tree.sums()
                out.append((text, {"leaves": [len(chars)], "chars": chars, "tokens": tokens}, before,
                            tree.tokens[1], tree.chars[1], again))
            types = (pa.string(), _TREE, *[pa.int64()] * 4)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), *[pa.array(c, t) for c, t in zip(zip(*out), types)]],
                ["doc_id", "text", "tree", "n_tokens", "n_tokens_after", "n_chars_after", "n_reencoded"])

    return trees.select("doc_id", "text", "edits", "tree").mapInArrow(
        run, f"doc_id long, text string, tree {TREE}, n_tokens long, n_tokens_after long, "
        "n_chars_after long, n_reencoded long")


def counts_after_edits(docs: DataFrame, edits: Column, tokenizer: str) -> DataFrame:
    """Token counts of every row of ``docs`` (doc_id, text), before and after its ``edits``.

    ``edits`` is an array of (at, removed, inserted), applied in order, each to the text as the
    one before left it; places beyond the text are its end. Texts are encoded once for their
    trees; an edit encodes the leaves it touches and the one before, and updates the sums
    above them. Nothing is shuffled.

    Null text: empty, no tokens. NULL edits, or edits without a place: none. Null doc_id and
    repeated rows: one result each. Empty table: no rows. Other columns are only read by
    ``edits``.
    """
    rows = docs.select("doc_id", "text", edits.alias("edits"))
    return after_edits(with_trees(rows, tokenizer), tokenizer)
