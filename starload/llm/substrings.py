"""Substring dedup by recompression: token runs and pairs are named alike in all texts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.llm.common import WordHashes, chunks, joined, mixed, window_hashes
from starload.llm.exchange import SCHEMA, attach, block_count, send, shared_places

WINDOW = 35
ROUNDS = 4
# A place sent for a symbol is its number in its text, above the run it needs (or the most
# these bits hold).
_NEED_BITS = 6


@dataclass
class Symbols:
    """Symbols of a chunk of texts, in order.

    ``name`` is the same wherever a symbol stands for the same words cut the same way. ``low``
    and ``high`` bound the words that decide how it was cut: wherever all of them occur
    again, so does the symbol. Where the end of a text had a say, they reach beyond the text.
    """

    name: np.ndarray
    doc: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def beside(self) -> tuple[np.ndarray, np.ndarray]:
        """Whether the left and the right neighbour are of the same text."""
        same = self.doc[1:] == self.doc[:-1]
        return np.concatenate([[False], same]), np.concatenate([same, [False]])


def _runs(s: Symbols, starts: np.ndarray, ends: np.ndarray) -> Symbols:
    """Runs of equal symbols become one; a run is decided by its neighbours, too."""
    left, _ = s.beside()
    left[1:] &= s.name[1:] == s.name[:-1]
    first = np.flatnonzero(~left)
    last = np.append(first[1:], len(left)) - 1
    times = last - first + 1
    name, doc = s.name[first], s.doc[first]
    name = np.where(times > 1, joined(name, mixed(times.astype(np.uint64))), name)
    same = doc[1:] == doc[:-1]
    low, high = starts[doc] - 1, ends[doc] + 1
    low[1:][same] = s.low[last[:-1]][same]
    high[:-1][same] = s.high[first[1:]][same]
    return Symbols(name, doc, low, high)


def _pairs(s: Symbols, starts: np.ndarray, ends: np.ndarray, salt: int) -> Symbols:
    """A hash of its name makes each symbol a left or a right one; a left one followed by a
    right one become one symbol."""
    is_left = (mixed(s.name + np.uint64(salt)) & np.uint64(1)).astype(bool)
    has_left, has_right = s.beside()
    opens = np.zeros(len(is_left), bool)
    opens[:-1] = is_left[:-1] & ~is_left[1:] & has_right[:-1]
    closes = np.concatenate([[False], opens[:-1]])
    low, high, name = s.low.copy(), s.high.copy(), s.name.copy()
    at = np.flatnonzero(opens)
    name[at] = joined(s.name[at], s.name[at + 1])
    high[at] = s.high[at + 1]
    alone = ~opens & ~closes
    # A single left symbol was decided by what follows, a single right one by what precedes.
    a = np.flatnonzero(alone & is_left)
    high[a] = np.where(has_right[a], s.high[np.minimum(a + 1, len(high) - 1)], ends[s.doc[a]] + 1)
    b = np.flatnonzero(alone & ~is_left)
    low[b] = np.where(has_left[b], s.low[b - 1], starts[s.doc[b]] - 1)
    keep = ~closes
    return Symbols(name[keep], s.doc[keep], low[keep], high[keep])


def recompressed(words: np.ndarray, starts: np.ndarray, rounds: int = ROUNDS) -> Symbols:
    """``starts`` has the first word of each text, and the number of words at its end."""
    ends, starts = starts[1:], starts[:-1]
    place = np.arange(len(words))
    s = Symbols(words, np.repeat(np.arange(len(starts)), ends - starts), place, place + 1)
    if len(words):
        for k in range(rounds):
            s = _pairs(_runs(s, starts, ends), starts, ends, 2 * k + 1)
    return s


def open_windows(s: Symbols, unshared: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
    """Windows that may repeat: none of the unshared symbols is settled inside them."""
    total = int(starts[-1])
    doc_of = s.doc[unshared]
    low = np.maximum(s.high[unshared] - window, starts[doc_of])
    high = s.low[unshared]
    use = low <= high
    change = np.bincount(low[use], minlength=total + 1) - np.bincount(high[use] + 1, minlength=total + 2)[: total + 1]
    free = np.cumsum(change)[:total] == 0
    n = np.diff(starts)
    last = np.repeat(starts[1:] - window, n)
    return np.flatnonzero(free & (np.arange(total) <= last))


def needed_runs(s: Symbols, starts: np.ndarray, window: int) -> np.ndarray:
    """Per symbol, the least number of symbols from it on that are all those settled inside
    some window; 0 if no window begins with it.

    A window may repeat only if all symbols settled inside it are shared, and these stand in a
    row, as both bounds of symbols only grow.
    """
    n = np.diff(starts)
    at = np.flatnonzero(np.arange(int(starts[-1])) <= np.repeat(starts[1:] - window, n))
    first = np.searchsorted(s.low, at)
    count = np.searchsorted(s.high, at + window, side="right") - first
    need = np.full(len(s.name) + 1, window + 1)
    np.minimum.at(need, first[count > 0], count[count > 0])
    need[need > window] = 0
    return np.minimum(need[:-1], (1 << _NEED_BITS) - 1)


def open_owners(owner: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the sorted replies are of texts with an open window, and the symbols' numbers."""
    number, need = place >> _NEED_BITS, place & ((1 << _NEED_BITS) - 1)
    stops = np.ones(len(owner), bool)
    stops[:-1] = (owner[1:] != owner[:-1]) | (number[1:] != number[:-1] + 1)
    ends = np.flatnonzero(stops)
    run = ends[np.searchsorted(ends, np.arange(len(owner)))] - np.arange(len(owner)) + 1
    return np.isin(owner, owner[(need > 0) & (run >= need)]), number


def _symbol_entries(blocks: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHashes()
        for keys, texts in chunks(batches):
            owner = np.array(keys, np.int64)
            words, starts = hasher(texts)
            s = recompressed(words, starts)
            # Texts with windows that no symbol can rule out are looked at in any case.
            loose = open_windows(s, np.ones(len(s.name), bool), starts, window)
            told = np.unique(owner[np.searchsorted(starts, loose, side="right") - 1])
            number = np.arange(len(s.doc)) - np.searchsorted(s.doc, s.doc)
            place = (number << _NEED_BITS) + needed_runs(s, starts, window)
            yield send(s.name, owner[s.doc], place, blocks, False, told)
    return run


def _window_entries(blocks: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHashes()
        for keys, texts, replies in chunks(batches):
            owner = np.array(keys, np.int64)
            words, starts = hasher(texts)
            s = recompressed(words, starts)
            unshared = np.ones(len(s.name), bool)
            first = np.searchsorted(s.doc, np.arange(len(texts)))
            for i, places in enumerate(replies):
                unshared[first[i] + np.frombuffer(places, np.uint32)] = False
            at = open_windows(s, unshared, starts, window)
            doc = np.searchsorted(starts, at, side="right") - 1
            hashes = window_hashes(words, window)[at] if len(at) else np.empty(0, np.uint64)
            yield send(hashes, owner[doc], at - starts[doc], blocks, True)
    return run


def _covered(places: bytes | None, window: int, n: int) -> np.ndarray:
    """Which of n words are inside a window starting at one of the places."""
    at = np.frombuffer(places or b"", np.uint32)
    change = np.zeros(n + 1, np.int64)
    change[at] += 1
    change[at + window] -= 1
    return np.cumsum(change[:n]) > 0


def _cut(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["dedup_text", "dedup_words", "dedup_removed", "dedup_spans"]
        for batch in batches:
            at = {name: i for i, name in enumerate(batch.schema.names)}
            out = []
            for text, places in zip(*[batch.column(at[c]).to_pylist() for c in ("dedup_in", "dedup_at")]):
                words = (text or b"").split()
                if places:
                    gone = _covered(places, window, len(words))
                    edge = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
                    spans = [{"first": int(a), "end": int(b)} for a, b in edge.reshape(-1, 2)]
                    kept = [w for w, g in zip(words, gone.tolist()) if not g]
                else:
                    spans, kept = [], words
                out.append((b" ".join(kept).decode("utf-8", "replace"), len(words),
                            len(words) - len(kept), spans))
            types = (pa.string(), pa.int64(), pa.int64(),
                     pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())])))
            new = [pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * 4, types)]
            keep = [c for c in batch.schema.names if c not in ("dedup_in", "dedup_at")]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(at[c]) for c in keep], *new], [*keep, *names])
    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, others: tuple[str, ...] = ()) -> DataFrame:
    """Rows of ``docs`` (doc_id, text) without the words inside repeated windows.

    Words are runs of anything but ASCII white space. A window is ``window`` consecutive words
    of one text; a word goes if a window over it has a word sequence that also starts
    elsewhere, in any text or in its own. Result: doc_id, ``others``, and dedup_text (words
    kept, joined by one space), dedup_words, dedup_removed and dedup_spans (first word and end
    of each stretch removed).

    Every text is cut into symbols by rounds that name runs of equal symbols and then pairs,
    the same way wherever the same words occur. Spark counts the last symbols. Where a window
    repeats, every symbol settled by the words in it does, so only windows without an
    unshared symbol are left; their hashes (64 bits) are counted to verify them, and hits
    reported back to their texts. No posting list is gathered: a task sends a hash once. Texts
    are read again only if some window of theirs is left.

    Null text: no words. Null doc_id and repeated rows: treated as rows of their own, and
    their windows count as found twice. Texts of less than ``window`` words stay as they are.
    Empty table: no rows.
    """
    spark = docs.sparkSession
    blocks = block_count(spark)
    rows = docs.select(
        F.xxhash64("doc_id", "text").alias("dedup_key"),
        F.col("text").cast("binary").alias("dedup_in"), "doc_id", *others,
    )
    texts = rows.select("dedup_key", "dedup_in").filter(F.length("dedup_in") >= 2 * window - 1)
    found = shared_places(
        texts.mapInArrow(_symbol_entries(blocks, window), SCHEMA), blocks, False, "shared-symbols",
        open_owners)
    likely = attach(texts, "dedup_key", found, only=True)
    repeated = shared_places(
        likely.mapInArrow(_window_entries(blocks, window), SCHEMA), blocks, True, "repeated-windows")
    marked = attach(rows, "dedup_key", repeated, only=False).drop("dedup_key").withColumnRenamed(
        "places", "dedup_at")
    kept = ", ".join(f"`{c}` {t}" for c, t in marked.dtypes if c not in ("dedup_in", "dedup_at"))
    return marked.mapInArrow(
        _cut(window), kept + ", dedup_text string, dedup_words long, dedup_removed long, "
        "dedup_spans array<struct<first: long, end: long>>")
