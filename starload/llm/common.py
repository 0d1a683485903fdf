"""What several operators share: bounded sets of labels, copies, text chunks and word hashes."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: runs of anything but ASCII white space.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER_ASCII = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
# Texts are handled in pieces of about this many characters inside a task.
CHUNK_CHARS = 2_000_000
# A side of a join is broadcast only if it was counted and has at most so many rows.
BROADCAST_ROWS = 500_000
# Rows of one key are ranked in groups of about this many, but in 256 groups at least.
GROUP_ROWS = 100_000
LEAST_GROUPS = 256


def label_sample(labels: DataFrame, column: str, folds: int, held: int, bound: int) -> DataFrame:
    """Labelled rows outside the held-out fold, about ``bound`` of them at most.

    Rows are taken by a hash of their id, so the sample is the same in every run.
    A row without id or label takes no part; of repeated ids the lowest label counts.
    """
    rows = (
        labels.select("doc_id", F.col(column).cast("double").alias("label"))
        .dropna()
        .filter(~in_fold(F.col("doc_id"), folds, held))
        .groupBy("doc_id").agg(F.min("label").alias("label"))
    )
    total = rows.count()
    if total > bound:
        # A margin of six deviations keeps the number of rows under the bound.
        share = (bound - 6 * bound**0.5) / total
        rows = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    return rows


def in_fold(doc_id: Column, folds: int, held: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == held, F.lit(False))


def bounded(df: DataFrame) -> DataFrame:
    """``df``, with a broadcast hint only if it has been counted to be small."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def ranked(df: DataFrame, key: str, order: list[str], total: int, name: str) -> DataFrame:
    """``df`` with the place of each row among those of its key, from 0, in column ``name``.

    Rows are ranked in groups by a hash of ``order``, so that no task holds all rows of a key;
    the counts of the groups before are added. The order is by group, then ``order``.
    """
    groups = max(LEAST_GROUPS, -(-total // GROUP_ROWS))
    group, before = f"{name}_group", f"{name}_before"
    df = df.withColumn(group, F.pmod(F.xxhash64(*order), F.lit(groups)))
    earlier = Window.partitionBy(key).orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    counts = df.groupBy(key, group).agg(F.count("*").alias(before)).select(
        key, group, F.coalesce(F.sum(before).over(earlier), F.lit(0)).alias(before)
    )
    own = Window.partitionBy(key, group).orderBy(*order)
    return (
        df.withColumn(name, F.row_number().over(own) - 1).join(bounded(counts), [key, group])
        .withColumn(name, F.col(name) + F.col(before)).drop(group, before)
    )


def ranked_along(df: DataFrame, key: list[str], order: list[str], end: int, name: str) -> DataFrame:
    """``df`` with the place of each row among those of its key along ``order``, from 0.

    The first column of ``order`` holds whole numbers from 0 to below ``end``. Rows are ranked
    in stretches of it, so that no task holds all rows of a key; ``df`` is read twice.
    """
    width = max(1, min(-(-end // LEAST_GROUPS), GROUP_ROWS))
    group, before = f"{name}_group", f"{name}_before"
    df = df.withColumn(group, F.expr(f"`{order[0]}` div {width}"))
    earlier = Window.partitionBy(*key).orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    counts = df.groupBy(*key, group).agg(F.count("*").alias(before)).select(
        *key, group, F.coalesce(F.sum(before).over(earlier), F.lit(0)).alias(before)
    )
    own = Window.partitionBy(*key, group).orderBy(*order)
    return (
        df.withColumn(name, F.row_number().over(own) - 1).join(bounded(counts), [*key, group])
        .withColumn(name, F.col(name) + F.col(before)).drop(group, before)
    )


def chunks(batches: Iterator[pa.RecordBatch], limit: int = CHUNK_CHARS) -> Iterator[list[list]]:
    """The columns of batches as lists, in pieces of about ``limit`` characters of text.

    The second column is the text, as string or bytes; NULL is empty. Texts are never cut.
    """
    columns: list[list] = []
    size = 0
    for batch in batches:
        empty = b"" if pa.types.is_binary(batch.schema.field(1).type) else ""
        columns = columns or [[] for _ in range(batch.num_columns)]
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            for column, value in zip(columns, row):
                column.append(value)
            columns[1][-1] = row[1] or empty
            size += len(columns[1][-1])
            if size >= limit:
                yield columns
                columns, size = [[] for _ in row], 0
    if columns and columns[0]:
        yield columns


# Hashed bytes: the value of each byte, and the odd base of their polynomial.
_BYTES = np.random.default_rng(20_240_601).integers(0, 1 << 64, 256, np.uint64)
_BASE = 0x9E3779B97F4A7C17
_SEGMENT = 1 << 19


class WordHashes:
    """64-bit hashes of the words (runs of anything but ASCII white space) of UTF-8 texts.

    A word's hash is a polynomial over its bytes, modulo 2 ** 64, taken from running sums over
    all bytes; with ``lower`` A-Z count as a-z. The texts are worked on in segments cut between
    words, so that memory follows the segment and not the longest text.
    """

    def __init__(self, lower: bool = False) -> None:
        self.values = _BYTES.copy()
        if lower:
            self.values[65:91] = self.values[97:123]
        self.space = np.zeros(256, bool)
        self.space[[9, 10, 11, 12, 13, 32]] = True
        self.powers = self.inverse = np.ones(0, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.powers) < n:
            factors = np.ones((2, n), np.uint64)
            factors[0, 1:], factors[1, 1:] = np.uint64(_BASE), np.uint64(pow(_BASE, -1, 1 << 64))
            self.powers, self.inverse = np.cumprod(factors, axis=1)

    def _segment(self, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        self._powers(len(part) + 1)
        word = ~self.space[part]
        edge = np.flatnonzero(np.diff(word, prepend=False, append=False))
        first, end = edge[::2], edge[1::2]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(self.values[part] * self.powers[: len(part)], out=sums[1:])
        lengths = (end - first).astype(np.uint64)
        return mixed((sums[end] - sums[first]) * self.inverse[first] + mixed(lengths)), first

    def cuts(self, flat: np.ndarray) -> Iterator[int]:
        """Ends of the segments of ``flat``; none cuts a word."""
        at = 0
        while at < len(flat):
            stop = min(at + _SEGMENT, len(flat))
            while stop < len(flat) and not self.space[flat[stop]]:
                rest = np.flatnonzero(self.space[flat[stop: stop + _SEGMENT]])
                stop = stop + int(rest[0]) if len(rest) else min(stop + _SEGMENT, len(flat))
            yield stop
            at = stop

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of all words, and the first word of each text, with their number last."""
        flat = np.frombuffer(b"\n".join(texts), np.uint8)
        offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
        hashes, places, at = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], 0
        for stop in self.cuts(flat):
            found, first = self._segment(flat[at:stop])
            hashes.append(found)
            places.append(first + at)
            at = stop
        return np.concatenate(hashes), np.searchsorted(np.concatenate(places), offsets)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit changes every output bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of an ordered pair of hashes."""
    return mixed(a * np.uint64(0x9FB21C651E98DF25) + mixed(b + np.uint64(0x632BE59BD9B4E019)))


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` consecutive entries (by doubling; none if too short)."""
    if not 0 < width <= len(words):
        return np.empty(0, np.uint64)
    power, level, done, out = 1, words, 0, None
    while True:
        if width & power:
            part = level[done:]
            out = part[: len(words) - width + 1].copy() if out is None else joined(
                out, part[: len(words) - width + 1]
            )
            done += power
        if done == width:
            return mixed(out + np.uint64(width))
        level = joined(level[:-power], level[power:])
        power *= 2
