"""Finding hashes that occur more than once, with entries packed by the block of their hash.

Tasks send one row per block of hashes, and one entry for a hash they hold several times, so
that a hash found in a third of all texts reaches its block as one entry per chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.llm.common import BROADCAST_ROWS
from starload.session import materialize

Choice = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
SCHEMA = "block int, hashes binary, many binary, owners binary, counts binary, places binary"
NAMES = ["block", "hashes", "many", "owners", "counts", "places"]


def block_count(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _row_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * 6
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]], NAMES
    )


def _runs(owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owners without neighbouring repeats, and how often each stands."""
    if not len(owners):
        return owners, np.empty(0, np.uint32)
    at = np.flatnonzero(np.concatenate([[True], owners[1:] != owners[:-1]]))
    return owners[at], np.diff(np.append(at, len(owners))).astype(np.uint32)


def _replies(owners: np.ndarray, places: np.ndarray, blocks: int) -> list[tuple]:
    """Rows that tell owners which of their places are shared, by the block of the owner."""
    block = (owners.view(np.uint64) % np.uint64(blocks)).astype(np.int32)
    order = np.argsort(block, kind="stable")
    rows = []
    for part in np.split(order, np.flatnonzero(np.diff(block[order])) + 1):
        if len(part):
            own, n = _runs(owners[part])
            rows.append((int(block[part[0]]), b"", b"", own.tobytes(), n.tobytes(),
                         places[part].tobytes()))
    return rows


def send(hashes: np.ndarray, owners: np.ndarray, places: np.ndarray, blocks: int, wide: bool,
         told: np.ndarray | None = None) -> pa.RecordBatch:
    """Rows of one chunk: entries of hashes it holds once, hashes it holds more often, and
    replies for the latter. ``told`` names owners that must get a reply in any case."""
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]]) if len(ordered) else np.empty(0, bool)
    first = np.flatnonzero(new)
    times = np.diff(np.append(first, len(ordered)))
    once = np.sort(order[first[times == 1]])
    many = ordered[first[times > 1]]
    again = np.sort(order[np.repeat(times > 1, times)])
    kind = np.uint64 if wide else np.uint32
    shift = np.uint64(0 if wide else 32)

    def block_of(x: np.ndarray) -> np.ndarray:
        return ((x & np.uint64(0xFFFFFFFF)) % np.uint64(blocks)).astype(np.int32)

    once_block, many_block = block_of(hashes[once]), block_of(many)
    by, by_many = np.argsort(once_block, kind="stable"), np.argsort(many_block, kind="stable")
    edges = np.searchsorted(once_block[by], np.arange(blocks + 1))
    many_edges = np.searchsorted(many_block[by_many], np.arange(blocks + 1))
    rows = []
    for b in range(blocks):
        part = once[by[edges[b]: edges[b + 1]]]
        more = many[by_many[many_edges[b]: many_edges[b + 1]]]
        if len(part) or len(more):
            own, n = _runs(owners[part])
            rows.append((b, (hashes[part] >> shift).astype(kind).tobytes(),
                         (more >> shift).astype(kind).tobytes(), own.tobytes(), n.tobytes(),
                         places[part].astype(np.uint32).tobytes()))
    rows.extend(_replies(owners[again], places[again].astype(np.uint32), blocks))
    if told is not None and len(told):
        block = (told.view(np.uint64) % np.uint64(blocks)).astype(np.int32)
        for b in np.unique(block):
            own = told[block == b]
            rows.append((int(b), b"", b"", own.tobytes(), np.zeros(len(own), np.uint32).tobytes(), b""))
    return _row_batch(rows)


def _shared(table: pa.Table, blocks: int, wide: bool) -> Iterator[tuple]:
    """Replies of one block: what came as replies goes on, entries are compared."""
    kind = np.uint64 if wide else np.uint32
    hashes, many, owners, places = [], [], [], []
    for _, h, m, o, n, p in zip(*[table[c].to_pylist() for c in NAMES]):
        if h or m:
            hashes.append(np.frombuffer(h, kind))
            many.append(np.frombuffer(m, kind))
            owners.append(np.repeat(np.frombuffer(o, np.int64), np.frombuffer(n, np.uint32)))
            places.append(np.frombuffer(p, np.uint32))
        else:
            yield (table["block"][0].as_py(), b"", b"", o, n, p)
    if hashes:
        values, owner, place = (np.concatenate(x) for x in (hashes, owners, places))
        unique, inverse, times = np.unique(values, return_inverse=True, return_counts=True)
        known = np.isin(unique, np.concatenate(many))
        hit = np.flatnonzero(((times > 1) | known)[inverse])
        yield from _replies(owner[hit], place[hit], blocks)


def _gathered(table: pa.Table, choose: Choice | None) -> pa.RecordBatch:
    owners, places, told = [np.empty(0, np.int64)], [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
    for o, n, p in zip(*[table[c].to_pylist() for c in ("owners", "counts", "places")]):
        own, times = np.frombuffer(o, np.int64), np.frombuffer(n, np.uint32)
        owners.append(np.repeat(own, times))
        places.append(np.frombuffer(p, np.uint32))
        told.append(own[times == 0])
    owner, place = np.concatenate(owners), np.concatenate(places)
    order = np.lexsort((place, owner))
    owner, place = owner[order], place[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (place[1:] != place[:-1])
    owner, place = owner[new], place[new]
    told = np.unique(np.concatenate(told))
    if choose:
        use, place = choose(owner, place)
        use |= np.isin(owner, told)
        owner, place = owner[use], place[use]
    names = np.union1d(owner, told)
    lo, hi = np.searchsorted(owner, names), np.searchsorted(owner, names, side="right")
    return pa.RecordBatch.from_arrays(
        [pa.array(names), pa.array([place[a:b].tobytes() for a, b in zip(lo, hi)], pa.binary())],
        ["owner", "places"],
    )


def shared_places(sent: DataFrame, blocks: int, wide: bool, label: str,
                  choose: Choice | None = None) -> DataFrame:
    """(owner, places): per owner, the places whose hash occurs more than once in all.

    ``places`` is packed as 32-bit numbers, in order. ``sent`` has the rows of ``send``. Unless
    ``wide``, hashes of one block are compared by 32 bits: equal ones are never missed.
    ``choose`` takes all replies, sorted by owner and place, and says which to keep and what
    to keep of their places.
    """

    def compare(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_row_batch(list(_shared(table, blocks, wide)))])

    def gather(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_gathered(table, choose)])

    replies = sent.groupBy("block").applyInArrow(compare, SCHEMA)
    # What passed through a block on its way to its owners is dealt out anew.
    return materialize(
        replies.groupBy("block").applyInArrow(gather, "owner long, places binary"), label
    )


def attach(rows: DataFrame, key: str, replies: DataFrame, only: bool) -> DataFrame:
    """``rows`` with the ``places`` of their key; the others go without, or away if ``only``.

    A broadcast of the keys alone, if they were counted to be few, keeps texts without a reply
    out of the shuffle; else all rows are shuffled.
    """
    replies = replies.withColumnRenamed("owner", key)
    if replies.count() > BROADCAST_ROWS:
        return rows.join(replies, key, "inner" if only else "left")
    keys = F.broadcast(replies.select(key))
    joined = rows.join(keys, key, "left_semi").join(replies, key)
    if only:
        return joined
    return joined.unionByName(
        rows.join(keys, key, "left_anti").withColumn("places", F.lit(None).cast("binary"))
    )
