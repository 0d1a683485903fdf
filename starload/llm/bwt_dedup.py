"""Suffix-array dedup: merged Burrows-Wheeler transforms find byte strings that earlier texts hold."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.llm.common import chunks, mixed
from starload.llm.exchange import SCHEMA, attach, send, shared_places
from starload.session import materialize

LENGTH = 50
# Bytes of an anchor, and bytes of text whose stretches a block compares on average.
ANCHOR = 16
BLOCK_BYTES = 8_000_000
# Bytes of text whose stretches are sent together, and least strings of a shard.
SENT_BYTES = 8_000_000
SHARD = 1 << 14
_SEGMENT = 1 << 17
_NEVER = np.iinfo(np.int64).max


def _words_at(flat: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number."""
    out = np.empty(len(flat) - 7, np.uint64)
    for r in range(8):
        part = flat[r: r + (len(flat) - r) // 8 * 8].view(np.uint64)
        out[r::8] = part[: len(out[r::8])]
    return out


def anchors(flat: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Stretches of ``flat``: (first window, last window, anchor, hash of the anchor's bytes).

    ``ends`` has the end of the text that each stretch of ``flat`` is of. A window is ``length``
    bytes of one text. Its anchor is the first of its ANCHOR-byte strings with the least hash,
    so equal windows have equal anchors at equal places. Neighbouring windows with one anchor
    are a stretch.
    """
    span = length - ANCHOR + 1
    out: list[list[np.ndarray]] = [[], [], [], []]
    total = len(flat) - length + 1
    for at in range(0, max(total, 0), _SEGMENT):
        stop = min(at + _SEGMENT, total)
        x = _words_at(np.append(flat[at: stop + length - 1], np.zeros(8, np.uint8)))
        n = stop - at + length - ANCHOR
        h = mixed(x[:n] * np.uint64(0x9FB21C651E98DF25) + mixed(x[8: n + 8]))
        low = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
        width = 1
        while 2 * width <= span:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if width < span:
            low = np.minimum(low[: len(low) - span + width], low[span - width:])
        where = np.arange(at, stop)
        end = ends[np.searchsorted(ends, where, side="right")]
        whole = where + length <= end
        where, place = where[whole], (low & np.uint64(0xFFFFFFFF)).astype(np.int64)[whole]
        new = np.flatnonzero(np.diff(place, prepend=-1))
        out[0].append(where[new])
        out[1].append(where[np.append(new[1:], len(where)) - 1] if len(new) else where[:0])
        out[2].append(place[new] + at)
        out[3].append(h[place[new]])
    first, last, place, name = (np.concatenate(c) if c else np.empty(0, t) for c, t in
                                zip(out, (np.int64, np.int64, np.int64, np.uint64)))
    # A stretch cut at the edge of two segments is one.
    same = np.zeros(len(place), bool)
    same[1:] = place[1:] == place[:-1]
    last[:-1][same[1:]] = last[1:][same[1:]]
    keep = ~same
    return first[keep], last[keep], place[keep], name[keep]


def _flat(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts])


def _anchor_entries(blocks: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in chunks(batches):
            flat, ends = _flat(texts)
            first, _, place, name = anchors(flat, ends, length)
            doc = np.searchsorted(ends, first, side="right")
            starts = ends - np.array([len(t) for t in texts])
            yield send(name, np.array(keys, np.int64)[doc], place - starts[doc], blocks, False)
    return run


def _packed(*arrays: np.ndarray) -> bytes:
    raw = b"".join([np.array([len(a.tobytes()) for a in arrays], np.int64).tobytes(),
                    *[a.tobytes() for a in arrays]])
    return np.int64(len(raw)).tobytes() + pa.compress(raw, "zstd", asbytes=True)


def _unpacked(data: bytes, *kinds) -> list[np.ndarray]:
    raw = pa.decompress(data[8:], int(np.frombuffer(data[:8], np.int64)[0]), "zstd", asbytes=True)
    sizes = np.frombuffer(raw[: 8 * len(kinds)], np.int64)
    edges = 8 * len(kinds) + np.concatenate([[0], np.cumsum(sizes)])
    return [np.frombuffer(raw[a:b], k) for a, b, k in zip(edges, edges[1:], kinds)]


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


def _distinct(flat: np.ndarray, first: np.ndarray, size: np.ndarray, left: np.ndarray) -> np.ndarray:
    """For each stretch, the first one with the same bytes and anchor (by all of its bytes)."""
    view = np.lib.stride_tricks.sliding_window_view(flat, 8)
    loads = [np.stack([size, left], 1).astype(np.uint64)]
    for k in range(0, int(size.max(initial=8)), 8):
        # From the end backwards where fewer than eight bytes are left: every byte is covered.
        at = np.minimum(first + k, first + size - 8)
        loads.append(np.ascontiguousarray(view[at]).view(np.uint64))
    table = np.concatenate(loads, axis=1)
    name = np.zeros(len(first), np.uint64)
    for column in table.T:
        name = mixed(name * np.uint64(0x9FB21C651E98DF25) + column)
    _, head, inverse = np.unique(name, return_index=True, return_inverse=True)
    same = (table == table[head[inverse]]).all(axis=1)
    return np.where(same, head[inverse], np.arange(len(first)))


STRETCHES = "block int, owner_docs binary, stretches binary"


def _stretch_rows(blocks: int, length: int):
    """Rows (block, owner_docs, stretches): the stretches of a chunk that belong to a block.

    Equal stretches are sent once, with all the places they stand at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts, docs, replies in chunks(batches, SENT_BYTES):
            flat, ends = _flat(texts)
            starts = ends - np.array([len(t) for t in texts])
            first, last, place, name = anchors(flat, ends, length)
            told = [np.frombuffer(r, np.uint32).astype(np.int64) + s for r, s in zip(replies, starts)]
            use = np.isin(place, np.concatenate(told))
            first, last, place, name = first[use], last[use], place[use], name[use]
            if not len(first):
                continue
            doc = np.searchsorted(ends, first, side="right")
            size, left = last - first + length, place - first
            head = _distinct(flat, first, size, left)
            block = (name % np.uint64(blocks)).astype(np.int64)
            order = np.lexsort((head, block))
            out = []
            for part in np.split(order, np.flatnonzero(np.diff(block[order])) + 1):
                new = np.diff(head[part], prepend=-1) != 0
                kept = part[new]
                number = np.cumsum(new) - 1
                who, local = np.unique(doc[part], return_inverse=True)
                out.append((
                    int(block[part[0]]),
                    _packed(*[np.array([column[i] for i in who], np.int64) for column in (keys, docs)]),
                    _packed(flat[_ranges(first[kept], size[kept])], size[kept].astype(np.uint16),
                            left[kept].astype(np.uint16), number.astype(np.uint32),
                            local.astype(np.uint32), (first - starts[doc])[part].astype(np.uint32)),
                ))
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]],
                ["block", "owner_docs", "stretches"])
    return run


def symbols(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, most: int) -> np.ndarray:
    """Strings of ``flat`` as rows of eight-byte symbols that order like their bytes, zeros behind."""
    padded = np.append(flat, np.zeros(8, np.uint8))
    view = np.lib.stride_tricks.sliding_window_view(padded, 8)
    out = np.zeros((len(starts), -(-most // 8)), np.uint64)
    for k in range(out.shape[1]):
        rest = np.clip(sizes - 8 * k, 0, 8)
        got = np.ascontiguousarray(view[np.minimum(starts + 8 * k, len(flat))]).view(">u8").ravel()
        mask = np.where(rest > 0, ~np.uint64(0) << ((8 - np.maximum(rest, 1)) * 8).astype(np.uint64), 0)
        out[:, k] = got.astype(np.uint64) & mask.astype(np.uint64)
    return out


def transform(table: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The Burrows-Wheeler transform of a shard's strings, and the strings in order.

    Entry k lists, for the suffixes that begin with symbol k + 1 in their order, the symbol
    before them; the suffixes of one column are sorted by the order of the next one.
    """
    order = np.arange(len(table))
    columns = []
    for k in range(table.shape[1] - 1, -1, -1):
        before = table[order, k]
        columns.append(before)
        order = order[np.argsort(before, kind="stable")]
    return columns[::-1], order


def interleaved(shards: list[list[np.ndarray]]) -> np.ndarray:
    """Of which shard each string is, in the order of the strings of all shards.

    The interleave starts with the suffixes of no symbol, all equal. Each round reads the
    transforms along the interleave, each shard's symbols in turn, and a stable sort by them
    refines it by one symbol. The shards' strings are never compared.
    """
    kind = np.uint16 if len(shards) < 1 << 16 else np.int64
    source = np.repeat(np.arange(len(shards)), [len(s[0]) for s in shards]).astype(kind)
    for k in range(len(shards[0]) - 1, -1, -1):
        read = np.empty(len(source), np.uint64)
        read[np.argsort(source, kind="stable")] = np.concatenate([s[k] for s in shards])
        source = source[np.argsort(read, kind="stable")]
    return source


def merged(table: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, common): the strings of all shards in order, and the bytes each shares with the last.

    ``edges`` has the first string of each shard and the number of strings.
    """
    parts = [transform(table[a:b]) for a, b in zip(edges, edges[1:])]
    source = interleaved([columns for columns, _ in parts])
    order = np.empty(len(table), np.int64)
    order[np.argsort(source, kind="stable")] = np.concatenate(
        [own + a for (_, own), a in zip(parts, edges)])
    common = np.zeros(len(table), np.int64)
    open_ = np.ones(len(table), bool)
    open_[:1] = False
    for k in range(table.shape[1]):
        now = table[order, k]
        differ = np.zeros(len(table), np.uint64)
        differ[1:] = now[1:] ^ now[:-1]
        equal = np.full(len(table), 8)
        for byte in range(8):
            equal = np.where(differ >> np.uint64(8 * byte) != 0, 7 - byte, equal)
        common += np.where(open_, equal, 0)
        open_ &= equal == 8
    return order, common


def _intervals(order: np.ndarray, common: np.ndarray, depth: int) -> np.ndarray:
    """For each string, which interval of strings with ``depth`` common bytes it is in."""
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(common < depth)
    return out


def _least(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each entry, the least document of the entries with its key."""
    order = np.argsort(key, kind="stable")
    new = np.flatnonzero(np.diff(key[order], prepend=-1))
    if not len(new):
        return doc
    low = np.minimum.reduceat(doc[order], new)
    out = np.empty(len(key), np.int64)
    out[order] = np.repeat(low, np.diff(np.append(new, len(order))))
    return out


def earlier(flat: np.ndarray, size: np.ndarray, left: np.ndarray, doc: np.ndarray,
            shard: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(of, least): for each stretch a row of ``least``, which has the least document that holds
    each window, by the number of bytes before the anchor.

    Two merges order what follows the anchors and what precedes them, read backwards. A window
    with o bytes before its anchor lies in an interval of o common bytes on the one side and of
    ``length`` - o on the other; windows are equal if both intervals are. Stretches of the same
    bytes are first reduced to one row with their least document.
    """
    before = length - ANCHOR
    start = np.cumsum(size) - size
    edges = np.concatenate([[0], np.flatnonzero(np.diff(shard)) + 1, [len(size)]])
    right = merged(symbols(flat, start + left, np.minimum(size - left, length), length), edges)
    backwards = np.ascontiguousarray(flat[::-1])
    back = merged(symbols(backwards, len(flat) - start - left, left, before), edges)
    whole = _intervals(*right, length) * (len(size) + 1) + _intervals(*back, before)
    whole, kind = np.unique(whole, return_inverse=True)[1], size * (before + 1) + left
    whole = whole * (int(kind.max(initial=0)) + 1) + kind
    _, head, of = np.unique(whole, return_index=True, return_inverse=True)
    own = np.full(len(head), _NEVER)
    np.minimum.at(own, of, doc)
    windows = (size - length)[head]
    least = np.full((len(head), before + 1), _NEVER)
    for o in range(before + 1):
        some = np.flatnonzero((left[head] >= o) & (left[head] - o <= windows))
        if len(some):
            key = (_intervals(*back, o)[head[some]] * (len(size) + 1)
                   + _intervals(*right, length - o)[head[some]])
            least[some, o] = _least(key, own[some])
    return of, least


REPLIES = "block int, owners binary, starts binary, masks binary"


def _compared(table: pa.Table, blocks: int, length: int) -> pa.Table:
    """Replies to the owners of a block's stretches: which windows an earlier text holds.

    Replies go to the blocks of their owners, in one row for each.
    Rows of ``_stretch_rows`` are put together to shards of at least SHARD strings.
    """
    rows, total = [], 0
    for packed_docs, packed in zip(table["owner_docs"].to_pylist(), table["stretches"].to_pylist()):
        owners, docs = _unpacked(packed_docs, np.int64, np.int64)
        body, size, left, number, local, place = _unpacked(
            packed, np.uint8, np.uint16, np.uint16, np.uint32, np.uint32, np.uint32)
        least = np.full(len(size), _NEVER)
        np.minimum.at(least, number, docs[local])
        rows.append((body, size.astype(np.int64), left.astype(np.int64), least,
                     np.full(len(size), total // SHARD), number + total, owners[local], docs[local], place))
        total += len(size)
    body, size, left, least, shard, number, owner, doc, place = (np.concatenate(c) for c in zip(*rows))
    del rows
    # Anchors that stand in one stretch only have no window in common with others.
    start = np.cumsum(size) - size
    names = symbols(body, start + left, np.full(len(size), ANCHOR), ANCHOR)
    _, at, times = np.unique(mixed(names[:, 0]) + names[:, 1], return_inverse=True, return_counts=True)
    alone = times[at] == 1
    # A stretch that stands in several places is compared with itself.
    lone = np.ones(len(size), bool)
    np.logical_and.at(lone, number, doc == least[number])
    use = ~(alone & lone)
    keep = np.repeat(use, size)
    renumbered = np.cumsum(use) - 1
    of, earliest = earlier(body[keep], size[use], left[use], least[use], shard[use], length)
    of_place = use[number]
    number, owner, doc, place = renumbered[number[of_place]], owner[of_place], doc[of_place], place[of_place]
    size, left = size[use][number], left[use][number]
    mask = np.zeros(len(number), np.uint64)
    for o in range(length - ANCHOR + 1):
        window = left - o
        hit = (window >= 0) & (window <= size - length) & (earliest[of[number], o] < doc)
        mask[hit] |= np.uint64(1) << window[hit].astype(np.uint64)
    hit = np.flatnonzero(mask)
    owner, place, mask = owner[hit], place[hit].astype(np.uint32), mask[hit]
    home = (owner.view(np.uint64) % np.uint64(blocks)).astype(np.int64)
    order = np.argsort(home, kind="stable")
    edges = np.searchsorted(home[order], np.arange(blocks + 1))
    homes = [h for h in range(blocks) if edges[h] < edges[h + 1]]
    parts = [order[edges[h]: edges[h + 1]] for h in homes]
    return pa.table([pa.array(homes, pa.int32()), *[pa.array([x[p].tobytes() for p in parts], pa.binary())
                                                    for x in (owner, place, mask)]],
                    names=["block", "owners", "starts", "masks"])


def _spans(table: pa.Table, length: int) -> pa.Table:
    """(owner, places): per owner, the first byte and the end of each stretch to remove."""
    owner, start, mask = (np.concatenate([np.frombuffer(x, kind) for x in table[c].to_pylist()])
                          for c, kind in (("owners", np.int64), ("starts", np.uint32), ("masks", np.uint64)))
    one = np.uint64(1)
    firsts, lasts = mask & ~(mask << one), mask & ~(mask >> one)
    found = []
    for edge in (firsts, lasts):
        bits = np.unpackbits(edge.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        found.append(np.nonzero(bits))
    (row, window), (_, last) = found
    owners, at = np.unique(owner, return_inverse=True)
    # Texts one after the other, so that one running maximum serves all of them.
    base = at[row].astype(np.int64) << 34
    first, end = base + start[row] + window, base + start[row] + last + length
    order = np.argsort(first, kind="stable")
    first, end = first[order], np.maximum.accumulate(end[order])
    new = np.flatnonzero(np.concatenate([[True], first[1:] > end[:-1]]))
    first, end = first[new], np.append(end[new[1:] - 1], end[-1])
    edges = np.searchsorted(first >> 34, np.arange(len(owners) + 1))
    both = (np.stack([first, end], 1) & ((1 << 34) - 1)).astype(np.uint32)
    return pa.table({"owner": pa.array(owners), "places": pa.array(
        [both[a:b].tobytes() for a, b in zip(edges, edges[1:])], pa.binary())})


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without their spans; the last two columns are the text and its spans."""
    for batch in batches:
        out = []
        for text, places in zip(batch.column(batch.num_columns - 2).to_pylist(),
                                batch.column(batch.num_columns - 1).to_pylist()):
            edges = np.frombuffer(places or b"", np.uint32).reshape(-1, 2).tolist()
            at, kept = 0, []
            for a, b in edges:
                kept.append(text[at:a])
                at = b
            kept.append(text[at:])
            out.append((b"".join(kept), len(text), sum(b - a for a, b in edges),
                        [{"first": a, "end": b} for a, b in edges]))
        types = (pa.binary(), pa.int64(), pa.int64(),
                 pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())])))
        new = [pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * 4, types)]
        names = ["bytes_kept", "n_bytes", "n_removed", "spans"]
        keep = batch.schema.names[:-2]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *new], [*keep, *names])


def remove_earlier(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, bytes_kept, n_bytes, n_removed, spans) of every row of ``docs`` (doc_id, text).

    A byte goes if a string of ``length`` bytes over it also starts in a text with a smaller
    doc_id; strings lie inside one text, and are judged on the input. ``spans`` has the first
    byte and the end of each stretch removed.

    Equal strings have equal anchors, so that texts fall into short stretches around anchors
    that never need to meet outside the block of their anchor. Anchors that stand only once in
    all texts are sorted out by their hashes first. What is left of a chunk for a block is a
    shard, with a Burrows-Wheeler transform of its own. A block merges its shards by refining
    their interleave round by round, derives common prefixes from neighbours, and takes the
    least document per interval of strings with enough common bytes. Equality is decided on
    the bytes, not on hashes. The number of blocks follows the size of the texts.

    Null text: empty. Null doc_id: compared with nothing, kept whole. Rows of one doc_id take
    nothing from each other; repeated rows get one result each. Texts under ``length`` bytes
    stay as they are. Empty table: no rows. Other columns are not read.
    """
    if not ANCHOR + 1 <= length <= ANCHOR + 63:
        raise ValueError(f"length must lie from {ANCHOR + 1} to {ANCHOR + 63}")
    spark = docs.sparkSession
    rows = docs.select(
        F.xxhash64("doc_id", "text").alias("key"), F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"),
    )
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BLOCK_BYTES))
    texts = rows.filter(F.col("doc_id").isNotNull() & (F.length("text") >= length))
    shared = shared_places(
        texts.select("key", "text").mapInArrow(_anchor_entries(blocks, length), SCHEMA),
        blocks, False, "shared-anchors")
    likely = attach(texts, "key", shared, only=True).select("key", "text", "doc_id", "places")
    replies = likely.mapInArrow(_stretch_rows(blocks, length), STRETCHES).groupBy("block").applyInArrow(
        lambda table: _compared(table, blocks, length), REPLIES)
    spans = materialize(
        replies.groupBy("block").applyInArrow(lambda table: _spans(table, length), "owner long, places binary"),
        "earlier-spans")
    marked = attach(rows, "key", spans, only=False).select("doc_id", "text", "places")
    cut = marked.filter("places IS NOT NULL").mapInArrow(
        _cut, "doc_id long, bytes_kept binary, n_bytes long, n_removed long, "
        "spans array<struct<first: long, end: long>>")
    whole = marked.filter("places IS NULL").select(
        "doc_id", F.col("text").alias("bytes_kept"), F.length("text").cast("long").alias("n_bytes"),
        F.lit(0).cast("long").alias("n_removed"),
        F.array().cast("array<struct<first: long, end: long>>").alias("spans"))
    return cut.unionByName(whole)
