"""Best-fit packing: documents as token sequences of bounded length."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.llm.common import bounded, chunks, ranked, ranked_along
from starload.llm.tokens import Tokenizer
from starload.session import materialize

CAPACITY = 1024
END = 2
# Sequences of one kind are spread evenly over so many instants.
INSTANTS = 1 << 30
# One row makes the places of so many sequences.
CHUNK_SEQUENCES = 10_000


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END,
           with_ids: bool = True, others: Mapping[str, str] | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids][, others]) of every row of ``docs`` (doc_id, text).

    A text's ids are followed by ``end``; only longer ones are cut. All pieces but the first
    are full. ``tokenizer`` is a vocabulary file that every executor has. ``others`` names
    long or string columns, with their types, that each piece keeps.
    """
    others = dict(others or {})
    other_types = [pa.int64() if t == "long" else pa.string() for t in others.values()]
    other_names = list(others)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Tokenizer(tokenizer)
        for ids, texts, *more in chunks(batches):
            rows, kept, beside = [], [], [[] for _ in more]
            for at, (key, text) in enumerate(zip(ids, texts)):
                tokens = np.append(encode(text), np.uint32(end)).astype("<u4")
                stop = (len(tokens) - 1) % capacity + 1
                start = piece = 0
                while start < len(tokens):
                    part = tokens[start:stop]
                    rows.append((key, piece, start, len(part), zlib.crc32(part.tobytes())))
                    if with_ids:
                        kept.append(part.astype(np.int32))
                    for column, values in zip(beside, more):
                        column.append(values[at])
                    start, stop, piece = stop, stop + capacity, piece + 1
            columns = [pa.array(c, t) for c, t in zip(
                zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                offsets = np.concatenate([[0], np.cumsum([len(k) for k in kept])])
                columns.append(pa.ListArray.from_arrays(
                    pa.array(offsets, pa.int32()), pa.array(np.concatenate(kept))))
                names.append("ids")
            columns.extend(pa.array(c, t) for c, t in zip(beside, other_types))
            names.extend(other_names)
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return docs.select(
        F.col("doc_id").cast("long"), "text", *[F.col(c).cast(t) for c, t in others.items()]
    ).mapInArrow(
        cut, schema + ", ids array<int>" * with_ids + "".join(f", {c} {t}" for c, t in others.items()))


def _reachable(counts: Mapping[int, int], limit: int) -> int:
    """Largest sum up to ``limit`` of some of the items."""
    sums, mask = 1, (1 << (limit + 1)) - 1
    for length, n in counts.items():
        if length > limit:
            continue
        n, step = min(n, limit // length), 1
        while n > 0:
            take = min(step, n)
            sums |= (sums << (length * take)) & mask
            n, step = n - take, step * 2
        if sums >> limit & 1:
            return limit
    return sums.bit_length() - 1


def dominant_sets(counts: Mapping[int, int], capacity: int) -> tuple[list, dict[int, int]]:
    """Sets fixed for good, as (how often, {length: times}), and the items left.

    A long item with the longest partner that fits is fixed if no set of other items fills
    the rest of its sequence better: whatever else shared its sequence could trade places
    with that partner. An item that nothing fits beside is fixed alone. Each fixed set shrinks
    the instance, which may make others dominant.
    """
    left = {k: n for k, n in counts.items() if n > 0}
    fixed, changed = [], True
    while changed:
        changed = False
        for a in sorted(left, reverse=True):
            while left.get(a):
                rest = dict(left)
                rest[a] -= 1
                fits = [k for k, n in rest.items() if n > 0 and k <= capacity - a]
                if not fits:
                    fixed.append((left[a], {a: 1}))
                    left.pop(a)
                    changed = True
                    break
                b = max(fits)
                if b != capacity - a and _reachable(rest, capacity - a) != b:
                    break
                n = left[a] // 2 if a == b else min(left[a], left[b])
                fixed.append((n, {a: 2} if a == b else {a: 1, b: 1}))
                for k in (a, b):
                    left[k] -= n
                left = {k: m for k, m in left.items() if m > 0}
                changed = True
    return fixed, left


def best_fit(counts: Mapping[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """Best fit, longest items first, as (how often, {length: times}).

    Sequences that look alike are handled together. An item goes where it leaves the least
    room, so a sequence that took one takes more of the same length while they fit.
    """
    room: dict[int, list[tuple[int, dict[int, int]]]] = {}
    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n > 0:
            fitting = [r for r in room if r >= length]
            if fitting:
                space = min(fitting)
                times, held = room[space].pop()
                if not room[space]:
                    del room[space]
            else:
                space, times, held = capacity, n, {}
            each = space // length
            full = min(times, n // each)
            some = n - full * each if full < times and n < times * each else 0
            if full:
                room.setdefault(space - each * length, []).append((full, held | {length: each}))
            if some:
                room.setdefault(space - some * length, []).append((1, held | {length: some}))
            if held and times - full - bool(some):
                room.setdefault(space, []).append((times - full - bool(some), held))
            n -= full * each + some
    return [x for groups in room.values() for x in groups]


def plan(counts: Mapping[int, int], capacity: int = CAPACITY) -> list[tuple]:
    """Rows (length, first, end, each, sequence, offset): the items of ``length`` ranked
    ``first`` to ``end`` go, ``each`` to a sequence, to the sequences from ``sequence`` on.

    Its size depends on the number of different lengths only.
    """
    fixed, left = dominant_sets(counts, capacity)
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for times, held in [*fixed, *best_fit(left, capacity)]:
        offset = 0
        for length, each in held.items():
            first = used.get(length, 0)
            used[length] = first + times * each
            rows.append((length, first, used[length], each, sequence, offset))
            offset += length * each
        sequence += times
    return rows


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``parts`` (doc_id, piece, length, others kept) with ``sequence_id`` and ``offset``.

    ``parts`` is read twice, so it should be a written table. Lengths are counted, at most
    ``capacity`` different ones whatever the number of rows; the driver packs these counts.
    Each row then finds its place by its rank among the rows of its length.
    """
    counts = {r["length"]: r["n"] for r in
              parts.groupBy("length").agg(F.count("*").alias("n")).collect()}
    rows = plan(counts, capacity)
    slots = parts.sparkSession.createDataFrame(
        rows or [(0, 0, 0, 1, 0, 0)],
        "length long, pack_first long, pack_end long, pack_each long, pack_sequence long, "
        "pack_offset long",
    )
    placed = ranked(parts, "length", ["doc_id", "piece"], sum(counts.values()), "pack_rank").alias("p")
    # The plan has at most a few rows for each pair of lengths up to the capacity.
    placed = placed.join(
        F.broadcast(slots.alias("s")),
        (F.col("p.length") == F.col("s.length")) & (F.col("pack_rank") >= F.col("pack_first"))
        & (F.col("pack_rank") < F.col("pack_end")),
    )
    at = F.col("pack_rank") - F.col("pack_first")
    return placed.select(
        *[F.col(f"p.`{c}`") for c in parts.columns],
        (F.col("pack_sequence") + F.floor(at / F.col("pack_each"))).alias("sequence_id"),
        (F.col("pack_offset") + at % F.col("pack_each") * F.col("p.length")).alias("offset"),
    )


def pack_along(parts: DataFrame, order: str, capacity: int = CAPACITY) -> DataFrame:
    """As ``pack``, with sequences that follow the whole number in column ``order``.

    The sequences of each kind in the plan are spread evenly, and the pieces of a length take
    their places along the spread in their order, so that pieces of one sequence stand near each
    other. Sequences are then numbered by the mean of the order over their tokens.
    """
    spark = parts.sparkSession
    counts = {r["length"]: r["n"] for r in
              parts.groupBy("length").agg(F.count("*").alias("n")).collect()}
    end = (parts.agg(F.max(order)).first()[0] or 0) + 1
    kinds = [(length, (stop - first) // each, each, sequence, offset)
             for length, first, stop, each, sequence, offset in plan(counts, capacity)]
    # Bounded like the plan; the places themselves are made in tasks.
    places = spark.createDataFrame(
        kinds, "length long, times long, each long, sequence long, first_offset long"
    ).withColumn("chunk", F.explode(F.expr(f"sequence(0L, times - 1, {CHUNK_SEQUENCES}L)")))
    places = (
        places.repartition("length", "sequence", "chunk")
        .withColumn("k", F.explode(F.expr(f"sequence(chunk, least(times, chunk + {CHUNK_SEQUENCES}) - 1)")))
        .withColumn("i", F.explode(F.expr("sequence(0L, each - 1)")))
        .select(
            "length", F.expr(f"((2 * k + 1) * {INSTANTS // 2}) div times").alias("pack_instant"),
            F.expr("sequence + k").alias("pack_sequence"),
            F.expr("first_offset + i * length").alias("offset"),
        )
    )
    places = ranked_along(
        places, ["length"], ["pack_instant", "pack_sequence", "offset"], INSTANTS, "pack_rank")
    placed = materialize(
        ranked_along(parts, ["length"], [order, "piece"], end, "pack_rank")
        .join(places, ["length", "pack_rank"]), "placed")
    sequences = placed.groupBy("pack_sequence").agg(
        F.expr(f"sum({order} * length) div sum(length)").alias("pack_mean"))
    numbered = ranked_along(
        materialize(sequences, "sequences"), [], ["pack_mean", "pack_sequence"], end, "sequence_id")
    return placed.join(
        bounded(numbered.select("pack_sequence", F.col("sequence_id").cast("long"))), "pack_sequence"
    ).select(*[F.col(f"`{c}`") for c in parts.columns], "sequence_id", "offset")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END,
                   with_ids: bool = True,
                   mixed: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Pieces of all ``docs`` (doc_id, text) and their places: sequences of at most
    ``capacity`` ids, gapless from offset 0.

    ``mixed`` gives rows (doc_id, source, one more) their ``mix_position``; sequences then follow
    it. Null or empty text: one piece holding ``end`` only. Null doc_id and repeated rows: pieces
    and places of their own. Empty table: no rows. Other columns are not read.
    """
    if mixed is None:
        return pack(materialize(pieces(docs, tokenizer, capacity, end, with_ids), "pieces"), capacity)
    # Rows are told apart by a number, which is fixed once the pieces are written.
    parts = materialize(
        pieces(docs.withColumn("pack_row", F.monotonically_increasing_id()), tokenizer, capacity, end,
               with_ids, {"pack_row": "long", "source": "string"}), "pieces")
    heads = mixed(parts.filter("piece = 0").select("doc_id", "source", "pack_row"))
    order = materialize(heads.select("pack_row", "mix_position"), "positions")
    ordered = materialize(parts.join(bounded(order), "pack_row"), "ordered-pieces")
    return pack_along(ordered, "mix_position", capacity).drop("pack_row", "source", "mix_position")
