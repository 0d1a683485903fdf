"""Collocations from a weighted de Bruijn graph of the longest word sequences."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starload.llm.common import WordHashes, bounded, chunks, joined, mixed
from starload.session import materialize

LONGEST = 5
# Bytes of text handled at once, and distinct pairs a task holds before it sends them on.
CHUNK = 4_000_000
HELD = 1 << 21
# Phrases of an output batch.
SENT = 50_000
# Bytes of text for a block of pairs on average; bits of the filter, at least and at most.
BLOCK_BYTES = 16_000_000
LEAST_BITS, MOST_BITS = 16, 28


class _Words(WordHashes):
    """Hashes and edges of the words (runs of anything but separators) of a chunk of texts.

    Blanks and tabs part words; the punctuation and line ends in ``breaks`` part pieces, too.
    """

    def __init__(self) -> None:
        super().__init__(lower=True)
        self.breaks = np.zeros(256, bool)
        # Fixed value: what ends a piece.
        self.breaks[list(b".,;:!?\n\v\f\r")] = True
        self.space = self.breaks.copy()
        self.space[[9, 32]] = True

    def _segment(self, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hashes, first = super()._segment(part)
        edge = np.flatnonzero(np.diff(~self.space[part], prepend=False, append=False))
        self.ends.append(edge[1::2] - first)
        return hashes, first

    def pieces(self, texts: list[bytes]) -> tuple[np.ndarray, ...]:
        """(bytes, hash, first byte, end, text, words left in the piece) of all words."""
        self.ends: list[np.ndarray] = []
        flat = np.frombuffer(b"\n".join(texts), np.uint8)
        hashes, first = self.located(flat)
        size = np.concatenate(self.ends) if self.ends else np.empty(0, np.int64)
        breaks = np.cumsum(self.breaks[flat], dtype=np.uint32)
        piece = breaks[first] if len(first) else first
        stops = np.flatnonzero(np.append(piece[1:] != piece[:-1], True)) if len(piece) else piece
        left = stops[np.searchsorted(stops, np.arange(len(piece)))] - np.arange(len(piece)) + 1
        offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
        return flat, hashes, first, first + size, np.searchsorted(offsets, first, side="right") - 1, left

    def located(self, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hashes, places, at = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], 0
        for stop in self.cuts(flat):
            found, first = self._segment(flat[at:stop])
            hashes.append(found)
            places.append(first + at)
            at = stop
        return np.concatenate(hashes), np.concatenate(places)


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


def _of_langs(hashes: np.ndarray, doc: np.ndarray, langs: list[str]) -> np.ndarray:
    """Word hashes that differ between languages."""
    names, number = np.unique(np.array(langs, object).astype(str), return_inverse=True)
    salt = np.array([xxhash.xxh3_64_intdigest(n.encode()) for n in names], np.uint64)
    return mixed(hashes + mixed(salt)[number][doc]) if len(hashes) else hashes


def _pair_rows(bits: int, blocks: int):
    """Counts of neighbouring words, by block; each task adds up its own first."""

    def rows(names: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(names)
        names, times = names[order], times[order]
        edges = np.searchsorted(names >> np.uint64(64 - bits), np.arange(blocks + 1) * ((1 << bits) // blocks))
        some = [b for b in range(blocks) if edges[b] < edges[b + 1]]
        return pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()),
             pa.array([names[edges[b]: edges[b + 1]].tobytes() for b in some], pa.binary()),
             pa.array([times[edges[b]: edges[b + 1]].tobytes() for b in some], pa.binary())],
            ["block", "names", "times"])

    def summed(names: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        unique, at = np.unique(np.concatenate(names), return_inverse=True)
        return unique, np.bincount(at, np.concatenate(times), len(unique)).astype(np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, names, times = _Words(), [], []
        for langs, texts in chunks(batches, CHUNK):
            _, word, _, _, doc, left = reader.pieces(texts)
            word = _of_langs(word, doc, langs)
            pairs, n = np.unique(joined(word[:-1], word[1:])[left[:-1] > 1], return_counts=True)
            names.append(pairs)
            times.append(n.astype(np.uint64))
            if sum(map(len, names)) > HELD:
                names, times = ([x] for x in summed(names, times))
                if len(names[0]) > HELD // 2:
                    yield rows(names[0], times[0])
                    names, times = [], []
        if names:
            yield rows(*summed(names, times))
    return run


def frequent_pairs(texts: DataFrame, least: int, total: int) -> np.ndarray:
    """A bit per slot of pairs of neighbouring words: set for all pairs found ``least`` times.

    ``texts`` (lang, text) has ``total`` bytes. The filter has at most 2 ** MOST_BITS bits, so
    some rarer pairs may pass it, which costs time but changes no count.
    """
    spark = texts.sparkSession
    bits = min(max(int(total // 64).bit_length(), LEAST_BITS), MOST_BITS)
    wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // BLOCK_BYTES)
    blocks = 1 << min(int(wanted - 1).bit_length(), bits - 3)

    def filtered(table: pa.Table) -> pa.Table:
        names = np.concatenate([np.frombuffer(x, np.uint64) for x in table["names"].to_pylist()])
        times = np.concatenate([np.frombuffer(x, np.uint64) for x in table["times"].to_pylist()])
        unique, at = np.unique(names, return_inverse=True)
        often = unique[np.bincount(at, times, len(unique)) >= least]
        part = np.zeros((1 << bits) // blocks, bool)
        part[((often >> np.uint64(64 - bits)) % np.uint64(len(part))).astype(np.int64)] = True
        return pa.table({"block": table["block"][:1],
                         "filter": pa.array([np.packbits(part, bitorder="little").tobytes()], pa.binary())})

    parts = texts.mapInArrow(_pair_rows(bits, blocks), "block int, names binary, times binary").groupBy(
        "block").applyInArrow(filtered, "block int, filter binary").collect()
    out = np.zeros((blocks, (1 << bits) // blocks // 8), np.uint8)
    for row in parts:
        out[row["block"]] = np.frombuffer(row["filter"], np.uint8)
    return out.ravel()


def _gram_rows(filter_, longest: int):
    """The word sequence from each word on, with its number in the chunk.

    It has ``longest`` words, or fewer if the piece ends or a rare pair follows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, bits = _Words(), filter_.value
        lower = np.arange(256, dtype=np.uint8)
        lower[65:91] += 32
        shift = np.uint64(64 - (len(bits) * 8 - 1).bit_length())
        for langs, texts in chunks(batches, CHUNK):
            flat, word, first, end, doc, left = reader.pieces(texts)
            if not len(word):
                continue
            word = _of_langs(word, doc, langs)
            slot = (joined(word[:-1], word[1:]) >> shift).astype(np.int64)
            cut = np.ones(len(word), bool)
            cut[:-1] = (bits[slot >> 3] >> (slot & 7).astype(np.uint8) & 1 == 0) | (left[:-1] == 1)
            stops = np.flatnonzero(cut)
            size = np.minimum(stops[np.searchsorted(stops, np.arange(len(word)))] - np.arange(len(word)) + 1,
                              longest)
            name = word
            for k in range(1, longest):
                name = np.where(size > k, joined(name, np.append(word[k:], np.zeros(k, np.uint64))[: len(word)]),
                                name)
            _, at, times = np.unique(mixed(name + size.astype(np.uint64)), return_index=True, return_counts=True)
            # The words one after the other, each with a blank behind.
            length = end - first + 1
            spaced = lower[flat[np.minimum(_ranges(first, length), len(flat) - 1)]]
            edge = np.concatenate([[0], np.cumsum(length)])
            spaced[edge[1:] - 1] = ord(" ")
            names = pa.array(langs, pa.string())
            for some in range(0, len(at), SENT):
                place, n = at[some: some + SENT], times[some: some + SENT]
                start, count = edge[place], edge[place + size[place]] - 1 - edge[place]
                offsets = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
                phrases = pa.StringArray.from_buffers(
                    len(place), pa.py_buffer(offsets), pa.py_buffer(spaced[_ranges(start, count)]))
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(doc[place])), phrases, pa.array(size[place].astype(np.int32)),
                     pa.array(n.astype(np.int64))], ["lang", "phrase", "words", "n"])
    return run


def phrase_flows(texts: DataFrame, least: int, longest: int, total: int) -> tuple[DataFrame, DataFrame]:
    """(phrases, totals): (lang, phrase, words, f) of all phrases found ``least`` times, of up to
    ``longest`` words, and (lang, n) of all words.

    The edges of the graph are the longest sequences, between the nodes they begin and end
    with; the last words of a piece make shorter ones. A node's count is what flows through
    its edges, and what ends there: each length is summed from the next one and the ends.
    """
    filter_ = texts.sparkSession.sparkContext.broadcast(frequent_pairs(texts, least, total))
    grams = materialize(
        texts.mapInArrow(_gram_rows(filter_, longest), "lang string, phrase string, words int, n long")
        .groupBy("lang", "words", "phrase").agg(F.sum("n").alias("f")), "longest-grams")
    flows = [grams.filter(F.col("words") == longest)]
    for words in range(longest - 1, 0, -1):
        passing = flows[-1].withColumn("phrase", F.substring_index("phrase", " ", words))
        ending = grams.filter(F.col("words") == words)
        flows.append(materialize(
            passing.withColumn("words", F.lit(words)).unionByName(ending).groupBy("lang", "words", "phrase")
            .agg(F.sum("f").alias("f")), f"flow-{words}"))
    totals = flows[-1].groupBy("lang").agg(F.sum("f").alias("n"))
    often = [f.filter(F.col("f") >= least) for f in flows]
    phrases = often[0]
    for f in often[1:]:
        phrases = phrases.unionByName(f)
    return materialize(phrases, "frequent-phrases"), materialize(totals, "word-totals")


def _words(count: Column) -> Column:
    """The first words of the phrase, or the last ones for a count below zero."""
    return F.call_function("substring_index", F.col("phrase"), F.lit(" "), count)


def collocations(docs: DataFrame, least: int = 100, longest: int = LONGEST, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language.

    Texts of ``docs`` (text, lang) are put in lower case (A-Z), split into pieces at ``.,;:!?``
    and line ends and into words at blanks and tabs. Phrases have 2 to ``longest`` words and
    are counted inside pieces, overlaps included. A phrase found a >= ``least`` times scores
    floor(1000 a n / (l r)) at its worst cut into two parts found l and r times, n being all
    words of the language; of equal cuts the first counts. A phrase whose whole flow passes
    into a longer one is a unary path of the graph, and left to the longer one. Higher scores
    come first, then higher a, then the phrase by its bytes.

    Tasks send a longest sequence once a chunk, cut where a pair of neighbours is too rare to
    be in any phrase wanted (told by a filter of bounded size), and parts are never counted in
    texts. Arithmetic is exact while a < 10 ** 15 and n < 10 ** 16.

    Null text: empty. Null lang: ``und``. Repeated rows count each. Empty table, or none
    frequent enough: no rows. Other columns are not read.
    """
    if longest < 2:
        raise ValueError("phrases have two words at least")
    rows = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"),
    )
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    phrases, totals = phrase_flows(rows, least, longest, total)
    found = phrases.filter("words > 1")
    # A node on a unary path: some edge at it carries all of its flow.
    edges = phrases.filter("words > 2")
    ends = F.array(_words(F.col("words") - 1), _words(1 - F.col("words")))
    inner = edges.select("lang", F.explode(ends).alias("phrase"), F.col("f").alias("edge"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("edge").alias("edge"))
    kept = found.join(bounded(materialize(inner, "edges-at-nodes")), ["lang", "phrase"], "left").filter(
        F.col("edge").isNull() | (F.col("edge") < F.col("f"))).drop("edge")
    cut = F.explode(F.sequence(F.lit(1), F.col("words") - 1))
    parts = bounded(phrases)

    def part(side: str, count: str) -> DataFrame:
        return parts.select("lang", F.col("phrase").alias(side), F.col("f").alias(count))

    cuts = (
        kept.withColumn("cut", cut)
        .withColumn("first_part", _words(F.col("cut")))
        .withColumn("rest", _words(F.col("cut") - F.col("words")))
        .join(part("first_part", "l"), ["lang", "first_part"]).join(part("rest", "r"), ["lang", "rest"])
        .join(bounded(totals), "lang")
        .withColumn("score", F.expr(
            "cast(1000 as decimal(4,0)) * cast(f as decimal(15,0)) * cast(n as decimal(16,0)) div "
            "(cast(l as decimal(15,0)) * cast(r as decimal(15,0)))"))
    )
    scored = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "f", "l", "r", "n")).alias("s"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        scored.select("lang", "phrase", F.col("s.f").alias("a"), "s.l", "s.r", "s.n", "s.score")
        .withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
