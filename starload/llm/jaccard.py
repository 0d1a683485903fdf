"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.llm.common import WordHashes, bounded, chunks, window_hashes
from starload.llm.components import components
from starload.llm.exchange import block_count
from starload.session import materialize

SHINGLE = 5
# Two sets link from 75 common of 100 united shingles on.
SHARE = 75
# Entries of the table of frequent shingles: a bound of its size, not of what it is used for.
FREQUENT = 1 << 19
FREQUENT_FROM = 8
# Lists up to this long are cut to the texts with a partner of fitting size.
SHORT_LIST = 128
# Sets a task multiplies with as many others at once, and shingles per block of columns.
SIDE = 1536
COLUMNS = 1024


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """(id, class, set) of each text; texts with the same words are of one class.

    A set has the distinct hashes of the text's shingles, in order; of all its words as one,
    if they are fewer. A-Z count as a-z.
    """
    hasher = WordHashes(lower=True)
    for ids, texts in chunks(batches):
        words, starts = hasher(texts)
        windows = window_hashes(words, SHINGLE)
        rows = []
        for key, a, b in zip(ids, starts.tolist(), starts[1:].tolist()):
            mine = windows[a: b - SHINGLE + 1] if b - a >= SHINGLE else window_hashes(words[a:b], b - a)
            name = np.uint64(xxhash.xxh3_64_intdigest(words[a:b].tobytes())).astype(np.int64)
            rows.append((key, int(name), np.unique(mine)))
        yield rows


def _sizes(batches):
    for rows in _sets(batches):
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
             pa.array([len(r[2]) for r in rows], pa.int64())], ["doc_id", "class", "n_shingles"])


def _block_of(x: np.ndarray, blocks: int) -> np.ndarray:
    return ((x & np.uint64(0xFFFFFFFF)) % np.uint64(blocks)).astype(np.int64)


def _short(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(32)).astype(np.uint32)


def _parts(block: np.ndarray, blocks: int) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(block, kind="stable")
    edges = np.searchsorted(block[order], np.arange(blocks + 1))
    for b in range(blocks):
        if edges[b] < edges[b + 1]:
            yield b, order[edges[b]: edges[b + 1]]


def frequent_shingles(texts: DataFrame, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, by 32 bits and block, and their numbers of texts.

    All texts are counted, each task sending a shingle once with its count. The table holds
    at most ``FREQUENT`` entries, so how often a shingle must occur to be in it follows the
    corpus. It serves to order shingles only; any order gives the same links.
    """

    def counted(batches):
        for rows in _sets(batches):
            values, times = np.unique(np.concatenate([r[2] for r in rows]), return_counts=True)
            out = [(b, _short(values[p]).tobytes(), times[p].astype(np.uint32).tobytes())
                   for b, p in _parts(_block_of(values, blocks), blocks)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 3,
                                                (pa.int32(), pa.binary(), pa.binary()))],
                ["block", "names", "times"])

    def summed(table: pa.Table) -> pa.Table:
        names = np.concatenate([np.frombuffer(x, np.uint32) for x in table["names"].to_pylist()])
        times = np.concatenate([np.frombuffer(x, np.uint32) for x in table["times"].to_pylist()])
        unique, at = np.unique(names, return_inverse=True)
        total = np.bincount(at, weights=times).astype(np.int64)
        level = np.minimum(np.log2(np.maximum(total, 1)).astype(int), 62)
        keep = total >= FREQUENT_FROM
        rows = [(int(k), int((level[keep] == k).sum()), unique[keep][level[keep] == k].tobytes(),
                 total[keep][level[keep] == k].tobytes()) for k in np.unique(level[keep])]
        columns = list(zip(*rows)) or [[]] * 4
        block = table["block"][0].as_py()
        return pa.table([pa.array([block] * len(rows), pa.int32()), pa.array(columns[0], pa.int32()),
                         pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.binary()),
                         pa.array(columns[3], pa.binary())],
                        names=["block", "level", "n", "names", "times"])

    table = materialize(
        texts.mapInArrow(counted, "block int, names binary, times binary").groupBy("block")
        .applyInArrow(summed, "block int, level int, n long, names binary, times binary"),
        "frequent-shingles",
    )
    least, held = 64, 0
    for row in table.groupBy("level").agg(F.sum("n").alias("n")).orderBy(F.desc("level")).collect():
        held += row["n"]
        if held > FREQUENT:
            break
        least = row["level"]
    names, times = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for row in table.filter(F.col("level") >= least).collect():
        names.append((np.uint64(row["block"]) << np.uint64(32))
                     + np.frombuffer(row["names"], np.uint32).astype(np.uint64))
        times.append(np.frombuffer(row["times"], np.int64))
    name, time = np.concatenate(names), np.concatenate(times)
    order = np.argsort(name)
    return name[order], time[order]


def _need(a, b):
    """Least overlap of two sets of these sizes that link."""
    return -(-SHARE * (a + b) // (100 + SHARE))


def _prefixes(frequent, blocks: int):
    """Postings of the rarest shingles of each text, enough that linked texts share one."""

    def run(batches):
        names, times = (x.value for x in frequent)
        for rows in _sets(batches):
            seen, found = set(), []
            for _, name, values in rows:
                n = len(values)
                if not n or name in seen:
                    continue
                seen.add(name)
                rank = np.ones(n, np.int64)
                if len(names):
                    full = (_block_of(values, blocks).astype(np.uint64) << np.uint64(32)) + _short(values)
                    at = np.minimum(np.searchsorted(names, full), len(names) - 1)
                    hit = names[at] == full
                    rank[hit] = times[at[hit]]
                prefix = values[np.lexsort((values, rank))[: n - -(-SHARE * n // 100) + 1]]
                found.append((name, n, prefix))
            if not found:
                continue
            lengths = [len(f[2]) for f in found]
            values = np.concatenate([f[2] for f in found])
            of = np.repeat(np.arange(len(found)), lengths)
            place = np.concatenate([np.arange(k) for k in lengths]).astype(np.uint32)
            name = np.array([f[0] for f in found], np.int64)
            size = np.array([f[1] for f in found], np.uint32)
            out = []
            for b, p in _parts(_block_of(values, blocks), blocks):
                mine, n = np.unique(of[p], return_counts=True)
                out.append((b, _short(values[p]).tobytes(), name[mine].tobytes(), size[mine].tobytes(),
                            n.astype(np.uint32).tobytes(), place[p].tobytes()))
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]],
                ["block", "names", "classes", "sizes", "counts", "places"])
    return run


def _candidates(table: pa.Table) -> pa.Table:
    """(leader, member): the texts of each shingle's list, gathered under its least class.

    Texts that cannot reach the overlap their sizes ask for, judged at the place of the
    shingle in both, are left out of lists short enough to compare; a linked pair passes at
    its first common shingle.
    """
    got = [[] for _ in range(4)]
    for h, c, s, n, p in zip(*[table[k].to_pylist() for k in
                               ("names", "classes", "sizes", "counts", "places")]):
        n = np.frombuffer(n, np.uint32)
        for x, v in zip(got, (np.frombuffer(h, np.uint32), np.repeat(np.frombuffer(c, np.int64), n),
                              np.repeat(np.frombuffer(s, np.uint32), n).astype(np.int64),
                              np.frombuffer(p, np.uint32).astype(np.int64))):
            x.append(v)
    name, who, size, place = (np.concatenate(x) for x in got)
    order = np.lexsort((who, name))
    name, who, size, place = name[order], who[order], size[order], place[order]
    new = np.ones(len(name), bool)
    new[1:] = (name[1:] != name[:-1]) | (who[1:] != who[:-1])
    name, who, size, rest = name[new], who[new], size[new], (size - place)[new]
    first = np.flatnonzero(np.concatenate([[True], name[1:] != name[:-1]]))
    end = np.append(first[1:], len(name))
    pairs = []
    for a, b in zip(first[end - first > 1], end[end - first > 1]):
        members = who[a:b]
        if b - a <= SHORT_LIST:
            fits = np.minimum(rest[a:b, None], rest[None, a:b]) >= _need(size[a:b, None], size[None, a:b])
            np.fill_diagonal(fits, False)
            members = members[fits.any(axis=1)]
        if len(members) > 1:
            pairs.append(np.stack([np.full(len(members), members.min()), members]))
    both = np.unique(np.concatenate(pairs, axis=1), axis=1) if pairs else np.empty((2, 0), np.int64)
    return pa.table({"leader": pa.array(both[0]), "member": pa.array(both[1])})


def _linked(left: list[np.ndarray], right: list[np.ndarray] | None) -> np.ndarray:
    """Which sets of ``left`` link with which of ``right`` (or of ``left``): overlap counts
    are summed over blocks of columns, and given up where no pair can reach its bound."""
    every = left if right is None else left + right
    size = np.array([len(s) for s in every], np.int64)
    values, column, times = np.unique(np.concatenate(every), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(every)), size)
    # Shingles of one set only add to no overlap.
    use = times[column] > 1
    renamed = np.cumsum(times > 1) - 1
    row, column = row[use], renamed[column[use]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    a = slice(0, len(left))
    b = a if right is None else slice(len(left), len(every))
    need = _need(size[a, None], size[None, b])
    overlap = np.zeros(need.shape, np.float32)
    rest = np.bincount(row, minlength=len(every)).astype(np.float32)
    at, total = 0, int(renamed[-1]) + 1 if len(renamed) else 0
    for start in range(0, total, COLUMNS):
        if not (overlap + np.minimum(rest[a, None], rest[None, b]) >= need).any():
            return np.zeros(need.shape, bool)
        stop = np.searchsorted(column, start + COLUMNS)
        block = np.zeros((len(every), min(COLUMNS, total - start)), np.float32)
        block[row[at:stop], column[at:stop] - start] = 1
        overlap += block[a] @ block[b].T
        rest -= block.sum(axis=1)
        at = stop
    return overlap >= need


def _links(table: pa.Table) -> pa.Table:
    """Links enough to connect what is linked: each text with the least one it reaches here."""
    out_a, out_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    keys = np.stack([table[c].to_numpy() for c in ("leader", "low", "high")])
    side, doc = table["side"].to_numpy(), table["doc"].to_numpy()
    sets = [np.frombuffer(x, np.uint64) for x in table["values"].to_pylist()]
    order = np.lexsort((doc, side, *keys[::-1]))
    change = np.any(np.diff(keys[:, order], axis=1) != 0, axis=0)
    for part in np.split(order, np.flatnonzero(change) + 1):
        low, high = keys[1:, part[0]]
        if low == high:
            docs = doc[part]
            linked = _linked([sets[i] for i in part], None)
            np.fill_diagonal(linked, True)
            label = docs.copy()
            while True:
                label_new = np.where(linked, label[None], np.iinfo(np.int64).max).min(axis=1)
                if (label_new == label).all():
                    break
                label = label_new
            out_a.append(docs[label != docs])
            out_b.append(label[label != docs])
        else:
            l, r = part[side[part] == low], part[side[part] == high]
            if len(l) and len(r):
                linked = _linked([sets[i] for i in l], [sets[i] for i in r])
                # A forest of both sides: each right one with its first left one, and left
                # ones with the first left one that a right one of theirs has.
                hit = np.flatnonzero(linked.any(axis=0))
                head = linked[:, hit].argmax(axis=0)
                out_a.append(doc[r[hit]])
                out_b.append(doc[l[head]])
                for i in range(len(l)):
                    heads = np.unique(head[linked[i, hit]])
                    out_a.append(np.full(len(heads), doc[l[i]]))
                    out_b.append(doc[l[heads]])
    a, b = np.concatenate(out_a), np.concatenate(out_b)
    pairs = np.unique(np.stack([a, b])[:, a != b], axis=1)
    return pa.table({"a": pa.array(pairs[0]), "b": pa.array(pairs[1])})


def jaccard_join(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text).

    Texts are compared as sets of five-word shingles (A-Z in lower case; a text of fewer words
    is one shingle) and linked from a Jaccard similarity of 0.75 on; component_id is the least
    doc_id reachable. Texts with equal words are one class, represented by its least id.

    Each class posts the rarest of its shingles, in one order for all: so many that the sizes
    allow no link without a common one. The texts of a posting list are gathered under its
    least class, one row each, and a group's sets are multiplied in blocks of rows and
    columns; only links that connect the group leave the task. Large groups are split into
    pairs of sides. Shingles are compared by 64-bit hashes.

    Null or empty text: no shingles, and a component of its own. Null doc_id: no component
    (NULL), linked with nothing. Repeated rows: one result each. Texts of one doc_id are linked
    as that document. Empty table: no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    blocks = block_count(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    info = materialize(texts.mapInArrow(_sizes, "doc_id long, class long, n_shingles long"), "set-sizes")
    named = texts.filter(F.col("doc_id").isNotNull())
    classes = info.filter("doc_id IS NOT NULL AND n_shingles > 0").groupBy("class").agg(
        F.min("doc_id").alias("first_id"))

    names, times = frequent_shingles(named, blocks)
    sent = [spark.sparkContext.broadcast(x) for x in (names, times)]
    postings = named.mapInArrow(
        _prefixes(sent, blocks),
        "block int, names binary, classes binary, sizes binary, counts binary, places binary")
    groups = materialize(
        postings.groupBy("block").applyInArrow(_candidates, "leader long, member long").distinct(), "lists")
    # A leader that is a member elsewhere joins the least leader it has there.
    home = groups.groupBy("member").agg(F.min("leader").alias("home"))
    home = home.withColumnRenamed("member", "leader")
    groups = groups.join(home, "leader").select(F.col("home").alias("leader"), "member").distinct()
    groups = materialize(groups, "groups")

    members = materialize(
        groups.select(F.col("member").alias("class")).distinct().join(classes, "class")
        .withColumnRenamed("first_id", "doc_id"), "members")

    def packed(batches):
        for rows in _sets(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([r[2].tobytes() for r in rows], pa.binary())], ["class", "values"])

    # An id may come with other texts, too: sets go by their class, and classes by their least id.
    wanted = named.join(bounded(members.select("doc_id").distinct()), "doc_id", "left_semi")
    sets = wanted.mapInArrow(packed, "class long, values binary").dropDuplicates(["class"])
    sets = sets.join(bounded(members.withColumnRenamed("doc_id", "doc")), "class")

    sizes = groups.groupBy("leader").agg(F.count("*").alias("n"))
    sided = (
        groups.join(sizes, "leader")
        .withColumn("sides", F.ceil(F.col("n") / SIDE).cast("int"))
        .withColumn("side", F.pmod(F.xxhash64("member"), F.col("sides")).cast("int"))
        # A side meets itself and every other side once.
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("sides") - 1)))
        .select("leader", F.col("member").alias("class"), "side",
                F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"),
                # Small groups share a task.
                F.when(F.col("sides") == 1, F.pmod(F.xxhash64("leader"), F.lit(4 * blocks)))
                .otherwise(F.xxhash64("leader", F.least("side", "other"), F.greatest("side", "other")))
                .alias("task"))
    )
    links = sided.join(sets, "class").groupBy("task").applyInArrow(_links, "a long, b long")
    # An id with several texts links their classes.
    several = info.filter("doc_id IS NOT NULL AND n_shingles > 0").groupBy("doc_id").agg(
        F.min("class").alias("low"), F.max("class").alias("high")).filter("low <> high")
    held = info.filter("n_shingles > 0").join(several.select("doc_id"), "doc_id").join(classes, "class")
    links = links.unionByName(held.select(F.col("doc_id").alias("a"), F.col("first_id").alias("b")))
    labels = components(links)
    # The class representative's component, or the representative itself.
    found = classes.join(labels.withColumnRenamed("node", "first_id"), "first_id", "left").select(
        "class", F.coalesce("component", "first_id").alias("component_id"))
    return info.join(found, "class", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("component_id"))
        .otherwise(F.col("doc_id")).alias("component_id"))
