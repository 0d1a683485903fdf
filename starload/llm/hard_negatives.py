"""Hard negatives by an exact search in a multiway tree with stored distance ranges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starload.session import materialize

# Rows the tree is fitted on, at most; split points of a node; rows of a leaf, as far as the sample
# can tell, and of a block of it; anchors that meet a block at once.
SAMPLE = 4096
WAYS = 12
LEAF_ROWS = 2048
PROBES = 1024
# Blocks are searched in parts of about so many rows, and in so many parts at most; the anchors of
# a part come in slices of about so many bytes.
PART_ROWS = 8192
PARTS = 128
SLICE_BYTES = 32_000_000
# Products are looked through in tiles of so many rows, fewer where more hits than this stand in
# one, down to the least.
TILE = 2048
LEAST_TILE = 128
HITS_AT_ONCE = 1 << 18
# Sums of products are exact in single floats and in doubles up to here.
EXACT_SINGLE = float(1 << 24)
EXACT = float(1 << 53)


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def _gaps(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Distances of rows to points, all in whole numbers: by products, where those are exact."""
    most = np.abs(rows).max(initial=0) + np.abs(points).max(initial=0)
    if most * most * rows.shape[1] < EXACT:
        square = (rows**2).sum(axis=1)[:, None] + (points**2).sum(axis=1)
        return np.sqrt(square - 2 * (rows @ points.T))
    out = np.empty((len(rows), len(points)))
    for i, point in enumerate(points):
        out[:, i] = np.sqrt(((rows - point) ** 2).sum(axis=1))
    return out


class Tree:
    """Nodes with split points; each row goes to the child of its nearest point, down to a leaf.

    ``children`` holds node numbers from 0 on, and leaves as -1 - their number. ``low`` and
    ``high`` tell the range of distances from each split point to the rows below each sibling,
    ``least`` and ``most`` the range of squared lengths of those rows.
    """

    def __init__(self, sample: np.ndarray, rows: int) -> None:
        self.points: list[np.ndarray] = []
        self.children: list[list[int]] = []
        self.leaves = 0
        self.dice = np.random.default_rng(11)
        self._share = rows / max(1, len(sample))
        self.top = self._grown(sample)
        ways = [len(p) for p in self.points]
        self.low = [np.full((m, m), np.inf) for m in ways]
        self.high = [np.full((m, m), -np.inf) for m in ways]
        self.least = [np.full(m, np.inf) for m in ways]
        self.most = [np.full(m, -np.inf) for m in ways]

    def _grown(self, sample: np.ndarray) -> int:
        distinct = np.unique(sample, axis=0) if len(sample) * self._share > LEAF_ROWS else sample[:0]
        if len(distinct) < 2:
            self.leaves += 1
            return -self.leaves
        # Far apart: each next point is the one of a few drawn that is farthest from those taken.
        drawn = distinct[self.dice.permutation(len(distinct))[: 3 * WAYS]]
        taken = [0]
        gap = _gaps(drawn, drawn[:1])[:, 0]
        while len(taken) < min(WAYS, len(drawn)):
            taken.append(int(gap.argmax()))
            gap = np.minimum(gap, _gaps(drawn, drawn[taken[-1:]])[:, 0])
        points = drawn[taken]
        number = len(self.points)
        self.points.append(points)
        self.children.append([])
        nearest = _gaps(sample, points).argmin(axis=1)
        for j in range(len(points)):
            self.children[number].append(self._grown(sample[nearest == j]))
        return number

    def descend(self, rows: np.ndarray) -> Iterator[tuple]:
        """(node, numbers of the rows that pass it, their distances, the child each goes to)."""
        todo = [(self.top, np.arange(len(rows)))] if self.top >= 0 else []
        while todo:
            node, some = todo.pop()
            gap = _gaps(rows[some], self.points[node])
            child = gap.argmin(axis=1)
            yield node, some, gap, child
            for j, below in enumerate(self.children[node]):
                if below >= 0 and (child == j).any():
                    todo.append((below, some[child == j]))

    def leaf_of(self, rows: np.ndarray) -> np.ndarray:
        leaf = np.zeros(len(rows), np.int32)
        for node, some, _, child in self.descend(rows):
            below = np.array(self.children[node])[child]
            leaf[some[below < 0]] = -1 - below[below < 0]
        return leaf

    def opened(self, rows: np.ndarray, of: np.ndarray, lowest: np.ndarray,
               highest: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, numbers of the probes for which it is open), for the leaves that are to any.

        A probe i asks for vectors whose product with row of[i] lies from lowest to highest.
        A product s and a squared length in [a, b] set a window for the distance d to the row,
        as d * d is the sum of both squared lengths less 2 s. By the triangle inequality the
        stored ranges bound d as well; a sibling whose bounds miss its window is passed by.
        """
        size = (rows**2).sum(axis=1)[of]
        todo = [(self.top, np.flatnonzero(lowest <= highest))]
        while todo:
            node, some = todo.pop()
            if node < 0:
                yield -1 - node, some
                continue
            mine, back = np.unique(of[some], return_inverse=True)
            gap = _gaps(rows[mine], self.points[node])
            for j, below in enumerate(self.children[node]):
                if self.most[node][j] < self.least[node][j]:
                    continue
                low, high = self.low[node][:, j], self.high[node][:, j]
                near = np.maximum(low - gap, gap - high).max(axis=1)[back]
                far = (gap + high).min(axis=1)[back]
                inner = size[some] + self.least[node][j] - 2 * highest[some]
                outer = size[some] + self.most[node][j] - 2 * lowest[some]
                slack = 1e-9 * (1 + far)
                open_ = outer >= 0
                open_ &= np.maximum(near, 0) <= np.sqrt(np.maximum(outer, 0)) * (1 + 1e-9) + slack
                open_ &= np.sqrt(np.maximum(inner, 0)) * (1 - 1e-9) <= far + slack
                if open_.any():
                    todo.append((below, some[open_]))

    def open_leaves(self, rows: np.ndarray, lowest: np.ndarray, highest: np.ndarray) -> list[list[int]]:
        """For each row, the leaves that may hold a vector with a product from lowest to highest."""
        out: list[list[int]] = [[] for _ in range(len(rows))]
        for leaf, some in self.opened(rows, np.arange(len(rows)), lowest, highest):
            for i in some:
                out[i].append(leaf)
        return out


def labelled_vectors(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, label, v): each component as floor(scale * x), shorter vectors filled with zeros.

    Rows without id, label or vector, and vectors holding a NULL or a component that is not
    finite, are left out.
    """
    x = F.col("embedding").cast("array<double>")
    odd = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    rows = vectors.select("vec_id", "label", "embedding").dropna().filter(~odd).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
        F.transform(x, lambda e: F.floor(e * scale).cast("double")).alias("v"),
    )
    width = rows.agg(F.max(F.size("v"))).first()[0] or 0
    return rows.withColumn("v", F.concat("v", F.array_repeat(F.lit(0.0), F.lit(width) - F.size("v"))))


def _placed(tree: Tree):
    def run(batches):
        for batch in batches:
            leaf = tree.leaf_of(_matrix(batch.column(2)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int32())],
                                             [*batch.schema.names, "leaf"])
    return run


RANGES = "node int, child int, point int, low double, high double, least double, most double"


def _range_rows(tree: Tree):
    """Of each task, the ranges of distances from split points to the rows below siblings."""

    def run(batches):
        low, high = [x.copy() for x in tree.low], [x.copy() for x in tree.high]
        least, most = [x.copy() for x in tree.least], [x.copy() for x in tree.most]
        for batch in batches:
            rows = _matrix(batch.column(0))
            size = (rows**2).sum(axis=1)
            for node, some, gap, child in tree.descend(rows):
                for j in np.unique(child):
                    mine, long = gap[child == j], size[some[child == j]]
                    low[node][:, j] = np.minimum(low[node][:, j], mine.min(axis=0))
                    high[node][:, j] = np.maximum(high[node][:, j], mine.max(axis=0))
                    least[node][j] = min(least[node][j], long.min())
                    most[node][j] = max(most[node][j], long.max())
        for node, points in enumerate(tree.points):
            child, point = np.meshgrid(np.flatnonzero(least[node] <= most[node]), np.arange(len(points)))
            child, point = child.ravel(), point.ravel()
            columns = [np.full(len(child), node), child, point, low[node][point, child],
                       high[node][point, child], least[node][child], most[node][child]]
            types = [pa.int32()] * 3 + [pa.float64()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                ["node", "child", "point", "low", "high", "least", "most"])
    return run


def grown_tree(spark: SparkSession, rows: DataFrame, total: int) -> tuple[Tree, DataFrame]:
    """The tree, and ``rows`` with the leaf of each. Split points come from a sample of at most
    ``SAMPLE`` rows by a hash; the ranges, of which there are as many as pairs of siblings,
    cover all rows."""
    place = F.xxhash64("vec_id")

    def first(some: DataFrame) -> list:
        return some.orderBy(place, "vec_id").limit(SAMPLE).select("v").collect()

    # Each task sends its first rows to the driver: with half as many again as needed in all, few.
    # Many rows of one id may lie beyond them.
    near = round(1.5 * SAMPLE * 2**64 / max(1, total)) - 2**63
    drawn = first(rows.filter(place < near)) if near < 2**63 else []
    if len(drawn) < SAMPLE:
        drawn = first(rows)
    sample = np.array([r["v"] for r in drawn], float)
    tree = Tree(sample, total)
    placed = materialize(rows.mapInArrow(
        _placed(tree), "vec_id long, label string, v array<double>, leaf int"), "placed-vectors")
    ranges = placed.select("v").mapInArrow(_range_rows(tree), RANGES).groupBy("node", "child", "point").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.min("least").alias("least"),
        F.max("most").alias("most"))
    for r in ranges.collect():
        at = (r["point"], r["child"])
        tree.low[r["node"]][at], tree.high[r["node"]][at] = r["low"], r["high"]
        tree.least[r["node"]][r["child"]], tree.most[r["node"]][r["child"]] = r["least"], r["most"]
    return tree, placed


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers: in floats where no sum can pass their precision."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    kind = np.float32 if most < EXACT_SINGLE else np.float64 if most < EXACT else np.int64
    return a.astype(kind) @ b.astype(kind).T


HITS = "anchor_id long, tag long, anchor_key long, vec_id long, score long"


def _found(anchors: list[tuple], ids: np.ndarray, labels: np.ndarray, v: np.ndarray, k: int,
           stretches: list[tuple] | None = None) -> list[tuple]:
    """Up to k first rows for each probe: by score, then by id.

    Probes come by anchor (anchor, key, label, v, same, [(tag, lowest, highest)]), whose products
    are made once for all of its windows. ``stretches`` (first row, end, numbers of the anchors
    that ask for it) are searched; by default all rows, for all anchors. The score of the k-th row
    found so far raises the lowest one of its probe.
    """
    count = np.array([len(a[5]) for a in anchors])
    start = np.cumsum(count) - count
    of = np.repeat(np.arange(len(anchors)), count)
    windows = [w for a in anchors for w in a[5]]
    lowest, highest = (np.array([w[i] for w in windows], float) for i in (1, 2))
    own = np.array([a[0] for a in anchors], np.int64)
    wanted = np.array([a[2] for a in anchors], object)
    same = np.array([a[4] for a in anchors], bool)
    rows = np.stack([a[3] for a in anchors])
    last = np.full(len(windows), np.iinfo(np.int64).max)
    # Of the rows found: their probes, scores and ids.
    best = [np.empty(0, np.int64)] * 3

    def looked_through(hit: np.ndarray, row: np.ndarray, score: np.ndarray) -> None:
        nonlocal best
        fits = ((labels[row] == wanted[hit]) == same[hit]) & (ids[row] != own[hit])
        hit, row, score = hit[fits], ids[row[fits]], score[fits].astype(np.int64)
        more = []
        for nth in range(int(count[hit].max(initial=0))):
            probe = start[hit] + nth
            fits = nth < count[hit]
            probe = np.where(fits, probe, 0)
            fits &= (score <= highest[probe]) & ((score > lowest[probe]) | (
                (score == lowest[probe]) & (row <= last[probe])))
            more.append((probe[fits], score[fits], row[fits]))
        if not any(len(m[0]) for m in more):
            return
        # Only probes that found something are put in order again.
        touched = np.zeros(len(windows), bool)
        for m in more:
            touched[m[0]] = True
        again = touched[best[0]]
        probe, score, row = (np.concatenate(x) for x in zip([b[again] for b in best], *more))
        order = np.lexsort((row, -score, probe))
        probe, score, row = probe[order], score[order], row[order]
        place = np.arange(len(probe)) - np.searchsorted(probe, probe, "left")
        best = [np.concatenate((b[~again], x[place < k])) for b, x in zip(best, (probe, score, row))]
        end = place == k - 1
        lowest[probe[end]], last[probe[end]] = score[end], row[end]

    for first, end, asking in stretches or [(0, len(ids), np.arange(len(anchors)))]:
        step = TILE
        while first < end:
            score = _products(rows[asking], v[first:min(first + step, end)])
            least = np.minimum.reduceat(lowest, start)[asking]
            if score.dtype == np.float32:
                least = np.clip(np.ceil(least), -EXACT_SINGLE, EXACT_SINGLE).astype(np.float32)
            fits = score >= least[:, None]
            while score.shape[1] > LEAST_TILE and np.count_nonzero(fits) > HITS_AT_ONCE:
                score, fits = (x[:, : -(-x.shape[1] // 4)] for x in (score, fits))
            hit, row = np.divmod(np.flatnonzero(fits), fits.shape[1])
            looked_through(asking[hit], first + row, score[hit, row])
            first += score.shape[1]
            step = min(TILE, 4 * score.shape[1])
    order = np.lexsort((best[2], -best[1], best[0]))
    return [(anchors[of[p]][0], windows[p][0], anchors[of[p]][1], i, s)
            for p, s, i in zip(*(x[order].tolist() for x in best))]


def _packed_rows(table: pa.Table) -> pa.Table:
    v = np.ascontiguousarray(_matrix(table["v"].combine_chunks()))
    small, vectors = _packed(v)
    return pa.table({
        "block": table["block"][:1], "leaf": table["leaf"][:1],
        "ids": pa.array([table["vec_id"].to_numpy().tobytes()], pa.binary()),
        "labels": pa.array([table["label"].to_pylist()], pa.list_(pa.string())),
        "width": pa.array([v.shape[1]], pa.int32()), "small": pa.array([small]),
        "vectors": pa.array([vectors], pa.binary()),
    })


def _packed(v: np.ndarray) -> tuple[bool, bytes]:
    small = bool(np.abs(v).max(initial=0) < 1 << 15)
    return small, v.astype(np.int16 if small else np.float64).tobytes()


def _unpacked(row: dict, n: int) -> np.ndarray:
    kind = np.int16 if row["small"] else np.float64
    return np.frombuffer(row["vectors"], kind).reshape(n, row["width"])


class Layout:
    """Where the rows of a leaf lie: its blocks are numbered in a row, and parts hold runs of blocks."""

    def __init__(self, sizes: dict[int, int], leaves: int) -> None:
        self.blocks = np.array([-(-sizes.get(i, 0) // LEAF_ROWS) for i in range(max(1, leaves))])
        self.first = np.cumsum(self.blocks) - self.blocks
        parts = min(PARTS, -(-sum(sizes.values()) // PART_ROWS))
        self.per = max(1, -(-int(self.blocks.sum()) // max(1, parts)))

    def block_of(self, leaf: Column, *key: str) -> Column:
        first, blocks = (F.array(*[F.lit(int(n)) for n in x]) for x in (self.first, self.blocks))
        return (first[leaf] + F.pmod(F.xxhash64(*key), blocks[leaf])).cast("int")

    def parts_of(self, leaf: int) -> range:
        first, n = int(self.first[leaf]), int(self.blocks[leaf])
        return range(first // self.per, (first + n - 1) // self.per + 1) if n else range(0)


ASKED = ("part int, slice int, ids binary, keys binary, labels array<string>, width int, small boolean, "
         "vectors binary, counts binary, tags binary, lowest binary, highest binary, leaves array<int>, "
         "asking binary")


def _asked(tree: Tree, layout: Layout, own_leaf: bool):
    """Of anchors, a row for each part that any asks for: the anchors, and which asks for which leaf.

    They ask for their own leaf, or else for the other leaves that are open to any of their windows.
    """
    most = PROBES

    def rows_of(batch):
        at = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
        v, leaf = _matrix(at["v"]), at["leaf"].to_numpy()
        ids, keys = at["anchor_id"].to_numpy(), at["anchor_key"].to_numpy()
        count = at["windows"].value_lengths().to_numpy()
        of, flat = np.repeat(np.arange(len(v)), count), at["windows"].flatten()
        tags = flat.field("tag").to_numpy()
        bound = [flat.field(c).to_numpy(zero_copy_only=False).astype(float) for c in ("lowest", "highest")]
        lowest, highest = (np.where(np.isnan(x), y, x) for x, y in zip(bound, (-np.inf, np.inf)))
        if own_leaf:
            asking = ((x, np.flatnonzero(leaf == x)) for x in np.unique(leaf))
        else:
            open_ = ((x, np.unique(of[some])) for x, some in tree.opened(v, of, lowest, highest))
            asking = ((x, some[leaf[some] != x]) for x, some in open_)
        asked: dict[int, list] = {}
        for x, some in asking:
            for part in layout.parts_of(x) if len(some) else ():
                asked.setdefault(part, []).append((int(x), some))
        for part, found in asked.items():
            mine = np.unique(np.concatenate([some for _, some in found]))
            who = np.zeros((len(found), len(mine)), bool)
            for i, (_, some) in enumerate(found):
                who[i, np.searchsorted(mine, some)] = True
            theirs = np.isin(of, mine)
            small, vectors = _packed(v[mine])
            yield {
                "part": part, "slice": at["slice"][0].as_py(), "ids": ids[mine].tobytes(),
                "keys": keys[mine].tobytes(), "labels": at["label"].take(pa.array(mine)).to_pylist(),
                "width": v.shape[1], "small": small, "vectors": vectors,
                "counts": count[mine].astype(np.int64).tobytes(), "tags": tags[theirs].tobytes(),
                "lowest": lowest[theirs].tobytes(), "highest": highest[theirs].tobytes(),
                "leaves": [x for x, _ in found], "asking": who.tobytes(),
            }

    names = [c.split()[0] for c in ASKED.split(", ")]
    kinds = {"int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_(),
             "array<string>": pa.list_(pa.string()), "array<int>": pa.list_(pa.int32())}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in ASKED.split(", ")])

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, most):
                for row in rows_of(batch.slice(at, most)):
                    yield pa.RecordBatch.from_pylist([{c: row[c] for c in names}], schema)
    return run


def _searched(k: int, same: bool):
    """Hits of the anchors that ask for leaves of a part, in its blocks."""

    def run(asked: pa.Table, blocks: pa.Table) -> pa.Table:
        out = []
        rows = sorted(blocks.to_pylist(), key=lambda b: b["block"]) if len(asked) else []
        if rows:
            ids = [np.frombuffer(b["ids"], np.int64) for b in rows]
            v = np.concatenate([_unpacked(b, len(i)) for b, i in zip(rows, ids)])
            labels = np.array([x for b in rows for x in b["labels"]], object)
            ends = np.cumsum([len(i) for i in ids])
            leaf = np.array([b["leaf"] for b in rows])
            ids = np.concatenate(ids)
        for n in range(len(asked) if rows else 0):
            a = asked.slice(n, 1).to_pylist()[0]
            count = np.frombuffer(a["counts"], np.int64)
            windows = list(zip(*(np.frombuffer(a[c], kind).tolist() for c, kind in (
                ("tags", np.int64), ("lowest", float), ("highest", float)))))
            firsts = np.cumsum(count) - count
            anchors = [(i, key, label, x, same, windows[f:f + m]) for i, key, label, x, f, m in zip(
                np.frombuffer(a["ids"], np.int64).tolist(), np.frombuffer(a["keys"], np.int64).tolist(),
                a["labels"], _unpacked(a, len(count)), firsts, count)]
            who = np.frombuffer(a["asking"], bool).reshape(len(a["leaves"]), len(count))
            stretches = []
            for x, asking in zip(a["leaves"], who):
                here = np.flatnonzero(leaf == x)
                if len(here):
                    stretches.append((int(ends[here[0] - 1]) if here[0] else 0, int(ends[here[-1]]),
                                      np.flatnonzero(asking)))
            if stretches:
                found = _found(anchors, ids, labels, v, k, stretches)
                out.append(np.array(found, np.int64).reshape(-1, 5))
        columns = np.concatenate(out or [np.empty((0, 5), np.int64)]).T
        return pa.table([pa.array(c, pa.int64()) for c in columns],
                        names=["anchor_id", "tag", "anchor_key", "vec_id", "score"])
    return run


PROBE = ["anchor_id", "tag", "anchor_key"]


def _best(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy(*PROBE).orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def first_in_window(anchors: DataFrame, tree: Tree, blocks: DataFrame, layout: Layout, k: int,
                    same: bool) -> DataFrame:
    """(anchor_id, tag, anchor_key, rank, vec_id, score): the k first rows each probe allows.

    An anchor (anchor_id, anchor_key, label, v, leaf, windows) has a probe for each of its
    windows (tag, lowest, highest): for rows of its label if ``same``, or else of others, with
    a score from lowest to highest (NULL: no bound). Its own leaf comes first: k rows found
    there raise ``lowest`` before the siblings are judged.
    """
    # Anchors of neighbouring leaves come together, so that they ask for few parts.
    total = anchors.count()
    width = len((anchors.select("v").first() or [[]])[0])
    slices = max(1, -(-total * (2 * width + 24 * k + 64) // SLICE_BYTES))
    columns = ["anchor_id", "anchor_key", "label", "v", "leaf", "windows"]
    anchors = materialize(anchors.select(*columns).repartitionByRange(
        max(1, -(-total // PROBES)), "leaf", F.xxhash64("anchor_id", "anchor_key")), "anchors")
    blocks = blocks.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    key = ["part", "slice"]

    def search(asking: DataFrame, own_leaf: bool) -> DataFrame:
        # All blocks of a part meet each of its slices, so an anchor may be in any.
        asked = asking.withColumn("slice", F.spark_partition_id() % slices).mapInArrow(
            _asked(tree, layout, own_leaf), ASKED)
        return asked.groupBy(*key).cogroup(blocks.groupBy(*key)).applyInArrow(_searched(k, same), HITS)

    own = materialize(_best(search(anchors, True), k).drop("rank"), "own-leaves")
    floor = F.when(F.count("*") >= k, F.min("score")).cast("double").alias("floor")
    floors = own.groupBy(*PROBE).agg(floor).groupBy("anchor_id", "anchor_key").agg(
        F.map_from_entries(F.collect_list(F.struct("tag", "floor"))).alias("floors"))
    raised = anchors.join(floors, ["anchor_id", "anchor_key"], "left").withColumn("windows", F.transform(
        "windows", lambda w: F.struct(w["tag"].alias("tag"), F.greatest(
            w["lowest"], F.col("floors")[w["tag"]]).alias("lowest"), w["highest"].alias("highest"))))
    raised = raised.select(*columns).repartitionByRange(
        max(1, -(-total // PROBES)), "leaf", F.xxhash64("anchor_id", "anchor_key"))
    return _best(own.unionByName(search(raised, False)), k)


def hard_negatives(vectors: DataFrame, is_anchor: Column, k: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors`` has vec_id, label, embedding, read as in ``labelled_vectors``; scores are inner
    products. The positives of a row that ``is_anchor`` are its k first rows of the same label.
    For each of them the k first rows of other labels count whose score lies from ``low`` to
    ``high`` hundredths of the positive's. Higher scores come first, ties by smaller vec_id.

    All rows lie in the leaves of one tree (see ``Tree``), in blocks of about ``LEAF_ROWS``. A
    search visits its own leaf and then those whose distance ranges meet its window. Vectors stay
    with their blocks, runs of which form a part; anchors, packed, are sent to the parts that hold
    a leaf they ask for, and each to a part once. What the driver holds is the tree, which the
    sample bounds.

    Rows with the anchor's id are neither its positives nor negatives. Repeated rows are found
    each; of equal anchors one counts. A positive without negatives gives no row, nor does one
    with a score below zero, whose window is empty. Scores are exact below 2 ** 53, and as far
    as they fit 64 bits beyond it. Empty table: no rows.
    """
    spark = vectors.sparkSession
    rows = materialize(labelled_vectors(vectors), "labelled-vectors")
    total = rows.count()
    tree, placed = grown_tree(spark, rows, total)
    layout = Layout({r["leaf"]: r["count"] for r in placed.groupBy("leaf").count().collect()}, tree.leaves)
    block = layout.block_of(F.col("leaf"), "vec_id", "v")
    blocks = materialize(
        placed.select("vec_id", "label", "v", "leaf", block.alias("block")).groupBy("block").applyInArrow(
            _packed_rows, "block int, leaf int, ids binary, labels array<string>, width int, small boolean, "
            "vectors binary").withColumn("part", F.expr(f"int(block div {layout.per})")), "vector-blocks")
    anchors = materialize(placed.filter(is_anchor).dropDuplicates(["vec_id", "label", "v"]).select(
        F.col("vec_id").alias("anchor_id"), F.xxhash64("label", "v").alias("anchor_key"), "label", "v", "leaf"),
        "all-anchors")

    none = F.lit(None).cast("double")
    window = F.struct(F.lit(0).cast("long").alias("tag"), none.alias("lowest"), none.alias("highest"))
    positives = materialize(first_in_window(
        anchors.withColumn("windows", F.array(window)), tree, blocks, layout, k, True), "positives").select(
        "anchor_id", "anchor_key", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    score = F.col("positive_score").cast("decimal(20,0)")
    windows = positives.distinct().select("anchor_id", "anchor_key", F.struct(
        # The window of whole scores; a positive is told by its id and score.
        F.xxhash64("positive_id", "positive_score").alias("tag"),
        F.ceil(score * low / 100).cast("double").alias("lowest"),
        F.floor(score * high / 100).cast("double").alias("highest"),
    ).alias("window")).filter("window.lowest <= window.highest").groupBy("anchor_id", "anchor_key").agg(
        F.collect_list("window").alias("windows"))
    found = first_in_window(anchors.join(windows, ["anchor_id", "anchor_key"]), tree, blocks, layout, k, False)
    told = positives.withColumn("tag", F.xxhash64("positive_id", "positive_score"))
    return told.join(found, PROBE).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
