import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.pandas.group_ops import PandasCogroupedOps

from starload.llm import hard_negatives as module
from starload.llm.hard_negatives import Tree, hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, k=5, low=80, high=100, every=10):
    whole = []
    for key, v, label in rows:
        if None not in (key, v, label) and all(x is not None and np.isfinite(x) for x in v):
            whole.append((key, label, [int(np.floor(256 * x)) for x in v]))
    width = max((len(v) for *_, v in whole), default=0)
    whole = [(key, label, v + [0] * (width - len(v))) for key, label, v in whole]
    out = []
    anchors = {(key, label, tuple(v)) for key, label, v in whole if key % every == 0}
    for key, label, v in anchors:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i, other == label)
                        for i, other, w in whole if i != key)
        for p, i, _ in [s for s in scored if s[2]][:k]:
            fits = [s for s in scored if not s[2] and low * -p <= 100 * -s[0] <= high * -p][:k]
            out.extend((key, i, n, j, -p, -s) for n, (s, j, _) in enumerate(fits, 1))
    return sorted(out)


def clustered(n, seed=1, width=6):
    dice = np.random.default_rng(seed)
    centres = dice.normal(size=(12, width))
    of = dice.integers(0, 12, n)
    vectors = centres[of] + 0.3 * dice.normal(size=(n, width))
    return [(i, [float(x) for x in v], int(c % 4)) for i, (v, c) in enumerate(zip(vectors, of))]


AWKWARD = [
    (None, [1.0] * 6, 1), (2000, None, 1), (2010, [1.0, None], 2), (2020, [float("nan")] * 6, 1),
    (2030, [float("inf")] * 6, 1), (2040, [1.0] * 6, None), (2050, [], 1), (2060, [0.5], 2),
    (2070, [0.0] * 6, 3), (2080, [-1.0] * 6, 0), (10, [0.25] * 6, 1), (10, [0.25] * 6, 1),
    (2090, [1.0] * 6, 1), (2091, [1.0] * 6, 1), (2092, [1.0] * 6, 2), (2093, [1.0] * 6, 2),
]


@pytest.mark.parametrize("leaf_rows", [2048, 40])
def test_equals_a_scan_of_all_rows(spark, monkeypatch, leaf_rows):
    monkeypatch.setattr(module, "LEAF_ROWS", leaf_rows)
    monkeypatch.setattr(module, "PROBES", 30)
    rows = clustered(700) + AWKWARD
    got = hard_negatives(spark.createDataFrame(rows, SCHEMA).withColumns(
        {"v": F.lit(1), "leaf": F.lit("x"), "score": F.lit(2)}).repartition(3), F.col("vec_id") % 10 == 0)
    assert sorted(map(tuple, got.collect())) == plain(rows)


def test_other_windows_and_few_rows(spark):
    rows = clustered(90, 5) + [(500, [0.1] * 6, 77)]
    got = hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0, 3, -50, 130)
    assert sorted(map(tuple, got.collect())) == plain(rows, 3, -50, 130)
    empty = hard_negatives(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 10 == 0)
    assert empty.collect() == [] and empty.columns[:2] == ["anchor_id", "positive_id"]


def test_open_leaves_hold_every_row_of_the_window():
    """No leaf that holds a product of the window is passed by, and most others are."""
    vectors = np.floor(256 * np.array([v for _, v, _ in clustered(3000, 2)]))
    tree = Tree(vectors[::5], 40_000)
    leaf = tree.leaf_of(vectors)
    for node, some, gap, child in tree.descend(vectors):
        for j in np.unique(child):
            mine, long = gap[child == j], (vectors[some[child == j]] ** 2).sum(axis=1)
            tree.low[node][:, j], tree.high[node][:, j] = mine.min(axis=0), mine.max(axis=0)
            tree.least[node][j], tree.most[node][j] = long.min(), long.max()
    queries = vectors[:200]
    scores = queries @ vectors.T
    top = np.sort(scores, axis=1)[:, -30]
    opened = tree.open_leaves(queries, 0.9 * top, top)
    for row, low, high, got in zip(scores, 0.9 * top, top, opened):
        assert set(leaf[(row >= low) & (row <= high)]) <= set(got) and len(got) == len(set(got))
    assert tree.leaves > 50 and np.mean([len(x) for x in opened]) < 0.7 * tree.leaves


def test_products_beyond_doubles(spark):
    big = float(1 << 21)
    rows = [(0, [big, 1.0], 1), (1, [big, 1.0], 1), (2, [big / 2 + 0.25, 3.0], 2), (3, [big * 0.9, 5.0], 2)]
    got = hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 0)
    assert sorted(map(tuple, got.collect())) == plain(rows, every=100)


def test_windows_of_an_anchor_share_its_products(monkeypatch):
    made = []
    plain = module._products
    monkeypatch.setattr(module, "_products", lambda a, b: made.append(len(a)) or plain(a, b))
    ids, labels = np.arange(6), np.array(["a", "b", "b", "a", "b", "b"], object)
    v = np.array([[5.0], [4.0], [4.0], [3.0], [2.0], [1.0]])
    windows = [(1, 2.0, 4.0), (2, -np.inf, 3.0), (3, 4.0, np.inf), (4, 3.0, 3.0)]
    found = module._found([(4, 9, "a", np.array([1.0]), False, windows)], ids, labels, v, 2)
    assert made == [1]
    assert found == [(4, 1, 9, 1, 4), (4, 1, 9, 2, 4), (4, 2, 9, 5, 1), (4, 3, 9, 1, 4), (4, 3, 9, 2, 4)]


def test_parts_slices_and_tiles_are_whole(spark, monkeypatch):
    """Many parts, slices and tiles, with vectors that are found often, give the rows of a scan."""
    for name, n in (("LEAF_ROWS", 40), ("PROBES", 20), ("PART_ROWS", 90), ("SLICE_BYTES", 8000),
                    ("TILE", 16), ("LEAST_TILE", 4), ("HITS_AT_ONCE", 50), ("SAMPLE", 200)):
        monkeypatch.setattr(module, name, n)
    rows = clustered(500, 7) + AWKWARD + [(3000 + i, [0.3, -0.2, 0.1, 0.4, 0.2, 0.1], i % 2) for i in range(150)]
    got = hard_negatives(spark.createDataFrame(rows, SCHEMA).repartition(3), F.col("vec_id") % 10 == 0)
    assert sorted(map(tuple, got.collect())) == plain(rows)


def test_an_anchor_is_sent_to_a_part_once(monkeypatch):
    """Of each anchor one copy goes to a part, with all of its windows, for every open leaf there."""
    monkeypatch.setattr(module, "PART_ROWS", 300)
    vectors = np.floor(256 * np.array([v for _, v, _ in clustered(3000, 2)]))
    tree = Tree(vectors[::5], 40_000)
    leaf = tree.leaf_of(vectors)
    for r in (r for b in module._range_rows(tree)([pa.record_batch({"v": vectors.tolist()})]) for r in b.to_pylist()):
        at = (r["point"], r["child"])
        tree.low[r["node"]][at], tree.high[r["node"]][at] = r["low"], r["high"]
        tree.least[r["node"]][r["child"]], tree.most[r["node"]][r["child"]] = r["least"], r["most"]
    layout = module.Layout({int(x): int((leaf == x).sum()) for x in np.unique(leaf)}, tree.leaves)
    anchors = vectors[:200]
    top = np.sort(anchors @ vectors.T, axis=1)[:, -30]
    windows = [[{"tag": 1, "lowest": 0.9 * t, "highest": t}, {"tag": 2, "lowest": t, "highest": None}] for t in top]
    batch = pa.record_batch({
        "anchor_id": pa.array(range(200)), "anchor_key": pa.array(range(200)), "label": ["a"] * 200,
        "v": anchors.tolist(), "leaf": pa.array(leaf[:200], pa.int32()), "slice": [0] * 200,
        "windows": pa.array(windows, pa.list_(pa.struct({"tag": pa.int64(), "lowest": pa.float64(),
                                                         "highest": pa.float64()})))})
    asked = [r for b in module._asked(tree, layout, False)([batch]) for r in b.to_pylist()]
    assert len({r["part"] for r in asked}) == len(asked) > 5
    sent = set()
    for r in asked:
        ids = np.frombuffer(r["ids"], np.int64)
        assert len(set(ids)) == len(ids) and len(r["tags"]) == 16 * len(ids)
        who = np.frombuffer(r["asking"], bool).reshape(len(r["leaves"]), len(ids))
        sent |= {(int(i), x) for x, some in zip(r["leaves"], who) for i in ids[some]}
    opened = tree.open_leaves(np.repeat(anchors, 2, axis=0), np.ravel(np.stack([0.9 * top, top], 1)),
                              np.ravel(np.stack([top, np.full(200, np.inf)], 1)))
    assert sent == {(i, x) for i in range(200) for x in opened[2 * i] + opened[2 * i + 1]
                    if x != leaf[i] and layout.blocks[x]}


def test_what_is_searched_does_not_grow_with_anchors_times_blocks(spark, monkeypatch):
    """Tasks that search are handed the vectors once, not again for each group of anchors."""
    monkeypatch.setattr(module, "LEAF_ROWS", 40)
    monkeypatch.setattr(module, "PROBES", 20)
    handed = []

    def size(df):
        return df.agg(F.sum(F.length(F.to_json(F.struct(*df.columns))))).first()[0] or 0

    def whole(self, f, schema):
        handed.append(size(self))
        return mapped(self, f, schema)

    def pairs(self, f, schema):
        handed.append(size(self._gd1._df) + size(self._gd2._df))
        return grouped(self, f, schema)

    rows = spark.createDataFrame(clustered(900, 4), SCHEMA)
    mapped, grouped = type(rows).mapInArrow, PandasCogroupedOps.applyInArrow
    monkeypatch.setattr(type(rows), "mapInArrow", whole)
    monkeypatch.setattr(PandasCogroupedOps, "applyInArrow", pairs)
    hard_negatives(rows, F.col("vec_id") % 10 == 0).count()
    assert max(handed) < 3 * size(rows)
