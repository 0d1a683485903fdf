import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from starload.llm import topk
from starload.llm.topk import top_k

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, is_query, k):
    whole = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, qv in whole:
        if is_query(q):
            scored = sorted((-sum(a * b for a, b in zip(qv, cv)), c) for c, cv in whole if c != q)
            out |= {(q, r + 1, c, -s) for r, (s, c) in enumerate(scored[:k])}
    return out


def awkward():
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(6, 8))
    rows = [(i, (centers[i % 6] + rng.normal(size=8) * (0.1 if i % 2 else 1)).round(1).tolist())
            for i in range(300)]
    return rows + [(1000, None), (1005, [1.0, None] + [0.0] * 6), (1010, [float("nan")] * 8),
                   (1015, [float("inf")] + [0.0] * 7), (1020, []), (1025, [0.5, -0.5]), (None, [1.0] * 8),
                   (1030, [0.0] * 8), (1031, rows[5][1]), (1032, rows[5][1]), (-15, rows[7][1])]


@pytest.mark.parametrize("block, group, pivots", [(2048, 1024, 32), (20, 7, 4), (50, 1024, 1)])
def test_equals_all_products(spark, monkeypatch, block, group, pivots):
    monkeypatch.setattr(topk, "BLOCK_ROWS", block)
    monkeypatch.setattr(topk, "QUERY_ROWS", group)
    df = spark.createDataFrame([(i, v, 0) for i, v in awkward()], SCHEMA).repartition(3)
    got = {tuple(r) for r in top_k(df, F.col("vec_id") % 5 == 0, 5, pivots).collect()}
    assert got == plain(awkward(), lambda i: i % 5 == 0, 5)


def test_few_rows(spark):
    def run(rows):
        return top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0).collect()

    assert run([]) == []
    assert run([(0, [1.0], 0)]) == []
    assert len(run([(0, [1.0], 0), (1, [2.0], 0), (1, [2.0], 0)])) == 2
