"""Exact top-k search by inner product with a table of distances to pivots."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starload.session import materialize

PIVOTS = 32
# Vectors a task compares at once: candidates of a block, and queries of a group.
BLOCK_ROWS = 2048
QUERY_ROWS = 1024
# Candidates scored between two looks at the stopping rule.
STEP = 64


def whole_vectors(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, v): each component as floor(scale * x), shorter vectors filled up with zeros.

    NULL vectors, and vectors holding a NULL or a component that is not finite, are left out,
    and so are rows without an id. Scores are exact while they stay below 2 ** 53.
    """
    x = F.col("embedding").cast("array<double>")
    odd = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    rows = vectors.filter(F.col("vec_id").isNotNull() & x.isNotNull() & ~odd).select(
        "vec_id", F.transform(x, lambda e: F.floor(e * scale).cast("double")).alias("v")
    )
    width = rows.agg(F.max(F.size("v"))).first()[0] or 0
    fill = F.array_repeat(F.lit(0.0), F.lit(width) - F.size("v"))
    return rows.select("vec_id", F.concat("v", fill).alias("v"))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    values = flat.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(flat), -1) if len(flat) else values.reshape(0, 0)


def pivot_table(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``vectors`` with ``near``, the distances to all pivots, and ``cell``, the nearest one."""

    def measured(batches):
        for batch in batches:
            v = _matrix(pa.chunked_array([batch.column(1)]))
            gap = (v**2).sum(1)[:, None] - 2 * v @ pivots.T + (pivots**2).sum(1)
            near = np.sqrt(np.maximum(gap, 0))
            rows = pa.ListArray.from_arrays(
                pa.array(np.arange(len(near) + 1) * near.shape[1], pa.int32()), pa.array(near.ravel())
            )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, rows, pa.array(near.argmin(1).astype(np.int32))],
                ["vec_id", "v", "near", "cell"],
            )

    return vectors.mapInArrow(measured, "vec_id long, v array<double>, near array<double>, cell int")


def _bounds(q_size, c_size, gap):
    """Highest possible inner product of vectors at least ``gap`` apart, rounding included."""
    most = (q_size + c_size - gap**2) / 2
    return most + 1e-6 * (1 + np.abs(most)) + 1e-9 * (q_size + c_size)


def search_block(queries: pa.Table, rows: pa.Table, k: int) -> pa.Table:
    """Up to k best rows of one block for each query, at least as good as its ``floor``.

    Rows are scored in the order of their bounds; the search of a query ends where no bound
    left reaches its k-th best score.
    """
    ids = rows["vec_id"].to_numpy()
    v, near = _matrix(rows["v"]), _matrix(rows["near"])
    sizes = (v**2).sum(1)
    out: list[tuple] = []
    keys = [queries[c].to_pylist() for c in ("query_id", "query_key", "floor")]
    q_v, q_near = _matrix(queries["v"]), _matrix(queries["near"])
    for i, (key, tag, floor) in enumerate(zip(*keys)):
        q = q_v[i]
        most = _bounds(q @ q, sizes, np.abs(near - q_near[i]).max(axis=1, initial=0))
        most[ids == key] = -np.inf
        order = np.argsort(-most, kind="stable")
        order = order[: np.searchsorted(-most[order], np.inf)]
        best_score, best_id = np.empty(0), np.empty(0, ids.dtype)
        least = -np.inf if floor is None else floor
        for at in range(0, len(order), STEP):
            if most[order[at]] < least:
                break
            some = order[at: at + STEP]
            score = np.concatenate([best_score, v[some] @ q])
            who = np.concatenate([best_id, ids[some]])
            top = np.lexsort((who, -score))[:k]
            best_score, best_id = score[top], who[top]
            if len(top) == k:
                least = max(least, best_score[-1])
        out.extend((key, tag, int(a), int(s)) for a, s in zip(best_id, best_score))
    columns = list(zip(*out)) or [[], [], [], []]
    return pa.table({n: pa.array(c, pa.int64()) for n, c in
                     zip(("query_id", "query_key", "vec_id", "score"), columns)})


def _search(queries: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """``queries`` name a block and query_group each, as ``blocks`` do."""
    key = ["block", "query_group"]
    return queries.groupBy(*key).cogroup(blocks.groupBy(*key)).applyInArrow(
        lambda q, c: search_block(q, c, k), "query_id long, query_key long, vec_id long, score long"
    )


def _best(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, pivots: int = PIVOTS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for each row that ``is_query``.

    Every row but those with the query's id is a candidate; ties go to the smaller id. The
    distances of all rows to ``pivots`` rows chosen by a hash are stored once. Rows lie in
    blocks of about ``BLOCK_ROWS`` by their nearest pivot, a large cell in several. A query
    first searches its own cell, which gives a score to beat, and then the cells whose
    distances to the pivots allow to beat or equal it. Queries meet blocks in groups of about
    ``QUERY_ROWS``. What the driver sees is one row per pivot.

    Vectors of ``vectors`` (vec_id, embedding) as in ``whole_vectors``. Repeated rows are
    candidates each; equal queries with one id are one query. Empty table: no rows.
    """
    spark = vectors.sparkSession
    rows = materialize(whole_vectors(vectors), "whole-vectors")
    chosen = np.array([r["v"] for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots)
                       .collect()], float)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not len(chosen):
        return empty
    chosen = np.unique(chosen, axis=0)
    n = len(chosen)
    table = materialize(pivot_table(rows, chosen), "pivot-table")
    size = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    cells = table.groupBy("cell").agg(
        F.count("*").alias("rows"), F.max(size).alias("size"),
        *[F.min(F.get("near", F.lit(i))).alias(f"low_{i}") for i in range(n)],
        *[F.max(F.get("near", F.lit(i))).alias(f"high_{i}") for i in range(n)],
    ).collect()
    cell_ids = [c["cell"] for c in cells]
    n_blocks = [-(-c["rows"] // BLOCK_ROWS) for c in cells]
    low = np.array([[c[f"low_{i}"] for i in range(n)] for c in cells])
    high = np.array([[c[f"high_{i}"] for i in range(n)] for c in cells])
    most_size = np.array([c["size"] for c in cells])

    queries = table.filter(is_query).dropDuplicates(["vec_id", "v"])
    groups = max(1, -(-queries.count() // QUERY_ROWS))
    block_counts = F.create_map(*[F.lit(x) for pair in zip(cell_ids, n_blocks) for x in pair])
    blocks = table.select(
        "vec_id", "v", "near",
        F.concat_ws("-", "cell", F.pmod(F.xxhash64("vec_id"), block_counts[F.col("cell")])).alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("query_group"),
    )
    queries = queries.select(
        F.col("vec_id").alias("query_id"), F.xxhash64("v").alias("query_key"), "v", "near", "cell",
        F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int").alias("query_group"),
    )

    def sent_to(df: DataFrame, cells_of: Column) -> DataFrame:
        each = F.flatten(F.transform(cells_of, lambda c: F.transform(
            F.sequence(F.lit(0), block_counts[c] - 1), lambda b: F.concat_ws("-", c, b))))
        return df.withColumn("block", F.explode(each))

    first = sent_to(queries.withColumn("floor", F.lit(None).cast("double")), F.array("cell"))
    own = materialize(_best(_search(first, blocks, k), k).drop("rank"), "own-cells")
    floors = own.groupBy("query_id", "query_key").agg(
        F.when(F.count("*") >= k, F.min("score")).cast("double").alias("floor"))

    def allowed(batches):
        for batch in batches:
            at = {c: i for i, c in enumerate(batch.schema.names)}
            v, near = (_matrix(pa.chunked_array([batch.column(at[c])])) for c in ("v", "near"))
            floor = batch.column(at["floor"]).to_numpy(zero_copy_only=False)
            floor = np.where(np.isnan(floor.astype(float)), -np.inf, floor.astype(float))
            # Distance from the query to the range of a cell, the largest over the pivots.
            gap = np.maximum(low[None] - near[:, None], near[:, None] - high[None]).max(axis=2)
            most = _bounds((v**2).sum(1)[:, None], most_size[None], np.maximum(gap, 0))
            own_cell = batch.column(at["cell"]).to_pylist()
            names = [[c for c, m in zip(cell_ids, row) if m >= f and c != o]
                     for row, f, o in zip(most, floor, own_cell)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.list_(pa.int32()))], [*batch.schema.names, "cells"])

    with_floor = queries.join(floors, ["query_id", "query_key"], "left")
    schema = ", ".join(f"{c} {t}" for c, t in with_floor.dtypes) + ", cells array<int>"
    second = sent_to(with_floor.mapInArrow(allowed, schema), F.col("cells")).drop("cells")
    found = own.unionByName(_search(second, blocks, k))
    return _best(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
