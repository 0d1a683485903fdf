"""Mixing sources to target weights: blocks with release times and deadlines, earliest first."""

from __future__ import annotations

import math
from collections.abc import Mapping
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starload.llm.common import BROADCAST_ROWS, bounded, ranked, ranked_along
from starload.session import materialize

# Weights are whole numbers: the given ones are exact if they fit in this, roots are rounded.
WEIGHT_BOUND = 1 << 48
ROOT_UNIT = 1 << 20
# One row makes so many blocks of a source.
CHUNK_BLOCKS = 10_000
# Blocks that are scheduled in one task, a power of 2.
AREA = 4096


def whole_weights(weights: Mapping[str, float]) -> tuple[dict[str, int], int]:
    """The weights as whole numbers, and the unit they were multiplied by.

    Weights are taken as the decimals they are written as. They keep their exact proportions
    unless these need more than ``WEIGHT_BOUND``; then they are rounded to it.
    """
    if any(not math.isfinite(w) or w < 0 for w in weights.values()):
        raise ValueError("weights must be finite and not negative")
    exact = {s: Fraction(str(w)) for s, w in weights.items()}
    top = max(exact.values(), default=0)
    if not top:
        return dict.fromkeys(exact, 0), Fraction(ROOT_UNIT)
    unit = Fraction(math.lcm(*[w.denominator for w in exact.values()]))
    # As large as fits, so that roots beside the given weights are fine too.
    unit = unit * (WEIGHT_BOUND // int(top * unit)) if top * unit <= WEIGHT_BOUND else WEIGHT_BOUND / top
    return {s: max(round(w * unit), 1) if w else 0 for s, w in exact.items()}, unit


def source_table(sizes: DataFrame, weights: Mapping[str, float], block_rows: int) -> DataFrame:
    """(mix_source, mix_tier, blocks, w, k, at, behind, rest) of ``sizes`` (mix_source, n).

    All sources are served at once, in proportion to their weights, and a source that runs out
    leaves its share to the others. ``k`` numbers the sources in the order they run out, from 1:
    by then ``behind`` blocks belong to sources that are out, the others weigh ``rest``,
    and ``at`` slots are over. Sources of weight 0 follow the others (tier 1).
    """
    spark = sizes.sparkSession
    known, unit = whole_weights(weights)
    # As many rows as the parameter has entries.
    given = spark.createDataFrame(list(known.items()), "mix_source string, given long")
    sizes = sizes.join(F.broadcast(given), "mix_source", "left").withColumn("root", F.sqrt("n"))
    # A sum of decimals does not depend on the order of the rows.
    roots = float(sizes.filter("given > 0").agg(
        F.sum(F.col("root").cast("decimal(30,9)"))).first()[0] or 0)
    scale = sum(known.values()) / roots if roots else float(unit)
    own = F.when(F.col("given") > 0, F.col("given")).when(
        F.col("given") == 0, F.col("root") * ROOT_UNIT).otherwise(F.col("root") * scale)
    sizes = sizes.select(
        "mix_source", F.when(F.col("given") == 0, 1).otherwise(0).alias("mix_tier"),
        F.ceil(F.col("n") / block_rows).cast("decimal(13,0)").alias("blocks"),
        F.greatest(F.round(own), F.lit(1)).cast("decimal(18,0)").alias("w"),
    )
    # One row per source is all that these windows see.
    out = Window.partitionBy("mix_tier").orderBy(F.col("blocks") / F.col("w"), "mix_source")
    so_far = out.rowsBetween(Window.unboundedPreceding, 0)
    first = Window.orderBy("mix_tier").rangeBetween(Window.unboundedPreceding, -1)
    return (
        sizes.withColumn("k", F.row_number().over(out))
        .withColumn("before", F.coalesce(F.sum("blocks").over(first), F.lit(0)).cast("decimal(14,0)"))
        .withColumn("behind", (F.col("before") + F.sum("blocks").over(so_far)).cast("decimal(14,0)"))
        .withColumn("rest", (F.sum("w").over(Window.partitionBy("mix_tier")) - F.sum("w").over(so_far))
                    .cast("decimal(20,0)"))
        .withColumn("at", F.expr("cast(behind as bigint) + (blocks * rest) div w"))
    )


class Stages:
    """What holds between two sources that run out; looked up in two steps, among the first
    stages of groups of stages and then in one group."""

    def __init__(self, sources: DataFrame) -> None:
        n = sources.count()
        width = max(1, math.isqrt(n))
        start = sources.groupBy("mix_tier").agg(
            F.min("before").alias("behind"), F.sum("w").cast("decimal(20,0)").alias("rest")
        ).selectExpr("mix_tier", "0 AS k", "cast(0 as decimal(13,0)) AS blocks",
                     "cast(1 as decimal(18,0)) AS w", "behind", "rest", "cast(behind as bigint) AS at")
        stages = start.unionByName(sources.select(*start.columns)).withColumn(
            "stage_group", F.expr(f"k div {width}"))
        fields = F.struct("k", "blocks", "w", "behind", "rest", "at")
        groups = stages.groupBy("mix_tier", "stage_group").agg(
            F.sort_array(F.collect_list(fields)).alias("stages"))
        self.groups = F.broadcast(groups) if n <= BROADCAST_ROWS else groups
        # One row per tier.
        self.firsts = F.broadcast(groups.groupBy("mix_tier").agg(F.sort_array(
            F.collect_list(F.get("stages", F.lit(0)))).alias("firsts")))

    def last(self, df: DataFrame, reached, name: str) -> DataFrame:
        """``df`` (mix_tier, ...) with the last stage that ``reached`` holds for."""
        return (
            df.join(self.firsts, "mix_tier")
            .withColumn("stage_group", F.size(F.filter("firsts", reached)) - 1)
            .drop("firsts").join(self.groups, ["mix_tier", "stage_group"])
            .withColumn(name, F.element_at("stages", F.size(F.filter("stages", reached))))
            .drop("stages", "stage_group")
        )


def windows(sources: DataFrame, stages: Stages) -> DataFrame:
    """(mix_source, mix_tier, mix_block, mix_release, mix_deadline) of all blocks.

    Block i may run from the slot in which its source has been served i blocks, and must have run
    when it has been served i + 1.
    """
    blocks = (
        sources.select("mix_source", "mix_tier", "w", F.col("blocks").cast("long").alias("blocks"))
        .withColumn("chunk", F.explode(F.expr(f"sequence(0L, blocks - 1, {CHUNK_BLOCKS}L)")))
        .repartition("mix_source", "chunk")
        .withColumn("mix_block", F.explode(F.expr(
            f"sequence(chunk, least(blocks, chunk + {CHUNK_BLOCKS}) - 1)")))
        .drop("blocks", "chunk")
    )
    for name, served in (("first", F.col("mix_block")), ("last", F.col("mix_block") + 1)):
        served = served.cast("decimal(13,0)")
        blocks = stages.last(blocks.withColumn("served", served), lambda s: (
            s["blocks"] * F.col("w") <= F.col("served") * s["w"]), name)
    return blocks.select(
        "mix_source", "mix_tier", "mix_block",
        F.expr("cast(first.behind as bigint) + (cast(mix_block as decimal(13,0)) * first.rest) div w")
        .alias("mix_release"),
        F.expr("cast(last.behind as bigint) + "
               "(cast(mix_block + 1 as decimal(13,0)) * last.rest + w - 1) div w").alias("mix_deadline"),
    )


def _low(least: Column) -> Column:
    return F.least(F.lit(0), F.coalesce(least, F.lit(0)))


def _halved(rows: DataFrame, low: Column) -> DataFrame:
    """Rows at their places in the halves of their node."""
    left = F.when(F.col("slot"), F.col("mark") >= F.col("low")).otherwise(F.col("early"))
    return rows.withColumn("low", low).withColumn("left", left).select(
        *[c for c in rows.columns if c == "area"], "id", "slot",
        F.when(F.col("left"), F.col("at") + F.col("low")).otherwise(-F.col("low")).alias("at"),
        F.when(F.col("left"), F.col("node") * 2).otherwise(F.col("node") * 2 + 1).alias("node"),
    )


def earliest_first(jobs: DataFrame, n: int, area: int = AREA) -> DataFrame:
    """(mix_order, mix_slot) of ``n`` ``jobs`` (mix_order, mix_release): of the released jobs the
    one that is first in order runs next.

    Jobs are halved by their order. The first half runs as if it were alone: with A(u) of its
    jobs released before slot u, low(t) = min(0, A(u) - u for u <= t) and t + low(t) of its
    slots lie before t; the slots it leaves are for the other half. Both halves are then the
    same task, in their own slots, until a job is alone with its slot. Nodes of more than
    ``area`` jobs are added up in parts of their slots.
    """
    spark = jobs.sparkSession
    rows = jobs.select(
        F.col("mix_order").alias("id"), F.lit(False).alias("slot"), F.col("mix_release").alias("at")
    ).unionByName(spark.range(n).select("id", F.lit(True).alias("slot"), F.col("id").alias("at")))
    rows = rows.withColumn("node", F.lit(0).cast("long"))
    size = 1 << max(n - 1, 0).bit_length()
    to_here, before = (Window.unboundedPreceding, 0), (Window.unboundedPreceding, -1)

    def marked(rows: DataFrame, keys: list[str]) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy("at", "slot", "id")
        early = ~F.col("slot") & (F.col("id") % size < size // 2)
        return (
            rows.withColumn("early", early)
            .withColumn("taken", F.sum(F.col("early").cast("long")).over(w.rowsBetween(*to_here)))
            .withColumn("mark", F.when(F.col("slot"), F.col("taken") - F.col("at") - 1))
            .withColumn("least", F.min("mark").over(w.rowsBetween(*before)))
        )

    while size > area:
        rows = materialize(
            marked(rows.withColumn("part", F.expr(f"at div {area}")), ["node", "part"]), "slots")
        w = Window.partitionBy("node").orderBy("part").rowsBetween(*before)
        parts = (
            rows.groupBy("node", "part").agg(
                F.sum(F.col("early").cast("long")).alias("n"), F.min("mark").alias("m"))
            .withColumn("earlier", F.coalesce(F.sum("n").over(w), F.lit(0)))
            .withColumn("part_least", F.min(F.col("earlier") + F.col("m")).over(w))
            .select("node", "part", "earlier", "part_least")
        )
        joined = rows.join(bounded(parts), ["node", "part"]).withColumn(
            "mark", F.col("mark") + F.col("earlier"))
        rows = _halved(joined, _low(F.least("part_least", F.col("least") + F.col("earlier"))))
        size //= 2
    rows = rows.withColumn("area", F.col("node")).repartition("area")
    while size > 1:
        rows = _halved(marked(rows, ["area", "node"]), _low(F.col("least")))
        size //= 2
    return rows.groupBy("area", "node").agg(
        F.max(F.when(~F.col("slot"), F.col("id"))).alias("mix_order"),
        F.max(F.when(F.col("slot"), F.col("id"))).alias("mix_slot"),
    ).select("mix_order", "mix_slot")


def mix(
    docs: DataFrame, weights: Mapping[str, float] | None = None, block_rows: int = 16,
) -> DataFrame:
    """Every row of ``docs`` (doc_id, source, others kept) with its place in the mixed order.

    Added: mix_block (of its source, from 0), mix_phase (how many sources have run out),
    mix_release, mix_deadline and mix_slot (the block's window and place, in slots since the
    start) and mix_position (the row's; it has gaps after blocks that are not full). At every slot
    each source is ahead of or behind its share by less than one block, where the shares are
    the weights among the sources that have not run out. No row is dropped or repeated.

    ``weights`` holds the target weight of each source; sources without one, and all sources if
    it is None, get the square root of their number of rows (scaled to the known ones). Sources
    of weight 0 follow all others, mixed among themselves by their roots.
    Rows of a source are ranked in groups by a hash of their id, so that no task holds a whole
    source; besides, counts and blocks are shuffled. The driver sees counts of sources and blocks.

    A NULL source counts as the source ''. NULL ids and repeated rows get places of their own.
    Empty table: no rows. Columns that start with mix_ are replaced.
    """
    docs = docs.drop(*[c for c in docs.columns if c.startswith("mix_")])
    keyed = docs.withColumn("mix_source", F.coalesce(F.col("source").cast("string"), F.lit("")))
    sizes = materialize(keyed.groupBy("mix_source").agg(F.count("*").alias("n")), "source-sizes")
    sources = materialize(source_table(sizes, weights or {}, block_rows), "sources")
    total, n = sizes.agg(F.sum("n"), F.sum(F.ceil(F.col("n") / block_rows))).first()
    total, n = total or 0, int(n or 0)
    stages = Stages(sources)
    jobs = ranked_along(
        materialize(windows(sources, stages), "windows"), [],
        ["mix_deadline", "mix_source", "mix_block"], n + 1, "mix_order")
    jobs = materialize(jobs, "jobs")
    slots = earliest_first(jobs, n)
    placed = stages.last(
        jobs.join(slots, "mix_order"), lambda s: s["at"] <= F.col("mix_slot"), "stage")
    # Sources of weight 0 start after all others have run out.
    out = sources.filter("mix_tier = 0").count()
    placed = materialize(placed.select(
        "mix_source", "mix_block", "mix_release", "mix_deadline", "mix_slot",
        (F.col("stage.k") + F.col("mix_tier") * out).cast("int").alias("mix_phase")), "blocks")
    keyed = ranked(keyed, "mix_source", ["doc_id"], total, "mix_rank").withColumn(
        "mix_block", F.floor(F.col("mix_rank") / block_rows))
    return keyed.join(bounded(placed), ["mix_source", "mix_block"]).select(
        *[F.col(f"`{c}`") for c in docs.columns], "mix_block", "mix_phase", "mix_release",
        "mix_deadline", "mix_slot",
        (F.col("mix_slot") * block_rows + F.col("mix_rank") % block_rows).alias("mix_position"),
    )
