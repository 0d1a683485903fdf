"""Join on names that contain each other, read as LIKE patterns, ignoring case."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.functions.text import containing_pattern, pattern_fragments
from starload.session import materialize

# Up to this many names the shorter list is compared with every other name: one broadcast of
# bounded size and no shuffle. Longer lists are equi-joined; both ways find the same pairs.
NESTED_LIMIT = 64
# Lengths of the stretches names are joined on, longest first.
GRAMS = (8, 5, 3, 2, 1)
# Up to this many stretches (of 8 characters at most, with a run beside them) are broadcast.
FEW_GRAMS = 200_000
# A run that gives stretches of the longest kind is weighed by every fourth of them and its last.
STEP = 4


def distinct_names(df: DataFrame, column: str) -> DataFrame:
    """The names in lower case, each once."""
    return df.select(F.lower(column).alias("name")).filter("name IS NOT NULL").distinct()


def nested_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """Matching (left, right) names by comparing all; ``right`` must be few."""
    a = left.select(F.col("name").alias("left"), containing_pattern(F.col("name")).alias("_lp"))
    b = right.select(F.col("name").alias("right"), containing_pattern(F.col("name")).alias("_rp"))
    match = F.like(F.col("left"), F.col("_rp")) | F.like(F.col("right"), F.col("_lp"))
    return a.join(F.broadcast(b), match).select("left", "right")


def _grams(text: Column, n: int) -> Column:
    """Every stretch of n characters, each once; none of a shorter text."""
    starts = F.sequence(F.lit(1), F.greatest(F.char_length(text) - (n - 1), F.lit(1)))
    every = F.transform(starts, lambda i: F.substring(text, i, F.lit(n)))
    return F.array_distinct(F.filter(every, lambda g: F.char_length(g) == n))


def _longest_grams(run: Column) -> Column:
    """Stretches of a literal run, of the longest of ``GRAMS`` that it allows, its first one first.

    Within a run no shorter stretch is found in fewer texts. Any of them finds all texts that hold
    the run, and neighbours are about as rare: of the longest kind a few will do, such that every
    five characters in a row lie in one of them.
    """
    out = F.array().cast("array<string>")
    longest = GRAMS[0]
    for n in sorted(GRAMS[1:]):
        out = F.when(F.char_length(run) >= n, _grams(run, n)).otherwise(out)
    last = F.greatest(F.char_length(run) - (longest - 1), F.lit(1))
    starts = F.concat(F.sequence(F.lit(1), last, F.lit(STEP)), F.array(last))
    cover = F.array_distinct(F.transform(starts, lambda i: F.substring(run, i, F.lit(longest))))
    return F.when(F.char_length(run) >= longest, cover).otherwise(out)


def leading_stretches(texts: DataFrame, needles: DataFrame) -> DataFrame:
    """(needle, pattern, runs, plain, gram, second, n_texts): how each needle is to be found.

    Each literal run of a pattern is weighed by its stretch that the fewest texts hold, as
    counted. The rarest of all leads (``gram``); ``second`` is the next rarest run as a whole,
    or the only one. A needle without wildcards is ``plain``. Needles made of wildcards only
    have no row. A stretch found in no text rules its needle out, and has no row either.
    """
    body = F.col("name")
    runs = materialize(needles.select(
        body.alias("needle"), containing_pattern(body).alias("pattern"),
        F.array_distinct(pattern_fragments(body)).alias("runs"),
        (~F.contains(body, F.lit("%")) & ~F.contains(body, F.lit("_")) & ~F.contains(body, F.lit("\\")))
        .alias("plain"),
    ).filter(F.size("runs") > 0), "needles")
    stretches = materialize(runs.select("needle", F.explode("runs").alias("run")).select(
        "needle", "run", F.explode(_longest_grams(F.col("run"))).alias("gram")), "stretches")
    grams = materialize(stretches.select("gram").distinct(), "grams")
    spread = materialize(spread_of(texts, grams), "spread")
    # A run with a stretch that no text holds counts as found in none.
    per_run = stretches.join(spread, "gram", "left").fillna(0, ["n_texts"]).groupBy("needle", "run").agg(
        F.min(F.struct("n_texts", (-F.char_length("gram")).alias("size"), "gram")).alias("rarest"))
    ranked = per_run.groupBy("needle").agg(
        F.sort_array(F.collect_list(F.struct("rarest", "run"))).alias("ranked"))
    lead = F.get("ranked", F.lit(0))
    return runs.join(ranked, "needle").select(
        "needle", "pattern", "runs", "plain", lead["rarest"]["gram"].alias("gram"),
        F.coalesce(F.get("ranked", F.lit(1)), lead)["run"].alias("second"),
        lead["rarest"]["n_texts"].alias("n_texts"),
    ).filter("n_texts > 0")


def _shares(grams: DataFrame) -> list[tuple[list[int], bool]]:
    """The lengths of the asked stretches: those that are few together by count, and the others.

    Each with whether it is to be broadcast. Short stretches are few whatever the names, long ones
    grow with them: only the latter are shuffled.
    """
    # One row per length in use reaches the driver.
    counted = grams.groupBy(F.char_length("gram").alias("n")).agg(F.count(F.lit(1)).alias("asked")).collect()
    few, many, room = [], [], FEW_GRAMS
    for n, asked in sorted(counted, key=lambda row: row["asked"]):
        room -= asked
        (few if room >= 0 else many).append(n)
    return [(sorted(lengths), held) for lengths, held in ((few, True), (many, False)) if lengths]


def _stretches_of(texts: DataFrame, lengths: list[int]) -> DataFrame:
    """(text, gram): every stretch of the given lengths of each text, once."""
    every = F.concat(*[_grams(F.col("name"), n) for n in lengths])
    return texts.select(F.col("name").alias("text"), F.explode(every).alias("gram"))


def pieces_of(texts: DataFrame, grams: DataFrame) -> DataFrame:
    """(text, gram, ...): which of the asked ``grams`` each text holds, by equi-join.

    A text gives at most as many rows as characters for each length in use. The optimizer takes
    the taken apart names for as small as the whole ones: it must not broadcast them.
    """
    parts = []
    for lengths, few in _shares(grams):
        asked = grams.filter(F.char_length("gram").isin(lengths))
        parts.append(_stretches_of(texts, lengths).join(
            F.broadcast(asked) if few else asked.hint("merge"), "gram"))
    if not parts:
        return _stretches_of(texts, [1]).join(grams, "gram")
    return functools.reduce(DataFrame.unionByName, parts)


def spread_of(texts: DataFrame, grams: DataFrame) -> DataFrame:
    """(gram, n_texts): in how many texts each of the grams is found, if in any.

    Stretches too many to be broadcast are counted before they are joined, so that a stretch of
    many names is one row per task.
    """
    parts = []
    for lengths, few in _shares(grams):
        asked = grams.filter(F.char_length("gram").isin(lengths))
        every = _stretches_of(texts, lengths).select("gram")
        n_texts = F.count(F.lit(1)).alias("n_texts")
        parts.append(every.join(F.broadcast(asked), "gram").groupBy("gram").agg(n_texts) if few
                     else every.groupBy("gram").agg(n_texts).join(asked.hint("merge"), "gram"))
    if not parts:
        return grams.select("gram", F.lit(0).cast("long").alias("n_texts"))
    return functools.reduce(DataFrame.unionByName, parts)


def candidates(texts: DataFrame, leads: DataFrame) -> DataFrame:
    """(text, gram, second): texts that hold both stretches of some needle.

    Needles with the same two stretches share their candidates, so that a stretch that is
    frequent alone brings no row per needle.
    """
    asked = leads.select("gram", "second").distinct()
    held = pieces_of(texts, materialize(asked, "asked-stretches"))
    return held.filter(F.contains(F.col("text"), F.col("second")))


def possible(texts: DataFrame, needles: DataFrame) -> DataFrame:
    """The needles that ask for no longer text than there is.

    A needle asks for as many characters as its literal runs and its ``_`` have.
    """
    body = F.col("name")
    literal = F.char_length(F.array_join(pattern_fragments(body), ""))
    # Escaped ones are in the runs: nothing is asked for twice.
    single = F.char_length(F.regexp_replace(body, r"(?s)\\.|[^_]", ""))
    # One number reaches the driver.
    longest = texts.agg(F.max(F.char_length(body))).first()[0] or 0
    return needles.filter(literal + single <= F.lit(longest))


def contained(texts: DataFrame, needles: DataFrame) -> DataFrame:
    """(text, needle) for each needle whose containing pattern a text matches.

    A text must hold every literal run of a pattern. Texts that hold the needle's two leading
    stretches (see ``leading_stretches``) are tested for the other runs and then, unless the
    needle has no wildcards, against the whole pattern. A needle made of wildcards only asks
    for a least length of text, joined on that number.
    """
    body = F.col("name")
    needles = possible(texts, needles)
    leads = materialize(leading_stretches(texts, needles), "leading-stretches")
    # The only run of a needle without wildcards is the needle.
    whole = pieces_of(texts, leads.filter("plain").select("gram", "needle")).filter(
        F.contains(F.col("text"), F.col("needle"))).select("text", "needle")
    # Needles with wildcards are mostly few: by themselves they may be small enough to be broadcast.
    wild = materialize(leads.filter("NOT plain"), "wild-stretches")
    holds = F.forall("runs", lambda run: F.contains(F.col("text"), run))
    found = whole.unionByName(candidates(texts, wild).join(wild, ["gram", "second"]).filter(
        holds & F.like(F.col("text"), F.col("pattern"))).select("text", "needle"))
    bare = needles.select(
        body.alias("needle"), F.char_length(F.translate(body, "%", "")).alias("n"),
    ).filter(F.size(pattern_fragments(F.col("needle"))) == 0)
    # Lengths only, so that the longest name bounds what reaches the driver.
    least = sorted(row[0] for row in bare.select("n").distinct().collect())
    if not least:
        return found
    long_enough = texts.select(
        body.alias("text"), F.explode(F.array(*[F.lit(n) for n in least])).alias("n")
    ).filter(F.col("n") <= F.char_length("text"))
    return found.unionByName(long_enough.join(bare, "n").select("text", "needle"))


def held_stretches(names: DataFrame) -> DataFrame:
    """(gram, name): every stretch of each name, of all lengths a pattern may be led by."""
    every = F.array_distinct(F.concat(*[_grams(F.col("name"), n) for n in GRAMS]))
    return names.select(F.explode(every).alias("gram"), "name")


def pattern_stretch(names: DataFrame) -> DataFrame:
    """(gram, name): a stretch each name asks for as a pattern; empty if it has wildcards only."""
    runs = pattern_fragments(F.col("name"))
    longest = F.array_max(F.transform(runs, lambda r: F.struct(F.char_length(r).alias("n"), r.alias("run"))))["run"]
    return names.select(F.coalesce(F.get(_longest_grams(longest), F.lit(0)), F.lit("")).alias("gram"), "name")


def blocked_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """Matching (left, right) names by equi-joins, for lists of any size."""
    # Names are short and dear to take apart: small lists are spread over all tasks, too.
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left, right = (materialize(side.repartition(tasks, F.xxhash64("name")), "names")
                   for side in (left, right))
    forward = contained(left, right).select(
        F.col("text").alias("left"), F.col("needle").alias("right")
    )
    backward = contained(right, left).select(
        F.col("needle").alias("left"), F.col("text").alias("right")
    )
    return forward.unionByName(backward).distinct()


def name_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """Matching pairs of lower-case names, by the way their number allows."""
    right = materialize(right, "right-names")
    if right.limit(NESTED_LIMIT + 1).count() <= NESTED_LIMIT:
        return nested_pairs(left, right)
    return blocked_pairs(left, right)


def fuzzy_join(
    left: DataFrame, right: DataFrame, left_name: str, right_name: str
) -> DataFrame:
    """All rows of both sides whose names contain each other.

    Names are matched once each and joined back to the rows.
    """
    pairs = materialize(
        name_pairs(distinct_names(left, left_name), distinct_names(right, right_name)),
        "name-pairs",
    )
    return (
        left.withColumn("_left", F.lower(left_name))
        .join(pairs.toDF("_left", "_right"), "_left")
        .join(right.withColumn("_right", F.lower(right_name)), "_right")
        .drop("_left", "_right")
    )
