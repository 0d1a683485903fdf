"""License scans: phrases in place, and stretches of words that hold most of a notice's words."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.session import materialize

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Short public notices and their labels.
TEMPLATES = {
    "apache-2.0": "licensed under the apache license version 2 0",
    "apache-2.0-terms": "you may not use this file except in compliance with the license",
    "bsd-terms": "redistribution and use in source and binary forms with or without modification "
                 "are permitted provided that the following conditions are met",
    "cc-by-nc-4.0": "licensed under cc by nc 4 0",
    "gpl-3.0": "this work is licensed under the gnu general public license version 3",
    "gpl-terms": "this program is free software you can redistribute it and or modify it under "
                 "the terms of the gnu general public license",
    "mit-notice": "released under the mit license",
    "mit-terms": "permission is hereby granted free of charge to any person obtaining a copy of "
                 "this software and associated documentation files",
}
# Words that tell a short notice from others; a block must hold all of them.
NAMING = {
    "apache-2.0": "apache 2",
    "cc-by-nc-4.0": "cc nc 4",
    "gpl-3.0": "gnu 3",
    "mit-notice": "mit",
}
# Share of a template's distinct words a block must hold.
CONTAINMENT = 0.8
# Words are letters, digits and all beyond ASCII; the rest stands between them.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _array(values) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def _places(phrase: str) -> Column:
    """Starts of a phrase in the array ``words``."""
    parts = phrase.split(" ")

    def here(i: Column) -> Column:
        test = F.get("words", i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            test = test & (F.get("words", i + k) == part)
        return F.coalesce(test, F.lit(False))

    every = F.sequence(F.lit(0), F.greatest(F.size("words") - 1, F.lit(0)))
    # Most texts do not hold the longest word of the phrase at all.
    return F.when(F.col("lower").contains(max(parts, key=len)), F.filter(every, here)).otherwise(
        F.array().cast("array<int>")
    )


def _template_words(templates: dict[str, str]) -> dict[str, list[str]]:
    return {k: sorted(set(re.findall(WORD, v.lower()))) for k, v in templates.items()}


def block_words(template: str) -> int:
    """Consecutive words of a text that are compared with a template: a quarter more than it has."""
    return math.ceil(1.25 * len(re.findall(WORD, template.lower())))


def read_words(docs: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """doc_id, text_hash, n_words, ``found`` (label and starts of each phrase) and ``hits``: the
    words of any template in a text, with their places.

    This is the only pass over the texts.
    """
    every = " ".join(sorted({w for s in _template_words(templates).values() for w in s}))
    found = F.array(*[
        F.struct(F.lit(label).alias("label"), _places(phrase).alias("starts"))
        for phrase, label in PHRASES.items()
    ])
    words = F.transform("words", lambda word, at: F.struct(at.alias("at"), word.alias("word")))
    hits = F.filter(words, lambda hit: F.contains(
        F.lit(f" {every} "), F.concat(F.lit(" "), hit["word"], F.lit(" "))))
    text = F.translate(F.coalesce(F.col("text"), F.lit("")), UPPER, LOWER)
    return (
        docs.select("doc_id", F.xxhash64("text").alias("text_hash"), text.alias("lower"))
        .withColumn("words", F.array_remove(F.split("lower", BETWEEN), ""))
        .select(
            "doc_id", "text_hash", F.size("words").cast("long").alias("n_words"),
            F.filter(found, lambda f: F.size(f["starts"]) > 0).alias("found"), hits.alias("hits"),
        )
    )


def template_hits(
    read: DataFrame, templates: dict[str, str] = TEMPLATES, containment: float = CONTAINMENT,
    naming: dict[str, str] | None = None,
) -> DataFrame:
    """(doc_id, text_hash, block, label, containment): blocks holding enough of a template.

    ``read`` is a written table of ``read_words``. Blocks are all stretches of ``block_words``
    consecutive words, over line breaks, compared with a template as sets of words; ``block`` is
    a word of the template in one. Words of ``naming`` must be among them.

    Template words are ordered by how often they stand in the texts, rarest first. A block that
    holds enough of a template holds one of its first words, so only places of those are
    joined, with the template words around. Pairs go whose word stands too late in the
    template, then those with too few words around, and then blocks are judged one by one. The
    join's right side has one row per prefix word of a template, and so is broadcast.
    """
    spark = read.sparkSession
    naming = NAMING if naming is None else naming
    sets = _template_words(templates)
    # One row per template word reaches the driver.
    counted = read.select(F.explode("hits.word").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    frequency = {r["word"]: r["n"] for r in counted.collect()}
    prefixes = []
    for label, words in sets.items():
        words = sorted(words, key=lambda w: (frequency.get(w, 0), w))
        need = math.ceil(round(containment * len(words), 9))
        for word in words[: len(words) - need + 1]:
            prefixes.append((word, label, words, sorted(naming.get(label, "").split()), need,
                             block_words(templates[label])))
    table = spark.createDataFrame(
        prefixes or [("", "", [""], [""], 1, 1)],
        "word string, label string, template array<string>, named array<string>, need int, span int",
    ).filter(F.lit(bool(prefixes)))
    rare = _array(sorted({p[0] for p in prefixes}))
    def held(near: Column, start: Column) -> Column:
        """The template's words in the block that begins at a place."""
        inside = F.filter(near, lambda x: (x["at"] >= start) & (x["at"] < start + F.col("span")))
        return F.array_intersect("template", F.transform(inside, lambda x: x["word"]))

    def judged(near: Column) -> Column:
        return F.array_max(F.transform(near, lambda first: F.when(
            F.size(F.array_intersect("named", held(near, first["at"]))) == F.size("named"),
            F.size(held(near, first["at"]))).otherwise(0)))

    # At most so many template words stand within a block's reach on either side. They are cut
    # out before a text is taken apart, so that no place carries a whole text along.
    reach = max([p[5] for p in prefixes], default=1)
    places = F.transform("hits", lambda hit, i: F.when(F.array_contains(rare, hit["word"]), F.struct(
        hit["at"].alias("at"), hit["word"].alias("word"),
        F.slice("hits", F.greatest(i - (reach - 2), F.lit(1)), 2 * reach - 1).alias("around"))))
    return (
        read.filter(F.arrays_overlap("hits.word", rare))
        .select("doc_id", "text_hash", F.explode(F.filter(places, lambda x: x.isNotNull())).alias("place"))
        .select("doc_id", "text_hash", "place.*")
        .join(F.broadcast(table), "word")
        .withColumn("near", F.filter("around", lambda x: (F.abs(x["at"] - F.col("at")) < F.col("span"))
                                     & F.array_contains("template", x["word"])))
        .filter(F.size(F.array_intersect("template", F.transform("near", lambda x: x["word"]))) >= F.col("need"))
        .withColumn("most", judged(F.col("near")))
        .filter(F.col("most") >= F.col("need"))
        .select("doc_id", "text_hash", F.col("at").alias("block"), "label",
                (F.col("most") / F.size("template")).alias("containment"))
    )


def license_scan(docs: DataFrame) -> DataFrame:
    """Phrases and notices of every row of ``docs`` (doc_id, text), in DataFrame functions only.

    Result: doc_id, n_words, ``found`` (label and starts of each phrase), ``notices`` (labels
    of the templates met, sorted) and ``containment`` (the highest, else NULL). Labels are
    gathered as a set per text, so hot sources or long texts gather nothing large. Null text: empty. Null doc_id, repeated rows and repeated ids: one result each,
    as texts are told apart by their hash. Empty table: no rows. Other columns are not read.
    """
    rows = materialize(read_words(docs), "words-read")
    best = template_hits(rows).groupBy("doc_id", "text_hash").agg(
        F.sort_array(F.collect_set("label")).alias("notices"), F.max("containment").alias("containment")
    ).withColumnsRenamed({"doc_id": "hit_id", "text_hash": "hit_hash"})
    return rows.join(
        best, rows["doc_id"].eqNullSafe(best["hit_id"]) & rows["text_hash"].eqNullSafe(best["hit_hash"]),
        "left",
    ).select(
        "doc_id", "n_words", "found",
        F.coalesce("notices", F.array().cast("array<string>")).alias("notices"), "containment",
    )
