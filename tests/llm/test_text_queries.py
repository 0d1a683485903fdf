"""Queries beside their SQL, and the pipeline's stages on small tables."""

import textwrap

import duckdb
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from texts import SCHEMA, everything, frame, rows

import __spark_entry__
import corpus_pipeline
from starload.llm.licenses import license_scan, read_words, template_hits
from starload.llm.queries import ORACLE, QUERIES
from testbed.compare import normal

SF = "/root/testdata/sf0.001"
NOTICES = [
    (301, "This work is licensed under the GNU General Public License, version 3."),
    (302, "x\nLicensed under CC BY-NC 4.0.\ny"), (303, "apache\nlicense, apache license"),
    (304, "the MIT   License and the mit-license"), (305, "ccby cc byx cc-by"),
    (305, "Redistribution in source and binary forms"), (None, "Apache License"),
    (308, "Redistribution and use in\n * source and binary forms, with or\n * without modification, "
          "are permitted\n * provided that the following conditions are met:"),
    (309, "released under the\nMIT license or under the Apache License"),
    (306, "You may not use this file except in compliance with the License, ever"),
    (307, "apachelicense Éapache license"),
]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    result = con.execute(ORACLE[name])
    df = QUERIES[name](spark, SF)
    assert normal(df.collect(), df.columns) == normal(
        result.fetchall(), [c[0] for c in result.description])


def test_license_query_on_awkward_rows(spark, tmp_path):
    frame(spark, everything() + NOTICES).withColumn("words", F.lit(1)).write.parquet(
        f"{tmp_path}/documents.parquet")
    df = QUERIES["op6_licenses"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    result = con.execute(ORACLE["op6_licenses"])
    assert normal(df.collect(), df.columns) == normal(
        result.fetchall(), [c[0] for c in result.description])


def test_blocks_meet_templates_by_containment(spark):
    templates = {"t": "a b c d e", "u": "x y", "none": "q"}
    pairs = [(1, "a b c d z\nE D C B A"), (2, "a b c\nd e"), (3, "x"), (4, "Y x a"), (5, None),
             (6, "a b z z z z c d e"), (7, "a z b c d"), (8, "y - z - x"), (9, "y z z x")]
    got = {(r.doc_id, r.label, r.containment) for r in
           template_hits(read_words(frame(spark, pairs), templates), templates, 0.8).groupBy(
               "doc_id", "label").agg(F.max("containment").alias("containment")).collect()}
    # Blocks have seven words for five, and three for two.
    assert got == {(1, "t", 1.0), (2, "t", 1.0), (4, "u", 1.0), (7, "t", 0.8), (8, "u", 1.0)}
    named = template_hits(read_words(frame(spark, pairs), templates), templates, 0.8, {"t": "e"})
    assert {r.doc_id for r in named.filter("label = 't'").collect()} == {1, 2}
    assert license_scan(frame(spark, [])).collect() == []


def wrapped(text, width):
    return "\n * ".join(textwrap.wrap(text, width))


def test_wrapped_notices_and_near_ones(spark):
    """Terms wrapped as they usually are get their labels, and the names of others do not."""
    gpl = ("This program is free software: you can redistribute it and/or modify it under the terms of the "
           "GNU General Public License as published by the Free Software Foundation")
    bsd = ("Redistribution and use in source and binary forms, with or without modification, are permitted "
           "provided that the following conditions are met:")
    mit = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
           "associated documentation files (the Software)")
    filler = "one of the words in this text is not to be taken for a notice under any law " * 400
    pairs = [(1, wrapped(gpl, 60)), (2, filler + wrapped(bsd, 40) + filler), (3, wrapped(mit, 75)),
             (4, "Released under the Apache License"), (5, "Licensed under CC BY 4.0"),
             (6, "licensed under the GNU General Public License version 2.0"),
             (7, "released under\nthe MIT\nlicense"), (8, filler),
             (9, "Licensed under the\nApache License, Version 2.0")]
    got = {r.doc_id: set(r.notices) for r in license_scan(frame(spark, pairs)).collect()}
    assert got == {1: {"gpl-terms"}, 2: {"bsd-terms"}, 3: {"mit-terms"}, 4: set(), 5: set(), 6: set(),
                   7: {"mit-notice"}, 8: set(), 9: {"apache-2.0"}}


def test_every_operator_has_a_query():
    names = {n.split("_")[0] for n in __spark_entry__.queries()}
    assert {f"op{i}" for i in range(1, 14)} | {"pipeline"} <= names


@pytest.mark.parametrize("name", ["op2_substrings", "op3_edit_counts", "op4_mix", "op9_jaccard",
                                  "op13_bwt_dedup"])
def test_query_gives_a_row_per_document(spark, name):
    assert QUERIES[name](spark, SF).count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_pipeline(spark, tmp_path):
    prose = everything(3, 120)
    long = [p for p in prose if (p[0] or 0) >= 100 and len(p[1] or "") > 300]
    passage = " ".join(f"shared{i}" for i in range(60))
    pairs = prose + [(700, long[0][1]), (701, long[0][1] + " more"), (702, f"{long[1][1]} {passage}"),
                     (703, f"{passage} {long[2][1]}")]
    pairs += [(800 + i, " ".join(f"{w}###" for w in t.split())) for i, (_, t) in enumerate(long[3:20])]
    # A clean text beside a rejected one under one id, a copy without an id, and long blanks.
    pairs += [(801, long[20][1]), (None, long[4][1]), (None, long[6][1] + " and more"), (900, " " * 1_000_000 + "end")]
    labels = [(k, int(k < 800), 0) for k, _ in pairs if k is not None and 100 <= k < 900 and k != 801]
    spark.createDataFrame(rows(pairs), SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").withColumn("component_id", F.lit(1))
    texts, kept = {}, []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        if name != "best-fit packing":
            assert docs.columns == list(corpus_pipeline.COLUMNS)
            docs = spark.createDataFrame(docs.collect(), docs.schema)
            texts[name] = {r.doc_id: r.text for r in docs.collect()}
            held = sorted((r.doc_id or 0, r.text or "") for r in docs.collect())
            kept.append(held)
    good, single, cut, mixed = texts.values()
    assert not any(t and "###" in t for _, t in kept[0]) and {k for k, _ in long} <= set(good)
    # Only rejected rows go, with and without an id; then copies, each row by itself.
    assert kept[0] == sorted((k or 0, t or "") for k, t in pairs if "###" not in (t or ""))
    assert (801, long[20][1]) in kept[0] and (0, prose[0][1]) in kept[1]
    assert (0, long[4][1]) not in kept[1] and (long[4][0], long[4][1]) in kept[1]
    assert [t for k, t in kept[1] if k == 6] == ["another text, same id", "same text twice"]
    first = min(long[0][0], 700)
    assert first in single and not {700, 701} & set(single)
    assert set(cut) == set(single) == set(mixed) and cut == mixed
    assert "shared5" not in cut[702] + cut[703] and long[1][0] in good
    assert cut[long[5][0]] == dict(pairs)[long[5][0]]
    packed = docs.collect()
    assert {r.doc_id for r in packed} == set(mixed)
    assert sum(r.length for r in packed if r.doc_id == 900) > 1_000_000
    run = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id or 0, r.piece, r.ids_crc32) for r in run) == sorted(
        (r.doc_id or 0, r.piece, r.ids_crc32) for r in packed)
    assert public_tokenizers.path("byte_bpe_50k.json")
