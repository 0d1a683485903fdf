import random

import public_tokenizers
from pyspark.sql import functions as F
from texts import everything, frame

from starload.llm import edit_counts
from starload.llm.edit_counts import counter, counts_after_edits, edited, grown

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "bc", " ", "  ", "\n", "'s", "'", "ll", "12", ".", "é", "😀", "don't", " the", "   x"]


def test_counts_equal_a_full_encoding(monkeypatch):
    monkeypatch.setattr(edit_counts, "LEAF", 3)
    count, rng = counter(PATH), random.Random(2)
    for _ in range(400):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 60)))
        tree = grown(text, count)
        assert tree.tokens[1] == count(text)
        for _ in range(4):
            at, removed = rng.randint(0, len(text)), rng.choice([0, 1, 2, 5, 30])
            inserted = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 4)))
            want = text[:at] + inserted + text[at + removed:]
            text, _ = edited(text, tree, at, removed, inserted, count)
            assert text == want
            assert (tree.tokens[1], tree.chars[1]) == (count(text), len(text))


def test_an_edit_encodes_a_small_region():
    count = counter(PATH)
    text = "some words in a row, " * 5000
    tree = grown(text, count)
    _, n = edited(text, tree, 50_000, 7, "other", count)
    assert n < 4 * edit_counts.LEAF
    assert sum(tree.sums()[1]) == tree.tokens[1]


def test_query_over_awkward_rows(spark):
    docs, count = frame(spark, everything()), counter(PATH)
    edits = F.when(F.col("doc_id") == 4, F.lit(None)).otherwise(F.array(
        F.struct(F.lit(3).cast("long").alias("at"), F.lit(2).cast("long").alias("removed"),
                 F.lit("new ").alias("inserted")),
        F.struct(F.lit(10**9).cast("long").alias("at"), F.lit(None).cast("long").alias("removed"),
                 F.lit(" end").alias("inserted"))))
    got = sorted((r.doc_id or 0, r.n_tokens, r.n_tokens_after) for r in
                 counts_after_edits(docs, edits, PATH).collect())
    want = []
    for key, text in everything():
        text = text or ""
        at = min(3, len(text))
        after = text if key == 4 else text[:at] + "new " + text[at + 2:] + " end"
        want.append((key or 0, count(text), count(after)))
    assert got == sorted(want)
    assert counts_after_edits(frame(spark, []), edits, PATH).collect() == []
