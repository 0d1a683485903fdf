import zlib

import pytest
from pyspark.sql import functions as F
from texts import everything, frame, prose, shown, words

from starload.llm.quality_model import Condition, RuleModel, quality_scores
from starload.llm.quality_votes import quality_votes
from starload.llm.toxicity import toxicity_scores

LABELS = "doc_id long, quality int, toxic int, extra string"


def held(key, folds, part):
    return key is not None and zlib.crc32(str(key).encode()) % folds == part


def corpus():
    pairs = list(everything())
    labels = []
    for i, text in enumerate(prose(11, 400, longest=60)):
        w = text.split()
        bad, toxic = i % 5 == 0, i % 3 == 0
        if bad:
            w = [x + "###" for x in w]
        if toxic:
            w[len(w) // 2:len(w) // 2] = ["Scum,", "you", "people"] if i % 2 else ["worthless", "lot"]
        pairs.append((1000 + i, ". ".join(w)))
        if w and i % 4:
            labels.append((1000 + i, int(not bad), int(toxic), "x"))
    return pairs, labels + [(1, 1, 0, None), (None, 0, 1, None), (9999, 0, 1, None), (1003, None, None, None)]


def separation(rows, labels, name):
    truth = {l[0]: l[name] for l in labels if l[name] is not None}
    scored = [(r.score, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    good = [s for s, y in scored if y == 1]
    bad = [s for s, y in scored if y == 0]
    return sum((a > b) + 0.5 * (a == b) for a in good for b in bad) / (len(good) * len(bad))


@pytest.mark.parametrize("score, folds, part, at, threshold", [
    (quality_scores, 5, 0, 1, 0.3), (toxicity_scores, 3, 1, 2, 0.7)])
def test_held_out_labels_are_told_apart(spark, score, folds, part, at, threshold):
    pairs, labels = corpus()
    docs = frame(spark, pairs).withColumn("label", F.lit("clash")).withColumn("score", F.lit(3))
    rows = score(docs, spark.createDataFrame(labels, LABELS)).collect()
    assert sorted((r.doc_id or 0) for r in rows) == sorted((k or 0) for k, _ in pairs)
    for r in rows:
        assert r.held_out == held(r.doc_id, folds, part)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= threshold)
    assert separation(rows, labels, at) > 0.95


@pytest.mark.parametrize("score, folds, part", [(quality_scores, 5, 0), (toxicity_scores, 3, 1)])
def test_held_out_labels_are_not_learned(spark, score, folds, part):
    pairs, labels = corpus()
    turned = [(k, 1 - q if held(k, folds, part) and q is not None else q,
               1 - t if held(k, folds, part) and t is not None else t, e) for k, q, t, e in labels]
    docs = frame(spark, pairs, 1)
    first, second = (shown(score(docs, spark.createDataFrame(x, LABELS).coalesce(1)).select(
        "doc_id", F.round("score", 6).alias("score")).collect()) for x in (labels, turned))
    assert first == second


@pytest.mark.parametrize("score", [quality_scores, toxicity_scores])
def test_without_labels(spark, score):
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in score(frame(spark, everything()), none).collect()} == {0.5}
    assert score(frame(spark, []), none).collect() == []


def test_rules_compile_to_a_column(spark):
    model = RuleModel(-1.0, ((2.0, (Condition("a", True, 1.0), Condition("b", False, 0.0))),))
    rows = spark.createDataFrame([(2.0, -1.0), (2.0, 1.0), (0.0, -1.0)], "a double, b double")
    assert [round(r[0], 4) for r in rows.select(model.score()).collect()] == [0.7311, 0.2689, 0.2689]


def plain_counts(text):
    w, seen, places, dup = words(text), set(), {}, 0
    for i in range(len(w) - 4):
        places.setdefault(tuple(w[i:i + 5]), []).append(i)
    repeated = {j for v in places.values() if len(v) > 1 for i in v for j in range(i, i + 5)}
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(repeated),
            len(w) < 10 or 100 * len(repeated) > 20 * len(w))


def test_votes_count_as_defined(spark):
    pairs = everything() + [(50, "a b a b a b a b\n\na b\na b\n \n a b"), (51, "ab ### |x| <b>\r\nab ### |x| <b>")]
    got = quality_votes(frame(spark, pairs))
    assert shown(got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                            "n_repeat_words", "base_failed").collect()) == shown(
        (k, *plain_counts(t)) for k, t in pairs)
    assert all(not (r.base_failed and r.kept) for r in got.collect())
    assert quality_votes(frame(spark, [])).collect() == []


def test_votes_find_single_defects(spark):
    pairs, good = [], prose(4, 300, longest=80)
    letters = str.maketrans("0123456789", "abcdefghij")
    for i, text in enumerate(t for t in good if len(t.split()) > 15):
        w = text.lower().translate(letters).split()
        kind = i % 10
        if kind == 0:
            w = [x + "###" for x in w]
        elif kind == 1:
            w = [x.upper() + "!!" for x in w]
        pairs.append((i, ". ".join(" ".join(w[k:k + 8]) for k in range(0, len(w), 8)) + "."))
    kept = {r.doc_id: r.kept for r in quality_votes(frame(spark, pairs)).collect()}
    assert all(not kept[i] for i, _ in pairs if i % 10 < 2)
    assert sum(kept[i] for i, _ in pairs if i % 10 > 1) >= 0.98 * sum(i % 10 > 1 for i, _ in pairs)
