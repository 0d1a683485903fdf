import math
import random

from pyspark.ml.feature import HashingTF
from texts import frame

from starload.llm.toxicity import BUCKETS, fitted, toxicity_scores

LABELS = "doc_id long, toxic int"


def exactly_one(n):
    """Texts with none, one or both of two words; toxic with exactly one."""
    draw, pairs, labels = random.Random(7), [], []
    filler = ["river", "stone", "cloud", "table", "green", "seven", "house", "music"]
    for i in range(n):
        a, b = i % 2, i // 2 % 2
        words = draw.sample(filler, 5) + ["alpha"] * a + ["beta"] * b
        draw.shuffle(words)
        pairs.append((i, " ".join(words)))
        labels.append((i, a ^ b))
    return pairs, labels


def test_a_pair_of_neutral_terms_is_learned(spark):
    pairs, labels = exactly_one(600)
    rows = toxicity_scores(frame(spark, pairs), spark.createDataFrame(labels, LABELS)).collect()
    truth = dict(labels)
    held = [(r.score, truth[r.doc_id]) for r in rows if r.held_out]
    toxic, clean = ([s for s, y in held if y == kind] for kind in (1, 0))
    above = sum((s > t) + 0.5 * (s == t) for s in toxic for t in clean)
    assert above / (len(toxic) * len(clean)) > 0.95


def test_scores_are_those_of_a_plain_machine(spark):
    pairs, labels = exactly_one(300)
    # Rows without a label count for the weights of terms, too.
    pairs += [(1000 + i, "alpha Alpha, river" if i % 2 else None) for i in range(60)]
    docs, given = frame(spark, pairs), spark.createDataFrame(labels, LABELS)
    _, model = fitted(docs, given)
    bucket = HashingTF(numFeatures=BUCKETS).indexOf
    sets = {k: {bucket(w.strip(",").lower()) for w in (t or "").split()} for k, t in pairs}
    chosen = model.chosen.getIndices()
    linear, factors = model.machine.linear.toArray(), model.machine.factors.toArray()
    for row in toxicity_scores(docs, given).collect():
        x = [math.log((len(sets) + 1) / (sum(c in s for s in sets.values()) + 1)) * (c in sets[row.doc_id])
             for c in chosen]
        total = model.machine.intercept + sum(w * v for w, v in zip(linear, x))
        used = [i for i, v in enumerate(x) if v]
        total += sum(x[i] * x[j] * float(factors[i] @ factors[j]) for i in used for j in used if i < j)
        assert abs(row.score - 1 / (1 + math.exp(-total))) < 1e-6
