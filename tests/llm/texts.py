"""Small tables with the awkward rows, and plain rules the operators are compared with."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORD.findall(text or "")


def rows(pairs):
    return [(i, t, None, f"s{(i or 0) % 3}" if t else None, len(t or "")) for i, t in pairs]


def frame(spark, pairs, parts=3):
    return spark.createDataFrame(rows(pairs), SCHEMA).repartition(parts)


def prose(seed, n, vocabulary=800, longest=150):
    rng = random.Random(seed)
    names = [f"w{i}é" if i % 5 == 0 else f"W{i}" for i in range(vocabulary)]
    return [" ".join(rng.choice(names) for _ in range(rng.randint(0, longest))) for _ in range(n)]


AWKWARD = [
    (None, "a text without an id, of seven words"), (1, None), (2, ""), (3, " \n\t "), (4, "one"),
    (5, "x " * 3000), (6, "same text twice"), (6, "same text twice"), (6, "another text, same id"),
    (7, "é 😀 <|endoftext|> it's fine"),
]


def everything(seed=1, n=60):
    return AWKWARD + [(100 + i, t) for i, t in enumerate(prose(seed, n))]


def shown(rows):
    return sorted((tuple(r) for r in rows), key=repr)
