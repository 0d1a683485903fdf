import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from texts import AWKWARD, LOWER, SCHEMA, prose

from starload.llm import collocations as module
from starload.llm.collocations import collocations


def plain(rows, least, longest=5, top=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for i in range(len(w)):
                for k in range(1, min(longest, len(w) - i) + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    found = {x: a for x, a in f.items() if a >= least and len(x[1]) > 1}
    dropped = {(lang, p[i:j]) for (lang, p), a in found.items() for i in range(len(p))
               for j in range(i + 2, len(p) + 1) if j - i < len(p) and 100 * a >= 100 * f[lang, p[i:j]]}
    out = defaultdict(list)
    for (lang, p), a in found.items():
        if (lang, p) not in dropped:
            score, k = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
            text = " ".join(p)
            out[lang].append((-score, -a, text.encode(), (text, a, f[lang, p[:k]], f[lang, p[k:]], n[lang], score)))
    return sorted((lang, rank, *x[3]) for lang, some in out.items() for rank, x in enumerate(sorted(some)[:top], 1))


def table():
    texts = prose(4, 150, vocabulary=40, longest=120)
    out = [(t, "en") for _, t in AWKWARD]
    for i, t in enumerate(texts):
        words = t.split()
        # Punctuation, runs of blanks and fixed phrases, at places that differ.
        for at in range(i % 7, len(words), 7):
            words[at] += ", \t"[: 1 + at % 4] + "Big  Red\tfox jumps over" + ".;:!?\n\r\v\f"[at % 9]
        out.append((" ".join(words), [None, "und", "en", "", "a very long name"][i % 5]))
    return out + [(t, "a very long name, again") for t in texts[:20]] + [
        ("a\x00b a\x00b\x1ca c ÉÉ " * 40, "en"), ("no no " * 300, None), (None, None), (None, "xx")]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, None, 0) for i, (t, lang) in enumerate(rows)], SCHEMA).repartition(5)


@pytest.mark.parametrize("least,chunk", [(5, 8_000_000), (30, 500), (2, 3000)])
def test_equals_counts_of_all_phrases(spark, monkeypatch, least, chunk):
    monkeypatch.setattr(module, "CHUNK", chunk)
    monkeypatch.setattr(module, "HELD", 300 if chunk == 500 else 1 << 22)
    docs = frame(spark, table()).withColumns({"phrase": F.lit("x"), "n": F.lit(1), "words": F.lit("y")})
    assert sorted(map(tuple, collocations(docs, least).collect())) == plain(table(), least)


def test_top_phrases_and_short_ones(spark):
    got = collocations(frame(spark, table()), 4, longest=3, top=7)
    assert sorted(map(tuple, got.collect())) == plain(table(), 4, 3, 7)


def test_full_filter_changes_nothing(spark, monkeypatch):
    """Where rare pairs pass the filter for want of bits, counts stay the same."""
    monkeypatch.setattr(module, "LEAST_BITS", 6)
    monkeypatch.setattr(module, "MOST_BITS", 6)
    assert sorted(map(tuple, collocations(frame(spark, table()), 20).collect())) == plain(table(), 20)


def test_no_rows(spark):
    assert collocations(frame(spark, [])).collect() == []
    assert collocations(frame(spark, [("one two", "en")])).collect() == []


def test_long_runs(spark):
    rows = [("ab " * 400_000, "en"), (" " * 1_000_000 + "ab ab", "en"), ("x" * 1_500_000, "en")]
    assert sorted(map(tuple, collocations(frame(spark, rows), 100).collect())) == plain(rows, 100)
