import random

import numpy as np
import pytest
from texts import AWKWARD, frame, prose

from starload.llm import bwt_dedup
from starload.llm.bwt_dedup import anchors, interleaved, merged, remove_earlier, symbols, transform


def plain(pairs, length=50):
    rows = [(i, (t or "").encode()) for i, t in pairs]
    least = {}
    for i, b in rows:
        for k in range(len(b) - length + 1 if i is not None else 0):
            least[b[k:k + length]] = min(least.get(b[k:k + length], i), i)
    out = []
    for i, b in rows:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1 if i is not None else 0):
            if least[b[k:k + length]] < i:
                gone[k:k + length] = b"\1" * length
        spans = [k for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1])]
        out.append((i, len(b), sum(gone), len(spans), bytes(c for c, g in zip(b, gone) if not g)))
    return sorted(out, key=repr)


def shown(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.bytes_kept)) for r in df.collect()),
                  key=repr)


def planted():
    rng = random.Random(4)
    passage = prose(8, 1, longest=60)[0] + " " + "z" * 120 + "\0\0\0 é" * 30
    pairs = list(AWKWARD) + [(20, "a" * 49), (21, "a" * 50), (22, "a" * 51), (23, "ab" * 400),
                             (24, "\0" * 70), (25, "\0" * 50 + "a"), (26, "b\0" * 40)]
    for i, text in enumerate(prose(3, 60)):
        at, first = rng.randint(0, len(text)), rng.randint(0, 100)
        if rng.random() < 0.6:
            text = text[:at] + passage[first:first + rng.choice([48, 49, 50, 51, 80, 300])] + text[at:]
        pairs.append((100 + i, text))
    # Copies, copies under one id, ids below zero, and a row without an id that holds a passage.
    return pairs + [(30, pairs[-1][1]), (31, pairs[-2][1] + pairs[-3][1]), (100, pairs[-4][1]),
                    (-5, pairs[-5][1][:400]), (None, pairs[-6][1])]


@pytest.mark.parametrize("length", [50, 20])
def test_equals_a_table_of_all_strings(spark, length, monkeypatch):
    pairs = planted()
    assert shown(remove_earlier(frame(spark, pairs), length)) == plain(pairs, length)


def test_many_blocks_and_other_columns(spark):
    conf = "spark.sql.shuffle.partitions"
    before = spark.conf.get(conf)
    try:
        spark.conf.set(conf, "23")
        pairs = planted()
        docs = frame(spark, pairs).withColumnsRenamed({"lang": "places", "source": "key", "n_chars": "spans"})
        assert shown(remove_earlier(docs)) == plain(pairs)
    finally:
        spark.conf.set(conf, before)
    assert remove_earlier(frame(spark, [])).collect() == []


def test_long_texts(spark):
    rng = random.Random(7)
    long = "".join(rng.choice("abcdefgh \n") for _ in range(700_000))
    pairs = [(1, long), (2, "x" + long[300_000:300_400]), (3, " " * 1_000_000), (4, " " * 60), (5, long[:80] * 3)]
    got = {r.doc_id: (r.n_removed, len(r.spans)) for r in remove_earlier(frame(spark, pairs)).collect()}
    assert got[1] == (0, 0) and got[2] == (400, 1) and got[3] == (0, 0) and got[4] == (60, 1)
    assert got[5][0] == 240


def test_equal_windows_have_equal_anchors():
    """Over the edges of segments, too: all equal windows lie in stretches of one anchor string."""
    rng = random.Random(2)
    text = "".join(rng.choice("ab ") for _ in range(3000)).encode()
    whole = anchors(np.frombuffer(text, np.uint8), np.array([1000, 1000, 3000]), 50)
    before, bwt_dedup._SEGMENT = bwt_dedup._SEGMENT, 100
    try:
        parts = anchors(np.frombuffer(text, np.uint8), np.array([1000, 1000, 3000]), 50)
    finally:
        bwt_dedup._SEGMENT = before
    for a, b in zip(whole, parts):
        assert a.tolist() == b.tolist()
    seen = {}
    for first, last, place, _ in zip(*(x.tolist() for x in whole)):
        for at in range(first, last + 1):
            assert at <= place <= at + 34 and (at + 50 <= 1000 or at >= 1000)
            assert seen.setdefault(text[at:at + 50], place - at) == place - at


def test_merged_transforms_are_the_order_of_all_strings():
    """The interleave comes from the transforms alone and equals a sort of all strings."""
    rng = random.Random(3)
    strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 24))) for _ in range(400)]
    flat = np.frombuffer(b"".join(strings), np.uint8)
    sizes = np.array([len(s) for s in strings])
    table = symbols(flat, np.cumsum(sizes) - sizes, sizes, 24)
    edges = np.array([0, 150, 151, 151, 400])
    order, common = merged(table, edges)
    padded = [s.ljust(24, b"\0") for s in strings]
    assert order.tolist() == sorted(range(400), key=lambda i: (padded[i], i))
    for place in range(1, 400):
        a, b = padded[order[place - 1]], padded[order[place]]
        equal = next((k for k in range(24) if a[k] != b[k]), 24)
        assert common[place] == equal
    source = interleaved([transform(table[a:b])[0] for a, b in zip(edges, edges[1:])])
    assert source.tolist() == (np.searchsorted(edges, order, side="right") - 1).tolist()
