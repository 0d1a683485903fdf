import random
from collections import Counter

import numpy as np
import pytest
from texts import AWKWARD, LOWER, frame, prose, shown, words

from starload.llm import common
from starload.llm.common import WordHashes
from starload.llm.substrings import open_windows, recompressed, remove_repeats


def plain(pairs, window):
    texts = [words(t) for _, t in pairs]
    times = Counter(tuple(w[i:i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for (key, _), w in zip(pairs, texts):
        gone = set()
        for i in range(len(w) - window + 1):
            if times[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((key, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return shown(out)


def planted():
    rng = random.Random(5)
    passage = prose(9, 1, longest=70)[0].split() + ["end"] * 3
    pairs = list(AWKWARD) + [
        (20, " ".join(["x"] * 34)), (21, " ".join(["z"] * 35)), (22, " ".join(["y"] * 36)),
        (23, " ".join(["x", "y"] * 60)), (24, " ".join(["p", "q", "r"] * 25))]
    for i, text in enumerate(prose(2, 70, longest=220)):
        w = text.split()
        if rng.random() < 0.5:
            at, first = rng.randint(0, len(w)), rng.randint(0, 20)
            w[at:at] = passage[first:first + rng.choice([20, 34, 35, 36, 50])]
        pairs.append((100 + i, " ".join(w)))
    return pairs + [(500, pairs[-1][1]), (501, pairs[-1][1]), (None, pairs[-3][1])]


@pytest.mark.parametrize("window", [35, 6])
def test_equals_a_count_of_all_windows(spark, window):
    pairs = planted()
    got = remove_repeats(frame(spark, pairs), window)
    assert shown(got.select("doc_id", "dedup_words", "dedup_removed", "dedup_text").collect()) == plain(
        pairs, window)
    for r in got.collect():
        assert sum(s.end - s.first for s in r.dedup_spans) == r.dedup_removed


def test_settled_symbols_come_with_every_copy():
    """Where all words that settle a symbol occur, so does the symbol."""
    rng = random.Random(1)
    for _ in range(60):
        core = [rng.choice("abc") for _ in range(40)]
        texts = [[rng.choice("abc") for _ in range(rng.randint(0, 9))] for _ in range(4)]
        flat = texts[0] + core + texts[1] + texts[2] + core + texts[3]
        starts = np.array([0, len(texts[0]) + 40 + len(texts[1]), len(flat)])
        hashes, _ = WordHashes()([" ".join(flat).encode()])
        s = recompressed(hashes, starts)
        first, second = len(texts[0]), int(starts[1]) + len(texts[2])
        sets = []
        for at in (first, second):
            inside = (s.low >= at) & (s.high <= at + 40)
            sets.append({(n, lo - at) for n, lo in zip(s.name[inside].tolist(), s.low[inside].tolist())})
        assert sets[0] == sets[1]


def test_no_window_is_lost_when_all_symbols_are_shared():
    starts = np.array([0, 50, 60])
    hashes, _ = WordHashes()([" ".join(map(str, range(60))).encode()])
    s = recompressed(hashes, starts)
    assert open_windows(s, np.zeros(len(s.name), bool), starts, 35).tolist() == list(range(16))


def test_empty_table(spark):
    assert remove_repeats(frame(spark, [])).collect() == []
    assert remove_repeats(frame(spark, [(1, None)])).collect()[0].dedup_text == ""


def test_word_hashes(monkeypatch):
    texts = [(t or "").encode() for _, t in planted()] + ["A\u00a0b\u2003c x".encode(), b"", b"end"]
    whole, starts = WordHashes()(texts)
    assert np.diff(starts).tolist() == [len(words(t.decode())) for t in texts]
    flat = [w for t in texts for w in words(t.decode())]
    assert len(set(whole.tolist())) == len(set(flat)) == len(set(zip(flat, whole.tolist())))
    lower, _ = WordHashes(lower=True)(texts)
    assert len(set(lower.tolist())) == len({w.translate(LOWER) for w in flat})
    monkeypatch.setattr(common, "_SEGMENT", 7)
    cut, cut_starts = WordHashes()(texts)
    assert cut.tolist() == whole.tolist() and cut_starts.tolist() == starts.tolist()
