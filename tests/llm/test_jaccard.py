import random
from collections import Counter, defaultdict

import pytest
from texts import AWKWARD, LOWER, frame, prose, shown, words

from starload.llm import jaccard
from starload.llm.components import components
from starload.llm.jaccard import jaccard_join


def sets_of(pairs):
    out = []
    for _, text in pairs:
        w = words((text or "").translate(LOWER))
        out.append(frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    return out


def plain(pairs):
    sets, root = sets_of(pairs), list(range(len(pairs)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    lists = defaultdict(list)
    for j, s in enumerate(sets):
        if pairs[j][0] is None:
            continue
        for k, n in Counter(k for x in s for k in lists[x]).items():
            if 100 * n >= 75 * (len(s) + len(sets[k]) - n):
                root[top(j)] = top(k)
        for x in s:
            lists[x].append(j)
    # Texts of one document are linked as that document.
    first = {}
    for j, (key, _) in enumerate(pairs):
        if key is not None and sets[j]:
            root[top(j)] = top(first.setdefault(key, j))
    least = defaultdict(list)
    for j, (key, _) in enumerate(pairs):
        least[top(j)].append(key)
    return shown((key, len(sets[j]), None if key is None else min(least[top(j)]))
                 for j, (key, _) in enumerate(pairs))


def planted():
    rng = random.Random(7)
    base = [t.split() for t in prose(3, 14, longest=110) if t]
    pairs = AWKWARD + [(10, "a b"), (11, "A  B"), (12, "a b c d e"), (13, "a b c d e f"), (14, "A B C D E")]
    for i in range(250):
        w = list(rng.choice(base))
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = f"new{rng.randrange(500)}"
        pairs.append((100 + i, " ".join(w)))
    passage = " ".join(base[0][:9])
    return pairs + [(600 + i, f"{t} {passage}") for i, t in enumerate(prose(8, 30, longest=30))]


@pytest.mark.parametrize("side, short", [(1536, 128), (20, 4)])
def test_equals_all_overlaps(spark, monkeypatch, side, short):
    monkeypatch.setattr(jaccard, "SIDE", side)
    monkeypatch.setattr(jaccard, "SHORT_LIST", short)
    monkeypatch.setattr(jaccard, "FREQUENT", 40)
    monkeypatch.setattr(jaccard, "COLUMNS", 64)
    assert shown(jaccard_join(frame(spark, planted())).collect()) == plain(planted())


def test_the_bound_is_met_exactly(spark):
    """Nine common of twelve united shingles link, and the next smaller share does not."""
    common = [f"c{i}" for i in range(13)]
    pairs = [(1, " ".join([*common, "x"])), (2, " ".join([*common, "y", "z"])),
             (3, " ".join([f"d{i}" for i in range(12)] + ["x"])),
             (4, " ".join([f"d{i}" for i in range(12)] + ["y", "z"]))]
    got = {r.doc_id: r.component_id for r in jaccard_join(frame(spark, pairs)).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4}


@pytest.mark.parametrize("seed", range(4))
def test_an_id_with_several_texts(spark, seed):
    """Links go through every text of an id, whatever the order of rows."""
    a, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "ac")
    pairs = [(3, a), (6, a), (6, c), (20, a + " extra"), (21, c + " tail"), (30, "alone with six words of mine"),
             (30, c[:-4]), (6, None)]
    random.Random(seed).shuffle(pairs)
    docs = frame(spark, pairs, 1 + seed).withColumnsRenamed({"lang": "class", "source": "doc", "n_chars": "a"})
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join(docs).collect()}
    assert {(k, c) for k, n, c in got if n} == {(3, 3), (6, 3), (20, 3), (21, 3), (30, 3)}
    assert (6, 0, 6) in got


def test_empty_table(spark):
    assert jaccard_join(frame(spark, [])).collect() == []


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(50)] + [(7, 7), (299, 300)]
    links += [(300, 299), (250, 301)]
    got = {r.node: r.component for r in components(
        spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 0 for i in range(41)} | {n: 100 for n in [100, *range(200, 250)]}
    want |= {299: 299, 300: 299, 250: 250, 301: 250}
    assert got == want
