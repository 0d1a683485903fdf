import random
import zlib

import pytest
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from texts import everything, frame
from tokenizers import Tokenizer as Library

from starload.llm.packing import best_fit, dominant_sets, pack_documents, pieces, plan
from starload.llm.tokens import Tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")


def sequences(rows):
    found = {}
    for length, first, end, each, sequence, offset in rows:
        for rank in range(first, end):
            at = rank - first
            found.setdefault(sequence + at // each, []).append((offset + at % each * length, length))
    return found


def gapless(parts, capacity):
    at = 0
    for offset, length in sorted(parts):
        assert offset == at
        at += length
    assert at <= capacity


def one_by_one(counts, capacity):
    room = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fits = [i for i, r in enumerate(room) if r >= length]
            if fits:
                room[min(fits, key=lambda i: room[i])] -= length
            else:
                room.append(capacity - length)
    return len(room)


def fewest(items, capacity):
    """Exact, by trying: items, longest first, into each different room or a new sequence."""
    best = len(items)

    def put(left, room):
        nonlocal best
        if len(room) >= best:
            return
        if not left:
            best = len(room)
            return
        for r in {x for x in room if x >= left[0]}:
            i = room.index(r)
            put(left[1:], room[:i] + [r - left[0]] + room[i + 1:])
        put(left[1:], [*room, capacity - left[0]])

    put(sorted(items, reverse=True), [])
    return best


@settings(max_examples=120, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=60))
def test_every_item_has_one_place(items):
    counts = {k: items.count(k) for k in set(items)}
    rows = plan(counts, 30)
    placed = sequences(rows)
    assert sorted(l for s in placed.values() for _, l in s) == sorted(items)
    for parts in placed.values():
        gapless(parts, 30)
    assert sum(n for n, _ in best_fit(counts, 30)) == one_by_one(counts, 30)
    assert len(placed) <= one_by_one(counts, 30)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=9))
def test_fixed_sets_cost_no_sequence(items):
    counts = {k: items.count(k) for k in set(items)}
    fixed, left = dominant_sets(counts, 20)
    rest = [k for k, n in left.items() for _ in range(n)]
    assert sum(n for n, _ in fixed) + fewest(rest, 20) == fewest(items, 20)


def test_ids_are_those_of_the_library():
    library, mine = Library.from_file(PATH), Tokenizer(PATH)
    for _, text in everything():
        assert library.encode(text or "", add_special_tokens=False).ids == mine(text or "").tolist()


def test_whole_documents_come_back(spark):
    docs = frame(spark, everything())
    library = Library.from_file(PATH)
    placed = pack_documents(docs, PATH, capacity=256).collect()
    by_sequence, by_doc = {}, {}
    for r in placed:
        assert len(r.ids) == r.length
        assert r.ids_crc32 == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in r.ids))
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append((r.piece, r.start, r.ids))
    for parts in by_sequence.values():
        gapless(parts, 256)
    for key, text in everything():
        if key == 6:
            continue
        want = library.encode(text or "", add_special_tokens=False).ids + [2]
        parts = sorted(by_doc[key])
        assert [p for p, _, _ in parts] == list(range(len(parts)))
        assert sum((ids for _, _, ids in parts), []) == want
        assert all(len(ids) == 256 for _, _, ids in parts[1:])
    assert len(by_doc[6]) == 3
    total = sum(r.length for r in placed)
    assert -(-total // 256) <= len(by_sequence) <= -(-total // 256) * 1.1 + 1


def test_empty_table(spark):
    assert pack_documents(frame(spark, []), PATH).collect() == []
    assert "ids" not in pieces(frame(spark, []), PATH, with_ids=False).columns


@pytest.mark.parametrize("seed", range(3))
def test_many_lengths_stay_near_the_bound(seed):
    rng = random.Random(seed)
    counts = {k: rng.randint(1, 300) for k in range(1, 1025)}
    used = sum(each[0] for each in [*dominant_sets(counts, 1024)[0], *best_fit(dominant_sets(counts, 1024)[1], 1024)])
    assert used <= sum(k * n for k, n in counts.items()) / 1024 * 1.02


@pytest.mark.parametrize("text", [
    " " * 1_000_000, "a" + "\n" * 1_000_000 + "b c", " " * 20_001 + "<|endoftext|> x", " " * 20_000 + "'s",
    "x" + " \n" * 20_000 + " é" + " " * 20_000 + "z", "q" * 300_000, " " * 15_000 + "\x1c" + "\t" * 15_000 + "!",
])
def test_long_runs_have_the_ids_of_the_library(text):
    want = Library.from_file(PATH).encode(text, add_special_tokens=False).ids
    assert Tokenizer(PATH)(text).tolist() == want


def test_a_long_run_is_packed(spark):
    packed = pack_documents(frame(spark, [(1, " " * 1_000_000), (2, "word")]), PATH, with_ids=False).collect()
    assert sum(r.length for r in packed if r.doc_id == 1) == 1_000_001
    assert max(r.length for r in packed) <= 1024
