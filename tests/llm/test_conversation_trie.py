"""Conversation trie, list ranking and segmented scans against plain Python forms."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from lakegov.llm import conversation_trie as T
from lakegov.llm.list_rank import rank
from lakegov.llm.scan import segmented_scan

SCHEMA = "conv_id long, turn long, role string, text string, n_convs string, c string"


def plain_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, x) for *_, r, x in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c in sorted(rebuilt):
        for d in range(len(rebuilt[c]) + 1):
            members[tuple(rebuilt[c][:d])].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p in members:
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
    return sorted(
        (m[0], len(p), members[p[:-1]][0] if p else None, len(m), children[p], leaves[p], saved[p],
         hashlib.sha256(",".join(str(c) for c in m if len(rebuilt[c]) == len(p)).encode()).hexdigest())
        for p, m in members.items())


def found(df):
    return sorted((tuple(r)[:8] for r in df.collect()), key=lambda r: r[:2])


@pytest.mark.parametrize("sizes", [{}, {"per_task": 37, "rank_rows": 120}])
def test_trie_of_random_conversations(spark, sizes):
    rnd = random.Random(5)
    says = [f"line {i}" for i in range(3)]
    rows = [(c, t, rnd.choice(["user", "assistant"]), rnd.choice(says), "x", "y")
            for c in (*range(0, 130), 205, 999, 1000) for t in range(rnd.randint(1, 7))]
    got = found(T.conversation_trie(spark.createDataFrame(rows, SCHEMA), **sizes))
    assert got == plain_trie(rows)


def test_trie_odd_rows(spark):
    rows = [
        (0, None, "system", None, "a", "b"), (0, 5, None, "", "a", "b"), (0, 2, "user", "é€𝄞" * 40_000, None, None),
        (1, 0, "user", "same", None, None), (2, 0, "user", "same", None, None), (3, 0, "user", "same", None, None),
        (4, 1, "user", "one turn only", None, None), (None, 0, "user", "belongs to none", None, None),
        (150, 1, "user", "base is absent", None, None), (150, -3, "user", "first", None, None),
        *[(7, i, "user", "hot", None, None) for i in range(600)], (7, None, "user", "before", None, None),
        (9, 3, "user", "repeated", None, None), (9, 3, "user", "repeated", None, None),
    ]
    got = found(T.conversation_trie(spark.createDataFrame(rows, SCHEMA), per_task=100, rank_rows=50))
    assert got == plain_trie(rows)


def test_trie_many_copies_of_one_conversation(spark):
    rows = [(c, t, "user", f"turn {t}", None, None) for c in range(100, 5300) for t in range(2)]
    got = found(T.conversation_trie(spark.createDataFrame(rows, SCHEMA), per_task=900, rank_rows=300))
    assert got == plain_trie(rows)


def test_trie_empty(spark):
    out = T.conversation_trie(spark.createDataFrame([], SCHEMA))
    assert out.count() == 0 and out.columns[:8] == [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def test_tour_positions_are_a_nesting(spark):
    rows = [(c, t, "user", f"{(c * 7 + t) % 3}", None, None) for c in range(40) for t in range(4)]
    got = [r.asDict() for r in T.conversation_trie(spark.createDataFrame(rows, SCHEMA), rank_rows=20).collect()]
    places = sorted([r["enter_at"] for r in got])
    assert places[0] == 0 and len(set(places)) == len(places)
    by = {(r["conv_id"], r["depth"]): r for r in got}
    for r in got:
        if r["depth"]:
            up = by[(r["parent_conv_id"], r["depth"] - 1)]
            assert up["enter_at"] < r["enter_at"] <= r["exit_at"] <= up["exit_at"]


@pytest.mark.parametrize("rows", [300, 5000])
def test_rank_of_a_scattered_list(spark, rows):
    """Neighbours in the list are far apart by id, so contraction needs random mates."""
    n = 1500
    order = list(range(n))
    random.Random(3).shuffle(order)
    cells = [(order[i], 2, order[i + 1] if i + 1 < n else None, 2 if i + 1 < n else None, i % 5) for i in range(n)]
    got = {r["c"]: r["w"] for r in rank(spark.createDataFrame(cells, "c long, k long, nc long, nk long, w long"), ["w"], rows).collect()}
    want, total = {}, 0
    for c, *_, w in cells:
        want[c] = total
        total += w
    assert got == want


def test_scan_of_one_segment_over_many_tasks(spark):
    rows = [(0, i, 1 << 62, i * 3) for i in range(500)] + [(s, i, s, i) for s in (1, 2) for i in range(30)]
    df = spark.createDataFrame(rows, "k long, o long, v long, x long")
    got = sorted(tuple(r) for r in segmented_scan(df, ["k"], ["o"], {"s": "v"}, ("nx", "x"), per_task=40)
                 .select("k", "o", "s", "nx").collect())
    want = []
    for k, size in ((0, 500), (1, 30), (2, 30)):
        total = 0
        own = [r for r in rows if r[0] == k]
        for i, (_, o, v, _x) in enumerate(own):
            total = (total + v) % (1 << 64)
            want.append((k, o, total - (1 << 64) if total >= 1 << 63 else total, own[i + 1][3] if i + 1 < size else None))
    assert got == sorted(want)
