"""Prefix trie of conversations against a plain dictionary of sequences."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quarry.llm import prefix_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute_rebuilt(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", hashlib.sha256(f"{len(r or '')}:{r or ''}{x or ''}".encode()).hexdigest(), x or ""))
    own = {c: [(v[2], v[4]) for v in sorted(rows)] for c, rows in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - int(c % 100 if c >= 0 else -(-c % 100)), [])[:h] + turns[h:]
    return out


def brute_trie(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(set)
    for p in members:
        if p:
            kids[p[:-1]].add(p)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, who in members.items():
        gain = (len(who) - 1) * len(p[-1][1]) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += gain
    out = set()
    for p, who in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in who if len(convs[c]) == len(p)))
        out.add((min(who), len(p), min(members[p[:-1]]) if p else None, len(who), len(kids[p]) if p in kids else 0, leaves[p], saved[p],
                 hashlib.sha256(ends.encode()).hexdigest()))
    return out


def found(spark, rows, segment=trie.SEGMENT, **limits):
    df = rows if not isinstance(rows, list) else spark.createDataFrame(rows, SCHEMA)
    out = [tuple(r) for r in trie.prefix_trie(trie.rebuild(trie.numbered_turns(df, **limits)), segment).collect()]
    assert len(out) == len(set(out))
    return set(out)


def test_tree_keeps_keys_of_every_layout():
    rng = random.Random(5)
    keys = {bytes(rng.choices(range(n), k=2 * rng.randrange(5))) for n in (2, 9, 40, 256) for _ in range(700)}
    tree = trie.AdaptiveRadixTree()
    order = sorted(keys)
    for k in rng.sample(order, len(order)):
        tree.insert(k, k)
    kinds, todo = set(), [tree.root]
    while todo:
        node = todo.pop()
        kinds.add(type(node).__name__)
        todo.extend(kid for _, kid in node.children())
    assert kinds == {"Node4", "Node16", "Node48", "Node256"}
    first, last, depth, above = (x.tolist() for x in tree.nodes(2))
    got = {(order[a][:2 * d], b - a, order[first[u]][:2 * depth[u]] if u >= 0 else None)
           for a, b, d, u in zip(first, last, depth, above, strict=True)}
    want = {k[:2 * d] for k in keys for d in range(len(k) // 2 + 1)}
    assert got == {(p, sum(k.startswith(p) for k in keys), p[:-2] if p else None) for p in want}


def test_matches_brute_force_on_the_fixture(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(spark, rows) == brute_trie(brute_rebuilt(rows))


@pytest.fixture(scope="module")
def tangle():
    """Few distinct turns, so that prefixes are shared deeply; one conversation
    and one group of copies hold a third of the rows each."""
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["user", "bot"]), rng.choice(["a", "bé", ""])) for c in range(-230, 430, 3) for t in range(rng.randrange(1, 14))]
    rows += [(c, t, "user", "copy" * (t % 3)) for c in range(1000, 1300) for t in range(7)]
    return rows + [(5_000_000_000, t, "user", "long") for t in range(900)]


def test_blocks_and_segments_do_not_change_the_nodes(spark, tangle, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK_KEYS", 7)
    short = [r for r in tangle if r[1] < 6]
    assert found(spark, short, 2) == brute_trie(brute_rebuilt(short))


def test_large_conversation_is_ranked_by_range_sort(spark, tangle):
    assert found(spark, tangle, window_rows=50) == brute_trie(brute_rebuilt(tangle))


def test_edge_rows(spark):
    rows = [(1, None, None, None), (1, 3, "user", ""), (1, 3, "user", ""), (1, 3, "bot", "z"), (2, 1, "", None), (2, None, "x" * 3, "y" * 200_000),
            (None, 1, "user", "lost"), (200, 1, "user", "a"), (203, None, None, "own"), (7, 9, "1:", "a"), (8, 9, "1", ":a"), (100, 0, "user", " é")]
    want = brute_trie(brute_rebuilt(rows))
    assert found(spark, rows) == want
    names = ["id", "pos", "chars", "tree", "key", "next", "n", "low", "part", "up", "lcp"]
    wide = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit("z").alias(c) for c in names])
    assert found(spark, wide) == want
    assert found(spark, spark.createDataFrame([], SCHEMA)) == set()
