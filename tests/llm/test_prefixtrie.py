"""Z-fast trie against a plain trie in memory."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from aeroloom.llm import prefixtrie as P, queries
from tests.llm.conftest import SF

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows, heads=lambda c: zlib.crc32(str(c).encode()) % 4):
    """Nodes of the contract, from (conv_id, turn, role, text) rows without ties in turn that differ in text."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in own.items()}
    built = {c: own.get(c - c % 20, [])[:heads(c)] + own[c][heads(c):] for c in own}
    members = defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[tuple(built[c][:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        words = len(re.findall("[^\x20\x09-\x0d]+", node[-1][1])) if node else 0
        saved[node] = (len(members[node]) - 1) * words + sum(saved[k] for k in children[node])
    out = []
    for node, ids in members.items():
        ends = ",".join(str(c) for c in ids if len(built[c]) == len(node))
        out.append((ids[0], len(node), members[node[:-1]][0] if node else None, len(ids), len(children[node]), leaves[node], saved[node],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()), key=str)


def test_fattest(spark):
    pairs = [(a, b) for a in range(0, 70) for b in range(a + 1, 71)]
    rows = spark.createDataFrame(pairs, "lo int, hi int").withColumn("f", P.fattest("lo", "hi")).collect()
    for r in rows:
        assert r.f == max(range(r.lo + 1, r.hi + 1), key=lambda n: n & -n)


@pytest.mark.parametrize("chunk", [3, 1024])
def test_shared_heads_copies_and_odd_rows(spark, monkeypatch, chunk):
    """Families, a third of all conversations with one first turn, copies, nulls, repeated rows, one long conversation."""
    monkeypatch.setattr(P, "CHUNK", chunk)
    monkeypatch.setattr(P, "BLOCK", 8)
    draw, rows = random.Random(4), []
    for c in range(120):
        for t in range(draw.randrange(1, 9)):
            common = c % 3 == 0 and t < 2
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", "the same opening" if common else f"w{draw.randrange(3)} " * draw.randrange(1, 4)))
    for c in range(400, 420):  # copies
        rows += [(c, t, "user", f"copy {t}") for t in range(5)]
    for c in range(600, 640):  # prefixes of one long conversation
        rows += [(c, t, "user", f"step {t} of many") for t in range(70 if c == 620 else draw.randrange(1, 60))]
    rows += [(700, None, None, None), (700, None, "user", "first"), (700, 3, "a", "x"), (700, 3, "a", "x"), (701, 0, "user", ""), (702, 0, "user", " \t\n"), (703, 5, None, "one"),
             (721, 0, "user", "no base"), (722, 0, "user", "no base"), (741, 9, "é", "漢 字 🎉"), (None, 0, "user", "no id"), (760, 0, "user", "long " * 30000)]
    draw.shuffle(rows)
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in ("conv", "depth", "words", "t", "base")})
    assert got(P.prefix_trie(frame)) == brute(rows)
    assert got(P.prefix_trie(frame, heads=F.lit(0))) == brute(rows, heads=lambda c: 0)


def test_turnless_conversations_alone(spark):
    """Conversations that lose all their turns and find no base: one root."""
    c = next(i for i in range(21, 500) if i % 20 and zlib.crc32(str(i).encode()) % 4 >= 2)
    rows = [(c, 0, "user", "gone"), (c, 1, "user", "gone too")]
    assert got(P.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    assert P.prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []


def test_search_agrees_with_comparison(spark):
    """Every string's exit from a trie of the others is the longest prefix that it shares with any of them."""
    draw = random.Random(9)
    strings = sorted({tuple(draw.randrange(2) for _ in range(draw.randrange(1, 20))) for _ in range(60)})
    paths = spark.createDataFrame([(i, d + 1, hash(s[:d + 1]) & 0xFFFFFFFF, d) for i, s in enumerate(strings) for d in range(len(s))], "conv long, depth int, x long, y long")
    lengths = spark.createDataFrame([(i, len(s)) for i, s in enumerate(strings)], "t long, length int")
    trie = P.Trie(paths)
    trie.build(lengths.where("t % 2 = 0"))
    exits = {r.t: r.g for r in trie.exits(lengths.where("t % 2 = 1").withColumn("a", F.lit(0))).collect()}
    for t, g in exits.items():
        shared = max(next((k for k, (p, q) in enumerate(zip(strings[t], s)) if p != q), min(len(strings[t]), len(s))) for s in strings[::2])
        assert g == shared


def test_query(spark, given):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in given("conversations")]
    assert got(queries.op11_prefixtrie(spark, SF)) == brute(rows)
