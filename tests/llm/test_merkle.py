"""Merkle manifest against a plain tree in memory."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from aeroloom.llm import merkle, queries
from tests.llm.conftest import SF

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    values = [*(None if v is None else str(v) for v in row[:4]), text]
    return h("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def lower(text):
    return text if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def proofs_of(nodes):
    """Root of a list of digests, and for each the list of (siblings before, siblings after)."""
    paths, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(place):
            run = nodes[p // 16 * 16:p // 16 * 16 + 16]
            paths[i].append((run[:p % 16], run[p % 16 + 1:]))
        place = [p // 16 for p in place]
        nodes = [h("".join(nodes[i:i + 16])) for i in range(0, len(nodes), 16)]
    return nodes[0], paths


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text) -> sorted results of the contract."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    subtrees = {}
    for s in order:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
        subtrees[s] = proofs_of([leaf(r, r[4]) for r in groups[s]])
    if not order:
        return []
    root, above = proofs_of([subtrees[s][0] for s in order])
    out = []
    for s, outer in zip(order, above):
        for r, inner in zip(groups[s], subtrees[s][1]):
            path = inner + outer
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            folded = leaf(r, lower(r[4]) if tampered else r[4])
            for before, after in path:
                folded = h("".join([*before, folded, *after]))
            proof = ["".join([*b, *a]) for b, a in path]
            out.append((r[0], leaf(r, r[4]), subtrees[s][0], root, h("".join(proof)), folded, folded == root, proof))
    return sorted(out, key=str)


def got(frame, proofs=True):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = merkle.manifest(frame, COLUMNS, seen={"text": lowered}, when=tampered, proofs=proofs)
    return sorted((tuple(r) for r in out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "proof").collect()), key=str)


def test_hot_source_odd_rows_and_ties(spark):
    """One source of three superblocks (one leaf over two), a lone leaf, a run of 17, nulls everywhere, repeated rows."""
    rows = [(i, "hot", "en", i, f"Text {i} É") for i in range(2 * merkle.BLOCK + 1)]
    rows += [(1000 + i, "b", None, None, "Ab" * i) for i in range(17)] + [(2000, "", "x", 5, ""), (2001, None, None, None, None), (2002, None, "EN", 3, "Q\U0001f389퟿")]
    rows += [(None, "b", None, None, "No id"), (None, "b", None, None, "No id"), (1003, "b", None, None, "other"), (3000, "é", "y", 1, "Long " * 50_000)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    clash = frame.withColumns({c: F.lit("clash") for c in ("tree", "pos", "hash", "seen", "root", "seq", "total", "id")})
    assert got(clash.repartition(3)) == brute(rows)


@pytest.mark.parametrize("n_sources", [1, 16, 17, 300])
def test_many_sources(spark, n_sources):
    rows = [(i, f"s{i % n_sources}", "en", i, "Some Text") for i in range(max(n_sources, 40))]
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert got(frame) == brute(rows)


def test_one_row_and_none(spark):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    one = [(7, "s", None, 1, "A")]
    assert got(spark.createDataFrame(one, schema)) == brute(one)
    assert got(spark.createDataFrame([], schema)) == []


def test_query(spark, given):
    rows = [tuple(r[c] for c in COLUMNS) for r in given("documents")]
    want = [r[:-1] for r in brute(rows)]
    assert sorted((tuple(r) for r in queries.op12_merkle(spark, SF).collect()), key=str) == sorted(want, key=str)
    assert any(r[6] for r in want) and not all(r[6] for r in want)
