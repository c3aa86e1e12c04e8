"""PartEnum join against all pairs, on given and made texts."""

import random
import re

import numpy as np
import pytest

from aeroloom.llm import links, queries, setjoin
from tests.llm.conftest import SF

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_set(text, size):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    if not words:
        return set()
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))}


def brute(rows, size, p, q):
    """(doc_id, n, component) of every row by comparing all pairs; one node per doc_id."""
    sets = [plain_set(t, size) for _, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None and q * min(len(a), len(b)) >= p * max(len(a), len(b)):
                if q * len(a & b) >= p * len(a | b):
                    x, y = find(rows[i][0]), find(rows[j][0])
                    parent[max(x, y)] = min(x, y)
    return sorted(((i, len(s), None if i is None else find(i)) for (i, _), s in zip(rows, sets)), key=str)


def same(df, rows, size, p, q):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)
    assert got == brute(rows, size, p, q)


def edited(draw, words, edits):
    words = list(words)
    for _ in range(edits):
        words[draw.randrange(len(words))] = f"new{draw.randrange(10 ** 6)}"
    return " ".join(words)


def test_query(spark, given):
    same(queries.op9_similar(spark, SF), [(r.doc_id, r.text) for r in given("documents")], 4, 17, 20)


@pytest.mark.parametrize("size,p,q", [(4, 17, 20), (5, 4, 5)])
def test_groups_of_near_copies(spark, docs_of, size, p, q, monkeypatch):
    """Copies, chains of near copies, near misses and odd rows; several blocks per group."""
    monkeypatch.setattr(setjoin, "BLOCK", 5)
    draw, rows = random.Random(3), []
    for length, copies, edits in ((8, 10, 1), (40, 25, 1), (60, 25, 2), (200, 20, 3), (300, 12, 9), (25, 30, 1)):
        words = [f"w{draw.randrange(10 ** 6)}" for _ in range(length)]
        rows += [(0, edited(draw, words, draw.randint(0, edits))) for _ in range(copies)]
        text = words
        for _ in range(6):  # a chain: each is like the one before
            text = edited(draw, text, 1).split()
            rows.append((0, " ".join(text)))
        rows.append((0, " ".join(words + [f"x{draw.random()}" for _ in range(length // 6)])))
    draw.shuffle(rows)
    rows = [(3 * i, t) for i, (_, t) in enumerate(rows)]
    rows += [(7000, None), (7001, ""), (7002, " \n"), (7003, "Two words"), (7004, "two WORDS"), (7005, "É a b c d"), (7006, "é a b c d"), (None, "Two words"),
             (7007, rows[5][1]), (7007, rows[40][1]), (7008, "w " * 3000), (7009, "w w w w w")]
    same(setjoin.similar_classes(docs_of(rows), size, (p, q)), rows, size, p, q)


def test_no_documents(spark, docs_of):
    assert setjoin.similar_classes(docs_of([])).collect() == []
    same(setjoin.similar_classes(docs_of([(1, None), (2, "")])), [(1, None), (2, "")], 5, 4, 5)


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(5)
    for p, q in ((17, 20), (4, 5)):
        where = setjoin.Bands((p, q))
        for _ in range(1500):
            n = int(rng.integers(1, 300)) if rng.random() < 0.8 else int(rng.integers(300, 3000))
            base = rng.integers(0, 2 ** 63, n).astype(np.uint64)
            drop, add = rng.integers(0, n // 8 + 1), rng.integers(0, n // 8 + 2)
            other = np.concatenate([base[drop:], rng.integers(0, 2 ** 63, add).astype(np.uint64)])
            a, b = np.unique(base), np.unique(other)
            if len(b) and setjoin.linked(a, b, (p, q)):
                assert len(np.intersect1d(setjoin.signatures(a, where), setjoin.signatures(b, where)))


def test_linked_is_exact():
    rng = np.random.default_rng(6)
    for _ in range(2000):
        a, b = (np.unique(rng.integers(0, 150, rng.integers(1, 140)).astype(np.uint64)) for _ in range(2))
        if rng.random() < 0.6:
            b = np.unique(np.concatenate([a[rng.integers(0, 9):], b[:rng.integers(0, 9)]]))
        x, y = set(a.tolist()), set(b.tolist())
        assert setjoin.linked(a, b, (17, 20)) == (bool(x and y) and 20 * len(x & y) >= 17 * len(x | y))


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(500, 400), (5, 5)]
    got = {r.node: r.root for r in setjoin.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got.get(i, i) == 0 for i in range(41)) and all(got.get(i, i) == 100 for i in range(100, 130)) and got[500] == 400


def test_sums_bound_the_difference():
    """Sets differ in at least as many elements as partition sums."""
    rng = np.random.default_rng(8)
    for _ in range(300):
        a = np.unique(rng.integers(0, 2 ** 63, rng.integers(1, 400)).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.integers(0, len(a)):], rng.integers(0, 2 ** 63, rng.integers(0, 400)).astype(np.uint64)]))
        n = int(rng.integers(1, 200))
        if len(b):
            assert (setjoin.partition_sums(a, n) != setjoin.partition_sums(b, n)).sum() <= len(np.setxor1d(a, b))


def test_short_forms_never_miss_a_common_element():
    rng = np.random.default_rng(10)
    for n, m in ((5, 6), (200, 240), (250, 260), (300, 300), (2000, 2300), (65_000, 66_000), (70_000, 70_000)):
        base = np.unique(rng.integers(0, 2 ** 63, n + m).astype(np.uint64))
        a, b = np.sort(rng.choice(base, n, replace=False)), np.sort(rng.choice(base, m, replace=False))
        common = len(np.intersect1d(a, b))
        whole = links.common_of_short(*(links.read_form(x.tobytes(), False) for x in (a, b)), len(a), len(b))
        short = links.common_of_short(*(links.read_form(links.short_form(x), True) for x in (a, b)), len(a), len(b))
        assert whole == common <= short <= common + 0.02 * n + 2


@pytest.mark.parametrize("few", [0, 2])
def test_cells_with_many_partners_take_sets(docs_of, monkeypatch, few):
    monkeypatch.setattr(links, "FEW", few)
    monkeypatch.setattr(setjoin, "STARS", 1 << 40)
    draw, rows = random.Random(11), []
    for _ in range(3):
        base = [f"w{draw.randrange(50000)}" for _ in range(70)]
        rows += [(len(rows) + i, edited(draw, base, i % 5)) for i in range(30)]
    same(setjoin.similar_classes(docs_of(rows)), rows, 5, 4, 5)


def test_a_pair_of_several_bands_is_compared_in_one(docs_of, monkeypatch):
    """Sets near the edge of two bands share signatures in both; the sketches of either can rule the pair out."""
    draw, seen, before = random.Random(3), [], setjoin._possible
    rows = []
    for i in range(40):
        words = [f"w{i}-{k}" for k in range(draw.randrange(40, 160))]
        rows += [(3 * i + k, edited(draw, words, k)) for k in range(3)]

    def possible(pairs, held, threshold):
        seen.append([(r.a, r.b) for r in pairs.collect()])
        return before(pairs, held, threshold)

    monkeypatch.setattr(setjoin, "_possible", possible)
    same(setjoin.similar_classes(docs_of(rows), 4, (17, 20)), rows, 4, 17, 20)
    assert seen[0] and all(len(pairs) == len(set(pairs)) for pairs in seen)


def test_sets_are_made_in_one_pass_of_few_known_documents(spark, docs_of):
    docs = docs_of([(i, f"a b c {i}") for i in range(50)]).select("doc_id", "text")
    wanted = spark.range(0, 50, 7).selectExpr("id AS rep").unionByName(spark.range(0, 50, 14).selectExpr("id AS rep"))
    made = links.sets_of(docs, wanted, 2, short=True)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInPandas") == 1 and "HashAggregate" not in plan
    assert {r.rep: bytes(r.elements) for r in made.collect()} == {
        i: links.short_form(links.shingle_sets([f"a b c {i}"], 2)[0]) for i in range(0, 50, 7)}


def test_members_are_dealt_once_for_counts_and_pairs(spark):
    members = spark.createDataFrame([(s, r, r // 2, 0, 1) for s in range(20) for r in range(s, s + 5)], "sig long, rep long, root long, mark int, cls int")
    pairs = links._ends(members)
    found = {(r.a, r.b) for r in pairs.collect()}
    assert found == {(min(r, e), max(r, e)) for s in range(20) for r in range(s, s + 5) for e in (s, s + 4) if r // 2 != e // 2}
    assert "Reused" in pairs._jdf.queryExecution().executedPlan().toString()
