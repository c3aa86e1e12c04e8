"""HyperMinHash: registers and estimates against exact similarities, components against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from aeroloom.llm import hyperminhash as H, queries, text as T
from tests.llm.conftest import SF
from tests.llm.test_setjoin import brute, edited


def same(df, rows, size, p, q):
    got = sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)
    assert got == sorted(((i, n, c, i is None or i == c) for i, n, c in brute(rows, size, p, q)), key=str)


def sets_of(seed, common, each):
    x = T.mix64(np.arange(common + 2 * each, dtype=np.uint64) + np.uint64(seed << 32))
    return x[:common + each], np.concatenate([x[:common], x[common + each:]])


@pytest.mark.parametrize("common,each", [(17, 1), (85, 15), (170, 15), (900, 300), (5000, 200)])
def test_estimate(common, each):
    """Over many pairs of sets the corrected estimate has no bias, and its spread is that of the registers."""
    cls = H.size_classes(common + each, (4, 5))[0]
    got = []
    for seed in range(150):
        a, b = sets_of(seed, common, each)
        x, y = H.registers(a, cls), H.registers(b, cls)
        n = np.array([len(a)])
        got.append(H.estimate(np.array([((x == y) & (x > 0)).sum()]), np.array([((x > 0) | (y > 0)).sum()]), n, n, np.array([cls]))[0])
    true = common / (common + 2 * each)
    sd = np.sqrt(true * (1 - true) / H.REGISTERS)
    assert abs(np.mean(got) - true) < 4 * sd / np.sqrt(150) and max(abs(np.array(got) - true)) < 5 * sd


def test_chance_collisions():
    """Registers of sets without a common element agree as often as expected."""
    for n in (100, 3000):
        cls, agree = H.size_classes(n, (4, 5))[0], 0
        for seed in range(300):
            a, b = sets_of(seed, 0, n)
            x, y = H.registers(a, cls), H.registers(b, cls)
            agree += int(((x == y) & (x > 0)).sum())
        want = 300 * H.chance(np.array([n]), np.array([n]), np.array([cls]))[0]
        assert abs(agree - want) < 5 * np.sqrt(want) + 1


def test_every_partner_shares_a_class():
    for p, q in ((4, 5), (17, 20)):
        for n in range(1, 3000):
            for m in {n, n + 1, n * q // p}:
                if m >= n and n * q >= m * p and (m > n or (n - 1) * q >= (n + 1) * p):
                    assert set(H.size_classes(n, (p, q))) & set(H.size_classes(m, (p, q))), (n, m)


@pytest.mark.parametrize("size,p,q", [(5, 17, 20), (5, 4, 5)])
def test_groups_of_near_copies(docs_of, size, p, q, monkeypatch):
    """Copies, chains and families of near copies around the threshold, small sets, near misses, odd rows; small blocks."""
    monkeypatch.setattr(H, "BLOCK", 16)
    draw, rows = random.Random(5), []
    for length in (8, 12, 30, 90, 400):
        base = [f"w{draw.randrange(50000)}" for _ in range(length)]
        rows += [(len(rows) + i, " ".join(base)) for i in range(3)]
        for edits in (0, 1, 1, 2, 2, 3, 3, 4, 6, 8) * 6:
            rows.append((len(rows), edited(draw, base, min(edits, length // 20 + (edits > 2)))))
        chain = list(base)
        for _ in range(12):
            chain = edited(draw, chain, 1).split()
            rows.append((len(rows), " ".join(chain)))
        rows += [(len(rows) + i, " ".join(base[:length - i])) for i in range(4)]
    passage = " ".join(f"p{i}" for i in range(25))
    rows += [(len(rows) + i, passage + " " + " ".join(f"w{draw.randrange(50000)}" for _ in range(60))) for i in range(40)]
    rows += [(None, passage), (None, passage), (9001, None), (9002, ""), (9003, " \n"), (9004, "one"), (9005, "ONE"), (9006, "a b c d"), (9007, "a b c"),
             (9008, passage + " x"), (9009, passage + " y"), (9009, "another text of the same id"), (9010, "another text of the same id")]
    draw.shuffle(rows)
    frame = docs_of(rows).withColumns({c: F.lit("clash") for c in ("rep", "sig", "root", "n", "registers")})
    same(H.near_duplicates(frame, size, (p, q)), rows, size, p, q)


def test_cells_alone_find_all_links(docs_of, monkeypatch):
    """Without stars, every link is found by looking through groups."""
    monkeypatch.setattr(H, "STAR_BANDS", 0)
    draw, rows = random.Random(6), []
    for _ in range(4):
        base = [f"w{draw.randrange(50000)}" for _ in range(60)]
        rows += [(len(rows) + i, edited(draw, base, i % 3)) for i in range(30)]
    same(H.near_duplicates(docs_of(rows)), rows, 5, 4, 5)


def test_a_short_set_that_misleads_is_not_the_end(docs_of, monkeypatch):
    """With short forms that call every candidate a link, whole sets decide."""
    plain = H._look
    monkeypatch.setattr(H, "STAR_BANDS", 0)
    monkeypatch.setattr(H, "_look", lambda cell, threshold, slack: plain(cell, (7, 10) if slack else threshold, slack))
    draw, rows = random.Random(7), []
    base = [f"w{draw.randrange(50000)}" for _ in range(60)]
    rows += [(i, edited(draw, base, i % 4)) for i in range(40)]
    same(H.near_duplicates(docs_of(rows)), rows, 5, 4, 5)


def test_empty_table(docs_of):
    assert H.near_duplicates(docs_of([])).collect() == []


def test_query(spark, given):
    same(queries.op13_hyperminhash(spark, SF), [(r.doc_id, r.text) for r in given("documents")], 5, 17, 20)
