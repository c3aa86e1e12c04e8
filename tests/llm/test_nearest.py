"""Learned partitions: recall and exactness against brute force, balance, odd vectors."""

import numpy as np
import pytest

from aeroloom.llm import nearest, queries


def brute(rows, query, k):
    """(vec_id, score) of the k nearest of usable rows [(id, vec)]."""
    q = dict(rows)[query]
    all_ = sorted(((-sum(float(a) * float(b) for a, b in zip(q, v)), i) for i, v in rows if i != query))
    return [(i, -s) for s, i in all_[:k]]


@pytest.fixture(scope="module")
def made(spark):
    """Clusters, one very common vector, and rows that take no part."""
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 1, (12, 8))
    good = [(i, (centres[i % 12] + rng.normal(0, 0.3, 8)).astype(np.float32).tolist()) for i in range(1500)]
    good += [(2000 + i, [4 * x for x in good[3][1]]) for i in range(400)]
    odd = [(5000, None), (5020, [0.0] * 8), (5040, [float("nan")] + [1.0] * 7), (5060, [float("inf")] + [1.0] * 7), (5080, [None] + [1.0] * 7), (5100, [1.0, 2.0]),
           (None, [1.0] * 8), (5120, [])]
    df = spark.createDataFrame([(i, v, "clash") for i, v in good + odd], "vec_id long, embedding array<float>, part string")
    return good, df


def test_exact_scores_and_recall(spark, made, monkeypatch):
    monkeypatch.setattr(nearest, "BLOCK", 60)
    monkeypatch.setattr(nearest, "SHARD", 300)
    good, df = made
    rows = nearest.usable(df)
    model = nearest.fit(rows, sample=1200, part_size=150)
    assert model.parts > 4 and 1 <= model.probes <= model.parts
    q = rows.where("vec_id % 20 = 0").selectExpr("vec_id AS query_id", "vec")
    got = {}
    for r in nearest.search(rows, q, model, 10).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert got.keys() == {i for i, _ in good if i % 20 == 0}
    hits = 0
    by_id = dict(good)
    for query, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 11)) and query not in [v for _, v, _ in found]
        assert found == sorted(found, key=lambda f: (-f[2], f[1]))
        for _, v, s in found:
            assert abs(s - np.dot(np.array(by_id[query], float), np.array(by_id[v], float))) < 1e-9
        want = brute(good, query, 10)
        hits += sum(s >= want[-1][1] - 1e-9 for _, _, s in found)
    assert hits >= 0.9 * 10 * len(got)
    common = got[2000]
    assert [v for _, v, _ in common] == sorted(v for _, v, _ in common)  # equal vectors: equal scores, smaller ids first


def test_few_vectors(spark):
    rows = [(20 * i, [float(i + 1), 1.0]) for i in range(5)] + [(7, [1.0, 0.0]), (7, [0.5, 0.5])]
    got = {}
    for r in nearest.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    kept = [*rows[:5], (7, [0.5, 0.5])]
    for i in range(5):
        assert [(v, round(s, 9)) for _, v, s in sorted(got[20 * i])] == [(v, round(s, 9)) for v, s in brute(kept, 20 * i, 20)]
    none = spark.createDataFrame([(1, None)], "vec_id long, embedding array<double>")
    assert nearest.nearest(none).collect() == [] and nearest.nearest(none.where("false")).collect() == []


def test_parts_are_balanced_and_cut_few_edges():
    rng = np.random.default_rng(4)
    x = np.repeat(np.eye(6), 50, axis=0) + rng.normal(0, 0.1, (300, 6))
    graph = nearest.neighbours(x, np.arange(300), 6)
    part = nearest.balanced_parts(graph, 6)
    assert np.bincount(part, minlength=6).max() <= 55
    assert (part[graph] != part[:, None]).mean() < 0.1


def test_query_recall(spark):
    d = "/root/testdata/sf0.01"
    got = queries.op5_nearest(spark, d).collect()
    rows = spark.read.parquet(f"{d}/embeddings.parquet").collect()
    x, ids = np.array([r.embedding for r in rows], float), [r.vec_id for r in rows]
    found = {}
    for r in got:
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for i, v in zip(ids, x):
        if i % 20 == 0:
            s = x @ v
            s[ids.index(i)] = -np.inf
            hits += len(found[i] & {ids[j] for j in np.argsort(-s, kind="stable")[:20]})
    assert hits >= 0.9 * 20 * len(found) and len(got) == 20 * len(found)


def test_recall_of_unseen_queries_over_many_parts(spark):
    """The given vectors in 20 parts or more, of which the search leaves some out; no query is among the rows fitted on."""
    rows = nearest.usable(spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")).cache()
    seen = rows.where("vec_id % 20 != 0")
    model = nearest.fit(seen, sample=1500, part_size=60)
    assert model.parts >= 20 and model.probes < model.parts
    got = nearest.search(rows, rows.where("vec_id % 20 = 0").selectExpr("vec_id AS query_id", "vec"), model, 20).collect()
    held = rows.collect()
    ids, x = np.array([r.vec_id for r in held]), np.array([r.vec for r in held], float)
    found, hits, queries_of = {}, 0, [i for i in ids if i % 20 == 0]
    for r in got:
        found.setdefault(r.query_id, set()).add(r.vec_id)
    for i in queries_of:
        s = x @ x[ids == i][0]
        s[ids == i] = -np.inf
        hits += len(found[i] & set(ids[np.argsort(-s, kind="stable")[:20]].tolist()))
    assert hits >= 0.9 * 20 * len(queries_of)
