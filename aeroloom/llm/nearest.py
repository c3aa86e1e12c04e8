"""Approximate nearest neighbours by learned partitions.

A bounded sample gives a neighbour graph.  The graph is cut into parts of equal size so that few edges cross, and a
small network learns which parts a vector's neighbours lie in.  Every vector of the table is put into its most probable
part; a query visits its most probable parts, as many as the sample shows to be enough, and ranks what is there by the
exact inner product.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from aeroloom.llm import files

#: Queries per block, and vectors per shard: neighbouring parts make a shard, a larger part makes several blocks.  A task
#: compares a block of queries with a shard, each query with the parts that it visits.
BLOCK, SHARD = 2048, 16384


@dataclass
class Model:
    """Network from a vector to log-odds of the parts, and how many parts a query visits."""

    scale: float
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int

    @property
    def parts(self) -> int:
        return len(self.b2)

    def ranking(self, x: np.ndarray) -> np.ndarray:
        """Parts of each vector, most probable first."""
        return np.argsort(-self.odds(x), axis=1, kind="stable")

    def odds(self, x: np.ndarray) -> np.ndarray:
        # Directions decide: a vector's length is not seen.
        z = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300) * self.scale
        return np.tanh(z @ self.w1 + self.b1) @ self.w2 + self.b2


def neighbours(x: np.ndarray, queries: np.ndarray, k: int) -> np.ndarray:
    """Rows of ``x`` with the largest inner products for each row number of ``queries``, itself left out."""
    k = min(k, len(x) - 1)
    out = np.zeros((len(queries), max(k, 0)), np.int64)
    for lo in range(0, len(queries), 512):
        q = queries[lo:lo + 512]
        s = x[q] @ x.T
        s[np.arange(len(q)), q] = -np.inf
        out[lo:lo + 512] = np.argsort(-s, axis=1, kind="stable")[:, :k] if k else 0
    return out


def balanced_parts(graph: np.ndarray, parts: int, rounds: int = 12, slack: float = 1.1, seed: int = 3) -> np.ndarray:
    """Part of each node of a neighbour graph (n by k), none above ``slack`` times its share.

    Parts grow from seeds along edges until they are full; then nodes move to the part of most of their neighbours as
    long as it has room, which lowers the number of crossing edges in each round.
    """
    n = len(graph)
    rng = np.random.default_rng(seed)
    linked: list[list[int]] = [list(r) for r in graph.tolist()]
    for i, r in enumerate(graph.tolist()):
        for j in r:
            linked[j].append(i)
    part, share = np.full(n, -1), -(-n // parts)
    order = rng.permutation(n).tolist()
    at = 0
    for p in range(parts):
        front, size = [], 0
        while size < share:
            if not front:
                while at < n and part[order[at]] >= 0:
                    at += 1
                if at == n:
                    break
                front = [order[at]]
            i = front.pop(0)
            if part[i] >= 0:
                continue
            part[i] = p
            size += 1
            front += [j for j in linked[i] if part[j] < 0]
    sizes, cap = np.bincount(part, minlength=parts), int(np.ceil(n / parts * slack))
    for _ in range(rounds):
        moved = 0
        for i in rng.permutation(n).tolist():
            votes = np.bincount(part[linked[i]], minlength=parts) if linked[i] else None
            if votes is None:
                continue
            votes[(sizes >= cap)] = -1
            here = part[i]
            votes[here] = np.count_nonzero(part[linked[i]] == here)
            best = int(votes.argmax())
            if votes[best] > votes[here]:
                sizes[here] -= 1
                sizes[best] += 1
                part[i] = best
                moved += 1
        if moved < n // 200:
            break
    return part


def learn(x: np.ndarray, parts: int, k: int = 20, hidden: int = 96, epochs: int = 40, recall: float = 0.95, seed: int = 7) -> Model:
    """Cut the sample's neighbour graph and fit the network to the parts of each vector's neighbours.

    The number of parts to visit is the least with which the sample's own ``k`` neighbours are found with ``recall``.
    """
    n, d = x.shape
    rng = np.random.default_rng(seed)
    unit = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    scale = np.sqrt(d)
    params = [rng.normal(0, 1 / np.sqrt(d), (d, hidden)), np.zeros(hidden), rng.normal(0, 1 / np.sqrt(hidden), (hidden, parts)), np.zeros(parts)]
    if parts > 1:
        graph = neighbours(x, np.arange(n), 10)
        part = balanced_parts(graph, parts)
        target = np.zeros((n, parts))
        np.add.at(target, (np.repeat(np.arange(n), graph.shape[1]), part[graph].ravel()), 1)
        target[np.arange(n), part] += 2
        target /= target.sum(axis=1, keepdims=True)
        z = unit * scale
        m, v, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        for epoch in range(epochs):
            rate = 0.01 * (1 - epoch / epochs) + 0.0005
            order = rng.permutation(n)
            for lo in range(0, n, 256):
                b = order[lo:lo + 256]
                w1, b1, w2, b2 = params
                h = np.tanh(z[b] @ w1 + b1)
                o = h @ w2 + b2
                o = np.exp(o - o.max(axis=1, keepdims=True))
                g = (o / o.sum(axis=1, keepdims=True) - target[b]) / len(b)
                gh = (g @ w2.T) * (1 - h * h)
                step += 1
                for i, grad in enumerate((z[b].T @ gh, gh.sum(axis=0), h.T @ g, g.sum(axis=0))):
                    m[i] = 0.9 * m[i] + 0.1 * grad
                    v[i] = 0.999 * v[i] + 0.001 * grad * grad
                    params[i] = params[i] - rate * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)
    model = Model(float(scale), *params, probes=1)
    if parts > 1:
        ask = rng.permutation(n)[:1000]
        near = neighbours(x, ask, k)
        home = model.odds(x).argmax(axis=1)
        rank = np.argsort(model.ranking(x[ask]), axis=1)  # place of each part for each query
        needed = np.sort(rank[np.arange(len(ask))[:, None], home[near]].ravel())
        model.probes = max(2, int(needed[int(np.ceil(recall * len(needed))) - 1]) + 1)
    return model


def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, vec) of the vectors that take part: with an id, not null or zero, all components finite, and of the
    commonest length.  Of rows with one id the least vector stands."""
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    rows = (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"))
            .where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull())
            .where(~F.exists("vec", bad) & F.exists("vec", lambda c: c != 0)))
    common = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    rows = rows.where(F.size("vec") == (common["d"] if common else 0))
    return rows.groupBy("vec_id").agg(F.min("vec").alias("vec"))


def fit(rows: DataFrame, sample: int = 8000, part_size: int = 400, most_parts: int = 256, seed: int = 11) -> Model | None:
    """Learn partitions from about ``sample`` rows of ``vec_id, vec``, drawn by a hash; None without rows.

    There is one part per ``part_size`` rows of the table, but no more than ``most_parts`` and than the sample can show.
    """
    n = rows.count()
    if n == 0:
        return None
    drawn = rows.where(F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(1_000_000)) < F.lit(sample / n * 1_000_000)).select("vec_id", "vec").toPandas()
    if len(drawn) == 0:
        drawn = rows.orderBy("vec_id").limit(1).toPandas()
    drawn = drawn.sort_values("vec_id", kind="stable")
    x = np.stack(drawn["vec"].to_numpy()).astype(np.float64)
    return learn(x, int(np.clip(min(n // part_size, len(x) // 30), 1, most_parts)))


def search(rows: DataFrame, queries: DataFrame, model: Model, k: int = 20) -> DataFrame:
    """``k`` nearest of ``rows`` (vec_id, vec) for each of ``queries`` (query_id, vec): query_id, rank, vec_id, score.

    Score is the inner product in double precision; ties go to the smaller vec_id, and a row with the query's own id is
    left out.  A query visits the model's number of parts, and more until they hold eight times ``k`` rows or there are
    no more, so that few rows in a part never shorten a result.  Large parts are compared block by block.
    """
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(model)  # some ten thousand numbers

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.stack(batch["vec"].to_numpy()) if len(batch) else np.zeros((0, 1))
            yield batch.assign(part=shared.value.odds(x).argmax(axis=1)) if len(batch) else batch.assign(part=0)

    indexed = files.written(rows.select("vec_id", "vec").mapInPandas(place, "vec_id long, vec array<double>, part int"), "vectors-in-parts")
    sizes = np.zeros(model.parts, np.int64)
    for r in indexed.groupBy("part").count().collect():  # one number per part
        sizes[r["part"]] = r["count"]
    shard_of, held = np.zeros(model.parts, np.int64), 0
    for p in range(1, model.parts):
        held += sizes[p - 1]
        new = held + sizes[p] > SHARD
        shard_of[p], held = shard_of[p - 1] + new, 0 if new else held
    shards = np.bincount(shard_of, sizes).astype(np.int64)
    enough = 8 * (k + 1)

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch) == 0:
                continue
            order = shared.value.ranking(np.stack(batch["vec"].to_numpy()))
            filled = np.cumsum(sizes[order], axis=1)
            want = np.maximum(shared.value.probes, (filled < enough).sum(axis=1) + 1)
            keep = (np.arange(order.shape[1]) < want[:, None]) & (sizes[order] > 0)
            i, j = np.nonzero(keep)
            part = order[i, j]
            order = np.lexsort((part, shard_of[part], i))
            i, part = i[order], part[order]
            cut = np.flatnonzero(np.append(True, (i[1:] != i[:-1]) | (shard_of[part[1:]] != shard_of[part[:-1]])))
            yield pd.DataFrame({"query_id": batch["query_id"].to_numpy()[i[cut]], "vec": batch["vec"].to_numpy()[i[cut]], "shard": shard_of[part[cut]],
                                "visits": np.split(part.astype(np.int32), cut[1:])})

    asked = queries.select("query_id", "vec").mapInPandas(visit, "query_id long, vec array<double>, shard int, visits array<int>")
    asked = files.written(asked, "queries-in-shards")
    loads = np.zeros(len(shards), np.int64)
    for r in asked.groupBy("shard").count().collect():
        loads[r["shard"]] = r["count"]
    blocks = lambda counts, size: F.array(*[F.lit(int(max(1, -(-c // size)))) for c in counts])[F.col("shard")]
    # Cell: a block of a shard's vectors and a block of its queries.  Each side goes to all blocks of the other.
    left = (asked.withColumn("qb", F.pmod(F.xxhash64("query_id"), blocks(loads, BLOCK)).cast("int"))
            .withColumn("cb", F.explode(F.sequence(F.lit(0), blocks(shards, SHARD) - 1))))
    right = (indexed.withColumn("shard", F.array(*[F.lit(int(x)) for x in shard_of])[F.col("part")])
             .withColumn("cb", F.pmod(F.xxhash64("vec_id"), blocks(shards, SHARD)).cast("int"))
             .withColumn("qb", F.explode(F.sequence(F.lit(0), blocks(loads, BLOCK) - 1))))

    def compare(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if len(q) == 0 or len(c) == 0:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        c = c.sort_values(["part", "vec_id"], kind="stable")
        x, ids, part = np.stack(c["vec"].to_numpy()), c["vec_id"].to_numpy(), c["part"].to_numpy()
        y, own = np.stack(q["vec"].to_numpy()), q["query_id"].to_numpy()
        visitor = np.repeat(np.arange(len(q)), q["visits"].map(len).to_numpy())
        visited = np.concatenate(q["visits"].to_numpy())
        found: list[tuple] = []
        for p in np.unique(part):
            a, b = np.searchsorted(part, p), np.searchsorted(part, p, "right")
            asking = visitor[visited == p]
            for lo in range(0, len(asking), 256):
                i = asking[lo:lo + 256]
                s = y[i] @ x[a:b].T
                s[own[i, None] == ids[a:b]] = -np.inf
                kth = np.partition(s, -min(k, b - a), axis=1)[:, -min(k, b - a)]
                # Products of a block may differ in the last bits from those of another: what is near the limit is
                # kept and reckoned again row by row, so that equal vectors get equal scores.
                row, j = np.nonzero((s >= (kth - 1e-9 * np.maximum(1, np.abs(kth)))[:, None]) & (s > -np.inf))
                found.append((i[row], a + j, np.einsum("ij,ij->i", y[i[row]], x[a + j])))
        if not found:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        i, j, exact = (np.concatenate(f) for f in zip(*found))
        order = np.lexsort((ids[j], -exact, i))
        i, j, exact = i[order], j[order], exact[order]
        best = np.arange(len(i)) - np.searchsorted(i, i) < k
        return pd.DataFrame({"query_id": own[i[best]], "vec_id": ids[j[best]], "score": exact[best]})

    cell = ["shard", "cb", "qb"]
    found = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInPandas(compare, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """Fit, index and search: queries are the usable vectors whose id is divisible by ``every``."""
    rows = files.written(usable(vectors), "vectors")
    model = fit(rows)
    if model is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    queries = rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "vec")
    return search(rows, queries, model, k)
