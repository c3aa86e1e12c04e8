"""Similarity join of documents' shingle sets by PartEnum signatures, and the components of the links.

Sets are hashed shingles.  Sizes are cut into bands; a set belongs to the band of its size and, near the upper edge, is
too large for the next smaller partner's band to be missed: band j takes sizes from L(j) to just over L(j+1) divided by
the threshold, so any linked pair shares the band of its smaller set.  Linked sets of band j differ in at most k(j)
elements.  The hashed domain is dealt into n1 = k(j) // 2 + 1 groups of n2 partitions each: two linked sets differ in at
most one element of some group, and so in at most one of its partitions.  A signature is a band, a group and the elements
of all its partitions but one; each of the n2 subsets is enumerated, and linked sets share at least one.  n2 is
larger in bands of small sets, where a subset would else hold too few elements.

A sketch of a set is a 32-bit sum of each partition's elements.  Two sets differ in at least as many elements as sums, which
rules out most candidates.  Candidates go the way of `links`: stars in every group, components, cells, all confirmed on full
sets.  No link is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from aeroloom.llm import files, text as T
from aeroloom.llm.links import Method, components, linked, linked_classes, shingle_sets

__all__ = ["bands", "Bands", "components", "linked", "partition_sums", "signatures", "similar_classes"]

RATIO = 1.4
#: Partitions of a group, and the most differences of a band for which it has the larger number.
GROUP, SMALL_GROUP, SMALL = 3, 6, 8
#: One signature in so many serves for stars.
STARS = 7
#: A document has some hundred signature rows, so these take as many times the partitions that Spark is set to.
SPREAD = 2
#: Members of a group of equal signatures that one task looks through; larger ones go in pairs of blocks of this size.
BLOCK = 2048


def bands(threshold: tuple[int, int], largest: int) -> list[tuple[int, int, int, int, int]]:
    """(band, smallest size, largest size, n1, n2) for sets of up to ``largest`` elements; threshold = (p, q) is p / q."""
    p, q = threshold
    out, low, j = [], 1, 0
    while low <= largest:
        high = max(low + 1, math.ceil(low * RATIO))  # the smaller set has low .. high - 1 elements
        top = (high - 1) * q // p
        # With s elements in both sets together, at least p / (p + q) of s are common; rounding makes this rise and fall.
        most = high - 1 + top
        differ = max(0, *(s - 2 * -(-p * s // (p + q)) for s in range(max(2, most - 2 * (p + q)), most + 1)))
        out.append((j, low, top, differ // 2 + 1, SMALL_GROUP if differ <= SMALL else GROUP))
        low, j = high, j + 1
    return out


class Bands:
    """The bands, grown as larger sets come."""

    def __init__(self, threshold: tuple[int, int]):
        self.threshold, self.largest, self.table = threshold, 0, []

    def of(self, size: int) -> list[tuple[int, int, int]]:
        """(band, n1, n2) of the bands that a set of ``size`` belongs to."""
        self._grow(size)
        return [(j, n1, n2) for j, low, top, n1, n2 in self.table if low <= size <= top]

    def shape(self, band: int) -> tuple[int, int]:
        """n1 and n2 of a band."""
        while len(self.table) <= band:
            self._grow(2 * max(self.largest, 32))
        return self.table[band][3:]

    def _grow(self, size: int) -> None:
        if size > self.largest:
            self.largest = max(64, 2 * size)
            self.table = bands(self.threshold, self.largest)


def partition_sums(elements: np.ndarray, n: int) -> np.ndarray:
    """A 32-bit sum of the elements of each of ``n`` partitions of the domain; ``elements`` ascend."""
    part = ((elements >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
    cut = np.searchsorted(part, np.arange(n + 1, dtype=np.uint64))
    with np.errstate(over="ignore"):
        running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(T.mix64(elements), dtype=np.uint64)])
        return (T.mix64(running[cut[1:]] - running[cut[:-1]]) >> np.uint64(32)).astype(np.uint32)


def subset_keys(sums: np.ndarray, band: int, n2: int) -> np.ndarray:
    """64-bit signatures: for each group of ``n2`` sums and each of them, a hash of the others and their place."""
    each = T.mix64(sums.astype(np.uint64) ^ (np.arange(len(sums), dtype=np.uint64) << np.uint64(32))).reshape(-1, n2)
    with np.errstate(over="ignore"):
        rest = each.sum(axis=1, dtype=np.uint64)[:, None] - each
    return T.mix64(rest.ravel() ^ T.mix64(np.arange(len(sums), dtype=np.uint64) + np.uint64((band + 1) << 40)))


def signatures(elements: np.ndarray, where: Bands) -> np.ndarray:
    """All signatures of one set (distinct 64-bit hashes, ascending)."""
    found = [subset_keys(partition_sums(elements, n1 * n2), band, n2) for band, n1, n2 in where.of(len(elements))]
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def sketches(docs: DataFrame, size: int, threshold: tuple[int, int]) -> DataFrame:
    """doc_id, n_shingles, set_key (two 64-bit sums; null for the empty set), bands and partition sums of every document."""
    p, q = threshold

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        where = Bands(threshold)
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            for lo, hi in T.chunks(texts):
                sets = shingle_sets(texts[lo:hi], size)
                with np.errstate(over="ignore"):
                    names = [f"{int(T.mix64(s).sum(dtype=np.uint64)):016x}{int(T.mix64(s ^ np.uint64(0x5DEECE66D)).sum(dtype=np.uint64)):016x}"
                             if len(s) else None for s in sets]
                # Where not even a set with one element more links, equal sets alone do, and those are one already.
                of = [where.of(len(s)) if len(s) * q >= (len(s) + 1) * p else [] for s in sets]
                held = [[partition_sums(s, n1 * n2).astype("<u4").tobytes() for _, n1, n2 in b] for s, b in zip(sets, of)]
                yield pd.DataFrame({"doc_id": batch["doc_id"].iloc[lo:hi].array, "n_shingles": [len(s) for s in sets], "set_key": names,
                                    "classes": [[j for j, _, _ in b] for b in of], "sketches": held})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInPandas(run, "doc_id long, n_shingles long, set_key string, classes array<int>, sketches array<binary>")


def _signature_rows(held: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """(sig, rep, cls) of (rep, cls, sketch), dealt by sig.

    A set has a row per signature, six at least, so even a group of all sets has no more than a sixth of the rows, and
    of longer texts far less."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        where = Bands(threshold)
        for batch in batches:
            bands_of, raw, reps = batch["cls"].to_numpy(), batch["sketch"].tolist(), batch["rep"].to_numpy(np.int64)
            for lo in range(0, len(raw), 256):
                keys = [subset_keys(np.frombuffer(r, "<u4"), b, where.shape(b)[1]) for r, b in zip(raw[lo:lo + 256], bands_of[lo:lo + 256].tolist())]
                lengths = [len(k) for k in keys]
                yield pd.DataFrame({"sig": np.concatenate(keys).view(np.int64), "cls": np.repeat(bands_of[lo:lo + 256], lengths), "rep": np.repeat(reps[lo:lo + 256], lengths)})

    return held.select("rep", "cls", "sketch").mapInPandas(run, "sig long, cls int, rep long").repartition(SPREAD * files.parts(held.sparkSession), "sig")


def _one_byte(held: DataFrame) -> DataFrame:
    """The same rows with one byte of each sum: unlike bytes are unlike sums."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(sketch=[np.frombuffer(s, "<u4").astype(np.uint8).tobytes() for s in batch["sketch"]])

    return held.mapInPandas(run, held.schema)


def _possible(pairs: DataFrame, held: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """Those of the pairs (cls, a, b) whose sizes and sums let them link."""
    p, q = threshold

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n, m = batch["n"].to_numpy(np.int64), batch["m"].to_numpy(np.int64)
            differ = np.array([(np.frombuffer(x, np.uint8) != np.frombuffer(y, np.uint8)).sum() for x, y in zip(batch["x"], batch["y"])], np.int64)
            yield batch.loc[(q * np.minimum(n, m) >= p * np.maximum(n, m)) & (differ * (p + q) <= (n + m) * (q - p)), ["a", "b"]]

    left = held.select("cls", F.col("rep").alias("a"), "n", F.col("sketch").alias("x"))
    right = held.select("cls", F.col("rep").alias("b"), F.col("n").alias("m"), F.col("sketch").alias("y"))
    return (pairs.join(left, ["cls", "a"]).join(right, ["cls", "b"]).select("a", "b", "n", "m", "x", "y")
            .mapInPandas(run, "a long, b long").distinct())


def _near(cell: pd.DataFrame, threshold: tuple[int, int]):
    """Which members of one cell the sums allow to link."""
    p, q = threshold
    held, n = np.frombuffer(b"".join(cell["sketch"]), np.uint8).reshape(len(cell), -1), cell["n"].to_numpy(np.int64)

    def near_of(i: int, near: np.ndarray) -> np.ndarray:
        return near[(held[near] != held[i]).sum(axis=1) * (p + q) <= (n[near] + n[i]) * (q - p)]

    return near_of


def similar_classes(docs: DataFrame, size: int = 5, threshold: tuple[int, int] = (4, 5)) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs`` (``doc_id, text``; other columns don't matter).

    Two documents link when their shingle sets have a Jaccard similarity of at least the threshold p / q; the component
    is named by its smallest doc_id.  A document without words links with nothing.  A null doc_id takes no part and
    keeps a null component; rows with one doc_id are each described, and are one node.  An empty table gives no rows.
    """
    method = Method("setjoin", lambda d: sketches(d, size, threshold), lambda held: _signature_rows(held, threshold),
                    lambda pairs, held: _possible(pairs, held, threshold), lambda cell: _near(cell, threshold),
                    "0", "cls", f"pmod(sig, {STARS}) = 0", BLOCK, one_place=False, lighten=_one_byte)
    return linked_classes(docs, method, size, threshold)
