"""Near-duplicate documents by HyperMinHash: compressed registers, banding, corrected estimates, exact confirmation.

A set of shingle hashes is dealt into `REGISTERS` buckets.  A register keeps its bucket's smallest hash value as a short
floating-point number: the count of its leading zeros and `MANTISSA` bits after them, 8 bits in all.  Two sets agree in
a register about as often as they are similar.  Small sets would leave most buckets empty, so each element is dealt
several times, by hashes of its own; how often follows from the set's size class (powers of two), and so does the least
count of zeros worth telling apart.  A set whose partners may be of the next class has registers for both.

1. Every `ROWS` registers make a band; sets with equal bands are candidates.  Sets of a similarity of 0.85 miss each other
   in all `BANDS` bands with a probability of 2.4e-7, and are lost by the estimate below with about 1e-9.
2. Stars: in the first `STAR_BANDS` bands, each member of a group of equal bands is paired with the group's smallest.
   Agreeing registers, less those expected to agree by chance, estimate the similarity; pairs that are `SIGMAS` standard
   deviations below the threshold go, the rest are confirmed on their full sets.  Links make components.
3. Cells: groups of any band that hold several components are looked through inside tasks, large ones in blocks.  Members
   of one component are not compared.  A pair is looked at in its first common band alone: by estimate, then by 32-bit
   forms of its sets.  What passes is confirmed on the full sets as before.

So copies and near copies cost a pair per member and band, not one per pair, and pairs leave a task only if they link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from aeroloom.llm import files, text as T
from aeroloom.llm.setjoin import components, linked, shingle_sets

ROWS, BANDS = 8, 48
REGISTERS = ROWS * BANDS
#: Bits of a register for the mantissa; the others hold a count of zeros from 1 to `MOST`, 0 being an empty bucket.
MANTISSA, MOST = 4, 15
#: Dealt elements per register, at least.
FILL = 4
STAR_BANDS = 8
SIGMAS = 6
#: Members of a group that one task looks through; larger groups go in pairs of blocks of this size.
BLOCK = 2048
#: Band and class within a band's key.
BAND, CLASS = "CAST(sig & 63 AS INT)", "CAST((sig >> 6) & 63 AS INT)"
_SEEDS = T.mix64(np.arange(1, FILL * REGISTERS + 1, dtype=np.uint64))


def size_classes(n: int, threshold: tuple[int, int]) -> list[int]:
    """Classes in which a set of ``n`` elements meets sets that may link with it: its own and that of its largest partner."""
    p, q = threshold
    if n * q < (n + 1) * p:  # not even a set with one element more links
        return []
    return sorted({n.bit_length() - 1, (n * q // p).bit_length() - 1})


def times(cls: int) -> int:
    """How often each element is dealt in a class whose sets hold 2 ** cls elements or more."""
    return max(1, -(-FILL * REGISTERS >> cls))


def fewest_zeros(cls: int) -> int:
    """Leading zeros that a bucket's least value of this class has but for one bucket in some thousand; fewer count as these."""
    return max(0, ((times(cls) << cls) // REGISTERS).bit_length() - 4)


def registers(elements: np.ndarray, cls: int) -> np.ndarray:
    """Registers of one set: the count of zeros in the upper bits, the complement of the mantissa below; 0 if empty."""
    dealt = T.mix64((elements[:, None] ^ _SEEDS[:times(cls)]).ravel())
    bucket = ((dealt >> np.uint64(32)) * np.uint64(REGISTERS)) >> np.uint64(32)
    value = (T.mix64(dealt ^ np.uint64(0xD1B54A32D192ED03)) >> np.uint64(11)).astype(np.float64)  # 53 bits, exact
    fraction, exponent = np.frexp(value)
    zeros = np.clip(54 - exponent - fewest_zeros(cls), 1, MOST)
    mantissa = np.maximum((fraction * 2 - 1) * (1 << MANTISSA), 0).astype(np.int64)
    out = np.zeros(REGISTERS, np.uint8)
    np.maximum.at(out, bucket.astype(np.int64), ((zeros << MANTISSA) + ((1 << MANTISSA) - 1 - mantissa)).astype(np.uint8))
    return out


def chance(n: np.ndarray, m: np.ndarray, cls: np.ndarray) -> np.ndarray:
    """Registers that sets of n and m elements without a common one are expected to agree in.

    Both least values fall into the same short float: the integral of the product of their densities, times its width.
    """
    dealt = np.array([times(c) for c in range(65)])[cls] / REGISTERS
    a, b = n * dealt, m * dealt
    low = np.exp2(-np.arange(1, 54))
    both = (a + b)[:, None]
    spans = (low * (np.exp(-both * low) - np.exp(-both * 2 * low))).sum(axis=1)
    return REGISTERS * a * b / (a + b) * spans / (1 << MANTISSA)


def estimate(equal: np.ndarray, either: np.ndarray, n: np.ndarray, m: np.ndarray, cls: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the counts of registers that agree and that either set fills.

    Registers without a common least element agree by chance too, so that share is taken off."""
    by_chance = np.minimum(chance(n, m, cls) / REGISTERS, 0.5)
    return np.maximum(equal / np.maximum(either, 1) - by_chance, 0) / (1 - by_chance)


def least_estimate(threshold: tuple[int, int]) -> float:
    j = threshold[0] / threshold[1]
    return j - SIGMAS * float(np.sqrt(j * (1 - j) / REGISTERS))


def band_keys(held: np.ndarray, cls: int) -> np.ndarray:
    """A key of each band of a set's registers: 52 bits of a hash, 6 of the class and 6 of the band."""
    out = T.mix64(np.arange(BANDS, dtype=np.uint64) + np.uint64((cls + 1) << 8))
    wide = held.reshape(BANDS, ROWS).astype(np.uint64)
    for k in range(ROWS):
        out = T.mix64(out * np.uint64(0x100000001B3) + wide[:, k])
    return (((out >> np.uint64(12)) << np.uint64(12)) + np.uint64(cls << 6) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def sketches(docs: DataFrame, size: int, threshold: tuple[int, int]) -> DataFrame:
    """doc_id, n_shingles, set_key (two 64-bit sums; null for the empty set), classes and registers of every document."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            for lo, hi in T.chunks(texts):
                sets = shingle_sets(texts[lo:hi], size)
                with np.errstate(over="ignore"):
                    names = [f"{int(T.mix64(s).sum(dtype=np.uint64)):016x}{int(T.mix64(s ^ np.uint64(0x5DEECE66D)).sum(dtype=np.uint64)):016x}"
                             if len(s) else None for s in sets]
                classes = [size_classes(len(s), threshold) for s in sets]
                held = [[registers(s, c).tobytes() for c in cs] for s, cs in zip(sets, classes)]
                yield pd.DataFrame({"doc_id": batch["doc_id"].iloc[lo:hi].array, "n_shingles": [len(s) for s in sets], "set_key": names,
                                    "classes": classes, "registers": held})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInPandas(run, "doc_id long, n_shingles long, set_key string, classes array<int>, registers array<binary>")


def _unpacked(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(-1, REGISTERS)


def _band_rows(held: DataFrame) -> DataFrame:
    """(sig, rep) of (rep, cls, registers), dealt by sig.

    A set has one row per band, so even a group of all sets has no more than one in `BANDS` of the rows."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys = [band_keys(r, c) for r, c in zip(_unpacked(batch["registers"]), batch["cls"].tolist())]
            if keys:
                yield pd.DataFrame({"sig": np.concatenate(keys), "rep": np.repeat(batch["rep"].to_numpy(), BANDS)})

    return held.select("rep", "cls", "registers").mapInPandas(run, "sig long, rep long").repartition(files.parts(held.sparkSession), "sig")


def _estimated(pairs: DataFrame, held: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """Those of the pairs (cls, a, b) whose sizes and registers let them link."""
    p, q = threshold
    least = least_estimate(threshold)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch) == 0:
                continue
            n, m = batch["n"].to_numpy(np.int64), batch["m"].to_numpy(np.int64)
            x, y = _unpacked(batch["x"]), _unpacked(batch["y"])
            near = estimate(((x == y) & (x > 0)).sum(axis=1), ((x > 0) | (y > 0)).sum(axis=1), n, m, batch["cls"].to_numpy())
            yield batch.loc[(q * np.minimum(n, m) >= p * np.maximum(n, m)) & (near >= least), ["a", "b"]]

    left = held.select("cls", F.col("rep").alias("a"), "n", F.col("registers").alias("x"))
    right = held.select("cls", F.col("rep").alias("b"), F.col("n").alias("m"), F.col("registers").alias("y"))
    return (pairs.join(left, ["cls", "a"]).join(right, ["cls", "b"]).select("cls", "a", "b", "n", "m", "x", "y")
            .mapInPandas(run, "a long, b long").distinct())


def _sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(rep, elements) of the wanted documents, made anew from their texts."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            for lo, hi in T.chunks(texts):
                raw = [s.astype("<u8").tobytes() for s in shingle_sets(texts[lo:hi], size)]
                yield pd.DataFrame({"rep": batch["doc_id"].iloc[lo:hi].array, "elements": raw})

    return docs.join(wanted.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi").select("doc_id", "text").mapInPandas(run, "rep long, elements binary")


def _shortened(rows: DataFrame) -> DataFrame:
    """The same rows with the distinct lower halves of their elements."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(elements=[np.unique(np.frombuffer(e, "<u8").astype("<u4")).tobytes() for e in batch["elements"]])

    return rows.mapInPandas(run, rows.schema)


def _confirmed(pairs: DataFrame, sets: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """Those of the pairs (a, b) whose full sets link."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ok = [linked(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), threshold) for x, y in zip(batch["x"], batch["y"])]
            yield batch.loc[ok, ["a", "b"]]

    joined = (pairs.join(sets.select(F.col("rep").alias("b"), F.col("elements").alias("y")), "b")
              .join(sets.select(F.col("rep").alias("a"), F.col("elements").alias("x")), "a"))
    # A doc_id with several texts links if one of them does.
    return joined.select("a", "b", "x", "y").mapInPandas(run, "a long, b long").distinct()


def _look(cell: pd.DataFrame, threshold: tuple[int, int], slack: bool) -> list[tuple[int, int]]:
    """Pairs of different components in one cell that pass estimate and set comparison; what passes is of one component then.

    Sets are compared by 32-bit hashes, counted so that a link is never missed, or (``slack`` False) by whole ones."""
    p, q = threshold
    least, kind = least_estimate(threshold), "<u4" if slack else "<u8"
    band, cls = int(cell["band"].iloc[0]), cell["cls"].to_numpy()
    rep, n, side = (cell[c].to_numpy(np.int64) for c in ("rep", "n", "side"))
    label = np.unique(cell["root"].to_numpy(), return_inverse=True)[1]
    held, raw, two, found = _unpacked(cell["registers"]), cell["elements"].tolist(), len(np.unique(side)) > 1, []
    for i in range(1, len(rep)):
        fit = (label[:i] != label[i]) & (q * np.minimum(n[i], n[:i]) >= p * np.maximum(n[i], n[:i]))
        if two:
            fit &= side[:i] != side[i]
        near = np.flatnonzero(fit)
        if len(near) == 0:
            continue
        same = held[near] == held[i]
        # The first band in which all registers agree is the pair's own.
        mine = same.reshape(len(near), BANDS, ROWS).all(axis=2).argmax(axis=1) == band
        filled = ((held[near] > 0) | (held[i] > 0)).sum(axis=1)
        near = near[mine & (estimate((same & (held[i] > 0)).sum(axis=1), filled, n[near], np.full(len(near), n[i]), cls[near]) >= least)]
        own = np.frombuffer(raw[i], kind)
        for j in near.tolist():
            if label[j] == label[i]:
                continue
            other = np.frombuffer(raw[j], kind)
            small, large = (own, other) if len(own) < len(other) else (other, own)
            common = int((large[np.minimum(np.searchsorted(large, small), len(large) - 1)] == small).sum())
            # Elements that fell together in the short form may all be common.
            common = min(common + max(n[i] - len(own), n[j] - len(other)), n[i], n[j])
            if q * common >= p * (n[i] + n[j] - common):
                found.append((int(rep[j]), int(rep[i])))
                label[label == label[j]] = label[i]
    return found


def _passing(cells: DataFrame, threshold: tuple[int, int], slack: bool) -> DataFrame:
    """Pairs (a, b) of all cells (cell, side, band, cls, rep, root, n, registers, elements); each cell lies in one task, in order."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: pd.DataFrame | None = None
        for batch in batches:
            rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            if len(rows) == 0:
                continue
            open_cell = rows["cell"] == rows["cell"].iloc[-1]
            rest = rows[open_cell]
            yield look(rows[~open_cell])
        if rest is not None:
            yield look(rest)

    def look(rows: pd.DataFrame) -> pd.DataFrame:
        found = [pair for _, cell in rows.groupby("cell", sort=False) for pair in _look(cell, threshold, slack)]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    dealt = cells.repartition(files.parts(cells.sparkSession), "cell").sortWithinPartitions("cell", "rep")
    return dealt.select("cell", "side", "band", "cls", "rep", "root", "n", "registers", "elements").mapInPandas(run, "a long, b long").distinct()


def _rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    return rows.join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))


def _cells(bands: DataFrame, roots: DataFrame) -> DataFrame:
    """(cell, side, band, cls, rep, root) of the groups of equal bands that hold several components, in blocks."""
    rooted = files.written(_rooted(bands, roots), "hmh-rooted")
    groups = (rooted.groupBy("sig").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("n"))
              .where("lo != hi").select("sig", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
    # A member of block i meets every block j: it goes to the cell of the two.
    return (rooted.join(groups, "sig").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select(F.concat_ws(":", "sig", F.least("block", "other"), F.greatest("block", "other")).alias("cell"), F.col("block").alias("side"),
                    F.expr(BAND).alias("band"), F.expr(CLASS).alias("cls"), "rep", "root"))


def near_duplicates(docs: DataFrame, size: int = 5, threshold: tuple[int, int] = (4, 5)) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs`` (``doc_id, text``; other columns don't matter).

    Documents link when their sets of ``size``-word shingles have a Jaccard similarity of at least p / q; a component is
    named by its smallest doc_id, and that document is kept.  A document without words (null or empty text) links with
    nothing and is kept.  A null doc_id takes no part, has a null component and is kept; rows with one doc_id are
    each described, and are one node.  An empty table gives no rows.
    """
    sketched = files.written(sketches(docs, size, threshold), "hmh-sketches")
    described = files.written(sketched.select("doc_id", "n_shingles", "set_key"), "hmh-described")
    known = described.where("doc_id IS NOT NULL AND set_key IS NOT NULL")
    # Each set once: its smallest doc_id stands for all its copies.
    reps = known.groupBy("set_key").agg(F.min("doc_id").alias("rep"))
    stands = files.written(known.select("doc_id", "set_key").distinct().join(reps, "set_key"), "hmh-stands")
    first = sketched.where("size(classes) > 0").join(stands.where("doc_id = rep").select("doc_id", "set_key"), ["set_key", "doc_id"], "left_semi")
    held = files.written(first.dropDuplicates(["set_key", "doc_id"])
                         .select(F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), F.explode(F.arrays_zip("classes", "registers")).alias("s"))
                         .select("rep", "n", F.col("s.classes").alias("cls"), F.col("s.registers").alias("registers")), "hmh-registers")
    files.drop(sketched)
    rows = _band_rows(held)
    pivots = rows.groupBy("sig").agg(F.min("rep").alias("a"), F.max("rep").alias("top")).where("a != top").drop("top")
    bands = files.written(rows.join(pivots, "sig"), "hmh-groups")
    # Only sets that share a band are made, once, and keep their registers.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    wanted = files.written(bands.select("rep").distinct(), "hmh-candidates")
    sets = files.written(_sets(texts, wanted, size), "hmh-sets")
    candidates = files.written(held.join(wanted, "rep", "left_semi"), "hmh-candidate-registers")
    files.drop(held)
    # Stars.
    pairs = bands.where((F.expr(BAND) < STAR_BANDS) & (F.col("rep") != F.col("a"))).select(F.expr(CLASS).alias("cls"), "a", F.col("rep").alias("b")).distinct()
    pairs = files.written(_estimated(pairs, candidates, threshold), "hmh-pairs")
    # One doc_id with several texts is one node: it ties the sets that it stands in.
    tied = (stands.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a != b").select("doc_id", "a")
            .join(stands.select("doc_id", F.col("rep").alias("b")), "doc_id").where("a != b").select("a", "b"))
    links = files.written(_confirmed(pairs, sets, threshold).unionByName(tied), "hmh-links")
    roots = components(links)
    # Cells: by short sets, and by whole ones if a short one has misled.
    cells = files.written(_cells(bands.select("sig", "rep"), roots), "hmh-cells")
    loads = candidates.join(sets, "rep").join(cells.select("rep").distinct(), "rep", "left_semi")
    for short in (True, False):
        tried = files.written(_passing(cells.join(_shortened(loads) if short else loads, ["rep", "cls"]), threshold, short), "hmh-passing")
        more = files.written(_confirmed(tried, sets, threshold), "hmh-more-links")
        if tried.join(more, ["a", "b"], "left_anti").isEmpty():
            break
    if not more.isEmpty():
        roots = components(links.unionByName(more))
    named = _rooted(stands.select("doc_id", "rep"), roots).groupBy("doc_id").agg(F.min("root").alias("component_id"))
    out = described.select("doc_id", "n_shingles").join(named, "doc_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))
