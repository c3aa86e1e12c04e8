"""What joins of shingle sets have in common: sets, exact comparison, and components of links from groups of candidates.

A method gives each set sketches by class and signatures; sets with one signature are a group of candidates.

1. Stars: in some of the groups, each member is paired with the group's smallest.  Pairs that the sketches allow are
   confirmed on their full sets, and links make components.  In all groups that still hold several components, members
   are then paired with the smallest and the largest, where these are of another component.  That settles groups of three.
2. Cells: larger groups that still hold several components are looked through inside tasks, very large ones in pairs of
   blocks.  Members of one component are not compared.  Each pair is looked at in one of its groups alone, or else groups
   of the same members are one cell.  Pairs that the sketches allow are confirmed like the others.  A cell with a member that
   has more than `FEW` such partners is looked through again with short forms of the sets, where what passes counts as one
   component from then on; and once more with whole sets if a short form has misled.

So copies and near copies cost a pair per member and group, not one per pair, and pairs leave a task only if they link.
Whole sets are made, from their texts, for pairs that the sketches allow and for the cells that need them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from aeroloom.llm import files, text as T


def shingle_sets(texts: list[str], size: int) -> list[np.ndarray]:
    """Distinct shingle hashes of each text, ascending; A-Z count as a-z.  A text without words has none."""
    out = []
    for lo, hi in T.chunks(texts):
        cp, offsets = T.code_points(texts[lo:hi])
        cp = T.lower_ascii(cp)
        starts, ends, first = T.word_spans(T.plain_words(cp), offsets)
        words = T.span_hashes(cp, starts, ends)
        out += [np.unique(T.shingle_hashes(words[first[i]:first[i + 1]], size)) for i in range(hi - lo)]
    return out


def linked(a: np.ndarray, b: np.ndarray, threshold: tuple[int, int]) -> bool:
    """Whether q * |A and B| >= p * |A or B| for the threshold p / q."""
    p, q = threshold
    small, large = sorted((len(a), len(b)))
    if small == 0 or q * small < p * large:
        return False
    both = small + large - len(np.union1d(a, b)) if small < 64 else _common(a, b)
    return q * both >= p * (small + large - both)


def _common(a: np.ndarray, b: np.ndarray) -> int:
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def sets_of(docs: DataFrame, wanted: DataFrame, size: int, short: bool = False) -> DataFrame:
    """(rep, elements) of the wanted documents, made anew from their texts; with ``short``, in short form."""
    # Written first: Spark knows how few they are before it deals the texts.
    ids = files.written(wanted.select(F.col("rep").alias("doc_id")).distinct(), "wanted")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            for lo, hi in T.chunks(texts):
                raw = [short_form(s) if short else s.astype("<u8").tobytes() for s in shingle_sets(texts[lo:hi], size)]
                yield pd.DataFrame({"rep": batch["doc_id"].iloc[lo:hi].array, "elements": raw})

    return docs.join(ids, "doc_id", "left_semi").select("doc_id", "text").mapInPandas(run, "rep long, elements binary")


def short_form(elements: np.ndarray) -> bytes:
    """The distinct low bytes of a set's elements, as many as leave few of them alike: two to four per element."""
    width = 2 if len(elements) < 256 else 3 if len(elements) < 1 << 16 else 4
    low = np.unique(elements & np.uint64((1 << (8 * width)) - 1)).astype("<u4")
    return bytes([width]) + low.view(np.uint8).reshape(-1, 4)[:, :width].tobytes()


def read_form(raw: bytes, short: bool) -> np.ndarray:
    """Elements, ascending, of a short form or of a whole set."""
    if not short:
        return np.frombuffer(raw, "<u8")
    out = np.zeros(((len(raw) - 1) // raw[0], 4), np.uint8)
    out[:, :raw[0]] = np.frombuffer(raw, np.uint8, offset=1).reshape(-1, raw[0])
    return out.view("<u4").ravel()


def confirmed(pairs: DataFrame, docs: DataFrame, size: int, threshold: tuple[int, int], name: str) -> DataFrame:
    """Those of the pairs (a, b) whose full sets link, as a written table; sets are made for the pairs' documents alone."""
    sets = files.written(sets_of(docs, pairs.select(F.explode(F.array("a", "b")).alias("rep")), size), f"{name}-sets")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ok = [linked(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), threshold) for x, y in zip(batch["x"], batch["y"])]
            yield batch.loc[ok, ["a", "b"]]

    joined = (pairs.join(sets.select(F.col("rep").alias("b"), F.col("elements").alias("y")), "b")
              .join(sets.select(F.col("rep").alias("a"), F.col("elements").alias("x")), "a"))
    # A doc_id with several texts links if one of them does.
    out = files.written(joined.select("a", "b", "x", "y").mapInPandas(run, "a long, b long").distinct(), name)
    files.drop(sets)
    files.release(docs.sparkSession)
    return out


def components(links: DataFrame, rounds: int = 200) -> DataFrame:
    """(node, root): the smallest node that each node of the links (a, b) reaches.

    Alternates stars: every node's larger neighbours are tied to its smallest neighbour, then its smaller ones, until
    nothing changes.  Each round is written to the shared folder, so its lineage ends there.
    """
    edges = files.written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "edges")
    if edges.isEmpty():
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    before = None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Larger neighbours to the smallest one.
        large = files.written(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "edges")
        # Smaller neighbours, and the node itself, to the smallest one.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = files.written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    return rows.join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))


def common_of_short(a: np.ndarray, b: np.ndarray, n: int, m: int) -> int:
    """Common elements of two sets of n and m elements, at most, from their distinct short forms."""
    if len(a) and len(b) and (n < 256) != (m < 256) or (n < 1 << 16) != (m < 1 << 16):
        width = 2 if min(n, m) < 256 else 3  # forms of two widths meet in the shorter
        a, b = (np.unique(x & np.uint32((1 << (8 * width)) - 1)) if x.dtype.itemsize == 4 else x for x in (a, b))
    small, large = (a, b) if len(a) < len(b) else (b, a)
    common = int((large[np.minimum(np.searchsorted(large, small), len(large) - 1)] == small).sum())
    # Elements that fell together in the short form may all be common.
    return min(common + max(n - len(a), m - len(b)), n, m)


#: Partners that a member of a cell may have by sketches alone.
FEW = 16


@dataclass
class Method:
    """A way to find candidates."""

    name: str
    #: docs -> (doc_id, n_shingles, set_key, classes, sketches); set_key is null for the empty set.
    sketches: Callable[[DataFrame], DataFrame]
    #: (rep, n, cls, sketch) -> (sig, rep, ...) dealt by sig, a row per signature.
    signatures: Callable[[DataFrame], DataFrame]
    #: pairs (cls, a, b) and sketches -> those of (a, b) that may link.
    possible: Callable[[DataFrame, DataFrame], DataFrame]
    #: rows of one cell -> function of a member's place and those of others before it, giving the others that may link with it.
    near: Callable[[pd.DataFrame], Callable[[int, np.ndarray], np.ndarray]]
    #: SQL over signature rows: what a cell must know of its signature, the class, and whether stars are made of it.
    mark: str
    cls: str
    star: str
    #: Members of a group that one task looks through; larger groups go in pairs of blocks of this size.
    block: int
    #: Whether ``look`` takes each pair in one of its groups alone, so that no group may be left out for another.
    one_place: bool
    #: What of the sketches the comparisons need.
    lighten: Callable[[DataFrame], DataFrame] = lambda held: held


def _groups(method: Method, held: DataFrame) -> DataFrame:
    """(sig, rep, low, mark, cls, star): signatures that two sets at least have, with the least of them."""
    rows = method.signatures(held)
    # Both branches read all columns, so the rows are dealt once.
    pivots = (rows.groupBy("sig").agg(F.min("rep").alias("low"), F.max("rep").alias("top"), F.min(F.expr(method.cls)).alias("least_cls"))
              .where("low != top AND least_cls >= 0").drop("least_cls", "top"))
    return rows.join(pivots, "sig").select("sig", "rep", "low", F.expr(method.mark).alias("mark"), F.expr(method.cls).alias("cls"), F.expr(method.star).alias("star"))


def _mixed(members: DataFrame) -> DataFrame:
    """The groups of (sig, rep, root, cls) that hold several components, with their ends and what names their members.

    It reads the columns that its callers join to it, so that Spark deals the members once for both."""
    return (members.groupBy("sig").agg(
        F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("who"),
        F.min("rep").alias("low"), F.max("rep").alias("top"), F.min_by("root", "rep").alias("low_root"), F.max_by("root", "rep").alias("top_root"),
        F.min("cls").alias("least_cls")).where("lo != hi AND least_cls >= 0").drop("lo", "hi", "least_cls"))


def _once(pairs: DataFrame) -> DataFrame:
    """Each pair (a, b) in one of the classes (cls, a, b) where it comes: what one class rules out, cannot link in any.

    The last class has the most sums."""
    return pairs.groupBy("a", "b").agg(F.max("cls").alias("cls")).select("cls", "a", "b")


def _dealt(members: DataFrame) -> DataFrame:
    """Members dealt by their group: what is counted per group and joined to it again moves no row a second time."""
    # A filter that one branch alone needs would keep the branches apart; no root is null.
    return members.where("root IS NOT NULL").repartition(files.parts(members.sparkSession), "sig").select("sig", "rep", "root", "mark", "cls")


def _ends(members: DataFrame) -> DataFrame:
    """Pairs (cls, a, b) of members with the ends of their groups, where these are of another component."""
    members = _dealt(members)
    ends = F.array(F.struct(F.col("low").alias("end"), F.col("low_root").alias("end_root")), F.struct(F.col("top").alias("end"), F.col("top_root").alias("end_root")))
    pairs = members.join(_mixed(members), "sig").select("cls", "rep", "root", F.explode(ends).alias("e")).where("root != e.end_root")
    return _once(pairs.select("cls", F.least("rep", "e.end").alias("a"), F.greatest("rep", "e.end").alias("b")))


def _cells(method: Method, members: DataFrame) -> DataFrame:
    """(cell, side, mark, cls, rep, root) of the groups of four and more that hold several components, in blocks."""
    members = _dealt(members)
    mixed = _mixed(members).where("n > 3")
    if not method.one_place:
        mixed = mixed.groupBy("n", "who", "low").agg(F.min("sig").alias("sig"))
    mixed = mixed.select("sig", F.ceil(F.col("n") / method.block).cast("int").alias("blocks"))
    # A member of block i meets every block j: it goes to the cell of the two.
    return (members.join(mixed, "sig").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select(F.concat_ws(":", "sig", F.least("block", "other"), F.greatest("block", "other")).alias("cell"), F.col("block").alias("side"),
                    "mark", "cls", "rep", "root"))


def _look(cell: pd.DataFrame, method: Method, threshold: tuple[int, int], form: str) -> list[tuple]:
    """Pairs (a, b) of different components in one cell that may link, by sketches or by sets; (None, None) if those are too many."""
    p, q = threshold
    rep, n, side = (cell[c].to_numpy(np.int64) for c in ("rep", "n", "side"))
    label = np.unique(cell["root"].to_numpy(), return_inverse=True)[1]
    near_of, two, found = method.near(cell), len(np.unique(side)) > 1, []
    raw = cell["elements"].tolist() if form != "sketch" else []
    for i in range(1, len(rep)):
        fit = (label[:i] != label[i]) & (q * np.minimum(n[i], n[:i]) >= p * np.maximum(n[i], n[:i]))
        if two:
            fit &= side[:i] != side[i]
        near = np.flatnonzero(fit)
        near = near_of(i, near) if len(near) else near
        if form == "sketch":
            if len(near) > FEW:
                return [(None, None)]
            found += [(int(rep[j]), int(rep[i])) for j in near]
            continue
        own = read_form(raw[i], form == "short") if len(near) else None
        for j in near.tolist():
            if label[j] == label[i]:
                continue
            common = common_of_short(own, read_form(raw[j], form == "short"), int(n[i]), int(n[j]))
            if q * common >= p * (n[i] + n[j] - common):
                found.append((int(rep[j]), int(rep[i])))
                label[label == label[j]] = label[i]
    return found


def _passing(method: Method, cells: DataFrame, threshold: tuple[int, int], form: str) -> DataFrame:
    """(cell, a, b) of all cells (cell, side, mark, cls, rep, root, n, sketch, and elements by ``form``); each cell lies in one task, in order."""
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
        found = [(name, *pair) for name, cell in rows.groupby("cell", sort=False) for pair in _look(cell, method, threshold, form)]
        out = pd.DataFrame(found, columns=["cell", "a", "b"])
        return out.astype({"a": "Int64", "b": "Int64"})

    dealt = cells.repartition(files.parts(cells.sparkSession), "cell").sortWithinPartitions("cell", "rep")
    columns = ["cell", "side", "mark", "cls", "rep", "root", "n", "sketch", *(["elements"] if form != "sketch" else [])]
    return dealt.select(columns).mapInPandas(run, "cell string, a long, b long")


def linked_classes(docs: DataFrame, method: Method, size: int, threshold: tuple[int, int]) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs`` (``doc_id, text``)."""
    name = method.name
    sketched = files.written(method.sketches(docs), f"{name}-sketches")
    described = files.written(sketched.select("doc_id", "n_shingles", "set_key"), f"{name}-described")
    known = described.where("doc_id IS NOT NULL AND set_key IS NOT NULL")
    # Each set once: its smallest doc_id stands for all its copies.
    reps = known.groupBy("set_key").agg(F.min("doc_id").alias("rep"))
    stands = files.written(known.select("doc_id", "set_key").distinct().join(reps, "set_key"), f"{name}-stands")
    first = sketched.where("size(classes) > 0").join(stands.where("doc_id = rep").select("doc_id", "set_key"), ["set_key", "doc_id"], "left_semi")
    held = files.written(first.dropDuplicates(["set_key", "doc_id"])
                         .select(F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), F.explode(F.arrays_zip("classes", "sketches")).alias("s"))
                         .select("rep", "n", F.col("s.classes").alias("cls"), F.col("s.sketches").alias("sketch")), f"{name}-held")
    files.drop(sketched)
    groups = files.written(_groups(method, held), f"{name}-groups")
    files.release(docs.sparkSession)
    # Only sets that share a signature keep their sketches.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    wanted = files.written(groups.select("rep").distinct(), f"{name}-candidates")
    candidates = files.written(method.lighten(held).join(wanted, "rep", "left_semi"), f"{name}-candidate-sketches")
    files.drop(held)
    files.release(docs.sparkSession)
    # Stars.
    pairs = _once(groups.where("star AND rep != low").select("cls", F.col("low").alias("a"), F.col("rep").alias("b")))
    pairs = files.written(method.possible(pairs, candidates), f"{name}-pairs")
    # One doc_id with several texts is one node: it ties the sets that it stands in.
    tied = (stands.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a != b").select("doc_id", "a")
            .join(stands.select("doc_id", F.col("rep").alias("b")), "doc_id").where("a != b").select("a", "b"))
    links = files.written(confirmed(pairs, texts, size, threshold, f"{name}-star-links").unionByName(tied), f"{name}-links")
    roots = components(links)
    members = files.written(rooted(groups.select("sig", "rep", "mark", "cls"), roots), f"{name}-members")
    files.drop(groups)
    ends = files.written(method.possible(_ends(members), candidates), f"{name}-end-pairs")
    more = confirmed(ends, texts, size, threshold, f"{name}-end-links")
    links = links.unionByName(more)
    roots = components(links)
    members = files.written(rooted(members.drop("root"), roots), f"{name}-members")
    files.release(docs.sparkSession)
    cells = files.written(_cells(method, members), f"{name}-cells")
    files.drop(members)
    for form in ("sketch", "short", "whole"):
        loads = candidates
        if form != "sketch":
            loads = candidates.join(sets_of(texts, cells.select("rep"), size, short=form == "short"), "rep")
        tried = files.written(_passing(method, cells.join(loads, ["rep", "cls"]), threshold, form), f"{name}-passing")
        more = confirmed(tried.where("a IS NOT NULL").select("a", "b").distinct(), texts, size, threshold, f"{name}-more-links")
        links = links.unionByName(more)
        if form == "sketch":
            again = tried.where("a IS NULL").select("cell").distinct()
        else:  # what passed and proved wrong may have hidden a link
            again = tried.join(more, ["a", "b"], "left_anti").select("cell").distinct()
        cells = files.written(cells.join(again, "cell", "left_semi"), f"{name}-cells")
        if form == "whole" or cells.isEmpty():
            break
        cells = files.written(rooted(cells.drop("root"), components(links)), f"{name}-cells")
    roots = components(links)
    named = rooted(stands.select("doc_id", "rep"), roots).groupBy("doc_id").agg(F.min("root").alias("component_id"))
    out = described.select("doc_id", "n_shingles").join(named, "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
