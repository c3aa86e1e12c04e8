"""Merkle manifest of a table: a tree of hashes per source, one tree over the sources, and a proof for every row.

Each row is a leaf.  Per source, leaves stand in order; every `RUN` consecutive nodes of a level are hashed into one of
the next, until one is left, the subroot.  The subroots, in order of source, are the leaves of one more tree.  All
digests are SHA-256 in lower-case hex, and a node is the hash of its children's digests written one after the other.

Cogrouped subtree exchange: `LEVELS` levels at a time make a superblock of RUN ** LEVELS consecutive nodes.

1. upwards, each superblock is reduced to the node that stands for it, and these nodes to theirs, until each tree has
   one node: a table per pass, each RUN ** LEVELS times smaller than the one below;
2. downwards, nodes and the path above their superblock (the runs that lead from it to the root) meet by superblock in a
   cogroup.  It rebuilds the superblock's own levels, puts its runs in front of the path, and at the leaves folds
   every leaf along its whole path.

A task holds one superblock and one path, however large a source is, and no node but a run's siblings travels down.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from aeroloom.llm import files
from aeroloom.operators.sequence import number_rows

RUN, LEVELS = 16, 2
BLOCK = RUN ** LEVELS
HEX = 64
_PATH = "at array<int>, runs array<string>, subroot string, root string"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


def levels_of(nodes: list[str], total: int) -> list[list[str]]:
    """Levels of one superblock from its nodes to the node that stands for it; ``total`` nodes are on its tree's level."""
    levels = [nodes]
    while total > 1 and len(levels) <= LEVELS:
        below = levels[-1]
        levels.append([digest("".join(below[i:i + RUN])) for i in range(0, len(below), RUN)])
        total = -(-total // RUN)
    return levels


def steps_of(levels: list[list[str]], i: int) -> tuple[list[int], list[str]]:
    """For node ``i`` of the lowest level: its place in its run and that run's digests in a row, level by level."""
    at, runs = [], []
    for below in levels[:-1]:
        at.append(i % RUN)
        i //= RUN
        runs.append("".join(below[i * RUN:(i + 1) * RUN]))
    return at, runs


def siblings(at, runs) -> list[str]:
    """The digests that a proof needs, level by level, without the node's own."""
    return [run[:HEX * a] + run[HEX * (a + 1):] for a, run in zip(at, runs)]


def fold(leaf: str, at, runs) -> str:
    """The root that a leaf and its proof's siblings give."""
    for a, run in zip(at, runs):
        leaf = digest(run[:HEX * a] + leaf + run[HEX * (a + 1):])
    return leaf


def leaf_hash(*values: Column) -> Column:
    """SHA-256 of the values in a row: each its number of UTF-8 bytes, a colon and itself, or ``-`` if null."""
    def written(v: Column) -> Column:
        text = v.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(written, values)), 256)


def _tree(source: Column) -> Column:
    """Key of a source's tree; the null source sorts before all others, and those bytewise."""
    return F.coalesce(F.concat(F.lit("1"), source.cast("string")), F.lit("0"))


def _climb(nodes: DataFrame) -> DataFrame:
    """One node (tree, block, pos, total, hash) for each superblock of such nodes."""
    def reduce(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        total = int(pdf["total"].iloc[0])
        top = levels_of(pdf["hash"].tolist(), total)[-1]
        block = int(pdf["block"].iloc[0])
        return pd.DataFrame({"tree": pdf["tree"].iloc[:1], "block": block // BLOCK, "pos": block, "total": -(-total // BLOCK), "hash": top})

    wanted = nodes.select("tree", "block", "pos", "total", "hash")
    return wanted.groupBy("tree", "block").applyInPandas(reduce, "tree string, block long, pos long, total long, hash string")


def _passes(nodes: DataFrame) -> list[DataFrame]:
    """Tables of nodes from the leaves up to one node per tree."""
    tables = [nodes]
    most = nodes.agg(F.max("total")).first()[0] or 0
    while most > 1:
        tables.append(files.written(_climb(tables[-1]), "merkle-nodes"))
        most = -(-most // BLOCK)
    return tables


def _descend(nodes: DataFrame, outer: DataFrame) -> DataFrame:
    """Path (tree, block, at, runs, subroot, root) of every node, as the outer path of the superblock that it stands for."""
    def join(below: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        below = below.sort_values("pos")
        path = above.iloc[0]
        levels = levels_of(below["hash"].tolist(), int(below["total"].iloc[0]))
        steps = [steps_of(levels, i) for i in range(len(below))]
        return pd.DataFrame({"tree": below["tree"], "block": below["pos"], "at": [[*a, *path["at"]] for a, _ in steps],
                             "runs": [[*r, *path["runs"]] for _, r in steps], "subroot": path["subroot"], "root": path["root"]})

    return (nodes.select("tree", "block", "pos", "total", "hash").groupBy("tree", "block").cogroup(outer.groupBy("tree", "block"))
            .applyInPandas(join, f"tree string, block long, {_PATH}"))


def _down(tables: list[DataFrame], outer: DataFrame) -> DataFrame:
    """Paths of the superblocks of the lowest table, from those of the nodes at the top."""
    for nodes in reversed(tables[1:]):
        outer = files.written(_descend(nodes, outer), "merkle-paths")
    return outer


def _prove(leaves: DataFrame, outer: DataFrame, proofs: bool) -> DataFrame:
    """Rows (tree, pos, id, leaf, subroot, root, proof_sha256, folded_root, verified), and proof if wanted."""
    def finish(below: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        below = below.sort_values("pos")
        path = above.iloc[0]
        levels = levels_of(below["hash"].tolist(), int(below["total"].iloc[0]))
        outer_at, outer_runs = list(path["at"]), list(path["runs"])
        outer_siblings = siblings(outer_at, outer_runs)
        outer_text, given, folded, lists = "".join(outer_siblings), [], [], []
        for i, (own, seen) in enumerate(zip(below["hash"], below["seen"])):
            at, runs = steps_of(levels, i)
            inner = siblings(at, runs)
            given.append(digest("".join(inner) + outer_text))
            folded.append(fold(seen if isinstance(seen, str) else own, [*at, *outer_at], [*runs, *outer_runs]))
            if proofs:
                lists.append([*inner, *outer_siblings])
        out = pd.DataFrame({"tree": below["tree"], "pos": below["pos"], "id": below["id"], "leaf": below["hash"], "subroot": path["subroot"], "root": path["root"],
                            "proof_sha256": given, "folded_root": folded, "verified": [f == path["root"] for f in folded]})
        return out.assign(proof=lists) if proofs else out

    schema = "tree string, pos long, id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return (leaves.select("tree", "block", "pos", "total", "hash", "id", "seen").groupBy("tree", "block").cogroup(outer.groupBy("tree", "block"))
            .applyInPandas(finish, schema + (", proof array<string>" if proofs else "")))


def manifest(docs: DataFrame, columns: list[str], source: str = "source", key: str = "doc_id", seen: dict[str, Column] | None = None,
             when: Column | None = None, proofs: bool = False) -> DataFrame:
    """One row per row of ``docs``: the key, ``source``, ``pos`` (from 0, in its source), leaf, subroot, root, proof_sha256, folded_root, verified.

    A leaf is the hash of ``columns``.  Rows for which ``when`` holds are checked with the columns in ``seen`` in
    place of theirs: folded_root is what the row as seen and its proof give, and ``verified`` whether that is the root.
    With ``proofs``, ``proof`` lists for each level the siblings' digests in a row.

    A null source is a source and comes first; a null key comes first in its source; rows with one key stand in order of
    their leaves, and equal rows are leaves of their own.  An empty table gives no rows.  Other columns of ``docs`` don't
    matter, whatever their names.
    """
    texts = {c: F.col(c) for c in columns}
    changed = leaf_hash(*({**texts, **(seen or {})}[c] for c in columns))
    leaves = docs.select(_tree(F.col(source)).alias("tree"), F.col(key).alias("id"), leaf_hash(*texts.values()).alias("hash"),
                         (F.when(when, changed) if when is not None else F.lit(None).cast("string")).alias("seen"))
    leaves = number_rows(files.written(leaves, "merkle-leaves"), ["tree"], ["id", "hash"], "nth", "total")
    leaves = leaves.select("tree", (F.col("nth") - 1).alias("pos"), F.floor((F.col("nth") - 1) / BLOCK).alias("block"), "total", "hash",
                           F.col("id").cast("string").alias("id"), "seen")
    leaves = files.written(leaves, "merkle-placed")
    trees = _passes(leaves)
    # The subroots are leaves of the last tree, in order of source.
    roots = trees[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "hash")
    roots = number_rows(roots, ["tree"], ["name"], "nth", "total")
    roots = files.written(roots.select("tree", "name", (F.col("nth") - 1).alias("pos"), F.floor((F.col("nth") - 1) / BLOCK).alias("block"), "total", "hash"), "merkle-subroots")
    forest = _passes(roots)
    empty = F.array()
    top = forest[-1].select("tree", F.lit(0).cast("long").alias("block"), empty.cast("array<int>").alias("at"), empty.cast("array<string>").alias("runs"),
                            F.lit(None).cast("string").alias("subroot"), F.col("hash").alias("root"))
    if len(forest) > 1:
        above = _descend(roots, _down(forest, top)).select(F.col("block").alias("pos"), "at", "runs", "root")
    else:  # one source: its subroot is the root
        above = top.select(F.lit(0).cast("long").alias("pos"), "at", "runs", "root")
    outer = (roots.select("pos", F.col("name").alias("tree"), F.col("hash").alias("subroot")).join(above, "pos")
             .select("tree", F.lit(0).cast("long").alias("block"), "at", "runs", "subroot", "root"))
    out = _prove(leaves, _down(trees, files.written(outer, "merkle-paths")), proofs)
    named = F.when(F.col("tree") != "0", F.substring("tree", 2, 1 << 30))
    return out.select(F.col("id").cast(docs.schema[key].dataType).alias(key), named.alias(source), "pos", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                      "verified", *(["proof"] if proofs else []))
