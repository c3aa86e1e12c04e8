"""Prefix trie of conversations as a distributed z-fast trie.

Every prefix of a conversation has a 128-bit name: the exclusive or of a hash of each turn together with its depth.  The
trie is compacted: its nodes are the places where conversations part or end, and a node's edge spans the depths
(p, e] from its parent's to its own.  A node's handle is its prefix at the depth of (p, e] that is divisible by the
highest power of two (the 2-fattest one); nodes are found by the handle's name.

1. Locate: for each conversation a fat binary search over its depths.  A step looks up its prefix at the 2-fattest depth of
   the interval left; a hit goes on below that node, a miss above that depth.  So a conversation of n turns takes about
   log2(n) joins, and its exit node is the one found last or that node's child.
2. Insert in batches: of all conversations that leave the trie at one place with one next turn, the one whose name hashes
   least becomes a new edge; edges are split where conversations leave them.  The others are located again from
   where they left.  The choice is as good as random, so about log2(n) rounds do, whatever the trie's shape.
3. Expand: each edge gives one node per depth.

Equal conversations are one string from the start.  Counts over subtrees are sums over the strings that pass a node; each
trie node is counted with the one string of the smallest conversation that passes it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from aeroloom.llm import files
from aeroloom.operators.sequence import number_rows

#: Depths of one conversation that a window goes through at a time.
BLOCK = 4096
#: conv_ids that are joined to one piece of text.
CHUNK = 1024
WORD = r"[^\x20\x09-\x0D]+"
NOTHING = hashlib.sha256(b"").hexdigest()
_EARLIER = (Window.unboundedPreceding, -1)


def borrowed(conv: Column) -> Column:
    """How many turns of another conversation stand at the head of conversation ``conv``."""
    return (F.crc32(conv.cast("string").cast("binary")) % 4).cast("int")


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv, nth, turns, a, b, words): every conversation's turns in order, named by two hashes; ``turns`` is their number."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    named = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").alias("at"), F.xxhash64(F.lit(1), role, F.lit(0), text).alias("a"),
        F.xxhash64(F.lit(2), role, F.lit(0), text).alias("b"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    return number_rows(named, ["conv"], ["at", "a", "b"], "nth", "turns").select("conv", F.col("nth").cast("int").alias("nth"),
                                                                                F.col("turns").cast("int").alias("turns"), "a", "b", "words")


def rebuilt_turns(turns: DataFrame, heads: Column, family: int = 20) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first ``heads`` turns are those of the first conversation of their family of ids.

    Returns (conv, length) of every conversation and (conv, depth, a, b, words) of the turns.
    """
    own = turns.groupBy("conv").agg(F.first("turns").alias("turns"))
    convs = own.select("conv", "turns", heads.alias("heads"), (F.col("conv") - F.col("conv") % family).alias("base"))
    first = own.select(F.col("conv").alias("base"), F.col("turns").alias("base_turns"))
    convs = convs.join(first, "base", "left").withColumn("taken", F.least("heads", F.coalesce("base_turns", F.lit(0))))
    convs = files.written(convs.select("conv", "base", "heads", "taken", (F.col("taken") + F.greatest(F.col("turns") - F.col("heads"), F.lit(0))).alias("length")),
                          "trie-conversations")
    # Few turns of a base, for at most as many conversations as a family has.
    before = convs.where("taken > 0").select("conv", "base", F.explode(F.expr("sequence(1, taken)")).alias("nth"))
    heads_of = turns.select(F.col("conv").alias("base"), "nth", "a", "b", "words")
    before = before.join(heads_of, ["base", "nth"]).select("conv", F.col("nth").alias("depth"), "a", "b", "words")
    after = (turns.join(convs.select("conv", "heads", "taken"), "conv").where("nth > heads")
             .select("conv", (F.col("nth") - F.col("heads") + F.col("taken")).alias("depth"), "a", "b", "words"))
    return convs.select("conv", "length"), before.unionByName(after)


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv, depth, x, y, before, words): the name (x, y) of every prefix, its last turn's words and those of the turns before.

    Running totals within blocks of depths, and of whole blocks before: no task holds a whole long conversation.
    """
    rows = turns.select("conv", "depth", F.floor(F.col("depth") / BLOCK).alias("block"), F.xxhash64("depth", "a", "b").alias("x"),
                        F.xxhash64("b", "depth", "a").alias("y"), "words")
    blocks = rows.groupBy("conv", "block").agg(F.bit_xor("x").alias("bx"), F.bit_xor("y").alias("by"), F.sum("words").alias("bw"))
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(*_EARLIER)
    blocks = blocks.select("conv", "block", *[F.coalesce(f(c).over(earlier), F.lit(0)).alias(c) for c, f in (("bx", F.bit_xor), ("by", F.bit_xor), ("bw", F.sum))])
    inside = Window.partitionBy("conv", "block").orderBy("depth")
    rows = rows.withColumns({"x": F.bit_xor("x").over(inside), "y": F.bit_xor("y").over(inside),
                             "before": F.coalesce(F.sum("words").over(inside.rowsBetween(*_EARLIER)), F.lit(0))})
    return rows.join(blocks, ["conv", "block"]).select("conv", "depth", F.col("x").bitwiseXOR(F.col("bx")).alias("x"), F.col("y").bitwiseXOR(F.col("by")).alias("y"),
                                                      (F.col("before") + F.col("bw")).alias("before"), "words")


def id_digests(named: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and ends_sha256: the SHA-256 of all conv_ids of a key, ascending, joined by commas.

    Ids are numbered over ranges and joined in pieces; a task then feeds the pieces of a key to one digest, in order and
    one batch at a time.
    """
    order = number_rows(named.select(*keys, "conv"), keys, ["conv"], "nth", "ids")
    pieces = (order.groupBy(*keys, F.floor((F.col("nth") - 1) / CHUNK).alias("piece"))
              .agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("text")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state = None, None
        for batch in batches:
            out = []
            for *now, text in zip(*(batch[k].tolist() for k in keys), batch["text"]):
                if now != key:
                    if key is not None:
                        out.append((*key, state.hexdigest()))
                    key, state = now, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(text.encode())
            yield pd.DataFrame(out, columns=[*keys, "ends_sha256"])
        if key is not None:
            yield pd.DataFrame([(*key, state.hexdigest())], columns=[*keys, "ends_sha256"])

    dealt = pieces.repartition(files.parts(named.sparkSession), *keys).sortWithinPartitions(*keys, "piece")
    schema = ", ".join(f"{k} {named.schema[k].dataType.simpleString()}" for k in keys)
    return dealt.select(*keys, "text").mapInPandas(run, f"{schema}, ends_sha256 string")


def fattest(low: str, high: str) -> Column:
    """The number in (low, high] that the highest power of two divides."""
    return F.expr(f"shiftleft(shiftright({high}, length(bin({low} ^ {high})) - 1), length(bin({low} ^ {high})) - 1)")


class Trie:
    """Compacted nodes (p, e, x, y, f, fx, fy, gx, gy, qx, qy, rep) over the strings of ``paths``.

    (x, y) names the node, (fx, fy) its handle at depth f, (gx, gy) its edge's first turn, (qx, qy) its parent; ``rep`` is a
    string through the node.  The root has no row.
    """

    def __init__(self, paths: DataFrame):
        self.paths = paths.select(F.col("conv").alias("t"), "depth", "x", "y")
        self.nodes = self._named(self.paths.limit(0).select(F.lit(0).alias("p"), F.col("depth").alias("e"), F.col("t").alias("rep")))

    def _at(self, rows: DataFrame, depth: Column, x: str, y: str, string: str = "t") -> DataFrame:
        """Adds the name (x, y) of each row's string at a depth from 1 to its length."""
        here = self.paths.select(F.col("t").alias(string), F.col("depth").alias("depth_of"), F.col("x").alias(x), F.col("y").alias(y))
        return rows.withColumn("depth_of", depth).join(here, [string, "depth_of"]).drop("depth_of")

    def _named(self, edges: DataFrame) -> DataFrame:
        """Nodes of edges (p, e, rep): names at four depths, from one join."""
        wanted = F.array(*[F.struct(F.lit(k).alias("kind"), d.cast("int").alias("depth")) for k, d in
                           (("", F.col("e")), ("f", fattest("p", "e")), ("g", F.col("p") + 1), ("q", F.col("p")))])
        rows = edges.withColumn("w", F.explode(wanted)).select("p", "e", "rep", "w.kind", "w.depth").join(self.paths.withColumnRenamed("t", "rep"), ["rep", "depth"])
        names = [F.max(F.when(F.col("kind") == k, F.col(c))).alias(f"{k}{c}") for k in ("", "f", "g", "q") for c in ("x", "y")]
        made = rows.groupBy("p", "e", "rep").agg(*names, F.max(F.when(F.col("kind") == "f", F.col("depth"))).alias("f"))
        root = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("qx", "qy")]  # the root's name
        return files.written(made.select("p", "e", "x", "y", "f", "fx", "fy", "gx", "gy", *root, "rep"), "trie-nodes")

    def locate(self, active: DataFrame) -> DataFrame:
        """Fat binary search of (t, length, a), ``a`` being the depth of a node on the way: (t, length, a) and the node found last (ce, cx, cy, cp, cf, crep)."""
        none = {"ce": "int", "cx": "long", "cy": "long", "cp": "int", "cf": "int", "crep": "long"}
        state = active.withColumns({"lo": F.col("a"), "hi": F.col("length"), **{c: F.lit(None).cast(k) for c, k in none.items()}})
        handles = self.nodes.select(F.col("f"), F.col("fx").alias("hx"), F.col("fy").alias("hy"), F.col("e").alias("ne"), F.col("x").alias("nx"), F.col("y").alias("ny"),
                                    F.col("p").alias("np"), F.col("rep").alias("nrep"))
        closed = []
        while True:
            probes = self._at(state.withColumn("f", fattest("lo", "hi").cast("int")), F.col("f"), "hx", "hy").join(handles, ["f", "hx", "hy"], "left")
            hit = F.col("ne").isNotNull()
            kept = {c: F.when(hit, F.col(n)).otherwise(F.col(c)) for c, n in (("ce", "ne"), ("cx", "nx"), ("cy", "ny"), ("cp", "np"), ("cf", "f"), ("crep", "nrep"))}
            state = files.written(probes.withColumns({"lo": F.when(hit, F.col("ne")).otherwise(F.col("lo")), "hi": F.when(hit, F.col("hi")).otherwise(F.col("f") - 1), **kept})
                                  .select("t", "length", "a", "lo", "hi", *none), "trie-search")
            closed.append(state.where("lo >= hi").drop("lo", "hi"))
            state = state.where("lo < hi")
            if state.isEmpty():
                break
        out = closed[0]
        for more in closed[1:]:
            out = out.unionByName(more)
        return out

    def exits(self, active: DataFrame) -> DataFrame:
        """Where strings leave the trie: (t, length, g, zx, zy) and the edge (ep, ee, ex, ey, erep) on which they do, null at a node.

        ``g`` is the depth up to which a string runs along the trie, (zx, zy) its name one deeper (at its end: there).
        """
        found = self._at(self.locate(active), F.when(F.col("ce") <= F.col("length"), F.col("ce")).otherwise(F.col("length")), "mx", "my")
        whole = F.col("ce").isNull() | ((F.col("ce") <= F.col("length")) & (F.col("mx") == F.col("cx")) & (F.col("my") == F.col("cy")))
        # The depth of a node that lies whole on the string, or null if the node found last is left before its end.
        found = found.withColumn("at", F.when(whole, F.coalesce("ce", "a")))
        found = self._at(found, F.least(F.col("at") + 1, F.col("length")), "nx", "ny")
        children = self.nodes.select((F.col("p") + 1).alias("below"), F.col("gx").alias("nx"), F.col("gy").alias("ny"), F.col("p").alias("vp"), F.col("e").alias("ve"),
                                     F.col("x").alias("vx"), F.col("y").alias("vy"), F.col("rep").alias("vrep"))
        below = F.when(F.col("at") < F.col("length"), F.col("at") + 1).otherwise(0)  # 0: no child is looked for
        found = found.withColumn("below", below).join(children, ["below", "nx", "ny"], "left")
        edge = {n: F.when(F.col("at").isNull(), F.col(c)).otherwise(F.col(v)) for n, c, v in
                (("ep", "cp", "vp"), ("ee", "ce", "ve"), ("ex", "cx", "vx"), ("ey", "cy", "vy"), ("erep", "crep", "vrep"))}
        known = F.when(F.col("at").isNull(), F.col("cf")).when(F.col("ve").isNotNull(), F.col("at") + 1).otherwise(F.col("at"))
        left = files.written(found.select("t", "length", known.alias("known"), *[c.alias(n) for n, c in edge.items()]), "trie-left")
        # How far a string runs along its edge, compared with the edge's own string depth by depth.
        last = F.least(F.col("ee") - 1, F.col("length"))
        along = left.where(last > F.col("known")).select("t", "erep", F.explode(F.sequence(F.col("known") + 1, last)).alias("depth"))
        along = self._at(self._at(along, F.col("depth"), "tx", "ty"), F.col("depth"), "rx", "ry", "erep")
        run = along.where("tx = rx AND ty = ry").groupBy("t").agg(F.count(F.lit(1)).cast("int").alias("run"))
        out = left.join(run, "t", "left").withColumn("g", F.col("known") + F.coalesce("run", F.lit(0))).drop("known", "run")
        return files.written(self._at(out, F.least(F.col("g") + 1, F.col("length")), "zx", "zy"), "trie-exits")

    def insert(self, exits: DataFrame) -> DataFrame:
        """Split edges, add a new edge for each place and next turn; returns the strings left over, from where they left."""
        on = exits.where("g < length")
        chosen = on.groupBy("g", "zx", "zy").agg(F.min(F.struct(F.xxhash64("t").alias("draw"), "t", "length")).alias("c"))
        chosen = files.written(chosen.select(F.col("g").alias("p"), F.col("c.length").alias("e"), F.col("c.t").alias("rep")), "trie-chosen")
        cut = files.written(exits.where("ee IS NOT NULL").select("ep", "ee", "ex", "ey", "erep", "g").distinct(), "trie-cuts")
        touched = cut.select("ep", "ee", "ex", "ey", "erep").distinct()
        points = cut.unionByName(touched.withColumn("g", F.col("ee")))
        pieces = _before(points, ["ep", "ee", "ex", "ey", "erep"], "g").select(F.coalesce("previous", "ep").alias("p"), F.col("g").alias("e"), F.col("erep").alias("rep"))
        kept = self.nodes.join(touched.select(F.col("ee").alias("e"), F.col("ex").alias("x"), F.col("ey").alias("y")), ["e", "x", "y"], "left_anti")
        made = self._named(pieces.unionByName(chosen))
        self.nodes = files.written(kept.unionByName(made), "trie-nodes")
        return files.written(on.join(chosen.select(F.col("rep").alias("t")), "t", "left_anti").select("t", "length", F.col("g").alias("a")), "trie-active")

    def build(self, strings: DataFrame) -> DataFrame:
        """Insert all strings (t, length) and return the nodes."""
        active = strings.where("length > 0").withColumn("a", F.lit(0))
        while not active.isEmpty():
            active = self.insert(self.exits(active))
        return self.nodes


def _before(points: DataFrame, keys: list[str], at: str) -> DataFrame:
    """Adds ``previous``: the next smaller value of ``at`` of the key, by blocks of values."""
    points = points.withColumn("block", F.floor(F.col(at) / BLOCK))
    lasts = points.groupBy(*keys, "block").agg(F.max(at).alias("last"))
    lasts = lasts.select(*keys, "block", F.lag("last").over(Window.partitionBy(*keys).orderBy("block")).alias("last"))
    inside = Window.partitionBy(*keys, "block").orderBy(at)
    return points.withColumn("previous", F.lag(at).over(inside)).join(lasts, [*keys, "block"]).withColumn("previous", F.coalesce("previous", "last")).drop("block", "last")


def prefix_trie(conversations: DataFrame, heads: Column | None = None) -> DataFrame:
    """One row per trie node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256.

    ``conversations`` has conv_id, turn, role and text; turns stand in order of ``turn``, null first, ties in an order
    that hangs on their role and text alone; repeated rows are turns of their own.  A null role or text is empty.  Rows
    without a conv_id take no part.  ``heads``, a function of ``conv``, is how many turns each conversation takes from the
    head of the first one of its family of twenty ids (`borrowed` if not given; 0 leaves all as they are).  A node
    is named by its smallest member and its depth: its last turn is that conversation's turn at that depth.  An empty
    table gives no rows.
    """
    turns = numbered_turns(conversations)
    lengths, turns = rebuilt_turns(files.written(turns, "trie-turns"), borrowed(F.col("conv")) if heads is None else heads)
    paths = files.written(prefixes(turns), "trie-prefixes")
    # Conversations by their whole string; a turnless one is the root's.
    last = paths.select("conv", F.col("depth").alias("length"), "x", "y", (F.col("before") + F.col("words")).alias("total"))
    whole = lengths.join(last, ["conv", "length"], "left").fillna(0, ["x", "y", "total"])
    whole = files.written(whole, "trie-strings")
    key = ["length", "x", "y"]
    strings = files.written(whole.groupBy(*key).agg(F.min("conv").alias("t"), F.count(F.lit(1)).alias("copies"), F.max("total").alias("total")), "trie-distinct")
    ends = files.written(id_digests(whole, key), "trie-ends")
    of_strings = files.written(paths.join(strings.select(F.col("t").alias("conv")), "conv", "left_semi"), "trie-paths")
    nodes = Trie(of_strings).build(strings.select("t", "length"))
    return _expand(nodes, strings, of_strings, ends)


def _expand(nodes: DataFrame, strings: DataFrame, paths: DataFrame, ends: DataFrame) -> DataFrame:
    """Sums over subtrees for the compacted nodes, then every depth of their edges."""
    name = ["e", "x", "y"]
    root = strings.where("length = 0").select(F.lit(0).alias("e"), "x", "y")
    children = nodes.groupBy(F.col("p").alias("e"), F.col("qx").alias("x"), F.col("qy").alias("y")).agg(F.count(F.lit(1)).alias("n_children"))
    children = files.written(children, "trie-children")
    leaves = strings.select("t", F.col("length").alias("e"), "x", "y", "copies", "total").join(children, name, "left")
    leaves = leaves.select("t", "copies", "total", F.col("e").alias("length"), F.col("n_children").isNull().cast("long").alias("leaf"))
    # Strings through each node: at most one row per turn.
    through = paths.select(F.col("conv").alias("t"), F.col("depth").alias("e"), "x", "y", "before").join(nodes.select("p", *name), name)
    everywhere = strings.select("t", F.lit(0).alias("e"), F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"), F.lit(0).cast("long").alias("before"), F.lit(-1).alias("p"))
    through = files.written(through.select("t", *name, "before", "p").unionByName(everywhere).join(leaves, "t"), "trie-through")
    tops = files.written(through.groupBy(*name).agg(F.min("t").alias("conv_id"), F.sum("copies").alias("n_convs"), F.sum("leaf").alias("n_leaves")), "trie-tops")
    # From which depth on a string's nodes are its own, and the words up to there.
    own = through.join(tops.select(*name, F.col("conv_id").alias("t")), [*name, "t"]).groupBy("t").agg(F.min("p").alias("own"))
    shared = strings.select("t", "length").join(own, "t", "left").select("t", F.greatest(F.coalesce("own", "length"), F.lit(0)).alias("own"))
    shared = shared.join(paths.select(F.col("conv").alias("t"), F.col("depth").alias("own"), (F.col("before") + F.col("words")).alias("shared")), ["t", "own"], "left")
    shared = shared.select("t", F.coalesce("shared", F.lit(0)).alias("shared"))
    saved = F.sum(F.col("copies") * (F.col("total") - F.col("before")) - (F.col("total") - F.greatest("before", "shared")))
    saved = through.join(shared, "t").groupBy(*name).agg(saved.alias("saved"))
    stats = files.written(tops.join(saved, name).join(children, name, "left").join(ends.withColumnRenamed("length", "e"), name, "left"), "trie-stats")
    # Each depth of an edge has the members of the edge's end; texts and words are the smallest member's.
    parents = tops.select(F.col("e").alias("p"), F.col("x").alias("qx"), F.col("y").alias("qy"), F.col("conv_id").alias("parent"))
    edges = nodes.select("p", *name, "qx", "qy").join(stats, name).join(parents, ["p", "qx", "qy"])
    words = paths.select(F.col("conv").alias("conv_id"), "depth", "before")
    edges = edges.join(words.select("conv_id", F.col("depth").alias("e"), F.col("before").alias("before_end")), ["conv_id", "e"])
    spread = edges.withColumn("depth", F.explode(F.sequence(F.col("p") + 1, F.col("e")))).join(words, ["conv_id", "depth"])
    end = F.col("depth") == F.col("e")
    below = spread.select(
        "conv_id", F.col("depth").cast("long").alias("depth"), F.when(F.col("depth") - 1 == F.col("p"), F.col("parent")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        "n_convs", F.when(end, F.coalesce("n_children", F.lit(0))).otherwise(1).cast("long").alias("n_children"), "n_leaves",
        (F.col("saved") + (F.col("n_convs") - 1) * (F.col("before_end") - F.col("before"))).alias("saved_tokens"),
        F.when(end, F.coalesce("ends_sha256", F.lit(NOTHING))).otherwise(NOTHING).alias("ends_sha256"))
    top = stats.where("e = 0").select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs",
                                      F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves",
                                      F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"))
    return top.unionByName(below)
