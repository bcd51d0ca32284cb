"""Merkle manifest of a dataset, with nested-interval labels.

Each row is a leaf.  The leaves of a source, ranked by id, form a tree: every ``fanout``
consecutive nodes are hashed to one of the level above, until one is left, the source's subroot;
the subroots, ranked by source, form the upper tree likewise, whose root stands for the dataset.

Every node carries the half-open interval ``[lo, hi)`` of leaf ranks that it covers.  A node of
level k covers at most ``fanout**k`` ranks and starts at a multiple of it, so
``floor(lo / fanout**k)`` is its bucket there, and a node of the level below lies in a parent of
its own bucket: an equi-join on tree and bucket with containment of the intervals.  What the
parent covers and the node doesn't are the intervals of its siblings.  Going down level by level,
nodes hand their proof (the siblings on each level up to the root) to the nodes they contain; the
work is in proportion to the number of nodes, 1.5 times that of the leaves, and only the last
join touches every leaf.

Defined results: a null field is hashed as ``-``; rows are ordered by id (nulls first), then by
leaf digest, so that rows that share an id have fixed places; repeated rows are leaves each; a
null source is a source of its own, before all others; an empty table has no rows and no root.
Only the named columns are read; others, whatever their names, play no part.  Texts are hashed
whole, whatever their length.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termweave.llm.common import crc_of_id, staged
from termweave.llm.ranks import numbered, ranked

FANOUT = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:``, the value."""
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def digest(*inputs: Column) -> Column:
    """sha256 of the inputs one after another, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*inputs) if len(inputs) > 1 else inputs[0], 256))


def hex_text(d: Column) -> Column:
    return F.lower(F.hex(d))


def _digests_text(nodes: Column) -> Column:
    return F.array_join(F.transform(nodes, lambda x: hex_text(x["digest"])), "")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its proof (``left`` and ``right`` digests a level) lead to."""
    return F.aggregate(path, leaf, lambda acc, x: digest(
        hex_text(x["left"]), hex_text(acc), hex_text(x["right"])))


def siblings(path: Column) -> Column:
    """The proof's digests, level by level and left to right, as hex text."""
    return F.array_join(F.transform(path, lambda x: F.concat(hex_text(x["left"]), hex_text(x["right"]))), "")


@dataclass
class Trees:
    """Trees over ranked leaves.  ``levels[0]`` has the leaves; each level has (tree, n, lo, hi,
    digest), and above the leaves ``parts``, the intervals and digests of the nodes below."""

    levels: list[DataFrame]
    fanout: int

    def nodes(self) -> DataFrame:
        """(level, tree, lo, hi, digest) of every node."""
        out = [x.select(F.lit(k).alias("level"), "tree", "lo", "hi", "digest") for k, x in enumerate(self.levels)]
        return _union(out)

    def tops(self) -> DataFrame:
        """(tree, n, digest): the node of each tree that covers all its leaves."""
        return _union([x.where(_is_top()).select("tree", "n", "digest") for x in self.levels])


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for x in frames[1:]:
        out = out.unionByName(x)
    return out


def _is_top() -> Column:
    return F.col("hi") - F.col("lo") == F.col("n")


def _bucket(k: int, fanout: int) -> Column:
    return F.floor(F.col("lo") / F.lit(fanout ** k)).cast("long")


def build(leaves: DataFrame, fanout: int = FANOUT) -> Trees:
    """``leaves``: (tree, rank, n, digest) with ranks 0 to n-1 in each tree, a written table."""
    levels = [leaves.select("tree", "n", F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "digest")]
    most = levels[0].agg(F.max("n")).first()[0] or 0
    width, k = 1, 0
    while width < most:
        width, k = width * fanout, k + 1
        part = F.struct("lo", "hi", "digest")
        up = (levels[-1].where(~_is_top()).groupBy("tree", "n", _bucket(k, fanout).alias("bucket"))
              .agg(F.array_sort(F.collect_list(part)).alias("parts")))  # fanout parts at most
        levels.append(staged(up.select(
            "tree", "n", (F.col("bucket") * width).alias("lo"),
            F.least((F.col("bucket") + 1) * width, F.col("n")).alias("hi"),
            digest(_digests_text(F.col("parts"))).alias("digest"), "parts"), "merkle-up"))
    return Trees(levels, fanout)


def _step(parts: Column, lo: Column) -> Column:
    """The siblings of the node at ``lo``: the parent's parts whose interval is not its own."""
    def text(keep):
        return F.unhex(F.array_join(F.transform(F.filter(parts, keep), lambda x: F.hex(x["digest"])), ""))
    return F.struct(text(lambda x: x["lo"] < lo).alias("left"), text(lambda x: x["lo"] > lo).alias("right"))


def proofs(trees: Trees, start: DataFrame) -> DataFrame:
    """(tree, lo, path, top) for every leaf; ``path`` runs from the leaf upwards and ends with
    that of the tree, ``top`` is the tree's own top digest.  ``start``: (tree, path, top) of each
    tree, a written table."""
    above = None
    for k in range(len(trees.levels) - 1, -1, -1):
        level = trees.levels[k]
        own = [c for c in ("tree", "lo", "hi", "parts") if c in level.columns]
        got = level.where(_is_top()).select(*own).join(start, "tree").select(*own, "path", "top")
        if above is not None:
            c, p = level.where(~_is_top()).select(*own, _bucket(k + 1, trees.fanout).alias("bucket")).alias("c"), above.alias("p")
            inside = c.join(p, (F.col("c.tree") == F.col("p.tree")) & (F.col("c.bucket") == F.col("p.bucket"))
                            & (F.col("c.lo") >= F.col("p.lo")) & (F.col("c.hi") <= F.col("p.hi")))
            path = F.concat(F.array(_step(F.col("p.parts"), F.col("c.lo"))), F.col("p.path"))
            got = got.unionByName(inside.select(*[F.col(f"c.{x}") for x in own], path.alias("path"), F.col("p.top").alias("top")))
        if k:
            above = staged(got.withColumn("bucket", _bucket(k, trees.fanout)), "merkle-down")
    return got.select("tree", "lo", "path", "top")


@dataclass
class Manifest:
    """``leaves``: (tree, rank, n, and the columns given to ``manifest``); ``trees``: the trees of
    the sources; ``upper``: the tree over them; ``sources``: (tree, source, n, subroot, path)."""

    leaves: DataFrame
    trees: Trees
    upper: Trees
    sources: DataFrame
    root: bytes | None

    def proofs(self) -> DataFrame:
        """Every leaf with its proof up to the root and its source's subroot."""
        start = self.sources.select("tree", "path", F.col("subroot").alias("top"))
        found = proofs(self.trees, start).withColumnRenamed("lo", "rank").withColumnRenamed("top", "subroot")
        return self.leaves.join(found, ["tree", "rank"])


def manifest(leaves: DataFrame, fanout: int = FANOUT) -> Manifest:
    """Manifest over ``leaves``: (id, source, digest, further columns), a written table."""
    group = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))  # null first, no nulls
    keyed = leaves.withColumn("group", group)
    in_order = ranked(keyed, "group", [F.col("id").asc_nulls_first(), F.col("digest").asc()], "rank", "merkle-leaves")
    sizes = staged(in_order.groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.first("source").alias("source")),
                   "merkle-sources")
    trees = staged(numbered(sizes, [F.col("group").asc()], "tree", "merkle-order"), "merkle-sources")
    own = staged(in_order.join(trees.select("group", "tree", "n"), "group").drop("group"), "merkle-leaves")
    lower = build(own, fanout)
    tops = lower.tops().select("tree", F.col("digest").alias("subroot"))
    subroots = staged(trees.select("tree", "source", "n").join(tops, "tree"), "merkle-subroots")
    count = subroots.count()
    upper = build(subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("rank"),
                                  F.lit(count).cast("long").alias("n"), F.col("subroot").alias("digest")), fanout)
    top = upper.tops().first()
    none = "array<struct<left:binary,right:binary>>"
    start = subroots.sparkSession.range(1).select(
        F.col("id").alias("tree"), F.array().cast(none).alias("path"),
        F.lit(bytes(top["digest"]) if top else None).cast("binary").alias("top"))
    ways = proofs(upper, start).select(F.col("lo").alias("tree"), "path")
    sources = staged(subroots.join(ways, "tree"), "merkle-subroots")
    return Manifest(own, lower, upper, sources, bytes(top["digest"]) if top else None)


def verified(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", source_col: str = "source",
             text_col: str = "text", fanout: int = FANOUT) -> DataFrame:
    """The manifest of ``docs`` put to the test: rows whose id has an even crc32 lose the newlines
    of their text, and every row is folded with its proof to the root it leads to.  (doc_id, leaf,
    subroot, root, path, folded_root, verified), digests as bytes."""
    def leaf(text):
        return digest(*[field(text if f == text_col else F.col(f"`{f}`")) for f in fields])

    text = F.col(f"`{text_col}`")
    hit = crc_of_id(id_col) % 2 == 0
    leaves = staged(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), leaf(text).alias("digest"),
                                F.when(hit, leaf(F.replace(text, F.lit("\n"), F.lit("")))).alias("tampered")), "merkle-rows")
    made = manifest(leaves, fanout)
    root = F.lit(made.root).cast("binary")
    folded = fold(F.coalesce("tampered", "digest"), F.col("path"))
    return made.proofs().select(
        F.col("id").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", root.alias("root"), "path",
        folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))
