"""Approximate nearest neighbours by robust-pruned directed graphs.

Nearness is the largest inner product.  Vectors are dealt at random into shards of about
``shard_rows`` (a bound on what one task holds), each with a graph of its own:

* the inner product becomes a distance by one more coordinate, ``sqrt(max|x|^2 - |x|^2)``;
* vectors enter in batches; a **greedy search** on the graph so far proposes their neighbours;
* **robust pruning**: the nearest candidate becomes an edge, and candidates that are nearer to it
  than to the vector, by the factor ``alpha``, are dropped, until ``degree`` edges stand, so
  that edges point in diverse directions and some far;
* edges are added backwards as well, and a list that overflows is pruned again;
* a vector that cannot be reached from the entry at the end gets an edge from one that can.

Graphs are written to the shared folder.  A **beam search** takes every distinct query vector
through every shard, in bounded groups of queries by shards; the shards' lists are merged, and
scores are inner products of the original vectors in double precision.

Equal vectors are one node, with the smallest ids it stands for, as many as can ever be in a
result; equal queries are searched once.  So a vector that holds any share of the rows costs
one node, and what is found for it is exact in its ties (smaller id first).

Defined results: vectors that are null, all zeros, of no width, or hold null or non-finite
components take no part, nor do rows without an id; vectors meet those of their own width only;
rows that share an id are no candidates for each other, each is a candidate for the others, and of
wholly equal rows one counts; fewer candidates than ``k`` are returned all; an empty table gives
no rows.  Only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType, StructType

from termweave.llm.common import _arrow_schema, staged

DEGREE = 32       # edges a vector keeps
SLACK = 16        # edges beyond that before a list is pruned again
ALPHA = 1.2       # factor of robust pruning
BUILD_BEAM = 64   # width of the greedy search that proposes neighbours
BEAM = 128        # width of the beam search of a query
FRONT = 4         # vectors that a search opens in one step
SHARD_ROWS = 8192
QUERY_ROWS = 8192  # queries that one task takes through one shard
_BLOCK = 256      # queries searched side by side


# -- one shard, in numpy -----------------------------------------------------------------------


class Graph:
    """Vectors with the extra coordinate (``points``), edges (-1: none) and an entry."""

    def __init__(self, points: np.ndarray, edges: np.ndarray, entry: int):
        self.points, self.edges, self.entry = points, edges, entry
        self.norms = np.einsum("nd,nd->n", points, points)

    def search(self, queries: np.ndarray, width: int, entered: int | None = None) -> np.ndarray:
        """The nearest ``width`` nodes that a beam search finds (-1: fewer), nearest first.
        ``entered``: only that many nodes are in the graph yet."""
        n = entered or len(self.points)
        width = min(width, n)
        out = np.full((len(queries), width), -1)
        for lo in range(0, len(queries), _BLOCK):
            out[lo:lo + _BLOCK] = self._beam(queries[lo:lo + _BLOCK], width, n)
        return out

    def _far(self, q: np.ndarray, rows: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Squared distances less the query's own squared norm."""
        return self.norms[ids] - 2 * np.einsum("pd,pd->p", self.points.take(ids, 0), q.take(rows, 0))

    def _beam(self, q: np.ndarray, width: int, n: int) -> np.ndarray:
        m = len(q)
        ids = np.full((m, width), -1)
        far = np.full((m, width), np.inf, np.float32)
        opened = np.ones((m, width), bool)
        seen, met = np.zeros(m * n, bool), np.empty(m * n, np.int32)
        ids[:, 0], seen[self.entry::n], opened[:, 0] = self.entry, True, False
        far[:, 0] = self._far(q, np.arange(m), np.full(m, self.entry))
        live = np.arange(m)
        while len(live):
            front = np.argsort(opened[live], axis=1, kind="stable")[:, :FRONT]
            nodes = np.where(np.take_along_axis(opened[live], front, 1), -1, np.take_along_axis(ids[live], front, 1))
            opened[live[:, None], front] = True
            near = self.edges.take(nodes.ravel(), 0, mode="wrap")
            near[nodes.ravel() < 0] = -1
            places = np.flatnonzero(near >= 0)
            rows, found = places // (near.size // len(live)), near.ravel()[places]
            pair = live[rows] * n + found
            fresh = np.flatnonzero(~seen[pair])
            pair = pair[fresh]
            met[pair] = fresh  # the same node may be met twice in a step: one of its places counts
            once = met[pair] == fresh
            rows, found = rows[fresh[once]], found[fresh[once]]
            seen[pair] = True
            apart = self._far(q, live[rows], found)
            closer = apart < far[live, -1][rows]  # others would fall out of the list at once
            rows, found, apart = rows[closer], found[closer], apart[closer]
            if len(rows):
                count = np.bincount(rows, minlength=len(live))
                place = np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count)
                more = count.max()
                new_ids = np.full((len(live), more), -1)
                new_far = np.full((len(live), more), np.inf, np.float32)
                new_ids[rows, place], new_far[rows, place] = found, apart
                all_ids, all_far = np.hstack([ids[live], new_ids]), np.hstack([far[live], new_far])
                all_open = np.hstack([opened[live], new_ids < 0])
                best = np.argsort(all_far, axis=1, kind="stable")[:, :width]
                ids[live], far[live] = np.take_along_axis(all_ids, best, 1), np.take_along_axis(all_far, best, 1)
                opened[live] = np.take_along_axis(all_open, best, 1)
            live = live[~opened[live].all(1)]
        return ids


def robust_prune(graph: Graph, nodes: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """At most ``degree`` edges of each node among its candidates (-1: none), diverse ones."""
    out = np.full((len(nodes), degree), -1)
    step = max(1, (1 << 21) // max(1, candidates.shape[1] ** 2))
    for lo in range(0, len(nodes), step):
        own, c = nodes[lo:lo + step], candidates[lo:lo + step]
        c = np.sort(c, 1)
        c[:, 1:][c[:, 1:] == c[:, :-1]] = -1
        c = np.where(c == own[:, None], -1, c)
        x = graph.points[c]
        far = graph.norms[c] + graph.norms[own][:, None] - 2 * np.einsum("bcd,bd->bc", x, graph.points[own])
        far = np.where(c >= 0, far, np.inf)
        order = np.argsort(far, 1, kind="stable")
        c, far = np.take_along_axis(c, order, 1), np.take_along_axis(far, order, 1)
        x = graph.points[c]
        between = graph.norms[c][:, :, None] + graph.norms[c][:, None, :] - 2 * (x @ x.transpose(0, 2, 1))
        open_, row = c >= 0, np.arange(len(own))
        for k in range(degree):
            at = open_.argmax(1)
            some = open_[row, at]
            if not some.any():
                break
            out[lo:lo + step, k] = np.where(some, c[row, at], -1)
            open_ &= alpha * alpha * between[row, at] > far
            open_[row, at] = False
    return out


def build(vectors: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA, beam: int = BUILD_BEAM,
          batch: int = 512, seed: int = 7) -> tuple[Graph, np.ndarray]:
    """Graph over distinct vectors (float64), and the order in which it holds them."""
    n = len(vectors)
    order = np.random.default_rng(seed).permutation(n)
    points = _points(vectors[order])
    graph = Graph(points, np.full((n, degree + SLACK), -1, np.int32), 0)
    start = points[:min(batch, 128)]  # the entry is one of the first batch
    graph.entry = int(((start - start.mean(0)) ** 2).sum(1).argmin())
    entered = 0
    while entered < n:
        new = np.arange(entered, min(n, entered + batch) if entered else len(start))
        if entered:
            near = graph.search(points[new], beam, entered)
        else:
            near = np.broadcast_to(new, (len(new), len(new))).copy()  # the first ones know each other
        kept = robust_prune(graph, new, near, degree, alpha)
        graph.edges[new, :degree] = kept
        _backwards(graph, new, kept, degree, alpha)
        entered = new[-1] + 1
    _join_rest(graph, degree)
    return graph, order


def _backwards(graph: Graph, new: np.ndarray, kept: np.ndarray, degree: int, alpha: float) -> None:
    ends, starts = kept.ravel(), np.repeat(new, kept.shape[1])
    ends, starts = ends[ends >= 0], starts[ends >= 0]
    order = np.argsort(ends, kind="stable")
    ends, starts = ends[order], starts[order]
    nodes, first, count = np.unique(ends, return_index=True, return_counts=True)
    held = (graph.edges[nodes] >= 0).sum(1)
    room = graph.edges.shape[1]
    total = held + count
    place = np.arange(len(ends)) - np.repeat(first, count)
    fits = np.repeat(total <= room, count)
    # Lists with room are packed to the left, so the next free place is their length.
    graph.edges[ends[fits], (np.repeat(held, count) + place)[fits]] = starts[fits]
    over = np.nonzero(total > room)[0]
    for group in np.array_split(over[np.argsort(count[over])], max(1, len(over) // 256)):
        if len(group):
            wide = np.full((len(group), room + count[group].max()), -1)
            wide[:, :room] = graph.edges[nodes[group]]
            for r, g in enumerate(group):
                wide[r, room:room + count[g]] = starts[first[g]:first[g] + count[g]]
            graph.edges[nodes[group]] = -1
            graph.edges[nodes[group], :degree] = robust_prune(graph, nodes[group], wide, degree, alpha)


def _join_rest(graph: Graph, degree: int) -> None:
    """An edge to every node that the entry does not lead to, from the nearest found that has
    room; where none has, lists grow by a column."""
    n = len(graph.points)
    reached = np.zeros(n, bool)

    def spread(now):
        reached[now] = True
        while len(now):
            near = np.unique(graph.edges[now])
            now = near[(near >= 0)]
            now = now[~reached[now]]
            reached[now] = True
    spread(np.array([graph.entry]))
    while not reached.all():
        lost = int(np.argmin(reached))
        found = graph.search(graph.points[lost:lost + 1], degree)[0]
        found = found[found >= 0]
        found = found[reached[found]]
        free = (graph.edges[found] < 0)
        with_room = np.nonzero(free.any(1))[0]
        if len(with_room):
            host = found[with_room[0]]
            graph.edges[host, int(free[with_room[0]].argmax())] = lost
        else:
            graph.edges = np.hstack([graph.edges, np.full((n, 1), -1, np.int32)])
            graph.edges[found[0], -1] = lost
        spread(np.array([lost]))


# -- all shards, in Spark ------------------------------------------------------------------------


def usable(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, vector, h1, h2) of the rows that take part; h1, h2: 128 bits of the vector."""
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    same = F.transform("vector", lambda x: x.cast("double") + F.lit(0.0))  # -0.0 becomes 0.0
    return (rows.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").alias("vector"))
            .where(F.col("vec_id").isNotNull() & (F.size("vector") > 0))
            .where(fine & F.exists("vector", lambda x: x != 0))
            .withColumn("h1", F.xxhash64(same)).withColumn("h2", F.xxhash64(F.lit(1), same)))


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


_INDEX = "width int, shard long, vectors binary, ids binary, edges binary, entry int"


def _points(vectors: np.ndarray) -> np.ndarray:
    """Inner product as distance: one more coordinate makes all vectors equally long (then 1)."""
    norms = np.einsum("nd,nd->n", vectors, vectors)
    points = np.hstack([vectors, np.sqrt(np.maximum(norms.max() - norms, 0))[:, None]])
    return (points / max(np.sqrt(norms.max()), 1e-300)).astype(np.float32)


def _number(rows: DataFrame) -> str:
    """Bytes of vectors are kept as single floats where the column has these."""
    return "<f4" if rows.schema["vector"].dataType.elementType == FloatType() else "<f8"


def index(classes: DataFrame, shards: DataFrame, **params) -> DataFrame:
    """A row a shard with its graph; ``classes``: (width, h1, ids, vector); ``shards``: (width, n_shards)."""
    arrow, number = _arrow_schema(StructType.fromDDL(_INDEX)), _number(classes)

    def one(key, table):
        vectors = _matrix(table.column("vector"))
        graph, order = build(vectors, **params)
        ids = table.column("ids").to_pylist()
        most = max(map(len, ids))
        padded = np.array([ids[i] + [-1] * (most - len(ids[i])) for i in order], np.int64)
        many = np.array([len(ids[i]) for i in order], np.int64)
        row = {"width": key[0].as_py(), "shard": key[1].as_py(), "vectors": vectors[order].astype(number).tobytes(),
               "ids": np.hstack([many[:, None], padded]).tobytes(), "edges": graph.edges.astype(np.int32).tobytes(),
               "entry": graph.entry}
        return pa.Table.from_pylist([row], schema=arrow)
    return classes.join(shards, "width").select(
        "width", F.pmod("h1", "n_shards").alias("shard"), "ids", "vector").groupBy("width", "shard").applyInArrow(one, _INDEX)


def _opened(row: dict, number: str) -> tuple[Graph, np.ndarray, np.ndarray]:
    vectors = np.frombuffer(row["vectors"], number).reshape(-1, row["width"]).astype(np.float64)
    graph = Graph(_points(vectors), np.frombuffer(row["edges"], np.int32).reshape(len(vectors), -1), row["entry"])
    return graph, vectors, np.frombuffer(row["ids"], np.int64).reshape(len(vectors), -1)


_FOUND = "h1 long, h2 long, score double, vec_id long"


def _search(queries: DataFrame, graphs: DataFrame, keep: int, beam: int) -> DataFrame:
    """(h1, h2, score, vec_id): the ``keep`` best of every shard for every query vector."""
    arrow, number = _arrow_schema(StructType.fromDDL(_FOUND)), _number(queries)

    def one(key, left, right):
        if not left.num_rows or not right.num_rows:
            return pa.Table.from_pylist([], schema=arrow)
        graph, vectors, ids = _opened(right.to_pylist()[0], number)
        q = _matrix(left.column("vector"))
        h = np.stack([left.column("h1").to_numpy(), left.column("h2").to_numpy()], 1)
        parts = []
        scale = np.sqrt(np.einsum("qd,qd->q", q, q))
        flat = np.hstack([q / scale[:, None], np.zeros((len(q), 1))]).astype(np.float32)
        near = graph.search(flat, max(beam, keep))
        for lo in range(0, len(q), _BLOCK):
            c = near[lo:lo + _BLOCK]
            score = np.einsum("qcd,qd->qc", vectors[c], q[lo:lo + _BLOCK])
            score = np.where(c >= 0, score, -np.inf)
            top = np.argsort(-score, 1, kind="stable")
            # Ties at the end of the list may go to smaller ids: all classes down to the score
            # of the keep-th one stay, and the ids decide.
            edge = np.take_along_axis(score, top[:, min(keep, top.shape[1]) - 1][:, None], 1)
            rows, cols = np.nonzero((score >= edge) & (c >= 0))
            node, s = c[rows, cols], score[rows, cols]
            many = ids[node, 0]
            at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            rows, s, found = np.repeat(rows, many), np.repeat(s, many), ids[np.repeat(node, many), 1 + at]
            order = np.lexsort((found, -s, rows))
            rows, s, found = rows[order], s[order], found[order]
            place = np.arange(len(rows)) - np.searchsorted(rows, rows)
            rows, s, found = rows[place < keep], s[place < keep], found[place < keep]
            parts.append(pa.table([h[lo + rows, 0], h[lo + rows, 1], s, found], schema=arrow))
        return pa.concat_tables(parts)
    key = ("width", "shard", "part")
    return queries.groupBy(*key).cogroup(graphs.groupBy(*key)).applyInArrow(one, _FOUND)


def neighbours(rows: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
               shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS, beam: int = BEAM, **params) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for each row that ``is_query`` (a
    condition on ``vec_id``) picks, nearest first, ties to the smaller id."""
    keep = k + 1  # the query itself may be among them
    spark = rows.sparkSession
    x = staged(usable(rows, id_col, vector_col), "ann-vectors")
    place = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("vec_id"))
    light = x.select("vec_id", "h1", "h2").distinct()
    asked = light.where(is_query)
    # Smallest ids of each distinct vector: a limit per group that is applied before the shuffle too.
    ids = light.withColumn("n", place).where(F.col("n") <= keep).groupBy("h1", "h2").agg(
        F.array_sort(F.collect_list("vec_id")).alias("ids"))
    # The vector of a class is that of its smallest row: no group is gathered.
    first = ids.select("h1", "h2", "ids", F.col("ids")[0].alias("vec_id"))
    wanted = asked.select("h1", "h2").distinct().withColumn("asked", F.lit(True))
    classes = staged(first.join(x.dropDuplicates(["vec_id", "h1", "h2"]), ["vec_id", "h1", "h2"])
                     .join(wanted, ["h1", "h2"], "left")
                     .select("h1", "h2", "ids", "vector", F.size("vector").alias("width"), "asked"), "ann-classes")
    # A row a width.
    shards = staged(classes.groupBy("width").agg(
        F.ceil(F.count(F.lit(1)) / shard_rows).cast("long").alias("n_shards"),
        F.ceil(F.count("asked") / query_rows).cast("long").alias("n_parts")), "ann-shards")
    graphs = staged(index(classes, shards, **params), "ann-graphs")
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_shards") - 1))
    queries = (classes.where("asked").join(shards, "width")
               .select("width", F.pmod("h2", "n_parts").alias("part"), "h1", "h2", "vector", each.alias("shard")))
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_parts") - 1))
    copies = graphs.join(shards.where("n_parts > 0"), "width").select(*graphs.columns, part.alias("part"))
    found = staged(_search(queries, copies, keep, beam), "ann-found")
    best = Window.partitionBy("h1", "h2").orderBy(F.col("score").desc(), "vec_id")
    hit = F.struct("n", "vec_id", "score")
    lists = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= keep).groupBy("h1", "h2").agg(
        F.array_sort(F.collect_list(hit)).alias("hits"))
    others = F.slice(F.filter("hits", lambda h: h["vec_id"] != F.col("query_id")), 1, k)
    out = asked.withColumnRenamed("vec_id", "query_id").join(staged(lists, "ann-lists"), ["h1", "h2"]).select(
        "query_id", F.posexplode(others).alias("at", "hit"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"),
                      F.col("hit.score").alias("score"))
