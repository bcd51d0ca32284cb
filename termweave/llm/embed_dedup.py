"""Embedding near-duplicates by an exact subspace join.

Unit vectors with cosine >= c lie within the squared distance 2 - 2c.  All vectors are turned by
one fixed random rotation, which spreads that distance evenly, and split into blocks of
coordinates; each block has a share of the squared distance in proportion to its width.  If two
vectors are within the whole budget, at least one block is within its share (pigeonhole).  So
every block is range-joined under its share, and the union of what is found is verified exactly,
in double precision.

Range join of a block: vectors are ordered by the cells that they lie in, the plane of a block's first
two coordinates being cut into cells as wide as the radius, and packed into chunks of a bounded size, one
row each.  Every two chunks meet once, in a cartesian product whose tasks read the chunks they need from
the shared folder: nothing is shuffled for it, so disk grows with the vectors and not with the meetings,
and a task holds two chunks and the rows of one file split.  Where two chunks meet, a block whose boxes
are further apart than the radius is left out, the others are compared as matrix products.

A pair that is within the share of several blocks is verified once.  What leaves a meeting are counts per
vector and its links reduced to spanning stars, not pairs.

The number of candidates falls steeply with a block's width (for isotropic vectors and cosine
0.9: one random pair in a million at 16 coordinates), but cells and boxes separate such vectors
little, so that the comparisons of short sub-vectors remain close to quadratic there; they are
matrix products over blocks of a table, about a nanosecond each.

Vectors of every width in the table are joined, each with those of its own width.

Equal vectors are one class, joined through its smallest id.  Defined results: vectors that are
null, zero, empty or hold null or non-finite components link with nothing; rows with a null id are returned with zero links, a null component and kept.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termweave.llm.common import staged
from termweave.llm.components import connected_components

COSINE = 0.9
BLOCK_WIDTH = 16
HOME_CHUNK = 8192
VISIT_CHUNK = 4096
SEED = 20240601


def rotation(width: int, seed: int = SEED) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, width)))
    return q * np.sign(np.diag(r))


def blocks_of(width: int, block_width: int) -> list[tuple[int, int]]:
    n = max(1, round(width / block_width))
    edges = [round(width * i / n) for i in range(n + 1)]
    return list(zip(edges[:-1], edges[1:], strict=True))


class Geometry:
    """Rotation, blocks, shares and cells for vectors of one width."""

    def __init__(self, width: int, cosine: float = COSINE, block_width: int = BLOCK_WIDTH, seed: int = SEED):
        self.width, self.cosine = width, cosine
        self.turn = rotation(width, seed)
        self.blocks = blocks_of(width, block_width)
        self.budget = (2 - 2 * cosine) * (1 + 1e-6) + 1e-9
        self.share = [self.budget * (hi - lo) / width for lo, hi in self.blocks]

    def turned(self, raw: np.ndarray) -> np.ndarray:
        """Rotated unit vectors, float64, row by row the same whatever else is in the batch."""
        v = raw.astype(np.float64)
        v /= np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]
        return np.einsum("ij,jk->ik", v, self.turn)

    def home(self, b: int, turned: np.ndarray) -> np.ndarray:
        """The cell of each vector in the plane of the block's first two coordinates."""
        lo, hi = self.blocks[b]
        return self._number(np.floor(turned[:, lo:min(lo + 2, hi)] / self.share[b] ** 0.5).astype(np.int64))

    def slack(self, b: int) -> float:
        """What rounding in single precision can add to a block's squared distance at its share."""
        lo, hi = self.blocks[b]
        n = hi - lo
        return 2.0 ** -23 * (4 * self.width * (self.share[b] * n) ** 0.5 + 8 * (n + 4))

    @staticmethod
    def _number(c: np.ndarray) -> np.ndarray:
        out = np.zeros(len(c), np.int64)
        for k in range(c.shape[1]):
            out = out * 65536 + c[:, k] + 32768
        return out


@lru_cache(maxsize=16)
def geometry(width: int, cosine: float, block_width: int, seed: int) -> Geometry:
    """The geometry of a width, made once per process."""
    return Geometry(width, cosine, block_width, seed)


class Side:
    """A chunk of vectors made ready for comparison."""

    def __init__(self, geo: Geometry, raw: np.ndarray):
        v = raw.astype(np.float64)
        v /= np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]
        turned = v.astype(np.float32) @ geo.turn.astype(np.float32)
        self.raw, self.parts, self.boxes = raw, [], []
        one = np.ones((len(raw), 1), np.float32)
        for lo, hi in geo.blocks:
            x = turned[:, lo:hi]
            xx = (x * x).sum(1)[:, None]
            # The product of the one's left and the other's right part is their squared distance.
            self.parts.append((np.concatenate([-2 * x, xx, one], 1),
                               np.ascontiguousarray(np.concatenate([x, one, xx], 1).T)))
            self.boxes.append((x.min(0).astype(np.float64), x.max(0).astype(np.float64)))


def _gap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Squared distance of two boxes."""
    d = np.maximum(0, np.maximum(a[0] - b[1], b[0] - a[1]))
    return float(d @ d)


TILE = 256


def linked(geo: Geometry, a: Side, z: Side) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs within the cosine, found as pairs with a block within its share.

    The matrix products only narrow down, with slack; decisions are made pair by pair."""
    most = [s + geo.slack(b) for b, s in enumerate(geo.share)]
    blocks = [b for b in range(len(geo.blocks)) if _gap(a.boxes[b], z.boxes[b]) <= most[b]]
    out_i, out_j = [], []
    n = len(z.raw)
    # Hits are rare: eight comparisons are looked at as one number, so rows are filled up to eights.
    near, one = np.zeros((TILE, -(-n // 8) * 8), bool), np.empty((TILE, n), bool)
    distance = np.empty((TILE, n), np.float32)
    for t in range(0, len(a.raw) if blocks else 0, TILE):
        rows = min(TILE, len(a.raw) - t)
        for k, b in enumerate(blocks):
            np.matmul(a.parts[b][0][t:t + rows], z.parts[b][1], out=distance[:rows])
            np.less_equal(distance[:rows], np.float32(most[b]), out=near[:rows, :n] if k == 0 else one[:rows])
            if k:
                np.logical_or(near[:rows, :n], one[:rows], out=near[:rows, :n])
        i, word = np.nonzero(near[:rows].view(np.uint64))
        at, bit = np.nonzero(near[:rows].reshape(rows, -1, 8)[i, word])
        i, j = i[at] + t, word[at] * 8 + bit
        for s in range(0, len(i), 100_000):
            p, q = i[s:s + 100_000], j[s:s + 100_000]
            u, v = a.raw[p].astype(np.float64), z.raw[q].astype(np.float64)
            cos = np.einsum("ij,ij->i", u, v) / np.sqrt(np.einsum("ij,ij->i", u, u) * np.einsum("ij,ij->i", v, v))
            ok = cos >= geo.cosine
            out_i.append(p[ok])
            out_j.append(q[ok])
    return np.concatenate(out_i or [np.empty(0, int)]), np.concatenate(out_j or [np.empty(0, int)])


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between ids reduced to (id, smallest id of its component among these links)."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        if (new == label).all():
            return nodes, nodes[label]
        label = new


def _digest(vector) -> Column:
    """32 bytes that stand for a vector in the join of rows and classes."""
    return F.unhex(F.sha2(vector.cast("string").cast("binary"), 256))


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    cosine: float = COSINE, block_width: int = BLOCK_WIDTH, home_chunk: int = HOME_CHUNK,
                    visit_chunk: int = VISIT_CHUNK, seed: int = SEED) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per input row.  A chunk holds at most ``home_chunk``
    and ``visit_chunk`` vectors."""
    spark = vectors.sparkSession
    # Components that were given in single precision stay in it.
    single = vectors.schema[vector_col].dataType.elementType.simpleString() == "float"
    dtype, real = (np.float32, "float") if single else (np.float64, "double")
    v = F.col("vector")
    # Zero and minus zero are the same component.
    same = F.transform(v, lambda x: F.when(x == 0, F.lit(0.0).cast(real)).otherwise(x))
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast(f"array<{real}>").alias("vector"))
    finite = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = rows.where("vec_id is not null and vector is not null").where(finite & F.exists(v, lambda x: x != 0))
    classes = staged(usable.groupBy(same.alias("vector")).agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("size")).select("rep", "size", "vector"), "vectors")
    kind = classes.schema["rep"].dataType.simpleString()

    def by_width(batch, column):
        """(width, rows, raw vectors) of a batch."""
        widths = pc.list_value_length(batch.column(column)).to_numpy()
        for width in np.unique(widths).tolist():
            at = np.flatnonzero(widths == width)
            yield width, at, batch.column(column).take(pa.array(at)).flatten().to_numpy().reshape(-1, width)

    def place(batches):
        for batch in batches:
            for width, at, raw in by_width(batch, 2):
                geo = geometry(width, cosine, block_width, seed)
                turned = geo.turned(raw)
                # Cells only order the vectors, so those of the first blocks will do.
                cells = np.stack([geo.home(b, turned) for b in range(min(4, len(geo.blocks)))], 1)
                part = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), width, np.int32)), pa.array(cells.tolist(), pa.list_(pa.int64())), *part.columns],
                    names=["width", "cells", "rep", "size", "vector"])

    def pack(batches):
        most = min(home_chunk, visit_chunk)
        held, width = [], None

        def row():
            rep, size = (pa.concat_arrays([h[k] for h in held]) for k in (0, 1))
            raw = np.concatenate([h[2] for h in held])
            return pa.RecordBatch.from_arrays(
                [pa.array([width], pa.int32()), *(pa.ListArray.from_arrays([0, len(x)], x) for x in (rep, size)),
                 pa.array([raw.astype(dtype).tobytes()], pa.binary())], names=["width", "reps", "sizes", "raw"])

        for batch in batches:
            for w, at, raw in by_width(batch, 2):
                if held and w != width:
                    yield row()
                    held = []
                width, part = w, batch.take(pa.array(at))
                lo = 0
                while lo < len(at):
                    n = min(most - sum(len(h[0]) for h in held), len(at) - lo)
                    held.append((part.column(0).slice(lo, n), part.column(1).slice(lo, n), raw[lo:lo + n]))
                    lo += n
                    if sum(len(h[0]) for h in held) == most:
                        yield row()
                        held = []
        if held:
            yield row()

    # A chunk's row is some hundred kilobytes; as many files as give every core a share of the meetings.
    n_files = max(spark.sparkContext.defaultParallelism, -(-classes.count() // (8 * min(home_chunk, visit_chunk))))
    order = ["width", "cells", F.xxhash64("rep")]
    placed = classes.mapInArrow(place, f"width int, cells array<long>, rep {kind}, size long, vector array<{real}>")
    packed = placed.repartitionByRange(n_files, *order).sortWithinPartitions(*order).select("rep", "size", "vector")
    chunks = staged(packed.mapInArrow(pack, f"width int, reps array<{kind}>, sizes array<long>, raw binary")
                    .withColumn("chunk", F.monotonically_increasing_id()), "vector-chunks")

    # Every two chunks meet once; a hash of both says which of them is on the left, so that tasks share the work.
    left, right = (chunks.select(*[F.col(c).alias(f"{side}_{c}") for c in chunks.columns]) for side in ("a", "z"))
    odd = F.xxhash64("a_chunk").bitwiseXOR(F.xxhash64("z_chunk")).bitwiseAND(F.lit(1)) == 1
    once = (F.col("a_chunk") == F.col("z_chunk")) | (
        (F.col("a_chunk") != F.col("z_chunk")) & ((F.col("a_chunk") < F.col("z_chunk")) == odd))
    meets = left.join(right.hint("shuffle_replicate_nl"), (F.col("a_width") == F.col("z_width")) & once)

    def compare(batches):
        last, a = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {f.name: batch.column(k)[i] for k, f in enumerate(batch.schema)}
                width, at, to = row["a_width"].as_py(), row["a_chunk"].as_py(), row["z_chunk"].as_py()
                geo = geometry(width, cosine, block_width, seed)

                def side(c, row=row, geo=geo, width=width):
                    return Side(geo, np.frombuffer(row[f"{c}_raw"].as_buffer(), dtype).reshape(-1, width))
                if at != last:
                    last, a = at, side("a")
                z = a if at == to else side("z")
                x, y = linked(geo, a, z)
                if at == to:
                    x, y = x[x < y], y[x < y]
                if not len(x):
                    continue
                reps = [row[c].values for c in ("a_reps", "z_reps")]
                sizes = [row[c].values.to_numpy() for c in ("a_sizes", "z_sizes")]
                rep = pa.concat_arrays(reps).to_numpy(zero_copy_only=False)
                y = y + len(a.raw)
                size = np.concatenate(sizes)
                n = np.zeros(len(rep), np.int64)
                np.add.at(n, x, size[y])
                np.add.at(n, y, size[x])
                if at == to:
                    n[:len(a.raw)] += n[len(a.raw):]
                    n[len(a.raw):] = 0
                got = np.flatnonzero(n)
                nodes, roots = stars(rep[x], rep[y])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([rep[got], nodes]), reps[0].type),
                     pa.array(np.concatenate([n[got], np.zeros(len(nodes), np.int64)])),
                     pa.array(np.concatenate([rep[got], roots]), reps[0].type)], names=["rep", "links", "root"])

    found = staged(meets.select(*[f"{s}_{c}" for s in ("a", "z") for c in ("width", "chunk", "reps", "sizes", "raw")])
                   .mapInArrow(compare, f"rep {kind}, links long, root {kind}"), "vector-links")
    parts = staged(connected_components(found.where("rep <> root"), "rep", "root"), "vector-parts")
    named = (classes.select("rep", "size", _digest(v).alias("digest"))
             .join(found.groupBy("rep").agg(F.sum("links").alias("links")), "rep", "left")
             .join(parts, F.col("rep") == F.col("node"), "left")
             .select("digest", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("links"),
                     F.coalesce("component", "rep").alias("component")))
    named = staged(named, "vector-classes")
    # Rows meet their class by its digest: vectors themselves are shuffled for the classes and the chunks only.
    keyed = rows.select("vec_id", F.when(F.col("vec_id").isNotNull(), _digest(same)).alias("digest"))
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id"))
    return keyed.join(named, "digest", "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))
