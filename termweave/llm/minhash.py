"""MinHash near-duplicates: a signature-coordinate inverted join.

A document is the set of its word shingles.  Documents with equal sets form a class, which is
represented by its smallest id.  Each representative has a signature of ``coordinates`` minima
and is posted under its coordinate-value pairs:

* values held by one document are dropped; they cannot collide;
* a document with fewer than ``matches`` shared values is out;
* the rest are ordered from rare to frequent, and only the prefix is posted that two documents
  with ``matches`` collisions must meet in; the other coordinates, which have the long lists,
  are never merged: collisions there are counted by looking at the two signatures;
* members of a list are compared in groups of a bounded size, by signature and then by how
  often each of 512 buckets holds one of their shingles: the sum of the smaller counts is never
  less than the intersection, so that a pair it rules out cannot be similar enough.  In a few
  rounds, over the longest lists of its prefix, every document proposes its best partner outside
  its component, those are confirmed, and components grow; what then still meets in any list
  across components, and is not ruled out, is confirmed in full.  Pairs inside a component need
  no comparison, so that a large group of near copies costs little more than its size.

Pairs above the match threshold are confirmed on the full shingle sets.  Components of the
confirmed links give the result.  With 32 coordinates and 16 matches, a pair at similarity 0.8
is missed with a probability of about 3 in 100,000.

Defined results: a document without words or text has no shingles, links with nothing and is
its own component; rows with a null id are returned with a null component and kept; rows that
share an id are judged each by its own text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termweave.llm.common import id_text, map_texts, staged
from termweave.llm.components import connected_components

SHINGLE = 5
COORDINATES = 32
MATCHES = 16
PERCENT = 80
ROUNDS = 2  # of proposing the best partner
LONGEST = 3  # lists of a document's prefix that these rounds look at
BUCKETS = 512
CHUNK = 1024  # members of a list that are compared at a time

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


class Shingler:
    """Whole texts to their sorted, distinct 64-bit shingle numbers."""

    def __init__(self, width: int = SHINGLE, remembered: int = 300_000):
        import xxhash

        class Words(dict):
            def __missing__(self, w, number=xxhash.xxh3_64_intdigest):
                v = self[w] = number(w)
                return v

        self.width, self.remembered, self.fresh = width, remembered, Words
        self.words = Words()

    def __call__(self, text: bytes) -> np.ndarray:
        w = text.lower().split()  # bytes: only A-Z are lowered, only ASCII white space splits
        if not w:
            return np.empty(0, np.uint64)
        if len(self.words) > self.remembered:
            self.words = self.fresh()
        a = np.fromiter(map(self.words.__getitem__, w), np.uint64, len(w))
        k = min(self.width, len(a))
        s = np.full(len(a) - k + 1, k, np.uint64)
        for i in range(k):
            s = s * _MIX2 + a[i:len(a) - k + 1 + i]
        return np.unique(_mixed(s))


def signature(shingles: np.ndarray, salts: np.ndarray, step: int = 8192) -> np.ndarray:
    """Minimum of each salted permutation, the coordinate's number mixed into the value."""
    low = np.full(len(salts), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), step):
        low = np.minimum(low, ((shingles[i:i + step, None] ^ salts) * _MIX2).min(axis=0))
    return low ^ salts


def counts(mixed: np.ndarray) -> np.ndarray:
    """How many shingles fall into each bucket, 255 standing for that many or more."""
    return np.minimum(np.bincount((mixed >> np.uint64(40)).astype(np.int64) % BUCKETS, minlength=BUCKETS),
                      255).astype(np.uint8)


def not_ruled_out(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, percent: int):
    """(bound, possible) row by row: the most shingles that two documents can share, and whether
    that is enough.  Full buckets on both sides bound nothing."""
    most = np.minimum(a, b).sum(1, dtype=np.int64)
    most = np.where(((a == 255) & (b == 255)).any(1), np.minimum(na, nb), most)
    return most, 100 * most >= percent * (na + nb - most)


def _features(width, coordinates):
    def start():
        shingler = Shingler(width)
        salts = _mixed(np.arange(1, coordinates + 1, dtype=np.uint64) * _MIX2)

        def fn(texts):
            sets = [shingler(t) for t in texts]
            mixed = [_mixed(s) for s in sets]
            sigs = [signature(s, salts) if len(s) else None for s in sets]
            return {"n_shingles": [len(s) for s in sets],
                    "f1": pa.array(np.array([s.sum() for s in mixed], np.uint64).view(np.int64)),
                    "f2": pa.array(np.array([np.bitwise_xor.reduce(s * _MIX2) if len(s) else 0
                                             for s in mixed], np.uint64).view(np.int64)),
                    "sig": [x.view(np.int64) if x is not None else None for x in sigs],
                    # What members are compared by: 16 bits of each coordinate, counts by bucket.
                    "code": [x.astype(np.uint16).tobytes() + counts(s).tobytes() if x is not None else None
                             for x, s in zip(sigs, mixed, strict=True)]}
        return fn
    return start


def features(docs: DataFrame, width: int = SHINGLE, coordinates: int = COORDINATES) -> DataFrame:
    """doc_id, n_shingles, a 128-bit fingerprint of the set, the signature."""
    return map_texts(docs, "n_shingles long, f1 long, f2 long, sig array<long>, code binary",
                     _features(width, coordinates), as_bytes=True)


def shingle_sets(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    def start():
        shingler = Shingler(width)

        def fn(texts):
            return {"shingles": [shingler(t).view(np.int64) for t in texts]}
        return fn
    return map_texts(docs, "shingles array<long>", start, as_bytes=True)


def prefix_posts(reps: DataFrame, matches: int) -> DataFrame:
    """(rep, place, key): the coordinate values under which a representative is posted, the
    longest list at place 0."""
    posts = reps.select("rep", F.explode("sig").alias("key"))
    shared = staged(posts.groupBy("key").agg(F.count("*").alias("n")).where("n >= 2"), "shared")
    mine = (posts.join(shared, "key").groupBy("rep")
            .agg(F.array_sort(F.collect_list(F.struct("n", "key"))).alias("keys"))
            .where(F.size("keys") >= matches))
    prefix = F.reverse(F.slice("keys", F.lit(1), F.size("keys") - (matches - 1)))
    return mine.select("rep", F.posexplode(prefix).alias("place", "k")).select(
        "rep", "place", F.col("k.key").alias("key"))


def _only(docs: DataFrame, ids: DataFrame, bits: int = 20) -> DataFrame:
    """Rows of ``docs`` whose id is in ``ids``.  A bitmap of id hashes, 128 KB whatever the number
    of ids, goes out with the tasks and drops other rows before the exact join; with very many ids
    it drops few, and the join does the work."""
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << bits)).cast("int")
    n = place + 1  # positions of the bitmap functions count from 1
    parts = (ids.select(n.alias("n")).groupBy(F.bitmap_bucket_number("n").alias("part"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("bits")).collect())
    held = bytearray((1 << bits) // 8)
    for r in parts:
        at = (r["part"] - 1) * len(r["bits"])
        held[at:at + len(r["bits"])] = r["bits"]
    held = bytes(held)

    def run(batches):
        bit = np.unpackbits(np.frombuffer(held, np.uint8), bitorder="little").astype(bool)
        for b in batches:
            yield pa.RecordBatch.from_arrays(b.columns[:-1], schema=pa.schema(list(b.schema)[:-1])).filter(
                pa.array(bit[b.column(b.num_columns - 1).to_numpy()]))

    maybe = docs.withColumn("place", place).mapInArrow(run, docs.schema)
    return maybe.join(ids, "doc_id", "left_semi")


def compare_groups(rows: DataFrame, matches: int, percent: int, coordinates: int, best: bool) -> DataFrame:
    """(x, y, m): pairs of a group (key, h, v) in different parts that collide in at least
    ``matches`` coordinates and that sizes and bucket counts do not rule out; per x the best
    one, by the similarity that the counts allow (m, in millionths), or all.

    ``rows``: key, h, v, side (the row's chunk), rep, part, n_shingles, code, tried."""
    kind = rows.schema["rep"].dataType.simpleString()
    names = ["side", "rep", "part", "n_shingles"]

    def pairs(side, rep, part, size, code, buckets, tried, crossing):
        g = len(rep)
        m = np.zeros((g, g), np.uint8)
        for i in range(code.shape[1]):
            m += code[:, i, None] == code[None, :, i]
        ok = (m >= matches) & (part[:, None] != part[None, :])
        ok &= 100 * np.minimum(size[:, None], size[None, :]) >= percent * np.maximum(size[:, None], size[None, :])
        if crossing:
            ok &= side[:, None] != side[None, :]
        where = {r: i for i, r in enumerate(rep.tolist())} if any(tried) else {}
        for i, t in enumerate(tried):
            for y in t or ():
                if y in where:
                    ok[i, where[y]] = False
        x, y = np.nonzero(np.triu(ok | ok.T if best else ok & ok.T))
        kept, scores = [], []
        for s in range(0, len(x), 16_384):
            i, j = x[s:s + 16_384], y[s:s + 16_384]
            most, may = not_ruled_out(buckets[i], buckets[j], size[i], size[j], percent)
            kept.append(np.stack([i[may], j[may]]))
            scores.append((1_000_000 * most // (size[i] + size[j] - most))[may])
        if not kept:
            return rep[:0], rep[:0], size[:0]
        (x, y), m = np.concatenate(kept, 1), np.concatenate(scores)
        if not best:
            return rep[x], rep[y], m
        x, y, m = np.concatenate([x, y]), np.concatenate([y, x]), np.concatenate([m, m])
        mine = ok[x, y]
        x, y, m = x[mine], y[mine], m[mine]
        order = np.lexsort((rep[y], -m, x))
        first = order[np.concatenate([[True], x[order][1:] != x[order][:-1]])] if len(x) else order
        return rep[x[first]], rep[y[first]], m[first]

    def run(batches):
        held = None
        for batch in _with_end(batches):
            if batch is not None:
                t = pa.Table.from_batches([batch])
                held = t if held is None else pa.concat_tables([held, t])
            if held is None or not held.num_rows:
                continue
            held = held.combine_chunks()
            g = np.stack([held[c].to_numpy() for c in ("key", "h", "v")])
            cuts = np.flatnonzero((g[:, 1:] != g[:, :-1]).any(0)) + 1
            cuts = np.concatenate([[0], cuts, [held.num_rows]])
            done = len(cuts) - 1 if batch is None else len(cuts) - 2  # the last group may go on
            cols = [held[c].to_numpy() for c in names]
            both = np.frombuffer(b"".join(held["code"].to_pylist()), np.uint8).reshape(held.num_rows, -1)
            code = np.ascontiguousarray(both[:, :2 * coordinates]).view(np.uint16)
            buckets = both[:, 2 * coordinates:]
            tried = held["tried"].to_pylist()
            out = [[], [], []]
            for k in range(done):
                s, e = cuts[k], cuts[k + 1]
                if e - s > 1:
                    for o, c in zip(out, pairs(*(c[s:e] for c in cols), code[s:e], buckets[s:e], tried[s:e],
                                               g[1, s] != g[2, s]), strict=True):
                        o.append(c)
            held = held.slice(cuts[done])
            if out[0]:
                x, y, m = (np.concatenate(o) for o in out)
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y), pa.array(m.astype(np.int32))],
                                                 names=["x", "y", "m"])

    dealt = rows.repartition("key", "h", "v").sortWithinPartitions("key", "h", "v")
    return dealt.select("key", "h", "v", *names, "code", "tried").mapInArrow(run, f"x {kind}, y {kind}, m int")


def _with_end(batches):
    yield from batches
    yield None


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets are similar enough."""
    left = sets.select(F.col("doc_id").alias("x"), F.col("shingles").alias("sx"))
    right = sets.select(F.col("doc_id").alias("y"), F.col("shingles").alias("sy"))
    both = F.size(F.array_intersect("sx", "sy"))
    return (pairs.join(right, "y").join(left, "x")
            .where(100 * both >= percent * (F.size("sx") + F.size("sy") - both)).select("x", "y"))


def _merged(parts: DataFrame, links: DataFrame) -> DataFrame:
    """Parts (node, component) after joining those that a link (x, y) connects."""
    ends = parts.select(F.col("node").alias("x"), F.col("component").alias("px")), parts.select(
        F.col("node").alias("y"), F.col("component").alias("py"))
    between = links.join(ends[0], "x").join(ends[1], "y").select(F.col("px").alias("a"), F.col("py").alias("b"))
    new = staged(connected_components(between).select(
        F.col("node").alias("component"), F.col("component").alias("into")), "into")
    return staged(parts.join(new, "component", "left").select(
        "node", F.coalesce("into", "component").alias("component")), "parts")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    width: int = SHINGLE, coordinates: int = COORDINATES, matches: int = MATCHES,
                    percent: int = PERCENT, rounds: int = ROUNDS, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per input row."""
    docs = id_text(docs, id_col, text_col)
    feats = staged(features(docs, width, coordinates), "minhash")
    worded = feats.where("n_shingles > 0 and doc_id is not null")
    classes = staged(worded.groupBy("n_shingles", "f1", "f2").agg(F.min("doc_id").alias("rep")), "classes")
    firsts = classes.select(F.col("rep").alias("doc_id")).distinct()
    reps = staged(worded.join(firsts, "doc_id", "left_semi")
                  .select(F.col("doc_id").alias("rep"), "n_shingles", "sig", "code")
                  .dropDuplicates(["rep", "n_shingles", "sig"]), "reps")
    posts = staged(prefix_posts(reps, matches), "posts")
    sets = staged(shingle_sets(_only(docs, posts.select(F.col("rep").alias("doc_id")).distinct()), width), "sets")
    members = posts.join(reps.select("rep", "n_shingles", "code"), "rep")
    parts = reps.select(F.col("rep").alias("node")).distinct().withColumn("component", F.col("node"))
    tried = None  # (x, y): what x has proposed, confirmed or not
    for turn in range(rounds + 1):
        best = turn < rounds
        rows = (members.where(F.col("place") < LONGEST) if best else members).join(parts, F.col("rep") == F.col("node")).select(
            "key", "rep", F.col("component").alias("part"), "n_shingles", "code")
        if tried is None:
            rows = rows.withColumn("tried", F.array().cast(f"array<{reps.schema['rep'].dataType.simpleString()}>"))
        else:
            mine = tried.groupBy(F.col("x").alias("rep")).agg(F.collect_list("y").alias("tried"))
            rows = rows.join(mine, "rep", "left")
        rows = staged(rows, "rows")
        lists = staged(rows.groupBy("key").agg(
            F.count("*").alias("n"), F.min("part").alias("lo"), F.max("part").alias("hi"))
            .where("lo <> hi").select("key", F.ceil(F.col("n") / chunk).alias("chunks")), "lists")
        rows = rows.join(lists, "key").withColumn(
            "side", F.pmod(F.xxhash64("rep", F.lit(turn)), F.col("chunks")))
        if not best:  # every chunk of a list against every other
            rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
        else:  # every chunk in itself: few comparisons that join most
            rows = rows.withColumn("other", F.col("side"))
        rows = rows.withColumn("h", F.least("side", "other")).withColumn("v", F.greatest("side", "other"))
        found = staged(compare_groups(rows, matches, percent, coordinates, best), "found")
        if not best:
            found = found.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
            if tried is not None:
                found = found.join(tried.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct(),
                                   ["x", "y"], "left_anti")
        else:
            found = found.groupBy("x").agg(F.max_by("y", F.struct("m", "y")).alias("y"))
        found = staged(found, "proposed")
        if found.isEmpty():
            continue
        tried = found if tried is None else staged(tried.unionByName(found), "tried")
        links = _confirm(found.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct(),
                         sets, percent)
        parts = _merged(parts, links)
    whole = parts

    named = staged(classes.join(whole, F.col("rep") == F.col("node"), "left").select(
        "n_shingles", "f1", "f2", F.coalesce("component", "rep").alias("component")), "named")
    placed = feats.select("doc_id", "n_shingles", "f1", "f2").join(
        named, ["n_shingles", "f1", "f2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return placed.select("doc_id", "n_shingles", component.alias("component_id"),
                         F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))
