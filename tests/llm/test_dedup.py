"""Near-duplicate operators against exhaustive comparison."""

import random

import numpy as np
import pytest
from llm_data import SMALL, none, odd  # noqa: F401

from termweave.llm import embed_dedup, minhash, queries
from termweave.llm.components import connected_components


def roots(nodes, links):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in links:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return {n: find(n) for n in nodes}


def test_components(spark):
    r = random.Random(2)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + [
        (r.randint(200, 400), r.randint(200, 400)) for _ in range(90)] + [(7, 7), (3, 2)]
    df = spark.createDataFrame(links + [(None, 4), (5, None)], "a long, b long")
    got = dict(connected_components(df).collect())
    nodes = {x for a, b in links for x in (a, b) if a != b}
    assert got == {n: c for n, c in roots(nodes, [x for x in links if x[0] != x[1]]).items()}
    assert connected_components(df.limit(0)).count() == 0


def shingles(text, width):
    w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", "".join(
        c.lower() if c.isascii() else c for c in text or "")) if x]
    return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def brute(docs, width, percent=80):
    sets = {i: shingles(t, width) for i, t in docs}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    part = roots(ids, links)
    return sorted((i, len(sets[i]), part[i], part[i] == i) for i in ids)


def family(r, n_words, vocabulary, copies, change):
    base = [r.choice(vocabulary) for _ in range(n_words)]
    for _ in range(copies):
        w = list(base)
        for _ in range(r.randint(0, change)):
            w[r.randrange(len(w))] = r.choice(vocabulary)
        yield " ".join(w)


@pytest.fixture(scope="module")
def near(spark):
    r = random.Random(11)
    vocabulary = [f"w{i}" for i in range(2000)]
    texts = ["", "one", "One", "two words", "a b c", "a b c d"]
    for n, copies, change in ((40, 30, 2), (120, 60, 7), (300, 25, 20), (60, 40, 4), (8, 10, 1)):
        texts += family(r, n, vocabulary, copies, change)
    passage = " ".join(r.choice(vocabulary) for _ in range(60))
    texts += [" ".join(r.choice(vocabulary) for _ in range(r.randint(5, 90))) + " " + passage for _ in range(80)]
    texts += [" ".join(r.choice(vocabulary) for _ in range(100)) for _ in range(60)]
    r.shuffle(texts)
    docs = list(enumerate(texts, 10))
    return spark.createDataFrame(docs, "doc_id long, text string"), docs


@pytest.mark.parametrize("width", [4, 5])
def test_minhash_equals_brute_force(near, width):
    df, docs = near
    got = sorted(tuple(x) for x in minhash.near_duplicates(df, width=width).collect())
    assert got == brute(docs, width)


def test_minhash_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(x) for x in queries.op9_minhash_inverted_join(spark, SMALL).collect())
    assert got == brute(docs, 4)


def test_minhash_odd_rows(odd, none):
    got = minhash.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    by = {r["doc_id"]: r for r in got}
    assert by[6]["component_id"] == 5 and not by[6]["kept"] and by[5]["kept"]
    assert by[1]["n_shingles"] == by[2]["n_shingles"] == by[3]["n_shingles"] == 0 and by[3]["component_id"] == 3
    assert by[None]["component_id"] is None and by[None]["kept"]
    assert minhash.near_duplicates(none).count() == 0


def vectors(seed=0, dim=24):
    g = np.random.default_rng(seed)
    base = g.standard_normal((40, dim))
    out = [base[k] + g.standard_normal(dim) * s for k in range(40) for s in (0, 0.15, 0.3, 0.35, 0.4)]
    chain = [base[0]]
    for _ in range(15):
        chain.append(chain[-1] + g.standard_normal(dim) * 0.35)
    out += chain + [base[3] * 5, base[3], -base[3]] + [base[7]] * 6
    return [v.astype(np.float32) for v in out]


def brute_cosine(rows, cosine=0.9):
    ids = [i for i, _ in rows]
    ok = {i: np.asarray(v, float) for i, v in rows if v is not None and len(v) == 24
          and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    n, links = dict.fromkeys(ids, 0), []
    for a in ok:
        for b in ok:
            if a != b and ok[a] @ ok[b] / np.sqrt((ok[a] @ ok[a]) * (ok[b] @ ok[b])) >= cosine:
                n[a] += 1
                links.append((a, b))
    part = roots(ids, links)
    return sorted((i, n[i], part[i], part[i] == i) for i in ids)


@pytest.mark.parametrize("width", [6, 12, 24])
def test_subspace_join_equals_brute_force(spark, width):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors(), 5)]
    n = len(rows) + 5
    rows += [(n, None), (n + 1, [0.0] * 24), (n + 2, [float("nan")] * 24), (n + 3, [None] + [1.0] * 23),
             (n + 4, [1.0, 2.0]), (n + 5, [float("inf")] * 24), (n + 6, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(tuple(x) for x in embed_dedup.near_duplicates(
        df, block_width=width, home_chunk=40, visit_chunk=30).collect())
    assert got == brute_cosine(rows)


def test_subspace_join_odd_tables(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, size int")
    assert embed_dedup.near_duplicates(empty).count() == 0
    df = spark.createDataFrame([(None, [1.0, 0.0]), (2, [1.0, 0.0]), (1, [2.0, 0.0])], "vec_id long, embedding array<float>")
    got = {r["vec_id"]: tuple(r)[1:] for r in embed_dedup.near_duplicates(df).collect()}
    assert got == {None: (0, None, True), 2: (1, 1, False), 1: (1, 1, True)}


def test_subspace_join_covers_every_width(spark):
    """Several widths in one table: each gives what it gives alone, and none links with another."""
    want, rows = [], []
    for k, dim in enumerate((24, 10, 1, 37)):
        some = [(1000 * k + i, [float(x) for x in v]) for i, v in enumerate(vectors(k, dim))]
        rows += some
        m = np.array([v for _, v in some])
        m /= np.sqrt((m * m).sum(1))[:, None]
        near = m @ m.T >= 0.9
        near[np.diag_indices(len(m))] = False
        part = roots([i for i, _ in some], [(some[a][0], some[b][0]) for a, b in zip(*np.nonzero(near), strict=True)])
        want += [(i, int(near[j].sum()), part[i], part[i] == i) for j, (i, _) in enumerate(some)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3, "vec_id")
    got = sorted(tuple(x) for x in embed_dedup.near_duplicates(df, block_width=6, home_chunk=60, visit_chunk=40).collect())
    assert got == sorted(want)
