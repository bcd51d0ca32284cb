"""The Merkle manifest against a recomputation in plain Python."""

import hashlib
import zlib

import pytest
from llm_data import SMALL, longest

from termweave.llm import merkle, queries
from pyspark.sql import functions as F


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(nodes, fanout=3):
    """The top, and for each leaf its (left, right) siblings upwards."""
    paths, own = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, owners = [], []
        for i in range(0, len(nodes), fanout):
            run = nodes[i:i + fanout]
            for j in range(len(run)):
                for x in own[i + j]:
                    paths[x].append(("".join(run[:j]), "".join(run[j + 1:])))
            above.append(h(*run))
            owners.append(sum(own[i:i + fanout], []))
        nodes, own = above, owners
    return nodes[0], paths


def brute(rows, fanout=3):
    """rows: (doc_id, source, lang, n_chars, text)."""
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    order = sorted(by, key=lambda k: (k is not None, (k or "").encode()))
    low = {}
    for k in order:
        v = sorted(by[k], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        low[k] = (v, *tree([leaf(r) for r in v], fanout))
    root, up = tree([low[k][1] for k in order], fanout)
    out = []
    for n, k in enumerate(order):
        v, sub, paths = low[k]
        for r, p in zip(v, paths):
            p, t = p + up[n], r[4]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and t is not None:
                t = t.replace("\n", "")
            now = leaf(r[:4] + (t,))
            for a, b in p:
                now = h(a, now, b)
            out.append((r[0], leaf(r), sub, root, h("".join(a + b for a, b in p)), now, now == root))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def run(docs, **params):
    got = merkle.verified(docs, **params)
    d = [merkle.hex_text(F.col(c)).alias(c) for c in ("leaf", "subroot", "root", "folded_root")]
    got = got.select("doc_id", *d, F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"), "verified")
    return sorted((tuple(r) for r in got.select(COLUMNS).collect()), key=str)


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = queries.op11_merkle_manifest(spark, SMALL).select(COLUMNS).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("fanout", [2, 3, 5])
def test_odd_rows(spark, fanout):
    """Null fields and sources, repeated rows, shared and null ids, a very long text, newlines."""
    rows = [(None, "s", "en", 1, "no id\n"), (None, "s", None, None, None), (1, None, "en", 3, "a\nb"), (2, None, "", 0, ""),
            (3, "s", "en", 2, "é\n𝒳"), (3, "s", "en", 2, "é\n𝒳"), (3, "s", "de", 2, "other\ntext"), (4, "", "en", 9, longest()),
            (5, "é", "en", 1, "\n"), (6, "z", "en", 1, "-"), (7, "z", None, 1, "-")] + [
            (i, "s", "en", i, f"line\n{i}") for i in range(10, 60)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as leaf", "2 as path", "3 as tree", "4 as digest", "5 as lo")
    assert run(docs, fanout=fanout) == brute(rows, fanout)


def test_lone_leaf_and_empty_table(spark):
    one = [(2, "s", "en", 1, "x\ny")]
    got = run(spark.createDataFrame(one, SCHEMA))
    assert got == brute(one) and got[0][1] == got[0][2] == got[0][3] and got[0][4] == h("")
    assert run(spark.createDataFrame([], SCHEMA)) == []


def test_intervals_nest(spark):
    """A node covers what its parts cover, and every level covers all ranks once."""
    rows = [(i, "s" if i % 3 else "t", "en", 1, f"{i}") for i in range(100)]
    leaves = spark.createDataFrame(rows, SCHEMA).select(
        F.col("doc_id").alias("id"), "source", F.unhex(F.sha2("text", 256)).alias("digest"))
    made = merkle.manifest(leaves)
    nodes = made.trees.nodes().collect()
    for t, n in ((0, 66), (1, 34)):
        for level in {r["level"] for r in nodes}:
            spans = sorted((r["lo"], r["hi"]) for r in nodes if r["tree"] == t and r["level"] == level)
            if spans:
                assert spans[0][0] == 0 and spans[-1][1] == n and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
                assert all(hi - lo <= 3 ** level and lo % 3 ** level == 0 for lo, hi in spans)
