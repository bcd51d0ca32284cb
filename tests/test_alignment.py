"""Word alignment against a brute-force version and a planted dictionary."""

import math
import os
import random
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from termweave.operators import alignment
from termweave.session import checkpoint_dir


def _brute(pairs, rounds):
    counted = [(Counter([*s.lower().split()]), Counter(t.lower().split())) for s, t in pairs if s and t and s.split()]
    for e, _ in counted:
        e[""] = 1
    t = defaultdict(lambda: 10 ** 9)
    for _ in range(rounds):
        c = Counter()
        for es, fs in counted:
            for f, nf in fs.items():
                whole = sum(ne * t[e, f] for e, ne in es.items())
                for e, ne in es.items():
                    c[e, f] += nf * math.floor(1e6 * float(ne * t[e, f]) / float(whole)) if whole else 0
        total = Counter()
        for (e, _), n in c.items():
            total[e] += n
        t = {(e, f): math.floor(1e9 * float(n) / float(total[e])) if total[e] else 0 for (e, f), n in c.items()}
    return t


def _shares(pairs, rounds):
    """Sums of shares in round ``rounds``."""
    t = _brute(pairs, rounds - 1) if rounds > 1 else defaultdict(lambda: 10 ** 9)
    c = Counter()
    for s, tgt in pairs:
        es, fs = Counter([*s.split(), ""]), Counter(tgt.split())
        for f, nf in fs.items():
            whole = sum(ne * t[e, f] for e, ne in es.items())
            for e, ne in es.items():
                c[e, f] += nf * math.floor(1e6 * float(ne * t[e, f]) / float(whole)) if whole else 0
    return c


def _frame(spark, pairs):
    return spark.createDataFrame([(i, s, t, "extra") for i, (s, t) in enumerate(pairs)],
                                 "row_no bigint, src string, tgt string, pair string")


@pytest.mark.parametrize("rounds", [1, 3])
def test_equals_brute_force(spark, rounds):
    rnd = random.Random(rounds)
    words = [f"w{i}" for i in range(9)]
    pairs = [(" ".join(rnd.choices(words, k=rnd.randrange(7))), " ".join(rnd.choices(words, k=rnd.randrange(7))).upper())
             for _ in range(60)]
    pairs += pairs[:20] * 3 + [("", "x y"), ("x", ""), (None, "x"), ("x", None), ("  \n", "x y"), ("lone", "lone Lone")]
    got = {(r["e"], r["f"]): r["t"] for r in alignment.align(_frame(spark, pairs), rounds).collect()}
    assert got == _brute(pairs, rounds)


def test_finds_a_planted_dictionary(spark):
    rnd = random.Random(1)
    known = {f"src{i}": f"tgt{i}" for i in range(40)}
    pairs = []
    for _ in range(400):
        s = rnd.sample(sorted(known), 6)
        t = [known[w] for w in s]
        rnd.shuffle(t)
        pairs.append((" ".join(s), " ".join([*t, "common"])))
    found = {r["src"]: r["tgt"] for r in alignment.lexicon(alignment.align(_frame(spark, pairs), 6)).collect()}
    assert set(found) == set(known)
    assert sum(found[w] == known[w] for w in known) >= 38


def test_ties_least_and_empty_tables(spark):
    t = alignment.align(_frame(spark, [("a", "y x")]), 2)
    assert [(r["src"], r["tgt"], r["score"]) for r in alignment.lexicon(t).collect()] == [("a", "x", 500_000_000)]
    assert alignment.lexicon(t, 600_000_000).isEmpty()
    assert alignment.align(_frame(spark, [("a", "b")]).where("false"), 2).isEmpty()
    with pytest.raises(ValueError):
        alignment.align(_frame(spark, []), 0)


def _sizes(folder):
    return sum(os.path.getsize(os.path.join(d, x)) for d, _, names in os.walk(folder) for x in names if x.endswith(".parquet"))


def test_links_are_not_written(spark):
    """600,000 links of 40 pairs, 16,000 words of text: what is kept between rounds is in proportion to the text."""
    pairs = [(" ".join(f"s{i}x{k}" for k in range(50)), " ".join(f"t{i}x{k}" for k in range(300))) for i in range(40)]
    folder = checkpoint_dir(spark).removeprefix("file:")
    before = _sizes(folder)
    lex = alignment.lexicon(alignment.align(_frame(spark, pairs), likeliest=True))
    assert lex.count() == 40 * 50
    assert _sizes(folder) - before < 12 * sum(len(s) + len(t) for s, t in pairs)


@pytest.mark.parametrize("block_words", [5, 10 ** 6])
def test_likeliest_words_of_any_blocks(spark, block_words):
    rnd = random.Random(block_words)
    pairs = [(" ".join(rnd.choices("abcdefgh", k=5)), " ".join(rnd.choices("pqrstuvwxyz\u00e9", k=9))) for _ in range(40)]
    want = alignment.lexicon(alignment.align(_frame(spark, pairs), 3)).collect()
    got = alignment.lexicon(alignment.align(_frame(spark, pairs), 3, likeliest=True, block_words=block_words)).collect()
    assert sorted(got) == sorted(want) and len(want) == 8


@pytest.mark.parametrize("links", [7, 50, 10 ** 6])
def test_a_block_by_slices_of_links(monkeypatch, links):
    """Words with more links than are built at a time are taken by slices of their pairs."""
    monkeypatch.setattr(alignment, "LINKS", links)
    rnd = random.Random(links)
    pairs = sorted({(" ".join(rnd.choices("abcde", k=4)), " ".join(rnd.choices("xyz", k=5))) for _ in range(50)})
    batch = pa.RecordBatch.from_pydict({"src": [s for s, _ in pairs], "tgt": [t for _, t in pairs], "weight": [1] * len(pairs)})
    cut = pa.Table.from_batches(alignment._cut(1)([batch]))
    first = Counter()
    for (e, _), n in _shares(pairs, 1).items():
        first[e] += n
    sums = pa.table({"block": pa.nulls(len(first), pa.int32()), "weight": pa.nulls(len(first), pa.int64()), "a": list(first),
                     "b": pa.nulls(len(first), pa.string()), "sums": [[n] for n in first.values()]}, cut.schema)
    block = alignment._Block(pa.concat_tables([cut, sums]).to_batches())
    got = {}
    for p in block.chunks():
        e, f, c = block.rounds(p, 2)
        got |= {(block.src[i].as_py(), block.tgt[j].as_py()): n for i, j, n in zip(e.tolist(), f.tolist(), c.tolist())}
    assert got == _shares(pairs, 2)
