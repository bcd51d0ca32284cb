"""Toxicity and quality: held-out accuracy, fairness, fixed rows."""

import random
from zlib import crc32

import numpy as np
import pyarrow.dataset as ds
from llm_data import MEDIUM, none, odd  # noqa: F401
from pyspark.sql import functions as F

from termweave.llm import quality_ftrl, queries, toxicity
from termweave.llm.learning import labelled_sample


def held_out_accuracy(df, label, mod, rest):
    truth = dict(zip(*ds.dataset(f"{MEDIUM}/labels.parquet").to_table(
        columns=["doc_id", label]).to_pydict().values(), strict=True))
    got = df.collect()
    for r in got:
        assert r["held_out"] == (crc32(str(r["doc_id"]).encode()) % mod == rest)
        assert 0 <= r["score"] <= 1
    some = [(r["predicted"], truth[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in truth]
    return sum(p == y for p, y in some) / len(some), got


def test_toxicity_held_out(spark):
    accuracy, got = held_out_accuracy(queries.op4_toxicity(spark, MEDIUM), "toxic", 3, 1)
    assert accuracy > 0.9
    assert all(r["predicted"] == (r["score"] >= 0.7) for r in got)


def test_quality_held_out(spark):
    accuracy, got = held_out_accuracy(queries.op5_quality_ftrl(spark, MEDIUM), "quality", 5, 0)
    assert accuracy > 0.95
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in got)


def test_swaps_stay_within_a_kind():
    got = toxicity.swaps({"muslims", "walk"}, {"religion": ["muslims", "jews"], "age": ["old"]})
    assert got == [("muslims", "jews")]


def test_neutral_mentions_are_not_flagged():
    """One group stands in many toxic texts of the sample.  Without the penalty its name is toxic."""
    r = random.Random(1)
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300)]
    feats, y, diffs = [], [], []
    for i in range(1200):
        toxic = i % 3 == 0
        group = "muslims" if r.random() < (0.9 if toxic else 0.05) else r.choice(["jews", "christians", "hindus"])
        text = " ".join(r.sample(words, 12) + [group] + (["awful"] if toxic and r.random() < 0.8 else []))
        f, d, ends = toxicity.text_features(text)
        feats.append(f)
        y.append(int(toxic))
        diffs += [d[a:b] for a, b in zip([0] + ends[:-1], ends, strict=True)]
    plain = toxicity.fit(feats, y, l1=1e-3)
    fair = toxicity.fit(feats, y, diffs, l1=1e-3, counterfactual=20.0)
    gap = lambda m: abs(m.score("muslims walk home") - m.score("hindus walk home"))
    assert gap(plain) > 0.3
    assert gap(fair) < gap(plain) / 4
    assert fair.score("awful hindus") > fair.score("muslims walk home") + 0.3


def test_stems_carry_over():
    feats = [toxicity.text_features(f"some plain words {w}")[0] for w in
             [f"vile{e}" for e in ("ab", "cd", "ef", "gh", "ij", "kl", "mn", "op", "qr", "st")]
             + [f"kind{e}" for e in ("ab", "cd", "ef", "gh", "ij", "kl", "mn", "op", "qr", "st")]]
    model = toxicity.fit(feats, [1] * 10 + [0] * 10)
    assert model.score("some plain words vilexyz") > 0.9 > 0.1 > model.score("some plain words kindxyz")


def test_shape_short_way_equals_long_way():
    for w in ["the", "The", "THE!!", "a", "A", "I.", "abc**..", "aBc", "ABc", "foo.bar", "12ab", "é", "ÉÉ!!", "x--", "||"]:
        assert quality_ftrl.shape(w) == quality_ftrl._RUNS.sub(
            lambda m: "A" if m["u"] else "a" if m["l"] else "0" if m["d"] else m["s"][0], w)


def test_ftrl_separates():
    h = quality_ftrl.Hasher()
    rows = [(*h(f"good words here {i}"), 1) for i in range(60)] + [(*h(f"JUNK!! JUNK!! {i}"), 0) for i in range(60)]
    order = np.random.default_rng(0).permutation(len(rows))
    m = quality_ftrl.fit([rows[i] for i in order], epochs=6)
    assert m.score(*h("good words again")) > 0.6 > 0.4 > m.score(*h("JUNK!! more"))


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(5, 1, 0), (5, 0, 0), (4, 0, 1), (None, 1, 1), (6, None, None)],
                                   "doc_id long, quality int, toxic int")
    empty = labels.limit(0)
    for run in (toxicity.toxicity, quality_ftrl.quality):
        got = run(odd, labels).collect()
        assert len(got) == odd.count()
        assert all(0 <= r["score"] <= 1 for r in got)
        by = {}
        for r in got:
            by.setdefault(r["doc_id"], set()).add(r["score"])
        assert by[5] == by[6] and by[1] == by[2]
        assert run(none, labels).count() == 0
        assert {r["score"] for r in run(odd, empty).collect()} == {0.5}


def test_sample_holds_one_text_an_id(spark):
    """However many rows an id has, the sample is bounded by ``max_rows``, and the same in any order."""
    rows = [(1, f"text {i}") for i in range(500)] + [(i, f"other {i}") for i in range(2, 30)] + [(2, None)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 30)], "doc_id long, toxic int")
    got = []
    for n in (1, 5):
        docs = spark.createDataFrame(rows if n == 1 else rows[::-1], "doc_id long, text string").repartition(n)
        sample = labelled_sample(docs, labels, "toxic", F.lit(True), 29)
        assert sample.columns == ["doc_id", "text", "label"]
        got.append(sorted(map(tuple, sample.collect())))
        assert labelled_sample(docs, labels, "toxic", F.lit(True), 10).count() == 10
    assert got[0] == got[1] and [i for i, _, _ in got[0]] == list(range(1, 30))
