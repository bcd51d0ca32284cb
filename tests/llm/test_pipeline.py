"""The pipeline against its stages put together by hand, and on odd rows."""

import random
import sys

import pytest
from llm_data import ROOT, SMALL

sys.path.insert(0, ROOT)
import corpus_pipeline  # noqa: E402

from termweave.llm import minhash, quality_rules, secret_scan, toxicity  # noqa: E402


def test_stages_are_named():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "toxicity", "minhash_near_dedup", "secret_scans", "packing"]


def test_run_equals_single_operators(spark):
    """Each decision taken apart: ids that stay, the blanked texts, and all their tokens packed."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    keep = {r["doc_id"] for r in quality_rules.quality_rules(docs).where("kept").collect()}
    left = docs.where(docs["doc_id"].isin(list(keep)))
    model = toxicity.train(left, spark.read.parquet(f"{SMALL}/labels.parquet"), ~toxicity.held_out())
    keep = {i for i in keep if model.score(text[i]) < 0.7}
    left = docs.where(docs["doc_id"].isin(list(keep)))
    keep = {r["doc_id"] for r in minhash.near_duplicates(left).where("kept").collect()}
    left = docs.where(docs["doc_id"].isin(list(keep)))
    blanked = {}
    for r in secret_scan.secrets(left).collect():
        t, at, out = text[r["doc_id"]], 0, ""
        for s in sorted(r["spans"], key=lambda s: (s["start"], s["end"])):
            if s["start"] >= at:
                out += t[at:s["start"]] + "[secret]"
            at = max(at, s["end"])
        blanked[r["doc_id"]] = out + t[at:]
    import numpy as np
    from public_tokenizers import path
    from tokenizers import Tokenizer
    from zlib import crc32

    tok = Tokenizer.from_file(path("byte_bpe_50k.json"))
    ids = {i: np.array(tok.encode(t, add_special_tokens=False).ids + [1], "<u4") for i, t in blanked.items()}
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert {r["doc_id"] for r in got} == keep
    total = dict.fromkeys(keep, 0)
    for r in got:
        total[r["doc_id"]] += r["length"]
        assert crc32(ids[r["doc_id"]][r["start"]:r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
    assert total == {i: len(x) for i, x in ids.items()}


def prose(seed):
    r = random.Random(seed)
    return " ".join("".join(r.choice(["the", "on", "er", "ing", "at", "is", "ou", "me", "ra", "lo", "du", "pi",
                                          "sk", "ve", "no", "ch", "wh", "ay"])
                            for _ in range(r.randint(1, 4))) for _ in range(80))


@pytest.mark.parametrize("empty", [False, True])
def test_stages_on_odd_rows(spark, empty):
    words = prose(1)
    rows = [(1, words, None, "s", 5), (1, words, None, "s", 5), (2, words, "en", None, None),
            (None, words + " more of it", "en", "s", 1), (3, None, "en", "s", 0), (4, "", "en", "s", 0),
            (5, prose(2) + " password=0123456789abcdefX and " + prose(3), "en", "s", 9)]
    docs = spark.createDataFrame([] if empty else rows,
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.selectExpr("*", "1 as score", "2 as kept", "3 as row", "4 as spans")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "score", "kept", "row", "spans"], name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    left = {r["doc_id"]: r for r in docs.collect()}
    if empty:
        assert not left
    else:
        assert set(left) == {1, None, 5} and docs.count() == 3
        assert "password" not in left[5]["text"] and left[5]["n_chars"] == len(left[5]["text"])
        assert left[1]["text"] == words and left[1]["n_chars"] == 5
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() >= (0 if empty else 3)
