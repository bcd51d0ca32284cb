"""Plans that hold at size: what is shuffled, aggregated and numbered; retrieval and increments on
small golden rows."""

import math

import pytest
from pyspark.sql import functions as F

from termweave.functions import constants as K
from termweave.operators import corpus, matching, mining, ordering, retrieval
from termweave.plans import queries
from termweave.plans.fixtures import Fixtures
from termweave.streaming import incremental
from tests.conftest import SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(i, j, "en" if i % 3 else "fr", f"w{i} alpha beta{j} gam{i % 5} x{'y' * (j % 4)}") for i in range(30) for j in range(4)]
    return spark.createDataFrame(rows, "doc_id long, pos int, lang string, s string")


@pytest.fixture(scope="module")
def terms(spark):
    t = ["alpha", "beta1", "gam", "gam3", "xy", "yyy", "w1", "a", "zzz", "", "pha be"]
    return spark.createDataFrame([(x, lang, n) for lang in ("en", "fr") for n, x in enumerate(t)], "term string, lang string, n int")


def test_late_join_equals_the_others_and_shuffles_no_text(texts, terms):
    def run(**kw):
        return matching.contains_join(texts, terms, "s", "term", ["lang"], **kw)

    late = run(strategy="anchor", ids=["doc_id", "pos"], broadcast_bytes=0)
    want = run(strategy="broadcast")
    assert late.columns == want.columns and late.count() == want.count() > 0
    assert late.exceptAll(want).isEmpty()
    shuffles = [line for line in _plan(late).split("\n") if "Exchange" in line and "__gram" in line]
    assert shuffles and not any(" s#" in line or ",s#" in line for line in shuffles)


def test_best_sentence_needs_no_sort_aggregate(spark):
    fx = Fixtures(spark, SMALL)
    plan = _plan(mining.best_sentences(fx.docs(), fx.terms(), fx.keywords()))
    assert "SortAggregate" not in plan and "HashAggregate" in plan


@pytest.mark.parametrize("bucket", [1, 3, 50])
def test_prefix_sums_in_two_levels(spark, monkeypatch, bucket):
    monkeypatch.setattr(ordering, "DENSE_BUCKET", 4)
    df = spark.range(1, 200).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"), F.lit("x").alias("payload"))
    got = ordering.prefix_sum(df, "k", "v", "total", bucket_size=bucket, dense_keys=True)
    assert got.columns == ["k", "v", "payload", "total"]
    want, total = [], 0
    for k in range(1, 200):
        total += k % 7
        want.append((k, total))
    assert sorted((r["k"], r["total"]) for r in got.collect()) == want


def test_rank_within_groups(spark):
    df = spark.createDataFrame([(g, n) for g in "abc" for n in range(20)], "g string, n int").repartition(3)
    got = ordering.rank_within(df, "g", [F.desc("n")], "rk")
    assert all(r["rk"] == 20 - r["n"] for r in got.collect())


def test_retrieval_scores(spark):
    docs = spark.createDataFrame([(1, "cat cat dog"), (2, "cat"), (3, "bird"), (4, "dog bird fish"), (5, ""), (6, None), (7, "fish"),
                                  (8, "ant")], "doc_id long, text string")
    asked = spark.createDataFrame([("q1", "CAT, cat!"), ("q2", "nothing"), ("q3", "fish dog"), ("q4", "")], "id string, query string")
    index = retrieval.postings(docs)
    got = {}
    for r in retrieval.search(index, asked, ["id"], 2, slice_rows=1).collect():
        got.setdefault(r["id"], {})[r["rank"]] = (r["doc"], r["score"])
    assert set(got) == {"q1", "q3"}
    n, mean = 6, 10 / 6

    def part(df, tf, length):
        return round(1e6 * math.log(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / mean)))
    assert got["q1"] == {1: (2, part(2, 1, 1)), 2: (1, part(2, 2, 3))} or got["q1"] == {1: (1, part(2, 2, 3)), 2: (2, part(2, 1, 1))}
    assert got["q3"][1] == (4, 2 * part(2, 1, 3))


def test_increments_equal_one_run_and_survive_a_lost_one(spark, tmp_path):
    fx = Fixtures(spark, SMALL)
    docs, keywords = fx.docs(), fx.keywords()
    terms = fx.terms().select("lang", "term")
    state = str(tmp_path / "state")
    part = docs.where("doc_id % 3 <> 0")
    incremental.mine_increment(spark, part, terms.where("length(term) % 2 = 0"), keywords, state)
    # A run that ended before its commit: its folders are there, but nobody reads them.
    mining.best_sentences(docs, terms, keywords).write.parquet(incremental.epoch_path(f"{state}/found", 1))
    docs.select("doc_id").write.parquet(incremental.epoch_path(f"{state}/docs", 1))
    incremental.mine_increment(spark, docs, terms, keywords, state)
    incremental.mine_increment(spark, docs, terms, keywords, state)  # nothing new
    got, want = incremental.mined(spark, state), mining.best_sentences(docs, terms, keywords)
    assert got.count() == want.count() > 0
    assert got.select(want.columns).exceptAll(want).isEmpty()


def test_retrieval_by_blocks_equals_sums_of_all_pairs(spark):
    """Several slices and blocks, equal documents (ties), a token in one search only; and no exchange of
    (search, document) sums: what leaves a slice are the k best of each search."""
    words = [f"w{i}" for i in range(40)]
    docs = spark.createDataFrame([(n, " ".join(words[(n * j * j + j) % 37] for j in range(n % 9 + 1))) for n in range(300)]
                                 + [(n, "w1 w2 w3") for n in range(300, 340)], "doc_id long, text string")
    asked = spark.createDataFrame([(n, f"{words[n % 40]} {words[n * 7 % 40]} w2 only{n}") for n in range(50)], "id long, query string")
    index = retrieval.postings(docs)
    got = retrieval.search(index, asked, ["id"], 4, slice_rows=50, block_rows=8)
    n, total = 340, sum(r["length"] for r in index.select("doc", "length").distinct().collect())
    df, of = {}, {}
    for r in index.collect():
        df[r["token"]] = df.get(r["token"], 0) + 1
        of.setdefault(r["token"], []).append(r)
    want = set()
    for a in asked.collect():
        sums = {}
        for t in set(a["query"].split()):
            if t in df and df[t] <= n / 2:
                for r in of[t]:
                    part = math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * r["tf"] * 2.2 / (
                        r["tf"] + 1.2 * (0.25 + 0.75 * r["length"] / (total / n)))
                    sums[r["doc"]] = sums.get(r["doc"], 0) + round(1e6 * part)
        best = sorted(sums.items(), key=lambda x: (-x[1], x[0]))[:4]
        want |= {(a["id"], i + 1, d) for i, (d, _) in enumerate(best)}
    assert {(r["id"], r["rank"], r["doc"]) for r in got.collect()} == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "sum(part" not in plan


@pytest.mark.parametrize("held", [0, 2_000, 1 << 20])
def test_terms_of_letters_meet_distinct_runs(spark, held):
    """No row per gram of a text; the same pairs whether runs are broadcast, split or shuffled; a term that
    several runs of a text hold comes once, equal rows of terms come each."""
    rows = [(i, "en" if i % 3 else "fr", f"Concat cat, cats{'s' * (i % 3)}-x{i} alpha alphabet{i % 5} ábćd") for i in range(60)]
    texts = spark.createDataFrame(rows, "id long, lang string, s string")
    terms = spark.createDataFrame([(t, lang) for lang in ("en", "fr") for t in ("cat", "alpha", "alphabet", "x", "bc", "oncat", "no", "cat")],
                                  "term string, lang string")
    got = matching.contains_join(texts, terms, "s", "term", ["lang"], strategy="anchor", broadcast_bytes=held)
    want = matching.contains_join(texts, terms, "s", "term", ["lang"], strategy="broadcast")
    assert got.columns == want.columns and got.count() == want.count() > 0
    assert got.exceptAll(want).isEmpty()
    assert "__gram" not in _plan(got)


def test_prompt_rows_join_sentences_not_source_texts(spark):
    """A target text is cleaned before rows multiply it, and source texts are not joined to rows at all."""
    rows = Fixtures(spark, SMALL).rows()
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    top = plan[:plan.index("Join ")]
    assert "regexp_replace" not in top and "split(" not in top
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("lang in ('en', 'de')")
    assert rows.count() == docs.count()


def test_prompt_rows_and_token_counts_share_one_pass_over_texts(spark, monkeypatch):
    """Rows, their terms' ranks and their targets read what one scan of the texts has written."""
    scans = []
    docs = Fixtures.docs
    monkeypatch.setattr(Fixtures, "docs", lambda self: scans.append(1) or docs(self))
    fx = Fixtures(spark, SMALL)
    rows = fx.rows()
    assert rows.count() > 0 and len(scans) == 1
    counts = Fixtures(spark, SMALL).document_frequencies()
    assert fx.document_frequencies().exceptAll(counts).isEmpty() and counts.count() == fx.document_frequencies().count()


def test_pairs_are_encoded_with_one_grouping(spark):
    rows = [(1, "a b  c", "x"), (2, "", "y a"), (3, "b", ""), (4, " ", None), (5, "q a", " a q a a")]
    pairs = spark.createDataFrame(rows, "row_no long, src string, tgt string")
    vocab = spark.createDataFrame([("a", 3), ("b", 4), ("c", 5), ("x", 6), ("y", 7)], "token string, id int")
    for held in (0, 1 << 20):
        enc = corpus.encode_pairs(pairs, vocab, max_len=3, broadcast_bytes=held)
        p, u = K.PAD_ID, K.UNK_ID
        assert {r["row_no"]: (r["input_ids"], r["labels"]) for r in enc.collect()} == {
            1: ([3, 4, 5], [6, p, p]), 2: ([p, p, p], [7, 3, p]), 3: ([4, p, p], [p, p, p]),
            4: ([p, p, p], [p, p, p]), 5: ([u, 3, p], [3, u, 3])}
        assert enc._jdf.queryExecution().optimizedPlan().toString().count("Aggregate ") == 1


def test_validated_rows_keep_a_sentence_once(spark):
    v = queries._validated(Fixtures(spark, SMALL))
    assert {"en_sentence", "vi_sentence"} <= set(v.columns) and not {"English Sentence", "Vietnamese Sentence"} & set(v.columns)
    assert all(".zstd." in f for f in v.inputFiles())
