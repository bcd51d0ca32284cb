"""Mining at size: texts are made ready once, rows meet lists of terms by their runs of letters."""

import re

import pytest
from pyspark.sql import functions as F

from termweave.functions import text as T
from termweave.operators import matching, mining
from termweave.plans.fixtures import Fixtures
from tests.conftest import SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def both(spark):
    rows = [(i, j, "en" if i % 3 else "fr", f"{'' if j else '- '}cats{'s' * (i % 3)} concat x{i} alpha{' alphabet' * (i % 2)} ábćd-{i % 5}e")
            for i in range(40) for j in range(3)] + [(99, 0, None, "cat"), (98, 0, "en", None), (97, 0, "en", "")]
    texts = spark.createDataFrame(rows, "doc_id long, pos int, lang string, s string")
    terms = [(t, lang, n) for n, lang in enumerate(("en", "fr", "de"))
             for t in ("cat", "cats", "alpha", "bć", "x1", "cat", "", "c", "- cat", None)]
    return texts, spark.createDataFrame(terms, "term string, lang string, n int")


@pytest.mark.parametrize("held", [0, 1_000, 1 << 20])
@pytest.mark.parametrize("letters", [True, False])
def test_pairs_equal_the_join_without_its_texts(both, held, letters):
    texts, terms = both
    if letters:
        terms = terms.where("term rlike '^[a-z]{3,}$'")
    want = matching.contains_join(texts, terms, "s", "term", ["lang"], strategy="broadcast").select(
        "doc_id", "lang", "pos", "term", "n", F.startswith("s", "term").alias("at_start"))
    for once in (True, False):
        got = matching.contains_pairs(texts, terms, "s", "term", ["doc_id", "lang", "pos"], ["lang"], strategy="anchor",
                                      ids=["doc_id", "pos"], once=once, broadcast_bytes=held)
        assert got.columns == want.columns
        if once:
            assert got.count() == want.count() > 0 and got.exceptAll(want).isEmpty()
        else:
            assert got.distinct().exceptAll(want.distinct()).isEmpty() and want.distinct().exceptAll(got.distinct()).isEmpty()


def test_texts_are_made_ready_once(spark):
    """The documents' text is read once more at most, for the sentences that won; terms come in lists."""
    fx = Fixtures(spark, SMALL)
    plan = _plan(mining.best_sentences(fx.docs(), fx.dictionary(), fx.keywords(), strategy="anchor"))
    assert plan.count("text:string") == 1 and "__ts" in plan
    assert "text:string" not in _plan(mining.sentence_scores(fx.docs(), fx.dictionary(), fx.keywords(), strategy="anchor"))


def test_case_of_terms_is_kept(spark):
    docs = spark.createDataFrame([(1, "en", "The Heart beats in the chest of a human being all day. Heart " + "one two three " * 3 + "four.")],
                                 "doc_id long, lang string, text string")
    keywords = spark.createDataFrame([("en", "chest")], "lang string, keyword string")
    terms = spark.createDataFrame([("en", "HEART"), ("en", "chest"), ("en", "HUMAN"), ("en", "Day.")], "lang string, term string")
    got = {s: sorted(map(tuple, mining.best_sentences(docs, terms, keywords, strategy=s).collect())) for s in ("anchor", "broadcast")}
    assert got["anchor"] == got["broadcast"] and {r[2] for r in got["anchor"]} == {"HEART", "chest", "HUMAN", "Day."}
    scores = {s: sorted(map(tuple, mining.sentence_scores(docs, terms, keywords, strategy=s).collect())) for s in ("anchor", "broadcast")}
    assert scores["anchor"] == scores["broadcast"] and len(scores["anchor"]) == 5


def test_clean_sentences_are_split_alike(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select(T.clean_text("text").alias("c"))
    odd = spark.createDataFrame([(" . a.  b! c? İ.\tx ",), ("",), (". . .",), ("a.[x] b",)], "t string").select(T.clean_text("t").alias("c"))
    both = docs.unionByName(odd).select("c", F.lower("c").alias("l"))
    for c in ("c", "l"):
        assert both.where(T.split_sentences(c) != T.split_clean_sentences(c)).isEmpty()


def test_winners_are_dealt_by_the_number_of_pairs(spark, monkeypatch):
    """A task's share of pairs is bounded, however few shuffle partitions the session has."""
    fx = Fixtures(spark, SMALL)
    docs, terms, keywords = fx.docs(), fx.dictionary(), fx.keywords()
    want = mining.best_sentences(docs, terms, keywords, strategy="broadcast")
    monkeypatch.setattr(mining, "PAIRS_PER_TASK", 100)
    got = mining.best_sentences(docs, terms, keywords, strategy="anchor")
    assert got.count() == want.count() > 0 and got.exceptAll(want).isEmpty()
    counts = {int(n) for n in re.findall(r"hashpartitioning\((?:doc_id|__id)#\w+, (\d+)\)", _plan(got))}
    assert max(counts) > 20 and "ShuffledHashJoin" in _plan(got)
