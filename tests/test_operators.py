"""Operator-level golden cases and properties."""

import math
from html.parser import HTMLParser

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from termweave.functions import constants as K
from termweave.operators import answering, corpus, evaluation, matching, mining, ordering, prompting
from tests.conftest import MEDIUM


def _rows(spark, data):
    return spark.createDataFrame(data, "row_no bigint, index string, English string, Vietnamese string, "
                                       "`English Sentence` string, `Vietnamese Sentence` string")


def test_auto_index_golden(spark):
    df = _rows(spark, [(1, "", "a", "b", "a.", "b."), (2, "5", "a", "b", "a.", "b."),
                       (3, "x", "a", "b", "a.", "b."), (4, None, "a", "b", "a.", "b.")])
    got = [r["index"] for r in prompting.assign_index(df).orderBy("row_no").collect()]
    assert got == [1, 5, 2, 3]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.sampled_from(["", "7", "x", " 12 ", "1_0", "-3"]), min_size=1, max_size=40),
       st.integers(min_value=1, max_value=7))
def test_prefix_sum_matches_python(spark, idx, bucket):
    df = spark.createDataFrame([(i * 3 + 1, v) for i, v in enumerate(idx)], "row_no bigint, index string")
    got = [r["index"] for r in prompting.assign_index(df, bucket_size=bucket).orderBy("row_no").collect()]
    want, auto = [], 1
    for v in idx:
        s = v.strip().replace("_", "")
        try:
            want.append(int(s))
        except ValueError:
            want.append(auto)
            auto += 1
    assert got == want


def test_validation_first_rule_wins(spark):
    df = _rows(spark, [(1, "1", " ", "", "", ""), (2, "2", "a", " ", "", ""), (3, "3", "a", "b", '"', ""),
                       (4, "4", "a", "b", "A.", " "), (5, "5", "FEVER", "b", "A fever.", "b."),
                       (6, "6", "cold", "b", "A fever.", "b.")])
    got = [r["reason"] for r in prompting.validation_reason(df).orderBy("row_no").collect()]
    assert got == [K.REASON_MISSING_EN_TERM, K.REASON_MISSING_VI_TERM, K.REASON_MISSING_EN_SENTENCE,
                   K.REASON_MISSING_VI_SENTENCE, None,
                   "English Sentence does not contain English term 'cold'"]


def test_resolve_attempts_golden(spark):
    acc = spark.createDataFrame(
        [(1, 1, "t", "điều", "s", "p"), (2, 2, "t", "điều", "s", "p"), (3, 3, "t", "điều", "s", "p"),
         (4, 4, "t", "điều", "s", "p")],
        "row_no bigint, index bigint, en_term string, vi_term string, en_sentence string, prompt_input string")
    e = "LLM API error: E"
    att = spark.createDataFrame(
        [(1, 0, "1 | s | Điều x", "success"), (1, 1, "1 | s | Điều y", "success"), (1, 2, "1 | s | Điều z", "success"),
         (2, 0, None, e), (2, 1, None, e), (2, 2, None, e),
         (3, 0, "1 | s | no", "success"), (3, 1, "bad", "success"), (3, 2, "", "success"),
         (4, 0, "4 | s | no", "success"), (4, 1, "4 | s | có điều", "success"), (4, 2, "4 | s | điều 2", "success")],
        "row_no bigint, attempt int, raw_response string, error string")
    res = {r["row_no"]: r for r in prompting.resolve_attempts(acc, att).collect()}
    assert res[1]["status"] == "failed_validation: success" and res[1]["raw_response"] == "1 | s | Điều z"
    assert res[2]["status"] == "failed_api: " + e and res[2]["raw_response"] == ""
    assert res[3]["status"] == "failed_api: success"
    assert res[4]["status"] == "success" and res[4]["raw_response"] == "4 | s | có điều"
    assert res[4]["vi_sentence_gen"] == "có điều"


def test_bleu_identity_and_short(spark):
    refs = spark.createDataFrame([(0, "the cat sat on the mat ."), (1, "a b c d")], "line_no bigint, text string")
    same = spark.createDataFrame([("s", 0, "the cat sat on the mat ."), ("s", 1, "a b c d")],
                                 "system string, line_no bigint, text string")
    assert math.isclose(evaluation.corpus_bleu(refs, same).first()["bleu"], 100.0)
    short = spark.createDataFrame([("s", 0, "the cat"), ("s", 1, "a b")], "system string, line_no bigint, text string")
    assert evaluation.corpus_bleu(refs, short).first()["bleu"] == 0.0


def test_bleu_hand_computed(spark):
    refs = spark.createDataFrame([(0, "a b c d e")], "line_no bigint, text string")
    hyp = spark.createDataFrame([("s", 0, "a b c x e")], "system string, line_no bigint, text string")
    r = evaluation.corpus_bleu(refs, hyp).first()
    # p1 = 4/5, p2 = 2/4, p3 = 1/3, p4 = 0 -> smoothed 100/(2*2); bp = 1
    p = [80.0, 50.0, 100 / 3, 100 / 4]
    want = math.exp(sum(math.log(x) for x in p) / 4)
    assert math.isclose(r["bleu"], want, rel_tol=1e-12)


def test_tokenize_13a(spark):
    df = spark.createDataFrame([("Hello, world! It's 3.5-4 (ok) &amp; done.",)], "t string")
    toks = df.select(evaluation.tokenize_13a("t")).first()[0]
    assert toks == ["Hello", ",", "world", "!", "It's", "3.5", "-", "4", "(", "ok", ")", "&", "done", "."]


def test_anchor_join_equals_broadcast(spark):
    texts = spark.createDataFrame(
        [(i, "en", s) for i, s in enumerate(["fever and cough", "no match here", "a fe", "coughing fever",
                                             "ab fever", "xx"])], "id bigint, lang string, t string")
    terms = spark.createDataFrame([("en", "fever"), ("en", "cough"), ("en", "ab"), ("en", "zzz"), ("en", "x")],
                                  "lang string, term string")
    b = matching.contains_join(texts, terms, "t", "term", ["lang"], strategy="broadcast")
    a = matching.contains_join(texts, terms, "t", "term", ["lang"], strategy="anchor")
    key = lambda r: (r["id"], r["term"])
    assert sorted(map(key, b.collect())) == sorted(map(key, a.collect()))
    assert len(b.collect()) == 7


class _Text(HTMLParser):
    SKIP = set(K.DROPPED_HTML_ELEMENTS)

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.parts = 0, []

    def handle_starttag(self, tag, attrs):
        if tag in self.SKIP:
            self.depth += 1

    def handle_endtag(self, tag):
        if tag in self.SKIP and self.depth:
            self.depth -= 1

    def handle_data(self, data):
        if not self.depth and data.strip():
            self.parts.append(data.strip())


@pytest.mark.parametrize("sf_dir", [MEDIUM, "/root/testdata/sf0.1"])
def test_html_text_matches_stdlib_parser(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r["page_id"]: r["t"] for r in pages.select("page_id", mining.html_to_text("html").alias("t")).collect()}
    for r in pages.select("page_id", "html").collect():
        p = _Text()
        p.feed(r["html"])
        p.close()
        assert got[r["page_id"]] == "\n".join(p.parts), r["page_id"]


def test_url_usable(spark):
    df = spark.createDataFrame([("http://a.org/x.pdf",), ("https://a.org/x.PDF?y=1",), ("ftp://a.org/x",),
                                ("http://a.org/doc.html",), (None,)], "u string")
    got = [r[0] for r in df.select(mining.url_usable("u")).collect()]
    assert got == [False, False, False, True, False]


def test_answers_golden(spark):
    q = spark.createDataFrame(
        [("q1", "open_ended"), ("q2", "multi_choice"), ("q3", "multi_choice"), ("q4", "other"),
         ("q5", "open_ended"), ("q6", "open_ended_multi_choice")], "id string, question_type string")
    r = spark.createDataFrame(
        [("q1", "plain text"), ("q2", "plain text"), ("q3", "[1]"), ("q4", "[1]"),
         ("q5", '{"selected_option": null, "reasoning": "r"}'), ("q6", '{"selected_option": "B"} x')],
        "id string, response string")
    a, rej = answering.assemble_answers(q, r)
    got = {x["id"]: (x["prediction"], x["reasoning"], x["choice"]) for x in a.collect()}
    assert got["q1"] == ("plain text", "plain text", "A")
    assert got["q2"] == ("", "plain text", "")
    assert got["q4"] == ("", K.UNSUPPORTED_REASONING, "")
    assert got["q5"] == ("r", "r", "A")
    assert got["q6"] == ("", '{"selected_option": "B"} x', "")  # trailing junk is not JSON
    assert [x["id"] for x in rej.collect()] == ["q3"]


def test_ascii_evidence_fallback(spark):
    s = spark.createDataFrame([("t", 1, "abcdé"), ("t", 2, "plain words"), ("u", 1, "ééé")],
                              "term string, result_rank int, body string")
    got = {r["term"]: r["evidence"] for r in answering.ascii_evidence(s, ["term"]).collect()}
    assert got == {"t": "plain words", "u": K.NO_ENGLISH_EVIDENCE}


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_dense_row_number_partition_independent(spark, parts):
    df = spark.range(0, 500, 3).withColumnRenamed("id", "k").repartition(parts)
    got = [r["row_no"] for r in ordering.dense_row_number(df, "k", bucket_size=17).orderBy("k").collect()]
    assert got == list(range(1, len(got) + 1))


def test_best_sentences_anchor_strategy_equals_broadcast(spark):
    from termweave.plans.fixtures import Fixtures
    from tests.conftest import SMALL

    fx = Fixtures(spark, SMALL)
    a = mining.best_sentences(fx.docs(), fx.terms(), fx.keywords(), strategy="anchor")
    b = mining.best_sentences(fx.docs(), fx.terms(), fx.keywords(), strategy="broadcast")
    assert a.count() > 0
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_dense_row_number_sparse_keys_use_quantile_buckets(spark):
    import random

    rnd = random.Random(5)
    keys = sorted(rnd.sample(range(1, 10**15), 300))
    df = spark.createDataFrame([(k,) for k in keys], "k bigint").repartition(3)
    got = [r["row_no"] for r in ordering.dense_row_number(df, "k", bucket_size=10).orderBy("k").collect()]
    assert got == list(range(1, 301))


def test_failed_calls_keep_null_reasoning_and_are_listed(spark):
    q = spark.createDataFrame([("q1", "open_ended"), ("q2", "multi_choice"), ("q3", "other"), ("q4", "open_ended")],
                              "id string, question_type string")
    r = spark.createDataFrame([("q1", None, "LLM API error: busy"), ("q2", None, "LLM API error: busy"),
                               ("q4", "text", "success")], "id string, response string, error string")
    a, rej = answering.assemble_answers(q, r)
    got = {x["id"]: (x["prediction"], x["reasoning"], x["choice"]) for x in a.collect()}
    assert got == {"q1": (None, None, "A"), "q2": ("", None, ""), "q3": ("", K.UNSUPPORTED_REASONING, ""),
                   "q4": ("text", "text", "A")}
    assert sorted(tuple(x) for x in rej.collect()) == [("q1", "LLM API error: busy"), ("q2", "LLM API error: busy")]


def test_provider_chain(spark):
    keys = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "k string")
    hits = spark.createDataFrame(
        [("a", 1, i, f"t{i}", f"b{i}") for i in range(7)] + [("a", 2, 1, "x", "no")]
        + [("b", 2, i, "t", f"é{i}") for i in range(5)] + [("b", 3, 1, "t", "no")]
        + [("c", 3, 1, "t", "éé"), ("c", 3, 2, "t", "plain"), ("c", 3, 3, "t", "words"), ("c", 3, 4, "t", "late")],
        "k string, provider int, result_rank int, title string, body string")
    got = dict(answering.provider_evidence(keys, hits, ["k"]).collect())
    assert got == {"a": "t0: b0 | t1: b1 | t2: b2 | t3: b3 | t4: b4", "b": "é0 | é1 | é2", "c": "plain | words",
                   "d": K.NO_ENGLISH_EVIDENCE}
    assert dict(answering.provider_evidence(keys, hits, ["k"], third_answers=False).collect())["d"] == K.NO_EVIDENCE


def test_same_option_in_two_questions_has_its_own_evidence(spark):
    q = spark.createDataFrame([("q1", "s", {"A": "fever"}), ("q2", "s", {"A": "fever"})],
                              "id string, question string, options map<string,string>")
    ev = spark.createDataFrame([("q1", "A", "one"), ("q2", "A", "two")], "id string, opt_key string, evidence string")
    got = dict(answering.evidence_map(q, ev).select("id", "evidence_text").collect())
    assert got == {"q1": "A: one", "q2": "A: two"}
    by_text = answering.option_rows(q).select("query").distinct().withColumn("evidence", F.lit("same"))
    got = dict(answering.evidence_map(q, by_text, on=("query",)).select("id", "evidence_text").collect())
    assert got == {"q1": "A: same", "q2": "A: same"}


@pytest.mark.parametrize("strategy", ["broadcast", "anchor"])
def test_containment_join_of_two_sides_of_one_frame(spark, strategy):
    df = spark.createDataFrame([("en", "a fever came"), ("en", "fever"), ("fr", "fever"), ("en", "ca"), ("en", "x")],
                               "lang string, t string")
    terms = df.select("lang", F.col("t").alias("term"))
    got = matching.contains_join(df, terms, "t", "term", ["lang"], strategy=strategy)
    assert sorted(tuple(r) for r in got.select("lang", "t", "term").collect()) == [
        ("en", "a fever came", "a fever came"), ("en", "a fever came", "ca"), ("en", "a fever came", "fever"),
        ("en", "ca", "ca"), ("en", "fever", "fever"), ("en", "x", "x"), ("fr", "fever", "fever")]


def test_bleu_refuses_files_of_unequal_length(spark):
    refs = spark.createDataFrame([(i, "a b c d e") for i in range(4)], "line_no long, text string")
    preds = refs.withColumn("system", F.lit("s"))
    assert evaluation.corpus_bleu(refs, preds).count() == 1
    for bad in (preds.where("line_no < 2"), preds.union(preds.selectExpr("line_no + 9", "text", "system"))):
        with pytest.raises(Exception, match="differ in length"):
            evaluation.corpus_bleu(refs, bad).collect()


def test_vocabulary_is_whole_and_ranked(spark):
    r = spark.createDataFrame([(" ".join(f"t{j}" for j in range(i + 1)),) for i in range(60)], "text string")
    got = [tuple(x) for x in corpus.vocabulary(r.repartition(5)).orderBy("id").collect()]
    want = sorted(((60 - j, f"t{j}") for j in range(60)), key=lambda x: (-x[0], x[1]))
    assert got == [(t, n, K.FIRST_TOKEN_ID + i) for i, (n, t) in enumerate(want)]
    assert corpus.vocabulary(r, vocab_size=7).count() == 7


def test_pending_rows_for_resume(spark):
    df = _rows(spark, [(1, "1", "a", "b", "a.", "b."), (2, "2", "a", "b", "a.", "b."), (3, "3", "a", "b", "a.", "b.")])
    acc = prompting.accepted(prompting.validation_reason(prompting.assign_index(df)))
    done = spark.createDataFrame([(2, "success")], "row_no bigint, status string")
    assert sorted(r["row_no"] for r in prompting.pending(acc, done).collect()) == [1, 3]


@pytest.mark.parametrize("strategy,limit", [("broadcast", 1), ("anchor", 1), ("auto", 10), ("auto", 1)])
def test_contains_join_empty_terms_match_nothing(spark, strategy, limit):
    texts = spark.createDataFrame([(1, "en", "a cat sat"), (2, "en", ""), (3, "en", None)], "i int, lang string, t string")
    terms = spark.createDataFrame([("en", ""), ("en", "at"), ("en", "cat"), ("en", None)], "lang string, term string")
    got = matching.contains_join(texts, terms, "t", "term", ["lang"], strategy=strategy, broadcast_limit=limit)
    assert sorted((r["i"], r["term"]) for r in got.collect()) == [(1, "at"), (1, "cat")]
