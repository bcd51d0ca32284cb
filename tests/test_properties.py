"""Property tests: invariants that must hold for any input."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from termweave.functions import constants as K
from termweave.functions import text as T
from termweave.operators import evaluation, mining, prompting

WORDS = st.sampled_from(["fever", "The", "patient", "a.", "b!", "c?", "x", "  ", "\t", "\n", "é.", "[n]",
                         "(p)", "history", " ", "..", "!?", "end."])
TEXT = st.lists(WORDS, min_size=0, max_size=25).map(" ".join)


@settings(max_examples=25, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=8))
def test_split_sentences_joined_back_loses_only_whitespace(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select(T.clean_text("t").alias("c"), T.split_sentences(T.clean_text("t")).alias("s")).collect()
    for r in rows:
        assert " ".join(r["s"]) == r["c"]
        assert all(p == p.strip() for p in r["s"])


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["", "3", "x", " 7 "]), st.sampled_from(["", " ", "fever", "FEVER"]),
                          st.sampled_from(["", "sốt", "  "]), st.sampled_from(["", '"', "A fever.", "'fever'"]),
                          st.sampled_from(["", "Bị sốt.", " "])), min_size=1, max_size=30))
def test_accepted_plus_rejected_is_input(spark, rows):
    df = spark.createDataFrame([(i + 1, *r) for i, r in enumerate(rows)],
                               "row_no bigint, index string, English string, Vietnamese string, "
                               "`English Sentence` string, `Vietnamese Sentence` string")
    v = prompting.validation_reason(prompting.assign_index(df))
    acc = {r["row_no"] for r in prompting.accepted(v).collect()}
    rej = {r["row_no"] for r in prompting.input_rejects(v).collect()}
    assert acc.isdisjoint(rej) and acc | rej == set(range(1, len(rows) + 1))


TOKENS = st.lists(st.sampled_from(["a", "b", "c", "d", "e", "f", "g", "h"]), min_size=4, max_size=12)


@settings(max_examples=15, deadline=None)
@given(st.lists(TOKENS, min_size=1, max_size=5))
def test_bleu_identity_is_100(spark, lines):
    refs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(lines)], "line_no bigint, text string")
    hyp = refs.select(F.lit("s").alias("system"), "line_no", "text")
    assert math.isclose(evaluation.corpus_bleu(refs, hyp).first()["bleu"], 100.0)


@settings(max_examples=10, deadline=None)
@given(st.floats(0, 100), st.floats(0, 100))
def test_delta_antisymmetric(spark, a, b):
    s = spark.createDataFrame([("baseline", a), ("tuned", b)], "system string, bleu double")
    d1 = evaluation.bleu_delta(s).first()
    d2 = evaluation.bleu_delta(s, baseline="tuned", tuned="baseline").first()
    assert d1["delta"] == -d2["delta"]
    assert {d1["verdict"], d2["verdict"]} in ({"improved", "decreased"}, {"unchanged"})


def test_best_sentence_independent_of_partitioning(spark):
    from termweave.plans.fixtures import Fixtures
    from tests.conftest import SMALL

    fx = Fixtures(spark, SMALL)
    base = mining.best_sentences(fx.docs(), fx.terms(), fx.keywords())
    for n in (1, 5):
        other = mining.best_sentences(fx.docs().repartition(n), fx.terms(), fx.keywords())
        assert base.exceptAll(other).isEmpty() and other.exceptAll(base).isEmpty()


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(alphabet="ab .!?  \t\nxyz", max_size=40), min_size=1, max_size=6))
def test_strip_and_word_count_follow_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(T.strip("t"), T.word_count("t")).collect()
    for t, r in zip(texts, got):
        assert r[0] == t.strip()
        assert r[1] == len(t.split())


@settings(max_examples=20, deadline=None)
@given(TEXT)
def test_word_count_clean_equals_word_count(spark, t):
    df = spark.createDataFrame([(t,)], "t string").select(T.clean_text("t").alias("c"))
    r = df.select(T.word_count("c"), T.word_count_clean("c")).first()
    assert r[0] == r[1]


def test_score_parts_add_up(spark):
    kws = F.array(*[F.lit(x) for x in K.CLINICAL_KEYWORDS["en"]])
    df = spark.createDataFrame([("The patient presented with fever.", "fever"), ("fever", "fever"),
                                ("Fever treatment and clinical study results here.", "fever")], "s string, k string")
    rows = df.select(T.score_sentence("s", "k", kws).alias("a"),
                     T.term_score(T.sentence_base("s", kws), F.lower("s"), F.lower("k")).alias("b")).collect()
    assert all(r["a"] == r["b"] for r in rows)


ALPHA = "abcé "


@settings(max_examples=12, deadline=None)
@given(st.lists(st.text(alphabet=ALPHA, min_size=0, max_size=30), min_size=1, max_size=12),
       st.lists(st.text(alphabet=ALPHA, min_size=1, max_size=5), min_size=1, max_size=10, unique=True))
def test_anchor_join_equals_nested_loop(spark, texts, terms):
    from termweave.operators import matching

    t = spark.createDataFrame([(i, "x", s) for i, s in enumerate(texts)], "id bigint, lang string, s string")
    d = spark.createDataFrame([("x", w) for w in terms], "lang string, term string")
    got = sorted((r["id"], r["term"]) for r in
                 matching.contains_join(t, d, "s", "term", ["lang"], strategy="anchor").collect())
    want = sorted((i, w) for i, s in enumerate(texts) for w in terms if w in s)
    assert got == want
