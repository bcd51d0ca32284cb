"""Golden rows for the text rules (FIXTURES.md §4) and their traps."""

from pyspark.sql import functions as F

from termweave.functions import constants as K
from termweave.functions import text as T
from tests.conftest import one


def test_clean_sentence(spark):
    got = one(spark, T.clean_sentence("a"), ' "a" ', '""a""', '"', "\"a'", " 'x'\t", None)
    assert got == ["a", '"a"', "", "\"a'", "x", ""]


def test_clean_text(spark):
    got = one(spark, T.clean_text("a"),
              "Diabetes[1] (a disease) research history.",
              "[a\nb] (c\nd) x",
              "A\r\n\tB  C  ",
              "[a\rb] Free Encyclopedia x",
              None)
    assert got == ["Diabetes re .", "[a b] x", "A B C", "x", ""]


def test_split_sentences(spark):
    got = one(spark, T.split_sentences(T.clean_text("a")), "A b. C d!  E? f.")
    assert got == [["A b.", "C d!", "E?", "f."]]


def test_prepare_vi_examples(spark):
    got = one(spark, T.prepare_vi_examples("a"), "A b. C d! E.", "A b.", '""A b. C""', "")
    assert got == ["A b\nC d", "A b.\nA b.", "\"A b\nC\"", ""]


def test_parse_llm_output(spark):
    got = one(spark, T.parse_llm_output("a"), "7 | x | y | z", "x | a | b", "7 | a", " 1_0 |a|b", None)
    assert [tuple(r) for r in got] == [(7, "x", "y"), (None, None, None), (None, None, None),
                                       (10, "a", "b"), (None, None, None)]


def test_valid_output_case_sensitive(spark):
    df = spark.createDataFrame([("Điều trị bệnh", "điều trị"), ("điều trị bệnh", "điều trị"),
                                ("", "x"), ("x", "")], "s string, t string")
    got = [r[0] for r in df.select(T.valid_output("s", "t")).collect()]
    assert got == [False, True, False, False]


def test_score_sentence(spark):
    kws = F.array(*[F.lit(x) for x in ["treatment", "patient", "presented with", "infection"]])
    df = spark.createDataFrame(
        [("The patient presented with fever after treatment of the infection.", "fever"),
         ("Fever is common.", "fever"),  # under 20 characters
         ("Fever appears when the browser is old and slow today.", "fever"),
         ("Search results for fever in the large clinical database.", "fever"),
         ("fever fever fever fever fever fever fever fever", "fever")],
        "s string, k string")
    got = [r[0] for r in df.select(T.score_sentence("s", "k", kws)).collect()]
    # 10 + 3 keywords*3 + 5 words + 5 end = 29 (keywords here: patient, presented with,
    # treatment, infection -> 4 hits; the original EN list has no 'infection').
    assert got[0] == 10 + 4 * 3 + 5 + 5
    assert got[1:4] == [-100, -100, -100]
    assert got[4] == 10 + 5 + 5 - 10


def test_score_with_default_keywords(spark):
    df = spark.createDataFrame(
        [("The patient presented with fever after treatment of the infection.", "fever", "en")],
        "s string, k string, lang string")
    assert df.select(T.score_sentence("s", "k", T.default_keywords("lang"))).first()[0] == 29


def test_best_sentence_ties_to_earliest(spark):
    kws = F.array().cast("array<string>")
    sents = F.array(F.lit("one two three four five six fever eight."),
                    F.lit("uno dos tres cuatro cinco seis fever ocho."),
                    F.lit("fever"))
    df = spark.range(1).select(T.best_sentence_of(sents, F.lit("fever"), kws).alias("b"))
    b = df.first()["b"]
    assert b["pos"] == 0 and b["score"] == 20


def test_python_int(spark):
    got = one(spark, T.python_int("a"), "5", " 5 ", "+5", "-0", "1_000", "x", "", "3.7", "_1")
    assert got == [5, 5, 5, 0, 1000, None, None, None, None]


def test_url_quote(spark):
    got = one(spark, T.url_quote("a"), "a b/c~*é")
    assert got == ["a%20b/c~%2A%C3%A9"]


def test_ascii_share_threshold(spark):
    got = one(spark, T.ascii_share("a") > 0.8, "abcdé", "", "abcdef")
    assert got == [False, False, True]


def test_last_word_and_queries(spark):
    df = spark.createDataFrame([("heart attack ", "en"), ("bệnh", "vi")], "t string, lang string")
    rows = df.select(T.last_word("t"), T.search_queries("t", "lang")).collect()
    assert rows[0][0] == "attack"
    assert rows[0][1] == ['"heart attack " medical', '"heart attack " disease', '"heart attack "']
    assert rows[1][1] == ['"bệnh" medical', '"bệnh" y', '"bệnh" bệnh', '"bệnh"']


def test_report_score_line(spark):
    got = one(spark, T.report_score("a"), "BLEU = 31.20 55.0/40.1", "score: 12", "nothing 1.5",
              "BLEU|version:2.4.0 = 31.20")
    assert got == [31.2, None, None, 2.4]


def test_sentences_of_clean_text_are_those_of_any_text(spark):
    texts = ["", "One. Two!  Three?\nFour", "a.b. c .d ! e", "(x) A. [y] B. C? D", " . ! ? ", ".", "no end", "end. ", None]
    df = spark.createDataFrame([(t,) for t in texts], "a string").select(T.clean_text("a").alias("c"))
    for r in df.select(T.split_sentences("c").alias("any"), T.split_clean_sentences("c").alias("clean")).collect():
        assert r["clean"] == r["any"]


def test_clean_text_runs_phrases_where_they_may_be(spark):
    """The tests before the patterns pass every text that the plain patterns change, also with letters
    that fold to a phrase's letter."""
    hits = [p for q in K.BOILERPLATE_PHRASES for p in (q, q.upper(), q.title(), q.replace("s", "\u017f"), q.replace("i", "\u0130"),
            q.replace("i", "\u0131"), q.replace("k", "\u212a"), q[:-1])]
    texts = [f"x{h}y [a] (b\nc) [d\ne] {h} \u2003 z" for h in hits] + ["a[b]c", "a(b)c", "a  b", "(searCh)", "sea[x]rch", "[(]x)", "", None]
    plain = F.coalesce(F.col("a"), F.lit(""))
    for pattern in ("(?d)" + K.BRACKET_PATTERN, K.PAREN_PATTERN, "(?iu)(" + "|".join(K.BOILERPLATE_PHRASES) + ")"):
        plain = F.regexp_replace(plain, pattern, "")
    plain = T.strip(F.regexp_replace(plain, T.JWS + "+", " "))
    df = spark.createDataFrame([(t,) for t in texts], "a string").select("a", T.clean_text("a").alias("got"), plain.alias("want"))
    assert [r for r in df.collect() if r["got"] != r["want"]] == []
    # A text without a phrase's letters in reach is not given to the phrases' pattern.
    assert one(spark, T._may_hold_boilerplate(F.col("a")), "a plain text", "his story", "My HISTORY", "hi\u017ftory") == [
        False, False, True, True]


def test_folded_letters_are_all_that_the_pattern_takes(spark):
    letters = sorted({c for p in K.BOILERPLATE_PHRASES for c in p if c.isalpha()})
    df = spark.range(128, 0x10000).where("id < 55296 or id > 57343").select(F.expr("decode(unhex(lpad(hex(id), 4, '0')), 'UTF-16BE')").alias("c"))
    for x in letters:
        got = {r["c"] for r in df.where(F.regexp_like("c", F.lit(f"(?iu)^{x}$"))).collect()}
        assert got == set(T._FOLDED.get(x, "")), x


def test_examples_split_a_sentence_once(spark):
    df = spark.createDataFrame([("One. Two. Three.",), ("One",), ("",), (None,), ("\"A! B\"",), (". . ",)], "a string")
    got = df.select(T.prepare_vi_examples("a").alias("x"))
    assert [r["x"] for r in got.collect()] == ["One\nTwo", "One\nOne", "", "", "A\nB", ".\n."]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1


def test_sentences_split_before_their_white_space_is_collapsed(spark):
    values = ["", " \n ", "A  b.\n\tC\u2003 d!e ?  F", "  x. \u00a0[1](y) . !\r\nZ ", "...  ?", "\u3000A.\x1c\x1dB\u2028c.", None]
    whole = one(spark, T.split_clean_sentences(T.clean_text("a")), *values)
    late = one(spark, F.transform(T.split_uncollapsed(T.drop_noise("a")), T.collapse), *values)
    assert late == whole


def test_strip_text(spark):
    values = ["", " ", "\u3000", "a", " a", "a\u2028", "\x1c a b \u00a0", "a b", "\u200ba\u200b", None]
    assert one(spark, T.strip_text("a"), *values) == one(spark, T.strip("a"), *values)
