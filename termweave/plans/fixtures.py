"""Derived inputs (FIXTURES.md §3) built from the driver tables with Spark.

The original pipeline reads CSV/JSON files that do not exist here; each of its inputs
is derived deterministically from the driver tables so that every query's work grows
with them.  The DuckDB oracle (``termweave.plans.oracle``) defines the same views.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termweave.functions import text as T
from termweave.operators.matching import contains_join
from termweave.operators.ordering import dense_row_number, rank_within
from termweave.operators.parallel import spread
from termweave.session import read_table, scratch_path

TERM_LANGS = ("en", "fr", "de", "es")
PAIR_LANGS = {"en": "fr", "de": "es"}  # source language -> the one that stands in for the target
LEAST_DF = 12  # documents a dictionary term is in
KEYWORD_RANKS = (51, 69)  # ranks of the 19 keywords of a language
API_TIMEOUT = "LLM API error: timeout"
SIGNATURE_LINE = "BLEU|nrefs:1|case:mixed|eff:no|tok:13a|smooth:exp|version:2.4.0 = "


class Fixtures:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._kept: dict[str, DataFrame] = {}

    def _once(self, tag: str, make, **options: str) -> DataFrame:
        """A frame that several views read, written once per query."""
        if tag not in self._kept:
            df = make()
            path = scratch_path(self.spark, tag)
            df.write.options(**options).parquet(path)
            self._kept[tag] = self.spark.read.schema(df.schema).parquet(path)
        return self._kept[tag]

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    def docs(self) -> DataFrame:
        return spread(self.table("documents").select("doc_id", "lang", "text"), "doc_id")  # a bare scan

    def pages(self) -> DataFrame:
        return spread(self.table("pages"), "page_id")

    # -- vocabulary ranking -------------------------------------------------
    def ranked_tokens(self, max_rank: int = KEYWORD_RANKS[1]) -> DataFrame:
        """(lang, term, df, rk): letter tokens of length >= 5 ranked by document
        frequency per language.  ``row_number() <= k`` is planned as a partial
        WindowGroupLimit before the shuffle, so no task sees a whole vocabulary."""
        w = Window.partitionBy("lang").orderBy(F.desc("df"), F.asc("term"))
        return (self.document_frequencies().withColumn("rk", F.row_number().over(w))
                .where(F.col("rk") <= max_rank))

    @staticmethod
    def _words() -> Column:
        """A text's different letter tokens of length >= 5: shorter runs of letters are never taken out."""
        return F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}{5,}"), F.lit(0)))

    def document_frequencies(self, docs: DataFrame | None = None) -> DataFrame:
        """(lang, term, df): letter tokens of length >= 5 and how many documents hold them."""
        def words(docs):
            return docs.where(F.col("lang").isin(*TERM_LANGS)).select("lang", self._words().alias("words"))

        def count(words):
            return (words.select("lang", F.explode("words").alias("term"))
                    .groupBy("lang", "term").agg(F.count(F.lit(1)).alias("df")))
        if docs is not None:
            return count(words(docs))
        return self._once("token-counts", lambda: count(
            self._kept["prepared"] if "prepared" in self._kept else words(self.docs())))

    def dictionary(self) -> DataFrame:
        """DICTIONARY(lang, term): tokens in at least ``LEAST_DF`` documents; it grows with the data."""
        return self.document_frequencies().where(F.col("df") >= LEAST_DF).select("lang", "term")

    def terms(self) -> DataFrame:
        """TERMS(lang, term, rk): the dictionary, ranked by document frequency in its language.
        Ranks come from a range-partitioned order, whatever the dictionary's size."""
        def rank():
            known = self.document_frequencies().where(F.col("df") >= LEAST_DF)
            return rank_within(known, "lang", [F.desc("df"), F.asc("term")], "rk").select("lang", "term", "rk")
        return self._once("terms", rank)

    def term_counts(self) -> DataFrame:
        """(lang, n_terms): a row per language."""
        return self.terms().groupBy("lang").agg(F.count(F.lit(1)).alias("n_terms"))

    def keywords(self) -> DataFrame:
        """KEYWORDS(lang, keyword): ranks 51-69 of the tokens."""
        return (self.ranked_tokens().where(F.col("rk") >= KEYWORD_RANKS[0])
                .select("lang", F.col("term").alias("keyword")))

    # -- prompting inputs ---------------------------------------------------
    def pairs(self) -> DataFrame:
        """PAIRS(src_lang, tgt_lang, term_id, en_term, vi_term): terms of equal rank in the two
        languages of each direction."""
        t = self.terms()
        to = F.create_map(*[F.lit(x) for kv in PAIR_LANGS.items() for x in kv])
        src = t.where(F.col("lang").isin(*PAIR_LANGS)).select(
            F.col("lang").alias("src_lang"), to[F.col("lang")].alias("tgt_lang"), F.col("rk").alias("term_id"),
            F.col("term").alias("en_term"))
        tgt = t.select(F.col("lang").alias("tgt_lang"), F.col("rk").alias("term_id"), F.col("term").alias("vi_term"))
        return src.join(tgt, ["tgt_lang", "term_id"])

    def prepared(self) -> DataFrame:
        """(doc_id, lang, words, en_term, en_s, tgt_clean): what rows and the counts of tokens take from a
        document's text, in one pass over the documents.  Source documents have ``en_term``, their letter
        token whose hash with the id is least, and ``en_s``, their first sentence with it, or else their first
        one; target documents have their cleaned text."""
        def make():
            source = F.col("lang").isin(*PAIR_LANGS)
            prefix = F.concat(F.col("doc_id").cast("string"), F.lit(":"))

            # A hash has 32 characters, so hashes with their tokens behind them have the order of the hashes.
            def least(prefix):
                return F.array_min(F.transform("words", lambda t: F.concat(F.md5(F.concat(prefix, t)), t)))

            x = self.docs().where(F.col("lang").isin(*TERM_LANGS)).select(
                "doc_id", "lang", self._words().alias("words"), T.drop_noise("text").alias("t"))
            # Of a source text one sentence is needed: it alone has its white space collapsed.
            x = x.select("doc_id", "lang", "words", F.when(source, T._let(prefix, least)).alias("h"),
                         F.when(source, T.split_uncollapsed("t")).alias("sents"),
                         F.when(~source, T.collapse("t")).alias("tgt_clean"))
            x = x.select("doc_id", "lang", "words", F.substring("h", F.lit(33), F.length("h")).alias("en_term"), "sents",
                         "tgt_clean")
            first_hit = T._let(F.lower("en_term"), lambda term: F.get(
                F.filter("sents", lambda s: F.contains(F.lower(s), term)), 0))
            return x.select("doc_id", "lang", "words", "en_term",
                            T.collapse(F.coalesce(first_hit, F.get("sents", 0), F.lit(""))).alias("en_s"), "tgt_clean")
        # Texts and lists of different words hardly repeat inside a page: dictionaries cost time only.
        return self._once("prepared", make, **{"parquet.enable.dictionary": "false", "compression": "zstd"})

    def _row_keys(self) -> DataFrame:
        """(doc_id, row_no, en_term, en_s, vi_term, tgt_id): ROWS without their target texts.  Ids are
        numbered without their texts."""
        to = F.create_map(*[F.lit(x) for kv in PAIR_LANGS.items() for x in kv])
        prepared = self.prepared()
        ids = prepared.select("doc_id", "lang")
        src = dense_row_number(ids.where(F.col("lang").isin(*PAIR_LANGS)), "doc_id", "row_no", start=1)
        tgt = None
        for lang in PAIR_LANGS.values():
            one = dense_row_number(ids.where(F.col("lang") == lang), "doc_id", "tgt_no", start=0)
            tgt = one if tgt is None else tgt.unionByName(one)
        tgt = tgt.select(F.col("lang").alias("tgt_lang"), "tgt_no", F.col("doc_id").alias("tgt_id"))
        # Two rows: a row per direction.
        n_tgt = F.broadcast(tgt.groupBy("tgt_lang").agg(F.count(F.lit(1)).alias("n_tgt")))
        return (src.select("doc_id", "row_no", F.col("lang").alias("src_lang"), to[F.col("lang")].alias("tgt_lang"))
                .join(n_tgt, "tgt_lang", "left")
                .withColumn("tgt_no", F.col("row_no") % F.col("n_tgt"))
                .join(prepared.where(F.col("lang").isin(*PAIR_LANGS)).select("doc_id", "en_term", "en_s"), "doc_id")
                .join(self.pairs().select("src_lang", "en_term", "vi_term"), ["src_lang", "en_term"], "left")
                .join(tgt, ["tgt_lang", "tgt_no"], "left")
                .select("doc_id", "row_no", "en_term", "en_s", "vi_term", "tgt_id"))

    def rows(self) -> DataFrame:
        """ROWS: prompt-input rows, one per EN or DE document (see FIXTURES.md §3), its term a token
        of its own (some spelled backwards); a token that no pair of terms has comes without a
        translation.  Rows without target texts are written once, as their numbers are summed over them
        again; a target text is cleaned once, however many rows have it."""
        d = F.col("doc_id")
        targets = self.prepared().where(F.col("lang").isin(*PAIR_LANGS.values())).select(
            F.col("doc_id").alias("tgt_id"), "tgt_clean")
        x = self._once("row-keys", self._row_keys).join(targets, "tgt_id", "left")
        en_s = F.col("en_s")
        vi_s = F.when(F.col("tgt_id").isNull(), F.lit("")).otherwise(F.col("tgt_clean"))
        return x.select(
            "row_no",
            F.when(d % 4 == 0, F.lit("")).when(d % 4 == 1, F.lit("x"))
            .when(d % 4 == 2, d.cast("string"))
            .otherwise(F.concat(F.lit("  "), d.cast("string"), F.lit(" "))).alias("index"),
            F.when(d % 17 == 0, F.lit("")).when(d % 7 == 3, F.reverse("en_term")).otherwise(F.col("en_term")).alias("English"),
            F.when(d % 19 == 0, F.lit("  ")).otherwise(F.col("vi_term")).alias("Vietnamese"),
            F.when(d % 5 == 0, F.concat(F.lit('"'), en_s, F.lit('"'))).otherwise(en_s)
            .alias("English Sentence"),
            F.when(d % 23 == 0, F.lit("")).otherwise(vi_s).alias("Vietnamese Sentence"),
        )

    def attempts(self, validated: DataFrame) -> DataFrame:
        """ATTEMPTS(row_no, attempt, raw_response, error) for accepted rows, six
        behaviours by ``row_no % 6`` (FIXTURES.md §3)."""
        a = validated.where(F.col("reason").isNull())
        idx = F.col("index").cast("string")
        valid = F.concat(idx, F.lit(" | "), F.col("en_sentence"), F.lit(" | "), F.col("vi_term"),
                         F.lit(" "), F.col("vi_sentence"))
        noterm = F.concat(idx, F.lit(" | "), F.col("en_sentence"), F.lit(" | "), F.col("vi_sentence"))
        two = F.concat(idx, F.lit(" | "), F.col("en_sentence"))
        nonint = F.concat(F.lit("x | "), F.col("en_sentence"), F.lit(" | "), F.col("vi_term"),
                          F.lit(" "), F.col("vi_sentence"))
        ok, err = F.lit("success"), F.lit(API_TIMEOUT)
        none = F.lit(None).cast("string")

        def att(*items):
            return F.array(*[F.struct(r.alias("raw_response"), e.alias("error")) for r, e in items])

        case = F.col("row_no") % 6
        arr = (F.when(case == 0, att((valid, ok), (noterm, ok)))
               .when(case == 1, att((noterm, ok), (valid, ok)))
               .when(case == 2, att((noterm, ok), (noterm, ok), (noterm, ok)))
               .when(case == 3, att((none, err), (none, err), (valid, ok)))
               .when(case == 4, att((two, ok), (two, ok), (F.lit(""), ok)))
               .otherwise(att((nonint, ok), (nonint, ok), (none, err))))
        return (a.select("row_no", F.posexplode(arr).alias("attempt", "a"))
                .select("row_no", "attempt", "a.raw_response", "a.error"))

    # -- evaluation inputs ----------------------------------------------------
    def refs(self) -> DataFrame:
        """REFS(line_no, text): benchmark items, newline -> space."""
        return self.table("benchmark").select(F.col("item_id").alias("line_no"),
                                              F.replace("text", F.lit("\n"), F.lit(" ")).alias("text"))

    def preds(self) -> DataFrame:
        """PREDS(system, line_no, text): REFS without every 5th (baseline) / 9th (tuned)
        space-separated word."""
        r = self.refs()

        def drop_every(k):
            return F.array_join(F.filter(F.split("text", " ", -1), lambda w, i: (i + 1) % k != 0), " ")

        return (r.select(F.lit("baseline").alias("system"), "line_no", drop_every(5).alias("text"))
                .unionByName(r.select(F.lit("tuned").alias("system"), "line_no",
                                      drop_every(9).alias("text"))))

    def reports(self, scores: DataFrame) -> DataFrame:
        """REPORTS(system, line_no, text) rendered from computed BLEU statistics."""
        dec2 = F.col("bleu").cast("decimal(10,2)").cast("string")
        base = F.col("system") == "baseline"
        l1 = F.when(base, F.concat(F.lit("score: "), F.col("sys_len").cast("string"))) \
            .otherwise(F.lit("chrF not computed"))
        l2 = F.when(base, F.concat(F.lit("BLEU = "), dec2, F.lit(" (hyp_len = "),
                                   F.col("sys_len").cast("string"), F.lit(" ref_len = "),
                                   F.col("ref_len").cast("string"), F.lit(")"))) \
            .otherwise(F.concat(F.lit(SIGNATURE_LINE), dec2))
        return scores.select("system", F.inline(F.array(
            F.struct(F.lit(1).alias("line_no"), l1.alias("text")),
            F.struct(F.lit(2).alias("line_no"), l2.alias("text")))))

    def term_map(self) -> DataFrame:
        """Source -> target term map for monolingual scoring: EN terms to themselves."""
        return (self.terms().where(F.col("lang") == "en")
                .select(F.col("term").alias("src_term"), F.col("term").alias("tgt_term")))

    def lexicon(self) -> DataFrame:
        """LEXICON(src, tgt): EN term -> FR term of equal rank."""
        return self.pairs().where(F.col("src_lang") == "en").select(
            F.col("en_term").alias("src"), F.col("vi_term").alias("tgt"))

    # -- enrichment inputs ----------------------------------------------------
    def _dealt(self, rows: DataFrame, id_col: str) -> DataFrame:
        """``rows`` (with ``lang``) dealt over all terms of their language by their id."""
        n = F.broadcast(self.term_counts())  # a row per language
        return (rows.join(n, "lang").withColumn("rk", F.col(id_col) % F.col("n_terms") + 1)
                .join(self.terms(), ["lang", "rk"])
                .withColumn("query_rank", (F.lit(1) + F.floor(F.col(id_col) / 50) % 3).cast("int"))
                .withColumn("result_rank", F.col(id_col) + 1))  # unique, however few the terms

    def hits(self) -> DataFrame:
        """HITS(term, lang, query_rank, result_rank, url, body): the documents of a language dealt
        over its terms, three queries, every document kept; ``result_rank = doc_id + 1``
        orders results and need not be dense (the operators take their own top-k by it)."""
        url = F.concat(F.lit("http://example.org/"), F.col("doc_id").cast("string"),
                       F.when(F.col("doc_id") % 7 == 0, F.lit(".pdf")).otherwise(F.lit("")))
        return self._dealt(self.docs(), "doc_id").select(
            "term", "lang", "query_rank", "result_rank", url.alias("url"), F.col("text").alias("body"))

    def abstracts(self) -> DataFrame:
        """ABSTRACTS(term, url, body): per EN term the lowest benchmark item containing
        it (case-insensitive)."""
        t = self.terms().where(F.col("lang") == "en").select("term")
        b = self.table("benchmark").select("item_id", "text")
        pairs = contains_join(b.select("item_id", "text", F.lower("text").alias("text_l"),
                                       F.lit("en").alias("lang")),
                              t.withColumn("lang", F.lit("en")), "text_l", "term", on=["lang"], ids=["item_id"])
        m = (pairs.groupBy("term").agg(F.min_by(F.struct("item_id", "text"), "item_id").alias("a")))
        return m.select("term", F.concat(F.lit("http://abstracts.example.org/"),
                                         F.col("a.item_id").cast("string")).alias("url"),
                        F.col("a.text").alias("body"))

    def enrichment_input(self) -> DataFrame:
        """ENRICHED: the enrichment table with existing values by rank % 5."""
        p = self.pairs()

        def existing(r):
            return (F.when(r % 5 == 0, F.lit("PENDING")).when(r % 5 == 1, F.lit("UNOBSERVED"))
                    .when(r % 5 == 2, F.lit(None).cast("string")).when(r % 5 == 3, F.lit("short"))
                    .otherwise(F.concat(F.lit("kept example "), F.lpad(r.cast("string"), 7, "0"))))

        r = F.col("term_id")
        url = F.concat(F.lit("http://kept.example.org/"), r.cast("string"))
        row_no = 2 * r.cast("bigint") + (F.col("src_lang") == "de").cast("int")
        return p.select(
            row_no.alias("row_no"), "src_lang", "tgt_lang", F.col("en_term").alias("English"),
            F.when(r % 13 == 0, F.lit(" ")).otherwise(F.col("vi_term")).alias("Vietnamese"),
            existing(r).alias("English example"), existing(r + 2).alias("Vietnamese example"),
            url.alias("English source URL"), url.alias("Vietnamese source URL"))

    # -- question answering inputs --------------------------------------------
    def questions(self) -> DataFrame:
        """QUESTIONS(id, question, options, question_type) per benchmark item."""
        b = self.table("benchmark").select("item_id", "text")
        t = self.terms().where(F.col("lang") == "en").select("rk", "term")
        n_terms = t.select(F.count(F.lit(1))).scalar()
        letters = F.array(*[F.lit(x) for x in "ABCD"])
        opts = (b.select("item_id", F.posexplode(letters).alias("k", "letter"))
                .withColumn("rk", (F.lit(4) * F.col("item_id") + F.col("k")) % n_terms + 1)
                .join(t, "rk")
                .groupBy("item_id").agg(F.map_from_entries(F.transform(
                    F.sort_array(F.collect_list(F.struct("letter", "term"))),
                    lambda e: F.struct(e["letter"], e["term"]))).alias("options")))
        types = F.array(*[F.lit(x) for x in
                          ("multi_choice", "open_ended_multi_choice", "open_ended", "other")])
        words = F.filter(F.split("text", T.JWS + "+", -1), lambda x: x != F.lit(""))
        return b.join(opts, "item_id", "left").select(
            F.concat(F.lit("q"), F.col("item_id").cast("string")).alias("id"),
            F.array_join(words, " ").alias("question"),
            "options",
            F.element_at(types, (F.col("item_id") % 4 + 1).cast("int")).alias("question_type"))

    def answers_raw(self) -> DataFrame:
        """ANSWERS_RAW(id, response): six response shapes by ``item_id % 6``."""
        q = self.questions().withColumn("item_id", F.substring("id", 2, 20).cast("bigint"))
        letter = F.element_at(F.array(*[F.lit(x) for x in "ABCD"]), (F.col("item_id") % 4 + 1).cast("int"))
        reason = F.concat(F.lit("Evidence supports "), F.coalesce(F.element_at("options", F.lit("A")), F.lit("")))
        c = F.col("item_id") % 7
        resp = (F.when(c == 6, F.lit(None).cast("string")).when(c == 0, F.concat(F.lit('{"selected_option": "'), letter, F.lit('", "reasoning": "'),
                                        reason, F.lit('"}')))
                .when(c == 1, F.concat(F.lit('{"reasoning": "'), reason, F.lit('"}')))
                .when(c == 2, reason)
                .when(c == 3, F.concat(F.lit('{"selected_option": null, "reasoning": "'), reason, F.lit('"}')))
                .when(c == 4, F.lit("[1]"))
                .otherwise(F.concat(F.lit('```json\n{"selected_option": "'), letter, F.lit('"}\n```'))))
        return q.select("id", resp.alias("response"))

    def snippets(self) -> DataFrame:
        """Search snippets: the hits of all queries with their whole cleaned body, ordered by
        result and then query."""
        return self.hits().select("term", "lang", (3 * F.col("result_rank") + F.col("query_rank")).alias("result_rank"),
                                  "url", T.clean_text("body").alias("body"))

    def provider_hits(self) -> DataFrame:
        """PROVIDER_HITS(term, lang, provider, result_rank, title, body): HITS as answers of
        three providers (its queries); some terms have none of the first, or of the first two."""
        h = self.hits().withColumn("provider", F.col("query_rank"))
        none = F.length("term") % 3
        return (h.where(F.col("provider") > none)
                .select("term", "lang", "provider", "result_rank", F.col("url").alias("title"), "body"))

    def page_hits(self) -> DataFrame:
        """PAGE_HITS(term, lang, query_rank, result_rank, url): result links that point at
        the driver's ``pages`` (language from the URL path, dealt over its terms)."""
        p = self.table("pages").select("page_id", "url").withColumn(
            "lang", F.regexp_extract("url", "/(en|fr|de|es)/", 1))
        return self._dealt(p, "page_id").select("term", "lang", "query_rank", "result_rank", "url")
