"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Column names and types match the oracle SQL in ``termweave.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termweave.functions import text as T
from termweave.functions import constants as K
from termweave.operators import alignment, answering, corpus, evaluation, generation, mining, ordering, prompting, retrieval
from termweave.operators.ordering import dense_row_number
from termweave.session import scratch_path
from termweave.sources import io
from termweave.streaming import incremental
from termweave.plans.fixtures import LEAST_DF, Fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def best_sentence(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixtures(spark, sf_dir)
    return mining.best_sentences(fx.docs(), fx.terms(), fx.keywords())


@query
def sentence_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixtures(spark, sf_dir)
    return mining.sentence_scores(fx.docs(), fx.terms(), fx.keywords())


@query
def best_sentence_anchor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-6 over a dictionary that grows with the data: the anchor-gram plan of JOIN-1."""
    fx = Fixtures(spark, sf_dir)
    return mining.best_sentences(fx.docs(), fx.dictionary(), fx.keywords(), strategy="anchor").select(
        "doc_id", "lang", "term", "pos", "score")


@query
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixtures(spark, sf_dir)
    return fx.docs().select("doc_id", T.clean_text("text").alias("clean"))


@query
def split_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixtures(spark, sf_dir)
    return (mining.sentences(fx.docs())
            .select("doc_id", "pos", "sentence", T.word_count("sentence").alias("n_words")))


# -- prompting -----------------------------------------------------------------

def written(df: DataFrame, tag: str) -> DataFrame:
    """A frame that several branches read, written once to the shared folder."""
    path = scratch_path(df.sparkSession, tag)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _validated(fx: Fixtures) -> DataFrame:
    """Rows with their reasons; of the sentences the cleaned ones, which all that follows reads."""
    v = prompting.validation_reason(prompting.assign_index(fx.rows()))
    return written(v.drop(prompting.EN_S, prompting.VI_S), "validated")


def _resolved(fx: Fixtures):
    v = _validated(fx)
    acc = prompting.accepted(v)
    return v, acc, written(prompting.resolve_attempts(acc, fx.attempts(v)), "resolved")


@query
def clean_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = Fixtures(spark, sf_dir).rows()
    return r.select("row_no", T.clean_sentence("English Sentence").alias("en_clean"),
                    T.clean_sentence("Vietnamese Sentence").alias("vi_clean"))


@query
def auto_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prompting.assign_index(Fixtures(spark, sf_dir).rows()).select("row_no", "index", "is_auto")


@query
def validate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validated(Fixtures(spark, sf_dir)).select("row_no", "index", "reason")


@query
def vi_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    acc = prompting.accepted(_validated(Fixtures(spark, sf_dir)))
    return acc.select("row_no", "vi_examples")


@query
def prompt_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    acc = prompting.accepted(_validated(Fixtures(spark, sf_dir)))
    return prompting.prompts(acc)


@query
def parse_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixtures(spark, sf_dir)
    att = prompting.parse_attempts(fx.attempts(_validated(fx)))
    return att.select("row_no", "attempt", "parsed_index", "en_echo", "vi_gen", "parsed")


@query
def resolve_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, res = _resolved(Fixtures(spark, sf_dir))
    return prompting.prompt_log(res)


@query
def synthetic_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, res = _resolved(Fixtures(spark, sf_dir))
    return prompting.results(res)


@query
def reject_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, _, res = _resolved(Fixtures(spark, sf_dir))
    return prompting.reject_table(v, res)


@query
def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, _, res = _resolved(Fixtures(spark, sf_dir))
    return prompting.reject_counts(prompting.reject_table(v, res))


@query
def run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, _, res = _resolved(Fixtures(spark, sf_dir))
    return prompting.run_counts(v, res)


# -- evaluation ----------------------------------------------------------------

def _scores(fx: Fixtures) -> DataFrame:
    return evaluation.corpus_bleu(fx.refs(), fx.preds())


@query
def corpus_bleu(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _scores(Fixtures(spark, sf_dir))
    return s.select("system", F.round("bleu", 6).alias("bleu"), "sys_len", "ref_len",
                    "c1", "c2", "c3", "c4", "t1", "t2", "t3", "t4")


@query
def bleu_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = evaluation.bleu_delta(_scores(Fixtures(spark, sf_dir)))
    return d.select(F.round("baseline_bleu", 6).alias("baseline_bleu"),
                    F.round("tuned_bleu", 6).alias("tuned_bleu"),
                    F.round("delta", 6).alias("delta"), "verdict")


@query
def term_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixtures(spark, sf_dir)
    t = evaluation.term_accuracy(fx.refs(), fx.preds(), fx.term_map())
    return t.select("system", "n_pairs", "n_hits", F.round("term_accuracy", 6).alias("term_accuracy"))


@query
def report_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixtures(spark, sf_dir)
    return evaluation.report_scores(fx.reports(_scores(fx)))


@query
def evaluation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-9: the report of the run, written as JSON and read again."""
    path = scratch_path(spark, "report")
    io.write_json_config(evaluation.evaluation_report(_scores(Fixtures(spark, sf_dir))), path)
    r = io.read_jsonl(spark, path, "system string, bleu double, delta double, sys_len bigint, ref_len bigint")
    return r.select("system", F.round("bleu", 6).alias("bleu"), F.round("delta", 6).alias("delta"), "sys_len", "ref_len")


@query
def zip_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixtures(spark, sf_dir)
    return corpus.zip_lines(fx.refs(), fx.preds().where(F.col("system") == "baseline"))


# -- corpus --------------------------------------------------------------------

@query
def pair_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixtures(spark, sf_dir)
    v, acc, res = _resolved(fx)
    return corpus.pair_corpus(prompting.results(res), keep=acc)


@query
def train_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixtures(spark, sf_dir)
    v, acc, res = _resolved(fx)
    pairs = corpus.pair_corpus(prompting.results(res), keep=acc)
    return corpus.train_config(pairs, "base-model", "checkpoints/ft_model")


@query
def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.vocabulary(Fixtures(spark, sf_dir).docs())


@query
def encode_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = Fixtures(spark, sf_dir).docs()
    return corpus.encode_fixed(docs, corpus.vocabulary(docs), "doc_id")


@query
def encode_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UDF-4: input ids and labels of the pair corpus, over the vocabulary of both sides."""
    fx = Fixtures(spark, sf_dir)
    _, acc, res = _resolved(fx)
    pairs = written(corpus.pair_corpus(prompting.results(res), keep=acc), "pairs")
    both = pairs.select(F.col("src").alias("text")).unionByName(pairs.select(F.col("tgt").alias("text")))
    return corpus.encode_pairs(pairs, corpus.vocabulary(both))


@query
def line_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-4/5, SRC-3, JOIN-2: aligned line files of many parts, written, read and zipped;
    some lines are blank on either side."""
    d = dense_row_number(Fixtures(spark, sf_dir).docs(), "doc_id", "row_no", start=0)
    one_line = F.regexp_replace("text", "[\\r\\n]", " ")
    pairs = d.select("row_no", F.when(F.col("doc_id") % 11 == 0, F.lit(" ")).otherwise(one_line).alias("src"),
                     F.when(F.col("doc_id") % 13 == 0, F.lit("")).otherwise(
                         F.concat_ws(" ", F.col("lang"), F.col("doc_id").cast("string"))).alias("tgt"))
    src, tgt = io.write_pair_files(pairs, scratch_path(spark, "lines"), partitions=8)
    return corpus.zip_lines(io.read_lines(spark, src), io.read_lines(spark, tgt))


@query
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-1/2, SNK-1/2: documents written as CSV files with quoted newlines, read by splits; a source
    spelled as a missing-value token is null where the file is read as pandas does."""
    docs = Fixtures(spark, sf_dir).table("documents")
    source = F.when(F.col("doc_id") % 9 == 0, F.lit("NA")).when(F.col("doc_id") % 9 == 1, F.lit(" NA ")).otherwise(F.col("source"))
    rows = docs.select("doc_id", "lang", source.alias("source"), F.concat(F.lit('"'), "lang", F.lit('", "')).alias("quoted"), "text")
    path = scratch_path(spark, "csv")
    io.write_csv(rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id"), path)
    every = io.read_csv_rows(spark, path, ["doc_id", "lang", "source", "quoted", "text"], splits=True)
    missing = io.read_csv_pandas(spark, path, ["source"], splits=True)
    return every.join(missing.select("row_no", F.col("source").isNull().alias("no_source")), "row_no").select(
        "row_no", F.col("doc_id").cast("bigint").alias("doc_id"), "lang", "source", "quoted", "text", "no_source")


@query
def json_lines_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-4, SNK-3, SCA-16: a log of records as JSON lines, nulls and letters of all alphabets kept;
    lines torn off by an ended writer are rows without fields, not an error."""
    docs = Fixtures(spark, sf_dir).table("documents")
    log = docs.select("doc_id", "lang", F.when(F.col("doc_id") % 5 > 0, F.col("source")).alias("note"), "text")
    whole, torn = scratch_path(spark, "jsonl"), scratch_path(spark, "jsonl-torn")
    io.write_jsonl(log, whole)
    line = T.json_line("doc_id", "lang", "note", "text")
    log.where(F.col("doc_id") % 10 == 0).select(F.substring(line, F.lit(1), F.length(line) - 1)).write.text(torn)
    schema = "doc_id bigint, lang string, note string, text string"
    read = io.read_jsonl(spark, whole, schema).unionByName(io.read_jsonl(spark, torn, schema))
    bad = F.col("_corrupt_record")
    return read.select("doc_id", "lang", "note", "text", bad.isNotNull().alias("torn"),
                       F.regexp_extract(bad, r'^\{"doc_id":([0-9]+),', 1).alias("torn_id"))


@query
def translate_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UDF-2 with a stand-in translator over all documents."""
    docs = Fixtures(spark, sf_dir).docs().select(F.col("doc_id").alias("line_no"), "text")
    return corpus.translate_batches(docs, lambda batch: [f"{len(x)}:{x}" for x in batch])


@query
def lexicon_translate(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixtures(spark, sf_dir)
    return corpus.lexicon_translate(fx.refs(), fx.lexicon())


def _aligned(fx: Fixtures) -> DataFrame:
    _, acc, res = _resolved(fx)
    return alignment.lexicon(alignment.align(corpus.pair_corpus(prompting.results(res), keep=acc), likeliest=True))


@query
def align_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UDF-2's lexicon learnt from the pair corpus: likeliest target word of every source word after
    a fixed number of rounds of word alignment."""
    return _aligned(Fixtures(spark, sf_dir))


@query
def aligned_translate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UDF-2: the evaluation lines translated word by word with the aligned lexicon."""
    fx = Fixtures(spark, sf_dir)
    return corpus.lexicon_translate(fx.refs(), _aligned(fx).select("src", "tgt"))


# -- web pages, search and enrichment ---------------------------------------------

@query
def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mining.page_text(Fixtures(spark, sf_dir).pages()).select("page_id", "text")


@query
def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixtures(spark, sf_dir)
    urls = (fx.hits().select("url").unionByName(fx.pages().select("url")))
    return urls.select("url", mining.url_path("url").alias("path"),
                       mining.url_usable("url").alias("usable"))


def _langs() -> dict:
    return {"en": F.col("src_lang"), "vi": F.col("tgt_lang")}


def _enrich(fx: Fixtures) -> DataFrame:
    return mining.enrich(fx.enrichment_input(), fx.hits(), fx.abstracts(), fx.keywords(),
                         lang_map=_langs())


@query
def enrich_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enrich(Fixtures(spark, sf_dir))


@query
def enrich_from_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOIN-3: search links joined to the pages table by URL, page HTML to text, then the
    enrichment chain."""
    fx = Fixtures(spark, sf_dir)
    hits = mining.hits_with_pages(fx.page_hits(), fx.pages())
    return mining.enrich(fx.enrichment_input(), hits, fx.abstracts(), fx.keywords(),
                         lang_map=_langs())


@query
def enriched_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixtures(spark, sf_dir)
    t = mining.enriched_table(fx.enrichment_input(), _enrich(fx))
    return t.select("row_no", "English", "Vietnamese",
                    F.col("English example").alias("en_example"),
                    F.col("English source URL").alias("en_source_url"),
                    F.col("Vietnamese example").alias("vi_example"),
                    F.col("Vietnamese source URL").alias("vi_source_url"))


@query
def resume_work_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixtures(spark, sf_dir)
    items = mining.work_items(fx.enrichment_input(), lang_map=_langs())
    done = items.where(F.col("state") == "done").select("row_no", "side")
    # JOIN-7: only rows without a finished value are (re)processed.
    return (items.where(F.col("state") != "blank")
            .join(done, ["row_no", "side"], "left_anti")
            .select("row_no", "side", "lang", "term"))


@query
def prompt_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-1 / PRJ-5: a table that lacks the columns of one side, completed and handed on as rows to prompt."""
    bare = Fixtures(spark, sf_dir).enrichment_input().drop("Vietnamese example", "Vietnamese source URL")
    full = mining.add_missing_columns(bare)
    p = mining.to_prompt_input(full).join(full.select("row_no", F.col("Vietnamese example").alias("state")), "row_no")
    return p.select("row_no", "index", "English", "Vietnamese", F.col("English Sentence").alias("en_sentence"),
                    F.col("Vietnamese Sentence").alias("vi_sentence"), "state")


@query
def search_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Fixtures(spark, sf_dir).terms()
    return t.select("lang", "term", F.posexplode(T.search_queries("term", "lang")).alias("q", "query"),
                    T.url_quote("term").alias("quoted_term")).select(
        "lang", "term", (F.col("q") + 1).alias("query_rank"), "query", "quoted_term")


# -- evidence and answers -------------------------------------------------------------

def _evidence(fx: Fixtures) -> DataFrame:
    return answering.ascii_evidence(fx.snippets(), ["term", "lang"])


def _option_hits(fx: Fixtures, questions: DataFrame) -> DataFrame:
    """(id, opt_key, rank, doc, score): the documents found for each option's search text,
    ``option question``."""
    index = retrieval.postings(fx.docs())
    return written(retrieval.search(index, answering.option_rows(questions), ["id", "opt_key"], K.SNIPPETS_PER_QUERY),
                   "option-hits")


def _option_evidence(fx: Fixtures, questions: DataFrame) -> DataFrame:
    """(id, opt_key, evidence): what the search finds for each option, texts fetched for the hits alone."""
    hits = _option_hits(fx, questions)
    bodies = fx.docs().select(F.col("doc_id").alias("doc"), "text").join(hits.select("doc").distinct(), "doc", "left_semi")
    found = hits.join(bodies.select("doc", T.clean_text("text").alias("body")), "doc")
    return answering.ascii_evidence(found.withColumnRenamed("rank", "result_rank"), ["id", "opt_key"])


@query
def search_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-6 / SCA-19: ranked retrieval over all documents for every question's options."""
    fx = Fixtures(spark, sf_dir)
    return _option_hits(fx, fx.questions())


@query
def top_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = answering.top_hits(Fixtures(spark, sf_dir).hits(), ["term", "lang"], K.SNIPPETS_PER_QUERY)
    return h.select("term", "lang", "query_rank", "result_rank", "url")


@query
def ascii_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _evidence(Fixtures(spark, sf_dir))


@query
def provider_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The provider chain per search: five of the first, else three of the second, else three
    of the third in English, else a fixed text."""
    fx = Fixtures(spark, sf_dir)
    return answering.provider_evidence(fx.terms(), fx.provider_hits(), ["term", "lang"])


@query
def evidence_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixtures(spark, sf_dir)
    q = fx.questions()
    return answering.evidence_map(q, _option_evidence(fx, q)).select("id", "evidence_text")


@query
def answer_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixtures(spark, sf_dir)
    q = fx.questions()
    m = answering.evidence_map(q, _option_evidence(fx, q))
    j = q.join(m, "id", "left")
    p = answering.answer_prompt(F.col("question"), F.col("options"), F.col("evidence_text"),
                                F.col("question_type"))
    return j.select("id", p.alias("prompt")).where(F.col("prompt").isNotNull())


def _stand_in_answers(prompts):
    """Answers of a stand-in model: JSON for most prompts, free text, or a failed call."""
    def one(n: int):
        if n % 7 == 0:
            return None, K.API_ERROR_PREFIX + "busy"
        return (f"free text {n}" if n % 7 == 1 else f'{{"selected_option": "B", "reasoning": "{n} characters"}}'), "success"

    return [one(len(p)) for p in prompts]


@query
def answer_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UDF-3: every question through evidence, prompt, batch generator (a stand-in) and strict parsing."""
    fx = Fixtures(spark, sf_dir)
    q = fx.questions()
    answered, _ = answering.answer_questions(q, _option_evidence(fx, q), _stand_in_answers, K.QUESTION_BATCH_SIZE)
    return answering.answers_csv(answered)


@query
def parse_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = Fixtures(spark, sf_dir).answers_raw()
    p = answering.parse_response("response")
    return r.select("id", p["valid"].alias("valid"), p["is_object"].alias("is_object"),
                    F.when(p["is_object"], p["selected_option"]).alias("selected_option"),
                    F.when(p["is_object"], p["reasoning"]).alias("reasoning"))


@query
def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixtures(spark, sf_dir)
    a, _ = answering.assemble_answers(fx.questions(), fx.answers_raw())
    return answering.answers_csv(a)


@query
def answer_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixtures(spark, sf_dir)
    return answering.assemble_answers(fx.questions(), fx.answers_raw())[1]


# -- incremental runs, batching and slices ---------------------------------------------

@query
def incremental_mine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-1: the flagship mined incrementally from the documents file as a stream;
    equal to ``best_sentence``."""
    fx = Fixtures(spark, sf_dir)
    sink, ckpt = incremental.scratch_paths(spark, "incremental_mine")
    incremental.incremental_best_sentences(spark, sf_dir, fx.terms(), fx.keywords(), sink, ckpt,
                                           glob="documents.parquet")
    return spark.read.parquet(sink).drop("epoch")


@query
def incremental_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-1 / SNK-10 / JOIN-7: documents arrive in two parts and the dictionary grows with them; each
    run mines what is new on either side.  Equal to ``best_sentence``."""
    fx = Fixtures(spark, sf_dir)
    state = scratch_path(spark, "delta")
    docs, keywords = fx.docs(), written(fx.keywords(), "keywords")
    first = docs.where(F.crc32(F.col("doc_id").cast("string")) % 2 == 0)
    counts = fx.document_frequencies(first)
    incremental.mine_increment(spark, first, counts.where(F.col("df") >= LEAST_DF), keywords, state)
    incremental.mine_increment(spark, docs, fx.terms(), keywords, state)
    return incremental.mined(spark, state)


@query
def append_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-2 / SNK-6 / SET-2: documents as JSON files, read by a stream a few files at a time and
    appended an epoch at a time.  A further folder without a commit record, as an ended run leaves it,
    is not read: every document is there once."""
    docs = Fixtures(spark, sf_dir).docs()
    source, (sink, ckpt) = scratch_path(spark, "json"), incremental.scratch_paths(spark, "append")
    docs.select("doc_id", "lang", "text").write.json(source)

    def fn(df: DataFrame) -> DataFrame:
        return df.select("doc_id", "lang", F.length("text").alias("n_chars"), T.clean_text("text").alias("clean"))

    incremental.append_batches(spark, source, "doc_id bigint, lang string, text string", fn, sink, ckpt,
                               max_files_per_trigger=4)
    fn(docs).write.json(incremental.epoch_path(sink, 1 << 20))  # halfway: no commit record
    return incremental.read_committed(spark, sink, "doc_id bigint, lang string, n_chars int, clean string", "json")


@query
def slice_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LIM-1..3 as flags over every document in file (doc_id) order: head of 100,
    slice [100, 300), and everything after skipping 50."""
    d = dense_row_number(Fixtures(spark, sf_dir).docs().select("doc_id"), "doc_id", "row_no", start=0)

    def flag(part, name):
        return part.select("doc_id", F.lit(True).alias(name))

    flags = [flag(ordering.first_rows(d, "doc_id", 100), "in_head"),
             flag(ordering.slice_rows(d, "row_no", 100, 300), "in_slice"),
             flag(ordering.slice_rows(d, "row_no", 50), "after_skip")]
    for f in flags:
        d = d.join(f, "doc_id", "left")
    return d.select("doc_id", "row_no", *[F.coalesce(c, F.lit(False)).alias(c)
                                          for c in ("in_head", "in_slice", "after_skip")])


@query
def batch_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-5: question batches of 5 and translation batches of 8 over documents."""
    d = dense_row_number(Fixtures(spark, sf_dir).docs().select("doc_id"), "doc_id", "row_no", start=0)
    d = incremental.batch_ids(d, "row_no", K.QUESTION_BATCH_SIZE, "q_batch")
    return incremental.batch_ids(d, "row_no", K.TRANSLATE_BATCH_SIZE, "t_batch")


@query
def append_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-6, STR-2, SET-2: document files processed a few at a time by a stream, each batch's rows in
    an epoch of their own.  Files come in two lots, the second run goes on where the first ended.  Then
    a writer dies in the middle of an epoch: its rows lie in the folder, but readers, who go by the
    commit records, don't see them."""
    docs = Fixtures(spark, sf_dir).table("documents").select("doc_id", "lang", "text")
    source, schema = scratch_path(spark, "append-in"), "doc_id bigint, lang string, text string"
    sink, log = incremental.scratch_paths(spark, "append")

    def counted(batch: DataFrame) -> DataFrame:
        return batch.select("doc_id", "lang", T.word_count("text").alias("n_words"), T.clean_text("text").alias("clean"))

    for first in (True, False):
        lot = docs.where((F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0) == F.lit(first))
        io.write_jsonl(lot, source, mode="append")
        incremental.append_batches(spark, source, schema, counted, sink, log, max_files_per_trigger=64)
    torn = len(incremental.committed(spark, sink))
    io.write_jsonl(counted(docs.where(F.col("doc_id") % 5 == 0)), incremental.epoch_path(sink, torn))
    return incremental.read_committed(spark, sink, "doc_id bigint, lang string, n_words int, clean string", "json")


@query
def generate_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UDF-1 with the deterministic echo generator over accepted rows (rows-only)."""
    acc = prompting.accepted(_validated(Fixtures(spark, sf_dir)))
    att = generation.generate_with_retries(acc, generation.echo_generator)
    res = prompting.resolve_attempts(acc, att)
    return prompting.prompt_log(res)
