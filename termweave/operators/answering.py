"""Evidence gathering and multiple-choice answering over question tables.

Questions: ``(id, question, options map<string,string>, question_type)``.  Search hits
are data: ``hits(key, query_rank, result_rank, url, body)``.  Generated responses are
data: ``responses(id, response)``.  Everything is joins, windows and aggregations;
the generation itself goes through ``termweave.operators.generation``.

WIN-4, FIL-9, AGG-8, AGG-9, SCA-15, SCA-18..22, FIL-11, JOIN-5, SET-2.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termweave.functions import constants as K
from termweave.functions import text as T
from termweave.session import scratch_path

# Default answer prompts (our own wording; pass others as parameters).
CHOICE_PROMPT = (
    "Answer the clinical question using the evidence.\n\nQuestion: {stem}\n\nOptions:\n{options}\n\n"
    "Evidence:\n{evidence}\n\nReturn only JSON with fields selected_option (A-D) and reasoning.")
OPEN_PROMPT = (
    "Answer the clinical question using the evidence.\n\nQuestion: {stem}\n\n"
    "Evidence:\n{evidence}\n\nReturn only JSON with fields reasoning and selected_option (A-D).")


def top_hits(hits: DataFrame, keys: list[str], k: int) -> DataFrame:
    """WIN-4: the first ``k`` results per query (``keys`` + ``query_rank``).  Planned as
    a WindowGroupLimit, so partial top-k happens before the shuffle."""
    w = Window.partitionBy(*keys, "query_rank").orderBy("result_rank")
    return hits.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k).drop("rn")


def ascii_evidence(snippets: DataFrame, keys: list[str], k: int = K.SNIPPETS_PER_QUERY) -> DataFrame:
    """FIL-9 + AGG-9: among the first ``k`` snippets per key (by ``result_rank``), keep
    those with an ASCII share strictly above the threshold, join them with `` | `` in
    rank order; a key where none survive gets the fixed fallback text.  Groups hold at
    most ``k`` rows."""
    w = Window.partitionBy(*keys).orderBy("result_rank")
    s = (snippets.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k)
         .withColumn("keep", T.ascii_share("body") > K.ASCII_SHARE_MIN))
    g = s.groupBy(*keys).agg(F.sort_array(F.collect_list(
        F.when(F.col("keep"), F.struct("result_rank", "body")))).alias("kept"))
    joined = F.array_join(F.transform("kept", lambda e: e["body"]), K.EVIDENCE_SEPARATOR)
    return g.select(*keys, F.when(F.size("kept") > 0, joined)
                    .otherwise(F.lit(K.NO_ENGLISH_EVIDENCE)).alias("evidence"))


def provider_evidence(queries: DataFrame, hits: DataFrame, keys: list[str],
                      third_answers: bool = True) -> DataFrame:
    """JOIN-4 / WIN-4 / SRC-6: one evidence text per query through the provider chain.

    ``hits``: ``keys``, provider (1, 2, 3), result_rank, title, body.  The first provider
    with results wins: its first five as ``title: body``; else the second's first three
    bodies; else the third's first three, less those whose ASCII share is too low, and the
    fixed text if none is left.  ``third_answers``: whether the third provider can be
    asked; if not, a query without results gets the other fixed text.  Ranks are unique
    per query and provider; a group keeps five rows at most."""
    w = Window.partitionBy(*keys, "provider").orderBy("result_rank")
    first = (hits.withColumn("__n", F.row_number().over(w))
             .where(F.col("__n") <= F.when(F.col("provider") == 1, K.FIRST_PROVIDER_SNIPPETS)
                    .otherwise(K.SNIPPETS_PER_QUERY)))
    body = F.coalesce(F.col("body"), F.lit(""))
    text = F.when(F.col("provider") == 1, F.concat(F.coalesce("title", F.lit("")), F.lit(": "), body)).otherwise(body)
    kept = (F.col("provider") != 3) | (T.ascii_share("body") > K.ASCII_SHARE_MIN)
    by = first.groupBy(*keys).agg(F.array_sort(F.collect_list(F.when(
        kept, F.struct("provider", "result_rank", text.alias("text"))))).alias("e"))

    def joined(n):
        mine = F.filter("e", lambda x: x["provider"] == n)
        return F.when(F.size(mine) > 0, F.array_join(F.transform(mine, lambda x: x["text"]), K.EVIDENCE_SEPARATOR))

    last = F.lit(K.NO_ENGLISH_EVIDENCE if third_answers else K.NO_EVIDENCE)
    return (queries.select(*keys).distinct().join(by, keys, "left")
            .select(*keys, F.coalesce(joined(1), joined(2), joined(3) if third_answers else F.lit(None), last)
                    .alias("evidence")))


def option_rows(questions: DataFrame) -> DataFrame:
    """JOIN-5 input: one row per (question, option) with its position and the evidence
    query ``option question`` (SCA-19)."""
    return questions.select(
        "id", "question", F.posexplode(F.map_entries("options")).alias("opt_pos", "e")).select(
        "id", "opt_pos", F.col("e.key").alias("opt_key"), F.col("e.value").alias("opt_val"),
        F.concat_ws(" ", F.col("e.value"), F.col("question")).alias("query"))


def evidence_map(questions: DataFrame, evidence: DataFrame, on: tuple[str, ...] = ("id", "opt_key")) -> DataFrame:
    """JOIN-5 / AGG-8 / SCA-18: per question, the map option -> evidence text (fixed
    text when an option has none) and the ``key: value`` evidence block.  ``evidence``
    has a row per (question, option); other keys of ``option_rows`` (its search text, say)
    can be named in ``on``."""
    ev = evidence.select(*[F.col(c).alias(f"__{c}") for c in on], "evidence")
    opts = option_rows(questions)
    j = opts.join(ev, [F.col(c) == F.col(f"__{c}") for c in on], "left")
    g = j.groupBy("id").agg(F.sort_array(F.collect_list(F.struct(
        "opt_pos", "opt_key", F.coalesce("evidence", F.lit(K.NO_EVIDENCE)).alias("evidence"))))
        .alias("e"))
    m = F.map_from_entries(F.transform("e", lambda x: F.struct(x["opt_key"], x["evidence"])))
    return g.select("id", m.alias("evidence"), T.map_lines(m).alias("evidence_text"))


def answer_prompt(stem, options, evidence_text, qtype,
                  choice_template: str = CHOICE_PROMPT, open_template: str = OPEN_PROMPT) -> Column:
    """SCA-21: prompt by question type; options only for choice types; null for
    unsupported types (no generation happens for them)."""

    def fill(tpl: str, with_options: bool) -> Column:
        parts = []
        rest = tpl
        for key, col in (("{stem}", stem), ("{options}", T.map_lines(options) if with_options else None),
                         ("{evidence}", evidence_text)):
            if key not in rest:
                continue
            head, rest = rest.split(key, 1)
            parts += [F.lit(head), col]
        parts.append(F.lit(rest))
        return F.concat(*parts)

    return (F.when(qtype.isin(*K.CHOICE_TYPES), fill(choice_template, True))
            .when(qtype == K.OPEN_TYPE, fill(open_template, False)))


def parse_response(resp) -> dict[str, Column]:
    """SCA-15 strict JSON: ``valid`` (exactly one JSON value, no trailing junk),
    ``is_object``, and per field a (present, is_null, text) triple."""
    r = F.col(resp) if isinstance(resp, str) else resp
    v = F.try_parse_json(F.concat(F.lit("["), r, F.lit("]")))
    one = F.when(F.schema_of_variant(v).startswith("ARRAY"),
                 F.try_variant_get(v, "$[0]", "variant"))
    valid = v.isNotNull() & one.isNotNull() & F.try_variant_get(v, "$[1]", "variant").isNull()
    is_obj = valid & F.schema_of_variant(one).startswith("OBJECT")
    out = {"valid": valid, "is_object": is_obj}
    for f in ("selected_option", "reasoning"):
        val = F.try_variant_get(one, f"$.{f}", "variant")
        out[f] = F.when(val.isNull(), F.lit("")).when(F.is_variant_null(val), F.lit(None).cast("string")) \
            .otherwise(F.try_variant_get(one, f"$.{f}", "string"))
    return out


def assemble_answers(questions: DataFrame, responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """SCA-15/20, FIL-11: (answers, rejects).  Answers ``(id, prediction, reasoning,
    choice)``; rejects ``(id, reason)``: responses that are valid JSON but not an object
    (the original drops those questions silently), and failed calls (null response), with
    the call's error if ``responses`` has an ``error`` column.  A failed call keeps its
    answer row, with null reasoning."""
    q = questions.select("id", "question_type")
    error = F.col("error") if "error" in responses.columns else F.lit(None).cast("string")
    r = responses.select("id", "response", error.alias("__error"), F.lit(True).alias("__asked"))
    j = q.join(r, "id", "left")
    p = parse_response("response")
    qt = F.col("question_type")
    choice, open_ = qt.isin(*K.CHOICE_TYPES), qt == K.OPEN_TYPE
    raw = F.col("response")  # null after a failed call
    # Invalid JSON -> choice types {selected:'', reasoning:raw}; open type {reasoning:raw}.
    sel = F.when(p["is_object"], p["selected_option"]).otherwise(F.lit(""))
    rea = F.when(p["is_object"], p["reasoning"]).otherwise(raw)
    failed = F.coalesce((choice | open_) & p["valid"] & ~p["is_object"], F.lit(False))
    x = j.withColumns({"__sel": sel, "__rea": rea, "__failed": failed})
    answers = x.where(~F.col("__failed")).select(
        "id",
        F.when(choice, F.col("__sel")).when(open_, F.col("__rea")).otherwise(F.lit("")).alias("prediction"),
        F.when(choice | open_, F.col("__rea")).otherwise(F.lit(K.UNSUPPORTED_REASONING)).alias("reasoning"),
        F.when(choice, F.col("__sel"))
        .when(open_, F.when(F.coalesce(F.col("__sel"), F.lit("")) != "", F.col("__sel"))
              .otherwise(F.lit(K.OPEN_DEFAULT_CHOICE)))
        .otherwise(F.lit("")).alias("choice"))
    silent = (choice | open_) & F.col("__asked") & F.col("response").isNull()
    rejects = x.where(F.col("__failed") | F.coalesce(silent, F.lit(False))).select("id", F.when(
        F.col("__failed"), F.lit("response is not a JSON object")).otherwise(
        F.coalesce("__error", F.lit("no response"))).alias("reason"))
    return answers, rejects


def answers_csv(answers: DataFrame) -> DataFrame:
    """SNK-7 column selection: reasoning is written as reasoning_trace."""
    return answers.select("id", "prediction", F.col("reasoning").alias("reasoning_trace"), "choice")


def answer_questions(questions: DataFrame, evidence: DataFrame, fn, batch_size: int = 5,
                     choice_template: str = CHOICE_PROMPT, open_template: str = OPEN_PROMPT
                     ) -> tuple[DataFrame, DataFrame]:
    """UDF-3 end to end: evidence map -> prompts (SCA-21) -> caller's batch generator
    (``mapInPandas``) -> strict parsing and assembly.  Unsupported question types are
    never sent to the generator.  Its responses are written once, before answers and rejects read
    them, so no question is asked twice.  Returns (answers, rejects)."""
    from termweave.operators.generation import generate

    m = evidence_map(questions, evidence)
    q = questions.join(m, "id", "left").withColumn(
        "prompt", answer_prompt(F.col("question"), F.col("options"), F.col("evidence_text"),
                                F.col("question_type"), choice_template, open_template))
    asked = q.where(F.col("prompt").isNotNull()).select("id", "prompt")
    resp = generate(asked, fn, "prompt", "id", 0, batch_size).select(
        "id", F.col("raw_response").alias("response"), "error")
    path = scratch_path(questions.sparkSession, "responses")
    resp.write.parquet(path)
    return assemble_answers(questions, questions.sparkSession.read.schema(resp.schema).parquet(path))
