"""Term-constrained prompting: index assignment, row validation and routing, prompt
assembly, response parsing, retry resolution and the reject table.

Input rows follow the prompt-input CSV schema: ``row_no`` (file order), ``index``,
``English``, ``Vietnamese``, ``English Sentence``, ``Vietnamese Sentence`` (strings).
Generation attempts are data: ``attempts(row_no, attempt, raw_response, error)``, so
retries never re-run a job -- they are rows resolved by an aggregation (AGG-7).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termweave.functions import constants as K
from termweave.functions import text as T
from termweave.operators.ordering import prefix_sum

EN, VI, EN_S, VI_S = "English", "Vietnamese", "English Sentence", "Vietnamese Sentence"


def assign_index(rows: DataFrame, bucket_size: int | None = None) -> DataFrame:
    """PRJ-2 / WIN-1: keep a valid integer ``index``; otherwise take the next number of
    a counter shared by all rows without one, starting at 1, in ``row_no`` order."""
    parsed = rows.withColumn("__idx", T.python_int(F.coalesce(F.col("index"), F.lit(""))))
    # row_no is the dense file position (1..N), so fixed-width buckets are bounded.
    counted = prefix_sum(parsed, "row_no", F.col("__idx").isNull().cast("int"), "__auto",
                         bucket_size, dense_keys=True)
    return (counted.withColumn("index", F.coalesce(F.col("__idx"), F.col("__auto")))
            .withColumn("is_auto", F.col("__idx").isNull())
            .drop("__idx", "__auto"))


def validation_reason(rows: DataFrame) -> DataFrame:
    """FIL-1: add ``reason`` (null when the row is accepted), first failing rule wins,
    plus the stripped/cleaned fields used downstream."""
    en_term = T.strip_or_empty(EN)
    vi_term = T.strip_or_empty(VI)
    x = rows.withColumns({
        "en_term": en_term,
        "vi_term": vi_term,
        "en_sentence": T.clean_sentence(EN_S),
        "vi_sentence": T.clean_sentence(VI_S),
    })
    head, tail = K.REASON_TERM_NOT_IN_SENTENCE.split("{term}")
    reason = (
        F.when(F.col("en_term") == "", F.lit(K.REASON_MISSING_EN_TERM))
        .when(F.col("vi_term") == "", F.lit(K.REASON_MISSING_VI_TERM))
        .when(F.col("en_sentence") == "", F.lit(K.REASON_MISSING_EN_SENTENCE))
        .when(F.col("vi_sentence") == "", F.lit(K.REASON_MISSING_VI_SENTENCE))
        .when(~T.contains_ci("en_sentence", "en_term"),
              F.concat(F.lit(head), F.col("en_term"), F.lit(tail)))
    )
    return x.withColumn("reason", reason)


def input_rejects(validated: DataFrame) -> DataFrame:
    """FIL-2, rejected side: raw terms as read (null read as '')."""
    return (validated.where(F.col("reason").isNotNull())
            .select("row_no", "index",
                    F.coalesce(F.col(EN), F.lit("")).alias("en_term"),
                    F.coalesce(F.col(VI), F.lit("")).alias("vi_term"), "reason"))


def accepted(validated: DataFrame) -> DataFrame:
    """FIL-2, accepted side, with the prompt input built (SCA-6, SCA-10)."""
    a = validated.where(F.col("reason").isNull())
    a = a.withColumn("vi_examples", T.prepare_vi_examples("vi_sentence"))
    return a.withColumn("prompt_input", T.prompt_input("index", "en_term", "vi_term",
                                                       "en_sentence", "vi_examples"))


def prompts(acc: DataFrame, template: str = K.DEFAULT_PROMPT_TEMPLATE) -> DataFrame:
    """Per accepted row: first-attempt prompt and retry prompt (SCA-10, SCA-11)."""
    return acc.select(
        "row_no", "index", "prompt_input",
        T.full_prompt(template, "prompt_input").alias("full_prompt"),
        T.full_prompt(template, T.retry_prompt("prompt_input", "vi_term")).alias("retry_prompt"),
    )


def parse_attempts(attempts: DataFrame) -> DataFrame:
    """SCA-12 on every attempt; FIL-10 flag ``parsed``."""
    p = T.parse_llm_output("raw_response")
    return (attempts.withColumn("__p", p)
            .select("*", F.col("__p.index").alias("parsed_index"), F.col("__p.en").alias("en_echo"),
                    F.col("__p.vi").alias("vi_gen"))
            .drop("__p")
            .withColumn("parsed", F.col("parsed_index").isNotNull()))


def resolve_attempts(acc: DataFrame, attempts: DataFrame) -> DataFrame:
    """AGG-7: one row per accepted input row with ``status``,
    ``raw_response`` (as logged) and ``vi_sentence_gen`` (null unless success).

    ``attempts`` holds at most MAX_ATTEMPTS rows per ``row_no``; grouping is by row, so
    every group is bounded.  The accepted frame supplies the target term for FIL-3."""
    att = parse_attempts(attempts.where(F.col("attempt") < K.MAX_ATTEMPTS))
    att = att.join(acc.select("row_no", "vi_term"), "row_no", "inner")
    resp = F.col("raw_response")
    valid = (resp.isNotNull() & (resp != "") & F.col("vi_gen").isNotNull()
             & T.valid_output("vi_gen", "vi_term"))
    att = att.withColumn("valid", valid)
    g = att.groupBy("row_no").agg(
        F.min_by(F.struct("raw_response", "vi_gen"),
                 F.when(F.col("valid"), F.col("attempt"))).alias("first_valid"),
        F.max(F.when(F.col("valid"), F.lit(1))).alias("any_valid"),
        F.max_by(F.struct("raw_response", "error"), "attempt").alias("last"),
    )
    last_text = F.col("last.raw_response")
    has_text = last_text.isNotNull() & (last_text != "")
    status = (
        F.when(F.col("any_valid") == 1, F.lit(K.STATUS_SUCCESS))
        .when(has_text, F.concat(F.lit(K.STATUS_FAILED_VALIDATION), F.col("last.error")))
        .otherwise(F.concat(F.lit(K.STATUS_FAILED_API), F.col("last.error")))
    )
    raw = (F.when(F.col("any_valid") == 1, F.col("first_valid.raw_response"))
           .when(has_text, last_text).otherwise(F.lit("")))
    res = g.select("row_no", status.alias("status"), raw.alias("raw_response"),
                   F.when(F.col("any_valid") == 1, F.col("first_valid.vi_gen")).alias("vi_sentence_gen"))
    return acc.select("row_no", "index", "en_term", "vi_term", "en_sentence", "prompt_input").join(
        res, "row_no", "inner")


def prompt_log(resolved: DataFrame) -> DataFrame:
    """SNK-3 rows: index, prompt_input (base prompt), raw_response, status."""
    return resolved.select("row_no", "index", "prompt_input", "raw_response", "status")


def results(resolved: DataFrame) -> DataFrame:
    """Synthetic pairs: accepted rows whose generation succeeded."""
    return (resolved.where(F.col("status") == K.STATUS_SUCCESS)
            .select("row_no", "index", "en_term", "vi_term", "en_sentence", "vi_sentence_gen"))


def generation_rejects(resolved: DataFrame) -> DataFrame:
    return (resolved.where(F.col("status") != K.STATUS_SUCCESS)
            .select("row_no", "index", "en_term", "vi_term", F.col("status").alias("reason")))


def reject_table(validated: DataFrame, resolved: DataFrame) -> DataFrame:
    """SET-1: input rejects union generation rejects."""
    return input_rejects(validated).unionByName(generation_rejects(resolved))


def reject_counts(rejects: DataFrame) -> DataFrame:
    """AGG-10: rejects per reason."""
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def run_counts(validated: DataFrame, resolved: DataFrame) -> DataFrame:
    """AGG-1: success / failed counts (failed = input rejects + generation failures)."""
    gen = resolved.select(F.when(F.col("status") == K.STATUS_SUCCESS, F.lit("success"))
                          .otherwise(F.lit("failed")).alias("outcome"))
    bad = validated.where(F.col("reason").isNotNull()).select(F.lit("failed").alias("outcome"))
    return gen.unionByName(bad).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def pending(acc: DataFrame, prompt_log_done: DataFrame, key: str = "row_no") -> DataFrame:
    """JOIN-7 / STR-1 resume: accepted rows that have no logged outcome yet.  A rerun
    after an interruption generates only these and appends their log rows."""
    return acc.join(prompt_log_done.select(key), key, "left_anti")
