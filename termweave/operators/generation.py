"""Pluggable batch generation (UDF-1, UDF-3).

The caller supplies a batch function ``fn(prompts: list[str]) -> list[(text, error)]``
(``text`` None when the call failed; ``error`` is ``'success'`` for a returned text,
as in the original).  Calls run inside ``mapInPandas`` over Arrow batches, in batches
of ``batch_size``; no network client ships with this package.

Retries are rounds: round ``a`` calls only rows that have no valid attempt yet, with
the retry prompt.  Each round's attempts are written as a table before the next round
starts, so a lost executor never re-calls the generator for rows whose answers were
already recorded (generation is not deterministic), and the plan's lineage stays one
round deep.  With a path of the caller's, a restarted run reads the rounds that are
there and goes on after them.  A batch whose call raises counts as failed, with the
error's text, and does not stop the job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termweave.functions import constants as K
from termweave.functions import text as T
from termweave.operators.parallel import tasks
from termweave.session import scratch_path

BatchFn = Callable[[Sequence[str]], Sequence[tuple[str | None, str]]]


def generate(df: DataFrame, fn: BatchFn, prompt_col: str, key: str = "row_no",
             attempt: int = 0, batch_size: int = 8, parallelism: int | None = None) -> DataFrame:
    """One generation attempt per row: (key, attempt, raw_response, error).

    ``parallelism`` is the number of tasks calling ``fn`` at once (the original ran a
    pool of 20 threads); prompts are hash-spread over that many partitions with an
    explicit count, so AQE cannot fold a small prompt set into one task.  Default: two
    tasks per core."""
    n = parallelism or tasks(df.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            prompts = pdf[prompt_col].fillna("").tolist()
            texts, errors = [], []
            for i in range(0, len(prompts), batch_size):
                part = prompts[i:i + batch_size]
                try:
                    got = list(fn(part))
                    if len(got) != len(part):
                        raise ValueError(f"{len(got)} answers to {len(part)} prompts")
                except Exception as e:  # a failed call is a recorded attempt
                    got = [(None, f"{K.API_ERROR_PREFIX}{e}")] * len(part)
                for text, err in got:
                    texts.append(text)
                    errors.append(err)
            yield pd.DataFrame({key: pdf[key].to_numpy(), "attempt": attempt,
                                "raw_response": texts, "error": errors})

    key_type = df.schema[key].dataType.simpleString()
    return df.select(key, prompt_col).repartition(n, key).mapInPandas(
        run, f"{key} {key_type}, attempt int, raw_response string, error string")


def generate_with_retries(acc: DataFrame, fn: BatchFn, template: str = K.DEFAULT_PROMPT_TEMPLATE,
                          max_attempts: int = K.MAX_ATTEMPTS, batch_size: int = 8,
                          parallelism: int | None = None, path: str | None = None) -> DataFrame:
    """UDF-1 with the retry loop of the original, as data: returns the attempts table
    that ``prompting.resolve_attempts`` consumes.  ``acc`` comes from
    ``prompting.accepted``.  ``path``: the table of attempts, one folder per round; a
    fresh one in the shared folder by default."""
    from termweave.operators.prompting import parse_attempts

    spark = acc.sparkSession
    path = path or scratch_path(spark, "attempts")
    # The prompts are written once: every round reads the same input without re-deriving
    # it, and a lost executor cannot change it between rounds.
    prompts = _kept(f"{path}/prompts", lambda: acc.select(
        "row_no", "vi_term", T.full_prompt(template, "prompt_input").alias("p0"),
        T.full_prompt(template, T.retry_prompt("prompt_input", "vi_term")).alias("p1")), spark)
    todo = prompts
    rounds: list[DataFrame] = []
    for a in range(max_attempts):
        col = "p0" if a == 0 else "p1"
        att = _kept(f"{path}/attempt={a}", lambda: generate(
            todo, fn, col, "row_no", a, batch_size, parallelism), spark)
        rounds.append(att)
        ok = (parse_attempts(att).join(todo.select("row_no", "vi_term"), "row_no")
              .where(F.col("raw_response").isNotNull() & (F.col("raw_response") != "")
                     & F.col("vi_gen").isNotNull() & T.valid_output("vi_gen", "vi_term"))
              .select("row_no"))
        todo = todo.join(ok, "row_no", "left_anti")
    out = rounds[0]
    for r in rounds[1:]:
        out = out.unionByName(r)
    return out


def _kept(path: str, make: Callable[[], DataFrame], spark: SparkSession) -> DataFrame:
    """The table at ``path``; written first unless an earlier run has finished writing it."""
    try:
        spark.read.format("binaryFile").load(f"{path}/_SUCCESS").isEmpty()
    except AnalysisException:
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def echo_generator(prompts: Sequence[str]) -> list[tuple[str | None, str]]:
    """Deterministic stand-in generator for tests: echoes the prompt input (the text
    after the template's blank line) as ``<index> | <input> | <input>``."""
    out = []
    for p in prompts:
        body = p.split("\n\n", 1)[-1].replace("\n", " ")
        head = body.split(" ", 1)[0]
        out.append((f"{head} | {body} | {body}", K.STATUS_SUCCESS))
    return out
