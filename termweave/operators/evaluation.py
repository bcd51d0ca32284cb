"""Scoring: corpus BLEU (mteval-13a tokens, exponential smoothing), BLEU delta between
systems, term accuracy, and score extraction from report text.

Inputs are line tables: ``refs(line_no, text)`` and ``preds(system, line_no, text)``.
The BLEU plan has one data-sized shuffle: predictions and references meet on
``line_no``; that hash partitioning also satisfies the per-(system, line, n, gram)
counting, so the exploded n-grams are counted without another exchange, and only
per-(system, n) partial sums travel afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termweave.functions import text as T

MAX_ORDER = 4

# mteval-13a: ASCII symbols isolated except apostrophe, comma, hyphen, period, digits.
# The symbols that stand alone.
_SYMBOLS = r"""([ !"#$%&()*+/:;<=>?@\[\\\]^_`{|}~])"""


def tokenize_13a(c) -> Column:
    """Array of tokens under the 13a rules."""
    s = F.col(c) if isinstance(c, str) else c
    s = F.replace(s, F.lit("<skipped>"), F.lit(""))
    s = F.replace(s, F.lit("-\n"), F.lit(""))
    s = F.replace(s, F.lit("\n"), F.lit(" "))
    for a, b in (("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        s = F.replace(s, F.lit(a), F.lit(b))
    s = F.concat(F.lit(" "), s, F.lit(" "))
    s = F.regexp_replace(s, _SYMBOLS, " $1 ")
    s = F.regexp_replace(s, r"([^0-9])([.,])", "$1 $2 ")
    s = F.regexp_replace(s, r"([.,])([^0-9])", " $1 $2")
    s = F.regexp_replace(s, r"([0-9])(-)", "$1 $2 ")
    return F.filter(F.split(s, T.JWS + "+", -1), lambda x: x != F.lit(""))


def ngrams(tokens, n: int) -> Column:
    """``n``-grams of a token array, tokens joined by one space (tokens hold no space)."""
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    return F.when(
        F.size(t) >= n,
        F.transform(F.sequence(F.lit(1), F.size(t) - n + 1),
                    lambda i: F.array_join(F.slice(t, i, n), " ")),
    ).otherwise(F.array().cast("array<string>"))


def _tag(n: int):
    return lambda g: F.struct(F.lit(n).alias("n"), g.alias("gram"))


def _all_ngrams(tokens: str) -> Column:
    return F.concat(*[F.transform(ngrams(tokens, n), _tag(n)) for n in range(1, MAX_ORDER + 1)])


def bleu_stats(refs: DataFrame, preds: DataFrame) -> DataFrame:
    """Per system: clipped matches ``c1..c4``, totals ``t1..t4``, ``sys_len``, ``ref_len``.

    Line files of unequal length are refused, as the original scorer does: a hypothesis
    without reference, or a reference that a system has no hypothesis for, stops the job."""
    r = refs.select("line_no", tokenize_13a("text").alias("rt"))
    h = preds.select("system", "line_no", tokenize_13a("text").alias("ht"))
    lines = h.join(r, "line_no", "left")
    n_refs = refs.select(F.count(F.lit(1))).scalar()
    grams = lines.select(
        "system", "line_no",
        F.explode(F.concat(
            F.transform(_all_ngrams("ht"), lambda e: F.struct(e["n"], e["gram"], F.lit(1).alias("h"),
                                                             F.lit(0).alias("r"))),
            F.transform(_all_ngrams("rt"), lambda e: F.struct(e["n"], e["gram"], F.lit(0).alias("h"),
                                                             F.lit(1).alias("r"))),
        )).alias("g"))
    clipped = (grams.groupBy("system", "line_no", F.col("g.n").alias("n"), F.col("g.gram").alias("gram"))
               .agg(F.least(F.sum("g.h"), F.sum("g.r")).alias("m"))
               .groupBy("system").agg(*[F.sum(F.when(F.col("n") == n, F.col("m")).otherwise(0))
                                        .cast("bigint").alias(f"c{n}")
                                        for n in range(1, MAX_ORDER + 1)]))
    lens = lines.groupBy("system").agg(
        F.sum(F.size("ht")).cast("bigint").alias("sys_len"),
        F.sum(F.size("rt")).cast("bigint").alias("ref_len"),
        *[F.sum(F.greatest(F.size("ht") - n + 1, F.lit(0))).cast("bigint").alias(f"t{n}")
          for n in range(1, MAX_ORDER + 1)],
        F.count_if(F.col("rt").isNotNull()).alias("__paired"), F.count(F.lit(1)).alias("__lines"))
    unequal = (F.col("__paired") != F.col("__lines")) | (F.col("__paired") != n_refs)
    said = F.concat(F.lit("hypotheses and references differ in length: "), "system")
    lens = lens.withColumn("sys_len", F.when(unequal, F.raise_error(said).cast("bigint")).otherwise(
        F.col("sys_len"))).drop("__paired", "__lines")
    return lens.join(clipped, "system", "left").fillna(0, subset=[f"c{n}" for n in range(1, MAX_ORDER + 1)])


def bleu_from_stats(stats: DataFrame) -> DataFrame:
    """Closed-form corpus BLEU with exponential smoothing."""
    c = [F.col(f"c{n}") for n in range(1, MAX_ORDER + 1)]
    t = [F.col(f"t{n}") for n in range(1, MAX_ORDER + 1)]
    zeros = []
    acc = F.lit(0)
    for n in range(MAX_ORDER):
        acc = acc + (c[n] == 0).cast("int")
        zeros.append(acc)
    prec = [F.when(c[n] == 0, F.lit(100.0) / (F.pow(F.lit(2.0), zeros[n]) * t[n]))
            .otherwise(F.lit(100.0) * c[n] / t[n]) for n in range(MAX_ORDER)]
    sys_len, ref_len = F.col("sys_len"), F.col("ref_len")
    bp = (F.when(sys_len >= ref_len, F.lit(1.0))
          .when(sys_len > 0, F.exp(F.lit(1.0) - ref_len / sys_len)).otherwise(F.lit(0.0)))
    no_match = c[0] + c[1] + c[2] + c[3] == 0
    empty_order = (t[0] == 0) | (t[1] == 0) | (t[2] == 0) | (t[3] == 0)
    mean_log = (F.log(prec[0]) + F.log(prec[1]) + F.log(prec[2]) + F.log(prec[3])) / MAX_ORDER
    score = F.when(no_match | empty_order, F.lit(0.0)).otherwise(bp * F.exp(mean_log))
    return stats.withColumn("bleu", score).withColumn("bp", bp)


def corpus_bleu(refs: DataFrame, preds: DataFrame) -> DataFrame:
    """AGG-3: one row per system."""
    return bleu_from_stats(bleu_stats(refs, preds))


def bleu_delta(scores: DataFrame, baseline: str = "baseline", tuned: str = "tuned") -> DataFrame:
    """AGG-5 / JOIN-6: tuned minus baseline and a verdict; null when either is missing."""
    piv = scores.groupBy().agg(
        F.max(F.when(F.col("system") == baseline, F.col("bleu"))).alias("baseline_bleu"),
        F.max(F.when(F.col("system") == tuned, F.col("bleu"))).alias("tuned_bleu"))
    delta = F.col("tuned_bleu") - F.col("baseline_bleu")
    return piv.withColumn("delta", delta).withColumn(
        "verdict", F.when(delta > 0, F.lit("improved")).when(delta < 0, F.lit("decreased"))
        .when(delta == 0, F.lit("unchanged")))


def evaluation_report(scores: DataFrame, baseline: str = "baseline", tuned: str = "tuned") -> DataFrame:
    """SNK-9: one row per system with its BLEU and, on the tuned row, the delta."""
    d = bleu_delta(scores, baseline, tuned).select("delta")
    s = scores.select("system", "bleu", "sys_len", "ref_len")
    return (s.join(F.broadcast(d.withColumn("system", F.lit(tuned))), "system", "left")
            .select("system", "bleu", "delta", "sys_len", "ref_len"))


def term_accuracy(sources: DataFrame, preds: DataFrame, term_map: DataFrame) -> DataFrame:
    """AGG-4: for every (line, source term) with the source term contained in the source
    line (case-insensitive), whether the system's prediction contains the mapped target
    term (case-sensitive).  Returns per system ``n_pairs``, ``n_hits``, ``term_accuracy``.

    ``sources(line_no, text)``, ``preds(system, line_no, text)``,
    ``term_map(src_term, tgt_term)``."""
    from termweave.operators.matching import contains_join

    s = sources.select("line_no", F.lower("text").alias("src_l"))
    tm = term_map.select(F.lower("src_term").alias("src_l_term"), "tgt_term")
    # No language to join on: the anchor plan joins on grams, not every line with every term.
    hits = contains_join(s, tm, "src_l", "src_l_term", strategy="anchor")
    pairs = hits.select("line_no", "tgt_term").join(
        preds.select("system", "line_no", F.col("text").alias("pred")), "line_no")
    return (pairs.groupBy("system").agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.count_if(F.contains(F.col("pred"), F.col("tgt_term"))).alias("n_hits"))
        .withColumn("term_accuracy", F.col("n_hits") / F.col("n_pairs")))


from termweave.functions import constants as K  # noqa: E402

# The fixed fallback pattern with Python's Unicode \s and ASCII digits.
_FALLBACK_RE = K.BLEU_FALLBACK_PATTERN.replace(r"\s", T.JWS).replace(r"\d", "[0-9]")


def report_scores(reports: DataFrame) -> DataFrame:
    """SCA-17 per report ``(system, line_no, text)``: the first decimal on the first
    line mentioning BLEU/score, else ``BLEU = x.y`` anywhere in the report."""
    x = reports.withColumn("v", T.report_score("text"))
    return x.groupBy("system").agg(
        F.min_by("v", F.when(F.col("v").isNotNull(), F.col("line_no"))).alias("first"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_no", "text"))),
                                 lambda e: e["text"]), "\n").alias("full"),
    ).select("system", F.coalesce(
        F.col("first"),
        F.when(F.regexp_extract("full", _FALLBACK_RE, 1) != "",
               F.regexp_extract("full", _FALLBACK_RE, 1).cast("double"))).alias("bleu"))
