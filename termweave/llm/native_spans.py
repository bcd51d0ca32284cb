"""Positions of pattern matches with built-in functions only.

Offsets are code points from 0, ends exclusive; matches are the leftmost non-overlapping ones.
Patterns must not match the empty string.  Repeated groups in patterns are possessive, so that
the regex engine loops instead of recursing on very long runs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_HIT = "struct<start:int,end:int,match:string>"


def found(text: Column, pattern: str) -> Column:
    """array<struct<start, end, match>>: the text between matches gives their positions."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    steps = F.zip_with(hits, gaps, lambda h, g: F.struct(h.alias("match"), F.length(g).alias("gap")))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_HIT}>").alias("out"))

    def step(s, x):
        start = s["at"] + x["gap"]
        end = start + F.length(x["match"])
        return F.struct(end.alias("at"), F.concat(s["out"], F.array(F.struct(
            start.alias("start"), end.alias("end"), x["match"].alias("match")))).alias("out"))

    # There is one gap more than hits; the one behind the last hit is not needed.
    some = F.filter(steps, lambda x: x["match"].isNotNull())
    return F.when(F.size(hits) == 0, F.array().cast(f"array<{_HIT}>")).otherwise(
        F.aggregate(some, zero, step, lambda s: s["out"]))


def written(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined, by start and then rank of the kind."""
    order = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return F.array_join(F.transform(order, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def normal_cdf(z: Column) -> Column:
    """Standard normal distribution function, by its usual logistic approximation."""
    return 1 / (1 + F.exp(-(1.5976 * z + 0.07056 * z * z * z)))


def replaced(text: Column, spans: Column, by: str) -> Column:
    """The text with every stretch that a span covers replaced; overlapping spans count as one."""
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(s, x):
        fresh = x["start"] >= s["at"]
        kept = F.concat(s["out"], F.substring(text, s["at"] + 1, x["start"] - s["at"]), F.lit(by))
        return F.struct(F.greatest(s["at"], x["end"]).alias("at"),
                        F.when(fresh, kept).otherwise(s["out"]).alias("out"))

    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(
        order, zero, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text)))))
