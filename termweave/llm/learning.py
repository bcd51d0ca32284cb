"""Labelled samples for the classifiers: a bounded, hash-ordered choice of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termweave.llm.common import id_text


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, max_rows: int,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, label) of at most ``max_rows`` labelled ids for which ``allowed`` holds.

    Ids are taken in the order of a hash, so the choice depends on nothing but the id.  The
    chosen ids are broadcast: ``max_rows`` rows of two numbers at most.  Rows whose label or id
    is null teach nothing; where an id is labelled more than once, the largest label counts.  Where
    rows share an id, the text with the smallest hash stands for it, so that the rows are no more
    than the ids."""
    chosen = (labels.select(F.col(id_col).alias("doc_id"), F.col(label).cast("int").alias("label"))
              .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & allowed)
              .groupBy("doc_id").agg(F.max("label").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    rows = id_text(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id")
    first = F.min_by("text", F.struct(F.xxhash64("text"), "text"))
    return rows.groupBy("doc_id", "label").agg(first.alias("text")).select("doc_id", "text", "label")
