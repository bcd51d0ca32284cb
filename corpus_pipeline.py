"""The training-data pipeline: stages over ``documents``, each written and read again.

Quality rules and toxicity drop the documents they reject, near-duplicate removal keeps one
document of each group, the secret scan blanks out what it finds, and packing cuts what is left
into training sequences.  All stages but the last return the columns they were given.

Rows pass through the first two stages and the secret scan whole, as one struct column, so no
join is needed, rows with a null or repeated id are judged each by its own text, and no column
name can clash.  Near-duplicate removal goes by id: an id stays with all its texts, of equal rows
one stays, and rows without an id stay.  Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termweave.llm import minhash, quality_rules, secret_scan, toxicity
from termweave.llm.common import staged, table
from termweave.llm.queries import pack_documents

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _rows(docs: DataFrame) -> DataFrame:
    """Each row as the one column ``row``."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def _unpacked(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id.*")


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = quality_rules.quality_rules(_rows(docs), "row", "row.text")
    return _unpacked(judged.where("kept"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels, ~toxicity.held_out())
    return _unpacked(toxicity.score(_rows(docs), model, "row", "row.text").where("predicted = 0"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(docs)
    kept = found.where("kept and doc_id is not null").select("doc_id").distinct()
    some = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return some.select(docs.columns).unionByName(docs.where("doc_id is null"))


def blank_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = secret_scan.secrets(_rows(docs), "row", "row.text")
    row, hit = F.col("doc_id"), F.size("spans") > 0
    text = F.when(hit, secret_scan.redacted(row["text"], F.col("spans"))).otherwise(row["text"])
    blanked = found.select("doc_id", text.alias("blanked"))
    size = F.when(F.col("blanked").eqNullSafe(row["text"]), row["n_chars"]).otherwise(
        F.length("blanked").cast(docs.schema["n_chars"].dataType))
    return blanked.select(*[F.col("blanked").alias("text") if c == "text" else
                            size.alias("n_chars") if c == "n_chars" else row[c].alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", drop_low_quality),
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("secret_scans", blank_secrets),
    ("packing", pack),
]

# The classifier, the compressor and the tokenizer are not SQL; tests hold run() against a
# brute-force version instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
