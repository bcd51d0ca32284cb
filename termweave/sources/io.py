"""Readers and writers with the options that reproduce the original file formats.

SRC-1..4 and SNK-1..9.  Spark reads a CSV file with quoted newlines in one task; ``splits=True``
reads it in many (``csv_splits``).  At scale, convert such files once to parquet
(``csv_to_parquet``) with a stable ``row_no`` and run every job on the parquet copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Tt

# Tokens pandas reads as missing by default (SRC-2).
PANDAS_NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

CSV_READ_OPTIONS = {
    "header": "true",
    "multiLine": "true",
    "escape": '"',
    "quote": '"',
    "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "mode": "PERMISSIVE",
}

CSV_WRITE_OPTIONS = {
    "header": "true",
    "escape": '"',
    "quote": '"',
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "encoding": "UTF-8",
}


def with_row_no(df: DataFrame, name: str = "row_no", start: int = 1) -> DataFrame:
    """WIN-2 at ingest: file-order position of each row of a fresh scan
    (``ordering.scan_positions``), computed in the JVM.  Columns keep their order, the
    position first."""
    from termweave.operators.ordering import scan_positions

    return scan_positions(df, name, start).select(name, *df.columns)


def read_csv_rows(spark: SparkSession, path: str, columns: list[str] | None = None,
                  row_no: bool = True, splits: bool = False) -> DataFrame:
    """SRC-1: ``csv.DictReader`` semantics: header row, every field a string, quoted
    newlines and doubled quotes, whitespace kept.  Missing trailing fields are null
    (read them through ``coalesce(..., '')``).  ``columns`` are taken by header name, in
    that order; a name that the header lacks gives null.  ``splits`` reads every file by as
    many tasks as its size asks for (quotes in quoted fields only, see ``csv_splits``)."""
    if splits:
        from termweave.sources.csv_splits import read_csv_splits

        df = read_csv_splits(spark, path, CSV_READ_OPTIONS)
        df = df if row_no else df.drop("row_no")
    else:
        df = spark.read.options(**CSV_READ_OPTIONS).csv(path)
        df = with_row_no(df) if row_no else df
    if columns:
        here = set(df.columns)
        df = df.select(*(["row_no"] if row_no else []),
                       *[F.col(f"`{c}`") if c in here else F.lit(None).cast("string").alias(c) for c in columns])
    return df


def read_csv_pandas(spark: SparkSession, path: str, columns: list[str] | None = None,
                    splits: bool = False) -> DataFrame:
    """SRC-2: as SRC-1 but the pandas default NA tokens become null (so a term spelled
    ``NA`` is missing, as in the original)."""
    df = read_csv_rows(spark, path, columns, splits=splits)
    return df.select(*[F.when(F.col(f"`{c}`").isin(PANDAS_NA_TOKENS), F.lit(None).cast("string"))
                       .otherwise(F.col(f"`{c}`")).alias(c) if c != "row_no" else F.col(c)
                       for c in df.columns])


def csv_to_parquet(spark: SparkSession, src: str, dst: str, columns: list[str] | None = None,
                   splits: bool = False) -> None:
    """Convert a multi-line CSV once (``splits``: by many tasks); later jobs read parquet splits."""
    read_csv_rows(spark, src, columns, splits=splits).write.mode("overwrite").parquet(dst)


def read_lines(spark: SparkSession, path: str, drop_blank: bool = False,
               compat: bool = False) -> DataFrame:
    """SRC-3: text lines as (line_no, text).  Default: the raw 0-based position is kept;
    with ``drop_blank`` lines are stripped and blank ones dropped *after* numbering, so a
    blank line never shifts its neighbours.  ``compat=True`` reproduces the original:
    strip, drop blanks, *then* number (one blank line shifts every later pair, D6)."""
    from termweave.functions import text as T
    from termweave.operators.ordering import scan_positions

    raw = spark.read.text(path)
    if compat:
        raw = raw.select("*", F.col("_metadata.file_path").alias("__file"),
                         F.col("_metadata.file_block_start").alias("__start"))
        kept = raw.withColumn("text", T.strip("value")).where(F.col("text") != "")
        return scan_positions(kept, "line_no", 0, "__file", "__start").select("line_no", "text")
    df = with_row_no(raw, "line_no", 0).withColumnRenamed("value", "text")
    if drop_blank:
        df = df.withColumn("text", T.strip("text")).where(F.col("text") != "")
    return df


def read_jsonl(spark: SparkSession, path: str, schema: Tt.StructType | str) -> DataFrame:
    """SRC-4: JSON lines with an explicit schema; malformed lines land in
    ``_corrupt_record`` instead of failing the job."""
    if isinstance(schema, str):
        schema = Tt._parse_datatype_string(schema)
    if "_corrupt_record" not in schema.fieldNames():
        schema = schema.add("_corrupt_record", Tt.StringType())
    return (spark.read.schema(schema).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record").json(path))


QUESTION_SCHEMA = ("id string, question string, options map<string,string>, "
                   "question_type string")


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", skip_empty: bool = True) -> bool:
    """SNK-1/2/7: CSV with a header, RFC-4180 quoting, empty strings written empty.
    Like the original, nothing is written for an empty result (``isEmpty`` reads at
    most one row).  Returns whether files were written."""
    if skip_empty and df.isEmpty():
        return False
    df.write.mode(mode).options(**CSV_WRITE_OPTIONS).csv(path)
    return True


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK-3/6: JSON lines keeping null fields and non-ASCII text as is."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_lines(df: DataFrame, path: str, key: str = "line_no", text_col: str = "text",
                partitions: int | None = None) -> None:
    """SNK-4/5: a line file in ``key`` order: range-partition by key, sort within
    partitions, write text; part files concatenated in name order are the file."""
    d = df.select(key, text_col)
    d = d.repartitionByRange(partitions, key) if partitions else d.repartitionByRange(key)
    d.sortWithinPartitions(key).select(text_col).write.mode("overwrite").text(path)


def write_pair_files(pairs: DataFrame, path: str, key: str = "row_no",
                     partitions: int | None = None) -> tuple[str, str]:
    """SNK-4: aligned source/target files from one frame (same order on both sides)."""
    src, tgt = f"{path}/train.src", f"{path}/train.tgt"
    write_lines(pairs.select(key, F.col("src").alias("text")), src, key, partitions=partitions)
    write_lines(pairs.select(key, F.col("tgt").alias("text")), tgt, key, partitions=partitions)
    return src, tgt


def write_json_config(df: DataFrame, path: str) -> None:
    """SNK-8/9: small one-row reports as JSON."""
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
