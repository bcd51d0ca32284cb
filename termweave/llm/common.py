"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from termweave.session import checkpoint_dir

# The ASCII whitespace that ends a word (bytes.split() uses the same set).
WORD_SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged_path(spark: SparkSession, tag: str) -> str:
    """A fresh path in the shared folder, one per call."""
    return f"{checkpoint_dir(spark).rstrip('/')}/termweave/{tag}-{uuid.uuid4().hex}"


def staged(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: lineage ends here,
    a lost executor costs no recomputation, and later readers scan only their columns."""
    spark = df.sparkSession
    path = staged_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the key and the text (null: empty); other columns, whatever their names, stay out."""
    return docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def map_texts(docs: DataFrame, schema: StructType | str, prepare: Callable[[], Callable],
              passed: Iterable[str] = ("doc_id",), as_bytes: bool = False,
              block_bytes: int = 4 << 20) -> DataFrame:
    """Row-wise work on whole texts in Arrow batches.

    ``prepare()`` runs once per task and returns ``fn(texts) -> dict of column lists``.  A
    batch is worked off in blocks of about ``block_bytes`` of text (a longer text is a block
    of its own), so memory follows the longest text and not the batch.  ``passed`` columns
    are handed through untouched."""
    passed = list(passed)
    if isinstance(schema, str):
        out = StructType.fromDDL(schema)
    else:
        out = schema
    full = StructType([docs.schema[c] for c in passed] + list(out.fields))
    arrow_schema = _arrow_schema(full)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = prepare()
        for batch in batches:
            col = batch.column(batch.schema.get_field_index("text"))
            if as_bytes:
                col = col.cast(pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary())
            for lo, hi in _blocks(col, block_bytes):
                part = fn(col.slice(lo, hi - lo).to_pylist())
                cols = [batch.column(batch.schema.get_field_index(c)).slice(lo, hi - lo).cast(
                    arrow_schema.field(c).type) for c in passed]
                cols += [v if isinstance(v, pa.Array) else pa.array(v, arrow_schema.field(k).type)
                         for k, v in ((f.name, part[f.name]) for f in out.fields)]
                yield pa.RecordBatch.from_arrays(cols, schema=arrow_schema)

    return docs.select(*passed, "text").mapInArrow(run, full)


def _arrow_schema(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _blocks(col: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(col), 0).to_pylist()
    lo = held = 0
    for i, n in enumerate(sizes):
        if i > lo and held + n > most:
            yield lo, i
            lo, held = i, 0
        held += n
    if lo < len(sizes):
        yield lo, len(sizes)


def crc_of_id(id_col: str = "doc_id") -> Column:
    """crc32 of the id written as text."""
    return F.crc32(F.col(id_col).cast("string"))

