"""Task counts and size checks.

A scan yields one task per file split (per parquet row group).  A text table stored as a
single large row group would push every narrow step after it into one task.  ``spread``
is for a bare scan only: it reads the number of splits, which needs the file listing and
no job, and hash-partitions by the row key when there are fewer than cores.  It must not
be given a frame that already has an exchange: counting that one's partitions would run it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PER_CORE = 2
BROADCAST_BYTES = 64 << 20


def tasks(spark: SparkSession) -> int:
    """Tasks for an explicit repartition: the session's shuffle partitions, which are set
    from the input's size, and at least two per core."""
    return max(PER_CORE * spark.sparkContext.defaultParallelism,
               int(spark.conf.get("spark.sql.shuffle.partitions")))


def spread(scan: DataFrame, key: str | None = None) -> DataFrame:
    n = tasks(scan.sparkSession)
    if scan.rdd.getNumPartitions() >= scan.sparkSession.sparkContext.defaultParallelism:
        return scan
    return scan.repartition(n, key) if key else scan.repartition(n)


def fits(df: DataFrame, most_bytes: int = BROADCAST_BYTES, most_rows: int | None = None) -> bool:
    """Whether a table may be broadcast: one small aggregate over its rows and the bytes
    of its string columns (other columns count 16 bytes)."""
    size = sum(((F.coalesce(F.octet_length(c), F.lit(0)) if t == "string" else F.lit(16)) for c, t in df.dtypes),
               F.lit(16))
    rows, held = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return held <= most_bytes and (most_rows is None or rows <= most_rows)
