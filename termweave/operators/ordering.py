"""WIN-1 / WIN-2 at scale: global running sums and dense row numbers without a
single-task window.

A window with ``orderBy`` and no ``partitionBy`` moves every row into one task.  Here
the keys alone are cut into buckets of the integer order key (``floor(key / bucket_size)``; at most
``bucket_size`` keys per bucket because keys are unique), per-bucket totals are summed
(map-side partial aggregation), the bucket table gets its exclusive prefix in two levels, and a
window *partitioned by bucket* finishes the sums, which are joined to the rows by key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termweave.operators.parallel import tasks
from termweave.session import scratch_path

DEFAULT_BUCKET = 100_000
MAX_BUCKETS = 10_000
DENSE_BUCKET = 4_096  # keys a bucket of dense keys, and buckets a group of the upper level
BUCKETS_PER_TASK = 4


def _bucket_column(df: DataFrame, key: str, bucket_size: int, max_buckets: int):
    """Bucket expression for ``key``: fixed-width ranges when the keys fill their range at least
    by half (unique keys then put about a bucket's width of rows in each), of at most
    ``bucket_size`` keys and so many that every task has a few, but at most ``max_buckets``;
    otherwise approximate-quantile ranges (sparse or clustered keys), which keep every bucket
    near ``rows / max_buckets`` rows.  One small aggregation job over the keys."""
    lo, hi, n = df.agg(F.min(key), F.max(key), F.count(key)).first()
    if lo is None:
        return F.lit(0), df
    span = hi - lo + 1
    width = max(min(bucket_size, -(-span // (BUCKETS_PER_TASK * tasks(df.sparkSession)))), -(-span // max_buckets))
    if width <= bucket_size or 2 * n >= span:
        return F.floor((F.col(key) - F.lit(lo)) / F.lit(width)), df
    from pyspark.ml.feature import Bucketizer

    probs = [i / max_buckets for i in range(1, max_buckets)]
    cuts = sorted(set(df.approxQuantile(key, probs, 1.0 / max_buckets)))
    splits = [float("-inf")] + [c for c in cuts if c not in (float("-inf"), float("inf"))] + [float("inf")]
    tmp = "__kd"
    b = Bucketizer(splits=splits, inputCol=tmp, outputCol="__bq")
    out = b.transform(df.withColumn(tmp, F.col(key).cast("double"))).drop(tmp)
    return F.col("__bq").cast("bigint"), out


def _sums_before(totals: DataFrame, group: str, order: str, value: str, out: str) -> DataFrame:
    """Per row of ``totals``: the sum of ``value`` over the earlier groups and, inside its own, over
    the earlier rows.  Two levels: only a row per group goes through the unpartitioned window."""
    earlier = Window.unboundedPreceding, -1
    groups = totals.groupBy(group).agg(F.sum(value).alias("__g"))
    starts = groups.select(group, F.coalesce(F.sum("__g").over(Window.orderBy(group).rowsBetween(*earlier)), F.lit(0))
                           .alias("__start"))
    inside = F.coalesce(F.sum(value).over(Window.partitionBy(group).orderBy(order).rowsBetween(*earlier)), F.lit(0))
    return (totals.withColumn("__inside", inside).join(starts, group)
            .withColumn(out, F.col("__start") + F.col("__inside")).drop("__start", "__inside"))


def prefix_sum(df: DataFrame, key: str, value, out: str,
               bucket_size: int | None = None, max_buckets: int = MAX_BUCKETS,
               dense_keys: bool = False) -> DataFrame:
    """Add ``out`` = inclusive running sum of ``value`` in ``key`` order (key unique,
    integer).  ``dense_keys``: the keys are dense positions (a file's row numbers), so
    fixed-width buckets are known to be bounded and the statistics job is skipped.

    Only the keys and values go through buckets and windows; the rows are joined to the sums by
    their key, so they are dealt over all tasks however few the buckets are."""
    v = F.col(value) if isinstance(value, str) else value
    b, group = "__bucket", "__group"
    narrow = df.select(key, v.cast("bigint").alias("__v"))
    if dense_keys:
        bucket, src = F.floor(F.col(key) / F.lit(bucket_size or DENSE_BUCKET)), narrow
    else:
        bucket, src = _bucket_column(narrow, key, bucket_size or DEFAULT_BUCKET, max_buckets)
    x = src.withColumn(b, bucket)
    totals = x.groupBy(b).agg(F.sum("__v").alias("__t")).withColumn(group, F.floor(F.col(b) / F.lit(DENSE_BUCKET)))
    offsets = _sums_before(totals, group, b, "__t", "__off").select(b, "__off")
    w = Window.partitionBy(b).orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    sums = x.join(offsets, b).select(key, (F.col("__off") + F.sum("__v").over(w)).alias(out))
    return df.join(sums, key, "left").select(*df.columns, out)


def scan_positions(df: DataFrame, out: str = "row_no", start: int = 0,
                   path: str = "_metadata.file_path", block: str = "_metadata.file_block_start") -> DataFrame:
    """WIN-2 at ingest: the position of each row in file order -- path, place in the file --
    without leaving the JVM.  Apply it directly to a file scan: a split is known by its
    file's path and the offset it starts at, and ``monotonically_increasing_id`` orders the
    rows inside it.  Spark deals splits out by size, so part files of one folder come in
    any order; the numbers follow the names.  Row counts per split give each split's offset in
    two levels (file, then split), and a window partitioned by split numbers its rows."""
    mid, p, b = "__mid", "__path", "__block"
    x = df.select("*", F.col(path).alias(p), F.col(block).alias(b)).withColumn(
        mid, F.monotonically_increasing_id())
    counts = x.groupBy(p, b).agg(F.count(F.lit(1)).alias("__n"))
    offsets = _sums_before(counts, p, b, "__n", "__off").select(p, b, "__off")
    w = Window.partitionBy(p, b).orderBy(mid)
    return (x.join(offsets, [p, b])
            .withColumn(out, F.col("__off") + F.row_number().over(w) - F.lit(1) + F.lit(start))
            .drop(mid, p, b, "__off"))


def rank_within(df: DataFrame, group: str, order: list, out: str, start: int = 1) -> DataFrame:
    """Dense position in ``order`` inside each ``group``, of any size: the global position less the
    group's first one."""
    spark = df.sparkSession
    path = scratch_path(spark, "rank-within")
    global_rank(df, [F.asc(group), *order], "__at").write.parquet(path)
    x = spark.read.parquet(path)
    firsts = x.groupBy(group).agg(F.min("__at").alias("__first"))
    return x.join(firsts, group).withColumn(out, F.col("__at") - F.col("__first") + F.lit(start)).drop("__at", "__first")


def global_rank(df: DataFrame, order: list, out: str, start: int = 1) -> DataFrame:
    """Dense position in any order without a single-task window: rows are range-partitioned,
    sorted and written to the shared folder with their partition's number; the partitions'
    counts (one row each) give offsets, and a window partitioned by that number finishes."""
    spark = df.sparkSession
    path = scratch_path(spark, "rank")
    (df.repartitionByRange(*order).sortWithinPartitions(*order)
     .withColumn("__part", F.spark_partition_id()).write.parquet(path))
    x = spark.read.parquet(path)
    offsets = x.groupBy("__part").agg(F.count(F.lit(1)).alias("__n")).select(
        "__part", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("__off"))
    place = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    return (x.join(F.broadcast(offsets), "__part")  # a row per partition
            .withColumn(out, F.col("__off") + place + F.lit(start - 1)).drop("__part", "__off"))


def dense_row_number(df: DataFrame, key: str, out: str = "row_no", start: int = 1,
                     bucket_size: int | None = None) -> DataFrame:
    """WIN-2: dense position in ``key`` order, from ``start``."""
    r = prefix_sum(df, key, F.lit(1), out, bucket_size)
    return r.withColumn(out, F.col(out) + F.lit(start - 1)) if start != 1 else r


def first_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    """LIM-1: the first ``n`` rows in ``key`` order (the testing-mode row cap of the
    original): a filter on the dense position, so no task merges them, however many."""
    return dense_row_number(df, key, "__pos", start=0).where(F.col("__pos") < n).drop("__pos")


def slice_rows(df: DataFrame, row_no: str, start: int = 0, end: int | None = None) -> DataFrame:
    """LIM-2/LIM-3: rows with dense position in ``[start, end)`` (``end`` None = all);
    ``row_no`` is a 0-based dense position (``dense_row_number(..., start=0)``)."""
    cond = F.col(row_no) >= start
    if end is not None:
        cond = cond & (F.col(row_no) < end)
    return df.where(cond)
