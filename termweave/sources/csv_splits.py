"""CSV with quoted newlines, read by many tasks (SRC-1 / SRC-2 at scale).

Spark reads a ``multiLine`` CSV file in one task, because a newline may stand inside quotes.  Here
the file is read as physical lines, in as many splits as its size asks for.  What a line is depends
on one bit, whether it starts inside a quoted field, and that bit is the parity of the quotes before
it in its file.  The lines of a split are read in order by one task, so a split needs one bit from
outside, and no line has to be shuffled to be numbered:

1. the first scan gives a row per split, which is written: its quotes, and for either state it may
   start in the number of records that start in it, its lines before the first of these, and those of
   the last one if that is still open at the end;
2. prefix sums over these rows, within the file, tell every split its true state and the number of
   records before it; the files (one row each) get theirs in the order of their paths;
3. the second scan joins every line with its split's row and puts together the records that start and
   end in one split;
4. a record that crosses splits is put together from the pieces of the first scan; only these are
   shuffled.  ``from_csv`` parses both kinds.

The rows of splits go out with the tasks if their measured size allows it (``parallel.fits``).
Otherwise the lines are joined with them by split, sorted back into their order.

Defined results, as of ``csv.DictReader`` over each file: the first record of a file is its header;
blank lines between records are skipped; missing trailing fields are null, further ones are dropped;
a record may end in ``\\n`` or ``\\r\\n``.  A quote inside an unquoted field must not occur (RFC 4180):
use ``io.read_csv_rows`` for files that have such.  A quote that is never closed makes the rest
of its file one record, as with every CSV reader.  An empty file or a header alone gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termweave.operators import parallel
from termweave.session import scratch_path

_FILE, _SPLIT, _AT = "file", "split", "at"
_BEFORE = Window.unboundedPreceding, -1
_SUMMARY = ("file string, split long, quotes long, starts0 long, starts1 long, "
            "tail0 string, head1 string, tail1 string")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Physical lines with their file, split and order inside the split."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.file_block_start").alias(_SPLIT),
        F.monotonically_increasing_id().alias(_AT), "value")


def _runs(batches: Iterator, key: tuple[str, str]) -> Iterator:
    """(first, batch) for the stretches of one split in Arrow batches; ``first`` where a split begins.
    Its lines must come in their order."""
    import numpy as np
    import pyarrow.compute as pc

    last, at = None, -1
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(b.schema.get_field_index(k)) for k in key]
        new = np.zeros(b.num_rows, bool)
        for c in cols:
            new[1:] |= pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)
        cuts = [0, *np.flatnonzero(new).tolist(), b.num_rows]
        order = b.column(b.schema.get_field_index(_AT)).to_numpy()
        for lo, hi in zip(cuts, cuts[1:]):
            this = tuple(c[lo].as_py() for c in cols)
            first = this != last
            if (np.diff(order[lo:hi]) <= 0).any() or (not first and order[lo] <= at):
                raise ValueError(f"lines of {this} out of order")
            last, at = this, order[hi - 1]
            yield first, b.slice(lo, hi - lo)


def _states(run, before: int):
    """Lines of a run; whether a record would start at each if the split starts closed, or open;
    and the quotes up to its end, with ``before`` of earlier runs."""
    import numpy as np
    import pyarrow.compute as pc

    value = run.column(run.schema.get_field_index("value"))
    n = pc.count_substring(value, '"').to_numpy(zero_copy_only=False).astype(np.int64)
    odd = (before + np.cumsum(n) - n) % 2 == 1
    lines = value.to_pylist()
    blank = np.fromiter((s == "" or s == "\r" for s in lines), bool, len(lines))
    return lines, blank, odd, before + int(n.sum())


def _kept(lines: list[str], blank, is_open) -> tuple[list[str], list[int]]:
    """Lines without the blank ones between records, and the places of those that start one."""
    import numpy as np

    keep = is_open | ~blank
    kept = lines if keep.all() else [s for s, k in zip(lines, keep.tolist()) if k]
    return kept, np.flatnonzero(~is_open[keep]).tolist()


def _summaries(batches: Iterator) -> Iterator:
    import pyarrow as pa

    names = [f.split()[0] for f in _SUMMARY.split(", ")]
    now = None

    def row():
        odd = now["quotes"] % 2 == 1
        (n0, _, last0), (n1, head1, last1) = now["closed"], now["open"]  # an open one goes on in the next split
        pieces = last0 if odd else [], head1, [] if odd else last1
        text = ["\n".join(x) if x else None for x in pieces]
        cols = [now["file"], now["split"], now["quotes"], n0, n1, *text]
        return pa.RecordBatch.from_arrays(
            [pa.array([c], pa.string() if isinstance(c, str) or c is None else pa.int64()) for c in cols], names)

    for first, run in _runs(batches, (_FILE, _SPLIT)):
        if first:
            if now:
                yield row()
            now = {"file": run.column(0)[0].as_py(), "split": run.column(1)[0].as_py(), "quotes": 0,
                   "closed": [0, [], []], "open": [0, [], []]}
        lines, blank, odd, now["quotes"] = _states(run, now["quotes"])
        for name, is_open in (("closed", odd), ("open", ~odd)):
            side = now[name]  # records started, lines before the first, lines of the last
            kept, starts = _kept(lines, blank, is_open)
            if not starts:
                side[2 if side[0] else 1] += kept
                continue
            if not side[0]:
                side[1] += kept[:starts[0]]
            side[0] += len(starts)
            side[2] = kept[starts[-1]:]
    if now:
        yield row()


def _whole_records(batches: Iterator) -> Iterator:
    """(rec, row_no, text) of the records that start and end in one split."""
    import pyarrow as pa

    def out(rows):
        recs, nos, texts = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(recs, pa.int64()), pa.array(nos, pa.int64()), pa.array(texts, pa.string())], ["rec", "row_no", "text"])

    rec, files_before, quotes, held, opened = 0, 0, 0, None, False

    def ended():
        """The last record of a split, if no quote is open."""
        return [(rec, files_before + rec, "\n".join(held))] if held is not None and (quotes + opened) % 2 == 0 else []

    for first, run in _runs(batches, ("file_no", _SPLIT)):
        rows = []
        if first:
            rows += ended()
            quotes, held = 0, None
            rec, files_before, opened = (run.column(run.schema.get_field_index(c))[0].as_py() for c in ("r0", "f0", "open"))
        lines, blank, odd, quotes = _states(run, quotes)
        kept, starts = _kept(lines, blank, ~odd if opened else odd)
        if held is not None:
            held += kept[:starts[0]] if starts else kept
        for lo, hi in zip(starts, [*starts[1:], len(kept)]):
            if held is not None:
                rows.append((rec, files_before + rec, "\n".join(held)))
            rec, held = rec + 1, kept[lo:hi]
        if rows:
            yield out(rows)
    rows = ended()
    if rows:
        yield out(rows)


def _before(value: str, window) -> F.Column:
    return F.coalesce(F.sum(value).over(window.rowsBetween(*_BEFORE)), F.lit(0))


def _located(splits: DataFrame) -> DataFrame:
    """Rows of splits with ``open`` (state at the start), ``r0`` (records of the file that started
    before), ``starts``, ``file_no`` and ``f0`` (data records of earlier files)."""
    here = Window.partitionBy(_FILE).orderBy(_SPLIT)
    x = splits.withColumn("open", _before("quotes", here) % 2 == 1)
    x = x.withColumn("starts", F.when(F.col("open"), F.col("starts1")).otherwise(F.col("starts0")))
    x = x.withColumn("r0", _before("starts", here))
    files = x.groupBy(_FILE).agg(F.greatest(F.sum("starts") - 1, F.lit(0)).alias("n"))
    w = Window.orderBy(_FILE)  # a row per file
    files = files.select(_FILE, F.row_number().over(w).cast("long").alias("file_no"), _before("n", w).alias("f0"))
    return x.join(files, _FILE)


def _crossing(splits: DataFrame) -> DataFrame:
    """(rec, row_no, text) of the records that cross splits, from the pieces of the first scan."""
    head = F.when(F.col("open"), F.struct(F.col("r0").alias("rec"), F.lit(0).alias("last"), F.col("head1").alias("piece")))
    tail = F.struct((F.col("r0") + F.col("starts")).alias("rec"), F.lit(1).alias("last"),
                    F.when(F.col("open"), F.col("tail1")).otherwise(F.col("tail0")).alias("piece"))
    pieces = splits.select(_FILE, _SPLIT, "f0", F.explode(F.array(head, tail)).alias("p")).where("p.piece is not null")
    return (pieces.groupBy(_FILE, "f0", "p.rec")
            .agg(F.array_sort(F.collect_list(F.struct(_SPLIT, "p.last", "p.piece"))).alias("pieces"))
            .select("rec", (F.col("f0") + F.col("rec")).alias("row_no"),
                    F.array_join(F.transform("pieces", lambda e: e["piece"]), "\n").alias("text")))


def read_csv_splits(spark: SparkSession, path: str, options: dict[str, str], start: int = 1,
                    broadcast_bytes: int = parallel.BROADCAST_BYTES) -> DataFrame:
    """(row_no, columns of the header as strings): the data records of the CSV files under ``path``
    in the order of file paths and records, numbered from ``start``.  ``options`` are those of
    ``spark.read.csv``; all files have the header of the first one.  The first scan runs, and
    writes its row per split, when this is called."""
    header = spark.read.options(**options).csv(path).columns
    lines = _lines(spark, path)
    summary = scratch_path(spark, "csv-splits")
    lines.mapInArrow(_summaries, _SUMMARY).write.parquet(summary)
    splits = _located(spark.read.schema(_SUMMARY).parquet(summary))
    states = splits.select(_FILE, _SPLIT, "file_no", "open", "r0", "f0")
    if parallel.fits(states, broadcast_bytes):
        placed = lines.join(F.broadcast(states), [_FILE, _SPLIT])
    else:
        placed = (lines.join(states.hint("merge"), [_FILE, _SPLIT]).repartition("file_no", _SPLIT)
                  .sortWithinPartitions("file_no", _SPLIT, _AT))
    whole = placed.select("file_no", _SPLIT, _AT, "open", "r0", "f0", "value").mapInArrow(
        _whole_records, "rec long, row_no long, text string")
    schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in header)
    parsed = F.from_csv(F.regexp_replace("text", "\r\\z", ""), schema, {k: v for k, v in options.items() if k != "header"})
    return (whole.unionByName(_crossing(splits)).where("rec > 1")
            .select((F.col("row_no") - 2 + F.lit(start)).alias("row_no"), parsed.alias("__row"))
            .select("row_no", "__row.*"))
