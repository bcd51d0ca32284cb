"""Multi-line CSV read by many tasks, against Python's ``csv`` module."""

import csv
import os
import random
import tempfile

import pytest

from termweave.sources import io
from termweave.sources.csv_splits import read_csv_splits


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def _write(path, rows, header=("a", "b", "c"), end="\r\n", before=""):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, lineterminator=end)
        w.writerow(header)
        for r in rows:
            f.write(before)
            w.writerow(r)


def _dicts(paths):
    out = []
    for p in paths:
        with open(p, newline="", encoding="utf-8") as f:
            out += [{k: v or "" for k, v in r.items() if k is not None} for r in csv.DictReader(f)]
    return out


def _got(spark, path, cols=("a", "b", "c")):
    rows = io.read_csv_rows(spark, path, splits=True).orderBy("row_no").collect()
    assert [r["row_no"] for r in rows] == list(range(1, len(rows) + 1))
    return [{c: r[c] or "" for c in cols} for r in rows]


def _field(rnd):
    return "".join(rnd.choice(['"', "\n", ",", " ", "x", "yz", "é", "\n\n", '""', "term"]) for _ in range(rnd.randrange(12)))


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_over_many_splits(spark, small_splits, end):
    d = tempfile.mkdtemp(prefix="tw-csv-")
    rnd = random.Random(5)
    names = [os.path.join(d, f"{n}.csv") for n in ("one", "three", "two")]
    _write(names[0], [["k" + _field(rnd), _field(rnd), _field(rnd)] for _ in range(1500)], end=end)
    _write(names[1], [], end=end)  # a header alone
    _write(names[2], [["k", "long \n" * 3000, _field(rnd)], *[["k" + _field(rnd), "", _field(rnd)] for _ in range(400)]], end=end)
    assert spark.read.text(names[0]).rdd.getNumPartitions() > 5
    assert _got(spark, d) == _dicts(names)


def test_blank_lines_short_rows_and_empty_files(spark, small_splits):
    d = tempfile.mkdtemp(prefix="tw-csv-")
    p = os.path.join(d, "x.csv")
    _write(p, [["1", " a ", "z"], ["2", '"\n\n"', ""]], before="\n\r\n", end="\n")
    with open(p, "a", encoding="utf-8") as f:
        f.write("3\n4,b\n5,b,c,more")  # no newline at the end
    assert _got(spark, p) == _dicts([p])
    only = os.path.join(d, "only.csv")
    _write(only, [])
    assert _got(spark, only) == []


def test_equal_to_the_one_task_reader(spark, small_splits):
    d = tempfile.mkdtemp(prefix="tw-csv-")
    p = os.path.join(d, "x.csv")
    rnd = random.Random(7)
    _write(p, [["k" + _field(rnd), rnd.choice(["NA", "nan", "v"]), _field(rnd)] for _ in range(300)], end="\n")
    one = io.read_csv_pandas(spark, p)
    many = io.read_csv_pandas(spark, p, splits=True)
    assert one.columns == many.columns
    assert sorted(map(repr, one.collect())) == sorted(map(repr, many.collect()))
    assert io.read_csv_rows(spark, p, ["c", "nosuch"], splits=True).columns == ["row_no", "c", "nosuch"]


def _split_rows(spark, path, **how):
    return sorted(map(repr, read_csv_splits(spark, path, io.CSV_READ_OPTIONS, **how).collect()))


def test_rows_of_splits_not_broadcast(spark, small_splits):
    """Beyond the broadcast limit the lines are joined with their splits: the same rows."""
    d = tempfile.mkdtemp(prefix="tw-csv-")
    rnd = random.Random(9)
    for name in ("x", "y"):
        _write(os.path.join(d, f"{name}.csv"), [["k", _field(rnd), "many \n" * rnd.choice([1, 2000])] for _ in range(200)])
    assert _split_rows(spark, d) == _split_rows(spark, d, broadcast_bytes=0)


def test_records_are_not_shuffled_as_lines(spark, small_splits):
    """Only pieces of records that cross splits go through an exchange: none above the scan of lines."""
    d = tempfile.mkdtemp(prefix="tw-csv-")
    _write(os.path.join(d, "x.csv"), [["k", "a\nb", "c"] for _ in range(2000)])
    plan = read_csv_splits(spark, d, io.CSV_READ_OPTIONS)._jdf.queryExecution().executedPlan().toString()
    scans = [i for i, s in enumerate(plan.splitlines()) if "FileScan text" in s]
    depth = [len(s) - len(s.lstrip(" :+-*()0123456789")) for s in plan.splitlines()]
    assert len(scans) == 1
    above, level = [], depth[scans[0]]
    for i in range(scans[0], -1, -1):
        if depth[i] < level:
            level = depth[i]
            above.append(plan.splitlines()[i])
    assert any("MapInArrow" in s for s in above) and not any("Exchange hash" in s or "Exchange range" in s for s in above)


def test_unclosed_quote_and_header_over_splits(spark, small_splits):
    d = tempfile.mkdtemp(prefix="tw-csv-")
    p = os.path.join(d, "x.csv")
    wide = "a\n" * 5000
    _write(p, [["1", "x", "y"], ["2", "\n" * 9000, "z"], ["3", "", "\n"]], header=("k", wide, "c"), end="\n")
    rows = read_csv_splits(spark, p, io.CSV_READ_OPTIONS).orderBy("row_no").collect()
    assert [(r["row_no"], r["k"], r[wide] or "", r["c"]) for r in rows] == [
        (1, "1", "x", "y"), (2, "2", "\n" * 9000, "z"), (3, "3", "", "\n")]
    with open(p, "w", encoding="utf-8") as f:
        f.write('k,b\n1,x\n2,"never\n' + "closed, \n" * 3000)
    rows = read_csv_splits(spark, p, io.CSV_READ_OPTIONS).orderBy("row_no").collect()
    assert [r["row_no"] for r in rows] == [1, 2] and rows[0]["b"] == "x" and "never" in rows[1]["b"]
