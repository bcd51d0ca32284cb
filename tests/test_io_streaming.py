"""Readers/writers, incremental streams and pluggable batch functions."""

import csv
import glob
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from termweave.functions import text as T
from termweave.operators import answering, corpus, evaluation, generation, mining, ordering, prompting
from termweave.sources import io
from termweave.streaming import incremental
from tests.conftest import SMALL


def _tmp():
    return tempfile.mkdtemp(prefix="tw-io-")


def test_csv_round_trip_matches_dictreader(spark):
    d = _tmp()
    src = os.path.join(d, "in.csv")
    rows = [{"index": "1", "English": " fever ", "Vietnamese": "sốt", "English Sentence": 'He said "hi"\nthen left.',
             "Vietnamese Sentence": ""}, {"index": "", "English": "NA", "Vietnamese": "x",
                                          "English Sentence": "a, b", "Vietnamese Sentence": "c"}]
    with open(src, "w", newline="", encoding="utf-8") as f:
        w = csv.DictWriter(f, fieldnames=list(rows[0]))
        w.writeheader()
        w.writerows(rows)
    df = io.read_csv_rows(spark, src).orderBy("row_no")
    got = [{k: (r[k] if r[k] is not None else "") for k in rows[0]} for r in df.collect()]
    assert got == rows
    assert [r["row_no"] for r in df.collect()] == [1, 2]
    na = io.read_csv_pandas(spark, src).orderBy("row_no").collect()
    assert na[1]["English"] is None and na[0]["Vietnamese Sentence"] is None
    out = os.path.join(d, "out")
    assert io.write_csv(df.drop("row_no"), out)
    back = []
    for p in sorted(glob.glob(os.path.join(out, "part-*.csv"))):
        with open(p, encoding="utf-8", newline="") as f:
            back += list(csv.DictReader(f))
    assert sorted(map(lambda r: r["index"], back)) == ["", "1"]
    assert {r["English Sentence"] for r in back} == {'He said "hi"\nthen left.', "a, b"}
    assert not io.write_csv(df.where(F.lit(False)), os.path.join(d, "empty"))
    assert not os.path.exists(os.path.join(d, "empty"))


def test_jsonl_keeps_nulls_and_unicode(spark):
    d = _tmp()
    df = spark.createDataFrame([(1, "điều", None)], "index bigint, s string, t string")
    io.write_jsonl(df, os.path.join(d, "log"))
    line = "".join(open(p, encoding="utf-8").read() for p in glob.glob(os.path.join(d, "log", "part-*.json"))).strip()
    assert json.loads(line) == {"index": 1, "s": "điều", "t": None}
    assert "điều" in line
    assert df.select(T.json_line("index", "s", "t")).first()[0] == '{"index":1,"s":"điều","t":null}'


def test_read_lines_keeps_positions(spark):
    d = _tmp()
    p = os.path.join(d, "a.txt")
    with open(p, "w", encoding="utf-8") as f:
        f.write("first\n\n  third  \n")
    got = [(r["line_no"], r["text"]) for r in io.read_lines(spark, p, drop_blank=True).orderBy("line_no").collect()]
    assert got == [(0, "first"), (2, "third")]


def test_write_lines_in_order(spark):
    d = _tmp()
    df = spark.createDataFrame([(i, f"l{i}") for i in range(50)], "line_no bigint, text string").repartition(5)
    io.write_lines(df, os.path.join(d, "out"), partitions=4)
    text = "".join(open(p, encoding="utf-8").read() for p in sorted(glob.glob(os.path.join(d, "out", "part-*"))))
    assert text.splitlines() == [f"l{i}" for i in range(50)]


def test_incremental_stream_equals_batch(spark):
    from termweave.plans.fixtures import Fixtures

    fx = Fixtures(spark, SMALL)
    sink, ck = incremental.scratch_paths(spark, "t")
    incremental.incremental_best_sentences(spark, SMALL, fx.terms(), fx.keywords(), sink, ck,
                                           glob="documents.parquet")
    batch = mining.best_sentences(fx.docs(), fx.terms(), fx.keywords())
    a = spark.read.parquet(sink).drop("epoch")
    assert a.exceptAll(batch).isEmpty() and batch.exceptAll(a).isEmpty()
    # A rerun finds nothing new: the checkpoint remembers the file.
    incremental.incremental_best_sentences(spark, SMALL, fx.terms(), fx.keywords(), sink, ck,
                                           glob="documents.parquet")
    assert spark.read.parquet(sink).count() == batch.count()


def test_append_batches(spark):
    d = _tmp()
    src = os.path.join(d, "in")
    os.makedirs(src)
    for i in range(3):
        with open(os.path.join(src, f"q{i}.json"), "w") as f:
            f.write(json.dumps({"id": f"q{i}", "question": "x", "options": {"A": "a"}, "question_type": "other"}) + "\n")
    sink, ck = incremental.scratch_paths(spark, "append")
    incremental.append_batches(spark, src, io.QUESTION_SCHEMA, lambda b: b.select("id"), sink, ck)
    assert sorted(r["id"] for r in spark.read.json(sink).collect()) == ["q0", "q1", "q2"]


def test_generation_rounds_and_resolution(spark):
    rows = spark.createDataFrame(
        [(1, "1", "fever", "sốt", "A fever came.", "Bị sốt."), (2, "x", "cough", "ho", "A cough.", "Ho.")],
        "row_no bigint, index string, English string, Vietnamese string, `English Sentence` string, "
        "`Vietnamese Sentence` string")
    acc = prompting.accepted(prompting.validation_reason(prompting.assign_index(rows)))
    calls = []

    def flaky(prompts):
        calls.append(len(prompts))
        return [(None, "LLM API error: busy") if "Ensure" not in p else (p.split("\n\n", 1)[-1].split(" ")[0] + " | e | sốt ho", "success")
                for p in prompts]

    att = generation.generate_with_retries(acc, flaky)
    assert att.count() == 4  # two rows x (failed first call + successful retry)
    res = {r["row_no"]: r for r in prompting.resolve_attempts(acc, att).collect()}
    assert res[1]["status"] == "success" and res[2]["status"] == "success"


def test_generator_that_raises_is_a_failed_attempt(spark):
    rows = spark.createDataFrame([(i, f"p{i}") for i in range(12)], "row_no bigint, p string")

    def fn(prompts):
        if "p3" in prompts:
            raise RuntimeError("quota")
        return [(x.upper(), "success") for x in prompts]

    got = generation.generate(rows, fn, "p", batch_size=1, parallelism=3).collect()
    assert sorted(r["row_no"] for r in got) == list(range(12))
    by = {r["row_no"]: r for r in got}
    assert by[3]["raw_response"] is None and by[3]["error"] == "LLM API error: quota"
    assert by[4]["raw_response"] == "P4"


def test_restarted_generation_reads_finished_rounds(spark):
    rows = spark.createDataFrame([(1, "1", "fever", "sốt", "A fever came.", "Bị sốt.")],
                                 "row_no bigint, index string, English string, Vietnamese string, "
                                 "`English Sentence` string, `Vietnamese Sentence` string")
    acc = prompting.accepted(prompting.validation_reason(prompting.assign_index(rows)))
    path = os.path.join(_tmp(), "attempts")
    first = generation.generate_with_retries(acc, generation.echo_generator, path=path).collect()

    def never(prompts):
        raise AssertionError("called again")

    again = generation.generate_with_retries(acc, never, path=path).collect()
    assert again == first and not any("called again" in (r["error"] or "") for r in again)


def test_replayed_epoch_is_not_written_twice(spark):
    sink = os.path.join(_tmp(), "sink")
    df = spark.range(5)
    for _ in range(2):
        df.write.mode("overwrite").parquet(incremental.epoch_path(sink, 0))
    df.write.mode("overwrite").parquet(incremental.epoch_path(sink, 1))
    assert spark.read.parquet(sink).count() == 10


def test_many_part_line_files_stay_aligned(spark):
    pairs = spark.range(4000).selectExpr("id as row_no", "concat('s', id, repeat('x', int(id % 97))) src",
                                         "concat('t', id) tgt").repartition(3)
    src, tgt = io.write_pair_files(pairs, os.path.join(_tmp(), "pairs"), partitions=8)
    z = corpus.zip_lines(io.read_lines(spark, src), io.read_lines(spark, tgt))
    assert z.count() == 4000 and corpus.check_aligned(z) == {"ok": 4000}
    wrong = z.where("regexp_extract(left_text, 's([0-9]+)', 1) <> substring(right_text, 2) "
                    "or line_no <> bigint(substring(right_text, 2))")
    assert wrong.isEmpty()
    compat = io.read_lines(spark, tgt, compat=True).orderBy("line_no").collect()
    assert [r["line_no"] for r in compat] == list(range(4000)) and compat[7]["text"] == "t7"


def test_csv_columns_are_taken_by_name(spark):
    src = os.path.join(_tmp(), "in.csv")
    with open(src, "w", encoding="utf-8") as f:
        f.write("POS,English,Vietnamese\nn,fever,sốt\n")
    got = io.read_csv_rows(spark, src, ["Vietnamese", "English", "Other"]).collect()
    assert [tuple(r) for r in got] == [(1, "sốt", "fever", None)]


def test_no_machine_local_checkpoints_on_a_cluster():
    from termweave.session import checkpoint_dir

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())


def test_translate_batches_keeps_order(spark):
    lines = spark.createDataFrame([(i, f"w{i}") for i in range(20)], "line_no bigint, text string")
    out = corpus.translate_batches(lines, lambda b: [s.upper() for s in b], batch_size=8)
    assert sorted((r["line_no"], r["text"]) for r in out.collect()) == [(i, f"W{i}") for i in range(20)]


def test_answer_questions_end_to_end(spark):
    q = spark.createDataFrame([("q1", "stem", {"A": "fever", "B": "cough"}, "multi_choice"),
                               ("q2", "stem", {"A": "fever"}, "other")],
                              "id string, question string, options map<string,string>, question_type string")
    ev = spark.createDataFrame([("q1", "A", "hot body")], "id string, opt_key string, evidence string")
    seen = []

    def fn(prompts):
        seen.extend(prompts)
        return [('{"selected_option": "B", "reasoning": "r"}', "success") for _ in prompts]

    a, rej = answering.answer_questions(q, ev, fn)
    got = {r["id"]: (r["prediction"], r["choice"]) for r in a.collect()}
    assert got == {"q1": ("B", "B"), "q2": ("", "")}
    assert rej.isEmpty()


def test_report_and_helpers(spark):
    scores = spark.createDataFrame([("baseline", 10.0, 5, 6), ("tuned", 12.5, 5, 6)],
                                   "system string, bleu double, sys_len bigint, ref_len bigint")
    rep = {r["system"]: r["delta"] for r in evaluation.evaluation_report(scores).collect()}
    assert rep == {"baseline": None, "tuned": 2.5}
    df = spark.range(10).withColumnRenamed("id", "k")
    assert [r["k"] for r in ordering.first_rows(df, "k", 3).collect()] == [0, 1, 2]
    assert ordering.slice_rows(df, "k", 2, 5).count() == 3
    t = spark.createDataFrame([(1, "fever", "sốt", "UNOBSERVED", "a long example text")],
                              "row_no bigint, English string, Vietnamese string, `English example` string, "
                              "`Vietnamese example` string")
    r = mining.to_prompt_input(mining.add_missing_columns(t)).first()
    assert r["English Sentence"] == "" and r["Vietnamese Sentence"] == "a long example text"


def test_incremental_stream_picks_up_new_files_only(spark):
    from termweave.plans.fixtures import Fixtures

    fx = Fixtures(spark, SMALL)
    src = os.path.join(_tmp(), "docs")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    cut = docs.agg(F.expr("percentile_approx(doc_id, 0.5)")).first()[0]
    docs.where(F.col("doc_id") <= cut).coalesce(1).write.parquet(os.path.join(src, "a"))
    sink, ck = incremental.scratch_paths(spark, "two-files")
    glob_ = "part-*.parquet"
    incremental.incremental_best_sentences(spark, os.path.join(src, "a"), fx.terms(), fx.keywords(), sink, ck,
                                           glob=glob_)
    first = spark.read.parquet(sink)
    assert first.count() > 0 and first.select(F.max("doc_id")).first()[0] <= cut
    # New data lands next to the old file; the next run processes only the new file.
    docs.where(F.col("doc_id") > cut).coalesce(1).write.parquet(os.path.join(src, "b"))
    for p in glob.glob(os.path.join(src, "b", "part-*.parquet")):
        os.link(p, os.path.join(src, "a", "part-new-" + os.path.basename(p)[5:]))
    incremental.incremental_best_sentences(spark, os.path.join(src, "a"), fx.terms(), fx.keywords(), sink, ck,
                                           glob=glob_)
    out = spark.read.parquet(sink)
    assert out.select("epoch").distinct().count() == 2
    batch = mining.best_sentences(fx.docs(), fx.terms(), fx.keywords())
    got = out.drop("epoch")
    assert got.exceptAll(batch).isEmpty() and batch.exceptAll(got).isEmpty()


def test_scan_positions_over_many_splits(spark):
    d = _tmp()
    p = os.path.join(d, "big.txt")
    with open(p, "w", encoding="utf-8") as f:
        for i in range(20000):
            f.write(f"line {i}\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        raw = spark.read.text(p)
        assert raw.rdd.getNumPartitions() > 5
        got = io.read_lines(spark, p).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted((r["line_no"], r["text"]) for r in got) == [(i, f"line {i}") for i in range(20000)]


def test_read_lines_compat_and_alignment_check(spark):
    d = _tmp()
    a, b = os.path.join(d, "a.txt"), os.path.join(d, "b.txt")
    with open(a, "w", encoding="utf-8") as f:
        f.write("one\n\nthree\nfour\n")
    with open(b, "w", encoding="utf-8") as f:
        f.write("uno\ndos\ntres\ncuatro\n")
    kept = {r["line_no"]: r["text"] for r in io.read_lines(spark, a, drop_blank=True).collect()}
    compat = {r["line_no"]: r["text"] for r in io.read_lines(spark, a, compat=True).collect()}
    assert kept == {0: "one", 2: "three", 3: "four"}
    assert compat == {0: "one", 1: "three", 2: "four"}  # the original's shift
    z = corpus.zip_lines(io.read_lines(spark, a, compat=True), io.read_lines(spark, b, compat=True))
    import pytest

    with pytest.raises(ValueError):
        corpus.check_aligned(z)
    ok = corpus.zip_lines(io.read_lines(spark, b), io.read_lines(spark, b))
    assert corpus.check_aligned(ok) == {"ok": 4}


@pytest.mark.parametrize("files", [1, 3])
def test_incremental_reads_a_table_that_is_a_folder(spark, tmp_path, files):
    from termweave.plans.fixtures import Fixtures

    fx = Fixtures(spark, SMALL)
    docs, terms, keywords = fx.docs(), fx.terms(), fx.keywords()
    docs.repartition(files).write.parquet(str(tmp_path / "in" / "documents.parquet"))
    docs.limit(3).write.parquet(str(tmp_path / "in" / "others.parquet"))
    sink, ckpt = incremental.scratch_paths(spark, f"folder{files}")
    incremental.incremental_best_sentences(spark, str(tmp_path / "in"), terms, keywords, sink, ckpt, glob="documents.parquet")
    got, want = spark.read.parquet(sink).drop("epoch"), mining.best_sentences(docs, terms, keywords)
    assert got.count() == want.count() > 0
    assert got.select(want.columns).exceptAll(want).isEmpty()
