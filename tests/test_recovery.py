"""Crashes between a batch's write and its commit, progress as rows, the keyed table's
claims and pruning, rejected lines and the console preview."""
import os
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F

from tidewell.operators import merge
from tidewell.plans import flows
from tidewell.schemas import TableSpec, struct
from tidewell.sources import files, folders, keyed
from tidewell.sources.preview import stream_preview
from tidewell.streaming.progress import ProgressRows, finish
from tidewell.streaming.recovery import CrashAfterWrite, InjectedCrash, supervise
from tidewell.streaming.runner import await_done, current_run_id, run_batches

SPEC = TableSpec(struct("id bigint, score double"), "id", "scores")
ROWS = struct("id bigint, score double")


def _arrivals(spark, path, files_=4, rows=30):
    """Files in which keys repeat: the later file holds the larger value of an id."""
    spark.range(files_ * rows).select((F.col("id") % 40).alias("id"), F.col("id").cast("double").alias("score")) \
        .coalesce(1).write.option("maxRecordsPerFile", rows).parquet(path)
    return {x % 40: float(x) for x in range(files_ * rows)}


def _upsert(path):
    def step(df, epoch):
        keyed.upsert(merge.reduce_max(df, "id", ["score"]), path, SPEC, epoch, run_id=current_run_id(df.sparkSession))
    return step


@pytest.mark.parametrize("times", [1, 2])
def test_every_epoch_dies_after_its_write_and_is_replayed(spark, tmp, times):
    src, out, ck = tmp("src"), tmp("out"), tmp("ck")
    want = _arrivals(spark, src)
    seen = []

    def watched(df, epoch):
        seen.append((epoch, sorted(r.score for r in df.collect())))
        _upsert(out)(df, epoch)

    step = CrashAfterWrite(watched, times)
    start = lambda: run_batches(files.stream_files(spark, src, ROWS, fmt="parquet", max_files_per_trigger=1), step, ck)
    assert supervise(start) == 4 * times
    assert step.attempts == {e: times + 1 for e in range(4)}
    for e in range(4):        # the same rows each time
        rows = [x for n, x in seen if n == e]
        assert len(rows) == times + 1 and all(x == rows[0] for x in rows)
    assert {r.id: r.score for r in keyed.read_table(spark, out, SPEC).collect()} == want
    assert keyed.read_slices(spark, out, SPEC).select("seq", "epoch").distinct().count() == 4   # one slice an epoch
    assert supervise(start) == 0 and len(seen) == 4 * (times + 1)                               # nothing left to do


def test_supervision_gives_up_in_the_end(spark, tmp):
    src = tmp("src")
    _arrivals(spark, src, files_=1)

    def broken(df, epoch):
        raise InjectedCrash("always")

    with pytest.raises(Exception, match="always"):
        supervise(lambda: run_batches(files.stream_files(spark, src, ROWS, fmt="parquet"), broken, tmp("ck")), most_failures=2)


def test_a_killed_process_leaves_a_replayable_epoch(spark, tmp):
    """A whole driver ends (no handler runs) after the second epoch's write."""
    src, out, ck = tmp("src"), tmp("out"), tmp("ck")
    want = _arrivals(spark, src)
    code = textwrap.dedent(f"""
        import os, sys
        sys.path.insert(0, {os.getcwd()!r})
        from tidewell.session import build_session
        from tests.test_recovery import ROWS, _upsert
        from tidewell.sources import files
        from tidewell.streaming.runner import await_done, run_batches
        spark = build_session(master="local[2]", shuffle_partitions=2, extra={{"spark.driver.memory": "1g"}})
        def step(df, epoch):
            _upsert({out!r})(df, epoch)
            if epoch == 1:
                os._exit(9)
        await_done(run_batches(files.stream_files(spark, {src!r}, ROWS, fmt="parquet", max_files_per_trigger=1), step, {ck!r}))
        """)
    ended = subprocess.run([sys.executable, "-c", code], capture_output=True, timeout=240)
    assert ended.returncode == 9, ended.stderr[-2000:]
    assert sorted(r.epoch for r in keyed.read_slices(spark, out, SPEC).select("epoch").distinct().collect()) == [0, 1]
    epochs = []

    def step(df, epoch):
        epochs.append(epoch)
        _upsert(out)(df, epoch)

    await_done(run_batches(files.stream_files(spark, src, ROWS, fmt="parquet", max_files_per_trigger=1), step, ck))
    assert epochs == [1, 2, 3]
    assert {r.id: r.score for r in keyed.read_table(spark, out, SPEC).collect()} == want


def test_rows_set_aside_count_once_however_often_replayed(spark, tmp):
    src, out, ck = tmp("src"), tmp("out"), tmp("ck")
    spark.createDataFrame([(1, 1.0), (None, 2.0), (None, 3.0)], ROWS).coalesce(1).write.parquet(src)
    train = spark.range(9).select(F.col("id").cast("double").alias("score"), F.col("id").cast("double").alias("label"))
    spec = TableSpec(struct("id bigint, score double, h double, prediction double"), "id")
    step = flows.MergeScore(history=lambda s: s.createDataFrame([], "id bigint, h double"),
                            bundle=flows.train_linear(train, ["score"], "label"), key="id", batch_features=["score"],
                            history_features=["h"], table_path=out, spec=spec)
    crashing = CrashAfterWrite(step, 2)
    assert supervise(lambda: flows.score_with_history(files.stream_files(spark, src, ROWS, fmt="parquet"), crashing, ck)) == 2
    assert step.set_aside == 2 and spark.read.parquet(f"{out}_quarantine").count() == 2


def test_paths_take_the_scheme_of_the_default_file_system(spark, tmp):
    assert folders.qualified(spark, "/a/b") == "file:/a/b"
    assert folders.qualified(spark, "file:/x") == "file:/x"
    mounted = "fs.viewfs.mounttable.shared.link./data"
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set(mounted, "file:/tmp")
    try:
        assert folders.qualified(spark, "viewfs://shared/data/x") == "viewfs://shared/data/x"
    finally:
        conf.unset(mounted)


# -- keyed table ---------------------------------------------------------------------

def test_a_table_of_eighty_columns_takes_partial_appends(spark, tmp):
    wide = TableSpec(struct("id bigint, " + ", ".join(f"c{i} int" for i in range(80))), "id")
    path = tmp("wide")
    rows = spark.range(5).select("id", *[(F.col("id") * 100 + i).cast("int").alias(f"c{i}") for i in range(80)])
    keyed.upsert(rows, path, wide, 0, "a")
    keyed.upsert(rows.select("id", F.lit(-1).alias("c79"), F.lit(-2).alias("c3")).where("id < 2"), path, wide, 1, "a", strict=False)
    got = {r.id: r for r in keyed.read_table(spark, path, wide).collect()}
    assert (got[1].c0, got[1].c3, got[1].c78, got[1].c79) == (100, -2, 178, -1)
    assert (got[4].c3, got[4].c79) == (403, 479)


def test_two_writers_never_share_a_sequence_number(spark, tmp):
    path = tmp("t")
    one = spark.createDataFrame([(1, 1.0)], ROWS)
    keyed.upsert(one, path, SPEC, 0, "a")
    assert not folders.claim(spark, f"{path}/_claims/1") and folders.claim(spark, f"{path}/_claims/2")
    keyed.upsert(one.withColumn("score", F.lit(3.0)), path, SPEC, 0, "b")     # 2 is another process's
    keyed._KNOWN.clear()                                                      # as a new process would see it
    keyed.upsert(one.withColumn("score", F.lit(2.0)), path, SPEC, 0, "a")     # a replay keeps its number
    assert {(r.seq, r.run) for r in keyed.read_slices(spark, path, SPEC).collect()} == {(1, "a"), (3, "b")}
    assert [r.score for r in keyed.read_table(spark, path, SPEC).collect()] == [3.0]


def test_lookup_reads_only_the_buckets_of_its_keys(spark, tmp):
    path = tmp("t")
    for e in range(3):
        keyed.upsert(spark.range(4000).select("id", F.lit(float(e)).alias("score")), path, SPEC, e, "r")
    found = keyed.lookup(spark, path, SPEC, spark.createDataFrame([(7,), (7,)], "id bigint"))
    assert [(r.id, r.score) for r in found.collect()] == [(7, 2.0)]
    plan = found._jdf.queryExecution().executedPlan()
    assert "dynamicpruning" in plan.toString()
    scans = [p for p in _nodes(plan) if "FileSourceScan" in p.getClass().getSimpleName()]
    read = max(s.metrics().apply("numFiles").value() for s in scans)
    assert 0 < read <= 3 * 8 < len(keyed.read_slices(spark, path, SPEC).inputFiles())


def _nodes(plan):
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        yield from _nodes(plan.executedPlan())
    elif name.endswith("QueryStageExec"):
        yield from _nodes(plan.plan())
    else:
        yield plan
        children = plan.children()
        for i in range(children.size()):
            yield from _nodes(children.apply(i))


# -- progress, rejected lines, console -----------------------------------------------

def test_progress_rows_of_a_live_query(spark, tmp):
    src = tmp("src")
    _arrivals(spark, src)
    rows = ProgressRows(["watched"])
    spark.streams.addListener(rows)
    try:
        stream = files.stream_files(spark, src, ROWS, fmt="parquet", max_files_per_trigger=1)
        q = run_batches(stream, lambda df, e: df.count(), tmp("ck"), trigger="100 milliseconds", name="watched")
        other = run_batches(stream, lambda df, e: None, tmp("ck"), trigger="100 milliseconds", name="other")
        finish([q])
        rows.wait_for(q)
        assert other.isActive and not q.isActive
        other.stop()
    finally:
        spark.streams.removeListener(rows)
    got = rows.write(spark, tmp("progress")).where("n_rows > 0").orderBy("batch").collect()
    assert [(r.query, r.batch, r.n_rows) for r in got] == [("watched", e, 30) for e in range(4)]


def test_rejected_lines_keep_their_text(spark, tmp):
    src, bad, good = tmp("src"), tmp("bad"), tmp("good")
    lines = ["1,2.5", "x,1", "3", "4,5,6", "", "7,", '8,"a,b"']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(src)
    stream = files.stream_files(spark, src, ROWS, header=False, rejected="_bad")
    step = CrashAfterWrite(flows.RejectAside(lambda df, e: df.write.mode("overwrite").parquet(f"{good}/epoch={e}"), "_bad", bad))
    ck = tmp("ck")
    assert supervise(lambda: run_batches(stream, step, ck)) == 1
    assert sorted((r.id, r.score) for r in spark.read.parquet(good).select("id", "score").collect() if r.score) == [(1, 2.5)]
    rejected = sorted(r.raw for r in spark.read.parquet(bad).collect())
    assert rejected == ["3", "4,5,6", '8,"a,b"', "x,1"]
    assert spark.read.parquet(good).count() + len(rejected) == len(lines) - 1      # the blank line is no row
    batch = files.read_csv(spark, src, ROWS, header=False, rejected="_bad")
    assert sum(r._bad is not None for r in batch.collect()) == 4
    with pytest.raises(ValueError):
        files.read_csv(spark, src, ROWS, rejected="SCORE")


@pytest.mark.parametrize("truncate", [True, False])
def test_console_preview_prints_so_many_rows(spark, tmp, capfd, truncate):
    src = tmp("src")
    spark.range(30).select("id", F.lit("y" * 50).alias("text")).coalesce(1).write.parquet(src)
    stream = files.stream_files(spark, src, struct("id bigint, text string"), fmt="parquet")
    await_done(stream_preview(stream, tmp("ck"), num_rows=4, order_by=["id"], truncate=truncate))
    printed = capfd.readouterr().out
    assert printed.count("yyy") and printed.count("|") > 10
    assert [x for x in ("|  3|", "|3  |") if x in printed] and not [x for x in ("|  4|", "|4  |") if x in printed]
    assert ("y" * 50 in printed) == (not truncate)
