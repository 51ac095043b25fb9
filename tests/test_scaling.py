"""Work per trigger and per task: what must not grow with the input, on rows built here."""
import threading
import time
import uuid
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql.streaming import listener

from tidewell.operators import features as feat, models
from tidewell.plans import q_streams
from tidewell.schemas import TableSpec, struct
from tidewell.sources import files, keyed
from tidewell.streaming import runner
from tidewell.streaming.progress import ProgressRows, finish

SPEC = TableSpec(struct("id bigint, v double"), "id")


@pytest.fixture(scope="module")
def sf(spark):
    """Orders for three intake files, and customers."""
    from tidewell.session import scratch
    path = scratch(spark, "sf")
    spark.range(0, 9000, 1, 1).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 50).alias("o_custkey"),
        (F.col("id") * 1.5 + 1).alias("o_totalprice"), F.expr("timestamp '1995-03-01' + make_interval(0, 0, 0, cast(id % 900 as int))")
        .alias("o_orderdate"), F.when(F.col("id") % 3 == 0, "P").otherwise("F").alias("o_orderstatus"),
        F.when(F.col("id") % 5 == 0, "1-URGENT").otherwise("5-LOW").alias("o_orderpriority")) \
        .write.parquet(f"{path}/orders.parquet")
    spark.range(0, 50).select(
        F.col("id").alias("c_custkey"), (F.col("id") * 100.0).alias("c_acctbal"), (F.col("id") % 25).alias("c_nationkey"),
        F.when(F.col("id") % 2 == 0, "AUTOMOBILE").otherwise("BUILDING").alias("c_mktsegment")) \
        .write.parquet(f"{path}/customer.parquet")
    return path


@pytest.fixture
def started(monkeypatch):
    """The queries that wait for their end, as they end."""
    done, wait = [], q_streams.await_done
    monkeypatch.setattr(q_streams, "await_done", lambda q, *a: done.append(q) or wait(q, *a))
    return done


def test_lanes_hold_all_rows_in_files_within_the_bound(spark, sf, tmp):
    orders = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey")
    lanes = q_streams.arrive_in_lanes(orders, path := tmp("lanes"))
    assert len(lanes) == 3
    got = spark.read.parquet(path).select("o_orderkey", F.input_file_name().alias("file"))
    assert sorted(r["count"] for r in got.groupBy("file").count().collect()) == [1000, 4000, 4000]
    assert got.select("o_orderkey").distinct().count() == got.count() == 9000
    assert len(q_streams.arrive_in_lanes(orders.limit(10), tmp("lanes"))) == 1
    assert len(q_streams.arrive_in_lanes(orders.limit(0), tmp("lanes"))) == 1


@pytest.mark.parametrize("name", ["stream_rate_limit", "log_rate_limit"])
def test_rate_limited_intake_runs_in_lanes(spark, sf, monkeypatch, name):
    started, run = [], q_streams.run_batches
    monkeypatch.setattr(q_streams, "run_batches", lambda *a, **k: started.append(1) or run(*a, **k))
    got = getattr(q_streams, name)(spark, sf).first()
    assert len(started) == 3
    assert got.asDict() == {"n_rows": 9000, "n_orders": 9000, "custkeys": 9000 // 50 * sum(range(50)),
                            "within_bound": True, "several_batches": True}


def test_live_relay_and_score_runs_in_lanes(spark, sf, monkeypatch):
    live, finish = [], q_streams.finish
    monkeypatch.setattr(q_streams, "finish", lambda queries: live.extend(queries) or finish(queries))
    got = {r.query: r for r in q_streams.live_relay_and_score(spark, sf).collect()}
    assert len(live) == 6 and not any(q.isActive for q in live)
    assert set(got) == {"relay", "score"}
    assert all(r.n_rows == 9000 and r.within_bound and r.several_triggers and r.n_scored == 9000 for r in got.values())


def _report(batch, n_rows=10):
    return {"name": "q", "runId": uuid.UUID(int=1), "batchId": batch, "numInputRows": n_rows, "durationMs": {"triggerExecution": 5}}


def _reported(rows, batch):
    rows.onQueryProgress(SimpleNamespace(progress=SimpleNamespace(**_report(batch))))


def test_reports_that_come_late_are_waited_for(spark, tmp):
    rows = ProgressRows(["q"])
    late = threading.Thread(target=lambda: [(time.sleep(0.2), _reported(rows, b)) for b in range(8)])
    late.start()
    rows.wait_for(SimpleNamespace(name="q", runId=str(uuid.UUID(int=1)), recentProgress=[_report(7)]), seconds=0.7)   # 1.6 s in all
    late.join()
    assert sorted(r.batch for r in rows.write(spark, tmp("progress")).collect()) == [*range(8)]


def test_reports_that_were_dropped_are_taken_from_the_query(spark, tmp):
    rows, query = ProgressRows(["q"]), SimpleNamespace(name="q", runId=str(uuid.UUID(int=1)), recentProgress=[_report(b) for b in range(2, 6)])
    for b in (0, 1, 2, 4, 4):
        _reported(rows, b)
    rows.wait_for(query, seconds=0.1)
    assert sorted(r.batch for r in rows.write(spark, tmp("progress")).collect()) == [*range(6)]
    lost = ProgressRows(["q"])
    for b in (0, 2, 5):
        _reported(lost, b)
    with pytest.raises(TimeoutError, match="missing .1"):   # batch 1 is in neither
        lost.wait_for(query, seconds=0.1)


def test_a_report_builds_no_event_objects(spark, sf, tmp, monkeypatch):
    """One costs some seventy calls to the JVM: reports then fall behind the triggers."""
    def built(*a):
        raise AssertionError("an event object")
    monkeypatch.setattr(listener.QueryProgressEvent, "fromJObject", built)
    lane = q_streams.arrive_in_lanes(spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey"), tmp("lanes"))[0]
    rows = ProgressRows(["light"])
    spark.streams.addListener(rows)
    try:
        q = runner.run_batches(files.stream_files(spark, lane, struct("o_orderkey bigint"), fmt="parquet", max_files_per_trigger=1),
                               lambda df, epoch: df.count(), tmp("ck"), "100 milliseconds", "light")
        finish([q])
        rows.wait_for(q, seconds=10)
    finally:
        spark.streams.removeListener(rows)
    assert [(r.query, r.n_rows) for r in rows.write(spark, tmp("progress")).collect()] == [("light", 4000)]


def test_checkpoints_on_a_local_disk_start_no_process_per_rename(spark, tmp):
    def manager():
        return spark.conf.get(runner._MANAGER, None)
    with runner.light_checkpoints(spark, tmp("ck")):
        with runner.light_checkpoints(spark, tmp("ck")):
            pass
        assert manager().endswith("FileSystemBasedCheckpointFileManager")
    assert manager() is None
    spark.conf.set(runner._MANAGER, "theirs")
    try:
        with runner.light_checkpoints(spark, tmp("ck")):
            assert manager() == "theirs"
        assert manager() == "theirs"
    finally:
        spark.conf.unset(runner._MANAGER)


def test_log_rate_limit_has_two_lanes_a_core(spark, sf, monkeypatch):
    started, run = [], q_streams.run_batches
    monkeypatch.setattr(q_streams, "parallelism", lambda spark: 1)
    monkeypatch.setattr(q_streams, "run_batches", lambda *a, **k: started.append(1) or run(*a, **k))
    got = q_streams.log_rate_limit(spark, sf).first()
    assert len(started) == 2 and got.n_rows == got.n_orders == 9000 and got.within_bound and got.several_batches


@pytest.mark.parametrize("name", ["live_relay_and_score", "log_rate_limit"])
def test_streams_of_small_triggers_have_light_checkpoints(spark, sf, monkeypatch, name):
    seen, publish = [], q_streams.flows.relay_to_log
    monkeypatch.setattr(q_streams.flows, "relay_to_log",
                        lambda *a, **k: seen.append(spark.conf.get("spark.sql.streaming.checkpointFileManagerClass", None)) or publish(*a, **k))
    getattr(q_streams, name)(spark, sf).collect()
    assert len(seen) == 3 and all("FileSystemBased" in (s or "") for s in seen)


@pytest.mark.parametrize("name, rows", [("rejected_rows", 18000), ("null_key_quarantine", 693), ("score_stream_gbt", None)])
def test_a_trigger_takes_many_files(spark, sf, started, name, rows):
    """No rate limit is the point of these: files that have arrived share a trigger."""
    got = getattr(q_streams, name)(spark, sf).count()
    assert started and all(q.lastProgress["batchId"] == 0 for q in started)
    assert rows is None or got == rows


def test_triggers_stay_bounded(spark, sf, started, monkeypatch):
    monkeypatch.setattr(q_streams, "full_trigger", lambda spark: 2)
    assert q_streams.rejected_rows(spark, sf).count() == 18000
    assert [q.lastProgress["batchId"] for q in started] == [1, 1]


def test_small_slice_is_one_file_and_found_by_key(spark, tmp):
    path = tmp("kt")
    rows = spark.range(0, 100).select("id", F.col("id").cast("double").alias("v"))
    keyed.upsert(rows, path, SPEC, epoch=0, run_id="r")
    for _ in range(2):                                           # the second is a replay
        keyed.upsert(rows.where("id < 60").withColumn("v", -F.col("v")), path, SPEC, epoch=1, run_id="r",
                     dedupe_rule="max", small=True)
    files = keyed.read_slices(spark, path, SPEC).where("epoch = 1").select(F.input_file_name()).distinct()
    assert files.count() == 1
    got = {r.id: r.v for r in keyed.lookup(spark, path, SPEC, spark.createDataFrame([(5,), (80,), (999,)], "id bigint")).collect()}
    assert got == {5: -5.0, 80: 80.0}
    assert keyed.read_table(spark, path, SPEC).count() == 100


def test_training_partitions_follow_the_rows(spark, monkeypatch):
    seen, fit = [], models.fit
    monkeypatch.setattr(models, "fit", lambda stages, df: seen.append(df.rdd.getNumPartitions()) or fit(stages, df))
    monkeypatch.setattr(models, "PARTITION_ROWS", 50, raising=False)
    df = spark.range(0, 390, 1, 1).select(F.col("id").cast("double").alias("x"), (F.col("id") * 2.0).alias("y"))
    models.train(df, [feat.assemble(["x"]), models.linear()], "y", partitions=2)
    models.train(df.limit(60), [feat.assemble(["x"]), models.linear()], "y", partitions=4)
    assert seen == [8, 4]


def test_index_of_few_labels_is_broadcast_whatever_its_estimated_size(spark, monkeypatch):
    rows = spark.range(0, 100).select((F.col("id") % 3).cast("string").alias("label"), (F.col("id") % 2).cast("double").alias("p"))
    index = feat.frequency_index(rows, "label").localCheckpoint()   # without the joins that numbered it
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def plans():
            return [df._jdf.queryExecution().executedPlan().toString()
                    for df in (feat.rank_label(rows, "label", index, n_labels=3), feat.unrank(rows, "p", index, "value", n_labels=3))]
        assert all("BroadcastHashJoin" in p for p in plans())
        monkeypatch.setattr(feat, "BROADCAST_LABELS", 2, raising=False)
        assert not any("BroadcastHashJoin" in p for p in plans())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
