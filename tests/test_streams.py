from pyspark.sql import functions as F

from tidewell.operators import merge
from tidewell.plans import flows
from tidewell.schemas import TableSpec, struct
from tidewell.sources import files, keyed, log
from tidewell.streaming.runner import await_done, current_run_id, run_batches, stop_queries

SPEC = TableSpec(struct("id bigint, v double"), "id")


def test_upsert_replay_is_idempotent_and_latest_wins(spark, tmp):
    path = tmp("kt")
    a = spark.createDataFrame([(i, float(i)) for i in range(8)], "id bigint, v double")
    b = spark.createDataFrame([(i, float(i) * 10) for i in range(5, 13)], "id bigint, v double")
    keyed.upsert(a, path, SPEC, epoch=0, run_id="r1")
    keyed.upsert(b, path, SPEC, epoch=1, run_id="r1")
    keyed.upsert(b, path, SPEC, epoch=1, run_id="r1")      # replayed epoch
    assert keyed.read_slices(spark, path, SPEC).count() == 16
    got = {r.id: r.v for r in keyed.read_table(spark, path, SPEC).collect()}
    assert len(got) == 13 and got[4] == 4.0 and got[5] == 50.0 and got[12] == 120.0


def test_fresh_run_overrides_older_run(spark, tmp):
    path = tmp("kt")
    old = spark.createDataFrame([(1, 1.0)], "id bigint, v double")
    new = spark.createDataFrame([(1, 2.0)], "id bigint, v double")
    keyed.upsert(old, path, SPEC, epoch=5, run_id="run-a")
    keyed.upsert(new, path, SPEC, epoch=0, run_id="run-b")   # new checkpoint starts at 0
    assert keyed.read_table(spark, path, SPEC).first().v == 2.0


def test_read_missing_table_is_empty(spark, tmp):
    assert keyed.read_table(spark, tmp("none"), SPEC).count() == 0


def test_null_key_fails_write(spark, tmp):
    df = spark.createDataFrame([(None, 1.0)], "id bigint, v double")
    try:
        keyed.upsert(df, tmp("kt"), SPEC, epoch=0, run_id="r")
        raise AssertionError("expected failure")
    except Exception as e:
        assert "null key" in str(e)



def _csv(spark, path, rows, name):
    spark.createDataFrame(rows, "id string, age string").coalesce(1).write \
        .option("header", True).mode("overwrite").csv(f"{path}/{name}")


def test_stream_handles_empty_file_duplicates_and_restart(spark, tmp):
    src, out, ck = tmp("src"), tmp("out"), tmp("ck")
    spec = TableSpec(struct("id bigint, age double"), "id")
    _csv(spark, src, [("1", "3.0"), ("1", "5.0"), ("2", "x")], "a")
    _csv(spark, src, [], "b")                                   # header-only file
    schema = struct("id bigint, age double")
    seen = []

    def step(df, epoch):
        seen.append((epoch, current_run_id(df.sparkSession)))
        keyed.upsert(merge.reduce_max(df, "id", ["age"]), out, spec, epoch,
                     run_id=current_run_id(df.sparkSession))

    stream = files.stream_files(spark, f"{src}/*", schema, max_files_per_trigger=1)
    await_done(run_batches(stream, step, ck))
    got = {r.id: r.age for r in keyed.read_table(spark, out, spec).collect()}
    assert got == {1: 5.0, 2: None}
    n = len(seen)
    await_done(run_batches(stream, step, ck))                   # restart: nothing new
    assert len(seen) == n
    _csv(spark, src, [("2", "7.0")], "c")
    await_done(run_batches(stream, step, ck))                   # only the new file
    assert len(seen) == n + 1 and seen[-1][1] == seen[0][1] and seen[0][1] is not None
    # a fresh checkpoint is a new run
    await_done(run_batches(stream, step, tmp("ck")))
    assert seen[-1][1] not in (None, seen[0][1])
    assert {r.id: r.age for r in keyed.read_table(spark, out, spec).collect()}[2] == 7.0



def test_stream_equals_batch_when_keys_do_not_repeat(spark, tmp):
    # keys are split across files without repeating: the streamed merge equals the batch merge
    src, out = tmp("src"), tmp("out")
    base = spark.range(0, 600).select((F.col("id") % 200).alias("id"),
                                      (F.col("id") * 1.5).alias("a"))
    base.withColumn("part", (F.col("id") % 3)).coalesce(1).write.partitionBy("part").parquet(src)
    hist = spark.range(0, 300).select(F.col("id"), (F.col("id") - 100.0).alias("h"))
    train = base.withColumn("label", F.col("a") * 2)
    bundle = flows.train_linear(train, ["a"], "label")
    spec = TableSpec(struct("id bigint, a double, h double, prediction double"), "id")
    step = flows.MergeScore(history=lambda s: hist, bundle=bundle, key="id",
                            batch_features=["a"], history_features=["h"], table_path=out, spec=spec)
    stream = files.stream_files(spark, src, struct("id bigint, a double, part int"), fmt="parquet",
                                max_files_per_trigger=1)
    await_done(flows.score_with_history(stream, step, tmp("ck")))
    streamed = {r.id: tuple(r) for r in keyed.read_table(spark, out, spec).collect()}
    merged = merge.merge_max(base, hist, "id", ["a"], ["h"])
    batch = {r.id: (r.id, r.a, r.h, r.predicted) for r in bundle.score(merged).collect()}
    assert streamed.keys() == batch.keys()
    for k in batch:
        assert all(abs(x - y) < 1e-9 for x, y in zip(streamed[k], batch[k])), k



def test_merge_scorer_quarantines_null_keys(spark, tmp):
    src, out = tmp("src"), tmp("out")
    spark.createDataFrame([(1, 2.0), (None, 5.0), (2, 3.0)], "id bigint, a double") \
        .coalesce(1).write.parquet(src)
    hist = spark.createDataFrame([(1, 10.0)], "id bigint, h double")
    train = spark.range(0, 50).select(F.col("id").cast("double").alias("a"),
                                      (F.col("id") * 2.0).alias("label"))
    bundle = flows.train_linear(train, ["a"], "label")
    spec = TableSpec(struct("id bigint, a double, h double, prediction double"), "id")
    step = flows.MergeScore(history=lambda s: hist, bundle=bundle, key="id", batch_features=["a"],
                            history_features=["h"], table_path=out, spec=spec, absent=None)
    stream = files.stream_files(spark, src, struct("id bigint, a double"), fmt="parquet")
    await_done(flows.score_with_history(stream, step, tmp("ck")))
    got = {r.id: r for r in keyed.read_table(spark, out, spec).collect()}
    assert set(got) == {1, 2} and got[1].h == 10.0 and got[2].h is None
    assert abs(got[1].prediction - 4.0) < 1e-6
    assert step.set_aside == 1
    aside = spark.read.parquet(f"{out}_quarantine")
    assert aside.count() == 1 and aside.first().a == 5.0





def test_external_store_path_with_parquet_stand_in(spark, tmp):
    from tidewell.sources import external
    store, src = tmp("store"), tmp("src")
    spec = TableSpec(struct("id bigint, a double, h double, prediction double"), "id")
    hist_spec = TableSpec(struct("id bigint, h double"), "id")
    spark.createDataFrame([(1, 10.0), (3, 30.0)], "id bigint, h double").write.parquet(store + "-h")
    found = external.lookup_store(spark, "parquet", {"path": store + "-h"}, hist_spec,
                                  spark.createDataFrame([(1,), (2,)], "id bigint"))
    assert [tuple(r) for r in found.collect()] == [(1, 10.0)]
    spark.createDataFrame([(1, 2.0), (2, 3.0)], "id bigint, a double").coalesce(1).write.parquet(src)
    train = spark.range(0, 20).select(F.col("id").cast("double").alias("a"),
                                      (F.col("id") * 2.0).alias("label"))
    step = flows.MergeScore(
        history=lambda s: external.read_store(s, "parquet", {"path": store + "-h"}, hist_spec),
        bundle=flows.train_linear(train, ["a"], "label"), key="id", batch_features=["a"],
        history_features=["h"], table_path="", spec=spec,
        writer=external.store_writer("parquet", {"path": store}, spec))
    stream = files.stream_files(spark, src, struct("id bigint, a double"), fmt="parquet")
    await_done(flows.score_with_history(stream, step, tmp("ck")))
    out = {r.id: r for r in spark.read.parquet(store).collect()}
    assert set(out) == {1, 2} and out[1].h == 10.0 and abs(out[2].prediction - 6.0) < 1e-6




def test_bytes_per_trigger_bounds_batches(spark, tmp):
    src = tmp("src")
    spark.range(0, 40000).repartition(8).write.parquet(src)
    one = min(f.stat().st_size for f in __import__("pathlib").Path(src.replace("file:", ""))
              .glob("*.parquet"))
    sizes = []
    s = files.stream_files(spark, src, struct("id bigint"), fmt="parquet",
                           max_bytes_per_trigger=2 * one + 1)
    await_done(run_batches(s, lambda df, e: sizes.append(df.count()), tmp("ck")))
    assert sum(sizes) == 40000 and len(sizes) >= 4


def _two(spark, a, b):
    return spark.createDataFrame([(a, b)], "id bigint, v double")


def test_latest_follows_the_order_of_writes_not_a_clock(spark, tmp):
    path = tmp("kt")
    keyed.upsert(_two(spark, 1, 11.0), path, SPEC, epoch=7, run_id="old-driver")
    keyed.upsert(_two(spark, 1, 999.0), path, SPEC, epoch=0, run_id="new-driver")
    assert keyed.read_table(spark, path, SPEC).first().v == 999.0
    keyed.upsert(_two(spark, 1, 5.0), path, SPEC, epoch=8, run_id="old-driver")   # it goes on
    assert keyed.read_table(spark, path, SPEC).first().v == 5.0
    keyed.upsert(_two(spark, 1, 12.0), path, SPEC, epoch=7, run_id="old-driver")  # an old replay
    assert keyed.read_table(spark, path, SPEC).first().v == 5.0


def test_partial_append_keeps_the_other_columns(spark, tmp):
    spec = TableSpec(struct("id bigint, a double, h double"), "id")
    path = tmp("kt")
    keyed.upsert(spark.createDataFrame([(1, 5.0, 6.0)], "id bigint, a double, h double"), path, spec, 0, "r")
    flows.seed_history(spark.createDataFrame([(1, 9.0)], "id bigint, h double"), path, spec)
    assert tuple(keyed.read_table(spark, path, spec).first()) == (1, 5.0, 9.0)
    keyed.upsert(spark.createDataFrame([(1, None, 2.0)], "id bigint, a double, h double"), path, spec, 1, "r")
    assert tuple(keyed.read_table(spark, path, spec).first()) == (1, None, 2.0)   # a null that was named


def test_seeding_twice_keeps_both(spark, tmp):
    path = tmp("kt")
    flows.seed_history(_two(spark, 1, 1.0), path, SPEC)
    flows.seed_history(_two(spark, 2, 2.0), path, SPEC)
    assert keyed.read_table(spark, path, SPEC).count() == 2


def test_upsert_needs_a_run_and_fitting_values(spark, tmp):
    import pytest
    with pytest.raises(ValueError):
        keyed.upsert(_two(spark, 1, 1.0), tmp("kt"), SPEC, 0, run_id="")
    with pytest.raises(RuntimeError):
        current_run_id(spark)
    small = TableSpec(struct("id int, v int"), "id")
    with pytest.raises(Exception, match="cannot hold"):
        keyed.upsert(spark.createDataFrame([(1, 3_000_000_000)], "id bigint, v bigint"), tmp("kt"), small, 0, "r")


def test_relay_carries_every_message_and_sets_malformed_ones_aside(spark, tmp):
    src, lg, out = tmp("src"), tmp("log"), tmp("out")
    rows = spark.range(0, 1000).select(F.col("id"), (F.col("id") * 0.5).alias("a"))
    rows.repartition(4).write.parquet(src)
    stream = files.stream_files(spark, src, struct("id bigint, a double"), fmt="parquet", max_files_per_trigger=2)
    parsed = flows.parse_log(spark, lg, struct("id bigint, a double"))      # before the first message
    await_done(flows.relay_to_log(stream, lg, tmp("ck")))
    sizes = []
    await_done(run_batches(parsed, lambda df, e: sizes.append(df.count()), tmp("ck")))
    assert sum(sizes) == 1000
    bad = spark.createDataFrame([(None, '{"id": 5, "a": 1.0}'), (None, "{broken")], log.MESSAGE_SCHEMA)
    bad_dir = tmp("log")
    bad.coalesce(1).write.parquet(bad_dir)
    train = spark.range(0, 20).select(F.col("id").cast("double").alias("a"), (F.col("id") * 2.0).alias("label"))
    spec = TableSpec(struct("id bigint, a double, h double, prediction double"), "id")
    step = flows.MergeScore(history=lambda s: s.createDataFrame([], "id bigint, h double"),
                            bundle=flows.train_linear(train, ["a"], "label"), key="id", batch_features=["a"],
                            history_features=["h"], table_path=out, spec=spec)
    await_done(flows.score_with_history(flows.parse_log(spark, bad_dir, struct("id bigint, a double")), step, tmp("ck")))
    assert keyed.read_table(spark, out, spec).count() == 1 and step.set_aside == 1


def test_live_relay_and_scorer_run_side_by_side(spark, tmp):
    """Processing-time triggers: both queries are active together, take in what
    arrives later, and are stopped by the caller; other queries go on."""
    import time
    src, lg, out = tmp("src"), tmp("log"), tmp("out")
    schema = struct("id bigint, a double")
    rows = spark.range(0, 40).select(F.col("id"), F.col("id").cast("double").alias("a"))
    rows.where("id < 20").coalesce(1).write.parquet(src)
    train = rows.withColumn("label", F.col("a") * 2)
    spec = TableSpec(struct("id bigint, a double, h double, prediction double"), "id")
    step = flows.MergeScore(history=lambda s: s.createDataFrame([], "id bigint, h double"),
                            bundle=flows.train_linear(train, ["a"], "label"), key="id", batch_features=["a"],
                            history_features=["h"], table_path=out, spec=spec)
    other = run_batches(files.stream_files(spark, src, schema, fmt="parquet"), lambda df, e: df.count(),
                        tmp("ck"), trigger="1 second")
    relay = flows.relay_to_log(files.stream_files(spark, src, schema, fmt="parquet"), lg, tmp("ck"),
                               trigger="1 second")
    scorer = flows.score_with_history(flows.parse_log(spark, lg, schema), step, tmp("ck"), trigger="1 second")
    try:
        def wait_for(n):
            end = time.time() + 90
            while keyed.read_table(spark, out, spec).count() < n and time.time() < end:
                assert relay.isActive and scorer.isActive
                time.sleep(1)
            assert keyed.read_table(spark, out, spec).count() == n
        wait_for(20)
        rows.where("id >= 20").coalesce(1).write.mode("append").parquet(src)
        wait_for(40)
        assert stop_queries([relay, scorer]) == 2
        assert not relay.isActive and not scorer.isActive and other.isActive
    finally:
        stop_queries([relay, scorer, other])


def test_table_as_a_directory_streams_all_rows(spark, tmp):
    from tests.conftest import SF_SMALL
    from tidewell.plans import q_streams
    sf = tmp("sf")
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    events.repartition(5).write.parquet(f"{sf}/events.parquet")
    assert q_streams.stream_scan(spark, sf).count() == events.count()


def test_waiting_has_no_limit_by_default():
    import inspect
    assert inspect.signature(await_done).parameters["timeout"].default is None


def test_bundle_saved_over_the_folder_it_reads_is_a_version_of_its_own(spark, tmp):
    from tidewell.operators import features as feat, models
    df = spark.range(0, 30).select((F.col("id") % 3).cast("string").alias("y"), F.col("id").cast("double").alias("x"))
    path = tmp("model")
    models.train(df, [feat.assemble(["x"]), models.linear()], "y", "rank").save(path)
    loaded = models.load(spark, path)
    assert loaded.save(path).endswith("/v=2") and loaded.score(df).count() == 30     # what it reads stays
    other = tmp("model")
    loaded.save(other)
    assert models.load(spark, path).score(df).count() == models.load(spark, other).score(df).count() == 30


def test_training_never_lowers_the_partition_count(spark):
    from tidewell.operators import features as feat, models
    seen = []

    class Probe:
        def __init__(self):
            self.stages = [feat.assemble(["x"]), models.linear()]

    df = spark.range(0, 200, numPartitions=16).select(F.col("id").cast("double").alias("x"), F.col("id").alias("y"))
    real = models.fit
    try:
        models.fit = lambda stages, d: (seen.append(d.rdd.getNumPartitions()), real(stages, d))[1]
        models.train(df, Probe().stages, "y", partitions=4)
        models.train(df.coalesce(1), Probe().stages, "y", partitions=4)
    finally:
        models.fit = real
    assert seen == [16, 4]


def test_workspace_needs_a_shared_folder_off_local_masters(spark, monkeypatch):
    import pytest
    from tidewell import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master, applicationId = "spark://host:7077", "app-x"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="checkpoint"):
        session.workspace(Session())
