"""Physical-plan properties that matter at scale, checked on the executed plans."""
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidewell.operators import features as feat, merge
from tidewell.plans.bindings import BATCH_FEATURES, HISTORY_FEATURES, history_rows, stream_rows


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_reduce_has_partial_aggregation(spark):
    p = plan_of(merge.reduce_max(stream_rows(spark, SF_SMALL), "id", BATCH_FEATURES))
    assert "partial_max" in p


def test_merge_reads_the_batch_once_and_prunes_the_history(spark):
    b, h = stream_rows(spark, SF_SMALL), history_rows(spark, SF_SMALL)
    m = merge.merge_max(b, h, "id", BATCH_FEATURES, HISTORY_FEATURES)
    p = m._jdf.queryExecution().sparkPlan().toString()
    assert p.count("FileScan parquet") == 2
    # only the needed columns reach the customer scan
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int,c_acctbal:double>" in p
    # the final aggregate uses the join's partitioning: one exchange a side at most
    assert plan_of(m).count("Exchange") <= 2


def test_pushed_filter_reaches_scan(spark):
    df = stream_rows(spark, SF_SMALL).where(F.col("o_orderkey") < 100)
    p = df._jdf.queryExecution().sparkPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderkey), LessThan(o_orderkey,100)]" in p


def test_frequency_index_uses_no_single_partition_window_over_data(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    idx = feat.frequency_index(li, "l_quantity")
    p = plan_of(idx)
    # the only window is over one row per partition, joined back by broadcast
    assert "BroadcastHashJoin" in p
    assert idx.count() == li.select("l_quantity").distinct().count()


def test_rank_label_is_a_join_the_planner_chooses(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    labelled = feat.rank_label(li, "l_quantity", feat.frequency_index(li, "l_quantity"))
    assert "LeftOuter" in labelled._jdf.queryExecution().sparkPlan().toString()
    assert labelled.where("label is null").count() == 0 and labelled.count() == li.count()


def test_hot_history_key_is_split_by_aqe(spark):
    """A key holding a third of the history rows: with the key set too large to
    broadcast, the semi join is a sort-merge join whose skewed partition AQE
    splits at run time (no salting needed, nothing dropped)."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n = 30000
        hist = spark.range(0, n).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("id"),
            F.col("id").cast("double").alias("h"))
        keys = spark.range(0, n, 2).select("id")
        found = merge.lookup(hist, keys, "id")               # no measured count: no broadcast
        assert found.count() == hist.join(keys, "id", "left_semi").count()
        found.collect()
        final = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in final and "AQEShuffleRead skewed" in final
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_keyed_lookup_filters_before_a_hash_aggregate(spark, tmp):
    from tidewell.schemas import TableSpec, struct
    from tidewell.sources import keyed
    spec = TableSpec(struct("id bigint, v double"), "id")
    path = tmp("kt")
    keyed.upsert(spark.range(0, 100).select("id", F.col("id").cast("double").alias("v")),
                 path, spec, 0, "r")
    got = keyed.lookup(spark, path, spec, spark.createDataFrame([(5,)], "id bigint"))
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert "HashAggregate" in plan and "LeftSemi" in plan and "SortAggregate" not in plan
    # tree strings list parents first: the aggregate must sit above the semi join
    assert plan.index("HashAggregate") < plan.index("LeftSemi")
    assert [tuple(r) for r in got.collect()] == [(5, 5.0)]
