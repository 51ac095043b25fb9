"""Catalogue entries for streams, the log relay, the keyed upsert table and
the scoring flows. Each runs its stream(s) to completion (available-now
trigger) into files under the shared workspace and returns the sink read back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import merge
from ..schemas import TableSpec, struct
from ..session import parallelism, scratch, workspace
from ..sources import files, keyed
from ..sources.folders import is_folder, matching
from ..sources.preview import stream_preview
from ..sources.tables import table
from ..streaming.progress import ProgressRows, finish
from ..streaming.recovery import CrashAfterWrite, supervise
from ..streaming.runner import (await_all, await_done, current_run_id, light_checkpoints, run_batches,
                                stop_queries)
from . import flows
from .bindings import (BATCH_FEATURES, HISTORY_FEATURES, HISTORY_ROWS_SQL, STREAM_ROWS_SQL,
                       history_rows, stream_rows)
from .catalogue import query
from .q_models import BANDED_SQL, HOUSE_LIKE_CATS, HOUSE_SLOTS, banded_bundle, banded_houses
from .split_sql import boosted

#: Intake bound of the rate-limited streams: records per file, one file per trigger.
INTAKE_ROWS = 4000

#: A rate-limited intake is dealt over lanes, streams side by side that each keep the bound:
#: one a core (two where a lane is a single stream at a time: a trigger's core waits while the
#: driver plans and commits), and no more than a driver plans for at a time.
MOST_LANES = 16

#: Small files that a scan packs into one task (``maxPartitionBytes`` / ``openCostInBytes``).
FILES_PER_TASK = 32


def table_stream(spark, sf_dir, name):
    """A driver table as a file stream, be it one file or a directory of part files."""
    schema = table(spark, sf_dir, name).schema
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if is_folder(spark, path):
        return files.stream_files(spark, path, schema, fmt="parquet")
    # the file source takes folders only: the one that holds the file, filtered to it
    return files.stream_files(spark, sf_dir, schema, fmt="parquet", options={"pathGlobFilter": f"{name}.parquet"})


def arrive_in_files(df, path, fmt="parquet", rows=INTAKE_ROWS):
    """Writes ``df`` as files of at most ``rows`` records, as a producer would drop them."""
    df.write.option("header", True).option("maxRecordsPerFile", rows).format(fmt).save(path)


def arrive_in_lanes(df, path, rows=INTAKE_ROWS, per_core=1):
    """As ``arrive_in_files``, the files dealt over folders ``lane=k``: a task's runs of
    ``rows`` records go to the lanes in turn. Returns the folders that got files."""
    spark = df.sparkSession
    run = F.floor(F.monotonically_increasing_id() % F.lit(1 << 33) / rows)
    lane = F.pmod(F.spark_partition_id() + run, F.lit(min(MOST_LANES, per_core * parallelism(spark))))
    df.withColumn("lane", lane).write.option("maxRecordsPerFile", rows).partitionBy("lane").parquet(path)
    found = sorted(matching(spark, f"{path}/lane=*"))
    if not found:   # no rows: a lane with the empty file
        found = [f"{path}/lane=0"]
        arrive_in_files(df, found[0])
    return found


def full_trigger(spark):
    """Files that keep every core busy for one wave of tasks: what a trigger without a rate
    limit of its own takes, so that triggers grow in number with the input by waves, not files."""
    return FILES_PER_TASK * parallelism(spark)


@query("stream_scan", ("S03", "T09"), sql="""
select event_id, user_id, upper(event_type) as event_type, coalesce(value, 0.0) * 2 as value2
from events""")
def stream_scan(spark, sf_dir):
    s = table_stream(spark, sf_dir, "events")
    t = s.select("event_id", "user_id", F.upper("event_type").alias("event_type"),
                 (F.coalesce("value", F.lit(0.0)) * 2).alias("value2"))
    out, ck = scratch(spark, "stream-scan"), scratch(spark, "ck")
    q = t.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck) \
        .trigger(availableNow=True).start()
    await_done(q)
    return spark.read.parquet(out)


_INTAKE_SQL = f"""
select count(*) as n_rows, count(distinct o_orderkey) as n_orders, sum(o_custkey) as custkeys,
  true as within_bound, count(*) > {INTAKE_ROWS} as several_batches from orders"""


def _intake(spark, streams):
    """Runs the streams side by side and reports what their batches took in."""
    out = scratch(spark, "rate-out")

    def lane(k):
        def write(df, epoch):
            df.write.mode("overwrite").parquet(f"{out}/lane={k}/epoch={epoch}")
        return write

    with light_checkpoints(spark, workspace(spark)):
        await_all([run_batches(s, lane(k), scratch(spark, "ck")) for k, s in enumerate(streams)])
    got = spark.read.parquet(out)
    sizes = got.groupBy("lane", "epoch").count().agg(F.max("count").alias("most"), F.count("*").alias("batches"))
    facts = got.agg(F.count("*").alias("n_rows"), F.count_distinct("o_orderkey").alias("n_orders"),
                    F.sum("o_custkey").alias("custkeys"))
    return facts.join(sizes, F.lit(True)).select(
        "n_rows", "n_orders", "custkeys", (F.col("most") <= INTAKE_ROWS).alias("within_bound"),
        (F.col("batches") > 1).alias("several_batches"))


@query("stream_rate_limit", ("T02",), sql=_INTAKE_SQL)
def stream_rate_limit(spark, sf_dir):
    """Files of a fixed size, one per trigger of a lane: no batch takes more than the bound."""
    src = scratch(spark, "orders-files")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return _intake(spark, [files.stream_files(spark, lane, o.schema, fmt="parquet", max_files_per_trigger=1)
                           for lane in arrive_in_lanes(o, src)])


@query("log_rate_limit", ("S05", "T02", "P13"), sql=_INTAKE_SQL)
def log_rate_limit(spark, sf_dir):
    """The same files relayed as messages, a log per lane, a file per trigger on both sides:
    every relay batch writes what it took in, so the reader's batches keep the bound."""
    src, log_path = scratch(spark, "orders-files"), scratch(spark, "log")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    logs = {f"{log_path}/{k}": lane for k, lane in enumerate(arrive_in_lanes(o, src, per_core=2))}
    with light_checkpoints(spark, workspace(spark)):
        await_all([flows.relay_to_log(files.stream_files(spark, lane, o.schema, fmt="parquet", max_files_per_trigger=1),
                                      log, scratch(spark, "ck")) for log, lane in logs.items()])
    schema = struct("o_orderkey bigint, o_custkey bigint, o_totalprice double")
    return _intake(spark, [flows.parse_log(spark, log, schema, max_per_trigger=1) for log in logs])


@query("stream_preview", ("S06", "T07", "T08"), sql="""
select event_id, user_id, event_type from events order by event_id limit 20""")
def stream_preview_q(spark, sf_dir):
    s = table_stream(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    path, ck = scratch(spark, "preview"), scratch(spark, "ck")
    q = stream_preview(s, ck, fmt="table", num_rows=20, order_by=["event_id"], path=path)
    await_done(q)
    stop_queries([q])
    return spark.read.parquet(path).drop("run", "epoch")


SCORE_SPEC = TableSpec(struct("id bigint, score double, source string"), "id", "scores")


def _upsert_step(path, key, value, source, spec=SCORE_SPEC):
    def step(df, epoch):
        reduced = merge.reduce_max(df.select(F.col(key).alias("id"), F.col(value).alias("score")),
                                   "id", ["score"]).withColumn("source", F.lit(source))
        keyed.upsert(reduced, path, spec, epoch, run_id=current_run_id(df.sparkSession))
    return step


def _two_runs(spark, sf_dir, path, ck_events=None, ck_orders=None):
    ck_events = ck_events or scratch(spark, "ck")
    ck_orders = ck_orders or scratch(spark, "ck")
    await_done(run_batches(table_stream(spark, sf_dir, "events"),
                           _upsert_step(path, "user_id", "value", "events"), ck_events))
    await_done(run_batches(table_stream(spark, sf_dir, "orders"),
                           _upsert_step(path, "o_custkey", "o_totalprice", "orders"), ck_orders))
    return ck_events, ck_orders


_LATEST_SQL = """
with a as (select user_id as id, max(value) as score, 'events' as source from events group by 1),
     b as (select o_custkey as id, max(o_totalprice) as score, 'orders' as source
           from orders group by 1)
select * from b
union all
select * from a where id not in (select id from b)"""


@query("stream_upsert_latest", ("S08", "S09", "K02", "K03", "F01"), sql=_LATEST_SQL)
def stream_upsert_latest(spark, sf_dir):
    path = scratch(spark, "scores")
    _two_runs(spark, sf_dir, path)
    return keyed.read_table(spark, path, SCORE_SPEC)


@query("stream_restart", ("T04", "G20", "G21"), sql=_LATEST_SQL)
def stream_restart(spark, sf_dir):
    path = scratch(spark, "scores")
    ck_e, ck_o = _two_runs(spark, sf_dir, path)
    # same checkpoints again: nothing new to process, nothing rewritten
    _two_runs(spark, sf_dir, path, ck_e, ck_o)
    # a fresh checkpoint for the orders stream: a new run rewrites the same values
    await_done(run_batches(table_stream(spark, sf_dir, "orders"),
                           _upsert_step(path, "o_custkey", "o_totalprice", "orders"),
                           scratch(spark, "ck")))
    return keyed.read_table(spark, path, SCORE_SPEC)


# --- scoring flows -------------------------------------------------------------------

HISTORY_SPEC = TableSpec(struct("id bigint, acctbal double, nation double"), "id", "history")
PREDICTION_SPEC = TableSpec(struct(
    "id bigint, totalprice double, order_year double, acctbal double, nation double, "
    "prediction double"), "id", "predictions")


def train_tutor_like(spark, sf_dir):
    """One-feature linear model on merged features (closed form in the oracle)."""
    merged = merge.merge_max(stream_rows(spark, sf_dir), history_rows(spark, sf_dir), "id",
                             BATCH_FEATURES, HISTORY_FEATURES, absent=0.0)
    label = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), (F.col("c_acctbal") / 1000.0).alias("acctbal_k"))
    return flows.train_linear(merged.join(label, "id"), ["totalprice"], "acctbal_k")


#: Orders arrive in portions of two calendar years, one micro-batch each.
PORTIONS, FIRST_YEAR = 4, 1995


def portion_of(date):
    return F.least(F.lit(PORTIONS - 1), F.greatest(F.lit(0), F.floor((F.year(date) - FIRST_YEAR) / 2))) \
        .cast("int")


_SCORED_SQL = f"""
with s as (select o_custkey as id, o_totalprice as totalprice, cast(year(o_orderdate) as double) as order_year,
             least({PORTIONS - 1}, greatest(0, cast(floor((year(o_orderdate) - {FIRST_YEAR}) / 2.0) as integer)))
               as portion from orders),
     last as (select id, max(portion) as portion from s group by id),
     b as (select s.id, max(totalprice) as totalprice, max(order_year) as order_year
           from s join last on last.id = s.id and last.portion = s.portion group by s.id),
     h as (select id, coalesce(acctbal, 0.0) as acctbal, coalesce(nation, 0.0) as nation
           from {HISTORY_ROWS_SQL} x),
     m as (select b.id, greatest(totalprice, 0.0) as totalprice, greatest(order_year, 0.0) as order_year,
                  greatest(0.0, coalesce(acctbal, 0.0)) as acctbal, greatest(0.0, coalesce(nation, 0.0)) as nation
           from b left join h on h.id = b.id),
     t as (select w.x, c.c_acctbal / 1000.0 as y
           from (select id, max(totalprice) as x from {STREAM_ROWS_SQL} r group by id) w
           join customer c on c.c_custkey = w.id),
     f as (select regr_slope(y, x) as b, regr_intercept(y, x) as a from t)
select id, totalprice, order_year, acctbal, nation,
       round(f.a + f.b * coalesce(totalprice, 0.0), 4) as prediction
from m cross join f"""


def _rounded(df, digits=4):
    return df.withColumn("prediction", F.round("prediction", digits))


_ROWS_SCHEMA = struct("id bigint, totalprice double, order_year double")


def _portions(spark, sf_dir, src):
    """Lets the orders arrive under ``src``, a portion at a time; yields after each."""
    o = table(spark, sf_dir, "orders").withColumn("portion", portion_of("o_orderdate"))
    for p in range(PORTIONS):
        o.where(F.col("portion") == p).select(
            F.col("o_custkey").alias("id"), F.col("o_totalprice").alias("totalprice"),
            F.year("o_orderdate").cast("double").alias("order_year")) \
            .write.mode("append").parquet(src)
        yield p


@query("score_with_history", ("S07", "S12", "S14", "T04", "T05", "T10", "T11", "C01", "C04"), sql=_SCORED_SQL)
def score_with_history(spark, sf_dir):
    """One checkpoint, one micro-batch per portion: the last batch that holds a key wins."""
    bundle = train_tutor_like(spark, sf_dir)
    hist_path, out_path = scratch(spark, "history"), scratch(spark, "predictions")
    flows.seed_history(history_rows(spark, sf_dir), hist_path, HISTORY_SPEC)
    step = flows.MergeScore(
        history=keyed.KeyedHistory(hist_path, HISTORY_SPEC),
        bundle=bundle, key="id", batch_features=BATCH_FEATURES,
        history_features=HISTORY_FEATURES, table_path=out_path, spec=PREDICTION_SPEC)
    src, ck = scratch(spark, "arrivals"), scratch(spark, "ck")
    for _ in _portions(spark, sf_dir, src):
        batch = files.stream_files(spark, src, _ROWS_SCHEMA, fmt="parquet")
        await_done(flows.score_with_history(batch, step, ck))
    return _rounded(keyed.read_table(spark, out_path, PREDICTION_SPEC))


@query("relay_then_score", ("S05", "C03", "P09", "P12"), sql=_SCORED_SQL)
def relay_then_score(spark, sf_dir):
    """The same through the message relay: each portion is published, then scored."""
    bundle = train_tutor_like(spark, sf_dir)
    hist_path, out_path = scratch(spark, "history"), scratch(spark, "predictions")
    flows.seed_history(history_rows(spark, sf_dir), hist_path, HISTORY_SPEC)
    step = flows.MergeScore(
        history=keyed.KeyedHistory(hist_path, HISTORY_SPEC), bundle=bundle, key="id",
        batch_features=BATCH_FEATURES, history_features=HISTORY_FEATURES,
        table_path=out_path, spec=PREDICTION_SPEC)
    src, log_path = scratch(spark, "arrivals"), scratch(spark, "log")
    relay_ck, score_ck = scratch(spark, "ck"), scratch(spark, "ck")
    for _ in _portions(spark, sf_dir, src):
        rows = files.stream_files(spark, src, _ROWS_SCHEMA, fmt="parquet")
        await_done(flows.relay_to_log(rows, log_path, relay_ck, fmt="json"))
        await_done(flows.score_with_history(flows.parse_log(spark, log_path, _ROWS_SCHEMA), step, score_ck))
    return _rounded(keyed.read_table(spark, out_path, PREDICTION_SPEC))


@query("stream_crash_replay", ("T04", "G21", "S08", "K02", "F01"), sql=_SCORED_SQL)
def stream_crash_replay(spark, sf_dir):
    """As ``score_with_history``, but every epoch dies after its write and before its
    commit; started again on the checkpoint it is replayed from the offset log."""
    bundle = train_tutor_like(spark, sf_dir)
    hist_path, out_path = scratch(spark, "history"), scratch(spark, "predictions")
    flows.seed_history(history_rows(spark, sf_dir), hist_path, HISTORY_SPEC)
    step = CrashAfterWrite(flows.MergeScore(
        history=keyed.KeyedHistory(hist_path, HISTORY_SPEC), bundle=bundle, key="id", batch_features=BATCH_FEATURES,
        history_features=HISTORY_FEATURES, table_path=out_path, spec=PREDICTION_SPEC))
    src, ck = scratch(spark, "arrivals"), scratch(spark, "ck")
    failed = 0
    for _ in _portions(spark, sf_dir, src):
        failed += supervise(lambda: flows.score_with_history(
            files.stream_files(spark, src, _ROWS_SCHEMA, fmt="parquet"), step, ck))
    if failed != len(step.attempts) or set(step.attempts.values()) != {2}:
        raise AssertionError(f"every epoch was to fail once and be replayed: {step.attempts}")
    return _rounded(keyed.read_table(spark, out_path, PREDICTION_SPEC))


ORDER_SPEC = TableSpec(struct("id bigint, totalprice double, prediction double"), "id", "order_scores")


@query("live_relay_and_score", ("T01", "T02", "T06", "T07", "T08", "S05", "C03", "C05"), sql=f"""
with t as (select o_orderkey as id, o_totalprice as totalprice from orders),
f as (select regr_slope(o_totalprice, o_custkey) as b, regr_intercept(o_totalprice, o_custkey) as a from orders),
s as (select id, round(a + b * o_custkey, 2) as prediction from t join orders on o_orderkey = id cross join f)
select q.query, (select count(*) from orders) as n_rows, true as within_bound,
  (select count(*) from orders) > {INTAKE_ROWS} as several_triggers,
  (select count(*) from s) as n_scored, (select round(sum(prediction), 0) from s) as predictions
from (values ('relay'), ('score')) q(query)""")
def live_relay_and_score(spark, sf_dir):
    """Relays and scorers, a pair per lane, live side by side on processing-time triggers, stopped
    when the last offset is through; a listener's rows tell what each trigger took in."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").cast("double")
                                              .alias("custkey"), F.col("o_totalprice").alias("totalprice"))
    bundle = flows.train_linear(o, ["custkey"], "totalprice")
    src, log_path, out = scratch(spark, "arrivals"), scratch(spark, "log"), scratch(spark, "order-scores")
    logs = {f"{log_path}/{k}": lane for k, lane in enumerate(arrive_in_lanes(o, src))}
    step = flows.ScoreOnly(bundle, "id", out, ORDER_SPEC,
                           output={"id": "id", "totalprice": "totalprice", "prediction": "predicted"}, small=True)
    names = {log: [f"{n}-{scratch(spark, 'q')[-12:]}" for n in ("relay", "score")] for log in logs}
    rows = ProgressRows(n for pair in names.values() for n in pair)
    relays, scorers = [], []
    spark.streams.addListener(rows)
    try:
        with light_checkpoints(spark, workspace(spark)):
            for log, lane in logs.items():
                relays.append(flows.relay_to_log(
                    files.stream_files(spark, lane, o.schema, fmt="parquet", max_files_per_trigger=1),
                    log, scratch(spark, "ck"), trigger="100 milliseconds", name=names[log][0]))
                scorers.append(flows.score_stream(flows.parse_log(spark, log, o.schema, max_per_trigger=1), step,
                                                  scratch(spark, "ck"), trigger="100 milliseconds", name=names[log][1]))
            finish([*relays, *scorers])
        for q in (*relays, *scorers):
            rows.wait_for(q)
    finally:
        stop_queries([*relays, *scorers])
        spark.streams.removeListener(rows)
    progress = rows.write(spark, scratch(spark, "progress")).where("n_rows > 0")
    scored = keyed.read_table(spark, out, ORDER_SPEC).agg(
        F.count("*").alias("n_scored"), F.round(F.sum(F.round("prediction", 2)), 0).alias("predictions"))
    return progress.groupBy(F.element_at(F.split("query", "-"), 1).alias("query")).agg(
        F.sum("n_rows").alias("n_rows"), (F.max("n_rows") <= INTAKE_ROWS).alias("within_bound"),
        (F.count("*") > 1).alias("several_triggers")).join(scored, F.lit(True))


@query("null_key_quarantine", ("P14", "G14", "T10"), sql="""
select o_totalprice as totalprice, cast(year(o_orderdate) as double) as order_year from orders where o_orderkey % 13 = 0""")
def null_key_quarantine(spark, sf_dir):
    """Stream rows without a key, kept aside by the scorer as data."""
    bundle = train_tutor_like(spark, sf_dir)
    hist_path, out_path = scratch(spark, "history"), scratch(spark, "predictions")
    flows.seed_history(history_rows(spark, sf_dir), hist_path, HISTORY_SPEC)
    step = flows.MergeScore(history=keyed.KeyedHistory(hist_path, HISTORY_SPEC), bundle=bundle, key="id",
                            batch_features=BATCH_FEATURES, history_features=HISTORY_FEATURES,
                            table_path=out_path, spec=PREDICTION_SPEC)
    src = scratch(spark, "arrivals")
    rows = stream_rows(spark, sf_dir)
    arrive_in_files(rows.select(F.when(F.col("o_orderkey") % 13 != 0, F.col("id")).alias("id"), "totalprice",
                                "order_year"), src)
    stream = files.stream_files(spark, src, _ROWS_SCHEMA, fmt="parquet", max_files_per_trigger=full_trigger(spark))
    await_done(flows.score_with_history(stream, step, scratch(spark, "ck")))
    return spark.read.parquet(f"{out_path}_quarantine").select("totalprice", "order_year")


_LINES = {
    "csv": """o_orderkey || ',' || o_custkey || ',' || case when o_orderkey % 10 = 3 then 'n/a' else
  cast(o_orderkey * 2 as {text}) end || case when o_orderkey % 10 = 7 then ',extra' else '' end""",
    "json": """'{{"o_orderkey":' || o_orderkey || ',"o_custkey":' || case when o_orderkey % 10 = 3 then '"n/a"' else
  cast(o_custkey as {text}) end || ',"amount":' || o_orderkey * 2 || case when o_orderkey % 10 = 7 then '' else '}}' end""",
}


@query("rejected_rows", ("S01", "S03", "P14", "G15", "T09"), sql=" union all ".join(f"""
select '{fmt}' as format, case when o_orderkey % 10 in (3, 7) then null else o_orderkey end as o_orderkey,
  case when o_orderkey % 10 in (3, 7) then null else o_custkey end as o_custkey,
  case when o_orderkey % 10 in (3, 7) then null else o_orderkey * 2 end as amount,
  case when o_orderkey % 10 in (3, 7) then {line.format(text="varchar")} end as raw from orders"""
                                                                                for fmt, line in _LINES.items()))
def rejected_rows(spark, sf_dir):
    """CSV and JSON lines, some malformed: good rows and the raw text of the others, by two
    sinks of one stream; together they are the input."""
    schema = struct("o_orderkey bigint, o_custkey bigint, amount bigint")
    parts = []
    for fmt, line in _LINES.items():
        src, good, bad = scratch(spark, f"lines-{fmt}"), scratch(spark, "good"), scratch(spark, "rejected")
        table(spark, sf_dir, "orders").select(F.expr(line.format(text="string")).alias("value")) \
            .write.option("maxRecordsPerFile", INTAKE_ROWS).text(src)
        stream = files.stream_files(spark, src, schema, fmt=fmt, header=False,
                                    max_files_per_trigger=full_trigger(spark), rejected="_bad")

        def keep(df, epoch, good=good):
            df.write.mode("overwrite").parquet(f"{good}/epoch={epoch}")

        await_done(run_batches(stream, flows.RejectAside(keep, "_bad", bad), scratch(spark, "ck")))
        rows = spark.read.parquet(good).select(*schema.names, F.lit(None).cast("string").alias("raw"))
        parts.append(rows.unionByName(spark.read.parquet(bad).select("raw"), allowMissingColumns=True)
                     .select(F.lit(fmt).alias("format"), "*"))
    return parts[0].unionByName(parts[1])


HOUSE_OUT_SPEC = TableSpec(struct("id bigint, prediction double"), "id", "price_predictions")


@query("score_stream_gbt", ("C02", "C05", "M07", "P01", "P07", "P14", "T09", "G14", "G15"),
       sql="with recursive " + boosted(BANDED_SQL, HOUSE_SLOTS, "o_totalprice", rounds=10, depth=5) + """,
s as (select case when o_orderstatus = 'P' and o_orderpriority = '1-URGENT' then 0 else o_orderkey end as id, prediction
      from orders join boosted on boosted.id = o_orderkey)
select id, round(max(prediction), 2) as prediction from s group by id""")
def score_stream_gbt(spark, sf_dir):
    """The house flow on three categories and two numbers with gaps: trees of ten rounds
    score a stream of CSV rows in which ids and numbers arrive as text."""
    train = banded_houses(spark, sf_dir)
    bundle = banded_bundle(spark, sf_dir)
    src = scratch(spark, "house-csv")
    no_id = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")
    arrive_in_files(train.select(
        F.when(no_id, F.lit(None)).otherwise(F.col("o_orderkey")).cast("string").alias("o_orderkey"),
        *HOUSE_LIKE_CATS, F.coalesce(F.col("c_acctbal").cast("string"), F.lit("NA")).alias("c_acctbal"),
        "c_nationkey"), src, "csv", 8000)
    schema = struct("o_orderkey string, o_orderpriority string, o_orderstatus string, c_mktsegment string, "
                    "c_acctbal string, c_nationkey string")
    stream = files.stream_files(spark, src, schema, fmt="csv", max_files_per_trigger=full_trigger(spark))
    # the id is typed before its nulls are defaulted: text that is no number has no id
    cleaned = flows.clean_stream(stream, {"o_orderkey": "bigint", "c_acctbal": "double", "c_nationkey": "double"},
                                 {}, key="o_orderkey")
    out_path = scratch(spark, "price-predictions")
    step = flows.ScoreOnly(bundle, "o_orderkey", out_path, HOUSE_OUT_SPEC,
                           output={"id": "o_orderkey", "prediction": "predicted"})
    await_done(flows.score_stream(cleaned, step, scratch(spark, "ck")))
    return _rounded(keyed.read_table(spark, out_path, HOUSE_OUT_SPEC), 2)
