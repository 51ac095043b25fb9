"""Catalogue entries for sources, cleaning, envelope and merge operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean, envelope, merge
from ..operators.evaluate import preview
from ..schemas import TableSpec, struct, tutor_history_table
from ..session import scratch
from ..sources import files
from ..sources.tables import table
from .bindings import (BATCH_FEATURES, HISTORY_FEATURES, HISTORY_ROWS_SQL, STREAM_ROWS_SQL,
                       history_rows, stream_rows)
from .catalogue import query

ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
_ORDERS_SQL = "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from orders"


def _orders_as_csv(spark, sf_dir, sep):
    path = scratch(spark, "orders-csv")
    table(spark, sf_dir, "orders").select(*ORDER_COLS).write.option("header", True) \
        .option("sep", sep).csv(path)
    return path


@query("csv_scan_cast", ("S01", "P01"), sql=_ORDERS_SQL)
def csv_scan_cast(spark, sf_dir):
    path = _orders_as_csv(spark, sf_dir, ",")
    raw = files.read_csv(spark, path, sep=",")  # every column is text
    return clean.cast_columns(raw, {"o_orderkey": "bigint", "o_custkey": "bigint",
                                    "o_totalprice": "double"})


@query("csv_scan_schema", ("S02",), sql=_ORDERS_SQL)
def csv_scan_schema(spark, sf_dir):
    path = _orders_as_csv(spark, sf_dir, ";")
    schema = struct("o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
                    "o_totalprice double, o_orderpriority string")
    return files.read_csv(spark, path, schema=schema, sep=";")


# The ten hand-made history rows of the tutor example
# (id, qualification, physics, chemistry, biology, english, geography, history).
SEED_HISTORY = [
    (10000, 1.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0),
    (10001, 2.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0),
    (10002, 1.0, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0),
    (10003, 3.0, 1.0, 0.0, 1.0, 0.0, 0.0, 0.0),
    (10004, 3.0, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0),
    (10005, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0),
    (10006, 1.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0),
    (10007, 1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0),
    (10008, 2.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0),
    (10009, 3.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0),
]
SEED_COLUMNS = ["id", "qualification", "physics", "chemistry", "biology", "english",
                "geography", "history"]

_SEED_VALUES_SQL = ",\n".join(
    "(" + ", ".join(str(v) for v in row) + ")" for row in SEED_HISTORY)


@query("literal_rows", ("S13", "S14"), sql=f"""
select cast(c_custkey as int) as id, cast(null as float) as age,
  cast(null as float) as years_of_experience, cast(null as float) as lesson_price,
  cast(c_nationkey % 4 as float) as qualification, cast(c_acctbal as float) as physics,
  cast(null as float) as chemistry, cast(null as float) as biology,
  cast(null as float) as english, cast(null as float) as geography,
  cast(null as float) as history
from customer
union all
select cast(id as int), cast(null as float), cast(null as float), cast(null as float),
  cast(q as float), cast(p as float), cast(c as float), cast(b as float), cast(e as float),
  cast(g as float), cast(h as float)
from (values {_SEED_VALUES_SQL}) as t(id, q, p, c, b, e, g, h)
""")
def literal_rows(spark, sf_dir):
    spec = tutor_history_table()
    stored = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), (F.col("c_nationkey") % 4).alias("qualification"),
        F.col("c_acctbal").alias("physics"))
    seed = files.literal_rows(spark, SEED_HISTORY, SEED_COLUMNS, spec)
    return files.append_rows(clean.conform(stored, spec, strict=False), seed)


@query("cast_bad_text_null", ("P01", "P05"), sql="""
select event_id, try_cast(substr(props, 7, 2) as integer) as k_int,
  try_cast(event_type as integer) as type_int,
  try_cast(substr(props, 7, 2) as bigint) as k_long
from events""")
def cast_bad_text_null(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(
        "event_id", F.substring("props", 7, 2).alias("k_int"),
        F.col("event_type").alias("type_int"), F.substring("props", 7, 2).alias("k_long"))
    return clean.cast_columns(e, {"k_int": "int", "type_int": "int", "k_long": "bigint"})


_HOLEY_CUSTOMER_SQL = """(select c_custkey,
  case when c_mktsegment = 'HOUSEHOLD' then null else c_acctbal end as acctbal,
  case when c_acctbal < 0 then null else c_nationkey end as nation,
  case when c_nationkey = 0 then null else c_mktsegment end as segment
from customer)"""


def _holey_customer(spark, sf_dir):
    # gaps follow the data: no balance on file for households, no nation for
    # overdrawn accounts, no segment for nation 0
    c = table(spark, sf_dir, "customer")
    return c.select(
        "c_custkey",
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit(None)).otherwise(F.col("c_acctbal"))
        .alias("acctbal"),
        F.when(F.col("c_acctbal") < 0, F.lit(None)).otherwise(F.col("c_nationkey")).alias("nation"),
        F.when(F.col("c_nationkey") == 0, F.lit(None)).otherwise(F.col("c_mktsegment"))
        .alias("segment"))


@query("fill_scalar", ("P06",), sql=f"""
select c_custkey, coalesce(acctbal, 0.0) as acctbal, coalesce(nation, 0) as nation, segment
from {_HOLEY_CUSTOMER_SQL}""")
def fill_scalar(spark, sf_dir):
    return clean.fill(_holey_customer(spark, sf_dir), 0)


@query("fill_by_column", ("P07", "M04"), sql=f"""
select c_custkey, coalesce(acctbal, 60.0) as acctbal, nation,
  coalesce(segment, 'UNKNOWN') as segment
from {_HOLEY_CUSTOMER_SQL}""")
def fill_by_column(spark, sf_dir):
    return clean.fill(_holey_customer(spark, sf_dir),
                      by_column={"acctbal": 60.0, "segment": "UNKNOWN"})


# pending urgent orders arrive without a customer key
def _no_customer():
    return (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")


@query("null_key_default", ("P14",), sql="""
select o_orderkey,
  coalesce(case when o_orderstatus = 'P' and o_orderpriority = '1-URGENT' then null
                else o_custkey end, 0) as id
from orders""")
def null_key_default(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(_no_customer(), F.lit(None)).otherwise(F.col("o_custkey")).alias("id"))
    return clean.null_key(o, "id", mode="default", default=0)


@query("null_key_drop", ("P14",), sql="""
select o_orderkey, o_custkey as id from orders
where not (o_orderstatus = 'P' and o_orderpriority = '1-URGENT')""")
def null_key_drop(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(_no_customer(), F.lit(None)).otherwise(F.col("o_custkey")).alias("id"))
    return clean.null_key(o, "id", mode="drop")


@query("conform_table", ("P02", "P03", "P04", "K01"), sql="""
select cast(o_custkey as integer) as id, o_totalprice as totalprice, o_orderstatus as status,
  cast(null as float) as discount
from orders""")
def conform_table(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("Status"), F.col("o_custkey").alias("ID"),
        F.col("o_totalprice").alias("TotalPrice"))
    spec = TableSpec(struct("id int, totalprice double, status string, discount float"), "id")
    return clean.conform(o, spec, strict=False)


@query("sql_text_projection", ("F03", "P03"), sql="""
select o_orderkey, upper(o_orderpriority) as priority, o_totalprice * 2 as doubled,
  cast(o_custkey as varchar) as cust_text
from orders""")
def sql_text_projection(spark, sf_dir):
    """Columns given as SQL text by the user, in a fixed order."""
    o = table(spark, sf_dir, "orders")
    return clean.select_exprs(o, ["o_orderkey", "upper(o_orderpriority) AS priority",
                                  "o_totalprice * 2 AS doubled",
                                  "CAST(o_custkey AS STRING) AS cust_text"])


@query("distinct_keys", ("A03",), sql="select distinct o_custkey as id from orders")
def distinct_keys(spark, sf_dir):
    return merge.keys(stream_rows(spark, sf_dir), "id")


@query("lookup_keys", ("J01", "P10"), sql=f"""
select * from {HISTORY_ROWS_SQL} h
where h.id in (select id from {STREAM_ROWS_SQL} b)""")
def lookup_keys(spark, sf_dir):
    batch_keys = merge.keys(stream_rows(spark, sf_dir), "id")
    return merge.lookup(history_rows(spark, sf_dir), batch_keys, "id")


@query("group_max_absent", ("A01", "A02", "P08"), sql=f"""
select id, max(totalprice) as totalprice, max(order_year) as order_year,
  cast(0.0 as double) as acctbal, cast(0.0 as double) as nation
from {STREAM_ROWS_SQL} b group by id""")
def group_max_absent(spark, sf_dir):
    return merge.reduce_max(stream_rows(spark, sf_dir), "id", BATCH_FEATURES,
                            absent=HISTORY_FEATURES, absent_value=0.0)


@query("union_rows", ("U01",), sql=f"""
select id, totalprice, order_year, cast(null as double) as acctbal, cast(null as double) as nation
from {STREAM_ROWS_SQL} b
union all
select id, cast(null as double), cast(null as double), acctbal, nation from {HISTORY_ROWS_SQL} h""")
def union_rows(spark, sf_dir):
    b = stream_rows(spark, sf_dir).select("id", *BATCH_FEATURES)
    h = history_rows(spark, sf_dir)
    return b.unionByName(h, allowMissingColumns=True)


_MERGE_SQL = """
with b as (select id, max(totalprice) as totalprice, max(order_year) as order_year
           from {batch} s group by id),
     h as (select id, {hfill} from {hist} x where id in (select id from b)),
     u as (select id, totalprice, order_year, {absent} as acctbal, {absent} as nation from b
           union all
           select id, {absent}, {absent}, acctbal, nation from h)
select id, max(totalprice) as totalprice, max(order_year) as order_year,
  max(acctbal) as acctbal, max(nation) as nation
from u group by id"""


@query("merge_features_max", ("J02", "U01", "A01", "A02", "A03", "J01", "P06", "T10", "T11"),
       sql=_MERGE_SQL.format(
           batch=STREAM_ROWS_SQL, hist=HISTORY_ROWS_SQL, absent="cast(0.0 as double)",
           hfill="coalesce(acctbal, 0.0) as acctbal, coalesce(nation, 0.0) as nation"))
def merge_features_max(spark, sf_dir):
    return merge.merge_max(stream_rows(spark, sf_dir), history_rows(spark, sf_dir), "id",
                           BATCH_FEATURES, HISTORY_FEATURES, absent=0.0)


@query("merge_features_nullsafe", ("J02",),
       sql=_MERGE_SQL.format(batch=STREAM_ROWS_SQL, hist=HISTORY_ROWS_SQL,
                             absent="cast(null as double)", hfill="acctbal, nation"))
def merge_features_nullsafe(spark, sf_dir):
    return merge.merge_max(stream_rows(spark, sf_dir), history_rows(spark, sf_dir), "id",
                           BATCH_FEATURES, HISTORY_FEATURES, absent=None)


_EVENTS_TEXT_SQL = ("'{' || event_id || ', ' || user_id || ', ' || event_type || '}'")


@query("encode_text", ("P08", "P09"), sql=f"""
select cast(null as varchar) as key, {_EVENTS_TEXT_SQL} as value, event_id as offset from events""")
def encode_text(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return envelope.encode(e, ["event_id", "user_id", "event_type"], fmt="text",
                           offset="event_id")


@query("encode_json", ("P09",), sql="""
select cast(null as varchar) as key,
  cast(to_json(struct_pack(event_id := event_id, user_id := user_id, event_type := event_type,
                           props := props)) as varchar) as value,
  event_id as offset
from events""")
def encode_json(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return envelope.encode(e, ["event_id", "user_id", "event_type", "props"], fmt="json",
                           offset="event_id")


@query("decode_text", ("P11", "P12", "P13"), sql="""
select event_id, user_id, event_type, event_id as offset from events""")
def decode_text(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    log = envelope.encode(e, ["event_id", "user_id", "event_type"], fmt="text", offset="event_id")
    return envelope.decode(log, struct("event_id bigint, user_id bigint, event_type string"),
                           fmt="text")


@query("decode_json", ("P11", "P12", "P13", "G13"), sql="""
select doc_id, text, lang, doc_id as offset from documents""")
def decode_json(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    log = envelope.encode(d, ["doc_id", "text", "lang"], fmt="json", offset="doc_id")
    return envelope.decode(log, struct("doc_id bigint, text string, lang string"), fmt="json")


@query("preview_top", ("L01",), sql="""
select o_orderkey, o_custkey, o_totalprice from orders order by o_orderkey limit 20""")
def preview_top(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return preview(o, 20, order_by=["o_orderkey"])
