"""Catalogue entries for feature and model operators."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators import evaluate, features as feat, models
from ..operators.quantiles import QuantileFill
from ..operators.rank_stage import RankLabel, Unrank
from ..operators.wide_features import WideFeatures, vector_parts
from . import flows
from ..session import scratch
from ..sources.tables import table
from .catalogue import query
from .split_sql import boosted

# --- SQL fragments -----------------------------------------------------------


def _rank_sql(expr: str, source: str) -> str:
    """value -> 0-based rank by count desc, value asc (the oracle's frequency index)."""
    return f"""(select value, cnt as count, row_number() over (order by cnt desc, value) - 1 as idx
  from (select cast({expr} as varchar) as value, count(*) as cnt from {source}
        where {expr} is not null group by 1))"""


_QTY_INDEX = _rank_sql("l_quantity", "lineitem")


# --- frequency index, categorical index, one-hot, assemble, impute ------------

@query("frequency_index", ("M01", "A05", "W01"), sql=f"""
select value, count, idx as "index" from {_QTY_INDEX}""")
def frequency_index(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return feat.frequency_index(li, "l_quantity")


def _order_categories(spark, sf_dir):
    stages, vec = feat.categorical(["o_orderpriority", "o_orderstatus"])
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return models.fit(stages, o).transform(o)


@query("categorical_index", ("M01",), sql=f"""
select o.o_orderkey, cast(p.idx as double) as priority_index, cast(s.idx as double) as status_index
from orders o
join {_rank_sql('o_orderpriority', 'orders')} p on p.value = o.o_orderpriority
join {_rank_sql('o_orderstatus', 'orders')} s on s.value = o.o_orderstatus""")
def categorical_index(spark, sf_dir):
    t = _order_categories(spark, sf_dir)
    return t.select("o_orderkey", F.col("o_orderpriority__idx").alias("priority_index"),
                    F.col("o_orderstatus__idx").alias("status_index"))


@query("one_hot_slots", ("M02",), sql=f"""
select o.o_orderkey, cast(p.idx as integer) as priority_slot,
  cast((select count(distinct o_orderpriority) from orders) + 1 as integer) as priority_size
from orders o join {_rank_sql('o_orderpriority', 'orders')} p on p.value = o.o_orderpriority""")
def one_hot_slots(spark, sf_dir):
    t = _order_categories(spark, sf_dir)
    arr = vector_to_array("o_orderpriority__vec")
    return t.select("o_orderkey",
                    (F.array_position(arr, 1.0) - 1).cast("int").alias("priority_slot"),
                    F.size(arr).cast("int").alias("priority_size"))


@query("assemble_vector", ("M03",), sql=f"""
select c.c_custkey, c.c_acctbal as f0, cast(c.c_nationkey as double) as f1,
  cast(case when s.idx = 0 then 1.0 else 0.0 end as double) as f2,
  cast(case when s.idx = 4 then 1.0 else 0.0 end as double) as f6,
  cast((select count(distinct c_mktsegment) from customer) + 3 as integer) as width
from customer c join {_rank_sql('c_mktsegment', 'customer')} s on s.value = c.c_mktsegment""")
def assemble_vector(spark, sf_dir):
    c = table(spark, sf_dir, "customer").withColumn("nation", F.col("c_nationkey").cast("double"))
    stages, vec = feat.categorical(["c_mktsegment"])
    stages.append(feat.assemble(["c_acctbal", "nation", *vec]))
    out = models.fit(stages, c).transform(c)
    arr = vector_to_array("features")
    return out.select("c_custkey", arr[0].alias("f0"), arr[1].alias("f1"), arr[2].alias("f2"),
                      arr[6].alias("f6"), F.size(arr).cast("int").alias("width"))


def _holey_acctbal(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit(None))
                    .otherwise(F.col("c_acctbal")).alias("acctbal"))


@query("impute_mean", ("M04",), sql="""
select c_custkey, round(coalesce(acctbal, avg(acctbal) over ()), 6) as acctbal_imputed
from (select c_custkey, case when c_mktsegment = 'HOUSEHOLD' then null else c_acctbal end as acctbal
      from customer)""")
def impute_mean(spark, sf_dir):
    df = _holey_acctbal(spark, sf_dir)
    stage, outs = feat.impute(["acctbal"], strategy="mean")
    out = models.fit([stage], df).transform(df)
    return out.select("c_custkey", F.round(outs[0], 6).alias("acctbal_imputed"))


@query("impute_median", ("M04",), sql="""
with t as (select l_orderkey, l_linenumber, case when l_linenumber <> 3 then l_quantity end as quantity,
  case when l_linenumber <> 5 then l_extendedprice end as price from lineitem)
select l_orderkey, l_linenumber, coalesce(quantity, (select quantile_disc(quantity, 0.5) from t)) as quantity,
  coalesce(price, (select quantile_disc(price, 0.5) from t)) as price from t""")
def impute_median(spark, sf_dir):
    """The exact median as a stage: one column of many ties, one of nearly none."""
    df = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") != 3, F.col("l_quantity")).alias("q"),
        F.when(F.col("l_linenumber") != 5, F.col("l_extendedprice")).alias("p"))
    stage = QuantileFill(inputCols=["q", "p"], outputCols=["quantity", "price"])
    return models.fit([stage], df).transform(df).select("l_orderkey", "l_linenumber", "quantity", "price")


@query("wide_categories", ("M01", "M02", "M03"), sql=f"""
with t as (select * from customer where c_custkey % 3 <> 0),
n as {_rank_sql('c_name', 't')}, s as {_rank_sql('c_mktsegment', 't')}, k as (select count(*) as n from n)
select c.c_custkey, cast(coalesce(n.idx, k.n) as integer) as name_slot,
  cast(k.n + 1 + coalesce(s.idx, (select count(*) from s)) as integer) as segment_slot, c.c_acctbal as number,
  cast(k.n + 1 + (select count(*) from s) + 1 + 1 as integer) as width
from customer c cross join k left join n on n.value = c.c_name left join s on s.value = c.c_mktsegment""")
def wide_categories(spark, sf_dir):
    """One-hot slots by index tables and joins; every third customer's name is unseen."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    model = WideFeatures(inputCols=["c_name", "c_mktsegment"], numericCols=["c_acctbal"]).fit(c.where("c_custkey % 3 != 0"))
    v = vector_parts(F.col("features"))
    return model.transform(c).select("c_custkey", v["indices"][0].alias("name_slot"), v["indices"][1].alias("segment_slot"),
                                     v["values"][2].alias("number"), v["size"].alias("width"))


@query("constant_fill_stage", ("M04", "G4"), sql="""
select c_custkey, case when c_mktsegment = 'HOUSEHOLD' then 60.0 else c_acctbal end as acctbal_filled
from customer""")
def constant_fill_stage(spark, sf_dir):
    df = _holey_acctbal(spark, sf_dir)
    out = models.fit([feat.constant_fill({"acctbal": 60.0})], df).transform(df)
    return out.select("c_custkey", F.col("acctbal__filled").alias("acctbal_filled"))


# --- rank label and its inverse ---------------------------------------------

@query("rank_label", ("M05",), sql=f"""
select l.l_orderkey, l.l_linenumber, cast(i.idx as integer) as label
from lineitem l join {_QTY_INDEX} i on i.value = cast(l.l_quantity as varchar)""")
def rank_label(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    index = feat.frequency_index(li, "l_quantity")
    out = feat.rank_label(li, "l_quantity", index)
    return out.select("l_orderkey", "l_linenumber", F.col("label").cast("int").alias("label"))


@query("unrank_prediction", ("M08", "G2"), sql=f"""
with n as (select count(*) as n from {_QTY_INDEX})
select l.l_orderkey, l.l_linenumber, i.value as predicted
from lineitem l cross join n
join {_QTY_INDEX} i
  on i.idx = cast(trunc(greatest(0.0, least(cast(n.n - 1 as double),
                                              l.l_discount * 600.0 - 3.0))) as bigint)""")
def unrank_prediction(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    index = feat.frequency_index(li, "l_quantity")
    pred = li.select("l_orderkey", "l_linenumber",
                     (F.col("l_discount") * 600.0 - 3.0).alias("prediction"))
    out = feat.unrank(pred, "prediction", index, "predicted")
    return out.select("l_orderkey", "l_linenumber", "predicted")


# --- linear models -------------------------------------------------------------

def _qty_price(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity",
                                                 "l_extendedprice")
    return li


def _linear_value_bundle(spark, sf_dir):
    li = _qty_price(spark, sf_dir)
    stages = [feat.assemble(["l_quantity"]), models.linear(max_iter=10)]
    return models.train(li, stages, "l_extendedprice", label_mode="value"), li


_LINEAR_SQL = """
with c as (select regr_slope(l_extendedprice, l_quantity) as b,
                  regr_intercept(l_extendedprice, l_quantity) as a from lineitem)
select l_orderkey, l_linenumber, round(a + b * l_quantity, 2) as prediction
from lineitem cross join c"""


@query("linear_predict", ("M06", "M09"), sql=_LINEAR_SQL)
def linear_predict(spark, sf_dir):
    bundle, li = _linear_value_bundle(spark, sf_dir)
    out = bundle.score(li)
    return out.select("l_orderkey", "l_linenumber", F.round("predicted", 2).alias("prediction"))


@query("model_round_trip", ("S10", "S11"), sql=_LINEAR_SQL)
def model_round_trip(spark, sf_dir):
    bundle, li = _linear_value_bundle(spark, sf_dir)
    path = scratch(spark, "model")
    bundle.save(path)
    loaded = models.load(spark, path)
    out = loaded.score(li)
    return out.select("l_orderkey", "l_linenumber", F.round("predicted", 2).alias("prediction"))


def _linear_rank_scored(spark, sf_dir):
    li = _qty_price(spark, sf_dir)
    stages = [feat.assemble(["l_extendedprice"]), models.linear(max_iter=10)]
    bundle = models.train(li, stages, "l_quantity", label_mode="rank")
    return bundle.score(li)


_RANK_PRED_SQL = f"""
with idx as {_QTY_INDEX},
n as (select count(*) as n from idx),
lab as (select l.l_orderkey, l.l_linenumber, l.l_quantity, l.l_extendedprice,
               cast(idx.idx as double) as label
        from lineitem l join idx on idx.value = cast(l.l_quantity as varchar)),
c as (select regr_slope(label, l_extendedprice) as b, regr_intercept(label, l_extendedprice) as a
      from lab),
p as (select lab.*, a + b * l_extendedprice as pred from lab cross join c),
q as (select p.*, cast(idx.value as double) as predicted_quantity
      from p cross join n
      join idx on idx.idx = cast(trunc(greatest(0.0, least(cast(n.n - 1 as double), p.pred)))
                                 as bigint))
"""


@query("linear_rank_predict", ("M05", "M06", "M08", "C01"), sql=_RANK_PRED_SQL + """
select l_orderkey, l_linenumber, predicted_quantity from q""")
def linear_rank_predict(spark, sf_dir):
    out = _linear_rank_scored(spark, sf_dir)
    return out.select("l_orderkey", "l_linenumber", F.col("predicted").alias("predicted_quantity"))


@query("rmse_report", ("A04", "M12"), sql=_RANK_PRED_SQL + """
select round(sqrt(avg(power(predicted_quantity - l_quantity, 2))), 6) as rmse,
  round(avg(case when predicted_quantity = l_quantity then 1.0 else 0.0 end), 6) as match_rate,
  count(*) as n_scored
from q""")
def rmse_report(spark, sf_dir):
    out = _linear_rank_scored(spark, sf_dir)
    return evaluate.report(out, "predicted", "l_quantity", digits=6)


@query("match_rate", ("A06",), sql=_RANK_PRED_SQL + """
select round(avg(case when predicted_quantity = l_quantity then 1.0 else 0.0 end), 6)
  as match_rate, count(*) as n_rows
from q""")
def match_rate(spark, sf_dir):
    out = _linear_rank_scored(spark, sf_dir)
    return evaluate.match_rate(out, "predicted", "l_quantity", digits=6)


@query("rmse_value", ("A04",), sql="""
with c as (select regr_slope(l_extendedprice, l_quantity) as b,
                  regr_intercept(l_extendedprice, l_quantity) as a from lineitem)
select round(sqrt(avg(power(a + b * l_quantity - l_extendedprice, 2))), 4) as rmse,
  count(*) as n_scored, cast(0 as bigint) as n_missing
from lineitem cross join c""")
def rmse_value(spark, sf_dir):
    bundle, li = _linear_value_bundle(spark, sf_dir)
    return evaluate.rmse(bundle.score(li), "predicted", "l_extendedprice", digits=4)


@query("holdout_report", ("A04", "M12", "G17"), sql="""
with t as (select * from lineitem where not coalesce(l_shipdate >= timestamp '2000-01-01', false)),
     c as (select regr_slope(l_extendedprice, l_quantity) as b,
                  regr_intercept(l_extendedprice, l_quantity) as a from t),
     s as (select case when coalesce(l_shipdate >= timestamp '2000-01-01', false)
                       then 'holdout' else 'train' end as part,
                  a + b * l_quantity - l_extendedprice as err
           from lineitem cross join c)
select part, round(sqrt(avg(err * err)), 4) as rmse, count(*) as n_scored from s group by part""")
def holdout_report(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity",
                                                 "l_extendedprice", "l_shipdate")
    stages = [feat.assemble(["l_quantity"]), models.linear(max_iter=10)]
    _, report = flows.train_and_evaluate(
        li, F.col("l_shipdate") >= F.lit("2000-01-01").cast("timestamp_ntz"),
        lambda train: models.train(train, stages, "l_extendedprice"), "l_extendedprice", digits=4)
    return report


def _fold_sql(lam: float) -> str:
    """Mean over three folds of the RMSE of ridge regression on one feature. The fit
    standardises feature and label, so the slope shrinks by 1 + lambda / sd(label)."""
    return f"""select cast({lam} as double) as reg_param, round(avg(rmse), 3) as avg_rmse from (
  select f.fold, sqrt(avg(power(my + b * (l_quantity - mx) - l_extendedprice, 2))) as rmse
  from (select k.fold, avg(l_quantity) as mx, avg(l_extendedprice) as my,
               covar_pop(l_extendedprice, l_quantity) / var_pop(l_quantity)
                 / (1 + {lam} / stddev_pop(l_extendedprice)) as b
        from lineitem, (values (0), (1), (2)) k(fold) where l_orderkey % 3 <> k.fold group by 1) f
  join lineitem on l_orderkey % 3 = f.fold group by f.fold)"""


_GRID = [0.01, 1000.0]


@query("cross_validate_linear", ("M10", "M11"), sql=" union all ".join(map(_fold_sql, _GRID)))
def cross_validate_linear(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice")
    li = li.withColumn("label", F.col("l_extendedprice")) \
           .withColumn("fold", F.pmod("l_orderkey", F.lit(3)).cast("int"))
    est = models.linear(max_iter=10)
    stages = [feat.assemble(["l_quantity"]), est]
    _, metrics = models.cross_validate(li, stages, est, {"regParam": _GRID}, num_folds=3, fold_col="fold")
    return metrics.select(F.get_json_object("params", "$.regParam").cast("double").alias("reg_param"),
                          F.round("avg_rmse", 3).alias("avg_rmse"))


def _ridge_folds_sql(lam: float, outside: str = "outside", inside: str = "inside") -> str:
    """Mean over three folds of the RMSE of ridge regression on two features: on
    standardised columns the slopes solve (R + lambda / sd(label)) b = r, with R the
    correlations of the features and r theirs with the label. ``outside``
    and ``inside`` are tables (k, x1, x2, y) of the rows outside and inside the fold k."""
    return f"""select cast({lam} as double) as reg_param, round(avg(rmse), 3) as avg_rmse from (
  select f.k, sqrt(avg(power(my + b1 * (x1 - m1) + b2 * (x2 - m2) - y, 2))) as rmse
  from (select *, sy / s1 * ((1 + l) * r1 - r12 * r2) / ((1 + l) * (1 + l) - r12 * r12) as b1,
               sy / s2 * ((1 + l) * r2 - r12 * r1) / ((1 + l) * (1 + l) - r12 * r12) as b2
        from (select k, avg(x1) as m1, avg(x2) as m2, avg(y) as my, stddev_pop(x1) as s1, stddev_pop(x2) as s2,
                     stddev_pop(y) as sy, {lam} / stddev_pop(y) as l, corr(x1, x2) as r12, corr(x1, y) as r1,
                     corr(x2, y) as r2 from {outside} group by 1)) f
  join {inside} h on h.k = f.k group by 1)"""


#: the grid of the original's cross-validation
REG_GRID = [0.01, 0.1]

_FOLDS_SQL = """li as (select l_orderkey % 3 as fold, l_quantity, l_extendedprice, l_discount from lineitem),
outside as (select k, l_quantity as x1, l_discount as x2, l_extendedprice as y from li, range(3) r(k) where fold <> k),
inside as (select fold as k, l_quantity as x1, l_discount as x2, l_extendedprice as y from li)"""


def _grid_report(metrics):
    return metrics.select(F.get_json_object("params", "$.regParam").cast("double").alias("reg_param"),
                          F.round("avg_rmse", 3).alias("avg_rmse"))


def _folded(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
                                                   "l_discount", F.pmod("l_orderkey", F.lit(3)).cast("int").alias("fold"))


@query("cross_validate_two_features", ("M10", "M11"), sql="with " + _FOLDS_SQL + " " + " union all ".join(
    _ridge_folds_sql(lam) for lam in REG_GRID))
def cross_validate_two_features(spark, sf_dir):
    li = _folded(spark, sf_dir).withColumn("label", F.col("l_extendedprice"))
    est = models.linear(max_iter=10)
    stages = [feat.assemble(["l_quantity", "l_discount"]), est]
    _, metrics = models.cross_validate(li, stages, est, {"regParam": REG_GRID}, num_folds=3, fold_col="fold")
    return _grid_report(metrics)


_RANK_FOLDS_SQL = """li as (select l_orderkey % 3 as fold, cast(l_quantity as varchar) as value, l_extendedprice as x1,
    l_discount as x2 from lineitem),
idx as (select k, value, row_number() over (partition by k order by cnt desc, value) - 1 as rank
  from (select k, value, count(*) as cnt from li, range(3) r(k) where fold <> k group by all)),
outside as (select idx.k, x1, x2, cast(rank as double) as y from li join idx on idx.value = li.value and fold <> k),
inside as (select fold as k, x1, x2, cast(coalesce(rank, (select count(*) from idx n where n.k = fold)) as double) as y
  from li left join idx on idx.value = li.value and idx.k = fold)"""


def _rank_stages():
    est = models.linear(max_iter=10)
    return [RankLabel(labelCol="l_quantity", outputCol="label"), feat.assemble(["l_extendedprice", "l_discount"]), est,
            Unrank(labelCol="l_quantity", inputCol="prediction", outputCol="predicted")], est


@query("cross_validate_rank", ("M05", "M08", "M10", "M11"), sql="with " + _RANK_FOLDS_SQL + " " + " union all ".join(
    _ridge_folds_sql(lam) for lam in REG_GRID))
def cross_validate_rank(spark, sf_dir):
    """Cross-validation of the whole pipeline with the rank label in it: each fold's fit
    ranks the target by its own rows."""
    stages, est = _rank_stages()
    _, metrics = models.cross_validate(_folded(spark, sf_dir), stages, est, {"regParam": REG_GRID}, num_folds=3,
                                       fold_col="fold")
    return _grid_report(metrics)


@query("rank_pipeline_round_trip", ("M05", "M06", "M08", "M09", "S10", "S11"), sql=f"""
with idx as {_QTY_INDEX},
lab as (select l_orderkey, l_linenumber, l_extendedprice as u, l_discount as v, cast(idx.idx as double) as y
        from lineitem join idx on idx.value = cast(l_quantity as varchar)),
c as (select avg(y) as my, avg(u) as mu, avg(v) as mv, var_pop(u) as uu, var_pop(v) as vv, covar_pop(u, v) as uv,
        covar_pop(y, u) as yu, covar_pop(y, v) as yv from lab),
w as (select *, (yu * vv - yv * uv) / (uu * vv - uv * uv) as a, (yv * uu - yu * uv) / (uu * vv - uv * uv) as b from c),
p as (select l_orderkey, l_linenumber, my + a * (u - mu) + b * (v - mv) as pred from lab cross join w)
select l_orderkey, l_linenumber, idx.value as predicted from p join idx on idx.idx = cast(trunc(greatest(0.0,
  least((select count(*) - 1 from idx)::double, pred))) as bigint)""")
def rank_pipeline_round_trip(spark, sf_dir):
    """Saved and loaded as one PipelineModel; serving rows lack the target."""
    stages, _ = _rank_stages()
    li = _folded(spark, sf_dir)
    path = scratch(spark, "rank-pipeline")
    models.fit(stages, li).write().overwrite().save(path)
    return PipelineModel.load(path).transform(li.drop("l_quantity")).select("l_orderkey", "l_linenumber", "predicted")


@query("linear_two_features", ("M06", "M09", "C01"), sql="""
with t as (select l_orderkey, l_linenumber, l_extendedprice as y, l_quantity as u,
                  case when l_linenumber = 3 then 0.0 else l_discount end as v from lineitem),
     c as (select avg(y) as my, avg(u) as mu, avg(v) as mv, var_pop(u) as uu, var_pop(v) as vv,
                  covar_pop(u, v) as uv, covar_pop(y, u) as yu, covar_pop(y, v) as yv from t),
     w as (select *, (yu * vv - yv * uv) / (uu * vv - uv * uv) as a,
                  (yv * uu - yu * uv) / (uu * vv - uv * uv) as b from c)
select l_orderkey, l_linenumber, round(my + a * (u - mu) + b * (v - mv), 2) as prediction from t cross join w""")
def linear_two_features(spark, sf_dir):
    """The training flow on two features, one with gaps filled inside the pipeline."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity",
        F.when(F.col("l_linenumber") != 3, F.col("l_discount")).alias("l_discount"))
    bundle = flows.train_linear(li, ["l_quantity", "l_discount"], "l_extendedprice", fill=0.0)
    return bundle.score(li).select("l_orderkey", "l_linenumber", F.round("predicted", 2).alias("prediction"))


def house_like(spark, sf_dir):
    """orders x customer as a house-style table: text categories + numerics."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority",
                                              "o_orderstatus", "o_totalprice")
    c = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_mktsegment",
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit(None)).otherwise(F.col("c_acctbal"))
        .alias("c_acctbal"), F.col("c_nationkey").cast("double").alias("c_nationkey"))
    return o.join(c, "o_custkey", "left")


HOUSE_LIKE_CATS = ["o_orderpriority", "o_orderstatus", "c_mktsegment"]
HOUSE_LIKE_NUMS = ["c_acctbal", "c_nationkey"]


def price_by_status(spark, sf_dir):
    """Orders with a category, a constant number with gaps and the price as label."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice",
        F.when(F.col("o_orderkey") % 3 != 0, F.lit(60.0)).alias("lot"))


@query("gbt_predict", ("M02", "M03", "M04", "M07", "C02"), sql="""
select o_orderkey, round(avg(o_totalprice) over (partition by o_orderstatus), 2) as prediction from orders""")
def gbt_predict(spark, sf_dir):
    """Boosted trees whose only informative feature is a one-hot category: the mean
    of the category, whatever the number of rounds."""
    df = price_by_status(spark, sf_dir)
    bundle = flows.train_gbt(df, ["o_orderstatus"], ["lot"], "o_totalprice")
    return bundle.score(df).select("o_orderkey", F.round("predicted", 2).alias("prediction"))


@query("gbt_many_features", ("M07", "C02"))
def gbt_many_features(spark, sf_dir):
    """Trees on several categories and numbers with gaps, one of them continuous: its
    split points are drawn from a sample, so no SQL states them (rows only)."""
    df = house_like(spark, sf_dir)
    bundle = flows.train_gbt(df, HOUSE_LIKE_CATS, HOUSE_LIKE_NUMS, "o_totalprice", fill={"c_acctbal": 60.0})
    return bundle.score(df).select("o_orderkey", F.round("predicted", 2).alias("prediction"))


def banded_houses(spark, sf_dir):
    """The house-style table with numbers of few values, so that every value is a
    possible split: balances in thousands (gaps: a constant) and nations (gaps: the mean)."""
    return house_like(spark, sf_dir).withColumn("c_acctbal", F.floor(F.col("c_acctbal") / 1000).cast("double")) \
        .withColumn("c_nationkey", F.when(F.col("o_orderkey") % 7 != 0, F.col("c_nationkey")))


BANDED_SQL = """select o_orderkey as id, o_orderpriority, o_orderstatus, c_mktsegment, o_totalprice,
  case when c_mktsegment = 'AUTOMOBILE' then 60.0 else floor(c_acctbal / 1000) end as c_acctbal,
  coalesce(case when o_orderkey % 7 <> 0 then c_nationkey end,
           avg(case when o_orderkey % 7 <> 0 then c_nationkey end) over ()) as c_nationkey
  from orders left join customer on c_custkey = o_custkey"""

#: fixed values: the categories of the driver's tables, which its generator names
_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
_STATUSES = ["F", "O", "P"]
_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
_SLOTS = {f"{c}={v}": f"case when {c} = '{v}' then 1 else 0 end"
          for c, values in (("o_orderpriority", _PRIORITIES), ("o_orderstatus", _STATUSES), ("c_mktsegment", _SEGMENTS))
          for v in values}
HOUSE_SLOTS = {**_SLOTS, "c_acctbal": "c_acctbal", "c_nationkey": "c_nationkey"}


def banded_bundle(spark, sf_dir):
    return flows.train_gbt(banded_houses(spark, sf_dir), HOUSE_LIKE_CATS, HOUSE_LIKE_NUMS, "o_totalprice",
                           fill={"c_acctbal": 60.0})


@query("gbt_split_search", ("M01", "M02", "M03", "M04", "M07", "C02"),
       sql="with recursive " + boosted(BANDED_SQL, HOUSE_SLOTS, "o_totalprice", rounds=10, depth=5) + """
select id as o_orderkey, round(prediction, 2) as prediction from boosted""")
def gbt_split_search(spark, sf_dir):
    """The house flow's trees (ten rounds of depth five) on three one-hot categories and
    two numbers with gaps, against a split search in SQL."""
    df = banded_houses(spark, sf_dir)
    return banded_bundle(spark, sf_dir).score(df).select("o_orderkey", F.round("predicted", 2).alias("prediction"))
