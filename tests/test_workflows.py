"""The two original workflows on generated CSV files in their own layouts."""
from pyspark.sql import functions as F

from tidewell.plans import houses, tutors
from tidewell.schemas import (HOUSE_CATEGORICAL, HOUSE_FLOAT, HOUSE_LABEL, HOUSE_STREAM_ORDER,
                              TUTOR_FEATURES, tutor_history_table)
from tidewell.streaming.runner import await_done


def _tutor_csvs(spark, tmp):
    n = 240
    base = spark.range(0, n).select(
        (F.col("id") + 10000).cast("int").alias("Id"),
        *[((F.col("id") * (i + 3)) % (7 + i)).cast("float").alias(c)
          for i, c in enumerate(TUTOR_FEATURES)])
    label = (F.col("age") * 2 + F.col("lesson_price") + F.col("physics") * 5).cast("int")
    train = base.withColumn("mean_exam_points", label.cast("string"))
    tr = tmp("tutor-train")
    train.coalesce(1).write.option("header", True).csv(tr)
    stream = tmp("tutor-stream")
    s = base.select(F.col("Id").alias("id"), "age", "years_of_experience", "lesson_price")
    s.where("id % 2 = 0").coalesce(1).write.option("header", True).option("sep", ";").csv(stream + "/a")
    # same id twice in one file, a bad number and a null id
    extra = spark.createDataFrame([("10001", "1.0", "2.0", "3.0"), ("10001", "9.0", "x", None),
                                   (None, "4.0", "4.0", "4.0")], "id string, a string, b string, c string")
    extra.coalesce(1).write.option("header", True).option("sep", ";").csv(stream + "/b")
    hist = base.select(F.col("Id").alias("id"), *[F.col(c) - 3 for c in TUTOR_FEATURES[3:]]) \
        .toDF("id", *TUTOR_FEATURES[3:])
    hp = tmp("tutor-hist")
    hist.coalesce(1).write.option("header", True).option("sep", ";").csv(hp)
    return tr, stream, hp, n


def test_tutor_workflow_rank_label_with_log(spark, tmp):
    tr, stream, hp, n = _tutor_csvs(spark, tmp)
    model = tmp("tutor-model")
    bundle, report = tutors.train(spark, tr, model, label_mode="rank")
    r = report.first()
    assert r.n_scored == n and r.rmse is not None
    hist_table, out = tmp("hist"), tmp("pred")
    tutors.seed_history(spark, hp, hist_table)
    qs = tutors.serve(spark, f"{stream}/*", hist_table, out, model, tmp("ck"),
                      via_log=tmp("log"))
    for q in qs:
        await_done(q)
    pred = tutors.predictions(spark, out)
    assert pred.columns[0] == "id" and pred.columns[-1] == "mean_exam_points"
    rows = {r.id: r for r in pred.collect()}
    assert len(rows) == n // 2 + 1            # even ids + 10001; the null id is dropped
    r = rows[10001]
    assert (r.age, r.years_of_experience, r.lesson_price) == (9.0, 2.0, 3.0)
    labels = {float(x.mean_exam_points) for x in spark.read.option("header", True).csv(tr)
              .select("mean_exam_points").collect()}
    assert all(x.mean_exam_points in labels for x in rows.values())
    # negative stored values are clobbered to 0.0 by the original merge rule
    assert min(x.qualification for x in rows.values()) >= 0.0


def test_tutor_workflow_value_label_direct(spark, tmp):
    tr, stream, hp, n = _tutor_csvs(spark, tmp)
    model = tmp("tutor-model")
    tutors.train(spark, tr, model, label_mode="value")
    hist_table, out = tmp("hist"), tmp("pred")
    tutors.seed_history(spark, hp, hist_table)
    for q in tutors.serve(spark, f"{stream}/*", hist_table, out, model, tmp("ck"), absent=None,
                          max_files_per_trigger=1):
        await_done(q)
    rows = {r.id: r for r in tutors.predictions(spark, out).collect()}
    assert len(rows) == n // 2 + 1
    assert min(x.qualification for x in rows.values()) < 0.0   # null-safe merge keeps negatives


def _house_csvs(spark, tmp):
    n = 300
    cols = []
    for i, c in enumerate(HOUSE_STREAM_ORDER):
        k = F.col("id")
        if c == "Id":
            cols.append((k + 1).cast("string").alias(c))
        elif c in HOUSE_CATEGORICAL:
            v = F.concat(F.lit("c"), (k * (i + 1) % 4).cast("string"))
            cols.append(F.when(k % 13 == i % 13, F.lit("")).otherwise(v).alias(c))
        elif c == "LotFrontage":
            cols.append(F.when(k % 9 == 0, F.lit("NA")).otherwise((k % 50 + 20).cast("string")).alias(c))
        else:
            v = (k * (i + 7) % 31).cast("float" if c in HOUSE_FLOAT else "int")
            cols.append(v.cast("string").alias(c))
    base = spark.range(0, n).select(*cols)
    price = (F.col("OverallQual").cast("int") * 1000 + F.col("LotArea").cast("int") * 10 + 50000)
    train = base.withColumn(HOUSE_LABEL, price.cast("string"))
    tr, st = tmp("house-train"), tmp("house-stream")
    train.coalesce(1).write.option("header", True).csv(tr)
    serve = base.withColumn("Id", F.when(F.col("Id") == "5", F.lit(None)).otherwise(F.col("Id")))
    serve.where("cast(Id as int) % 3 = 0 or Id is null").coalesce(1).write.option("header", True).csv(st)
    return tr, st


def test_house_workflow(spark, tmp):
    tr, st = _house_csvs(spark, tmp)
    model, out = tmp("house-model"), tmp("house-pred")
    bundle, report = houses.train(spark, tr, model, label_mode="value", max_iter=3)
    assert report.first().n_scored == 300
    await_done(houses.serve(spark, st, out, model, tmp("ck")))
    pred = houses.predictions(spark, out)
    assert pred.columns == ["id", "saleprice"]
    rows = {r.id: r.saleprice for r in pred.collect()}
    assert 0 in rows                          # the null id was defaulted to 0
    assert len(rows) == 100 + 1
    assert all(v is not None and v > 0 for v in rows.values())


def test_command_line_tutors(spark, tmp):
    from tidewell.__main__ import main
    tr, stream, hp, n = _tutor_csvs(spark, tmp)
    model, hist, out = tmp("m"), tmp("h"), tmp("p")
    assert main(["train-tutors", "--csv", tr, "--model", model, "--label-mode", "value"]) == 0
    assert main(["seed-history", "--csv", hp, "--table", hist]) == 0
    assert main(["serve-tutors", "--stream", f"{stream}/*", "--history", hist, "--out", out,
                 "--model", model, "--checkpoint", tmp("ck")]) == 0
    assert tutors.predictions(spark, out).count() == n // 2 + 1
    assert main(["show", "--table", out, "--kind", "tutors", "--rows", "3"]) == 0


def test_tutor_workflow_with_store_stand_in(spark, tmp):
    # a connector-backed store, played by parquet: history read from it,
    # predictions appended to it
    tr, stream, hp, n = _tutor_csvs(spark, tmp)
    model = tmp("m")
    tutors.train(spark, tr, model, label_mode="value")
    hist_store, out_store = tmp("hstore"), tmp("ostore")
    tutor_history_table().conform(
        spark.read.option("header", True).option("sep", ";").csv(hp), strict=False) \
        .write.parquet(hist_store)
    for q in tutors.serve(spark, f"{stream}/*", "", tmp("beside"), model, tmp("ck"),
                          history_store=("parquet", {"path": hist_store}),
                          out_store=("parquet", {"path": out_store})):
        await_done(q)
    out = spark.read.parquet(out_store)
    assert out.count() == n // 2 + 1 and out.columns[-1] == "mean_exam_points"


def test_house_workflow_rank_label(spark, tmp):
    tr, st = _house_csvs(spark, tmp)
    model, out = tmp("house-model"), tmp("house-pred")
    houses.train(spark, tr, model, label_mode="rank", max_iter=2)
    await_done(houses.serve(spark, st, out, model, tmp("ck")))
    prices = {int(r.SalePrice) for r in spark.read.option("header", True).csv(tr)
              .select("SalePrice").collect()}
    got = [r.saleprice for r in houses.predictions(spark, out).collect()]
    assert len(got) == 101 and all(p in prices for p in got)   # predictions are known labels
