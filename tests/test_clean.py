import math

from tidewell.operators import clean
from tidewell.schemas import TableSpec, struct


def test_cast_bad_text_becomes_null(spark):
    df = spark.createDataFrame([("1", "2.5"), ("NA", "x"), ("7.9", "1e3"), (None, "")],
                               "a string, b string")
    out = clean.cast_columns(df, {"a": "int", "b": "double"}).collect()
    assert [r.a for r in out] == [1, None, None, None]
    assert [r.b for r in out] == [2.5, None, 1000.0, None]


def test_fill_scalar_fills_nan_and_null_numeric_only(spark):
    df = spark.createDataFrame([(None, float("nan"), None), (1, 2.0, "x")],
                               "a int, b double, s string")
    r = clean.fill(df, 0).orderBy("a").collect()
    assert (r[0].a, r[0].b, r[0].s) == (0, 0.0, None)


def test_fill_by_column_casts_value(spark):
    df = spark.createDataFrame([(None, None)], "lot float, id string")
    r = clean.fill(df, by_column={"lot": 60.0, "id": "0"}).first()
    assert r.lot == 60.0 and r.id == "0"


def test_null_key_modes(spark):
    df = spark.createDataFrame([(None, 1.0), (5, 2.0)], "id int, v double")
    assert sorted(r.id for r in clean.null_key(df, "id").collect()) == [0, 5]
    assert [r.id for r in clean.null_key(df, "id", "drop").collect()] == [5]
    assert clean.null_key(df, "id", "quarantine").count() == 1


def test_conform_renames_casts_orders(spark):
    spec = TableSpec(struct("id int, price float, name string"), "id")
    df = spark.createDataFrame([("a", 2.5, 7)], "Name string, PRICE double, Id bigint")
    out = clean.conform(df, spec)
    assert out.columns == ["id", "price", "name"]
    assert out.schema["price"].dataType.simpleString() == "float"
    r = out.first()
    assert (r.id, r.name) == (7, "a") and math.isclose(r.price, 2.5)


def test_conform_strict_missing_column(spark):
    spec = TableSpec(struct("id int, extra double"), "id")
    df = spark.createDataFrame([(1,)], "id int")
    try:
        clean.conform(df, spec)
        raise AssertionError("expected failure")
    except ValueError:
        pass
    assert clean.conform(df, spec, strict=False).first().extra is None
