from tidewell.operators import envelope
from tidewell.schemas import struct


def test_json_round_trip_keeps_commas_quotes_newlines(spark):
    rows = [(1, 'a, "b",\nc', None), (2, None, 3.5), (3, "", -1.0)]
    df = spark.createDataFrame(rows, "id bigint, text string, x double")
    log = envelope.encode(df, fmt="json", offset="id")
    back = envelope.decode(log, df.schema, fmt="json")
    assert sorted(tuple(r)[:3] for r in back.collect()) == sorted(rows)
    assert back.columns == ["id", "text", "x", "offset"]


def test_text_round_trip_comma_free(spark):
    rows = [(1, 2.0, None), (2, None, 3)]
    df = spark.createDataFrame(rows, "id int, age float, n int")
    log = envelope.encode(df, fmt="text", offset="id")
    assert log.orderBy("offset").first().value == "{1, 2.0, null}"
    back = envelope.decode(log, df.schema, fmt="text")
    assert sorted(tuple(r)[:3] for r in back.collect()) == sorted(rows)


def test_text_decodes_both_wire_forms_and_short_rows(spark):
    df = spark.createDataFrame([("[1,2.0]", 0), ("{1, 2.0, null}", 1), ("7", 2), ("x,y", 3)],
                               "value string, offset bigint")
    out = {r.offset: r for r in envelope.decode(
        df, struct("id int, age double, extra double"), fmt="text").collect()}
    assert (out[0].id, out[0].age, out[0].extra) == (1, 2.0, None)
    assert (out[1].id, out[1].age, out[1].extra) == (1, 2.0, None)
    assert (out[2].id, out[2].age) == (7, None)         # too few fields -> null, no failure
    assert out[3].id is None                             # not a number -> null


def test_json_malformed_is_null(spark):
    df = spark.createDataFrame([("{not json", 0)], "value string, offset bigint")
    r = envelope.decode(df, struct("id int"), fmt="json").first()
    assert r.id is None and r.offset == 0
