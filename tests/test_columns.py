"""Golden tests for the column expressions on the edge rows of FIXTURES.md."""

import datetime as dt

from pyspark.sql import functions as F

from tidewater.functions import columns as C


def one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr).collect()]


def test_title_case_capitalises_after_non_letters(spark):
    got = one(spark, C.title_case("n"), [("  1inch ",), ("wrapped-btc",), ("o'neil",), ("éclair x2y",)], "n string")
    assert got == ["1Inch", "Wrapped-Btc", "O'Neil", "Éclair X2Y"]


def test_tier_strict_boundaries_and_null(spark):
    vals = [(1e9,), (1e10,), (1e11,), (1e11 + 1,), (0.0,), (None,), (5e9,)]
    got = one(spark, C.tier_strict("v"), vals, "v double")
    assert got == ["Small", "Mid", "Large", "Mega", "Small", "Small", "Mid"]


def test_tier_bins_right_closed(spark):
    vals = [(1e9,), (1e10,), (1e11,), (1e11 + 1,), (0.0,), (None,), (-5.0,)]
    got = one(spark, C.tier_bins("v"), vals, "v double")
    assert got == ["Small", "Mid", "Large", "Mega", None, None, None]


def test_safe_ratio_zero_and_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (1.0, 3.0)], "a double, b double")
    assert [r[0] for r in df.select(C.safe_ratio("a", "b", 4)).collect()] == [None, None, 0.3333]


def test_days_since_floors_whole_days(spark):
    asof = "2024-02-01 00:00:00"
    rows = [("2024-01-31T00:01:00Z",), ("2024-01-30T00:00:00Z",), ("garbage",), (None,)]
    got = one(spark, C.days_since(C.parse_instant("t"), asof), rows, "t string")
    assert got == [0, 2, None, None]          # 23 h 59 min old -> 0 days


def test_parse_yy_dd_mm(spark):
    got = one(spark, C.parse_yy_dd_mm("t"), [("17.14.11",), ("17.31.02",), ("bad",)], "t string")
    assert got == [dt.date(2017, 11, 14), None, None]


def test_decode_payload_json_and_raw(spark):
    rows = [("eyJrIjogMX0=",), ("bm90IGpzb24=",)]       # {"k": 1}  /  not json
    got = one(spark, C.decode_payload("p"), rows, "p string")
    assert got == ['{"k": 1}', '{"raw":"not json"}']


def test_resolve_choice_struct(spark):
    df = spark.createDataFrame([("12",), ("abc",), (None,)], "v string")
    got = df.select(C.resolve_choice("v", ["long", "string"]).alias("c")).select("c.long", "c.string").collect()
    assert [tuple(r) for r in got] == [(12, None), (None, "abc"), (None, None)]


def test_apply_mapping_renames_casts_and_nulls_absent(spark):
    df = spark.createDataFrame([("1", "x", "y")], "A string, b string, extra string")
    out = C.apply_mapping(df, [("a", "string", "id", "long"), ("b", "string", "name", "string"),
                               ("missing", "string", "m", "int")])
    assert out.columns == ["id", "name", "m"]
    assert tuple(out.first()) == (1, "x", None)


def test_drop_null_fields_and_ensure_column(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a int, b string")
    assert C.drop_null_fields(df).columns == ["a"]
    got = C.ensure_column(C.ensure_column(df, "b", "u"), "c", "d").collect()
    assert [(r.b, r.c) for r in got] == [("u", "d"), ("u", "d")]


def test_parse_fields_empty_is_null(spark):
    df = spark.createDataFrame([('{"k": 5}',), ("{}",)], "m string")
    got = [r[0] for r in df.select(*C.parse_fields("m", r'"k":\s*(\d+)', ["k"])).collect()]
    assert got == ["5", None]


def test_flatten_struct(spark):
    df = spark.createDataFrame([(1, ("t", ("x",)))], "id int, snippet struct<title:string, inner:struct<z:string>>")
    assert C.flatten_struct(df).columns == ["id", "snippet_title", "snippet_inner_z"]


def test_run_stamps(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5),)], "t timestamp")
    r = df.select(*C.run_stamps("t")).first()
    assert (r.stamp_compact, r.stamp_iso, r.stamp_underscore, r.stamp_hour) == (
        "20240102T030405", "2024-01-02 03:04:05", "20240102_030405", "03")
    assert F is not None
