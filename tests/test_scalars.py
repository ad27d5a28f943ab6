import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import scalars as sc
from tidemark.operators import grouping as gr
from tidemark.operators.unions import diagonal_union, merged_type, relaxed_union


def test_three_date_layouts(spark):
    texts = ["Sun Jul  8 00:34:60 2001", "12Mar2022", "12/Mar/2022", "nonsense", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r["d"] for r in df.select("i", sc.parse_any(F.col("t")).alias("d")).orderBy("i").collect()]
    day = dt.datetime(2022, 3, 12)
    assert got == [dt.datetime(2001, 7, 8, 0, 35), day, day, None, None]


def test_strict_parse_raises(spark):
    df = spark.createDataFrame([("x",)], "t string")
    with pytest.raises(Exception):
        df.select(sc.parse_timestamp(F.col("t"), "dd/MM/yyyy", strict=True)).collect()


def test_casts(spark):
    df = spark.createDataFrame([("90%",), ("7",)], "t string")
    assert [r[0] for r in df.select(sc.cast_to(F.col("t"), "int", strict=False)).collect()] == [None, 7]
    with pytest.raises(Exception):
        df.select(sc.cast_to(F.col("t"), "int")).collect()


def test_fill_text_leaves_numbers(spark):
    row = sc.fill_text(spark.createDataFrame([(None, None)], "a string, b int")).first()
    assert tuple(row) == ("unknown", None)


def test_json_list(spark):
    df = spark.createDataFrame([(1, '["a","b"]'), (2, "[]"), (3, "oops")], "i int, l string")
    got = sorted((r["i"], r["v"] or "") for r in sc.explode_json_list(df, "l", "v").collect())
    assert got == [(1, "a"), (1, "b"), (2, ""), (3, "")]


def test_labels_and_parts(spark):
    df = spark.createDataFrame([("E1_Format_bad", None)], "c string, x int")
    row = df.select(sc.labelled([("c", F.col("c")), ("x", F.col("x"))]), sc.part_of(F.col("c"), 2), sc.part_of(F.col("c"), 9)).first()
    assert tuple(row) == ("c: E1_Format_bad - x: nan", "bad", "")


def names(spark, fn, paths):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "i int, path string")
    return [r["g"] for r in df.select("i", fn(gr.file_stem(F.col("path"))).alias("g")).orderBy("i").collect()]


def test_base_names(spark):
    paths = ["data_1.csv", "data_v2.csv", "data (3).csv", "data_1of3.csv", "data_part7.csv", "data copy.csv", "data_BACKUP.csv", "data_copy_2.csv", "data.csv"]
    assert names(spark, gr.base_name, paths) == ["data"] * 9


def test_template_names(spark):
    paths = [
        "Data Template T01_Application_C2R2_21_Apr_2026_TMS.xlsx", "Data Template T01_Application_C2R2_21_Apr_2026_2_TMS.xlsx",
        "Data Template M01_User Information_C2R2_16_Apr_2026_TMS.xlsx", "Data Template T01_Application_C2R2_17_Apr_2026_LXP (1).xlsx",
        "Data Template T01_Application_C2R2_17_Apr_2026_LXP new.xlsx", "x_y_z.xlsx", "plain.xlsx",
    ]
    want = ["Application", "Application", "User Information", "Application", "Application", "y", "plain"]
    assert names(spark, gr.template_name, paths) == want


def test_config_groups_match_from_the_start_and_may_overlap(spark):
    df = spark.createDataFrame([("/in/order_1.csv",), ("/in/my_order.csv",), ("/in/else.csv",)], "path string")
    configs = [gr.GroupConfig("starts", r"order_\d"), gr.GroupConfig("order"), gr.GroupConfig("none")]
    got = sorted((r["group"], r["path"]) for r in gr.group_by_config(df, configs).collect())
    assert got == [("order", "/in/my_order.csv"), ("order", "/in/order_1.csv"), ("starts", "/in/order_1.csv")]


def test_natural_order(spark):
    rows = [("g", f, s) for f in "ab" for s in ("Sheet10", "Sheet2", "Sheet1")] + [("g", "a", "extra")]
    got = gr.common_sheets(spark.createDataFrame(rows, "group string, path string, sheet string")).orderBy("ord").collect()
    assert [r["sheet"] for r in got] == ["Sheet1", "Sheet2", "Sheet10"]


def test_unions(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(2.5, 7)], "k double, w long")
    with pytest.raises(TypeError):
        diagonal_union([a, b])
    out = relaxed_union([a, b])
    assert dict(out.dtypes) == {"k": "double", "v": "string", "w": "bigint"}
    assert merged_type({"int", "string"}) == "string"
    assert merged_type({"int", "float"}) == "double"
    mixed = relaxed_union([a, spark.createDataFrame([("n/a", "y")], "k string, v string")])
    assert sorted(r["k"] for r in mixed.collect()) == ["1", "n/a"]
