"""NaN, untidy text files, repeated keys and unfinished outputs."""

import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators import impute, ingest, outliers, profile, reconcile
from tidemark.operators.aggregates import missing_by_group
from tidemark.operators.grouping import number_key
from tidemark.operators.models import regression_metrics
from tidemark.sinks.writers import WriteOptions, exists, write
from tidemark.sources.readers import read_csv_text


@pytest.fixture
def numbers(spark):
    rows = [(i, "ab"[i % 2], float(i % 7), float(i % 5) + 0.5) for i in range(40)]
    clean = [(i, g, None if i in (3, 8) else x, y) for i, g, x, y in rows]
    dirty = [(i, g, float("nan") if i in (3, 8) else x, y) for i, g, x, y in rows]
    schema = "k bigint, g string, x double, y double"
    return spark.createDataFrame(clean, schema), spark.createDataFrame(dirty, schema)


OPERATORS = {
    "histogram": lambda d: outliers.histogram(d, "x", 5),
    "binned_counts": lambda d: outliers.binned_counts(d, "x", 5),
    "outlier_flags": lambda d: outliers.outlier_flags(d, "x"),
    "threshold_sweep": lambda d: outliers.threshold_sweep(d, "x", [2.0, 4.0]),
    "validity_split": lambda d: outliers.validity_split(d, "x", 0, 4),
    "dagostino_k2": lambda d: outliers.dagostino_k2(d, "x"),
    "ks_test": lambda d: outliers.ks_test(d, "x"),
    "stat_block": lambda d: profile.stat_block(d, "x", ["g"]),
    "pair_corr": lambda d: profile.pair_corr(d, [("x", "y")]),
    "shape_moments": lambda d: profile.shape_moments(d, ["x"]),
    "impute_group_median": lambda d: impute.impute_group_median(d, "x", ["g"]),
    "drop_missing": lambda d: impute.drop_missing(d, "x"),
    "drop_vs_impute": lambda d: impute.drop_vs_impute(d, "x", ["g"]),
    "compare_groupings": lambda d: impute.compare_groupings(d, "x", [["g"]], F.col("k") % 5 == 0),
    "simple_imputations": lambda d: impute.simple_imputations(d, "x"),
    "sensitivity": lambda d: impute.sensitivity(d, "x", ["g"], {"half": 0.5}),
    "missing_by_group": lambda d: missing_by_group(d, ["g"], "x"),
    "regression_metrics": lambda d: regression_metrics(d, "x", "y"),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_nan_counts_as_missing(numbers, name):
    clean, dirty = (sorted(map(str, OPERATORS[name](d).collect())) for d in numbers)
    assert dirty == clean and "nan" not in "".join(dirty)


def test_csv_keeps_every_text(spark, tmp_path):
    texts = ["two\nlines", 'say "hi", y', " a ", "", None, '"', "a\\b", "\ttab"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    write(df, str(tmp_path / "out"), "csv")
    files = [str(p) for p in (tmp_path / "out").glob("part-*")]
    got = {int(r["doc_id"]): r["text"] for r in read_csv_text(spark, files).collect()}
    assert got == dict(enumerate(texts))


def test_an_aborted_output_is_not_finished(spark, tmp_path):
    folder = tmp_path / "out" / "_temporary" / "0"
    os.makedirs(folder)
    (folder / "part-0").write_text("half")
    assert not exists(spark, str(tmp_path / "out"))
    facts = write(spark.range(3).toDF("n"), str(tmp_path / "out"), skip_existing=True)
    assert facts.written and exists(spark, str(tmp_path / "out"))


def test_unread_workbooks_fail_their_group(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "old.xls").write_bytes(b"old format")
    (tmp_path / "in" / "broken.xlsx").write_bytes(b"no zip")
    files = [(str(p), "excel") for p in sorted((tmp_path / "in").iterdir())]
    assert sorted(x.rsplit("/", 1)[1] for x in ingest.not_read(spark, files)) == ["broken.xlsx (cannot be opened)", "old.xls (no reader)"]


def test_files_of_two_kinds_are_merged_or_kept_apart(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n,t\n1,x\n")
    (tmp_path / "b.json").write_text('{"n": 2, "t": "y"}\n')
    files = [(str(tmp_path / "a.csv"), "csv"), (str(tmp_path / "b.json"), "json")]
    done = ingest.convert_group(spark, "g", files, [], str(tmp_path / "out"), "parquet", WriteOptions())
    assert [facts.rows for _, _, facts in done] == [2]


def test_repeated_and_null_keys_pair_up_one_to_one(spark):
    rows = [(1, "a")] * 50 + [(1, "b"), (None, "c")]
    df = spark.createDataFrame(rows, "k int, v string")
    assert reconcile.cell_diff(df, df, ["k"], ["v"]).count() == 0
    other = spark.createDataFrame([(1, "a")] * 50 + [(1, "z"), (None, "c")], "k int, v string")
    assert [tuple(r) for r in reconcile.cell_diff(df, other, ["k"], ["v"]).collect()] == [(1, "value", "v", "b", "z")]


def test_numbers_of_any_length_sort_by_value(spark):
    texts = ["2", "10", "0002", "9" * 25, "1" + "0" * 25]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", number_key(F.col("t")).alias("k"))
    got = [r["t"] for r in df.orderBy("k", "t").collect()]
    assert got == ["0002", "2", "10", "9" * 25, "1" + "0" * 25]
