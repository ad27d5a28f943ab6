import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality as ql
from tidemark.operators import reconcile as rc
from tidemark.operators import report as rp


def test_header_labels_fill_forward():
    assert rc.header_labels(["Source", None, "UNNAMED_2", "Target"], ["a", "b", "c", "a"]) == [
        "Source__a", "Source__b", "Source__c", "Target__a"]


def test_cell_diff_treats_nulls_as_equal(spark):
    source = spark.createDataFrame([(1, None, "x"), (2, 5, "y"), (3, 7, None)], "k int, a int, b string")
    target = spark.createDataFrame([(1, None, "x"), (2, 6, "y"), (4, 1, "z")], "k int, a int, b string")
    got = sorted((r["k"], r["change"], r["column"], r["source"], r["target"]) for r in rc.cell_diff(source, target, ["k"], ["a", "b"]).collect())
    assert got == [(2, "value", "a", "5", "6"), (3, "source_only", None, None, None), (4, "target_only", None, None, None)]


def test_wide_diff_keeps_one_sided_rows_of_nulls(spark):
    source = spark.createDataFrame([(1, None), (2, 3)], "k int, a int")
    target = spark.createDataFrame([(2, 3)], "k int, a int")
    assert [r["k"] for r in rc.compare_wide(source, target, ["k"], ["a"]).collect()] == [1]


def test_prune_and_layout(spark):
    wide = spark.createDataFrame([(4, None, None, 1, 2)], "i long, a__source int, a__destination int, b__source int, b__destination int")
    kept = rc.prune_empty_pairs(wide, ["a", "b"])
    assert kept.columns == ["i", "b__source", "b__destination"]
    rows = [r["cells"] for r in rc.report_rows(kept, "i").orderBy("section", "ord").collect()]
    assert rows == [["index", "b", "b"], ["", "source", "destination"], ["5", "1", "2"]]


def test_positional_diff_with_repeated_rows(spark, many_partitions):
    original = spark.createDataFrame([("a", "x", 1)] * 30 + [("a", "x", 2), ("b", "y", 1)], "k1 string, k2 string, v int")
    loaded = spark.createDataFrame([("a", "x", 1)] * 29 + [("a", "x", 2), ("b", "y", 5)], "p string, q string, r int")
    got = sorted((r["k1"], r["position"], r["v__origin"], r["v__source"]) for r in rc.keyed_positional_diff(original, loaded).collect())
    assert got == [("a", 30, "1", "2"), ("a", 31, "2", None), ("b", 1, "1", "5")]


def test_positional_diff_tells_null_from_empty(spark):
    a = spark.createDataFrame([("k", "k", None)], "a string, b string, c string")
    b = spark.createDataFrame([("k", "k", "")], "a string, b string, c string")
    assert rc.keyed_positional_diff(a, b).count() == 1


def comments(spark, rows):
    df = spark.createDataFrame(rows, "a string, b string, c string, comment string, status string")
    return rp.sample_labels(df, ["a", "b", "c"])


def test_summary_keeps_five_samples_in_order(spark):
    rows = [(f"r{i:02d}", "b", None, "E1_Format_bad\nE2_Range_high", "Failed") for i in range(8)] + [("z", "b", "c", "x", None)]
    out = rp.summarise(rp.split_messages(comments(spark, rows), "comment"), "status").collect()
    assert {(r["error_type"], r["message"], r["amount"]) for r in out} == {("Format", "bad", 8), ("Range", "high", 8)}
    first = out[0]["samples"].split("\n")
    assert len(first) == 5 and first[0] == "a: r00 - b: b - c: nan(Report index: 2)" and "r04" in first[4]


def test_summary_limits_rows_before_the_shuffle(spark):
    rows = [("a", "b", "c", "E1_F_m", "Failed")]
    picked = rp.first_samples(rp.split_messages(comments(spark, rows), "comment"), ["message", "status"])
    assert "WindowGroupLimit" in picked._jdf.queryExecution().executedPlan().toString()


def test_post_mode_and_short_comment(spark):
    lines = rp.split_messages(comments(spark, [("a", "b", "c", "plain", "Failed")]), "comment", "Post")
    row = rp.summarise(lines, "status", mode="Post").first()
    assert (row["status"], row["message"], row["amount"]) == ("Failed", "plain", 1)
    pre = rp.split_messages(comments(spark, [("a", "b", "c", "plain", "Failed")]), "comment").first()
    assert (pre["error_type"], pre["message"]) == ("", "")


def test_duplicates_are_marked_not_removed(spark):
    df = spark.createDataFrame([(1, "x", None), (2, "x", None), (3, "x", "l"), (4, None, None)], "k int, t string, l string")
    got = sorted((r["k"], r["copies"], r["is_repeat"]) for r in ql.mark_duplicates(df, "k", ["t", "l"]).collect())
    assert got == [(1, 2, False), (2, 2, True), (3, 1, False), (4, 1, False)]


def test_validation_log_lists_every_broken_rule(spark):
    df = spark.createDataFrame([(1, -5, None), (2, 5, "x")], "k int, a int, b string")
    log = ql.validation_log(df, "k", {"negative": ("a", F.col("a") < 0), "no_b": ("b", F.col("b").isNull())})
    assert sorted((r["k"], r["rule"], r["column"], r["value"]) for r in log.collect()) == [
        (1, "negative", "a", "-5"), (1, "no_b", "b", None)]


def test_star_model_round_trip(spark, many_partitions):
    df = spark.createDataFrame([("a", None, 1), ("a", "x", 2), ("b", None, 3), ("a", None, 4)], "p string, q string, v int")
    fact, dims = ql.star_model(df, {"pq": ["p", "q"]})
    back = fact.join(dims["pq"], "pq").select("p", "q", "v")
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    assert dims["pq"].count() == 3


def test_a_key_repeated_on_both_sides_pairs_in_order(spark, many_partitions):
    from tidemark.operators.reconcile import cell_diff

    left = [(None, i % 40) for i in range(120)] + [(1, 5), (2, 6), (2, 6)]
    right = [(None, i % 40) for i in range(119)] + [(1, 7), (2, 6), (2, 9)]
    frames = [spark.createDataFrame(x, "k int, v int").repartition(6) for x in (left, right)]
    got = [tuple(r) for r in cell_diff(*frames, ["k"], ["k", "v"]).collect()]
    a, b = (sorted(v for k, v in x if k is None) for x in (left, right))
    want = [(None, "value", "v", str(x), str(y)) for x, y in zip(a, b) if x != y] + [(None, "source_only", None, None, None)]
    want += [(1, "value", "v", "5", "7"), (2, "value", "v", "6", "9")]
    assert sorted(got, key=str) == sorted(want, key=str)
