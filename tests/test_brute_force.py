"""Random small tables against plain Python."""

import random
from collections import defaultdict

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality as ql
from tidemark.operators import reconcile as rc
from tidemark.operators import report as rp
from tidemark.operators.aggregates import value_counts
from tidemark.operators.outliers import outlier_flags

SEEDS = [1, 2, 3]


def table(rng, n, values=4):
    pick = lambda: rng.choice([None, *map(str, range(values))])
    return [(rng.choice("ab"), rng.choice("xy"), pick(), pick()) for _ in range(n)]


@pytest.mark.parametrize("seed", SEEDS)
def test_positional_diff(spark, many_partitions, seed):
    rng = random.Random(seed)
    left = table(rng, 60)
    right = [r for r in left if rng.random() > 0.1] + table(rng, 8)
    schema = "k1 string, k2 string, c string, d string"
    out = rc.keyed_positional_diff(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema))
    got = sorted(tuple(r) for r in out.select("k1", "k2", "position", "c__origin", "c__source", "d__origin", "d__source").collect())

    def groups(rows):
        found = defaultdict(list)
        for k1, k2, *rest in rows:
            found[k1, k2].append(tuple("nan" if v is None else v for v in rest))
        return {k: sorted(v) for k, v in found.items()}

    a, b, want = groups(left), groups(right), []
    for key in a.keys() | b.keys():
        mine, theirs = a.get(key, []), b.get(key, [])
        for i in range(max(len(mine), len(theirs))):
            s = mine[i] if i < len(mine) else (None, None)
            t = theirs[i] if i < len(theirs) else (None, None)
            if s != t:
                cells = [v for x, y in zip(s, t) for v in ((x, y) if x != y else (None, None))]
                want.append((*key, i + 1, *cells))
    order = lambda r: tuple("" if v is None else str(v).zfill(4) for v in r)
    assert sorted(got, key=order) == sorted(want, key=order)


@pytest.mark.parametrize("seed", SEEDS)
def test_cell_diff(spark, seed):
    rng = random.Random(seed)
    left = {i: (rng.choice([None, 1, 2]), rng.choice([None, "u", "v"])) for i in range(40) if rng.random() > 0.1}
    right = {i: (rng.choice([None, 1, 2]), rng.choice([None, "u", "v"])) for i in range(40) if rng.random() > 0.1}
    frame = lambda d: spark.createDataFrame([(k, *v) for k, v in d.items()], "k int, a int, b string")
    text = lambda v: None if v is None else str(v)
    got = {(r["k"], r["change"], r["column"], r["source"], r["target"]) for r in rc.cell_diff(frame(left), frame(right), ["k"], ["a", "b"]).collect()}
    want = set()
    for k in left.keys() | right.keys():
        if k not in right:
            want.add((k, "source_only", None, None, None))
        elif k not in left:
            want.add((k, "target_only", None, None, None))
        else:
            want |= {(k, "value", c, text(x), text(y)) for c, x, y in zip("ab", left[k], right[k]) if x != y}
    assert got == want


@pytest.mark.parametrize("mode", ["Pre", "Post"])
def test_report_summary(spark, many_partitions, mode):
    rng = random.Random(7)
    rows = []
    for i in range(80):
        lines = [f"E{rng.randrange(3)}_T{rng.randrange(2)}_m{rng.randrange(3)}" for _ in range(rng.randrange(1, 4))]
        rows.append((f"id{rng.randrange(1000):04d}", f"b{i}", None if i % 9 == 0 else "c", "\n".join(lines), rng.choice([None, "Failed", "Warning"])))
    df = spark.createDataFrame(rows, "a string, b string, c string, comment string, status string")
    lines = rp.split_messages(rp.sample_labels(df, ["a", "b", "c"]), "comment", mode)
    out = rp.summarise(lines, "status", mode=mode)
    got = sorted(tuple(r) for r in out.select("message", "amount", "samples").collect())

    found = defaultdict(list)
    # Spark sorts nulls first among equal ids; (a, b) is unique here
    for index, (a, b, c, comment, status) in enumerate(sorted(rows, key=lambda r: (r[0], r[1])), 2):
        label = f"a: {a} - b: {b} - c: {'nan' if c is None else c}(Report index: {index})"
        for line in comment.split("\n"):
            kind, message = (line.split("_")[1], line.split("_")[2]) if mode == "Pre" else ("", line)
            if status is not None:
                found[message, status, kind].append(label)
    want = sorted((key[0], len(v), "\n".join(v[:5])) for key, v in found.items())
    assert got == want


def test_value_counts_of_many_columns(spark):
    rng = random.Random(5)
    pdf = pd.DataFrame({"a": [rng.choice(["x", "y", None]) for _ in range(200)], "b": [rng.randrange(3) for _ in range(200)]})
    got = {(r["column"], r["value"]): r["count"] for r in value_counts(spark.createDataFrame(pdf), ["a", "b"]).collect()}
    want = {("b", str(k)): v for k, v in pdf["b"].value_counts().items()}
    want |= {("a", k): v for k, v in pdf["a"].value_counts().items()} | {("a", None): int(pdf["a"].isna().sum())}
    assert got == want


def test_outlier_flags(spark):
    rng = random.Random(9)
    values = [rng.gauss(0, 1) for _ in range(300)] + [12.0, -15.0]
    series = pd.Series(values)
    q1, q3 = series.quantile(0.25), series.quantile(0.75)
    out = outlier_flags(spark.createDataFrame([(v,) for v in values] + [(None,)], "x double"), "x")
    rows = out.collect()
    assert sum(r["iqr_outlier"] for r in rows) == int(((series < q1 - 1.5 * (q3 - q1)) | (series > q3 + 1.5 * (q3 - q1))).sum())
    assert sum(r["z_outlier"] for r in rows) == int((((series - series.mean()) / series.std()).abs() > 3).sum())


@pytest.mark.parametrize("seed", SEEDS)
def test_duplicates(spark, seed):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["hot"] * 5 + ["a", "b", None, "c"])) for i in range(200)]
    out = ql.mark_duplicates(spark.createDataFrame(rows, "k int, t string").repartition(7), "k", ["t"])
    count, first = defaultdict(int), {}
    for k, t in rows:
        count[t] += 1
        first.setdefault(t, k)
    assert {(r["k"], r["copies"], r["is_repeat"]) for r in out.collect()} == {(k, count[t], k != first[t]) for k, t in rows}
    assert out.where(F.col("is_repeat")).count() == len(rows) - len(first)
