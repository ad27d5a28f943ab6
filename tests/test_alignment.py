"""Matching rows of two tables without keys, against a brute-force longest common subsequence."""

import random
from functools import lru_cache

import numpy as np
import pytest

from tidemark.operators import alignment as al
from tidemark.session import pin


def lcs_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def frames(spark, a, b):
    schema = "at int, v string, w int"
    return [spark.createDataFrame([(i, v, None) for i, v in enumerate(x)], schema).repartition(3) for x in (a, b)]


def checked(a, b, rows):
    """The rows are a whole and valid comparison; how many were matched."""
    lefts = sorted(r["left_pos"] for r in rows if r["left_pos"] is not None)
    rights = sorted(r["right_pos"] for r in rows if r["right_pos"] is not None)
    assert lefts == list(range(1, len(a) + 1)) and rights == list(range(1, len(b) + 1))
    equal = sorted((r["left_pos"], r["right_pos"]) for r in rows if r["status"] == "equal")
    assert all(a[l - 1] == b[r - 1] for l, r in equal)
    assert [r for _, r in equal] == sorted(r for _, r in equal)
    for r in rows:
        if r["status"] == "moved":
            assert a[r["left_pos"] - 1] == b[r["right_pos"] - 1]
        if r["status"] == "changed":
            assert a[r["left_pos"] - 1] != b[r["right_pos"] - 1]
    return len(equal)


def edited(rows, rng, share=0.1):
    out = []
    for v in rows:
        chance = rng.random()
        if chance < share / 3:
            continue
        out.append(f"new{rng.random()}" if chance < 2 * share / 3 else v)
        if chance > 1 - share / 3:
            out.append(f"more{rng.random()}")
    at = rng.randrange(max(len(out) - 20, 1))
    block = out[at : at + 15]
    del out[at : at + 15]
    to = rng.randrange(len(out) + 1)
    return out[:to] + block + out[to:]


@pytest.mark.parametrize("max_cells, max_runs", [(1 << 20, 1 << 18), (16, 1 << 18), (0, 40)])
def test_unique_rows_match_as_many_as_the_longest_common_subsequence(spark, max_cells, max_runs):
    rng = random.Random(5)
    a = [f"row{i}" for i in range(250)]
    b = edited(a, rng)
    rows = al.align_rows(*frames(spark, a, b), ["at"], ["v", "w"], max_cells, max_runs).collect()
    assert checked(a, b, rows) == lcs_length(a, b)
    assert sum(r["status"] == "moved" for r in rows) > 0


@pytest.mark.parametrize("max_cells", [1 << 20, 200])
def test_repeated_rows(spark, max_cells):
    rng = random.Random(6)
    a = [rng.choice("abcdefgh") * rng.randint(1, 2) for _ in range(120)] + ["same"] * 60
    b = edited(a, rng, 0.2) + ["same"] * 5
    found = checked(a, b, al.align_rows(*frames(spark, a, b), ["at"], ["v", "w"], max_cells).collect())
    best = lcs_length(a, b)
    assert found == best if max_cells > 1000 else found >= 0.85 * best


def test_many_breaks_are_joined_in_blocks(spark):
    rng = random.Random(7)
    a = [f"row{i}" for i in range(120)]
    b = a[60:] + a[:60]
    b = [v for i in range(0, 120, 4) for v in rng.sample(b[i : i + 4], 4)]
    rows = al.align_rows(*frames(spark, a, b), ["at"], ["v"], 0, 8).collect()
    assert checked(a, b, rows) >= 0.8 * lcs_length(a, b)


def test_an_inserted_row_shifts_nothing(spark):
    a = [f"row{i}" for i in range(50)]
    b = ["first", *a]
    rows = al.align_rows(*frames(spark, a, b), ["at"], ["v"], 0).collect()
    assert sorted((r["status"], r["left_pos"], r["right_pos"]) for r in rows if r["status"] != "equal") == [("inserted", None, 1)]
    assert checked(a, b, rows) == 50


@pytest.mark.parametrize("a, b", [([], []), (["x"], []), ([], ["x", "y"]), ([None, None, "x"], [None, "x", None]), (["x"], ["y"])])
def test_small_and_empty_tables(spark, a, b):
    rows = al.align_rows(*frames(spark, a, b), ["at"], ["v", "w"]).collect()
    assert checked(a, b, rows) == lcs_length(a, b)


@pytest.fixture
def hash_joins(spark, many_partitions):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def largest_share(df):
    sizes = [sum(1 for _ in part) for part in df.rdd.glom().collect()]
    return max(sizes) / sum(sizes)


def test_one_gap_of_all_rows_is_dealt_over_the_tasks(spark, hash_joins, monkeypatch):
    monkeypatch.setattr(al, "BLOCK", 16, raising=False)
    side = pin(spark.range(1, 2001).selectExpr("0L as gap", "id as pos", "xxhash64(id) as d1", "xxhash64(7, id) as d2"))
    spans = "0L as gap, 2000L as nl, 1L as l_first, 2000L as l_last, 2000L as nr, 1L as r_first, 2000L as r_last"
    pairs = al.candidates(side, side, pin(spark.range(1).selectExpr(*spans.split(", "))))
    assert sorted(map(tuple, pairs.collect())) == [(i, i) for i in range(1, 2001)]
    assert largest_share(pairs) < 0.5


def test_one_run_of_nearly_all_rows_is_dealt_over_the_tasks(spark, hash_joins, monkeypatch):
    monkeypatch.setattr(al, "BLOCK", 16, raising=False)
    pairs = spark.range(1, 2001).selectExpr("id as l", "case when id = 2000 then 0 else id end as r")
    kept = al.chain(pairs, 2)
    assert sorted(map(tuple, kept.collect())) == [(i, i) for i in range(1, 2000)]
    assert largest_share(kept) < 0.5


def test_cells_of_changed_rows(spark):
    left = spark.createDataFrame([(1, "a", 1), (2, "b", None), (3, "c", 3)], "at int, v string, w int")
    right = spark.createDataFrame([(10, "a", 1), (20, "b", 5), (25, "new", 0), (30, "c", 3)], "at int, v string, w int")
    got = sorted(tuple(r) for r in al.aligned_cells(left, right, ["at"], ["v", "w"]).collect())
    assert got == sorted([("changed", 2, 2, "w", None, "5"), ("inserted", None, 3, None, None, None)], key=lambda r: r)


def test_heaviest_chain_equals_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(60):
        n = int(rng.integers(1, 9))
        l, r, w = rng.permutation(n), rng.permutation(n), rng.integers(1, 9, n)
        by_l = np.argsort(l)

        @lru_cache(None)
        def best(i, last):
            if i == n:
                return 0
            k = by_l[i]
            skip = best(i + 1, last)
            return max(skip, int(w[k]) + best(i + 1, int(r[k]))) if r[k] > last else skip

        chosen = al.heaviest_chain(l, r, w)
        assert list(l[chosen]) == sorted(l[chosen]) and list(r[chosen]) == sorted(r[chosen])
        assert w[chosen].sum() == best(0, -1)
