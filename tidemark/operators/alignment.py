"""Comparing two ordered tables that have no key: rows are matched in order, so an inserted row shifts nothing after it.

Rows equal in all compared columns may be matched, matches never cross. Where the rows between two matches are few, they are matched by an
exact longest common subsequence. Elsewhere rows that are unique on both sides become candidates (where there are none, the k-th of one kind on
one side with the k-th on the other), and the heaviest increasing chain of the candidates becomes the next matches; then the gaps between matches are looked at again,
until no gap holds a row on both sides.

The chain is found on *runs*: candidates that follow each other on both sides belong together, whichever chain is best, so its size is that of the
breaks between the two orders, not of the tables. Up to ``max_runs`` runs it is exact, in one task; beyond that, blocks of runs give their own best chains,
and neighbouring chains are joined two by two at the best threshold, which keeps a valid chain though perhaps not the longest.

What stays unmatched is reported as moved (the same row elsewhere), changed (the i-th of a gap's rest on either side), deleted or inserted. Nulls
equal nulls. Positions come from spread-out running totals, so neither a gap nor a repeated row has to fit one task.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.ordering import running_total, spread_running_total, spread_sort
from tidemark.session import pin

MAX_CELLS = 1 << 20  # rows on one side of a gap times rows on the other, up to which the gap is solved exactly
MAX_RUNS = 1 << 18
BLOCK = 1 << 12  # consecutive rows that share a join key, so that a gap or a run of any length is dealt out over all tasks
DIGEST = ["d1", "d2"]


def row_digest(columns: Sequence[str]) -> list[Column]:
    """128 bits over the values; a null counts as a value of its own."""
    cells = [part for c in columns for part in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    return [F.xxhash64(*cells).alias("d1"), F.xxhash64(F.lit(7), *reversed(cells)).alias("d2")]


def numbered(df: DataFrame, order: Sequence[str], name: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rows numbered from 1 in order, within their keys; large tables are spread over range partitions."""
    return running_total(df, order, F.lit(1).cast("bigint"), name, keys)


def placed(df: DataFrame, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(pos, d1, d2) of every row, numbered from 1 in the given order."""
    rows = df.select(*[F.col(f"`{c}`").alias(f"__o{i}") for i, c in enumerate(order)], *row_digest(columns))
    return pin(numbered(rows, [*[f"__o{i}" for i in range(len(order))], *DIGEST], "pos").select("pos", *DIGEST))


def open_rows(rows: DataFrame, matched: DataFrame, side: str) -> DataFrame:
    """Unmatched rows with the number of matches before them."""
    marked = rows.join(matched.select(F.col(side).alias("pos"), F.lit(1).alias("hit")), "pos", "left")
    counted = running_total(marked, ["pos"], F.coalesce("hit", F.lit(0)), "gap")
    return pin(counted.where("hit is null").select("gap", "pos", *DIGEST))


def lcs_pairs(a: list, b: list) -> list[tuple[int, int]]:
    """One longest common subsequence as index pairs; where there are several, matches lie as far back as they can."""
    codes: dict = {}
    x = np.array([codes.setdefault(v, len(codes)) for v in a], dtype=np.int64)
    y = np.array([codes.setdefault(v, len(codes)) for v in b], dtype=np.int64)
    table = np.zeros((len(x) + 1, len(y) + 1), dtype=np.int32)
    for i, value in enumerate(x):
        here = np.maximum(table[i, 1:], table[i, :-1] + (y == value))
        table[i + 1, 1:] = np.maximum.accumulate(here)
    out, i, j = [], len(x), len(y)
    while i and j:
        if x[i - 1] == y[j - 1]:
            i, j = i - 1, j - 1
            out.append((i, j))
        elif table[i - 1, j] >= table[i, j - 1]:
            i -= 1
        else:
            j -= 1
    return out[::-1]


def block_of(position: Column) -> Column:
    return F.floor(position / F.lit(BLOCK)).cast("bigint")


def by_block(spans: DataFrame, key: str, first: str, last: str) -> DataFrame:
    """(key, block) of all blocks of rows that the spans of positions from ``first`` to ``last`` touch."""
    return spans.select(key, F.explode(F.sequence(block_of(F.col(first)), block_of(F.col(last)))).alias("block"))


def rows_in(side: DataFrame, gaps: DataFrame, name: str) -> DataFrame:
    """The side's rows in the given gaps. A gap is an unbroken span of positions, so its rows are met block by block."""
    wanted = by_block(gaps, "gap", f"{name}_first", f"{name}_last")
    return side.withColumn("block", block_of(F.col("pos"))).join(wanted, ["gap", "block"]).drop("block")


def exact_matches(left: DataFrame, right: DataFrame, gaps: DataFrame) -> DataFrame:
    """(l, r) of the longest common subsequence of each of the given gaps."""

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        sides = [rows[rows.side == s] for s in (0, 1)]
        keys = [list(zip(s.d1, s.d2)) for s in sides]
        found = lcs_pairs(*keys)
        return pd.DataFrame({
            "l": sides[0].pos.to_numpy()[[i for i, _ in found]], "r": sides[1].pos.to_numpy()[[j for _, j in found]],
        })

    both = rows_in(left, gaps, "l").withColumn("side", F.lit(0)).unionByName(rows_in(right, gaps, "r").withColumn("side", F.lit(1)))
    return both.groupBy("gap").applyInPandas(solve, "l bigint, r bigint")


def candidates(left: DataFrame, right: DataFrame, gaps: DataFrame) -> DataFrame:
    """(l, r) of rows unique on both sides of their gap; in gaps without any, k-th with k-th of the same content."""
    kinds = ["gap", *DIGEST]
    own_left, own_right = rows_in(left, gaps, "l"), rows_in(right, gaps, "r")

    def once(side: DataFrame, name: str) -> DataFrame:
        return side.groupBy(*kinds).agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias(name)).where("n = 1").drop("n")

    unique = pin(once(own_left, "l").join(once(own_right, "r"), kinds).select("gap", "l", "r"))
    rest = pin(gaps.join(unique.select("gap").distinct(), "gap", "left_anti"))
    if rest.isEmpty():
        return unique.select("l", "r")

    def turn(side: DataFrame, name: str) -> DataFrame:
        return numbered(rows_in(side, rest, name), ["pos"], "k", kinds).withColumnRenamed("pos", name)

    repeated = turn(left, "l").join(turn(right, "r"), [*kinds, "k"]).select("gap", "l", "r")
    return unique.unionByName(repeated).select("l", "r")


def heaviest_chain(l: np.ndarray, r: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Indices, ascending in ``l``, of the heaviest chain ascending in ``r`` too (a tree of prefix maxima)."""
    order = np.argsort(l, kind="stable")
    rank = np.argsort(np.argsort(r[order], kind="stable"), kind="stable") + 1
    size = len(order)
    best, who = [0] * (size + 1), [-1] * (size + 1)
    total, before = [0] * size, [-1] * size
    for i, (at, w) in enumerate(zip(rank.tolist(), weight[order].tolist())):
        high, last, j = 0, -1, at - 1
        while j > 0:
            if best[j] > high:
                high, last = best[j], who[j]
            j -= j & -j
        total[i], before[i] = high + w, last
        j = at
        while j <= size:
            if total[i] > best[j]:
                best[j], who[j] = total[i], i
            j += j & -j
    out, at = [], int(np.argmax(total)) if size else -1
    while at >= 0:
        out.append(at)
        at = before[at]
    return order[out[::-1]]


def as_runs(pairs: DataFrame) -> DataFrame:
    """Candidates (l, r) with their rank by ``l`` and the run they belong to."""
    ranked = pin(numbered(numbered(pairs, ["r"], "rank_r"), ["l"], "rank_l"))
    previous = ranked.select((F.col("rank_l") + 1).alias("rank_l"), (F.col("rank_r") + 1).alias("rank_r"), F.lit(0).alias("first"))
    marked = ranked.join(previous, ["rank_l", "rank_r"], "left")
    return pin(running_total(marked, ["rank_l"], F.coalesce("first", F.lit(1)), "run").select("l", "r", "rank_l", "run"))


def chain(pairs: DataFrame, max_runs: int) -> DataFrame:
    """The pairs (l, r) of a heaviest chain: no two of them cross."""
    pairs = pin(pairs)
    if pairs.count() <= max_runs:  # few enough to be runs of their own

        def best_pairs(rows: pd.DataFrame) -> pd.DataFrame:
            chosen = heaviest_chain(rows.l.to_numpy(), rows.r.to_numpy(), np.ones(len(rows), dtype=np.int64))
            return rows[["l", "r"]].iloc[chosen]

        return pairs.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(best_pairs, "l bigint, r bigint")
    members = as_runs(pairs)
    runs = pin(members.groupBy("run").agg(F.min("l").alias("l"), F.min("r").alias("r"), F.count(F.lit(1)).alias("w"), F.min("rank_l").alias("first")))
    count = runs.count()
    if count <= 1:
        return members.select("l", "r")
    blocks = -(-count // max_runs)

    def best(rows: pd.DataFrame) -> pd.DataFrame:
        return rows.iloc[heaviest_chain(rows.l.to_numpy(), rows.r.to_numpy(), rows.w.to_numpy())]

    # runs are numbered in the order of l without gaps, so a block holds at most max_runs of them
    blocked = runs.drop("first").withColumn("block", F.expr(f"cast((run - 1) div {max_runs} as bigint)"))
    kept = pin(blocked.groupBy("block").applyInPandas(best, "run bigint, l bigint, r bigint, w bigint, block bigint"))
    while blocks > 1:
        kept, blocks = pin(joined_chains(kept)), -(-blocks // 2)
    spans = kept.select("run").join(runs, "run").withColumn("last", F.col("first") + F.col("w") - 1)
    chosen = by_block(spans, "run", "first", "last")
    return members.withColumn("block", block_of(F.col("rank_l"))).join(chosen, ["run", "block"]).select("l", "r")


def joined_chains(chains: DataFrame) -> DataFrame:
    """Chains of blocks 2i and 2i + 1 joined: the first one's part up to a value of r and the second one's part beyond it."""
    second = F.col("block") % 2 == 1
    tagged = chains.withColumn("pair", F.expr("block div 2")).withColumn("late", second.cast("int"))
    change = F.when(second, -F.col("w")).otherwise(F.col("w"))  # what the joined chain gains by a threshold at this row
    summed = spread_running_total(spread_sort(tagged, ["pair"], ["r"]), ["r"], change, "gain", ["pair"])
    cut = pin(summed.groupBy("pair").agg(F.max(F.struct("gain", (-F.col("r")).alias("low"))).alias("best")))
    limit = F.when(F.col("best.gain") > 0, -F.col("best.low")).otherwise(F.lit(None))
    # one row per two blocks of ``max_runs`` runs
    placed_at = tagged.join(F.broadcast(cut.select("pair", limit.alias("limit"))), "pair")
    keep = F.when(F.col("late") == 1, F.col("limit").isNull() | (F.col("r") > F.col("limit"))).otherwise(F.col("r") <= F.col("limit"))
    return placed_at.where(F.coalesce(keep, F.lit(False))).select("run", "l", "r", "w", F.col("pair").alias("block"))


def matches(left: DataFrame, right: DataFrame, max_cells: int, max_runs: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(l, r) of all matched rows, and the unmatched rows of both sides with their gaps, of tables made by ``placed``."""
    spark = left.sparkSession
    matched = spark.createDataFrame([], "l bigint, r bigint")
    while True:
        open_left, open_right = open_rows(left, matched, "l"), open_rows(right, matched, "r")
        kinds = ["gap", *DIGEST]
        shared = open_left.select(*kinds).distinct().join(open_right.select(*kinds).distinct(), kinds).select("gap").distinct()
        sizes = [
            side.groupBy("gap").agg(F.count(F.lit(1)).alias(f"n{n}"), F.min("pos").alias(f"{n}_first"), F.max("pos").alias(f"{n}_last"))
            for side, n in ((open_left, "l"), (open_right, "r"))
        ]
        gaps = pin(shared.join(sizes[0], "gap").join(sizes[1], "gap"))
        facts = gaps.agg(F.count(F.lit(1)), F.count_if(F.col("nl") * F.col("nr") > max_cells)).first()
        if not facts[0]:
            return matched, open_left, open_right
        small = F.col("nl") * F.col("nr") <= max_cells
        found = exact_matches(open_left, open_right, gaps.where(small))
        if facts[1]:
            pairs = candidates(open_left, open_right, gaps.where(~small))
            found = found.unionByName(chain(pairs, max_runs))
        matched = pin(matched.unionByName(found))


def align_rows(
    left: DataFrame, right: DataFrame, order: Sequence[str], columns: Sequence[str], max_cells: int = MAX_CELLS, max_runs: int = MAX_RUNS
) -> DataFrame:
    """(status, left_pos, right_pos) of every row of either table: equal, changed, moved, deleted or inserted.

    ``order`` gives the order of the rows of each table and takes no part in the comparison unless it is in ``columns`` as well. Rows that tie
    in it are taken in the order of a digest of their values.
    """
    a, b = placed(left, order, columns), placed(right, order, columns)
    matched, rest_a, rest_b = matches(a, b, max_cells, max_runs)
    equal = matched.select(F.lit("equal").alias("status"), F.col("l").alias("left_pos"), F.col("r").alias("right_pos"))

    def turns(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
        return numbered(rows, ["pos"], "k", keys).withColumnRenamed("pos", name)

    twins = turns(rest_a, DIGEST, "left_pos").drop("gap").join(turns(rest_b, DIGEST, "right_pos").drop("gap"), [*DIGEST, "k"])
    moved = pin(twins.select("left_pos", "right_pos"))
    left_over = rest_a.join(moved.select(F.col("left_pos").alias("pos")), "pos", "left_anti").select("gap", "pos")
    right_over = rest_b.join(moved.select(F.col("right_pos").alias("pos")), "pos", "left_anti").select("gap", "pos")
    pairs = turns(left_over, ["gap"], "left_pos").join(turns(right_over, ["gap"], "right_pos"), ["gap", "k"], "full")
    status = F.when(F.col("right_pos").isNull(), "deleted").when(F.col("left_pos").isNull(), "inserted").otherwise("changed")
    return (
        equal.unionByName(moved.select(F.lit("moved").alias("status"), "left_pos", "right_pos"))
        .unionByName(pairs.select(status.alias("status"), "left_pos", "right_pos"))
    )


def aligned_cells(left: DataFrame, right: DataFrame, order: Sequence[str], columns: Sequence[str], **limits: int) -> DataFrame:
    """Long form of the differences: (status, left_pos, right_pos, column, source, target); a row that is changed gives one row per
    differing cell, a moved, deleted or inserted one a single row without a cell."""
    found = pin(align_rows(left, right, order, columns, **limits).where("status <> 'equal'"))
    texts = F.array(*[F.col(f"`{c}`").cast("string") for c in columns])

    def cells(df: DataFrame, pos: str, name: str) -> DataFrame:
        own = [F.col(f"`{c}`").alias(f"__o{i}") for i, c in enumerate(order)]
        rows = df.select(*own, *row_digest(columns), texts.alias(name))
        return numbered(rows, [*[f"__o{i}" for i in range(len(order))], *DIGEST], pos).select(pos, name)

    changed = found.where("status = 'changed'").join(cells(left, "left_pos", "a"), "left_pos").join(cells(right, "right_pos", "b"), "right_pos")
    names = F.array(*[F.lit(c) for c in columns])
    cell = F.explode(F.arrays_zip(names.alias("column"), F.col("a").alias("source"), F.col("b").alias("target"))).alias("c")
    long = changed.select("status", "left_pos", "right_pos", cell).where(~F.col("c.source").eqNullSafe(F.col("c.target")))
    none = F.lit(None).cast("string")
    others = found.where("status <> 'changed'").select(
        "status", "left_pos", "right_pos", none.alias("column"), none.alias("source"), none.alias("target")
    )
    return long.select("status", "left_pos", "right_pos", F.col("c.column").alias("column"), "c.source", "c.target").unionByName(others)
