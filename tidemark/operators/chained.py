"""Chained imputation from sufficient statistics: one scan for the statistics, one for the result, whatever the number of rounds.

Every column with gaps is regressed on all others, in turn, round after round, starting from the means. All values filled in are linear in the values that are known,
so the chain needs no rows: the cross-products of the columns, summed once per pattern of missing columns, change with every step in a way that follows from the
regression itself. The driver holds one small matrix per pattern and per side of ``fit_on``, runs the rounds on them, and keeps
for each pattern how its gaps follow from its known columns; rows are then filled by their pattern.

With ``ridge`` "evidence" the penalty of each regression is the one that makes the data most likely (as in Bayesian ridge regression); a number is a fixed penalty on the
slopes of centred columns; 0 is least squares, of least norm where columns depend on each other.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

MAX_PATTERNS = 4096
EVIDENCE_STEPS, EVIDENCE_TOLERANCE, VAGUE = 300, 1e-3, 1e-6


def pattern_of(columns: Sequence[str]) -> Column:
    """The columns that are missing, as a text of one digit a column."""
    return F.concat(*[F.when(F.col(f"`{c}`").isNull(), "1").otherwise("0") for c in columns])


def cross_products(df: DataFrame, columns: Sequence[str], means: Sequence[float], fit_on: Column | None) -> dict[tuple[str, bool], np.ndarray]:
    """Per (pattern, usable for fits): sums of products of (1, columns less their means), gaps counting as the mean."""
    p = len(columns) + 1
    shift = np.array(means)
    usable = F.lit(True) if fit_on is None else F.coalesce(fit_on, F.lit(False))
    values = [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float(m))).alias(f"x{i}") for i, (c, m) in enumerate(zip(columns, means))]

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, bool], np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.ones((batch.num_rows, p))
            for i in range(p - 1):
                x[:, i + 1] = batch.column(i + 2).to_numpy(zero_copy_only=False) - shift[i]
            keys = batch.column(0).dictionary_encode()
            code = keys.indices.to_numpy().astype(np.int64) * 2 + batch.column(1).to_numpy(zero_copy_only=False)
            order = np.argsort(code, kind="stable")
            starts = np.flatnonzero(np.diff(code[order], prepend=-1))
            for a, b in zip(starts, [*starts[1:], len(order)]):
                rows, number = x[order[a:b]], int(code[order[a]])
                key = (keys.dictionary[number // 2].as_py(), bool(number % 2))
                sums[key] = sums.get(key, 0) + rows.T @ rows
        for (pattern, fits), total in sums.items():
            n = p * p
            yield pa.RecordBatch.from_arrays(
                [pa.array([pattern] * n, pa.string()), pa.array([fits] * n, pa.bool_()), pa.array(np.arange(n), pa.int32()), pa.array(total.ravel())],
                names=["pattern", "fits", "cell", "value"],
            )

    cells = df.select(pattern_of(columns).alias("pattern"), usable.alias("fits"), *values).mapInArrow(
        summed, "pattern string, fits boolean, cell int, value double"
    )
    out: dict[tuple[str, bool], np.ndarray] = {}
    # one row per pattern, side and pair of columns; the number of patterns was counted before
    for r in cells.groupBy("pattern", "fits", "cell").agg(F.sum("value").alias("value")).collect():
        out.setdefault((r["pattern"], r["fits"]), np.zeros(p * p))[r["cell"]] = r["value"]
    return {key: total.reshape(p, p) for key, total in out.items()}


def regression(total: np.ndarray, target: int, ridge: float | str) -> np.ndarray:
    """Weights of (1, columns) for the target column, 0 at its own place, from sums of products."""
    n, p = total[0, 0], len(total)
    others = [i for i in range(1, p) if i != target]
    out = np.zeros(p)
    if n <= 0:
        return out
    means = total[0] / n
    centred = total - n * np.outer(means, means)
    gram, cross = centred[np.ix_(others, others)], centred[others, target]
    if ridge == "evidence":
        slopes = evidence_slopes(gram, cross, max(centred[target, target], 0.0), n)
    elif ridge:
        slopes = np.linalg.solve(gram + float(ridge) * np.eye(len(others)), cross)
    else:
        scale = np.sqrt(np.maximum(np.diag(gram), 1e-300))
        slopes = np.linalg.lstsq(gram / np.outer(scale, scale), cross / scale, rcond=1e-10)[0] / scale
    out[others] = slopes
    out[0] = means[target] - slopes @ means[others]
    return out


def evidence_slopes(gram: np.ndarray, cross: np.ndarray, square: float, n: float) -> np.ndarray:
    """Slopes whose noise and weight precisions make the data most likely, by re-estimating both until the slopes settle."""
    values, vectors = np.linalg.eigh(gram)
    values = np.maximum(values, 0)
    turned = vectors.T @ cross
    noise, weight = 1.0 / max(square / n, 1e-12), 1.0
    slopes = np.zeros(len(cross))
    for _ in range(EVIDENCE_STEPS):
        turned_slopes = turned / (values + weight / noise)
        new = vectors @ turned_slopes
        error = max(square - 2 * cross @ new + new @ gram @ new, 0.0)
        used = (noise * values / (weight + noise * values)).sum()
        weight = (used + 2 * VAGUE) / (new @ new + 2 * VAGUE)
        noise = (n - used + 2 * VAGUE) / (error + 2 * VAGUE)
        settled, slopes = np.abs(new - slopes).sum() < EVIDENCE_TOLERANCE * max(np.abs(new).sum(), 1e-300), new
        if settled:
            break
    return vectors @ (turned / (values + weight / noise))


def chain(
    sums: dict[tuple[str, bool], np.ndarray], gaps: Sequence[int], spread: Sequence[float], rounds: int, tolerance: float, ridge: float | str
) -> dict[str, np.ndarray]:
    """Per pattern, the matrix that gives (1, all columns) from (1, columns with gaps at their mean).

    Stops when the root mean square change of the filled values falls below ``tolerance`` standard deviations in every column.
    """
    now = {key: total.copy() for key, total in sums.items()}
    given = {pattern: np.eye(len(next(iter(sums.values())))) for pattern, _ in sums} if sums else {}
    for _ in range(rounds):
        before = {pattern: rows.copy() for pattern, rows in given.items()}
        for c in gaps:
            fit = sum((t for (pattern, fits), t in now.items() if fits and pattern[c - 1] == "0"), np.zeros_like(next(iter(now.values()))))
            weights = regression(fit, c, ridge)
            for key in now:
                if key[0][c - 1] == "1":  # the column becomes a combination of the others, and so do its products
                    step = np.eye(len(weights))
                    step[c] = weights
                    now[key] = step @ now[key] @ step.T
            for pattern in given:
                if pattern[c - 1] == "1":
                    given[pattern][c] = weights @ given[pattern]
        still = True
        for c in gaps:
            moved, count = 0.0, 0.0
            for (pattern, _), total in sums.items():
                if pattern[c - 1] == "1":
                    change = given[pattern][c] - before[pattern][c]
                    moved += change @ total @ change
                    count += total[0, 0]
            still = still and np.sqrt(max(moved, 0.0) / max(count, 1.0)) <= tolerance * (spread[c - 1] or 1.0)
        if still:
            break
    return given


def chained_fill(
    df: DataFrame, columns: Sequence[str], means: Sequence[float], spread: Sequence[float], gaps: Sequence[str], rounds: int, tolerance: float,
    fit_on: Column | None, ridge: float | str,
) -> DataFrame:
    """``df`` with the gaps of its ``columns`` filled."""
    columns = list(columns)
    sums = cross_products(df, columns, means, fit_on)
    given = chain(sums, [columns.index(c) + 1 for c in gaps], spread, rounds, tolerance, ridge)
    rows = [
        (pattern, [[float(v) for v in matrix[columns.index(c) + 1]] if pattern[columns.index(c)] == "1" else None for c in gaps])
        for pattern, matrix in given.items()
    ]
    schema = T.StructType([T.StructField("__pattern", T.StringType()), T.StructField("__weights", T.ArrayType(T.ArrayType(T.DoubleType())))])
    table = df.sparkSession.createDataFrame(rows, schema)
    known = F.array(F.lit(1.0), *[F.coalesce(F.col(f"`{c}`").cast("double") - F.lit(float(m)), F.lit(0.0)) for c, m in zip(columns, means)])
    # as many rows as there are patterns, which were counted
    joined = df.withColumns({"__pattern": pattern_of(columns), "__known": known}).join(F.broadcast(table), "__pattern", "left")
    filled = {}
    for i, c in enumerate(gaps):
        product = F.zip_with(F.get("__weights", F.lit(i)), F.col("__known"), lambda a, b: a * b)
        guess = F.aggregate(product, F.lit(0.0), lambda a, b: a + b) + F.lit(float(means[columns.index(c)]))
        filled[c] = F.coalesce(F.col(f"`{c}`").cast("double"), guess)
    return joined.withColumns(filled).select(*[F.col(f"`{c}`") for c in df.columns])
