"""Toxicity: a linear classifier on character n-grams whose features are scaled by naive Bayes log-count ratios.

A text's features are the distinct n-grams of its lower-cased code points, with one blank for everything between words,
hashed into a fixed number of buckets and scaled by r = log of the share of toxic texts having the bucket over that of
the other texts. Shares are smoothed by ``smoothing`` rows of the usual mix of labels, so a bucket seen in few texts
counts little. A logistic regression, with toxic rows weighing ``toxic_weight`` times as much, on the scaled features is fitted in rounds: every partition of the training rows improves the current
weights on its own rows, and the weights of the partitions are averaged. Training rows are a sample by hash of the
id of about ``max_rows``, ``part_rows`` to a partition; scoring reads whole texts in one pass without a shuffle.

Defined results: null and empty texts score like texts without n-grams (the intercept alone); rows without id or
label are not learned from, an id labelled twice counts once with its higher label; without labels of both classes
the score is the smoothed share of toxic rows (one half when there are none). Documents that repeat get the same score.
Further columns are kept, existing columns named like the results are replaced. Empty tables give empty results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from tidemark.llm.common import quoted, text_of
from tidemark.session import pin

SIZES = (4, 6)
BUCKET_BITS = 18
BETWEEN = re.compile(r"[\W_]+")
BLOCK = 1 << 19  # buckets of rows looked at together while fitting
PIECE = 1 << 16  # code points handled at a time, to bound memory on very long texts


@dataclass(frozen=True)
class Model:
    """Weights per bucket (log-odds of its presence) and the intercept."""

    weights: np.ndarray
    intercept: float

    def log_odds(self, text: str) -> float:
        return self.intercept + float(self.weights[buckets(text)].sum())


def buckets(text: str) -> np.ndarray:
    """Distinct hash buckets of the text's n-grams."""
    plain = BETWEEN.sub(" ", f" {text.lower()} ")
    points = np.frombuffer(plain.encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    seen = np.zeros(1 << BUCKET_BITS, dtype=bool)
    shift = np.uint64(64 - BUCKET_BITS)
    for start in range(0, len(points), PIECE):
        piece = points[start : start + PIECE + max(SIZES) - 1]
        for size in SIZES:
            if len(piece) < size:
                continue
            hashed = np.full(len(piece) - size + 1, size, dtype=np.uint64)
            for j in range(size):
                hashed *= np.uint64(0x9E3779B97F4A7C15)
                hashed += piece[j : j + len(hashed)]
            hashed ^= hashed >> np.uint64(29)
            hashed *= np.uint64(0xBF58476D1CE4E5B9)
            seen[hashed >> shift] = True
    return np.flatnonzero(seen)


def training_rows(
    docs: DataFrame, labels: DataFrame, usable: Column, id_col: str, text_col: str, label_col: str, max_rows: int
) -> tuple[DataFrame, int]:
    """(toxic, text) of about ``max_rows`` labelled documents chosen by hash of the id, and how many have labels."""
    known = (
        labels.select(quoted(id_col).alias("id"), quoted(label_col).cast("int").alias("toxic"))
        .where(F.col("id").isNotNull() & F.col("toxic").isNotNull())
        .groupBy("id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
        .where(usable)
    )
    total = known.count()
    if total > max_rows:
        share = int(max_rows / total * (1 << 30))
        known = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < share)

    texts = docs.select(quoted(id_col).alias("doc"), text_of(text_col).alias("text"))
    # the sampled labels have a fixed bound, so they may be sent to every task
    return texts.join(F.broadcast(known), F.col("doc") == F.col("id")).select("toxic", "text"), total


def log_count_ratios(rows: DataFrame, smoothing: float) -> tuple[np.ndarray, int, int]:
    """r per bucket, and the numbers of toxic and other rows."""
    size = 1 << BUCKET_BITS

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, totals = np.zeros((2, size), dtype=np.int64), [0, 0]
        for batch in batches:
            labels, flat, lengths = unpacked(batch)
            for toxic in (0, 1):
                totals[toxic] += int((labels == toxic).sum())
                seen[toxic] += np.bincount(flat[np.repeat(labels == toxic, lengths)], minlength=size)
        used = np.flatnonzero(seen.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, *used], pa.int64()), *(pa.array([totals[t], *seen[t, used]], pa.int64()) for t in (0, 1))],
            names=["bucket", "other", "toxic"],
        )

    # one row per bucket at most, whatever the size of the corpus
    counts = (
        rows.mapInArrow(counted, "bucket bigint, other bigint, toxic bigint")
        .groupBy("bucket").agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic")).toArrow()
    )
    bucket, n_of_other, n_of_toxic = (counts.column(c).to_numpy() for c in ("bucket", "other", "toxic"))
    total, used = bucket < 0, bucket >= 0
    n_other, n_toxic = int(n_of_other[total].sum()), int(n_of_toxic[total].sum())
    if not n_toxic or not n_other:
        return np.zeros(size), n_toxic, n_other
    share = n_toxic / (n_toxic + n_other)
    other, toxic = np.full(size, smoothing * (1 - share)), np.full(size, smoothing * share)
    other[bucket[used]] += n_of_other[used]
    toxic[bucket[used]] += n_of_toxic[used]
    return np.log(toxic / n_toxic) - np.log(other / n_other), n_toxic, n_other


def unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Labels, the buckets of all texts one after the other, and how many each text has."""
    lists = [buckets(t.as_py()).astype(np.int32) for t in batch.column(1)]
    flat = np.concatenate([np.zeros(0, dtype=np.int32), *lists])
    return batch.column(0).to_numpy(), flat, np.array([len(x) for x in lists], dtype=np.int64)


def improve(
    labels: np.ndarray, flat: np.ndarray, lengths: np.ndarray, ratio: np.ndarray, start: np.ndarray,
    steps: int, penalty: float, toxic_weight: float = 1.0,
) -> np.ndarray:
    """Lower the penalised log-loss of the given rows from ``start``; the last weight is the intercept."""
    used = np.zeros(len(ratio), dtype=bool)
    used[flat] = True
    used = np.flatnonzero(used)
    number = np.zeros(len(ratio), dtype=np.int32)
    number[used] = np.arange(len(used), dtype=np.int32)
    local, own = number[flat], ratio[used]
    ends = np.cumsum(lengths)
    blocks = row_blocks(lengths)

    weight = np.where(labels == 1, toxic_weight, 1.0)
    weight /= weight.sum()

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        scaled, slope = w[:-1] * own, np.zeros(len(used))
        margin = np.full(len(labels), w[-1])
        for low, high in blocks:  # rows are contiguous, so a few of them at a time bound the memory
            begin = ends[low] - lengths[low]
            filled = np.flatnonzero(lengths[low:high]) + low
            if len(filled):
                margin[filled] += np.add.reduceat(scaled[local[begin : ends[high - 1]]], ends[filled] - lengths[filled] - begin)
        chance = 1 / (1 + np.exp(-np.clip(margin, -500, 500)))
        value = weight @ (np.logaddexp(0, margin) - labels * margin) + penalty / 2 * (w[:-1] @ w[:-1])
        miss = (chance - labels) * weight
        for low, high in blocks:
            part = local[ends[low] - lengths[low] : ends[high - 1]]
            slope += np.bincount(part, np.repeat(miss[low:high], lengths[low:high]), minlength=len(used))
        return value, np.append(slope * own + penalty * w[:-1], miss.sum())

    out = start.copy()
    best = quasi_newton(loss, np.append(start[used], start[-1]), steps)
    out[used], out[-1] = best[:-1], best[-1]
    return out


def row_blocks(lengths: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of rows of about ``BLOCK`` buckets each."""
    cut = np.flatnonzero(np.diff(np.cumsum(lengths) // BLOCK)) + 1
    return [(int(a), int(b)) for a, b in zip([0, *cut], [*cut, len(lengths)]) if a < b]


def quasi_newton(loss, x: np.ndarray, steps: int, memory: int = 8) -> np.ndarray:
    """Limited-memory BFGS with step halving."""
    value, slope = loss(x)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        move, shares = slope.copy(), []
        for s, y in reversed(past):
            shares.append(s @ move / (y @ s))
            move -= shares[-1] * y
        if past:
            s, y = past[-1]
            move *= s @ y / (y @ y)
        else:
            move /= max(1.0, float(np.linalg.norm(slope)))
        for (s, y), share in zip(past, reversed(shares)):
            move += s * (share - y @ move / (y @ s))
        size = 1.0
        while size > 1e-6:
            there = x - size * move
            new_value, new_slope = loss(there)
            if new_value <= value - 1e-4 * size * (slope @ move):
                break
            size /= 2
        else:
            break
        if (there - x) @ (new_slope - slope) > 1e-12:
            past = [*past, (there - x, new_slope - slope)][-memory:]
        x, value, slope = there, new_value, new_slope
        if np.linalg.norm(slope) < 1e-5:
            break
    return x


def train(
    docs: DataFrame, labels: DataFrame, usable: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", max_rows: int = 12_000, part_rows: int = 2_500, rounds: int = 2, steps: int = 30,
    penalty: float = 1e-3, smoothing: float = 30.0, toxic_weight: float = 3.0,
) -> Model:
    """Fit on the labelled documents for which ``usable`` (a condition on ``id``) holds."""
    usable = F.lit(True) if usable is None else usable
    rows, known = training_rows(docs, labels, usable, id_col, text_col, label_col, max_rows)
    rows = pin(rows.repartition(max(1, -(-min(known, max_rows) // part_rows))))
    ratio, n_toxic, n_other = log_count_ratios(rows, smoothing)
    share = (n_toxic + 1) / (n_toxic + n_other + 2)
    prior = float(np.log(share / (1 - share)))
    if not n_toxic or not n_other:
        return Model(np.zeros(1 << BUCKET_BITS), prior)
    weights = np.append(np.zeros(len(ratio)), prior)
    context = docs.sparkSession.sparkContext
    for _ in range(rounds):
        sent = context.broadcast((ratio, weights))

        def fitted(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            parts = [unpacked(b) for b in batches if b.num_rows]
            if parts:
                own, flat, lengths = (np.concatenate(x) for x in zip(*parts))
                parts.clear()
                new = improve(own, flat, lengths, *sent.value, steps=steps, penalty=penalty, toxic_weight=toxic_weight)
                moved = np.flatnonzero(new != sent.value[1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(moved), pa.array((new - sent.value[1])[moved])], names=["weight", "change"]
                )

        # the weights have a fixed number, whatever the size of the corpus
        change = (
            rows.mapInArrow(fitted, "weight bigint, change double").groupBy("weight")
            .agg(F.sum("change").alias("change"), F.count(F.lit(1)).alias("votes")).toArrow()
        )
        at, moved, votes = (change.column(c).to_numpy() for c in ("weight", "change", "votes"))
        weights = weights.copy()
        weights[at] += moved / votes
        sent.destroy()
    return Model(weights[:-1] * ratio, float(weights[-1]))


def with_scores(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with the probability of being toxic, from the whole text alone."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        known = sent.value
        odds = np.array([known.log_odds(t) for t in texts], dtype=np.float64)
        return pd.Series(1 / (1 + np.exp(-np.clip(odds, -700, 700))))

    return docs.withColumn(score_col, score(text_of(text_col)))
