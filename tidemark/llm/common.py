"""Helpers shared by the operators of this package: names, row identity, text batches, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.session import pin


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def text_of(name: str) -> Column:
    """The text column with null read as the empty text."""
    return F.coalesce(quoted(name).cast("string"), F.lit(""))


def fresh(taken: Iterable[str], stem: str) -> str:
    """A column name that none of ``taken`` uses, whatever its case."""
    lower, name = {t.lower() for t in taken}, stem
    while name.lower() in lower:
        name = "_" + name
    return name


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def row_key(id_col: str, text_col: str) -> Column:
    """Identity of a row by id and text: rows that repeat both are one, rows that share only the id are not."""
    return F.xxhash64(quoted(id_col), text_of(text_col))


def by_batch(fn: Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table]) -> Callable[[Iterator], Iterator]:
    """``mapInArrow`` function that turns every batch on its own into one result batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                yield from out.to_batches() if isinstance(out, pa.Table) else [out]

    return run


def key_runs(batches: Iterator[pa.RecordBatch], keys: int, limit: int | None = None) -> Iterator[pa.RecordBatch]:
    """Rows sorted by their first ``keys`` columns, regrouped so that no key is cut between two batches.

    With ``limit``, a batch is held back at most until it has so many rows; a key beyond that is cut.
    """
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        start = run_starts(batch, keys)[-1]
        if held and (start or not same_key(held[-1], held[-1].num_rows - 1, batch, 0, keys)):
            cut = start if same_key(held[-1], held[-1].num_rows - 1, batch, 0, keys) else 0
            if cut:
                held.append(batch.slice(0, cut))
            yield joined(held)
            if cut < start:
                yield batch.slice(cut, start - cut)
            held, rows = [], 0
        elif start:
            yield batch.slice(0, start)
        held.append(batch.slice(start))
        rows += batch.num_rows - start
        if limit is not None and rows >= limit:
            yield joined(held)
            held, rows = [], 0
    if held:
        yield joined(held)


def joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def same_key(a: pa.RecordBatch, i: int, b: pa.RecordBatch, j: int, keys: int) -> bool:
    return all(a.column(k)[i].as_py() == b.column(k)[j].as_py() for k in range(keys))


def run_starts(batch: pa.RecordBatch, keys: int) -> np.ndarray:
    """Where a new key begins; the key columns hold numbers without nulls."""
    new = np.zeros(batch.num_rows, dtype=bool)
    new[0] = True
    for k in range(keys):
        values = batch.column(k).to_numpy(zero_copy_only=False)
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def merge_labels(n: int, u: np.ndarray, v: np.ndarray, labels: np.ndarray | None = None) -> np.ndarray:
    """Smallest member index of each member's group when the pairs (u, v) are joined; vectorised union-find."""
    labels = np.arange(n) if labels is None else labels
    while len(u):
        a, b = labels[u], labels[v]
        apart = a != b
        if not apart.any():
            break
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = labels[labels]
            if np.array_equal(up, labels):
                break
            labels = up
    return labels


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node with an edge to another one: root is the smallest node it can reach.

    Alternating large-star and small-star rounds over the edge table: only minima per node are gathered, with a
    map-side combine, and the joins against them are plain shuffles that Spark can split where a node is a hub.
    """

    def shrink(pairs: DataFrame) -> tuple[DataFrame, tuple]:
        kept = pin(pairs.where("lo < hi").distinct())
        mark = kept.agg(F.count(F.lit(1)), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first()
        return kept, tuple(mark)

    def to_smallest(links: DataFrame) -> DataFrame:
        """Smallest neighbour of u or u itself, with u's rows."""
        least = pin(links.groupBy("u").agg(F.min("v").alias("m"))).select(
            F.col("u").alias("w"), F.least("u", "m").alias("m")
        )
        return links.join(least, F.col("u") == F.col("w")).select("u", "v", "m")

    x, y = quoted(a), quoted(b)
    found, mark = shrink(edges.select(F.least(x, y).alias("lo"), F.greatest(x, y).alias("hi")))
    while mark[0]:
        both = found.selectExpr("lo as u", "hi as v").unionByName(found.selectExpr("hi as u", "lo as v"))
        large, _ = shrink(to_smallest(both).where("v > u").selectExpr("least(m, v) as lo", "greatest(m, v) as hi"))
        small = to_smallest(large.selectExpr("hi as u", "lo as v"))
        small = small.selectExpr("m as lo", "v as hi").unionByName(small.selectExpr("m as lo", "u as hi"))
        found, after = shrink(small)
        if after == mark:
            break
        mark = after
    return found.selectExpr("hi as node", "lo as root").unionByName(found.selectExpr("lo as node", "lo as root").distinct())
