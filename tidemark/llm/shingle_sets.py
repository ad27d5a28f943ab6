"""Links between texts whose sets of word shingles are alike, which fingerprints of few differing bits do not show.

Candidates come from MinHash: ``BANDS`` keys, each of ``ROWS`` minima, so two sets of Jaccard similarity 0.8 share a key with
probability 1 - (1 - 0.8^6)^30 = 0.9999, more alike ones with a higher one. Every link is confirmed on the sets themselves.
Texts of equal words are one set. Only keys whose sets lie in more than one group are looked at, in two passes: first every set
is compared with a few centres of its keys, which joins a dense group by a number of pairs that grows with its size, then with
all sets of its keys that are still in another group. The second grows with the square of a dense group that is just not alike.

Texts without words have no keys; they link by their fingerprint, zero.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from tidemark.llm import simhash
from tidemark.llm.common import connected_components, merge_labels, quoted, row_key, text_of
from tidemark.session import pin

BANDS, ROWS = 30, 6
ONE_TASK_LINKS = 200_000  # links between groups joined in one task
CENTRES = 3  # centres that a set is compared with in the first pass
MINIMA_ROWS = 1 << 11
KEPT_SETS = 256  # sets remembered by a task that confirms links
_RNG = np.random.default_rng(20)
FACTORS = _RNG.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _RNG.integers(0, 1 << 64, BANDS * ROWS, dtype=np.uint64)


def shingle_set(text: str, shingle: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles."""
    return np.unique(np.concatenate([np.zeros(0, "<u8"), *simhash.shingled(text, shingle)[2]]))


def band_keys(hashes: np.ndarray) -> list[int]:
    """One key per band for a set of hashes; none for an empty set."""
    if not len(hashes):
        return []
    minima = np.full(len(FACTORS), ~np.uint64(0))
    for at in range(0, len(hashes), MINIMA_ROWS):
        mixed = hashes[at : at + MINIMA_ROWS] * FACTORS[:, None] + OFFSETS[:, None]
        np.minimum(minima, mixed.min(axis=1), out=minima)
    return [xxhash.xxh64_intdigest(band.tobytes(), i) for i, band in enumerate(minima.reshape(BANDS, ROWS))]


def signed(values: list[int]) -> np.ndarray:
    return np.array(values, dtype=np.uint64).view(np.int64)


def with_sketches(docs: DataFrame, shingle: int) -> DataFrame:
    """Adds fp, key (of the words), size (of the set) and bands."""

    @pandas_udf("struct<fp:bigint,key:bigint,size:bigint,bands:array<bigint>>")
    def sketched(texts: pd.Series) -> pd.DataFrame:
        prints, keys, sizes, bands = [], [], [], []
        for text in texts:
            words, total, blocks = simhash.shingled(text, shingle)
            held = list(blocks)
            hashes = np.unique(np.concatenate([np.zeros(0, "<u8"), *held]))
            prints.append(simhash.majority(held, total))
            keys.append(xxhash.xxh64_intdigest(words))
            sizes.append(len(hashes))
            bands.append(signed(band_keys(hashes)))
        return pd.DataFrame({"fp": signed(prints), "key": signed(keys), "size": sizes, "bands": bands})

    return docs.withColumn("sketch", sketched("text")).select("id", "row", "sketch.*")


def confirmed(pairs: DataFrame, texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """The pairs (x, y) of sets that are alike, with their groups (x_root, y_root)."""
    x = texts.select(F.col("key").alias("x"), F.col("text").alias("x_text"))
    y = texts.select(F.col("key").alias("y"), F.col("text").alias("y_text"))
    both = pairs.join(x, "x").join(y, "y").select("x", "y", "x_root", "y_root", "x_text", "y_text")

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[int, np.ndarray] = {}

        def of(key: int, text: pa.Scalar) -> np.ndarray:
            if key not in sets:
                if len(sets) >= KEPT_SETS:
                    sets.clear()
                sets[key] = shingle_set(text.as_py(), shingle)
            return sets[key]

        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            for i, (a, b) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                left, right = of(a, batch.column(4)[i]), of(b, batch.column(5)[i])
                common = len(np.intersect1d(left, right, assume_unique=True))
                keep[i] = common >= similarity * (len(left) + len(right) - common) - 1e-9
            if keep.any():
                yield batch.select([2, 3]).filter(pa.array(keep))

    return both.mapInArrow(alike, "x_root bigint, y_root bigint")


def components(links: DataFrame) -> DataFrame:
    """(node, root) of the pinned links (x_root, y_root).

    Up to ``ONE_TASK_LINKS`` of them, 3 MB, are joined by one task, which spares the driver dozens of small jobs; more take the rounds of
    ``connected_components``. Both give the smallest node reachable.
    """
    if links.count() > ONE_TASK_LINKS:
        return connected_components(links, "x_root", "y_root")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [np.stack([c.to_numpy() for c in b.columns]) for b in batches if b.num_rows]
        if parts:
            ends = np.concatenate(parts, axis=1)
            nodes, number = np.unique(ends, return_inverse=True)
            u, v = number.reshape(ends.shape)
            roots = nodes[merge_labels(len(nodes), u, v)]
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(roots)], names=["node", "root"])

    return links.coalesce(1).mapInArrow(joined, "node bigint, root bigint")


def merged(groups: DataFrame, links: DataFrame) -> DataFrame:
    """``groups`` (key, root and others) with the roots joined that ``links`` joins."""
    joined = components(links).select("node", F.col("root").alias("new_root"))
    others = [c for c in groups.columns if c != "root"]
    return pin(
        groups.join(joined, F.col("root") == F.col("node"), "left").select(*others, F.coalesce("new_root", "root").alias("root"))
    )


def shared_keys(members: DataFrame) -> DataFrame:
    """The rows (bucket, key, size, root) of buckets that hold more than one group."""
    mixed = members.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    return members.join(mixed.select("bucket"), "bucket")


def grouped(
    docs: DataFrame, id_col: str, text_col: str, shingle: int, radius: int, similarity: float
) -> tuple[DataFrame, DataFrame]:
    """As ``simhash.grouped``, with the links of similar sets of shingles besides those of fingerprints."""
    whole = docs.select(quoted(id_col).alias("id"), row_key(id_col, text_col).alias("row"), text_of(text_col).alias("text"))
    rows = pin(with_sketches(whole, shingle))
    classes = simhash.fingerprint_classes(rows, radius)
    one = F.min(F.struct("row", "fp", "size", "bands")).alias("one")
    sets = rows.where("size > 0").groupBy("key").agg(one).select("key", "one.*")
    sets = sets.join(classes, F.col("fp") == F.col("own_fp")).select("key", "row", "size", "bands", "root")
    members = pin(shared_keys(sets.select(F.explode("bands").alias("bucket"), "key", "row", "size", "root")))
    wanted = pin(members.select("key", F.col("row").alias("text_row")).distinct())
    texts = pin(
        whole.join(wanted, F.col("row") == F.col("text_row")).select("key", "text").dropDuplicates(["key"])
    )
    members = members.drop("row")
    near = F.least("size", "other_size") >= F.lit(similarity) * F.greatest("size", "other_size") - 1e-9
    ordered = (
        F.least("key", "other").alias("x"), F.greatest("key", "other").alias("y"),
        F.when(F.col("key") < F.col("other"), F.col("root")).otherwise(F.col("other_root")).alias("x_root"),
        F.when(F.col("key") < F.col("other"), F.col("other_root")).otherwise(F.col("root")).alias("y_root"),
    )

    centres = [
        F.min(F.struct(F.xxhash64("key", F.lit(i)).alias("turn"), "key", "size", "root")).alias(f"c{i}") for i in range(CENTRES)
    ]
    stars = members.join(members.groupBy("bucket").agg(*centres), "bucket").select(
        "key", "size", "root", F.explode(F.array(*[
            F.struct(F.lit(i).alias("i"), F.col(f"c{i}.key").alias("other"), F.col(f"c{i}.size").alias("other_size"),
                     F.col(f"c{i}.root").alias("other_root")) for i in range(CENTRES)
        ])).alias("c"),
    ).select("key", "size", "root", "c.*").where(near & (F.col("root") != F.col("other_root")))
    shared = stars.groupBy("key", "root", "i", "other", "other_root").count()
    best = shared.groupBy("key", "root", "i").agg(F.max(F.struct("count", "other", "other_root")).alias("best"))
    first = best.select("key", "root", "best.*").select(*ordered).distinct()
    found = pin(confirmed(first, texts, shingle, similarity).distinct())

    classes = merged(classes, found)
    members = pin(shared_keys(merged(members, found)))
    sizes = members.groupBy("bucket", "root").count()
    largest = sizes.groupBy("bucket").agg(F.max(F.struct("count", F.col("root").alias("main")))["main"].alias("main"))
    aside = members.join(largest, "bucket").where("root <> main").select(
        "bucket", F.col("key").alias("other"), F.col("size").alias("other_size"), F.col("root").alias("other_root")
    )
    rest = members.join(aside, "bucket").where(near & (F.col("root") != F.col("other_root"))).select(*ordered).distinct()
    return rows, merged(classes, pin(confirmed(rest, texts, shingle, similarity).distinct()))
