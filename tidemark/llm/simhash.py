"""SimHash near-duplicates: 64-bit fingerprints, bit-sliced comparison of candidate buckets, connected components.

A fingerprint bit is 1 where more than half the hashes of the text's word shingles have it. Two fingerprints link
when at most ``radius`` bits differ. By the pigeonhole principle linked fingerprints agree on one of ``radius + 1``
bit ranges, so every distinct fingerprint enters one bucket per range (on very large inputs, one per range and part
of the other bits, which keeps buckets short). A bucket is stored as bit planes: word w of plane b holds bit b of 64
members. Each member is compared with all words at once: the planes that differ from its own bits are added into
vertical carry-save counters, and words whose 64 members all exceed the radius are abandoned. A bucket leaves only
the links of a spanning forest, never its pairs; buckets beyond ``BUCKET_ROWS`` are compared tile by tile.

Defined results: null and empty texts, and texts without words, have fingerprint zero and link like any other; texts
with fewer words than a shingle are hashed whole; rows that repeat share their fingerprint; null ids are passed
over when the smallest id is sought. Only the id and text are read; results hold the id and the columns named here.
Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from tidemark.llm import shingle_sets
from tidemark.llm.common import (
    connected_components, fresh, key_runs, merge_labels, quoted, row_key, run_starts, text_of,
)
from tidemark.session import pin

SEED = 42
BUCKET_ROWS = 2_048  # distinct fingerprints compared at a time
ONE_LEVEL_ROWS = 4_000_000  # distinct fingerprints up to which one bit range per bucket key is enough
PAIR_WORDS = 1 << 15  # (member, word) states held at a time
HASH_ROWS = 1 << 16
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def shingled(text: str, shingle: int) -> tuple[bytes, int, Iterator[np.ndarray]]:
    """Words joined by single blanks, number of shingles, and their hashes in blocks."""
    words = text.encode().translate(LOWER).split()
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1) if words else ends
    if len(words) > shingle:
        starts, ends = starts[: len(words) - shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]

    def blocks() -> Iterator[np.ndarray]:
        digest = xxhash.xxh64_intdigest
        for at in range(0, len(starts), HASH_ROWS):
            cuts = zip(starts[at : at + HASH_ROWS].tolist(), ends[at : at + HASH_ROWS].tolist())
            yield np.array([digest(joined[a:b], SEED) for a, b in cuts], dtype="<u8")

    return joined, len(starts), blocks()


def majority(blocks: Iterable[np.ndarray], total: int) -> int:
    """Bits that more than half of ``total`` hashes have."""
    ones = np.zeros(64, dtype=np.int64)
    for hashes in blocks:
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprint(text: str, shingle: int) -> int:
    """Unsigned fingerprint of one text; repeated shingles count as often as they occur."""
    _, total, blocks = shingled(text, shingle)
    return majority(blocks, total)


def with_fingerprints(docs: DataFrame, text_col: str, shingle: int, out: str = "fingerprint") -> DataFrame:
    @pandas_udf("bigint")
    def hashed(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64))

    return docs.withColumn(out, hashed(text_of(text_col)))


def bit_ranges(width: int, parts: int) -> list[tuple[int, int]]:
    """(shift, bits) of ``parts`` ranges that split ``width`` bits as evenly as possible."""
    edges = [width * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def bucket_keys(shift: int, bits: int, radius: int, levels: int) -> list:
    """Key columns of the buckets of one bit range: the range itself, or with each part of the other bits too."""
    value = F.col("fp")
    own = value.bitwiseAND(F.lit(signed(((1 << bits) - 1) << shift)))
    if levels == 1:
        return [F.xxhash64(F.lit(shift), own)]
    others = [b for b in range(64) if not shift <= b < shift + bits]
    keys = []
    for a, n in bit_ranges(len(others), radius + 1):
        mask = sum(1 << b for b in others[a : a + n])
        keys.append(F.xxhash64(F.lit(shift), F.lit(a), own, value.bitwiseAND(F.lit(signed(mask)))))
    return keys


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def links_within(values: np.ndarray, radius: int) -> np.ndarray:
    """Smallest member index each member reaches by links, for one bucket of distinct fingerprints."""
    n = len(values)
    words = -(-n // 64)
    padded = np.zeros(words * 64, dtype="<u8")
    padded[:n] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    planes = np.packbits(bits, axis=0, bitorder="little").T.copy().view("<u8")  # [bit, word]
    real = np.full(words, ~np.uint64(0))
    if n % 64:
        real[-1] = np.uint64((1 << n % 64) - 1)
    labels, step = np.arange(n), max(1, PAIR_WORDS // words)
    for start in range(0, n, step):
        own = np.arange(start, min(n, start + step))
        member, word = np.repeat(own, words), np.tile(np.arange(words), len(own))
        later = word >= member // 64  # each pair once
        hits = compared(planes, values, member[later], word[later], radius, real)
        labels = merge_labels(n, *hits, labels)
    return labels


def compared(
    planes: np.ndarray, values: np.ndarray, member: np.ndarray, word: np.ndarray, radius: int, real: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of members within ``radius``, from states (member, word of 64 others)."""
    digits = max(1, (radius + 1).bit_length())
    counters = [np.zeros(len(member), dtype=np.uint64) for _ in range(digits)]
    beyond = ~real[word]
    own = values[member]
    for b in range(64):
        carry = planes[b, word] ^ (np.uint64(0) - ((own >> np.uint64(b)) & np.uint64(1)))
        for d in range(digits):
            counters[d], carry = counters[d] ^ carry, counters[d] & carry
        beyond |= carry | above(counters, radius)
        if b % 8 == 7:
            live = beyond != ~np.uint64(0)
            if not live.all():
                member, word, own, beyond = member[live], word[live], own[live], beyond[live]
                counters = [c[live] for c in counters]
            if not len(member):
                break
    within = np.unpackbits((~beyond).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    row, bit = np.nonzero(within)
    u, v = member[row], word[row] * 64 + bit
    return u[u != v], v[u != v]


def above(counters: list[np.ndarray], limit: int) -> np.ndarray:
    """Where the vertical counters exceed ``limit``, compared from the highest digit down."""
    more = np.zeros_like(counters[0])
    same = ~more
    for d in reversed(range(len(counters))):
        if limit >> d & 1:
            same = same & counters[d]
        else:
            more |= same & counters[d]
            same = same & ~counters[d]
    return more


def fingerprint_links(distinct: DataFrame, radius: int) -> DataFrame:
    """(a, b): links of a spanning forest of every bucket, from a table of distinct fingerprints ``fp``."""
    spark = distinct.sparkSession
    levels = 1 if distinct.count() <= ONE_LEVEL_ROWS else 2
    keys = [k for shift, bits in bit_ranges(64, radius + 1) for k in bucket_keys(shift, bits, radius, levels)]
    rows = distinct.select("fp", F.explode(F.array(*keys)).alias("key"))
    crowded = pin(
        rows.groupBy("key").count().where(F.col("count") > BUCKET_ROWS)
        .select(F.col("key").alias("crowd"), F.ceil(F.col("count") / BUCKET_ROWS).cast("int").alias("tiles"))
    )
    own = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("tiles") - 1), lambda t: F.least(t, own) * F.col("tiles") + F.greatest(t, own)
    )
    tiled = rows.join(crowded, F.col("key") == F.col("crowd"), "left").select(
        "key", "fp",
        F.explode(F.when(F.col("tiles").isNull(), F.array(F.lit(0))).otherwise(pairs.cast("array<int>"))).alias("tile"),
    )
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = tiled.select("key", "tile", "fp").repartition(width, "key", "tile").sortWithinPartitions("key", "tile")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in key_runs(batches, 2):
            starts = run_starts(batch, 2)
            values = batch.column(2).to_numpy().view(np.uint64)
            u, v = [], []
            for a, b in zip(starts, np.append(starts[1:], len(values))):
                if b - a > 1:
                    bucket = values[a:b]
                    labels = links_within(bucket, radius)
                    child = np.flatnonzero(labels != np.arange(b - a))
                    u.append(bucket[child])
                    v.append(bucket[labels[child]])
            if u:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x).view(np.int64)) for x in (u, v)], names=["a", "b"]
                )

    return sorted_rows.mapInArrow(linked, "a bigint, b bigint")


def grouped(
    docs: DataFrame, id_col: str, text_col: str, shingle: int, radius: int
) -> tuple[DataFrame, DataFrame]:
    """Rows (id, row, fp) and classes (fp, root): fingerprints with the same root reach each other by links."""
    rows = pin(
        with_fingerprints(
            docs.select(
                quoted(id_col).alias("id"), row_key(id_col, text_col).alias("row"), text_of(text_col).alias("text")
            ), "text", shingle, "fp",
        ).select("id", "row", "fp")
    )
    return rows, fingerprint_classes(rows, radius)


def fingerprint_classes(rows: DataFrame, radius: int) -> DataFrame:
    """(own_fp, root) of every distinct fingerprint."""
    distinct = pin(rows.select("fp").distinct())
    roots = connected_components(fingerprint_links(distinct, radius), "a", "b")
    return pin(
        distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
            F.col("fp").alias("own_fp"), F.coalesce("root", "fp").alias("root")
        )
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, radius: int = 4
) -> DataFrame:
    """(id, fingerprint as 16 hex digits, component_id: the smallest id reachable by links) of every row."""
    rows, classes = grouped(docs, id_col, text_col, shingle, radius)
    firsts = pin(rows.groupBy("fp").agg(F.min("id").alias("first_id")))
    placed = firsts.join(classes, F.col("fp") == F.col("own_fp"))
    smallest = pin(placed.groupBy("root").agg(F.min("first_id").alias("component_id")))
    of_print = pin(classes.join(smallest, "root").select("own_fp", "component_id"))
    return rows.join(of_print, F.col("fp") == F.col("own_fp"), "left").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one_per_group(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, radius: int = 4,
    similarity: float | None = None,
) -> DataFrame:
    """One row of every group of near-duplicates, the one with the smallest id, with all its columns.

    With ``similarity``, texts whose sets of shingles have at least that Jaccard similarity link too, however far apart their
    fingerprints are. A row without an id stays only where no row of its group has one.
    """
    if similarity is None:
        rows, classes = grouped(docs, id_col, text_col, shingle, radius)
    else:
        rows, classes = shingle_sets.grouped(docs, id_col, text_col, shingle, radius, similarity)
    first = F.min(F.struct(F.col("id").isNull().alias("blank"), F.col("id"), F.col("row"))).alias("first")
    firsts = pin(rows.groupBy("fp").agg(first))
    placed = firsts.join(classes, F.col("fp") == F.col("own_fp"))
    kept_row = fresh(docs.columns, "kept_row")
    kept = pin(placed.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias(kept_row)))
    chosen = docs.join(kept, row_key(id_col, text_col) == quoted(kept_row), "left_semi")
    if rows.groupBy("row").count().where("count > 1").isEmpty():
        return chosen
    mark = fresh(docs.columns, "row_mark")  # identical rows: one of them
    return chosen.withColumn(mark, row_key(id_col, text_col)).dropDuplicates([mark]).drop(mark)
