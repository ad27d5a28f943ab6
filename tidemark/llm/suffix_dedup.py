"""Removal of byte strings that occur more than once, with sorted suffixes.

A byte goes when it is covered by a string of ``length`` bytes that starts at two or more places of the input. The
suffixes that decide this are those at anchors: an anchor is the place of the smallest hash among the places of a
window where ``KEY`` bytes still fit, so equal windows have their anchor at the same place inside, and the windows of an anchor
form one stretch of text (its context). The job runs in four steps.

1. Every text yields its anchors: place, range of windows, a hash of the ``KEY`` bytes that follow the anchor, and a hash of
   the context. Leading hashes are counted with a map-side combine: an anchor whose leading bytes occur once is done,
   one whose leading bytes always have the same context is repeated throughout, and so is a context that occurs twice.
2. For leading bytes with several contexts, one copy of each context is cut out of its text. Sampled splitters range-partition the suffixes by
   their leading bytes and then by what follows them, so equal suffixes may spread over buckets.
3. A bucket sorts its suffixes by multikey quicksort on eight bytes at a time, and the reversed text before the
   anchors likewise. Two suffixes share a window that begins o bytes before the anchor when they fall into the same class
   at depth ``length`` - o of one order and depth o of the other; common prefixes of neighbours give the classes.
4. Across boundaries: a window can have its equal in another bucket only when its text from the anchor on is shared with the
   bucket's first or last suffix. Suffixes with such windows are range-partitioned once more, by the text before the anchor read
   backwards, and compared in these buckets. What shares its text with the ends of a bucket in both orders is left; one hash per
   class of it is compared with those of the other buckets.

Contexts and documents are found again by (row, place), where a row is known by id and text.

Defined results: null texts are empty and stay empty, shorter texts than ``length`` lose nothing, but a row that repeats id
and text is another document and removes its twin's bytes like any copy does. Cuts may split characters, so the
kept text is returned as bytes. Only ids and texts are read. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.common import by_batch, joined, key_runs, quoted, row_key, text_of
from tidemark.session import pin

KEY = 64  # leading bytes; a quarter of the length when that is less, but eight at least
PLACE_BITS = 22
BUCKET_ROWS = 8_192  # suffixes sorted at a time; a longer run of one leading key is compared across the cut
PART_BYTES = 1 << 21  # bytes whose anchors are sought at a time


def key_bytes(length: int) -> int:
    if length < 16:
        raise ValueError("strings of fewer than 16 bytes can't be sought")
    return max(8, min(KEY, length // 4))


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number that orders like them."""
    padded = np.concatenate([data, np.zeros(7, np.uint8)])
    return np.lib.stride_tricks.as_strided(padded, (len(data), 8), (1, 1)).copy().view(">u8").ravel().astype(np.uint64)


def anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, last window) of one text, in order; windows without gaps from 0 on."""
    count, span = len(data) - length + 1, length - key_bytes(length) + 1
    words = words_at(data)[: count + span - 1]
    words = words * np.uint64(0x9E3779B97F4A7C15)
    words ^= words >> np.uint64(32)
    words = words * np.uint64(0xD6E8FEB86659FD93)
    bits = np.uint64(PLACE_BITS)
    ranked = (words >> bits << bits) | np.arange(len(words), dtype=np.uint64)  # ties: the first
    blocks = -(-len(ranked) // span)
    grid = np.full(blocks * span, ~np.uint64(0))
    grid[: len(ranked)] = ranked
    grid = grid.reshape(blocks, span)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:count], ahead[span - 1 : span - 1 + count])
    place = (least & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    return place[first], first, np.append(first[1:] - 1, count - 1)


def anchor_rows(length: int):
    """(row, text) to (row, anchor, low, high, lead, context, context2): places in bytes, hashes."""
    key = key_bytes(length)

    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, texts = batch.column(0).to_pylist(), batch.column(1)
        source: list[int] = []
        places, leads, contexts = [], [], []
        for i, row in enumerate(rows):
            text = texts[i].as_py().encode()
            if len(text) < length:
                continue
            data = np.frombuffer(text, np.uint8)
            for start in range(0, len(text) - length + 1, PART_BYTES):
                found = np.stack(anchors(data[start : start + PART_BYTES + length - 1], length), axis=1) + start
                places.append(found)
                source += [row] * len(found)
                for anchor, low, high in found.tolist():
                    leads.append(xxhash.xxh3_64_intdigest(text[anchor : anchor + key]))
                    contexts.append(xxhash.xxh3_128_digest(text[low : high + length]))
        place = np.concatenate(places) if places else np.zeros((0, 3), np.int64)
        context = np.frombuffer(b"".join(contexts), "<i8").reshape(-1, 2)
        columns = [np.array(source, np.int64), *place.T, np.array(leads, np.uint64).view(np.int64), *context.T]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=ANCHOR_COLUMNS)

    return scan


ANCHOR_COLUMNS = ["row", "anchor", "low", "high", "lead", "context", "context2"]
ANCHOR_SCHEMA = ", ".join(f"{c} bigint" for c in ANCHOR_COLUMNS)


def multikey_order(columns: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows by (group, columns), and the number of leading columns each shares with the one before
    it in that order (-1 where the group changes).

    Multikey quicksort: rows are split by one column at a time, and only runs that are still tied go on.
    """
    order = np.argsort(groups, kind="stable")
    shared = np.full(len(order), columns.shape[1], dtype=np.int64)
    run = np.append(0, np.cumsum(groups[order][1:] != groups[order][:-1])) if len(order) else order
    shared[np.flatnonzero(np.append(True, run[1:] != run[:-1]))] = -1
    active = np.arange(len(order))
    for depth in range(columns.shape[1]):
        sizes = np.bincount(run[active])
        active = active[sizes[run[active]] > 1]
        if not len(active):
            break
        value = columns[order[active], depth]
        by = np.lexsort((value, run[active]))
        order[active], value = order[active][by], value[by]
        split = np.append(False, (value[1:] != value[:-1]) & (run[active][1:] == run[active][:-1]))
        shared[active[split]] = depth
        head = np.append(True, run[active][1:] != run[active][:-1]) | split
        run[active] = np.cumsum(head) - 1
    return order, shared


def common_bytes(order: np.ndarray, shared: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Bytes each suffix shares with the one before it, from whole shared columns and the bytes of the next one."""
    width = texts.shape[1]
    out = np.where(shared < 0, -1, np.minimum(shared * 8, width))
    part = np.flatnonzero((shared >= 0) & (shared * 8 < width))
    for step in range(8):
        at = np.minimum(shared[part] * 8 + step, width - 1)
        same = (texts[order[part], at] == texts[order[part - 1], at]) & (shared[part] * 8 + step < width)
        part = part[same]
        out[part] += 1
    return out


def classes(rank_of: np.ndarray, common: np.ndarray, depth: int) -> np.ndarray:
    """For every row, the number of its class: rows that share ``depth`` bytes with their neighbours in the order."""
    return np.maximum.accumulate(np.where(common < depth, np.arange(len(common)), 0))[rank_of]


def padded(pieces: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(len(pieces), width)


class Windows:
    """Windows of a bucket's suffixes, sorted both ways: (member, offset) of each, whether it is repeated in the bucket,
    and its class. A window begins ``offset`` bytes before its suffix's anchor."""

    def __init__(self, batch: pa.RecordBatch, length: int):
        lead, anchor, low, high, limit = (batch.column(n).to_numpy() for n in ("lead", "anchor", "low", "high", "limit"))
        self.back, self.after = batch.column("back").to_pylist(), batch.column("suffix").to_pylist()
        reach = length - key_bytes(length)
        nearest, farthest = np.maximum(anchor - high, length - limit), anchor - low
        self.views = []
        for texts in (padded([t[:length] for t in self.after], -(-length // 8) * 8), padded(self.back, -(-reach // 8) * 8)):
            order, shared = multikey_order(np.ascontiguousarray(texts).view(">u8").astype(np.uint64), lead)
            rank = np.empty(len(order), dtype=np.int64)
            rank[order] = np.arange(len(order))
            self.views.append((rank, common_bytes(order, shared, texts)))
        found = [(np.zeros(0, np.int64),) * 4]
        for offset in range(reach + 1):
            rows = np.flatnonzero((nearest <= offset) & (offset <= farthest))
            if len(rows):
                here = classes(*self.views[0], length - offset)[rows] * len(lead) + classes(*self.views[1], offset)[rows]
                _, number, count = np.unique(here, return_inverse=True, return_counts=True)
                found.append((rows, np.full(len(rows), offset), count[number] > 1, here))
        self.member, self.offset, self.repeated, self.kind = (np.concatenate(x) for x in zip(*found))
        self.repeated = self.repeated.astype(bool)
        self.start = anchor[self.member] - self.offset

    def shared_with_ends(self, view: int, first: bool, last: bool) -> np.ndarray:
        """Bytes that each suffix shares, in one of the orders, with the bucket's first or last one."""
        rank, common = self.views[view]
        most = np.full(len(rank), -1, dtype=np.int64)
        for end in [0] * first + [len(rank) - 1] * last:
            at, out = rank[end], np.full(len(rank), 1 << 30, dtype=np.int64)
            out[at + 1 :] = np.minimum.accumulate(common[at + 1 :])
            out[:at] = np.minimum.accumulate(common[at:0:-1])[::-1]
            most = np.maximum(most, out[rank])
        return most

    def ranges(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(member, first start, last start) of runs of repeated windows."""
        by = np.lexsort((self.start[self.repeated], self.member[self.repeated]))
        own, begin = self.member[self.repeated][by], self.start[self.repeated][by]
        heads = np.flatnonzero(np.append(True, (own[1:] != own[:-1]) | (begin[1:] != begin[:-1] + 1))[: len(own)])
        ends = np.append(heads[1:], len(own))[: len(heads)] - 1
        return own[heads], begin[heads], begin[ends]

    def one_of_each(self, wanted: np.ndarray) -> np.ndarray:
        """One of the wanted windows of each class; those repeated in the bucket too, so that others find them."""
        which = np.flatnonzero(wanted)
        _, one = np.unique(np.stack([self.offset[which], self.kind[which]]), axis=1, return_index=True)
        return which[one]

    def text(self, window: int, length: int) -> bytes:
        member, offset = self.member[window], self.offset[window]
        return self.back[member][:offset][::-1] + self.after[member][: length - offset]


SUFFIX_FIELDS = [("lead", pa.int64()), ("row", pa.int64()), ("anchor", pa.int64()), ("low", pa.int64()), ("high", pa.int64()),
                 ("limit", pa.int64()), ("back", pa.binary()), ("suffix", pa.binary())]
SUFFIX_SCHEMA = "lead bigint, row bigint, anchor bigint, low bigint, high bigint, limit bigint, back binary, suffix binary"


def bucket_rows(length: int, second: bool):
    """Sorted suffixes to rows of the same form and a hash. Without suffix: a range (low, high) of repeated windows.

    The first time, suffixes come back that share text with other buckets, with the number of bytes as ``limit``; the
    second time, windows (low) to be compared with those of other buckets by their hash.
    """

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        previous, open_before = None, True
        for batch in gathered(key_runs(batches, 1, BUCKET_ROWS)):
            if previous is not None:
                cut = previous.column(0)[-1].as_py() == batch.column(0)[0].as_py()
                yield settled(previous, open_before, cut)
                open_before = cut
            previous = batch
        if previous is not None:
            yield settled(previous, open_before, True)

    def settled(batch: pa.RecordBatch, first: bool, last: bool) -> pa.RecordBatch:
        windows = Windows(batch, length)
        member, low, high = windows.ranges()
        row = batch.column("row").to_numpy()
        parts = [result({"row": row[member], "low": low, "high": high})]
        ends = windows.shared_with_ends(1 if second else 0, first, last)
        if second:
            ask = windows.one_of_each(windows.offset <= ends[windows.member])
            parts.append(result({
                "row": row[windows.member[ask]], "low": windows.start[ask], "high": windows.start[ask],
                "hash": [xxhash.xxh3_128_digest(windows.text(w, length)) for w in ask],
            }))
        else:
            anchor, start = batch.column("anchor").to_numpy(), batch.column("low").to_numpy()
            again = np.flatnonzero(ends >= length - (anchor - start))
            taken = batch.take(pa.array(again))
            parts.append(result({n: taken.column(n) for n in batch.schema.names if n != "limit"} | {"limit": np.minimum(ends, length)[again]}))
        return pa.Table.from_batches(parts).combine_chunks().to_batches()[0] if any(p.num_rows for p in parts) else parts[0]

    def result(columns: dict) -> pa.RecordBatch:
        fields = [*SUFFIX_FIELDS, ("hash", pa.binary())]
        size = len(columns["row"])
        arrays = [
            columns[n] if isinstance(columns.get(n), pa.Array) else pa.array(columns.get(n, [None] * size), kind)
            for n, kind in fields
        ]
        return pa.RecordBatch.from_arrays(arrays, names=[n for n, _ in fields])

    return sort


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of whole keys joined to at most ``BUCKET_ROWS`` rows, or one that is larger by itself."""
    parts, rows = [], 0
    for batch in batches:
        if parts and rows + batch.num_rows > BUCKET_ROWS:
            yield joined(parts)
            parts, rows = [], 0
        parts.append(batch)
        rows += batch.num_rows
    if parts:
        yield joined(parts)


def cut_suffixes(length: int):
    """(row, text, cuts) to suffixes: what stands before the anchor in its context, backwards, and from it on."""

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for row, text, cuts in zip(*(batch.column(c).to_pylist() for c in ("row", "text", "cuts"))):
            data = text.encode()
            for c in cuts:
                anchor, low, high = c["anchor"], c["low"], c["high"]
                out.append((c["lead"], row, anchor, low, high, length, data[low:anchor][::-1], data[anchor : high + length]))
        columns = list(zip(*out)) if out else [()] * 8
        arrays = [pa.array(c, t) for c, (_, t) in zip(columns, SUFFIX_FIELDS)]
        return pa.RecordBatch.from_arrays(arrays, names=[n for n, _ in SUFFIX_FIELDS])

    return cut


def repeated_ranges(docs: DataFrame, length: int) -> DataFrame:
    """(row, low, high): ranges of window starts that are repeated, of documents (row, text)."""
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = docs.select("row", "text").mapInArrow(by_batch(anchor_rows(length)), ANCHOR_SCHEMA)
    leads = pin(
        found.groupBy(F.col("lead").alias("own_lead"))
        .agg(F.count(F.lit(1)).alias("n"), (F.min("context") != F.max("context")).alias("mixed"))
        .where("n > 1").select("own_lead", "mixed")
    )
    live = pin(found.join(leads, F.col("lead") == F.col("own_lead")).drop("own_lead"))
    mixed = live.where("mixed")
    contexts = pin(
        mixed.groupBy(F.col("lead").alias("c_lead"), F.col("context").alias("c1"), F.col("context2").alias("c2"))
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "anchor", "low", "high")).alias("one"))
    )
    whole = contexts.where("n > 1").select("c_lead", "c1", "c2")
    same = (F.col("lead") == F.col("c_lead")) & (F.col("context") == F.col("c1")) & (F.col("context2") == F.col("c2"))
    copied = live.where("not mixed").unionByName(mixed.join(whole, same).select(*live.columns)).select("row", "low", "high")
    wanted = (
        contexts.select(F.col("c_lead").alias("lead"), "one.*").groupBy(F.col("row").alias("own_row"))
        .agg(F.collect_list(F.struct("lead", "anchor", "low", "high")).alias("cuts"))
    )
    suffixes = (
        docs.join(wanted, F.col("row") == F.col("own_row")).select("row", "text", "cuts")
        .mapInArrow(by_batch(cut_suffixes(length)), SUFFIX_SCHEMA)
    )
    forward = suffixes.repartitionByRange(width, "suffix", "row", "anchor").sortWithinPartitions("suffix")
    once = pin(forward.mapInArrow(bucket_rows(length, second=False), f"{SUFFIX_SCHEMA}, hash binary"))
    again = once.where("suffix is not null").drop("hash")
    backward = again.repartitionByRange(width, "lead", "back", "row", "anchor").sortWithinPartitions("lead", "back")
    twofold = pin(backward.mapInArrow(bucket_rows(length, second=True), f"{SUFFIX_SCHEMA}, hash binary"))
    ranges = once.where("suffix is null").unionByName(twofold).select("row", "low", "high", "hash")
    asked = ranges.where("hash is not null")
    twice = pin(asked.groupBy(F.col("hash").alias("own_hash")).count().where("count > 1").select("own_hash"))
    crossing = asked.join(twice, F.col("hash") == F.col("own_hash")).select("row", "low", "high")
    return copied.unionByName(ranges.where("hash is null").select("row", "low", "high")).unionByName(crossing)


def removed_spans(cuts: list | None, length: int) -> list[tuple[int, int]]:
    """Maximal runs of removed bytes from ranges of window starts."""
    spans: list[tuple[int, int]] = []
    for low, high in sorted((c["low"], c["high"]) for c in cuts or ()):
        if spans and low <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(spans[-1][1], high + length))
        else:
            spans.append((low, high + length))
    return spans


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400, with_bytes: bool = True
) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, and ``kept``: the remaining bytes, when wanted) of every row."""
    rows = docs.select(
        quoted(id_col).alias("id"), row_key(id_col, text_col).alias("row"), text_of(text_col).alias("text")
    )
    ranges = repeated_ranges(rows.select("row", "text"), length)
    cuts = ranges.groupBy(F.col("row").alias("own_row")).agg(F.collect_set(F.struct("low", "high")).alias("cuts"))
    kind = rows.schema["id"].dataType

    def kept(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for text, ranges in zip(batch.column("text").to_pylist(), batch.column("cuts").to_pylist()):
            data, spans = text.encode(), removed_spans(ranges, length)
            starts, ends = [0, *(b for _, b in spans)], [*(a for a, _ in spans), len(data)]
            rest = b"".join(data[a:b] for a, b in zip(starts, ends))
            out.append((
                len(data), len(data) - len(rest), len(spans), hashlib.sha256(rest).hexdigest(), rest if with_bytes else None
            ))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        columns = [batch.column("id").cast(to_arrow_type(kind)), *(pa.array(c, t) for c, t in zip(zip(*out), types))]
        names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        return pa.RecordBatch.from_arrays(columns, names=names)

    out = rows.join(cuts, F.col("row") == F.col("own_row"), "left").select("id", "text", "cuts").mapInArrow(
        by_batch(kept),
        f"id {kind.simpleString()}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary",
    )
    out = out.withColumnRenamed("id", id_col)
    return out if with_bytes else out.drop("kept")
