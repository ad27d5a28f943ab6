"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts are compared as lower-cased letters and digits with single spaces between runs of other characters. An item
(or each overlapping piece of a long one) of m characters matches a region of a document when at most k = ``rate`` x m
edits turn one into the other. By the q-gram lemma such a region shares at least m - q + 1 - kq of the item's q-grams, and
their diagonals (place in the document minus place in the item) lie within k of each other. Shared q-grams are
counted in overlapping diagonal bands; bands that reach the bound are verified by an alignment restricted to them.

The benchmark is cut into blocks of bounded size by hash; every block is sent to all tasks and meets all documents in one pass
without a shuffle, so a larger benchmark means more passes, not larger broadcasts.

Defined results: null and empty texts match nothing; items without letters or digits are never found; items shorter than q
characters are found only word for word; of several matches of one item the one with the fewest edits, then the first, is reported; repeated
rows are reported for each row once per id and text; a null item id is reported as null. Only ids and texts are read; empty tables give empty results.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.common import by_batch, fresh, quoted, row_key, text_of

Q = 10
BLOCK_CHARS = 4_000_000  # benchmark characters sent to the tasks at a time
PIECE = 400  # longer items are searched in overlapping pieces of this length
FILTER_BITS = 22
SPACE = 32


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Code point after lower-casing, and a space for all but letters and digits."""
    table = np.full(0x110000, SPACE, dtype=np.uint32)
    for point in range(0x110000):
        char = chr(point)
        if char.isalnum():
            lower = char.lower()
            table[point] = ord(lower) if len(lower) == 1 else point
    return table


def plain(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the compared form, and where each stands in the text."""
    points = letters()[np.frombuffer(text.encode("utf-32-le"), dtype="<u4")]
    blank = points == SPACE
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    places = np.flatnonzero(keep)
    points = points[places]
    if len(points) and points[0] == SPACE:
        points, places = points[1:], places[1:]
    if len(points) and points[-1] == SPACE:
        points, places = points[:-1], places[:-1]
    return points, places


def grams(points: np.ndarray) -> np.ndarray:
    """Hash of each q-gram, built from halves."""
    have, size = {1: points.astype(np.uint64)}, 1
    power = {1: 0x9E3779B97F4A7C15}
    while size * 2 <= Q:
        have[size * 2] = have[size][:-size] * np.uint64(power[size]) + have[size][size:]
        power[size * 2] = power[size] ** 2 % (1 << 64)
        size *= 2
    value, length = have[size], size
    while length < Q:
        step = max(s for s in have if s <= Q - length)
        count = len(points) - length - step + 1
        value = value[:count] * np.uint64(power[step]) + have[step][length : length + count]
        length += step
    value ^= value >> np.uint64(31)
    return value * np.uint64(0xBF58476D1CE4E5B9)


@dataclass(frozen=True)
class Piece:
    item: int
    points: np.ndarray
    budget: int
    least: int  # shared q-grams that a match has at least


class Index:
    """Q-grams of a block of items."""

    def __init__(self, texts: list[str], rate: float):
        self.pieces, self.short = [], []
        keys, owners, places = [], [], []
        for item, text in enumerate(texts):
            points, _ = plain(text)
            if not len(points):
                continue
            if len(points) < Q:
                self.short.append((item, "".join(map(chr, points))))
                continue
            starts = [0] if len(points) <= PIECE else [*range(0, len(points) - PIECE, PIECE // 2), len(points) - PIECE]
            for start in starts:
                part = points[start : start + PIECE]
                m = len(part)
                budget = min(int(rate * m), (m - Q) // Q)
                hashed = grams(part)
                keys.append(hashed)
                owners.append(np.full(len(hashed), len(self.pieces)))
                places.append(np.arange(len(hashed)))
                self.pieces.append(Piece(item, part, budget, m - Q + 1 - budget * Q))
        keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.owners = np.concatenate(owners)[order] if len(order) else order
        self.places = np.concatenate(places)[order] if len(order) else order
        self.filter = np.zeros(1 << FILTER_BITS, dtype=bool)
        self.filter[self.keys >> np.uint64(64 - FILTER_BITS)] = True
        self.budgets = np.array([p.budget for p in self.pieces], dtype=np.int64)
        self.least = np.array([p.least for p in self.pieces], dtype=np.int64)

    def matches(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item, start, end, edits) of the best match of each item found in the text."""
        points, at = plain(text)
        found: dict[int, tuple[int, int, int]] = {}
        if self.short and len(points):
            whole = f" {''.join(map(chr, points))} "
            for item, word in self.short:
                start = whole.find(f" {word} ")
                if start >= 0:
                    found[item] = (0, start, start + len(word) - 1)
        if len(points) >= Q and len(self.keys):
            for piece, band in self.bands(points):
                hit = aligned(points, self.pieces[piece].points, self.pieces[piece].budget, band)
                item = self.pieces[piece].item
                if hit and (item not in found or hit < found[item]):
                    found[item] = hit
        return [(i, int(at[a]), int(at[b]) + 1, e) for i, (e, a, b) in sorted(found.items())]

    def bands(self, points: np.ndarray) -> list[tuple[int, int]]:
        """(piece, lowest diagonal) of the bands with enough shared q-grams."""
        hashed = grams(points)
        where = np.flatnonzero(self.filter[hashed >> np.uint64(64 - FILTER_BITS)])
        low = np.searchsorted(self.keys, hashed[where], "left")
        counts = np.searchsorted(self.keys, hashed[where], "right") - low
        if not counts.sum():
            return []
        entry = np.repeat(low - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        piece = self.owners[entry]
        diagonal = np.repeat(where, counts) - self.places[entry] + PIECE  # never negative
        # bands of two steps' width begin at every step, so diagonals within the budget of each other share one
        step = self.budgets[piece] + 1
        band = diagonal // step
        span = np.int64(len(points) + 2 * PIECE + 2)
        keys, seen = np.unique(np.concatenate([piece * span + band, piece * span + band - 1]), return_counts=True)
        pieces, bands = (keys + 1) // span, (keys + 1) % span - 1
        enough = seen >= self.least[pieces]
        return [(int(p), int(b * (self.budgets[p] + 1) - PIECE)) for p, b in zip(pieces[enough], bands[enough])]


def aligned(points: np.ndarray, item: np.ndarray, budget: int, low: int) -> tuple[int, int, int] | None:
    """(edits, first, last) of the best region along the diagonals from ``low`` on, when within the budget."""
    m, width = len(item), 2 * (budget + 1)
    first, last = max(0, low - budget), min(len(points), low + width + m + budget)
    region = points[first:last]
    exact = exact_place(region, item)
    if exact is not None:
        return 0, first + exact, first + exact + m - 1
    edits, end = best_end(region, item, low - first, width, budget)
    if edits > budget or not end:
        return None
    # the same alignment backwards from its end gives its start
    back = region[:end][::-1]
    _, length = best_end(back, item[::-1], -budget, 2 * budget + 1, budget, anchored=True)
    return edits, first + end - length, first + end - 1


def exact_place(region: np.ndarray, item: np.ndarray) -> int | None:
    place = region.astype("<u4").tobytes().find(item.astype("<u4").tobytes())
    while place >= 0 and place % 4:
        place = region.astype("<u4").tobytes().find(item.astype("<u4").tobytes(), place + 1)
    return place // 4 if place >= 0 else None


def best_end(
    region: np.ndarray, item: np.ndarray, low: int, width: int, budget: int, anchored: bool = False
) -> tuple[int, int]:
    """Fewest edits that turn the item into a part of the region, and where that part ends (exclusive).

    Only the diagonals from ``low - budget`` to ``low + width + budget`` are computed. ``anchored``: the part begins where
    the region does.
    """
    far, low, size = 1 << 20, low - budget, width + 2 * budget + 1
    columns = low + np.arange(size + 1)  # end of the part, for row 0
    row = np.where((columns >= 0) & (columns <= len(region)), columns if anchored else 0, far)
    padded = np.concatenate([region, np.full(len(item) + size + budget + 2, -1)]).astype(np.int64)
    slope = np.arange(size + 1)
    for i, char in enumerate(item):
        columns = columns + 1
        inside = (columns >= 1) & (columns <= len(region))
        same = padded[np.where(inside, columns - 1, -1)] == char
        change = np.where(inside, row + np.where(same, 0, 1), far)
        lost = np.append(row[1:], far) + 1
        row = np.minimum(change, lost)
        row[(columns < 0) | (columns > len(region))] = far
        if columns[0] <= 0 <= columns[-1]:
            row[-columns[0]] = min(row[-columns[0]], i + 1)
        row = np.minimum.accumulate(row - slope) + slope
        row[(columns < 0) | (columns > len(region))] = far
    best = int(row.argmin())
    return int(row[best]), int(columns[best])


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", rate: float = 0.08,
) -> DataFrame:
    """(id, row, item, start, end, edits): one row per document and benchmark item found in it, places in characters."""
    items = benchmark.select(quoted(item_col).alias("item"), text_of(item_text_col).alias("text"))
    rows = docs.select(
        quoted(id_col).alias("id"), row_key(id_col, text_col).alias("row"), text_of(text_col).alias("text")
    )
    total = items.agg(F.coalesce(F.sum(F.length("text") + 1), F.lit(0))).first()[0]
    blocks = max(1, -(-total // BLOCK_CHARS))
    kinds = [f.dataType for f in rows.schema.fields[:1] + items.schema.fields[:1]]
    schema = f"id {kinds[0].simpleString()}, row bigint, item {kinds[1].simpleString()}, start bigint, end bigint, edits bigint"
    out = None
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).distinct().collect()
        sent = docs.sparkSession.sparkContext.broadcast(
            ([r["item"] for r in part], Index([r["text"] for r in part], rate))
        )
        hits = rows.mapInArrow(by_batch(searcher(sent, *map(to_arrow_type, kinds))), schema)
        out = hits if out is None else out.unionByName(hits)
    return out


def searcher(sent, id_type: pa.DataType, item_type: pa.DataType):
    def search(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, index = sent.value
        source, item, spans = [], [], []
        for i, text in enumerate(batch.column(2).to_pylist()):
            for found in index.matches(text):
                source.append(i)
                item.append(names[found[0]])
                spans.append(found[1:])
        take = pa.array(source, pa.int64())
        columns = [batch.column(0).take(take), batch.column(1).take(take), pa.array(item, item_type)]
        columns += [pa.array([s[k] for s in spans], pa.int64()) for k in range(3)]
        return pa.RecordBatch.from_arrays(columns, names=["id", "row", "item", "start", "end", "edits"])

    return search


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the documents in which an item was found, with all their columns."""
    mark = fresh(docs.columns, "leak_row")
    found = contaminated(docs, benchmark, id_col, text_col, **options).select(F.col("row").alias(mark)).distinct()
    return docs.join(found, row_key(id_col, text_col) == quoted(mark), "left_anti")
