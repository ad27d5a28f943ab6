"""Two tokenizers' ids of the same text, aligned by byte offsets and counted over the corpus.

Tokenizer A is a byte-level BPE of the tokenizers library and encodes a space and the text, tokenizer B a BPE of the sentencepiece library
with byte fallback, which adds that space itself; both are given whole texts. Places where tokens of both end cut the
text into groups; every A and B token of overlapping byte ranges are linked.

``identity_map`` gives for every A id the B id of the same bytes. Links along it are counted, one document at a time, in a vector as
long as A's vocabulary; only other pairs of ids enter a shuffle. Documents are gathered into *shards* of bounded size; a shard's distinct
pairs, with the number of its documents that hold them, are added up over all shards and joined back to the shards, so what is shuffled is
one row for a pair and a shard, not one for a pair and a document. The shards are then streamed a second time beside their counts.

Defined results: a text that is null or empty, or whose joined bytes differ from space and text for either tokenizer (U+2581 inside it),
has no tokens: zeros and an empty group digest. Strings of special tokens are plain text. Rows that repeat count each for itself, any
length is aligned whole, extra columns are not returned, an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.common import quoted, shuffle_width, text_of
from tidemark.llm.token_files import WholeTextBpe
from tidemark.session import pin

BATCH_CHARS = 1 << 18  # texts aligned at a time
SHARD_LINKS = 1 << 19  # distinct pairs per document, added up, that close a shard
BLANK = "▁"
PAIR_DOCS, DOCUMENT, EXACT = 0, 1, 2


class Aligner:
    """Both tokenizers with the bytes of their tokens; made once per worker process."""

    def __init__(self, vocabulary: str, pattern: str, model: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece

        self.a = WholeTextBpe(vocabulary, pattern)
        self.b = sentencepiece.SentencePieceProcessor(model_file=model)
        self.a_bytes = self.a.bytes_by_id
        self.b_bytes = [self.piece_bytes(i) for i in range(self.b.get_piece_size())]
        lone = [self.b.is_byte(i) for i in range(len(self.b_bytes))]
        self.same = identity_map(self.a_bytes, self.b_bytes, lone)
        self.lengths = [np.array([len(t) for t in table], dtype=np.int64) for table in (self.a_bytes, self.b_bytes)]
        self.digits = [decimal_table(len(table)) for table in (self.a_bytes, self.b_bytes)]

    def piece_bytes(self, number: int) -> bytes:
        piece = self.b.id_to_piece(number)
        if self.b.is_byte(number):
            return bytes([int(piece[3:-1], 16)])
        return b"" if self.b.is_control(number) else piece.replace(BLANK, " ").encode()

    def encoded(self, texts: list[str]) -> list[tuple[np.ndarray, list[int]] | None]:
        """Ids of both tokenizers per text, None where it has no tokens or their bytes are not the text's."""
        out: list = []
        for text, b in zip(texts, self.b.encode(texts, num_threads=1, add_bos=False, add_eos=False)):
            spaced = " " + text
            a = np.frombuffer(self.a.encode_plain(spaced), dtype="<u4")
            data = spaced.encode()
            same = b"".join(map(self.a_bytes.__getitem__, a.tolist())) == data == b"".join(map(self.b_bytes.__getitem__, b))
            out.append((a, b) if text and same else None)
        return out

    def aligned(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Per text the numbers of A ids, B ids, groups and links and the groups written out; then every distinct linked pair
        of a text: index of the text, A id times the size of B's vocabulary plus B id, and how often it is linked."""
        found = self.encoded(texts)
        known = [i for i, ids in enumerate(found) if ids is not None]
        totals, written = np.zeros((len(texts), 4), dtype=np.int64), [""] * len(texts)
        if not known:
            return totals, written, *[np.zeros(0, dtype=np.int64)] * 3
        sides = [np.concatenate([found[i][0] for i in known]).astype(np.int64), np.array([b for i in known for b in found[i][1]], dtype=np.int64)]
        sizes = [np.array([len(found[i][side]) for i in known]) for side in (0, 1)]
        # texts stand one after the other: both sides have the same bytes, so a text's end is the end of a group
        ends = [np.cumsum(length[ids]) for length, ids in zip(self.lengths, sides)]
        cuts = np.intersect1d(*ends, assume_unique=True)
        group = [np.searchsorted(cuts, end) for end in ends]  # group of each token
        upto = [np.searchsorted(end, cuts, side="right") for end in ends]  # tokens up to the end of each group
        text_end = np.cumsum(sizes[0])
        groups_to = group[0][text_end - 1] + 1

        # an A token is linked with the B tokens from the first that ends after its start to the last that starts before its end
        first = np.searchsorted(ends[1], ends[0] - self.lengths[0][sides[0]], side="right")
        last = np.searchsorted(ends[1], ends[0], side="left")
        each = last - first + 1
        a_of = np.repeat(np.arange(len(each)), each)
        b_of = np.arange(len(a_of)) - np.repeat(np.cumsum(each) - each, each) + first[a_of]
        links_to = np.cumsum(each)[text_end - 1]
        place = np.array(known)
        for column, to in enumerate((text_end, np.cumsum(sizes[1]), groups_to, links_to)):
            totals[place, column] = np.diff(to, prepend=0)

        size = len(self.b_bytes)
        owner = np.repeat(np.repeat(place, sizes[0]), each)
        packed = owner * (len(self.a_bytes) * size) + sides[0][a_of] * size + sides[1][b_of]
        packed, times = np.unique(packed, return_counts=True)
        text_of_pair, pairs = np.divmod(packed, len(self.a_bytes) * size)

        # every group's A ids, then its B ids, each with the mark that follows it
        before = [np.concatenate([[0], to]) for to in upto]
        spots = [np.arange(len(sides[0])) + before[1][group[0]], np.arange(len(sides[1])) + before[0][group[1] + 1]]
        width = max(table.shape[1] for table in self.digits) + 1
        page = np.zeros((len(sides[0]) + len(sides[1]), width), dtype=np.uint8)
        for ids, spot, table, to, mark in zip(sides, spots, self.digits, upto, "|;"):
            page[spot, : table.shape[1]] = table[ids]
            page[spot, width - 1] = ord(",")
            page[spot[to - 1], width - 1] = ord(mark)
        kept = page != 0
        rows_to = text_end + np.cumsum(sizes[1])
        chars_to = np.cumsum(kept.sum(axis=1))[rows_to - 1].tolist()
        line = page[kept].tobytes().decode()
        for i, low, high in zip(known, [0, *chars_to], chars_to):
            written[i] = line[low : high - 1]
        return totals, written, text_of_pair, pairs, times


def decimal_table(size: int) -> np.ndarray:
    """ASCII digits of 0 to ``size`` - 1, one row each, filled up with zero bytes."""
    return np.arange(size).astype(f"S{len(str(size))}").view(np.uint8).reshape(size, -1)


def identity_map(a_bytes: list[bytes], b_bytes: list[bytes], b_is_byte: list[bool]) -> np.ndarray:
    """B id of the same bytes for every A id, -1 where there is none; a whole piece goes before a lone byte."""
    of: dict[bytes, int] = {}
    for number in sorted(range(len(b_bytes)), key=lambda i: (b_is_byte[i], i)):
        if b_bytes[number]:
            of.setdefault(b_bytes[number], number)
    return np.array([of.get(data, -1) for data in a_bytes], dtype=np.int64)


@lru_cache(maxsize=2)
def loaded(vocabulary: str, pattern: str, model: str) -> Aligner:
    return Aligner(vocabulary, pattern, model)


def as_bytes(values: np.ndarray) -> bytes:
    return values.astype("<u4").tobytes()


def link_table(
    docs: DataFrame, vocabulary: str, pattern: str, model: str, id_col: str, text_col: str, with_groups: bool, shard_links: int
) -> DataFrame:
    """One pinned table of documents (with their links), pairs of every shard and exact counts of every task, told apart by ``kind``."""
    rows = docs.select(quoted(id_col).alias("id"), text_of(text_col).alias("text"))
    kind = rows.schema["id"].dataType
    fields = [
        ("kind", "int", pa.int32()), ("shard", "bigint", pa.int64()), ("slot", "bigint", pa.int64()), ("pair", "bigint", pa.int64()),
        ("docs", "bigint", pa.int64()), ("id", kind.simpleString(), to_arrow_type(kind)), ("totals", "array<bigint>", pa.list_(pa.int64())),
        ("groups_sha256", "string", pa.string()), ("groups", "string", pa.string()), ("slots", "binary", pa.binary()),
        ("slot_links", "binary", pa.binary()), ("same", "binary", pa.binary()), ("same_links", "binary", pa.binary()),
    ]
    schema = pa.schema([(name, arrow) for name, _, arrow in fields])

    def table(rows: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(rows, f.type) for f in schema], schema=schema
        )

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = loaded(vocabulary, pattern, model)
        exact = np.zeros(len(aligner.same), dtype=np.int64)
        shard = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        links = 0

        def closed() -> Iterator[pa.RecordBatch]:
            pairs, slots = np.unique(np.concatenate([h[4] for h in held]), return_inverse=True)
            counts = np.bincount(slots, minlength=len(pairs))
            for at in range(0, len(pairs), 1 << 16):
                part = slice(at, at + (1 << 16))
                n = len(pairs[part])
                yield table(
                    n, kind=np.full(n, PAIR_DOCS), shard=np.full(n, shard), slot=np.arange(at, at + n),
                    pair=pairs[part], docs=counts[part],
                )
            ends = np.cumsum([len(h[4]) for h in held])
            for at in range(0, len(held), 1024):
                part = held[at : at + 1024]
                own = [slots[e - len(h[4]) : e] for e, h in zip(ends[at : at + 1024].tolist(), part)]
                yield table(
                    len(part), kind=[DOCUMENT] * len(part), shard=[shard] * len(part), id=[h[0] for h in part],
                    totals=[h[1] for h in part], groups_sha256=[h[2] for h in part], groups=[h[3] for h in part],
                    slots=[as_bytes(s) for s in own], slot_links=[as_bytes(h[5]) for h in part],
                    same=[as_bytes(h[6]) for h in part], same_links=[as_bytes(h[7]) for h in part],
                )

        size = len(aligner.b_bytes)
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            ends = np.cumsum([len(t) for t in texts]) // BATCH_CHARS
            edges = [0, *(np.flatnonzero(ends[1:] != ends[:-1]) + 1).tolist(), len(texts)] if texts else []
            for low, high in zip(edges, edges[1:]):
                totals, written, owners, pairs, times = aligner.aligned(texts[low:high])
                a, b = np.divmod(pairs, size)
                along = aligner.same[a] == b
                exact += np.bincount(a[along], minlength=len(exact))
                sides = [(pairs[~along], times[~along], owners[~along]), (a[along], times[along], owners[along])]
                bounds = [np.searchsorted(o, np.arange(high - low + 1)) for _, _, o in sides]
                for i, (key, own, groups) in enumerate(zip(keys[low:high], totals.tolist(), written)):
                    cut = [slice(x[i], x[i + 1]) for x in bounds]
                    digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
                    lists = [part[c] for side, c in zip(sides, cut) for part in side[:2]]
                    held.append((key, own, digest, groups if with_groups else None, *lists))
                    links += 1 + len(lists[0]) + len(lists[2]) + (len(groups) // 8 if with_groups else 0)
                if links >= shard_links:
                    yield from closed()
                    held, links, shard = [], 0, shard + 1
        if held:
            yield from closed()
        used = np.flatnonzero(exact)
        if len(used):
            yield table(len(used), kind=np.full(len(used), EXACT), slot=used, docs=exact[used])

    return pin(rows.mapInArrow(linked, ", ".join(f"{name} {spark}" for name, spark, _ in fields)))


def counted(table: DataFrame, size: int, b_size: int) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """(pair, n) of all pairs beside the identity map, and per A id the exact count and the highest count of any pair."""
    pairs = pin(table.where(F.col("kind") == PAIR_DOCS).groupBy("pair").agg(F.sum("docs").alias("n")))
    exact, best = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
    # at most one row for each id of A's vocabulary, however large the corpus is
    own = table.where(F.col("kind") == EXACT).groupBy("slot").agg(F.sum("docs").alias("n")).toPandas()
    exact[own.slot] = own.n
    high = pairs.groupBy((F.expr("pair div %d" % b_size)).alias("a")).agg(F.max("n").alias("n")).toPandas()
    best[high.a] = high.n
    return pairs, exact, np.maximum(best, exact)


def align_documents(
    docs: DataFrame, vocabulary: str, pattern: str, model: str, id_col: str = "doc_id", text_col: str = "text", with_groups: bool = False,
    shard_links: int = SHARD_LINKS,
) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 and on request groups) of every document."""
    spark = docs.sparkSession
    rows = link_table(docs, vocabulary, pattern, model, id_col, text_col, with_groups, shard_links)
    both = loaded(vocabulary, pattern, model)
    b_size = len(both.b_bytes)
    pairs, exact, best = counted(rows, len(both.same), b_size)
    sent = spark.sparkContext.broadcast((exact, best))  # as long as A's vocabulary

    slots = rows.where(F.col("kind") == PAIR_DOCS).select("kind", "shard", "slot", "pair").join(pairs, "pair")
    all_rows = rows.where(F.col("kind") == DOCUMENT).drop("slot", "pair", "docs").unionByName(slots, allowMissingColumns=True)
    by_shard = all_rows.repartition(shuffle_width(spark), "shard").sortWithinPartitions("shard", "kind")
    kind = rows.schema["id"].dataType
    names = ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"]
    types = [to_arrow_type(kind), *[pa.int64()] * 6, pa.string(), pa.string()]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact, best = sent.value
        shard, count, highest = None, np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)
        for batch in batches:
            numbers, kinds = batch.column("shard").to_numpy(), batch.column("kind").to_numpy()
            edges = np.flatnonzero((numbers[1:] != numbers[:-1]) | (kinds[1:] != kinds[:-1])) + 1 if len(numbers) else []
            for low, high in zip([0, *edges], [*edges, len(numbers)]):
                if low == high:
                    continue
                part = batch.slice(low, high - low)
                if numbers[low] != shard:
                    shard, count, highest = numbers[low], np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)
                if kinds[low] == PAIR_DOCS:
                    at, n = part.column("slot").to_numpy(), part.column("n").to_numpy()
                    grow = int(at.max()) + 1 - len(count)
                    if grow > 0:
                        count, highest = np.append(count, np.zeros(grow, dtype=np.int64)), np.append(highest, np.zeros(grow, dtype=bool))
                    count[at] = n
                    highest[at] = n == best[part.column("pair").to_numpy() // b_size]
                    continue
                found = []
                of = {c: part.column(c).to_pylist() for c in ("slots", "slot_links", "same", "same_links")}
                for slots, times, same, same_times in zip(*of.values()):
                    slots, times, same, same_times = (np.frombuffer(x, dtype="<u4").astype(np.int64) for x in (slots, times, same, same_times))
                    alike = exact[same]
                    found.append((
                        int(times[highest[slots]].sum() + same_times[alike == best[same]].sum()),
                        int((times * count[slots]).sum() + (same_times * alike).sum()),
                    ))
                totals = np.array(part.column("totals").to_pylist(), dtype=np.int64).reshape(-1, 4)
                n_best, sums = zip(*found)
                columns = [part.column("id"), *totals.T, n_best, sums, part.column("groups_sha256"), part.column("groups")]
                yield pa.RecordBatch.from_arrays(
                    [c.cast(t) if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types)], names=names
                )

    schema = f"id {kind.simpleString()}, " + ", ".join(f"{n} bigint" for n in names[1:7]) + ", groups_sha256 string, groups string"
    out = by_shard.mapInArrow(scored, schema).withColumnRenamed("id", id_col)
    return out if with_groups else out.drop("groups")


def pair_counts(docs: DataFrame, vocabulary: str, pattern: str, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(a_id, b_id, n_docs, exact): every linked pair of ids and how many documents hold it, a table from one vocabulary to the other."""
    spark = docs.sparkSession
    rows = link_table(docs, vocabulary, pattern, model, id_col, text_col, False, SHARD_LINKS)
    both = loaded(vocabulary, pattern, model)
    same, b_size = both.same, len(both.b_bytes)
    pairs, exact, _ = counted(rows, len(same), b_size)
    along = spark.createDataFrame(  # as long as A's vocabulary
        [(int(a), int(same[a]), int(exact[a]), True) for a in np.flatnonzero(exact)], "a_id bigint, b_id bigint, n_docs bigint, exact boolean"
    )
    others = pairs.select(
        F.expr(f"pair div {b_size}").alias("a_id"), (F.col("pair") % b_size).alias("b_id"),
        F.col("n").alias("n_docs"), F.lit(False).alias("exact"),
    )
    return others.unionByName(along)
