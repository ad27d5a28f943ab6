"""Phrases whose words stand together more often than their parts suggest, counted per language in counting quotient filters.

Texts are read once: ASCII letters are lowered, the text is cut into pieces and words, and every task numbers the words it meets
itself. What it has read is handed on as *shards* of bounded size, a list of word numbers (0 where a piece ends) and the words behind them with
their counts. Adding these up gives the exact count of every word of a language, and the words of at least ``min_count`` occurrences get
dense ids (a rarer word cannot be part of a phrase that is frequent enough). The ids are joined back to the words of each shard, not to their occurrences.

Every shard then counts its phrases of 2 to ``max_words`` words. A phrase is its words' ids packed into one key; a keyed permutation of the
key's bits, which can be undone, spreads keys evenly, and its leading bits (range and quotient) and the other ones (remainder) are the entry of a counting quotient
filter: quotients as unary run lengths, full remainders packed, counts in two bits with a list of larger ones. Filters are
sorted and lossless, so those of one range merge over all shards into exact totals, and keys of frequent phrases are turned back into words.

Defined results: null text is empty, null language is ``und``; texts that repeat count each time; a text of any length is counted whole
and lies in one shard, which it may exceed; extra columns are ignored, an empty table gives no rows. Numbers of
scores are decimals wide enough for any count, so nothing overflows.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.ordering import row_position
from tidemark.llm.bitpack import pack, packed_size, unpack
from tidemark.llm.common import quoted, shuffle_width, text_of
from tidemark.session import pin

SHARD_WORDS = 1 << 21  # word occurrences (and piece ends) that close a shard
RANGE_ENTRIES = 1 << 20  # phrase occurrences to a range of keys, on average
MERGE_ENTRIES = 1 << 21  # entries gathered before filters of a range are merged
WORD, STREAM = 0, 1
PIECE_END = bytes.maketrans(b"\t.,;:!?\n\x0b\x0c\r", b" .........." )
SMALL_COUNT = 2  # bits of an ordinary counter


class Numbering(dict):
    """Numbers for the words of one language, drawn from a counter shared by all languages of a shard."""

    def __init__(self, words: list[tuple[str, bytes]], lang: str):
        super().__init__({b".": 0})
        self.words, self.lang = words, lang

    def __missing__(self, word: bytes) -> int:
        self.words.append((self.lang, word))
        self[word] = number = len(self.words)
        return number


def numbers_of(text: str, numbering: Numbering) -> list[int]:
    """The words of a text by number, 0 at the end of every piece."""
    words = text.encode().lower().translate(PIECE_END).replace(b".", b" . ").split(b" ")
    return [*map(numbering.__getitem__, filter(None, words)), 0]


def read_shards(docs: DataFrame, text_col: str, lang_col: str, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Pinned rows of two kinds: (shard, lang, word, number, n) and (shard, numbers, width, size)."""
    rows = docs.select(F.coalesce(quoted(lang_col).cast("string"), F.lit("und")).alias("lang"), text_of(text_col).alias("text"))
    schema = pa.schema([
        ("kind", pa.int32()), ("shard", pa.int64()), ("lang", pa.string()), ("word", pa.string()), ("number", pa.int64()),
        ("n", pa.int64()), ("numbers", pa.binary()), ("width", pa.int32()), ("size", pa.int64()),
    ])

    def table(rows: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(rows, f.type) for f in schema], schema=schema
        )

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        words: list[tuple[str, bytes]] = []
        numberings: dict[str, Numbering] = {}
        parts: list[np.ndarray] = []
        held = 0

        def closed() -> Iterator[pa.RecordBatch]:
            stream = np.concatenate(parts)
            counts = np.bincount(stream, minlength=len(words) + 1)
            for at in range(0, len(words), 1 << 16):
                langs, own = zip(*words[at : at + (1 << 16)])
                n = len(own)
                yield table(
                    n, kind=np.full(n, WORD), shard=np.full(n, shard), lang=langs, word=[w.decode() for w in own],
                    number=np.arange(at + 1, at + 1 + n), n=counts[at + 1 : at + 1 + n],
                )
            width = len(words).bit_length()
            yield table(1, kind=[STREAM], shard=[shard], numbers=[pack(stream, width)], width=[width], size=[len(stream)])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if lang not in numberings:
                    numberings[lang] = Numbering(words, lang)
                numbers = np.array(numbers_of(text, numberings[lang]), dtype=np.int64)
                parts.append(numbers)
                held += len(numbers)
                if held >= shard_words:
                    yield from closed()
                    words, numberings, parts, held, shard = [], {}, [], 0, shard + 1
        if parts:
            yield from closed()

    spark = "kind int, shard bigint, lang string, word string, number bigint, n bigint, numbers binary, width int, size bigint"
    return pin(rows.mapInArrow(shards, spark))


def mixed(values: np.ndarray, bits: int, turn: int) -> np.ndarray:
    """Lowest ``bits`` bits of a hash."""
    out = (values + np.uint64(turn)) * np.uint64(0x9E3779B97F4A7C15)
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(29)
    return out & np.uint64((1 << bits) - 1)


def permuted(high: np.ndarray, low: np.ndarray, high_bits: int, low_bits: int, back: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """A permutation of keys of two halves: each half in turn is changed by a hash of the other; ``back`` undoes it."""
    for turn in (3, 2, 1, 0) if back else (0, 1, 2, 3):
        if turn % 2:
            low = low ^ mixed(high, low_bits, turn + 1)
        else:
            high = high ^ mixed(low, high_bits, turn + 1)
    return high, low


class CountingQuotientFilter:
    """Exact counters of keys given as two halves of at most 64 bits, kept sorted; the ``prefix`` leading bits are the same for all keys."""

    def __init__(self, high: np.ndarray, low: np.ndarray, counts: np.ndarray, high_bits: int, low_bits: int, prefix: int = 0):
        self.high, self.low, self.counts = high, low, counts
        self.high_bits, self.low_bits, self.prefix = high_bits, low_bits, prefix

    @classmethod
    def of(cls, high: np.ndarray, low: np.ndarray, counts: np.ndarray | None, high_bits: int, low_bits: int, prefix: int = 0):
        """From keys in any order, repeated ones added up."""
        if high_bits + low_bits <= 64:
            order = np.argsort(high << np.uint64(low_bits) | low, kind="stable")
        else:
            order = np.lexsort((low, high))
        high, low = high[order], low[order]
        new = np.ones(len(high), dtype=bool)
        new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        starts = np.flatnonzero(new)
        if counts is None:
            totals = np.diff(starts, append=len(high))
        else:
            totals = np.add.reduceat(counts[order], starts) if len(starts) else counts[:0]
        return cls(high[starts], low[starts], totals.astype(np.int64), high_bits, low_bits, prefix)

    @classmethod
    def merge(cls, filters: list[CountingQuotientFilter]) -> CountingQuotientFilter:
        one = filters[0]
        parts = (np.concatenate([getattr(f, name) for f in filters]) for name in ("high", "low", "counts"))
        return cls.of(*parts, one.high_bits, one.low_bits, one.prefix)

    def __len__(self) -> int:
        return len(self.high)

    def count(self, high: int, low: int) -> int:
        """How often a key was counted."""
        first, last = np.searchsorted(self.high, [np.uint64(high)], "left")[0], np.searchsorted(self.high, [np.uint64(high)], "right")[0]
        at = first + np.searchsorted(self.low[first:last], np.uint64(low))
        return int(self.counts[at]) if at < last and self.low[at] == low else 0

    def ranges(self, bits: int) -> Iterator[tuple[int, CountingQuotientFilter]]:
        """Cut at the leading ``bits`` bits."""
        lead = self.high >> np.uint64(self.high_bits - bits) if bits else np.zeros(len(self), dtype=np.uint64)
        edges = [0, *(np.flatnonzero(lead[1:] != lead[:-1]) + 1).tolist(), len(self)]
        for a, b in zip(edges, edges[1:]):
            if a < b:
                yield int(lead[a]), CountingQuotientFilter(
                    self.high[a:b], self.low[a:b], self.counts[a:b], self.high_bits, self.low_bits, bits
                )

    def to_bytes(self) -> bytes:
        n = len(self)
        quotient_bits = min(max(n.bit_length() - 1, 0), self.high_bits - self.prefix)
        rest = self.high_bits - self.prefix - quotient_bits
        lead = int(self.high[0] >> np.uint64(self.high_bits - self.prefix)) if self.prefix else 0
        quotients = (self.high >> np.uint64(rest)) & np.uint64((1 << quotient_bits) - 1) if quotient_bits else np.zeros(n, np.uint64)
        runs = np.zeros(n + (1 << quotient_bits), dtype=np.uint8)  # a one for every entry, a zero after every quotient
        runs[quotients.astype(np.int64) + np.arange(n)] = 1
        most = (1 << SMALL_COUNT) - 1
        small = np.minimum(self.counts - 1, most)
        large = self.counts[small == most]
        head = struct.pack("<BBBBQI", self.high_bits, self.low_bits, self.prefix, quotient_bits, lead, n)
        return b"".join([
            head, np.packbits(runs).tobytes(), pack(self.high, rest), pack(self.low, self.low_bits), pack(small, SMALL_COUNT),
            large.astype("<i8").tobytes(),
        ])

    @classmethod
    def from_bytes(cls, data: bytes) -> CountingQuotientFilter:
        high_bits, low_bits, prefix, quotient_bits, lead, n = struct.unpack_from("<BBBBQI", data)
        view, at = memoryview(data), struct.calcsize("<BBBBQI")
        rest = high_bits - prefix - quotient_bits

        def taken(size: int) -> memoryview:
            nonlocal at
            at += size
            return view[at - size : at]

        slots = n + (1 << quotient_bits)
        runs = np.unpackbits(np.frombuffer(taken((slots + 7) // 8), dtype=np.uint8), count=slots)
        quotients = (np.flatnonzero(runs) - np.arange(n)).astype(np.uint64)
        high = quotients << np.uint64(rest) | unpack(taken(packed_size(n, rest)), n, rest) if rest < 64 else unpack(taken(packed_size(n, rest)), n, rest)
        if prefix:
            high |= np.uint64(lead) << np.uint64(high_bits - prefix)
        low = unpack(taken(packed_size(n, low_bits)), n, low_bits)
        counts = unpack(taken(packed_size(n, SMALL_COUNT)), n, SMALL_COUNT).astype(np.int64) + 1
        counts[counts == 1 << SMALL_COUNT] = np.frombuffer(view[at:], dtype="<i8")
        return cls(high, low, counts, high_bits, low_bits, prefix)


def halves(words: int, bits: int) -> tuple[int, int]:
    """Bits of the two halves of a key."""
    return (words + 1) // 2 * bits, words // 2 * bits


def phrase_filter(ids: np.ndarray, words: int, bits: int) -> CountingQuotientFilter | None:
    """Counts of all runs of ``words`` ids without a zero."""
    windows = len(ids) - words + 1
    if windows <= 0:
        return None
    inside = np.ones(windows, dtype=bool)
    for j in range(words):
        inside &= ids[j : j + windows] != 0
    at = np.flatnonzero(inside)
    if not len(at):
        return None
    split, (high_bits, low_bits) = (words + 1) // 2, halves(words, bits)
    high, low = np.zeros(len(at), dtype=np.uint64), np.zeros(len(at), dtype=np.uint64)
    for j in range(words):
        half = high if j < split else low
        half <<= np.uint64(bits)
        half |= ids[at + j]
    return CountingQuotientFilter.of(*permuted(high, low, high_bits, low_bits), None, high_bits, low_bits)


def phrases_of(found: CountingQuotientFilter, words: int, bits: int) -> list[np.ndarray]:
    """The ids of every phrase, one array per word."""
    high, low = permuted(found.high, found.low, found.high_bits, found.low_bits, back=True)
    split, mask = (words + 1) // 2, np.uint64((1 << bits) - 1)
    return [
        (high >> np.uint64((split - 1 - j) * bits) if j < split else low >> np.uint64((words - 1 - j) * bits)) & mask
        for j in range(words)
    ]


def frequent_phrases(shards: DataFrame, known: DataFrame, vocabulary: int, total: int, min_count: int, max_words: int) -> DataFrame:
    """(ids, a): phrases of 2 to ``max_words`` words of at least ``min_count`` occurrences; ``known`` holds (lang, word, id)."""
    width = shuffle_width(shards.sparkSession)
    bits = max(vocabulary.bit_length(), 1)
    range_bits = min(max(total // RANGE_ENTRIES, 1).bit_length(), bits, 30)
    ids = shards.where(F.col("kind") == WORD).join(known, ["lang", "word"]).select("kind", "shard", "number", "id")
    streams = shards.where(F.col("kind") == STREAM).select("kind", "shard", "numbers", "width", "size")
    beside = streams.unionByName(ids, allowMissingColumns=True).repartition(width, "shard").sortWithinPartitions("shard", "kind")

    def filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, own = None, []
        for batch in batches:
            numbers, kinds = batch.column("shard").to_numpy(), batch.column("kind").to_numpy()
            edges = [0, *(np.flatnonzero((numbers[1:] != numbers[:-1]) | (kinds[1:] != kinds[:-1])) + 1).tolist(), len(numbers)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                if numbers[a] != shard:
                    shard, own = numbers[a], []
                part = batch.slice(a, b - a)
                if kinds[a] == WORD:
                    own.append((part.column("number").to_numpy(), part.column("id").to_numpy()))
                    continue
                for data, bit, size in zip(*(part.column(c).to_pylist() for c in ("numbers", "width", "size"))):
                    local = unpack(data, size, bit).astype(np.int64)
                    table = np.zeros(1 << bit, dtype=np.uint64)
                    for number, found in own:
                        table[number] = found
                    stream = table[local]
                    del local, table
                    for words in range(2, max_words + 1):
                        counted = phrase_filter(stream, words, bits)
                        if counted is not None:
                            ranges, parts = zip(*counted.ranges(range_bits))
                            data = [p.to_bytes() for p in parts]
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([words] * len(data), pa.int32()), pa.array(ranges, pa.int64()), pa.array(data, pa.binary())],
                                names=["words", "range", "filter"],
                            )

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, entries = None, [], 0

        def totals() -> Iterator[pa.RecordBatch]:
            found = CountingQuotientFilter.merge(held)
            enough = found.counts >= min_count
            if enough.any():
                kept = CountingQuotientFilter(found.high[enough], found.low[enough], found.counts[enough], found.high_bits, found.low_bits)
                ids = np.stack(phrases_of(kept, key[0], bits), axis=1).astype(np.int64)
                lists = pa.ListArray.from_arrays(np.arange(len(ids) + 1, dtype=np.int32) * key[0], ids.ravel())
                yield pa.RecordBatch.from_arrays([lists, pa.array(kept.counts)], names=["ids", "a"])

        for batch in batches:
            for words, lead, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if (words, lead) != key:
                    if held:
                        yield from totals()
                    key, held, entries = (words, lead), [], 0
                held.append(CountingQuotientFilter.from_bytes(data))
                entries += len(held[-1])
                if entries >= MERGE_ENTRIES and len(held) > 1:
                    held = [CountingQuotientFilter.merge(held)]
                    entries = 0
        if held:
            yield from totals()

    per_shard = beside.mapInArrow(filters, "words int, range bigint, filter binary")
    by_range = per_shard.repartition(width, "words", "range").sortWithinPartitions("words", "range")
    return pin(by_range.mapInArrow(merged, "ids array<bigint>, a bigint"))


def mine_phrases(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = 30, max_words: int = 4, per_lang: int = 2000,
    covered: int = 80, shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the best ``per_lang`` phrases of each language.

    A phrase's score is floor(2000000 a / (l + r)) at the cut into two parts, of l and r occurrences, where that is lowest;
    phrases inside a longer one with at least ``covered`` percent of their occurrences are left out.
    """
    spark = docs.sparkSession
    shards = read_shards(docs, text_col, lang_col, shard_words)
    words = pin(shards.where(F.col("kind") == WORD).groupBy("lang", "word").agg(F.sum("n").alias("n")))
    sizes = words.groupBy("lang").agg(F.sum("n").alias("n"))
    known = pin(row_position(words.where(F.col("n") >= min_count), ["lang", "word"], "id"))
    vocabulary = known.count()
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    found = frequent_phrases(shards, known.select("lang", "word", "id"), vocabulary, total, min_count, max_words)

    counts = found.select(F.col("ids").alias("part"), F.col("a").alias("f")).unionByName(
        known.select(F.array("id").alias("part"), F.col("n").alias("f"))
    )
    cuts = found.select("ids", "a", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k")).select(
        "ids", "a", "k", F.slice("ids", F.lit(1), F.col("k")).alias("left"),
        F.expr("slice(ids, k + 1, size(ids) - k)").alias("right"),
    )
    with_l = cuts.join(counts.select(F.col("part").alias("left"), F.col("f").alias("l")), "left")
    with_r = with_l.join(counts.select(F.col("part").alias("right"), F.col("f").alias("r")), "right")
    score = F.expr("(cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    lowest = with_r.withColumn("score", score).groupBy("ids", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    inner = found.where(F.size("ids") > 2).select(
        F.col("a").alias("longer"),
        F.explode(F.expr(
            "flatten(transform(sequence(2, size(ids) - 1), w -> transform(sequence(1, size(ids) - w + 1), s -> slice(ids, s, w))))"
        )).alias("ids"),
    ).groupBy("ids").agg(F.max("longer").alias("longer"))
    hidden = F.expr(f"cast(longer as decimal(20,0)) * 100 >= cast(a as decimal(20,0)) * {covered}")
    kept = lowest.join(inner, "ids", "left").where(~F.coalesce(hidden, F.lit(False)))

    spelled = kept.select("ids", "a", "cut", F.posexplode("ids").alias("at", "id")).join(known.select("id", "lang", "word"), "id")
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x["word"])  # at most max_words
    phrases = spelled.groupBy("ids", "a", "cut").agg(F.min("lang").alias("lang"), F.array_join(in_order, " ").alias("phrase"))
    best = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc(), "phrase")
    ranked = phrases.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= per_lang)
    return ranked.join(sizes, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n",
        F.col("cut.score").alias("score"),
    )
