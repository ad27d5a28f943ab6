"""Token ids in binary files of patched frame-of-reference blocks, and reading them back.

Documents are range-partitioned and sorted by id; every task encodes its documents with the tokenizers library, ends each one with
``end_id`` and writes one *shard*: the ids of its documents one after the other, cut into blocks of ``BLOCK`` ids. Spark's own writer
puts the bytes down, so its commit protocol covers lost executors and any store that Spark writes to will do.

Shard layout, little-endian; every record is followed by one line feed, which belongs to the layout:

* header: ``MAGIC``, shard number (u32), ids to a full block (u32);
* blocks: ids (u32), smallest id (u32), bits (u8), exceptions (u32), the ids less the smallest one packed at so many bits, the
  places (u32 each) and upper parts (u32 each) of the ids that do not fit. The bits are those that ``PERCENTILE`` of the block needs;
* footer: number of blocks (u32), start of every block in the file (u64 each), then the documents as an Arrow stream (id, n_tokens);
* end: length of the footer (u64), ``MAGIC``.

Beside the shards lies an index, one row per shard: its file, its number of documents and ids, and how many ids lie before it.

Defined results: null and empty texts are documents with the end id alone; rows that repeat are written each for itself, rows of the same
id in the order of a hash of their text, null ids first; strings of special tokens inside a text become the special token, as
the library has it; any length is encoded whole; extra columns are not written. An empty table gives no shards and reads back as none.
The number of shards follows ``spark.sql.shuffle.partitions``; a shard is read as one row, so it must stay below 2 GB.
"""

from __future__ import annotations

import re
import struct
import zlib
from codecs import charmap_decode
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.bitpack import pack, packed_size, unpack
from tidemark.llm.byte_bpe import ByteBpe
from tidemark.llm.common import by_batch, quoted, text_of
from tidemark.session import pin

MAGIC = b"PFOR1\x00\x00\x00"
BLOCK = 4096
PERCENTILE = 0.95
WAITING = 1 << 16  # ids gathered before blocks are cut
KNOWN_PARTS = 600_000  # parts of texts in each of the two generations that a worker remembers
SEEN_MASK = (1 << 22) - 1  # marks for parts met once
ROWS = 256  # texts made Python strings at a time
HEAD, BLOCK_HEAD = struct.Struct("<8sII"), struct.Struct("<IIBI")


class WholeTextBpe(ByteBpe):
    """Ids as the library gives them for whole texts, special tokens in the text included; parts between blanks are remembered.

    A single space between two non-blanks always begins a piece, and so does a line feed after a non-blank: the text is cut
    there into parts that recur. Parts at other blanks are joined with their neighbours again and split by the pattern.
    Parts of letters are one piece, with a mark behind them two. Parts that have not been seen for long are forgotten.
    """

    def __init__(self, vocabulary: str, pattern: str):
        super().__init__(vocabulary, pattern)
        from tokenizers import Tokenizer

        added = Tokenizer.from_file(vocabulary).get_added_tokens_decoder()
        self.special = {t.content: struct.pack("<I", i) for i, t in added.items() if t.special}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")").split if self.special else None
        self.table = "".join(self.chars.values())
        self.space = self.table[32]
        self.marks = {c: self.ids_of(c) for c in ".,;:!?"}
        self.older: dict[str, bytes] = {}
        self.seen, self.met = bytearray(SEEN_MASK + 1), 0

    def encode(self, text: str) -> bytes:
        if self.cut is not None and any(s in text for s in self.special):
            return b"".join(self.special.get(t) or self.encode_plain(t) for t in self.cut(text) if t)
        return self.encode_plain(text)

    def encode_plain(self, text: str) -> bytes:
        parts = text.replace("\n", " \n").split(" ")
        found = list(map(self.chunks.get, parts))
        found[0] = None  # the first part has no space before it
        if None in found:
            self.fill(parts, found)
        return b"".join(found)

    def fill(self, parts: list[str], found: list[bytes | None]) -> None:
        done = 0
        for i, known in enumerate(found):
            if known is not None or i < done:
                continue
            part = parts[i]
            if i and part.isalpha() and ends_whole(parts[i - 1]):  # the most usual new part: one piece after a space
                ids = self.older.get(part)
                found[i] = self.keep(part, self.word(part) if ids is None else ids)
                continue
            if i and whole(parts[i]) and ends_whole(parts[i - 1]):
                found[i] = self.part_ids(parts[i])
                continue
            low = i
            while low and not (whole(parts[low]) and ends_whole(parts[low - 1])):
                low -= 1
            high = i + 1
            while high < len(parts) and not (whole(parts[high]) and ends_whole(parts[high - 1])):
                high += 1
            text = "".join((p if not j or p[:1] == "\n" else " " + p) for j, p in enumerate(parts[low:high], low))
            found[low:high] = [b"".join(map(self.piece, self.split(text))), *[b""] * (high - low - 1)]
            done = high

    def part_ids(self, part: str) -> bytes:
        """Ids of a part with the space before it, or with its own line feed."""
        mark = self.marks.get(part[-1])
        if mark is not None and part[:-1].isalpha():
            known = self.chunks.get(part[:-1])
            return self.part_ids(part[:-1]) + mark if known is None else self.keep(part, known + mark)
        out = self.older.get(part)
        if out is None:
            if part.isalpha():
                out = self.word(part)
            else:
                out = b"".join(map(self.piece, self.split(part if part[0] == "\n" else " " + part)))
        return self.keep(part, out)

    def keep(self, part: str, ids: bytes) -> bytes:
        """Remember a part from its second time on, as most are met only once."""
        place = hash(part) & SEEN_MASK
        if not self.seen[place]:
            self.seen[place] = 1
            self.met += 1
            if self.met > SEEN_MASK // 2:
                self.seen, self.met = bytearray(SEEN_MASK + 1), 0
            return ids
        if len(self.chunks) >= KNOWN_PARTS:
            self.older, self.chunks = self.chunks, {}
        self.chunks[part] = ids
        return ids

    def word(self, part: str) -> bytes:
        """Ids of a space and letters, which are one piece."""
        written = self.space + (part if part.isascii() else charmap_decode(part.encode(), "strict", self.table)[0])
        ids = [t.id for t in self.model.tokenize(written)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def piece(self, piece: str) -> bytes:
        """Ids of one piece; a word after a space is looked up among the parts."""
        known = self.chunks.get(piece[1:]) if piece[0] == " " else self.pieces.get(piece)
        if known is not None:
            return known
        ids = [t.id for t in self.model.tokenize(charmap_decode(piece.encode(), "strict", self.table)[0])]
        out = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) < 4 and piece[0] != " " and len(self.pieces) < KNOWN_PARTS:  # marks and blanks, of which there are few
            self.pieces[piece] = out
        return out


def whole(part: str) -> bool:
    """Begins and ends with a non-blank, but for one line feed before it."""
    rest = part[1:] if part[:1] == "\n" else part
    return bool(rest) and not rest[0].isspace() and not rest[-1].isspace()


def ends_whole(part: str) -> bool:
    return bool(part) and not part[-1].isspace()


@lru_cache(maxsize=4)
def loaded(vocabulary: str, pattern: str) -> WholeTextBpe:
    return WholeTextBpe(vocabulary, pattern)


def encode_block(ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """One block of unsigned 32-bit ids; any number from 1 on."""
    base = int(ids.min())
    rest = ids - np.uint32(base)
    at = min(len(ids) - 1, int(percentile * len(ids)))
    width = int(np.partition(rest, at)[at]).bit_length()
    places = np.flatnonzero(rest >> np.uint32(width)) if width < 32 else np.zeros(0, dtype=np.int64)
    upper = (rest[places] >> np.uint32(width)).astype("<u4") if width < 32 else np.zeros(0, dtype="<u4")
    head = BLOCK_HEAD.pack(len(ids), base, width, len(places))
    return head + pack(rest, width) + places.astype("<u4").tobytes() + upper.tobytes()


def decode_block(data: memoryview) -> np.ndarray:
    """The ids of the block that begins where ``data`` does."""
    count, base, width, others = BLOCK_HEAD.unpack_from(data)
    at = BLOCK_HEAD.size
    size = packed_size(count, width)
    rest = unpack(data[at : at + size], count, width).astype(np.uint32)
    if others:
        at += size
        places = np.frombuffer(data[at : at + 4 * others], dtype="<u4")
        upper = np.frombuffer(data[at + 4 * others : at + 8 * others], dtype="<u4")
        rest[places] |= upper << np.uint32(width)
    return rest + np.uint32(base)


def shard_records(
    documents: Iterable[tuple[object, bytes]], kind: pa.DataType, shard: int, block: int = BLOCK
) -> Iterator[bytes]:
    """The records of one shard from (id, ids as bytes) in order; nothing for no documents."""
    waiting: list[bytes] = []
    held, at = 0, 0
    keys, counts, starts = [], [], []

    def put(record: bytes) -> bytes:
        nonlocal at
        at += len(record) + 1
        return record

    def blocks(last: bool) -> Iterator[bytes]:
        nonlocal held, waiting
        ids = np.frombuffer(b"".join(waiting), dtype="<u4")
        end = len(ids) if last else len(ids) // block * block
        for i in range(0, end, block):
            starts.append(at)
            yield put(encode_block(ids[i : min(i + block, end)]))
        waiting, held = [ids[end:].tobytes()], len(ids) - end

    for key, ids in documents:
        if not keys:
            yield put(HEAD.pack(MAGIC, shard, block))
        keys.append(key)
        counts.append(len(ids) // 4)
        waiting.append(ids)
        held += len(ids) // 4
        if held >= WAITING:
            yield from blocks(last=False)
    if keys:
        yield from blocks(last=True)
        sink = pa.BufferOutputStream()
        table = pa.table([pa.array(keys, kind), pa.array(counts, pa.int64())], names=["id", "n_tokens"])
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table)
        footer = struct.pack("<I", len(starts)) + np.array(starts, dtype="<u8").tobytes() + sink.getvalue().to_pybytes()
        yield put(footer)
        yield put(struct.pack("<Q", len(footer)) + MAGIC)


class Shard:
    """A shard file held as bytes: its documents, and any range of its ids without decoding the rest."""

    def __init__(self, data: bytes):
        self.data = memoryview(data)
        magic, self.number, self.block = HEAD.unpack_from(self.data)
        size, again = struct.unpack_from("<Q8s", self.data, len(data) - 17)
        if magic != MAGIC or again != MAGIC:
            raise ValueError("not a token shard")
        footer = self.data[len(data) - 18 - size : len(data) - 18]
        (n,) = struct.unpack_from("<I", footer)
        self.starts = np.frombuffer(footer[4 : 4 + 8 * n], dtype="<u8")
        with pa.ipc.open_stream(footer[4 + 8 * n :]) as reader:
            self.documents = reader.read_all()

    def ids(self, first: int, last: int) -> np.ndarray:
        """The ids from ``first`` up to but without ``last``, counted within the shard."""
        if last <= first:
            return np.zeros(0, dtype=np.uint32)
        low, high = first // self.block, -(-last // self.block)
        parts = [decode_block(self.data[int(s) :]) for s in self.starts[low:high]]
        return np.concatenate(parts)[first - low * self.block : last - low * self.block]

    def by_document(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """(place in the shard's document list, first id, ids) of every document, a few blocks decoded at a time."""
        counts = self.documents.column("n_tokens").to_numpy()
        ends = np.cumsum(counts)
        held, held_from, held_to = np.zeros(0, dtype=np.uint32), 0, 0
        for i, (end, n) in enumerate(zip(ends.tolist(), counts.tolist())):
            if end > held_to:
                low = (end - n) // self.block * self.block
                high = min(int(ends[-1]), max(-(-end // self.block) * self.block, low + 16 * self.block))
                held, held_from, held_to = self.ids(low, high), low, high
            yield i, end - n, held[end - n - held_from : end - held_from]


def write_shards(
    docs: DataFrame, path: str, vocabulary: str, pattern: str, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Write the ids of every whole text to files below ``path``/shards."""
    rows = docs.select(quoted(id_col).alias("id"), text_of(text_col).alias("text")).withColumn("tie", F.xxhash64("text"))
    kind, end = to_arrow_type(rows.schema["id"].dataType), struct.pack("<I", end_id)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def encoded() -> Iterator[tuple[object, bytes]]:
            bpe = loaded(vocabulary, pattern)
            for batch in batches:
                for at in range(0, batch.num_rows, ROWS):
                    part = batch.slice(at, ROWS)
                    for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                        yield key, bpe.encode(text) + end

        for record in shard_records(encoded(), kind, TaskContext.get().partitionId()):
            yield pa.RecordBatch.from_arrays([pa.array([record], pa.binary())], names=["record"])

    ordered = rows.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie", "text").select("id", "text")
    records = ordered.mapInArrow(shards, "record binary").select(F.col("record").cast("string").alias("record"))
    records.write.option("compression", "none").option("lineSep", "\n").text(f"{path}/shards")


def write_index(per_shard: DataFrame, path: str) -> None:
    """Write (shard, path, n_docs, n_tokens, start) below ``path``/index from rows without the start."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard: as many as there were tasks
    index = per_shard.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    index.coalesce(1).write.parquet(f"{path}/index")


def write_tokens(
    docs: DataFrame, path: str, vocabulary: str, pattern: str, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Write the ids of every whole text below ``path``: ``shards/`` and ``index/``."""
    write_shards(docs, path, vocabulary, pattern, end_id, id_col, text_col)

    def footers(batch: pa.RecordBatch) -> pa.RecordBatch:
        held = [Shard(c.as_buffer()) for c in batch.column(1)]
        totals = [int(s.documents.column("n_tokens").to_numpy().sum()) for s in held]
        columns = [pa.array(x, pa.int64()) for x in ([s.number for s in held], [s.documents.num_rows for s in held], totals)]
        return pa.RecordBatch.from_arrays([columns[0], batch.column(0), *columns[1:]], names=["shard", "path", "n_docs", "n_tokens"])

    found = shard_files(docs.sparkSession, path).mapInArrow(by_batch(footers), "shard bigint, path string, n_docs bigint, n_tokens bigint")
    write_index(found, path)


def shard_files(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/shards")
    return files.where("length > 0").select("path", "content")


def shard_documents(spark: SparkSession, path: str, id_type: T.DataType, with_ids: bool) -> DataFrame:
    """(path, shard, id, place, n_tokens, ids_crc32, token_ids) of every document, ``place`` counted within its shard."""
    kind = to_arrow_type(id_type)
    names = ["path", "shard", "id", "place", "n_tokens", "ids_crc32", "token_ids"]
    numbers = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                shard = Shard(content.as_buffer())
                keys = shard.documents.column("id").cast(kind)
                rows: list[tuple] = []

                def batch_of(first: int) -> pa.RecordBatch:
                    n = len(rows)
                    columns = [pa.array(c, t) for c, t in zip(zip(*rows), numbers)]
                    own = [pa.array([file] * n, pa.string()), pa.array([shard.number] * n, pa.int64()), keys.slice(first, n).combine_chunks()]
                    return pa.RecordBatch.from_arrays([*own, *columns], names=names)

                first, waiting = 0, 0
                for i, place, ids in shard.by_document():
                    kept = ids.astype(np.int32) if with_ids else None
                    rows.append((place, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), kept))
                    waiting += len(ids)
                    if len(rows) >= 4096 or with_ids and waiting >= 1 << 20:
                        yield batch_of(first)
                        first, waiting, rows = i + 1, 0, []
                if rows:
                    yield batch_of(first)

    schema = f"path string, shard bigint, id {id_type.simpleString()}, place bigint, n_tokens bigint, ids_crc32 bigint, token_ids array<int>"
    return shard_files(spark, path).mapInArrow(documents, schema)


def with_starts(found: DataFrame, path: str, id_col: str) -> DataFrame:
    index = found.sparkSession.read.parquet(f"{path}/index").select("shard", F.col("start").alias("shard_start"))
    return found.join(F.broadcast(index), "shard").select(  # one row per shard
        F.col("id").alias(id_col), (F.col("shard_start") + F.col("place")).alias("start"), "n_tokens", "ids_crc32", "token_ids"
    )


def read_documents(
    spark: SparkSession, path: str, id_type: T.DataType, id_col: str = "doc_id", with_ids: bool = True
) -> DataFrame:
    """(id, start, n_tokens, ids_crc32 and on request token_ids) of every document, from the files alone."""
    out = with_starts(shard_documents(spark, path, id_type, with_ids), path, id_col)
    return out if with_ids else out.drop("token_ids")


def read_range(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """(start, token_ids): the ids from ``first`` up to but without ``last``, counted over all shards, as one row per shard
    that holds some of them; only blocks that hold them are decoded."""
    index = spark.read.parquet(f"{path}/index")
    wanted = index.where((F.col("start") < last) & (F.col("start") + F.col("n_tokens") > first))
    named = shard_files(spark, path).join(F.broadcast(wanted), "path").select("start", "n_tokens", "content")

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        starts, lists = [], []
        for start, n, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            low, high = max(first - start, 0), min(last - start, n)
            starts.append(start + low)
            lists.append(Shard(content.as_buffer()).ids(low, high).astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [pa.array(starts, pa.int64()), pa.array(lists, pa.list_(pa.int32()))], names=["start", "token_ids"]
        )

    return named.mapInArrow(by_batch(cut), "start bigint, token_ids array<int>")


def token_file_digests(
    docs: DataFrame, path: str, vocabulary: str, pattern: str, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Write the files and return (id, start, n_tokens, ids_crc32) of every document as read back from them."""
    write_shards(docs, path, vocabulary, pattern, end_id, id_col, text_col)
    found = pin(shard_documents(docs.sparkSession, path, docs.schema[id_col].dataType, with_ids=False))  # read once, without the ids
    counts = found.groupBy("shard", "path").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    write_index(counts, path)
    return with_starts(found, path, id_col).drop("token_ids")
