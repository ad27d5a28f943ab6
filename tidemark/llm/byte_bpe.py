"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

Text is cut into pieces by the splitting pattern of the vocabulary, every piece is written with one character per
byte (the byte table of byte-level vocabularies) and handed to the library's BPE model; the bytes of its tokens give their
offsets in the text. Pieces recur a lot, so each task keeps the ids of pieces it has seen, up to a fixed number.

Defined results: a null or empty text has no tokens and decodes to the empty text; rows that repeat are encoded each
for itself; special-token strings inside a text are ordinary text; any length is encoded whole. Decoding a list of
ids gives the bytes, and their text with U+FFFD where a list ends inside a character; ids outside the vocabulary and
null ids raise ``ValueError``. Empty tables give empty results, further columns are left alone.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.functions import pandas_udf

from tidemark.llm.common import by_batch, quoted, text_of

KNOWN_PIECES = 400_000  # pieces whose ids a worker remembers; the memory is emptied when it is full


def byte_table() -> list[str]:
    """Character that stands for each byte: itself where it is printable, else the next free one from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class ByteBpe:
    """Encoder and decoder of one vocabulary file; made once per worker process."""

    def __init__(self, vocabulary: str, pattern: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(vocabulary)
        self.model = tokenizer.model
        self.split = regex.compile(pattern).findall
        self.chars = dict(enumerate(byte_table()))
        special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
        bytes_of = {c: b for b, c in self.chars.items()}
        size = tokenizer.get_vocab_size()
        self.bytes_by_id: list[bytes | None] = [None] * size
        for token, number in tokenizer.get_vocab().items():
            self.bytes_by_id[number] = (
                token.encode() if token in special else bytes(bytes_of[c] for c in token)
            )
        self.pieces: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}
        # two blanks in a row, or blanks other than space and line feed, or at an end: split the whole text at once
        self.unusual = re.compile(r"\s\s|[^\S \n]|\A\s|\s\Z").search

    def tokens_of(self, piece: str) -> list:
        """The library's tokens of one piece; one character of theirs is one byte of the piece."""
        return self.model.tokenize("".join(map(self.chars.__getitem__, piece.encode())))

    def piece_ids(self, piece: str) -> bytes:
        known = self.pieces.get(piece)
        if known is None:
            if len(self.pieces) >= KNOWN_PIECES:
                self.pieces.clear()
            known = np.array([t.id for t in self.tokens_of(piece)], dtype="<u4").tobytes()
            self.pieces[piece] = known
        return known

    def ids_of(self, text: str) -> bytes:
        return b"".join(map(self.piece_ids, self.split(text)))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers.

        A space before a non-blank always begins a piece, and so does a line feed between non-blanks: ordinary
        text is cut there into chunks that recur, other text is given to the pattern whole.
        """
        if self.unusual(text):
            return self.ids_of(text)
        first, *rest = text.replace("\n", " \n").split(" ")
        found = list(map(self.chunks.get, rest))
        if None in found:
            if len(self.chunks) >= KNOWN_PIECES:
                self.chunks.clear()
            for i, known in enumerate(found):
                if known is None:
                    chunk = rest[i]
                    found[i] = self.chunks[chunk] = self.ids_of(chunk if chunk[0] == "\n" else " " + chunk)
        return self.ids_of(first) + b"".join(found)

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """(id, first character, one past the last character) of every token, in characters of ``text``.

        A token that covers part of a character spans that whole character, as the library reports it.
        """
        out, at = [], 0
        for piece in self.split(text):
            owner = [i for i, c in enumerate(piece) for _ in c.encode()]
            begin = 0
            for token in self.tokens_of(piece):
                end = begin + len(self.bytes_by_id[token.id])
                out.append((token.id, at + owner[begin], at + owner[end - 1] + 1))
                begin = end
            at += len(piece)
        return out

    def decode(self, ids: Iterable[int]) -> bytes:
        ids = list(ids)
        try:
            if ids and min(ids) < 0:  # Python would count these from the end
                raise IndexError(min(ids))
            return b"".join([self.bytes_by_id[i] for i in ids])
        except (IndexError, TypeError) as error:
            raise ValueError("an id lies outside the vocabulary") from error


@lru_cache(maxsize=4)
def loaded(vocabulary: str, pattern: str) -> ByteBpe:
    return ByteBpe(vocabulary, pattern)


def encode_documents(
    docs: DataFrame, vocabulary: str, pattern: str, text_col: str = "text", ids_col: str = "token_ids",
    offsets_col: str | None = None,
) -> DataFrame:
    """``docs`` with the token ids of every whole text, and on request their character offsets.

    An existing column of the same name is replaced.
    """

    @pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        bpe = loaded(vocabulary, pattern)
        return texts.map(lambda t: np.frombuffer(bpe.encode(t), dtype="<u4").astype(np.int32))

    @pandas_udf("array<struct<start:int,end:int>>")
    def offsets(texts: pd.Series) -> pd.Series:
        bpe = loaded(vocabulary, pattern)
        return texts.map(lambda t: [{"start": a, "end": b} for _, a, b in bpe.spans(t)])

    out = docs.withColumn(ids_col, ids(text_of(text_col)))
    return out.withColumn(offsets_col, offsets(text_of(text_col))) if offsets_col else out


def decode_documents(
    docs: DataFrame, vocabulary: str, pattern: str, ids_col: str = "token_ids", bytes_col: str = "decoded"
) -> DataFrame:
    """``docs`` with the bytes that the ids stand for; null ids decode to null."""

    @pandas_udf("binary")
    def decoded(lists: pd.Series) -> pd.Series:
        bpe = loaded(vocabulary, pattern)
        return lists.map(lambda ids: None if ids is None else bpe.decode(np.asarray(ids).tolist()))

    return docs.withColumn(bytes_col, decoded(quoted(ids_col)))


def token_digests(
    docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256 and on request token_ids) of every whole text, encoded and
    decoded again in one pass."""

    def digest(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = loaded(vocabulary, pattern)
        counts, id_hash, text_hash, lists = [], [], [], []
        for text in batch.column(1).to_pylist():
            ids = bpe.encode(text)
            numbers = np.frombuffer(ids, dtype="<u4")
            counts.append(len(numbers))
            id_hash.append(hashlib.sha256(ids).hexdigest())
            text_hash.append(hashlib.sha256(bpe.decode(numbers.tolist())).hexdigest())
            lists.append(numbers.astype(np.int32) if with_ids else None)
        arrays = [
            batch.column(0), pa.array(counts, pa.int64()), pa.array(id_hash, pa.string()), pa.array(text_hash, pa.string()),
            pa.array(lists, pa.list_(pa.int32())),
        ]
        return pa.RecordBatch.from_arrays(arrays, names=["id", "n_tokens", "ids_sha256", "decoded_sha256", "token_ids"])

    rows = docs.select(quoted(id_col).alias("id"), text_of(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(
        by_batch(digest), f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, token_ids array<int>"
    ).withColumnRenamed("id", id_col)
    return out if with_ids else out.drop("token_ids")
