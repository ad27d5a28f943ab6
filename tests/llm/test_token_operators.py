"""Token files, phrases and aligned tokenizers against brute force on small tables."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers as P
import pytest
import sentencepiece
from pyspark.sql import functions as F, types as T
from tokenizers import Tokenizer

from tidemark.llm import collocations, token_alignment, token_files
from tidemark.llm.bitpack import pack, unpack
from tidemark.llm.byte_bpe import ByteBpe
from tidemark.llm.collocations import CountingQuotientFilter, permuted
from tidemark.session import scratch_path

VOCABULARY, PIECES = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
SCHEMA = "doc_id bigint, text string, lang string, ids string, `shard` string, kind string"


def odd_texts(n: int = 300) -> list[str | None]:
    rng = random.Random(4)
    fixed = [
        None, "", " ", "\n", "a  b", " a", "a ", "\n\na \n b\n c\t d\r\n e", "it's o'clock'll\n\n\n x", "a\x1cb \x1f c", "日本 語  テスト",
        "x <|endoftext|><|endoftext|> y", "<s> </s> <0x41> <unk>", "▁x", "x ▁ y", "a b　c", "é é ﬁ", "\U0001f600" * 50,
        "very long " * 4000, "word" * 3000,
    ]
    return fixed + ["".join(rng.choice(" \n\t ab1.'sé日") for _ in range(rng.randint(0, 40))) for _ in range(n)]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en", "x", "y", "z") for i, t in enumerate(odd_texts())]
    rows += [(5, "a b", "en", None, None, None), (5, "a b", "en", None, None, None), (None, "no id", None, "x", "y", "z")]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def by_library(text: str | None) -> list[int]:
    return Tokenizer.from_file(VOCABULARY).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("width", [0, 1, 7, 8, 15, 16, 17, 31, 32, 33, 63, 64])
def test_packed_numbers_come_back(width):
    values = np.random.default_rng(width).integers(0, 1 << 64, 70_001, dtype=np.uint64) >> np.uint64(64 - width if width else 0)
    values = values if width else np.zeros(70_001, dtype=np.uint64)
    assert np.array_equal(unpack(pack(values, width), len(values), width), values)


@pytest.mark.parametrize("ids", [
    [7], [0, 0, 0], [2**32 - 1, 0, 2**32 - 1], list(range(50_000, 54_096)), [1] * 4000 + [2**31] * 96, list(range(100)) + [2**32 - 1],
])
def test_a_block_comes_back(ids):
    data = token_files.encode_block(np.array(ids, dtype="<u4"))
    assert token_files.decode_block(memoryview(data)).tolist() == ids


def test_blocks_are_small_where_few_ids_are_large():
    ids = np.array([*[5] * 4000, *[40_000] * 96], dtype="<u4")
    assert len(token_files.encode_block(ids)) < 1000


def test_whole_texts_equal_the_library():
    bpe, library = token_files.WholeTextBpe(VOCABULARY, P.PATTERN), Tokenizer.from_file(VOCABULARY)
    for text in [t or "" for t in odd_texts(3000)] * 2:
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(bpe.encode(text), dtype="<u4").tolist() == ids, text[:80]


def test_token_files(spark, odd):
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(odd, path, VOCABULARY, P.PATTERN, 2)
    got = token_files.read_documents(spark, path, T.LongType()).toPandas().sort_values("start").reset_index(drop=True)
    rows = sorted(odd.select("doc_id", "text").collect(), key=lambda r: (r.doc_id is not None, r.doc_id))
    library = Tokenizer.from_file(VOCABULARY)
    lists = {}
    for r in rows:
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 2]
        lists.setdefault(r.doc_id, []).append(ids)
    stream, at = [], 0
    for row in got.itertuples():
        key = None if pd.isna(row.doc_id) else int(row.doc_id)
        ids = list(row.token_ids)
        assert ids in lists[key]
        lists[key].remove(ids)
        assert row.start == at and row.n_tokens == len(ids)
        assert row.ids_crc32 == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        stream += ids
        at += len(ids)
    assert not any(lists.values())
    known = got.doc_id.dropna().tolist()
    assert known == sorted(known) and pd.isna(got.doc_id.iloc[0])
    for first, last in ((0, 1), (4000, 4200), (17, len(stream)), (len(stream), len(stream) + 5)):
        parts = token_files.read_range(spark, path, first, last).orderBy("start").collect()
        assert [i for p in parts for i in p.token_ids] == stream[first:last]


def test_many_shards_keep_the_order(spark):
    docs = spark.range(500).select((500 - F.col("id")).alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = scratch_path(spark, "tokens")
        token_files.write_tokens(docs, path, VOCABULARY, P.PATTERN, 2)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert spark.read.parquet(f"{path}/index").count() > 1
    got = token_files.read_documents(spark, path, T.LongType(), with_ids=False).orderBy("start").collect()
    assert [r.doc_id for r in got] == list(range(1, 501))
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]


def test_no_documents_give_no_tokens(spark, odd):
    none = odd.where("false")
    assert token_files.token_file_digests(none, scratch_path(spark, "tokens"), VOCABULARY, P.PATTERN, 2).count() == 0
    assert collocations.mine_phrases(none).count() == 0
    assert token_alignment.align_documents(none, VOCABULARY, P.PATTERN, PIECES).count() == 0


@pytest.mark.parametrize("high_bits, low_bits", [(5, 5), (34, 17), (34, 34), (64, 64), (64, 32)])
def test_filters_are_lossless(high_bits, low_bits):
    rng = np.random.default_rng(high_bits + low_bits)
    high = rng.integers(0, 1 << high_bits, 5000, dtype=np.uint64) if high_bits < 64 else rng.integers(0, 1 << 64, 5000, dtype=np.uint64)
    low = rng.integers(0, 1 << low_bits, 5000, dtype=np.uint64) if low_bits < 64 else rng.integers(0, 1 << 64, 5000, dtype=np.uint64)
    high, low = np.concatenate([high, high[:2000], high[:9]]), np.concatenate([low, low[:2000], low[:9]])
    there = permuted(high, low, high_bits, low_bits)
    back = permuted(*there, high_bits, low_bits, back=True)
    assert np.array_equal(back[0], high) and np.array_equal(back[1], low)
    expected = Counter(zip(there[0].tolist(), there[1].tolist()))
    whole = CountingQuotientFilter.of(*there, None, high_bits, low_bits)
    assert Counter(dict(zip(zip(whole.high.tolist(), whole.low.tolist()), whole.counts.tolist()))) == expected
    key = next(iter(expected))
    assert whole.count(*key) == expected[key]
    halves = [CountingQuotientFilter.of(there[0][i::2], there[1][i::2], None, high_bits, low_bits) for i in (0, 1)]
    ranges = defaultdict(list)
    for half in halves:
        for lead, part in half.ranges(3):
            ranges[lead].append(CountingQuotientFilter.from_bytes(part.to_bytes()))
    merged = Counter()
    for parts in ranges.values():
        f = CountingQuotientFilter.merge(parts)
        merged.update(dict(zip(zip(f.high.tolist(), f.low.tolist()), f.counts.tolist())))
    assert merged == expected


def test_large_counts_are_kept():
    f = CountingQuotientFilter(np.array([3], np.uint64), np.array([1], np.uint64), np.array([10**14]), 5, 5)
    assert CountingQuotientFilter.from_bytes(f.to_bytes()).counts.tolist() == [10**14]


def brute_phrases(rows, min_count, per_lang, covered=80):
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        plain = (text or "").translate(upper)
        for mark in ",;:!?\n\x0b\x0c\r":
            plain = plain.replace(mark, ".")
        for piece in plain.split("."):
            words = [w for w in piece.replace("\t", " ").split(" ") if w]
            n[lang] += len(words)
            for size in (1, 2, 3, 4):
                f[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = set()
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        hidden = set()
        for longer, a in candidates.items():
            for size in range(2, len(longer)):
                for i in range(len(longer) - size + 1):
                    part = longer[i : i + size]
                    if 100 * a >= covered * candidates.get(part, 10**30):
                        hidden.add(part)
        scored = []
        for p, a in candidates.items():
            if p in hidden:
                continue
            score, k = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:per_lang], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return out


@pytest.mark.parametrize("shard_words", [1 << 21, 300])
def test_phrases_equal_brute_force(spark, shard_words):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "é", "Ab", "AB", "x y", "日本"]
    rows = [(None, "en"), ("", None), ("a b " * 3000, "en"), ("a b. c d\ta  b\rc d", "de"), ("same same same same same", "fr")] * 9
    for _ in range(150):
        words = [vocabulary[min(int(rng.expovariate(0.12)), len(vocabulary) - 1)] + rng.choice(["", "", "", ".", ",", "\n"]) for _ in range(60)]
        rows.append((" ".join(words), rng.choice(["en", "en", "de", None, "und"])))
    docs = spark.createDataFrame([(i, *r, 1) for i, r in enumerate(rows)], "doc_id bigint, text string, lang string, word int").repartition(4)
    got = {tuple(r) for r in collocations.mine_phrases(docs, min_count=8, per_lang=25, shard_words=shard_words).collect()}
    assert got == brute_phrases(rows, 8, 25)


def brute_alignment(rows):
    a_side, b_side = Tokenizer.from_file(VOCABULARY), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a_side.encode_special_tokens = True
    a_bytes = ByteBpe(VOCABULARY, P.PATTERN).bytes_by_id

    def b_bytes(i):
        piece = b_side.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b_side.is_byte(i) else piece.replace("▁", " ").encode()

    found, counts = [], Counter()
    for text in rows:
        if not text:
            found.append(None)
            continue
        a, b = a_side.encode(" " + text, add_special_tokens=False).ids, b_side.encode(text)
        data = (" " + text).encode()
        if b"".join(a_bytes[i] for i in a) != data or b"".join(map(b_bytes, b)) != data:
            found.append(None)
            continue
        ends = [np.cumsum([len(f(i)) for i in ids]) for f, ids in ((a_bytes.__getitem__, a), (b_bytes, b))]
        owner = [np.repeat(np.arange(len(e)), np.diff(e, prepend=0)) for e in ends]
        links = [(a[i], b[j]) for i, j in sorted(set(zip(owner[0].tolist(), owner[1].tolist())))]
        groups, i, j = [], 0, 0
        for cut in sorted(set(ends[0].tolist()) & set(ends[1].tolist())):
            u, v = ends[0].tolist().index(cut) + 1, ends[1].tolist().index(cut) + 1
            groups.append(",".join(map(str, a[i:u])) + "|" + ",".join(map(str, b[j:v])))
            i, j = u, v
        counts.update(set(links))
        found.append((len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    out = [
        (0,) * 6 + ("",) if f is None
        else (*f[:3], len(f[3]), sum(counts[p] == best[p[0]] for p in f[3]), sum(counts[p] for p in f[3]), f[4])
        for f in found
    ]
    return out, counts


def test_alignment_equals_brute_force(spark, odd):
    rows = odd.select("doc_id", "text").collect()
    expected, counts = brute_alignment([r.text for r in rows])
    docs = odd.select("doc_id", "text", F.lit(1).alias("slot"), F.lit(2).alias("pair"), F.lit(3).alias("n"))
    got = token_alignment.align_documents(docs, VOCABULARY, P.PATTERN, PIECES, shard_links=200).collect()
    assert Counter(tuple(r) for r in got) == Counter((r.doc_id, *e) for r, e in zip(rows, expected))
    table = token_alignment.pair_counts(odd, VOCABULARY, P.PATTERN, PIECES).collect()
    assert {(r.a_id, r.b_id): r.n_docs for r in table} == dict(counts)
    assert any(r.exact for r in table) and not all(r.exact for r in table)


def test_groups_are_written_out(spark):
    docs = spark.createDataFrame([(1, "hello")], "doc_id bigint, text string")
    row = token_alignment.align_documents(docs, VOCABULARY, P.PATTERN, PIECES, with_groups=True).first()
    assert hashlib.sha256(row.groups.encode()).hexdigest() == row.groups_sha256
    assert row.groups.count(";") + 1 == row.n_groups
