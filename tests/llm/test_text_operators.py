"""The operators on single texts and turns: chat format, toxicity, byte BPE, licences, pseudonyms."""

import base64
import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe, chat_format, license_scan, pii_pseudonyms, toxicity
from tidemark.llm.license_rules import rules
from tidemark.llm.queries import CONFLICT, PATTERN, VOCABULARY

ODD_TEXTS = [
    None, "", " ", "\n", "a", "  two  blanks ", "tab\tand\r\nreturn", "naïve café — ﬁn", "漢字 かな 한글", "😀👩‍👩‍👧 é",
    "<|endoftext|> 's 'll don't", "x" * 5_000, "\u3000wide\u00a0space", "1234.5 ²³ Ⅷ", CONFLICT, "\\\\### User:\n</turn>\n### Role x:",
]


def documents(spark, texts, first=0):
    return spark.createDataFrame([(first + i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")


def collected(df, key="doc_id"):
    return {r[key]: r.asDict() for r in df.collect()}


# ---- chat format

def test_turns_survive_the_round_trip():
    rng = random.Random(7)
    marks = ["### Assistant:", "### Role ", "</turn>", "\\", "\n", "a", "#", "###", "!", ":", " "]
    texts = ["".join(rng.choice(marks) for _ in range(rng.randint(0, 9))) for _ in range(3_000)]
    for role in ("user", "assistant", "System", "", "a:b\nc\\<#", "!x"):
        for text in texts[:500]:
            rendered, start, end = chat_format.checked_turn(role, text)
            assert list(chat_format.parse(rendered)) == [(role, text, start, end)]
    turns = [("user", t) for t in texts]
    whole = "".join(chat_format.checked_turn(*t)[0] for t in turns)
    assert [t[:2] for t in chat_format.parse(whole)] == turns


def test_only_conflicting_text_is_escaped():
    assert chat_format.escaped("plain # text < with \\ marks", 0) == "plain # text < with \\ marks"
    assert chat_format.escaped(CONFLICT, 0) == "\\\\\\### Assistant: \\</turn> ok"
    with pytest.raises(chat_format.Unparsable):
        list(chat_format.parse("### User:\nno end"))
    with pytest.raises(chat_format.Unparsable):
        chat_format.unescaped("### User:".join(["\\\\", ""]), 0)


def test_conversation_digests(spark):
    rows = [(1, 1, "assistant", None), (1, 0, "user", "hi"), (2, 0, None, CONFLICT), (None, 0, "assistant", "ok"),
            (1, 2, "assistant", "bye"), (1, 2, "assistant", "bye")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("rendered", F.lit(1))
    got = collected(chat_format.conversation_digests(chat_format.format_turns(df)), "conv_id")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1]["n_turns"] == 4 and got[1]["loss_chars"] == 6 and got[1]["loss_sha256"] == sha("byebye")
    assert got[1]["turns_sha256"] == sha("user\nhi\nassistant\n\nassistant\nbye\nassistant\nbye\n")
    assert got[2]["turns_sha256"] == sha(f"\n{CONFLICT}\n") and got[2]["loss_chars"] == 0
    assert got[None]["loss_sha256"] == sha("ok")
    assert chat_format.conversation_digests(chat_format.format_turns(df.where("false"))).count() == 0


# ---- toxicity

def test_toxicity_learns_and_handles_empty_input(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdeilnorst") for _ in range(rng.randint(2, 7)))
    texts = [" ".join([*(word() for _ in range(30)), *(["vile"] if i % 4 == 0 else [])]) for i in range(240)] + [None, ""]
    docs = documents(spark, texts).withColumn("score", F.lit("kept?"))
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)] + [(None, 1), (3, None), (0, 0)], "doc_id bigint, toxic int")
    model = toxicity.train(docs, labels)
    got = collected(toxicity.with_scores(docs, model))
    held = [i for i in range(200, 240)]
    assert sum((got[i]["score"] >= 0.3) == (i % 4 == 0) for i in held) >= 36
    assert got[240]["score"] == got[241]["score"] and 0 <= got[240]["score"] <= 1
    blank = toxicity.train(docs, labels.where("false"))
    assert set(r["score"] for r in toxicity.with_scores(docs, blank).collect()) == {0.5}
    assert toxicity.with_scores(docs.where("false"), model).count() == 0


def test_buckets_do_not_depend_on_the_piece_size(monkeypatch):
    text = "".join(random.Random(1).choice("abc déf") for _ in range(2_000))
    whole = toxicity.buckets(text)
    monkeypatch.setattr(toxicity, "PIECE", 100)
    assert np.array_equal(toxicity.buckets(text), whole)


# ---- byte BPE

@pytest.fixture(scope="module")
def reference():
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_tokens_equal_the_reference_tokeniser(reference):
    rng, bpe = random.Random(5), byte_bpe.ByteBpe(VOCABULARY, PATTERN)
    parts = ["a", "Bé", "漢", "😀", "1", "²", ".", "'", "'ll", " ", "  ", "\n", "\n\n", "\t", "\r", "\u3000", "\u0301", "<|endoftext|>"]
    texts = [t or "" for t in ODD_TEXTS] + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(5_000)]
    for text in texts:
        ids = np.frombuffer(bpe.encode(text), "<u4").tolist()
        assert ids == reference.encode_ordinary(text)
        assert bpe.decode(ids) == text.encode()
        spans = bpe.spans(text)
        assert [s[0] for s in spans] == ids
        assert all(bpe.decode([i]) in text[a:b].encode() for i, a, b in spans)


def test_split_characters_and_unknown_ids(spark, reference):
    ids = reference.encode_ordinary("😀")
    assert len(ids) > 1
    df = spark.createDataFrame([(0, ids[:1]), (1, ids), (2, []), (3, None)], "doc_id bigint, token_ids array<int>")
    got = collected(byte_bpe.decode_documents(df, VOCABULARY, PATTERN))
    assert bytes(got[0]["decoded"]).decode(errors="replace") == "\ufffd"
    assert bytes(got[1]["decoded"]).decode() == "😀" and bytes(got[2]["decoded"]) == b"" and got[3]["decoded"] is None
    with pytest.raises(ValueError):
        byte_bpe.ByteBpe(VOCABULARY, PATTERN).decode([10**6])


def test_documents_encode_and_decode(spark, reference):
    docs = documents(spark, ODD_TEXTS).withColumn("id", F.lit("other"))
    digests = collected(byte_bpe.token_digests(docs, VOCABULARY, PATTERN, with_ids=True))
    full = collected(byte_bpe.encode_documents(docs, VOCABULARY, PATTERN, offsets_col="spans"))
    for i, text in enumerate(ODD_TEXTS):
        ids = reference.encode_ordinary(text or "")
        assert digests[i]["token_ids"] == ids == full[i]["token_ids"] and digests[i]["n_tokens"] == len(ids)
        assert digests[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert digests[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
        assert len(full[i]["spans"]) == len(ids)
    assert byte_bpe.token_digests(docs.where("false"), VOCABULARY, PATTERN).count() == 0


# ---- licences

def scanned(text):
    """Brute force: every rule and phrase at every place."""
    low = (text or "").translate(str.maketrans(license_scan.UPPER, license_scan.LOWER))
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places, base, found = [], set(), []
    for phrase, label in license_scan.BASE_PHRASES.items():
        parts = phrase.split()
        here = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
        places += here
        base |= {label} if here else set()
    line = f" {' '.join(words)} "
    lower = (text or "").lower()
    if any(w in lower for w in license_scan.OPENING) or ("cc" in lower and re.search(license_scan.CREATIVE, lower)):
        for rule in rules():
            if rule.gate in line:
                for m in re.finditer(rule.pattern, line):
                    first = line[: m.start()].count(" ") - 1
                    found.append((rule, first, first + m[0].count(" ")))

    def beats(e, d):
        key = lambda x: (x[0].priority, x[2] - x[1], -x[0].number)
        return e[1] <= d[1] and e[2] >= d[2] and key(e) > key(d)

    kept = [d for d in found if not any(beats(e, d) for e in found)]
    score = max([d[0].relevance for d in kept] + [0.9 if base else 0.0])
    return {
        "n_words": len(words), "n_base": len(places), "first_word": min(places, default=None), "last_word": max(places, default=None),
        "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(base | {d[0].label for d in kept})), "score": score,
    }


def test_licences_against_brute_force(spark):
    rng = random.Random(11)
    parts = [
        "under the MIT License", "the", "Apache License, Version 2.0", "licensed under", "CC BY-NC 4.0", "cc-by", "GNU General Public License",
        "version 3", "SPDX-License-Identifier: MIT", "All rights reserved.", "https://opensource.org/licenses/MIT", "é", "Copyright (c) 2020",
        "Creative Commons Attribution-ShareAlike 4.0", "word", "\n", "Mozilla Public License v2.0", "K", "İ",
    ]
    texts = ODD_TEXTS + [" ".join(rng.choice(parts) for _ in range(rng.randint(1, 9))) for _ in range(200)]
    got = collected(license_scan.scan_licenses(documents(spark, texts).withColumn("words", F.lit(0))))
    for i, text in enumerate(texts):
        assert {k: got[i][k] for k in scanned(text)} == scanned(text), text
    assert license_scan.scan_licenses(documents(spark, texts).where("false")).count() == 0


def test_licence_rules_are_many_and_compile():
    assert len(rules()) > 300 and all(re.compile(r.pattern) for r in rules())


# ---- pseudonyms

def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


PRIVATE = {
    "call +1 (743) 555-3824 now": "phone:1", "4111 1111 1111 1111": "card:1", "4111-1111-1111-1112": "", "ip 152.143.123.131.": "address:1",
    "999.1.1.1": "", "born 1984-02-29": "date:1", "1983-02-29": "", "12/31/1999, 31.12.1999": "date:2", "123-45-6789": "social:1",
    "000-12-3456": "", "DE89 3704 0044 0532 0130 00": "iban:1", "DE88370400440532013000": "", "geteü enbest.54@mail3.example.com.": "email:1",
}


def test_pseudonyms_keep_format_and_can_be_undone(spark):
    texts = list(PRIVATE) + ODD_TEXTS
    docs = documents(spark, texts).withColumn("pii_hits", F.lit("other"))
    hidden = pii_pseudonyms.pseudonymise(docs, "key", counts_col="found")
    got = collected(hidden)
    for i, (text, kinds) in enumerate(PRIVATE.items()):
        assert got[i]["found"] == kinds
        assert (got[i]["text"] != text) == bool(kinds)
        if kinds and not kinds.startswith(("address", "email")):
            assert re.sub(r"\d", "9", got[i]["text"]) == re.sub(r"\d", "9", text)
    assert luhn(re.sub(r"\D", "", got[1]["text"]))
    assert all(got[len(PRIVATE) + i]["text"] == t for i, t in enumerate(ODD_TEXTS))
    assert got[0]["pii_hits"] == "other"
    back = collected(pii_pseudonyms.pseudonymise(hidden.drop("found"), "key", reveal=True))
    assert [back[i]["text"] for i in range(len(texts))] == texts
    assert pii_pseudonyms.pseudonymise(docs.where("false"), "key").count() == 0


def test_pseudonyms_link_equal_values_and_never_collide(spark):
    days = spark.range(73_049).select(F.date_format(F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("text"))
    out = pii_pseudonyms.pseudonymise(days, "key")
    assert out.distinct().count() == 73_049
    twice = pii_pseudonyms.pseudonymise(documents(spark, ["a 1.2.3.4 b", "1.2.3.4"]), "key").orderBy("doc_id").collect()
    assert twice[0]["text"] == f"a {twice[1]['text']} b"
    other = pii_pseudonyms.pseudonymise(documents(spark, ["1.2.3.4"]), "another").first()["text"]
    assert other != twice[1]["text"]


def test_native_operators_run_no_python(spark):
    docs = documents(spark, ["x"])
    for df in (license_scan.scan_licenses(docs), pii_pseudonyms.pseudonymise(docs, "key")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|Exchange", plan)
