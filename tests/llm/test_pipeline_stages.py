"""The stages of the pipeline against brute force."""

import random

import pytest

from test_corpus_operators import documents, roots

import corpus_pipeline
from tidemark.llm import byte_bpe, shingle_sets, simhash
from tidemark.llm.queries import PATTERN, VOCABULARY


def shingles(text, size=5):
    words = text.lower().split()
    return {" ".join(words[i : i + size]) for i in range(len(words) - size + 1)} or {" ".join(words)}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def edited_copies(rng, bases=25, copies=6):
    """Texts with edits of 0 to 12 words, so that pairs lie on both sides of Jaccard 0.8."""
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 8)))
    texts = ["", "one", "One ", "two words"]
    for _ in range(bases):
        base = [word() for _ in range(rng.randint(30, 300))]
        for _ in range(copies):
            copy = list(base)
            for at in rng.sample(range(len(copy)), rng.randint(0, min(12, len(copy) // 40 + 1))):
                copy[at] = word()
            texts.append(" ".join(copy))
    return texts


def test_near_duplicates_by_jaccard_against_brute_force(spark):
    texts = edited_copies(random.Random(31))
    sets, prints = [shingles(t) for t in texts], [simhash.fingerprint(t, 5) for t in texts]
    every = [(i, j) for j in range(len(texts)) for i in range(j)]
    near = [(i, j) for i, j in every if jaccard(sets[i], sets[j]) >= 0.8]
    bits = {p: (prints[p[0]] ^ prints[p[1]]).bit_count() for p in every}
    assert sum(bits[p] > 4 for p in near) > 50  # pairs that the fingerprints alone do not link
    want = set(roots(range(len(texts)), near + [p for p in every if bits[p] <= 4]).values())
    got = corpus_pipeline.drop_near_duplicates(spark, documents(spark, texts), "")
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(want)
    assert corpus_pipeline.drop_near_duplicates(spark, documents(spark, texts).where("false"), "").count() == 0


@pytest.mark.parametrize("limit", [0, 200_000])
def test_links_are_joined_alike_in_one_task_and_in_rounds(spark, monkeypatch, limit):
    monkeypatch.setattr(shingle_sets, "ONE_TASK_LINKS", limit)
    rng = random.Random(3)
    pairs = [(rng.randrange(-60, 60), rng.randrange(-60, 60)) for _ in range(70)]
    pairs = [(a, b) for a, b in pairs if a != b]
    links = spark.createDataFrame(pairs, "x_root bigint, y_root bigint").repartition(4)
    got = {r["node"]: r["root"] for r in shingle_sets.components(links).collect()}
    assert got == roots({n for p in pairs for n in p}, pairs)


def test_band_keys_meet_at_the_threshold():
    rng, met, n = random.Random(5), 0, 1_000
    for _ in range(n):
        shared, own = [rng.getrandbits(64) for _ in range(80)], [rng.getrandbits(64) for _ in range(20)]
        a, b = (shingle_sets.signed(shared + part).view("<u8") for part in (own[:10], own[10:]))
        met += bool(set(shingle_sets.band_keys(a)) & set(shingle_sets.band_keys(b)))
    assert met >= n - 2


def test_all_stages_one_after_the_other(spark, tmp_path):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    item, line = text(30), "all rights reserved by the printer of this page"
    rows, toxic = [], []
    for i in range(60):
        bad = i % 4 == 0
        rows.append((i, (text(40) + " zzworst zzvile zzawful" * 3) if bad else text(60)))
        toxic.append((i, 1, int(bad)))
    rows += [(100 + i, f"{text(40)}\n{line}\n{text(20)}") for i in range(6)]
    near = "\n".join(text(3) for _ in range(30))  # lines too short for templates
    rows += [(200, near), (201, near + "\nmore"), (202, near)]
    rows += [(300, f"{text(30)} {item} {text(30)}"), (301, None), (302, "")]
    docs = spark.createDataFrame([(i, t, "en", "web", len(t or "")) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(toxic, "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item), (2, text(25))], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    held, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES:
        out = str(tmp_path / name)
        stage(spark, held, str(tmp_path)).write.parquet(out)
        held = spark.read.parquet(out)
        seen[name] = {r["doc_id"]: r for r in held.collect()}
        if name != "byte_bpe":
            assert held.columns == docs.columns
    assert not any(i % 4 == 0 for i in seen["toxicity"] if i < 60) and all(i in seen["toxicity"] for i in range(60) if i % 4)
    with_line = [i for i, r in seen["line_dedup"].items() if line in (r["text"] or "")]
    assert with_line == [100] and set(seen["line_dedup"]) == set(seen["toxicity"])
    assert all(r["n_chars"] == len(r["text"]) for r in seen["line_dedup"].values() if r["text"] is not None)
    assert {200, 201, 202} & set(seen["simhash_near_dedup"]) == {200}
    assert set(seen["simhash_near_dedup"]) - set(seen["decontamination"]) == {300}
    assert set(seen["byte_bpe"]) == set(seen["decontamination"])
    bpe = byte_bpe.ByteBpe(VOCABULARY, PATTERN)
    for i, r in seen["byte_bpe"].items():
        assert bpe.decode(r["token_ids"]).decode() == (seen["decontamination"][i]["text"] or "")
        assert len(r["token_ids"]) == r["n_tokens"]
    final = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(r["doc_id"] for r in final.collect()) == sorted(seen["byte_bpe"])


def test_an_id_outside_the_vocabulary_is_refused():
    bpe = byte_bpe.ByteBpe(VOCABULARY, PATTERN)
    for ids in ([-1], [5, -3], [10**6], [None]):
        with pytest.raises(ValueError):
            bpe.decode(ids)
