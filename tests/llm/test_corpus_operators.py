"""The operators that compare documents or vectors with each other, against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import common, decontaminate, line_templates, nn_descent, simhash, suffix_dedup


def documents(spark, texts, first=0):
    return spark.createDataFrame([(first + i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(5)


def collected(df, key="doc_id"):
    return {r[key]: r.asDict() for r in df.collect()}


def roots(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


# ---- components

@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_connected_components(spark, shape):
    rng = random.Random(2)
    pairs = {
        "path": [(i, i + 1) for i in range(60)], "star": [(7, i) for i in range(60)], "none": [],
        "random": [(rng.randrange(90), rng.randrange(90)) for _ in range(60)],
    }[shape]
    df = spark.createDataFrame(pairs, "x bigint, y bigint")
    got = {r["node"]: r["root"] for r in common.connected_components(df, "x", "y").collect()}
    ends = {n for p in pairs if p[0] != p[1] for n in p}
    assert got == roots(ends, [p for p in pairs if p[0] != p[1]])


# ---- SimHash

def print_of(text, size):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[\x20\x09-\x0D]+", low) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_against_brute_force(spark):
    rng = random.Random(4)
    word = lambda: rng.choice(["Ab", "cd", "É", "x1", "of", "the", "zz", "q r"])
    texts = [None, "", " \t\n", "one", "two words", "a b c"]
    for _ in range(25):
        base = [word() for _ in range(rng.randint(3, 120))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 4)):
            copy = base[:]
            copy[rng.randrange(len(copy))] = word()
            texts.append("\n".join(copy))
    docs = documents(spark, texts).unionByName(documents(spark, texts[:3])).withColumn("fp", F.lit("x"))
    got = collected(simhash.near_duplicates(docs))
    prints = {i: print_of(t, 4) for i, t in enumerate(texts)}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    want = roots(prints, links)
    assert {i: (r["fingerprint"], r["component_id"]) for i, r in got.items()} == {
        i: (f"{prints[i]:016x}", want[i]) for i in prints
    }
    kept = simhash.keep_one_per_group(docs, shingle=4)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want.values())) and kept.columns == docs.columns
    assert simhash.near_duplicates(docs.where("false")).count() == 0


@pytest.mark.parametrize("radius", [0, 3, 4, 7])
def test_bit_sliced_links(radius):
    rng = np.random.default_rng(radius)
    centres = rng.integers(0, 2**63, 40, dtype=np.uint64)
    values = [c ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, rng.integers(0, radius + 3), replace=False))) for c in centres for _ in range(5)]
    values = np.unique(np.array(values, dtype=np.uint64))
    pairs = [(i, j) for i in range(len(values)) for j in range(i) if int(values[i] ^ values[j]).bit_count() <= radius]
    want = roots(range(len(values)), pairs)
    assert simhash.links_within(values, radius).tolist() == [want[i] for i in range(len(values))]


def test_crowded_buckets_and_two_levels_lose_no_link(spark, monkeypatch):
    rng = np.random.default_rng(9)
    centre = int(rng.integers(0, 2**62))
    values = {centre ^ sum(1 << int(b) for b in rng.choice(62, 2, replace=False)) for _ in range(150)}
    far = {int(v) for v in rng.integers(0, 2**62, 100)}
    df = spark.createDataFrame([(v,) for v in values | far], "fp bigint")
    pairs = [(a, b) for a in values | far for b in values | far if a < b and (a ^ b).bit_count() <= 4]
    want = {n: r for n, r in roots(values | far, pairs).items()}
    monkeypatch.setattr(simhash, "BUCKET_ROWS", 16)
    for rows in (10**6, 0):
        monkeypatch.setattr(simhash, "ONE_LEVEL_ROWS", rows)
        links = simhash.fingerprint_links(df, 4)
        got = {r["node"]: r["root"] for r in common.connected_components(links, "a", "b").collect()}
        assert got == {n: r for n, r in want.items() if sum(x == r for x in want.values()) > 1}


# ---- line templates

def test_recurring_templates_are_dropped_and_first_ones_stay(spark):
    texts = [
        "Posted on 2020-01-02 by admin at noon\nonly here is this line\nshort one",
        "Posted on 2021-11-12 by admin at noon\nshort one\nshare this page with all of your friends today",
        "Posted on 1999-01-01 by guest at noon\nshare this page with all of your family today",
        "only here is another thing", None, "", "Posted on 2020-01-02 by admin at noon",
    ]
    docs = documents(spark, texts).withColumn("row", F.lit("kept")).withColumn("n_dropped", F.lit(-1))
    got = collected(line_templates.drop_recurring_lines(docs.drop("n_dropped"), dropped_col="n_dropped"))
    assert got[0]["text"] == texts[0] and got[0]["n_dropped"] == 0
    assert got[1]["text"] == "short one\nshare this page with all of your friends today"
    assert got[2]["text"] == "" and got[2]["n_dropped"] == 2  # six of seven tokens in place are enough
    assert got[3]["text"] == texts[3] and got[4]["text"] is None and got[5]["text"] == ""
    assert got[6]["text"] == "" and got[6]["row"] == "kept"
    assert line_templates.drop_recurring_lines(docs.where("false")).count() == 0


def brute_lines(texts, similarity=0.8, least=4):
    import re

    masked, leaves = {}, defaultdict(dict)
    for d, text in enumerate(texts):
        for p, raw in enumerate((text or "").split("\n")):
            line = re.sub(r"[^ \d]*\d[^ ]*", "<*>", re.sub("[\t\r\f ]+", " ", raw).strip(" "))
            tokens = line.split(" ")
            if len(tokens) >= least:
                masked[d, p] = line
                leaves[len(tokens), tuple(tokens[:3])].setdefault(line, set()).add(d)
    first = {}
    for lines in leaves.values():
        if len(set().union(*lines.values())) < 2:
            continue
        templates = []
        for line in sorted(lines, key=str.encode):
            tokens = line.split(" ")
            same = [sum(a == b for a, b in zip(t["tokens"], tokens)) for t in templates]
            best = max(range(len(same)), key=lambda i: (same[i], -i), default=None)
            if best is not None and same[best] >= similarity * len(tokens):
                t = templates[best]
                t["tokens"] = [a if a == b else "<*>" for a, b in zip(t["tokens"], tokens)]
                t["lines"].append(line)
            else:
                templates.append({"tokens": tokens, "lines": [line]})
        joined = defaultdict(list)
        for t in templates:
            joined[tuple(t["tokens"])] += t["lines"]
        for members in joined.values():
            docs = set().union(*(lines[m] for m in members))
            if len(docs) > 1:
                first.update((m, min(docs)) for m in members)
    return [
        None if t is None else "\n".join(raw for p, raw in enumerate(t.split("\n")) if first.get(masked.get((d, p)), d) == d)
        for d, t in enumerate(texts)
    ]


def test_line_templates_against_brute_force(spark):
    rng = random.Random(6)
    line = lambda: " ".join(rng.choice(["a", "b", "c", "d1", "e\t"]) for _ in range(rng.randint(1, 9)))
    texts = ["\n".join(line() for _ in range(rng.randint(0, 12))) for _ in range(60)] + [None]
    got = collected(line_templates.drop_recurring_lines(documents(spark, texts)))
    assert [got[i]["text"] for i in range(len(texts))] == brute_lines(texts)


# ---- decontamination

def edits(item, doc):
    row = [0] * (len(doc) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(doc, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_leaks_against_full_alignment():
    rng = random.Random(3)
    for _ in range(150):
        item = " ".join("".join(rng.choice("abcde fgh") for _ in range(rng.randint(30, 150))).split())
        leak = list(item)
        for _ in range(rng.randint(0, 14)):
            at = rng.randrange(len(leak))
            leak[at : at + rng.randint(0, 1)] = rng.choice(["", "x", "y"])
        around = ["".join(rng.choice("abcde fgh") for _ in range(rng.randint(0, 200))) for _ in range(2)]
        doc = " ".join(f"{around[0]} {''.join(leak)} {around[1]}".split())
        index = decontaminate.Index([item], 0.08)
        found, least = index.matches(doc), edits(item, doc)
        assert bool(found) == (least <= index.pieces[0].budget)
        if found:
            assert found[0][3] == least == edits(item, doc[found[0][1] : found[0][2]])


def test_leaks_in_documents(spark):
    item = "The quick brown fox jumps over the lazy dog, again and again, until the evening comes."
    texts = [f"Before. {item.upper()} After.", "clean text that shares the lazy dog", None, "", item.replace("fox", "cat"), "short gem!"]
    bench = spark.createDataFrame([(5, item), (None, "short gem"), (6, None), (7, "")], "item_id bigint, text string")
    docs = documents(spark, texts).withColumn("row", F.lit(1))
    got = {(r["id"], r["item"], r["edits"]) for r in decontaminate.contaminated(docs, bench).collect()}
    assert got == {(0, 5, 0), (4, 5, 3), (5, None, 0)}
    left = decontaminate.drop_contaminated(docs, bench)
    assert sorted(r["doc_id"] for r in left.collect()) == [1, 2, 3] and left.columns == docs.columns
    assert decontaminate.contaminated(docs, bench.where("false")).count() == 0
    assert decontaminate.contaminated(docs.where("false"), bench).count() == 0


def test_benchmark_in_blocks_gives_the_same(spark, monkeypatch):
    bench = spark.createDataFrame([(i, f"item number {i} says something long enough {i * 7919}") for i in range(30)], "item_id bigint, text string")
    docs = documents(spark, [f"x item number {i} says something long enough {i * 7919} y" for i in range(30)])
    whole = {tuple(r) for r in decontaminate.contaminated(docs, bench).collect()}
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 300)
    assert {tuple(r) for r in decontaminate.contaminated(docs, bench).collect()} == whole and len(whole) >= 30


# ---- suffix dedup

def without_repeats(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(d, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept))
    return out


@pytest.mark.parametrize("bucket", [8_192, 7])
@pytest.mark.parametrize("length", [20, 40])
def test_repeats_against_brute_force(spark, monkeypatch, bucket, length):
    monkeypatch.setattr(suffix_dedup, "BUCKET_ROWS", bucket)
    rng = random.Random(bucket + length)
    base = ["".join(rng.choice("ab é") for _ in range(length * 2)) for _ in range(6)]
    texts = []
    for _ in range(40):
        text = ""
        for _ in range(rng.randint(0, 4)):
            kind = rng.random()
            if kind < 0.5:
                at = rng.randint(0, length)
                text += rng.choice(base)[at : at + rng.randint(length // 2, length * 2)]
            elif kind < 0.6:
                text += "a" * rng.randint(0, length * 2)
            else:
                text += "".join(rng.choice("abcdefg") for _ in range(rng.randint(0, length)))
        texts.append(text)
    texts += [None, "", texts[3]]
    docs = documents(spark, texts).withColumn("cuts", F.lit(1))
    got = collected(suffix_dedup.remove_repeats(docs, length=length))
    want = without_repeats(texts, length)
    for i in range(len(texts)):
        row = got[i]
        assert (row["n_bytes"], row["n_removed"], row["n_spans"], row["kept_sha256"], bytes(row["kept"])) == want[i]
    assert suffix_dedup.remove_repeats(docs.where("false"), length=length).count() == 0


def test_identical_rows_remove_each_other(spark):
    docs = spark.createDataFrame([(1, "x" * 30 + "abcdefghij" * 5)] * 2 + [(None, "z" * 10)], "doc_id bigint, text string")
    got = suffix_dedup.remove_repeats(docs, length=40).where("doc_id = 1").collect()
    assert [r["n_removed"] for r in got] == [80, 80]


# ---- embeddings

def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(1)
    rows, label = [], lambda: int(rng.integers(0, 3))
    for _ in range(60):
        centre, own = rng.normal(size=16), label()
        for _ in range(int(rng.integers(1, 12))):
            rows.append((centre + rng.normal(size=16) * 0.03, own))
    rows += [(rows[0][0], rows[0][1])] * 20 + [(rows[5][0] * 3, rows[5][1])]
    table = [(i, [float(x) for x in v], l) for i, (v, l) in enumerate(rows)]
    n = len(table)
    table += [(n, None, 1), (n + 1, [0.0] * 16, 1), (n + 2, [float("nan")] * 16, 1), (n + 3, [1.0, None], 1), (n + 4, rows[0][0].tolist(), None),
              (n + 5, [1.0, 2.0], 1), (n + 6, [2.0, 4.0], 1), (n + 7, [], 1)]
    df = spark.createDataFrame(table, "vec_id bigint, embedding array<double>, label int").withColumn("node", F.lit(1))
    unit = np.array([v / np.linalg.norm(v) for v, _ in rows])
    same = np.array([l for _, l in rows])
    close = (unit @ unit.T >= 0.98) & (same[:, None] == same[None, :])
    np.fill_diagonal(close, False)
    want = roots(range(n), zip(*np.nonzero(close)))
    result = nn_descent.near_vectors(df)
    got = collected(result, "vec_id")
    for i in range(n):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (close[i].sum(), want[i], want[i] == i)
    for i in (n, n + 1, n + 2, n + 3, n + 4, n + 7):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert got[n + 5]["n_links"] == got[n + 6]["n_links"] == 1 and got[n + 6]["component_id"] == n + 5
    found, there = nn_descent.audit_recall(df, result, every=5)
    assert there > 0 and found >= 0.9 * there
    assert nn_descent.near_vectors(df.where("false")).count() == 0


def test_large_components_are_counted_in_tiles(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "TILE", 16)
    rng = np.random.default_rng(2)
    centre = rng.normal(size=8)
    vectors = [centre + rng.normal(size=8) * 0.05 for _ in range(120)]
    df = spark.createDataFrame([(i, [float(x) for x in v], 0) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<float>, label int")
    unit = np.array([np.array(v, dtype=np.float32).astype(float) for v in vectors])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    close = unit @ unit.T >= 0.98
    np.fill_diagonal(close, False)
    got = collected(nn_descent.near_vectors(df), "vec_id")
    assert [got[i]["n_links"] for i in range(120)] == close.sum(axis=1).tolist()
