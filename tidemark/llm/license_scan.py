"""Licence scan with ordered signature rules, in Spark expressions alone.

A text is lower-cased (A-Z) and cut into words of letters, digits and non-ASCII characters. Rules are regular expressions over the
words joined by single spaces. A text that holds no word of any gate is done at once; otherwise each rule is tried
only where its own gate words occur, which stand in every match. Every match is an interval of words with a priority. A detection
is suppressed when another one contains its interval and has a higher priority, or the same and a longer interval, or
the same of both and an earlier rule. Base phrases are always found, whatever the rules say.

Defined results: null and empty texts have no words and no labels; positions are null without a base phrase; labels are
sorted and distinct, an empty string without any; rows that repeat are scanned each for itself; only ids and texts are read. Empty
tables give empty results.
"""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import quoted, text_of
from tidemark.llm.license_rules import rules

# Phrases that are always found, and their labels
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# what stands between words; the class of the word characters themselves, a complement, is several times slower in Java
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# the keyword prefilter: no rule can match a text without the longest word of its gate, or without a Creative Commons short name
OPENING = sorted({max(r.gate.split(), key=len) for r in rules() if not r.gate.startswith("cc")})
OPENING = [w for w in OPENING if not any(o in w for o in OPENING if o != w)]
CREATIVE = r"(?:^|[\x00-\x2F\x3A-\x60\x7B-\x7F])cc(?:0|[\x00-\x2F\x3A-\x60\x7B-\x7F]+by)(?:[\x00-\x2F\x3A-\x60\x7B-\x7F]|$)"


def spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def rule_table() -> Column:
    """The rules as a constant, under their gates."""
    gates: dict[str, list[dict]] = {}
    for r in rules():
        gates.setdefault(r.gate, []).append(asdict(r))
    return F.from_json(
        F.lit(json.dumps([{"gate": g, "rules": found} for g, found in gates.items()])),
        "array<struct<gate:string,rules:array<struct<number:int,label:string,pattern:string,priority:int,relevance:double>>>>",
    )


def matches(words: Column, rule: Column) -> Column:
    """Intervals of words (first, last) where the rule matches: between the pieces that its matches leave."""
    pieces = F.split(words, rule["pattern"], -1)
    hits = F.regexp_extract_all(words, rule["pattern"], F.lit(0))
    start = F.struct(F.lit(0).alias("seen"), F.array().cast("array<struct<first:int,last:int>>").alias("found"))

    def step(state: Column, pair: Column) -> Column:
        first = state["seen"] + spaces(pair["piece"])
        last = first + spaces(pair["hit"])
        return F.struct(
            last.alias("seen"),
            F.when(
                pair["hit"].isNotNull(),
                F.concat(state["found"], F.array(F.struct((first - 1).cast("int").alias("first"), (last - 1).cast("int").alias("last")))),
            ).otherwise(state["found"]).alias("found"),
        )

    pairs = F.zip_with(pieces, hits, lambda piece, hit: F.struct(piece.alias("piece"), hit.alias("hit")))
    found = F.aggregate(pairs, start, step)["found"]
    return F.transform(
        found,
        lambda m: F.struct(
            rule["number"].alias("number"), rule["label"].alias("label"), rule["priority"].alias("priority"),
            rule["relevance"].alias("relevance"), m["first"].alias("first"), m["last"].alias("last"),
        ),
    )


def standing(found: Column) -> Column:
    """Detections that no other one suppresses."""

    def beats(e: Column, d: Column) -> Column:
        longer = (e["last"] - e["first"]) - (d["last"] - d["first"])
        inside = (e["first"] <= d["first"]) & (e["last"] >= d["last"])
        ahead = (e["priority"] > d["priority"]) | (
            (e["priority"] == d["priority"]) & ((longer > 0) | ((longer == 0) & (e["number"] < d["number"])))
        )
        return inside & ahead

    return F.filter(found, lambda d: ~F.exists(found, lambda e: beats(e, d)))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections) of every row.

    The score is the highest relevance of the detections, base phrases counting 0.9; ``detections`` holds the standing ones with their
    words and rule numbers.
    """
    lower = F.lower(F.col("text"))
    rows = docs.select(quoted(id_col).alias("id"), text_of(text_col).alias("text"))
    opens = F.contains(lower, F.lit("cc")) & lower.rlike(CREATIVE)
    for word in OPENING:
        opens = opens | F.contains(lower, F.lit(word))
    plain = F.trim(F.regexp_replace("text", BETWEEN, " "))
    rows = rows.select("id", plain.alias("plain"), opens.alias("opens")).select(
        "id", F.when(F.length("plain") > 0, spaces(F.col("plain")) + 1).otherwise(0).cast("bigint").alias("n_words"),
        F.when(F.col("opens"), F.concat(F.lit(" "), F.translate("plain", UPPER, LOWER), F.lit(" "))).alias("words"),
    )
    w = F.col("words")
    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in BASE_PHRASES.items():
        framed = f" {phrase} "
        at, back = F.instr(w, framed), F.instr(F.reverse(w), framed[::-1])
        end = F.length(w) - back + 1  # place of the last framing space
        counts.append(F.coalesce(F.regexp_count(w, F.lit(rf"(?<= ){phrase}(?= )")), F.lit(0)))
        firsts.append(F.when(at > 0, spaces(F.substring(w, F.lit(1), at)) - 1))
        lasts.append(F.when(back > 0, spaces(F.substring(w, F.lit(1), end - len(framed) + 1)) - 1))
        labels.append(F.when(at > 0, F.lit(label)))
    gates_here = F.filter(rule_table(), lambda g: F.contains(w, g["gate"]))
    rules_here = F.flatten(F.transform(gates_here, lambda g: g["rules"]))
    found = F.when(w.isNotNull(), F.flatten(F.transform(rules_here, lambda r: matches(w, r))))
    empty = F.array().cast("array<struct<number:int,label:string,priority:int,relevance:double,first:int,last:int>>")
    rows = rows.select(
        "id", "n_words", sum(counts[1:], counts[0]).cast("bigint").alias("n_base"),
        F.least(*firsts).cast("bigint").alias("first_word"), F.greatest(*lasts).cast("bigint").alias("last_word"),
        F.array_compact(F.array(*labels)).alias("base"), F.coalesce(found, empty).alias("found"),
    ).withColumn("detections", standing(F.col("found")))
    best = F.aggregate("detections", F.lit(0.0), lambda top, d: F.greatest(top, d["relevance"]))
    every = F.array_union("base", F.transform("detections", lambda d: d["label"]))
    return rows.select(
        F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(every), ",").alias("labels"),
        F.greatest(best, F.when(F.size("base") > 0, F.lit(0.9)).otherwise(F.lit(0.0))).alias("score"), "detections",
    )
