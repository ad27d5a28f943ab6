"""One registered query per operator, over its whole table, with SQL counterparts where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import (
    byte_bpe, chat_format, collocations, decontaminate, license_scan, line_templates, nn_descent, pii_pseudonyms, simhash,
    suffix_dedup, token_alignment, token_files, toxicity,
)
from tidemark.session import scratch_path

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")  # the same vocabulary as the ranks in byte_bpe_50k.tiktoken
PATTERN = public_tokenizers.PATTERN
PIECES = public_tokenizers.path("piece_bpe_32k.model")
END_ID = 2
TOXIC_FROM = 0.3
PSEUDONYM_KEY = "example key, to be replaced"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


CONFLICT = "\\### Assistant: </turn> ok"


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one whose texts hold the template's own marks, digested from the formatted output."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast(given.schema["conv_id"].dataType).alias("conv_id"), F.col("id").cast(given.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONFLICT).alias("text"),
    )
    return chat_format.conversation_digests(chat_format.format_turns(given.unionByName(extra)))


OP1_SQL = r"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -7, 0, 'user', '\### Assistant: </turn> ok'
    union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
), written as (
    select *, case when role in ('system', 'user', 'assistant', 'tool') then length('### ' || role || ':')
                   else length('### Role ' || role || ':') end
        + length(regexp_replace(text, '(\\*)(### (?:System|User|Assistant|Tool):|### Role |</turn>)', '\1\1\\\2', 'g'))
        + length('</turn>') + 3 as chars
    from turns
)
select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role)) as turns_sha256,
    coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn, role) filter (role = 'assistant'), '')) as loss_sha256,
    sum(chars)::bigint as formatted_chars
from written group by conv_id
"""


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by a classifier learned from the labelled rows that are not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rest = lambda c: F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(4))
    model = toxicity.train(docs, labels, usable=rest(F.col("id")) != 2)
    scored = toxicity.with_scores(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", (rest(F.col("doc_id")) == 2).alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted")
    )


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, radius=4)


def op4_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without the lines of recurring templates."""
    kept = line_templates.drop_recurring_lines(table(spark, sf_dir, "documents"), dropped_col="n_dropped")
    return kept.select("doc_id", "n_dropped", F.length("text").cast("bigint").alias("kept_chars"), "text")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item found in a document, with its place and edits."""
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "start", "end", "edits")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document, with its digest and the remaining text."""
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), length=400)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", F.make_valid_utf8(F.col("kept").cast("string")).alias("text"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents")).drop("detections")


def op8_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii_pseudonyms.pseudonymise(docs, PSEUDONYM_KEY, counts_col="found")


def op9_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.near_vectors(table(spark, sf_dir, "embeddings"))


OP9_SQL = """
with recursive usable as (
    select vec_id, label, [x::double for x in embedding] as e from embeddings
    where label is not null and embedding is not null and len(embedding) > 0
        and len([x for x in embedding if x is null or not isfinite(x)]) = 0
        and len([x for x in embedding if x <> 0]) > 0
), pairs as (
    select a.vec_id as a, b.vec_id as b from usable a join usable b
    on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
        and list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e) * list_dot_product(b.e, b.e)) >= 0.98
), reached as (
    select distinct a as vec_id, a as other from pairs
    union select reached.vec_id, pairs.b from reached join pairs on reached.other = pairs.a
), component as (select vec_id, min(other) as root from reached group by vec_id),
linked as (select a as vec_id, count(*) as n from pairs group by a)
select e.vec_id, coalesce(n, 0)::bigint as n_links, coalesce(root, e.vec_id) as component_id,
    coalesce(root, e.vec_id) = e.vec_id as kept
from embeddings e left join component using (vec_id) left join linked using (vec_id)
"""


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.token_digests(table(spark, sf_dir, "documents"), VOCABULARY, PATTERN)


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document in packed files, with an end id, and what the files hold when they are read back."""
    docs = table(spark, sf_dir, "documents")
    return token_files.token_file_digests(docs, scratch_path(spark, "tokens"), VOCABULARY, PATTERN, END_ID)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of every language."""
    return collocations.mine_phrases(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
with texts as (
    select coalesce(lang, 'und') as lang,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
    from documents
), pieces as (select lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) as piece from texts),
cut as (select lang, [x for x in string_split_regex(piece, '[ \t]+') if x <> ''] as w from pieces),
places as (select lang, w, unnest(generate_series(1, len(w))) as i from cut where len(w) > 0),
runs as (select lang, w, i, unnest([1, 2, 3, 4]) as k from places),
f as (
    select lang, array_to_string(w[i:i + k - 1], ' ') as phrase, k, count(*) as a from runs
    where i + k - 1 <= len(w) group by all
), sizes as (select lang, sum(a) as n from f where k = 1 group by lang),
candidates as (select lang, phrase, k, a, string_split(phrase, ' ') as w from f where k >= 2 and a >= 30),
cuts as (
    select lang, phrase, k, a, w, c, array_to_string(w[1:c], ' ') as lp, array_to_string(w[c + 1:k], ' ') as rp
    from (select *, unnest(generate_series(1, k - 1)) as c from candidates)
), scored as (
    select cuts.lang, cuts.phrase, cuts.a, c, l.a as l, r.a as r, (2000000::hugeint * cuts.a) // (l.a + r.a) as score
    from cuts join f l on l.lang = cuts.lang and l.phrase = lp join f r on r.lang = cuts.lang and r.phrase = rp
), lowest as (
    select *, row_number() over (partition by lang, phrase order by score, c) as first from scored
), inner_runs as (
    select lang, a as longer, array_to_string(w[s:s + v - 1], ' ') as phrase
    from (select *, unnest(generate_series(1, k)) as s from candidates where k > 2), (values (2), (3)) as sizes(v)
    where v < k and s + v - 1 <= k
), hidden as (
    select distinct i.lang, i.phrase from inner_runs i join candidates c on c.lang = i.lang and c.phrase = i.phrase
    where 100::hugeint * longer >= 80::hugeint * c.a
), ranked as (
    select lang, phrase, a, l, r, score,
        row_number() over (partition by lang order by score desc, a desc, phrase) as rank
    from lowest where first = 1 and not exists (select 1 from hidden h where h.lang = lowest.lang and h.phrase = lowest.phrase)
)
select lang, rank, phrase, a, l, r, n::bigint as n, score::bigint as score from ranked join sizes using (lang) where rank <= 2000
"""


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids under two tokenizers aligned, with counts of linked ids over all documents."""
    return token_alignment.align_documents(table(spark, sf_dir, "documents"), VOCABULARY, PATTERN, PIECES)


LLM_QUERIES = {
    f.__name__: f
    for f in (
        op1_chat_format, op2_toxicity, op3_simhash, op4_line_templates, op5_decontamination, op6_suffix_dedup, op7_license_scan,
        op8_pii_pseudonyms, op9_nn_descent, op10_byte_bpe, op11_token_files, op12_collocations, op13_token_alignment,
    )
}
LLM_ORACLES = {"op1_chat_format": OP1_SQL, "op9_nn_descent": OP9_SQL, "op12_collocations": OP12_SQL}
