"""Encoding checks and repairs over document texts, a tenth of them written as ISO-8859-1."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import encoding as en
from tidemark.plans.registry import query, table
from tidemark.session import scratch_path

LATIN = r"^[\x00-\xFF]*$"
SQL_LATIN = r"regexp_matches(text, '^[\x00-\x{FF}]*$')"
SQL_HIGH = r"regexp_matches(text, '[\x{80}-\x{FF}]')"
SQL_LINE = r"regexp_replace(text, '[\r\n]+', ' ', 'g')"
DAMAGED_SQL = f"(doc_id % 10 = 0 and {SQL_LATIN} and {SQL_HIGH})"


def one_line():
    return F.regexp_replace("text", "[\r\n]+", " ")


def documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def damaged():
    return (F.col("doc_id") % 10 == 0) & F.col("text").rlike(LATIN)


def raw(text):
    """Text bytes: ISO-8859-1 for the damaged documents, else UTF-8."""
    return F.when(damaged(), F.encode(F.when(damaged(), text), en.LATIN_1)).otherwise(F.encode(text, en.UTF_8)).cast("string")


def damaged_file(spark, sf_dir):
    """One line per document: its number, a tab and its bytes."""
    path = scratch_path(spark, "lines")
    docs = documents(spark, sf_dir).withColumn("text", one_line())
    docs.select(F.concat(F.col("doc_id").cast("string"), F.lit("\t"), raw(F.col("text"))).alias("value")).write.text(path)
    return path


@query(
    "non_utf8_lines",
    "select doc_id, pos::int as start, (pos + 1)::int as \"end\", printf('%02x', unicode(c)) as bad_bytes from (select doc_id, c, "
    f"length(cast(doc_id as varchar)) + strpos(t, c) as pos from (select doc_id, {SQL_LINE} as t, "
    "regexp_extract(text, '[\\x{80}-\\x{FF}]') as c from documents "
    f"where {DAMAGED_SQL}))",
)
def non_utf8_lines(spark, sf_dir):
    lines = en.numbered_lines(spark, damaged_file(spark, sf_dir))
    keyed = lines.withColumn("doc_id", F.substring_index("value", "\t", 1).cast("bigint"))
    return en.non_utf8_lines(keyed, ["doc_id"]).drop("reason")


@query("numbered_lines", "select count(*) as lines, true as without_gaps from documents")
def numbered_lines(spark, sf_dir):
    """Line numbers of each file run from 1 without gaps."""
    path = scratch_path(spark, "numbered")
    documents(spark, sf_dir).repartition("doc_id").select(one_line().alias("value")).write.text(path)
    per_file = en.numbered_lines(spark, path).groupBy("path").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("line").alias("d"), F.min("line").alias("lo"), F.max("line").alias("hi")
    )
    return per_file.agg(F.sum("n").alias("lines"), F.every(F.expr("lo = 1 and hi = n and d = n")).alias("without_gaps"))


@query(
    "non_utf8_cells",
    f"select doc_id, {DAMAGED_SQL} as text_non_utf8, false as key_non_utf8, {DAMAGED_SQL} as non_utf8, "
    f"case when {DAMAGED_SQL} then null else text end as text from documents",
)
def non_utf8_cells(spark, sf_dir):
    docs = documents(spark, sf_dir)
    # what a CSV read with encoding ISO-8859-1 would hold: every byte as one character
    cells = docs.select(
        F.col("doc_id").cast("string").alias("key"), F.decode(raw(F.col("text")).cast("binary"), en.LATIN_1).alias("text")
    )
    out = en.decode_cells(cells)
    return out.select(
        F.col("key").cast("bigint").alias("doc_id"), "text_non_utf8", "key_non_utf8", "non_utf8",
        F.when(~F.col("text_non_utf8"), F.col("text")).alias("text"),
    )


@query("non_utf8_values", f"select count(distinct text) as damaged_texts from documents where {DAMAGED_SQL}")
def non_utf8_values(spark, sf_dir):
    docs = documents(spark, sf_dir)
    cells = docs.select(F.decode(raw(F.col("text")).cast("binary"), en.LATIN_1).alias("text"))
    found = en.bad_values(en.decode_cells(cells), ["text"])
    return found.agg(F.count(F.lit(1)).alias("damaged_texts"))


@query("reencode", f"select doc_id, {SQL_LINE} as text from documents")
def reencode(spark, sf_dir):
    """Damaged lines decoded from ISO-8859-1, the others from UTF-8: the original text comes back."""
    lines = en.raw_lines(spark, damaged_file(spark, sf_dir))
    value = F.col("value")
    text = F.when(F.is_valid_utf8(value), value).otherwise(en.decode_from(value, "latin-1"))
    parts = F.split(text, "\t", 2)
    return lines.select(F.get(parts, F.lit(0)).cast("bigint").alias("doc_id"), F.get(parts, F.lit(1)).alias("text"))


@query("reencode_cp1252", f"select doc_id, {SQL_LINE} as text from documents")
def reencode_cp1252(spark, sf_dir):
    """Texts that windows-1252 can hold are stored in it, the others in UTF-8; all come back whole."""
    fits = F.col("text").rlike(LATIN) & ~F.col("text").rlike(r"[\x80-\x9F]")
    docs = documents(spark, sf_dir).withColumn("text", one_line()).withColumn("fits", fits)
    stored = F.when(F.col("fits"), F.encode(F.when(F.col("fits"), F.col("text")), en.LATIN_1)).otherwise(F.encode("text", en.UTF_8))
    lines = docs.select("doc_id", "fits", stored.cast("string").alias("value"))
    value = F.col("value")
    return lines.select(
        "doc_id", F.when(F.col("fits"), en.decode_from(value, "cp1252")).otherwise(en.decode_from(value, "utf-8")).alias("text")
    )


@query(
    "repair_policy",
    f"select doc_id, case when {DAMAGED_SQL} then regexp_replace(text, '[\\x{{80}}-\\x{{FF}}]', '', 'g') else text end as dropped, "
    f"{DAMAGED_SQL} as replaced from documents",
)
def repair_policy(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", raw(F.col("text")).alias("value"), F.col("text").contains("�").alias("had"))
    return docs.select(
        "doc_id",
        en.repair(F.col("value"), "ignore").alias("dropped"),
        (en.repair(F.col("value"), "replace").contains("�") & ~F.col("had")).alias("replaced"),
    )


@query(
    "detect_encoding",
    "select lang, case when bool_or(bad) then 'iso-8859-1' when bool_and(ascii) then 'ascii' else 'utf-8' end as encoding, "
    f"round(avg(bad::int), 6) as invalid_share from (select lang, {DAMAGED_SQL} as bad, "
    "not regexp_matches(text, '[^\\x00-\\x7F]') as ascii from documents) group by lang",
)
def detect_encoding(spark, sf_dir):
    """One folder of lines per language stands for a file."""
    docs = table(spark, sf_dir, "documents").withColumn("text", one_line())
    lines = docs.select(F.col("lang").alias("path"), raw(F.col("text")).alias("value"))
    return en.detect_encoding(lines).select(
        F.col("path").alias("lang"), "encoding", F.round("invalid_share", 6).alias("invalid_share")
    )


@query("read_or_repair", f"select count(*) as lines, 0 as still_invalid, sum(length({SQL_LINE}))::bigint as characters from documents")
def read_or_repair(spark, sf_dir):
    path, target = scratch_path(spark, "broken"), scratch_path(spark, "fixed")
    docs = documents(spark, sf_dir).withColumn("text", one_line())
    # whole files of one encoding: the ISO-8859-1 texts apart from the others
    docs.select(raw(F.col("text")).alias("value"), damaged().alias("latin")).write.partitionBy("latin").text(path)
    fixed, left = en.read_or_repair(spark, path, target)
    return fixed.agg(F.count(F.lit(1)).alias("lines"), F.sum(F.char_length("value")).alias("characters")).withColumn(
        "still_invalid", left.agg(F.count(F.lit(1)).cast("int").alias("n")).scalar()
    )


@query("fix_mojibake", "select doc_id, text from documents")
def fix_mojibake(spark, sf_dir):
    """Texts garbled by one wrong decoding come back; texts that were never garbled stay."""
    docs = documents(spark, sf_dir)
    garbled = F.when(F.col("doc_id") % 2 == 0, F.decode(F.encode("text", en.UTF_8), en.LATIN_1)).otherwise(F.col("text"))
    return docs.select("doc_id", en.fix_mojibake(garbled).alias("text"))
