"""Documents of three languages written in eight encodings, found out again from their bytes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import charset as cs, encoding as en
from tidemark.plans.registry import query, table
from tidemark.session import scratch_path

LETTERS = "éóèñçêüäößíáàùúâîôûëïÉÓÈÑÇÊÜÄÖÍÁÀ"
LANGUAGES = ("fr", "de", "es")
WRITTEN = ["ascii", "utf-8", "utf-16-le", "utf-16-be", "iso-8859-1", "windows-1252", "cp850", "mac-roman"]
LINE_FEED = {"utf-16-le": "\n\0", "utf-16-be": "\0\n"}
PLAIN_SQL = r"regexp_replace(text, '[\r\n]+', ' ', 'g')"


def written_bytes(text, encoding):
    """The text's bytes in an encoding, by JVM functions: letters are exchanged for those whose ISO-8859-1 byte is theirs."""
    if encoding == "ascii":
        return F.encode(F.regexp_replace(text, r"[^\x00-\x7F]", ""), "US-ASCII")
    if encoding in ("utf-8", "utf-16-le", "utf-16-be"):
        return F.encode(text, encoding.upper().replace("-LE", "LE").replace("-BE", "BE"))
    if encoding == "windows-1252":
        text = F.concat(F.lit("\x93"), text, F.lit("\x94"))
    elif encoding != "iso-8859-1":
        text = F.translate(text, LETTERS, "".join(c.encode(encoding).decode("latin-1") for c in LETTERS))
    return F.encode(text, en.LATIN_1)


def written_files(spark, sf_dir):
    """One folder of files per encoding and language; texts beyond ISO-8859-1 are left out, as five of the encodings have no place for them."""
    path = scratch_path(spark, "charsets")
    docs = table(spark, sf_dir, "documents").where(F.col("lang").isin(*LANGUAGES) & F.col("text").rlike(r"^[\x00-\x7F" + LETTERS + r"]*$"))
    docs = docs.withColumn("text", F.regexp_replace("text", "[\r\n]+", " "))
    for encoding in WRITTEN:
        raw = docs.select(written_bytes(F.col("text"), encoding).cast("string").alias("value"), "lang")
        raw.write.option("lineSep", LINE_FEED.get(encoding, "\n")).partitionBy("lang").text(f"{path}/{encoding}")
    return path


def folder(path):
    return F.regexp_extract(path, r"([^/]+/lang=[^/]+)/[^/]*$", 1)


def lines_of(spark, sf_dir):
    path = written_files(spark, sf_dir)
    lines = spark.read.text([f"{path}/{e}" for e in WRITTEN], recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("file"), "value")
    return lines.select(folder(F.col("file")).alias("path"), "value")


@query(
    "detect_charset",
    "select e as written, lang, e as detected from (select unnest(["
    + ", ".join(f"'{e}'" for e in WRITTEN) + "]) as e), (select distinct lang from documents where lang in ('fr', 'de', 'es'))",
)
def detect_charset(spark, sf_dir):
    """The confusion table of eight encodings and three languages: every one is found again."""
    found = cs.detect_charsets(lines_of(spark, sf_dir))
    parts = F.split("path", "/lang=")
    return found.select(F.get(parts, F.lit(0)).alias("written"), F.get(parts, F.lit(1)).alias("lang"), F.col("encoding").alias("detected"))


@query(
    "charset_texts",
    f"select e as written, lang, count(*) as lines, sum(length(case when e = 'ascii' then regexp_replace({PLAIN_SQL}, '[^\\x00-\\x7F]', '', 'g') else {PLAIN_SQL} end)"
    " + case when e = 'windows-1252' then 2 else 0 end)::bigint as characters from documents, (select unnest(["
    + ", ".join(f"'{e}'" for e in WRITTEN) + f"]) as e) where lang in ('fr', 'de', 'es') and regexp_matches(text, '^[\\x00-\\x7F{LETTERS}]*$') group by all",
)
def charset_texts(spark, sf_dir):
    """The files decoded by what was detected have the characters that were written."""
    lines = lines_of(spark, sf_dir)
    texts = cs.decode_lines(lines, cs.detect_charsets(lines)).where(F.col("text") != "")
    parts = F.split("path", "/lang=")
    return texts.groupBy(F.get(parts, F.lit(0)).alias("written"), F.get(parts, F.lit(1)).alias("lang")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.char_length("text")).alias("characters")
    )
