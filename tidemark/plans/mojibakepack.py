"""Documents read wrongly through chains of encodings, and read right again."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F, types as T
from pyspark.sql.functions import arrow_udf

from tidemark.operators import mojibake as mo
from tidemark.plans.registry import query, table

CHAINS = ["", "latin-1", "cp1252+cp1252", "cp437", "mac-roman", "cp1252+cp437", "cp850", "latin-1+cp1252+cp1252"]


@arrow_udf(T.StringType())
def garbled(texts: pa.Array, chains: pa.Array) -> pa.Array:
    """UTF-8 read as each encoding of the chain in turn, the last one first, as undoing begins with the first."""
    readers = {e: {ord(b): c for c, b in mo.byte_of(e).items()} for e in mo.WRONG}

    def one(text: str, chain: str) -> str:
        for encoding in reversed(chain.split("+") if chain else []):
            text = text.encode().decode("latin-1").translate(readers[encoding])
        return text

    return pa.array((one(t.as_py(), c.as_py()) for t, c in zip(texts, chains)), pa.string(), size=len(texts))


def planted(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where(F.col("text").isNotNull()).select("doc_id", "text")
    chain = F.element_at(F.array(*[F.lit(c) for c in CHAINS]), (F.col("doc_id") % len(CHAINS) + 1).cast("int"))
    return docs.select("doc_id", garbled(F.col("text"), chain).alias("text"))


@query("undo_mojibake", "select doc_id, text from documents where text is not null")
def undo_mojibake(spark, sf_dir):
    """Texts read wrongly up to three times come back; texts that were read right stay."""
    return mo.undo_mojibake(planted(spark, sf_dir), "text").select("doc_id", "text")


@query(
    "mojibake_report",
    "with t as (select doc_id % 8 as c, regexp_matches(text, '[^\\x00-\\x7F]') as odd from documents where text is not null) "
    "select not (odd and c <> 0) as left_alone, count(*) as texts from t group by all",
)
def mojibake_report(spark, sf_dir):
    """How many texts were changed and how many left alone."""
    found = mo.mojibake_report(planted(spark, sf_dir), "text")
    return found.groupBy(F.col("chain").isNull().alias("left_alone")).agg(F.sum("texts").alias("texts"))
