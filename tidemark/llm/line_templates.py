"""Line dedup with a log-template tree of fixed depth.

Tokens with digits are variable fields (``<*>``). A line goes down the tree by its number of tokens and its first
``LEADING`` tokens; in the leaf it joins the most similar template, at least ``similarity`` of whose tokens it shares in
place, and the tokens that differ become ``<*>``; otherwise it starts a template. A template that occurs in two or
more documents recurs: its lines are dropped from every document but the first (smallest id).

Scale: leaves are counted as (leaf, smallest and largest document) with a map-side combine, so a line that a third of all
documents share is one row. Leaves that only one document reaches go no further. In the others equal lines are combined
before the leaf is built, and the leaf is read in sorted order, template by template, never as a list of documents.

Defined results: null and empty texts have no lines and stay as they are; lines shorter than ``min_tokens`` tokens (and
blank ones) are neither counted nor dropped; rows without an id count as one document and come last; rows with the
same id are the same document. Documents are kept even when all their lines go; their text is then empty. All
columns are kept. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import fresh, key_runs, quoted, row_key, run_starts, text_of
from tidemark.session import pin

LEADING = 3
FIELD = "<*>"


def exploded(docs: DataFrame, id_col: str, text_col: str, min_tokens: int) -> DataFrame:
    """(doc, row, pos, masked, leaf, line): lines of all documents with their path in the tree."""
    lines = docs.select(
        quoted(id_col).alias("doc"), row_key(id_col, text_col).alias("row"),
        F.posexplode(F.transform(F.split(text_of(text_col), "\n"), masked_line)).alias("pos", "masked"),
    )
    spaces = F.length("masked") - F.length(F.replace("masked", F.lit(" "), F.lit("")))
    return lines.where(spaces + 1 >= min_tokens).select(
        "doc", "row", "pos", "masked",
        F.xxhash64(spaces, F.substring_index("masked", " ", LEADING)).alias("leaf"), F.xxhash64("masked").alias("line"),
    )


def masked_line(raw: Column) -> Column:
    """Tokens with single spaces between, those with digits as ``<*>``; the replacements are costly and rarely needed."""
    odd = F.contains(raw, F.lit("  ")) | F.contains(raw, F.lit("\t")) | F.contains(raw, F.lit("\r")) | F.contains(raw, F.lit("\f"))
    digit = raw.rlike("[0-9]")
    plain = F.trim(F.when(odd, F.regexp_replace(raw, "[\\t\\r\\f ]+", " ")).otherwise(raw))
    return F.when(digit, F.regexp_replace(plain, "[^ 0-9]*[0-9][^ ]*", FIELD)).otherwise(plain)


def spread(doc: Column) -> list[Column]:
    """First document, and whether there is more than one; a missing id counts as the last document."""
    return [
        F.min("doc").alias("first_doc"),
        ((F.min("doc") < F.max("doc")) | ((F.count("doc") > 0) & (F.count("doc") < F.count(F.lit(1))))).alias("recurs"),
    ]


def templates_of(tokens: list[list[str]], similarity: float) -> tuple[list[int], list[list[str]]]:
    """Template number of each line of a leaf, taken in order, and the templates."""
    width = len(tokens[0])
    codes: dict[str, int] = {FIELD: 0}
    own = np.array([[codes.setdefault(t, len(codes)) for t in line] for line in tokens], dtype=np.int32)
    known = np.empty((16, width), dtype=np.int32)
    count, member = 0, []
    for line in own:
        if count:
            same = (known[:count] == line).sum(axis=1)
            best = int(same.argmax())
            if same[best] >= similarity * width:
                known[best][known[best] != line] = 0
                member.append(best)
                continue
        if count == len(known):
            known = np.concatenate([known, np.empty_like(known)])
        known[count] = line
        member.append(count)
        count += 1
    names = list(codes)
    return member, [[names[c] for c in row] for row in known[:count]]


def grown(similarity: float):
    """``mapInArrow`` function over (leaf, line, masked) sorted by leaf and text: adds the template's text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in key_runs(batches, 1):
            starts = run_starts(batch, 1)
            masked, names = batch.column("masked").to_pylist(), []
            for a, b in zip(starts, np.append(starts[1:], batch.num_rows)):
                if b - a == 1:
                    names.append(masked[a])
                    continue
                member, templates = templates_of([m.split(" ") for m in masked[a:b]], similarity)
                names += [" ".join(templates[m]) for m in member]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.string())], names=["leaf", "line", "template"]
            )

    return run


def recurring_lines(docs: DataFrame, id_col: str, text_col: str, similarity: float, min_tokens: int) -> DataFrame:
    """(row, drop: positions of the lines to drop) of every row that loses lines."""
    spark = docs.sparkSession
    lines = exploded(docs, id_col, text_col, min_tokens)
    leaves = pin(
        lines.groupBy("leaf").agg(*spread(F.col("doc")), (F.min("line") != F.max("line")).alias("mixed"))
        .where("recurs").select(F.col("leaf").alias("own_leaf"), "first_doc", "mixed")
    )
    shared = pin(
        lines.join(leaves, F.col("leaf") == F.col("own_leaf"))
        .select("leaf", "line", "doc", "row", "pos", "first_doc", "mixed", F.when(F.col("mixed"), F.col("masked")).alias("masked"))
    )
    repeats = shared.where("not mixed").select("row", "pos", "doc", "first_doc")
    distinct = shared.where("mixed").groupBy("leaf", "line").agg(
        F.min("doc").alias("low"), F.max("doc").alias("high"), F.count("doc").alias("ids"), F.count(F.lit(1)).alias("n"),
        F.first("masked").alias("masked"),
    )
    distinct = pin(distinct)
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    named = (
        distinct.select("leaf", "line", "masked").repartition(width, "leaf").sortWithinPartitions("leaf", "masked")
        .mapInArrow(grown(similarity), "leaf bigint, line bigint, template string")
    )
    named = pin(named.select("leaf", "line", F.xxhash64("template").alias("template")))
    placed = distinct.drop("masked").join(
        named.select(F.col("leaf").alias("of_leaf"), F.col("line").alias("of_line"), "template"),
        (F.col("leaf") == F.col("of_leaf")) & (F.col("line") == F.col("of_line")),
    )
    several = (F.min("low") < F.max("high")) | ((F.sum("ids") > 0) & (F.sum("ids") < F.sum("n")))
    groups = pin(
        placed.groupBy(F.col("leaf").alias("g_leaf"), F.col("template").alias("g_template"))
        .agg(F.min("low").alias("first_doc"), several.alias("recurs")).where("recurs").drop("recurs")
    )
    dropped = pin(
        placed.join(groups, (F.col("leaf") == F.col("g_leaf")) & (F.col("template") == F.col("g_template")))
        .select(F.col("leaf").alias("d_leaf"), F.col("line").alias("d_line"), F.col("first_doc").alias("kept_in"))
    )
    varied = shared.where("mixed").drop("first_doc").join(
        dropped, (F.col("leaf") == F.col("d_leaf")) & (F.col("line") == F.col("d_line"))
    ).select("row", "pos", "doc", F.col("kept_in").alias("first_doc"))
    return (
        repeats.unionByName(varied).where(~F.col("doc").eqNullSafe(F.col("first_doc")))
        .groupBy("row").agg(F.collect_set("pos").alias("drop"))
    )


def drop_recurring_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8, min_tokens: int = 4,
    dropped_col: str | None = None,
) -> DataFrame:
    """``docs`` without the lines of recurring templates; ``dropped_col`` names a column for the number of lines dropped."""
    lost = recurring_lines(docs, id_col, text_col, similarity, min_tokens)
    row, drop = fresh(docs.columns, "line_row"), fresh(docs.columns, "line_drop")
    joined = docs.withColumn(row, row_key(id_col, text_col)).join(
        lost.select(F.col("row").alias(row), F.col("drop").alias(drop)), row, "left"
    )
    kept = F.array_join(
        F.filter(F.split(quoted(text_col), "\n"), lambda line, at: ~F.array_contains(quoted(drop), at)), "\n"
    )
    text = F.when(quoted(drop).isNull(), quoted(text_col)).otherwise(kept)
    columns = [text.alias(c) if c == text_col else quoted(c) for c in docs.columns]
    if dropped_col:
        columns.append(F.when(quoted(drop).isNull(), F.lit(0)).otherwise(F.size(quoted(drop))).cast("bigint").alias(dropped_col))
    return joined.select(*columns)
