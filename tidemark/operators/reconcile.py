"""Comparing a source table with its loaded copy, cell by cell."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.joins import null_safe_join
from tidemark.functions.ordering import expand_counts, running_total, spread_running_total, spread_sort

SECTION_SEPARATOR = "__"


# -- two-row headers ---------------------------------------------------------------------------------


def header_labels(top: Sequence[str | None], fields: Sequence[str | None], separator: str = SECTION_SEPARATOR) -> list[str]:
    """Section names carried over the blank cells to their right, joined to the field names below them."""
    labels, section = [], ""
    for name, field in zip(top, fields):
        if name and "UNNAMED" not in name.upper():
            section = name
        labels.append(f"{section}{separator}{field}")
    return labels


def promote_headers(rows: DataFrame, row_idx: str = "row_idx", cells: str = "cells") -> DataFrame:
    """Sheet rows ``(row_idx, cells array)`` whose first two rows are headers, as named columns.

    Only the two header rows visit the driver.
    """
    head = {r[row_idx]: r[cells] for r in rows.where(F.col(row_idx) < 2).select(row_idx, cells).collect()}
    labels = header_labels(head[0], head[1])
    return rows.where(F.col(row_idx) >= 2).select(
        row_idx, *[F.get(F.col(cells), F.lit(i)).alias(label) for i, label in enumerate(labels)]
    )


def split_sections(wide: DataFrame, sections: Sequence[str], row_idx: str = "row_idx") -> DataFrame:
    """One struct column per section, fields named without the section prefix."""
    parts = []
    for section in sections:
        prefix = section + SECTION_SEPARATOR
        fields = [c for c in wide.columns if c.startswith(prefix)]
        parts.append(F.struct(*[F.col(f"`{c}`").alias(c[len(prefix):]) for c in fields]).alias(section))
    return wide.select(row_idx, *parts)


# -- cell differences --------------------------------------------------------------------------------


def paired(source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Full outer join on the keys with both rows as structs ``s`` and ``t`` (null on a missing side).

    Null keys match each other. Rows that repeat a key pair up one to one, in the order of their columns; only these are
    ranked, spread over range partitions, so a key that fills much of a table does not end in one task.
    """

    def numbered(df: DataFrame, side: str) -> DataFrame:
        rows = df.select(*keys, *[c for c in columns if c not in keys])
        first = F.lit(1).cast("bigint").alias("__place")
        repeated = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows")).where("__rows > 1").select(*keys)
        if repeated.isEmpty():
            placed = rows.select("*", first)
        else:
            tagged = null_safe_join(rows, repeated.withColumn("__again", F.lit(True)), keys)
            counted = tagged.where("__again").groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("__n"))
            order = rows.columns[len(keys):] or list(keys)
            ranked = running_total(counted, order, F.col("__n"), "__hi", keys, plain_limit=0)
            placed = tagged.where("__again is null").select(*rows.columns, first).unionByName(
                expand_counts(ranked, F.col("__hi") - F.col("__n") + 1, F.col("__n"), "__place").drop("__n", "__hi")
            )
        return placed.select(*[F.col(k).alias(f"__{side}_{k}") for k in keys], F.col("__place").alias(f"__{side}"), F.struct(*columns).alias(side))

    same = reduce(and_, [F.col(f"__s_{k}").eqNullSafe(F.col(f"__t_{k}")) for k in keys], F.col("__s") == F.col("__t"))
    pairs = numbered(source, "s").join(numbered(target, "t"), same, "full_outer")
    own = [F.when(F.col("s").isNotNull(), F.col(f"__s_{k}")).otherwise(F.col(f"__t_{k}")).alias(k) for k in keys]
    return pairs.select(*own, "s", "t")


def changed(column: str) -> Column:
    return ~F.col(f"s.{column}").eqNullSafe(F.col(f"t.{column}"))


def both_sides() -> Column:
    return F.col("s").isNotNull() & F.col("t").isNotNull()


def cell_diff(source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Long form: one row per differing cell, plus one row per record found on one side only.

    Two nulls are equal. ``change`` is ``value``, ``source_only`` or ``target_only``.
    """
    pairs = paired(source, target, keys, columns)
    cells = [
        F.when(
            both_sides() & changed(c),
            F.struct(
                F.lit("value").alias("change"), F.lit(c).alias("column"),
                F.col(f"s.{c}").cast("string").alias("source"), F.col(f"t.{c}").cast("string").alias("target"),
            ),
        )
        for c in columns
    ]
    none = F.lit(None).cast("string")
    missing = F.when(
        ~both_sides(),
        F.struct(
            F.when(F.col("t").isNull(), "source_only").otherwise("target_only").alias("change"),
            none.alias("column"), none.alias("source"), none.alias("target"),
        ),
    )
    hits = F.array_compact(F.array(missing, *cells))
    return pairs.select(*keys, F.explode(hits).alias("d")).select(*keys, "d.*")


def compare_wide(source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str],
                 names: tuple[str, str] = ("source", "destination")) -> DataFrame:
    """Differing rows only; per column a pair of values that is null where the two sides agree."""
    pairs = paired(source, target, keys, columns)
    differs = reduce(or_, [changed(c) for c in columns])
    cells = []
    for c in columns:
        for side, name in zip("st", names):
            cells.append(F.when(changed(c), F.col(f"{side}.{c}")).alias(f"{c}{SECTION_SEPARATOR}{name}"))
    return pairs.where(differs | ~both_sides()).select(*keys, *cells)


def with_status(diffs: DataFrame, status: DataFrame, keys: Sequence[str], status_column: str,
                kept: Sequence[str] = ("Object Mismatch", "Field Mismatch")) -> DataFrame:
    """Attach comparison status and transformation details to the diffs and keep the given statuses."""
    return diffs.join(status, on=list(keys), how="left").where(F.col(status_column).isin(*kept))


def prune_empty_pairs(wide: DataFrame, columns: Sequence[str], names: tuple[str, str] = ("source", "destination")) -> DataFrame:
    """Drop the column pairs that hold no value on either side; one pass decides for all pairs."""
    pair = {c: [f"{c}{SECTION_SEPARATOR}{n}" for n in names] for c in columns}
    filled = wide.agg(*[(F.count(F.col(f"`{a}`")) + F.count(F.col(f"`{b}`"))).alias(c) for c, (a, b) in pair.items()]).first()
    return wide.drop(*[name for c in columns if not filled[c] for name in pair[c]])


def report_rows(wide: DataFrame, row_idx: str, shift: int = 1) -> DataFrame:
    """Report layout: two header rows and the body, all text, nulls as ''. ``(section, ord, cells)``.

    The body keeps its row number plus ``shift`` in the first cell and as ``ord``.
    """
    body = [c for c in wide.columns if c != row_idx]
    split = [c.split(SECTION_SEPARATOR, 1) for c in body]
    heads = [["index"] + [s[0] for s in split], [""] + [s[1] if len(s) > 1 else "" for s in split]]
    header = wide.sparkSession.createDataFrame(
        [(0, i, cells) for i, cells in enumerate(heads)], "section int, ord long, cells array<string>"
    )
    number = F.col(row_idx) + F.lit(shift)
    texts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in body]
    rows = wide.select(
        F.lit(1).alias("section"), number.cast("long").alias("ord"), F.array(number.cast("string"), *texts).alias("cells")
    )
    return header.unionByName(rows)


def as_text(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """All columns as text, nulls as ``nan``, optionally renamed by position."""
    names = names or df.columns
    return df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("nan")).alias(n) for c, n in zip(df.columns, names)])


def keyed_positional_diff(original: DataFrame, loaded: DataFrame, key_count: int = 2,
                          drop: Sequence[str] = ()) -> DataFrame:
    """Compare two tables as text after sorting: rows pair up by position within their first columns.

    ``loaded`` loses the ``drop`` columns and takes the names of ``original`` by position. Equal rows are
    counted first and positions come from running totals, so a key (or one repeated row) that fills much
    of the table does not end in one task. Result: keys, position and per column the two differing texts.
    """
    left = as_text(original)
    right = as_text(loaded.drop(*drop), left.columns)
    keys, rest = left.columns[:key_count], left.columns[key_count:]

    def placed(df: DataFrame, side: str) -> DataFrame:
        counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
        ranked = spread_running_total(spread_sort(counted, keys, rest), rest, F.col("__n"), "__hi", keys)
        rows = expand_counts(ranked, F.col("__hi") - F.col("__n") + 1, F.col("__n"), "position")
        return rows.select(*keys, "position", F.struct(*rest).alias(side))

    pairs = placed(left, "s").join(placed(right, "t"), on=[*keys, "position"], how="full_outer")
    differs = reduce(or_, [changed(c) for c in rest])
    cells = [F.when(changed(c), F.col(f"{side}.{c}")).alias(f"{c}{SECTION_SEPARATOR}{name}")
             for c in rest for side, name in (("s", "origin"), ("t", "source"))]
    return pairs.where(differs).select(*keys, "position", *cells)


