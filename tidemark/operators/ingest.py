"""Folder conversion: list, group, read, stack, de-duplicate, write, record."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor, as_completed

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators import manifest as mf
from tidemark.operators.grouping import GroupConfig, common_sheets, group_by_config
from tidemark.operators.unions import column_types, relaxed_union
from tidemark.sinks.writers import SUFFIX, OutputFacts, WriteOptions, safe_name, write
from tidemark.sources import excel, readers
from tidemark.sources.listing import list_files


def read_files(spark: SparkSession, paths: Sequence[str], kind: str) -> DataFrame:
    if kind == "csv":
        return readers.read_csv_text(spark, paths)
    if kind == "json":
        return readers.read_json(spark, paths)
    if kind == "parquet":
        return readers.read_parquet(spark, paths, merge=True)
    raise ValueError(f"no reader for {kind}")


def mergeable(frames: Sequence[DataFrame]) -> bool:
    """False when a column is nested in one input and plain, or differently nested, in another."""
    nested = ("array", "struct", "map")
    return all(len(k) == 1 or not any(t.startswith(nested) for t in k) for k in column_types(frames).values())


def merge_or_split(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All inputs as one widened table, or each on its own when their columns cannot be reconciled."""
    parts = list(frames.values())
    if len(parts) > 1 and mergeable(parts):
        return {"merged": relaxed_union(parts)}
    return dict(frames)


def convert_group(
    spark: SparkSession, group: str, files: Sequence[tuple[str, str]], sheets: Sequence[str], output: str, fmt: str,
    options: WriteOptions,
) -> list[tuple[str, str | None, OutputFacts]]:
    """Write one group: one table, or one per common sheet. Returns (inputs, sheet, facts)."""
    inputs = ", ".join(path for path, _ in files)
    done = []
    workbooks = [p for p, kind in files if kind == "excel" and p.lower().endswith(".xlsx")]
    for sheet in sheets:
        frame = excel.sheet_table(excel.workbooks(spark, workbooks), sheet)
        path = f"{output}/{safe_name(f'{group}.{sheet}.{SUFFIX[fmt]}')}"
        done.append((inputs, sheet, write(frame, path, fmt, options)))
    kinds = sorted({kind for _, kind in files if kind != "excel"})
    frames = {kind: read_files(spark, [p for p, k in files if k == kind], kind) for kind in kinds}
    tables = merge_or_split(frames)
    for kind, frame in tables.items():
        name = group if len(tables) == 1 else f"{group}.{kind}"
        path = f"{output}/{safe_name(f'{name}.{SUFFIX[fmt]}')}"
        own = inputs if len(tables) == 1 else ", ".join(p for p, k in files if k == kind)
        done.append((own, None, write(frame, path, fmt, options)))
    return done


def not_read(spark: SparkSession, files: Sequence[tuple[str, str]]) -> list[str]:
    """Workbooks without a reader (the old binary format) and those that cannot be opened."""
    books = [p for p, kind in files if kind == "excel"]
    old = [p for p in books if not p.lower().endswith(".xlsx")]
    new = [p for p in books if p not in old]
    broken = [r["path"] for r in excel.unreadable(excel.workbooks(spark, new)).collect()] if new else []
    return sorted([f"{p} (no reader)" for p in old] + [f"{p} (cannot be opened)" for p in broken])


def _convert_task(
    spark: SparkSession, config: GroupConfig, group: list[tuple[str, str]], output: str, run_id: str, fmt: str, options: WriteOptions
) -> tuple:
    """Convert one group and describe the attempt as a manifest row; a failure is recorded, not raised."""
    started, clock = dt.datetime.now(dt.timezone.utc), time.perf_counter()
    status, error, done = mf.SUCCESS, None, []
    try:
        unread = not_read(spark, group)
        books = [p for p, kind in group if kind == "excel" and p.lower().endswith(".xlsx")]
        sheets = []
        if books:
            named = excel.sheet_names(excel.workbooks(spark, books), config.ignore_sheets)
            shared = common_sheets(named.select(F.lit(config.name).alias("group"), "path", "sheet"))
            sheets = [r["sheet"] for r in shared.orderBy("ord").collect()]
        done = convert_group(spark, config.name, group, sheets, output, fmt, options)
        if unread:  # what could be read is written, but the group is not finished
            status, error = mf.FAILED, f"not read: {', '.join(unread)}"
    except Exception as failure:  # the other groups go on
        status, error = mf.FAILED, str(failure)
    results = [
        (inputs, facts.output, sheet, facts.schema, facts.rows, facts.columns, facts.size_mb) for inputs, sheet, facts in done
    ]
    return (
        run_id, config.name, status, started, dt.datetime.now(dt.timezone.utc), round(time.perf_counter() - clock, 4),
        error, len(group), sum(f.written for _, _, f in done), 0, results,
    )


def convert_folder(
    spark: SparkSession, folder: str, configs: Sequence[GroupConfig], output: str, manifest: str, run_id: str,
    fmt: str = "parquet", options: WriteOptions = WriteOptions(deduplicate=True), at_once: int = 4,
) -> DataFrame:
    """Convert every configured group that has not succeeded before; returns the manifest.

    Groups are independent Spark jobs, ``at_once`` of them submitted together so that small ones do not
    leave the cluster idle. The manifest grows as each one ends, so an interrupted run keeps what it finished.
    """
    files = group_by_config(list_files(spark, folder), configs)
    tasks = files.select(F.col("group").alias("task_id")).distinct()
    todo = [r["task_id"] for r in mf.unfinished(tasks, mf.load_manifest(spark, manifest)).collect()]
    members: dict[str, list[tuple[str, str]]] = {}
    if todo:
        for r in files.where(F.col("group").isin(*todo)).select("group", "path", "file_type").collect():
            members.setdefault(r["group"], []).append((r["path"], r["file_type"]))
    with ThreadPoolExecutor(at_once) as pool:
        running = [
            pool.submit(_convert_task, spark, config, sorted(members[config.name]), output, run_id, fmt, options)
            for config in configs
            if config.name in members
        ]
        for finished in as_completed(running):
            mf.append_manifest(spark, manifest, [finished.result()])
    return mf.load_manifest(spark, manifest)
