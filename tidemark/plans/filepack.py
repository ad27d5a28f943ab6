"""File sources, sinks, grouping and manifests over files that Spark writes from the business tables."""

from __future__ import annotations

import io
import zipfile
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import functions as F

from tidemark.operators import grouping as gr
from tidemark.operators import manifest as mf
from tidemark.operators.ingest import convert_folder, merge_or_split
from tidemark.operators.unions import diagonal_union, relaxed_union
from tidemark.plans.registry import query, table
from tidemark.session import scratch_path
from tidemark.sinks import writers as wr
from tidemark.sources import excel, listing, readers
from tidemark.streaming.new_files import ingest_new_files

PART = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
PART_TYPES = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
TEXT_PART = "select " + ", ".join(f"cast({c} as varchar) as {c}" for c in PART) + " from part"
LATIN = r"^[\x00-\xFF]*$"
TYPED_PART = "select " + ", ".join(PART) + " from part"


def part(spark, sf_dir):
    return table(spark, sf_dir, "part")


def files_in(spark, folder, *types):
    return listing.paths_of(listing.list_files(spark, folder, recursive=True), *types)


def csv_in_two_orders(spark, sf_dir):
    """The part table as CSV files, half of them with the columns in reverse order."""
    folder = scratch_path(spark, "csv")
    part(spark, sf_dir).where("p_partkey % 2 = 0").write.option("header", "true").csv(f"{folder}/a")
    part(spark, sf_dir).where("p_partkey % 2 = 1").select(*PART[::-1]).write.option("header", "true").csv(f"{folder}/b")
    return folder


# -- scans -------------------------------------------------------------------------------------------


@query("csv_typed", TYPED_PART)
def csv_typed(spark, sf_dir):
    path = scratch_path(spark, "csv")
    part(spark, sf_dir).write.option("header", "true").csv(path)
    return readers.read_csv(spark, path, schema=PART_TYPES)


@query("csv_text", TEXT_PART)
def csv_text(spark, sf_dir):
    return readers.read_csv_text(spark, files_in(spark, csv_in_two_orders(spark, sf_dir), "csv"))


@query(
    "csv_lossy",
    "select cast(doc_id as varchar) as doc_id, case when regexp_matches(text, '^[\\x00-\\x{FF}]*$') and doc_id % 10 = 0 then null "
    "else regexp_replace(text, '\\r\\n?', chr(10), 'g') end as text from documents",
)
def csv_lossy(spark, sf_dir):
    """Texts with quoted newlines, a tenth of them badly encoded; the damaged cells are blanked for comparison."""
    path = scratch_path(spark, "lossy")
    text = F.regexp_replace("text", "\r\n?", "\n")
    docs = table(spark, sf_dir, "documents").select("doc_id", text.alias("text"))
    damaged = (F.col("doc_id") % 10 == 0) & F.col("text").rlike(LATIN)
    quoted = F.concat(F.col("doc_id").cast("string"), F.lit(',"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('",surplus'))
    raw = F.when(damaged, F.encode(quoted, "ISO-8859-1")).otherwise(F.encode(quoted, "UTF-8"))
    # raw bytes pass through a text column unchanged, so the files keep their damage
    docs.select(raw.cast("string").alias("value")).write.text(path)
    back = readers.read_csv_lossy(spark, path, "doc_id string, text string")
    blank = (F.col("doc_id").cast("bigint") % 10 == 0) & (F.col("text").contains("\ufffd") | F.col("text").rlike(LATIN))
    return back.withColumn("text", F.when(~blank, F.col("text")))


@query("ndjson", TYPED_PART)
def ndjson(spark, sf_dir):
    path = scratch_path(spark, "ndjson")
    part(spark, sf_dir).write.json(path)
    return readers.read_ndjson(spark, path, PART_TYPES)


@query("json_layouts", TYPED_PART)
def json_layouts(spark, sf_dir):
    """Objects per line, arrays of up to 1,000 keys and spread-out objects in one folder, told apart by their first line."""
    folder, key = scratch_path(spark, "json"), F.col("p_partkey")
    rows = part(spark, sf_dir).select(key, F.struct(*PART).alias("r"))
    rows.where(key % 2 == 1).select(F.to_json("r").alias("value")).write.text(f"{folder}/lines")
    even = rows.where(key % 2 == 0)
    arrays = even.where(key % 500 != 0).groupBy(F.floor(key / 1000)).agg(F.to_json(F.collect_list("r")).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(f"{folder}/arrays")
    spread = even.where(key % 500 == 0).select(F.regexp_replace(F.to_json("r"), r"^\{", "{\n").alias("value"))
    spread.write.option("maxRecordsPerFile", 1).text(f"{folder}/spread")
    files = listing.list_files(spark, folder, recursive=True, supported_only=False)
    texts = files.where(F.col("path").endswith(".txt") & (F.col("length") > 0))
    return readers.read_json(spark, listing.paths_of(texts), PART_TYPES)


@query(
    "parquet_dir",
    "select p_partkey, p_name, p_brand, p_type, p_size, case when p_size > 25 then p_retailprice end as p_retailprice from part",
)
def parquet_dir(spark, sf_dir):
    """Two folders with different columns; the missing one comes back as null."""
    folder = scratch_path(spark, "parquet")
    part(spark, sf_dir).where("p_size <= 25").drop("p_retailprice").write.parquet(f"{folder}/half=1")
    part(spark, sf_dir).where("p_size > 25").write.parquet(f"{folder}/half=2")
    return readers.read_parquet(spark, folder, merge=True).select(*PART)


def sheet_xml(rows) -> str:
    """A worksheet part: text as inline strings, numbers plain, nulls left out."""
    out = ['<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>']
    for r, row in enumerate(rows, 1):
        out.append(f'<row r="{r}">')
        for c, value in enumerate(row):
            ref = f"{chr(65 + c)}{r}"
            if isinstance(value, str):
                out.append(f'<c r="{ref}" t="inlineStr"><is><t>{escape(value)}</t></is></c>')
            elif value is not None:
                out.append(f'<c r="{ref}"><v>{value}</v></c>')
        out.append("</row>")
    return "".join([*out, "</sheetData></worksheet>"])


def workbook_bytes(sheets: dict[str, list]) -> bytes:
    buffer = io.BytesIO()
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        names = "".join(f'<sheet name="{escape(n)}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(sheets, 1))
        z.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="{rel}"><sheets>{names}</sheets></workbook>',
        )
        links = "".join(f'<Relationship Id="rId{i}" Type="{rel}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1))
        z.writestr(
            "xl/_rels/workbook.xml.rels",
            f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{links}</Relationships>',
        )
        for i, rows in enumerate(sheets.values(), 1):
            z.writestr(f"xl/worksheets/sheet{i}.xml", sheet_xml(rows))
    return buffer.getvalue()


def part_workbooks(spark, sf_dir):
    """The part table as workbooks of at most 500 keys each, made inside the tasks; the column order varies."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        block = int(pdf["block"].iloc[0])
        order = PART if block % 2 == 0 else PART[::-1]
        rows = [order] + [[v.item() if hasattr(v, "item") else v for v in r] for r in pdf[order].itertuples(index=False)]
        book = workbook_bytes({"Part": rows, "Config Data": [["key"], ["value"]], "Notes": [["block"], [block]]})
        return pd.DataFrame({"path": [f"mem/part_{block}.xlsx"], "content": [book]})

    blocks = part(spark, sf_dir).withColumn("block", F.floor(F.col("p_partkey") / 500))
    return blocks.groupBy("block").applyInPandas(build, "path string, content binary")


@query("excel_sheets", TEXT_PART)
def excel_sheets(spark, sf_dir):
    return excel.sheet_table(part_workbooks(spark, sf_dir), "Part")


@query("excel_typed", "select p_partkey, p_name, p_brand, p_type, p_size::bigint as p_size, p_retailprice from part")
def excel_typed(spark, sf_dir):
    return readers.infer_types(excel.sheet_table(part_workbooks(spark, sf_dir), "Part"))


@query(
    "excel_sheet_names",
    "select 'mem/part_' || cast(floor(p_partkey / 500) as bigint) || '.xlsx' as path, unnest([0, 2]) as sheet_no, "
    "unnest(['Part', 'Notes']) as sheet from part group by floor(p_partkey / 500)",
)
def excel_sheet_names(spark, sf_dir):
    return excel.sheet_names(part_workbooks(spark, sf_dir), skip=["Config Data"])


@query(
    "list_files",
    "select p_type as folder, 1 as has_files, true as all_csv from part group by p_type",
)
def list_files(spark, sf_dir):
    folder = scratch_path(spark, "listed")
    part(spark, sf_dir).repartition("p_type").write.partitionBy("p_type").option("header", "true").csv(folder)
    files = listing.list_files(spark, folder, recursive=True)
    return (
        files.where("length > 0")
        .groupBy(F.regexp_extract("path", r"/p_type=([^/]+)/", 1).alias("folder"))
        .agg(F.count(F.lit(1)).alias("n"), F.every(F.col("file_type") == "csv").alias("all_csv"))
        .select("folder", F.when(F.col("n") > 0, 1).otherwise(0).alias("has_files"), "all_csv")
    )


@query("view_over_parquet", "select p_type, count(*) as parts, round(avg(p_retailprice), 4) as price from part group by p_type")
def view_over_parquet(spark, sf_dir):
    path = scratch_path(spark, "view")
    part(spark, sf_dir).write.parquet(path)
    (view,) = readers.register_views(spark, {"Parts_Sheet 1": path})
    return spark.sql(f"select p_type, count(*) as parts, round(avg(p_retailprice), 4) as price from {view} group by p_type")


@query("count_rows", "select count(*) as rows from documents")
def count_rows(spark, sf_dir):
    return readers.count_rows(table(spark, sf_dir, "documents"))


@query("reencode_copy", TYPED_PART)
def reencode_copy(spark, sf_dir):
    return readers.reencode(spark, f"{sf_dir}/part.parquet", scratch_path(spark, "copy"))


# -- sinks -------------------------------------------------------------------------------------------


@query("write_parquet_options", TYPED_PART)
def write_parquet_options(spark, sf_dir):
    path = scratch_path(spark, "parquet")
    wr.write(part(spark, sf_dir), path, "parquet", wr.WriteOptions("zstd", rows_per_file=500))
    return spark.read.parquet(path)


@query("write_csv", TYPED_PART)
def write_csv(spark, sf_dir):
    path = scratch_path(spark, "csv")
    wr.write(part(spark, sf_dir), path, "csv", wr.WriteOptions(rows_per_file=700))
    return spark.read.schema(PART_TYPES).option("header", "true").csv(path)


@query(
    "write_csv_no_header",
    "select 'p_partkey' as c0, 'p_name' as c1 union all select 'key', 'text' union all "
    "select cast(p_partkey as varchar), p_name from part",
)
def write_csv_no_header(spark, sf_dir):
    path = scratch_path(spark, "plain")
    heads = spark.createDataFrame([("p_partkey", "p_name"), ("key", "text")], "c0 string, c1 string")
    body = part(spark, sf_dir).select(F.col("p_partkey").cast("string").alias("c0"), F.col("p_name").alias("c1"))
    wr.write(heads.unionByName(body), path, "csv", wr.WriteOptions(header=False))
    return spark.read.schema("c0 string, c1 string").csv(path)


@query("write_json", TYPED_PART)
def write_json(spark, sf_dir):
    path = scratch_path(spark, "json")
    wr.write(part(spark, sf_dir), path, "json")
    return spark.read.schema(PART_TYPES).json(path)


@query("save_table", TYPED_PART)
def save_table(spark, sf_dir):
    path = scratch_path(spark, "table")
    name = wr.save_table(part(spark, sf_dir), "Part list " + path.split("scratch-")[1][:8], path)
    return spark.table(name).select(*PART)


@query("skip_existing", "select p_brand, count(*) as rows from part group by p_brand")
def skip_existing(spark, sf_dir):
    path = scratch_path(spark, "kept")
    wr.write(part(spark, sf_dir), path, skip_existing=True)
    second = wr.write(part(spark, sf_dir).limit(1), path, skip_existing=True)
    assert not second.written
    return spark.read.parquet(path).groupBy("p_brand").agg(F.count(F.lit(1)).alias("rows"))


@query("dedup_write", "select distinct p_name, p_brand, p_type from part")
def dedup_write(spark, sf_dir):
    path = scratch_path(spark, "distinct")
    wr.write(part(spark, sf_dir).select("p_name", "p_brand", "p_type"), path, options=wr.WriteOptions(deduplicate=True))
    return spark.read.parquet(path)


@query(
    "output_facts",
    "select count(*) as rows, 6 as columns, true as written, true as has_size, 'p_partkey:bigint' as first_column from part "
    "union all select 0, 0, false, false, null",
)
def output_facts(spark, sf_dir):
    full = wr.write(part(spark, sf_dir), scratch_path(spark, "facts"))
    empty = wr.write(part(spark, sf_dir).where("p_partkey < 0"), scratch_path(spark, "empty"))
    first = F.get("schema", F.lit(0))
    return wr.facts_table(spark, [full, empty]).select(
        "rows", "columns", "written", (F.col("size_mb") > 0).alias("has_size"),
        F.when(F.col("written"), F.concat(first["column"], F.lit(":"), first["dtype"])).alias("first_column"),
    )


@query(
    "output_names",
    "select distinct replace(p_brand || '.' || p_type || '/' || p_size || '.parquet', '/', '_') as name from part union "
    "select distinct p_brand || '.csv' from part",
)
def output_names(spark, sf_dir):
    sheet = F.concat("p_type", F.lit("/"), F.col("p_size").cast("string"))
    both = part(spark, sf_dir).select(
        F.explode(
            F.array(
                wr.output_name(F.col("p_brand"), sheet, "parquet"),
                wr.output_name(F.col("p_brand"), F.lit(None).cast("string"), "csv"),
            )
        ).alias("name")
    )
    return both.distinct()


# -- grouping ----------------------------------------------------------------------------------------

ENDINGS = ["_1", "_v2", " (3)", "_1of3", "_part7", " copy", "_backup", "", "_copy_2"]
NAME_SQL = (
    "(select p_partkey, '/in/' || replace(p_name, ' ', '-') || case p_partkey % 9 "
    + " ".join(f"when {i} then '{e}'" for i, e in enumerate(ENDINGS))
    + " end || case when p_partkey % 4 = 0 then '.XLSX' when p_partkey % 4 = 1 then '.txt' else '.csv' end as path from part)"
)
STEM_SQL = "regexp_replace(regexp_replace(path, '^.*/', ''), '[.][^.]*$', '')"


def named_files(spark, sf_dir):
    key = F.col("p_partkey")
    ending = F.get(F.array(*[F.lit(e) for e in ENDINGS]), (key % 9).cast("int"))
    suffix = F.when(key % 4 == 0, ".XLSX").when(key % 4 == 1, ".txt").otherwise(".csv")
    path = F.concat(F.lit("/in/"), F.replace("p_name", F.lit(" "), F.lit("-")), ending, suffix)
    files = part(spark, sf_dir).select("p_partkey", path.alias("path"))
    return files.withColumn("file_type", listing.file_type(F.col("path"))).where(F.col("file_type").isNotNull())


def stripped_sql(stem: str) -> str:
    for pattern in gr.COPY_ENDINGS:
        stem = f"regexp_replace({stem}, '{pattern}', '', 'i')"
    return f"trim(regexp_replace({stem}, '^_+|_+$', '', 'g'))"


@query(
    "strip_suffix_groups",
    f"select {stripped_sql(STEM_SQL)} as \"group\", count(*) as files, min(path) as first_path, "
    f"count(distinct lower(regexp_extract(path, '[.][^.]*$'))) as types from {NAME_SQL} where path not like '%.txt' group by 1",
)
def strip_suffix_groups(spark, sf_dir):
    return gr.group_sizes(gr.group_by_base_name(named_files(spark, sf_dir)))


TEMPLATE_SQL = (
    "(select p_brand, '/in/Data Template T0' || p_partkey % 7 || '_' || p_name || '_C' || p_partkey % 5 || 'R2_21_Apr_2026_TMS' || "
    "case p_partkey % 4 when 0 then ' (1)' when 1 then ' new' when 2 then '' else ' v2' end || '.xlsx' as path, p_name as name "
    "from part where p_partkey % 10 <> 0 union all "
    "select p_brand, '/in/Data Template ' || p_type || '_' || p_name || '.xlsx', p_name from part where p_partkey % 10 = 0)"
)


@query("template_groups", f"select name as \"group\", count(*) as files, min(path) as first_path from {TEMPLATE_SQL} group by 1")
def template_groups(spark, sf_dir):
    key = F.col("p_partkey")
    text = lambda c: c.cast("string")
    tail = F.get(F.array(F.lit(" (1)"), F.lit(" new"), F.lit(""), F.lit(" v2")), (key % 4).cast("int"))
    usual = F.concat(
        F.lit("/in/Data Template T0"), text(key % 7), F.lit("_"), F.col("p_name"), F.lit("_C"), text(key % 5),
        F.lit("R2_21_Apr_2026_TMS"), tail, F.lit(".xlsx"),
    )
    short = F.concat(F.lit("/in/Data Template "), F.col("p_type"), F.lit("_"), F.col("p_name"), F.lit(".xlsx"))
    files = part(spark, sf_dir).select(F.when(key % 10 != 0, usual).otherwise(short).alias("path"))
    grouped = gr.group_by_template(files.withColumn("file_type", listing.file_type(F.col("path"))))
    return gr.group_sizes(grouped).drop("types")


@query(
    "config_groups",
    f"select g as \"group\", count(*) as files, min(path) as first_path from (select path, unnest(list_filter(["
    f"case when regexp_matches({STEM_SQL}, '^(red|blue)-') then 'warm_and_cold' end, "
    f"case when contains({STEM_SQL}, 'ring') then 'ring' end, "
    f"case when contains({STEM_SQL}, 'nothing') then 'nothing' end], lambda x: x is not null)) as g from {NAME_SQL} "
    "where path not like '%.txt') group by g",
)
def config_groups(spark, sf_dir):
    configs = [gr.GroupConfig("warm_and_cold", "(red|blue)-"), gr.GroupConfig("ring"), gr.GroupConfig("nothing")]
    return gr.group_sizes(gr.group_by_config(named_files(spark, sf_dir), configs)).drop("types")


def sheet_rows(spark, sf_dir):
    """Each part is a workbook of its brand's group; its size decides how many numbered sheets it has."""
    numbers = F.sequence(F.lit(1), F.lit(10) + F.pmod("p_size", F.lit(3)))
    return part(spark, sf_dir).select(
        F.col("p_brand").alias("group"), F.concat(F.lit("/in/"), F.col("p_partkey").cast("string")).alias("path"),
        F.posexplode(numbers).alias("sheet_no", "n"),
    ).select("group", "path", "sheet_no", F.concat(F.lit("Sheet "), F.col("n").cast("string")).alias("sheet"))


SHEET_SQL = (
    "(select p_brand as \"group\", '/in/' || p_partkey as path, (n - 1)::int as sheet_no, n, 'Sheet ' || n as sheet "
    "from part, unnest(range(1, 11 + p_size % 3)) t(n))"
)


@query(
    "common_sheets",
    f"with w as (select \"group\", count(distinct path) as w from {SHEET_SQL} group by 1), "
    f"c as (select \"group\", n, sheet, count(distinct path) as f from {SHEET_SQL} group by all) "
    "select c.\"group\", row_number() over (partition by c.\"group\" order by n) as ord, sheet from c join w using (\"group\") "
    "where f = w and sheet <> 'Sheet 2'",
)
def common_sheets(spark, sf_dir):
    sheets = sheet_rows(spark, sf_dir)
    ignored = part(spark, sf_dir).select(F.col("p_brand").alias("group"), F.lit("Sheet 2").alias("sheet")).distinct()
    return gr.common_sheets(sheets, ignored)


@query(
    "first_file_sheets",
    f"select \"group\", sheet_no, sheet from {SHEET_SQL} s where path = (select min(path) from {SHEET_SQL} t where t.\"group\" = s.\"group\")",
)
def first_file_sheets(spark, sf_dir):
    return gr.first_file_sheets(sheet_rows(spark, sf_dir))


@query(
    "diagonal_union",
    "select p_partkey, p_name, p_size, null as p_brand from part where p_size <= 20 union all "
    "select p_partkey, null, p_size, p_brand from part where p_size > 20",
)
def diagonal(spark, sf_dir):
    low = part(spark, sf_dir).where("p_size <= 20").select("p_partkey", "p_name", "p_size")
    high = part(spark, sf_dir).where("p_size > 20").select("p_size", "p_brand", "p_partkey")
    return diagonal_union([low, high])


@query(
    "relaxed_union",
    "select p_partkey, cast(p_size as varchar) as size, p_size::double as amount from part where p_size <= 20 union all "
    "select p_partkey, 'large', p_retailprice from part where p_size > 20",
)
def relaxed(spark, sf_dir):
    low = part(spark, sf_dir).where("p_size <= 20").select(
        F.col("p_partkey").cast("int").alias("p_partkey"), F.col("p_size").alias("size"), F.col("p_size").alias("amount")
    )
    high = part(spark, sf_dir).where("p_size > 20").select(
        F.lit("large").alias("size"), F.col("p_retailprice").alias("amount"), "p_partkey"
    )
    return relaxed_union([low, high])


@query(
    "source_lineage",
    "select case p_partkey % 2 when 0 then 'a' else 'b' end as folder, count(*) as rows, true as named from part group by 1",
)
def source_lineage(spark, sf_dir):
    folder = csv_in_two_orders(spark, sf_dir)
    back = readers.read_csv_text(spark, files_in(spark, folder, "csv"), lineage=True)
    parity = F.when(F.col("p_partkey").cast("bigint") % 2 == 0, "a").otherwise("b")
    return back.groupBy(parity.alias("folder")).agg(
        F.count(F.lit(1)).alias("rows"), F.every(F.col("_source_file").endswith(".csv")).alias("named")
    )


@query(
    "merge_fallback",
    "select 'plain/merged' as output, count(*) as rows from part union all "
    "select 'nested/' || case when p_size <= 25 then 'low' else 'high' end, count(*) from part group by p_size <= 25",
)
def merge_fallback(spark, sf_dir):
    low, high = part(spark, sf_dir).where("p_size <= 25"), part(spark, sf_dir).where("p_size > 25")
    plain = {"low": low.select("p_partkey", "p_size"), "high": high.select("p_partkey", F.col("p_name").alias("p_size"))}
    nested = {"low": low.select("p_partkey", "p_size"), "high": high.select("p_partkey", F.split("p_name", " ").alias("p_size"))}
    counted = [
        frame.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(f"{kind}/{name}").alias("output"), "rows")
        for kind, group in (("plain", plain), ("nested", nested))
        for name, frame in merge_or_split(group).items()
    ]
    return diagonal_union(counted)


# -- manifest ----------------------------------------------------------------------------------------


def manifest(spark, sf_dir):
    """Order rows read as task records: customer = task, year = run."""
    key = F.col("o_orderkey")
    started = F.col("o_orderdate").cast("timestamp")
    return table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").cast("string").alias("run_id"),
        F.col("o_custkey").cast("string").alias("task_id"),
        F.when(key % 4 == 0, mf.FAILED).otherwise(mf.SUCCESS).alias("status"),
        (started + F.make_dt_interval(secs=key.cast("decimal(18,6)"))).alias("finished_at"),
        (key % 7).alias("files_read"), (key % 2).alias("files_written"), (key % 3).alias("retries"),
        (key % 100 / 10.0).cast("double").alias("duration"),
    )


MANIFEST_SQL = (
    "(select cast(year(o_orderdate) as varchar) as run_id, cast(o_custkey as varchar) as task_id, case when o_orderkey % 4 = 0 then "
    "'failed' else 'success' end as status, o_orderdate + to_seconds(o_orderkey) as finished_at, o_orderkey % 7 as files_read, "
    "o_orderkey % 2 as files_written, o_orderkey % 3 as retries, o_orderkey % 100 / 10.0 as duration from orders)"
)


@query("resume_skip", f"select cast(c_custkey as varchar) as task_id from customer where cast(c_custkey as varchar) not in "
       f"(select task_id from {MANIFEST_SQL} group by task_id having arg_max(status, finished_at) = 'success')")
def resume_skip(spark, sf_dir):
    tasks = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("task_id"))
    return mf.unfinished(tasks, manifest(spark, sf_dir))


@query(
    "manifest_totals",
    "select run_id, sum(files_read)::bigint as files_read, sum(files_written)::bigint as files_written, "
    "count(*) filter (status = 'success') as success, count(*) filter (status = 'failed') as failed, "
    f"sum(retries)::bigint as retries, round(sum(duration), 2)::double as duration from {MANIFEST_SQL} group by run_id",
)
def manifest_totals(spark, sf_dir):
    return mf.totals(manifest(spark, sf_dir)).withColumn("duration", F.round("duration", 2))


@query(
    "ready_jobs",
    "select s_name as name, 'src/' || s_suppkey as path, 'raw' as destination, 'ready' as status from supplier where s_acctbal > 0",
)
def ready_jobs(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier")
    registry = suppliers.select(
        F.col("s_name").alias("name"), F.concat(F.lit("src/"), F.col("s_suppkey").cast("string")).alias("path")
    )
    status = suppliers.select(F.col("s_name").alias("name"), (F.col("s_acctbal") > 0).alias("reachable"))
    return mf.ready_jobs(registry, status, "raw")


@query(
    "manifest_rows",
    "select 'part' as task_id, 'success' as status, count(*) as rows, 6 as columns from (select distinct * from part) union all "
    "select 'nation', 'success', count(*), 3 from nation",
)
def manifest_rows(spark, sf_dir):
    """A folder of part and nation files, every part row written twice, converted end to end."""
    folder, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    twice = part(spark, sf_dir).unionByName(part(spark, sf_dir))
    _flat_files(twice, folder, "part")
    _flat_files(table(spark, sf_dir, "nation"), folder, "nation")
    configs = [gr.GroupConfig("part"), gr.GroupConfig("nation", "nation.*")]
    convert_folder(spark, folder, configs, f"{out}/data", f"{out}/manifest", "run-1")
    again = convert_folder(spark, folder, configs, f"{out}/data", f"{out}/manifest", "run-2")
    return again.select("task_id", "status", F.inline("transfer_result")).select("task_id", "status", "rows", "columns")


def _flat_files(df, folder, name):
    """Write ``df`` as ``folder/name_<n>.csv``: Spark's files moved up and given a group's name."""
    spark = df.sparkSession
    staging = scratch_path(spark, "staging")
    df.write.option("header", "true").csv(staging)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    files = hadoop(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(hadoop(folder))
    for i, path in enumerate(files_in(spark, staging, "csv")):
        files.rename(hadoop(path), hadoop(f"{folder}/{name}_{i}.csv"))


@query("new_files_stream", "select p_brand, count(*) as rows, sum(p_size)::bigint as size from part group by p_brand")
def new_files_stream(spark, sf_dir):
    """Two arrivals, two runs: the second run only reads what is new."""
    folder, target, progress = (scratch_path(spark, n) for n in ("arriving", "landed", "progress"))
    for number, rule in enumerate(("p_partkey % 3 = 0", "p_partkey % 3 <> 0")):
        part(spark, sf_dir).where(rule).write.option("header", "true").csv(f"{folder}/batch{number}")
        landed = ingest_new_files(spark, folder, PART_TYPES, target, progress)
    return landed.groupBy("p_brand").agg(F.count(F.lit(1)).alias("rows"), F.sum("p_size").alias("size"))
