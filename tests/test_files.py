import io
import os
import tempfile
import zipfile

import pytest
from pyspark.sql import functions as F

from tidemark.operators import encoding as en
from tidemark.operators import manifest as mf
from tidemark.operators.grouping import GroupConfig
from tidemark.operators.ingest import convert_folder, merge_or_split
from tidemark.plans.filepack import workbook_bytes
from tidemark.sinks import writers as wr
from tidemark.sources import excel, listing, readers
from tidemark.streaming.new_files import ingest_new_files


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def put(folder, name, data):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data if isinstance(data, bytes) else data.encode("utf-8"))
    return "file:" + path


def test_listing_keeps_supported_files(spark, folder):
    for name in ("a.CSV", "b.xlsx", "c.txt", "d.jsonl", "e.sql"):
        put(folder, name, "x")
    files = listing.list_files(spark, folder)
    got = {(r["n"], r["file_type"], r["length"]) for r in files.withColumn("n", listing.file_name(F.col("path"))).collect()}
    assert got == {("a.CSV", "csv", 1), ("b.xlsx", "excel", 1), ("d.jsonl", "json", 1)}


def test_listing_of_missing_folder_and_of_a_file(spark, folder):
    with pytest.raises(FileNotFoundError):
        listing.list_files(spark, folder + "/none")
    put(folder, "a.csv", "x")
    with pytest.raises(NotADirectoryError):
        listing.list_files(spark, folder + "/a.csv")


def test_csv_files_with_different_headers(spark, folder):
    paths = [put(folder, "a.csv", "x,y\n1,2\n"), put(folder, "b.csv", "y,x\n20,10\n"), put(folder, "c.csv", "x,z\n5,6\n")]
    rows = readers.read_csv_text(spark, paths, lineage=True).orderBy("_source_file").collect()
    assert [(r["x"], r["y"], r["z"], r["_source_file"]) for r in rows] == [
        ("1", "2", None, "a.csv"), ("10", "20", None, "b.csv"), ("5", None, "6", "c.csv")]


def test_csv_typed_infers(spark, folder):
    path = put(folder, "a.csv", "x,y\n1,a\n")
    assert dict(readers.read_csv(spark, path, infer=True).dtypes) == {"x": "int", "y": "string"}


def test_inferred_types_need_every_value(spark):
    df = spark.createDataFrame(
        [("1", "1.5", "true", "2024-01-02", "1", None, 7), ("2", "3", "false", "2024-01-02 03:04:05", "x", None, 8), (None,) * 7],
        "i string, d string, b string, t string, m string, n string, k int",
    )
    got = dict(readers.infer_types(df).dtypes)
    assert got == {"i": "bigint", "d": "double", "b": "boolean", "t": "timestamp", "m": "string", "n": "string", "k": "int"}


def test_lossy_csv(spark, folder):
    path = put(folder, "a.csv", b'x,y\n1,caf\xe9,extra\n2,"two\nlines"\n')
    rows = readers.read_csv_lossy(spark, path).collect()
    assert [tuple(r) for r in rows] == [("1", "caf�"), ("2", "two\nlines")]


def test_json_layouts(spark, folder):
    paths = [
        put(folder, "lines.json", '\n{"a": 1}\n{"a": 2}\n'), put(folder, "array.json", '[{"a": 3},\n {"a": 4}]'),
        put(folder, "object.json", '﻿{\n "a": 5\n}'),
    ]
    assert sorted(r["a"] for r in readers.read_json(spark, paths).collect()) == [1, 2, 3, 4, 5]
    with pytest.raises(ValueError):
        readers.read_json(spark, [put(folder, "empty.json", " \n")])


def test_json_arrays_split_by_line(spark, folder):
    tidy = [
        put(folder, "a.json", '[\n  {"a": 1, "b": "x],[y"},\n  {"a": 2, "b": null}\n]\n'), put(folder, "b.json", '[{"a": 3},\n{"a": 4}]'),
        put(folder, "c d.json", '[{"a": 5}]'),
    ]
    rough = [put(folder, "d.json", '[{"a": 6}, {"a": 7}]'), put(folder, "e.json", '[{"a":\n 8}]')]
    whole = {r["path"].rsplit("/", 1)[1]: r["t"] for r in readers.array_lines(spark, tidy + rough).groupBy("path").agg(F.bool_and("whole").alias("t")).collect()}
    assert {k for k, v in whole.items() if v} == {"a.json", "b.json", "c%20d.json"}
    got = sorted((r["a"], r["b"]) for r in readers.read_json(spark, tidy + rough, "a int, b string").collect())
    assert got == [(1, "x],[y")] + [(i, None) for i in range(2, 9)]
    assert sorted(r["a"] for r in readers.read_json(spark, tidy + rough).collect()) == list(range(1, 9))


def office_workbook():
    """Shared strings, a date style, a boolean, an error cell and a gap, as office programs write them."""
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    parts = {
        "xl/workbook.xml": f'<workbook {main} xmlns:r="{rel}"><sheets><sheet name="S" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Target="/xl/worksheets/s.xml"/></Relationships>',
        "xl/sharedStrings.xml": f"<sst {main}><si><t>name</t></si><si><r><t>ri</t></r><r><t>ch</t></r></si></sst>",
        "xl/styles.xml": f'<styleSheet {main}><numFmts><numFmt numFmtId="164" formatCode="yyyy-mm-dd"/><numFmt numFmtId="165" formatCode="0.0&quot;d&quot;"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="164"/><xf numFmtId="165"/></cellXfs></styleSheet>',
        "xl/worksheets/s.xml": f'<worksheet {main}><sheetData><row r="3"><c r="A3" t="s"><v>0</v></c><c r="C3" t="s"><v>1</v></c></row><row r="5"><c r="A5" s="1"><v>44927.5</v></c><c r="B5" t="b"><v>1</v></c><c r="C5" t="e"><v>#N/A</v></c><c r="AA5" s="2"><v>7.5</v></c></row></sheetData></worksheet>',
    }
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return buffer.getvalue()


def test_workbook_cells(spark, folder):
    put(folder, "a.xlsx", office_workbook())
    put(folder, "broken.xlsx", b"no zip")
    books = excel.workbooks(spark, folder)
    rows = [(r["row_idx"], r["cells"]) for r in excel.read_cells(books).orderBy("row_idx").collect()]
    assert rows[0] == (0, ["name", None, "rich"])
    assert rows[1][0] == 2 and rows[1][1][:3] == ["2023-01-01 12:00:00", "true", None] and rows[1][1][26] == "7.5"
    assert [r["path"].rsplit("/", 1)[1] for r in excel.unreadable(books).collect()] == ["broken.xlsx"]


def test_sheet_table_maps_by_header(spark, folder):
    put(folder, "a.xlsx", workbook_bytes({"S": [["x", "y"], ["1", "2"]], "Config Data": [["k"]]}))
    put(folder, "b.xlsx", workbook_bytes({"S": [["y", "x", "z"], ["20", "10", "30"], [None, "11"]]}))
    books = excel.workbooks(spark, folder)
    got = sorted((r["src"], r["x"], r["y"], r["z"]) for r in excel.sheet_table(books, "S", lineage="src").collect())
    assert got == [("a.xlsx", "1", "2", None), ("b.xlsx", "10", "20", "30"), ("b.xlsx", "11", None, None)]
    assert {r["sheet"] for r in excel.sheet_names(books, ["Config Data"]).collect()} == {"S"}


def test_write_facts_and_skips(spark, folder):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None)], "x int, y string")
    facts = wr.write(df, folder + "/out", "parquet", wr.WriteOptions(deduplicate=True))
    assert (facts.rows, facts.columns, facts.schema) == (2, 2, [("x", "int"), ("y", "string")])
    assert not wr.write(df, folder + "/out", skip_existing=True).written
    assert not wr.write(df.where("x > 5"), folder + "/none").written
    assert not os.path.exists(folder + "/none")


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
def test_row_facts_per_format(spark, folder, fmt):
    df = spark.createDataFrame([("a\nb",), (None,), ("c",)], "x string")
    assert wr.write(df, f"{folder}/{fmt}", fmt).rows == 3


def test_logistic_model_still_runs_after_writing(spark, folder):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    wr.write(spark.range(3), folder + "/out")
    frame = VectorAssembler(inputCols=["id"], outputCol="features").transform(spark.range(100)).withColumn(
        "label", (F.col("id") > 50).cast("double")
    )
    assert LogisticRegression(maxIter=5).fit(frame).transform(frame).select("prediction").count() == 100
    assert len(LogisticRegression(maxIter=5).fit(frame).transform(frame).select("prediction").collect()) == 100


def test_names():
    assert wr.table_name("Part list/1") == "Part_list_1" and wr.table_name(None) == "data"
    assert wr.safe_name("a/b\\c ") == "a_b_c"


def test_folder_conversion_end_to_end(spark, folder):
    put(folder, "in/order_1.csv", "x,y\n1,2\n1,2\n")
    put(folder, "in/order_2.csv", "y,x\n4,3\n")
    put(folder, "in/order_3.jsonl", '{"x": "9", "y": "8"}\n')
    for i in (1, 2):
        put(folder, f"in/book_{i}.xlsx", workbook_bytes({"S": [["x"], [str(i)]], "Skip": [["q"]], f"Own{i}": [["r"]]}))
    put(folder, "in/bad.json", " ")
    configs = [GroupConfig("order", r"order_\d"), GroupConfig("book", ignore_sheets=("Skip",)), GroupConfig("bad"), GroupConfig("absent")]
    run = lambda run_id: convert_folder(spark, folder + "/in", configs, folder + "/out", folder + "/manifest", run_id)
    status = {r["task_id"]: r["status"] for r in run("r1").collect()}
    assert status == {"order": mf.SUCCESS, "book": mf.SUCCESS, "bad": mf.FAILED}
    got = sorted((r["x"], r["y"]) for r in spark.read.parquet(folder + "/out/order.parquet").collect())
    assert got == [("1", "2"), ("3", "4"), ("9", "8")]
    assert sorted(os.listdir(folder + "/out")) == ["book.S.parquet", "order.parquet"]
    assert sorted(r["x"] for r in spark.read.parquet(folder + "/out/book.S.parquet").collect()) == ["1", "2"]
    put(folder, "in/bad.json", '{"a": 1}\n')
    again = run("r2")
    assert [r["task_id"] for r in again.where("run_id = 'r2'").collect()] == ["bad"]
    totals = {r["run_id"]: (r["success"], r["failed"]) for r in mf.totals(again).collect()}
    assert totals == {"r1": (2, 1), "r2": (1, 0)}
    assert mf.unfinished(again.select("task_id").distinct(), again).count() == 0


def test_merge_or_split(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(2.5,)], "x double")
    c = spark.createDataFrame([([1],)], "x array<int>")
    assert list(merge_or_split({"a": a, "b": b})) == ["merged"]
    assert list(merge_or_split({"a": a, "c": c})) == ["a", "c"]


def test_stream_takes_each_file_once(spark, folder):
    args = (folder + "/in", "x int", folder + "/out", folder + "/progress")
    put(folder, "in/a.csv", "x\n1\n")
    assert [r["x"] for r in ingest_new_files(spark, *args).collect()] == [1]
    put(folder, "in/b.csv", "x\n2\n")
    rows = ingest_new_files(spark, *args).collect()
    assert sorted((r["x"], r["_source_file"]) for r in rows) == [(1, "a.csv"), (2, "b.csv")]


def test_bad_lines(spark, folder):
    lines = [b"fine", b"caf\xe9 x", "gut ü".encode(), b"\xff", b"cut \xe2\x82"]
    path = put(folder, "a.txt", b"\n".join(lines) + b"\n")
    got = {r["line"]: (r["start"], r["end"], r["bad_bytes"], r["reason"]) for r in en.non_utf8_lines(en.numbered_lines(spark, path)).collect()}
    want = {}
    for number, raw in enumerate(lines, 1):
        try:
            raw.decode("utf-8")
        except UnicodeDecodeError as e:
            want[number] = (e.start, e.end, raw[e.start:e.end].hex(), e.reason)
    assert got == want


def test_line_numbers_over_many_splits(spark, folder):
    path = put(folder, "big.txt", "".join(f"line {i}\n" for i in range(1, 5001)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = en.numbered_lines(spark, path)
        assert spark.read.text(path).rdd.getNumPartitions() > 5
        assert lines.where(F.concat(F.lit("line "), F.col("line").cast("string")) != F.col("value")).count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("raw", [b"ok", b"caf\xe9", b"a\xe2\x82b", b"\xf0\x9f\x98", b"\xc3\x28"])
def test_repair_matches_python(spark, folder, raw):
    df = en.raw_lines(spark, put(folder, "a.txt", raw))
    row = df.select(en.repair(F.col("value"), "replace").alias("r"), en.repair(F.col("value"), "ignore").alias("i")).first()
    assert (row["r"], row["i"]) == (raw.decode("utf-8", "replace"), raw.decode("utf-8", "ignore"))


def test_decode_from(spark, folder):
    df = en.raw_lines(spark, put(folder, "a.txt", b"caf\xe9 \x80"))
    assert df.select(en.decode_from(F.col("value"), "cp1252")).first()[0] == "café €"
    assert df.select(en.decode_from(F.col("value"), "latin-1")).first()[0] == "café \x80"


def test_fix_encoding_per_file(spark, folder):
    put(folder, "in/latin.txt", "café\nplain\n".encode("latin-1"))
    put(folder, "in/utf.txt", "größe\n")
    put(folder, "in/bom.txt", b"\xef\xbb\xbfx\n")
    put(folder, "in/ascii.txt", "x\n")
    found = en.fix_encoding(spark, folder + "/in", folder + "/out", "reencode")
    got = {r["path"].rsplit("/", 1)[1]: r["encoding"] for r in found.collect()}
    assert got == {"latin.txt": "iso-8859-1", "utf.txt": "utf-8", "bom.txt": "ascii", "ascii.txt": "ascii"}
    fixed = {(r["file"], r["value"]) for r in spark.read.text(folder + "/out").collect()}
    assert {("bom_utf8", "x"), ("latin_utf8", "café"), ("latin_utf8", "plain"), ("utf_utf8", "größe")} <= fixed


def test_mojibake(spark):
    df = spark.createDataFrame([("cafÃ©",), ("café",), ("größe €",), ("plain",), (None,)], "t string")
    assert [r[0] for r in df.select(en.fix_mojibake(F.col("t"))).collect()] == ["café", "café", "größe €", "plain", None]
