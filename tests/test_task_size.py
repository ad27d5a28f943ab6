"""What one task or worker holds stays bounded as the input grows."""

import numpy as np
import pytest

from tidemark.operators import charset as cs, grouping as gr, mojibake as mo
from tidemark.plans.registry import derived_nulls


@pytest.mark.parametrize("of", ["common", "first"])
def test_sheets_of_one_input_split_are_dealt_out(spark, monkeypatch, of):
    monkeypatch.setattr(gr, "TASK_ROWS", 100, raising=False)
    sheets = spark.range(0, 1000, 1, 1).selectExpr(
        "'g' as group", "concat('/in/', lpad(string(id div 2), 4, '0')) as path", "int(id % 2) as sheet_no", "concat('Sheet ', id % 2) as sheet"
    )
    seen = []
    monkeypatch.setattr(gr, "dealt", lambda df, deal=getattr(gr, "dealt", None): seen.append(deal(df)) or seen[-1], raising=False)
    found = gr.common_sheets(sheets) if of == "common" else gr.first_file_sheets(sheets)
    assert sorted(r["sheet"] for r in found.collect()) == ["Sheet 0", "Sheet 1"]
    assert len(seen) == 1 and max(sum(1 for _ in part) for part in seen[0].rdd.glom().collect()) < 250


def test_a_batch_of_long_lines_is_counted_in_blocks(monkeypatch):
    """The counts are those of the lines joined by line feeds, wherever blocks and calls end."""
    rng = np.random.default_rng(2)
    lines = [bytes(rng.integers(1, 256, size=n, dtype=np.uint8)) for n in (1, 50, 7, 8, 200)]
    data = np.frombuffer(b"\n".join(lines), dtype=np.uint8).astype(np.int64)
    both = data[:-1] << 8 | data[1:]
    want = np.bincount(data, minlength=256), np.bincount(both[(data[:-1] | data[1:]) >= 128], minlength=65536)
    for block in (3, 8, 1 << 20):
        monkeypatch.setattr(cs, "BLOCK", block, raising=False)
        for cut in (1, 3, 5):
            counts, pairs = np.zeros(256, dtype=np.int64), np.zeros(65536, dtype=np.int64)
            last = cs.add_bytes(counts, pairs, b"", lines[:cut])
            if lines[cut:]:
                cs.add_bytes(counts, pairs, last, lines[cut:])
            assert (counts == want[0]).all() and (pairs == want[1]).all()


def test_long_runs_are_not_remembered():
    right = "é" * 500
    wrong = right.encode().decode("latin-1")
    mo.known_repair.cache_clear()
    assert mo.fixed(wrong + " caf" + wrong[:2])[0] == right + " café" and mo.known_repair.cache_info().currsize == 1


def test_part_is_not_collected_for_the_join(spark, tmp_path):
    spark.sql("select id as p_partkey, 'Brand#1' as p_brand, 'ECONOMY' as p_type, 1 as p_size, 1.0D as p_retailprice from range(5)").write.parquet(
        f"{tmp_path}/part.parquet"
    )
    spark.sql("select id as l_orderkey, id % 5 as l_partkey, 1.0D as l_quantity, 2.0D as l_extendedprice from range(40)").write.parquet(
        f"{tmp_path}/lineitem.parquet"
    )
    rows = derived_nulls(spark, str(tmp_path))
    assert rows.count() == 40
    assert "BroadcastHashJoin" not in rows._jdf.queryExecution().toString()
