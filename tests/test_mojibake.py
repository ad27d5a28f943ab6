"""Wrongly read text put right, and right text left alone."""

import itertools

import pytest
from pyspark.sql import functions as F

from tidemark.operators import mojibake as mo

RIGHT = [
    "L'été à côté de la forêt — « Évidemment ! », dit-elle. “À demain…” ‘Étienne’ —Étienne «École»", "Die größte Straße über die Brücke, ßäü ßüä Öffnung ÄÖÜ",
    "¿Qué será mañana? ¡Sí, señor! 25 °C, 30 £, 20 €, § 5, © 2020 ® naïve façade œuvre Œuvre bœuf", "Żółć gęślą jaźń, příliš žluťoučký kůň",
    "Съешь ещё этих мягких французских булок", "Η γρήγορη αλεπού πηδάει", "日本語のテキストと漢字。中文文字，标点。한국어 문장입니다.", "emoji 😀👍🏽 and ❤️", "",
    "plain text", "½ cup, x² + y³ = ±5 ¼", "Ångström Øresund þórður Ísland", "naïve “à la carte” – “été”",
]


def read_wrongly(text, encoding):
    table = {ord(b): c for c, b in mo.byte_of(encoding).items()}
    return text.encode().decode("latin-1").translate(table)


@pytest.mark.parametrize("text", RIGHT)
def test_right_text_stays(text):
    assert mo.fixed(text) == (text, 0, None)


CHAINS = [(e,) for e in mo.WRONG] + [("cp1252", "cp1252"), ("latin-1", "latin-1"), ("cp437", "cp1252"), ("cp1252", "cp850"), ("cp1252",) * 3]


@pytest.mark.parametrize("text, chain", list(itertools.product([RIGHT[0], RIGHT[1], RIGHT[2], RIGHT[4], RIGHT[5], RIGHT[6]], CHAINS)))
def test_chains_are_undone(text, chain):
    wrong = text
    for encoding in chain:
        wrong = read_wrongly(wrong, encoding)
    got, runs, found = mo.fixed(wrong)
    assert got == text and runs > 0 and found.count("+") + 1 == len(chain)


def test_only_part_of_a_text_is_wrong():
    assert mo.fixed("“Ã©tÃ©” and été, cafÃ© — «Ã‰cole»")[0] == "“été” and été, café — «École»"


def test_rows(spark):
    texts = ["cafÃ©", "café", None, "", "plain", "ÃƒÂ¼ber"]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "id int, text string, runs int").repartition(3)
    got = {r["id"]: (r["text"], r["fixed_runs"], r["fixed_chain"]) for r in mo.undo_mojibake(df, "text").collect()}
    assert [got[i][0] for i in range(6)] == ["café", "café", None, "", "plain", "über"]
    assert [got[i][1] for i in range(6)] == [1, 0, 0, 0, 0, 1]
    assert got[0][2] in ("latin-1", "cp1252") and got[5][2].count("+") == 1
    report = {r["chain"]: r["texts"] for r in mo.mojibake_report(df, "text").collect()}
    assert report[None] == 4 and sum(report.values()) == 6


def test_right_rows_stay_in_the_jvm(spark):
    df = spark.createDataFrame([("Der größte Bär",), ("L'été à côté",), ("plain",)], "text string")
    assert df.where(mo.suspicious(F.col("text"))).count() == 0
