"""Encodings found from bytes: real sentences of many languages, odd files, and files converted to UTF-8."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import charset as cs, encoding as en

SENTENCES = {
    "fr": "L'été dernier, nous avons visité le château à côté de la forêt où l'on élève des chèvres. Ça a été très agréable, même sans goûter.",
    "de": "Die schöne Straße führt über die Brücke, während die Mädchen fröhlich größere Äpfel für Österreich pflücken.",
    "es": "El niño comió más jamón aquí después de la canción, según su corazón español; también mañana habrá lección.",
    "pl": "Zażółć gęślą jaźń. Wczoraj słońce świeciło, a dzieci się śmiały i biegły przez łąkę, żeby zdążyć na późny obiad.",
    "cs": "Příliš žluťoučký kůň úpěl ďábelské ódy, zatímco děti běžely přes řeku a křičely, že už přišel čas.",
    "ru": "Съешь ещё этих мягких французских булок, да выпей чаю. Вчера мы гуляли по берегу реки и долго говорили о жизни.",
    "el": "Η γρήγορη αλεπού πηδάει πάνω από το τεμπέλικο σκυλί, ενώ τα παιδιά παίζουν στην πλατεία κοντά στη θάλασσα.",
    "ja": "昨日、日本の友達と一緒に東京の新しいレストランへ行って、とてもおいしいラーメンを食べました。それから公園を散歩しました。",
    "zh": "我们昨天在北京的一个新饭店里吃了很多好吃的菜，然后大家一起去公园散步，说了很多有意思的事。他是我的朋友，这是中国的地方。",
    "zh-tw": "我們昨天在台北的一個新飯店裡吃了很多好吃的菜，然後大家一起去公園散步，說了很多有意思的事。他是我的朋友，這是中國的地方。",
    "ko": "어제 우리는 서울에 있는 새로운 식당에서 친구와 같이 맛있는 음식을 먹고 나서 공원으로 산책을 하러 갔습니다. 이것은 한국의 도시입니다.",
}
CASES = [
    ("fr", "iso-8859-1"), ("fr", "cp850"), ("fr", "mac-roman"), ("de", "iso-8859-1"), ("de", "mac-roman"), ("es", "cp850"), ("es", "iso-8859-1"),
    ("pl", "windows-1250"), ("pl", "iso-8859-2"), ("cs", "windows-1250"), ("cs", "iso-8859-2"), ("ru", "windows-1251"), ("ru", "koi8-r"), ("ru", "cp866"),
    ("ru", "iso-8859-5"), ("el", "iso-8859-7"), ("ja", "shift_jis"), ("ja", "euc-jp"), ("zh", "gb18030"), ("zh-tw", "big5"), ("ko", "euc-kr"),
    ("ru", "utf-8"), ("ja", "utf-8"), ("ru", "utf-16-le"), ("ja", "utf-16-be"),
]


@pytest.fixture(scope="module")
def found(spark):
    rows = []
    for language, encoding in CASES:
        lines = (SENTENCES[language] + "\nplain line\n\n" + SENTENCES[language]).encode(encoding).split(b"\n")
        rows += [(f"{language}|{encoding}", bytes(line)) for line in lines]
    rows += [("empty", b""), ("ascii", b"just text"), ("quoted", "“l'été”".encode("cp1252")), ("damaged", "é".encode()), ("damaged", b"caf\xe9 \xff\xfe\x80")]
    lines = spark.createDataFrame(rows, "path string, raw binary").select("path", F.col("raw").cast("string").alias("value")).repartition(4)
    detected = cs.detect_charsets(lines)
    return {r["path"]: r for r in detected.collect()}, lines, detected


@pytest.mark.parametrize("language, encoding", CASES)
def test_sentences(found, language, encoding):
    row = found[0][f"{language}|{encoding}"]
    got = row["encoding"]
    data = SENTENCES[language].encode(encoding)
    assert got == encoding or data.decode(got, errors="replace") == SENTENCES[language]  # another name that reads the same
    assert row["lines"] == 4


def test_odd_files(found):
    rows = found[0]
    assert (rows["empty"]["encoding"], rows["ascii"]["encoding"], rows["quoted"]["encoding"]) == ("ascii", "ascii", "windows-1252")
    assert rows["damaged"]["encoding"] not in ("ascii", "utf-8")


def test_languages_are_told(found):
    assert found[0]["ru|koi8-r"]["language"] == "ru"
    assert found[0]["fr|mac-roman"]["language"] == "fr"
    assert found[0]["fr|iso-8859-1"]["confidence"] >= 0


def test_lines_decode_to_what_was_written(found):
    _, lines, detected = found
    texts = {}
    for r in cs.decode_lines(lines, detected).where("path rlike '[|]' and length(text) > 12").collect():
        texts.setdefault(r["path"], set()).add(r["text"])
    for language, encoding in CASES:
        assert texts[f"{language}|{encoding}"] == {SENTENCES[language]}, (language, encoding)


def test_files_become_utf_8(spark, tmp_path):
    for folder, language, encoding in (("a", "fr", "cp850"), ("b", "ru", "koi8-r"), ("b/c", "pl", "iso-8859-2"), ("d", "de", "utf-16-le")):
        (tmp_path / "in" / folder).mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / folder / "same.txt").write_bytes((SENTENCES[language] + "\n" + SENTENCES[language] + "\n").encode(encoding))
    source = str(tmp_path / "in")
    files = f"{source}/{{a,b,b/c,d}}/same.txt"
    lines = en.raw_lines(spark, files)
    detected = cs.detect_charsets(lines)
    texts = {(r["path"].split("/in/")[1], r["text"]) for r in cs.decode_lines(lines, detected).where("text <> ''").collect()}
    assert texts == {("a/same.txt", SENTENCES["fr"]), ("b/same.txt", SENTENCES["ru"]), ("b/c/same.txt", SENTENCES["pl"]), ("d/same.txt", SENTENCES["de"])}
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    (tmp_path / "one").mkdir()
    (tmp_path / "one" / "x.txt").write_bytes((SENTENCES["de"] + "\n").encode("iso-8859-1"))
    cs.files_to_utf8(spark, str(tmp_path / "one"), str(tmp_path / "out"))
    spark.conf.unset("spark.sql.sources.partitionColumnTypeInference.enabled")
    assert [tuple(r) for r in spark.read.text(str(tmp_path / "out")).collect()] == [(SENTENCES["de"], "x_utf8")]


def test_equal_names_in_different_folders_stay_apart(spark, tmp_path):
    for folder in ("a", "b"):
        (tmp_path / "in" / f"k={folder}").mkdir(parents=True)
        (tmp_path / "in" / f"k={folder}" / "same.txt").write_bytes(f"caf\xe9 {folder}\n".encode("latin-1"))
    en.fix_encoding(spark, str(tmp_path / "in"), str(tmp_path / "out"), "reencode")
    names = {(r["file"], r["value"]) for r in spark.read.text(str(tmp_path / "out")).collect()}
    assert names == {("k=a__same_utf8", "café a"), ("k=b__same_utf8", "café b")}
