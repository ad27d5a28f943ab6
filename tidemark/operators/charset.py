"""Which encoding a file is written in, from counts of its bytes and byte pairs.

Lines of plain ASCII are counted in the JVM and go no further. The others give, per file, histograms of bytes and neighbouring bytes and the number of lines that
the automaton of each multi-byte encoding accepts; these are added up with a map-side combine, so at most 65,536 pairs per file are shuffled however long it is.
A file of no other bytes is ASCII, one with zero bytes whose lines all read as UTF-16 is that (a line feed leaves its other byte at the start or at the end of a line), one that the UTF-8
automaton accepts UTF-8, one that a two-byte encoding accepts that encoding if its common characters are frequent. What is left is read under every
single-byte encoding: letters are weighed by tables of the languages written in it, and neighbours by whether letters and cases fit together.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.functions import pandas_udf

from tidemark.functions.joins import null_safe_join

# The letters beyond ASCII of each language, most frequent first.
LETTERS = {
    "fr": "éèàêçùâîôûëïœ", "de": "üäöß", "es": "óíáéñúü", "pt": "ãçéáóõêíâúà", "it": "èàùòìé", "sv": "äåö", "da": "øåæ",
    "pl": "łąężśćóńź", "cs": "íáěéřčžýšůúťďň", "hu": "áéöóőüíúű",
    "ru": "оеаинтсрвлкмдпуяыьгзбчйхжшюцщэфъё", "uk": "оаинвіетрслкдмупязьгбчхйжїшєцющфґ", "el": "αοιετσνηυρπκμλςωίόάέδγήθύώχφβξζψ",
}
# Single-byte encodings and the languages usually written in them, in the order in which they win a tie.
SINGLE = {
    "windows-1252": ("cp1252", "fr de es pt it sv da"), "iso-8859-15": ("iso8859-15", "fr de es pt it sv da"),
    "windows-1250": ("cp1250", "pl cs hu de"), "iso-8859-2": ("iso8859-2", "pl cs hu de"),
    "cp850": ("cp850", "fr de es pt it sv da"), "cp437": ("cp437", "fr de es it sv"), "mac-roman": ("mac-roman", "fr de es pt it sv da"),
    "windows-1251": ("cp1251", "ru uk"), "koi8-r": ("koi8-r", "ru"), "cp866": ("cp866", "ru"), "iso-8859-5": ("iso8859-5", "ru uk"),
    "windows-1253": ("cp1253", "el"), "iso-8859-7": ("iso8859-7", "el"),
}
# Which bytes follow which in two-byte encodings, and frequent characters of the languages written in them.
DOUBLE = {
    "shift_jis": (rb"[\x81-\x9F\xE0-\xFC][\x40-\x7E\x80-\xFC]", rb"[\x00-\x7F\xA1-\xDF]", "のにるたはをとしてがでれんいうかすなまもこさっらりアイスンー。、日本人年大"),
    "euc-jp": (rb"[\xA1-\xFE][\xA1-\xFE]", rb"[\x00-\x7F]", "のにるたはをとしてがでれんいうかすなまもこさっらりアイスンー。、日本人年大"),
    "euc-kr": (rb"[\xA1-\xFE][\xA1-\xFE]", rb"[\x00-\x7F]", "이다는에을의가고를하지로도한사기서인은대어정자리나시"),
    "gb18030": (rb"[\x81-\xFE][\x40-\x7E\x80-\xFE]", rb"[\x00-\x7F]", "的一是不了人我在有他这中大来上国个到说们为子和你地，。"),
    "big5": (rb"[\x81-\xFE][\x40-\x7E\xA1-\xFE]", rb"[\x00-\x7F]", "的一是不了人我在有他這中大來上國個到說們為子和你地，。"),
}
UTF_8 = rb"(?:[\x00-\x7F]|[\xC2-\xDF][\x80-\xBF]|\xE0[\xA0-\xBF][\x80-\xBF]|[\xE1-\xEC\xEE\xEF][\x80-\xBF]{2}|\xED[\x80-\x9F][\x80-\xBF]|\xF0[\x90-\xBF][\x80-\xBF]{2}|[\xF1-\xF3][\x80-\xBF]{3}|\xF4[\x80-\x8F][\x80-\xBF]{2})*+"
USUAL_MARKS = "“”‘’‚„–—…«»‹›°€£§©®·¿¡\u00a0"
COMMON_SHARE = 0.12  # of the characters of a text in a two-byte encoding

BLOCK = 1 << 20
BYTE, PAIR, FACT = 0, 1, 2
FACTS = ["lines", "nul_first", "nul_last", "utf-16-le", "utf-16-be", "utf-8"] + [f"{kind}:{name}" for name in DOUBLE for kind in ("valid", "chars", "common")]


@lru_cache(maxsize=1)
def automata() -> tuple:
    double = {}
    for name, (pair, single, common) in DOUBLE.items():
        known = {c.encode(name) for c in common}
        double[name] = (re.compile(rb"(?:" + pair + rb"|" + single + rb")*+"), re.compile(pair), known)
    return re.compile(UTF_8), double


def utf_16_line(line: bytes, name: str) -> bytes:
    """The line without the other byte of the line feed that the split has left at its start or its end."""
    return line if len(line) % 2 == 0 else line[1:] if name == "utf-16-le" else line[:-1]


def readable(data: bytes, name: str) -> bool:
    try:
        return data.decode(name).replace("\t", "").replace("\r", "").replace("\ufeff", "").replace("\u3000", "").isprintable()
    except UnicodeDecodeError:
        return False


def facts_of(line: bytes) -> dict[str, int]:
    """What one line adds to its file's facts."""
    utf_8, double = automata()
    out = {"lines": 1, "nul_first": int(line[:1] == b"\0"), "nul_last": int(line[-1:] == b"\0"), "utf-8": int(utf_8.fullmatch(line) is not None)}
    if b"\0" in line or not out["utf-8"]:
        out |= {name: int(readable(utf_16_line(line, name), name)) for name in ("utf-16-le", "utf-16-be")}
    for name, (whole, pair, known) in double.items():
        if whole.fullmatch(line):
            chars = [c for c in pair.findall(line)]
            out |= {f"valid:{name}": 1, f"chars:{name}": len(chars), f"common:{name}": sum(c in known for c in chars)}
    return out


def add_bytes(counts: np.ndarray, pairs: np.ndarray, last: bytes, lines: list[bytes]) -> bytes:
    """Add lines to the counts of bytes and of pairs with one beyond ASCII, ``BLOCK`` bytes at a time; ``last`` is the last byte of the line before, if any.

    Returns the last byte of these lines.
    """
    data = np.frombuffer(b"\n".join([last, *lines] if last else lines), dtype=np.uint8)
    for at in range(0, len(data), BLOCK):
        block = data[at : at + BLOCK + 1].astype(np.uint16)  # with the first byte of the next block, for the pair across
        both = block[:-1] << 8 | block[1:]
        high = both[(both & 0x8080) > 0]
        if len(high):
            pairs += np.bincount(high, minlength=65536)
        counts += np.bincount(block[:BLOCK], minlength=256)
    if last:
        counts[last[0]] -= 1  # counted with its own line
    return lines[-1][-1:]


def byte_counts(lines: DataFrame) -> DataFrame:
    """(path, kind, code, n) over the lines (path, value) that are not plain ASCII."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raws = batch.column(1)
            by_path: dict[str, list[int]] = {}
            for i, path in enumerate(batch.column(0).to_pylist()):
                by_path.setdefault(path, []).append(i)
            for path, own in by_path.items():
                counts, pairs = np.zeros(256, dtype=np.int64), np.zeros(65536, dtype=np.int64)
                facts, last, waiting, size = dict.fromkeys(FACTS, 0), b"", [], 0
                for i in own:
                    raw = raws[i].as_py()
                    for name, n in facts_of(raw).items():
                        facts[name] += n
                    waiting.append(raw)
                    size += len(raw)
                    if size >= BLOCK or i == own[-1]:
                        last, waiting, size = add_bytes(counts, pairs, last, waiting), [], 0
                rows = [(BYTE, counts), (PAIR, pairs), (FACT, np.array([facts[f] for f in FACTS]))]
                for kind, counts in rows:
                    used = np.flatnonzero(counts)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([path] * len(used), pa.string()), pa.array(np.full(len(used), kind), pa.int32()),
                        pa.array(used, pa.int32()), pa.array(counts[used], pa.int64()),
                    ], names=["path", "kind", "code", "n"])

    raw = F.col("value").cast("binary")
    other = F.decode(raw, "ISO-8859-1").rlike(r"[^\x01-\x7F]")
    found = lines.where(other).select("path", raw.alias("raw")).mapInArrow(counted, "path string, kind int, code int, n bigint")
    return found.groupBy("path", "kind", "code").agg(F.sum("n").alias("n"))


@lru_cache(maxsize=1)
def single_tables() -> list[tuple[str, str, np.ndarray, np.ndarray]]:
    """(encoding, language, log weight of each byte, log weight of each pair) of every single-byte encoding and language."""
    out = []
    for name, (codec, languages) in SINGLE.items():
        chars = [bytes([b]).decode(codec, errors="replace") for b in range(256)]
        letter = np.array([c.isalpha() for c in chars])
        upper = np.array([c.isupper() for c in chars])
        lower = letter & ~upper
        pair = np.zeros((256, 256))
        pair[lower[:, None] & upper[None, :]] += math.log(0.03)
        pair[(letter[:, None] ^ letter[None, :]) & ~(np.arange(256) < 128)[:, None] & ~letter[:, None] & lower[None, :]] += math.log(0.3)
        pair[letter[:, None] & (~letter & (np.arange(256) >= 128))[None, :]] += math.log(0.3)
        for language in languages.split():
            weight = np.zeros(256)
            order = {c: i for i, c in enumerate(LETTERS[language])}
            for b in range(128, 256):
                c = chars[b]
                if c.lower() in order:
                    share = 0.3 / (1 + order[c.lower()]) * (0.05 if c.isupper() else 1)
                elif c in USUAL_MARKS:
                    share = 0.003
                elif c.isalpha():
                    share = 0.0008
                elif c == "\ufffd" or "\x80" <= c < "\xa0":
                    share = 1e-7
                else:
                    share = 0.0001
                weight[b] = math.log(share)
            out.append((name, language, weight, pair.ravel()))
    return out


def best_single(counts: np.ndarray, pairs: np.ndarray) -> tuple[str, str, float]:
    """(encoding, language, lead over the next encoding per byte beyond ASCII) for a file's histograms."""
    best: dict[str, tuple[float, str]] = {}
    for name, language, weight, pair in single_tables():
        score = float(counts @ weight + pairs @ pair)
        if name not in best or score > best[name][0]:
            best[name] = (score, language)
    ranked = sorted(best, key=lambda name: -best[name][0])
    lead = (best[ranked[0]][0] - best[ranked[1]][0]) / max(counts[128:].sum(), 1)
    name = ranked[0]
    if name == "windows-1252" and not counts[128:160].any():
        name = "iso-8859-1"  # none of the characters that set the two apart
    return name, best[ranked[0]][1], lead


def decide(counts: np.ndarray, pairs: np.ndarray, facts: dict[str, int]) -> tuple[str, str | None, float]:
    lines = facts["lines"]
    if not lines:
        return "ascii", None, 1.0
    le, be = facts["utf-16-le"], facts["utf-16-be"]
    if counts[0] and max(le, be) == lines:
        if le == be:  # both readable, as Latin letters are as Han characters: the line feeds tell
            le, be = facts["nul_last"], facts["nul_first"]
        return ("utf-16-le" if le > be else "utf-16-be"), None, 1.0
    if facts["utf-8"] == lines:
        return ("utf-8" if counts[128:].any() else "ascii"), None, 1.0
    shares = {
        name: facts[f"common:{name}"] / max(facts[f"chars:{name}"], 1) for name in DOUBLE
        if facts[f"valid:{name}"] == lines and facts[f"chars:{name}"]
    }
    name = max(shares, key=shares.get, default=None)
    if name is not None and shares[name] >= COMMON_SHARE:
        return name, None, shares[name]
    return best_single(counts, pairs)


def detect_charsets(lines: DataFrame) -> DataFrame:
    """(path, encoding, language, confidence, lines) of every file, from lines (path, value) with untouched bytes.

    ``language`` is the one whose letters fit best, for single-byte encodings only. ``confidence`` is a share where an automaton decides, and the lead over the
    next encoding, in log weight per byte beyond ASCII, where letters do; 0 means that the next one reads the file the same. An empty file is ASCII.
    """

    def judged(rows: pd.DataFrame) -> pd.DataFrame:
        def histogram(kind: int, size: int) -> np.ndarray:
            own = rows[rows.kind == kind]
            out = np.zeros(size)
            out[own.code] = own.n
            return out

        facts = dict(zip(FACTS, histogram(FACT, len(FACTS)).astype(int)))
        found = decide(histogram(BYTE, 256), histogram(PAIR, 65536), facts)
        return pd.DataFrame([(rows.path.iloc[0], *found)], columns=["path", "encoding", "language", "confidence"])

    # a file's rows are bounded: its bytes, its pairs of bytes and its facts
    found = byte_counts(lines).groupBy("path").applyInPandas(judged, "path string, encoding string, language string, confidence double")
    files = lines.groupBy("path").agg(F.count(F.lit(1)).alias("lines"))
    return files.join(found, "path", "left").select(
        "path", F.coalesce("encoding", F.lit("ascii")).alias("encoding"), "language", F.coalesce("confidence", F.lit(1.0)).alias("confidence"), "lines"
    )


@pandas_udf(T.StringType())
def decoded(raw: pd.Series, encoding: pd.Series) -> pd.Series:
    """Lines decoded by the encoding of their file; the byte of UTF-16 that a line feed has left on a line goes."""

    def one(data: bytes, name: str) -> str:
        data = utf_16_line(bytes(data), name) if name.startswith("utf-16") else bytes(data)
        return data.decode(name, errors="replace")

    return pd.Series([None if d is None else one(d, n) for d, n in zip(raw, encoding)], dtype=object)


def decode_lines(lines: DataFrame, detected: DataFrame) -> DataFrame:
    """(path, encoding, text): every line as text; what is ASCII or valid UTF-8 stays in the JVM."""
    known = null_safe_join(lines, detected.select("path", "encoding"), ["path"], "inner")
    value = F.col("value")
    plain = F.col("encoding").isin("ascii", "utf-8")
    text: Column = F.when(plain, F.make_valid_utf8(value)).otherwise(
        decoded(F.when(~plain, value.cast("binary")), F.when(~plain, F.col("encoding")).otherwise("ascii"))
    )
    return known.select("path", "encoding", text.alias("text"))


def files_to_utf8(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Write all files below ``source`` as UTF-8 below ``target``, one folder per file, and return what was detected."""
    from tidemark.operators.encoding import output_name, raw_lines

    lines = raw_lines(spark, source)
    detected = detect_charsets(lines)
    out = decode_lines(lines, detected).select(F.col("text").alias("value"), output_name(F.col("path"), source).alias("file"))
    out.write.mode("overwrite").partitionBy("file").text(target)
    return detected
