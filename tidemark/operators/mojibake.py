"""Text that was decoded wrongly, once or several times over, put right again.

UTF-8 read as another encoding turns every character beyond ASCII into a *run* of two or more other ones; ASCII stays as it is, whatever the encoding and however often
it happened. So each run is repaired by itself: a step writes its characters as bytes of one encoding and reads what is valid as UTF-8, leaving the rest. A best-first
search over chains of such steps looks for the run that costs least, where letters of living alphabets are cheap and stray symbols, drawing characters
and controls are dear. A run is changed only if that saves enough, and only texts that hold a lead and a following character of some encoding side by side leave the JVM.
"""

from __future__ import annotations

import heapq
import re
import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.functions import arrow_udf

# Encodings that text is wrongly read as, and what a repair by each must save at least.
WRONG = {"latin-1": 0.05, "cp1252": 0.05, "cp1250": 0.05, "cp437": 0.1, "cp850": 0.1, "mac-roman": 0.15}
MULTI = re.compile("[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}|\xed[\x80-\x9f][\x80-\xbf]|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2}")
RUN = re.compile(r"[^\x00-\x7F]{2,}")
USUAL_MARKS = set("–—‘’“”„‚…•«»‹›°§©®£€¿¡ ")
MAX_STEPS, MAX_STATES = 6, 200
KNOWN_RUNS, KNOWN_LENGTH = 100_000, 64  # how many repairs a worker remembers, and the longest run among them
SLICE = 64
DOUBT = 0.2  # what a run may cost more when it has gone through the same chain as most of its text
RESULT = T.StructType([T.StructField("text", T.StringType()), T.StructField("runs", T.IntegerType()), T.StructField("chain", T.StringType())])


@lru_cache(maxsize=None)
def byte_of(encoding: str) -> dict[str, str]:
    """Byte, as a Latin-1 character, of every character beyond ASCII; unused bytes stand for the control of their number."""
    out = {}
    for b in range(128, 256):
        char = bytes([b]).decode(encoding, errors="replace")
        out[chr(b) if char == "�" else char] = chr(b)
    return out


def step(run: str, encoding: str) -> str:
    """The run with what is UTF-8 in its bytes under ``encoding`` decoded; the rest stays."""
    table = byte_of(encoding)
    raw = "".join([table.get(c, "\0") for c in run])
    out, at = [], 0
    for m in MULTI.finditer(raw):
        out += [run[at : m.start()], m.group().encode("latin-1").decode("utf-8")]
        at = m.end()
    return "".join([*out, run[at:]])


@lru_cache(maxsize=4096)
def char_cost(c: str) -> float:
    """How unlikely a character is in text of living languages."""
    code, kind = ord(c), unicodedata.category(c)
    if code < 0x80:
        return 0.0
    if 0xC0 <= code <= 0x17F and kind[0] == "L":
        return 0.1
    if c in USUAL_MARKS:
        return 0.2
    if 0x370 <= code <= 0x45F and kind[0] == "L":
        return 0.2
    if 0x5D0 <= code <= 0x64A or 0x900 <= code <= 0xDFF or 0xE00 <= code <= 0xEFF or 0x3040 <= code <= 0x30FF or 0x4E00 <= code <= 0x9FFF or 0xAC00 <= code <= 0xD7A3:
        return 0.3
    if 0x3000 <= code <= 0x303F or 0xFF00 <= code <= 0xFFEF or 0x1F300 <= code <= 0x1FAFF or code == 0xFE0F or 0x2600 <= code <= 0x27BF:
        return 0.4
    if 0x1E00 <= code <= 0x1FFF and kind[0] == "L":
        return 0.3
    if 0x2500 <= code <= 0x25FF or kind in ("Cc", "Cn", "Co") or code == 0xFFFD:
        return 1.5
    if kind[0] == "L" or kind[0] == "M":
        return 1.5  # letters of rare scripts, marks standing alone
    return 0.6


def cost(run: str) -> float:
    return sum(map(char_cost, run))


def repaired(run: str) -> tuple[str, str]:
    """The cheapest text that chains of steps make of a run, and the chain; short runs are remembered, as they come again and take bounded room."""
    return known_repair(run) if len(run) <= KNOWN_LENGTH else repair(run)


def repair(run: str) -> tuple[str, str]:
    """The cheapest text that chains of steps make of a run, and the chain; the run itself where nothing saves enough."""
    best = (cost(run), 0, run, (), cost(run))
    waiting, seen = [best], {run}
    while waiting and len(seen) < MAX_STATES:
        _, steps, text, chain, lowest = heapq.heappop(waiting)
        if steps == MAX_STEPS:
            continue
        for encoding, saving in WRONG.items():
            new = step(text, encoding)
            if new in seen:
                continue
            seen.add(new)
            price = cost(new)
            state = (price, steps + 1, new, (*chain, encoding), min(price, lowest))
            heapq.heappush(waiting, state)
            # right text may look like wrong text in another encoding: a chain's end has to pay against all that it passed through
            if price + saving <= lowest + 1e-9 and state[:2] < best[:2]:
                best = state
    return best[2], "+".join(best[3])


known_repair = lru_cache(maxsize=KNOWN_RUNS)(repair)


def fixed(text: str) -> tuple[str, int, str | None]:
    """The text, how many runs were changed, and the chain that changed most of them (the first by name of several).

    That chain has the say where a run alone is in doubt: it is undone as well where that costs no more than the run, or little more than
    what the run alone would have become.
    """
    chains: dict[str, int] = {}
    own: dict[str, tuple[str, str]] = {}  # of this text, which are looked at twice
    for m in RUN.finditer(text):
        run = m.group()
        if run not in own:
            own[run] = repaired(run)
        chain = own[run][1]
        if chain:
            chains[chain] = chains.get(chain, 0) + 1
    if not chains:
        return text, 0, None
    usual = min(chains, key=lambda c: (-chains[c], c))
    changed = 0

    def one(m: re.Match) -> str:
        nonlocal changed
        run = m.group()
        new, chain = own[run]
        if chain != usual and chains[usual] > 1:
            other = run
            for encoding in usual.split("+"):
                other = step(other, encoding)
            done = other != run and not repaired(other)[1]
            if done and cost(other) <= (cost(new) + DOUBT if chain else cost(run)) + 1e-9:
                new = other
        changed += new != run
        return new

    return RUN.sub(one, text), changed, usual


def suspicious(text: Column) -> Column:
    """Holds a character that stands for a lead byte of UTF-8 before one that stands for a following byte, under some encoding."""

    def of(encoding: str, low: int, high: int) -> str:
        return "".join(f"\\x{{{ord(c):X}}}" for c, b in byte_of(encoding).items() if low <= ord(b) <= high)

    return text.rlike("|".join(f"[{of(e, 0xC2, 0xF4)}][{of(e, 0x80, 0xBF)}]" for e in WRONG))


@arrow_udf(RESULT)
def fix_texts(texts: pa.Array) -> pa.Array:
    """A batch holds thousands of texts: only ``SLICE`` of them are Python's at a time."""
    kind, out = pa.struct([("text", pa.string()), ("runs", pa.int32()), ("chain", pa.string())]), []
    for at in range(0, len(texts), SLICE):
        rows = [(None, 0, None) if t is None else fixed(t) for t in texts.slice(at, SLICE).to_pylist()]
        out.append(pa.array([dict(zip(("text", "runs", "chain"), r)) for r in rows], kind))
    return pa.concat_arrays(out) if out else pa.array([], kind)


def undo_mojibake(df: DataFrame, text_col: str, runs_col: str = "fixed_runs", chain_col: str = "fixed_chain") -> DataFrame:
    """``df`` with its text put right, the number of runs that were changed and the chain of encodings that most of them had gone through."""
    text = F.col(f"`{text_col}`")
    flag = F.coalesce(suspicious(text), F.lit(False))
    done = df.withColumn("__fixed", fix_texts(F.when(flag, text)))
    return done.withColumns({
        text_col: F.when(flag, F.col("__fixed.text")).otherwise(text), runs_col: F.when(flag, F.col("__fixed.runs")).otherwise(F.lit(0)),
        chain_col: F.col("__fixed.chain"),
    }).drop("__fixed")


def mojibake_report(df: DataFrame, text_col: str) -> DataFrame:
    """(chain, texts, runs): how often each chain was undone; a null chain counts the texts left as they are."""
    found = undo_mojibake(df, text_col)
    return found.groupBy(F.col("fixed_chain").alias("chain")).agg(F.count(F.lit(1)).alias("texts"), F.sum("fixed_runs").cast("bigint").alias("runs"))
