"""Personal data replaced by format-preserving pseudonyms, in Spark expressions alone.

Numbers and dates that pass their check are permuted by a keyed Feistel network inside their own format, so an equal
value has the same pseudonym in every document and two values never share one: payment cards (Luhn digit made anew), IBANs (digits
permuted, check digits made anew), social security numbers (area, group and serial stay valid), telephone numbers (country code
kept), IPv4 addresses, and dates from 1900 to 2099. The letters and digits of an e-mail's local part are permuted within
their kinds. Candidates that fail their check stay as they are. With ``reveal`` and the same key the network runs backwards.

A text is split once at all candidates; what lies between stays byte for byte. Every row is handled by itself, without a shuffle.

Defined results: null texts stay null, texts without candidates stay equal; rows that repeat get equal results; all other columns are kept,
an existing column named like a result is replaced. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import fresh, quoted

ROUNDS = 8
FIRST_DAY, DAYS = "1900-01-01", 73_049  # up to 2099-12-31; 73,049 = 319 x 229
NAMES = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
PHONE = r"(?<![\w+])\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<!\w)\(\d{3}\) \d{3}-\d{4}(?!\d)"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
ADDRESS = r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d)"
DATE = r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?![\d/-]|\.\d)"
SOCIAL = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
CARD = r"(?<![\d-])\d(?:[ -]?\d){12,18}(?![\d-])"
CANDIDATE = "|".join((NAMES, PHONE, IBAN, ADDRESS, DATE, SOCIAL, CARD))


def number(text: Column) -> Column:
    return text.cast("bigint")


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def part(text: Column, start: int | Column, length: int | Column) -> Column:
    return F.substring(text, *(F.lit(x) if isinstance(x, int) else x for x in (start, length)))


def power(digits: Column) -> Column:
    return F.pow(F.lit(10.0), digits).cast("bigint")


def widened(value: Column, width: Column | int) -> Column:
    return F.lpad(value.cast("string"), width if isinstance(width, Column) else F.lit(width), F.lit("0"))


class Pseudonyms:
    """Expressions for one key and direction."""

    def __init__(self, key: str, reveal: bool = False):
        self.key, self.reveal = key, reveal

    def secret(self, kind: str, turn: Column, value: Column) -> Column:
        """60 bits that depend on the key, the kind of value, the round and the other half."""
        mixed = F.concat(F.lit(f"{self.key}|{kind}|"), turn.cast("string"), F.lit("|"), value.cast("string"))
        return F.conv(F.substring(F.sha2(mixed, 256), 1, 15), 16, 10).cast("bigint")

    def rounds(self, start: Column, step: Callable[[Column, Column], Column]) -> Column:
        turns = list(range(1, ROUNDS + 1))
        return F.aggregate(F.array(*map(F.lit, turns[::-1] if self.reveal else turns)), start, step)

    def permuted(self, kind: str, left: Column, right: Column, lefts: Column, rights: Column) -> Column:
        """(l, r): the pair of numbers below (lefts, rights) that stands for (left, right)."""
        sign = F.lit(-1 if self.reveal else 1).cast("bigint")

        def step(s: Column, turn: Column) -> Column:
            l, r = s["l"], s["r"]
            new_l = F.pmod(l + sign * F.pmod(self.secret(kind, turn, r), lefts), lefts)
            new_r = F.pmod(r + sign * F.pmod(self.secret(kind, turn, l), rights), rights)
            odd = turn % 2 == 1
            return F.struct(F.when(odd, new_l).otherwise(l).alias("l"), F.when(odd, r).otherwise(new_r).alias("r"))

        return self.rounds(F.struct(left.alias("l"), right.alias("r")), step)

    def digits(self, kind: str, digits: Column) -> Column:
        """A string of 2 to 36 digits permuted among those of its length."""
        size = F.length(digits)
        short = (size / 2).cast("int")
        long = size - short
        pair = self.permuted(
            kind, number(part(digits, 1, short)), number(part(digits, short + 1, long)), power(short), power(long)
        )
        return F.concat(widened(pair["l"], short), widened(pair["r"], long))

    def card(self, hit: Column) -> Column:
        digits = digits_of(hit)
        payload = self.digits("card", part(digits, 1, F.length(digits) - 1))
        check = F.pmod(F.lit(10) - luhn_sum(F.concat(payload, F.lit("0"))) % 10, F.lit(10))
        return refilled(hit, F.concat(payload, check.cast("string")))

    def iban(self, hit: Column) -> Column:
        plain = F.replace(hit, F.lit(" "), F.lit(""))
        body = F.substring(plain, F.lit(5), F.length(plain))
        new = refilled(body, self.digits("iban", digits_of(body)))
        check = F.lit(98) - remainder_97(F.concat(new, part(plain, 1, 2), F.lit("00")))
        return refilled(hit, F.concat(widened(check, 2), digits_of(new)))

    def social(self, hit: Column) -> Column:
        digits = digits_of(hit)
        area = number(part(digits, 1, 3))
        area = F.when(area > 666, area - 2).otherwise(area - 1)  # 001 to 899 without 666
        rest = (number(part(digits, 4, 2)) - 1) * 9999 + number(part(digits, 6, 4)) - 1
        pair = self.permuted("social", area, rest, F.lit(898).cast("bigint"), F.lit(99 * 9999).cast("bigint"))
        new = F.when(pair["l"] >= 665, pair["l"] + 2).otherwise(pair["l"] + 1)
        group, serial = (pair["r"] / 9999).cast("bigint") + 1, pair["r"] % 9999 + 1
        return refilled(hit, F.concat(widened(new, 3), widened(group, 2), widened(serial, 4)))

    def phone(self, hit: Column) -> Column:
        digits = digits_of(hit)
        code = F.length(F.regexp_extract(hit, r"^\+(\d{1,3})", 1))
        rest = F.substring(digits, code + 1, F.length(digits))
        return refilled(hit, F.concat(part(digits, 1, code), self.digits("phone", rest)))

    def address(self, hit: Column) -> Column:
        octets = F.transform(F.split(hit, r"\."), number)
        pair = self.permuted(
            "address", octets[0] * 256 + octets[1], octets[2] * 256 + octets[3],
            F.lit(65536).cast("bigint"), F.lit(65536).cast("bigint"),
        )
        quads = [f(pair[h]) for h in "lr" for f in (lambda x: (x / 256).cast("bigint"), lambda x: x % 256)]
        return F.concat_ws(".", *[q.cast("string") for q in quads])

    def date(self, hit: Column) -> Column:
        day = F.datediff(day_of(hit), F.lit(FIRST_DAY).cast("date")).cast("bigint")
        pair = self.permuted("date", day % 319, (day / 319).cast("bigint"), F.lit(319).cast("bigint"), F.lit(229).cast("bigint"))
        new = F.date_add(F.lit(FIRST_DAY).cast("date"), (pair["r"] * 319 + pair["l"]).cast("int"))
        year, month, day = (F.date_format(new, p) for p in ("yyyy", "MM", "dd"))
        return (
            F.when(hit.contains("-"), F.concat_ws("-", year, month, day))
            .when(hit.contains("."), F.concat_ws(".", day, month, year)).otherwise(F.concat_ws("/", month, day, year))
        )

    def email(self, hit: Column) -> Column:
        local = F.substring_index(hit, "@", 1)
        half = (F.length(local) / 2).cast("int")

        def shifted(own: Column, other: Column, turn: Column) -> Column:
            secret = F.sha2(F.concat(F.lit(f"{self.key}|email|"), turn.cast("string"), F.lit("|"), other), 256)

            def shift(char: Column, at: Column) -> Column:
                step = F.conv(F.substring(secret, (at % 15) * 4 + 1, F.lit(4)), 16, 10).cast("int")
                step = -step if self.reveal else step
                code = F.ascii(char)
                moved = lambda low, size: F.char(F.pmod(code - low + step, F.lit(size)) + low)
                return (
                    F.when(char.rlike("[a-z]"), moved(97, 26)).when(char.rlike("[A-Z]"), moved(65, 26))
                    .when(char.rlike("[0-9]"), moved(48, 10)).otherwise(char)
                )

            return F.array_join(F.transform(F.split(own, ""), shift), "")

        def step(s: Column, turn: Column) -> Column:
            odd = turn % 2 == 1
            return F.struct(
                F.when(odd, shifted(s["l"], s["r"], turn)).otherwise(s["l"]).alias("l"),
                F.when(odd, s["r"]).otherwise(shifted(s["r"], s["l"], turn)).alias("r"),
            )

        start = F.struct(part(local, 1, half).alias("l"), F.substring(local, half + 1, F.length(local)).alias("r"))
        pair = self.rounds(start, step)
        return F.concat(pair["l"], pair["r"], F.substring(hit, F.length(local) + 1, F.length(hit)))

    def kind_and_name(self, hit: Column) -> Column:
        """Kind of a candidate and what stands for it; kind null: it fails its check and stays."""
        whole = lambda pattern: hit.rlike(f"^(?:{pattern})$")
        digits = digits_of(hit)
        choices = [
            ("email", hit.contains("@"), self.email),
            ("phone", hit.rlike(r"^[+(]") & F.length(digits).between(8, 15), self.phone),
            ("iban", whole(IBAN) & (remainder_97(moved_iban(hit)) == 1), self.iban),
            ("address", whole(ADDRESS) & ~F.exists(F.split(hit, r"\."), lambda o: number(o) > 255), self.address),
            ("date", whole(DATE) & F.coalesce(day_of(hit).between(FIRST_DAY, "2099-12-31"), F.lit(False)), self.date),
            ("social", whole(SOCIAL) & hit.rlike(r"^(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)"), self.social),
            ("card", whole(CARD) & (luhn_sum(digits) % 10 == 0), self.card),
        ]
        kind = name = None
        for label, fits, make in choices:
            kind = F.when(fits, F.lit(label)) if kind is None else kind.when(fits, F.lit(label))
            name = F.when(fits, make(hit)) if name is None else name.when(fits, make(hit))
        return F.struct(kind.alias("kind"), name.otherwise(hit).alias("name"))


def refilled(form: Column, digits: Column) -> Column:
    """``form`` with its digits replaced in order by ``digits``."""
    return F.array_join(
        F.transform(
            F.split(form, ""),
            lambda char, at: F.when(
                char.rlike(r"\d"), F.substring(digits, F.length(digits_of(F.substring(form, F.lit(1), at + 1))), F.lit(1))
            ).otherwise(char),
        ), "",
    )


def luhn_sum(digits: Column) -> Column:
    def add(total: Column, pair: Column) -> Column:
        doubled = pair["d"] * 2
        return total + F.when(pair["i"] % 2 == 0, pair["d"]).when(doubled > 9, doubled - 9).otherwise(doubled)

    pairs = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.struct(d.cast("int").alias("d"), i.alias("i")))
    return F.aggregate(pairs, F.lit(0), add)


def moved_iban(hit: Column) -> Column:
    plain = F.replace(hit, F.lit(" "), F.lit(""))
    return F.concat(F.substring(plain, F.lit(5), F.length(plain)), part(plain, 1, 4))


def remainder_97(text: Column) -> Column:
    """Remainder by 97 of digits and letters, letters counting 10 to 35."""
    return F.aggregate(
        F.split(text, ""), F.lit(0),
        lambda rest, c: F.when(c.rlike(r"\d"), (rest * 10 + F.ascii(c) - 48) % 97).otherwise((rest * 100 + F.ascii(c) - 55) % 97),
    )


def day_of(hit: Column) -> Column:
    """The date written as year-month-day, day.month.year, or month/day/year; null when there is no such day."""
    return F.try_to_timestamp(
        hit, F.when(hit.contains("-"), "yyyy-MM-dd").when(hit.contains("."), "dd.MM.yyyy").otherwise("MM/dd/yyyy")
    ).cast("date")


def pseudonymise(
    docs: DataFrame, key: str, text_col: str = "text", reveal: bool = False, counts_col: str | None = None
) -> DataFrame:
    """``docs`` with pseudonyms in the text; ``counts_col`` names a column for the kinds found, with their numbers."""
    names = Pseudonyms(key, reveal)
    text, taken = quoted(text_col), list(docs.columns)
    pieces, hits = fresh(taken, "pii_pieces"), fresh(taken, "pii_hits")
    has = text.rlike("[0-9@]")
    found = docs.withColumn(hits, F.when(has, F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))))
    found = found.withColumn(
        pieces, F.when(F.size(quoted(hits)) > 0, F.split(text, CANDIDATE, -1))
    ).withColumn(hits, F.transform(quoted(hits), names.kind_and_name))
    pairs = F.zip_with(
        quoted(pieces), quoted(hits), lambda piece, hit: F.concat(piece, F.coalesce(hit["name"], F.lit("")))
    )
    out = found.withColumn(text_col, F.when(F.size(quoted(hits)) > 0, F.array_join(pairs, "")).otherwise(text))
    if counts_col:
        kinds = F.filter(F.transform(quoted(hits), lambda h: h["kind"]), lambda k: k.isNotNull())
        each = F.transform(
            F.array_sort(F.array_distinct(kinds)),
            lambda k: F.concat(k, F.lit(":"), F.size(F.filter(kinds, lambda x: x == k)).cast("string")),
        )
        out = out.withColumn(counts_col, F.coalesce(F.array_join(each, ","), F.lit("")))
    return out.drop(pieces, hits)
