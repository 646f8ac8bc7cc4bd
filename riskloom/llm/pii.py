"""Pseudonyms for personal data that keep the format and link equal values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.texts import bound

#: Feistel rounds. Each changes one half by a keyed function of the other.
ROUNDS = 10
#: The session setting that holds the key. There is no key in the source: whoever knows it can undo the pseudonyms.
KEY_SETTING = "spark.riskloom.pseudonyms.key"

# What may be personal data. Alternatives are tried in this order at each place.
# Borders are fixed: no letter, digit or sign that would make it part of more. No group is repeated without
# bound, since each repetition takes a place on the matcher's stack; a domain has at most 127 labels.
KINDS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+){0,125}\.[A-Za-z]{2,}",
    "ip": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])",
    "date": r"(?<![0-9./-])(?:[0-9]{4}([-/.])[0-9]{2}\1[0-9]{2}|[0-9]{2}([-/.])[0-9]{2}\2[0-9]{4})(?![0-9]|[./-][0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    "phone": r"(?<![0-9+(])(?:\+?1[ .-]?)?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9]|[.-][0-9])",
}


def _card_layouts() -> str:
    """Card numbers as they are written; no layout takes digits of a value of another kind next to it.

    13 to 19 digits without a break; 4-6-5 and 4-6-4; four or more groups of
    four, since cards and other numbers of four digits may follow each other,
    with three digits behind (4-4-4-4-3). The separator is one throughout.
    """
    four = r"[0-9]{4}(?![0-9]|[./-][0-9]{2}[./-][0-9]{2}(?![0-9]))"
    three = r"[0-9]{3}(?![0-9]|[.-][0-9]| [0-9]{3}[ .-][0-9]{4}(?![0-9]))"
    layouts = ["[0-9]{13,19}(?![0-9])"]
    for between in " -":
        rest = f"{between}[0-9]{{6}}{between}[0-9]{{4,5}}(?![0-9])"
        one = four + "(?!-[0-9]{4}-)" if between == " " else four
        layouts += [f"[0-9]{{4}}{rest}", f"{one}(?:{between}{one}){{3}}(?:{between}{one}(?!{rest}))*+(?:{between}{three})?"]
    return f"(?<![0-9])(?:{'|'.join(layouts)})"


KINDS["card"] = _card_layouts()


def feistel(left: Column, right: Column, left_size: Column, right_size: Column, key: Column) -> Column:
    """A keyed permutation of the pairs (0..left_size-1, 0..right_size-1), as a struct ``l, r``.

    In turn each half is moved, within its size, by a keyed hash of the other
    half. Every round can be undone, so no two pairs meet, whatever the sizes.
    """
    def moved(half: Column, other: Column, size: Column, turn: Column) -> Column:
        digest = F.sha2(F.concat_ws("|", key, turn.cast("string"), size.cast("string"), other.cast("string")), 256)
        return F.pmod(half + F.conv(F.substring(digest, 1, 14), 16, 10).cast("bigint"), size)

    start = F.struct(left.cast("bigint").alias("l"), right.cast("bigint").alias("r"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, lambda pair, turn: F.when(
        turn % 2 == 1, F.struct(moved(pair["l"], pair["r"], left_size, turn).alias("l"), pair["r"].alias("r")))
        .otherwise(F.struct(pair["l"].alias("l"), moved(pair["r"], pair["l"], right_size, turn).alias("r"))))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _padded(number: Column, width: Column | int) -> Column:
    return F.lpad(number.cast("string"), width if isinstance(width, Column) else F.lit(width), F.lit("0"))


def refilled(layout: Column, digits: Column) -> Column:
    """``layout`` with its digits replaced, in order, by ``digits``; everything else stays in its place."""
    def filled(own: Column, new: Column) -> Column:
        letters = F.filter(F.split(own, ""), lambda c: c != "")
        return F.array_join(F.transform(letters, lambda c, i: F.when(c.rlike("[0-9]"), F.substr(
            new, F.length(_digits(F.substr(own, F.lit(1), i + 1))), F.lit(1))).otherwise(c)), "")

    return bound(layout, lambda own: bound(digits, lambda new: filled(own, new)))


def _luhn_sum(digits: Column) -> Column:
    """Sum of the digits, every second one from the right doubled."""
    places = F.sequence(F.lit(1), F.length(digits))
    return F.aggregate(places, F.lit(0), lambda total, i: total + _luhn_share(
        F.substr(F.reverse(digits), i, F.lit(1)).cast("int"), i % 2 == 0))


def _luhn_share(digit: Column, doubled: Column) -> Column:
    twice = digit * 2
    return F.when(doubled, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(digit)


def _power(exponent: Column) -> Column:
    return F.rpad(F.lit("1"), (exponent + 1).cast("int"), F.lit("0")).cast("bigint")


def _is_card(digits: Column) -> Column:
    return (_luhn_sum(digits) % 10 == 0) & ~digits.rlike("^0+$")


def card_pseudonym(text: Column, key: Column) -> Column:
    """Numbers of 13 to 19 digits with a right check digit: the others permuted, the check digit made anew.

    Groups of four are read from the left: sixteen digits that are a card, or
    nineteen at the end, are replaced as one; a group that starts none stays.
    All starts are tested first and chosen by one search over their signs, so
    the time is linear in the number of groups.
    """
    def permuted(digits: Column) -> Column:
        size = F.length(digits) - 1
        half = F.floor(size / 2).cast("int")
        return bound(feistel(F.substr(digits, F.lit(1), half), F.substr(digits, half + 1, size - half),
                              _power(half), _power(size - half), F.concat(key, F.lit("card"))),
                      lambda p: bound(F.concat(_padded(p["l"], half), _padded(p["r"], size - half)),
                                       lambda body: F.concat(body, F.pmod(
                                           -_luhn_sum(F.concat(body, F.lit("0"))), F.lit(10)).cast("string"))))

    def made(value: Column) -> Column:
        return bound(_digits(value), lambda digits: refilled(value, permuted(digits)))

    def joined(parts: Column, start: Column, groups: int, between: Column) -> Column:
        return F.call_function("array_join", F.slice(parts, start + 1, groups), between)

    def marked(parts: Column, fours: Column) -> Column:
        """A sign per group: 1 and 2 where a card of sixteen or nineteen digits starts, x where one goes on, else 0."""
        def flag(i: Column) -> Column:
            sixteen = bound(joined(parts, i, 4, F.lit("")), _is_card)
            nineteen = (i + 5 == F.size(parts)) & (fours < F.size(parts)) & bound(joined(parts, i, 5, F.lit("")), _is_card)
            return F.when(i + 4 > fours, F.lit("0")).when(sixteen, F.lit("1")).when(nineteen, F.lit("2")).otherwise(F.lit("0"))

        flags = F.array_join(F.transform(F.sequence(F.lit(0), fours - 1), flag), "")
        # The search finds the first start from the left and goes on behind its four groups.
        return F.split(F.regexp_replace(flags, "([12])[012]{3}", "$1xxx"), "")

    def rebuilt(parts: Column, fours: Column, marks: Column, between: Column) -> Column:
        def piece(i: Column) -> Column:
            mark = F.get(marks, i)
            behind = (i == fours) & (F.get(marks, fours - 4) == "2")
            return F.when(behind | (mark == "x"), F.lit(None).cast("string")).when(
                (i < fours) & (mark == "1"), made(joined(parts, i, 4, between))).when(
                (i < fours) & (mark == "2"), made(joined(parts, i, 5, between))).otherwise(F.get(parts, i))

        return F.call_function("array_join", F.transform(F.sequence(F.lit(0), F.size(parts) - 1), piece), between)

    between = F.substring(text, 5, 1)
    in_fours = bound(F.split(text, "[ -]"), lambda parts: bound(
        F.size(parts) - (F.length(F.element_at(parts, -1)) < 4).cast("int"), lambda fours: bound(
            marked(parts, fours), lambda marks: rebuilt(parts, fours, marks, between))))
    alone = F.when(_is_card(_digits(text)), made(text)).otherwise(text)
    return F.when(text.rlike("^[0-9]{4}[ -][0-9]{4}[ -]"), in_fours).otherwise(alone)


def ip_pseudonym(text: Column, key: Column) -> Column:
    """Four numbers up to 255: the address permuted among all addresses."""
    def permuted(parts: Column) -> Column:
        n = [F.get(parts, i).cast("int") for i in range(4)]
        size = F.lit(65536).cast("bigint")
        return bound(feistel(n[0] * 256 + n[1], n[2] * 256 + n[3], size, size, F.concat(key, F.lit("ip"))),
                      lambda p: F.concat_ws(".", *(F.floor(p[h] / 256).cast("string") if high else (p[h] % 256).cast("string")
                                                   for h in "lr" for high in (True, False))))

    return bound(F.split(text, r"\."), lambda parts: F.when(
        F.forall(parts, lambda part: part.cast("int") <= 255), permuted(parts)).otherwise(text))


def phone_pseudonym(text: Column, key: Column) -> Column:
    """The last ten digits permuted, area codes from 200 and those below among themselves; the rest stays."""
    def permuted(digits: Column) -> Column:
        area = F.substr(F.right(digits, F.lit(10)), F.lit(1), F.lit(3)).cast("int")
        line = F.right(digits, F.lit(7)).cast("bigint")
        first = F.when(area < 200, 0).otherwise(200)
        areas = F.when(area < 200, 200).otherwise(800).cast("bigint")
        mixed = feistel(area - first, line, areas, F.lit(10_000_000).cast("bigint"), F.concat(key, F.lit("phone")))
        return bound(mixed, lambda p: F.concat(F.substr(digits, F.lit(1), F.length(digits) - 10),
                                                _padded(p["l"] + first, 3), _padded(p["r"], 7)))

    return bound(_digits(text), lambda digits: refilled(text, permuted(digits)))


def ssn_pseudonym(text: Column, key: Column) -> Column:
    """Area 001 to 899 without 666, group and serial not zero: permuted among such numbers."""
    area, group, serial = (F.substring(text, at, size).cast("int") for at, size in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    left = F.when(area < 666, area - 1).otherwise(area - 2)
    mixed = feistel(left, (group - 1) * 9999 + serial - 1, F.lit(898).cast("bigint"), F.lit(99 * 9999).cast("bigint"),
                    F.concat(key, F.lit("ssn")))
    made = bound(mixed, lambda p: F.concat_ws(
        "-", _padded(F.when(p["l"] < 665, p["l"] + 1).otherwise(p["l"] + 2), 3),
        _padded(F.floor(p["r"] / 9999) + 1, 2), _padded(p["r"] % 9999 + 1, 4)))
    return F.when(valid, made).otherwise(text)


def date_pseudonym(text: Column, key: Column) -> Column:
    """Days from 1700-01-01 to 2099-12-31, permuted among each other and written the same way.

    These 400 years are 146,097 = 27 x 5,411 days. A day is read as year,
    month, day or as day, month, year, or else as month, day, year.
    """
    def permuted(iso: Column) -> Column:
        day = F.datediff(F.to_date(iso), F.lit("1700-01-01").cast("date"))
        mixed = feistel(F.floor(day / 5411), day % 5411, F.lit(27).cast("bigint"), F.lit(5411).cast("bigint"),
                        F.concat(key, F.lit("date")))
        return bound(mixed, lambda p: F.date_add(F.lit("1700-01-01").cast("date"), (p["l"] * 5411 + p["r"]).cast("int")))

    def iso(year: int, month: int, day: int) -> Column:
        return F.concat_ws("-", F.substring(text, year, 4), F.substring(text, month, 2), F.substring(text, day, 2))

    def written(made: Column, layout: str) -> Column:
        return refilled(text, F.date_format(made, layout))

    def valid(day: Column) -> Column:
        return F.try_to_timestamp(day, F.lit("yyyy-MM-dd")).isNotNull() & F.substring(day, 1, 4).between("1700", "2099")

    forms = ((r"^[0-9]{4}", iso(1, 6, 9), "yyyyMMdd"), (r"^[0-9]{2}[^0-9]", iso(7, 4, 1), "ddMMyyyy"),
             (r"^[0-9]{2}[^0-9]", iso(7, 1, 4), "MMddyyyy"))
    out = text
    for shape, day, layout in reversed(forms):
        out = F.when(text.rlike(shape) & valid(day), written(permuted(day), layout)).otherwise(out)
    return out


def email_pseudonym(text: Column, key: Column) -> Column:
    """A keyed name at a domain that cannot exist: an address has no numeric domain to permute."""
    return F.concat(F.lit("u"), F.substring(F.sha2(F.concat_ws("|", key, F.lit("email"), F.lower(text)), 256), 1, 20),
                    F.lit("@mail.invalid"))


_PSEUDONYMS = {"email": email_pseudonym, "ip": ip_pseudonym, "date": date_pseudonym, "ssn": ssn_pseudonym,
               "phone": phone_pseudonym, "card": card_pseudonym}


def _combined() -> str:
    """All kinds in one pattern. Only the dates have groups, so their back references keep their numbers."""
    return "|".join(f"(?:{pattern})" for pattern in KINDS.values())


def pseudonymised(text: Column, key: Column) -> Column:
    """The text with every valid value replaced; texts without digit or ``@`` are passed through.

    The pattern cuts the text into values and what lies between; both are
    found by the same search, so they fit together again.
    """
    pattern = _combined()

    def replaced(value: Column) -> Column:
        out = value
        for kind in reversed(KINDS):
            out = F.when(value.rlike(f"^(?:{KINDS[kind]})$"), _PSEUDONYMS[kind](value, key)).otherwise(out)
        return out

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    whole = F.array_join(F.zip_with(between, found, lambda gap, value: F.concat(
        gap, F.when(value.isNull(), F.lit("")).otherwise(replaced(value)))), "")
    return F.when(text.rlike("[0-9@]"), whole).otherwise(text)


def configured_key(spark: SparkSession, default: str | None = None) -> str:
    """The key of the session's setting; without one ``default``, and without that an error."""
    key = spark.conf.get(KEY_SETTING, default)
    if not key:
        raise ValueError(f"set {KEY_SETTING} or give a key: pseudonyms need a secret one")
    return key


def pseudonymise(docs: DataFrame, key: str | None = None, text_col: str = "text") -> DataFrame:
    """``docs`` with the values in its text replaced, all other columns as they are; ``key`` comes from the session if not given.

    Card numbers (check digit), addresses of the internet protocol, calendar
    dates, telephone and social-security numbers are permuted by key within
    their format, e-mail addresses get keyed names: equal values have equal
    pseudonyms in all documents, different ones different pseudonyms. Values
    that fail validation stay. A null text stays null, an empty one empty;
    rows are independent of each other, so order, ties, repeats and an empty
    table need no rule. Nothing is shuffled.
    """
    return docs.withColumn(text_col, pseudonymised(F.col(text_col), F.lit(key or configured_key(docs.sparkSession))))
