"""Keys, identifiers, dates, amounts: Column in, Column out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space that keys drop. Java's \s has neither the ideographic nor the no-break space.
SPACES = "[\\s　 ]+"


def squeeze(x: Column) -> Column:
    """x without any white space."""
    return F.regexp_replace(x, SPACES, "")


def match_key(x: Column) -> Column:
    """The form in which names match: no white space, lower case; null if nothing is left."""
    return F.nullif(F.lower(squeeze(x)), F.lit(""))


def blank_to_null(x: Column) -> Column:
    return F.when(squeeze(x) != "", x)


def captured(x: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match, null where there is none."""
    return F.nullif(F.regexp_extract(x, pattern, group), F.lit(""))


def two_digit_suffix(x: Column) -> Column:
    return captured(x, "([0-9]{2})$")


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def extension(path: Column) -> Column:
    """Lower case, without the dot; null if there is none."""
    return F.lower(captured(file_name(path), r"\.([^.]+)$"))


def answer_letters(x: Column) -> Column:
    """The capital letters that end a paragraph, as a sorted set; empty if there are none."""
    found = F.regexp_extract(x, r"([A-Z]+)\s*$", 1)
    return F.array_sort(F.array_distinct(F.filter(F.split(found, ""), lambda c: c != "")))


def compact_date(x: Column) -> Column:
    """yyyyMMdd to a date, null if it is none."""
    return F.when(x.rlike("^[0-9]{8}$"), F.to_date(F.try_to_timestamp(x, F.lit("yyyyMMdd"))))


def month_day(x: Column, year: int) -> Column:
    """MMdd of a given year to a date."""
    return compact_date(F.concat(F.lit(f"{year:04d}"), x))


def period(x: Column) -> Column:
    """The first two dates of a text (2024-01-31, 2024/1/31, 2024.1.31) as struct<start, end, open_ended>."""
    one = "([0-9]{4})[-/.]([0-9]{1,2})[-/.]([0-9]{1,2})"
    start, end = _date(x, one, 0), _date(x, one, 1)
    return F.struct(start.alias("start"), end.alias("end"), (start.isNotNull() & end.isNull()).alias("open_ended"))


def _date(x: Column, one: str, k: int) -> Column:
    """The k-th date of the text, null if it is missing or no day of the calendar."""
    found = F.get(F.regexp_extract_all(x, F.lit(f"({one})"), F.lit(1)), F.lit(k))
    parts = F.split(found, "[-/.]")
    padded = F.concat(parts[0], F.lpad(parts[1], 2, "0"), F.lpad(parts[2], 2, "0"))
    return compact_date(padded)


def in_units(amount: Column, unit: Column, factors: dict[str, int]) -> Column:
    """amount in base units as decimal(28,6); null for a unit that isn't known."""
    table = F.create_map(*(F.lit(v) for kv in factors.items() for v in kv))
    return (amount.cast("decimal(18,6)") * F.try_element_at(table, unit).cast("decimal(9,0)")).cast("decimal(28,6)")


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as double, null where whole is zero or blank."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def flipped(amount: Column, direction: Column, outgoing: list[str]) -> Column:
    """amount with the sign that its direction asks for; which directions are outgoing is configuration."""
    return F.when(direction.isin(outgoing), -amount).otherwise(amount)


def column_number(letters: Column) -> Column:
    """A is 1, Z 26, AA 27."""
    return F.aggregate(F.split(F.upper(letters), ""), F.lit(0), lambda acc, c: acc * 26 + F.ascii(c) - 64)


def column_letters(number: int) -> str:
    out = ""
    while number:
        number, rest = divmod(number - 1, 26)
        out = chr(65 + rest) + out
    return out


#: Weights and check characters of ISO 7064 MOD 11-2 for 17 digits.
WEIGHTS = (7, 9, 10, 5, 8, 4, 2, 1, 6, 3, 7, 9, 10, 5, 8, 4, 2)
CHECKS = "10X98765432"


def checksum_rest(digits: Column) -> Column:
    """Weighted sum of 17 digits modulo 11."""
    numbers = F.transform(F.split(F.substring(digits, 1, 17), ""), lambda c: c.cast("int"))
    products = F.zip_with(numbers, F.array(*map(F.lit, WEIGHTS)), lambda a, w: a * w)
    return F.aggregate(products, F.lit(0), lambda acc, v: acc + v) % 11


def id_valid(x: Column) -> Column:
    """Whether an 18-character id number has the right check character; null stays null."""
    rest = checksum_rest(x)
    expected = F.element_at(F.array(*map(F.lit, CHECKS)), rest + 1)
    good = F.upper(F.substring(x, 18, 1)) == expected
    return F.when(x.isNull(), None).when(~x.rlike("^[0-9]{17}[0-9Xx]$"), False).otherwise(good)


def rotated(rotation: Column, by: int) -> Column:
    return F.pmod(rotation + F.lit(by), F.lit(360))


def even_pages(pages: Column, when: Column) -> Column:
    """pages padded to an even number where duplex printing asks for it."""
    return F.when(when, pages + pages % 2).otherwise(pages)


def business_name(*parts: Column, ext: str) -> Column:
    """Parts joined by '-', blanks left out, with an extension."""
    return F.concat(F.concat_ws("-", *parts), F.lit(f".{ext}"))
