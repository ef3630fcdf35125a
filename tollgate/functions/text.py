"""Text predicates and parsers as column expressions: what Python's strip, int and float accept, kept inside code generation.

Nothing here depends on the session's time zone: timestamps are parsed and compared without one.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Texts that count as null, a fixed value of contracts.
NULLS = ("", "NA", "N/A", "null", "NULL", "None")
#: All Unicode white space, and the ASCII separators that Python's strip takes off too.
SPACES = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
INTEGER = r"^[+-]?[0-9](?:_?[0-9])*$"
NUMBER = r"^[+-]?(?:[0-9](?:_?[0-9])*(?:\.(?:[0-9](?:_?[0-9])*)?)?|\.[0-9](?:_?[0-9])*)(?:[eE][+-]?[0-9](?:_?[0-9])*)?$"
SPECIAL = r"(?i)^[+-]?(?:inf|infinity|nan)$"
_CLOCK = r"[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}"
_DAY = r"(?!0000)[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"
FRACTIONAL = rf"^{_DAY}[Tt]{_CLOCK}\.[0-9]{{1,6}}$"
TIMESTAMP = rf"^{_DAY}(?:[Tt]{_CLOCK}(?:\.[0-9]{{1,6}})?|\s+{_CLOCK})$"


def stripped(c: Column) -> Column:
    """Without any Unicode white space around."""
    return F.trim(c, F.lit(SPACES))


def null_text(s: Column) -> Column:
    """Of a stripped text: null, or a text that stands for it."""
    return s.isNull() | s.isin(*NULLS)


def is_null(c: Column) -> Column:
    """Null, or a text that stands for it."""
    return null_text(stripped(c))


def is_integer(c: Column) -> Column:
    return stripped(c).rlike(INTEGER)


def number_of(s: Column) -> Column:
    """Of a stripped text: a double where it is a number, not-a-number and infinity among them; else null."""
    plain = F.replace(s, F.lit("_"), F.lit(""))
    return F.when(s.rlike(NUMBER), plain.try_cast("double")).when(s.rlike(SPECIAL), F.regexp_replace(F.lower(s), "^[+-](?=nan)", "").try_cast("double"))


def number(c: Column) -> Column:
    return number_of(stripped(c))


def timestamp_of(s: Column) -> Column:
    """Of a stripped text: a timestamp without a zone from ``T`` with or without a fraction, or a space; a date alone is none."""
    return F.when(s.rlike(TIMESTAMP), F.upper(F.regexp_replace(s, r"\s+", " ")).try_cast("timestamp_ntz"))


def timestamp(c: Column) -> Column:
    return timestamp_of(stripped(c))


def fractional_timestamp(c: Column) -> Column:
    """Only the shape with ``T`` and a fraction, nothing around it."""
    return F.when(c.rlike(FRACTIONAL), F.upper(c).try_cast("timestamp_ntz"))


def plain_double(c: Column) -> Column:
    """What a cast of a text gives: a number with ASCII white space around it; null where it fails."""
    return number_of(F.trim(c, F.lit("\t\n\x0b\x0c\r ")))


def starts_matching(c: Column, pattern: str) -> Column:
    """The pattern matches at the beginning of the stripped text."""
    return stripped(c).rlike(f"^(?:{pattern})")


def _days(start: Column, end: Column) -> Column:
    return F.datediff(end.cast("date"), start.cast("date")).cast("long")


def hours_between(start: Column, end: Column) -> Column:
    """Minute boundaries crossed between two timestamps without a zone, in hours."""
    minutes = lambda c: F.hour(c) * 60 + F.minute(c)
    return (_days(start, end) * 1440 + minutes(end) - minutes(start)).cast("double") / F.lit(60.0)


def exact_hours(start: Column, end: Column) -> Column:
    """Hours between two timestamps without a zone, to the microsecond."""
    micros = lambda c: (F.hour(c) * 3600 + F.minute(c) * 60).cast("long") * 1_000_000 + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long")
    return (_days(start, end) * 86_400_000_000 + micros(end) - micros(start)).cast("double") / F.lit(3.6e9)


def rounded(c: Column) -> Column:
    """Two decimals of a number that isn't negative, half of the binary value up."""
    return F.floor(c * F.lit(100.0) + F.lit(0.5)).cast("double") / F.lit(100.0)
