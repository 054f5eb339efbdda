"""Text to typed values. A value that does not parse is NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casefile.functions.text import as_column

# Texts that mean yes.
TRUE_TEXTS = ("y", "yes", "true", "1")

_DECIMAL_TEXT = "^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def yyyymmdd(col: Column | str) -> Column:
    """Eight-digit date text to a date. The ISO cast checks the calendar and is faster than a pattern parser."""
    text = F.trim(as_column(col))
    parts = [F.substring(text, start, size) for start, size in ((1, 4), (5, 2), (7, 2))]
    return F.when(text.rlike("^[0-9]{8}$"), F.concat_ws("-", *parts).try_cast("date"))


def first8_date(col: Column | str, low: int = 19000101, high: int = 21001231) -> Column:
    """First eight digits of any date text, NULL outside [low, high]."""
    digits = F.substring(F.regexp_replace(as_column(col), "[^0-9]", ""), 1, 8)
    return F.when((F.length(digits) == 8) & digits.between(str(low), str(high)), digits)


def date_key(col: Column | str) -> Column:
    """Date to its yyyyMMdd integer."""
    day = as_column(col)
    return (F.year(day) * 10000 + F.month(day) * 100 + F.day(day)).cast("int")


def flag(col: Column | str) -> Column:
    """Yes-text to true; anything else, NULL included, is false."""
    return F.lower(F.trim(F.coalesce(as_column(col), F.lit("")))).isin(*TRUE_TEXTS)


def _with_default(value: Column, default) -> Column:
    return value if default is None else F.coalesce(value, F.lit(default))


# A failing try_cast costs some ten microseconds a value, a pattern a fraction of one, and
# public records are full of blanks and N/A: texts that are no number never reach the cast.
_WHOLE_TEXT = "^[+-]?[0-9]+$"


def _whole(col: Column | str, kind: str) -> Column:
    text = F.trim(as_column(col))
    return F.when(text.rlike(_WHOLE_TEXT), text.try_cast(kind))


def safe_int(col: Column | str, default: int | None = None) -> Column:
    return _with_default(_whole(col, "int"), default)


def safe_long(col: Column | str, default: int | None = None) -> Column:
    return _with_default(_whole(col, "bigint"), default)


def safe_double(col: Column | str, default: float | None = None) -> Column:
    text = F.trim(as_column(col))
    return _with_default(F.when(text.rlike(_DECIMAL_TEXT), text.try_cast("double")), default)


# SQL of the bulk casts; the same conversions as safe_int, safe_long and safe_double.
_CAST = "CASE WHEN trim(`{0}`) RLIKE '{1}' THEN try_cast(trim(`{0}`) AS {2}) END"
_PATTERNS = {"int": _WHOLE_TEXT, "bigint": _WHOLE_TEXT, "double": _DECIMAL_TEXT}


def cast_columns(df: DataFrame, types: dict[str, str], suffix: str | None = None) -> DataFrame:
    """Append a typed copy of every listed column: `<name>_int` or `<name>_decimal` unless a suffix is given."""
    endings = {"int": "int", "bigint": "int", "double": "decimal"}
    typed = [
        f"{_CAST.format(name, _PATTERNS[kind], kind)} AS `{name}_{suffix or endings[kind]}`"
        for name, kind in types.items()
    ]
    return df.selectExpr("*", *typed)
