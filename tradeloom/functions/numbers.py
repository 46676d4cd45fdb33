"""Loosely typed text to numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A failed try_cast costs an exception per row, so text is tested by pattern first.
INTEGER_TEXT = r"^[+-]?[0-9]+$"
#: a whole number between any white space or control characters of ASCII, as a cast takes it
INTEGER_CAST_TEXT = r"^[\x00-\x20\x7f]*[+-]?[0-9]+[\x00-\x20\x7f]*$"
NUMBER_TEXT = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
PLAIN_NUMBER_TEXT = r"^-?[0-9]+(\.[0-9]+)?$"
NBSP = "\u00a0"
# What counts as white space at the ends of a text.
WHITE_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(text: Column) -> Column:
    """Text without white space at its ends: the ASCII kinds, U+0085, U+00A0 and the wide spaces.

    ``btrim`` searches the kinds once for each end; a text whose ends are visible ASCII is told
    by four comparisons and stays as it is.
    """
    last = F.substring(text, -1, 1)
    bare = (text >= "!") & (text < "\x7f") & (last >= "!") & (last < "\x7f")
    return F.when(bare, text).otherwise(F.btrim(text, F.lit(WHITE_SPACE)))


def replaced(text: Column, pairs: dict[str, str]) -> Column:
    """Text with every key replaced by its value; a text without them is only searched."""
    for old, new in pairs.items():
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def clean_number_text(value: Column | str, nbsp: bool = False) -> Column:
    """Drop spaces (and U+00A0 when asked) and turn a decimal comma into a dot."""
    return strip(replaced(as_column(value).cast("string"), {" ": "", **({NBSP: ""} if nbsp else {}), ",": "."}))


def parse_int_strict(value: Column | str) -> Column:
    """Whole-number text to BIGINT; anything else is null."""
    text = strip(as_column(value).cast("string"))
    return F.when(text.rlike(INTEGER_TEXT), text.try_cast("bigint"))


def json_integer(value: Column) -> Column:
    """A JSON value (VARIANT) to BIGINT: numbers lose their fraction, text must be a whole number, true is 1.

    Text is told by its JSON type and tested by pattern, as ``try_variant_get`` would throw for each bad one.
    """
    text = F.try_variant_get(value, "$", "string")
    of_text = F.when(text.rlike(INTEGER_CAST_TEXT), text.try_cast("bigint")).otherwise(parse_int_strict(text))
    return F.when(F.schema_of_variant(value) == "STRING", of_text).otherwise(F.try_variant_get(value, "$", "bigint"))


def json_number(value: Column) -> Column:
    """The number of a JSON number, null for every other kind of JSON value."""
    return F.when(F.schema_of_variant(value).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), F.try_variant_get(value, "$", "double"))


def parse_int_lenient_null(value: Column | str) -> Column:
    """Number text truncated towards zero; bad text is null."""
    text = clean_number_text(value)
    return F.when(text.rlike(NUMBER_TEXT), text.try_cast("decimal(38,10)").try_cast("bigint"))


def parse_int_lenient(value: Column | str) -> Column:
    """As :func:`parse_int_lenient_null`, with 0 for bad text."""
    return F.coalesce(parse_int_lenient_null(value), F.lit(0).cast("bigint"))


def parse_number(
    value: Column | str,
    precision: int = 18,
    scale: int = 2,
    default: str | None = None,
    nbsp: bool = False,
) -> Column:
    """Number text with spaces and a decimal comma to DECIMAL(precision, scale)."""
    text = clean_number_text(value, nbsp=nbsp)
    number = F.when(text.rlike(NUMBER_TEXT), text.try_cast(f"decimal({precision},{scale})"))
    if default is None:
        return number
    return F.coalesce(number, F.lit(default).cast(f"decimal({precision},{scale})"))


def numeric_cell(value: Column | str, strict: bool = False) -> Column:
    """Cell text to DECIMAL(18,4); ``strict`` accepts plain digits and one dot only."""
    if strict:
        text = F.translate(as_column(value).cast("string"), ",", ".")
        return F.when(text.rlike(PLAIN_NUMBER_TEXT), text.try_cast("decimal(18,4)"))
    return parse_number(value, 18, 4)


def report_number(value: Column | str, scale: int = 2) -> Column:
    """Report text without any white space to DECIMAL; unreadable text counts as 0."""
    text = F.translate(as_column(value), ", \t\n\u000b\f\r", ".")
    number = F.when(text.rlike(PLAIN_NUMBER_TEXT), text.try_cast(f"decimal(18,{scale})"))
    return F.coalesce(number, F.lit(0).cast(f"decimal(18,{scale})"))


def price_amount(value: Column | str, default: str | None = "0") -> Column:
    """Amount of a price given either as ``{"amount": ..}`` text or as a scalar."""
    raw = as_column(value)
    amount = F.when(raw.startswith("{"), F.get_json_object(raw, "$.amount")).otherwise(raw)
    return parse_number(amount, 18, 2, default=default)


def price_currency(value: Column | str, fallback: Column | str | None = None) -> Column:
    """Currency inside a price object, else the fallback, else null."""
    raw = as_column(value)
    inner = F.when(raw.startswith("{"), F.get_json_object(raw, "$.currency"))
    parts = [F.nullif(inner, F.lit(""))]
    if fallback is not None:
        parts.append(F.nullif(as_column(fallback), F.lit("")))
    return F.coalesce(*parts)


def half_up_int(value: Column | str) -> Column:
    """Decimal to INT, rounding halves away from zero."""
    return F.round(as_column(value), 0).cast("int")


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient as DOUBLE, null when the denominator is 0 or null."""
    return F.try_divide(as_column(numerator).cast("double"), as_column(denominator).cast("double"))
