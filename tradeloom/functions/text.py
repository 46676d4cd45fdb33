"""Articles, lots, headers, booleans and cell text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradeloom.functions.numbers import NBSP, PLAIN_NUMBER_TEXT, as_column, json_number, replaced, strip

# Cyrillic letters that look like Latin ones in lot codes.
LOT_CYRILLIC = "АВЕКМНОРСТУХавекмнорстух"
LOT_LATIN = "ABEKMHOPCTYXABEKMHOPCTYX"

# sign, digits without leading zeros, fraction without trailing zeros
CELL_NUMBER_PARTS = r"^(-?)0*([0-9]+)(?:\.0*|(\.[0-9]*[1-9])0*)?$"

TRUE_WORDS = ("true", "1", "yes")
FALSE_WORDS = ("false", "0", "no")


def parse_bool_null(value: Column | str) -> Column:
    """true/1/yes, false/0/no, anything else null."""
    text = F.lower(strip(as_column(value).cast("string")))
    return F.when(text.isin(*TRUE_WORDS), F.lit(True)).when(text.isin(*FALSE_WORDS), F.lit(False))


def parse_bool_false(value: Column | str) -> Column:
    """true/1/yes/да are true; everything else, null included, is false."""
    text = F.lower(strip(as_column(value).cast("string")))
    return F.coalesce(text.isin(*TRUE_WORDS, "да"), F.lit(False))


def json_flag(value: Column) -> Column:
    """A JSON value (VARIANT) as a flag: numbers but 0 and filled containers are true, text is read as words."""
    raw = F.try_variant_get(value, "$", "string")
    filled = F.schema_of_variant(value).rlike("^(ARRAY|OBJECT)") & ~raw.isin("[]", "{}")
    return F.coalesce(json_number(value) != 0, filled | parse_bool_false(raw), F.lit(False))


def counts_as_true(value: Column) -> Column:
    """Whether a JSON value (VARIANT) is there and is neither empty text, 0 nor false."""
    raw = F.try_variant_get(value, "$", "string")
    no = F.when(F.schema_of_variant(value) == "BOOLEAN", raw == "false").otherwise((raw == "") | F.coalesce(json_number(value) == 0, F.lit(False)))
    return raw.isNotNull() & ~no


def first_true(*values: Column) -> Column:
    """First JSON value (VARIANT) that counts as true; if there is none, the first that is not null."""
    chosen = F.when(counts_as_true(values[0]), values[0])
    for value in values[1:]:
        chosen = chosen.when(counts_as_true(value), value)
    return chosen.otherwise(F.coalesce(*values))


def blank_to_null(value: Column | str) -> Column:
    text = strip(as_column(value).cast("string"))
    return F.when(text != "", text)


def empty_to_null(value: Column | str) -> Column:
    """Empty text to null without trimming."""
    text = as_column(value).cast("string")
    return F.when(text != "", text)


def text_or_null(values: Column) -> Column:
    """First non-blank element of an array of text, trimmed."""
    trimmed = F.transform(values, lambda v: strip(v))
    return F.get(F.filter(trimmed, lambda v: v.isNotNull() & (v != "")), F.lit(0))


def clean_article(value: Column | str) -> Column:
    """Trim; digits lose leading zeros; a float without fraction becomes its integer text."""
    text = strip(F.coalesce(as_column(value).cast("string"), F.lit("")))
    digits = F.regexp_replace(text, r"^0+(?=[0-9])", "")
    return F.when(text.rlike(r"^[0-9]+$"), digits).otherwise(text)


def clean_article_number(value: Column | str) -> Column:
    """Article held in a numeric column: no fraction means integer text."""
    number = as_column(value).cast("double")
    whole = number == F.floor(number).cast("double")
    return F.coalesce(
        F.when(whole, number.cast("bigint").cast("string")).otherwise(number.cast("string")),
        F.lit(""),
    )


def normalize_lot(value: Column | str) -> Column:
    """Look-alike letters to Latin, upper case, only A-Z and 0-9 kept."""
    text = F.coalesce(as_column(value).cast("string"), F.lit(""))
    latin = F.upper(F.translate(text, LOT_CYRILLIC, LOT_LATIN))
    return F.regexp_replace(latin, "[^A-Z0-9]", "")


def article_or_sku(article: Column | str, sku: Column | str) -> Column:
    return F.coalesce(empty_to_null(article), as_column(sku).cast("string"), F.lit(""))


def norm_header(value: Column | str, fold_yo: bool = False) -> Column:
    """Header text for comparison: trimmed, lower case, U+00A0 as space."""
    text = F.lower(strip(F.coalesce(as_column(value).cast("string"), F.lit(""))))
    return replaced(text, {NBSP: " ", **({"ё": "е"} if fold_yo else {})})


def normalize_cell(value: Column | str) -> Column:
    """Cell text for comparison: numbers by value, everything else trimmed."""
    text = strip(F.coalesce(as_column(value).cast("string"), F.lit("")))
    compact = replaced(text, {" ": "", NBSP: "", ",": "."})
    plain = F.regexp_replace(compact, CELL_NUMBER_PARTS, "$1$2$3")
    return F.when(compact.rlike(PLAIN_NUMBER_TEXT), F.when(plain == "-0", "0").otherwise(plain)).otherwise(text)


def lookup_label(value: Column | str, labels: dict[str, str], missing: str = "-") -> Column:
    """Dictionary label; an unknown value stays as it is, empty becomes ``missing``."""
    raw = as_column(value).cast("string")
    key = F.lower(strip(F.coalesce(raw, F.lit(""))))
    pairs: list[Column] = []
    for code, label in labels.items():
        pairs += [F.lit(code), F.lit(label)]
    found = F.try_element_at(F.create_map(*pairs), key)
    return F.coalesce(found, empty_to_null(raw), F.lit(missing))


def lookup_key(value: Column | str, names: dict[str, str]) -> Column:
    """Case-insensitive dictionary lookup; unknown gives null."""
    key = F.lower(strip(F.coalesce(as_column(value).cast("string"), F.lit(""))))
    pairs: list[Column] = []
    for name, target in names.items():
        pairs += [F.lit(name), F.lit(target)]
    return F.try_element_at(F.create_map(*pairs), key)


def contains_any(text: Column, markers: Sequence[str]) -> Column:
    test = F.lit(False)
    for marker in markers:
        test = test | text.contains(marker)
    return test
