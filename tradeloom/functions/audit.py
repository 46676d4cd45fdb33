"""Redaction, formula tokens and column classes for audits of published sheets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradeloom.functions.numbers import as_column
from tradeloom.functions.text import contains_any

# Words that mark a cell as secret, and the patterns of secrets in text.
SECRET_MARKERS = ("token", "password", "secret", "api_key", "apikey", "authorization", "private_key")
REDACTED = "***REDACTED***"
WRAPPED_SECRETS = (
    r'(?i)(Authorization\s*=\s*")[^"]+(")',
    r'(?i)("?(?:token|api[_-]?key|password|secret)"?\s*[:=]\s*")[^"]+(")',
)
LEADING_SECRET = r"(?i)(Authorization\s*:\s*)[A-Za-z0-9_.=-]{20,}"
BARE_SECRET = r"eyJ[A-Za-z0-9_-]{20,}\.[A-Za-z0-9_-]{20,}\.[A-Za-z0-9_-]{20,}"

# Patterns of spreadsheet formulas.
FORMULA_FUNCTION = r"(?i)\b([A-Z][A-Z0-9_.]*)\s*\("
IMPORT_SOURCE = r"(?i)IMPORTRANGE\(([^;,)]+)"
SHEET_REFERENCE = r"(?:'([^']+)'|([A-Za-zА-Яа-яЁё0-9_ ]+))!"

# Headers of each column class.
PRODUCT_HEADERS = (
    "сцепка", "серия", "артикул", "наименование", "арт наш", "арт wb", "арт вб", "арт ozon", "арт озон",
)
PRODUCTION_HEADERS = (
    "смп", "осн", "сох", "свх", "тс", "план в минске", "согл заказа", "в произв", "готов", "в пути",
)
SUPPLY_HEADERS = ("поставлено с 01.05", "поставлено с 01.06", "склад", "кластер")
CURRENT_HEADERS = (
    "доступный остаток", "остаток", "остаток не чз", "товары в пути", "тек цена", "тек wb", "тек ozon",
    "тек маржа, %", "тек дрр на артикул маржа, %", "тек дрр на сцепку маржа, %",
)
AD_HEADERS = (
    "дрр", "ads прош", "ads тек", "ads 28к/д", "расход на арт", "заказы на арт", "расход на сцепку",
    "заказы на сцепку", "дрр сцепки", "затраты, rub", "стоимость", "затраты",
)
ECONOMY_MARKERS = ("маржа", "разница", "участие в акции")
DATE_HEADER = r"^=|^[0-9]{4,5}$"


def is_secret(value: Column | str) -> Column:
    text = F.lower(F.coalesce(as_column(value).cast("string"), F.lit("")))
    return contains_any(text, SECRET_MARKERS)


def redact_cell(value: Column | str) -> Column:
    """Whole cell masked when it holds a secret marker."""
    raw = as_column(value)
    return F.when(is_secret(raw), F.lit(REDACTED)).otherwise(raw)


def redact_text(value: Column | str) -> Column:
    """Secrets inside text masked, the rest kept."""
    text = as_column(value)
    for pattern in WRAPPED_SECRETS:
        text = F.regexp_replace(text, pattern, "$1***REDACTED***$2")
    text = F.regexp_replace(text, LEADING_SECRET, "$1***REDACTED***")
    return F.regexp_replace(text, BARE_SECRET, REDACTED)


def is_formula(value: Column | str) -> Column:
    return F.coalesce(as_column(value).startswith("="), F.lit(False))


def formula_functions(formula: Column | str) -> Column:
    """Sorted distinct function names of a formula, upper case."""
    names = F.regexp_extract_all(as_column(formula), F.lit(FORMULA_FUNCTION), F.lit(1))
    return F.array_sort(F.array_distinct(F.transform(names, lambda n: F.upper(n))))


def sheet_references(formula: Column | str) -> Column:
    """Sorted distinct sheet names a formula refers to."""
    text = as_column(formula)
    quoted = F.regexp_extract_all(text, F.lit(SHEET_REFERENCE), F.lit(1))
    bare = F.regexp_extract_all(text, F.lit(SHEET_REFERENCE), F.lit(2))
    names = F.zip_with(quoted, bare, lambda q, b: F.trim(F.when(q != "", q).otherwise(b)))
    return F.array_sort(F.array_distinct(F.filter(names, lambda n: n != "")))


def import_sources(formula: Column | str) -> Column:
    """Sorted distinct first arguments of cross-document imports."""
    found = F.regexp_extract_all(as_column(formula), F.lit(IMPORT_SOURCE), F.lit(1))
    names = F.transform(found, lambda s: F.btrim(F.trim(s), F.lit('"')))
    return F.array_sort(F.array_distinct(names))


def classify_column(sheet: Column | str, header: Column | str, functions: Column) -> Column:
    """Class of a report column from its sheet, header and formula functions."""
    name = F.lower(F.trim(F.coalesce(as_column(header).cast("string"), F.lit(""))))
    place = F.lower(F.trim(F.coalesce(as_column(sheet).cast("string"), F.lit(""))))
    used = F.coalesce(functions, F.array().cast("array<string>"))

    def uses(function: str) -> Column:
        return F.array_contains(used, function)

    daily_sheet = contains_any(place, ("аналитика wb", "аналитика ozon"))
    return (
        F.when(name.isin(*PRODUCT_HEADERS), "product_identity")
        .when(name.isin(*PRODUCTION_HEADERS), "production_inventory")
        .when(name.isin(*SUPPLY_HEADERS), "supply_stock_chz")
        .when(name.isin(*CURRENT_HEADERS), "current_marketplace_metrics")
        .when(
            name.isin(*AD_HEADERS) | name.contains("дрр") | place.contains("реклама"),
            "advertising_metrics",
        )
        .when(contains_any(name, ECONOMY_MARKERS), "unit_economy_or_price")
        .when(name.rlike(DATE_HEADER) | (uses("SUMIFS") & daily_sheet), "daily_time_series")
        .when(uses("IMPORTRANGE"), "external_sheet_lookup")
        .when(uses("XLOOKUP") | uses("VLOOKUP"), "lookup_enrichment")
        .otherwise("other_formula")
    )


def _first_marker(text: Column, rules: Sequence[tuple[str, str]], other: str) -> Column:
    result = F.lit(other)
    for marker, label in reversed(rules):
        result = F.when(text.contains(marker), F.lit(label)).otherwise(result)
    return result


def query_marketplace(name: Column | str) -> Column:
    text = F.lower(as_column(name))
    return _first_marker(text, [("wb", "wb"), ("ozon", "ozon"), ("ym", "yandex_market")], "internal")


def query_subject(name: Column | str) -> Column:
    text = F.lower(as_column(name))
    rules = [
        ("заказы", "orders"),
        ("остатки", "stocks"),
        ("хранение", "storage_costs"),
        ("список заказов", "supply_pipeline"),
    ]
    return _first_marker(text, rules, "other")
