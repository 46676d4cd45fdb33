"""JSON text access, canonical text and fingerprints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradeloom.functions.numbers import as_column


def json_text(value: Column | str, path: str) -> Column:
    return F.get_json_object(as_column(value), path)


def json_array(value: Column | str, path: str) -> Column:
    """Array at ``path`` as an array of JSON texts; anything else is an empty array."""
    raw = F.get_json_object(as_column(value), path)
    parsed = F.when(raw.startswith("["), F.from_json(raw, "array<string>"))
    return F.coalesce(parsed, F.array().cast("array<string>"))


def json_array_size(value: Column | str, path: str) -> Column:
    raw = F.get_json_object(as_column(value), path)
    return F.coalesce(F.when(raw.startswith("["), F.json_array_length(raw)), F.lit(0))


def canonical_json(value: Column | str) -> Column:
    """Key-sorted text of a JSON value; text that does not parse stays as it is."""
    raw = as_column(value)
    return F.coalesce(F.to_json(F.try_parse_json(raw)), raw)


def payload_sha(value: Column | str) -> Column:
    """SHA-256 of the canonical text, in hex."""
    return F.sha2(canonical_json(value), 256)


def row_hash(position: Column | str, *parts: Column | str) -> Column:
    """SHA-256 over the position of a row and its parts; a null part counts as empty."""
    cells = [F.coalesce(as_column(p).cast("string"), F.lit("")) for p in (position, *parts)]
    return F.sha2(F.concat_ws("\u001f", *cells), 256)
