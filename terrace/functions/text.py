"""Text helpers: column names on the driver, column values as Spark expressions."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def snake_name(name: str) -> str:
    """Accent-free lower snake case; a leading underscore marks a technical column and stays."""
    decomposed = unicodedata.normalize("NFKD", name)
    plain = "".join(ch for ch in decomposed if not unicodedata.combining(ch))
    body = re.sub(r"[\W_]+", "_", plain.strip().lower()).strip("_")
    if not body:
        raise ValueError(f"column name {name!r} has no letter or digit")
    return f"_{body}" if name.startswith("_") else body


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def contains_text(text: Column, query: str) -> Column:
    """Case-insensitive substring test; ``%`` and ``_`` in the query are plain characters."""
    return F.lower(text).contains(F.lower(F.lit(query)))


def contains_any_form(text: Column, query: str) -> Column:
    """Substring test that also ignores accents: "São" is found for "sao"."""
    return F.collate(text, "UNICODE_CI_AI").contains(F.collate(F.lit(query), "UNICODE_CI_AI"))


def place_label(name: Column, state: Column) -> Column:
    return F.concat(name, F.lit(" ("), state, F.lit(")"))
