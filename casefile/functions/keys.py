"""Deterministic keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casefile.functions.text import as_column, normalize_text
from casefile.functions.typing import safe_int

KEY_SEPARATOR = "||"


def vehicle_key(make: Column | str, model: Column | str, year: Column | str) -> Column:
    """Key of an already normalised identity."""
    return F.sha2(
        F.concat_ws(KEY_SEPARATOR, as_column(make), as_column(model), as_column(year).cast("string")), 256
    )


def record_key(*cols: Column | str) -> Column:
    """Key over several parts; a NULL part counts as empty text, so positions never shift."""
    parts = [F.coalesce(as_column(c).cast("string"), F.lit("")) for c in cols]
    return F.sha2(F.concat_ws(KEY_SEPARATOR, *parts), 256)


def valid_identity(min_year: int = 1900, max_year: int = 2027) -> Column:
    """Does a normalised row have an entity? True exactly where `with_entity_key` sets a key."""
    return F.expr(
        "normalized_make <> '' AND normalized_model <> '' "
        f"AND model_year_int BETWEEN {min_year} AND {max_year}"
    )


def with_entity_key(
    df: DataFrame,
    make: str,
    model: str,
    year: str,
    min_year: int = 1900,
    max_year: int = 2027,
    fold_accents: bool = False,
) -> DataFrame:
    """Append the normalised identity and its key; the key is NULL when the identity is not valid."""
    typed = df.withColumns(
        {
            "normalized_make": normalize_text(make, fold_accents),
            "normalized_model": normalize_text(model, fold_accents),
            "model_year_int": safe_int(year),
        }
    )
    return typed.withColumn(
        "vehicle_key",
        F.when(
            valid_identity(min_year, max_year),
            vehicle_key("normalized_make", "normalized_model", "model_year_int"),
        ),
    )
