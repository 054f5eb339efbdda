"""Text normalisation."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def blank_to_null(col: Column | str) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.nullif(F.trim(as_column(col)), F.lit(""))


@lru_cache(maxsize=1)
def _ascii_folds() -> tuple[dict[str, str], dict[str, str]]:
    """Characters whose compatibility decomposition has an ASCII part.

    Returns the one-letter folds (é -> e) and the longer ones (ligatures, fractions, units).
    """
    single, longer = {}, {}
    for code in range(0x80, sys.maxunicode + 1):
        char = chr(code)
        form = unicodedata.normalize("NFKD", char)
        plain = "".join(c for c in form if c < "\x80")
        if len(plain) == 1:
            single[char] = plain
        elif plain:
            longer[char] = plain
    return single, longer


def fold_to_ascii(col: Column | str) -> Column:
    """Compatibility-decompose and keep the ASCII part: é -> e, ﬁ -> fi, ß -> nothing."""
    single, longer = _ascii_folds()
    text = as_column(col)
    folded = F.translate(text, "".join(single), "".join(single.values()))
    expansions = F.map_from_arrays(
        F.split(F.lit("\n".join(longer)), "\n"), F.split(F.lit("\n".join(longer.values())), "\n")
    )
    spelled_out = F.array_join(
        F.transform(F.split(folded, ""), lambda c: F.coalesce(F.try_element_at(expansions, c), c)), ""
    )
    # ASCII texts pay for one scan; only texts that still hold a character with a longer
    # fold are taken apart, and that test looks at their non-ASCII characters alone.
    leftover = F.regexp_replace(folded, "[\\x00-\\x7F]+", "")
    expanded = F.when(leftover.rlike("[" + "".join(longer) + "]"), spelled_out).otherwise(folded)
    return F.when(text.rlike("[^\\x00-\\x7F]"), F.regexp_replace(expanded, "[^\\x00-\\x7F]+", "")).otherwise(text)


def normalize_text(col: Column | str, fold_accents: bool = False) -> Column:
    """Upper case, every run of characters other than A-Z and 0-9 becomes one blank, trimmed."""
    text = F.coalesce(as_column(col), F.lit(""))
    if fold_accents:
        text = fold_to_ascii(text)
    return F.trim(F.regexp_replace(F.upper(text), "[^A-Z0-9]+", " "))
