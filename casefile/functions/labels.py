"""Shares, presence counts, sort ranks and display labels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from casefile.functions.text import as_column

# Display order of the two priority scales.
PRIORITY_ORDER = ("CRITICAL", "HIGH", "REVIEW", "MONITOR")
ALIAS_ORDER = ("P0", "P1", "P2", "NONE")


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Share as a double; NULL when the denominator is 0 or NULL."""
    return F.try_divide(as_column(numerator).cast("double"), as_column(denominator).cast("double"))


def presence_count(*cols: Column | str) -> Column:
    """How many of the counts are above zero."""
    return reduce(
        lambda a, b: a + b, [F.coalesce((as_column(c) > 0).cast("int"), F.lit(0)) for c in cols]
    )


def label_rank(col: Column | str, order) -> Column:
    """1-based position of a label in its order; unknown labels share the last position."""
    chain = F.when(as_column(col) == order[0], 1)
    for position, label in enumerate(order[1:-1], start=2):
        chain = chain.when(as_column(col) == label, position)
    return chain.otherwise(len(order))


def title_label(col: Column | str) -> Column:
    """FIRE_OR_THERMAL -> Fire Or Thermal."""
    return F.initcap(F.replace(as_column(col), F.lit("_"), F.lit(" ")))
