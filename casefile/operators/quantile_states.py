"""Medians that add up: quantile sketches, stored, merged, and rolled up to any coarser context.

A state is one row per context with a KLL sketch of each measured column. Sketches of batches and of finer
contexts merge into the sketch of their union; its size grows with the logarithm of what it saw, not with rows.

A sketch that saw at most `k` values keeps them all: its median is the lower median, exactly. Beyond that it is a
value whose rank is within `rank_error(k)` of one half with 99 % confidence, and which value depends on the
order in which sketches met: reruns may differ within that error. The exact median is `mart.median_by`.

Missing values are not measured; a context without a value has a NULL median.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casefile.operators.mart import value_counts


@dataclass(frozen=True)
class QuantileState:
    """What is measured: output name -> numeric column, and the size of a sketch."""

    columns: dict[str, str]
    k: int = 4096

    def __post_init__(self):
        if not 8 <= self.k <= 65_535:
            raise ValueError("k is from 8 to 65535")


def rank_error(k: int) -> float:
    """How far the rank of a sketch's quantile may be off, one-sided, with 99 % confidence."""
    # The published error of the sketch family
    return 2.296 / k**0.9021


def states(df: DataFrame, state: QuantileState, context) -> DataFrame:
    """context, and a sketch `kll_<name>` for each measure. Rows are sketched before the only shuffle."""
    sketches = [
        F.kll_sketch_agg_double(F.col(column).cast("double"), F.lit(state.k)).alias(f"kll_{name}") for name, column in state.columns.items()
    ]
    return df.groupBy(*context).agg(*sketches)


def merged(parts: list[DataFrame], state: QuantileState, context) -> DataFrame:
    """One state of several, of batches or of finer contexts, at a context all of them have."""
    every = reduce(DataFrame.unionByName, [p.select(*context, *[f"kll_{n}" for n in state.columns]) for p in parts])
    return every.groupBy(*context).agg(*_merging(state))


def _merging(state: QuantileState):
    return [F.kll_merge_agg_double(f"kll_{name}", F.lit(state.k)).alias(f"kll_{name}") for name in state.columns]


def rolled_up(stored: DataFrame, state: QuantileState, contexts: list[list[str]]) -> DataFrame:
    """The states of each of the contexts, whose columns the state has, with `grouping_id`; one scan of the states.

    Sketches meet at the finest of the contexts first, so what grouping sets multiply are rows of that grain.
    """
    columns = list(dict.fromkeys(c for own in contexts for c in own))
    grain = stored.groupBy(*columns).agg(*_merging(state))
    if not columns:
        return grain.withColumn("grouping_id", F.lit(0).cast("bigint"))
    sets = [[F.col(c) for c in own] for own in contexts]
    return grain.groupingSets(sets, *[F.col(c) for c in columns]).agg(F.grouping_id().alias("grouping_id"), *_merging(state))


def medians(rolled: DataFrame, state: QuantileState) -> DataFrame:
    """The contexts with `<name>`, the median, and `n_<name>`, the values it is of."""
    kept = [c for c in rolled.columns if c not in {f"kll_{n}" for n in state.columns}]
    found = []
    for name in state.columns:
        sketch = F.col(f"kll_{name}")
        n = F.coalesce(F.kll_sketch_get_n_double(sketch), F.lit(0))
        found += [F.when(n > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(0.5))).alias(name), n.cast("bigint").alias(f"n_{name}")]
    return rolled.select(*kept, *found)


def rank_errors(found: DataFrame, df: DataFrame, state: QuantileState, context) -> DataFrame:
    """How far the medians of one context are off: context, measure, n, median, error.

    `found` are medians of `df` by `context`. The error is the distance of one half from the ranks that the
    median has among the values, from the share below it to the share up to it: 0 if it is a median. Values
    are counted first, so a group meets its distinct values, not its rows.
    """
    context = list(context)
    pairs = F.array(*[F.struct(F.lit(n).alias("measure"), F.col(n).alias("median")) for n in state.columns])
    named = found.select(*context, F.explode(pairs).alias("pair")).select(*context, "pair.*")
    counted = value_counts(df, context, state.columns).where("value IS NOT NULL")
    same = reduce(lambda a, b: a & b, [F.col(f"f.{c}").eqNullSafe(F.col(f"v.{c}")) for c in [*context, "measure"]])
    met = named.alias("f").join(counted.alias("v"), same).select(
        *[f"f.{c}" for c in context], "f.measure", "f.median", "v.value", "v.n"
    )
    ranks = met.groupBy(*context, "measure", "median").agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(F.col("value") < F.col("median"), F.col("n"))), F.lit(0)).alias("below"),
        F.coalesce(F.sum(F.when(F.col("value") <= F.col("median"), F.col("n"))), F.lit(0)).alias("upto"),
    )
    error = F.greatest(F.lit(0.0), F.col("below") / F.col("n") - 0.5, 0.5 - F.col("upto") / F.col("n"))
    return ranks.select(*context, "measure", "n", "median", error.alias("error"))
