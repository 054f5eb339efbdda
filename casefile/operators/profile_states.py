"""Profiles that grow: a state per batch is stored once, and the profile of any batches is merged from states.

A batch leaves below the store
* `counts/batch=<b>`: one row with its counts, smallest and largest values, and HLL sketches of its row digests,
  business ids and identities, from one scan that shuffles one row per task;
* for the kinds named in `exact`, `numbers/…` and `bits/…`: dense numbers of the values no earlier batch had, and
  bitmaps of those the batch has (see `distinct_states`), by which distinct counts are exact.

A batch is read when it arrives and never again. Without exact kinds a distinct count is within `hll_error(…)`, and
`exact_duplicate_rows`, the rows less the distinct ones, is off by that share of the rows.

One source per store, one writer at a time. The counts are written last: a batch without them is not there, so one
that was cut off is simply added again; adding one that is there raises.
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casefile.operators import distinct_states
from casefile.operators.profiling import ProfileSpec, profile_columns, read_rows
from casefile.session import scratch_path
from casefile.sources import writers

#: Kind of value -> the count of a profile that it gives.
KINDS = {"digest": "distinct_rows", "id": "distinct_business_ids", "identity": "distinct_normalized_vehicle_keys"}
#: Logarithm of the number of registers of a sketch.
LG_K = 14

_STATE = distinct_states.DistinctState("n", "value")


def hll_error(lg_k: int = LG_K, deviations: float = 3.0) -> float:
    """Relative error of a sketched count, at so many standard deviations."""
    return deviations * 1.04 / 2 ** (lg_k / 2)


def _text(kind: str) -> Column:
    """The value as text; parts of an identity with their lengths in front, so that no two share a text."""
    if kind == "digest":
        return F.lower(F.hex("digest"))
    if kind != "identity":
        return F.col(kind)
    return F.expr("concat(length(identity.k_make), ':', identity.k_make, length(identity.k_model), ':', identity.k_model, ':', identity.k_year)")


def _rows(df: DataFrame, spec: ProfileSpec) -> DataFrame:
    rows = read_rows(df, spec)
    return rows if spec.make else rows.withColumn("identity", F.lit(None).cast("struct<k_make: string, k_model: string, k_year: int>"))


def counts(df: DataFrame, spec: ProfileSpec, malformed_rows: int = 0) -> DataFrame:
    """The state of one batch: one row."""
    return _counted(_rows(df, spec), len(df.columns), malformed_rows)


def _counted(rows: DataFrame, n_columns: int, malformed_rows: int) -> DataFrame:
    vehicle = F.col("_vehicle")
    return rows.agg(
        F.lit(n_columns).alias("columns"),
        F.lit(malformed_rows).cast("bigint").alias("bad"),
        F.count("*").alias("rows"),
        F.count_if(vehicle).alias("vehicle_rows"),
        F.count_if(F.col("identity").isNotNull()).alias("valid_vehicle_rows"),
        F.count_if(vehicle & ~F.col("make")).alias("missing_make"),
        F.count_if(vehicle & ~F.col("model")).alias("missing_model"),
        F.count_if(vehicle & F.col("_year").isNull()).alias("missing_year"),
        F.min("_year").alias("min_year"),
        F.max("_year").alias("max_year"),
        F.min("day").alias("min_source_date"),
        F.max("day").alias("max_source_date"),
        *[F.hll_sketch_agg(_text(kind), F.lit(LG_K)).alias(f"hll_{kind}") for kind in KINDS],
    )


def _folder(path: str, batch: str) -> str:
    """Folder of one batch. The letters in front keep a name of digits a text when it is read back."""
    return f"{path}/batch=at-{batch}"


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path).withColumn("batch", F.expr("substring(batch, 4)"))
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):  # nothing written yet
            return None
        raise


def batches(spark: SparkSession, store: str) -> list[str]:
    """The batches that are there, one row each."""
    found = _stored(spark, f"{store}/counts")
    return [] if found is None else sorted(r[0] for r in found.select("batch").collect())


def add_batch(df: DataFrame, spec: ProfileSpec, store: str, batch: str, malformed_rows: int = 0, exact=()) -> None:
    """Add a batch's state to the store. `malformed_rows` is what the intake observed.

    `exact` names kinds whose distinct counts are to be exact; give the same for every batch of a store. For them
    the rows' digests, ids and identities are written to the shared folder first, as they are read several times.
    """
    if not re.fullmatch(r"[\w.-]+", batch):
        raise ValueError(f"a batch is named by letters, digits, dots, lines and underscores: {batch!r}")
    spark = df.sparkSession
    there = batches(spark, store)
    if batch in there:
        raise ValueError(f"batch {batch} is in {store} already")

    rows = _rows(df, spec)
    if exact:
        read = scratch_path(spark, "profiled-rows")
        writers.replace(rows, read)
        rows = spark.read.schema(rows.schema).parquet(read)

    def number(kind: str) -> None:
        values = rows.select(_text(kind).alias("value")).where("value IS NOT NULL")
        known = _stored(spark, f"{store}/numbers/{kind}")
        if known is not None:  # not those of a batch that was cut off
            known = known.where(F.col("batch").isin(there)).select("id", "number")
        numbers = distinct_states.number_ids(values, "value", _folder(f"{store}/numbers/{kind}", batch), known)
        writers.replace(distinct_states.states(values, numbers, _STATE, []), _folder(f"{store}/bits/{kind}", batch))

    with ThreadPoolExecutor(len(KINDS)) as pool:  # the kinds are independent jobs
        list(pool.map(number, exact))
    writers.replace(_counted(rows, len(df.columns), malformed_rows), _folder(f"{store}/counts", batch))


def profile_of(spark: SparkSession, spec: ProfileSpec, store: str, chosen=None, exact=()) -> DataFrame:
    """The profile of the chosen batches, of all by default, with the columns of `profiling.profile`; no row is read."""
    stored = _stored(spark, f"{store}/counts")
    if stored is None:
        raise ValueError(f"no batch in {store}")
    chosen = batches(spark, store) if chosen is None else list(chosen)
    own = stored.where(F.col("batch").isin(chosen))
    added = "bad rows vehicle_rows valid_vehicle_rows missing_make missing_model missing_year".split()
    merged = own.agg(
        F.max("columns").alias("columns"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in added],
        *[F.min(c).alias(c) for c in ("min_year", "min_source_date")],
        *[F.max(c).alias(c) for c in ("max_year", "max_source_date")],
        *[F.hll_sketch_estimate(F.hll_union_agg(f"hll_{kind}")).alias(name) for kind, name in KINDS.items()],
    )
    columns = merged.select("columns").first()[0]  # one row
    if columns is None:
        raise ValueError(f"none of the batches {chosen} is in {store}")
    parts = [merged.drop(*[KINDS[kind] for kind in exact])]
    for kind in exact:
        bits = _stored(spark, f"{store}/bits/{kind}").where(F.col("batch").isin(chosen))
        found = distinct_states.counts(distinct_states.merged([bits], _STATE, []), _STATE, [[]])
        parts.append(found.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias(KINDS[kind])))
    # one row each, brought together
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    counted = together.agg(*[F.max(c).alias(c) for c in together.columns])
    return profile_columns(counted.withColumn("distinct_rows", F.least("distinct_rows", "rows")), spec.source_id, columns)
