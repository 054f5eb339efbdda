"""Source profiles and cross-source coverage."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casefile.functions import blank_to_null, first8_date, normalize_text, ratio
from casefile.operators.dedup import row_digest


@dataclass(frozen=True)
class ProfileSpec:
    """Which columns of a source mean what; None where the source has no such column."""

    source_id: str
    id_col: str | None = None
    date_col: str | None = None
    make: str | None = None
    model: str | None = None
    year: str | None = None
    product_col: str | None = None
    product_value: str = "V"
    min_year: int = 1900
    max_year: int = 2027


def _valid_year(spec: ProfileSpec) -> Column:
    text = F.trim(F.coalesce(F.col(spec.year), F.lit("")))
    year = F.when(text.rlike("^[0-9]+$"), text.try_cast("int"))
    return F.when(year.between(spec.min_year, spec.max_year), year)


def _present(name: str) -> Column:
    return blank_to_null(name).isNotNull()


def _profiled_rows(df: DataFrame, spec: ProfileSpec) -> DataFrame:
    year = _valid_year(spec) if spec.year else F.lit(None).cast("int")
    if spec.make is None:
        vehicle = F.lit(False)
    elif spec.product_col is None:
        vehicle = F.lit(True)
    else:
        vehicle = F.coalesce(F.upper(F.trim(spec.product_col)) == spec.product_value, F.lit(False))
    return df.withColumns({"_year": year, "_vehicle": vehicle})


def _identity(spec: ProfileSpec) -> list[Column]:
    return [
        normalize_text(spec.make, fold_accents=True).alias("k_make"),
        normalize_text(spec.model, fold_accents=True).alias("k_model"),
        F.col("_year").alias("k_year"),
    ]


def profile_keys(df: DataFrame, spec: ProfileSpec) -> DataFrame:
    """Distinct accent-folded identities of the valid vehicle rows."""
    rows = _profiled_rows(df, spec)
    valid = F.col("_vehicle") & _present(spec.make) & _present(spec.model) & F.col("_year").isNotNull()
    return rows.filter(valid).select(*_identity(spec)).distinct()


def read_rows(df: DataFrame, spec: ProfileSpec) -> DataFrame:
    """What a profile needs of every row: digest, id, identity, day, _vehicle, _year, and whether it has a make and a model."""
    make = _present(spec.make) if spec.make else F.lit(False)
    model = _present(spec.model) if spec.model else F.lit(False)
    valid = F.col("_vehicle") & make & model & F.col("_year").isNotNull()
    identity = F.when(valid, F.struct(*_identity(spec))) if spec.make else F.lit(None).cast("string")
    return _profiled_rows(df, spec).select(
        row_digest(df.columns).alias("digest"),
        (blank_to_null(spec.id_col) if spec.id_col else F.lit(None).cast("string")).alias("id"),
        identity.alias("identity"),
        (first8_date(spec.date_col) if spec.date_col else F.lit(None).cast("string")).alias("day"),
        "_vehicle",
        "_year",
        make.alias("make"),
        model.alias("model"),
    )


def profile_columns(counted: DataFrame, source_id: str, n_columns: int) -> DataFrame:
    """The metrics of a profile from its counts; `rows` are those read, `bad` the malformed ones."""
    bad = F.col("bad")
    total = F.col("rows") + bad
    return counted.select(
        F.lit(source_id).alias("source_id"),
        F.lit(n_columns).alias("columns"),
        total.alias("rows"),
        bad.alias("malformed_rows"),
        ratio(bad, total).alias("malformed_rate"),
        (F.col("rows") - F.col("distinct_rows")).alias("exact_duplicate_rows"),
        "distinct_business_ids",
        ratio(total, "distinct_business_ids").alias("rows_per_business_id"),
        "vehicle_rows",
        "valid_vehicle_rows",
        ratio("missing_make", "vehicle_rows").alias("missing_make_rate"),
        ratio("missing_model", "vehicle_rows").alias("missing_model_rate"),
        ratio("missing_year", "vehicle_rows").alias("invalid_or_missing_year_rate"),
        "distinct_normalized_vehicle_keys",
        "min_year",
        "max_year",
        "min_source_date",
        "max_source_date",
    )


def profile(df: DataFrame, spec: ProfileSpec, malformed: DataFrame | None = None) -> DataFrame:
    """One row of 18 metrics for a landed source, from one scan.

    Rows are grouped by their digest together with their id and identity, which are functions of the row;
    every count is then taken from that smaller frame. Ids and identities are told apart by a grouping each,
    over the same shuffled frame, so no row is expanded. What these give is one row each, brought together
    by a union.
    """
    vehicle, year, n = F.col("_vehicle"), F.col("_year"), F.col("n")
    rows = read_rows(df, spec)
    # The condition keeps the count in the grouping of every branch, so that they are one grouping to Spark. A
    # condition on a grouping column would be pushed below it, and its branch would scan the source again.
    per_row = rows.groupBy(*rows.columns).agg(F.count("*").alias("n")).filter("n > 0")

    def rows_where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0))

    counted = per_row.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count("*").alias("distinct_rows"),
        rows_where(vehicle).alias("vehicle_rows"),
        rows_where(F.col("identity").isNotNull()).alias("valid_vehicle_rows"),
        rows_where(vehicle & ~F.col("make")).alias("missing_make"),
        rows_where(vehicle & ~F.col("model")).alias("missing_model"),
        rows_where(vehicle & year.isNull()).alias("missing_year"),
        F.min("_year").alias("min_year"),
        F.max("_year").alias("max_year"),
        F.min("day").alias("min_source_date"),
        F.max("day").alias("max_source_date"),
    )
    singles = [
        counted,
        per_row.groupBy("id").agg(F.max("n")).agg(F.count("id").alias("distinct_business_ids")),
        per_row.groupBy("identity").agg(F.max("n")).agg(F.count("identity").alias("distinct_normalized_vehicle_keys")),
    ]
    singles.append((rows.limit(0) if malformed is None else malformed).agg(F.count("*").alias("bad")))
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), singles)
    counted = together.agg(*[F.max(c).alias(c) for c in together.columns])
    return profile_columns(counted, spec.source_id, len(df.columns))


def profile_all(sources: dict[str, tuple[DataFrame, ProfileSpec]]) -> DataFrame:
    return reduce(DataFrame.unionByName, [profile(df, spec) for df, spec in sources.values()])


def profile_summary(profiles: DataFrame) -> DataFrame:
    """One row: sources, total rows, malformed and duplicate rows over all profiles."""
    return profiles.agg(
        F.count("*").alias("sources"),
        F.sum("rows").cast("bigint").alias("total_rows"),
        F.sum("malformed_rows").cast("bigint").alias("malformed_rows"),
        F.sum("exact_duplicate_rows").cast("bigint").alias("exact_duplicate_rows"),
        F.sum("vehicle_rows").cast("bigint").alias("vehicle_rows"),
        F.sum("valid_vehicle_rows").cast("bigint").alias("valid_vehicle_rows"),
    )


def profile_reconcile(profiles: DataFrame, manifest: DataFrame) -> DataFrame:
    """Do profile and manifest agree on rows per source, without malformed rows?"""
    return profiles.select("source_id", F.col("rows").alias("profiled_rows"), "malformed_rows").join(
        manifest.select("source_id", F.col("rows").alias("manifest_rows")), "source_id", "full"
    ).withColumn(
        "passed",
        F.coalesce((F.col("profiled_rows") == F.col("manifest_rows")) & (F.col("malformed_rows") == 0), F.lit(False)),
    )


_KEY = ["k_make", "k_model", "k_year"]


def _tagged_keys(operational: dict[str, DataFrame], reference: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Distinct keys per operational source, and the distinct reference keys with a marker."""
    tagged = reduce(
        DataFrame.unionByName, [keys.select(F.lit(name).alias("source_id"), *_KEY) for name, keys in operational.items()]
    ).distinct()
    marked = reduce(DataFrame.unionByName, [keys.select(*_KEY) for keys in reference.values()]).distinct()
    return tagged, marked.withColumn("in_reference", F.lit(True))


def _coverage(keys: DataFrame, by: list[str], era_start: int) -> DataFrame:
    eligible = F.col("k_year") >= era_start
    counted = keys.groupBy(*by).agg(
        F.count("*").alias("distinct_vehicle_keys"),
        F.count_if(F.col("matched")).alias("exact_reference_matches"),
        F.count_if(eligible).alias("era_eligible_vehicle_keys"),
        F.count_if(eligible & F.col("matched")).alias("era_eligible_exact_reference_matches"),
    )
    return counted.withColumns(
        {
            "exact_match_rate": ratio("exact_reference_matches", "distinct_vehicle_keys"),
            "era_eligible_exact_match_rate": ratio("era_eligible_exact_reference_matches", "era_eligible_vehicle_keys"),
        }
    )


def _matched(keys: DataFrame, reference: DataFrame) -> DataFrame:
    return keys.join(reference, _KEY, "left").withColumn("matched", F.coalesce("in_reference", F.lit(False)))


def coverage(operational: dict[str, DataFrame], reference: dict[str, DataFrame], era_start: int = 1984) -> DataFrame:
    """Match coverage of each operational source against the union of the reference sources."""
    keys, marked = _tagged_keys(operational, reference)
    return _coverage(_matched(keys, marked), ["source_id"], era_start)


def union_coverage(operational: dict[str, DataFrame], reference: dict[str, DataFrame], era_start: int = 1984) -> DataFrame:
    """Match coverage of the union of the operational sources."""
    keys, marked = _tagged_keys(operational, reference)
    return _coverage(_matched(keys.select(*_KEY).distinct(), marked), [], era_start)
