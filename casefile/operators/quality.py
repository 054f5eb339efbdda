"""Contracts, quality checks, reconciliation and the gates that stop a run."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casefile.functions.text import as_column
from casefile.operators.dedup import duplicate_keys
from casefile.operators.mart import COUNT_COLUMNS, MEDIAN_COLUMNS
from casefile.operators.star import orphan_keys
from casefile.sources.contracts import FORBIDDEN_COLUMNS


# --- ingest contract ------------------------------------------------------------------------


def observe(spark: SparkSession, landed: dict[str, DataFrame], headers: dict[str, list[str]]) -> DataFrame:
    """One row per landed table: its header and its row count, all counts in one job."""
    names = spark.createDataFrame(
        [(name, list(columns)) for name, columns in headers.items()],
        "table_name string, actual_columns array<string>",
    )
    counts = reduce(
        DataFrame.unionByName,
        [df.agg(F.count("*").alias("actual_rows")).withColumn("table_name", F.lit(n)) for n, df in landed.items()],
    )
    return names.join(F.broadcast(counts), "table_name")  # one row per table


def batch_id(moment: Column | None = None) -> Column:
    """yyyyMMddTHHmmssZ of a UTC timestamp."""
    return F.date_format(F.current_timestamp() if moment is None else moment, "yyyyMMdd'T'HHmmss'Z'")


AUDIT_COLUMNS = (
    "batch_id table_name source_id source_file source_sha256 extract_sha256 expected_rows actual_rows "
    "schema_matches row_count_matches status ingested_at"
).split()


def check_contract(observed: DataFrame, manifest: DataFrame, batch: str, ingested_at: Column | None = None) -> DataFrame:
    """Audit rows: ordered columns and row counts, observed against the manifest.

    The full join keeps a table the manifest lists but nobody landed, and one landed
    without a manifest entry; both fail.
    """
    joined = manifest.join(observed, "table_name", "full")
    return joined.select(
        F.lit(batch).alias("batch_id"),
        "table_name",
        "source_id",
        "output_file",
        F.col("source_sha256"),
        F.col("output_sha256").alias("extract_sha256"),
        F.col("rows").alias("expected_rows"),
        "actual_rows",
        F.col("columns").eqNullSafe(F.col("actual_columns")).alias("schema_matches"),
        F.col("rows").eqNullSafe(F.col("actual_rows")).alias("row_count_matches"),
        (F.current_timestamp() if ingested_at is None else ingested_at).alias("ingested_at"),
    ).select(
        *[
            F.col("output_file").alias(c) if c == "source_file" else _status() if c == "status" else F.col(c)
            for c in AUDIT_COLUMNS
        ]
    )


def _status() -> Column:
    return F.when(F.col("schema_matches") & F.col("row_count_matches"), "PASS").otherwise("FAIL").alias("status")


def verify_checksums(manifest: DataFrame, checksums: DataFrame) -> DataFrame:
    """(table_name, output_file, expected, actual, checksum_matches) per extract."""
    return manifest.join(
        checksums.select("output_file", F.col("output_sha256").alias("actual_sha256")), "output_file", "left"
    ).select(
        "table_name",
        "output_file",
        F.col("output_sha256").alias("expected_sha256"),
        "actual_sha256",
        F.col("output_sha256").eqNullSafe(F.col("actual_sha256")).alias("checksum_matches"),
    )


def missing_tables(manifest: DataFrame, expected: list[str]) -> DataFrame:
    """Expected tables without a manifest entry."""
    wanted = manifest.sparkSession.createDataFrame([(t,) for t in expected], "table_name string")
    return wanted.join(manifest, "table_name", "left_anti")


def latest_batch(audit: DataFrame) -> DataFrame:
    """Per table: the audit row of its newest batch, and how many batches there were."""
    rest = [c for c in audit.columns if c != "table_name"]
    newest = F.max_by(F.struct(*rest), F.struct("ingested_at", "batch_id")).alias("newest")
    return (
        audit.groupBy("table_name")
        .agg(F.count_distinct("batch_id").alias("batches"), newest)
        .select("table_name", "batches", "newest.*")
    )


def with_lineage(
    df: DataFrame,
    source_id: str,
    source_file: str,
    source_sha256: str | None,
    extract_sha256: str | None,
    batch: str,
    ingested_at: Column,
) -> DataFrame:
    """Append the six provenance columns; the batch id and time are literals of the run."""
    return df.withColumns(
        {
            "_source_id": F.lit(source_id),
            "_source_file": F.lit(source_file),
            "_source_sha256": F.lit(source_sha256).cast("string"),
            "_extract_sha256": F.lit(extract_sha256).cast("string"),
            "_batch_id": F.lit(batch),
            "_ingested_at": ingested_at,
        }
    )


# --- gates ----------------------------------------------------------------------------------


def gate(checks: DataFrame, failed: Column | str, label: str, what: str) -> None:
    """Raise when any check row fails. At most one row per table or check reaches the driver."""
    names = [row[0] for row in checks.filter(as_column(failed)).select(label).orderBy(label).collect()]
    if names:
        raise ValueError(f"{what} failed for: {names}")


def gate_outcomes(checks: dict[str, tuple[DataFrame, Column | str, str]]) -> DataFrame:
    """What each gate would do: gate, checks, failed, failed_names in order, stops. Nothing is raised.

    `checks` is gate -> (its check rows, which of them failed, the column that names them); a gate without check
    rows does not stop.
    """

    def one(name: str, rows: DataFrame, failed: Column | str, label: str) -> DataFrame:
        bad = F.coalesce(as_column(failed), F.lit(True))
        flagged = rows.select(bad.alias("bad"), F.col(label).cast("string").alias("label"))
        counted = flagged.agg(
            F.count("*").alias("checks"),
            F.count_if("bad").alias("failed"),
            F.array_join(F.array_sort(F.collect_list(F.when(F.col("bad"), F.col("label")))), ", ").alias("failed_names"),
        )
        return counted.select(F.lit(name).alias("gate"), "*", (F.col("failed") > 0).alias("stops"))

    return reduce(DataFrame.unionByName, [one(name, *rest) for name, rest in checks.items()])


def gate_contract(audit: DataFrame) -> None:
    gate(audit, F.col("status") != "PASS", "table_name", "Bronze contract")


def gate_checks(checks: DataFrame) -> None:
    gate(checks, ~F.col("passed"), "check_name", "Gold quality checks")


# --- privacy --------------------------------------------------------------------------------


def project_allowed(df: DataFrame, allowed, forbidden=FORBIDDEN_COLUMNS) -> DataFrame:
    """Keep the approved columns only; approving a forbidden one raises."""
    banned = {name.lower() for name in forbidden}
    leaked = [name for name in allowed if name.lower() in banned]
    if leaked:
        raise ValueError(f"forbidden columns approved: {leaked}")
    return df.select(*allowed)


# --- star schema checks ---------------------------------------------------------------------


def _check_rows(named_counts: DataFrame) -> DataFrame:
    return named_counts.select(
        "check_name",
        "actual_value",
        F.lit(0).cast("bigint").alias("expected_value"),
        (F.col("actual_value") == 0).alias("passed"),
    )


def _named(df: DataFrame, name: str, value: Column) -> DataFrame:
    return df.agg(value.cast("bigint").alias("actual_value")).select(F.lit(name).alias("check_name"), "actual_value")


def dq_checks(dim: DataFrame, facts: dict[str, DataFrame], alias_queue: DataFrame, checked_at: Column | None = None) -> DataFrame:
    """Uniqueness, orphan keys per fact, and queue content as one table of one job."""
    spark = dim.sparkSession
    zeros = spark.createDataFrame([(name, 0) for name in facts], "fact_name string, n bigint")
    orphans = (
        orphan_keys(dim, facts)
        .groupBy("fact_name")
        .agg(F.count("*").alias("n"))
        .unionByName(zeros)
        .groupBy("fact_name")
        .agg(F.sum("n").alias("actual_value"))
        .select(F.concat(F.upper("fact_name"), F.lit("_ORPHAN_KEYS")).alias("check_name"), "actual_value")
    )
    rows = (
        _named(duplicate_keys(dim, "vehicle_key"), "DIM_VEHICLE_UNIQUENESS", F.count("*"))
        .unionByName(orphans)
        .unionByName(
            _named(
                alias_queue,
                "ALIAS_QUEUE_CONTAINS_ONLY_P0_P1",
                F.count_if(~F.col("alias_priority").isin("P0", "P1")),
            )
        )
    )
    checks = _check_rows(rows)
    return checks if checked_at is None else checks.withColumn("checked_at", checked_at)


def dq_semantic(
    mart: DataFrame, counted: dict[str, tuple[DataFrame, str]], calendar: DataFrame, date_keys: dict[str, DataFrame]
) -> DataFrame:
    """The documented rules beyond uniqueness and orphans.

    * a count of the mart equals the distinct (entity, id) pairs of its fact; `counted` is
      mart column -> (fact, id column);
    * a critical entity has a do-not-drive or park-outside campaign, and the reverse;
    * every date key of a fact is in the calendar.
    """
    checks = []
    for column, (fact, id_col) in counted.items():
        reported = mart.agg(F.coalesce(F.sum(column), F.lit(0)).alias("n"))
        pairs = fact.filter(F.col("vehicle_key").isNotNull() & F.col(id_col).isNotNull()).select("vehicle_key", id_col)
        both = reported.unionByName(pairs.distinct().agg((-F.count("*")).alias("n")))
        checks.append(_named(both, f"MART_{column.upper()}_EQUAL_FACT", F.abs(F.sum("n"))))
    urgent = (F.col("do_not_drive_campaigns") > 0) | (F.col("park_outside_campaigns") > 0)
    critical = F.col("review_priority") == "CRITICAL"
    unexplained = _named(mart, "CRITICAL_HAS_URGENCY_FLAG", F.count_if(critical != urgent))
    tagged = [
        df.filter(F.col(column).isNotNull()).select(F.col(column).alias("date_key")).distinct()
        for column, df in date_keys.items()
    ]
    keys = reduce(DataFrame.unionByName, tagged).distinct()
    outside = _named(
        keys.join(calendar.select("date_key"), "date_key", "left_anti"), "DATE_KEYS_IN_CALENDAR", F.count("*")
    )
    return _check_rows(reduce(DataFrame.unionByName, [*checks, unexplained, outside]))


def dq_status(checks: DataFrame) -> DataFrame:
    """One row: failed checks and the report status."""
    return checks.agg(F.count_if(~F.col("passed")).alias("failed_data_quality_checks")).withColumn(
        "data_quality_status",
        # Fixed values
        F.when(F.col("failed_data_quality_checks") == 0, "PASS").otherwise("STOP AND INVESTIGATE"),
    )


# --- reconciliation -------------------------------------------------------------------------


TOTAL_COLUMNS = (
    "complaint_reports severe_complaint_reports recall_campaigns do_not_drive_campaigns "
    "park_outside_campaigns investigations open_investigations manufacturer_documents "
    "ncap_tested_variants epa_variants"
).split()


def business_totals(mart: DataFrame) -> DataFrame:
    """One row: sums of the mart's counts, entity count and match counts."""
    eligible = F.col("reference_year_eligible")
    matched = F.col("reference_exact_match_flag")
    return mart.agg(
        F.count("*").alias("vehicle_keys"),
        F.count_if(matched).alias("reference_exact_match_vehicle_keys"),
        F.count_if(eligible).alias("era_eligible_vehicle_keys"),
        F.count_if(eligible & matched).alias("era_eligible_reference_exact_match_vehicle_keys"),
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in TOTAL_COLUMNS],
    )


def mart_metrics(mart: DataFrame) -> DataFrame:
    """Everything a run reconciles, as (metric, value): counts, sums of the medians, label counts.

    One grouping of the mart by its labels feeds all metrics, so the mart is read once.
    """
    eligible, matched = F.col("reference_year_eligible"), F.col("reference_exact_match_flag")
    labels = ("review_priority", "review_reason", "alias_priority")
    grouped = mart.groupBy(*labels).agg(
        F.count("*").alias("vehicle_keys"),
        F.count_if(matched).alias("reference_exact_match_vehicle_keys"),
        F.count_if(eligible).alias("era_eligible_vehicle_keys"),
        F.count_if(eligible & matched).alias("era_eligible_reference_exact_match_vehicle_keys"),
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in COUNT_COLUMNS],
        *[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in MEDIAN_COLUMNS],
        *[F.count(c).alias(f"{c}_known") for c in MEDIAN_COLUMNS],
    )
    sums = [c for c in grouped.columns if c not in labels]
    pairs = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in sums]
    pairs += [
        F.struct(F.concat(F.lit(f"{c}="), F.col(c)).alias("metric"), F.col("vehicle_keys").cast("double").alias("value"))
        for c in labels
    ]
    return (
        grouped.select(F.explode(F.array(*pairs)).alias("m"))
        .groupBy(F.col("m.metric").alias("metric"))
        .agg(F.sum("m.value").alias("value"))
    )


def reconcile(actual: DataFrame, expected: DataFrame, tol: float = 1e-9) -> DataFrame:
    """Metric by metric; one that is missing on either side fails."""
    joined = actual.select("metric", F.col("value").alias("actual_value")).join(
        expected.select("metric", F.col("value").alias("expected_value")), "metric", "full"
    )
    close = F.abs(F.col("actual_value") - F.col("expected_value")) <= tol
    return joined.withColumn("passed", F.coalesce(close, F.lit(False)))


def product_row_counts(tables: dict[str, DataFrame], product: str = "V") -> DataFrame:
    """Rows and product rows per landed table with a product column."""
    return reduce(
        DataFrame.unionByName,
        [
            df.agg(
                F.count("*").alias("rows"), F.count_if(F.col("product_type") == product).alias("product_rows")
            ).select(F.lit(name).alias("table_name"), "rows", "product_rows")
            for name, df in tables.items()
        ],
    )
