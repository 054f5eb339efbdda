"""Report queries over the star schema, the mart and the audit table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casefile.functions import label_rank, ratio
from casefile.functions.labels import ALIAS_ORDER, PRIORITY_ORDER
from casefile.operators.mart import median_by
from casefile.plans.lookup import of_entities


def _distinct_ids(df: DataFrame, by, id_col: str, name: str) -> DataFrame:
    """Distinct non-NULL ids per group, as a grouping by (group, id) followed by a count."""
    by = list(by)
    return df.filter(F.col(id_col).isNotNull()).select(*by, id_col).distinct().groupBy(*by).agg(F.count("*").alias(name))


def _year_month(date_key: str) -> Column:
    key = F.col(date_key)
    return F.concat_ws(
        "-",
        F.lpad((key / 10000).cast("int").cast("string"), 4, "0"),
        F.lpad(((key / 100).cast("int") % 100).cast("string"), 2, "0"),
    )


def _side_by_side(parts: list[DataFrame], by) -> DataFrame:
    """Merge count frames on their group columns; a group missing from one part counts 0 there."""
    by = list(by)
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    counts = [c for c in union.columns if c not in by]
    return union.groupBy(*by).agg(*[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in counts])


# --- executive ------------------------------------------------------------------------------


def priority_by_reason(mart: DataFrame) -> DataFrame:
    return mart.groupBy("review_priority", "review_reason").agg(F.count("*").alias("vehicles"))


def priority_counts(mart: DataFrame) -> DataFrame:
    """Entities per label of the three label columns, in long form and one pass."""
    per_labels = mart.groupBy("review_priority", "review_reason", "alias_priority").agg(F.count("*").alias("n"))
    labels = F.array(
        *[
            F.struct(F.lit(c).alias("label_type"), F.col(c).alias("label"))
            for c in ("review_priority", "review_reason", "alias_priority")
        ]
    )
    return (
        per_labels.select(F.explode(labels).alias("l"), "n")
        .groupBy(F.col("l.label_type").alias("label_type"), F.col("l.label").alias("label"))
        .agg(F.sum("n").alias("vehicles"))
    )


def queue_ranked(mart: DataFrame) -> DataFrame:
    """Mart rows with the sort ranks of both priority scales."""
    return mart.select(
        "vehicle_key",
        "vehicle_label",
        "review_priority",
        label_rank("review_priority", PRIORITY_ORDER).alias("review_priority_rank"),
        "alias_priority",
        label_rank("alias_priority", ALIAS_ORDER).alias("alias_priority_rank"),
    )


def top_queue(queue: DataFrame, n: int = 20) -> DataFrame:
    """First n of the review queue; the key makes the order total. Spark keeps n rows per task."""
    ranked = queue.withColumn("review_priority_rank", label_rank("review_priority", PRIORITY_ORDER))
    return (
        ranked.orderBy(
            "review_priority_rank",
            F.desc("complaint_reports"),
            F.desc("severe_complaint_reports"),
            F.desc("recall_campaigns"),
            "vehicle_key",
        )
        .limit(n)
        .select(
            "vehicle_label",
            "review_priority",
            "review_reason",
            "complaint_reports",
            "severe_complaint_reports",
            "recall_campaigns",
            "open_investigations",
            "manufacturer_documents",
        )
    )


def scatter_severity(mart: DataFrame) -> DataFrame:
    return mart.filter("complaint_reports > 0").select(
        "vehicle_key",
        "vehicle_label",
        "review_priority",
        "complaint_reports",
        "severe_complaint_share",
        "recall_campaigns",
    )


def queue_unresolved_share(mart: DataFrame) -> DataFrame:
    """One row: unresolved share of the review queue and its alias split."""
    unresolved = F.col("reference_match_status") == "UNRESOLVED"
    return (
        mart.filter(F.col("review_priority") != "MONITOR")
        .agg(
            F.count("*").alias("queue_vehicles"),
            F.count_if(unresolved).alias("unresolved_vehicles"),
            *[
                F.count_if(unresolved & (F.col("alias_priority") == p)).alias(f"unresolved_{p.lower()}")
                for p in ("P0", "P1", "P2")
            ],
        )
        .withColumn("unresolved_share", ratio("unresolved_vehicles", "queue_vehicles"))
    )


def entity_matrix(mart: DataFrame) -> DataFrame:
    counts = (
        "complaint_reports recall_campaigns open_investigations manufacturer_documents "
        "ncap_tested_variants epa_variants"
    ).split()
    return mart.groupBy("make", "model", "model_year").agg(*[F.sum(c).alias(c) for c in counts])


# Family -> (fact, business id, date key).
FAMILIES = {
    "complaints": ("complaint", "complaint_id", "received_date_key"),
    "recalls": ("recall", "campaign_number", "report_received_date_key"),
    "investigations": ("investigation", "investigation_number", "opened_date_key"),
    "communications": ("communication", "document_id", "communication_date_key"),
}


def _dated_ids(model: dict[str, DataFrame], families) -> DataFrame:
    frames = []
    for family in families:
        table, id_col, key = FAMILIES[family]
        frames.append(
            model[table]
            .filter(F.col(key).isNotNull())
            .select(
                F.lit(family).alias("source_family"),
                _year_month(key).alias("year_month"),
                F.col(id_col).alias("business_id"),
            )
        )
    return reduce(DataFrame.unionByName, frames)


def trend_by_family(model: dict[str, DataFrame], families=tuple(FAMILIES)) -> DataFrame:
    """Distinct business ids per source family and month of its own date."""
    return _distinct_ids(_dated_ids(model, families), ["source_family", "year_month"], "business_id", "events")


def trend_without_gaps(model: dict[str, DataFrame], families=tuple(FAMILIES)) -> DataFrame:
    """`trend_by_family` with a row for every month from a family's first to its last; months without events count 0.

    The months come from each family's own first and last one, a row per family, not from the calendar times
    the families.
    """
    trend = trend_by_family(model, families)
    day = F.to_date(F.concat("year_month", F.lit("-01")))
    ends = trend.groupBy("source_family").agg(F.min(day).alias("first"), F.max(day).alias("last"))
    months = ends.select("source_family", F.explode(F.expr("sequence(first, last, interval 1 month)")).alias("month"))
    every = months.select("source_family", F.date_format("month", "yyyy-MM").alias("year_month"))
    return every.join(trend, ["source_family", "year_month"], "left").fillna(0, subset="events")


def formal_timeline(model: dict[str, DataFrame]) -> DataFrame:
    """Campaigns and investigation openings per month."""
    return trend_by_family(model, ("recalls", "investigations"))


def entity_drillthrough(model: dict[str, DataFrame], keys: list[str] | DataFrame) -> DataFrame:
    """All evidence of the chosen entities as one timeline.

    `keys` are a few vehicle keys, which become conditions of every fact's scan, or a frame of many.
    """
    parts = [
        ("complaint", "complaint_record_id", "received_date_key", "evidence_topic", "component_name"),
        ("recall", "recall_record_id", "report_received_date_key", "evidence_topic", "consequence_summary corrective_action"),
        ("investigation", "investigation_record_key", "opened_date_key", "evidence_topic", "subject summary"),
        ("communication", "communication_record_key", "communication_date_key", "evidence_topic", "summary"),
        ("ncap", "ncap_variant_key", None, None, "body_style"),
        ("fuel", "epa_vehicle_id", None, None, "vehicle_class"),
    ]
    frames = []
    for table, record, key, topic, detail in parts:
        frames.append(
            of_entities(model[table], keys).select(
                "vehicle_key",
                F.lit(table).alias("source_family"),
                F.col(record).cast("string").alias("record_id"),
                (F.col(key) if key else F.lit(None).cast("int")).alias("date_key"),
                (F.col(topic) if topic else F.lit(None).cast("string")).alias("evidence_topic"),
                F.concat_ws(" | ", *detail.split()).alias("detail"),
            )
        )
    return reduce(DataFrame.unionByName, frames)


def entity_header(mart: DataFrame, chosen: DataFrame) -> DataFrame:
    """Identity, match status, labels with their reasons, and counts of the chosen entity, one row with its vehicle_key."""
    columns = (
        "vehicle_key vehicle_label make model model_year reference_match_status reference_year_eligible "
        "review_priority review_reason alias_priority alias_reason complaint_reports severe_complaint_reports "
        "recall_campaigns open_investigations manufacturer_documents ncap_tested_variants epa_variants rule_version"
    ).split()
    return mart.select(*columns).join(F.broadcast(chosen.select("vehicle_key")), "vehicle_key")


def first_critical(mart: DataFrame) -> DataFrame:
    """One row: the smallest key among the critical entities."""
    return mart.filter(F.col("review_priority") == "CRITICAL").agg(F.min("vehicle_key").alias("vehicle_key"))


# --- recalls and investigations -------------------------------------------------------------


_MAKE_MODEL = ("normalized_make AS make", "normalized_model AS model")


def _identified(silver: DataFrame, *columns) -> DataFrame:
    """Rows that name an entity. Silver rows carry its make, model and year, so no dimension is joined."""
    return silver.filter("vehicle_key IS NOT NULL").selectExpr(*columns)


def topic_make_matrix(recalls: DataFrame, investigations: DataFrame) -> DataFrame:
    """Distinct campaigns and investigations per topic, make and model, from silver rows."""
    by = ["evidence_topic", "make", "model"]
    campaigns = _identified(recalls, "evidence_topic", *_MAKE_MODEL, "campaign_number")
    openings = _identified(investigations, "evidence_topic", *_MAKE_MODEL, "investigation_number")
    return _side_by_side(
        [
            _distinct_ids(campaigns, by, "campaign_number", "recall_campaigns"),
            _distinct_ids(openings, by, "investigation_number", "investigations"),
        ],
        by,
    )


def campaign_table(recall: DataFrame) -> DataFrame:
    """One row per campaign; texts and flags are maxima over its rows. Records without a number are none."""
    return recall.filter("campaign_number IS NOT NULL").groupBy("campaign_number").agg(
        F.max("filing_manufacturer").alias("filing_manufacturer"),
        F.max("consequence_summary").alias("consequence_summary"),
        F.max("corrective_action").alias("corrective_action"),
        F.bool_or("do_not_drive").alias("do_not_drive"),
        F.bool_or("park_outside").alias("park_outside"),
        F.max("potential_units_affected_int").alias("potential_units_affected"),
        F.count("*").alias("records"),
    )


# --- complaints -----------------------------------------------------------------------------


def star_monthly_topic(model: dict[str, DataFrame], roles=("received_date_key",)) -> DataFrame:
    """Distinct complaints per month and topic label under each chosen date role.

    The fact is read once for all roles. Complaints are made distinct per (role, day, topic)
    before the two dimension joins.
    """
    dates = F.array(*[F.struct(F.lit(r).alias("date_role"), F.col(r).alias("date_key")) for r in roles])
    days = (
        model["complaint"]
        .filter(F.col("complaint_id").isNotNull())
        .select(F.explode(dates).alias("d"), F.col("evidence_topic").alias("topic_key"), "complaint_id")
        .select("d.*", "topic_key", "complaint_id")
        .distinct()
        .join(model["calendar"].select("date_key", "year_month"), "date_key")
        .join(F.broadcast(model["topic"]), "topic_key")  # one row per rule label
    )
    return _distinct_ids(days, ["year_month", "topic_label", "date_role"], "complaint_id", "complaint_reports")


def topic_pareto(complaint: DataFrame) -> DataFrame:
    """Topics by distinct complaints with their cumulative share.

    The window has no partition, but it runs over one row per topic label of the rule list.
    """
    per_topic = _distinct_ids(complaint, ["evidence_topic"], "complaint_id", "complaint_reports")
    order = Window.orderBy(F.desc("complaint_reports"), "evidence_topic")
    running = F.sum("complaint_reports").over(order.rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("complaint_reports").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return per_topic.select(
        "evidence_topic",
        "complaint_reports",
        F.row_number().over(order).alias("rank"),
        running.alias("cumulative_reports"),
        ratio(running, total).alias("cumulative_share"),
    )


def component_pareto(complaint: DataFrame) -> DataFrame:
    """Components of each topic by distinct complaints with their cumulative share of the topic.

    The window is partitioned by topic and runs over one row per component.
    """
    per_component = _distinct_ids(complaint, ["evidence_topic", "component_name"], "complaint_id", "complaint_reports")
    topic = Window.partitionBy("evidence_topic")
    order = topic.orderBy(F.desc("complaint_reports"), "component_name")
    running = F.sum("complaint_reports").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return per_component.select(
        "evidence_topic",
        "component_name",
        "complaint_reports",
        F.row_number().over(order).alias("rank"),
        running.alias("cumulative_reports"),
        ratio(running, F.sum("complaint_reports").over(topic)).alias("cumulative_share"),
    )


def matrix_min_reports(complaints: DataFrame, min_reports: int = 10) -> DataFrame:
    """Distinct complaints, severe complaints and entities per make and model with enough reports, from silver rows."""
    by = ["make", "model"]
    rows = _identified(complaints, *_MAKE_MODEL, "model_year_int", "complaint_id", "severe_report_flag")
    rows = rows.filter("complaint_id IS NOT NULL")
    events = rows.groupBy(*by, "complaint_id").agg(F.max(F.col("severe_report_flag").cast("int")).alias("severe"))
    years = rows.select(*by, "model_year_int").distinct()
    counted = [
        events.select(*by, F.lit(1).alias("complaint"), "severe"),
        years.select(*by, F.lit(1).alias("entity")),
    ]
    return (
        reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), counted)
        .groupBy(*by)
        .agg(
            F.count("complaint").alias("complaint_reports"),
            F.sum("severe").alias("severe_complaint_reports"),
            F.count("entity").alias("entities"),
        )
        .filter(F.col("complaint_reports") >= min_reports)
        .withColumn("severe_complaint_share", ratio("severe_complaint_reports", "complaint_reports"))
    )


def reports_by_state(complaint: DataFrame) -> DataFrame:
    return _distinct_ids(complaint, ["incident_state"], "complaint_id", "complaint_reports")


# --- manufacturer communications ------------------------------------------------------------


def communication_topics(communication: DataFrame) -> DataFrame:
    """Distinct documents per month, topic and document type."""
    dated = communication.filter(F.col("communication_date_key").isNotNull()).withColumn(
        "year_month", _year_month("communication_date_key")
    )
    return _distinct_ids(
        dated, ["year_month", "evidence_topic", "communication_type"], "document_id", "documents"
    )


def topic_decomposition(communications: DataFrame) -> DataFrame:
    """Distinct documents from topic to system to component to make and model, from silver rows."""
    by = ["evidence_topic", "manufacturer_system", "nhtsa_components"]
    rows = _identified(communications, *by, *_MAKE_MODEL, "document_id")
    return _distinct_ids(rows, [*by, "make", "model"], "document_id", "documents")


# --- vehicle context ------------------------------------------------------------------------


def rating_distribution(ratings: DataFrame) -> DataFrame:
    """Tested variants per model year and star rating, from silver rows."""
    columns = ("model_year_int AS model_year", "overall_stars_int AS overall_stars", "ncap_variant_key")
    rated = _identified(ratings, *columns)
    return _distinct_ids(rated, ["model_year", "overall_stars"], "ncap_variant_key", "variants")


def mpg_cost(fuel: DataFrame) -> DataFrame:
    """Variants per fuel type, combined mileage and annual cost: the points of the scatter with their weight."""
    return fuel.groupBy("fuel_type", "combined_mpg", "annual_fuel_cost").agg(F.count("*").alias("variants"))


def variant_table(variants: DataFrame) -> DataFrame:
    """Configurations with drivetrain, transmission, class and how many variants share them, from silver rows."""
    label = "concat_ws(' ', string(model_year_int), normalized_make, normalized_model) AS vehicle_label"
    rows = _identified(variants, label, "drive", "trany", "VClass AS vehicle_class", "id_int")
    return _distinct_ids(rows, ["vehicle_label", "drive", "trany", "vehicle_class"], "id_int", "variants")


def fuel_spread(fuel: DataFrame) -> DataFrame:
    """Minimum, median and maximum mileage with the number of variants, per entity."""
    keyed = fuel.filter(F.col("vehicle_key").isNotNull())
    spread = keyed.groupBy("vehicle_key").agg(
        F.count("*").alias("variants"),
        F.min("combined_mpg").alias("min_combined_mpg"),
        F.max("combined_mpg").alias("max_combined_mpg"),
    )
    return spread.join(median_by(keyed, ["vehicle_key"], {"median_combined_mpg": "combined_mpg"}), "vehicle_key")


# --- trust ----------------------------------------------------------------------------------


def data_trust(audit: DataFrame, quality: DataFrame) -> DataFrame:
    """Ingest audit and match quality as two typed sections of one table."""
    bronze = audit.select(
        F.lit("bronze_ingestion_audit").alias("section"),
        "batch_id",
        "table_name",
        "source_id",
        "expected_rows",
        "actual_rows",
        "schema_matches",
        "row_count_matches",
        "status",
    )
    return bronze.unionByName(
        quality.withColumn("section", F.lit("entity_match_quality")), allowMissingColumns=True
    )


# Curated export: approved columns of the mart and of the alias queue.
# Ordered column names.
EVIDENCE_SUMMARY_COLUMNS = [
    "vehicle_key", "vehicle_label", "make", "model", "model_year", "review_priority", "review_reason",
    "alias_priority", "complaint_reports", "severe_complaint_reports", "crash_reported_complaints",
    "fire_reported_complaints", "recall_campaigns", "do_not_drive_campaigns", "park_outside_campaigns",
    "investigations", "open_investigations", "manufacturer_documents", "ncap_tested_variants", "epa_variants",
    "severe_complaint_share", "evidence_source_count", "source_system_count", "reference_match_status",
    "reference_year_eligible", "rule_version", "threshold_validation_status",
]
# Ordered column names.
ALIAS_EXPORT_COLUMNS = [
    "vehicle_key", "vehicle_label", "alias_priority", "alias_reason", "source_system_count",
    "complaint_reports", "severe_complaint_reports", "recall_campaigns", "do_not_drive_campaigns",
    "park_outside_campaigns", "open_investigations", "manufacturer_documents", "review_status",
]
