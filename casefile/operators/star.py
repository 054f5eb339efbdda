"""Star schema: three dimensions and seven facts at stated grains."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casefile.functions import date_key, title_label
from casefile.settings import DEFAULT_TOPIC, TOPIC_RULES


def dim_entity(bridge: DataFrame) -> DataFrame:
    """One row per entity. The key fixes the attributes, so they are part of the grouping."""
    grouped = bridge.groupBy(
        "vehicle_key",
        F.col("normalized_make").alias("make"),
        F.col("normalized_model").alias("model"),
        F.col("model_year_int").alias("model_year"),
        "rule_version",
        "threshold_validation_status",
    ).agg(
        F.count_distinct("source_system").alias("source_system_count"),
        F.bool_or("reference_exact_match_flag").alias("reference_exact_match_flag"),
        F.bool_or("reference_year_eligible").alias("reference_year_eligible"),
    )
    return grouped.select(
        "vehicle_key",
        "make",
        "model",
        "model_year",
        "source_system_count",
        "reference_exact_match_flag",
        "reference_year_eligible",
        F.when(F.col("reference_exact_match_flag"), "MATCHED").otherwise("UNRESOLVED").alias("reference_match_status"),
        "rule_version",
        "threshold_validation_status",
        F.concat_ws(" ", F.col("model_year").cast("string"), "make", "model").alias("vehicle_label"),
    )


def dim_date(dated: list[tuple[DataFrame, list[str]]]) -> DataFrame:
    """One row per day between the first and the last date of all listed columns.

    Each frame is read once for all its date columns. The calendar is at most 3.7 million
    days, whatever the data, because dates have four-digit years.
    """
    bounds = None
    for df, names in dated:
        days = F.array(*[F.col(n) for n in names])
        one = df.agg(F.min(F.array_min(days)).alias("low"), F.max(F.array_max(days)).alias("high"))
        bounds = one if bounds is None else bounds.unionByName(one)
    span = bounds.agg(F.min("low").alias("low"), F.max("high").alias("high"))
    days = span.select(F.explode(F.sequence("low", "high")).alias("date"))
    return days.select(
        date_key("date").alias("date_key"),
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month_number"),
        F.date_format("date", "MMMM").alias("month_name"),
        F.date_format("date", "yyyy-MM").alias("year_month"),
        F.weekofyear("date").alias("week_of_year"),
    )


def dim_topic(spark: SparkSession, rules=TOPIC_RULES, default: str = DEFAULT_TOPIC) -> DataFrame:
    """Topic keys and labels: one row per rule label and the default."""
    keys = list(dict.fromkeys([label for _, label in rules] + [default]))
    return spark.createDataFrame([(k,) for k in keys], "topic_key string").withColumn(
        "topic_label", title_label("topic_key")
    )


LINEAGE = ("_source_id", "_batch_id")


def fact(
    df: DataFrame, columns, date_keys: dict[str, str] | None = None, renames: dict[str, str] | None = None, more=()
) -> DataFrame:
    """Select a fact: plain columns, `key name -> date column`, `fact name -> silver column`, lineage if there.

    `more` are silver columns to stand beside the fact's own; those it has are not repeated.
    """
    picked = [F.col(c) for c in columns]
    picked += [date_key(source).alias(name) for name, source in (date_keys or {}).items()]
    picked += [F.col(source).alias(name) for name, source in (renames or {}).items()]
    own = {*columns, *(date_keys or {}), *(renames or {})}
    return df.select(*picked, *[c for c in LINEAGE if c in df.columns], *[c for c in more if c not in own])


def fact_complaint(silver: DataFrame, more=()) -> DataFrame:
    return fact(
        silver,
        "complaint_record_id complaint_id vehicle_key component_name evidence_topic crash_reported_flag "
        "fire_reported_flag severe_report_flag injury_count_int death_count_int mileage_at_failure_int "
        "incident_state".split(),
        {"incident_date_key": "incident_date_parsed", "received_date_key": "received_date"},
        more=more,
    )


def fact_recall(silver: DataFrame, more=()) -> DataFrame:
    return fact(
        silver,
        "recall_record_id campaign_number vehicle_key component_name evidence_topic "
        "potential_units_affected_int do_not_drive park_outside filing_manufacturer defect_summary "
        "consequence_summary corrective_action".split(),
        {"report_received_date_key": "report_received_date_parsed"},
        more=more,
    )


def fact_investigation(silver: DataFrame, more=()) -> DataFrame:
    return fact(
        silver,
        "investigation_record_key investigation_number vehicle_key open_investigation_flag component_name "
        "evidence_topic subject summary campaign_number".split(),
        {"opened_date_key": "opened_date_parsed", "closed_date_key": "closed_date_parsed"},
        more=more,
    )


def fact_communication(silver: DataFrame, more=()) -> DataFrame:
    return fact(
        silver,
        "communication_record_key nhtsa_communication_id document_id vehicle_key communication_type "
        "nhtsa_components evidence_topic summary".split(),
        {"communication_date_key": "communication_date"},
        more=more,
    )


def fact_ncap(silver: DataFrame, more=()) -> DataFrame:
    return fact(
        silver,
        "ncap_variant_key vehicle_key body_style vehicle_type drive_train num_of_seating "
        "rollover_possibility_decimal static_stability_factor_decimal blind_spot_detection "
        "adaptive_cruise_control frnt_collision_warning lane_departure_warning".split(),
        renames={
            "overall_stars": "overall_stars_int",
            "overall_front_stars": "overall_frnt_stars_int",
            "overall_side_stars": "overall_side_stars_int",
            "rollover_stars": "rollover_stars_int",
        },
        more=more,
    )


def fact_fuel(silver: DataFrame, more=()) -> DataFrame:
    return fact(
        silver,
        ["vehicle_key", "drive", "trany"],
        renames={
            "epa_vehicle_id": "id_int",
            "vehicle_class": "VClass",
            "fuel_type": "fuelType",
            "cylinders": "cylinders_int",
            "engine_displacement_liters": "displ_decimal",
            "city_mpg": "city08_int",
            "highway_mpg": "highway08_int",
            "combined_mpg": "comb08_int",
            "annual_fuel_cost": "fuelCost08_int",
            "ghg_score": "ghgScore_int",
            "tailpipe_co2_grams_per_mile": "co2TailpipeGpm_decimal",
            "range_miles": "range_int",
        },
        more=more,
    )


def fact_registration(silver: DataFrame, more=()) -> DataFrame:
    return fact(
        silver,
        ["state_name", "category_normalized", "registration_type_normalized", "registered_vehicles"],
        renames={"year": "year_int"},
        more=more,
    )


# Silver name -> fact builder.
FACTS = {
    "complaints": fact_complaint,
    "recalls": fact_recall,
    "investigations": fact_investigation,
    "communications": fact_communication,
    "ratings": fact_ncap,
    "variants": fact_fuel,
    "registrations": fact_registration,
}

# Silver name -> every date column that becomes a date key or a report axis.
DATED_COLUMNS = {
    "complaints": ["incident_date_parsed", "received_date"],
    "recalls": ["report_received_date_parsed"],
    "investigations": ["opened_date_parsed", "closed_date_parsed"],
    "communications": ["communication_date"],
}


def calendar(silver: dict[str, DataFrame]) -> DataFrame:
    """The date dimension over every date used as a key."""
    return dim_date([(silver[name], columns) for name, columns in DATED_COLUMNS.items()])


def orphan_keys(dim: DataFrame, facts: dict[str, DataFrame], key: str = "vehicle_key") -> DataFrame:
    """(fact_name, key) pairs of fact keys the dimension does not have.

    An anti join by one grouping: each key carries a bit per fact that holds it and whether
    the dimension holds it. Keys collapse within each map task before the only shuffle,
    where a join would be pushed below the distinct and shuffle the facts' rows. A key that is a digest's
    letters is shuffled as its bytes, half as long; any other as it is.
    """
    names = list(facts)
    packed = F.unhex(key)
    is_digest = F.coalesce(F.lower(F.hex(packed)) == F.col(key), F.lit(False))
    halves = [F.when(is_digest, packed).alias("_packed"), F.when(~is_digest, F.col(key)).alias("_plain")]
    tagged = [
        df.filter(F.col(key).isNotNull()).select(*halves, F.lit(1 << i).cast("bigint").alias("bit"), F.lit(False).alias("known"))
        for i, df in enumerate(facts.values())
    ]
    tagged.append(dim.select(*halves, F.lit(0).cast("bigint").alias("bit"), F.lit(True).alias("known")))
    per_key = (
        reduce(DataFrame.unionByName, tagged)
        .groupBy("_packed", "_plain")
        .agg(F.bit_or("bit").alias("mask"), F.bool_or("known").alias("known"))
        .filter(~F.col("known"))
        .withColumn(key, F.coalesce("_plain", F.lower(F.hex("_packed"))))
    )
    holders = F.array_compact(F.array(*[F.expr(f"if(mask & {1 << i} <> 0, '{n}', NULL)") for i, n in enumerate(names)]))
    return per_key.select(F.explode(holders).alias("fact_name"), key)
