"""Conform jobs: bronze text to typed, deduplicated silver rows with an entity key.

Each takes a frame with the contract's column names (or a mapping from contract name to
the frame's own name), keeps the source columns and appends the typed ones. Filters come
before the dedup and the dedup before any wide typing, so that the shuffle carries text once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casefile.functions import (
    blank_to_null,
    cast_columns,
    flag,
    record_key,
    safe_int,
    safe_long,
    severity,
    valid_identity,
    vehicle_key,
    with_entity_key,
    with_topic,
    yyyymmdd,
)
from casefile.operators.dedup import dedup_by_key, dedup_rows
from casefile.settings import IDENTITY_COLUMNS, Settings
from casefile.sources.contracts import CONTRACTS

# Text columns that become integers or doubles.
STAR_COLUMNS = (
    "overall_stars frnt_driv_stars frnt_pass_stars overall_frnt_stars side_driv_stars "
    "side_pass_stars side_barrier_star side_pole_stars overall_side_stars rollover_stars"
).split()
FUEL_INTEGERS = "id cylinders city08 highway08 comb08 fuelCost08 ghgScore range youSaveSpend".split()
FUEL_DECIMALS = "displ cityE highwayE combE co2TailpipeGpm charge240".split()


def apply_mapping(df: DataFrame, mapping: dict[str, str] | None) -> DataFrame:
    """Rename the frame's columns to contract names; mapping is contract name -> own name."""
    return df.withColumnsRenamed({own: name for name, own in (mapping or {}).items()})


def _identified(df: DataFrame, make: str, model: str, year: str, settings: Settings) -> DataFrame:
    return with_entity_key(df, make, model, year, settings.min_year, settings.max_year)


def _topic(df: DataFrame, cols, settings: Settings) -> DataFrame:
    return with_topic(df, cols, settings.topic_rules, settings.default_topic)


def _trim_ids(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: blank_to_null(name) for name in names})


def _one_per_record(df: DataFrame, table: str, keys) -> DataFrame:
    return dedup_by_key(df, keys, digest_of=CONTRACTS[table])


# Silver name -> its record key and the columns that the key is a function of.
RECORD_PARTS = {
    "investigations": ("investigation_record_key", ("investigation_number", "vehicle_key", "component_name")),
    "communications": ("communication_record_key", ("nhtsa_communication_id", "document_id", "vehicle_key", "nhtsa_components")),
    "ratings": ("ncap_variant_key", ("vehicle_key", "body_style", "vehicle_type", "drive_train", "num_of_seating")),
}


def made_keys(source: str, settings: Settings = Settings()) -> dict[str, Column]:
    """The entity key and, if it has one, the record key of a source, from the identity and the columns beside it."""
    key = F.when(valid_identity(settings.min_year, settings.max_year), vehicle_key(*IDENTITY_COLUMNS))
    name, parts = RECORD_PARTS.get(source, (None, ()))
    record = {name: record_key(*[key if c == "vehicle_key" else c for c in parts])} if name else {}
    return {"vehicle_key": key, **record}


def _one_per_record_key(keyed: DataFrame, table: str, source: str, settings: Settings) -> DataFrame:
    """One row for each record key of the source, which is appended.

    The key takes part in the shuffle and its sorts as bytes, not as 64 letters. The first 16 tell records apart, unless
    two keys agree in 128 bits; the others go along only for a query that reads the key. The entity key, a function of
    the identity beside it, stays behind and is made again for the rows that are left.
    """
    name, parts = RECORD_PARTS[source]
    digest = F.unhex(record_key(*parts))
    short = keyed.withColumns({"_record": F.substring(digest, 1, 16), "_record_rest": F.substring(digest, 17, 16)}).drop("vehicle_key")
    made = {"vehicle_key": made_keys(source, settings)["vehicle_key"], name: F.lower(F.hex(F.concat("_record", "_record_rest")))}
    return _one_per_record(short, table, "_record").withColumns(made).drop("_record", "_record_rest")


def conform_complaints(df: DataFrame, settings: Settings = Settings(), mapping=None) -> DataFrame:
    landed = apply_mapping(df, mapping).filter(F.col("product_type") == settings.product_value)
    rows = _trim_ids(_one_per_record(landed, "complaints", "complaint_record_id"), "complaint_id")
    typed = _identified(rows, "source_make", "source_model", "model_year", settings).withColumns(
        {
            "incident_date_parsed": yyyymmdd("incident_date"),
            "received_date": yyyymmdd("complaint_received_date"),
            "record_created_date_parsed": yyyymmdd("record_created_date"),
            "injury_count_int": safe_int("injury_count", 0),
            "death_count_int": safe_int("death_count", 0),
            "mileage_at_failure_int": safe_long("mileage_at_failure"),
            "crash_reported_flag": flag("crash_flag"),
            "fire_reported_flag": flag("fire_flag"),
            "medical_attention_reported_flag": flag("medical_attention_flag"),
            "vehicle_towed_reported_flag": flag("vehicle_towed_flag"),
        }
    )
    severe = severity("crash_reported_flag", "fire_reported_flag", "injury_count_int", "death_count_int")
    return _topic(typed.withColumn("severe_report_flag", severe), ["component_name"], settings)


def conform_recalls(df: DataFrame, settings: Settings = Settings(), mapping=None) -> DataFrame:
    landed = apply_mapping(df, mapping).filter(F.col("product_type") == settings.product_value)
    rows = _trim_ids(_one_per_record(landed, "recalls", "recall_record_id"), "campaign_number")
    typed = _identified(rows, "source_make", "source_model", "model_year", settings).withColumns(
        {
            "report_received_date_parsed": yyyymmdd("report_received_date"),
            "potential_units_affected_int": safe_long("potential_units_affected"),
            "do_not_drive": flag("do_not_drive_flag"),
            "park_outside": flag("park_outside_flag"),
        }
    )
    return _topic(typed, ["component_name", "defect_summary", "consequence_summary"], settings)


def conform_investigations(df: DataFrame, settings: Settings = Settings(), mapping=None) -> DataFrame:
    landed = _trim_ids(apply_mapping(df, mapping), "investigation_number", "campaign_number")
    keyed = _identified(landed, "source_make", "source_model", "model_year", settings)
    rows = _one_per_record_key(keyed, "investigations", "investigations", settings)
    typed = rows.withColumns(
        {"opened_date_parsed": yyyymmdd("opened_date"), "closed_date_parsed": yyyymmdd("closed_date")}
    ).withColumn("open_investigation_flag", F.col("closed_date_parsed").isNull())
    return _topic(typed, ["component_name", "subject", "summary"], settings)


def conform_communications(df: DataFrame, settings: Settings = Settings(), mapping=None) -> DataFrame:
    # Exact duplicate rows share the record key, so the dedup by key removes them as well.
    landed = _trim_ids(apply_mapping(df, mapping), "nhtsa_communication_id", "document_id")
    keyed = _identified(landed, "source_make", "source_model", "model_year", settings)
    rows = _one_per_record_key(keyed, "manufacturer_communications", "communications", settings)
    typed = rows.withColumns(
        {
            "date_added_parsed": yyyymmdd("date_added"),
            "communication_date": yyyymmdd("manufacturer_communication_date"),
        }
    )
    texts = ["nhtsa_components", "manufacturer_system", "manufacturer_subsystem", "summary"]
    return _topic(typed, texts, settings)


def conform_ratings(df: DataFrame, settings: Settings = Settings(), mapping=None) -> DataFrame:
    rows = dedup_rows(apply_mapping(df, mapping))
    typed = cast_columns(
        _identified(rows, "make", "model", "model_yr", settings),
        {**dict.fromkeys(STAR_COLUMNS, "int"), "rollover_possibility": "double", "static_stabi_factor": "double"},
    ).withColumnRenamed("static_stabi_factor_decimal", "static_stability_factor_decimal")
    name, parts = RECORD_PARTS["ratings"]
    return typed.withColumn(name, record_key(*parts))


def conform_variants(df: DataFrame, settings: Settings = Settings(), mapping=None) -> DataFrame:
    rows = _trim_ids(_one_per_record(apply_mapping(df, mapping), "fuel_economy", "id"), "id")
    return cast_columns(
        _identified(rows, "make", "model", "year", settings),
        {**dict.fromkeys(FUEL_INTEGERS, "int"), **dict.fromkeys(FUEL_DECIMALS, "double")},
    )


def conform_registrations(df: DataFrame, settings: Settings = Settings(), mapping=None) -> DataFrame:
    keys = ["year", "state", "category", "registration_type"]
    rows = _one_per_record(apply_mapping(df, mapping), "state_registrations", keys)
    return rows.withColumns(
        {
            "year_int": safe_int("year"),
            "state_name": F.initcap(F.trim("state")),
            "category_normalized": F.upper(F.trim("category")),
            "registration_type_normalized": F.upper(F.trim("registration_type")),
            "registered_vehicles": safe_long("vehicles"),
        }
    )


# Silver name -> (contract table, conform job).
CONFORM_JOBS = {
    "complaints": ("complaints", conform_complaints),
    "recalls": ("recalls", conform_recalls),
    "investigations": ("investigations", conform_investigations),
    "communications": ("manufacturer_communications", conform_communications),
    "ratings": ("ncap_ratings", conform_ratings),
    "variants": ("fuel_economy", conform_variants),
    "registrations": ("state_registrations", conform_registrations),
}
