"""Contract schemas. Every landed column is text; names and order are part of the contract."""

from __future__ import annotations

# Ordered column names of the seven extracts.
CONTRACTS = {
    "complaints": [
        "complaint_record_id", "complaint_id", "manufacturer_name", "source_make", "source_model", "model_year",
        "crash_flag", "incident_date", "fire_flag", "injury_count", "death_count", "component_name",
        "record_created_date", "complaint_received_date", "mileage_at_failure", "occurrence_count",
        "complaint_type", "police_report_flag", "product_type", "medical_attention_flag", "vehicle_towed_flag",
        "incident_state",
    ],
    "recalls": [
        "recall_record_id", "campaign_number", "source_make", "source_model", "model_year",
        "manufacturer_campaign_number", "component_name", "filing_manufacturer", "product_type",
        "potential_units_affected", "recall_initiator", "report_received_date", "defect_summary",
        "consequence_summary", "corrective_action", "recalled_component_id", "do_not_drive_flag",
        "park_outside_flag",
    ],
    "investigations": [
        "investigation_number", "source_make", "source_model", "model_year", "component_name", "manufacturer_name",
        "opened_date", "closed_date", "campaign_number", "subject", "summary",
    ],
    "manufacturer_communications": [
        "nhtsa_communication_id", "replacement_document_id", "date_added", "document_id",
        "manufacturer_communication_date", "internal_campaign_or_version", "communication_type", "source_make",
        "source_model", "model_year", "nhtsa_components", "manufacturer_system", "manufacturer_subsystem",
        "summary",
    ],
    "ncap_ratings": [
        "make", "model", "model_yr", "body_style", "vehicle_type", "drive_train", "vehicle_class", "body_frame",
        "num_of_seating", "blind_spot_detection", "adaptive_cruise_control", "abs", "auto_crash_notification",
        "frnt_collision_warning", "nhtsa_fcw_evaluation", "lane_departure_warning", "nhtsa_ldw_evaluation",
        "crash_imminent_brake", "nhtsa_cib_evaluation", "dynamic_brake_support", "nhtsa_dbs_evaluation",
        "nhtsa_esc", "overall_stars", "frnt_driv_stars", "frnt_pass_stars", "overall_frnt_stars", "side_driv_stars",
        "side_pass_stars", "side_barrier_star", "side_pole_stars", "overall_side_stars", "rollover_possibility",
        "static_stabi_factor", "tip", "rollover_stars", "nhtsa_backup_camera", "backup_camera",
    ],
    "fuel_economy": [
        "id", "make", "model", "year", "VClass", "fuelType", "fuelType1", "fuelType2", "drive", "trany",
        "cylinders", "displ", "atvType", "city08", "highway08", "comb08", "cityE", "highwayE", "combE",
        "co2TailpipeGpm", "fuelCost08", "ghgScore", "range", "charge240", "youSaveSpend", "createdOn", "modifiedOn",
    ],
    "state_registrations": [
        "year", "state", "category", "registration_type", "vehicles",
    ],
}

# Columns of the four headerless tab-delimited raw files with their field positions, and the number of fields.
RAW_LAYOUTS = {
    "complaints": [
        ("complaint_record_id", 0), ("complaint_id", 1), ("manufacturer_name", 2), ("source_make", 3),
        ("source_model", 4), ("model_year", 5), ("crash_flag", 6), ("incident_date", 7), ("fire_flag", 8),
        ("injury_count", 9), ("death_count", 10), ("component_name", 11), ("record_created_date", 15),
        ("complaint_received_date", 16), ("mileage_at_failure", 17), ("occurrence_count", 18),
        ("complaint_type", 20), ("police_report_flag", 21), ("product_type", 45), ("medical_attention_flag", 47),
        ("vehicle_towed_flag", 48), ("incident_state", 49),
    ],
    "recalls": [
        ("recall_record_id", 0), ("campaign_number", 1), ("source_make", 2), ("source_model", 3),
        ("model_year", 4), ("manufacturer_campaign_number", 5), ("component_name", 6), ("filing_manufacturer", 7),
        ("product_type", 10), ("potential_units_affected", 11), ("recall_initiator", 13),
        ("report_received_date", 15), ("defect_summary", 19), ("consequence_summary", 20),
        ("corrective_action", 21), ("recalled_component_id", 23), ("do_not_drive_flag", 27),
        ("park_outside_flag", 28),
    ],
    "investigations": [
        ("investigation_number", 0), ("source_make", 1), ("source_model", 2), ("model_year", 3),
        ("component_name", 4), ("manufacturer_name", 5), ("opened_date", 6), ("closed_date", 7),
        ("campaign_number", 8), ("subject", 9), ("summary", 10),
    ],
    "manufacturer_communications": [
        ("nhtsa_communication_id", 0), ("replacement_document_id", 1), ("date_added", 2), ("document_id", 3),
        ("manufacturer_communication_date", 4), ("internal_campaign_or_version", 5), ("communication_type", 6),
        ("source_make", 7), ("source_model", 8), ("model_year", 9), ("nhtsa_components", 10),
        ("manufacturer_system", 11), ("manufacturer_subsystem", 12), ("summary", 13),
    ],
}
RAW_FIELD_COUNTS = {
    "complaints": 51,
    "recalls": 29,
    "investigations": 11,
    "manufacturer_communications": 14,
}

# Header names of the three raw files that have one, by contract column.
RAW_HEADERS = {
    "ncap_ratings": {name: name.upper() for name in CONTRACTS["ncap_ratings"]},
    "fuel_economy": {name: name for name in CONTRACTS["fuel_economy"]},
    "state_registrations": {
        "year": "Year",
        "state": "State",
        "category": "Category",
        "registration_type": "Type",
        "vehicles": "Vehicles",
    },
}

# Raw field names that never leave the landing zone.
FORBIDDEN_COLUMNS = (
    "city",
    "vin",
    "vin_prefix",
    "cdescr",
    "complaint_description",
    "dealer_name",
    "dealer_tel",
    "dealer_phone",
    "dealer_city",
    "dealer_state",
    "dealer_zip",
    "vehicle_operator",
)

# Source identifier of every extract.
SOURCE_IDS = {
    "complaints": "nhtsa_complaints_2025_2026",
    "recalls": "nhtsa_recalls_post_2010",
    "investigations": "nhtsa_investigations_all",
    "manufacturer_communications": "nhtsa_tsbs_2025_2026",
    "ncap_ratings": "nhtsa_ncap_ratings",
    "fuel_economy": "epa_fuel_economy_vehicles",
    "state_registrations": "fhwa_state_registrations",
}

LINEAGE_COLUMNS = (
    "_source_id",
    "_source_file",
    "_source_sha256",
    "_extract_sha256",
    "_batch_id",
    "_ingested_at",
)


def raw_layout(table: str) -> list[tuple[str, int]]:
    """(column name, field position) pairs of a headerless raw file."""
    return list(RAW_LAYOUTS[table])
