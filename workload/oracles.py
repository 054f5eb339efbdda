"""SQL for every registered query that SQL can express, over the given tables as views."""

from __future__ import annotations

from workload.oracle_base import (
    C_COMPLAINTS,
    C_COMMUNICATIONS,
    C_INVESTIGATIONS,
    C_RATINGS,
    C_RECALLS,
    C_REGISTRATIONS,
    C_VARIANTS,
    FUEL_DECIMAL,
    FUEL_WHOLE,
    KEY,
    decimal,
    identity,
    norm,
    whole,
    with_tables,
    yes,
)

# --- files ----------------------------------------------------------------------------------

# table, source id, bronze table, columns
_EXTRACTS = [
    ("complaints", "nhtsa_complaints_2025_2026", "b_complaints", C_COMPLAINTS),
    ("recalls", "nhtsa_recalls_post_2010", "b_recalls", C_RECALLS),
    ("investigations", "nhtsa_investigations_all", "b_investigations", C_INVESTIGATIONS),
    ("manufacturer_communications", "nhtsa_tsbs_2025_2026", "b_communications", C_COMMUNICATIONS),
    ("ncap_ratings", "nhtsa_ncap_ratings", "b_ratings", C_RATINGS),
    ("fuel_economy", "epa_fuel_economy_vehicles", "b_variants", C_VARIANTS),
    ("state_registrations", "fhwa_state_registrations", "b_registrations", C_REGISTRATIONS),
]


def _manifest_rows(extra: str = "", only=None) -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{s}' AS source_id, '{t}.csv.gz' AS output_file, count(*) AS rows, "
        f"'{','.join(c.split())}' AS column_list, CAST(0 AS BIGINT) AS malformed_rows{extra} FROM {b}"
        for t, s, b, c in _EXTRACTS
        if only is None or t in only
    )


def _audit(batch: str, spoil: bool) -> str:
    rows = []
    for t, s, b, _ in _EXTRACTS:
        more = 1 if spoil and t == "recalls" else 0
        schema = not (spoil and t == "investigations")
        status = "PASS" if schema and not more else "FAIL"
        rows.append(
            f"SELECT '{batch}' AS batch_id, '{t}' AS table_name, '{s}' AS source_id, '{t}.csv.gz' AS source_file, "
            f"count(*) + {more} AS expected_rows, count(*) AS actual_rows, {schema} AS schema_matches, "
            f"{more == 0} AS row_count_matches, '{status}' AS status FROM {b}"
        )
    return " UNION ALL ".join(rows)


# The raw line of a line item up to its last field, tab-delimited.
_RAW_HEAD = (
    "concat_ws(chr(9), l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, 'open', 'a \"quoted word', '', "
    "l_linestatus, strftime(l_shipdate, '%Y%m%d'))"
)
_RAW_BAD = "count(*) FILTER (WHERE l_linenumber IN (6, 7))"


def _quality(by: str = "") -> str:
    """Match rates over keys made distinct first, per source system or overall."""
    group = f"{by}, " if by else ""
    return f"""
  SELECT {group}count(*) AS distinct_vehicle_keys, count(*) FILTER (WHERE m) AS reference_exact_match_keys,
    count(*) FILTER (WHERE e) AS era_eligible_vehicle_keys, count(*) FILTER (WHERE m AND e) AS era_eligible_reference_exact_match_keys,
    CAST(count(*) FILTER (WHERE m) AS DOUBLE) / nullif(count(*), 0) AS reference_exact_match_rate,
    CAST(count(*) FILTER (WHERE m AND e) AS DOUBLE) / nullif(count(*) FILTER (WHERE e), 0) AS era_eligible_reference_exact_match_rate
  FROM (SELECT {group}vehicle_key, bool_or(reference_exact_match_flag) AS m, bool_or(reference_year_eligible) AS e
        FROM bridge GROUP BY {group}vehicle_key) {f"GROUP BY {by}" if by else ""}"""


_QUALITY = _quality("source_system")


def _of_source(system: str, columns: str) -> str:
    return (
        f"SELECT vehicle_key, {columns} FROM counts JOIN middles USING (vehicle_key) "
        f"WHERE list_contains(systems, '{system}')"
    )


_SUMMARY = (
    "vehicle_key, vehicle_label, make, model, model_year, review_priority, review_reason, alias_priority, "
    "complaint_reports, severe_complaint_reports, crash_reported_complaints, fire_reported_complaints, "
    "recall_campaigns, do_not_drive_campaigns, park_outside_campaigns, investigations, open_investigations, "
    "manufacturer_documents, ncap_tested_variants, epa_variants, severe_complaint_share, evidence_source_count, "
    "source_system_count, reference_match_status, reference_year_eligible, rule_version, threshold_validation_status"
)
_COUNTS = (
    "complaint_reports severe_complaint_reports crash_reported_complaints fire_reported_complaints "
    "reported_injuries reported_deaths recall_campaigns do_not_drive_campaigns park_outside_campaigns "
    "investigations open_investigations manufacturer_documents ncap_tested_variants epa_variants"
).split()

FILES = {
    "scan_csv_contract": "SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, source, text FROM documents",
    "scan_positional": with_tables(
        "SELECT "
        + ", ".join(
            "'Société ' || manufacturer_name AS manufacturer_name" if c == "manufacturer_name" else f"trim({c}) AS {c}"
            for c in C_COMPLAINTS.split()
        )
        + " FROM b_complaints"
    ),
    "scan_named": with_tables(
        "SELECT " + ", ".join(f"trim({c}) AS {c}" for c in C_REGISTRATIONS.split()) + " FROM b_registrations"
    ),
    "table_by_name": "SELECT * FROM nation",
    "irregular_rows": "SELECT count(*) AS rows, count(*) FILTER (WHERE user_id % 10 IN (3, 7)) AS irregular_rows FROM events",
    "scan_irregular": "SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, "
    "CASE user_id % 10 WHEN 3 THEN '' WHEN 7 THEN 'click' ELSE event_type END AS event_type FROM events",
    "rejected_lines": "SELECT 'raw_lines' AS table_name, 'raw_lines' AS source_id, CASE l_linenumber WHEN 7 THEN 10 ELSE 12 END AS n_fields, "
    + f"{_RAW_HEAD} || CASE l_linenumber WHEN 7 THEN '' ELSE chr(9) || 'end' || chr(9) || 'extra' END AS line "
    + "FROM lineitem WHERE l_linenumber IN (6, 7)",
    "approved_lines": "SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS VARCHAR) AS line_id, "
    "'a \"quoted word' AS note, '' AS blank, strftime(l_shipdate, '%Y%m%d') AS ship_day, 'end' AS \"last\" "
    "FROM lineitem WHERE l_linenumber NOT IN (6, 7)",
    "intake_audit": "SELECT 'raw_lines' AS table_name, count(*) FILTER (WHERE l_linenumber NOT IN (6, 7)) AS rows, "
    "count(*) FILTER (WHERE l_linenumber IN (6, 7)) AS rejected_rows, CAST(0 AS BIGINT) AS irregular_rows, "
    "CASE WHEN count(*) FILTER (WHERE l_linenumber IN (6, 7)) > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM lineitem "
    "UNION ALL SELECT 'raw_events', count(*), 0, count(*) FILTER (WHERE user_id % 10 IN (3, 7)), 'PASS' FROM events",
    "verify_checksums": "SELECT *, table_name <> 'state_registrations' AS checksum_matches FROM (VALUES "
    + ", ".join(f"('{t}')" for t, *_ in _EXTRACTS)
    + ") t(table_name) WHERE EXISTS (SELECT 1 FROM nation WHERE n_name ILIKE '%a%')",
    "malformed_rows": f"SELECT count(*) AS rows, {_RAW_BAD} AS malformed_rows FROM lineitem",
    "build_manifest": with_tables(
        _manifest_rows()
        + " UNION ALL SELECT 'raw_lines', 'raw_lines', 'raw_lines.csv.gz', "
        + f"count(*) - {_RAW_BAD}, 'order_id,line_id,note,blank,ship_day,last', {_RAW_BAD} FROM lineitem"
    ),
    "manifest_explode": with_tables(_manifest_rows(", '20260101T000000Z' AS _batch_id")),
    "manifest_missing": with_tables(
        "SELECT 'recalls' AS table_name, count(*) AS actual_rows FROM b_recalls "
        "UNION ALL SELECT 'state_registrations', count(*) FROM b_registrations"
    ),
    "bronze_contract": with_tables(_audit("20260101T000000Z", True)),
    "ingest_audit": with_tables(_audit("20251201T000000Z", True) + " UNION ALL " + _audit("20260101T000000Z", False)),
    "audit_latest_batch": with_tables(
        "SELECT *, CAST(2 AS BIGINT) AS batches, true AS has_extract_checksum, batch_id AS ingested_batch FROM ("
        + _audit("20260101T000000Z", False)
        + ")"
    ),
    "bronze_lineage": with_tables(
        "SELECT recall_record_id, 'nhtsa_recalls_post_2010' AS _source_id, 'recalls.csv.gz' AS _source_file, "
        "true AS has_checksum, '20260101T000000Z' AS _batch_id, '20260101T000000Z' AS _ingested_batch FROM b_recalls"
    ),
    "snapshot_replace": with_tables("SELECT * FROM f_recall"),
    "export_evidence_summary": with_tables(f"SELECT {_SUMMARY} FROM mart"),
    "export_alias_queue": with_tables(
        "SELECT * EXCLUDE (rule_version, threshold_validation_status) FROM alias_work_queue"
    ),
    "export_data_trust": with_tables(
        "SELECT * FROM (SELECT 'bronze_ingestion_audit' AS section, * EXCLUDE (source_file) FROM ("
        + _audit("20260101T000000Z", False)
        + f")) UNION ALL BY NAME SELECT 'entity_match_quality' AS section, * FROM ({_QUALITY})"
    ),
    "export_csv_gz": with_tables(
        "SELECT vehicle_key, make, model, CAST(model_year AS VARCHAR) AS model_year, "
        + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in _COUNTS)
        + ", review_priority, review_reason FROM mart"
    ),
}

# --- expressions ----------------------------------------------------------------------------

_DEFAULT_TOPIC = """CASE
  WHEN regexp_matches(t, 'FIRE|FLAME|THERMAL|BURN') THEN 'FIRE_OR_THERMAL'
  WHEN regexp_matches(t, 'BRAKE|ABS') THEN 'BRAKES'
  WHEN regexp_matches(t, 'AIR.?BAG|AIRBAG|SRS') THEN 'AIR_BAGS'
  WHEN regexp_matches(t, 'STEER') THEN 'STEERING'
  WHEN regexp_matches(t, 'ENGINE|POWER.?TRAIN|TRANSMISSION|PROPULSION') THEN 'POWERTRAIN'
  WHEN regexp_matches(t, 'ELECTRIC|BATTERY|WIRING|SOFTWARE|PROGRAM|CONTROL MODULE') THEN 'ELECTRICAL_OR_SOFTWARE'
  WHEN regexp_matches(t, 'TIRE|WHEEL') THEN 'TIRES_OR_WHEELS'
  WHEN regexp_matches(t, 'VISIBILITY|WINDSHIELD|WIPER|CAMERA') THEN 'VISIBILITY'
  WHEN regexp_matches(t, 'SEAT.?BELT|RESTRAINT') THEN 'OCCUPANT_RESTRAINT'
  ELSE 'OTHER' END"""

EXPRESSIONS = {
    # ß has no one-letter capital in one of the engines, so it is spelled out first
    "normalize_text": f"SELECT doc_id, {norm('t')} AS normalized FROM "
    "(SELECT doc_id, replace(text, 'ß', 'ss') AS t FROM documents)",
    "normalize_fold": "SELECT doc_id, trim(regexp_replace(upper(regexp_replace(strip_accents(text), "
    "'[^\\x00-\\x7F]+', '', 'g')), '[^A-Z0-9]+', ' ', 'g')) AS normalized FROM documents",
    "entity_key": with_tables(
        f"SELECT *, {KEY} FROM (SELECT recall_record_id, source_make, source_model, model_year, "
        f"{identity('source_make', 'source_model', 'model_year')} FROM b_recalls)"
    ),
    "record_key": "SELECT o_orderkey, sha256(CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END || '||' || "
    "CAST(o_custkey AS VARCHAR) || '||' || CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE o_orderpriority END) "
    "AS record_key FROM orders",
    "variant_key": with_tables(
        "SELECT vehicle_key, body_style, vehicle_type, drive_train, num_of_seating, ncap_variant_key FROM s_ratings"
    ),
    "parse_dates": with_tables(
        "SELECT incident_date, CAST(try_strptime(incident_date, '%Y%m%d') AS DATE) AS incident_date_parsed, "
        "count(*) AS rows, "
        "count(*) FILTER (WHERE incident_date = '20251301') AS rejected, "
        "CAST(min(strptime(complaint_received_date, '%Y%m%d')) AS DATE) AS first_received "
        "FROM (SELECT incident_date, complaint_received_date FROM b_complaints) "
        "GROUP BY incident_date"
    ),
    "profile_dates": "SELECT event_type, count(*) AS dated, min(strftime(ts, '%Y%m%d')) AS min_date, "
    "max(strftime(ts, '%Y%m%d')) AS max_date FROM events GROUP BY event_type",
    "parse_flags": with_tables(
        f"SELECT complaint_record_id, {yes('crash_flag')} AS crash, {yes('fire_flag')} AS fire, "
        f"{yes('medical_attention_flag')} AS medical, {yes('vehicle_towed_flag')} AS towed, "
        f"{yes('police_report_flag')} AS police FROM b_complaints"
    ),
    "safe_casts": with_tables(
        f"SELECT complaint_record_id, coalesce({whole('injury_count')}, 0) AS injury_count_int, "
        f"{whole('model_year')} AS model_year_int, {whole('mileage_at_failure', 'BIGINT')} AS mileage_int, "
        f"{decimal('mileage_at_failure')} AS mileage_decimal, {decimal('injury_count')} AS injury_decimal "
        "FROM b_complaints"
    ),
    "bulk_casts": with_tables(
        "SELECT "
        + ", ".join([f"{c}_int" for c in FUEL_WHOLE] + [f"{c}_decimal" for c in FUEL_DECIMAL])
        + " FROM s_variants"
    ),
    "severity_flag": with_tables(
        "SELECT complaint_record_id, crash_flag = 'Y' OR fire_flag = 'yes' OR injury_count = ' 1 ' "
        "OR death_count = '1' AS severe_report_flag FROM b_complaints"
    ),
    "topic_classify": f"SELECT doc_id, {_DEFAULT_TOPIC} AS evidence_topic FROM (SELECT doc_id, "
    "upper(coalesce(source, '') || ' ' || replace(coalesce(text, ''), 'ß', 'ss')) AS t FROM documents)",
    "privacy_projection": "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer",
}

# --- silver, dedup, identity ----------------------------------------------------------------

SILVER = {
    f"conform_{name}": with_tables(f"SELECT * FROM s_{name}")
    for name in ("complaints", "recalls", "investigations", "communications", "ratings", "variants", "registrations")
}

DEDUP = {
    "dedup_by_key": "SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber "
    "ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, "
    "l_linestatus) = 1",
    "dedup_rows": "SELECT DISTINCT lang, source, text FROM documents",
    "dup_keys": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    "profile_dups": "SELECT sum(n)::BIGINT AS rows, count(*) AS distinct_rows, sum(n - 1)::BIGINT "
    "AS exact_duplicate_rows FROM (SELECT count(*) AS n FROM documents GROUP BY lang, source, text)",
}

_REMAPPED = """
ent AS (SELECT DISTINCT vehicle_key, normalized_make, normalized_model, model_year_int, reference_exact_match_flag
  FROM bridge),
mapping AS (
  SELECT u.vehicle_key, m.vehicle_key AS target FROM ent u JOIN ent m
    ON u.normalized_make = m.normalized_make AND u.normalized_model = m.normalized_model
    AND u.model_year_int = m.model_year_int - 1
  WHERE NOT u.reference_exact_match_flag AND m.reference_exact_match_flag AND u.model_year_int % 3 <> 0),
remapped AS (
  SELECT e.vehicle_key, e.reference_exact_match_flag AS matched, coalesce(m.target, e.vehicle_key) AS canonical,
    m.target IS NOT NULL AS moved
  FROM ent e LEFT JOIN mapping m ON e.vehicle_key = m.vehicle_key)
"""

_CHAINED = """
ent AS (SELECT DISTINCT vehicle_key, normalized_make, normalized_model, model_year_int AS y FROM bridge),
pairs AS (SELECT u.vehicle_key, m.vehicle_key AS target, u.y FROM ent u JOIN ent m
    ON u.normalized_make = m.normalized_make AND u.normalized_model = m.normalized_model AND u.y = m.y - 1),
in_force AS (  -- by noon of the third; by the ninth
  SELECT '20260103T120000Z' AS batch_id, vehicle_key, target, 'APPROVED' AS status FROM pairs WHERE 1 + y % 4 <= 3
  UNION ALL SELECT '20260109T000000Z', vehicle_key, target, CASE WHEN y % 5 = 0 THEN 'REJECTED' ELSE 'APPROVED' END FROM pairs),
chain AS (
  SELECT batch_id, vehicle_key, target FROM in_force WHERE status = 'APPROVED'
  UNION SELECT c.batch_id, c.vehicle_key, f.target FROM chain c JOIN in_force f
    ON f.batch_id = c.batch_id AND f.vehicle_key = c.target WHERE f.status = 'APPROVED'),
last AS (SELECT c.batch_id, c.vehicle_key, c.target FROM chain c WHERE NOT EXISTS (
  SELECT 1 FROM in_force f WHERE f.batch_id = c.batch_id AND f.vehicle_key = c.target AND f.status = 'APPROVED'))
"""

IDENTITY = {
    "bridge_as_of": with_tables(
        "SELECT k.batch_id, b.* REPLACE (coalesce(l.target, b.vehicle_key) AS canonical_vehicle_key) FROM "
        "(SELECT unnest(['20260103T120000Z', '20260109T000000Z']) AS batch_id) k, bridge b "
        "LEFT JOIN last l ON l.vehicle_key = b.vehicle_key AND l.batch_id = k.batch_id",
        _CHAINED,
        recursive=True,
    ),
    "alias_decisions_as_of": with_tables(
        "SELECT batch_id, status, count(*) AS decisions FROM in_force GROUP BY ALL", _CHAINED, recursive=True
    ),
    "identity_bridge": with_tables("SELECT * FROM bridge"),
    "reference_keys": with_tables("SELECT * FROM ref_keys"),
    "alias_review_queue": with_tables(
        f"SELECT {', '.join(['vehicle_key', 'normalized_make', 'normalized_model', 'model_year_int'])}, "
        "count(*) AS source_system_count, string_agg(source_system, ',' ORDER BY source_system) AS source_systems, "
        "model_year_int >= 1984 AS reference_year_eligible, 'UNREVIEWED' AS review_status, "
        "'No exact EPA or NCAP make/model/year reference match' AS review_reason "
        "FROM judged WHERE NOT matched GROUP BY ALL"
    ),
    "match_quality": with_tables(_QUALITY),
    "match_rates": with_tables(_quality()),
    "alias_what_if": with_tables(
        "SELECT count(*) AS keys_before, count(DISTINCT canonical) AS keys_after, "
        "count(*) FILTER (WHERE matched) AS matched_keys_before, count(*) FILTER (WHERE moved) AS keys_connected, "
        "(SELECT count(*) FROM mentions WHERE vehicle_key IN (SELECT vehicle_key FROM mapping)) "
        "AS records_connected FROM remapped",
        _REMAPPED,
    ),
}

# --- star, mart, rules ----------------------------------------------------------------------

_ORPHANS = " UNION ALL ".join(
    f"SELECT DISTINCT '{label}' AS fact_name, vehicle_key FROM {table} WHERE vehicle_key IS NOT NULL "
    "AND vehicle_key NOT IN (SELECT vehicle_key FROM ref_keys)"
    for label, table in [
        ("gold_fact_complaint", "f_complaint"),
        ("gold_fact_recall", "f_recall"),
        ("gold_fact_investigation", "f_investigation"),
        ("gold_fact_manufacturer_communication", "f_communication"),
        ("gold_fact_ncap_variant", "f_ncap"),
        ("gold_fact_fuel_economy_variant", "f_fuel"),
    ]
)

STAR = {
    "dim_entity": with_tables("SELECT * FROM entity"),
    "dim_date": with_tables("SELECT * FROM calendar"),
    "dim_topic": with_tables(
        "SELECT topic_key, topic_label, count(complaint_record_id) AS records "
        "FROM topic_dim LEFT JOIN f_complaint ON topic_key = evidence_topic GROUP BY topic_key, topic_label"
    ),
    **{
        f"fact_{name}": with_tables(f"SELECT * FROM f_{name}")
        for name in ("complaint", "recall", "investigation", "communication", "ncap", "fuel", "registration")
    },
    "orphan_keys": with_tables(_ORPHANS),
    "complaint_event": with_tables(
        "SELECT vehicle_key, event AS complaint_id, CAST(event IS NOT NULL AS INTEGER) AS complaint_reports, "
        "CAST(a AS INTEGER) AS severe_complaint_reports, CAST(b AS INTEGER) AS crash_reported_complaints, "
        "CAST(c AS INTEGER) AS fire_reported_complaints, i AS reported_injuries, d AS reported_deaths "
        "FROM per_event WHERE source_system = 'NHTSA_COMPLAINT'"
    ),
    "complaint_agg": with_tables(
        _of_source(
            "NHTSA_COMPLAINT",
            "complaint_reports, severe_complaint_reports, crash_reported_complaints, fire_reported_complaints, "
            "reported_injuries, reported_deaths",
        )
    ),
    "recall_agg": with_tables(
        _of_source("NHTSA_RECALL", "recall_campaigns, do_not_drive_campaigns, park_outside_campaigns")
    ),
    "investigation_agg": with_tables(_of_source("NHTSA_INVESTIGATION", "investigations, open_investigations")),
    "communication_agg": with_tables(_of_source("NHTSA_MANUFACTURER_COMMUNICATION", "manufacturer_documents")),
    "ncap_agg": with_tables(_of_source("NHTSA_NCAP", "ncap_tested_variants, median_overall_stars")),
    "fuel_agg": with_tables(
        _of_source("EPA_FUEL_ECONOMY", "epa_variants, median_combined_mpg, median_annual_fuel_cost")
    ),
    "approx_median": with_tables(
        "SELECT vehicle_key, quantile_disc(comb08_int, 0.5) AS median_combined_mpg, "
        "quantile_disc(fuelCost08_int, 0.5) AS median_annual_fuel_cost FROM s_variants "
        "WHERE vehicle_key IS NOT NULL GROUP BY vehicle_key"
    ),
    "evidence_mart": with_tables("SELECT * FROM mart"),
    "evidence_baseline": with_tables("SELECT * FROM mart"),
    "severe_share": with_tables(
        "SELECT vehicle_key, complaint_reports, severe_complaint_reports, severe_complaint_share FROM mart"
    ),
    "evidence_source_count": with_tables("SELECT vehicle_key, evidence_source_count, source_system_count FROM mart"),
    **{
        name: with_tables(f"SELECT vehicle_key, {name} FROM mart")
        for name in ("review_priority", "review_reason", "alias_priority", "alias_reason")
    },
    "review_queue": with_tables("SELECT * FROM review_queue"),
    "alias_work_queue": with_tables("SELECT * FROM alias_work_queue"),
    "queue_ranked": with_tables(
        "SELECT vehicle_key, vehicle_label, review_priority, CAST(CASE review_priority WHEN 'CRITICAL' THEN 1 "
        "WHEN 'HIGH' THEN 2 WHEN 'REVIEW' THEN 3 ELSE 4 END AS INTEGER) AS review_priority_rank, alias_priority, "
        "CAST(CASE alias_priority WHEN 'P0' THEN 1 WHEN 'P1' THEN 2 WHEN 'P2' THEN 3 ELSE 4 END AS INTEGER) "
        "AS alias_priority_rank FROM mart"
    ),
    "priority_counts": with_tables(
        " UNION ALL ".join(
            f"SELECT '{c}' AS label_type, {c} AS label, count(*) AS vehicles FROM mart GROUP BY {c}"
            for c in ("review_priority", "review_reason", "alias_priority")
        )
    ),
}

# --- quality, profiles ----------------------------------------------------------------------

_TOTALS = (
    "complaint_reports severe_complaint_reports recall_campaigns do_not_drive_campaigns park_outside_campaigns "
    "investigations open_investigations manufacturer_documents ncap_tested_variants epa_variants"
).split()
_ONE_TOTAL = (
    "count(*) AS vehicle_keys, count(*) FILTER (WHERE reference_exact_match_flag) AS "
    "reference_exact_match_vehicle_keys, count(*) FILTER (WHERE reference_year_eligible) AS "
    "era_eligible_vehicle_keys, count(*) FILTER (WHERE reference_year_eligible AND reference_exact_match_flag) AS "
    "era_eligible_reference_exact_match_vehicle_keys, "
    + ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in _TOTALS)
)
_METRIC_COLUMNS = [
    "vehicle_keys",
    "reference_exact_match_vehicle_keys",
    "era_eligible_vehicle_keys",
    "era_eligible_reference_exact_match_vehicle_keys",
    *_TOTALS,
]
_MEDIANS = ("median_overall_stars", "median_combined_mpg", "median_annual_fuel_cost")
_METRICS = " UNION ALL ".join(
    [f"SELECT '{c}' AS metric, CAST({c} AS DOUBLE) AS v FROM (SELECT {_ONE_TOTAL} FROM mart)" for c in _METRIC_COLUMNS]
    + [
        f"SELECT '{c}' AS metric, CAST(sum({c}) AS DOUBLE) AS v FROM mart"
        for c in ("crash_reported_complaints", "fire_reported_complaints", "reported_injuries", "reported_deaths")
    ]
    + [f"SELECT '{c}' AS metric, coalesce(sum({c}), 0) AS v FROM mart" for c in _MEDIANS]
    + [f"SELECT '{c}_known' AS metric, CAST(count({c}) AS DOUBLE) AS v FROM mart" for c in _MEDIANS]
    + [
        f"SELECT '{c}=' || {c} AS metric, CAST(count(*) AS DOUBLE) AS v FROM mart GROUP BY {c}"
        for c in ("review_priority", "review_reason", "alias_priority")
    ]
)

# source id, bronze table, id, date, make, model, year, is a vehicle row
_PROFILED = [
    ("nhtsa_complaints_2025_2026", "b_complaints", "complaint_record_id", "complaint_received_date", "source_make",
     "source_model", "model_year", "product_type = 'V'"),
    ("nhtsa_recalls_post_2010", "b_recalls", "recall_record_id", "report_received_date", "source_make",
     "source_model", "model_year", "product_type = 'V'"),
    ("nhtsa_investigations_all", "b_investigations", "investigation_number", "opened_date", "source_make",
     "source_model", "model_year", "true"),
    ("nhtsa_tsbs_2025_2026", "b_communications", "nhtsa_communication_id", "date_added", "source_make",
     "source_model", "model_year", "true"),
    ("nhtsa_ncap_ratings", "b_ratings", None, None, "make", "model", "model_yr", "true"),
    ("epa_fuel_economy_vehicles", "b_variants", "id", None, "make", "model", "year", "true"),
    ("fhwa_state_registrations", "b_registrations", "state", None, None, None, "year", "false"),
]
_WIDTH = {b: len(c.split()) for _, _, b, c in _EXTRACTS}


def _valid_year(year: str) -> str:
    return f"(regexp_full_match({year}, '[0-9]+') AND TRY_CAST({year} AS INTEGER) BETWEEN 1900 AND 2027)"


def _profile(source, table, id_col, date, make, model, year, vehicle) -> str:
    make_, model_ = make or "''", model or "''"
    ids = f"count(DISTINCT nullif(trim({id_col}), ''))" if id_col else "CAST(0 AS BIGINT)"
    digits = f"substr(regexp_replace({date}, '[^0-9]', '', 'g'), 1, 8)" if date else "NULL"
    dated = f"FILTER (WHERE length({digits}) = 8 AND {digits} BETWEEN '19000101' AND '21001231')" if date else ""
    valid = f"{vehicle} AND {make_} <> '' AND {model_} <> '' AND {_valid_year(year)}"
    vehicles = f"count(*) FILTER (WHERE {vehicle})"
    keys = (
        f"(SELECT count(*) FROM (SELECT DISTINCT {norm(make)} AS a, {norm(model)} AS b, {year} AS c "
        f"FROM {table} WHERE {valid}))"
        if make
        else "CAST(0 AS BIGINT)"
    )
    return (
        f"SELECT '{source}' AS source_id, {_WIDTH[table]} AS columns, count(*) AS rows, CAST(0 AS BIGINT) AS malformed_rows, "
        f"CAST(0 AS DOUBLE) / nullif(count(*), 0) AS malformed_rate, "
        f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {table})) AS exact_duplicate_rows, "
        f"{ids} AS distinct_business_ids, CAST(count(*) AS DOUBLE) / nullif({ids}, 0) AS rows_per_business_id, "
        f"{vehicles} AS vehicle_rows, count(*) FILTER (WHERE {valid}) AS valid_vehicle_rows, "
        f"CAST(count(*) FILTER (WHERE {vehicle} AND {make_} = '') AS DOUBLE) / nullif({vehicles}, 0) "
        f"AS missing_make_rate, "
        f"CAST(count(*) FILTER (WHERE {vehicle} AND {model_} = '') AS DOUBLE) / nullif({vehicles}, 0) "
        f"AS missing_model_rate, "
        f"CAST(count(*) FILTER (WHERE {vehicle} AND NOT {_valid_year(year)}) AS DOUBLE) / nullif({vehicles}, 0) "
        f"AS invalid_or_missing_year_rate, {keys} AS distinct_normalized_vehicle_keys, "
        f"min(TRY_CAST({year} AS INTEGER)) FILTER (WHERE {_valid_year(year)}) AS min_year, "
        f"max(TRY_CAST({year} AS INTEGER)) FILTER (WHERE {_valid_year(year)}) AS max_year, "
        f"CAST(min({digits}) {dated} AS VARCHAR) AS min_source_date, "
        f"CAST(max({digits}) {dated} AS VARCHAR) AS max_source_date FROM {table}"
    )


_PROFILES = " UNION ALL ".join(_profile(*p) for p in _PROFILED)


def _keys(p) -> str:
    source, table, _, _, make, model, year, vehicle = p
    return (
        f"SELECT DISTINCT '{source}' AS source_id, {norm(make)} AS a, {norm(model)} AS b, "
        f"TRY_CAST({year} AS INTEGER) AS c FROM {table} WHERE {vehicle} AND {make} <> '' AND {model} <> '' "
        f"AND {_valid_year(year)}"
    )


_COVER = """count(*) AS distinct_vehicle_keys, count(*) FILTER (WHERE hit) AS exact_reference_matches,
  count(*) FILTER (WHERE c >= 1984) AS era_eligible_vehicle_keys,
  count(*) FILTER (WHERE c >= 1984 AND hit) AS era_eligible_exact_reference_matches,
  CAST(count(*) FILTER (WHERE hit) AS DOUBLE) / nullif(count(*), 0) AS exact_match_rate,
  CAST(count(*) FILTER (WHERE c >= 1984 AND hit) AS DOUBLE) / nullif(count(*) FILTER (WHERE c >= 1984), 0)
    AS era_eligible_exact_match_rate"""
_OPERATIONAL_KEYS = " UNION ALL ".join(_keys(p) for p in _PROFILED[:4])
_REFERENCE_KEYS = " UNION ".join(
    f"SELECT a, b, c FROM ({_keys(p)})" for p in _PROFILED[4:6]
)

QUALITY = {
    "business_totals": with_tables(f"SELECT {_ONE_TOTAL} FROM mart"),
    "dq_checks": with_tables(
        "SELECT check_name, CAST(0 AS BIGINT) AS actual_value, CAST(0 AS BIGINT) AS expected_value, true AS passed "
        "FROM (VALUES ('DIM_VEHICLE_UNIQUENESS'), ('GOLD_FACT_COMPLAINT_ORPHAN_KEYS'), "
        "('GOLD_FACT_RECALL_ORPHAN_KEYS'), ('GOLD_FACT_INVESTIGATION_ORPHAN_KEYS'), "
        "('GOLD_FACT_MANUFACTURER_COMMUNICATION_ORPHAN_KEYS'), ('GOLD_FACT_NCAP_VARIANT_ORPHAN_KEYS'), "
        "('GOLD_FACT_FUEL_ECONOMY_VARIANT_ORPHAN_KEYS'), ('ALIAS_QUEUE_CONTAINS_ONLY_P0_P1')) t(check_name)"
    ),
    "dq_checks_failing": with_tables(
        "SELECT *, CAST(0 AS BIGINT) AS expected_value, actual_value = 0 AS passed FROM ("
        "SELECT 'DIM_VEHICLE_UNIQUENESS' AS check_name, count(*) FILTER (WHERE reference_exact_match_flag AND model_year % 2 = 0) "
        "AS actual_value FROM entity UNION ALL SELECT upper(label) || '_ORPHAN_KEYS', count(o.vehicle_key) FROM ("
        "SELECT unnest(['gold_fact_complaint', 'gold_fact_recall', 'gold_fact_investigation', "
        "'gold_fact_manufacturer_communication', 'gold_fact_ncap_variant', 'gold_fact_fuel_economy_variant']) AS label) "
        f"LEFT JOIN ({_ORPHANS}) o ON fact_name = label GROUP BY label "
        "UNION ALL SELECT 'ALIAS_QUEUE_CONTAINS_ONLY_P0_P1', count(*) FILTER (WHERE alias_priority = 'P2') FROM mart)"
    ),
    "dq_status": with_tables(
        "SELECT count(DISTINCT fact_name) AS failed_data_quality_checks, CASE WHEN count(*) = 0 THEN 'PASS' "
        f"ELSE 'STOP AND INVESTIGATE' END AS data_quality_status FROM ({_ORPHANS})"
    ),
    "dq_semantic": with_tables(
        " UNION ALL ".join(
            f"SELECT 'MART_{column.upper()}_EQUAL_FACT' AS check_name, abs((SELECT CAST(sum({column}) AS BIGINT) "
            f"FROM mart) - (SELECT count(*) FROM (SELECT DISTINCT vehicle_key, {event} FROM {fact} "
            f"WHERE vehicle_key IS NOT NULL AND {event} IS NOT NULL))) AS actual_value, CAST(0 AS BIGINT) AS "
            "expected_value, true AS passed"
            for column, event, fact in (
                ("complaint_reports", "complaint_id", "f_complaint"),
                ("recall_campaigns", "campaign_number", "f_recall"),
            )
        )
        + " "
        "UNION ALL SELECT 'CRITICAL_HAS_URGENCY_FLAG', count(*) FILTER (WHERE review_priority = 'CRITICAL' AND "
        "do_not_drive_campaigns + park_outside_campaigns = 0), 0, true FROM mart "
        "UNION ALL SELECT 'DATE_KEYS_IN_CALENDAR', count(*), 0, true FROM ("
        "SELECT closed_date_key AS k FROM f_investigation UNION SELECT opened_date_key FROM f_investigation "
        "UNION SELECT incident_date_key FROM f_complaint) WHERE k NOT IN (SELECT date_key FROM calendar)"
    ),
    "reconcile": with_tables(f"SELECT metric, v AS actual_value, v AS expected_value, true AS passed FROM ({_METRICS})"),
    "reconcile_failing": with_tables(
        "SELECT metric, a.v AS actual_value, e.v AS expected_value, coalesce(abs(a.v - e.v) <= 1e-9, false) AS passed "
        f"FROM ({_METRICS.replace('FROM mart', 'FROM short')}) a FULL JOIN ({_METRICS}) e USING (metric)",
        "short AS (SELECT * FROM mart WHERE do_not_drive_campaigns = 0 AND park_outside_campaigns = 0)",
    ),
    "product_row_counts": with_tables(
        "SELECT 'complaints' AS table_name, count(*) AS rows, count(*) FILTER (WHERE product_type = 'V') "
        "AS product_rows FROM b_complaints UNION ALL SELECT 'recalls', count(*), "
        "count(*) FILTER (WHERE product_type = 'V') FROM b_recalls"
    ),
    "profile_source": with_tables(_PROFILES),
    "profile_summary": with_tables(
        "SELECT count(*) AS sources, CAST(sum(rows) AS BIGINT) AS total_rows, CAST(sum(malformed_rows) AS BIGINT) "
        "AS malformed_rows, CAST(sum(exact_duplicate_rows) AS BIGINT) AS exact_duplicate_rows, "
        "CAST(sum(vehicle_rows) AS BIGINT) AS vehicle_rows, CAST(sum(valid_vehicle_rows) AS BIGINT) "
        f"AS valid_vehicle_rows FROM ({_PROFILES})"
    ),
    "profile_reconcile": with_tables(
        "SELECT source_id, rows AS profiled_rows, malformed_rows, rows AS manifest_rows, true AS passed "
        f"FROM ({_PROFILES})"
    ),
    "profile_reconcile_failing": with_tables(
        "SELECT source_id, rows AS profiled_rows, malformed_rows, rows + CAST(wrong AS BIGINT) AS manifest_rows, "
        "NOT wrong AS passed "
        f"FROM (SELECT *, source_id = 'nhtsa_recalls_post_2010' AS wrong FROM ({_PROFILES}))"
    ),
    "profile_match_coverage": with_tables(
        f"SELECT source_id, {_COVER} FROM (SELECT *, (a, b, c) IN (SELECT (a, b, c) FROM ({_REFERENCE_KEYS})) AS hit "
        f"FROM ({_OPERATIONAL_KEYS})) GROUP BY source_id"
    ),
    "profile_union_coverage": with_tables(
        f"SELECT {_COVER} FROM (SELECT *, (a, b, c) IN (SELECT (a, b, c) FROM ({_REFERENCE_KEYS})) AS hit "
        f"FROM (SELECT DISTINCT a, b, c FROM ({_OPERATIONAL_KEYS})))"
    ),
}

def _gate(name: str, rows: str, failed: str, label: str) -> str:
    return (
        f"SELECT '{name}' AS gate, count(*) AS checks, count(*) FILTER (WHERE {failed}) AS failed, "
        f"coalesce(string_agg({label}, ', ' ORDER BY {label}) FILTER (WHERE {failed}), '') AS failed_names, "
        f"count(*) FILTER (WHERE {failed}) > 0 AS stops FROM ({rows})"
    )


QUALITY["gates"] = " UNION ALL ".join(
    [
        _gate("contract, spoiled manifest", with_tables(_audit("20251201T000000Z", True)), "status <> 'PASS'", "table_name"),
        _gate("contract", with_tables(_audit("20260101T000000Z", False)), "status <> 'PASS'", "table_name"),
        _gate("checks, spoiled tables", QUALITY["dq_checks_failing"], "NOT passed", "check_name"),
        _gate("checks", QUALITY["dq_checks"], "NOT passed", "check_name"),
        _gate("reconciliation, short mart", QUALITY["reconcile_failing"], "NOT passed", "metric"),
    ]
)
_GROWING = " UNION ALL ".join(_profile(*p) for p in _PROFILED if p[1] in ("b_complaints", "b_investigations"))
QUALITY["profile_batches"] = with_tables(_GROWING)
QUALITY["profile_sketched"] = with_tables(
    "SELECT source_id, rows, vehicle_rows, min_source_date, max_source_date, true AS distinct_business_ids_within, "
    f"true AS distinct_normalized_vehicle_keys_within, true AS exact_duplicate_rows_within FROM ({_GROWING})"
)

# --- measures -------------------------------------------------------------------------------


def _grains(aggregates: str, source: str, by: str = "make") -> str:
    """Per group and, as (all), over everything."""
    return with_tables(
        f"SELECT {by}, {aggregates} FROM ({source}) GROUP BY {by} "
        f"UNION ALL SELECT '(all)' AS {by}, {aggregates} FROM ({source})"
    )


def _with_make(table: str) -> str:
    return f"SELECT t.*, e.make FROM {table} t LEFT JOIN entity e ON t.vehicle_key = e.vehicle_key"


def _distinct(column: str, where: str | None = None) -> str:
    return f"count(DISTINCT CASE WHEN {where} THEN {column} END)" if where else f"count(DISTINCT {column})"


def _units() -> str:
    per = "SELECT {by} AS make, campaign_number, max(potential_units_affected_int) AS u FROM ({src}) GROUP BY ALL"
    src = _with_make("f_recall")
    return with_tables(
        "SELECT make, CAST(sum(u) AS BIGINT) AS potential_units_affected FROM ("
        + per.format(by="make", src=src)
        + ") GROUP BY make UNION ALL SELECT make, CAST(sum(u) AS BIGINT) FROM ("
        + per.format(by="'(all)'", src=src)
        + ") GROUP BY make"
    )


def _context() -> str:
    def one(by: str) -> str:
        ncap, fuel = _with_make("f_ncap"), _with_make("f_fuel")
        return (
            f"SELECT coalesce(n.g, f.g) AS make, coalesce(tested_ncap_variants, 0) AS tested_ncap_variants, "
            f"median_overall_stars, coalesce(epa_vehicle_variants, 0) AS epa_vehicle_variants, median_combined_mpg, "
            f"median_annual_fuel_cost FROM (SELECT {by} AS g, count(DISTINCT ncap_variant_key) AS "
            f"tested_ncap_variants, CAST(median(overall_stars) AS DOUBLE) AS median_overall_stars FROM ({ncap}) "
            f"GROUP BY g) n FULL JOIN (SELECT {by} AS g, count(DISTINCT epa_vehicle_id) AS epa_vehicle_variants, "
            f"CAST(median(combined_mpg) AS DOUBLE) AS median_combined_mpg, CAST(median(annual_fuel_cost) AS DOUBLE) "
            f"AS median_annual_fuel_cost FROM ({fuel}) GROUP BY g) f ON n.g IS NOT DISTINCT FROM f.g"
        )

    return with_tables(one("make") + " UNION ALL " + one("'(all)'"))


def _sets() -> str:
    """Measures by make and model, by make and in all; grouping_id is 0, 1 and 3."""

    def part(aggregates: str, source: str) -> str:
        return (
            f"SELECT make, model, CAST(GROUPING(make, model) AS BIGINT) AS g, {aggregates} FROM ({source}) "
            "GROUP BY GROUPING SETS ((make, model), (make), ())"
        )

    def of(table: str) -> str:
        return f"SELECT t.*, e.make, e.model FROM {table} t LEFT JOIN entity e ON t.vehicle_key = e.vehicle_key"

    units = (
        "SELECT make, model, g, CAST(sum(u) AS BIGINT) AS units FROM (SELECT make, model, CAST(GROUPING(make, model) AS BIGINT) AS g, "
        f"campaign_number, max(potential_units_affected_int) AS u FROM ({of('f_recall')}) "
        "GROUP BY GROUPING SETS ((make, model, campaign_number), (make, campaign_number), (campaign_number))) GROUP BY ALL"
    )
    parts = {
        "a": part(f"{_distinct('complaint_id')} AS n, {_distinct('complaint_id', 'severe_report_flag')} AS severe", of("f_complaint")),
        "b": part(f"{_distinct('campaign_number')} AS n", of("f_recall")),
        "c": units,
        "d": part("CAST(median(combined_mpg) AS DOUBLE) AS n", of("f_fuel")),
        "e": part("avg(evidence_source_count) AS n", "SELECT * FROM mart"),
        "f": part("count(*) AS n", "SELECT *, CAST(NULL AS VARCHAR) AS make, CAST(NULL AS VARCHAR) AS model FROM f_registration"),
    }
    every = " UNION ".join(f"SELECT make, model, g FROM ({p})" for p in parts.values())
    joins = "".join(
        f" LEFT JOIN ({p}) {name} ON {name}.make IS NOT DISTINCT FROM k.make AND {name}.model IS NOT DISTINCT FROM k.model AND {name}.g = k.g"
        for name, p in parts.items()
    )
    return with_tables(
        "SELECT k.make, k.model, k.g AS grouping_id, coalesce(a.n, 0) AS complaint_reports, "
        "CAST(coalesce(a.severe, 0) AS DOUBLE) / nullif(coalesce(a.n, 0), 0) AS severe_complaint_share, "
        "coalesce(b.n, 0) AS recall_campaigns, c.units AS potential_units_affected, d.n AS median_combined_mpg, "
        f"e.n AS average_evidence_sources, coalesce(f.n, 0) AS registration_records FROM ({every}) k{joins}"
    )


_ENTITY_MEASURES = (
    "count(*) AS vehicle_keys, count(*) FILTER (WHERE review_priority = 'CRITICAL') AS critical_review_vehicles, "
    "count(*) FILTER (WHERE review_priority = 'HIGH') AS high_review_vehicles, "
    "count(*) FILTER (WHERE review_priority <> 'MONITOR') AS review_queue_vehicles, "
    "count(*) FILTER (WHERE reference_exact_match_flag) AS reference_exact_match_keys, "
    "CAST(count(*) FILTER (WHERE reference_exact_match_flag) AS DOUBLE) / nullif(count(*), 0) "
    "AS reference_exact_match_rate, "
    "CAST(count(*) FILTER (WHERE reference_exact_match_flag AND reference_year_eligible) AS DOUBLE) "
    "/ nullif(count(*) FILTER (WHERE reference_year_eligible), 0) AS era_eligible_exact_match_rate"
)

MEASURES = {
    "measures_complaints": _grains(
        f"{_distinct('complaint_id')} AS complaint_reports, "
        f"{_distinct('complaint_id', 'severe_report_flag')} AS severe_complaint_reports, "
        f"CAST({_distinct('complaint_id', 'severe_report_flag')} AS DOUBLE) / nullif({_distinct('complaint_id')}, 0) "
        f"AS severe_complaint_share, {_distinct('complaint_id', 'crash_reported_flag')} AS crash_reported_complaints, "
        f"{_distinct('complaint_id', 'fire_reported_flag')} AS fire_reported_complaints",
        _with_make("f_complaint"),
    ),
    "measures_recalls": _grains(
        f"{_distinct('campaign_number')} AS recall_campaigns, "
        f"{_distinct('campaign_number', 'do_not_drive')} AS do_not_drive_campaigns, "
        f"{_distinct('campaign_number', 'park_outside')} AS park_outside_campaigns",
        _with_make("f_recall"),
    ),
    "potential_units": _units(),
    "measures_investigations": _grains(
        f"{_distinct('investigation_number')} AS investigations, "
        f"{_distinct('investigation_number', 'open_investigation_flag')} AS open_investigations",
        _with_make("f_investigation"),
    ),
    "measures_documents": _grains(
        f"{_distinct('document_id')} AS manufacturer_documents", _with_make("f_communication")
    ),
    "measures_context": _context(),
    "measures_entities": _grains(_ENTITY_MEASURES, "SELECT * FROM mart"),
    "measures_alias": _grains(
        "count(*) FILTER (WHERE alias_priority = 'P0') AS alias_work_queue_p0, "
        "count(*) FILTER (WHERE alias_priority = 'P1') AS alias_work_queue_p1, "
        "count(*) FILTER (WHERE alias_priority = 'P2') AS alias_backlog_p2",
        "SELECT * FROM mart",
    ),
    "measures_governance": _grains(
        "max(rule_version) AS rule_version, max(threshold_validation_status) AS threshold_validation_status, "
        "avg(evidence_source_count) AS average_evidence_sources",
        "SELECT * FROM mart",
    ),
    "measures_sets": _sets(),
    "measures_filtered": with_tables(
        "SELECT make, coalesce(complaint_reports, 0) AS complaint_reports, "
        "coalesce(severe_complaint_reports, 0) AS severe_complaint_reports, "
        "coalesce(recall_campaigns, 0) AS recall_campaigns, coalesce(registration_records, 0) AS registration_records "
        f"FROM (SELECT make, {_distinct('complaint_id')} AS complaint_reports, "
        f"{_distinct('complaint_id', 'severe_report_flag')} AS severe_complaint_reports FROM f_complaint "
        "JOIN entity USING (vehicle_key) WHERE incident_state LIKE 'S1%' AND model_year >= 2000 GROUP BY make) "
        f"FULL JOIN (SELECT make, {_distinct('campaign_number')} AS recall_campaigns FROM f_recall "
        "JOIN entity USING (vehicle_key) WHERE model_year >= 2000 GROUP BY make) USING (make) "
        "FULL JOIN (SELECT CAST(NULL AS VARCHAR) AS make, count(*) AS registration_records FROM f_registration) USING (make)"
    ),
    "measures_registrations": _grains(
        "count(*) AS registration_records, CAST(sum(registered_vehicles) AS BIGINT) AS registered_vehicles",
        "SELECT * FROM f_registration",
        "state_name",
    ),
}

# --- reports --------------------------------------------------------------------------------


def _ym(key: str) -> str:
    return f"substr(CAST({key} AS VARCHAR), 1, 4) || '-' || substr(CAST({key} AS VARCHAR), 5, 2)"


_FORMAL = (
    f"SELECT 'recalls' AS source_family, {_ym('report_received_date_key')} AS year_month, "
    "count(DISTINCT campaign_number) AS events FROM f_recall WHERE report_received_date_key IS NOT NULL GROUP BY ALL "
    f"UNION ALL SELECT 'investigations', {_ym('opened_date_key')}, count(DISTINCT investigation_number) "
    "FROM f_investigation WHERE opened_date_key IS NOT NULL GROUP BY ALL"
)
_JOINED = "JOIN entity e ON t.vehicle_key = e.vehicle_key"


def _monthly(role: str) -> str:
    return (
        f"SELECT year_month, topic_label, count(DISTINCT complaint_id) AS complaint_reports, '{role}' AS date_role "
        f"FROM f_complaint JOIN calendar ON {role} = date_key JOIN topic_dim ON evidence_topic = topic_key "
        "GROUP BY year_month, topic_label"
    )


def _drill(label: str, table: str, record: str, key: str, topic: str, detail: str, most: int) -> str:
    return (
        f"SELECT t.vehicle_key, '{label}' AS source_family, CAST({record} AS VARCHAR) AS record_id, "
        f"{key} AS date_key, {topic} AS evidence_topic, {detail} AS detail FROM {table} t "
        f"WHERE t.vehicle_key IN (SELECT vehicle_key FROM mart WHERE review_priority = 'CRITICAL' ORDER BY vehicle_key LIMIT {most})"
    )


def _evidence(most: int) -> str:
    """All evidence of the critical entities with the smallest keys."""
    facts = [
        ("complaint", "f_complaint", "complaint_record_id", "received_date_key", "evidence_topic", "component_name"),
        ("recall", "f_recall", "recall_record_id", "report_received_date_key", "evidence_topic",
         "consequence_summary || ' | ' || corrective_action"),
        ("investigation", "f_investigation", "investigation_record_key", "opened_date_key", "evidence_topic", "subject || ' | ' || summary"),
        ("communication", "f_communication", "communication_record_key", "communication_date_key", "evidence_topic", "summary"),
        ("ncap", "f_ncap", "ncap_variant_key", "NULL", "NULL", "body_style"),
        ("fuel", "f_fuel", "epa_vehicle_id", "NULL", "NULL", "vehicle_class"),
    ]
    return with_tables(" UNION ALL ".join(_drill(*one, most) for one in facts))


def _rollup(table: str, date: str, counts: dict[str, tuple[str, str | None]]) -> str:
    """Distinct ids, a missing one as one value, by (year, make), (year, month), topic, make and in all."""
    columns = "year, make, month, evidence_topic"
    totals = ", ".join(
        f"count(DISTINCT CASE WHEN {c} THEN coalesce({i}, '(missing)') END) AS {n}" if c else f"count(DISTINCT coalesce({i}, '(missing)')) AS {n}"
        for n, (i, c) in counts.items()
    )
    return with_tables(
        f"SELECT {columns}, CAST(GROUPING({columns}) AS BIGINT) AS grouping_id, {totals} FROM (SELECT t.*, e.make, "
        f"CAST({date} // 10000 AS INTEGER) AS year, CAST(({date} // 100) % 100 AS INTEGER) AS month "
        f"FROM {table} t LEFT JOIN entity e ON t.vehicle_key = e.vehicle_key) "
        "GROUP BY GROUPING SETS ((year, make), (year, month), (evidence_topic), (make), ())"
    )


REPORTS = {
    "priority_by_reason": with_tables(
        "SELECT review_priority, review_reason, count(*) AS vehicles FROM mart GROUP BY ALL"
    ),
    "top20_queue": with_tables(
        "SELECT vehicle_label, review_priority, review_reason, complaint_reports, severe_complaint_reports, "
        "recall_campaigns, open_investigations, manufacturer_documents FROM review_queue ORDER BY CASE "
        "review_priority WHEN 'CRITICAL' THEN 1 WHEN 'HIGH' THEN 2 ELSE 3 END, complaint_reports DESC, "
        "severe_complaint_reports DESC, recall_campaigns DESC, vehicle_key LIMIT 20"
    ),
    "scatter_severity": with_tables(
        "SELECT vehicle_key, vehicle_label, review_priority, complaint_reports, severe_complaint_share, "
        "recall_campaigns FROM mart WHERE complaint_reports > 0"
    ),
    "entity_drillthrough": _evidence(1),
    "entity_lookup": _evidence(5),
    "reconcile_rows": with_tables(
        "SELECT m.vehicle_key, 'complaint_reports' AS column, CAST(o.complaint_reports AS VARCHAR) AS actual_value, "
        "CAST(m.complaint_reports AS VARCHAR) AS expected_value FROM mart m JOIN mart o ON m.vehicle_key <> o.vehicle_key "
        "WHERE m.complaint_reports <> o.complaint_reports AND "
        "((m.vehicle_key = (SELECT arg_max(vehicle_key, (complaint_reports, vehicle_key)) FROM mart) "
        "AND o.vehicle_key = (SELECT arg_min(vehicle_key, (complaint_reports, vehicle_key)) FROM mart)) "
        "OR (o.vehicle_key = (SELECT arg_max(vehicle_key, (complaint_reports, vehicle_key)) FROM mart) "
        "AND m.vehicle_key = (SELECT arg_min(vehicle_key, (complaint_reports, vehicle_key)) FROM mart)))"
    ),
    "reconcile_routes": with_tables("SELECT count(*) AS entities, CAST(0 AS BIGINT) AS differing_values FROM mart"),
    "distinct_rollup_complaints": _rollup(
        "f_complaint",
        "received_date_key",
        {"complaint_reports": ("complaint_id", None), "severe_complaint_reports": ("complaint_id", "severe_report_flag")},
    ),
    "distinct_rollup_recalls": _rollup(
        "f_recall",
        "report_received_date_key",
        {"recall_campaigns": ("campaign_number", None), "do_not_drive_campaigns": ("campaign_number", "do_not_drive")},
    ),
    "entity_header": with_tables(
        "SELECT vehicle_key, vehicle_label, make, model, model_year, reference_match_status, reference_year_eligible, "
        "review_priority, review_reason, alias_priority, alias_reason, complaint_reports, severe_complaint_reports, "
        "recall_campaigns, open_investigations, manufacturer_documents, ncap_tested_variants, epa_variants, "
        "rule_version FROM mart WHERE review_priority = 'CRITICAL' ORDER BY vehicle_key LIMIT 1"
    ),
    "queue_unresolved_share": with_tables(
        "SELECT *, CAST(unresolved_vehicles AS DOUBLE) / nullif(queue_vehicles, 0) AS unresolved_share FROM ("
        "SELECT count(*) AS queue_vehicles, count(*) FILTER (WHERE NOT reference_exact_match_flag) AS "
        "unresolved_vehicles, "
        + ", ".join(f"count(*) FILTER (WHERE alias_priority = '{p}') AS unresolved_{p.lower()}" for p in ("P0", "P1", "P2"))
        + " FROM mart WHERE review_priority <> 'MONITOR')"
    ),
    "trend_by_family": with_tables(
        f"SELECT 'complaints' AS source_family, {_ym('received_date_key')} AS year_month, "
        "count(DISTINCT complaint_id) AS events FROM f_complaint GROUP BY ALL "
        f"UNION ALL SELECT 'communications', {_ym('communication_date_key')}, count(DISTINCT document_id) "
        f"FROM f_communication GROUP BY ALL UNION ALL {_FORMAL}"
    ),
    "entity_matrix": with_tables(
        "SELECT make, model, model_year, "
        + ", ".join(
            f"CAST(sum({c}) AS BIGINT) AS {c}"
            for c in (
                "complaint_reports recall_campaigns open_investigations manufacturer_documents "
                "ncap_tested_variants epa_variants"
            ).split()
        )
        + " FROM mart GROUP BY make, model, model_year"
    ),
    "formal_timeline": with_tables(_FORMAL),
    "topic_make_matrix": with_tables(
        "SELECT evidence_topic, make, model, count(DISTINCT campaign_number) AS recall_campaigns, "
        "count(DISTINCT investigation_number) AS investigations FROM ("
        f"SELECT evidence_topic, make, model, campaign_number, NULL AS investigation_number FROM f_recall t {_JOINED} "
        f"UNION ALL SELECT evidence_topic, make, model, NULL, investigation_number FROM f_investigation t {_JOINED}) "
        "GROUP BY evidence_topic, make, model"
    ),
    "campaign_table": with_tables(
        "SELECT campaign_number, max(filing_manufacturer) AS filing_manufacturer, max(consequence_summary) AS "
        "consequence_summary, max(corrective_action) AS corrective_action, bool_or(do_not_drive) AS do_not_drive, "
        "bool_or(park_outside) AS park_outside, max(potential_units_affected_int) AS potential_units_affected, "
        "count(*) AS records FROM f_recall WHERE campaign_number IS NOT NULL GROUP BY campaign_number"
    ),
    "star_monthly_topic": with_tables(_monthly("received_date_key") + " UNION ALL " + _monthly("incident_date_key")),
    "topic_pareto": with_tables(
        "SELECT evidence_topic, complaint_reports, CAST(row_number() OVER w AS INTEGER) AS rank, "
        "CAST(sum(complaint_reports) OVER w AS BIGINT) AS cumulative_reports, "
        "CAST(sum(complaint_reports) OVER w AS DOUBLE) / sum(complaint_reports) OVER () AS cumulative_share "
        "FROM (SELECT evidence_topic, count(DISTINCT complaint_id) AS complaint_reports FROM f_complaint "
        "GROUP BY evidence_topic) WINDOW w AS (ORDER BY complaint_reports DESC, evidence_topic "
        "ROWS UNBOUNDED PRECEDING)"
    ),
    "component_pareto": with_tables(
        "SELECT evidence_topic, component_name, complaint_reports, CAST(row_number() OVER w AS INTEGER) AS rank, "
        "CAST(sum(complaint_reports) OVER w AS BIGINT) AS cumulative_reports, CAST(sum(complaint_reports) OVER w AS "
        "DOUBLE) / sum(complaint_reports) OVER (PARTITION BY evidence_topic) AS cumulative_share FROM ("
        "SELECT evidence_topic, component_name, count(DISTINCT complaint_id) AS complaint_reports FROM f_complaint "
        "GROUP BY ALL) WINDOW w AS (PARTITION BY evidence_topic ORDER BY complaint_reports DESC, component_name "
        "ROWS UNBOUNDED PRECEDING)"
    ),
    "matrix_min_reports": with_tables(
        "SELECT make, model, count(DISTINCT t.vehicle_key) AS entities, "
        "count(DISTINCT complaint_id) AS complaint_reports, count(DISTINCT CASE WHEN "
        "severe_report_flag THEN complaint_id END) AS severe_complaint_reports, CAST(count(DISTINCT CASE WHEN "
        "severe_report_flag THEN complaint_id END) AS DOUBLE) / count(DISTINCT complaint_id) AS "
        f"severe_complaint_share FROM f_complaint t {_JOINED} GROUP BY make, model "
        "HAVING count(DISTINCT complaint_id) >= 10"
    ),
    "reports_by_state": with_tables(
        "SELECT incident_state, count(DISTINCT complaint_id) AS complaint_reports FROM f_complaint "
        "GROUP BY incident_state"
    ),
    "communication_topics": with_tables(
        f"SELECT {_ym('communication_date_key')} AS year_month, evidence_topic, communication_type, "
        "count(DISTINCT document_id) AS documents FROM f_communication GROUP BY ALL"
    ),
    "topic_decomposition": with_tables(
        "SELECT evidence_topic, manufacturer_system, nhtsa_components, make, model, count(DISTINCT document_id) "
        f"AS documents FROM s_communications t {_JOINED} GROUP BY ALL"
    ),
    "rating_distribution": with_tables(
        "SELECT e.model_year, overall_stars, count(DISTINCT ncap_variant_key) AS variants "
        f"FROM f_ncap t {_JOINED} GROUP BY e.model_year, overall_stars"
    ),
    "mpg_cost": with_tables(
        "SELECT fuel_type, combined_mpg, annual_fuel_cost, count(*) AS variants FROM f_fuel GROUP BY ALL"
    ),
    "variant_table": with_tables(
        "SELECT vehicle_label, drive, trany, vehicle_class, count(DISTINCT epa_vehicle_id) AS variants "
        f"FROM f_fuel t {_JOINED} GROUP BY vehicle_label, drive, trany, vehicle_class"
    ),
    "fuel_spread": with_tables(
        "SELECT vehicle_key, count(*) AS variants, min(combined_mpg) AS min_combined_mpg, max(combined_mpg) AS "
        "max_combined_mpg, CAST(median(combined_mpg) AS DOUBLE) AS median_combined_mpg FROM f_fuel "
        "WHERE vehicle_key IS NOT NULL GROUP BY vehicle_key"
    ),
}

MEASURES["measures_frequent"] = f"SELECT * FROM ({MEASURES['measures_complaints']}) WHERE make IS DISTINCT FROM '(all)'"
MEASURES["median_rollup"] = with_tables(
    " UNION ALL ".join(
        f"SELECT make, model_year, CAST(GROUPING(make, model_year) AS BIGINT) AS grouping_id, '{name}' AS measure, count({column}) AS n, "
        f"CASE WHEN count({column}) <= 4096 THEN CAST(quantile_disc({column}, 0.5) AS DOUBLE) END AS median, true AS within_error "
        "FROM (SELECT t.*, e.make, e.model_year FROM f_fuel t LEFT JOIN entity e ON t.vehicle_key = e.vehicle_key) "
        f"GROUP BY GROUPING SETS ((make, model_year), (make), ()) HAVING count({column}) > 0"
        for name, column in (("median_combined_mpg", "combined_mpg"), ("median_annual_fuel_cost", "annual_fuel_cost"))
    )
)
REPORTS["trend_without_gaps"] = (
    f"WITH t AS ({REPORTS['trend_by_family']}), m AS (SELECT source_family, unnest(generate_series("
    "min(CAST(year_month || '-01' AS DATE)), max(CAST(year_month || '-01' AS DATE)), INTERVAL 1 MONTH)) AS day FROM t GROUP BY source_family) "
    "SELECT m.source_family, strftime(m.day, '%Y-%m') AS year_month, coalesce(events, 0) AS events FROM m LEFT JOIN t "
    "ON t.source_family = m.source_family AND t.year_month = strftime(m.day, '%Y-%m')"
)

# file_checksums has no SQL counterpart: views hide the files. It is tested against hashlib.
ORACLES = {
    **FILES,
    **EXPRESSIONS,
    **SILVER,
    **DEDUP,
    **IDENTITY,
    **STAR,
    **QUALITY,
    **MEASURES,
    **REPORTS,
}
