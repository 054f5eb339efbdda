"""Hand-made rows per operator."""

import datetime

import pytest
from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import functions as F

from casefile.operators import conform, dedup, identity, mart, measures, profiling, quality, rules, star
from casefile.plans import baseline, lookup, reports
from casefile.settings import SOURCE_SYSTEMS, Settings
from casefile.sources.contracts import CONTRACTS


def landed(spark, table, rows):
    """Contract-shaped rows from partial dictionaries; missing columns are NULL."""
    columns = CONTRACTS[table]
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in rows], schema)


CAR = {"source_make": "Ford", "source_model": "F-150", "model_year": "2020"}
VAN = {"source_make": "Fiat", "source_model": "Ducato", "model_year": "1980"}
TRUCK = {"source_make": "Volvo", "source_model": "FH", "model_year": "2021"}


@pytest.fixture(scope="module")
def bronze(spark):
    complaint = {"product_type": "V", "complaint_received_date": "20240105", "component_name": "BRAKES"}
    rows = {
        "complaints": [
            {**complaint, **CAR, "complaint_record_id": "1", "complaint_id": "100", "crash_flag": "Y"},
            {**complaint, **CAR, "complaint_record_id": "2", "complaint_id": "100", "injury_count": "2"},
            {**complaint, **CAR, "complaint_record_id": "3", "complaint_id": " ", "fire_flag": "yes"},
            {**complaint, **VAN, "complaint_record_id": "4", "complaint_id": "101", "incident_state": "OH"},
            {**complaint, "source_make": "Ford", "complaint_record_id": "5", "complaint_id": "102"},
            {**complaint, **CAR, "complaint_record_id": "6", "complaint_id": "103", "product_type": "T"},
        ],
        "recalls": [
            {**CAR, "recall_record_id": "1", "campaign_number": "R1 ", "product_type": "V",
             "potential_units_affected": "10", "do_not_drive_flag": "Yes"},
            {**CAR, "recall_record_id": "2", "campaign_number": "R1", "product_type": "V",
             "potential_units_affected": "30"},
            {**VAN, "recall_record_id": "3", "campaign_number": "R1", "product_type": "V",
             "potential_units_affected": "20", "park_outside_flag": "1"},
            {**VAN, "recall_record_id": "4", "campaign_number": "R2", "product_type": "V",
             "potential_units_affected": "5"},
        ],
        "investigations": [
            {**VAN, "investigation_number": "I1", "component_name": "A", "opened_date": "20240101"},
            {**VAN, "investigation_number": "I1", "component_name": "B", "opened_date": "20240101",
             "closed_date": "20240201"},
            {**VAN, "investigation_number": "I2", "component_name": "B", "closed_date": "bad"},
        ],
        "communications": [
            {**TRUCK, "nhtsa_communication_id": "C1", "document_id": "D1", "summary": "same"},
            {**TRUCK, "nhtsa_communication_id": "C1", "document_id": "D1", "summary": "same"},
        ],
        "ratings": [
            {"make": "FORD", "model": "f 150", "model_yr": "2020", "drive_train": "4WD", "overall_stars": s}
            for s in ("5", "4", "N/A")
        ],
        "variants": [],
        "registrations": [
            {"year": "2020", "state": " new york", "category": "auto ", "registration_type": "x", "vehicles": "7"},
            {"year": "2020", "state": " new york", "category": "auto ", "registration_type": "x", "vehicles": "8"},
        ],
    }
    return {table: landed(spark, table, rows[name]) for name, (table, _) in conform.CONFORM_JOBS.items()}


@pytest.fixture(scope="module")
def silver(bronze):
    return {name: job(bronze[table]) for name, (table, job) in conform.CONFORM_JOBS.items()}


def test_conform_keeps_every_vehicle_row(silver):
    rows = {r["complaint_record_id"]: r for r in silver["complaints"].collect()}
    assert set(rows) == {"1", "2", "3", "4", "5"}
    assert rows["3"]["complaint_id"] is None
    assert rows["5"]["vehicle_key"] is None
    assert rows["2"]["severe_report_flag"] and not rows["4"]["severe_report_flag"]
    assert rows["1"]["received_date"] == datetime.date(2024, 1, 5)
    assert rows["1"]["incident_date_parsed"] is None


def test_conform_small_sources(silver):
    assert {r["campaign_number"] for r in silver["recalls"].collect()} == {"R1", "R2"}
    opened = {(r["investigation_number"], r["component_name"]): r["open_investigation_flag"]
              for r in silver["investigations"].collect()}
    assert opened == {("I1", "A"): True, ("I1", "B"): False, ("I2", "B"): True}
    assert silver["communications"].count() == 1
    assert silver["variants"].count() == 0
    (registration,) = silver["registrations"].collect()
    assert registration["state_name"] == "New York" and registration["category_normalized"] == "AUTO"


def test_mapping_renames_to_contract_names(spark):
    frame = landed(spark, "state_registrations", [{"year": "2020", "state": "ohio", "vehicles": "1"}])
    renamed = frame.withColumnRenamed("state", "st")
    assert conform.conform_registrations(renamed, mapping={"state": "st"}).first()["state_name"] == "Ohio"


def test_dedup_does_not_depend_on_partitioning(spark):
    frame = spark.range(3000).selectExpr("id % 50 AS k", "string(id * 7 % 991) AS a", "if(id % 3 = 0, NULL, string(id)) AS b")
    survivors = [
        sorted(map(tuple, dedup.dedup_by_key(frame.repartition(n, F.rand(n)), "k").collect())) for n in (1, 5, 13)
    ]
    assert len(survivors[0]) == 50
    assert survivors[0] == survivors[1] == survivors[2]


def test_digest_is_32_bytes_in_the_order_of_its_text(spark):
    frame = spark.range(300).selectExpr("string(id) AS x").withColumn("d", dedup.row_digest(["x"]))
    rows = frame.withColumn("text", F.expr("sha2(concat(length(x), ':', x), 256)")).collect()
    assert {len(r["d"]) for r in rows} == {32}
    assert [r["x"] for r in sorted(rows, key=lambda r: bytes(r["d"]))] == [r["x"] for r in sorted(rows, key=lambda r: r["text"])]


def test_digest_tells_apart_what_a_separator_would_not(spark):
    frame = spark.createDataFrame([("a", None), ("a", ""), (None, "a"), ("", "a"), ("a:", "b"), ("a", ":b")], "x string, y string")
    assert frame.select(dedup.row_digest(["x", "y"])).distinct().count() == 6


def test_distinct_row_count(spark):
    frame = spark.createDataFrame([("a", None), ("a", None), ("a", "b")], "x string, y string")
    assert tuple(dedup.distinct_row_count(frame).first()) == (3, 2, 1)
    assert tuple(dedup.distinct_row_count(frame.limit(0)).first()) == (0, 0, 0)
    assert [tuple(r) for r in dedup.duplicate_keys(frame, "x").collect()] == [("a", 3)]


def test_bridge(silver):
    bridge = identity.identity_bridge(baseline.by_system(silver))
    rows = {(r["source_system"], r["normalized_make"]): r for r in bridge.collect()}
    assert set(rows) == {
        ("NHTSA_COMPLAINT", "FORD"), ("NHTSA_COMPLAINT", "FIAT"), ("NHTSA_RECALL", "FORD"), ("NHTSA_RECALL", "FIAT"),
        ("NHTSA_INVESTIGATION", "FIAT"), ("NHTSA_MANUFACTURER_COMMUNICATION", "VOLVO"), ("NHTSA_NCAP", "FORD"),
    }
    assert rows["NHTSA_RECALL", "FORD"]["reference_match_status"] == "MATCHED"
    assert rows["NHTSA_RECALL", "FIAT"]["match_confidence"] == "UNRESOLVED"
    assert not rows["NHTSA_RECALL", "FIAT"]["reference_year_eligible"]
    sources = baseline.by_system(silver)
    masks = identity.entity_sources(sources)
    queue = {r["normalized_make"]: r for r in identity.alias_review_queue(masks, list(sources)).collect()}
    assert set(queue) == {"FIAT", "VOLVO"}
    assert queue["FIAT"]["source_systems"] == ["NHTSA_COMPLAINT", "NHTSA_INVESTIGATION", "NHTSA_RECALL"]
    (rates,) = identity.match_quality(bridge, by=[]).collect()
    assert rates["distinct_vehicle_keys"] == 3 and rates["reference_exact_match_rate"] == 1 / 3
    assert rates["era_eligible_reference_exact_match_rate"] == 1 / 2


def test_match_rates_of_nothing_are_null(spark, silver):
    empty = identity.identity_bridge(baseline.by_system(silver)).limit(0)
    (rates,) = identity.match_quality(empty, by=[]).collect()
    assert rates["distinct_vehicle_keys"] == 0 and rates["reference_exact_match_rate"] is None


def test_alias_what_if(spark, silver):
    bridge = identity.identity_bridge(baseline.by_system(silver))
    keys = {r["normalized_make"]: r["vehicle_key"] for r in bridge.collect()}
    def mapping(*rows):
        return spark.createDataFrame(rows, identity.ALIAS_MAPPING)

    def decision(key, target, status="APPROVED", day=1, reviewer="r. viewer", rationale="typo"):
        return key, target, status, reviewer, datetime.datetime(2026, 1, day), rationale, "HIGH"

    fiat, ford, volvo = keys["FIAT"], keys["FORD"], keys["VOLVO"]
    records = [silver["complaints"], silver["recalls"]]
    counted = sum(df.filter(F.col("vehicle_key") == fiat).count() for df in records)
    (row,) = identity.alias_what_if(bridge, mapping(decision(fiat, ford)), records).collect()
    assert row.asDict() == {
        "keys_before": 3, "keys_after": 2, "matched_keys_before": 1, "keys_connected": 1, "records_connected": counted,
    }
    # the newest decision counts; a rejected or pending one changes nothing
    withdrawn = mapping(decision(fiat, ford), decision(fiat, ford, "REJECTED", 2), decision(volvo, ford, "PENDING"))
    assert identity.alias_what_if(bridge, withdrawn, records).first()["keys_after"] == 3
    for refused, what in [
        (mapping(decision(fiat, ford), decision(fiat, volvo)), "twice"),
        (mapping(decision(fiat, volvo), decision(volvo, ford), decision(ford, fiat)), "cycle"),
        (mapping(decision(fiat, fiat)), "no other target"),
        (mapping(decision(fiat, ford, "MAYBE")), "unknown status"),
        (mapping(decision(fiat, ford, reviewer=" ")), "without reviewer"),
    ]:
        with pytest.raises(ValueError, match=what):
            identity.apply_alias(bridge, refused)


def test_aliases_as_of_a_time_and_chains(spark):
    def at(day):
        return datetime.datetime(2026, 1, day, tzinfo=datetime.UTC)

    def mapping(*rows):
        full = [(k, t, status, "r", at(day), "why", "HIGH") for k, t, status, day in rows]
        return spark.createDataFrame(full, identity.ALIAS_MAPPING)

    keys = spark.createDataFrame([(k,) for k in "abcdexyz"], "vehicle_key string")

    def canonical(decisions, moment=None):
        rows = identity.apply_alias(keys, decisions, moment=moment).collect()
        return {r["vehicle_key"]: r["canonical_vehicle_key"] for r in rows if r["vehicle_key"] != r["canonical_vehicle_key"]}

    chain = mapping(*[(k, t, "APPROVED", i) for i, (k, t) in enumerate(["ab", "bc", "cd", "de", "xy"], 1)], ("c", "d", "REJECTED", 7))
    assert canonical(chain, at(5)) == {"a": "e", "b": "e", "c": "e", "d": "e", "x": "y"}
    assert canonical(chain) == canonical(chain, at(7)) == {"a": "c", "b": "c", "d": "e", "x": "y"}
    assert canonical(chain, at(2)) == {"a": "c", "b": "c"} and canonical(chain, datetime.datetime(2025, 12, 31, tzinfo=datetime.UTC)) == {}
    steps = identity.close_chains(identity.known_at(chain, at(5))).collect()
    assert {r["vehicle_key"]: r["steps"] for r in steps} == {"a": 4, "b": 3, "c": 2, "d": 1, "x": 1}
    assert identity.close_chains(chain.limit(0)).count() == 0

    # cycles of every length, with a way that leads there; one decided later has no say before
    for length in (2, 3, 4, 5):
        ring = [("abcde"[i], "abcde"[(i + 1) % length], "APPROVED", i + 1) for i in range(length)]
        with pytest.raises(ValueError, match="cycle"):
            canonical(mapping(*ring, ("x", "a", "APPROVED", 1)))
        assert canonical(mapping(*ring), at(length - 1)) == {k: "abcde"[length - 1] for k in "abcde"[: length - 1]}

    found = identity.decisions_at(chain, {"old": at(6), "new": at(8)}).collect()
    assert {r["vehicle_key"]: r["status"] for r in found if r["batch_id"] == "old"} == dict.fromkeys("abcdx", "APPROVED")
    assert {r["vehicle_key"]: r["status"] for r in found if r["batch_id"] == "new"}["c"] == "REJECTED" and len(found) == 10


def by_make(frame):
    return {r["make"]: r for r in frame.collect()}


def test_mart(silver):
    rows = by_make(mart.evidence_mart(silver))
    ford, fiat, volvo = rows["FORD"], rows["FIAT"], rows["VOLVO"]
    # one complaint with an id; the severe row without id still counts as severe, as in the per-entity route
    assert (ford["complaint_reports"], ford["severe_complaint_reports"], ford["reported_injuries"]) == (1, 2, 2)
    assert (ford["recall_campaigns"], ford["do_not_drive_campaigns"], ford["park_outside_campaigns"]) == (1, 1, 0)
    assert (ford["ncap_tested_variants"], ford["median_overall_stars"]) == (1, 4.5)
    assert ford["review_reason"] == "At least one do-not-drive recall campaign"
    assert ford["alias_priority"] == "NONE" and ford["source_system_count"] == 3
    assert (fiat["investigations"], fiat["open_investigations"]) == (2, 2)
    assert (fiat["review_priority"], fiat["alias_priority"]) == ("CRITICAL", "P0")
    assert fiat["vehicle_label"] == "1980 FIAT DUCATO"
    assert (volvo["review_priority"], volvo["alias_priority"]) == ("MONITOR", "P2")
    assert volvo["severe_complaint_share"] is None and volvo["evidence_source_count"] == 1
    assert volvo["median_combined_mpg"] is None and volvo["epa_variants"] == 0


def test_both_routes_give_the_same_mart(bronze, silver):
    one, other = mart.evidence_mart(silver), baseline.baseline_mart(bronze)
    columns = sorted(one.columns)
    assert sorted(other.columns) == columns
    assert dict(one.dtypes) == dict(other.dtypes)
    assert sorted(map(str, one.select(columns).collect())) == sorted(map(str, other.select(columns).collect()))


@pytest.mark.parametrize(
    ("source", "column", "value"),
    [
        ("complaints", "severe_report_flag", "false"),
        ("recalls", "normalized_make", "'OTHER'"),
        ("investigations", "open_investigation_flag", "false"),
        ("ratings", "overall_stars_int", "1"),
    ],
)
def test_a_fault_in_one_conform_job_shows(bronze, silver, source, column, value):
    faulty = {**silver, source: silver[source].withColumn(column, F.expr(value))}
    compared = quality.reconcile(
        quality.mart_metrics(mart.evidence_mart(faulty)), quality.mart_metrics(baseline.baseline_mart(bronze))
    )
    assert compared.filter("NOT passed").count() > 0


def test_empty_sources(spark, silver):
    nothing = {name: df.limit(0) for name, df in silver.items()}
    assert mart.evidence_mart(nothing).count() == 0
    assert quality.business_totals(mart.evidence_mart(nothing)).first()["complaint_reports"] == 0
    assert quality.mart_metrics(mart.evidence_mart(nothing)).count() == 0


def test_rules_take_their_thresholds_from_settings(spark):
    base = dict.fromkeys(mart.COUNT_COLUMNS, 0) | {"source_system_count": 1, "reference_exact_match_flag": False}

    def labels(settings=Settings(), **counts):
        frame = spark.createDataFrame([{**base, **counts}])
        r = rules.with_review_rules(frame, settings).first()
        return r["review_priority"], r["alias_priority"]

    assert labels(complaint_reports=10, severe_complaint_reports=3) == ("HIGH", "P1")
    assert labels(complaint_reports=10, severe_complaint_reports=2) == ("REVIEW", "P1")
    assert labels(complaint_reports=4) == ("MONITOR", "P2")
    assert labels(Settings(review_complaints=4), complaint_reports=4) == ("REVIEW", "P2")
    assert labels(manufacturer_documents=10) == ("REVIEW", "P1")
    assert labels(source_system_count=2) == ("MONITOR", "P1")
    assert labels(reference_exact_match_flag=True, park_outside_campaigns=1) == ("CRITICAL", "NONE")


def test_medians(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("a", 10), ("b", None)], "k string, v int")
    exact = {r["k"]: r["m"] for r in mart.median_by(frame, ["k"], {"m": "v"}).collect()}
    assert exact == {"a": 2.5, "b": None}
    approx = {r["k"]: r["m"] for r in mart.median_by(frame, ["k"], {"m": "v"}, approx=True).collect()}
    assert approx == {"a": 2, "b": None}


@pytest.fixture(scope="module")
def model(spark, silver):
    facts = {"complaint": "complaints", "recall": "recalls", "investigation": "investigations",
             "communication": "communications", "ncap": "ratings", "fuel": "variants", "registration": "registrations"}
    tables = {name: star.FACTS[source](silver[source]) for name, source in facts.items()}
    tables["entity"] = star.dim_entity(identity.identity_bridge(baseline.by_system(silver)))
    tables["mart"] = mart.evidence_mart(silver)
    tables["review_queue"] = rules.review_queue(tables["mart"])
    tables["alias_queue"] = rules.alias_work_queue(tables["mart"])
    tables["calendar"] = star.calendar(silver)
    tables["topic"] = star.dim_topic(spark)
    tables["checks"] = quality.dq_checks(
        tables["entity"], {n: tables[n] for n in ("complaint", "recall")}, tables["alias_queue"]
    )
    return tables


def test_measures_count_a_missing_id_once(model):
    (row,) = measures.measures(["complaint_reports", "severe_complaint_reports", "severe_complaint_share"], model).collect()
    # ids 100, 101, 102 and the missing one; severe: 100 and the missing one
    assert tuple(row) == (4, 2, 0.5)


def test_units_take_one_maximum_per_campaign_in_context(model):
    assert measures.measure("potential_units_affected", model).first()[0] == 35
    per_make = {r["make"]: r[1] for r in measures.measure("potential_units_affected", model, by=["make"]).collect()}
    assert per_make == {"FORD": 30, "FIAT": 25}


def test_measures_under_filters(model):
    eligible = measures.measure("recall_campaigns", model, where_entity="reference_exact_match_flag").first()[0]
    assert eligible == 1
    urgent = measures.measure("recall_campaigns", model, where="park_outside").first()[0]
    assert urgent == 1
    both = measures.measures(["vehicle_keys", "reference_exact_match_rate", "failed_data_quality_checks",
                              "data_quality_status", "median_combined_mpg", "epa_vehicle_variants"], model).first()
    assert both["vehicle_keys"] == 3 and both["data_quality_status"] == "PASS"
    assert both["median_combined_mpg"] is None and both["epa_vehicle_variants"] == 0


def test_every_measure_evaluates(model):
    for name in measures.MEASURES:
        assert measures.measure(name, model).count() == 1, name


def test_a_filter_leaves_tables_without_its_columns_as_they_are(model):
    names = ["registration_records", "failed_data_quality_checks", "recall_campaigns"]
    plain = measures.measures(names, model).first()
    filtered = measures.measures(names, model, where="`PARK_outside` AND 'x' <> 'incident_state'", where_entity="make = 'FIAT'").first()
    assert tuple(filtered)[:2] == tuple(plain)[:2] and filtered["recall_campaigns"] < plain["recall_campaigns"]
    (row,) = measures.measures(names[:2], model, by=["make"]).collect()
    assert (row["make"], *tuple(row)[1:]) == (None, *tuple(plain)[:2])


@pytest.mark.parametrize(
    ("filters", "error"),
    [
        ({"where": "park_outsid"}, AnalysisException),  # a misspelt column
        ({"where": "alias_priorty = 'P0'"}, AnalysisException),
        ({"where": "nosuch(park_outside)"}, AnalysisException),
        ({"where": "park_outside = = 1"}, ParseException),
        ({"where": "campaign_number"}, AnalysisException),  # no condition
        ({"where": "mileage_at_failure_int > 1"}, AnalysisException),  # of a table not asked
        ({"where": "state_name = 'x' AND park_outside"}, ValueError),  # no table has both
        ({"where_entity": "mke = 'FIAT'"}, AnalysisException),
    ],
)
def test_a_filter_that_cannot_apply_raises(model, filters, error):
    with pytest.raises(error):
        measures.measures(["recall_campaigns", "registration_records"], model, **filters)


SETS = [["make", "model"], ["make"], []]


def test_several_groupings_equal_one_call_each(model):
    names = [n for n in measures.MEASURES if n not in ("rule_version", "threshold_validation_status")]
    both = measures.measures(names, model, by=SETS, where_entity="model_year > 1000").collect()
    for by in SETS:
        number = sum(1 << i for i, c in enumerate(reversed(["make", "model"])) if c not in by)
        once = measures.measures(names, model, by=by, where_entity="model_year > 1000").collect()
        key = lambda r: str([r[c] for c in by])
        mine = sorted((r for r in both if r["grouping_id"] == number), key=key)
        assert [[r[c] for c in [*by, *names]] for r in mine] == [[r[c] for c in [*by, *names]] for r in sorted(once, key=key)]
        assert all(r[c] is None for r in mine for c in ("make", "model") if c not in by)
    assert len(both) == sum(measures.measures(names, model, by=by, where_entity="model_year > 1000").count() for by in SETS)


def test_sets_that_are_not_nested_count_an_id_once_in_each(spark):
    """Ids that come in several groups, a missing one and missing amounts among them."""
    rows = [(f"M{i % 3}", f"T{i % 5}", None if i % 7 == 0 else str(i % 11), i % 4 == 0, None if i % 11 in (2, 5) else i) for i in range(200)]
    shape = "make string, model string, campaign_number string, park_outside boolean, potential_units_affected_int long"
    facts = {"recall": spark.createDataFrame(rows, shape)}
    names = ["recall_campaigns", "park_outside_campaigns", "potential_units_affected"]
    sets = [["make"], ["model"], ["make", "model"], []]
    found = measures.measures(names, facts, by=sets).collect()
    expected = set()
    for own in sets:
        groups = {}
        for make, model_name, campaign, flagged, units in rows:
            group = (make if "make" in own else None, model_name if "model" in own else None)
            most, any_flag = groups.setdefault(group, {}).get(campaign, (None, False))
            units = most if units is None else units if most is None else max(most, units)
            groups[group][campaign] = (units, any_flag or flagged)
        number = 2 * ("make" not in own) + ("model" not in own)
        for group, ids in groups.items():
            amounts = [u for u, _ in ids.values() if u is not None]
            expected.add((*group, number, len(ids), sum(f for _, f in ids.values()), sum(amounts) if amounts else None))
    assert len(found) == len(expected) and set(map(tuple, found)) == expected
    text = measures.measures(names, facts, by=sets)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning(_id") == 1  # flags and amounts of an id in one grouping


def test_several_groupings_scan_a_fact_once(spark, model, tmp_path):
    stored = {}
    for name in ("complaint", "entity"):
        model[name].write.parquet(str(tmp_path / name))
        stored[name] = spark.read.parquet(str(tmp_path / name))
    frame = measures.measures(["complaint_reports", "severe_complaint_share"], stored, by=SETS)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    plan = plan[plan.find("Initial Plan") + 1 :]
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    # the rows of the grain are expanded, no others
    assert len(scans) == 2 and plan.count("Expand") == 1


def test_sets_of_empty_tables_have_a_row_for_the_whole(model):
    nothing = {name: df.limit(0) for name, df in model.items()}
    rows = measures.measures(["complaint_reports", "median_combined_mpg"], nothing, by=SETS).collect()
    assert [tuple(r) for r in rows] == [(None, None, 3, 0, None)]


def test_rows_without_an_entity_keep_out_of_the_join(model):
    rows = {r["make"]: r[1] for r in measures.measure("complaint_reports", model, by=["make"]).collect()}
    assert rows == {"FORD": 2, "FIAT": 1, None: 1}
    kept = measures.measure("complaint_reports", model, where_entity="true").first()[0]
    assert kept == 3


def test_calendar(model):
    days = model["calendar"].orderBy("date_key").collect()
    assert (days[0]["date_key"], days[-1]["date_key"], len(days)) == (20240101, 20240201, 32)
    assert (days[0]["month_name"], days[0]["year_month"], days[0]["week_of_year"]) == ("January", "2024-01", 1)


def test_quality_checks_find_what_is_wrong(spark, model):
    wrong_dim = model["entity"].filter("make <> 'FIAT'").unionAll(model["entity"].filter("make = 'FORD'"))
    wrong_queue = model["alias_queue"].withColumn("alias_priority", F.lit("P2"))
    checks = quality.dq_checks(wrong_dim, {"complaint": model["complaint"]}, wrong_queue)
    values = {r["check_name"]: r["actual_value"] for r in checks.collect()}
    assert values == {"DIM_VEHICLE_UNIQUENESS": 1, "COMPLAINT_ORPHAN_KEYS": 1, "ALIAS_QUEUE_CONTAINS_ONLY_P0_P1": 1}
    assert tuple(quality.dq_status(checks).first()) == (3, "STOP AND INVESTIGATE")
    with pytest.raises(ValueError, match="DIM_VEHICLE_UNIQUENESS"):
        quality.gate_checks(checks)
    quality.gate_checks(model["checks"])


def test_reconcile(spark):
    left = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0)], "metric string, value double")
    right = spark.createDataFrame([("a", 1.0), ("b", 2.1), ("d", 3.0)], "metric string, value double")
    passed = {r["metric"]: r["passed"] for r in quality.reconcile(left, right).collect()}
    assert passed == {"a": True, "b": False, "c": False, "d": False}


def test_privacy(spark):
    frame = spark.createDataFrame([("1", "x")], "id string, VIN string")
    assert quality.project_allowed(frame, ["id"]).columns == ["id"]
    with pytest.raises(ValueError, match="VIN"):
        quality.project_allowed(frame, ["id", "VIN"])


def test_profile_of_dirty_rows(spark):
    rows = [("1", "2024-01-05", "Citroën", "C4", "2020", "v"), ("1", "20240105", "CITROEN", "c4", "2020", "V"),
            (" ", "bad", "", "C4", "20x0", "V"), ("2", None, "X", "Y", "1850", "T"), ("2", None, "X", "Y", "1850", "T")]
    frame = spark.createDataFrame(rows, "id string, day string, make string, model string, year string, product string")
    spec = profiling.ProfileSpec("s", "id", "day", "make", "model", "year", "product")
    malformed = spark.createDataFrame([("broken",)], "line string")
    row = profiling.profile(frame, spec, malformed).first().asDict()
    assert row == {
        "source_id": "s", "columns": 6, "rows": 6, "malformed_rows": 1, "malformed_rate": 1 / 6, "exact_duplicate_rows": 1,
        "distinct_business_ids": 2, "rows_per_business_id": 3.0, "vehicle_rows": 3, "valid_vehicle_rows": 2,
        "missing_make_rate": 1 / 3, "missing_model_rate": 0.0, "invalid_or_missing_year_rate": 1 / 3,
        "distinct_normalized_vehicle_keys": 1, "min_year": 2020, "max_year": 2020,
        "min_source_date": "20240105", "max_source_date": "20240105",
    }
    empty = profiling.profile(frame.limit(0), spec).first()
    assert empty["rows"] == 0 and empty["rows_per_business_id"] is None and empty["min_source_date"] is None


def test_pareto_and_top(model):
    pareto = reports.topic_pareto(model["complaint"]).collect()
    assert [(r["evidence_topic"], r["cumulative_share"]) for r in pareto] == [("BRAKES", 1.0)]
    top = reports.top_queue(model["review_queue"], 1).collect()
    assert [r["vehicle_label"] for r in top] == ["2020 FORD F 150"]


def test_drillthrough(model):
    rows = reports.entity_drillthrough(model, lookup.listed(model["entity"].filter("make = 'FIAT'")))
    assert sorted(r["source_family"] for r in rows.collect()) == ["complaint", "investigation", "investigation",
                                                                  "investigation", "recall", "recall"]


def test_source_labels_are_complete():
    assert set(SOURCE_SYSTEMS) | {"registrations"} == set(conform.CONFORM_JOBS)
