"""The physical plans keep the properties the jobs rely on at scale."""

import re

import pytest

from casefile.operators import dedup, mart
from casefile.operators.conform import conform_complaints
from casefile.plans import reports
from workload import adapter, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", autouse=True)
def whole_descriptions(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text: str) -> int:
    return len(re.findall(r"Exchange hashpartitioning", text))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Silver tables on disk, as the build leaves them."""
    folder = tmp_path_factory.mktemp("silver")
    frames = {}
    for name in queries.IDENTITY_SOURCES:
        queries.silver(spark, SF_DIR, name, lineage=True).write.parquet(f"{folder}/{name}")
        frames[name] = spark.read.parquet(f"{folder}/{name}")
    return frames


def test_no_python_and_no_cartesian_product_anywhere(spark):
    eager = ("export", "scan", "manifest", "bronze", "ingest", "audit", "snapshot", "build", "malformed")
    eager += ("irregular", "verify", "profile_reconcile")  # these read files they write; the others run nothing here
    for name, query in queries.QUERIES.items():
        if name.startswith(eager):
            continue
        text = plan(query(spark, SF_DIR))
        assert not re.search("Python|Pandas|Arrow", text), name
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_dedup_keeps_one_row_per_key_before_the_shuffle(spark):
    text = plan(conform_complaints(adapter.complaints(spark, SF_DIR)))
    shuffle = text.index("Exchange hashpartitioning(complaint_record_id")
    assert "Partial" in text[shuffle:] and "WindowGroupLimit" in text[shuffle:]


def test_dedup_shuffles_only_what_the_query_needs(spark):
    conformed = conform_complaints(adapter.complaints(spark, SF_DIR))
    text = plan(conformed.select("complaint_id", "received_date"))
    before = text[text.index("Exchange hashpartitioning(complaint_record_id"):]
    project = before[before.index("Project ["):].split("\n")[0]
    assert "_digest" in project and "mileage_at_failure AS" not in project.replace("sha2", "")


def test_mart_is_two_shuffles_per_event_source_and_no_join(stored):
    text = plan(mart.evidence_mart(stored))
    assert "Join" not in text
    # six event groupings, two groupings for the medians (values, then groups), one per entity
    assert exchanges(text) == 6 + 2 * 2 + 1


def test_mart_reads_only_its_columns(stored):
    text = plan(mart.evidence_mart(stored))
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert len(scans) == 8
    assert not any("summary" in s or "component_name" in s for s in scans)
    assert "sha2" not in "".join(re.findall(r"Filter .*", text))


def test_bridge_needs_one_shuffle_for_all_sources(stored):
    from casefile.operators.identity import identity_bridge
    from casefile.plans.baseline import by_system

    text = plan(identity_bridge(by_system(stored)))
    assert exchanges(text) == 1 and "Join" not in text


def test_conditional_distinct_counts_do_not_expand_rows(stored):
    for frame in (
        mart.entity_counts(stored["recalls"], "recalls"),
        mart.entity_counts(stored["investigations"], "investigations"),
        reports.reports_by_state(stored["complaints"].withColumnRenamed("received_date", "d")),
    ):
        assert "Expand" not in plan(frame)


def test_top_is_taken_per_task(stored):
    queue = queries.rules.review_queue(mart.evidence_mart(stored))
    assert "TakeOrderedAndProject" in plan(reports.top_queue(queue))


def test_orphans_are_found_in_one_shuffle_without_a_join(stored):
    from casefile.operators import star

    facts = {name: star.FACTS[name](df) for name, df in stored.items()}
    dim = stored["ratings"].select("vehicle_key").distinct()
    text = plan(star.orphan_keys(dim, facts))
    assert "Join" not in text and exchanges(text) == 2  # the dimension's distinct and the keys


def test_filters_reach_the_scan(spark):
    text = plan(adapter.recalls(spark, SF_DIR))
    assert "EqualTo(l_linestatus,F)" in text and "EqualTo(l_returnflag,A)" in text


def test_a_hot_key_gives_the_same_rows(spark):
    frame = spark.range(20000).selectExpr("if(id % 3 = 0, 'hot', string(id % 100)) AS k", "string(id) AS a")
    kept = dedup.dedup_by_key(frame, "k")
    assert kept.count() == 101
    assert kept.filter("k = 'hot'").count() == 1


def test_a_hot_entity_is_split_in_the_join_to_the_dimension(spark):
    """Facts meet the entity dimension in a join Spark may split: a third of the rows on one key."""
    from casefile.operators import measures

    fact = spark.range(400_000).selectExpr(
        "if(id % 3 = 0, 'hot', string(id % 5000)) AS vehicle_key", "string(id) AS complaint_id", "id % 2 = 0 AS severe_report_flag"
    )
    entity = spark.range(5000).selectExpr("string(id) AS vehicle_key", "string(id % 7) AS make").unionAll(
        spark.createDataFrame([("hot", "hot")], "vehicle_key string, make string")
    )
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    before = {name: spark.conf.get(name, None) for name in changed}
    for name, value in changed.items():
        spark.conf.set(name, value)
    try:
        model = {"complaint": fact, "entity": entity}
        grouped = measures.measures(["complaint_reports", "severe_complaint_reports"], model, by=["make"])
        rows = {r["make"]: tuple(r)[1:] for r in grouped.collect()}
        assert "skew=true" in plan(grouped)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    assert rows["hot"] == (133334, 66667)
    assert sum(n for n, _ in rows.values()) == 400_000


@pytest.mark.parametrize("name", ["complaints", "recalls", "investigations", "manufacturer_communications", "state_registrations"])
def test_tables_that_grow_are_not_sent_to_the_driver(spark, name):
    broadcast = re.findall(r"BroadcastExchange.*\n.*\n.*\n.*", plan(adapter.bronze(spark, SF_DIR, name)))
    assert not any(column in text for text in broadcast for column in ("p_partkey", "o_orderkey", "c_custkey"))


def test_a_profile_scans_its_source_once(spark):
    from casefile.operators import profiling

    spec = queries.PROFILE_SPECS["complaints"]
    profile = profiling.profile(adapter.complaints(spark, SF_DIR), spec, spark.range(0))
    profile.collect()
    final = plan(profile).split("== Initial Plan ==")[0]
    assert final.count("ReusedExchange") >= 2


@pytest.mark.parametrize("name", ["dq_checks", "dq_checks_failing", "dq_status", "measures_sets", "alias_what_if", "entity_drillthrough"])
def test_surviving_records_are_chosen_once(spark, name):
    """What reads a source in several places reads its staged columns, so the query itself ranks no record any more."""
    assert "row_number" not in plan(queries.QUERIES[name](spark, SF_DIR))


def test_survivors_are_chosen_by_half_a_digest_in_the_order_of_the_whole(spark):
    frame = spark.range(5000).selectExpr("string(id % 700) AS k", "string(id) AS a", "IF(id % 3 = 0, NULL, string(id % 11)) AS b")
    kept = dedup.dedup_by_key(frame, "k")
    least = frame.withColumn("d", dedup.row_digest(["a", "b"])).groupBy("k").agg(dedup.F.expr("min_by(struct(a, b), d)").alias("r"))
    assert sorted(map(str, kept.collect())) == sorted(map(str, least.select("k", "r.*").collect()))
    before = plan(kept)[plan(kept).index("Exchange hashpartitioning(k"):]
    assert "substring(unhex(sha2(" in before


def test_a_lookup_makes_its_mart_from_the_written_facts(spark, monkeypatch):
    """The surviving records are chosen when the facts are written, and not once more for the mart."""
    asked = []
    listed = queries.lookup.listed
    monkeypatch.setattr(queries.lookup, "listed", lambda chosen: asked.append(plan(chosen)) or listed(chosen))
    found = queries.QUERIES["entity_lookup"](spark, SF_DIR).select("vehicle_key").distinct().count()
    assert found <= 5 and len(asked) == 1 and "normalized_make" in asked[0]
    assert "row_number" not in asked[0]


def test_a_record_key_is_shuffled_as_bytes_without_the_entity_key(spark):
    for name, key in (("communications", "communication_record_key"), ("investigations", "investigation_record_key")):
        text = plan(queries.silver(spark, SF_DIR, name).select("vehicle_key", key))
        before = text[text.index("Exchange hashpartitioning(_record"):]
        project = before[before.index("Project ["):].split("\n")[0]
        assert "_record" in project and "AS vehicle_key" not in project and key not in project


def test_a_column_that_was_not_staged_is_not_silently_missing(spark):
    model = queries.Model(spark, SF_DIR, needed={"variants": ["normalized_make", "normalized_model", "model_year_int"]})
    fuel = model["fuel"]
    keys = {r[0] for r in queries.fact(spark, SF_DIR, "fuel").select("vehicle_key").distinct().collect()}
    assert {r[0] for r in fuel.select("vehicle_key").distinct().collect()} == keys
    with pytest.raises(Exception, match="was not staged"):
        fuel.select("drive").collect()


def test_facts_of_measures_by_set_are_shuffled_once_more_by_their_id(spark):
    """Attributes come from a fact's own identity, not by a join, and sets multiply sums of groups, not ids."""
    text = plan(queries.QUERIES["measures_sets"](spark, SF_DIR))
    assert "Join" not in text
    expanded = re.findall(r"Expand \[.*", text)
    assert expanded and not any("_id" in line.replace("grouping_id", "") for line in expanded)


def test_described_facts_have_the_attributes_of_the_entity_dimension(spark):
    named = ["make", "model", "model_year"]
    model = queries.Model(spark, SF_DIR, described=tuple(named))
    entity = queries.the_dim(spark, SF_DIR).select("vehicle_key", *named)
    for name in ("complaint", "fuel"):
        rows = model[name].select("vehicle_key", *named)
        joined = rows.select("vehicle_key").join(entity, "vehicle_key", "left")
        assert rows.where("vehicle_key IS NULL").count() > 0
        assert sorted(map(str, rows.collect())) == sorted(map(str, joined.collect()))


def test_half_of_a_record_key_is_shuffled_unless_the_key_is_read(spark):
    frame = queries.silver(spark, SF_DIR, "communications")
    key = queries.fx.record_key("nhtsa_communication_id", "document_id", "vehicle_key", "nhtsa_components")
    for columns, rest in ((["document_id"], False), (["document_id", "communication_record_key"], True)):
        text = plan(frame.select(*columns))
        project = text[text.index("Exchange hashpartitioning(_record"):].split("Project [")[1].split("\n")[0]
        assert ("_record_rest" in project) == rest and ", 1, 16) AS _record" in project
    assert frame.where(frame["communication_record_key"] != key).count() == 0 < frame.count()


def test_gates_are_about_tables_that_are_made_once(spark, monkeypatch):
    """Landed tables are written once and read by all gates; records are chosen once for the checks and the mart, and by the baseline."""
    asked = []
    bronze = adapter.bronze
    monkeypatch.setattr(adapter, "bronze", lambda spark, sf, name: asked.append(name) or bronze(spark, sf, name))
    text = plan(queries.QUERIES["gates"](spark, SF_DIR))
    assert sorted(asked) == sorted(queries.contracts.CONTRACTS)
    assert "lineitem.parquet" not in text
    assert not any("complaint_record_id" in line for line in re.findall(r"Exchange hashpartitioning.*", text))


def test_keys_of_orphans_are_shuffled_as_bytes_if_they_are_digests(spark):
    """Any other key is found as well, as it is spelled."""
    digest = "0" + "ab" * 31 + "c"
    keys = [digest, digest.upper(), digest[1:], "hot", "", "00", "0", "A0", "a0", None]
    fact = spark.createDataFrame([(k,) for k in keys], "vehicle_key string")
    dim = spark.createDataFrame([("hot",), ("a0",), (None,)], "vehicle_key string")
    found = queries.star.orphan_keys(dim, {"f": fact, "g": fact.limit(0)})
    expected = [("f", k) for k in keys if k is not None and k not in ("hot", "a0")]
    assert sorted(map(tuple, found.collect())) == sorted(expected)
    text = plan(queries.star.orphan_keys(dim, {"f": queries.fact(spark, SF_DIR, "fuel")}))
    assert "Exchange hashpartitioning(_packed" in text


def test_the_baseline_shuffles_the_identity_once_to_choose_records(spark):
    """Names and year are part of the key of two sources; spaces around ids and missing years make no other record."""
    row = dict.fromkeys(queries.contracts.CONTRACTS["manufacturer_communications"], "")
    given = {"nhtsa_communication_id": "1", "document_id": "d", "source_make": "A", "source_model": "B", "model_year": "2000", "nhtsa_components": "c"}
    other = [{}, {"document_id": " d "}, {"source_make": "a "}, {"document_id": "e"}, {"document_id": " "}, {"document_id": None}, {"model_year": "x"}]
    rows = [tuple({**row, **given, **o}.values()) for o in other]
    landed = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in row))
    records = queries.baseline._records(landed, "manufacturer_communications", adapter.SETTINGS)
    kept = records.selectExpr("nullif(trim(document_id), '') AS id", "e_make", "e_year").collect()
    assert sorted((r["id"] or "", r["e_make"], r["e_year"]) for r in kept) == [("", "A", 2000), ("d", "A", 2000), ("e", "A", 2000)]
    text = plan(records.select("e_make", "e_model", "e_year", "document_id"))
    shuffle = text[text.index("Exchange hashpartitioning("):]
    names = re.findall(r"AS (\w+)#", shuffle[shuffle.index("Project ["):].split("\n")[0])
    assert sorted(set(names) & {"r0", "r1", "r2", "r3", "r4", "r5"}) == ["r0", "r1", "r5"]
