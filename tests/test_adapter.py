"""The adapter uses every given row, and its flags populate every class."""

import pytest
from pyspark.sql import functions as F

from workload import adapter, queries

SF_DIR = "/root/testdata/sf0.001"


def test_every_line_has_one_evidence_source(spark):
    lines = adapter.table(spark, SF_DIR, "lineitem")
    routed = sum(F.when(F.expr(condition), 1).otherwise(0) for condition in adapter.ROUTES.values())
    assert lines.select(routed.alias("n")).filter("n <> 1").count() == 0
    landed = {name: adapter.bronze(spark, SF_DIR, name) for name in adapter.ROUTES}
    landed["complaints"] = landed["complaints"].filter("occurrence_count = '1'")
    landed["recalls"] = landed["recalls"].filter("recall_initiator = 'entry 1'")
    assert sum(df.count() for df in landed.values()) == lines.count()


def test_every_part_has_at_most_one_reference_source(spark):
    parts = adapter.table(spark, SF_DIR, "part")
    routed = sum(F.when(F.expr(condition), 1).otherwise(0) for condition in adapter.REFERENCES.values())
    counts = {r["n"]: r["count"] for r in parts.select(routed.alias("n")).groupBy("n").count().collect()}
    assert set(counts) == {0, 1}
    landed = sum(adapter.bronze(spark, SF_DIR, name).count() for name in adapter.REFERENCES)
    assert landed == counts[1]


def test_every_order_counts_in_the_registrations(spark):
    orders = adapter.table(spark, SF_DIR, "orders").agg(F.expr("sum(bigint(floor(o_totalprice)))")).first()[0]
    rows = adapter.registrations(spark, SF_DIR)
    kept = rows.groupBy("year", "state", "category", "registration_type").agg(F.expr("min(bigint(vehicles)) AS n"))
    assert kept.agg(F.sum("n")).first()[0] == orders
    assert rows.count() > kept.count()


@pytest.fixture(scope="module")
def labels(spark):
    return queries.the_mart(spark, SF_DIR).select("review_priority", "review_reason", "alias_priority").collect()


def test_every_class_is_populated(labels):
    assert {r["review_priority"] for r in labels} == {"CRITICAL", "HIGH", "REVIEW", "MONITOR"}
    assert {r["alias_priority"] for r in labels} == {"NONE", "P0", "P1", "P2"}
    assert len({r["review_reason"] for r in labels}) == 8
