"""The given tables in the shape of the seven landed extracts (FIXTURES.md, part B)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casefile.settings import Settings
from casefile.sources.contracts import CONTRACTS, SOURCE_IDS

BATCH = "20260101T000000Z"

# Topics of the tables' own vocabulary.
TOPIC_RULES = (
    ("HOT|COLD", "THERMAL"),
    ("BOLT|ROD", "FASTENER"),
    ("GEAR|RING|WIDG.?ET", "ROTATING"),
    ("PLATE|ANVIL", "PLATE"),
)
SETTINGS = Settings(topic_rules=TOPIC_RULES)


# Schemas of the given tables, so that planning a query reads no file footers.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


# Every line belongs to one evidence source (ROUTES) and every part to one reference source or to none
# (REFERENCES); nothing is left out. What is rare in the domain is a flag value, not a filter.
ROUTES = {
    "complaints": "l_returnflag = 'R'",
    "recalls": "l_returnflag = 'A' AND l_linestatus = 'F'",
    "investigations": "l_returnflag = 'A' AND l_linestatus = 'O'",
    "manufacturer_communications": "l_returnflag = 'N'",
}
REFERENCES = {"ncap_ratings": "p_partkey % 7 IN (0, 3)", "fuel_economy": "p_partkey % 7 IN (2, 5)"}

YEAR = "CASE p_size WHEN 1 THEN '' WHEN 2 THEN '9999' ELSE string(p_size + 1975) END"
# Later lines of an order are about earlier years of the part, which no reference source has.
LINE_YEAR = (
    "CASE p_size WHEN 1 THEN '' WHEN 2 THEN '9999' "
    "ELSE string(p_size + 1975 - if(l_linenumber > 3, l_suppkey % 20, 0)) END"
)
LINE_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"


def _twice(df: DataFrame, condition: str, column: str) -> DataFrame:
    """Adds a column that is 1, and a second row with 2 where the condition holds: records to be deduplicated."""
    copies = F.expr(f"if({condition}, array(1, 2), array(1))")
    return df.withColumn(column, F.explode(copies))


def _contract(df: DataFrame, name: str, columns: dict[str, str]) -> DataFrame:
    """Exactly the contract's columns in its order, as text; those not given are empty."""
    return df.selectExpr(*[f"string({columns.get(c, chr(39) * 2)}) AS `{c}`" for c in CONTRACTS[name]])


def _shuffled(df: DataFrame) -> DataFrame:
    """A table that grows with the facts, so no side to broadcast: its compressed file says little of its size in memory.

    Queries over several sources would hold a copy for each of them in the driver at once.
    """
    return df.hint("shuffle_hash")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _shuffled(table(spark, sf_dir, "part"))
    lines = table(spark, sf_dir, "lineitem")
    return lines.join(part, lines.l_partkey == part.p_partkey)


def complaints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _twice(_lines(spark, sf_dir).filter(ROUTES["complaints"]), "l_suppkey % 25 = 3", "occurrence")
    return _contract(
        rows,
        "complaints",
        {
            "complaint_record_id": LINE_ID,
            "complaint_id": "l_orderkey",
            "manufacturer_name": "p_brand",
            "source_make": "p_brand",
            "source_model": "p_name",
            "model_year": LINE_YEAR,
            "crash_flag": "if(l_quantity >= 48, 'Y', 'N')",
            "incident_date": "CASE l_linenumber WHEN 5 THEN '' WHEN 6 THEN '20251301' "
            "ELSE date_format(date_sub(l_shipdate, l_linenumber), 'yyyyMMdd') END",
            "fire_flag": "if(l_discount >= 0.095D, 'yes', '')",
            "injury_count": "if(l_tax >= 0.075D, ' 1 ', 'N/A')",
            "death_count": "if(l_quantity = 50, '1', '0')",
            "component_name": "p_name",
            "record_created_date": "date_format(l_shipdate, 'yyyyMMdd')",
            "complaint_received_date": "date_format(l_shipdate, 'yyyyMMdd')",
            "mileage_at_failure": "if(l_linenumber = 7, '5.7', string(floor(l_extendedprice)))",
            "occurrence_count": "occurrence",
            "product_type": "if(p_type = 'LARGE', 'T', 'V')",
            "medical_attention_flag": "if(l_tax >= 0.065D, 'TRUE', '0')",
            "vehicle_towed_flag": "if(l_quantity >= 45, '1', 'no')",
            "incident_state": "concat('S', l_suppkey % 50)",
        },
    )


def recalls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _twice(_lines(spark, sf_dir).filter(ROUTES["recalls"]), "l_suppkey % 25 = 4", "entry")
    return _contract(
        rows,
        "recalls",
        {
            "recall_record_id": LINE_ID,
            "campaign_number": "concat(' ', l_suppkey)",
            "source_make": "p_brand",
            "source_model": "p_name",
            "model_year": LINE_YEAR,
            "component_name": "p_name",
            "filing_manufacturer": "p_brand",
            "product_type": "if(p_type = 'LARGE', 'T', 'V')",
            "potential_units_affected": "floor(l_extendedprice)",
            "recall_initiator": "concat('entry ', entry)",
            "report_received_date": "date_format(l_shipdate, 'yyyyMMdd')",
            "defect_summary": "concat('defect, type ', p_type)",
            "consequence_summary": "concat('found in ', p_name)",
            "corrective_action": "concat('replace the ', p_name)",
            "recalled_component_id": "l_partkey",
            "do_not_drive_flag": "if(l_discount >= 0.085D AND l_quantity >= 49, 'Yes', 'No')",
            "park_outside_flag": "if(l_discount >= 0.085D AND l_quantity BETWEEN 47 AND 48, 'TRUE', 'FALSE')",
        },
    )


def investigations(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _shuffled(table(spark, sf_dir, "orders"))
    lines = _lines(spark, sf_dir).filter(ROUTES["investigations"])
    rows = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return _contract(
        rows,
        "investigations",
        {
            "investigation_number": "o_custkey",
            "source_make": "p_brand",
            "source_model": "p_name",
            "model_year": LINE_YEAR,
            "component_name": "p_name",
            "manufacturer_name": "p_brand",
            "opened_date": "date_format(o_orderdate, 'yyyyMMdd')",
            "closed_date": "if(o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' AND l_quantity >= 40, '', "
            "date_format(l_shipdate, 'yyyyMMdd'))",
            "subject": "concat('inquiry, type ', p_type)",
            "summary": "concat('order ', o_orderkey)",
        },
    )


def communications(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _lines(spark, sf_dir).filter(ROUTES["manufacturer_communications"])
    return _contract(
        rows,
        "manufacturer_communications",
        {
            "nhtsa_communication_id": "l_suppkey",
            "date_added": "date_format(l_shipdate, 'yyyyMMdd')",
            "document_id": "l_orderkey",
            "manufacturer_communication_date": "date_format(l_shipdate, 'yyyyMMdd')",
            "communication_type": "concat('TYPE ', l_linenumber)",
            "source_make": "p_brand",
            "source_model": "p_name",
            "model_year": LINE_YEAR,
            "nhtsa_components": "p_name",
            "manufacturer_system": "p_type",
            "summary": "concat('bulletin on ', p_name)",
        },
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").filter(REFERENCES["ncap_ratings"])
    return _contract(
        rows,
        "ncap_ratings",
        {
            "make": "lower(replace(p_brand, '#', '-'))",
            "model": "p_name",
            "model_yr": YEAR,
            "body_style": "concat('B', p_partkey % 4)",
            "vehicle_type": "p_type",
            "drive_train": "if(p_partkey % 2 = 0, 'FWD', 'RWD')",
            "num_of_seating": "if(p_partkey % 5 = 0, '', string(p_partkey % 3 + 4))",
            "blind_spot_detection": "'Standard'",
            "adaptive_cruise_control": "'Optional'",
            "frnt_collision_warning": "'No'",
            "lane_departure_warning": "'Yes'",
            "overall_stars": "if(p_partkey % 11 = 0, 'N/A', string(p_size % 5 + 1))",
            "overall_frnt_stars": "p_size % 5 + 1",
            "overall_side_stars": "p_size % 4 + 1",
            "rollover_possibility": "concat('0.', p_size)",
            "static_stabi_factor": "if(p_partkey % 7 = 0, 'n/a', '1.25')",
            "rollover_stars": "p_size % 3 + 3",
        },
    )


def variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").filter(REFERENCES["fuel_economy"])
    return _contract(
        rows,
        "fuel_economy",
        {
            "id": "p_partkey",
            "make": "lower(replace(p_brand, '#', '-'))",
            "model": "p_name",
            "year": YEAR,
            "VClass": "concat('CLASS ', p_size % 6)",
            "fuelType": "if(p_partkey % 3 = 0, 'Diesel', 'Regular')",
            "drive": "if(p_partkey % 2 = 0, 'FWD', 'AWD')",
            "trany": "if(p_size % 2 = 0, 'Manual', 'Automatic')",
            "cylinders": "p_size % 3 * 2 + 4",
            "displ": "concat(p_size % 4 + 1, '.5')",
            "city08": "p_size + 12",
            "highway08": "p_size + 20",
            "comb08": "p_size + 15",
            "co2TailpipeGpm": "if(p_partkey % 13 = 0, '-', string(p_size * 10))",
            "fuelCost08": "floor(p_retailprice)",
            "ghgScore": "p_size % 10",
        },
    )


def registrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customer = _shuffled(table(spark, sf_dir, "customer"))
    nation = table(spark, sf_dir, "nation")
    rows = orders.join(customer, orders.o_custkey == customer.c_custkey).join(
        nation, customer.c_nationkey == nation.n_nationkey
    )
    keys = ["year(o_orderdate) AS year", "concat(' ', lower(n_name)) AS state", "c_mktsegment AS category"]
    keyed = rows.selectExpr(*keys, "lower(o_orderpriority) AS type", "CAST(floor(o_totalprice) AS BIGINT) AS price")
    totals = keyed.groupBy("year", "state", "category", "type").agg(F.sum("price").alias("total"))
    # some rows come twice, some with a second, conflicting number
    numbers = "CASE total % 10 WHEN 3 THEN array(total, total) WHEN 7 THEN array(total, total + 1) ELSE array(total) END"
    return _contract(
        totals.withColumn("number", F.explode(F.expr(numbers))),
        "state_registrations",
        {
            "year": "year",
            "state": "state",
            "category": "category",
            "registration_type": "type",
            "vehicles": "number",
        },
    )


# Contract table -> adapter.
ADAPTERS = {
    "complaints": complaints,
    "recalls": recalls,
    "investigations": investigations,
    "manufacturer_communications": communications,
    "ncap_ratings": ratings,
    "fuel_economy": variants,
    "state_registrations": registrations,
}


def bronze(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ADAPTERS[name](spark, sf_dir)


def with_source(df: DataFrame, name: str) -> DataFrame:
    """The two provenance columns the facts carry."""
    return df.withColumns({"_source_id": F.lit(SOURCE_IDS[name]), "_batch_id": F.lit(BATCH)})
