"""The mart computed a second time, from the landed text rows, to reconcile against.

Nothing of the main route's identity, flags, casts, events, aggregates or medians is used: names are
normalised by splitting instead of replacing, events are those with a number of matching rows instead
of maxima of flags, medians run over rows instead of value counts, and sources are joined to the
entity list instead of united. Shared are the choice of the surviving record (`dedup_by_key`) and the
rules that turn counts into labels.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casefile.operators.dedup import dedup_by_key
from casefile.operators.rules import with_review_rules
from casefile.settings import Settings
from casefile.sources.contracts import CONTRACTS

_ENTITY = ["make", "model", "model_year"]
_ENTITY_KEY = ["e_make", "e_model", "e_year"]

# Contract table -> make, model, year.
_IDENTITY = {
    "complaints": ("source_make", "source_model", "model_year"),
    "recalls": ("source_make", "source_model", "model_year"),
    "investigations": ("source_make", "source_model", "model_year"),
    "manufacturer_communications": ("source_make", "source_model", "model_year"),
    "ncap_ratings": ("make", "model", "model_yr"),
    "fuel_economy": ("make", "model", "year"),
}
# Contract table -> what makes a record, as SQL.
_RECORD = {
    "complaints": ["complaint_record_id"],
    "recalls": ["recall_record_id"],
    "investigations": ["trim(investigation_number)", "e_make", "e_model", "e_year", "component_name"],
    "manufacturer_communications": [
        "trim(nhtsa_communication_id)", "trim(document_id)", "e_make", "e_model", "e_year", "nhtsa_components",
    ],
    "ncap_ratings": CONTRACTS["ncap_ratings"],
    "fuel_economy": ["id"],
}


def _yes(column: str) -> str:
    return f"array_contains(array('y', 'yes', 'true', '1'), lower(trim({column})))"


def _number(column: str) -> str:
    return f"CASE WHEN trim({column}) RLIKE '^[+-]?[0-9]+$' THEN try_cast(trim({column}) AS BIGINT) END"


def _words(column: str) -> str:
    return f"array_join(filter(split(upper(coalesce({column}, '')), '[^A-Z0-9]+'), w -> w <> ''), ' ')"


def _is_day(column: str) -> str:
    return f"(trim({column}) RLIKE '^[0-9]{{8}}$' AND try_to_timestamp(trim({column}), 'yyyyMMdd') IS NOT NULL)"


def _median(name: str, column: str) -> str:
    return f"percentile({_number(column)}, 0.5) AS {name}"


_SEVERE = (
    f"({_yes('crash_flag')} OR {_yes('fire_flag')} OR coalesce({_number('injury_count')}, 0) > 0 "
    f"OR coalesce({_number('death_count')}, 0) > 0)"
)
# Contract table -> id of its events, and count -> (condition on a row, do rows without an id make an event).
_EVENTS = {
    "complaints": (
        "complaint_id",
        {
            "complaint_reports": ("true", False),
            "severe_complaint_reports": (_SEVERE, True),
            "crash_reported_complaints": (_yes("crash_flag"), True),
            "fire_reported_complaints": (_yes("fire_flag"), True),
        },
    ),
    "recalls": (
        "campaign_number",
        {
            "recall_campaigns": ("true", False),
            "do_not_drive_campaigns": (_yes("do_not_drive_flag"), False),
            "park_outside_campaigns": (_yes("park_outside_flag"), False),
        },
    ),
    "investigations": (
        "investigation_number",
        {
            "investigations": ("true", False),
            "open_investigations": (f"NOT coalesce({_is_day('closed_date')}, false)", False),
        },
    ),
}
# Contract table -> largest amount of an event, added up over events.
_AMOUNTS = {"complaints": {"reported_injuries": "injury_count", "reported_deaths": "death_count"}}
# Contract table -> aggregates over the rows of an entity; one distinct count each.
_AGGREGATES = {
    "manufacturer_communications": ["count(DISTINCT nullif(trim(document_id), '')) AS manufacturer_documents"],
    "ncap_ratings": [
        "count(DISTINCT coalesce(body_style, ''), coalesce(vehicle_type, ''), coalesce(drive_train, ''), "
        "coalesce(num_of_seating, '')) AS ncap_tested_variants",
        _median("median_overall_stars", "overall_stars"),
    ],
    "fuel_economy": [
        "count(DISTINCT nullif(trim(id), '')) AS epa_variants",
        _median("median_combined_mpg", "comb08"),
        _median("median_annual_fuel_cost", "fuelCost08"),
    ],
}


def by_system(silver: dict[str, DataFrame], settings: Settings = Settings()) -> dict[str, DataFrame]:
    """Silver frames of the identity sources under their source-system labels."""
    return {label: silver[name] for name, label in settings.source_systems.items()}


def _records(landed: DataFrame, table: str, settings: Settings) -> DataFrame:
    """Surviving records of a landed table with a valid identity."""
    contract = CONTRACTS[table]
    rows = landed.select(*contract)
    if "product_type" in contract:
        rows = rows.filter(F.col("product_type") == settings.product_value)
    make, model, year = _IDENTITY[table]
    named = rows.selectExpr(
        "*", f"{_words(make)} AS e_make", f"{_words(model)} AS e_model", f"int({_number(year)}) AS e_year"
    )
    valid = f"e_make <> '' AND e_model <> '' AND e_year BETWEEN {settings.min_year} AND {settings.max_year}"
    # the identity is part of the key as it is, so that it is shuffled once; a year is a number or NULL, never ''
    made = {f"r{i}": sql for i, sql in enumerate(_RECORD[table]) if sql not in _ENTITY_KEY}
    keys = [*made, *[sql for sql in _RECORD[table] if sql in _ENTITY_KEY]]
    keyed = named.selectExpr("*", *[f"coalesce({sql}, '') AS {name}" for name, sql in made.items()])
    kept = dedup_by_key(keyed, keys, digest_of=contract).filter(valid)
    # a trimmed id is in the key already and is trimmed wherever it is read
    trimmed = {sql[5:-1]: F.col(name) for name, sql in made.items() if sql.startswith("trim(")}
    return kept.withColumns(trimmed).drop(*made)


def _event_counts(records: DataFrame, table: str) -> DataFrame:
    """Counts per entity: rows that meet a condition are counted per event, then events that have any. No row is expanded."""
    id_col, named = _EVENTS[table]
    amounts = _AMOUNTS.get(table, {})
    rows = records.selectExpr(
        *_ENTITY_KEY,
        f"nullif(trim({id_col}), '') AS event",
        *[f"{condition} AS {name}" for name, (condition, _) in named.items()],
        *[f"coalesce({_number(column)}, 0) AS {name}" for name, column in amounts.items()],
    )
    per_event = rows.groupBy(*_ENTITY_KEY, "event").agg(
        *[F.count_if(name).alias(name) for name in named], *[F.max(name).alias(name) for name in amounts]
    )
    without_id = {name: F.lit(counts) for name, (_, counts) in named.items()}
    return per_event.groupBy(*_ENTITY_KEY).agg(
        *[F.count_if((F.col(name) > 0) & (F.col("event").isNotNull() | without_id[name])).alias(name) for name in named],
        *[F.sum(name).alias(name) for name in amounts],
    )


def baseline_mart(bronze: dict[str, DataFrame], settings: Settings = Settings()) -> DataFrame:
    """Landed tables (contract name -> rows) to the mart."""
    # Source-system labels by contract table.
    systems = dict(zip(_IDENTITY, settings.source_systems.values(), strict=True))
    entity = _ENTITY_KEY
    records = {table: _records(bronze[table], table, settings) for table in _IDENTITY}
    parts = [_event_counts(records[table], table).withColumn(f"in_{table}", F.lit(systems[table])) for table in _EVENTS]
    parts += [
        records[table].groupBy(*entity).agg(*[F.expr(sql) for sql in sqls], F.lit(systems[table]).alias(f"in_{table}"))
        for table, sqls in _AGGREGATES.items()
    ]
    # One row per entity on every side, all partitioned by the same columns.
    wide = reduce(lambda a, b: a.join(b, entity, "full"), parts)
    present = F.array_compact(F.array(*[F.col(f"in_{table}") for table in _IDENTITY]))
    matched = F.arrays_overlap(present, F.array(*[F.lit(s) for s in settings.reference_systems]))
    counts = [c for part in parts for c in part.columns if c not in entity and not c.startswith(("in_", "median_"))]
    described = wide.fillna(0, subset=counts).select(
        F.expr("sha2(concat_ws('||', e_make, e_model, string(e_year)), 256)").alias("vehicle_key"),
        *[F.col(own).alias(name) for own, name in zip(entity, _ENTITY, strict=True)],
        F.size(present).cast("bigint").alias("source_system_count"),
        matched.alias("reference_exact_match_flag"),
        (F.col("e_year") >= settings.era_start).alias("reference_year_eligible"),
        F.when(matched, "MATCHED").otherwise("UNRESOLVED").alias("reference_match_status"),
        F.lit(settings.rule_version).alias("rule_version"),
        F.lit(settings.threshold_status).alias("threshold_validation_status"),
        F.expr("concat_ws(' ', string(e_year), e_make, e_model)").alias("vehicle_label"),
        *[F.col(c).cast("bigint").alias(c) for c in counts],
        *[c for part in parts for c in part.columns if c.startswith("median_")],
    )
    sources = " + ".join(
        f"int({c} > 0)"
        for c in (
            "complaint_reports", "recall_campaigns", "investigations", "manufacturer_documents",
            "ncap_tested_variants", "epa_variants",
        )
    )
    derived = described.selectExpr(
        "*",
        "double(severe_complaint_reports) / nullif(complaint_reports, 0) AS severe_complaint_share",
        f"{sources} AS evidence_source_count",
    )
    return with_review_rules(derived, settings)


def ordered_baseline(bronze: dict[str, DataFrame], settings: Settings = Settings()) -> DataFrame:
    """The baseline in report order: make, model, year (a range-partitioned sort)."""
    return baseline_mart(bronze, settings).orderBy(*_ENTITY)
