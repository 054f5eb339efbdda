"""The semantic measures, as grouped aggregates under a caller's filter and grouping.

`model` maps table names to frames: the facts (complaint, recall, investigation,
communication, ncap, fuel, registration), entity (the dimension), mart, review_queue,
alias_queue and checks.

A distinct count takes a missing id as one value, as the measure language does. A share
with a zero denominator is NULL.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casefile.functions import ratio
from casefile.operators import frequent_keys
from casefile.operators.mart import counted_medians, median_by, value_counts


@dataclass(frozen=True)
class Measure:
    """kind: distinct | max_then_sum | median | count | sum | avg | max | ratio | status"""

    kind: str
    table: str = ""
    column: str = ""
    where: str | None = None  # a SQL condition on the table's rows
    value: str = ""  # max_then_sum: what is maximised per id
    parts: tuple[str, ...] = ()  # ratio and status: the measures it is made of


# Output name -> definition.
MEASURES = {
    "complaint_reports": Measure("distinct", "complaint", "complaint_id"),
    "severe_complaint_reports": Measure("distinct", "complaint", "complaint_id", "severe_report_flag"),
    "severe_complaint_share": Measure("ratio", parts=("severe_complaint_reports", "complaint_reports")),
    "crash_reported_complaints": Measure("distinct", "complaint", "complaint_id", "crash_reported_flag"),
    "fire_reported_complaints": Measure("distinct", "complaint", "complaint_id", "fire_reported_flag"),
    "recall_campaigns": Measure("distinct", "recall", "campaign_number"),
    "do_not_drive_campaigns": Measure("distinct", "recall", "campaign_number", "do_not_drive"),
    "park_outside_campaigns": Measure("distinct", "recall", "campaign_number", "park_outside"),
    "potential_units_affected": Measure(
        "max_then_sum", "recall", "campaign_number", value="potential_units_affected_int"
    ),
    "investigations": Measure("distinct", "investigation", "investigation_number"),
    "open_investigations": Measure(
        "distinct", "investigation", "investigation_number", "open_investigation_flag"
    ),
    "manufacturer_documents": Measure("distinct", "communication", "document_id"),
    "tested_ncap_variants": Measure("distinct", "ncap", "ncap_variant_key"),
    "median_overall_stars": Measure("median", "ncap", "overall_stars"),
    "epa_vehicle_variants": Measure("distinct", "fuel", "epa_vehicle_id"),
    "median_combined_mpg": Measure("median", "fuel", "combined_mpg"),
    "median_annual_fuel_cost": Measure("median", "fuel", "annual_fuel_cost"),
    "vehicle_keys": Measure("distinct", "entity", "vehicle_key"),
    "critical_review_vehicles": Measure(
        "distinct", "review_queue", "vehicle_key", "review_priority = 'CRITICAL'"
    ),
    "high_review_vehicles": Measure("distinct", "review_queue", "vehicle_key", "review_priority = 'HIGH'"),
    "review_queue_vehicles": Measure("distinct", "review_queue", "vehicle_key"),
    "reference_exact_match_keys": Measure("distinct", "entity", "vehicle_key", "reference_exact_match_flag"),
    "reference_exact_match_rate": Measure("ratio", parts=("reference_exact_match_keys", "vehicle_keys")),
    "era_eligible_exact_match_keys": Measure(
        "distinct", "entity", "vehicle_key", "reference_exact_match_flag AND reference_year_eligible"
    ),
    "era_eligible_vehicle_keys": Measure("distinct", "entity", "vehicle_key", "reference_year_eligible"),
    "era_eligible_exact_match_rate": Measure(
        "ratio", parts=("era_eligible_exact_match_keys", "era_eligible_vehicle_keys")
    ),
    "alias_work_queue_p0": Measure("distinct", "alias_queue", "vehicle_key", "alias_priority = 'P0'"),
    "alias_work_queue_p1": Measure("distinct", "alias_queue", "vehicle_key", "alias_priority = 'P1'"),
    "alias_backlog_p2": Measure("distinct", "mart", "vehicle_key", "alias_priority = 'P2'"),
    "rule_version": Measure("max", "entity", "rule_version"),
    "threshold_validation_status": Measure("max", "entity", "threshold_validation_status"),
    "average_evidence_sources": Measure("avg", "mart", "evidence_source_count"),
    "registration_records": Measure("count", "registration"),
    "registered_vehicles": Measure("sum", "registration", "registered_vehicles"),
    "failed_data_quality_checks": Measure("count", "checks", where="NOT passed"),
    "data_quality_status": Measure("status", parts=("failed_data_quality_checks",)),
}


_TEXT = re.compile(r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"")
_NAME = re.compile(r"`([^`]+)`|\b([A-Za-z_]\w*)\b(?!\s*\()")


def filter_columns(where: str, tables: dict[str, DataFrame]) -> set[str]:
    """The columns of the tables that a condition names, in lower case.

    Raises what Spark says of a condition that is no condition on them: an unknown column or function, a
    syntax error, types that do not fit.
    """
    kinds = {}
    for df in tables.values():
        for name, kind in df.dtypes:
            kinds.setdefault(name.lower(), kind)
    spark = next(iter(tables.values())).sparkSession
    probe = spark.createDataFrame([], ", ".join(f"`{name}` {kind}" for name, kind in kinds.items()))
    probe.filter(where).schema  # noqa: B018  analysis only, no job
    named = {(quoted or plain).lower() for quoted, plain in _NAME.findall(_TEXT.sub(" ", where))}
    return named & set(kinds)


def _check_filters(model, tables, where: str | None, where_entity: str | None) -> set[str]:
    """Columns of `where`; raises if it, or `where_entity`, is no condition that one of the asked tables can take."""
    if where_entity is not None:
        filter_columns(where_entity, {"entity": model["entity"]})
    if where is None:
        return set()
    asked = {table: model[table] for table in tables}
    columns = filter_columns(where, asked)
    if not any(columns <= {c.lower() for c in df.columns} for df in asked.values()):
        raise ValueError(f"the filter {where!r} applies to none of {sorted(asked)}")
    return columns


def _in_context(model, table: str, by, where, where_entity, needed: set[str] = frozenset(), frequent: dict | None = None) -> DataFrame:
    """The table under the caller's filters, with the grouping columns it lacks taken from the entity dimension.

    A filter on columns that the table lacks (`needed`), or on entities where it has none, leaves it as it is; a
    grouping column it cannot get is NULL there. Rows without an entity match nothing in the join: they
    have NULL attributes, and no entity filter keeps them.
    """
    df = model[table]
    if where is not None and needed <= {c.lower() for c in df.columns}:
        df = df.filter(where)
    borrowed = [c for c in by if c not in df.columns]
    if table == "entity":
        return df if where_entity is None else df.filter(where_entity)
    if not borrowed and where_entity is None:
        return df
    entity = model["entity"]
    kinds = dict(entity.dtypes)
    if "vehicle_key" not in df.columns:
        return df.withColumns({c: F.lit(None).cast(kinds.get(c, "string")) for c in borrowed})
    known = [c for c in borrowed if c in kinds]
    chosen = (entity if where_entity is None else entity.filter(where_entity)).select("vehicle_key", *known)
    absent = {c: F.lit(None).cast("string") for c in borrowed if c not in kinds}
    if frequent is not None:
        found = frequent_keys.attach(df, chosen.withColumn("_there", F.lit(True)), "vehicle_key", [*known, "_there"], **frequent)
        return (found if where_entity is None else found.filter("_there")).drop("_there").withColumns(absent)
    if where_entity is not None:
        return df.filter("vehicle_key IS NOT NULL").join(chosen, "vehicle_key").withColumns(absent)
    # rows without an entity are dealt by their own id, under keys that no entity has
    spread = F.concat(F.lit("#"), F.pmod(F.xxhash64(F.col(df.columns[0])), F.lit(4096)).cast("string"))
    keyed = df.withColumn("_key", F.coalesce("vehicle_key", spread))
    return keyed.join(chosen.withColumnRenamed("vehicle_key", "_key"), "_key", "left").drop("_key").withColumns(absent)


def _condition(where: str | None) -> Column:
    return F.lit(True) if where is None else F.coalesce(F.expr(where), F.lit(False))


#: Name of the column that tells grouping sets apart, as Spark numbers them.
GROUPING = "grouping_id"


class Contexts:
    """The groupings of a call: one list of columns, or several that are made from one finest grouping.

    Each family of measures is grouped once to its finest grain: every column of every set, and the id or
    value if it has one. That grain is what the sets are made from, so a table is scanned once and its rows
    are never multiplied; what is, after the first partial grouping, is the rows of the grain, or of measures
    per id the sums of a finest group (`totals`).
    """

    def __init__(self, by):
        by = list(by)
        self.several = any(not isinstance(x, str) for x in by)
        self.sets = [list(x) for x in by] if self.several else [by]
        self.columns = list(dict.fromkeys(c for own in self.sets for c in own))
        self.by = [*self.columns, GROUPING] if self.several else self.columns

    def group(self, grain: DataFrame, more: list[str], *aggregates: Column) -> DataFrame:
        """Aggregates of the grain by each set and by the columns in `more`."""
        if not self.several:
            return grain.groupBy(*self.columns, *more).agg(*aggregates)
        if not self.columns:  # sets without a column are the same group, numbered 0
            return grain.groupBy(*more).agg(*aggregates).withColumn(GROUPING, F.lit(0).cast("bigint"))
        # the columns in `more` are in every set, so they add the same to every number: they come first and are shifted out
        named = [F.col(c) for c in [*more, *self.columns]]
        sets = [[F.col(c) for c in [*more, *own]] for own in self.sets]
        return grain.groupingSets(sets, *named).agg(F.grouping_id().alias(GROUPING), *aggregates)

    def totals(self, grain: DataFrame, key: str, names: list[str]) -> DataFrame:
        """Per set and group, the sums over keys of each column's maximum per key; the grain has a row per finest group and key.

        A key's maximum in a group is counted at one of its rows there, for each set in a column of its own. So the
        grain is shuffled once, by the key, and what the sets multiply are sums per finest group.
        """
        parts = {}
        for i, own in enumerate(self.sets):
            others = [c for c in self.columns if c not in own]
            rows = Window.partitionBy(key, *own).orderBy(*others)
            every = rows.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
            for name in names:  # in the finest set a key has one row for each group
                first = F.lag(F.lit(True)).over(rows).isNull()
                highest = F.when(first, F.max(name).over(every)) if others else F.col(name)
                parts[f"{i}:{name}"] = highest
        dealt = grain.repartition(key).select(*self.columns, *[part.alias(label) for label, part in parts.items()])
        sums = dealt.groupBy(*self.columns).agg(*[F.sum(f"`{label}`").alias(label) for label in parts])
        found = self.group(sums, [], *[F.sum(f"`{label}`").alias(label) for label in parts])
        numbers = [sum(1 << n for n, c in enumerate(reversed(self.columns)) if c not in own) for own in self.sets]
        chosen = [
            F.coalesce(*[F.when(F.col(GROUPING) == number, F.col(f"`{i}:{name}`")) for i, number in enumerate(numbers)]).alias(name)
            for name in names
        ]
        return found.select(*self.by, *chosen)


def _per_id(df: DataFrame, contexts: Contexts, column: str, named: dict[str, Measure]) -> DataFrame:
    """Measures that take one maximum per id and add them up: a distinct count adds up 0 and 1."""
    counted = {name for name, m in named.items() if m.kind == "distinct"}
    per_id = df.groupBy(*contexts.columns, F.col(column).alias("_id")).agg(
        *[F.max(_condition(m.where).cast("int") if name in counted else m.value).alias(name) for name, m in named.items()]
    )
    if contexts.several:
        totals = contexts.totals(per_id, "_id", list(named))
    else:
        totals = per_id.groupBy(*contexts.by).agg(*[F.sum(name).alias(name) for name in named])
    return totals.withColumns(
        {name: (F.coalesce(name, F.lit(0)) if name in counted else F.col(name)).cast("bigint") for name in named}
    )


def _median(df: DataFrame, contexts: Contexts, named: dict[str, Measure]) -> DataFrame:
    columns = {name: m.column for name, m in named.items()}
    if not contexts.several:
        return median_by(df, contexts.columns, columns)
    grain = value_counts(df, contexts.columns, columns)
    counted = contexts.group(grain, ["measure", "value"], F.sum("n").alias("n"))
    return counted_medians(counted, contexts.by, columns)


def _plain(df: DataFrame, contexts: Contexts, named: dict[str, Measure]) -> DataFrame:
    def one(m: Measure) -> Column:
        if m.kind == "count":
            return F.count_if(_condition(m.where))
        return {"sum": F.sum, "avg": F.avg, "max": F.max}[m.kind](m.column)

    if not contexts.several:
        return df.groupBy(*contexts.columns).agg(*[one(m).alias(name) for name, m in named.items()])
    # a mean is kept as its sum and count
    parts = []
    for name, m in named.items():
        parts += [F.sum(m.column).alias(f"{name}:sum"), F.count(m.column).alias(f"{name}:n")] if m.kind == "avg" else [one(m).alias(name)]
    grain = df.groupBy(*contexts.columns).agg(*parts)
    wanted = []
    for name, m in named.items():
        if m.kind == "avg":
            wanted.append((F.sum(F.col(f"`{name}:sum`")) / F.sum(F.col(f"`{name}:n`"))).alias(name))
        else:
            total = F.max(name) if m.kind == "max" else F.sum(name)
            wanted.append((F.coalesce(total, F.lit(0)) if m.kind == "count" else total).alias(name))
    return contexts.group(grain, [], *wanted)


def measures(names, model: dict[str, DataFrame], by=(), where=None, where_entity=None, frequent: dict | None = None) -> DataFrame:
    """Several measures side by side, one row per group (one row in all without `by`).

    `by` is a list of columns, or a list of such lists: then every one of them is a grouping of the result,
    made in one pass, and `grouping_id` tells them apart as Spark numbers grouping sets (a bit for each
    column that a set lacks, the last column lowest). A column that a set lacks is NULL there.

    Measures over the same table and id share one scan and one grouping. Their results
    meet in a union that is grouped once more, so groups missing from one table stay.

    `where` and `where_entity` are SQL conditions on rows of the facts and of the entity dimension. A table
    that lacks a column of `where` stays unfiltered. A condition that names a column of none of the tables
    asked, that Spark cannot read, or that applies to none of the tables, raises.

    `frequent`, the settings of `frequent_keys` or {}, has entities with a large share of a fact's rows found by a
    job beforehand and joined apart. Without it such entities are left to adaptive splitting. The result is the same.
    """
    names, contexts = list(names), Contexts(by)
    base: dict[str, Measure] = {}
    for name in names:
        for part in MEASURES[name].parts or (name,):
            base[part] = MEASURES[part]
    families: dict[tuple, dict[str, Measure]] = {}
    for name, m in base.items():
        kind = "per_id" if m.kind in ("distinct", "max_then_sum") else "median" if m.kind == "median" else "plain"
        column = m.column if kind == "per_id" else ""
        families.setdefault((m.table, kind, column), {})[name] = m
    needed = _check_filters(model, {table for table, _, _ in families}, where, where_entity)
    parts = []
    for (table, kind, column), named in families.items():
        df = _in_context(model, table, contexts.columns, where, where_entity, needed, frequent)
        if kind == "per_id":
            parts.append(_per_id(df, contexts, column, named))
        elif kind == "median":
            parts.append(_median(df, contexts, named))
        else:
            parts.append(_plain(df, contexts, named))
    if contexts.several and [] in contexts.sets:  # the whole has a row, as without `by`, if no table has any
        whole = [(2 ** len(contexts.columns) - 1,)]
        parts.append(parts[0].sparkSession.createDataFrame(whole, f"{GROUPING} bigint"))
    merged = parts[0]
    if len(parts) > 1:
        union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        counted = [n for n, m in base.items() if m.kind in ("distinct", "count")]
        merged = union.groupBy(*contexts.by).agg(*[F.max(name).alias(name) for name in base]).fillna(0, subset=counted)
    derived = {}
    for name in names:
        m = MEASURES[name]
        if m.kind == "ratio":
            derived[name] = ratio(*m.parts)
        elif m.kind == "status":
            # Fixed values
            derived[name] = F.when(F.col(m.parts[0]) == 0, "PASS").otherwise("STOP AND INVESTIGATE")
    return merged.withColumns(derived).select(*contexts.by, *names)


def measure(name: str, model: dict[str, DataFrame], by=(), where=None, where_entity=None) -> DataFrame:
    """One measure by name."""
    return measures([name], model, by, where, where_entity)
