"""The registered queries: each takes (spark, sf_dir), reads the given tables and returns a DataFrame."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casefile import functions as fx
from casefile.operators import dedup, distinct_states, fingerprints, identity, mart, measures, profile_states, profiling
from casefile.operators import quality, quantile_states, rules, star
from casefile.operators.conform import CONFORM_JOBS, FUEL_DECIMALS, FUEL_INTEGERS, made_keys
from casefile.plans import baseline, build, lookup, reports
from casefile.session import scratch_path
from casefile.settings import IDENTITY_COLUMNS
from casefile.sources import contracts, intake, readers, writers
from workload import adapter

SETTINGS = adapter.SETTINGS
IDENTITY_SOURCES = list(SETTINGS.source_systems)


# --- frames the queries start from ----------------------------------------------------------


def silver(spark: SparkSession, sf: str, name: str, lineage: bool = False, bronze: dict[str, DataFrame] | None = None) -> DataFrame:
    table, job = CONFORM_JOBS[name]
    landed = bronze[table] if bronze else adapter.bronze(spark, sf, table)
    conformed = job(landed, SETTINGS)
    return adapter.with_source(conformed, table) if lineage else conformed


def silvers(spark: SparkSession, sf: str, names=None) -> dict[str, DataFrame]:
    return {name: silver(spark, sf, name) for name in (names or IDENTITY_SOURCES)}


def the_bridge(spark, sf) -> DataFrame:
    return identity.identity_bridge(baseline.by_system(silvers(spark, sf), SETTINGS), settings=SETTINGS)


def the_mart(spark, sf) -> DataFrame:
    return mart.evidence_mart(silvers(spark, sf), SETTINGS)


def the_dim(spark, sf) -> DataFrame:
    return star.dim_entity(the_bridge(spark, sf))


# Fact table name in the model -> silver name.
FACT_NAMES = {
    "complaint": "complaints",
    "recall": "recalls",
    "investigation": "investigations",
    "communication": "communications",
    "ncap": "ratings",
    "fuel": "variants",
    "registration": "registrations",
}

# Table names the quality checks report.
FACT_TABLES = {
    "complaint": "gold_fact_complaint",
    "recall": "gold_fact_recall",
    "investigation": "gold_fact_investigation",
    "communication": "gold_fact_manufacturer_communication",
    "ncap": "gold_fact_ncap_variant",
    "fuel": "gold_fact_fuel_economy_variant",
}


def fact(spark, sf, name: str) -> DataFrame:
    source = FACT_NAMES[name]
    return star.FACTS[source](silver(spark, sf, source, lineage=True))


def _as_whole(staged: DataFrame, whole: DataFrame) -> DataFrame:
    """A staged frame with all columns of the whole one: its key made from its identity again, others raise when read."""
    key = F.when(
        fx.valid_identity(SETTINGS.min_year, SETTINGS.max_year), fx.vehicle_key(*IDENTITY_COLUMNS)
    )
    lacking = {
        name: key if name == "vehicle_key" else F.raise_error(F.lit(f"{name} was not staged")).cast(kind)
        for name, kind in whole.dtypes
        if name not in staged.columns
    }
    return staged.withColumns(lacking).select(*whole.columns)


def mart_columns(more: dict[str, list[str]] | None = None, maxima: bool = True) -> dict[str, list[str]]:
    """Silver columns from which bridge, dimension and mart are made, and more; the key is a function of the identity.

    Without `maxima` those of the mart's flags and amounts are left out, for queries that read only its counts of events.
    """
    own = {
        e.source: [*IDENTITY_COLUMNS, e.id_col, *(e.maxima.values() if maxima else ()), *mart.MEDIANS.get(e.source, {}).values()]
        for e in mart.EVENTS
    }
    return {name: list(dict.fromkeys([*columns, *(more or {}).get(name, [])])) for name, columns in own.items()}


# Attribute of the entity dimension -> the identity column that it is.
OF_IDENTITY = {"make": "normalized_make", "model": "normalized_model", "model_year": "model_year_int"}


class Model(dict):
    """Model tables, planned when first asked for; only the sources they need are read.

    `staged` writes each silver table that is asked for to the shared scratch folder first: for queries
    over whole records of a few sources that read them several times. Without it nothing runs while a
    query is built, and every scan reads the columns the query needs.

    `needed` are the columns that are staged (silver name -> columns): for queries that need few columns, but of
    the same sources in several places, which would each choose the surviving records again.

    `described` are attributes of the entity that facts get beside their own columns (of `OF_IDENTITY`). They are
    functions of the identity, from which the entity dimension is made as well, so a row has the values that a join with
    the dimension would find for its key, and NULL without a key.

    `bronze` are the landed tables, where a query has them already (`staged_bronze`).
    """

    def __init__(
        self, spark, sf, staged: bool = False, needed: dict[str, list[str]] | None = None, described: tuple[str, ...] = (),
        bronze: dict[str, DataFrame] | None = None,
    ):
        super().__init__()
        self.spark, self.sf, self.staged, self.needed = spark, sf, staged or needed is not None, needed
        self.described, self.bronze = described, bronze
        self.silver = {}

    def silvers(self, names=None) -> dict[str, DataFrame]:
        names = list(names or IDENTITY_SOURCES)
        new = {n: silver(self.spark, self.sf, n, lineage=True, bronze=self.bronze) for n in names if n not in self.silver}
        if new and self.staged:
            kept = {n: df.select(*self.needed[n]) if self.needed else df for n, df in new.items()}
            written = build.write_tables(self.spark, kept, scratch_path(self.spark, "silver"))
            new = {n: _as_whole(written[n], df) for n, df in new.items()}
        self.silver |= new
        return {name: self.silver[name] for name in names}

    def __missing__(self, name: str) -> DataFrame:
        if name in FACT_NAMES:
            source = FACT_NAMES[name]
            described = bool(self.described) and source in IDENTITY_SOURCES
            table = star.FACTS[source](self.silvers([source])[source], IDENTITY_COLUMNS if described else ())
            if described:
                known = fx.valid_identity(SETTINGS.min_year, SETTINGS.max_year)
                made = {c: F.when(known, F.col(OF_IDENTITY[c])) for c in self.described}
                table = table.withColumns(made).drop(*IDENTITY_COLUMNS)
        elif name == "entity":
            sources = baseline.by_system(self.silvers(), SETTINGS)
            table = star.dim_entity(identity.identity_bridge(sources, settings=SETTINGS))
        elif name == "mart":
            table = mart.evidence_mart(self.silvers(), SETTINGS)
        elif name == "review_queue":
            table = rules.review_queue(self["mart"])
        elif name == "alias_queue":
            table = rules.alias_work_queue(self["mart"])
        elif name == "calendar":
            table = star.calendar(self.silvers(star.DATED_COLUMNS))
        elif name == "topic":
            table = star.dim_topic(self.spark, SETTINGS.topic_rules, SETTINGS.default_topic)
        else:
            raise KeyError(name)
        self[name] = table
        return table

    def keep(self, *names: str) -> Model:
        """Write tables that are read in several places, and that are small beside what they are made from."""
        written = build.write_tables(self.spark, {n: self[n] for n in names}, scratch_path(self.spark, "model"), compression="zstd")
        self.update(written)
        return self


# --- files ----------------------------------------------------------------------------------


def scan_csv_contract(spark, sf):
    """Whole texts through gzip CSV with quotes, separators and line breaks, and back under the contract."""
    path = scratch_path(spark, "documents.csv.gz")
    documents = adapter.table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id"), "lang", "source", "text"
    )
    writers.export(documents, path, fmt="csv.gz")
    return readers.read_extract(spark, path, ["doc_id", "lang", "source", "text"], multi_line=True)


def table_by_name(spark, sf):
    """A catalog view read by its name."""
    adapter.table(spark, sf, "nation").createOrReplaceTempView("casefile_nation")
    return readers.read_table(spark, "casefile_nation")


def _raw_lines(spark, sf) -> DataFrame:
    """Tab-delimited raw lines of 11 fields, some with a field too few or too many."""
    lines = adapter.table(spark, sf, "lineitem")
    fields = [F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")]
    fields += [F.col("l_returnflag"), F.lit("open"), F.lit('a "quoted word'), F.lit(""), F.col("l_linestatus")]
    fields += [F.date_format("l_shipdate", "yyyyMMdd")]
    head = F.concat_ws("\t", *fields)
    tail = F.when(F.col("l_linenumber") == 7, "").when(F.col("l_linenumber") == 6, "\tend\textra").otherwise("\tend")
    return lines.select(F.concat(head, tail).alias("value"))


RAW_LAYOUT = [("order_id", 0), ("line_id", 3), ("note", 6), ("blank", 7), ("ship_day", 9), ("last", 10)]


def malformed_rows(spark, sf):
    path = scratch_path(spark, "raw-lines")
    _raw_lines(spark, sf).write.text(path)
    return readers.count_fields(spark, path, 11)


def _raw_complaints(spark, sf) -> DataFrame:
    """The 51-field raw layout: contract fields at their positions, padding elsewhere, accents in one field."""
    landed = adapter.complaints(spark, sf)
    at = {position: name for name, position in contracts.raw_layout("complaints")}
    cells = [
        F.concat(F.lit("Société "), F.col(at[i])) if at.get(i) == "manufacturer_name"
        else F.concat(F.lit(" "), F.col(at[i])) if i in at
        else F.lit("x")
        for i in range(contracts.RAW_FIELD_COUNTS["complaints"])
    ]
    return landed.select(*[c.alias(f"c{i}") for i, c in enumerate(cells)])


def scan_positional(spark, sf):
    path = scratch_path(spark, "raw-complaints")
    _raw_complaints(spark, sf).write.options(
        sep="\t",
        quote="",
        encoding="ISO-8859-1",
        emptyValue="",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(path)
    good, _ = readers.read_positional(spark, path, contracts.raw_layout("complaints"), 51)
    return good


REGISTRATION_HEADER = list(contracts.RAW_HEADERS["state_registrations"].items())


def scan_named(spark, sf):
    path = scratch_path(spark, "raw-registrations")
    landed = adapter.registrations(spark, sf)
    raw = landed.select(
        F.lit("unused").alias("Note"), *[F.col(name).alias(header) for name, header in reversed(REGISTRATION_HEADER)]
    )
    raw.write.options(header=True, emptyValue="", ignoreLeadingWhiteSpace=False).csv(path)
    return readers.read_named(spark, path, REGISTRATION_HEADER)


IRREGULAR_HEADER = [("event_id", "event"), ("user_id", "user"), ("event_type", "type")]


def _raw_events(spark, sf) -> str:
    """Events as named CSV; some rows lack their last field, some have one too many. Returns the folder."""
    path = scratch_path(spark, "raw-events")
    events = adapter.table(spark, sf, "events")
    tail = F.when(F.col("user_id") % 10 == 3, "").when(F.col("user_id") % 10 == 7, ",click,extra")
    line = F.concat(F.concat_ws(",", "event_id", "user_id"), tail.otherwise(F.concat(F.lit(","), "event_type")))
    # one column, whose name is the header line of every part file
    events.select(line.alias("event,user,type")).write.options(header=True, sep="\u0001").csv(path)
    return path


def irregular_rows(spark, sf):
    return readers.count_irregular(spark, _raw_events(spark, sf), IRREGULAR_HEADER)


def scan_irregular(spark, sf):
    """A field that a short row lacks is empty text; one too many is left out."""
    return readers.read_named(spark, _raw_events(spark, sf), IRREGULAR_HEADER)


def _taken_in(spark, sf) -> list[intake.Received]:
    """Raw lines by position and raw events by name, each taken in by one pass."""
    lines = scratch_path(spark, "raw-lines")
    _raw_lines(spark, sf).write.text(lines)
    files = [
        intake.RawFile("raw_lines", "raw_lines", lines, tuple(RAW_LAYOUT), 11),
        intake.RawFile("raw_events", "raw_events", _raw_events(spark, sf), tuple(IRREGULAR_HEADER)),
    ]
    return intake.receive_all(spark, files, scratch_path(spark, "received"))


def rejected_lines(spark, sf):
    """Whole lines with a wrong number of fields, kept by the pass that writes the good ones."""
    return _taken_in(spark, sf)[0].rejects(spark).drop("part")


def approved_lines(spark, sf):
    return _taken_in(spark, sf)[0].approved(spark)


def intake_audit(spark, sf):
    """Counts observed on the writes of both files."""
    return intake.audit(spark, _taken_in(spark, sf), "first", {}).select("table_name", "rows", "rejected_rows", "irregular_rows", "status")


def _bronze(spark, sf, tables=tuple(contracts.CONTRACTS)) -> dict[str, DataFrame]:
    return {table: adapter.bronze(spark, sf, table) for table in tables}


def staged_bronze(spark, sf) -> dict[str, DataFrame]:
    """All landed tables, written to the shared scratch folder, for queries that read them in many places."""
    return build.write_tables(spark, _bronze(spark, sf), scratch_path(spark, "bronze"), compression="zstd")


def land(spark, sf, tables=tuple(contracts.CONTRACTS), bronze=None) -> str:
    """Write the extracts as gzip CSV into a new folder and return it."""
    folder, bronze = scratch_path(spark, "landing"), bronze or _bronze(spark, sf, tables)
    with ThreadPoolExecutor(len(tables)) as pool:
        list(pool.map(lambda name: writers.export(bronze[name], f"{folder}/{name}.csv.gz", fmt="csv.gz"), tables))
    return folder


def write_manifest(spark, sf, folder, tables=tuple(contracts.CONTRACTS), landed: bool = True, bronze=None) -> str:
    """The manifest of extracts, from the tables they were written from; with their checksums if they are landed."""
    extracts = {name: (bronze or _bronze(spark, sf, tables))[name] for name in tables}
    checksums = readers.file_checksums(spark, f"{folder}/*.csv.gz") if landed else None
    manifest = writers.build_manifest(extracts, contracts.SOURCE_IDS, checksums)
    path = f"{folder}/manifest.json"
    writers.write_manifest(manifest, path, project="casefile", created_at_utc="2026-01-01T00:00:00Z")
    return path


def _described(manifest: DataFrame) -> DataFrame:
    return manifest.select(
        "table_name",
        "source_id",
        "output_file",
        "rows",
        F.array_join("columns", ",").alias("column_list"),
        "malformed_rows",
    )


def build_manifest(spark, sf):
    raw = scratch_path(spark, "raw-lines")
    _raw_lines(spark, sf).write.text(raw)
    good, malformed = readers.read_positional(spark, raw, RAW_LAYOUT, 11)
    extracts = {name: adapter.bronze(spark, sf, name) for name in contracts.CONTRACTS}
    return _described(
        writers.build_manifest({**extracts, "raw_lines": good}, contracts.SOURCE_IDS, malformed={"raw_lines": malformed})
    )


def manifest_explode(spark, sf):
    """Nested manifest document, one row per extract, stamped with the batch and stored."""
    path = write_manifest(spark, sf, scratch_path(spark, "landing"), landed=False)
    stored = scratch_path(spark, "manifest-table")
    writers.replace(readers.read_manifest(spark, path).withColumn("_batch_id", F.lit(adapter.BATCH)), stored)
    table = spark.read.parquet(stored)
    return _described(table).join(table.select("table_name", "_batch_id"), "table_name")


def manifest_missing(spark, sf):
    """Landed tables the manifest does not list, with their rows."""
    listed = [t for t in contracts.CONTRACTS if t not in ("recalls", "state_registrations")]
    path = write_manifest(spark, sf, scratch_path(spark, "landing"), listed, landed=False)
    missing = quality.missing_tables(readers.read_manifest(spark, path), list(contracts.CONTRACTS))
    landed = {t: adapter.bronze(spark, sf, t) for t in contracts.CONTRACTS}
    observed = quality.observe(spark, landed, {t: df.columns for t, df in landed.items()})
    return missing.join(observed.select("table_name", "actual_rows"), "table_name", "left")


def landed(spark, sf, bronze=None) -> tuple[DataFrame, DataFrame]:
    """Land all extracts; return their manifest and what is observed of them."""
    folder = land(spark, sf, bronze=bronze)
    manifest = readers.read_manifest(spark, write_manifest(spark, sf, folder, bronze=bronze))
    headers = {t: readers.header_columns(spark, f"{folder}/{t}.csv.gz") for t in contracts.CONTRACTS}
    extracts = {t: readers.read_extract(spark, f"{folder}/{t}.csv.gz", headers[t]) for t in contracts.CONTRACTS}
    return manifest, quality.observe(spark, extracts, headers)


def _spoiled(manifest: DataFrame) -> DataFrame:
    """A manifest with one wrong row count and one wrong column order."""
    table = F.col("table_name")
    return manifest.withColumns(
        {
            "rows": F.when(table == "recalls", F.col("rows") + 1).otherwise(F.col("rows")),
            "columns": F.when(table == "investigations", F.reverse("columns")).otherwise(F.col("columns")),
        }
    )


def _audit(observed: DataFrame, manifest: DataFrame, batch: str) -> DataFrame:
    return quality.check_contract(observed, manifest, batch, F.to_timestamp(F.lit(batch), "yyyyMMdd'T'HHmmss'Z'"))


AUDIT_SHOWN = (
    "batch_id table_name source_id source_file expected_rows actual_rows schema_matches row_count_matches status"
).split()


def bronze_contract(spark, sf):
    manifest, observed = landed(spark, sf)
    return _audit(observed, _spoiled(manifest), adapter.BATCH).select(*AUDIT_SHOWN)


def _audit_history(spark, sf, bronze=None) -> DataFrame:
    """Two appended batches: the first fails its contract, the second passes."""
    path = scratch_path(spark, "audit")
    manifest, observed = landed(spark, sf, bronze)
    writers.append(_audit(observed, _spoiled(manifest), "20251201T000000Z"), path)
    writers.append(_audit(observed, manifest, adapter.BATCH), path)
    return spark.read.parquet(path)


def ingest_audit(spark, sf):
    return _audit_history(spark, sf).select(*AUDIT_SHOWN)


def audit_latest_batch(spark, sf):
    """Newest audit row per table with its time and whether the extract's checksum is kept."""
    return quality.latest_batch(_audit_history(spark, sf)).select(
        *AUDIT_SHOWN, "batches", (F.length("extract_sha256") == 64).alias("has_extract_checksum"),
        quality.batch_id(F.col("ingested_at")).alias("ingested_batch"),
    )


def verify_checksums(spark, sf):
    """Landed extracts against their manifest after one of them was written anew with fewer rows."""
    folder = land(spark, sf)
    write_manifest(spark, sf, folder)
    less = adapter.registrations(spark, sf).filter("state NOT LIKE '%a%'")
    writers.export(less, f"{folder}/state_registrations.csv.gz", fmt="csv.gz")
    return build.verify_files(spark, folder).select("table_name", "checksum_matches")


def bronze_lineage(spark, sf):
    """Landed recalls with their provenance; the checksums come from the landed files."""
    folder = land(spark, sf, ["recalls"])
    checksums = writers.extract_checksums(readers.file_checksums(spark, f"{folder}/recalls.csv.gz"))
    landed = readers.read_extract(spark, f"{folder}/recalls.csv.gz", contracts.CONTRACTS["recalls"])
    digest = checksums.first()["output_sha256"]  # one row: one extract
    stamped = quality.with_lineage(
        landed,
        contracts.SOURCE_IDS["recalls"],
        "recalls.csv.gz",
        None,
        digest,
        adapter.BATCH,
        F.to_timestamp(F.lit(adapter.BATCH), "yyyyMMdd'T'HHmmss'Z'"),
    )
    return stamped.select(
        "recall_record_id",
        "_source_id",
        "_source_file",
        (F.length("_extract_sha256") == 64).alias("has_checksum"),
        "_batch_id",
        quality.batch_id(F.col("_ingested_at")).alias("_ingested_batch"),
    )


def file_checksums(spark, sf):
    """Checksum and size of every given file."""
    return readers.file_checksums(spark, sf).select("file_name", "sha256", "bytes")


def snapshot_replace(spark, sf):
    """A table written with one schema, then replaced by another."""
    path = scratch_path(spark, "snapshot")
    writers.replace(adapter.recalls(spark, sf), path)
    writers.replace(fact(spark, sf, "recall"), path)
    return spark.read.parquet(path)


def export_evidence_summary(spark, sf):
    path = scratch_path(spark, "evidence_summary.parquet")
    writers.export(the_mart(spark, sf), path, reports.EVIDENCE_SUMMARY_COLUMNS)
    return spark.read.parquet(path)


def export_alias_queue(spark, sf):
    path = scratch_path(spark, "alias_work_queue.parquet")
    writers.export(rules.alias_work_queue(the_mart(spark, sf)), path, reports.ALIAS_EXPORT_COLUMNS)
    return spark.read.parquet(path)


def export_data_trust(spark, sf):
    path = scratch_path(spark, "data_trust.parquet")
    manifest, observed = landed(spark, sf)
    audit = _audit(observed, manifest, adapter.BATCH)
    writers.export(reports.data_trust(audit, identity.match_quality(the_bridge(spark, sf))), path)
    return spark.read.parquet(path)


def export_csv_gz(spark, sf):
    path = scratch_path(spark, "baseline.csv.gz")
    ordered = evidence_baseline(spark, sf)
    chosen = ["vehicle_key", "make", "model", "model_year", *mart.COUNT_COLUMNS, "review_priority", "review_reason"]
    writers.export(ordered, path, chosen, fmt="csv.gz")
    return readers.read_extract(spark, path, chosen)


# --- expressions ----------------------------------------------------------------------------


def normalize_text(spark, sf):
    return adapter.table(spark, sf, "documents").select("doc_id", fx.normalize_text("text").alias("normalized"))


def normalize_fold(spark, sf):
    return adapter.table(spark, sf, "documents").select(
        "doc_id", fx.normalize_text("text", fold_accents=True).alias("normalized")
    )


def entity_key(spark, sf):
    rows = adapter.recalls(spark, sf).select("recall_record_id", "source_make", "source_model", "model_year")
    return fx.with_entity_key(rows, "source_make", "source_model", "model_year")


def record_key(spark, sf):
    status = F.when(F.col("o_orderstatus") == "P", None).otherwise(F.col("o_orderstatus"))
    priority = F.when(F.col("o_orderpriority") == "5-LOW", None).otherwise(F.col("o_orderpriority"))
    return adapter.table(spark, sf, "orders").select(
        "o_orderkey", fx.record_key(status, F.col("o_custkey"), priority).alias("record_key")
    )


def variant_key(spark, sf):
    return silver(spark, sf, "ratings").select(
        "vehicle_key", "body_style", "vehicle_type", "drive_train", "num_of_seating", "ncap_variant_key"
    )


def parse_dates(spark, sf):
    landed = adapter.complaints(spark, sf)
    parsed = landed.select(
        "incident_date",
        fx.yyyymmdd("incident_date").alias("incident_date_parsed"),
        fx.yyyymmdd("complaint_received_date").alias("received_date"),
    )
    return parsed.groupBy("incident_date", "incident_date_parsed").agg(
        F.count("*").alias("rows"),
        F.count_if((F.trim("incident_date") != "") & F.col("incident_date_parsed").isNull()).alias("rejected"),
        F.min("received_date").alias("first_received"),
    )


def profile_dates(spark, sf):
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    day = fx.first8_date(text)
    return adapter.table(spark, sf, "events").groupBy("event_type").agg(
        F.count(day).alias("dated"), F.min(day).alias("min_date"), F.max(day).alias("max_date")
    )


def parse_flags(spark, sf):
    return adapter.complaints(spark, sf).select(
        "complaint_record_id",
        fx.flag("crash_flag").alias("crash"),
        fx.flag("fire_flag").alias("fire"),
        fx.flag("medical_attention_flag").alias("medical"),
        fx.flag("vehicle_towed_flag").alias("towed"),
        fx.flag("police_report_flag").alias("police"),
    )


def safe_casts(spark, sf):
    return adapter.complaints(spark, sf).select(
        "complaint_record_id",
        fx.safe_int("injury_count", 0).alias("injury_count_int"),
        fx.safe_int("model_year").alias("model_year_int"),
        fx.safe_long("mileage_at_failure").alias("mileage_int"),
        fx.safe_double("mileage_at_failure").alias("mileage_decimal"),
        fx.safe_double("injury_count").alias("injury_decimal"),
    )


def bulk_casts(spark, sf):
    types = {**dict.fromkeys(FUEL_INTEGERS, "int"), **dict.fromkeys(FUEL_DECIMALS, "double")}
    typed = fx.cast_columns(adapter.variants(spark, sf), types)
    return typed.select(*[c for c in typed.columns if c.endswith(("_int", "_decimal"))])


def severity_flag(spark, sf):
    rows = adapter.complaints(spark, sf).withColumns(
        {
            "crash": fx.flag("crash_flag"),
            "fire": fx.flag("fire_flag"),
            "injuries": fx.safe_int("injury_count", 0),
            "deaths": fx.safe_int("death_count", 0),
        }
    )
    return rows.select(
        "complaint_record_id", fx.severity("crash", "fire", "injuries", "deaths").alias("severe_report_flag")
    )


def topic_classify(spark, sf):
    """Whole documents and the source name under the default rules."""
    return fx.with_topic(adapter.table(spark, sf, "documents"), ["source", "text"]).select("doc_id", "evidence_topic")


def severe_share(spark, sf):
    return the_mart(spark, sf).select(
        "vehicle_key", "complaint_reports", "severe_complaint_reports", "severe_complaint_share"
    )


def evidence_source_count(spark, sf):
    return the_mart(spark, sf).select("vehicle_key", "evidence_source_count", "source_system_count")


def queue_ranked(spark, sf):
    return reports.queue_ranked(the_mart(spark, sf))


def privacy_projection(spark, sf):
    return quality.project_allowed(
        adapter.table(spark, sf, "customer"),
        ["c_custkey", "c_nationkey", "c_mktsegment"],
        [*contracts.FORBIDDEN_COLUMNS, "c_name", "c_acctbal"],
    )


# --- dedup ----------------------------------------------------------------------------------


def dedup_by_key(spark, sf):
    order = "l_shipdate l_partkey l_suppkey l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus"
    return dedup.dedup_by_key(
        adapter.table(spark, sf, "lineitem"),
        ["l_orderkey", "l_linenumber"],
        [F.col(c).asc_nulls_first() for c in order.split()],
        digest_of=[],
    )


def dedup_rows(spark, sf):
    return dedup.dedup_rows(adapter.table(spark, sf, "documents").select("lang", "source", "text"))


def dup_keys(spark, sf):
    return dedup.duplicate_keys(adapter.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def profile_dups(spark, sf):
    return dedup.distinct_row_count(adapter.table(spark, sf, "documents").select("lang", "source", "text"))


# --- entity resolution ----------------------------------------------------------------------


def reference_keys(spark, sf):
    sources = baseline.by_system(silvers(spark, sf), SETTINGS)
    return identity.reference_keys(sources, settings=SETTINGS)


def alias_review_queue(spark, sf):
    sources = baseline.by_system(silvers(spark, sf), SETTINGS)
    masks = identity.entity_sources(sources, SETTINGS)
    queue = identity.alias_review_queue(masks, list(sources), settings=SETTINGS)
    return queue.withColumn("source_systems", F.array_join("source_systems", ","))


def match_quality(spark, sf):
    return identity.match_quality(the_bridge(spark, sf)).orderBy("source_system")


def match_rates(spark, sf):
    return identity.match_quality(the_bridge(spark, sf), by=[])


def _decisions(bridge: DataFrame) -> DataFrame:
    """Review decisions: an unresolved entity is the matched one of the same make and model a year later.

    Each was pending first; every third model year was then rejected, the others approved.
    """
    described = ["normalized_make", "normalized_model", "model_year_int"]
    entities = bridge.select("vehicle_key", *described, "reference_exact_match_flag").distinct()
    target = entities.filter("reference_exact_match_flag").selectExpr(
        "vehicle_key AS canonical_vehicle_key", *described[:2], "model_year_int - 1 AS model_year_int"
    )
    pairs = entities.filter("NOT reference_exact_match_flag").join(target, described)
    final = "if(model_year_int % 3 = 0, 'REJECTED', 'APPROVED')"
    return pairs.selectExpr(
        "vehicle_key",
        "canonical_vehicle_key",
        f"explode(array(struct('PENDING' AS status, 1 AS day), struct({final} AS status, 2 AS day))) AS d",
    ).selectExpr(
        "vehicle_key", "canonical_vehicle_key", "d.status AS status", "'reviewer' AS reviewer",
        "timestamp(make_date(2026, 1, d.day)) AS reviewed_at", "'same vehicle, next year' AS rationale",
        "'HIGH' AS confidence",
    )


def alias_what_if(spark, sf):
    """Before and after approved aliases, over the records of all sources."""
    sources = Model(spark, sf, needed=dict.fromkeys(IDENTITY_SOURCES, list(IDENTITY_COLUMNS))).silvers()
    stored, mapping = scratch_path(spark, "bridge"), scratch_path(spark, "alias-mapping")
    writers.replace(identity.identity_bridge(baseline.by_system(sources, SETTINGS), settings=SETTINGS), stored)
    bridge = spark.read.parquet(stored)
    writers.replace(_decisions(bridge), mapping)
    records = [df.select("vehicle_key") for df in sources.values()]
    return identity.alias_what_if(bridge, spark.read.parquet(mapping), records)


def _chained_decisions(bridge: DataFrame) -> DataFrame:
    """An entity is the one of the same make and model a year later; every fifth was rejected again a week later."""
    entities = bridge.select("vehicle_key", "normalized_make", "normalized_model", "model_year_int").distinct()
    next_year = entities.selectExpr("vehicle_key AS canonical_vehicle_key", "normalized_make", "normalized_model", "model_year_int - 1 AS model_year_int")
    pairs = entities.join(next_year, ["normalized_make", "normalized_model", "model_year_int"])
    first = "struct('APPROVED' AS status, 1 + model_year_int % 4 AS day)"
    steps = f"if(model_year_int % 5 = 0, array({first}, struct('REJECTED' AS status, 8 AS day)), array({first}))"
    return pairs.selectExpr("vehicle_key", "canonical_vehicle_key", f"explode({steps}) AS d").selectExpr(
        "vehicle_key", "canonical_vehicle_key", "d.status AS status", "'reviewer' AS reviewer",
        "timestamp(make_date(2026, 1, d.day)) AS reviewed_at", "'same vehicle, next year' AS rationale", "'HIGH' AS confidence",
    )


ALIAS_BATCHES = ("20260103T120000Z", "20260109T000000Z")


def bridge_as_of(spark, sf):
    """The bridge of an older and of a newer batch, each with the canonical keys of its time, chains closed."""
    bridge = the_bridge(spark, sf)
    stored, mapping = scratch_path(spark, "bridge"), scratch_path(spark, "alias-mapping")
    writers.replace(bridge, stored)
    bridge = spark.read.parquet(stored)
    writers.replace(_chained_decisions(bridge), mapping)
    decisions = spark.read.parquet(mapping)
    parts = [
        identity.apply_alias(bridge, decisions, moment=build.batch_moment(batch)).select(F.lit(batch).alias("batch_id"), *bridge.columns)
        for batch in ALIAS_BATCHES
    ]
    return parts[0].unionByName(parts[1])


def alias_decisions_as_of(spark, sf):
    """Decisions in force at each batch."""
    decisions = _chained_decisions(the_bridge(spark, sf))
    rows = identity.decisions_at(decisions, {batch: build.batch_moment(batch) for batch in ALIAS_BATCHES})
    return rows.groupBy("batch_id", "status").agg(F.count("*").alias("decisions"))


# --- star schema ----------------------------------------------------------------------------


def dim_topic(spark, sf):
    """Topics with the complaint records each one classifies; a topic nothing matched stays with 0."""
    model = Model(spark, sf)
    used = model["complaint"].groupBy(F.col("evidence_topic").alias("topic_key")).agg(F.count("*").alias("records"))
    return model["topic"].join(used, "topic_key", "left").fillna({"records": 0})


def orphan_keys(spark, sf):
    """Fact keys the reference-only dimension does not have."""
    only_reference = silvers(spark, sf, ["ratings", "variants"])
    labelled = {SETTINGS.source_systems[n]: df for n, df in only_reference.items()}
    dim = star.dim_entity(identity.identity_bridge(labelled, settings=SETTINGS))
    return star.orphan_keys(dim, {FACT_TABLES[n]: fact(spark, sf, n) for n in FACT_TABLES})


# --- aggregates and mart --------------------------------------------------------------------


def complaint_event(spark, sf):
    keyed = silver(spark, sf, "complaints").filter("vehicle_key IS NOT NULL")
    return mart.event_rows(keyed, ["vehicle_key"], mart.BY_SOURCE["complaints"])


def approx_median(spark, sf):
    return mart.median_by(
        silver(spark, sf, "variants").filter(F.col("vehicle_key").isNotNull()),
        ["vehicle_key"],
        {"median_combined_mpg": "comb08_int", "median_annual_fuel_cost": "fuelCost08_int"},
        approx=True,
    )


def business_totals(spark, sf):
    return quality.business_totals(the_mart(spark, sf))


def _labels(spark, sf, *names):
    return the_mart(spark, sf).select("vehicle_key", *names)


# --- quality --------------------------------------------------------------------------------


def dq_checks(spark, sf, model=None):
    model = model or Model(spark, sf, needed=mart_columns())
    facts = {FACT_TABLES[n]: model[n] for n in FACT_TABLES}
    return quality.dq_checks(model["entity"], facts, model["alias_queue"])


def dq_checks_failing(spark, sf, model=None):
    """A dimension with some rows twice and without the unresolved entities, and a queue that kept P2."""
    model = model or Model(spark, sf, needed=mart_columns())
    matched = model["entity"].filter("reference_exact_match_flag")
    twice = matched.unionByName(matched.filter("model_year % 2 = 0"))
    facts = {FACT_TABLES[n]: model[n] for n in FACT_TABLES}
    return quality.dq_checks(twice, facts, model["mart"].filter("alias_priority <> 'NONE'"))


def dq_status(spark, sf):
    """Status under a dimension that lacks the unresolved entities."""
    model = Model(spark, sf, needed=mart_columns())
    matched = model["entity"].filter("reference_exact_match_flag")
    facts = {FACT_TABLES[n]: model[n] for n in FACT_TABLES}
    return quality.dq_status(quality.dq_checks(matched, facts, model["alias_queue"]))


def dq_semantic(spark, sf):
    """On one written set of silver tables, which mart, facts and calendar all read."""
    model = Model(spark, sf, needed=mart_columns(star.DATED_COLUMNS))
    keys = {
        "incident_date_key": model["complaint"],
        "received_date_key": model["complaint"],
        "report_received_date_key": model["recall"],
        "opened_date_key": model["investigation"],
        "closed_date_key": model["investigation"],
        "communication_date_key": model["communication"],
    }
    counted = {
        "complaint_reports": (model["complaint"], "complaint_id"),
        "recall_campaigns": (model["recall"], "campaign_number"),
    }
    return quality.dq_semantic(model["mart"], counted, model["calendar"], keys)


def reconcile(spark, sf):
    return quality.reconcile(
        quality.mart_metrics(the_mart(spark, sf)),
        quality.mart_metrics(baseline.baseline_mart(_bronze(spark, sf), SETTINGS)),
    )


def reconcile_rows(spark, sf):
    """Where a mart differs from one with the complaint counts of two entities exchanged: the totals agree, the rows are named."""
    good = scratch_path(spark, "mart")
    writers.replace(the_mart(spark, sf), good)
    good = spark.read.parquet(good)
    count = F.struct("complaint_reports", "vehicle_key")
    most, least = good.agg(F.max(count), F.min(count)).first()  # one row
    exchanged = F.when(F.col("vehicle_key") == most["vehicle_key"], least["complaint_reports"])
    exchanged = exchanged.when(F.col("vehicle_key") == least["vehicle_key"], most["complaint_reports"]).otherwise(F.col("complaint_reports"))
    return fingerprints.differences(good.withColumn("complaint_reports", exchanged), good, "vehicle_key")


def reconcile_routes(spark, sf):
    """Entities per bucket of a tree, from the mart and from the baseline: how many buckets agree."""
    trees = []
    for frame in (the_mart(spark, sf), baseline.baseline_mart(_bronze(spark, sf), SETTINGS)):
        stored = scratch_path(spark, "mart")
        writers.replace(frame, stored)
        trees.append(spark.read.parquet(stored))
    wrong = fingerprints.differences(*trees, "vehicle_key").agg(F.count("*").alias("differing_values"))
    return trees[0].agg(F.count("*").alias("entities")).unionByName(wrong, allowMissingColumns=True).agg(
        F.max("entities").alias("entities"), F.max("differing_values").alias("differing_values")
    )


def reconcile_failing(spark, sf, model=None):
    """A mart without its critical entities against the baseline: what differs, and labels that are missing."""
    made, bronze = (model["mart"], model.bronze) if model else (the_mart(spark, sf), _bronze(spark, sf))
    short = made.filter("review_priority <> 'CRITICAL'")
    return quality.reconcile(quality.mart_metrics(short), quality.mart_metrics(baseline.baseline_mart(bronze, SETTINGS)))


def gates(spark, sf):
    """What the gates of a build would do: with a sound batch, a spoiled one, spoiled tables, and a mart that lacks entities.

    As in a build, all of them are about one set of tables: landed, conformed and made into a mart once.
    """
    bronze = staged_bronze(spark, sf)
    history = _audit_history(spark, sf, bronze)
    model = Model(spark, sf, needed=mart_columns(), bronze=bronze).keep("entity", "mart")
    made = {"spoiled": dq_checks_failing(spark, sf, model), "checks": dq_checks(spark, sf, model), "short": reconcile_failing(spark, sf, model)}
    rows, folder = {}, scratch_path(spark, "checks")
    for name, checks in made.items():  # a row per check, written as in a build; one after the other, as their shuffles are large
        rows |= build.write_tables(spark, {name: checks}, folder)
    contract, failed = (F.col("status") != "PASS", "table_name"), ~F.col("passed")
    return quality.gate_outcomes(
        {
            "contract, spoiled manifest": (history.where("batch_id = '20251201T000000Z'"), *contract),
            "contract": (history.where("batch_id = '20260101T000000Z'"), *contract),
            "checks, spoiled tables": (rows["spoiled"], failed, "check_name"),
            "checks": (rows["checks"], failed, "check_name"),
            "reconciliation, short mart": (rows["short"], failed, "metric"),
        }
    )


def product_row_counts(spark, sf):
    return quality.product_row_counts({n: adapter.bronze(spark, sf, n) for n in ("complaints", "recalls")})


# --- profiles -------------------------------------------------------------------------------

# Which column is a source's record id and which its date.
PROFILE_SPECS = {
    "complaints": profiling.ProfileSpec(
        "nhtsa_complaints_2025_2026", "complaint_record_id", "complaint_received_date", "source_make", "source_model",
        "model_year", "product_type",
    ),
    "recalls": profiling.ProfileSpec(
        "nhtsa_recalls_post_2010", "recall_record_id", "report_received_date", "source_make", "source_model",
        "model_year", "product_type",
    ),
    "investigations": profiling.ProfileSpec(
        "nhtsa_investigations_all", "investigation_number", "opened_date", "source_make", "source_model", "model_year"
    ),
    "manufacturer_communications": profiling.ProfileSpec(
        "nhtsa_tsbs_2025_2026", "nhtsa_communication_id", "date_added", "source_make", "source_model", "model_year",
    ),
    # the approved extract has no test number, which is the id of the raw file
    "ncap_ratings": profiling.ProfileSpec("nhtsa_ncap_ratings", None, None, "make", "model", "model_yr"),
    "fuel_economy": profiling.ProfileSpec("epa_fuel_economy_vehicles", "id", None, "make", "model", "year"),
    "state_registrations": profiling.ProfileSpec("fhwa_state_registrations", "state", year="year"),
}
OPERATIONAL = ("complaints", "recalls", "investigations", "manufacturer_communications")
REFERENCE = ("ncap_ratings", "fuel_economy")


def profile_source(spark, sf):
    return profiling.profile_all({n: (adapter.bronze(spark, sf, n), s) for n, s in PROFILE_SPECS.items()})


def profile_summary(spark, sf):
    return profiling.profile_summary(profile_source(spark, sf))


def profile_reconcile(spark, sf):
    path = write_manifest(spark, sf, scratch_path(spark, "landing"), landed=False)
    return profiling.profile_reconcile(profile_source(spark, sf), readers.read_manifest(spark, path))


def profile_reconcile_failing(spark, sf):
    """Profiles against a manifest with one wrong row count."""
    path = write_manifest(spark, sf, scratch_path(spark, "landing"), landed=False)
    return profiling.profile_reconcile(profile_source(spark, sf), _spoiled(readers.read_manifest(spark, path)))


#: Sources that arrive in batches.
GROWING = ("complaints", "investigations")


def _grown(spark, sf, name: str, exact) -> str:
    """A store with the states of three batches of a source, dealt by their first column."""
    store, landed = scratch_path(spark, "profile-states"), adapter.bronze(spark, sf, name)
    rows = scratch_path(spark, "landed")
    writers.replace(landed.withColumn("_batch", F.pmod(F.crc32(F.col(landed.columns[0])), F.lit(3))), rows, "_batch")
    for batch in range(3):
        own = spark.read.parquet(rows).where(F.col("_batch") == batch).drop("_batch")
        profile_states.add_batch(own, PROFILE_SPECS[name], store, str(batch), exact=exact)
    return store


def profile_batches(spark, sf):
    """Profiles of two sources merged from the stored states of three batches each, with exact distinct counts."""
    exact = tuple(profile_states.KINDS)
    return reduce(
        DataFrame.unionByName,
        [profile_states.profile_of(spark, PROFILE_SPECS[n], _grown(spark, sf, n, exact), exact=exact) for n in GROWING],
    )


def profile_sketched(spark, sf):
    """The same from sketches: the counts that add up, and whether the distinct ones are within the stated error."""
    found = []
    for name in GROWING:
        spec, store = PROFILE_SPECS[name], _grown(spark, sf, name, ())
        sketched = profile_states.profile_of(spark, spec, store)
        exact = profiling.profile(adapter.bronze(spark, sf, name), spec)
        compared = {"distinct_business_ids": "distinct_business_ids", "exact_duplicate_rows": "rows"}
        compared["distinct_normalized_vehicle_keys"] = "distinct_normalized_vehicle_keys"
        names = list(dict.fromkeys([*compared, *compared.values()]))
        both = sketched.unionByName(exact.select("source_id", *[F.col(c).alias(f"{c}:exact") for c in names]), allowMissingColumns=True)
        row = both.groupBy("source_id").agg(*[F.max(f"`{c}`").alias(c) for c in both.columns if c != "source_id"])
        within = [
            (F.abs(F.col(c) - F.col(f"`{c}:exact`")) <= F.greatest(F.lit(1.0), F.col(f"`{base}:exact`") * profile_states.hll_error())).alias(f"{c}_within")
            for c, base in compared.items()
        ]
        found.append(row.select("source_id", "rows", "vehicle_rows", "min_source_date", "max_source_date", *within))
    return reduce(DataFrame.unionByName, found)


def _profile_keys(spark, sf, names):
    return {
        PROFILE_SPECS[n].source_id: profiling.profile_keys(adapter.bronze(spark, sf, n), PROFILE_SPECS[n])
        for n in names
    }


def profile_match_coverage(spark, sf):
    return profiling.coverage(_profile_keys(spark, sf, OPERATIONAL), _profile_keys(spark, sf, REFERENCE))


def profile_union_coverage(spark, sf):
    return profiling.union_coverage(_profile_keys(spark, sf, OPERATIONAL), _profile_keys(spark, sf, REFERENCE))


# --- measures -------------------------------------------------------------------------------


def _both_grains(spark, sf, names, by="make"):
    """The measures without grouping, under the label (all), and per value of one column."""
    model = Model(spark, sf)
    grouped = measures.measures(names, model, by=[by]).withColumn(by, F.col(by).cast("string"))
    overall = measures.measures(names, model).withColumn(by, F.lit("(all)"))
    return grouped.unionByName(overall)


MEASURE_GROUPS = {
    "measures_complaints": (
        "complaint_reports severe_complaint_reports severe_complaint_share crash_reported_complaints "
        "fire_reported_complaints"
    ).split(),
    "measures_recalls": "recall_campaigns do_not_drive_campaigns park_outside_campaigns".split(),
    "potential_units": ["potential_units_affected"],
    "measures_investigations": "investigations open_investigations".split(),
    "measures_documents": ["manufacturer_documents"],
    "measures_context": (
        "tested_ncap_variants median_overall_stars epa_vehicle_variants median_combined_mpg median_annual_fuel_cost"
    ).split(),
    "measures_entities": (
        "vehicle_keys critical_review_vehicles high_review_vehicles review_queue_vehicles "
        "reference_exact_match_keys reference_exact_match_rate era_eligible_exact_match_rate"
    ).split(),
    "measures_alias": "alias_work_queue_p0 alias_work_queue_p1 alias_backlog_p2".split(),
    "measures_governance": "rule_version threshold_validation_status average_evidence_sources".split(),
}


def measures_filtered(spark, sf):
    """Measures per make under a filter on facts and one on entities; tables without the columns stay unfiltered."""
    names = ["complaint_reports", "severe_complaint_reports", "recall_campaigns", "registration_records"]
    where = "incident_state LIKE 'S1%'"
    return measures.measures(names, Model(spark, sf), by=["make"], where=where, where_entity="model_year >= 2000")


SETS = [["make", "model"], ["make"], []]


def measures_sets(spark, sf):
    """Distinct, weighted, counted, averaged and median measures by make and model, by make and in all, in one pass."""
    names = [
        "complaint_reports", "severe_complaint_share", "recall_campaigns", "potential_units_affected", "median_combined_mpg",
        "average_evidence_sources", "registration_records",
    ]
    read = {"complaints": ["severe_report_flag"], "recalls": ["potential_units_affected_int"]}
    needed = mart_columns(read, maxima=False)  # of the mart its number of sources is averaged
    needed["registrations"] = ["state_name"]  # its records are counted
    return measures.measures(names, Model(spark, sf, needed=needed, described=("make", "model")), by=SETS)


def measures_frequent(spark, sf):
    """The complaint measures per make, entities with a large share of the complaints joined apart."""
    return measures.measures(MEASURE_GROUPS["measures_complaints"], Model(spark, sf), by=["make"], frequent={})


MEDIANS = quantile_states.QuantileState({"median_combined_mpg": "combined_mpg", "median_annual_fuel_cost": "annual_fuel_cost"})
MEDIAN_CONTEXTS = [["make", "model_year"], ["make"], []]


def median_rollup(spark, sf):
    """Medians by three contexts from stored sketches of two batches: rows of even and of odd years.

    A sketch of at most k values is exact, and its median is shown; of every other it is checked against the
    values that its rank is within the stated error.
    """
    model = Model(spark, sf)
    attributes = model["entity"].select("vehicle_key", "make", "model_year")
    fuel = model["fuel"].select("vehicle_key", *MEDIANS.columns.values()).join(attributes, "vehicle_key", "left")
    rows, grain, parts = scratch_path(spark, "fuel"), ["make", "model_year"], []
    writers.replace(fuel.drop("vehicle_key"), rows)
    rows = spark.read.parquet(rows)
    for batch in (0, 1):
        own = rows.where(F.coalesce(F.col("model_year"), F.lit(0)) % 2 == batch)
        stored = scratch_path(spark, "quantile-states")
        writers.replace(quantile_states.states(own, MEDIANS, grain), stored)
        parts.append(spark.read.parquet(stored))
    # written once: which value a sketch gives beyond k depends on the order in which sketches meet
    rolled = scratch_path(spark, "medians")
    merged = quantile_states.rolled_up(quantile_states.merged(parts, MEDIANS, grain), MEDIANS, MEDIAN_CONTEXTS)
    writers.replace(quantile_states.medians(merged, MEDIANS), rolled)
    checked = []
    for own in MEDIAN_CONTEXTS:
        number = sum(1 << i for i, c in enumerate(reversed(grain)) if c not in own)
        found = quantile_states.rank_errors(spark.read.parquet(rolled).where(F.col("grouping_id") == number), rows, MEDIANS, own)
        checked.append(found.withColumn("grouping_id", F.lit(number).cast("bigint")))
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), checked)
    return every.select(
        *grain,
        "grouping_id",
        "measure",
        "n",
        F.when(F.col("n") <= MEDIANS.k, F.col("median")).alias("median"),
        (F.col("error") <= quantile_states.rank_error(MEDIANS.k)).alias("within_error"),
    )


def measures_registrations(spark, sf):
    return _both_grains(spark, sf, ["registration_records", "registered_vehicles"], "state_name")


# --- registry -------------------------------------------------------------------------------


def _conform(name):
    return lambda spark, sf: silver(spark, sf, name)


def _fact(name):
    return lambda spark, sf: fact(spark, sf, name)


def _of_model(report, *tables):
    return lambda spark, sf: report(*[Model(spark, sf)[t] for t in tables])


def _whole_model(report):
    return lambda spark, sf: report(Model(spark, sf))


def _of_source(report, *sources):
    return lambda spark, sf: report(*[silver(spark, sf, source) for source in sources])


def _counts(source):
    return _of_source(lambda df: mart.entity_counts(df, source), source)


def _context(source):
    return _of_source(lambda df: mart.entity_context(df, source), source)


def star_monthly_topic(spark, sf):
    return reports.star_monthly_topic(Model(spark, sf), ("received_date_key", "incident_date_key"))


def evidence_baseline(spark, sf):
    return baseline.ordered_baseline(_bronze(spark, sf), SETTINGS)


# Silver name -> columns that the evidence of an entity shows besides those of the mart.
SHOWN = {
    "complaints": ["complaint_record_id", "received_date", "evidence_topic", "component_name"],
    "recalls": ["recall_record_id", "report_received_date_parsed", "evidence_topic", "consequence_summary", "corrective_action"],
    "investigations": ["investigation_record_key", "opened_date_parsed", "evidence_topic", "subject", "summary"],
    "communications": ["communication_record_key", "communication_date", "evidence_topic", "summary"],
    "ratings": ["body_style"],
    "variants": ["id_int", "VClass"],
}


def entity_drillthrough(spark, sf):
    """The key from the mart, then each fact under a condition on it, of sources whose needed columns are staged once."""
    model = Model(spark, sf, needed=mart_columns(SHOWN))
    return reports.entity_drillthrough(model, lookup.listed(reports.first_critical(model["mart"])))


def entity_lookup(spark, sf):
    """Evidence of the five critical entities with the smallest keys, from facts written for lookups.

    The columns of the mart stand beside the facts' own, so the mart is made from the written tables and the
    surviving records are chosen once.
    """
    gold, beside = scratch_path(spark, "gold"), mart_columns()
    for name, (table, record) in lookup.CLUSTERED.items():
        source = FACT_NAMES[name]
        rows = star.FACTS[source](silver(spark, sf, source, lineage=True), beside[source])
        lookup.write_clustered(rows, f"{gold}/{table}", record, made=made_keys(source, SETTINGS))
    facts = lookup.facts(spark, gold)
    entities = mart.evidence_mart({FACT_NAMES[name]: rows for name, rows in facts.items()}, SETTINGS)
    critical = entities.where("review_priority = 'CRITICAL'").select("vehicle_key").orderBy("vehicle_key").limit(5)
    return reports.entity_drillthrough(facts, lookup.listed(critical))


STATES = {
    "complaint": distinct_states.DistinctState("complaint_reports", "complaint_id", {"severe_complaint_reports": "severe_report_flag"}),
    "recall": distinct_states.DistinctState("recall_campaigns", "campaign_number", {"do_not_drive_campaigns": "do_not_drive"}),
}
STATE_CONTEXTS = [["year", "make"], ["year", "month"], ["evidence_topic"], ["make"], []]


def _distinct_state(spark, sf, name: str, date: str):
    """States of one fact at the grain topic, month, make, stored for two batches: records of even and of odd years."""
    state, model = STATES[name], Model(spark, sf)
    entity = model["entity"].select("vehicle_key", "make")
    dated = model[name].join(entity, "vehicle_key", "left").select(
        "*", F.expr(f"{date} DIV 10000").cast("int").alias("year"), F.expr(f"({date} DIV 100) % 100").cast("int").alias("month")
    )
    rows = scratch_path(spark, "dated")
    writers.replace(dated.select("evidence_topic", "year", "month", "make", state.id_col, *state.flags.values()), rows)
    rows, grain, numbers, parts = spark.read.parquet(rows), ["evidence_topic", "year", "month", "make"], None, []
    for batch in (0, 1):
        own = rows.where(F.coalesce(F.col("year"), F.lit(0)) % 2 == batch)
        numbers = distinct_states.number_ids(own, state.id_col, scratch_path(spark, "numbers"), numbers, F.expr("year * 100 + month"))
        stored = scratch_path(spark, "distinct-states")
        writers.replace(distinct_states.states(own, numbers, state, grain), stored)
        parts.append(spark.read.parquet(stored))
    return distinct_states.counts(distinct_states.merged(parts, state, grain), state, STATE_CONTEXTS)


def distinct_rollup_complaints(spark, sf):
    """Distinct complaints, and severe ones, by five contexts from stored states of two batches."""
    return _distinct_state(spark, sf, "complaint", "received_date_key")


def distinct_rollup_recalls(spark, sf):
    """Distinct campaigns, and urgent ones, by five contexts from stored states of two batches."""
    return _distinct_state(spark, sf, "recall", "report_received_date_key")


def entity_header(spark, sf):
    evidence = the_mart(spark, sf)
    return reports.entity_header(evidence, reports.first_critical(evidence))


QUERIES = {
    "scan_csv_contract": scan_csv_contract,
    "table_by_name": table_by_name,
    "irregular_rows": irregular_rows,
    "scan_irregular": scan_irregular,
    "rejected_lines": rejected_lines,
    "approved_lines": approved_lines,
    "intake_audit": intake_audit,
    "verify_checksums": verify_checksums,
    "scan_positional": scan_positional,
    "scan_named": scan_named,
    "manifest_explode": manifest_explode,
    "ingest_audit": ingest_audit,
    "snapshot_replace": snapshot_replace,
    "export_evidence_summary": export_evidence_summary,
    "export_alias_queue": export_alias_queue,
    "export_data_trust": export_data_trust,
    "export_csv_gz": export_csv_gz,
    "build_manifest": build_manifest,
    "dim_topic": dim_topic,
    "file_checksums": file_checksums,
    "privacy_projection": privacy_projection,
    "malformed_rows": malformed_rows,
    "conform_complaints": _conform("complaints"),
    "conform_recalls": _conform("recalls"),
    "conform_investigations": _conform("investigations"),
    "conform_communications": _conform("communications"),
    "conform_ratings": _conform("ratings"),
    "conform_variants": _conform("variants"),
    "conform_registrations": _conform("registrations"),
    "identity_bridge": the_bridge,
    "reference_keys": reference_keys,
    "alias_review_queue": alias_review_queue,
    "match_quality": match_quality,
    "match_rates": match_rates,
    "alias_what_if": alias_what_if,
    "entity_key": entity_key,
    "record_key": record_key,
    "variant_key": variant_key,
    "normalize_text": normalize_text,
    "normalize_fold": normalize_fold,
    "parse_dates": parse_dates,
    "profile_dates": profile_dates,
    "parse_flags": parse_flags,
    "safe_casts": safe_casts,
    "bulk_casts": bulk_casts,
    "severity_flag": severity_flag,
    "topic_classify": topic_classify,
    "bronze_lineage": bronze_lineage,
    "bronze_contract": bronze_contract,
    "manifest_missing": manifest_missing,
    "audit_latest_batch": audit_latest_batch,
    "dim_entity": the_dim,
    "dim_date": lambda spark, sf: Model(spark, sf)["calendar"],
    "fact_complaint": _fact("complaint"),
    "fact_recall": _fact("recall"),
    "fact_investigation": _fact("investigation"),
    "fact_communication": _fact("communication"),
    "fact_ncap": _fact("ncap"),
    "fact_fuel": _fact("fuel"),
    "fact_registration": _fact("registration"),
    "orphan_keys": orphan_keys,
    "complaint_event": complaint_event,
    "complaint_agg": _counts("complaints"),
    "recall_agg": _counts("recalls"),
    "investigation_agg": _counts("investigations"),
    "communication_agg": _counts("communications"),
    "ncap_agg": _context("ratings"),
    "fuel_agg": _context("variants"),
    "approx_median": approx_median,
    "evidence_mart": the_mart,
    "evidence_baseline": evidence_baseline,
    "severe_share": severe_share,
    "evidence_source_count": evidence_source_count,
    "review_priority": lambda spark, sf: _labels(spark, sf, "review_priority"),
    "review_reason": lambda spark, sf: _labels(spark, sf, "review_reason"),
    "alias_priority": lambda spark, sf: _labels(spark, sf, "alias_priority"),
    "alias_reason": lambda spark, sf: _labels(spark, sf, "alias_reason"),
    "review_queue": _of_model(lambda queue: queue, "review_queue"),
    "alias_work_queue": _of_model(lambda queue: queue, "alias_queue"),
    "queue_ranked": queue_ranked,
    "priority_counts": _of_model(reports.priority_counts, "mart"),
    "business_totals": business_totals,
    "dq_checks": dq_checks,
    "dq_checks_failing": dq_checks_failing,
    "dq_status": dq_status,
    "dq_semantic": dq_semantic,
    "reconcile": reconcile,
    "reconcile_failing": reconcile_failing,
    "gates": gates,
    "product_row_counts": product_row_counts,
    "dedup_by_key": dedup_by_key,
    "dedup_rows": dedup_rows,
    "dup_keys": dup_keys,
    "profile_dups": profile_dups,
    "profile_source": profile_source,
    "profile_summary": profile_summary,
    "profile_reconcile": profile_reconcile,
    "profile_reconcile_failing": profile_reconcile_failing,
    "profile_batches": profile_batches,
    "profile_sketched": profile_sketched,
    "profile_match_coverage": profile_match_coverage,
    "profile_union_coverage": profile_union_coverage,
    **{
        name: (lambda spark, sf, names=names: _both_grains(spark, sf, names))
        for name, names in MEASURE_GROUPS.items()
    },
    "measures_sets": measures_sets,
    "measures_filtered": measures_filtered,
    "measures_frequent": measures_frequent,
    "median_rollup": median_rollup,
    "measures_registrations": measures_registrations,
    "priority_by_reason": _of_model(reports.priority_by_reason, "mart"),
    "top20_queue": _of_model(reports.top_queue, "review_queue"),
    "scatter_severity": _of_model(reports.scatter_severity, "mart"),
    "entity_drillthrough": entity_drillthrough,
    "entity_lookup": entity_lookup,
    "reconcile_rows": reconcile_rows,
    "reconcile_routes": reconcile_routes,
    "bridge_as_of": bridge_as_of,
    "alias_decisions_as_of": alias_decisions_as_of,
    "distinct_rollup_complaints": distinct_rollup_complaints,
    "distinct_rollup_recalls": distinct_rollup_recalls,
    "entity_header": entity_header,
    "queue_unresolved_share": _of_model(reports.queue_unresolved_share, "mart"),
    "trend_by_family": _whole_model(reports.trend_by_family),
    "trend_without_gaps": _whole_model(reports.trend_without_gaps),
    "entity_matrix": _of_model(reports.entity_matrix, "mart"),
    "formal_timeline": _whole_model(reports.formal_timeline),
    "topic_make_matrix": _of_source(reports.topic_make_matrix, "recalls", "investigations"),
    "campaign_table": _of_model(reports.campaign_table, "recall"),
    "star_monthly_topic": star_monthly_topic,
    "topic_pareto": _of_model(reports.topic_pareto, "complaint"),
    "component_pareto": _of_model(reports.component_pareto, "complaint"),
    "matrix_min_reports": _of_source(reports.matrix_min_reports, "complaints"),
    "reports_by_state": _of_model(reports.reports_by_state, "complaint"),
    "communication_topics": _of_model(reports.communication_topics, "communication"),
    "topic_decomposition": _of_source(reports.topic_decomposition, "communications"),
    "rating_distribution": _of_source(reports.rating_distribution, "ratings"),
    "mpg_cost": _of_model(reports.mpg_cost, "fuel"),
    "variant_table": _of_source(reports.variant_table, "variants"),
    "fuel_spread": _of_model(reports.fuel_spread, "fuel"),
}
