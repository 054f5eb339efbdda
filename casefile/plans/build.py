"""The whole build: landed extracts to bronze, silver, gold, checks and exports, as Parquet tables.

Every layer is written and the next one reads the written table, so nothing is computed
twice, a lost executor costs the tasks of one layer at most, and all readers see the same
dedup survivors.
"""

from __future__ import annotations

import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from casefile.operators import fingerprints, identity, mart, quality, rules, star
from casefile.operators.conform import CONFORM_JOBS
from casefile.plans import baseline, lookup, reports
from casefile.settings import Settings
from casefile.sources import contracts, intake, readers, writers

# Gold fact table -> silver name.
GOLD_FACTS = {
    "gold_fact_complaint": "complaints",
    "gold_fact_recall": "recalls",
    "gold_fact_investigation": "investigations",
    "gold_fact_manufacturer_communication": "communications",
    "gold_fact_ncap_variant": "ratings",
    "gold_fact_fuel_economy_variant": "variants",
    "gold_fact_state_registration": "registrations",
}


# Gold fact table -> its date keys.
DATE_KEYS = {
    "gold_fact_complaint": ["incident_date_key", "received_date_key"],
    "gold_fact_recall": ["report_received_date_key"],
    "gold_fact_investigation": ["opened_date_key", "closed_date_key"],
    "gold_fact_manufacturer_communication": ["communication_date_key"],
}


def write_tables(spark: SparkSession, frames: dict[str, DataFrame], folder: str, **options: str) -> dict[str, DataFrame]:
    """Write independent tables side by side, so that one table's last tasks do not idle the cluster; read them back.

    Facts are clustered by entity, for lookups; the others are written with the `options`.
    """
    records = dict(lookup.CLUSTERED.values())

    def write(name: str) -> None:
        if name in records:
            lookup.write_clustered(frames[name], f"{folder}/{name}", records[name])
        else:
            writers.replace(frames[name], f"{folder}/{name}", **options)

    with ThreadPoolExecutor(max_workers=max(1, len(frames))) as pool:
        list(pool.map(write, frames))
    return {name: spark.read.parquet(f"{folder}/{name}") for name in frames}


def raw_file(table: str, path: str) -> intake.RawFile:
    """How the raw file of a contract table is read."""
    if table in contracts.RAW_HEADERS:
        return intake.RawFile(table, contracts.SOURCE_IDS[table], path, tuple(contracts.RAW_HEADERS[table].items()))
    return intake.RawFile(table, contracts.SOURCE_IDS[table], path, tuple(contracts.raw_layout(table)), contracts.RAW_FIELD_COUNTS[table])


def prepare_extracts(spark: SparkSession, raw: dict[str, str], landing: str, review: str | None = None) -> DataFrame:
    """Raw files (contract table -> path) to approved extracts and their manifest.

    Only contract columns are written, trimmed. Each raw file is parsed once; its rows, its rejected lines
    and their counts come from that pass, below `review` (by default beside the landing folder), where every
    attempt keeps its audit rows (`audit_intake`) and its rejected lines (`rejected_lines`). A file with a
    line of the wrong field count then stops the run before anything is landed; one without an expected
    header stops it before anything is written.
    """
    review = review or f"{landing.rstrip('/')}-review"
    attempt = uuid.uuid4().hex
    files = [raw_file(name, path) for name, path in raw.items()]
    with ThreadPoolExecutor(max_workers=len(files)) as pool:  # the bytes' checksums beside the rows
        sources = {name: pool.submit(source_checksum, spark, path) for name, path in raw.items()}
        received = intake.receive_all(spark, files, f"{review}/received/{attempt}")
        sources = {name: found.result() for name, found in sources.items()}
    audit = intake.audit(spark, received, attempt, sources)
    writers.append(audit, f"{review}/audit_intake")
    spoiled = [r for r in received if r.rejected_rows]
    if spoiled:
        lines = reduce(DataFrame.unionByName, [r.rejects(spark) for r in spoiled])
        writers.append(lines.withColumn("attempt", F.lit(attempt)), f"{review}/rejected_lines")
        raise ValueError("; ".join(f"{r.raw.source_id}: {r.rejected_rows} malformed rows, extract not approved" for r in spoiled))
    good = {r.raw.table: quality.project_allowed(r.approved(spark), contracts.CONTRACTS[r.raw.table]) for r in received}
    with ThreadPoolExecutor(max_workers=len(good)) as pool:
        list(pool.map(lambda n: writers.export(good[n], f"{landing}/{n}.csv.gz", fmt="csv.gz"), good))
    landed = readers.file_checksums(spark, f"{landing}/*.csv.gz")
    counts = {r.raw.table: (r.rows, r.rejected_rows) for r in received}
    manifest = writers.build_manifest(good, contracts.SOURCE_IDS, landed, sources, counts=counts)
    created = spark.sql("SELECT string(current_timestamp())").first()[0]
    writers.write_manifest(manifest, f"{landing}/manifest.json", project="casefile", created_at_utc=created)
    return readers.read_manifest(spark, f"{landing}/manifest.json")


def source_checksum(spark: SparkSession, path: str) -> str:
    """SHA-256 of a raw file; of several part files, of their checksums in name order."""
    parts = readers.file_checksums(spark, path).filter("file_name NOT LIKE '\\_%' AND file_name NOT LIKE '.%'")
    listed = F.array_sort(F.collect_list(F.struct("file_name", "sha256")))  # one short row per part file
    row = parts.agg(
        F.when(F.count("*") == 1, F.max("sha256")).otherwise(F.sha2(F.array_join(F.transform(listed, lambda x: x["sha256"]), ""), 256))
    ).first()
    return row[0]


def ingest(
    spark: SparkSession, landing: str, out: str, batch: str, ingested_at: Column | None = None, **csv_options
) -> dict[str, DataFrame]:
    """Bronze tables of one batch. The audit row is always kept; any contract failure stops the run.

    Files whose checksum is not the manifest's stop the run before anything is read. Every attempt at a
    batch has a folder and audit rows of its own, and only they decide about it: a corrected batch passes,
    and the audit keeps both attempts.

    Each extract is read once: it is staged as Parquet with its provenance, and the row
    counts the contract is checked on are observed on that write. Later layers
    only see a batch whose tables all passed.
    """
    moment = F.current_timestamp() if ingested_at is None else ingested_at
    manifest = readers.read_manifest(spark, f"{landing}/manifest.json")
    expected = list(contracts.CONTRACTS)
    quality.gate(quality.missing_tables(manifest, expected), F.lit(True), "table_name", "Manifest completeness")
    quality.gate(verify_files(spark, landing), ~F.col("checksum_matches"), "table_name", "Checksum")
    entries = {row["table_name"]: row for row in manifest.collect()}  # one row per extract
    attempt = f"batch={batch}/attempt={uuid.uuid4().hex}"
    folder = f"{out}/bronze/{attempt}"

    def stage(name: str) -> tuple[list[str], int]:
        """Header and rows of an extract, staged with its provenance."""
        entry, path = entries[name], f"{landing}/{name}.csv.gz"
        header = readers.header_columns(spark, path, **csv_options)
        rows = quality.with_lineage(
            readers.read_extract(spark, path, header, **csv_options),
            entry["source_id"],
            entry["output_file"],
            entry["source_sha256"],
            entry["output_sha256"],
            batch,
            moment,
        )
        return header, intake.observed_write(rows, f"{folder}/{name}", {"rows": F.count(F.lit(1))})["rows"]

    with ThreadPoolExecutor(max_workers=len(expected)) as pool:  # header probes and writes side by side
        observed = dict(zip(expected, pool.map(stage, expected), strict=True))
    bronze = {name: spark.read.parquet(f"{folder}/{name}") for name in expected}
    seen = [(name, header, rows) for name, (header, rows) in observed.items()]  # one row per table
    seen = spark.createDataFrame(seen, "table_name string, actual_columns array<string>, actual_rows long")
    audit = quality.check_contract(seen, manifest, batch, moment)
    audit = write_tables(spark, {"audit": audit}, f"{out}/attempts/{attempt}")["audit"]
    writers.append(audit, f"{out}/audit_bronze_ingestion")
    writers.append(manifest.withColumn("_batch_id", F.lit(batch)), f"{out}/bronze_manifest")
    quality.gate_contract(audit)
    return bronze


def verify_files(spark: SparkSession, landing: str) -> DataFrame:
    """Landed files against the manifest's checksums."""
    files = readers.file_checksums(spark, f"{landing}/*.csv.gz")
    return quality.verify_checksums(
        readers.read_manifest(spark, f"{landing}/manifest.json"), writers.extract_checksums(files)
    )


def conform(spark: SparkSession, bronze: dict[str, DataFrame], out: str, settings: Settings = Settings()) -> dict[str, DataFrame]:
    """Silver tables."""
    frames = {name: job(bronze[table], settings) for name, (table, job) in CONFORM_JOBS.items()}
    return write_tables(spark, frames, f"{out}/silver")


def build_gold(
    spark: SparkSession,
    silver: dict[str, DataFrame],
    out: str,
    settings: Settings = Settings(),
    mapping: DataFrame | None = None,
    moment: datetime | None = None,
) -> dict[str, DataFrame]:
    """Bridge, queues, dimensions, facts, mart and quality checks; a failed check stops the run after it is written.

    With a mapping of reviewed aliases the bridge's canonical keys follow the decisions in force at `moment`,
    which are written beside it. Whether an entity matches a reference is decided by its own identity only.
    """
    folder = f"{out}/gold"
    systems = list(settings.source_systems.values())
    first = write_tables(
        spark,
        {
            "silver_vehicle_identity": identity.entity_sources(baseline.by_system(silver, settings), settings),
            "gold_dim_date": star.calendar(silver),
            "gold_dim_evidence_topic": star.dim_topic(spark, settings.topic_rules, settings.default_topic),
            "gold_agg_vehicle_evidence": mart.evidence_mart(silver, settings),
            **{table: star.FACTS[name](silver[name]) for table, name in GOLD_FACTS.items()},
        },
        folder,
    )
    masks, evidence = first["silver_vehicle_identity"], first["gold_agg_vehicle_evidence"]
    bridge, in_force = identity.bridge_of(masks, systems, settings=settings), {}
    if mapping is not None:
        aliases = identity.approved_aliases(mapping, moment)
        in_force = write_tables(spark, {"silver_vehicle_alias_in_force": aliases}, folder)
        bridge = identity.with_canonical(bridge, in_force["silver_vehicle_alias_in_force"])
    second = write_tables(
        spark,
        {
            "silver_vehicle_identity_bridge": bridge,
            "silver_vehicle_alias_review_queue": identity.alias_review_queue(masks, systems, settings=settings),
            "audit_silver_entity_match_quality": identity.match_quality(bridge),
            "gold_dim_vehicle": star.dim_entity(bridge),
            "gold_vehicle_review_queue": rules.review_queue(evidence),
            "gold_alias_work_queue": rules.alias_work_queue(evidence),
        },
        folder,
    )
    tables = {**first, **second, **in_force}
    facts = {t: tables[t] for t in GOLD_FACTS if "vehicle_key" in tables[t].columns}
    checks = quality.dq_checks(
        tables["gold_dim_vehicle"], facts, tables["gold_alias_work_queue"], F.current_timestamp()
    )
    semantic = quality.dq_semantic(
        evidence,
        {"complaint_reports": (tables["gold_fact_complaint"], "complaint_id"), "recall_campaigns": (tables["gold_fact_recall"], "campaign_number")},
        tables["gold_dim_date"],
        {column: tables[table] for table, columns in DATE_KEYS.items() for column in columns},
    )
    checks = checks.unionByName(semantic.withColumn("checked_at", F.current_timestamp()))
    tables |= write_tables(spark, {"gold_data_quality_checks": checks}, folder)
    quality.gate_checks(tables["gold_data_quality_checks"])
    return tables


def export_curated(spark: SparkSession, gold: dict[str, DataFrame], out: str, audit_path: str) -> None:
    """The three curated exports."""
    writers.export(
        gold["gold_agg_vehicle_evidence"], f"{out}/export/evidence_summary.parquet", reports.EVIDENCE_SUMMARY_COLUMNS
    )
    writers.export(
        gold["gold_alias_work_queue"], f"{out}/export/alias_work_queue.parquet", reports.ALIAS_EXPORT_COLUMNS
    )
    audit = spark.read.parquet(audit_path)
    trust = reports.data_trust(audit, gold["audit_silver_entity_match_quality"])
    writers.export(trust, f"{out}/export/data_trust.parquet")


def reconcile(spark: SparkSession, bronze: dict[str, DataFrame], gold: dict[str, DataFrame], folder: str, settings: Settings = Settings()) -> DataFrame:
    """The written mart against the mart computed from the landed rows by the other route; a difference stops the run.

    Totals are compared metric by metric, then entities by fingerprints, which find errors that cancel in the
    totals and name their entities. The other mart, both results and the differences are written first.
    """
    mart = gold["gold_agg_vehicle_evidence"]
    other = write_tables(spark, {"mart": baseline.baseline_mart(bronze, settings)}, f"{folder}/baseline")["mart"]
    found = {
        "reconciliation": quality.reconcile(quality.mart_metrics(mart), quality.mart_metrics(other)),
        "reconciliation_differences": fingerprints.differences(mart, other, "vehicle_key"),
    }
    found = write_tables(spark, found, f"{folder}/gold")
    quality.gate(found["reconciliation"], ~F.col("passed"), "metric", "Reconciliation")
    columns = found["reconciliation_differences"].select("column").distinct()  # at most one row a column
    quality.gate(columns, F.lit(True), "column", "Reconciliation of entities")
    return found["reconciliation"]


POINTER = "version long, batch_id string, folder string, parent long, published_at timestamp"


def pointers(spark: SparkSession, out: str) -> DataFrame:
    """The published snapshots in order: version, batch_id, folder, parent, run, published_at.

    A row counts if its parent is the version before it; of several with one parent the first counts. Rows
    are added and never replaced, so a reader sees the newest version whatever a writer is doing.
    """
    rows = _claims(spark, out)
    first = Window.partitionBy("version").orderBy("published_at", "run")
    kept = rows.where("parent = version - 1").withColumn("place", F.row_number().over(first)).where("place = 1")
    return kept.drop("place")


def _claims(spark: SparkSession, out: str) -> DataFrame:
    """Every pointer row that was written, each in a folder of its own, which only its run writes to."""
    schema, folder = f"{POINTER}, run string", spark._jvm.org.apache.hadoop.fs.Path(f"{out}/published")
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.read.schema(schema).parquet(f"{out}/published")
    return spark.createDataFrame([], schema)


def newest(spark: SparkSession, out: str) -> tuple[int, str | None]:
    """Version and folder of the newest snapshot; (0, None) if there is none."""
    row = pointers(spark, out).orderBy(F.desc("version")).select("version", "folder").first()
    return (row["version"], row["folder"]) if row else (0, None)


def publish(spark: SparkSession, out: str, folder: str, batch: str, parent: int) -> int:
    """Point readers to a finished snapshot by one added row, last of all; returns its version.

    `parent` is the version the run started from. If another run has published since, or claims the same
    version first, this one is refused and readers keep the other.
    """
    started, _ = newest(spark, out)
    if started != parent:
        raise ValueError(f"refused: version {started} was published after this run started from {parent}")
    name = uuid.uuid4().hex
    row = spark.createDataFrame([(parent + 1, batch, folder, parent)], "version long, batch_id string, folder string, parent long")
    writers.append(row.withColumn("published_at", F.current_timestamp()).coalesce(1), f"{out}/published/run={name}")
    won = pointers(spark, out).where(F.col("version") == parent + 1).first()
    if won["run"] != name:
        raise ValueError(f"refused: another run published version {parent + 1} first")
    return parent + 1


def current(spark: SparkSession, out: str) -> str:
    """Folder of the published snapshot, with silver, gold and export below it."""
    version, folder = newest(spark, out)
    if not version:
        raise ValueError(f"nothing is published below {out}")
    return folder


def evidence_of(spark: SparkSession, out: str, keys: list[str] | DataFrame) -> DataFrame:
    """All evidence of the entities in the published snapshot: by conditions on its clustered facts for a few keys."""
    return reports.entity_drillthrough(lookup.facts(spark, f"{current(spark, out)}/gold"), keys)


def batch_moment(batch: str) -> datetime:
    """The time that a batch id names."""
    return datetime.strptime(batch, "%Y%m%dT%H%M%SZ").replace(tzinfo=UTC)


def run(
    spark: SparkSession,
    landing: str,
    out: str,
    batch: str,
    settings: Settings = Settings(),
    aliases: DataFrame | None = None,
    steps: dict[str, float] | None = None,
    **csv_options,
) -> dict[str, DataFrame]:
    """Landing folder to reconciled gold tables; raises where a contract, check or reconciliation fails.

    `aliases` are review decisions (`identity.ALIAS_MAPPING`); those of the batch's time count, so an older
    batch that is built again has the canonical keys of its day. `steps` receives the seconds of every step.

    The snapshot is written to a folder of its own and published after the last check, so readers never
    see a failed or half-written one.
    """
    def timed(name: str, step, *arguments, **options):
        start = time.perf_counter()
        result = step(spark, *arguments, **options)
        if steps is not None:
            steps[name] = round(time.perf_counter() - start, 3)
        return result

    parent, _ = newest(spark, out)
    moment = batch_moment(batch) if aliases is not None else None
    bronze = timed("ingest", ingest, landing, out, batch, **csv_options)
    folder = f"{out}/snapshots/{batch}-{uuid.uuid4().hex}"
    silver = timed("conform", conform, bronze, folder, settings)
    gold = timed("gold", build_gold, silver, folder, settings, aliases, moment)
    timed("export", export_curated, gold, folder, f"{out}/audit_bronze_ingestion")
    result = timed("reconcile", reconcile, bronze, gold, folder, settings)
    timed("publish", publish, out, folder, batch, parent)
    return {**gold, "reconciliation": result}
