"""The whole build from landed files, and what stops it."""

import gzip
import shutil

import pytest
from pyspark.sql import functions as F

from casefile.plans import build
from casefile.session import scratch_path, scratch_root
from casefile.sources import contracts, intake
from workload import adapter, queries

SF_DIR = "/root/testdata/sf0.001"
BATCH = "20260101T000000Z"


@pytest.fixture(scope="module")
def landing(spark):
    folder = queries.land(spark, SF_DIR)
    queries.write_manifest(spark, SF_DIR, folder)
    return folder


def copy(landing, tmp_path):
    target = str(tmp_path / "landing")
    shutil.copytree(landing.removeprefix("file:"), target)
    return target


def test_full_build(spark, landing, tmp_path):
    out = str(tmp_path / "out")
    gold = build.run(spark, landing, out, BATCH, queries.SETTINGS)
    mart = gold["gold_agg_vehicle_evidence"]
    assert mart.count() == gold["gold_dim_vehicle"].count() > 100
    queue = gold["gold_vehicle_review_queue"].count()
    assert queue + mart.filter("review_priority = 'MONITOR'").count() == mart.count()
    assert gold["gold_alias_work_queue"].filter("alias_priority NOT IN ('P0', 'P1')").count() == 0
    assert gold["reconciliation"].filter("NOT passed").count() == 0
    fact = gold["gold_fact_complaint"]
    assert fact.select("_source_id", "_batch_id").distinct().collect() == [(contracts.SOURCE_IDS["complaints"], BATCH)]
    published = build.current(spark, out)
    exported = spark.read.parquet(f"{published}/export/evidence_summary.parquet")
    entities = mart.count()
    assert len(exported.columns) == 27 and exported.count() == entities
    assert len(spark.read.parquet(f"{published}/export/alias_work_queue.parquet").columns) == 13
    audit = spark.read.parquet(f"{out}/audit_bronze_ingestion")
    assert audit.count() == 7 and audit.filter("status = 'FAIL'").count() == 0

    # the evidence of one entity, from the published facts
    key = mart.where("complaint_reports > 1").selectExpr("min(vehicle_key)").first()[0]
    evidence = build.evidence_of(spark, out, [key]).collect()
    assert evidence and {r["vehicle_key"] for r in evidence} == {key}
    assert sum(r["source_family"] == "complaint" for r in evidence) == fact.where(F.col("vehicle_key") == key).count()

    # a second batch replaces the snapshot and adds to the audit; aliases decided by its time change its bridge
    keys = [r[0] for r in gold["gold_dim_vehicle"].select("vehicle_key").orderBy("vehicle_key").limit(4).collect()]
    day = build.batch_moment("20260101T120000Z")
    rows = [(k, t, "APPROVED", "r", day if k != keys[2] else build.batch_moment("20260103T000000Z"), "why", "HIGH") for k, t in zip(keys, keys[1:], strict=False)]
    decisions = spark.createDataFrame(rows, build.identity.ALIAS_MAPPING)
    again = build.run(spark, landing, out, "20260102T000000Z", queries.SETTINGS, aliases=decisions)
    remapped = again["silver_vehicle_identity_bridge"].filter("canonical_vehicle_key <> vehicle_key")
    assert {tuple(r) for r in remapped.select("vehicle_key", "canonical_vehicle_key").collect()} == {(keys[0], keys[2]), (keys[1], keys[2])}
    assert gold["silver_vehicle_identity_bridge"].filter("canonical_vehicle_key <> vehicle_key").count() == 0
    assert again["gold_agg_vehicle_evidence"].count() == entities
    assert build.current(spark, out) != published
    assert spark.read.parquet(f"{out}/audit_bronze_ingestion").count() == 14


def rewrite_manifest(spark, folder, change):
    rows = queries.readers.read_manifest(spark, f"{folder}/manifest.json").collect()
    manifest = change(spark.createDataFrame(rows, queries.readers.MANIFEST_SCHEMA["extracts"].dataType.elementType))
    queries.writers.write_manifest(manifest, f"{folder}/manifest.json", project="changed")


@pytest.mark.parametrize(
    ("what", "change"),
    [
        ("recalls", lambda m: m.withColumn("rows", F.col("rows") + F.when(F.col("table_name") == "recalls", 1).otherwise(0))),
        (
            "investigations",
            lambda m: m.withColumn(
                "columns",
                F.when(F.col("table_name") == "investigations", F.reverse("columns")).otherwise(F.col("columns")),
            ),
        ),
    ],
)
def test_a_broken_contract_stops_the_run_and_stays_in_the_audit(spark, landing, tmp_path, what, change):
    folder = copy(landing, tmp_path)
    rewrite_manifest(spark, folder, change)
    out = str(tmp_path / "out")
    with pytest.raises(ValueError, match=what):
        build.run(spark, folder, out, BATCH, queries.SETTINGS)
    failed = spark.read.parquet(f"{out}/audit_bronze_ingestion").filter("status = 'FAIL'")
    assert [r["table_name"] for r in failed.collect()] == [what]
    assert not (tmp_path / "out" / "snapshots").exists() and not (tmp_path / "out" / "published").exists()

    # the corrected batch passes under the same id, and the audit keeps both attempts
    corrected = copy(landing, tmp_path / "again")
    build.ingest(spark, corrected, out, BATCH)
    audit = spark.read.parquet(f"{out}/audit_bronze_ingestion")
    assert audit.filter("status = 'FAIL'").count() == 1 and audit.count() == 14


def test_a_changed_file_stops_the_run(spark, landing, tmp_path):
    """Same header and row count, other content."""
    folder = copy(landing, tmp_path)
    changed = adapter.recalls(spark, SF_DIR).withColumn("do_not_drive_flag", F.lit("Yes"))
    queries.writers.export(changed, f"{folder}/recalls.csv.gz", fmt="csv.gz")
    out = tmp_path / "out"
    with pytest.raises(ValueError, match="Checksum failed for: .'recalls'"):
        build.run(spark, folder, str(out), BATCH, queries.SETTINGS)
    assert not out.exists()


def test_a_missing_manifest_entry_stops_the_run(spark, landing, tmp_path):
    folder = copy(landing, tmp_path)
    rewrite_manifest(spark, folder, lambda m: m.filter("table_name <> 'fuel_economy'"))
    with pytest.raises(ValueError, match="fuel_economy"):
        build.ingest(spark, folder, str(tmp_path / "out"), BATCH)


def test_checksums_show_a_changed_file(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    with gzip.open(folder / "recalls.csv.gz", "wt") as handle:
        handle.write("a\n1\n")
    files = queries.writers.extract_checksums(queries.readers.file_checksums(spark, f"{folder}/*.csv.gz"))
    manifest = spark.createDataFrame(
        [("recalls", "recalls.csv.gz", files.first()["output_sha256"])],
        "table_name string, output_file string, output_sha256 string",
    )
    queries.writers.write_manifest(manifest, f"{folder}/manifest.json", project="p")
    assert [r["checksum_matches"] for r in build.verify_files(spark, str(folder)).collect()] == [True]
    with gzip.open(folder / "recalls.csv.gz", "wt") as handle:
        handle.write("a\n2\n")
    assert [r["checksum_matches"] for r in build.verify_files(spark, str(folder)).collect()] == [False]


def test_scratch_is_the_shared_folder(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_adapter_columns_follow_the_contract(spark):
    for name, columns in contracts.CONTRACTS.items():
        assert adapter.bronze(spark, SF_DIR, name).dtypes == [(c, "string") for c in columns]


def test_raw_files_become_approved_extracts(spark, tmp_path):
    raw = {"complaints": str(tmp_path / "raw-complaints"), "state_registrations": str(tmp_path / "raw-registrations")}
    padded = queries._raw_complaints(spark, SF_DIR)
    padded.write.options(sep="\t", quote="", encoding="ISO-8859-1", emptyValue="").csv(raw["complaints"])
    header = contracts.RAW_HEADERS["state_registrations"]
    adapter.registrations(spark, SF_DIR).select(*[F.col(c).alias(h) for c, h in header.items()]).write.options(
        header=True
    ).csv(raw["state_registrations"])
    landing = str(tmp_path / "landing")
    manifest = {r["table_name"]: r for r in build.prepare_extracts(spark, raw, landing).collect()}
    assert manifest["complaints"]["rows"] == padded.count()
    assert manifest["complaints"]["columns"] == contracts.CONTRACTS["complaints"]
    assert all(len(r["source_sha256"]) == 64 for r in manifest.values())
    assert [r["checksum_matches"] for r in build.verify_files(spark, landing).collect()] == [True, True]
    extract = queries.readers.read_extract(spark, f"{landing}/complaints.csv.gz", contracts.CONTRACTS["complaints"])
    assert extract.filter("manufacturer_name LIKE 'Société Brand%'").count() == padded.count()

    audit = spark.read.parquet(str(tmp_path / "landing-review" / "audit_intake"))
    assert {(r["table_name"], r["rows"], r["rejected_rows"], r["status"]) for r in audit.collect()} == {
        (t, m["rows"], 0, "PASS") for t, m in manifest.items()
    }


def test_rejected_lines_are_kept_and_counted_before_the_run_stops(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    good = "\t".join(f" v{i} " for i in range(51))
    (raw / "a.txt").write_text("\n".join([good] * 3 + ["too\tshort", ""]) + "\n", encoding="latin-1")
    (raw / "b.txt").write_text(good + "\tone too many é\n" + good + "\n", encoding="latin-1")
    landing = str(tmp_path / "landing")
    with pytest.raises(ValueError, match="3 malformed rows"):
        build.prepare_extracts(spark, {"complaints": str(raw)}, landing)
    assert not (tmp_path / "landing").exists()
    audit = spark.read.parquet(f"{landing}-review/audit_intake").first()
    assert (audit["rows"], audit["rejected_rows"], audit["irregular_rows"], audit["status"]) == (4, 3, 0, "FAIL")
    assert len(audit["source_sha256"]) == 64
    lines = spark.read.parquet(f"{landing}-review/rejected_lines").collect()
    assert sorted((r["part"], r["n_fields"], r["line"]) for r in lines) == [
        ("a.txt", 1, ""), ("a.txt", 2, "too\tshort"), ("b.txt", 52, good + "\tone too many é"),
    ]
    assert {(r["attempt"], r["table_name"]) for r in lines} == {(audit["attempt"], "complaints")}


def test_one_scan_of_a_raw_file_gives_rows_rejects_and_counts(spark, tmp_path):
    """The tasks that read the raw text read it once."""
    path = str(tmp_path / "raw")
    tail = F.when(F.col("id") % 100 == 0, F.concat("id", F.lit("\t"))).otherwise(F.col("id").cast("string"))
    spark.range(20_000).select(F.concat_ws("\t", "id", "id", tail).alias("value")).write.text(path)
    raw = intake.RawFile("lines", "lines", path, (("first", 0), ("last", 2)), 3)
    plan = intake.parse(spark, raw)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1 and "Exchange" not in plan
    received = intake.receive(spark, raw, str(tmp_path / "received"))
    assert (received.rows, received.rejected_rows) == (19_800, 200)
    assert received.approved(spark).count() == 19_800 and received.rejects(spark).count() == 200
    assert received.approved(spark).where("first <> last").count() == 0 and received.approved(spark).columns == ["first", "last"]
    assert sorted(p.name for p in (tmp_path / "received").iterdir() if p.is_dir()) == ["_rejected=false", "_rejected=true"]


def pointer(spark, out):
    return build.newest(spark, str(out))


def test_publishing_never_hides_the_snapshot_before(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    assert pointer(spark, out) == (0, None)
    with pytest.raises(ValueError, match="nothing is published"):
        build.current(spark, out)
    assert build.publish(spark, out, "first", "b1", 0) == 1
    assert build.publish(spark, out, "second", "b2", 1) == 2

    def stop(df, path):  # a writer that dies after it has begun
        (tmp_path / "out" / "published" / "run=dead" / "_temporary").mkdir(parents=True)
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(build.writers, "append", stop)
        with pytest.raises(RuntimeError):
            build.publish(spark, out, "third", "b3", 2)
    assert build.current(spark, out) == "second"
    assert build.publish(spark, out, "third", "b3", 2) == 3
    assert [(r["version"], r["folder"], r["parent"]) for r in build.pointers(spark, out).orderBy("version").collect()] == [
        (1, "first", 0), (2, "second", 1), (3, "third", 2),
    ]


def test_of_two_runs_at_once_one_is_refused(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    build.publish(spark, out, "first", "b1", 0)
    # both started from version 1; the second finds the first's row
    assert build.publish(spark, out, "mine", "b2", 1) == 2
    with pytest.raises(ValueError, match="version 2 was published after"):
        build.publish(spark, out, "yours", "b2", 1)
    # both pass the check before either has written: the row that was there first counts
    with monkeypatch.context() as patch:
        real = build.newest
        patch.setattr(build, "newest", lambda spark, out: (1, None))
        with pytest.raises(ValueError, match="published version 2 first"):
            build.publish(spark, out, "theirs", "b2", 1)
        assert real(spark, out) == (2, "mine")
    assert build.current(spark, out) == "mine" and build.publish(spark, out, "next", "b3", 2) == 3
