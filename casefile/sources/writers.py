"""Writers: layer tables and exports. Overwrite replaces data and schema; a path being read is never a target."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def replace(df: DataFrame, path: str, partition_by: str | None = None, **options: str) -> None:
    """Snapshot-replace a Parquet table, schema included; `options` are those of the Parquet writer."""
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.options(**options).mode("overwrite").parquet(path)


def append(df: DataFrame, path: str) -> None:
    """Add rows to a Parquet table that keeps history."""
    df.write.mode("append").parquet(path)


def export(df: DataFrame, path: str, columns=None, fmt: str = "parquet") -> None:
    """Write the approved columns as Parquet, or as gzip CSV with a header."""
    chosen = df.select(*columns) if columns else df
    writer = chosen.write.mode("overwrite")
    if fmt == "parquet":
        writer.parquet(path)
    elif fmt == "csv.gz":
        # emptyValue: an empty text is written as nothing, as a plain CSV writer does
        writer.options(
            header=True,
            quote='"',
            escape='"',
            compression="gzip",
            emptyValue="",
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        ).csv(path)
    else:
        raise ValueError(f"unknown format {fmt}")


def build_manifest(
    extracts: dict[str, DataFrame],
    source_ids: dict[str, str],
    checksums: DataFrame | None = None,
    source_checksums: dict[str, str] | None = None,
    malformed: dict[str, DataFrame] | None = None,
    counts: dict[str, tuple[int, int]] | None = None,
) -> DataFrame:
    """One row per extract: rows, ordered columns, file checksum, malformed rows.

    `counts` are the (rows, malformed rows) that were observed when the extracts were written; without them
    the row counts of all extracts run in one job. `checksums` is the output of file_checksums
    for the extract folders; an extract of several part files gets the checksum of its
    parts' checksums in name order.
    """
    spark = next(iter(extracts.values())).sparkSession
    if counts is not None:
        known = [(name, *counts[name]) for name in extracts]  # one row per extract
        counted = spark.createDataFrame(known, "table_name string, rows long, malformed_rows long")
    else:
        counted = _counted(extracts, "rows")
        if malformed:
            counted = counted.join(F.broadcast(_counted(malformed, "malformed_rows")), "table_name", "left")  # one row per extract
        else:
            counted = counted.withColumn("malformed_rows", F.lit(0).cast("bigint"))
    described = spark.createDataFrame(
        [
            (name, source_ids.get(name, name), (source_checksums or {}).get(name), f"{name}.csv.gz", df.columns)
            for name, df in extracts.items()
        ],
        "table_name string, source_id string, source_sha256 string, output_file string, columns array<string>",
    )
    manifest = described.join(F.broadcast(counted), "table_name")  # one row per extract
    manifest = manifest.fillna({"malformed_rows": 0})
    if checksums is None:
        return manifest.withColumn("output_sha256", F.lit(None).cast("string"))
    return manifest.join(extract_checksums(checksums), "output_file", "left")


def _counted(frames: dict[str, DataFrame], what: str) -> DataFrame:
    """table_name and the number of rows of each frame, in one job."""
    each = [df.agg(F.count("*").alias(what)).select(F.lit(name).alias("table_name"), what) for name, df in frames.items()]
    return reduce(DataFrame.unionByName, each)


def extract_checksums(checksums: DataFrame) -> DataFrame:
    """Checksum per extract from the checksums of its files.

    The extract is the `<name>.csv.gz` file or folder in the path. One file keeps its own
    SHA-256. Several part files are combined by XOR over the SHA-256 of (file name, file
    checksum): order-free, so it aggregates like a sum and no list of files is ever collected.
    """
    parts = checksums.select(
        F.regexp_extract("path", "([^/]+[.]csv[.]gz)(/[^/]+[.]gz)?$", 1).alias("output_file"),
        "sha256",
        F.sha2(F.concat_ws("|", "file_name", "sha256"), 256).alias("named"),
    ).filter("output_file <> ''")
    quarters = [F.conv(F.substring("named", 1 + 16 * i, 16), 16, -10).cast("bigint") for i in range(4)]
    combined = parts.groupBy("output_file").agg(
        F.count("*").alias("files"),
        F.max("sha256").alias("only"),
        *[F.bit_xor(q).alias(f"x{i}") for i, q in enumerate(quarters)],
    )
    hexed = F.concat(*[F.lpad(F.lower(F.hex(f"x{i}")), 16, "0") for i in range(4)])
    return combined.select(
        "output_file", F.when(F.col("files") == 1, F.col("only")).otherwise(hexed).alias("output_sha256")
    )


def write_manifest(manifest: DataFrame, path: str, **document_fields: str) -> None:
    """Write the manifest as one nested JSON document (one element per extract, so one task)."""
    extract = F.struct(*[F.col(c) for c in manifest.columns])
    document = manifest.agg(F.array_sort(F.collect_list(extract)).alias("extracts")).select(
        *[F.lit(value).alias(name) for name, value in document_fields.items()], "extracts"
    )
    document.coalesce(1).write.mode("overwrite").json(path)
