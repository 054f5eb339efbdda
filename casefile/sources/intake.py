"""Raw files taken in by one pass: approved rows, rejected lines and their counts come from the same write.

A raw file is parsed once. Its rows are written as Parquet, rejected lines whole and apart, and the counts are
metrics observed on that write. The observed frame is what the write's own tasks compute, without a shuffle in
between, so a task that runs twice counts once. Only the checksum of the file's bytes, which must be taken in
order, reads it besides.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from casefile.sources import readers


@dataclass(frozen=True)
class RawFile:
    """A raw file of a table. `layout` gives (column, position) with `n_fields`, or (column, header name) without."""

    table: str
    source_id: str
    path: str
    layout: tuple[tuple[str, int | str], ...]
    n_fields: int | None = None
    sep: str = "\t"
    encoding: str = "ISO-8859-1"


BOOKKEEPING = ("_line", "_n_fields", "_irregular", "_part", "_rejected")


def parse(spark: SparkSession, raw: RawFile) -> DataFrame:
    """The laid-out columns of every line, and: the line if it is rejected, its fields, whether it is irregular, its part file.

    By position a line with another number of fields is rejected, and its columns are null. By name nothing
    is: short and long rows are irregular, as `readers.read_named` has it.
    """
    part = F.col("_metadata.file_name").alias("_part")
    if raw.n_fields is None:
        rows = readers.named_rows(spark, raw.path, list(raw.layout), raw.encoding)
        columns = [F.trim(F.coalesce(F.col(f"`{source}`"), F.lit(""))).alias(name) for name, source in raw.layout]
        irregular = F.col("_irregular_").isNotNull().alias("_irregular")
        return rows.select(
            *columns, F.lit(None).cast("string").alias("_line"), F.lit(None).cast("int").alias("_n_fields"), irregular, part, F.lit(False).alias("_rejected")
        )
    fields = readers.split_lines(spark, raw.path, raw.sep, raw.encoding, part)
    good = F.size("fields") == raw.n_fields
    columns = [F.when(good, F.trim(F.get("fields", F.lit(position)))).alias(name) for name, position in raw.layout]
    return fields.select(
        *columns, F.when(~good, F.col("line")).alias("_line"), F.size("fields").alias("_n_fields"), F.lit(False).alias("_irregular"), "_part", (~good).alias("_rejected")
    )


def observed_write(df: DataFrame, path: str, metrics: dict[str, Column], partition_by: str | None = None) -> dict[str, int]:
    """Write a frame as Parquet and return metrics of its rows, which the write's own tasks gathered.

    The frame must end without a shuffle of its own after the observed rows, as a write does: then a lost or
    repeated task counts once.
    """
    seen = Observation(f"observed-{uuid.uuid4().hex}")
    rows = df.observe(seen, *[metric.alias(name) for name, metric in metrics.items()])
    writer = rows.write.partitionBy(partition_by) if partition_by else rows.write
    writer.mode("overwrite").parquet(path)
    return seen.get


@dataclass(frozen=True)
class Received:
    """What one pass over a raw file left: its folder, and the counts observed."""

    raw: RawFile
    folder: str
    rows: int
    rejected_rows: int
    irregular_rows: int

    def approved(self, spark: SparkSession) -> DataFrame:
        """The rows with the right number of fields."""
        return _stored(spark, self.raw, self.folder).where("NOT _rejected").select(*[name for name, _ in self.raw.layout])

    def rejects(self, spark: SparkSession) -> DataFrame:
        """table_name, source_id, part, n_fields, line of the lines that were not taken."""
        return _stored(spark, self.raw, self.folder).where("_rejected").select(
            F.lit(self.raw.table).alias("table_name"),
            F.lit(self.raw.source_id).alias("source_id"),
            F.col("_part").alias("part"),
            F.col("_n_fields").alias("n_fields"),
            F.col("_line").alias("line"),
        )


def _stored(spark: SparkSession, raw: RawFile, folder: str) -> DataFrame:
    texts = ", ".join(f"`{name}` string" for name, _ in raw.layout)
    kinds = f"{texts}, _line string, _n_fields int, _irregular boolean, _part string, _rejected boolean"
    return spark.read.schema(kinds).parquet(folder)


def receive(spark: SparkSession, raw: RawFile, folder: str) -> Received:
    """One pass: rows and rejected lines to `folder`, apart (`_rejected=true`), with their counts."""
    metrics = {
        "rows": F.count_if(~F.col("_rejected")),
        "rejected_rows": F.count_if("_rejected"),
        "irregular_rows": F.count_if("_irregular"),
    }
    return Received(raw, folder, **observed_write(parse(spark, raw), folder, metrics, "_rejected"))


def receive_all(spark: SparkSession, files: list[RawFile], folder: str) -> list[Received]:
    """Every file into a folder of its own, side by side."""
    with ThreadPoolExecutor(max_workers=max(1, len(files))) as pool:
        return list(pool.map(lambda raw: receive(spark, raw, f"{folder}/{raw.table}"), files))


AUDIT = (
    "attempt string, table_name string, source_id string, source_path string, source_sha256 string, rows long, "
    "rejected_rows long, irregular_rows long, status string"
)


def audit(spark: SparkSession, received: list[Received], attempt: str, checksums: dict[str, str | None], received_at: Column | None = None) -> DataFrame:
    """One row per raw file of an attempt: what was observed, and FAIL where lines were rejected."""
    # one row per raw file
    rows = [
        (attempt, r.raw.table, r.raw.source_id, r.raw.path, checksums.get(r.raw.table), r.rows, r.rejected_rows, r.irregular_rows,
         "FAIL" if r.rejected_rows else "PASS") for r in received
    ]
    return spark.createDataFrame(rows, AUDIT).withColumn("received_at", F.current_timestamp() if received_at is None else received_at)
