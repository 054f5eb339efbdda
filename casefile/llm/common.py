"""Helpers the operators share: reading, shipping this package to executors, staging, Arrow batches."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import casefile
from casefile.session import scratch_path

#: A word, wherever one is counted: everything between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: Bytes of a record batch that Spark hands to Python, which bounds what a worker holds at once.
BATCH_BYTES = "16m"


def ship(spark: SparkSession) -> None:
    """Bound record batches in this session, and give executors this package, as `--py-files` would, once per context.

    The archive (below 1 MB) is the driver's own upload copy; executors fetch it from Spark.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    context = spark.sparkContext
    if getattr(context, "_casefile_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(casefile.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="casefile-"), "casefile.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("casefile", os.path.relpath(path, root)))
    context.addPyFile(archive)
    context._casefile_shipped = True


def map_arrow(df: DataFrame, make: Callable, schema: str) -> DataFrame:
    """Run an iterator of record batches through `make`, on the executors. Spark bounds a batch by bytes."""
    ship(df.sparkSession)
    return df.mapInArrow(make, schema)


def staged(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write to the folder all executors share and read it back: a lost executor costs no recomputation from the start."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, n_rows: int, limit: int = 20_000) -> DataFrame:
    """Broadcast a frame of up to `limit` counted rows (about 100 bytes each); beyond, Spark chooses the join."""
    return F.broadcast(df) if n_rows <= limit else df


def texts_of(column: pa.Array) -> list[str]:
    """Python strings, null as empty text."""
    return ["" if x is None else x for x in column.to_pylist()]


def bytes_of(column: pa.Array) -> list[bytes]:
    """UTF-8 of a string column, null as empty text."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def slices(batch: pa.RecordBatch, column: int, limit: int = 4 << 20) -> Iterable[pa.RecordBatch]:
    """The batch in runs of rows with about `limit` bytes of text each; a longer text is a run of its own."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    start = size = 0
    for i, own in enumerate(sizes.tolist()):
        if size and size + own > limit:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += own
    if start < batch.num_rows or not batch.num_rows:
        yield batch.slice(start)


def list_array(values: np.ndarray, lengths: Iterable[int], kind: pa.DataType) -> pa.Array:
    """An Arrow list column from all values in a row and the length of each list."""
    offsets = np.concatenate([[0], np.cumsum(np.fromiter(lengths, dtype=np.int64))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def record_batch(schema: list[tuple[str, pa.DataType]], *columns) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, kind) for c, (_, kind) in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in schema])


def carried_schema(schema: str, df: DataFrame, carry: Iterable[str]) -> str:
    """The schema with the types of carried columns after it."""
    return ", ".join([schema, *(f"`{name}` {df.schema[name].dataType.simpleString()}" for name in carry)])


def with_columns(found: pa.RecordBatch, batch: pa.RecordBatch, start: int) -> pa.RecordBatch:
    """Results with the columns that a batch carries from position `start` on."""
    names = [*found.schema.names, *batch.schema.names[start:]]
    return pa.RecordBatch.from_arrays([*found.columns, *batch.columns[start:]], names=names)
