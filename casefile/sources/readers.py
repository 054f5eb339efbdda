"""Readers. Schemas are always explicit: the header is compared, never trusted for types."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("project", T.StringType()),
        T.StructField("created_at_utc", T.StringType()),
        T.StructField("purpose", T.StringType()),
        T.StructField("privacy_policy", T.StringType()),
        T.StructField(
            "extracts",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("table_name", T.StringType()),
                        T.StructField("source_id", T.StringType()),
                        T.StructField("source_path", T.StringType()),
                        T.StructField("source_sha256", T.StringType()),
                        T.StructField("output_file", T.StringType()),
                        T.StructField("output_sha256", T.StringType()),
                        T.StructField("rows", T.LongType()),
                        T.StructField("columns", T.ArrayType(T.StringType())),
                        T.StructField("malformed_rows", T.LongType()),
                    ]
                )
            ),
        ),
    ]
)


def text_schema(columns) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


def _quoted(spark: SparkSession, sep: str = ",", multi_line: bool = False, mode: str = "FAILFAST"):
    # Spark splits plain files; pass multi_line=True for line breaks inside quotes, which
    # makes every file one task. Gzip files are one task each anyway.
    return spark.read.options(header=True, sep=sep, quote='"', escape='"', multiLine=multi_line, mode=mode)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table or view by name."""
    return spark.read.table(name)


def header_columns(spark: SparkSession, path, **options) -> list[str]:
    """Column names as the landed file spells them, in file order. Reads one header line."""
    return _quoted(spark, **options).option("inferSchema", False).csv(path).columns


def read_extract(spark: SparkSession, path, columns=None, **options) -> DataFrame:
    """Quoted CSV (gzip or plain; a file or a folder of parts) with a header, all columns text.

    With `columns` the header must spell exactly these names in this order; a part file
    that does not makes the read fail. Without it the file's own header gives the names.
    """
    names = columns or header_columns(spark, path, **options)
    return _quoted(spark, **options).schema(text_schema(names)).option("enforceSchema", False).csv(path)


def split_lines(spark: SparkSession, path, sep: str, encoding: str, *more) -> DataFrame:
    """Raw lines with their fields, and more columns of the scan. No quoting: a field is what lies between two separators.

    The text source keeps the bytes of a line as they are, so they can be decoded here; it
    splits plain files and, unlike the CSV source, does not drop blank lines.
    """
    line = F.decode(F.col("value").cast("binary"), encoding)
    return (
        spark.read.text(path).select(line.alias("line"), *more).withColumn("fields", F.split("line", f"\\Q{sep}\\E", -1))
    )


def read_positional(
    spark: SparkSession,
    path,
    layout: list[tuple[str, int]],
    n_fields: int,
    sep: str = "\t",
    encoding: str = "ISO-8859-1",
) -> tuple[DataFrame, DataFrame]:
    """Headerless, unquoted, delimited text by field position.

    Returns (good rows with the laid-out columns trimmed, rows whose field count is wrong
    as whole lines).
    """
    lines = split_lines(spark, path, sep, encoding)
    good = lines.filter(F.size("fields") == n_fields).selectExpr(
        *[f"trim(fields[{position}]) AS `{name}`" for name, position in layout]
    )
    return good, lines.filter(F.size("fields") != n_fields).select("line")


def count_fields(spark: SparkSession, path, n_fields: int, sep: str = "\t", encoding: str = "ISO-8859-1") -> DataFrame:
    """One row from one scan: rows, malformed_rows."""
    return split_lines(spark, path, sep, encoding).agg(
        F.count("*").alias("rows"), F.count_if(F.size("fields") != n_fields).alias("malformed_rows")
    )


def require_well_formed(malformed: DataFrame, source_id: str) -> None:
    """Refuse a raw file with any malformed row."""
    count = malformed.count()
    if count:
        raise ValueError(f"{source_id}: {count} malformed rows, extract not approved")


def named_rows(spark: SparkSession, path, layout, encoding: str, **options) -> DataFrame:
    """Rows of a file with a header, short and long rows included, which _irregular_ tells."""
    reader = _quoted(spark, mode="PERMISSIVE", **options).option("encoding", encoding)
    header = reader.csv(path).columns
    missing = [name for _, name in layout if name not in header]
    if missing:
        raise ValueError(f"missing expected fields: {missing}")
    schema = text_schema([*header, "_irregular_"])
    # a pruned line is not counted field by field, so every column is parsed
    return reader.schema(schema).options(columnNameOfCorruptRecord="_irregular_", columnPruning=False).csv(path)


def read_named(
    spark: SparkSession, path, layout: list[tuple[str, str]], encoding: str = "ISO-8859-1", **options
) -> DataFrame:
    """Quoted CSV by header name; layout is (output name, header name). A missing header raises.

    Trailing fields that a short row lacks are empty text; fields beyond the header are left out.
    `count_irregular` tells how many such rows there are.
    """
    return named_rows(spark, path, layout, encoding, **options).select(
        *[F.trim(F.coalesce(F.col(f"`{source}`"), F.lit(""))).alias(name) for name, source in layout]
    )


def count_irregular(
    spark: SparkSession, path, layout: list[tuple[str, str]], encoding: str = "ISO-8859-1", **options
) -> DataFrame:
    """One row: rows, irregular_rows (more or fewer fields than the header) of a file read by header name."""
    rows = named_rows(spark, path, layout, encoding, **options)
    # Spark answers no query on the column of irregular rows alone, so another column takes part
    parsed = F.pmod(F.xxhash64(F.col(f"`{layout[0][1]}`")), F.lit(2)) < 2
    irregular = F.col("_irregular_").isNotNull() & parsed
    return rows.agg(F.count("*").alias("rows"), F.count_if(irregular).alias("irregular_rows"))


def read_manifest(spark: SparkSession, path) -> DataFrame:
    """One row per extract of the nested manifest document."""
    document = spark.read.schema(MANIFEST_SCHEMA).option("multiLine", True).json(path)
    return document.select(F.explode("extracts").alias("extract")).select("extract.*")


#: Files from this size on are digested while they are read, not held in memory.
STREAMED_FROM = 64 << 20


def file_checksums(spark: SparkSession, path, streamed_from: int = STREAMED_FROM) -> DataFrame:
    """SHA-256 and size of every file under a path or glob, computed on the executors.

    Files below `streamed_from` bytes are hashed whole, by built-in functions. No built-in function digests a
    file in pieces, so larger ones pass through Python, a record batch at a time, whatever their size; without
    such files the plan has no Python. A file is one task, as SHA-256 is taken in order. A large file whose name has
    no suffix is hashed whole; above the binary source's 2 GB limit the read fails rather than pass unchecked.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    suffix = F.regexp_extract("_metadata.file_path", "[^/]([.][^./]+)$", 1)
    streamed = (F.col("_metadata.file_size") >= streamed_from) & (suffix != "")  # by metadata alone, so files are left out unread
    suffixes = [row[0] for row in files.where(streamed).select(suffix).distinct().collect()]  # kinds of files, not files
    shown = [F.element_at(F.split("path", "/"), -1).alias("file_name"), "path", "sha256", F.col("length").alias("bytes")]
    whole = files.where(~streamed).withColumn("sha256", F.sha2("content", 256)).select(*shown)
    if not suffixes:
        return whole
    found = reduce(DataFrame.unionByName, [_streamed_digests(spark, path, kind, streamed_from) for kind in suffixes])
    listed = files.where(streamed).select("path", "length", F.col("_metadata.file_path").alias("file_path"))
    lacking = F.raise_error(F.concat(F.lit("no checksum of "), "path")).cast("string")
    digested = listed.join(found, "file_path", "left").withColumn("sha256", F.coalesce("sha256", lacking))
    return whole.unionByName(digested.select(*shown))


def _streamed_digests(spark: SparkSession, path, suffix: str, least: int) -> DataFrame:
    """file_path, sha256 of the files with a suffix from a size on, by Spark's own readers and in bounded memory.

    The text source gives the bytes between line feeds as they are. Hadoop's codec that changes nothing keeps it from
    unpacking a file and from splitting it, so a task gets a whole file in order. Bounded is what lies between
    two line feeds, about 256 bytes in packed data, and the record batch.
    """
    # the option names of a Hadoop client whose classes are not relocated, and of Spark's, whose are
    raw = {
        "io.compression.codecs": "org.apache.hadoop.io.compress.PassthroughCodec",
        "io.compress.passthrough.extension": suffix,
        "org.apache.hadoop.shaded.io.compress.passthrough.extension": suffix,
    }
    chosen = F.col("_metadata.file_path").endswith(suffix) & (F.col("_metadata.file_size") >= least)
    lines = spark.read.options(recursiveFileLookup=True, lineSep="\n", **raw).text(path).where(chosen)

    # needs nothing of this package on the executors
    def digests(batches):
        import hashlib

        import pyarrow as pa

        mark = b"\xef\xbb\xbf"  # the source leaves it out at the start of a file

        def closed(name, size, plain, marked, count):
            """The digest for the bytes that the size says were there; never one of other bytes."""
            missing = size - count
            if missing in (1, 4):  # a line feed at the end
                plain.update(b"\n")
                marked.update(b"\n")
            if missing not in (0, 1, 3, 4):
                raise ValueError(f"{name}: {count} bytes were read of {size}")
            digest = (plain if missing < 2 else marked).hexdigest()
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([digest])], names=["file_path", "sha256"])

        name = None
        for batch in batches:
            names, start = batch.column(1), 0
            while start < batch.num_rows:
                own = names[start].as_py()
                end = batch.num_rows
                if names[end - 1].as_py() != own:
                    end = next(i for i in range(start, end) if names[i].as_py() != own)
                if own != name:
                    if name is not None:
                        yield closed(name, size, plain, marked, count)
                    name, size = own, batch.column(2)[start].as_py()
                    plain, marked, count = hashlib.sha256(), hashlib.sha256(mark), 0
                    piece = b""
                else:
                    piece = b"\n"
                piece += b"\n".join(batch.column(0).slice(start, end - start).to_pylist())
                plain.update(piece)
                marked.update(piece)
                count += len(piece)
                start = end
        if name is not None:
            yield closed(name, size, plain, marked, count)

    read = lines.select(F.col("value").cast("binary"), "_metadata.file_path", "_metadata.file_size")
    return read.mapInArrow(digests, "file_path string, sha256 string")
