"""Line dedup over levelled sorted runs of line hashes.

A run is a table (key hash, documents) bucketed and sorted by the hash, so merging two runs, or a batch
with a run, is a sort-merge join without a shuffle of the run. Every batch of documents is
merge-anti-joined with the runs of settled keys (already found in enough documents), and what is left
becomes a new run of level 0. When a level has `fan_in` runs they are compacted into one run of the
next level; keys that reach the threshold there settle. At the end one full compaction settles the
rest, and every line whose key has settled goes, in every document.

A key is hashed to 128 bits. Only hashes and counts are shuffled for the runs; texts are shuffled once,
by a hash of the text, to meet the hashes of their lines that go.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casefile.llm.common import bytes_of, carried_schema, map_arrow, record_batch, staged, with_columns
from casefile.session import scratch_path

WHITE = b" \t\n\x0b\x0c\r"
_KEY = "h1 long, h2 long"


def line_key(line: bytes) -> bytes:
    """The line without ASCII white space at both ends, A-Z in lower case (bytes.lower touches no others)."""
    return line.strip(WHITE).lower()


def key_hashes(text: bytes, min_chars: int) -> dict[bytes, None]:
    """Hashes of the text's distinct keys that are long enough."""
    keys = dict.fromkeys(map(line_key, text.split(b"\n")))
    if min_chars > 0:
        keys = [k for k in keys if len(k) >= min_chars and (min_chars == 1 or len(k.decode("utf-8", "replace")) >= min_chars)]
    return dict.fromkeys(xxhash.xxh3_128_digest(k) for k in keys)


def _pairs(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)


class LineRuns:
    """The levelled runs. `add` takes one batch of (h1, h2, n_docs), one row per key."""

    def __init__(self, spark: SparkSession, min_docs: int, fan_in: int = 2):
        self.spark, self.min_docs, self.fan_in = spark, min_docs, fan_in
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = [[]]
        self.settled: list[str] = []
        self.owned: list[str] = []

    def _write(self, df: DataFrame, kind: str) -> str:
        """A bucketed, sorted run in the shared folder."""
        name = f"line_{kind}_{uuid.uuid4().hex}"
        parts = df.repartition(self.buckets, "h1", "h2")
        writer = parts.write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").format("parquet")
        writer.option("path", scratch_path(self.spark, name)).saveAsTable(name)
        self.owned.append(name)
        return name

    def add(self, batch: DataFrame) -> None:
        for run in self.settled:
            batch = batch.join(self.spark.table(run).hint("merge"), ["h1", "h2"], "left_anti")
        self.levels[0].append(self._write(batch, "run"))
        level = 0
        while len(self.levels[level]) >= self.fan_in:
            self._compact(level)
            level += 1

    def _merged(self, names: list[str]) -> DataFrame:
        """Runs added up: full merge joins, one sorted run with the next."""
        total = self.spark.table(names[0])
        for name in names[1:]:
            other = self.spark.table(name).withColumnRenamed("n_docs", "more").hint("merge")
            both = total.join(other, ["h1", "h2"], "full")
            total = both.select("h1", "h2", (F.coalesce("n_docs", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("n_docs"))
        return total

    def _compact(self, level: int) -> None:
        merged = self.spark.table(self._write(self._merged(self.levels[level]), "merged"))
        self.settled.append(self._write(merged.where(F.col("n_docs") >= self.min_docs).select("h1", "h2"), "settled"))
        self.levels[level] = []
        if level + 1 == len(self.levels):
            self.levels.append([])
        self.levels[level + 1].append(self._write(merged.where(F.col("n_docs") < self.min_docs), "run"))

    def frequent(self) -> DataFrame:
        """Keys found in at least min_docs documents of all batches. A key settles once, so no key comes twice."""
        rest = [run for level in self.levels for run in level]
        found = [self.spark.table(name) for name in self.settled]
        if rest:
            found.append(self._merged(rest).where(F.col("n_docs") >= self.min_docs).select("h1", "h2"))
        result = found[0]
        for other in found[1:]:
            result = result.unionByName(other)
        return result


def _hash_rows(min_chars: int):
    """Rows (batch, d1, d2, h1, h2): the distinct line hashes of every text, beside the text's own."""
    schema = [("batch", pa.int32()), *((name, pa.int64()) for name in ("d1", "d2", "h1", "h2"))]

    def run(batches):
        for batch in batches:
            numbers, texts = batch.column(0).to_numpy(zero_copy_only=False), bytes_of(batch.column(1))
            hashes = [list(key_hashes(text, min_chars)) for text in texts]
            counts = [len(h) for h in hashes]
            keys = _pairs([h for own in hashes for h in own])
            of = np.repeat(_pairs([xxhash.xxh3_128_digest(t) for t in texts]), counts, axis=0)
            yield record_batch(schema, np.repeat(numbers, counts), of[:, 0], of[:, 1], keys[:, 0], keys[:, 1])

    return run


def _digest_rows(batches):
    schema = [("doc_id", pa.int64()), ("text", pa.string()), ("d1", pa.int64()), ("d2", pa.int64())]
    for batch in batches:
        own = _pairs([xxhash.xxh3_128_digest(t) for t in bytes_of(batch.column(1))])
        yield with_columns(record_batch(schema, batch.column(0), batch.column(1), own[:, 0], own[:, 1]), batch, 2)


def _drop_rows(min_chars: int):
    schema = [
        ("doc_id", pa.int64()),
        ("n_lines", pa.int64()),
        ("n_dropped", pa.int64()),
        ("kept", pa.string()),
        ("kept_sha256", pa.string()),
    ]

    def run(batches):
        for batch in batches:
            lines, dropped, kept = [], [], []
            for text, gone in zip(bytes_of(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                own = text.split(b"\n")
                left = own
                if gone:
                    gone = set(gone)
                    left = [x for x in own if xxhash.xxh3_128_digest(line_key(x)) not in gone]
                lines.append(len(own))
                dropped.append(len(own) - len(left))
                kept.append(b"\n".join(left))
            texts = pa.array(kept, pa.binary()).cast(pa.string())
            digests = [hashlib.sha256(k).hexdigest() for k in kept]
            yield with_columns(record_batch(schema, batch.column(0), lines, dropped, texts, digests), batch, 3)

    return run


def line_hashes(df: DataFrame, id_col="doc_id", text_col="text", min_chars: int = 1, batches: int = 4) -> DataFrame:
    """Staged rows (batch, d1, d2, h1, h2), written once and read for the counts and for the matches."""
    number = F.coalesce(F.pmod(F.xxhash64(F.col(id_col)), F.lit(batches)), F.lit(0)).cast("int")
    chosen = df.select(number.alias("batch"), F.col(text_col).cast("string").alias("text"))
    rows = map_arrow(chosen, _hash_rows(min_chars), "batch int, d1 long, d2 long, h1 long, h2 long")
    return staged(rows, "line-hashes", partition_by="batch")


def dedup_lines(
    df: DataFrame,
    id_col="doc_id",
    text_col="text",
    min_docs: int = 10,
    min_chars: int = 1,
    batches: int = 4,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept (text), kept_sha256 of every row, and the columns named in `carry`.

    A key found in at least `min_docs` rows loses all its lines in every row; the other lines stay,
    joined by a line break. Every row is a document: repeated rows count each. A null or empty text is
    one empty line; keys below `min_chars` code points never go, so blank lines stay. Null ids stay
    null; an empty table gives no rows; other columns are not read. Documents come in `batches` by a
    hash of their id; the result does not depend on the number.
    """
    spark = df.sparkSession
    hashes = line_hashes(df, id_col, text_col, min_chars, batches)
    runs = LineRuns(spark, min_docs)
    # Counted and written before the anti-join: Spark would otherwise move the join below the grouping and
    # shuffle every row of a line that very many documents share.
    counts = hashes.groupBy("batch", "h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"))
    counts = staged(counts, "line-counts", partition_by="batch")
    for number in range(batches):
        runs.add(counts.where(F.col("batch") == number).select("h1", "h2", "n_docs"))
    # Equal texts lose equal lines: a text with very many copies is one group here, and its set is made
    # from partial sets.
    going = hashes.join(runs.frequent(), ["h1", "h2"]).select(
        "d1", "d2", F.unhex(F.concat(_hex("h1"), _hex("h2"))).alias("h")
    )
    # Written before it meets the texts: a join in the stage of its grouping could not be split by Spark, and
    # the rows of a text with very many copies would meet in one task.
    going = staged(going.groupBy("d1", "d2").agg(F.collect_set("h").alias("gone")), "line-going")
    ids, texts = F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    marked_schema = carried_schema("doc_id long, text string, d1 long, d2 long", df, carry)
    marked = map_arrow(df.select(ids, texts, *carry), _digest_rows, marked_schema)
    matched = marked.join(going, ["d1", "d2"], "left").select("doc_id", "text", "gone", *carry)
    out = "doc_id long, n_lines long, n_dropped long, kept string, kept_sha256 string"
    return map_arrow(matched, _drop_rows(min_chars), carried_schema(out, df, carry))


def _hex(name: str):
    """The eight bytes of a long in memory order, as the digest has them (little-endian)."""
    big = F.lpad(F.hex(F.col(name)), 16, "0")
    return F.concat(*(F.substring(big, i, 2) for i in range(15, 0, -2)))
