"""Deterministic duplicate removal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def row_digest(cols) -> Column:
    """SHA-256 over all the columns, each with its length in front so that no two rows share an encoding.

    Its 32 bytes, which come in the order of their hexadecimal text and are half as long.
    """
    parts = ", ".join(f"coalesce(concat(length(`{c}`), ':', `{c}`), '-')" for c in cols)
    return F.expr(f"unhex(sha2(concat({parts}), 256))")


def dedup_by_key(df: DataFrame, keys, order_by=None, digest_of=None) -> DataFrame:
    """Keep one row per key: the first in `order_by`, ties broken by the smallest row digest.

    Digests are compared by their first 16 bytes, which are in the order of the whole unless two different rows agree
    in 128 bits; only those are shuffled.
    The digest makes the survivor independent of file order and partitioning, and a query
    that needs few columns shuffles those and the digest instead of every column that
    would otherwise take part in a total order. Pass `digest_of=[]` when `order_by` is
    already total. Spark keeps the first row per key within
    each map task before the shuffle (WindowGroupLimit), so a key that holds a large share
    of the rows sends one row per task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    payload = [c for c in df.columns if c not in keys] if digest_of is None else digest_of
    ranked = df.withColumn("_digest", F.substring(row_digest(payload), 1, 16) if payload else F.lit(b""))
    order = [*(order_by or []), F.col("_digest")]
    survivors = Window.partitionBy(*keys).orderBy(*order)
    return (
        ranked.withColumn("_rank", F.row_number().over(survivors)).filter("_rank = 1").drop("_rank", "_digest")
    )


def dedup_rows(df: DataFrame) -> DataFrame:
    """Distinct whole rows."""
    return df.dropDuplicates()


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def distinct_row_count(df: DataFrame, cols=None) -> DataFrame:
    """One row: rows, distinct_rows, exact_duplicate_rows. Rows are compared by their 256-bit digest."""
    per_row = df.groupBy(row_digest(cols or df.columns).alias("digest")).agg(F.count("*").alias("n"))
    return per_row.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows"),
        F.count("*").alias("distinct_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("exact_duplicate_rows"),
    )
