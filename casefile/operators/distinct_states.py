"""Distinct counts that add up: stored, merged, and rolled up to any coarser context.

1. Every business id gets a number once. Numbers are dense in runs, so 32,768 consecutive ones are a bucket.
   Ids of a later batch get numbers beyond those of earlier ones.
2. A state is the set of ids seen in a context, as one bitmap for each bucket: (context, bucket, bits), with
   more bitmaps for ids seen under a condition. Ids spread over buckets, so no row holds all of them, and a
   row has a fixed size.
3. States of batches, and of finer contexts, merge by OR of equal buckets. A count is the sum of set bits
   over the buckets of a context, exactly the number of distinct ids.

Rows with bitmaps are large and mostly zeros, so they are few where a task holds several: ids are gathered before
a bitmap is made of them, and bitmaps meet in partitions of whole buckets whose number follows their size in
memory (Spark's own follows their compressed size).

A missing id counts as one value, as in `measures`.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casefile.sources import writers

MISSING = -1  # number of the missing id; others are from 0
BITMAP_BYTES = 4096
#: Bytes of bitmaps that a partition holds on average.
PARTITION_BYTES = 8 << 20


@dataclass(frozen=True)
class DistinctState:
    """What is counted: the id, and names with conditions under which an id counts as well."""

    name: str
    id_col: str
    flags: dict[str, str] = field(default_factory=dict)

    @property
    def counts(self) -> list[str]:
        return [self.name, *self.flags]


def number_ids(df: DataFrame, id_col: str, path: str, known: DataFrame | None = None, near: Column | None = None) -> DataFrame:
    """(id, number) of the ids that `known` lacks, written to `path`; returned with the known ones.

    Numbers follow each other within a task. They are given once, when they are written. Ids with close values of
    `near`, a number, get close numbers: the ids of a context that bears on it then share few buckets.
    """
    ids = df.select(F.col(id_col).alias("id"), *([] if near is None else [near.alias("near")])).where("id IS NOT NULL")
    new = ids.distinct() if near is None else ids.groupBy("id").agg(F.min("near").alias("near"))
    first = 0
    if known is not None:
        new = new.join(known, "id", "left_anti")
        largest = known.agg(F.max("number")).first()[0]
        first = 0 if largest is None else largest + 1
    if near is not None:
        new = new.repartitionByRange("near", "id").sortWithinPartitions("near", "id")
    # a new run of numbers starts a bucket, so that batches written apart do not share one
    first = -(-first // 32_768) * 32_768
    writers.replace(new.select("id", (F.monotonically_increasing_id() + first).alias("number")), path)
    written = df.sparkSession.read.parquet(path)
    return written if known is None else known.unionByName(written)


def states(df: DataFrame, numbers: DataFrame, state: DistinctState, context) -> DataFrame:
    """context, bucket, and a bitmap `bits_<name>` for the ids and for each condition."""
    context = list(context)
    flags = [F.coalesce(F.expr(condition), F.lit(False)).alias(f"is_{name}") for name, condition in state.flags.items()]
    rows = df.select(*context, F.col(state.id_col).alias("id"), *flags)
    # one row for each id of a context meets the numbers, and rows without an id none of them
    rows = rows.groupBy(*context, "id").agg(F.lit(True).alias(f"is_{state.name}"), *[F.max(f"is_{n}").alias(f"is_{n}") for n in state.flags])
    numbered = rows.where("id IS NOT NULL").join(numbers, "id").drop("id")
    missing = rows.where("id IS NULL").drop("id").withColumn("number", F.lit(MISSING).cast("bigint"))
    every = numbered.unionByName(missing).withColumn("bucket", F.bitmap_bucket_number("number"))
    bits = [
        F.bitmap_construct_agg(F.when(F.col(f"is_{n}"), F.bitmap_bit_position("number"))).alias(f"bits_{n}") for n in state.counts
    ]
    # numbers are shuffled, not bitmaps of one number each; a group has at most as many as a bucket
    return every.repartition(*context, "bucket").groupBy(*context, "bucket").agg(*bits)


def _by_bucket(stored: DataFrame, state: DistinctState) -> DataFrame:
    size = stored.count() * BITMAP_BYTES * len(state.counts)
    return stored.repartition(1 + size // PARTITION_BYTES, "bucket")


def merged(parts: list[DataFrame], state: DistinctState, context) -> DataFrame:
    """One state of several, of batches or of finer contexts, at a context all of them have.

    The parts' rows are counted first, which of written ones reads no row.
    """
    every = reduce(DataFrame.unionByName, [p.select(*context, "bucket", *[f"bits_{n}" for n in state.counts]) for p in parts])
    return _by_bucket(every, state).groupBy(*context, "bucket").agg(*[F.bitmap_or_agg(f"bits_{n}").alias(f"bits_{n}") for n in state.counts])


def counts(stored: DataFrame, state: DistinctState, contexts: list[list[str]]) -> DataFrame:
    """Distinct ids by each of the contexts, whose columns the state has, with `grouping_id`; one scan of the states.

    What grouping sets multiply are rows of the state, never ids. A column that a context lacks is NULL.
    """
    columns = list(dict.fromkeys(c for own in contexts for c in own))
    kinds = dict(stored.dtypes)
    # as Spark numbers grouping sets: a bit for each column that a set lacks, the last column lowest
    sets = [
        F.struct(
            *[(F.col(c) if c in own else F.lit(None).cast(kinds[c])).alias(c) for c in columns],
            F.lit(sum(1 << i for i, c in enumerate(reversed(columns)) if c not in own)).cast("bigint").alias("grouping_id"),
        )
        for own in contexts
    ]
    bits = [F.bitmap_or_agg(f"bits_{n}").alias(f"bits_{n}") for n in state.counts]
    merging = stored.groupBy("bucket", *columns).agg(*bits)  # to the finest of the contexts first
    # the bucket stays as it is, so merged states are grouped where they are
    listed = merging.select("bucket", *[f"bits_{n}" for n in state.counts], F.explode(F.array(*sets)).alias("own"))
    by_set = listed.select("*", "own.*").groupBy("bucket", *columns, "grouping_id").agg(*bits)
    totals = [F.sum(F.bitmap_count(f"bits_{n}")).cast("bigint").alias(n) for n in state.counts]
    return by_set.groupBy(*columns, "grouping_id").agg(*totals)
