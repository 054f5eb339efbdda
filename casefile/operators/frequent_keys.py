"""Attributes for rows of which a few keys hold many: the frequent keys are found and answered apart.

1. A bounded counter (`approx_top_k`) finds keys with at least a share of the rows. It reads the key column only
   and keeps a fixed number of items, whatever the number of keys.
2. Their dimension rows, at most `most`, are broadcast: a row with a frequent key gets its attributes there.
3. The rest is joined on the key. Rows that are answered already, and rows without a key, pass that join under keys
   that no dimension row has, dealt by their own values, so they spread evenly.

A row is answered by either way with the same attributes, so the result does not depend on what the counter
finds; only the balance does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def frequent_keys(df: DataFrame, key: str, share: float = 0.001, most: int = 1000, tracked: int = 20_000) -> list[str]:
    """Keys with about `share` of the rows that have one, or more, in order; at most `most` of them. Runs one job.

    The counter is off by a few parts in `tracked` of the rows. A key below the share stays in one partition
    of a join, so on more partitions than 1 / share lower it, and raise `most` and `tracked` with it.
    """
    counter = F.expr(f"approx_top_k(`{key}`, {most}, {tracked})")
    counted = df.where(F.col(key).isNotNull()).agg(counter.alias("top"), F.count("*").alias("n"))
    items = counted.select("n", F.explode("top").alias("found"))
    return sorted(r[0] for r in items.where(F.col("found.count") >= F.col("n") * share).select("found.item").collect())


def attach(df: DataFrame, dimension: DataFrame, key: str, columns, **counter) -> DataFrame:
    """`df` with the `columns` of its dimension row; NULL without one. `key` is text and unique in the dimension.

    `counter` is passed to `frequent_keys`. Columns of the dimension replace columns of the same name.
    """
    columns = list(columns)
    kept = [c for c in df.columns if c not in columns]
    frequent = frequent_keys(df, key, **counter)
    attributes = dimension.select(F.col(key).alias("_key"), F.struct(F.lit(True).alias("there"), *columns).alias("_far"))
    # one row for each frequent key, `most` at most, also for those that the dimension lacks
    listed = df.sparkSession.createDataFrame([(k,) for k in frequent], "_key string").withColumn("_listed", F.lit(True))
    near = attributes.where(F.col("_key").isin(frequent)).withColumnRenamed("_far", "_near")
    near = listed.join(F.broadcast(near), "_key", "left").withColumnRenamed("_key", "_frequent")
    flagged = df.select(*kept).join(F.broadcast(near), F.col(key) == F.col("_frequent"), "left")
    answered = F.col(key).isNull() | F.col("_listed").isNotNull()
    spread = F.concat(F.lit("#"), F.pmod(F.xxhash64(*kept), F.lit(65_536)).cast("string"))
    # texts that begin with # are no keys of the dimension there, whose keys begin with =
    dealt = flagged.withColumn("_key", F.when(answered, spread).otherwise(F.concat(F.lit("="), F.col(key))))
    far = attributes.withColumn("_key", F.concat(F.lit("="), F.col("_key")))
    found = F.coalesce("_near", "_far")
    return dealt.join(far, "_key", "left").select(*kept, *[found[c].alias(c) for c in columns])
