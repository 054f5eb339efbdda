"""Where two tables differ: fingerprints of key buckets in a tree, then rows of unequal buckets only.

Rows fall into buckets by a hash of their key. A bucket's fingerprint is its number of rows and two sums over
its rows' hashes, whatever their order. Sixteen buckets make one of the next level, up to a single root. The
comparison goes down from the root, through unequal nodes only; rows of leaves that differ are joined key by
key. Equal tables move one row a bucket, and a handful of differences as many buckets' rows as there are
differences.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casefile.session import scratch_path

FAN_OUT = 16


@dataclass(frozen=True)
class TreePlan:
    levels: int = 3  # below the root: 16 ** levels buckets
    digits: int = 9  # to which fractions are compared

    @property
    def buckets(self) -> int:
        return FAN_OUT**self.levels


def _text(df: DataFrame, name: str, plan: TreePlan) -> Column:
    """A value as it is compared and shown; null stays null."""
    kind = dict(df.dtypes)[name]
    value = F.round(F.col(name), plan.digits) + F.lit(0.0) if kind in ("double", "float") else F.col(name)
    return value.cast("string")


def _bucket(key: str, plan: TreePlan) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(plan.buckets)).cast("int")


def leaves(df: DataFrame, key: str, columns, plan: TreePlan = TreePlan()) -> DataFrame:
    """bucket, n, mixed, total: one row for each bucket that has rows."""
    values = [F.coalesce(F.concat(F.lit("="), _text(df, c, plan)), F.lit("null")) for c in [key, *columns]]
    rows = df.select(_bucket(key, plan).alias("bucket"), F.xxhash64(*values).alias("a"), F.xxhash64(F.lit(1), *values).alias("b"))
    return rows.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor("a").alias("mixed"), F.sum(F.col("b").cast("decimal(20,0)")).alias("total")
    )


def upper(nodes: DataFrame) -> DataFrame:
    """The next level of a tree: sixteen nodes make one."""
    return nodes.groupBy(F.expr(f"bucket DIV {FAN_OUT}").cast("int").alias("bucket")).agg(
        F.sum("n").alias("n"), F.bit_xor("mixed").alias("mixed"), F.sum(F.col("total").cast("decimal(28,0)")).alias("total")
    )


def tree(bottom: DataFrame, plan: TreePlan = TreePlan()) -> list[DataFrame]:
    """Levels from the root down to the leaves."""
    return list(reversed(reduce(lambda done, _: [*done, upper(done[-1])], range(plan.levels), [bottom])))


def unequal_buckets(mine: list[DataFrame], theirs: list[DataFrame]) -> list[int]:
    """Leaves that differ; a level is looked at only below nodes that differ above.

    At most the plan's number of buckets, as numbers, reach the driver; of equal trees the root's comparison only.
    """
    suspects: list[int] | None = None
    for a, b in zip(mine, theirs, strict=True):
        if suspects is not None:
            below = F.col("bucket").isin([FAN_OUT * node + i for node in suspects for i in range(FAN_OUT)])
            a, b = a.filter(below), b.filter(below)
        both = a.join(b.toDF("bucket", "n_", "mixed_", "total_"), "bucket", "full")
        same = F.col("n").eqNullSafe(F.col("n_")) & F.col("mixed").eqNullSafe(F.col("mixed_")) & F.col("total").eqNullSafe(F.col("total_"))
        suspects = sorted(r[0] for r in both.filter(~same).select("bucket").collect())
        if not suspects:
            break
    return suspects or []


def differences(actual: DataFrame, expected: DataFrame, key: str, columns=None, plan: TreePlan = TreePlan()) -> DataFrame:
    """(key, column, actual_value, expected_value) of every value that differs, as text.

    A key that one side lacks has one row, with the column `(row)` and `missing` or `present` as values.
    Both sides have at most one row a key; `columns` are all that both have, unless given. The leaves of both
    sides are written to the shared folder and compared at once.
    """
    spark = actual.sparkSession
    columns = [c for c in (columns or actual.columns) if c in expected.columns and c != key]

    def stored(df: DataFrame) -> list[DataFrame]:
        path = scratch_path(spark, "fingerprints")
        bottom = leaves(df, key, columns, plan)
        bottom.write.parquet(path)  # one short row a bucket
        return tree(spark.read.schema(bottom.schema).parquet(path), plan)

    buckets = unequal_buckets(stored(actual), stored(expected))

    def chosen(df: DataFrame, prefix: str) -> DataFrame:
        rows = df.filter(_bucket(key, plan).isin(buckets)) if buckets else df.limit(0)
        return rows.select(key, F.lit(True).alias(f"{prefix}_here"), *[_text(df, c, plan).alias(f"{prefix}_{c}") for c in columns])

    both = chosen(actual, "a").join(chosen(expected, "e"), key, "full")
    here = lambda prefix: F.when(F.col(f"{prefix}_here"), "present").otherwise("missing")
    one = F.struct(F.lit("(row)").alias("column"), here("a").alias("actual_value"), here("e").alias("expected_value"))
    each = [
        F.when(
            ~F.col(f"a_{c}").eqNullSafe(F.col(f"e_{c}")),
            F.struct(F.lit(c).alias("column"), F.col(f"a_{c}").alias("actual_value"), F.col(f"e_{c}").alias("expected_value")),
        )
        for c in columns
    ]
    lacking = F.col("a_here").isNull() | F.col("e_here").isNull()
    found = F.when(lacking, F.array(one)).otherwise(F.array_compact(F.array(*each)))
    return both.select(key, F.explode(found).alias("d")).select(key, "d.*")
