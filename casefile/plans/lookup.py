"""Facts laid out so that one entity is found without reading the others.

A fact is written in ranges of its key, sorted, with Bloom filters on the key. Statistics of the row groups
then exclude all but those around a wanted key, and the filters most of those. An entity with very many rows
spans several ranges, because they are cut by key and record.

A lookup turns the wanted keys into conditions that reach the scan. More keys than `MOST_KEYS` are no lookup:
they are joined, and Spark chooses how.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keys that become conditions of the scan, each tested against every row group's statistics.
MOST_KEYS = 64


@dataclass(frozen=True)
class Layout:
    """How a table is written for lookups. `files`: None leaves their number to Spark, by size."""

    key: str = "vehicle_key"
    group_bytes: int = 16 << 20
    files: int | None = None


def write_clustered(df: DataFrame, path: str, record: str, layout: Layout = Layout(), made: dict[str, Column] | None = None) -> None:
    """Replace a Parquet table by the frame, clustered by the key and, within it, by `record`.

    Rows without a key come first; they are cut by record as well. `made` are columns as functions of the others,
    such as digests: they decide about a row's range, but are not shuffled, and are made again where it is written.
    """
    number, made = [layout.files] if layout.files else [], made or {}
    order = [made.get(c, F.col(c)) for c in (layout.key, record)]
    ranges = df.drop(*made).repartitionByRange(*number, *order).withColumns(made).select(*df.columns)
    ranges = ranges.sortWithinPartitions(layout.key, record)
    options = {
        # half of a digest's letters is no information, which only zstd finds
        "compression": "zstd",
        "parquet.block.size": str(layout.group_bytes),
        # of a dictionary-encoded column no filter is written
        f"parquet.enable.dictionary#{layout.key}": "false",
        f"parquet.bloom.filter.enabled#{layout.key}": "true",
        "parquet.bloom.filter.adaptive.enabled": "true",
    }
    ranges.write.options(**options).mode("overwrite").parquet(path)


def listed(chosen: DataFrame, key: str = "vehicle_key") -> list[str] | None:
    """The keys of a frame if they are few enough to look up, else None. At most MOST_KEYS + 1 rows reach the driver."""
    keys = [r[0] for r in chosen.select(key).where(F.col(key).isNotNull()).distinct().limit(MOST_KEYS + 1).collect()]
    return sorted(keys) if len(keys) <= MOST_KEYS else None


def is_any(key: str, keys: list[str]) -> Column:
    """The key is one of few: equalities, which the scan takes one by one however many there are."""
    return reduce(or_, [F.col(key) == k for k in keys], F.lit(False))


def of_entities(df: DataFrame, keys: list[str] | DataFrame, key: str = "vehicle_key") -> DataFrame:
    """Rows of the entities: by conditions for a list, by a join for a frame of keys."""
    if isinstance(keys, DataFrame):
        return df.join(keys.select(key).distinct(), key, "left_semi")
    return df.where(is_any(key, keys))


# Fact in the model -> its table and the column that tells its records apart.
CLUSTERED = {
    "complaint": ("gold_fact_complaint", "complaint_record_id"),
    "recall": ("gold_fact_recall", "recall_record_id"),
    "investigation": ("gold_fact_investigation", "investigation_record_key"),
    "communication": ("gold_fact_manufacturer_communication", "communication_record_key"),
    "ncap": ("gold_fact_ncap_variant", "ncap_variant_key"),
    "fuel": ("gold_fact_fuel_economy_variant", "epa_vehicle_id"),
}


def facts(spark: SparkSession, gold: str) -> dict[str, DataFrame]:
    """The written facts of a gold folder, by their names in the model."""
    return {name: spark.read.parquet(f"{gold}/{table}") for name, (table, _) in CLUSTERED.items()}
