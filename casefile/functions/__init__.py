"""Column expressions: every one is a built-in expression Spark evaluates in the JVM."""

from casefile.functions.keys import record_key, valid_identity, vehicle_key, with_entity_key
from casefile.functions.labels import label_rank, presence_count, ratio, title_label
from casefile.functions.text import blank_to_null, fold_to_ascii, normalize_text
from casefile.functions.topics import severity, topic, with_topic
from casefile.functions.typing import (
    cast_columns,
    date_key,
    first8_date,
    flag,
    safe_double,
    safe_int,
    safe_long,
    yyyymmdd,
)

__all__ = [
    "blank_to_null",
    "cast_columns",
    "date_key",
    "first8_date",
    "flag",
    "fold_to_ascii",
    "label_rank",
    "normalize_text",
    "presence_count",
    "ratio",
    "record_key",
    "safe_double",
    "safe_int",
    "safe_long",
    "severity",
    "title_label",
    "topic",
    "valid_identity",
    "vehicle_key",
    "with_entity_key",
    "with_topic",
    "yyyymmdd",
]
