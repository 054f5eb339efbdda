"""Explainable keyword topics and the severity flag."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casefile.functions.text import as_column
from casefile.settings import DEFAULT_TOPIC, TOPIC_RULES


def _matches(text: Column, pattern: str) -> Column:
    """Does the pattern occur? Alternatives that are plain words are searched as text, which
    is several times faster on long texts than a regular expression with the same words."""
    if re.search(r"[()\[\]\\]", pattern):
        return text.rlike(pattern)
    words = pattern.split("|")
    plain = [w for w in words if re.fullmatch("[A-Z0-9 ]+", w)]
    regular = [w for w in words if w not in plain]
    found = [text.contains(w) for w in plain] + ([text.rlike("|".join(regular))] if regular else [])
    return reduce(lambda a, b: a | b, found)


def _classify(text: Column, rules, default: str) -> Column:
    (pattern, label), *rest = rules
    chain = F.when(_matches(text, pattern), label)
    for pattern, label in rest:
        chain = chain.when(_matches(text, pattern), label)
    return chain.otherwise(default)


def _joined(cols) -> Column:
    return F.upper(F.concat_ws(" ", *[F.coalesce(as_column(c), F.lit("")) for c in cols]))


def topic(cols, rules=TOPIC_RULES, default: str = DEFAULT_TOPIC) -> Column:
    """First rule whose pattern occurs in the joined upper-case texts."""
    return _classify(_joined(cols), rules, default)


def with_topic(
    df: DataFrame, cols, rules=TOPIC_RULES, default: str = DEFAULT_TOPIC, name: str = "evidence_topic"
) -> DataFrame:
    """`topic` as a column; the texts are joined and upper-cased once, not once per rule."""
    return (
        df.withColumn("_topic_text", _joined(cols))
        .withColumn(name, _classify(F.col("_topic_text"), rules, default))
        .drop("_topic_text")
    )


def severity(crash: Column | str, fire: Column | str, injuries: Column | str, deaths: Column | str) -> Column:
    return as_column(crash) | as_column(fire) | (as_column(injuries) > 0) | (as_column(deaths) > 0)
