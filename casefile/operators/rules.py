"""Ordered, explainable rules. One list gives both the priority and the reason."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casefile.settings import Settings


@dataclass(frozen=True)
class Rule:
    priority: str
    reason: str
    predicate: str  # a SQL condition over the mart's columns


def review_rules(settings: Settings = Settings()) -> list[Rule]:
    s = settings
    # Priorities and reason texts, first match wins.
    return [
        Rule("CRITICAL", "At least one do-not-drive recall campaign", "do_not_drive_campaigns > 0"),
        Rule("CRITICAL", "At least one park-outside recall campaign", "park_outside_campaigns > 0"),
        Rule("HIGH", "At least one open NHTSA investigation", "open_investigations > 0"),
        Rule(
            "HIGH",
            "Minimum-volume complaint signal with multiple severe reports",
            f"complaint_reports >= {s.high_complaints} AND severe_complaint_reports >= {s.high_severe}",
        ),
        Rule("REVIEW", "Recall campaign evidence exists", "recall_campaigns > 0"),
        Rule(
            "REVIEW",
            "Complaint reports meet review threshold",
            f"complaint_reports >= {s.review_complaints}",
        ),
        Rule(
            "REVIEW",
            "Manufacturer communication volume meets review threshold",
            f"manufacturer_documents >= {s.review_documents}",
        ),
    ]


REVIEW_DEFAULT = ("MONITOR", "No current rule crossed")


def alias_rules(settings: Settings = Settings()) -> list[Rule]:
    s = settings
    # Alias priorities and reason texts, first match wins.
    return [
        Rule(
            "NONE",
            "Exact EPA or NCAP reference match; no alias review required",
            "reference_exact_match_flag",
        ),
        Rule(
            "P0",
            "Unresolved identity with do-not-drive, park-outside, or open-investigation evidence",
            "do_not_drive_campaigns > 0 OR park_outside_campaigns > 0 OR open_investigations > 0",
        ),
        Rule(
            "P1",
            "Unresolved identity with multi-source or high-signal evidence",
            f"source_system_count >= {s.alias_sources} OR complaint_reports >= {s.high_complaints} "
            f"OR severe_complaint_reports >= {s.high_severe} OR recall_campaigns > 0 "
            f"OR manufacturer_documents >= {s.review_documents}",
        ),
    ]


ALIAS_DEFAULT = ("P2", "Unresolved low-signal identity; aggregate backlog only")


def _first_match(rules: list[Rule], pick, default: str) -> Column:
    first, *rest = rules
    chain = F.when(F.expr(first.predicate), pick(first))
    for rule in rest:
        chain = chain.when(F.expr(rule.predicate), pick(rule))
    return chain.otherwise(default)


def apply_rules(
    df: DataFrame, rules: list[Rule], default: tuple[str, str], out_priority: str, out_reason: str
) -> DataFrame:
    """Append the priority and the reason of the first rule that holds."""
    return df.withColumns(
        {
            out_priority: _first_match(rules, lambda r: r.priority, default[0]),
            out_reason: _first_match(rules, lambda r: r.reason, default[1]),
        }
    )


def with_review_rules(mart: DataFrame, settings: Settings = Settings()) -> DataFrame:
    reviewed = apply_rules(mart, review_rules(settings), REVIEW_DEFAULT, "review_priority", "review_reason")
    return apply_rules(reviewed, alias_rules(settings), ALIAS_DEFAULT, "alias_priority", "alias_reason")


# Ordered column names.
REVIEW_QUEUE_COLUMNS = [
    "vehicle_key", "vehicle_label", "review_priority", "review_reason", "complaint_reports",
    "severe_complaint_reports", "recall_campaigns", "do_not_drive_campaigns", "park_outside_campaigns",
    "open_investigations", "manufacturer_documents", "ncap_tested_variants", "epa_variants",
    "reference_exact_match_flag", "reference_year_eligible", "reference_match_status", "rule_version",
    "threshold_validation_status",
]

# Ordered column names.
ALIAS_QUEUE_COLUMNS = [
    "vehicle_key", "vehicle_label", "alias_priority", "alias_reason", "source_system_count",
    "complaint_reports", "severe_complaint_reports", "recall_campaigns", "do_not_drive_campaigns",
    "park_outside_campaigns", "open_investigations", "manufacturer_documents", "rule_version",
    "threshold_validation_status",
]


def review_queue(mart: DataFrame) -> DataFrame:
    return mart.filter(F.col("review_priority") != "MONITOR").select(*REVIEW_QUEUE_COLUMNS)


def alias_work_queue(mart: DataFrame) -> DataFrame:
    queued = (F.col("reference_match_status") == "UNRESOLVED") & F.col("alias_priority").isin("P0", "P1")
    return mart.filter(queued).select(*ALIAS_QUEUE_COLUMNS, F.lit("UNREVIEWED").alias("review_status"))
