"""Parameters and fixed labels shared by all jobs."""

from __future__ import annotations

from dataclasses import dataclass, field

# The labels of the six evidence sources, in reporting order.
SOURCE_SYSTEMS = {
    "complaints": "NHTSA_COMPLAINT",
    "recalls": "NHTSA_RECALL",
    "investigations": "NHTSA_INVESTIGATION",
    "communications": "NHTSA_MANUFACTURER_COMMUNICATION",
    "ratings": "NHTSA_NCAP",
    "variants": "EPA_FUEL_ECONOMY",
}

# The sources whose identities count as the reference.
REFERENCE_SYSTEMS = ("NHTSA_NCAP", "EPA_FUEL_ECONOMY")

# Fixed values: (pattern, topic), first match wins.
TOPIC_RULES = (
    ("FIRE|FLAME|THERMAL|BURN", "FIRE_OR_THERMAL"),
    ("BRAKE|ABS", "BRAKES"),
    ("AIR.?BAG|AIRBAG|SRS", "AIR_BAGS"),
    ("STEER", "STEERING"),
    ("ENGINE|POWER.?TRAIN|TRANSMISSION|PROPULSION", "POWERTRAIN"),
    ("ELECTRIC|BATTERY|WIRING|SOFTWARE|PROGRAM|CONTROL MODULE", "ELECTRICAL_OR_SOFTWARE"),
    ("TIRE|WHEEL", "TIRES_OR_WHEELS"),
    ("VISIBILITY|WINDSHIELD|WIPER|CAMERA", "VISIBILITY"),
    ("SEAT.?BELT|RESTRAINT", "OCCUPANT_RESTRAINT"),
)
DEFAULT_TOPIC = "OTHER"

IDENTITY_COLUMNS = ("normalized_make", "normalized_model", "model_year_int")
ENTITY_COLUMNS = ("vehicle_key", *IDENTITY_COLUMNS)


@dataclass(frozen=True)
class Settings:
    """Thresholds and labels of one run. Every number a rule uses lives here."""

    min_year: int = 1900
    max_year: int = 2027
    era_start: int = 1984
    rule_version: str = "portfolio_v1"
    threshold_status: str = "unvalidated"
    product_value: str = "V"
    topic_rules: tuple = TOPIC_RULES
    default_topic: str = DEFAULT_TOPIC
    source_systems: dict = field(default_factory=lambda: dict(SOURCE_SYSTEMS))
    reference_systems: tuple = REFERENCE_SYSTEMS
    high_complaints: int = 10
    high_severe: int = 3
    review_complaints: int = 5
    review_documents: int = 10
    alias_sources: int = 2
