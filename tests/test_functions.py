import datetime
import hashlib
import unicodedata
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from casefile import functions as fx


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        (None, ""),
        ("", ""),
        ("  Brand#17 ", "BRAND 17"),
        ("a--b__c", "A B C"),
        ("...", ""),
        ("Citroën C4", "CITRO N C4"),
        ("F-150\tXL", "F 150 XL"),
    ],
)
def test_normalize_text(one_row, text, expected):
    assert one_row(fx.normalize_text("x"), text) == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [("Citroën C4", "CITROEN C4"), ("ﬁat ½", "FIAT 1 2"), ("straße", "STRAE"), ("\U0001f110x", "A X"), (None, "")],
)
def test_fold_accents(one_row, text, expected):
    if text == "ﬁat ½":
        expected = "FIAT 12"  # the fraction slash has no ASCII form
    assert one_row(fx.normalize_text("x", fold_accents=True), text) == expected


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(max_size=30), min_size=20, max_size=40))
def test_fold_accents_equals_unicode_decomposition(spark, texts):
    texts = [t for t in texts if not any(0xD800 <= ord(c) <= 0xDFFF for c in t)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    got = {r["i"]: r["y"] for r in frame.select("i", fx.normalize_text("x", fold_accents=True).alias("y")).collect()}
    for i, text in enumerate(texts):
        plain = unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode()
        assert got[i] == " ".join(re.findall("[A-Z0-9]+", plain.upper()))


@pytest.mark.parametrize(
    ("text", "expected"),
    [("", None), (" 7 ", 7), ("5.7", None), ("1e3", None), ("N/A", None), ("99999999999", None), (None, None), ("-3", -3)],
)
def test_safe_int(one_row, text, expected):
    assert one_row(fx.safe_int("x"), text) == expected
    assert one_row(fx.safe_int("x", 0), text) == (expected or 0)


def test_safe_long_and_double(one_row):
    assert one_row(fx.safe_long("x"), "99999999999") == 99999999999
    assert one_row(fx.safe_double("x"), " 1.25 ") == 1.25
    assert one_row(fx.safe_double("x"), "1e3") == 1000.0
    assert [one_row(fx.safe_double("x"), t) for t in ("NaN", "1.5f", "n/a", "", None)] == [None] * 5


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("20250131", datetime.date(2025, 1, 31)),
        (" 20250131 ", datetime.date(2025, 1, 31)),
        ("20251301", None),
        ("20250230", None),
        ("2025010", None),
        ("120250101", None),
        ("", None),
        (None, None),
    ],
)
def test_yyyymmdd(one_row, text, expected):
    assert one_row(fx.yyyymmdd("x"), text) == expected


def test_date_key(one_row):
    assert one_row(fx.date_key(fx.yyyymmdd("x")), "20250131") == 20250131
    assert one_row(fx.date_key(fx.yyyymmdd("x")), "") is None


@pytest.mark.parametrize(
    ("text", "expected"),
    [("2025-01-31 12:00", "20250131"), ("2025013", None), ("18991231", None), ("21010101", None), (None, None)],
)
def test_first8_date(one_row, text, expected):
    assert one_row(fx.first8_date("x"), text) == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [(None, False), (" Y ", True), ("TRUE", True), ("yes", True), ("1", True), ("0", False), ("no", False), ("", False)],
)
def test_flag(one_row, text, expected):
    assert one_row(fx.flag("x"), text) is expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("ABSENT part", "BRAKES"),
        ("air-bag", "AIR_BAGS"),
        ("airbag on fire", "FIRE_OR_THERMAL"),
        ("seat belt", "OCCUPANT_RESTRAINT"),
        ("power-train", "POWERTRAIN"),
        ("", "OTHER"),
        (None, "OTHER"),
    ],
)
def test_topic(spark, one_row, text, expected):
    assert one_row(fx.topic(["x"]), text) == expected
    frame = spark.createDataFrame([(text,)], "x string")
    assert fx.with_topic(frame, ["x"]).first()["evidence_topic"] == expected


def test_record_key_keeps_positions(spark):
    frame = spark.createDataFrame([("A", None, "B"), ("A", "B", None)], "a string, b string, c string")
    keys = [r[0] for r in frame.select(fx.record_key("a", "b", "c")).collect()]
    assert keys == [hashlib.sha256(t).hexdigest() for t in (b"A||||B", b"A||B||")]


def test_entity_key(spark):
    frame = spark.createDataFrame(
        [("Ford", "F-150", " 2020 "), ("Ford", "...", "2020"), ("Ford", "F150", "9999"), ("Ford", "F150", None)],
        "make string, model string, year string",
    )
    keys = [r["vehicle_key"] for r in fx.with_entity_key(frame, "make", "model", "year").collect()]
    assert keys == [hashlib.sha256(b"FORD||F 150||2020").hexdigest(), None, None, None]


def test_labels(spark):
    frame = spark.createDataFrame([(3, 0, "HIGH"), (0, 0, "odd"), (None, 2, None)], "a int, b int, p string")
    rows = frame.select(
        fx.ratio("a", "b").alias("r"),
        fx.presence_count("a", "b").alias("n"),
        fx.label_rank("p", ("CRITICAL", "HIGH", "REVIEW", "MONITOR")).alias("k"),
        fx.title_label(F.lit("FIRE_OR_THERMAL")).alias("t"),
    ).collect()
    assert [tuple(r) for r in rows] == [
        (None, 1, 2, "Fire Or Thermal"),
        (None, 0, 4, "Fire Or Thermal"),
        (None, 1, 4, "Fire Or Thermal"),
    ]


def test_cast_columns(spark):
    frame = spark.createDataFrame([(" 7 ", "1.5f"), ("5.7", "2.5")], "n string, d string")
    rows = fx.cast_columns(frame, {"n": "int", "d": "double"}).collect()
    assert [(r["n_int"], r["d_decimal"]) for r in rows] == [(7, None), (None, 2.5)]
