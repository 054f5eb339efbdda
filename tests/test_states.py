"""States that merge: quantile sketches, profiles; frequent keys joined apart; what gates would do; months without events."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from casefile.operators import distinct_states, frequent_keys, measures, profile_states, profiling, quality, quantile_states
from casefile.operators.mart import median_by
from casefile.plans import reports
from casefile.sources import writers
from workload import queries

SF_DIR = "/root/testdata/sf0.001"

# --- medians ---------------------------------------------------------------------------------

SMALL = quantile_states.QuantileState({"med": "x", "none": "y"}, k=200)


def measured(spark, n=40_000):
    # a third of the rows in one group, missing and repeated values
    return spark.range(n, numPartitions=6).selectExpr(
        "IF(id % 3 = 0, 'hot', IF(id % 7 = 0, NULL, concat('g', id % 5))) AS g",
        "id % 12 AS month",
        "IF(id % 11 = 0, NULL, (id * 7919) % 9001) AS x",
        "CAST(NULL AS INT) AS y",
    )


def stored_sketches(spark, tmp_path, df, state, context, n_batches):
    parts = []
    for batch in range(n_batches):
        path = str(tmp_path / f"sketches-{batch}")
        writers.replace(quantile_states.states(df.where(f"pmod(xxhash64(x, month), {n_batches}) = {batch}"), state, context), path)
        parts.append(spark.read.parquet(path))
    return quantile_states.merged(parts, state, context)


def test_merged_medians_are_within_the_stated_rank_error(spark, tmp_path):
    df = measured(spark)
    stored = stored_sketches(spark, tmp_path, df, SMALL, ["g", "month"], 3)
    rolled = quantile_states.medians(quantile_states.rolled_up(stored, SMALL, [["g"], ["month"], []]), SMALL)
    writers.replace(rolled, str(tmp_path / "medians"))
    rolled = spark.read.parquet(str(tmp_path / "medians"))
    for number, context in ((0b01, ["g"]), (0b10, ["month"]), (0b11, [])):
        found = quantile_states.rank_errors(rolled.where(F.col("grouping_id") == number), df, SMALL, context).collect()
        expected = {tuple(r)[:-1]: r["count"] for r in df.where("x IS NOT NULL").groupBy(*context).count().collect()}
        assert {tuple(r)[: len(context)]: r["n"] for r in found} == expected
        assert max(r["error"] for r in found) <= quantile_states.rank_error(SMALL.k)
        # and n of the sketches themselves
        assert {tuple(r[c] for c in context): r["n_med"] for r in rolled.where(F.col("grouping_id") == number).collect()} == expected
    assert rolled.where("none IS NOT NULL OR n_none > 0").count() == 0


def test_small_groups_have_exact_lower_medians(spark, tmp_path):
    rng = random.Random(3)
    rows = [(rng.choice("abc"), m, rng.choice([None, *range(20)]), None) for m in range(4) for _ in range(rng.randrange(1, 40))]
    df = spark.createDataFrame(rows, "g string, month int, x int, y int")
    stored = stored_sketches(spark, tmp_path, df, SMALL, ["g", "month"], 2)
    found = quantile_states.medians(quantile_states.rolled_up(stored, SMALL, [["g"]]), SMALL).collect()
    values = {g: [r[2] for r in rows if r[0] == g and r[2] is not None] for g in "abc"}
    assert {r["g"]: r["med"] for r in found} == {g: statistics.median_low(v) for g, v in values.items()}
    exact = {r["g"]: r["med"] for r in median_by(df, ["g"], {"med": "x"}).collect()}
    assert exact == {g: statistics.median(v) for g, v in values.items()}


def test_rank_errors_tell_a_wrong_median(spark):
    df = spark.range(100).selectExpr("'a' AS g", "id AS x", "CAST(NULL AS INT) AS y")
    wrong = spark.createDataFrame([("a", 80.0, None)], "g string, med double, none double")
    (row,) = quantile_states.rank_errors(wrong, df, SMALL, ["g"]).collect()
    assert row["error"] == pytest.approx(0.3)
    right = spark.createDataFrame([("a", 49.0, None)], "g string, med double, none double")
    assert quantile_states.rank_errors(right, df, SMALL, ["g"]).first()["error"] == 0


def test_sketches_of_nothing(spark):
    empty = measured(spark).limit(0)
    stored = quantile_states.states(empty, SMALL, ["g", "month"])
    assert quantile_states.medians(quantile_states.rolled_up(stored, SMALL, [["g"]]), SMALL).collect() == []
    assert tuple(quantile_states.medians(quantile_states.states(empty, SMALL, []), SMALL).first()) == (None, 0, None, 0)
    with pytest.raises(ValueError):
        quantile_states.QuantileState({"m": "x"}, k=4)


# --- profiles --------------------------------------------------------------------------------

SPEC = profiling.ProfileSpec("src", "id", "day", "make", "model", "year", "product")
EXACT = tuple(profile_states.KINDS)
SHAPE = "id string, day string, make string, model string, year string, product string"


def landed(spark, n, seed):
    rng = random.Random(seed)
    rows = [
        (
            rng.choice(["", " ", None, *map(str, range(60))]),
            rng.choice(["20250103", "2025-02-30x", "19990101", "", None]),
            rng.choice(["Ford", "Škoda", "skoda", "", None]),
            rng.choice(["A", "B 1", "b-1", None]),
            rng.choice(["2001", "1850", "x", "", None]),
            rng.choice(["V", "v ", "T", None]),
        )
        for _ in range(n)
    ]
    return spark.createDataFrame(rows, SHAPE)


def test_profile_of_batches_equals_the_profile_of_all_rows(spark, tmp_path):
    store = str(tmp_path / "store")
    frames = [landed(spark, 400, 1), landed(spark, 300, 2), landed(spark, 0, 3), landed(spark, 50, 1)]  # the last repeats rows
    for i, df in enumerate(frames):
        profile_states.add_batch(df, SPEC, store, f"0{i}", malformed_rows=i, exact=EXACT)
    assert profile_states.batches(spark, store) == ["00", "01", "02", "03"]
    for chosen in ([0, 1, 2, 3], [0, 3], [1], [2]):
        together = frames[chosen[0]]
        for i in chosen[1:]:
            together = together.unionByName(frames[i])
        bad = spark.range(sum(chosen)) if sum(chosen) else None
        expected = profiling.profile(together, SPEC, bad)
        found = profile_states.profile_of(spark, SPEC, store, [f"0{i}" for i in chosen], exact=EXACT)
        assert found.columns == expected.columns and found.dtypes == expected.dtypes
        assert found.collect() == expected.collect()
    assert profile_states.profile_of(spark, SPEC, store, exact=EXACT).first()["rows"] == 756


def test_sketched_profile_is_within_the_stated_error(spark, tmp_path):
    store = str(tmp_path / "store")
    many = spark.range(120_000).selectExpr(
        "string(id DIV 2) AS id", "'20250103' AS day", "concat('m', id % 9000) AS make", "'x' AS model", "'2001' AS year", "'V' AS product"
    )
    for batch in (0, 1):  # batches share ids and identities
        profile_states.add_batch(many.where(f"id % 5 {'<' if batch else '>='} 2"), SPEC, store, str(batch))
    exact = profiling.profile(many, SPEC).first()
    found = profile_states.profile_of(spark, SPEC, store).first()
    limit = profile_states.hll_error()
    for name in ("distinct_business_ids", "distinct_normalized_vehicle_keys"):
        assert abs(found[name] - exact[name]) <= limit * exact[name]
    assert abs(found["exact_duplicate_rows"] - exact["exact_duplicate_rows"]) <= limit * exact["rows"]
    assert found["rows"] == exact["rows"] and found["vehicle_rows"] == exact["vehicle_rows"]


def test_a_batch_is_added_once_and_a_cut_off_one_again(spark, tmp_path):
    store, one, two = str(tmp_path / "store"), landed(spark, 100, 1), landed(spark, 100, 2)
    profile_states.add_batch(one, SPEC, store, "1", exact=EXACT)
    with pytest.raises(ValueError, match="already"):
        profile_states.add_batch(one, SPEC, store, "1", exact=EXACT)
    # numbers and bits of a batch whose counts were not written any more
    profile_states.add_batch(two, SPEC, str(tmp_path / "other"), "2", exact=EXACT)
    for part in ("numbers", "bits"):
        for kind in EXACT:
            cut = spark.read.parquet(str(tmp_path / f"other/{part}/{kind}/batch=at-2"))
            writers.replace(cut, f"{store}/{part}/{kind}/batch=at-2")
    assert profile_states.batches(spark, store) == ["1"]
    profile_states.add_batch(two, SPEC, store, "2", exact=EXACT)
    both = profile_states.profile_of(spark, SPEC, store, exact=EXACT).collect()
    assert both == profiling.profile(one.unionByName(two), SPEC).collect()
    with pytest.raises(ValueError, match="none of the batches"):
        profile_states.profile_of(spark, SPEC, store, ["9"])
    with pytest.raises(ValueError, match="no batch"):
        profile_states.profile_of(spark, SPEC, str(tmp_path / "nowhere"))
    with pytest.raises(ValueError, match="named"):
        profile_states.add_batch(two, SPEC, store, "a/b")


def test_rows_of_a_batch_are_read_once_for_all_kinds(spark, tmp_path, monkeypatch):
    calls, rows = [], profile_states._rows
    monkeypatch.setattr(profile_states, "_rows", lambda df, spec: calls.append(1) or rows(df, spec))
    profile_states.add_batch(landed(spark, 50, 1), SPEC, str(tmp_path / "store"), "1", exact=EXACT)
    assert len(calls) == 1


def test_profile_states_without_identity(spark, tmp_path):
    spec, store = profiling.ProfileSpec("src", "id", year="year"), str(tmp_path / "store")
    df = landed(spark, 80, 5).select("id", "year")
    profile_states.add_batch(df, spec, store, "1", exact=EXACT)
    assert profile_states.profile_of(spark, spec, store, exact=EXACT).collect() == profiling.profile(df, spec).collect()


# --- distinct counts -------------------------------------------------------------------------


def test_bitmaps_are_few_and_meet_in_partitions_of_buckets(spark, tmp_path):
    """Ids of a month share buckets, no bitmap of a single id is shuffled, and contexts are counted where buckets lie."""
    state = distinct_states.DistinctState("n", "id", {"odd": "id % 2 = 1"})
    rows = spark.range(400_000, numPartitions=4).selectExpr("id", "CAST(pmod(xxhash64(id), 40) AS INT) AS month", "id % 3 AS k")
    numbers = distinct_states.number_ids(rows, "id", str(tmp_path / "numbers"), near=F.col("month"))
    stored = distinct_states.states(rows, numbers, state, ["month"])
    text = stored._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_construct_agg" not in text[text.index("REPARTITION_BY_COL") :]
    writers.replace(stored, str(tmp_path / "states"))
    stored = spark.read.parquet(str(tmp_path / "states"))
    assert stored.count() <= 2 * 40 + numbers.select(F.bitmap_bucket_number("number")).distinct().count()
    merged = distinct_states.merged([stored], state, ["month"])
    found = distinct_states.counts(merged, state, [["month"], []])
    text = found._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange ") <= 2  # buckets, then counts
    counted = {r["month"]: (r["n"], r["odd"]) for r in found.where("grouping_id = 0").collect()}
    expected = rows.groupBy("month").agg(F.count("*"), F.expr("count_if(id % 2 = 1)")).collect()
    assert counted == {r[0]: (r[1], r[2]) for r in expected}
    assert [tuple(r) for r in found.where("grouping_id = 1").collect()] == [(None, 1, 400_000, 200_000)]


# --- frequent keys ---------------------------------------------------------------------------


def skewed(spark, n=300_000):
    # a third on one key, a sixth on one that the dimension lacks, a sixth without a key
    return spark.range(n, numPartitions=8).selectExpr(
        "CASE id % 6 WHEN 0 THEN 'hot' WHEN 3 THEN 'hot' WHEN 1 THEN NULL WHEN 2 THEN 'gone' ELSE concat('k', id % 20011) END AS key", "id"
    )


def dimension(spark):
    rows = spark.range(20_000).selectExpr("concat('k', id) AS key", "id % 9 AS a", "IF(id % 4 = 0, NULL, 'b') AS b")
    return rows.unionByName(spark.createDataFrame([("hot", 5, None), ("#1", 6, "x"), ("=k1", 7, "y")], rows.schema))


@pytest.fixture
def no_broadcast(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def test_frequent_keys_are_found(spark):
    assert frequent_keys.frequent_keys(skewed(spark), "key", share=0.01) == ["gone", "hot"]
    assert frequent_keys.frequent_keys(skewed(spark).limit(0), "key") == []
    assert len(frequent_keys.frequent_keys(skewed(spark), "key", share=0.0, most=7)) <= 7


@pytest.mark.parametrize("share", [0.0001, 0.01, 2.0])
def test_attributes_do_not_depend_on_what_is_frequent(spark, no_broadcast, share):
    rows = skewed(spark, 30_000).unionByName(spark.createDataFrame([("#1", -1), ("=k1", -2), ("", -3)], "key string, id long"))
    rows = rows.unionByName(rows.where("id < 100"))  # repeated rows stay
    found = frequent_keys.attach(rows.withColumn("a", F.lit("old")), dimension(spark), "key", ["a", "b"], share=share)
    expected = rows.join(dimension(spark), "key", "left").select(*found.columns)
    assert found.columns == ["key", "id", "a", "b"]
    assert found.exceptAll(expected).count() == 0 and expected.exceptAll(found).count() == 0


def test_no_task_reads_more_than_twice_the_median(spark, no_broadcast):
    """Under the default thresholds of adaptive splitting, with a third of the rows on one key."""

    def reads(df):
        return sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())

    rows, dim = skewed(spark), dimension(spark)
    plain = reads(rows.join(dim, "key", "left"))
    assert plain[-1] > 4 * statistics.median(plain)  # what is to be mended
    even = reads(frequent_keys.attach(rows, dim, "key", ["a"], share=0.01))
    assert sum(even) == 300_000 and even[-1] <= 2 * statistics.median(even)


# --- gates, months ---------------------------------------------------------------------------


def test_gate_outcomes(spark):
    checks = spark.createDataFrame([("b", False), ("a", None), ("c", True)], "check_name string, passed boolean")
    failed = ~F.col("passed")
    found = quality.gate_outcomes({"one": (checks, failed, "check_name"), "none": (checks.limit(0), failed, "check_name")}).collect()
    assert [tuple(r) for r in found] == [("one", 3, 2, "a, b", True), ("none", 0, 0, "", False)]


def test_months_without_events(spark):
    recall = spark.createDataFrame(
        [("c1", 20241115), ("c2", 20250220), ("c2", 20250221), (None, 20250222), ("c3", None)], "campaign_number string, report_received_date_key int"
    )
    model = {"recall": recall, "investigation": spark.createDataFrame([], "investigation_number string, opened_date_key int")}
    found = reports.trend_without_gaps(model, ("recalls", "investigations")).orderBy("year_month").collect()
    trend = {r["year_month"]: r["events"] for r in reports.trend_by_family(model, ("recalls", "investigations")).collect()}
    assert [tuple(r) for r in found] == [
        ("recalls", "2024-11", 1), ("recalls", "2024-12", 0), ("recalls", "2025-01", 0), ("recalls", "2025-02", trend["2025-02"]),
    ]


def test_measures_with_frequent_entities_apart(spark):
    """Under a filter, with several groupings, and for tables without entities."""
    model = queries.Model(spark, SF_DIR)
    names = ["complaint_reports", "recall_campaigns", "registration_records"]
    call = {"by": [["make"], []], "where_entity": "model_year > 2000 OR make IS NULL"}
    plain = measures.measures(names[:2], model, **call)
    apart = measures.measures(names[:2], model, frequent={"share": 0.05}, **call)
    assert sorted(map(str, apart.collect())) == sorted(map(str, plain.collect()))
    apart = measures.measures(names, model, by=["make"], frequent={})
    assert sorted(map(str, apart.collect())) == sorted(map(str, measures.measures(names, model, by=["make"]).collect()))
