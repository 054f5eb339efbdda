"""Facts laid out for lookups, and distinct counts that add up."""

import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from casefile.operators import distinct_states, fingerprints, measures
from casefile.plans import lookup
from workload import queries

SF_DIR = "/root/testdata/sf0.1"


def scanned_rows(df) -> int:
    """Rows that the scans of a frame handed on when it was last collected."""
    total, plans = 0, [df._jdf.queryExecution().executedPlan()]
    while plans:
        plan = plans.pop()
        children = plan.children()
        plans += [children.apply(i) for i in range(children.size())]
        metrics = plan.metrics()
        if "Scan" in plan.nodeName() and metrics.contains("numOutputRows"):
            total += metrics.apply("numOutputRows").value()
    return total


@pytest.fixture(scope="module")
def complaints(spark):
    return queries.fact(spark, SF_DIR, "complaint")


def test_one_entity_reads_few_row_groups(spark, complaints, tmp_path):
    path = str(tmp_path / "facts")
    lookup.write_clustered(complaints, path, "complaint_record_id", lookup.Layout(group_bytes=128 << 10, files=8))
    files = [pq.ParquetFile(f) for f in sorted((tmp_path / "facts").glob("*.parquet"))]
    groups = [f.metadata.row_group(i) for f in files for i in range(f.metadata.num_row_groups)]
    column = [i for i in range(groups[0].num_columns) if groups[0].column(i).path_in_schema == "vehicle_key"][0]
    stored = spark.read.parquet(path)
    keys = [r[0] for r in stored.where("vehicle_key IS NOT NULL").select("vehicle_key").distinct().orderBy(F.xxhash64("vehicle_key")).limit(5).collect()]
    total = stored.count()
    for key in keys:
        # row groups whose range holds the key, by the footers
        inside = [g for g in groups if g.column(column).statistics.has_min_max and g.column(column).statistics.min <= key <= g.column(column).statistics.max]
        found = lookup.of_entities(stored, [key])
        rows = found.collect()
        assert rows and {r["vehicle_key"] for r in rows} == {key}
        assert len(inside) < 0.05 * len(groups) and scanned_rows(found) < 0.05 * total
    some = lookup.of_entities(stored, keys)
    assert len(some.collect()) == stored.where(F.col("vehicle_key").isin(keys)).count() and scanned_rows(some) < 0.25 * total
    assert lookup.of_entities(stored, []).count() == 0


def test_bloom_filters_exclude_keys_inside_a_range(spark, tmp_path):
    """A key between those of a row group, but in none, reads nothing."""
    path = str(tmp_path / "facts")
    frame = spark.range(20_000).selectExpr("sha2(string(id * 2), 256) AS vehicle_key", "string(id) AS record")
    lookup.write_clustered(frame, path, "record", lookup.Layout(files=1))
    stored = spark.read.parquet(path)
    absent = [r[0] for r in spark.range(50).selectExpr("sha2(string(id * 2 + 1), 256)").collect()]
    read = 0
    for key in absent[:20]:
        found = lookup.of_entities(stored, [key])
        assert found.collect() == []
        read += scanned_rows(found) > 0
    assert read <= 2  # one in a hundred passes the filter


def test_columns_made_again_are_written_as_they_were(spark, tmp_path):
    """Keys that are functions of other columns stay out of the shuffle; ranges, order and values are those of the keys."""
    beside = queries.mart_columns()
    for source, name in (("communications", "communication"), ("ratings", "ncap")):
        record, path = lookup.CLUSTERED[name][1], str(tmp_path / name)
        rows = queries.star.FACTS[source](queries.silver(spark, "/root/testdata/sf0.001", source), beside[source])
        lookup.write_clustered(rows, path, record, lookup.Layout(files=3), made=queries.made_keys(source, queries.SETTINGS))
        stored = spark.read.parquet(path)
        assert stored.columns == rows.columns and stored.exceptAll(rows).count() == rows.exceptAll(stored).count() == 0
        files = [pq.read_table(f).to_pylist() for f in sorted((tmp_path / name).glob("*.parquet"))]
        order = [(r["vehicle_key"] or "", r[record]) for rows in files for r in rows]
        assert len(files) == 3 and order == sorted(order)


def test_a_hot_entity_spans_files(spark, tmp_path):
    frame = spark.range(30_000).selectExpr("IF(id % 3 = 0, 'hot', IF(id % 3 = 1, NULL, string(id))) AS vehicle_key", "string(id) AS record")
    lookup.write_clustered(frame, str(tmp_path / "facts"), "record", lookup.Layout(files=12))
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in (tmp_path / "facts").glob("*.parquet")]
    assert len(sizes) == 12 and max(sizes) < 2 * 30_000 / 12
    stored = spark.read.parquet(str(tmp_path / "facts"))
    assert lookup.of_entities(stored, ["hot"]).count() == 10_000


def test_many_keys_are_joined(spark, tmp_path):
    frame = spark.range(1000).selectExpr("string(id) AS vehicle_key")
    few, many = frame.where("length(vehicle_key) = 1"), frame.where("length(vehicle_key) < 3")
    assert lookup.listed(few.union(few)) == [str(i) for i in range(10)] and lookup.listed(many) is None
    assert lookup.of_entities(frame, many).count() == 100


# --- distinct counts that add up -------------------------------------------------------------

STATE = distinct_states.DistinctState("ids", "id", {"good_ids": "good"})


def stored_states(spark, tmp_path, rows, n_batches):
    frame = spark.createDataFrame(rows, "topic string, month int, entity string, id string, good boolean")
    numbers, parts = None, []
    for i in range(n_batches):
        own = frame.where(F.pmod(F.xxhash64("entity", "month"), F.lit(n_batches)) == i)
        numbers = distinct_states.number_ids(own, "id", str(tmp_path / f"numbers{i}"), numbers)
        distinct_states.states(own, numbers, STATE, ["topic", "month", "entity"]).write.parquet(str(tmp_path / f"states{i}"))
        parts.append(spark.read.parquet(str(tmp_path / f"states{i}")))
    return numbers, distinct_states.merged(parts, STATE, ["topic", "month", "entity"])


@pytest.mark.parametrize("n_batches", [1, 3])
def test_rolled_up_states_equal_distinct_counts(spark, tmp_path, n_batches):
    rng = random.Random(4)
    rows = [
        (rng.choice(["a", "b", None]), rng.randrange(3), f"e{rng.randrange(9)}", rng.choice([None, *map(str, range(400))]), rng.choice([True, False, None]))
        for _ in range(3000)
    ]
    numbers, stored = stored_states(spark, tmp_path, rows, n_batches)
    assert numbers.count() == numbers.select("number").distinct().count() == len({r[3] for r in rows} - {None})
    contexts = [["topic", "month"], ["entity"], []]
    columns = ["topic", "month", "entity"]
    expected = set()
    for own in contexts:
        groups = {}
        for r in rows:
            key = tuple(r[columns.index(c)] if c in own else None for c in columns)
            ids, good = groups.setdefault(key, (set(), set()))
            ids.add(r[3])
            if r[4]:
                good.add(r[3])
        number = sum(1 << i for i, c in enumerate(reversed(columns)) if c not in own)
        expected |= {(*key, number, len(ids), len(good)) for key, (ids, good) in groups.items()}
    found = distinct_states.counts(stored, STATE, contexts)
    assert {tuple(r) for r in found.select(*columns, "grouping_id", "ids", "good_ids").collect()} == expected


def test_ids_spread_over_buckets(spark, tmp_path):
    ids = spark.range(200_000).selectExpr("'t' AS topic", "1 AS month", "'e' AS entity", "string(id) AS id", "id % 2 = 0 AS good")
    numbers = distinct_states.number_ids(ids, "id", str(tmp_path / "numbers"))
    stored = distinct_states.states(ids, numbers, STATE, ["topic"])
    rows = stored.selectExpr("bitmap_count(bits_ids) AS n", "length(bits_ids) AS size").collect()
    assert len(rows) >= 7 and max(r["n"] for r in rows) <= 32_768 and {r["size"] for r in rows} == {4096}
    assert distinct_states.counts(stored, STATE, [[]]).select("ids", "good_ids").first() == (200_000, 100_000)
    # known ids keep their numbers; a later batch gets others, in buckets of its own
    more = distinct_states.number_ids(spark.range(199_990, 200_010).selectExpr("string(id) AS id"), "id", str(tmp_path / "more"), numbers)
    assert more.count() == 200_010 and more.select("number").distinct().count() == 200_010
    assert more.join(numbers, ["id", "number"]).count() == 200_000


def test_states_of_the_given_facts_equal_the_measures(spark):
    """Year, month, make and the whole from one stored table."""
    folder = "/root/testdata/sf0.001"
    found = queries.distinct_rollup_recalls(spark, folder).collect()
    model = queries.Model(spark, folder)
    names = ["recall_campaigns", "do_not_drive_campaigns"]
    per_make = {r["make"]: tuple(r)[1:] for r in measures.measures(names, model, by=["make"]).collect()}
    whole = tuple(measures.measures(names, model).first())
    assert {r["make"]: tuple(r[n] for n in names) for r in found if r["grouping_id"] == 0b1011} == per_make
    assert [tuple(r[n] for n in names) for r in found if r["grouping_id"] == 0b1111] == [whole]


def test_empty_states(spark, tmp_path):
    _, stored = stored_states(spark, tmp_path, [], 1)
    assert distinct_states.counts(stored, STATE, [["topic"], []]).collect() == []


# --- where two tables differ -----------------------------------------------------------------

PLAN = fingerprints.TreePlan(levels=2)


def marts(spark, n=2000):
    return spark.range(n).selectExpr("concat('k', id) AS key", "id AS a", "id % 7 AS b", "IF(id % 5 = 0, NULL, id / 3) AS c", "string(id % 3) AS d")


def test_swapped_values_that_cancel_in_the_totals_are_named(spark):
    good = marts(spark)
    swapped = good.withColumn("a", F.when(F.col("key") == "k10", 20).when(F.col("key") == "k20", 10).otherwise(F.col("a")))
    assert swapped.agg(F.sum("a")).first() == good.agg(F.sum("a")).first()
    found = sorted(tuple(r) for r in fingerprints.differences(swapped, good, "key", plan=PLAN).collect())
    assert found == [("k10", "a", "20", "10"), ("k20", "a", "10", "20")]


def test_missing_rows_nulls_and_fractions(spark):
    good = marts(spark)
    bad = good.where("key <> 'k3'").withColumn("c", F.when(F.col("key") == "k5", 0.0).when(F.col("key") == "k7", F.col("c") + 1e-12).otherwise(F.col("c")))
    bad = bad.unionByName(spark.createDataFrame([("new", 1, 2, None, None)], bad.schema))
    found = sorted(tuple(r) for r in fingerprints.differences(bad, good, "key", plan=PLAN).collect())
    assert found == [("k3", "(row)", "missing", "present"), ("k5", "c", "0.0", None), ("new", "(row)", "present", "missing")]
    assert fingerprints.differences(good, good.repartition(7), "key", plan=PLAN).count() == 0
    assert fingerprints.differences(good.limit(0), good.limit(0), "key", plan=PLAN).count() == 0


def test_only_unequal_buckets_are_joined(spark, tmp_path):
    good = marts(spark)
    good.write.parquet(str(tmp_path / "good"))
    good = spark.read.parquet(str(tmp_path / "good"))
    bad = good.withColumn("b", F.when(F.col("key") == "k77", -1).otherwise(F.col("b")))
    trees = [fingerprints.tree(fingerprints.leaves(df, "key", ["a", "b", "c", "d"], PLAN), PLAN) for df in (bad, good)]
    assert [level.count() for level in trees[1]] == [1, 16, 256]
    assert [level.agg(F.sum("n")).first()[0] for level in trees[1]] == [2000] * 3
    assert len(fingerprints.unequal_buckets(*trees)) == 1
    assert fingerprints.unequal_buckets(trees[1], trees[1]) == []


def test_equal_and_repeated_rows_have_fingerprints_whatever_their_order(spark):
    frame = marts(spark, 50)
    one, other = (fingerprints.leaves(df, "key", ["a"], PLAN) for df in (frame.orderBy("a"), frame.orderBy(F.desc("a"))))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, other.collect()))
    twice = fingerprints.leaves(frame.union(frame), "key", ["a"], PLAN)
    assert fingerprints.unequal_buckets(fingerprints.tree(one, PLAN), fingerprints.tree(twice, PLAN)) == sorted(r["bucket"] for r in one.collect())
