"""Hard negatives against comparing every pair."""

import math

import numpy as np
import pytest

from casefile.llm import negatives, oracles
from casefile.llm.common import read
from casefile.llm.queries import op11_hard_negatives
from pyspark.sql import functions as F
from tests.compare import connect, difference
from tests.llm.helpers import SF_DIR, empty

COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def brute(rows, is_anchor, positives=5, k=10):
    good = [(i, n, [math.floor(256 * float(x)) for x in v]) for i, v, n in rows
            if i is not None and n is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (i, label, v) in enumerate(good):
        if not is_anchor(i):
            continue
        scored = sorted(
            (-sum(a * b for a, b in zip(v, w, strict=True)), j, n) for p, (j, n, w) in enumerate(good) if p != at and len(w) == len(v)
        )
        for s, j, _ in [x for x in scored if x[2] == label][:positives]:
            near = [x for x in scored if x[2] != label and 30 * -s <= 100 * -x[0] <= 90 * -s][:k]
            out += [(i, j, r, m, -s, -t) for r, (t, m, _) in enumerate(near, 1)]
    return sorted(out)


def found(frame, is_anchor, **plan):
    return sorted(tuple(r) for r in negatives.hard_negatives(frame, is_anchor, negatives.MiningPlan(**plan)).select(*COLUMNS).collect())


@pytest.mark.parametrize("folder", [SF_DIR, "/root/testdata/sf0.1"])
def test_query_equals_sql(spark, folder):
    problem = difference(op11_hard_negatives(spark, folder), connect(folder), oracles.ORACLES["op11_hard_negatives"])
    assert problem is None, problem


@pytest.mark.parametrize("plan", [{}, {"shard_rows": 100, "block_rows": 20, "expected": 1, "growth": 2, "dims": 3}])
def test_random_vectors(spark, plan):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(6, 12))
    rows = [(i, (centers[i % 6] + 0.7 * rng.normal(size=12)).tolist(), int(i % 3)) for i in range(900)]
    rows += [(1000 + i, rows[0][1], i % 2) for i in range(300)]  # a vector that very many rows share
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    expected = brute(rows, lambda i: i % 50 == 0)
    assert expected and found(frame, F.col("vec_id") % 50 == 0, **plan) == expected


def test_odd_rows(spark):
    rows = [(i, [1.0, 0.25 * i], i % 2) for i in range(12)] + [(i, [1.0, 0.25 * i], i % 2) for i in range(3)]
    rows += [(0, [0.0, 0.0], 0), (20, [0.0, 0.0], 1), (21, [-1.0, -1.0], 1), (22, [-0.5, -2.0], 0)]
    rows += [(30, [1.0, 2.0, 3.0], 0), (10, [1.0, 2.0, 2.5], 0), (31, [1.0, 1.0, 1.0], 1), (32, [], 0), (33, [], 1), (40, [], 0)]
    bad = [(None, [1.0, 1.0], 0), (10, None, 0), (10, [1.0, None], 0), (10, [float("nan"), 1.0], 0), (10, [float("-inf"), 1.0], 0), (10, [1.0, 1.0], None)]
    frame = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, label int")
    for name in ("rid", "vec", "score", "low", "rank", "width", "item"):
        frame = frame.withColumn(name, F.lit("clash"))
    assert found(frame, F.col("vec_id") % 10 == 0) == brute(rows + bad, lambda i: i % 10 == 0)
    assert found(empty(frame), F.col("vec_id") % 10 == 0) == []
    assert found(frame, F.lit(False)) == []


def test_components_at_the_limit(spark):
    rows = [(i, [1e6 if i % 3 else -1e300, 1e5 + i, float(i)], i % 2) for i in range(40)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    held = [(i, [max(min(256 * x, 2**25), -(2**25)) / 256 for x in v], n) for i, v, n in rows]
    assert found(frame, F.col("vec_id") % 10 == 0, dims=1) == brute(held, lambda i: i % 10 == 0)


def test_the_index_leaves_out_what_norms_cover():
    rng = np.random.default_rng(4)
    rows, anchors = rng.normal(size=(500, 32)) * 2.0 ** -np.arange(32), rng.normal(size=(8, 32))
    scores = anchors @ rows.T
    least = float(np.quantile(scores, 0.98))
    index = negatives.SuffixIndex(rows, anchors, least, 4)
    assert index.postings[-1] == 0 and index.postings == sorted(index.postings, reverse=True) and index.postings[0] < 500
    left, right, sums = index.search(0, 8, np.full(8, least))
    kept = {(a, b): s for a, b, s in zip(left.tolist(), right.tolist(), sums, strict=True)}
    assert {p for p, s in kept.items() if s >= least} == set(zip(*np.nonzero(scores >= least), strict=True))
    assert all(abs(s - scores[p]) < 1e-9 for p, s in kept.items())


def test_given_table_has_all_windows(spark):
    rows = [(r["vec_id"], r["embedding"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"]) for r in read(spark, SF_DIR, "embeddings").collect()]
    mine = sorted(tuple(r) for r in op11_hard_negatives(spark, SF_DIR).select(*COLUMNS).collect())
    assert mine == brute(rows, lambda i: i % 100 == 0)
