"""Language-model scores against counts held in dictionaries."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from casefile.llm import ngram_filter as lm
from casefile.llm.common import read
from casefile.llm.queries import op12_lm_score
from tests.llm.helpers import SF_DIR, empty, odd_documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*WORD.findall(lower), ""]


def brute(training, rows, plan):
    """(doc_id, n_tokens, n_known, N, base, score) with exact look-ups of quantised counts."""
    counts = Counter()
    for text in training:
        own = ["<begin>"] * (plan.order - 1) + tokens(text)
        for n in range(1, plan.order + 1):
            counts.update(tuple(own[i - n + 1 : i + 1]) for i in range(plan.order - 1, len(own)))
    words = {w: c for w, c in counts.items() if len(w) == 1}
    total, types = sum(words.values()), len(words)

    def mean(gram):  # of the counts with the same level
        c = counts.get(gram, 0)
        if not c:
            return 0.0
        level = 1 + math.floor(math.log(c) / math.log(plan.base) + 1e-12)
        low, high = max(math.ceil(plan.base ** (level - 1)), 1), math.ceil(plan.base**level) - 1
        return (low + max(high, low)) / 2

    out = []
    for doc_id, text in rows:
        own = ["<begin>"] * (plan.order - 1) + tokens(text)
        base = score = 0.0
        before = {}
        for i in range(plan.order - 1, len(own)):
            base += math.log10((words.get((own[i],), 0) + 1) / (total + types + 1))
            shorter = mean((own[i],))
            p = (shorter + 1) / (total + types + 1)
            found = {1: shorter}
            for n in range(2, plan.order + 1):
                context = len(training) if i == plan.order - 1 else before[n - 1]
                shorter = min(mean(tuple(own[i - n + 1 : i + 1])), context, shorter)
                p = (shorter + plan.mass * p) / (context + plan.mass)
                found[n] = shorter
            before = found
            score += math.log10(p)
        n = tokens(text)
        out.append((doc_id, len(n), sum((w,) in words for w in n), total, base, score))
    return out


def near(mine, theirs):
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[5])
    mine, theirs = sorted(mine, key=key), sorted(theirs, key=key)
    assert [r[:4] for r in mine] == [r[:4] for r in theirs]
    assert np.allclose([r[4:] for r in mine], [r[4:] for r in theirs], rtol=1e-9, atol=1e-9)


def scored(frame, model):
    return [tuple(r) for r in lm.score(frame, model).collect()]


@pytest.mark.parametrize(
    "changes", [{}, {"order": 3}, {"broadcast_bytes": 0, "chunk_bytes": 20_000}, {"frequent": 50}, {"broadcast_bytes": 0, "order": 3, "segment_grams": 500, "chunk_bytes": 9000, "frequent": 3}]
)
def test_given_texts_against_dictionaries(spark, changes):
    """With so many bits that no probe errs."""
    plan = lm.LmPlan(item_bits=5000, **changes)
    rows = [(r["doc_id"], r["text"]) for r in read(spark, SF_DIR, "documents").select("doc_id", "text").collect()][:60]
    training = [t for i, t in rows if i % 3]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    near(scored(frame, lm.fit(frame.where("doc_id % 3 != 0"), plan)), brute(training, rows, plan))


def test_both_ways_agree_whatever_the_filter_errs(spark):
    frame = read(spark, SF_DIR, "documents")
    results = []
    for limit in (1 << 30, 0):
        plan = lm.LmPlan(item_bits=4, hashes=2, broadcast_bytes=limit, segment_grams=4000, chunk_bytes=50_000)
        results.append(scored(frame, lm.fit(frame.where("doc_id % 2 = 0"), plan)))
    near(*results)


def test_query_over_the_given_table(spark):
    rows = {r["doc_id"]: r["text"] for r in read(spark, SF_DIR, "documents").collect()}
    found = op12_lm_score(spark, SF_DIR).collect()
    out = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    training = [t for i, t in rows.items() if not out(i)]
    expected = {r[0]: r for r in brute(training, list(rows.items()), lm.LmPlan(order=1))}
    assert sorted(rows) == sorted(r["doc_id"] for r in found)
    for r in found:
        own = expected[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (out(r["doc_id"]), *own[1:4])
        assert r["base_score"] == pytest.approx(own[4], rel=1e-9)
    unseen = [r for r in found if r["held_out"]]
    assert sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen)


def test_odd_rows(spark):
    frame = odd_documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in frame.collect()]
    for limit in (1 << 20, 0):
        plan = lm.LmPlan(item_bits=5000, broadcast_bytes=limit)
        model = lm.fit(frame, plan)
        near(scored(frame, model), brute([t for _, t in rows], rows, plan))
        assert scored(empty(frame), model) == []
        untrained = scored(frame, lm.fit(empty(frame), plan))
        assert {r[2:] for r in untrained} == {(0, 0, 0.0, 0.0)} and len(untrained) == len(rows)


def test_levels_and_their_means():
    counts = np.array([0, 1, 2, 3, 4, 5, 6, 1000, 10**12])
    levels = lm.levels_of(counts, 1.5)
    assert levels.tolist() == [0, *(1 + math.floor(math.log(c) / math.log(1.5)) for c in counts[1:].tolist())]
    means = lm.expected_counts(1.5)
    assert means[levels[:4]].tolist() == [0, 1, 2, 3] and abs(means[levels[-1]] / 10**12 - 1) < 0.25


def test_probes_err_as_seldom_as_stated():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 63, 40_000, dtype=np.uint64) * np.uint64(2)
    levels = rng.integers(1, 6, 40_000)
    filled = lm.LogFilter([(0, lm.fill(keys, levels, lm.LmPlan()))], 1, lm.LmPlan.hashes)
    found = filled.levels(keys)
    assert (found >= levels).all() and 0.02 < (found > levels).mean() < 0.045
    assert 0.02 < (filled.levels(keys + np.uint64(1)) > 0).mean() < 0.045
    assert len(filled.words) * 64 == pytest.approx(levels.sum() * lm.LmPlan.item_bits, rel=1e-4)


def test_held_out_fold(spark):
    ids = [0, 1, 2, 10, 99, None]
    frame = spark.createDataFrame([(i,) for i in ids], "doc_id long").select("doc_id", lm.held_out(F.col("doc_id")).alias("x"))
    assert [r["x"] for r in frame.collect()] == [zlib.crc32(str(i).encode()) % 7 == 2 for i in ids[:-1]] + [None]
