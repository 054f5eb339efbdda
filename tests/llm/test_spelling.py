"""Spelling variants against comparing every pair of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np

from casefile.llm import oracles, spelling
from casefile.llm.common import read
from casefile.llm.queries import op13_spelling
from tests.compare import connect, difference
from tests.llm.helpers import SF_DIR, empty, odd_documents

RUNS = re.compile("[A-Za-zÀ-ÿ]+")


def brute_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in RUNS.findall(text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words):
    near = {w: [v for v in words if abs(len(w) - len(v)) < 2 and one_edit(w, v)] for w in words}
    form = {}
    for w, own in near.items():
        best = min(own, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), words[w], len(near[w]), words.get(form[w])) for w in words}


def found(frame):
    return [tuple(r) for r in spelling.variants(frame).select("word", "form", "root", "n", "n_near", "form_n").collect()]


def test_given_words_against_every_pair(spark):
    rows = [(r["doc_id"], r["text"]) for r in read(spark, SF_DIR, "documents").collect()]
    words = brute_words(rows)
    # every pair of the whole table's words is compared where lengths and letters allow an edit
    mine = found(read(spark, SF_DIR, "documents"))
    assert len(mine) == len(set(mine)) == len(words)
    assert {(w, n) for w, _, _, n, _, _ in mine} == set(words.items())
    assert set(mine) == brute_by_deletions(words)


def test_query_equals_sql(spark):
    problem = difference(op13_spelling(spark, "/root/testdata/sf0.01"), connect("/root/testdata/sf0.01"), oracles.ORACLES["op13_spelling"])
    assert problem is None, problem


def brute_by_deletions(words):
    """As `brute`, comparing only words that share a deletion: every pair one edit apart does."""
    sharing = {}
    for w in words:
        for x in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            sharing.setdefault(x, set()).add(w)
    near = {w: {v for x in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))} for v in sharing[x] if one_edit(w, v)} for w in words}
    form = {}
    for w, own in near.items():
        best = min(own, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), words[w], len(near[w]), words.get(form[w])) for w in words}


def test_chains_stretches_and_ties(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abé") for _ in range(rng.randrange(7, 10))) for _ in range(150)]
    words += ["aaaaaaa", "aaaaaaaa", "aaaaaaab", "baaaaaaa"]
    text = []
    for w in words:
        text += [w] * rng.choice([2, 3, 25, 40, 300, 4000])
    rows = [(1, " ".join(text)), (None, "aaaaaaa\naaaaaaa"), (2, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert set(found(frame)) == brute(brute_words(rows))
    assert any(f and r != f for _, f, r, *_ in brute(brute_words(rows)))  # a chain of two forms


def test_odd_rows(spark):
    frame = odd_documents(spark)
    long = "".join(random.Random(1).choice("abcdef") for _ in range(5000))
    near = [long, long[:99] + "z" + long[100:], long[:4000] + long[4001:], "q" + long]
    edge = ["m" * 126 + x for x in ("ab", "ac", "abb", "a", "bb")]
    rows = [(10 + i, w + " " + w) for i, w in enumerate([*near, *edge, "y" * 20_000, "y" * 19_999])]
    both = frame.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    words = brute_words([tuple(r) for r in both.collect()])
    assert set(found(both)) == brute_by_deletions_of_long(words)
    assert {x[0] for x in found(frame)} == set(brute_words([(r["doc_id"], r["text"]) for r in frame.collect()]))
    assert found(empty(frame)) == []
    assert found(spark.createDataFrame([(1, "short words")], "doc_id long, text string")) == []


def brute_by_deletions_of_long(words):
    near = {w: [v for v in words if abs(len(w) - len(v)) < 2 and quick_edit(w, v)] for w in words}
    return {(w, None, w, words[w], len(near[w]), None) for w in words}


def quick_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    at = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a != b and (a[at + 1 :] == b[at + 1 :] if len(a) == len(b) else a[at:] == b[at + 1 :])


def test_fingerprints_tell_substrings():
    codes = np.array([ord(c) for c in "abcabcabd"], np.int64)
    one = spelling.fingerprints(codes, np.arange(7), 3)
    texts = ["abcabcabd"[i : i + 3] for i in range(7)]
    assert all((one[i] == one[j]) == (texts[i] == texts[j]) for i in range(7) for j in range(7))
