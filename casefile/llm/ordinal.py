"""Toxicity severity by cumulative-link ordinal regression over sparse text features.

P(grade <= g) = sigmoid(threshold_g - w . x): one weight per feature serves all ordered thresholds, and
the output is the expected grade. Features are words and word beginnings that toxic texts use several
times as often as clean ones; each counts twice, as log2(1 + count) and as log2(1 + 200 count / words),
so that one passage in a very long text tells as well as a steady rate does.
"""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casefile.llm.common import map_arrow, record_batch, slices, staged, texts_of
from casefile.llm.pieces import UnitMemo

WORDS = re.compile(r"\w+")


def beginnings(word: str) -> list[str]:
    """The word and its beginnings of three to seven letters, marked."""
    return [word, *(f"^{word[:n]}" for n in range(3, min(len(word), 8)))]


def sparse_features(text: str, columns_of: UnitMemo, n_columns: int) -> dict[int, float]:
    """Column -> value: counts in the first n_columns, rates in the second."""
    words = WORDS.findall(text.lower())
    counts: Counter[int] = Counter(itertools.chain.from_iterable(map(columns_of.__getitem__, words)))
    found = {column: math.log2(1 + n) for column, n in counts.items()}
    found.update({n_columns + column: math.log2(1 + 200 * n / len(words)) for column, n in counts.items()})
    return found


def column_memo(index: dict[str, int]) -> UnitMemo:
    return UnitMemo(lambda word: tuple(index[f] for f in beginnings(word) if f in index), limit=300_000)


@dataclass(frozen=True)
class OrdinalModel:
    index: dict[str, int] = field(repr=False)  # word or beginning -> column
    weights: np.ndarray = field(repr=False)  # of counts, then of rates
    thresholds: np.ndarray  # ascending; one less than grades

    def scorer(self):
        """A function from a whole text to w . x, with a bounded memo of words."""
        memo = column_memo(self.index)

        def score(text: str) -> float:
            found = sparse_features(text, memo, len(self.index))
            return sum(self.weights[c] * x for c, x in sorted(found.items()))

        return score

    def at_least(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= 1), P(grade >= 2), ... per score."""
        return _sigmoid(scores[:, None] - self.thresholds)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def fit_ordinal(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, grades: np.ndarray, n_columns: int, n_grades: int,
                penalty: float = 1e-5, steps: int = 1000, rate: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of least penalised log loss, by Adam over all examples; x is given by its entries."""
    n = len(grades)
    share = np.array([(np.sum(grades <= g) + 0.5) / (n + 1) for g in range(n_grades - 1)])
    start = np.log(share / (1 - share))
    # thresholds are kept in order as a first one and logarithms of the steps up
    shape = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    parameters = np.concatenate([np.zeros(n_columns), shape])
    first, second = np.zeros_like(parameters), np.zeros_like(parameters)
    example = np.arange(n)
    for step in range(1, steps + 1):
        weights, shape = parameters[:n_columns], parameters[n_columns:]
        ups = np.exp(shape[1:])
        thresholds = shape[0] + np.concatenate([[0.0], np.cumsum(ups)])
        scores = np.bincount(rows, weights[columns] * values, minlength=n)
        below = np.concatenate([np.zeros((n, 1)), _sigmoid(thresholds - scores[:, None]), np.ones((n, 1))], axis=1)
        likely = np.maximum(below[example, grades + 1] - below[example, grades], 1e-12)
        slope = below * (1 - below)  # of each cumulative probability in its threshold
        by_threshold = np.zeros((n, n_grades + 1))
        by_threshold[example, grades + 1] -= slope[example, grades + 1] / likely
        by_threshold[example, grades] += slope[example, grades] / likely
        by_threshold = by_threshold[:, 1:-1]
        by_score = -by_threshold.sum(axis=1) / n
        gradient_thresholds = by_threshold.sum(axis=0) / n
        tail = np.cumsum(gradient_thresholds[::-1])[::-1]
        gradient = np.concatenate([
            np.bincount(columns, by_score[rows] * values, minlength=n_columns) + penalty * weights,
            tail[:1], tail[1:] * ups,
        ])
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        parameters = parameters - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    weights, shape = parameters[:n_columns], parameters[n_columns:]
    return weights, shape[0] + np.concatenate([[0.0], np.cumsum(np.exp(shape[1:]))])


def fit(
    documents: DataFrame,
    labels: DataFrame,
    id_col="doc_id",
    text_col="text",
    label_col="toxic",
    n_grades: int = 4,
    fit_rows: int = 10_000,
    max_features: int = 512,
    least_contexts: int = 8,
    least_ratio: float = 4.0,
) -> OrdinalModel:
    """Fit on at most `fit_rows` labelled documents, those whose hashed id comes first.

    Labels are 0 (clean) or 1 (toxic), several for a document count as the highest; rows with a null id
    or label are not used. Of several texts of one id the one with the smallest hash is used. Toxic texts are graded by the rate of their most frequent telling feature, in
    equal parts; those without any are grade 1. Features are chosen by chi-squared over contexts:
    occurrences after the same word count once in a class, so that many copies of one text do not make its
    words telling. The driver holds the sample's entries in the `max_features` chosen features. Without
    toxic or without clean labels nothing is learnt, and every text has severity 0.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
    known = known.agg((F.max(label_col) > 0).cast("int").alias("toxic"))
    sample = known.orderBy(F.xxhash64("id"), "id").limit(fit_rows)
    texts = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    place = F.struct(F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2"), "text")
    one = texts.join(F.broadcast(sample), "id").groupBy("id", "toxic").agg(F.min(place)["text"].alias("text"))
    sampled = one.repartition(16, "id")
    sampled = staged(sampled.select("id", "toxic", "text"), "toxic-sample")

    def contexts(batches):
        """Distinct (word, hash of the word before, toxic) of each run of rows."""
        schema = [("word", pa.string()), ("before", pa.int64()), ("toxic", pa.int32())]
        for batch in (part for whole in batches for part in slices(whole, 1)):
            found: set[tuple[str, str, int]] = set()
            for text, toxic in zip(texts_of(batch.column(1)), batch.column(0).to_pylist(), strict=True):
                own = WORDS.findall(text.lower())
                found.update(zip(own, ["", *own], [toxic] * len(own), strict=False))
            before = [zlib.crc32(x.encode("utf-8")) for _, x, _ in found]
            yield record_batch(schema, [w for w, _, _ in found], before, [t for _, _, t in found])

    met = map_arrow(sampled.select("toxic", "text"), contexts, "word string, before long, toxic int").distinct()
    seen = met.groupBy("word").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    seen = staged(seen, "toxic-words")
    total = seen.agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).first()
    n_bad, n_good = total["bad"] or 0, total["good"] or 0
    if not n_bad or not n_good:
        return OrdinalModel({}, np.zeros(0), np.full(n_grades - 1, np.inf))
    n = n_bad + n_good
    starts = F.expr("transform(sequence(3, 7), n -> CASE WHEN length(word) > n THEN concat('^', left(word, n)) END)")
    feature = F.explode(F.filter(F.concat(F.array("word"), starts), lambda x: x.isNotNull())).alias("feature")
    sums = seen.select(feature, "bad", "good").groupBy("feature").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    both = F.col("bad") + F.col("good")
    cross = F.col("bad") * F.lit(float(n_good)) - F.col("good") * F.lit(float(n_bad))
    chi = n * cross * cross / (F.lit(float(n_bad) * n_good) * both * (n - both + 0.5))
    telling = F.col("bad") * F.lit(float(n_good)) > least_ratio * F.col("good") * F.lit(float(n_bad))
    # 23.9: one feature in a million without any bearing passes
    ranked = sums.where(both >= least_contexts).where(telling).withColumn("chi", chi).where("chi > 23.9")
    chosen = ranked.orderBy(F.desc("chi"), "feature").limit(max_features).collect()
    index = {r["feature"]: i for i, r in enumerate(chosen)}

    def entries(batches):
        schema = [("id", pa.int64()), ("toxic", pa.int32()), ("columns", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))]
        memo = column_memo(index)
        for batch in (part for whole in batches for part in slices(whole, 2)):
            own = [sparse_features(t, memo, len(index)) for t in texts_of(batch.column(2))]
            yield record_batch(schema, batch.column(0), batch.column(1), [list(x) for x in own], [list(x.values()) for x in own])

    found = map_arrow(sampled, entries, "id long, toxic int, columns array<int>, values array<double>").orderBy("id").collect()
    rows = np.repeat(np.arange(len(found)), [len(r["columns"]) for r in found])
    columns = np.array([c for r in found for c in r["columns"]], np.int64)
    values = np.array([x for r in found for x in r["values"]], np.float64)
    toxic = np.array([r["toxic"] for r in found])
    rates = columns >= len(index)
    level = np.zeros(len(found))
    np.maximum.at(level, rows[rates], values[rates])  # the rate of a text's most frequent telling feature
    marked = level[(toxic == 1) & (level > 0)]
    cuts = np.quantile(marked, [i / (n_grades - 1) for i in range(1, n_grades - 1)]) if len(marked) else np.full(n_grades - 2, np.inf)
    grades = np.where(toxic == 1, 1 + (level[:, None] > cuts).sum(axis=1), 0)
    weights, thresholds = fit_ordinal(rows, columns, values, grades, 2 * len(index), n_grades)
    return OrdinalModel(index, weights, thresholds)


_COLUMNS = [("doc_id", pa.int64()), ("severity", pa.float64()), ("grade", pa.int32()), ("p_toxic", pa.float64()), ("toxic", pa.bool_())]


def severity(df: DataFrame, model: OrdinalModel, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, severity (expected grade), grade (most likely), p_toxic (grade 1 or more), toxic (p_toxic >= 0.5).

    Null and empty texts hold no word and get the severity of a text without telling words. Whole texts of
    any length are read; a null id stays null; repeated rows are graded each; an empty table gives no rows;
    other columns are not read. Rows need no shuffle.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)  # at most max_features features

    def run(batches):
        known = sent.value
        score = known.scorer()
        for batch in (part for whole in batches for part in slices(whole, 1)):
            above = known.at_least(np.array([score(t) for t in texts_of(batch.column(1))], np.float64))
            steps = np.concatenate([np.ones((len(above), 1)), above, np.zeros((len(above), 1))], axis=1)
            grade = (steps[:, :-1] - steps[:, 1:]).argmax(axis=1)
            yield record_batch(_COLUMNS, batch.column(0), above.sum(axis=1), grade, above[:, 0], above[:, 0] >= 0.5)

    chosen = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_arrow(chosen, run, "doc_id long, severity double, grade int, p_toxic double, toxic boolean")
