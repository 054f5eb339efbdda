"""Hard negatives by threshold joins: inner products above a threshold through a reduced inverted index.

The join of anchors with all rows finds every pair whose score reaches the anchor's threshold, exactly.
Dimensions are put in order of falling energy. A row is indexed in its first dimensions only: the rest,
from where its suffix norm times the largest suffix norm of an anchor is below every threshold, is in no
posting list, so short rows are in none at all. Partial scores are accumulated list by list, a few
dimensions at a time. A pair goes as soon as its partial score and the product of both remaining norms stay
below the anchor's threshold; what is left of a pair is completed from the vectors.

First every anchor looks for its best rows of the same label, the positives. Each positive opens a window of
scores for rows of other labels. Thresholds start where a bounded sample says that few rows are above, and
are lowered for those windows only that are not yet full, until they are or the window's lower end is
reached. The sample bears on the number of rounds, never on the result.

Anchors are cut into blocks and rows into shards; every block meets every shard once, and a task holds one
of each. It gives a window the best rows of its shard only, so neither a label nor a vector that a third of
all rows share is ever one group. Rounds are written to the shared folder.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from casefile.llm.common import map_arrow, record_batch, ship, staged


@dataclass(frozen=True)
class MiningPlan:
    positives: int = 5
    negatives: int = 10
    low_share: int = 30  # hundredths of the positive's score
    high_share: int = 90
    scale: int = 256
    shard_rows: int = 16_384
    block_rows: int = 2048  # windows
    sample: int = 2048  # rows that first thresholds are taken from
    expected: int = 40  # rows expected above the first threshold, times those wanted
    growth: int = 8  # by which a lower threshold lets more rows in
    dims: int = 8  # accumulated between two prunings


LIMIT = 1 << 25  # components are held within +-LIMIT, so that scores of up to 8192 of them fit a long
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1
_ITEMS = "rid long, vec_id long, label long, vec array<int>"
_ASKS = "rid long, label long, no int, floor long, high long, low long, vec array<int>"
_FOUND = [("rid", pa.int64()), ("no", pa.int32()), ("item", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())]


def items(df: DataFrame, plan: MiningPlan, id_col="vec_id", vec_col="embedding", label: Column | str = "label") -> DataFrame:
    """rid, vec_id, label, vec (whole numbers) of the rows that take part, numbered when they are written."""
    vec, label = F.col(vec_col), F.col(label) if isinstance(label, str) else label
    sound = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"), vec.alias("vec"), sound.alias("sound"))
    rows = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND vec IS NOT NULL AND sound")
    held = lambda x: F.greatest(F.least(x.cast("double") * plan.scale, F.lit(float(LIMIT))), F.lit(float(-LIMIT)))
    whole = F.transform("vec", lambda x: F.floor(held(x)).cast("int"))
    return staged(rows.select(F.monotonically_increasing_id().alias("rid"), "vec_id", "label", whole.alias("vec")), "mined-items")


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1 if len(column) and len(column[0]) else 0)


# --- the join of one block with one shard ------------------------------------------------------


class SuffixIndex:
    """Rows in an inverted index that leaves out what suffix norms cover, for anchors with given thresholds."""

    def __init__(self, rows: np.ndarray, anchors: np.ndarray, least: float, dims: int):
        n = rows.shape[1]
        self.order = np.argsort(-np.einsum("nd,nd->d", rows, rows), kind="stable")
        self.edges = [*range(0, n, dims), n] if n else [0]
        rows, self.anchors = rows[:, self.order], anchors[:, self.order]
        norms, self.anchor_norms = self._suffix_norms(rows), self._suffix_norms(self.anchors)
        # the first edge from which on the suffix is covered: norms fall, so all later ones are, too
        bound = norms * self.anchor_norms.max(axis=0, initial=0.0)
        covered = bound < least - 1e-6 * abs(least) if np.isfinite(least) else np.zeros_like(bound, bool)
        indexed = np.where(covered.any(axis=1), covered.argmax(axis=1), len(self.edges) - 1)
        self.place = np.argsort(-indexed, kind="stable")  # rows in order of how much of them is indexed
        self.rows, self.norms, self.indexed = rows[self.place], norms[self.place], indexed[self.place]
        self.postings = [int((self.indexed > i).sum()) for i in range(len(self.edges) - 1)]

    def _suffix_norms(self, vectors: np.ndarray) -> np.ndarray:
        squares = np.cumsum((vectors * vectors)[:, ::-1], axis=1)[:, ::-1]
        squares = np.concatenate([squares, np.zeros((len(vectors), 1))], axis=1)
        return np.sqrt(squares[:, self.edges])

    def search(self, start: int, stop: int, thresholds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, row, score) of all pairs of anchors start to stop that can reach their anchor's threshold."""
        asked, norms = self.anchors[start:stop], self.anchor_norms[start:stop]
        slack = thresholds - 1e-9 * (norms[:, 0] * self.norms[:, 0].max(initial=0.0) + 1)
        n_indexed = self.postings[0] if self.postings else len(self.rows)
        partial = np.zeros((len(asked), n_indexed))
        chunks = list(zip(self.edges, self.edges[1:], strict=False))
        pairs, sums = None, None
        for i, (a, b) in enumerate(chunks if n_indexed else []):
            if pairs is None:
                n = self.postings[i]
                partial[:, :n] += asked[:, a:b] @ self.rows[:n, a:b].T
                # what a row has not accumulated starts where its index ends, or after these dimensions
                rest = np.minimum(self.indexed[:n_indexed], i + 1)
                alive = partial + norms[:, rest] * self.norms[np.arange(n_indexed), rest] >= slack[:, None]
                if i + 1 < len(chunks) and alive.mean() < 0.25:  # few pairs: they go on one by one
                    pairs = np.nonzero(alive)
                    sums = partial[pairs]
                    for e in np.unique(rest):  # rows whose index has ended are completed up to here
                        own = rest[pairs[1]] == e
                        sums[own] += self._products(asked, pairs[0][own], pairs[1][own], self.edges[e], b)
            else:
                sums = sums + self._products(asked, *pairs, a, b)
                keep = sums + norms[pairs[0], i + 1] * self.norms[pairs[1], i + 1] >= slack[pairs[0]]
                pairs, sums = (pairs[0][keep], pairs[1][keep]), sums[keep]
        if pairs is None:
            for n, (a, b) in zip(self.postings, chunks, strict=True):
                if n < n_indexed:  # suffixes that are in no list
                    partial[:, n:] += asked[:, a:b] @ self.rows[n:n_indexed, a:b].T
            pairs = np.nonzero(partial >= slack[:, None])
            sums = partial[pairs]
        return pairs[0] + start, self.place[pairs[1]], sums

    def _products(self, asked: np.ndarray, left: np.ndarray, right: np.ndarray, a: int, b: int) -> np.ndarray:
        """Inner products of the pairs over dimensions a to b, in runs of bounded size."""
        runs = [np.einsum("pd,pd->p", asked[left[i : i + 65536], a:b], self.rows[right[i : i + 65536], a:b]) for i in range(0, len(left), 65536)]
        return np.concatenate([np.zeros(0), *runs])


def _windows(same: bool, k: int, plan: MiningPlan):
    """The best k rows of a shard in each window of a block."""

    def run(base: pa.Table, asks: pa.Table) -> pa.Table:
        names = [name for name, _ in _FOUND]
        empty = pa.Table.from_batches([record_batch(_FOUND, *([[]] * len(names)))])
        if not base.num_rows or not asks.num_rows:
            return empty
        rows, item = _matrix(base["vec"]), base["rid"].to_numpy()
        row_id, row_label = base["vec_id"].to_numpy(), base["label"].to_numpy()
        rid, first, anchor = np.unique(asks["rid"].to_numpy(), return_index=True, return_inverse=True)
        anchors, label = _matrix(asks["vec"])[first], asks["label"].to_numpy()[first]
        low, high, no = asks["low"].to_numpy(), asks["high"].to_numpy(), asks["no"].to_numpy()
        thresholds = np.full(len(rid), np.inf)
        np.minimum.at(thresholds, anchor, np.where(low == _LEAST, -np.inf, low.astype(np.float64)))
        by_anchor = np.argsort(anchor, kind="stable")
        starts = np.searchsorted(anchor[by_anchor], np.arange(len(rid) + 1))
        index = SuffixIndex(rows, anchors, float(thresholds.min()), plan.dims)
        exact = np.abs(rows).max(initial=0.0) * np.abs(anchors).max(initial=0.0) * max(rows.shape[1], 1) < 2**53
        out = [[], [], [], [], []]
        for start in range(0, len(rid), 64):
            stop = min(start + 64, len(rid))
            left, right, scores = index.search(start, stop, thresholds[start:stop])
            wanted = ((label[left] == row_label[right]) == same) & (rid[left] != item[right])
            left, right, scores = left[wanted], right[wanted], scores[wanted]
            if exact:
                scores = scores.astype(np.int64)
            else:  # sums of products beyond 2**53 are taken again in whole numbers
                scores = np.concatenate([np.zeros(0, np.int64), *(
                    np.einsum("pd,pd->p", anchors[left[i : i + 4096]].astype(np.int64), rows[right[i : i + 4096]].astype(np.int64))
                    for i in range(0, len(left), 4096)
                )])
            order = np.lexsort((item[right], row_id[right], -scores, left))
            left, right, scores = left[order], right[order], scores[order]
            ends = np.searchsorted(left, np.arange(start, stop + 1))
            for a in range(start, stop):
                own = slice(ends[a - start], ends[a - start + 1])
                falling = -scores[own]
                for w in by_anchor[starts[a] : starts[a + 1]]:
                    # of scores in falling order, those at most high and at least low
                    i = int(np.searchsorted(falling, -high[w] if high[w] != _MOST else _LEAST, "left"))
                    j = int(np.searchsorted(falling, -low[w] if low[w] != _LEAST else _MOST, "right"))
                    chosen = right[own][i : min(j, i + k)]
                    out[0].append(np.full(len(chosen), rid[a]))
                    out[1].append(np.full(len(chosen), no[w]))
                    out[2].append(item[chosen])
                    out[3].append(row_id[chosen])
                    out[4].append(scores[own][i : min(j, i + k)])
        columns = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out]
        return pa.Table.from_batches([record_batch(_FOUND, *columns)])

    return run


# --- rounds ------------------------------------------------------------------------------------


def _lowered(sent, n_rows: dict[int, int], k: int, level: int, plan: MiningPlan):
    """Thresholds of a round: where the normal law of the sample's scores expects so many rows in the window."""
    schema = [("rid", pa.int64()), ("label", pa.int64()), ("no", pa.int32()), ("floor", pa.int64()), ("high", pa.int64()), ("low", pa.int64()), ("vec", pa.list_(pa.int32()))]

    def run(batches):
        law = NormalDist()
        for batch in batches:
            low = []
            for row in batch.select(["floor", "high", "vec"]).to_pylist():
                sample, n = sent.value.get(len(row["vec"])), n_rows[len(row["vec"])]
                more = plan.expected * k * plan.growth**level / n
                low.append(row["floor"])
                if sample is None or more >= 0.25 or not row["vec"]:
                    continue
                scores = sample @ np.array(row["vec"], np.float64)
                mean, spread = float(scores.mean()), float(scores.std())
                above = 1 - law.cdf((row["high"] - mean) / spread) if spread and row["high"] != _MOST else 0.0
                if spread and above + more < 0.5:
                    start = mean + spread * law.inv_cdf(1 - above - more)
                    if start < row["high"]:
                        low[-1] = max(row["floor"], int(start))
            yield record_batch(schema, *(batch.column(c) for c in ("rid", "label", "no", "floor", "high")), low, batch.column("vec"))

    return run


def _cut(base: DataFrame, asks: DataFrame, n_rows: dict[int, int], plan: MiningPlan) -> tuple[DataFrame, DataFrame]:
    """Both sides with the keys by which they meet: every block of windows meets every shard of its length once."""
    counts = {r["width"]: r["count"] for r in asks.groupBy(F.size("vec").alias("width")).count().collect()}  # one row per length
    parts = [(w, -(-n_rows[w] // plan.shard_rows), -(-n // plan.block_rows)) for w, n in counts.items()]
    parts = F.broadcast(base.sparkSession.createDataFrame(parts, "width int, shards int, blocks int"))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    width = F.size("vec").alias("width")
    placed = base.select("*", width).join(parts, "width").withColumn("shard", F.pmod(F.xxhash64("rid"), F.col("shards")).cast("int"))
    placed = placed.withColumn("block", each("blocks")).drop("shards", "blocks")
    # windows of an anchor stay together, so its scores are made once
    asking = asks.select("*", width).join(parts, "width").withColumn("block", F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int"))
    return placed, asking.withColumn("shard", each("shards")).drop("shards", "blocks")


def threshold_join(base: DataFrame, asks: DataFrame, same: bool, k: int, plan: MiningPlan = MiningPlan()) -> DataFrame:
    """rid, no, rank, item, vec_id, score: of every window the first k rows, or all if fewer.

    `asks` has rid (of the row that asks), label, vec, no, and the window's ends floor and high. Rows of the
    same label, or of other labels, take part, never the row itself. Higher scores come first, ties by
    smaller vec_id.
    """
    spark = base.sparkSession
    ship(spark)
    n_rows = {r["width"]: r["count"] for r in base.groupBy(F.size("vec").alias("width")).count().collect()}  # one row per length
    sample = base.orderBy(F.xxhash64("rid")).limit(plan.sample).select("vec").collect()
    widths = {len(r["vec"]) for r in sample}
    sent = spark.sparkContext.broadcast({w: np.array([r["vec"] for r in sample if len(r["vec"]) == w], np.float64) for w in widths})
    place = Window.partitionBy("rid", "no").orderBy(F.desc("score"), "vec_id", "item")
    key, full, level = ["width", "shard", "block"], [], 0
    while True:
        asked = staged(map_arrow(asks.select("rid", "label", "no", "floor", "high", "vec"), _lowered(sent, n_rows, k, level, plan), _ASKS), "mined-asks")
        placed, asking = _cut(base, asked, n_rows, plan)
        met = placed.groupBy(*key).cogroup(asking.groupBy(*key))
        found = met.applyInArrow(_windows(same, k, plan), "rid long, no int, item long, vec_id long, score long")
        found = staged(found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k), "mined-found")
        counts = found.groupBy("rid", "no").agg(F.count(F.lit(1)).alias("n"))
        state = asked.join(counts, ["rid", "no"], "left").withColumn("settled", (F.coalesce("n", F.lit(0)) >= k) | (F.col("low") <= F.col("floor")))
        state = staged(state.drop("n", "low"), "mined-state")
        full.append(found.join(state.where("settled").select("rid", "no"), ["rid", "no"], "left_semi"))
        asks = state.where("NOT settled")
        if not asks.limit(1).count():
            return reduce(DataFrame.union, full)
        level += 1


def _share(score: str, hundredths: int, up: bool) -> Column:
    """Whole part of score * hundredths / 100, or the next whole number, of scores from 0 on; never beyond a long."""
    rest = f"({score} % 100) * {hundredths}" + (" + 99" if up else "")
    return F.expr(f"({score} DIV 100) * {hundredths} + ({rest}) DIV 100")


def hard_negatives(
    df: DataFrame,
    is_anchor: Column,
    plan: MiningPlan = MiningPlan(),
    id_col="vec_id",
    vec_col="embedding",
    label: Column | str = "label",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `is_anchor` is a condition on the column vec_id. Each component becomes floor(scale * x); the score is
    the inner product of these whole numbers. An anchor's positives are its first rows of the same label.
    For each of them the first rows of other labels follow whose score is at least `low_share` and at most
    `high_share` hundredths of the positive's; a positive with a score below 0 has none. Higher scores come
    first, ties by smaller id.

    Rows with a null id, label or vector, or a null or non-finite component take no part. Every other row
    counts: a repeated row is another row for its copies, and as an anchor answers for itself. Vectors meet
    those of their own length; there should be few lengths. Components beyond 2**25 either way are held
    there. An empty table, or one without anchors, gives no rows. Other columns are not read.
    """
    base = items(df, plan, id_col, vec_col, label)
    anchors = base.where(is_anchor)
    ask = anchors.select("rid", "label", "vec", F.lit(1).alias("no"), F.lit(_LEAST).alias("floor"), F.lit(_MOST).alias("high"))
    positives = threshold_join(base, ask, True, plan.positives, plan)
    positives = staged(positives.select("rid", F.col("rank").alias("no"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    ends = positives.where("positive_score >= 0").select(
        "rid", "no", _share("positive_score", plan.low_share, True).alias("floor"), _share("positive_score", plan.high_share, False).alias("high")
    )
    ask = ends.where("floor <= high").join(anchors.select("rid", "label", "vec"), "rid")
    negatives = threshold_join(base, ask, False, plan.negatives, plan)
    named = positives.join(anchors.select("rid", F.col("vec_id").alias("anchor_id")), "rid")
    return negatives.join(named, ["rid", "no"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
