"""Approximate nearest neighbours by posting lists, balanced as far as the sample shows.

Centroids come from a balanced k-means over a bounded sample; lists of a tight cluster can be far longer than others. Every vector goes to the lists of its
nearest centroids, up to `replicas` of them, as long as their distance is within a ratio of the nearest:
vectors at a boundary are in several lists. A query searches the graph of centroids, keeps the lists
within another ratio of its nearest centroid, and compares itself with all vectors in them, exactly and
in double precision.

Equal vectors are one entry with its smallest ids, which loses no answer, so a vector that a third of
all rows share is one entry. Lists are handled in groups of neighbouring lists; a group with many
vectors is cut into shards, one with many queries into blocks, and every block goes to every shard. The driver holds the sample and the
centroids, both bounded by parameters.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from casefile.llm.common import map_arrow, record_batch, ship, staged


@dataclass(frozen=True)
class AnnPlan:
    list_size: int = 64  # vectors per list aimed at
    max_lists: int = 4096  # bounds the centroids sent to every executor
    sample: int = 20_000  # vectors the centroids are fitted on; at least 4 per list
    replicas: int = 4
    replica_ratio: float = 1.3  # of the distance to the nearest centroid
    probe_ratio: float = 1.28
    min_probes: int = 8
    lists_per_group: int = 16
    shard_rows: int = 8192
    block_rows: int = 8192  # queries of a group that meet a shard in one task
    degree: int = 24


class CentroidGraph:
    """Unit centroids with edges to near and to random others; searched best first, many queries at once."""

    def __init__(self, centroids: np.ndarray, degree: int, seed: int = 7):
        self.centroids = centroids
        n = len(centroids)
        degree = min(degree, n - 1)
        near = np.empty((n, max(degree, 0)), np.int32)
        for start in range(0, n, 1024):
            close = centroids[start : start + 1024] @ centroids.T
            close[np.arange(len(close)), np.arange(start, start + len(close))] = -np.inf
            if degree:
                near[start : start + 1024] = np.argpartition(-close, degree - 1, axis=1)[:, :degree]
        random = np.random.default_rng(seed).integers(0, n, (n, 8)).astype(np.int32)
        ring = ((np.arange(n) + 1) % n).astype(np.int32)[:, None]  # every centroid can be reached
        self.edges = np.concatenate([near, random, ring], axis=1)
        self.entries = np.unique(np.linspace(0, n - 1, min(n, 32)).astype(np.int32))

    def search(self, queries: np.ndarray, beam: int, ratio: float, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Found centroids and distances per query (unit vectors), nearest first; -1 and infinity beyond those kept.

        Kept are those within `ratio` of the nearest, and the `least` nearest.
        """
        n, k = len(queries), len(self.centroids)
        beam = min(beam, k)
        at = np.arange(n)[:, None]
        seen = np.zeros((n, k), bool)
        ids = np.broadcast_to(self.entries, (n, len(self.entries))).copy()
        seen[at, ids] = True
        distances = self._distances(queries, ids)
        done = np.zeros(ids.shape, bool)
        width = 4 if beam <= 64 else 16 if beam <= 1024 else 64
        while True:
            order = np.argsort(distances, axis=1, kind="stable")[:, :beam]
            ids, distances, done = (np.take_along_axis(x, order, 1) for x in (ids, distances, done))
            edge = distances[:, :1] * ratio + 1e-9
            useful = ~done & (distances < np.inf) & ((distances <= edge) | (np.arange(ids.shape[1]) < max(least, 16)))
            if not useful.any():
                break
            chosen = np.argsort(~useful, axis=1, kind="stable")[:, :width]
            valid = np.take_along_axis(useful, chosen, 1)
            np.put_along_axis(done, chosen, valid | np.take_along_axis(done, chosen, 1), 1)
            new = self.edges[np.take_along_axis(ids, chosen, 1)].reshape(n, -1)
            fresh = np.repeat(valid, self.edges.shape[1], axis=1) & ~seen[at, new]
            new_distances = np.where(fresh, self._distances(queries, new), np.inf)
            by_id = np.argsort(new, axis=1, kind="stable")  # one centroid can come from several edges
            new, new_distances = np.take_along_axis(new, by_id, 1), np.take_along_axis(new_distances, by_id, 1)
            new_distances[:, 1:][new[:, 1:] == new[:, :-1]] = np.inf
            row, column = np.nonzero(new_distances < np.inf)
            seen[row, new[row, column]] = True
            ids = np.concatenate([ids, new], axis=1)
            distances = np.concatenate([distances, new_distances], axis=1)
            done = np.concatenate([done, new_distances == np.inf], axis=1)
        keep = (distances <= distances[:, :1] * ratio + 1e-9) | (np.arange(ids.shape[1]) < least)
        keep &= distances < np.inf
        return np.where(keep, ids, -1), np.where(keep, distances, np.inf)

    def _distances(self, queries: np.ndarray, ids: np.ndarray) -> np.ndarray:
        close = np.einsum("nd,nmd->nm", queries, self.centroids[ids])
        return np.sqrt(np.maximum(2.0 - 2.0 * close, 0.0))


def balanced_centroids(sample: np.ndarray, k: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """Spherical k-means whose assignment pays for lists that are already long. Neighbouring lists get neighbouring numbers."""
    rng = np.random.default_rng(seed)
    centroids = sample[rng.choice(len(sample), k, replace=False)].copy()
    sizes = np.zeros(k)
    for _ in range(rounds):
        penalty = 0.1 * (sizes / max(len(sample) / k, 1.0) - 1.0).clip(0, 10)
        owner = np.concatenate([
            (sample[i : i + 4096] @ centroids.T - penalty).argmax(axis=1) for i in range(0, len(sample), 4096)
        ])
        sizes = np.bincount(owner, minlength=k).astype(float)
        sums = np.zeros_like(centroids)
        np.add.at(sums, owner, sample)
        empty = sizes == 0
        sums[empty] = sample[rng.choice(len(sample), int(empty.sum()))]
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(norms > 1e-12, sums / np.maximum(norms, 1e-12), centroids)
    coarse = centroids[rng.choice(k, max(k // 16, 1), replace=False)]
    return centroids[np.argsort((centroids @ coarse.T).argmax(axis=1), kind="stable")]


def _valid(vector: Column) -> Column:
    """Neither null nor zero, and every component finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def usable(df: DataFrame, id_col="vec_id", vec_col="embedding") -> DataFrame:
    """id, vec, k1, k2: rows that take part, with a 128-bit key of the vector."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"))
    rows = rows.where(F.col("id").isNotNull() & _valid(F.col("vec")))
    return rows.select("id", "vec", F.xxhash64("vec").alias("k1"), F.xxhash64(F.lit(1), F.col("vec")).alias("k2"))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of an Arrow list column as doubles; all lists have the same length."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True, initial=1e-300)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Each vector by a power of two that brings its largest component near 1: the cosine is the same to the last bit,
    and squares of very large or small components neither overflow nor vanish."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1, initial=0.0))
    return np.ldexp(vectors, -exponent[:, None])


def nearest(
    df: DataFrame, is_query: Column, k: int = 5, plan: AnnPlan = AnnPlan(), id_col="vec_id", vec_col="embedding"
) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest rows found for every query row, by cosine.

    `is_query` is a condition on the column `id`. Vectors that are null, zero or hold null or non-finite
    components take no part, nor do rows without an id. Vectors are compared with those of their own length;
    every length that a query has gets its own index, so there should be few. Ties in the score go to the
    smaller id. A repeated row counts once; an id with several vectors is a candidate with its nearest, and
    as a query gets what is nearest to any.
    With fewer than k candidates all are returned; an empty table gives no rows. Other columns are not read.
    """
    spark = df.sparkSession
    ship(spark)
    kind = df.schema[vec_col].dataType.simpleString()
    empty = "query_id long, rank int, vec_id long, score double"
    rows = usable(df, id_col, vec_col)
    lengths = rows.groupBy(F.size("vec").alias("n")).agg(F.count_if(is_query).alias("asking")).where("asking > 0").collect()
    if not lengths:
        return spark.createDataFrame([], empty)
    keep = k + 1  # a query's own row may be among them
    found = [_found(rows.where(F.size("vec") == r["n"]), is_query, keep, plan, kind) for r in sorted(lengths)]
    members = rows.where(is_query).select("id", "k1", "k2").distinct()
    pairs = reduce(DataFrame.union, found).select("k1", "k2", F.explode(F.arrays_zip("ids", "scores")).alias("x"))
    pairs = pairs.groupBy("k1", "k2", F.col("x.ids").alias("id")).agg(F.max("x.scores").alias("score"))
    best = pairs.groupBy("k1", "k2").agg(
        F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("minus"), "id"))), 1, keep).alias("best")
    )
    own = members.join(best, ["k1", "k2"]).select("id", "best")
    # An id with several vectors asks with each of them.
    asks = own.groupBy("id").agg(F.array_distinct(F.sort_array(F.flatten(F.collect_list("best")))).alias("best"))
    others = F.slice(F.filter("best", lambda x: x["id"] != F.col("id")), 1, k)
    ranked = asks.select(F.col("id").alias("query_id"), F.posexplode(others).alias("at", "x"))
    return ranked.select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), (-F.col("x.minus")).alias("score")
    )


def _found(rows: DataFrame, is_query: Column, keep: int, plan: AnnPlan, kind: str) -> DataFrame:
    """k1, k2 of the queries with ids and scores found in each shard, among rows of one length."""
    spark = rows.sparkSession
    place = F.row_number().over(Window.partitionBy("k1", "k2").orderBy("id"))
    # Spark keeps the first ids of a key in every map task, before the shuffle.
    firsts = rows.dropDuplicates(["k1", "k2", "id"]).withColumn("place", place).where(F.col("place") <= keep)
    entries = firsts.groupBy("k1", "k2").agg(F.any_value("vec").alias("vec"), F.sort_array(F.collect_list("id")).alias("ids"))
    entries = staged(entries, "ann-entries")
    graph = _fit(entries, plan)
    sent = spark.sparkContext.broadcast(graph)  # at most max_lists centroids and their edges
    base = staged(map_arrow(entries.select("k1", "k2", "vec", "ids"), _posting(sent, plan, kind), _BASE.format(kind)), "ann-lists")
    asked = rows.where(is_query).groupBy("k1", "k2").agg(F.any_value("vec").alias("vec"))
    routed = staged(map_arrow(asked, _routing(sent, plan, kind), _ROUTED.format(kind)), "ann-routed")
    placed, routed = _cut(base, routed, plan)
    found = placed.groupBy("grp", "shard", "block").cogroup(routed.groupBy("grp", "shard", "block"))
    return found.applyInArrow(_compare(keep), "k1 long, k2 long, ids array<long>, scores array<double>")


def _cut(base: DataFrame, routed: DataFrame, plan: AnnPlan) -> tuple[DataFrame, DataFrame]:
    """Both sides with shard and block, by which they meet: every query of a group meets every row once, in bounded parts."""
    # One row per group of lists: at most max_lists / lists_per_group.
    rows = {r["grp"]: r["count"] for r in base.groupBy("grp").count().collect()}
    queries = {r["grp"]: r["count"] for r in routed.groupBy("grp").count().collect()}
    parts = [(g, -(-n // plan.shard_rows), -(-queries[g] // plan.block_rows)) for g, n in rows.items() if g in queries]
    parts = F.broadcast(base.sparkSession.createDataFrame(parts, "grp int, shards int, blocks int"))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    placed = base.join(parts, "grp").withColumn("shard", F.pmod("k1", F.col("shards")).cast("int")).withColumn("block", each("blocks"))
    asking = routed.join(parts, "grp").withColumn("block", F.pmod("k2", F.col("blocks")).cast("int")).withColumn("shard", each("shards"))
    return placed.drop("shards", "blocks"), asking.drop("shards", "blocks")


_BASE = "grp int, list int, k1 long, k2 long, ids array<long>, vec {}"
_ROUTED = "grp int, k1 long, k2 long, lists array<int>, vec {}"


def _fit(entries: DataFrame, plan: AnnPlan) -> CentroidGraph:
    n = entries.count()
    k = int(min(max(-(-n // plan.list_size), min(n, plan.min_probes)), plan.max_lists))
    sample = entries.orderBy("k1", "k2").limit(max(plan.sample, 4 * k)).select("vec").toArrow()["vec"]
    return CentroidGraph(balanced_centroids(_unit(_matrix(sample.combine_chunks())), k), plan.degree)


def _element(kind: str) -> pa.DataType:
    return pa.list_({"array<float>": pa.float32(), "array<double>": pa.float64()}.get(kind, pa.float64()))


def _blocks(batches, rows: int = 256):
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _posting(sent, plan: AnnPlan, kind: str):
    schema = [("grp", pa.int32()), ("list", pa.int32()), ("k1", pa.int64()), ("k2", pa.int64()), ("ids", pa.list_(pa.int64())), ("vec", _element(kind))]

    def run(batches):
        for batch in _blocks(batches):
            lists, _ = sent.value.search(_unit(_matrix(batch.column(2))), 24, plan.replica_ratio, 1)
            lists = lists[:, : plan.replicas]
            row, at = np.nonzero(lists >= 0)
            own = lists[row, at]
            taken = batch.take(pa.array(row))
            yield record_batch(schema, own // plan.lists_per_group, own, taken.column(0), taken.column(1), taken.column(3), taken.column(2))

    return run


def _routing(sent, plan: AnnPlan, kind: str):
    schema = [("grp", pa.int32()), ("k1", pa.int64()), ("k2", pa.int64()), ("lists", pa.list_(pa.int32())), ("vec", _element(kind))]

    def run(batches):
        for batch in _blocks(batches):
            lists, _ = sent.value.search(_unit(_matrix(batch.column(2))), plan.max_lists, plan.probe_ratio, plan.min_probes)
            row, at = np.nonzero(lists >= 0)
            own = lists[row, at]
            order = np.lexsort((own, row))
            row, own = row[order], own[order]
            group = own // plan.lists_per_group
            first = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (group[1:] != group[:-1])))
            offsets = np.append(first, len(own)).astype(np.int32)
            taken = batch.take(pa.array(row[first]))
            grouped = pa.ListArray.from_arrays(pa.array(offsets), pa.array(own.astype(np.int32)))
            yield record_batch(schema, group[first], taken.column(0), taken.column(1), grouped, taken.column(2))

    return run


def _compare(keep: int):
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("ids", pa.list_(pa.int64())), ("scores", pa.list_(pa.float64()))])

    def run(base: pa.Table, asked: pa.Table) -> pa.Table:
        if not base.num_rows or not asked.num_rows:
            return schema.empty_table()
        base, asked = base.combine_chunks(), asked.combine_chunks()
        k1 = base["k1"].to_numpy()
        k2 = base["k2"].to_numpy()
        _, first, entry = np.unique(np.stack([k1, k2], 1), axis=0, return_index=True, return_inverse=True)
        entry = entry.reshape(-1)
        vectors = _scaled(_matrix(base["vec"].chunk(0))[first])
        ids = [base["ids"][int(i)].as_py() for i in first]
        lists, local = np.unique(base["list"].to_numpy(), return_inverse=True)
        held = np.zeros((len(lists), len(first)), bool)  # list x entry
        held[local.reshape(-1), entry] = True
        norms = np.linalg.norm(vectors, axis=1)
        queries = _scaled(_matrix(asked["vec"].chunk(0)))
        probes = asked["lists"].to_pylist()
        out: list[tuple] = []
        for start in range(0, len(queries), 256):
            block = queries[start : start + 256]
            wanted = np.array([np.isin(lists, p) for p in probes[start : start + 256]])
            scores = (block @ vectors.T) / (np.linalg.norm(block, axis=1)[:, None] * norms)
            scores[~(wanted.astype(np.float32) @ held.astype(np.float32) > 0)] = -np.inf
            n = min(keep, scores.shape[1])
            edge = np.partition(scores, -n, axis=1)[:, -n] - 1e-9
            for i, row in enumerate(scores):
                near = np.flatnonzero((row >= edge[i]) & (row > -np.inf))
                # the score proper, summed in one order whatever the block
                exact = np.einsum("d,nd->n", block[i], vectors[near]) / (np.sqrt(np.einsum("d,d->", block[i], block[i])) * np.sqrt(np.einsum("nd,nd->n", vectors[near], vectors[near])))
                answers = sorted((-s, j) for s, e in zip(exact.tolist(), near, strict=True) for j in ids[e])[:keep]
                out.append(([j for _, j in answers], [-s for s, _ in answers]))
        return pa.Table.from_arrays(
            [asked["k1"], asked["k2"], pa.array([a for a, _ in out], schema.field("ids").type), pa.array([b for _, b in out], schema.field("scores").type)],
            schema=schema,
        )

    return run
