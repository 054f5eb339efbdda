"""Mixing sources to target weights by Sainte-Lague apportionment of equal blocks of words.

Targets come from weights, a cap per source and resharing of the excess. Blocks of `block_words` words
are handed to sources by highest quotients target / (2 n + 1), each source's blocks to its shards in the
same way by their words. A shard lays its documents end to end in a seeded order and cuts them into
blocks; a quota of q out of m blocks is floor(q / m) whole passes and a seeded choice of the rest. What a
document gives is its overlap with the blocks taken.

A shard is a hash bucket of one source's documents, so a source with a third of all rows is many groups.
The driver handles one row per source and per shard; there are at most `max_shards` shards and one more
per source.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from casefile.llm.common import small, staged
from casefile.llm.text_stats import word_array


@dataclass(frozen=True)
class MixPlan:
    weights: tuple[int, ...] = (5, 2, 1)  # by source in code-point order, null last, repeating
    share: float = 1.5  # of all words, to be taken
    repeats: int = 2  # of one document at most
    block_words: int = 64
    shard_words: int = 500_000
    max_shards: int = 4096
    seed: int = 17


def targets(sizes: dict[str | None, int], plan: MixPlan) -> dict[str | None, float]:
    """Words each source should give: by weight, at most `repeats` times its size, the excess reshared by weight."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: plan.weights[i % len(plan.weights)] for i, s in enumerate(order)}
    result: dict[str | None, float] = {}
    left, free = plan.share * sum(sizes.values()), list(order)
    while free:
        unit = left / sum(weight[s] for s in free)
        full = [s for s in free if unit * weight[s] > plan.repeats * sizes[s]]
        if not full:
            result.update({s: unit * weight[s] for s in free})
            break
        for s in full:
            result[s] = float(plan.repeats * sizes[s])
            left -= result[s]
        free = [s for s in free if s not in result]
    return result


def sainte_lague(votes: dict, seats: int, room: dict | None = None) -> dict:
    """Seats by highest quotients votes / (2 n + 1); ties to the key that comes first. No key gets more than its room.

    All but the last few seats are given at once: with a divisor a little too large, rounding
    votes / divisor gives every key no more than it ends with.
    """
    given = dict.fromkeys(votes, 0)
    open_keys = [k for k, v in votes.items() if v > 0 and (room is None or room[k] > 0)]
    total = sum(votes[k] for k in open_keys)
    spare = seats - len(open_keys) / 2
    if open_keys and spare > 0:
        for k in open_keys:
            given[k] = min(math.ceil(votes[k] * spare / total - 0.5), room[k] if room else seats)
    position = {k: i for i, k in enumerate(votes)}
    heap = [(-votes[k] / (2 * given[k] + 1), position[k], k) for k in open_keys if room is None or given[k] < room[k]]
    heapq.heapify(heap)
    left = seats - sum(given.values())
    while heap and left > 0:
        _, i, k = heapq.heappop(heap)
        given[k] += 1
        left -= 1
        if room is None or given[k] < room[k]:
            heapq.heappush(heap, (-votes[k] / (2 * given[k] + 1), i, k))
    return given


def _stride(blocks: int, seed: str) -> tuple[int, int]:
    """A seeded bijection b -> (a b + c) mod blocks."""
    digest = hashlib.sha256(seed.encode("utf-8", "surrogatepass")).digest()
    a, c = (int.from_bytes(digest[i : i + 8], "big") % max(blocks, 1) for i in (0, 8))
    a = max(a, 1)
    while math.gcd(a, blocks) != 1:
        a = a % blocks + 1
    return a, c


def plan_mix(shard_sizes: list[tuple[str | None, int, int]], plan: MixPlan) -> list[tuple]:
    """(source, shard, source_size, target, passes, extra, blocks, a, c) for every (source, shard, words)."""
    sizes: dict[str | None, int] = {}
    by_source: dict[str | None, dict[int, int]] = {}
    for source, shard, words in sorted(shard_sizes, key=lambda x: (x[0] is None, x[0] or "", x[1])):
        sizes[source] = sizes.get(source, 0) + words
        by_source.setdefault(source, {})[shard] = words
    goal = targets(sizes, plan)
    block = plan.block_words
    blocks = {s: {shard: -(-words // block) for shard, words in own.items()} for s, own in by_source.items()}
    room = {s: plan.repeats * sum(own.values()) for s, own in blocks.items()}
    seats = sainte_lague(goal, round(sum(goal.values()) / block), room)
    rows = []
    for source, own in by_source.items():
        quota = sainte_lague(own, seats[source], {k: plan.repeats * n for k, n in blocks[source].items()})
        for shard, q in quota.items():
            n = blocks[source][shard]
            passes, extra = divmod(q, n) if n else (0, 0)
            a, c = _stride(n, f"{plan.seed}/{source}/{shard}") if n else (1, 0)
            rows.append((source, shard, sizes[source], float(goal[source]), passes, extra, n, a, c))
    return rows


_PLAN = (
    "p_source string, p_shard int, source_size long, target double, passes long, extra long, blocks long, a long, c long"
)


def mix(
    df: DataFrame,
    plan: MixPlan = MixPlan(),
    id_col="doc_id",
    text_col="text",
    source_col="source",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, source, text, size, source_size, target, taken, parts of every row, and the columns named in `carry`.

    `parts` lists what is taken: (first word, words, times) in order, empty if nothing is. `taken` is
    words x times, at most `repeats` x size. Null and empty texts have size 0 and give nothing. A null
    source is a source of its own, the last. Repeated rows are documents each; which of them gives more is
    open, as they are equal. Shards, and the order in one, are by a seeded hash of id and text, so reruns
    agree and rows that share an id, or have none, are many groups. An empty table gives no rows; other columns are not read.
    """
    spark = df.sparkSession
    text = F.col(text_col).cast("string")
    rows = df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        text.alias("text"),
        F.size(word_array(text)).cast("long").alias("size"),
        *_text_hashes(text),
        *carry,
    )
    return _mixed(spark, rows, plan, carry)


def mix_sizes(df: DataFrame, plan: MixPlan = MixPlan(), id_col="doc_id", text_col="text", source_col="source") -> DataFrame:
    """As `mix`, without texts and parts: sizes are counted once, written, and texts never shuffled."""
    sizes = df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        F.size(word_array(F.col(text_col).cast("string"))).cast("long").alias("size"),
        *_text_hashes(F.col(text_col).cast("string")),
    )
    return _mixed(df.sparkSession, staged(sizes, "mix-sizes"), plan).drop("parts")


def _text_hashes(text) -> list:
    """128 bits that tell the rows of one id apart."""
    return [F.xxhash64(text).alias("t1_"), F.xxhash64(F.lit(1), text).alias("t2_")]


def _mixed(spark, rows: DataFrame, plan: MixPlan, carry: tuple[str, ...] = ()) -> DataFrame:
    totals = rows.groupBy("source").agg(F.sum("size").alias("words")).collect()  # one row per source
    all_words = max(sum(r["words"] for r in totals), 1)
    per_shard = max(plan.shard_words, all_words / plan.max_shards)
    counts = [(r["source"], max(1, math.ceil(r["words"] / per_shard))) for r in totals]
    shards = spark.createDataFrame(counts, "s_source string, n_shards int")
    order = F.xxhash64("doc_id", "t1_", F.lit(plan.seed))
    placed = rows.join(small(shards, len(counts)), F.col("source").eqNullSafe(F.col("s_source")))
    placed = placed.withColumn("shard", F.pmod(order, F.col("n_shards")).cast("int")).drop("s_source", "n_shards")
    shard_sizes = placed.groupBy("source", "shard").agg(F.sum("size").alias("words")).collect()
    planned = spark.createDataFrame(plan_mix([tuple(r) for r in shard_sizes], plan), _PLAN)
    in_shard = Window.partitionBy("source", "shard").orderBy("place", "doc_id", "size", "t1_", "t2_")
    ended = placed.withColumn("place", F.xxhash64(order)).withColumn(
        "ends", F.sum("size").over(in_shard.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    chosen = ended.join(
        small(planned, len(shard_sizes)), F.col("source").eqNullSafe(F.col("p_source")) & (F.col("shard") == F.col("p_shard"))
    )
    b = plan.block_words
    parts = F.expr(
        f"""
        CASE WHEN size = 0 THEN CAST(array() AS ARRAY<STRUCT<first: BIGINT, words: BIGINT, times: BIGINT>>) ELSE
        filter(transform(sequence((ends - size) DIV {b}, (ends - 1) DIV {b}), k -> named_struct(
            'first', greatest(k * {b} - (ends - size), 0L),
            'words', least((k + 1) * {b}, ends) - greatest(k * {b}, ends - size),
            'times', passes + CASE WHEN pmod(a * k + c, blocks) < extra THEN 1L ELSE 0L END)), x -> x.times > 0) END
        """
    )
    taken = F.aggregate("parts", F.lit(0).cast("long"), lambda total, x: total + x["words"] * x["times"])
    kept = [c for c in ("doc_id", "source", "text", "size") if c in rows.columns]
    return chosen.withColumn("parts", parts).select(*kept, "source_size", "target", taken.alias("taken"), "parts", *carry)


def taken_texts(mixed: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, copy, text and carried columns: one row for the parts taken at least once, one more for each further time.

    The text of a row is its parts in order with the white space inside and before them; a row that takes
    the whole document has the document's text.
    """
    tokens = F.expr(r"regexp_extract_all(text, '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+', 0)")
    times = F.coalesce(F.array_max(F.transform("parts", lambda x: x["times"])), F.lit(0)).cast("int")
    rows = mixed.withColumn("tokens", tokens).withColumn("copies", times).where("copies > 0")
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    own = F.filter("parts", lambda x: x["times"] >= F.col("copy"))
    words = F.aggregate(own, F.lit(0).cast("long"), lambda n, x: n + x["words"])
    slices = F.transform(own, lambda x: F.slice("tokens", (x["first"] + 1).cast("int"), x["words"].cast("int")))
    joined = F.regexp_replace(F.array_join(F.flatten(slices), ""), r"^[\x20\x09-\x0D]+", "")
    text = F.when(words == F.col("size"), F.col("text")).otherwise(joined)
    return rows.select("doc_id", "source", "copy", text.alias("text"), *carry)
