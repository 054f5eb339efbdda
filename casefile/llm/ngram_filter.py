"""Language-model scores from a log-frequency Bloom filter of n-gram counts.

1. N-grams of the training texts are hashed to 64 bits and counted on the cluster, in segments of the hash
   range that hold about as many n-grams each, whatever the corpus.
2. A count c is quantised to the level 1 + floor(log c / log base). An n-gram of level q enters the filter
   as the q items (n-gram, 1) to (n-gram, q). To look it up is to probe for one level after the other until
   one is absent: the levels present tell the count. All bits of an item lie in one word of 64 bits, so a
   probe is one look-up. A false positive raises a count by one level with a chance of 3 to 4 in a hundred,
   by two with the square of that. A segment has bits in proportion to its items, so this chance is the same
   at every size.
3. A filter of up to `broadcast_bytes`, by the segments' sizes, is sent to every worker. A larger one stays
   in its segments: texts are dealt into chunks, a chunk's n-grams go to their segments, and the levels found
   go back to the chunk. Both ways probe the same bits, so the scores do not depend on the way.
4. The probability of a word after a context of n - 1 is (count of both + mass x probability after n - 2) /
   (count of the context + mass), down to that of the word alone, (count + 1) / (N + V + 1). No count is
   taken to exceed that of a part of the n-gram.

Beside the score every text gets the exact unigram score. Counts of the most frequent words, a number set
by a parameter, are sent to the workers; a text's other words meet their counts in a join.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casefile.llm.common import bytes_of, map_arrow, record_batch, slices, staged


@dataclass(frozen=True)
class LmPlan:
    order: int = 2
    base: float = 1.5  # of the quantising logarithm
    item_bits: int = 8  # of the filter for each item
    hashes: int = 4  # of them that an item sets; 5 at most
    mass: float = 16.0  # of the shorter context's probability
    broadcast_bytes: int = 128 << 20
    frequent: int = 1 << 17  # words whose counts every worker gets
    frequent_bytes: int = 64  # of such a word at most
    segment_grams: int = 1 << 21  # occurrences of n-grams in a segment
    gram_bytes: int = 6 << 20  # of text whose n-grams a worker counts at once
    chunk_bytes: int = 8 << 20  # of text, where the filter is too large to send


END = b""  # the token after a text's last word; no word is empty


# --- n-grams of texts --------------------------------------------------------------------------


def _scramble(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_BEGIN = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD1342543DE82EF95)


class _Numbers(dict):
    """Word -> its number in order of first sight."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class Grams:
    """The tokens of some texts as numbers, and the hash of the n-gram that ends at every token."""

    def __init__(self, texts: list[bytes], order: int):
        numbers = _Numbers()
        end = numbers[END]
        owned, lengths = [], []
        for text in texts:
            words = text.lower().split()  # of bytes: A-Z only, at ASCII white space only
            own = np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))
            owned += [own, np.array([end], np.int32)]
            lengths.append(len(words) + 1)
        self.words = list(numbers)
        self.tokens = np.concatenate(owned) if owned else np.zeros(0, np.int32)
        self.lengths = np.array(lengths, np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.doc = np.repeat(np.arange(len(texts), dtype=np.int32), self.lengths)
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, self.words), np.uint64, len(self.words))
        self.first = np.zeros(len(self.tokens), bool)  # of its text
        self.first[self.starts] = True
        own = hashes[self.tokens]
        begun = _scramble(np.full(1, _BEGIN))[0]
        self.word_keys = _scramble(hashes)
        self.keys = [self.word_keys[self.tokens]]  # of n-grams of 1, 2, … ending at each token
        before = begun  # of n - 1 marks of the beginning
        for _ in range(1, order):
            left = np.concatenate([[before], self.keys[-1][:-1]]) if len(own) else self.keys[-1]
            left = np.where(self.first, before, left)
            self.keys.append(_scramble(left * _STEP + own))
            before = _scramble(np.array([before * _STEP + _BEGIN]))[0]

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct keys of all orders, and how often each is met."""
        found = [(self.word_keys, np.bincount(self.tokens, minlength=len(self.words)))]
        found += [np.unique(keys, return_counts=True) for keys in self.keys[1:]]
        keys, counts = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(keys)
        return keys[order], counts[order]


np.seterr(over="ignore")  # hashes wrap around


# --- the filter --------------------------------------------------------------------------------


def level_edges(base: float) -> np.ndarray:
    """Least count of the levels 1, 2, … that a long can reach."""
    edges = [1]
    power = base
    while power < 2**62:
        edges.append(int(np.ceil(power)))
        power *= base
    return np.array(edges, np.int64)


def levels_of(counts: np.ndarray, base: float) -> np.ndarray:
    """1 + floor(log count / log base), 0 of 0."""
    return np.searchsorted(level_edges(base), counts, "right")


def expected_counts(base: float) -> np.ndarray:
    """Mean of the counts of a level, by level; 0 for level 0."""
    edges = level_edges(base)
    return np.concatenate([[0.0], (edges[:-1] + np.maximum(edges[1:] - 1, edges[:-1])) / 2, [float(edges[-1])]])


def _items(keys: np.ndarray, level: int, hashes: int, n_words) -> tuple[np.ndarray, np.ndarray]:
    """The word of the items (key, level) in a segment, and their bits in it."""
    mixed = _scramble(keys + np.uint64(level) * _BEGIN)
    mask = np.zeros(len(keys), np.uint64)
    for i in range(hashes):
        mask |= np.uint64(1) << ((mixed >> np.uint64(6 * i)) & np.uint64(63))
    return ((mixed >> np.uint64(32)) * n_words) >> np.uint64(32), mask


def fill(keys: np.ndarray, levels: np.ndarray, plan: LmPlan) -> bytes:
    """A segment of the filter."""
    n_words = max(int(levels.sum()) * plan.item_bits // 64, 1)
    words = np.zeros(n_words, np.uint64)
    for level in range(1, int(levels.max(initial=0)) + 1):
        word, mask = _items(keys[levels >= level], level, plan.hashes, np.uint64(n_words))
        np.bitwise_or.at(words, word, mask)
    return words.tobytes()


class LogFilter:
    """Segments of the filter (number, words as bytes), by the first bits of the key."""

    def __init__(self, segments, n_segments: int, hashes: int):
        self.hashes, self.n_segments = hashes, n_segments
        self.sizes, self.offsets = np.zeros(n_segments, np.uint64), np.zeros(n_segments, np.uint64)
        parts, at = [], 0
        for number, words in segments:
            self.sizes[number], self.offsets[number] = len(words) // 8, at
            parts.append(words)
            at += len(words) // 8
        self.words = np.frombuffer(b"".join(parts), np.uint64)

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Levels of the keys: probes go on to the next level while all bits of the last were set."""
        segment = segment_of(keys, self.n_segments)
        sizes, offsets = self.sizes[segment], self.offsets[segment]
        found = np.zeros(len(keys), np.uint8)
        alive, level = np.flatnonzero(sizes > 0), 0
        while len(alive) and level < 255:
            level += 1
            word, mask = _items(keys[alive], level, self.hashes, sizes[alive])
            alive = alive[self.words[word + offsets[alive]] & mask == mask]
            found[alive] = level
        return found


def segment_of(keys: np.ndarray, n_segments: int) -> np.ndarray:
    """Segment of each key; their number is a power of two, and sorted keys have rising segments."""
    bits = n_segments.bit_length() - 1
    return (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


# --- learning ----------------------------------------------------------------------------------


def _word_rows(batches):
    """(token, n) of every batch."""
    schema = [("token", pa.binary()), ("n", pa.int64())]
    for batch in batches:
        if batch.num_rows:
            found = Counter(chain.from_iterable(text.lower().split() for text in bytes_of(batch.column(0))))
            yield record_batch(schema, [END, *found], [batch.num_rows, *found.values()])


def _gram_rows(plan: LmPlan, n_segments: int):
    """(segment, sorted keys, their counts) of every batch."""
    schema = [("segment", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())]

    def run(batches):
        # about 20 bytes of memory for a byte of text
        for batch in (part for whole in batches for part in slices(whole, 0, plan.gram_bytes)):
            keys, counts = Grams(bytes_of(batch.column(0)), plan.order).distinct()
            yield record_batch(schema, *_split(keys, n_segments, keys, counts.astype(np.uint32)))

    return run


def _split(keys: np.ndarray, n_segments: int, *columns: np.ndarray) -> tuple:
    """Segments met by sorted keys, and each column's run of every one of them as bytes."""
    segment = segment_of(keys, n_segments)
    first = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]])) if len(keys) else np.zeros(0, np.int64)
    ends = np.append(first[1:], len(keys))
    return segment[first], *([c[a:b].tobytes() for a, b in zip(first, ends, strict=True)] for c in columns)


def _filter_rows(plan: LmPlan):
    schema = [("segment", pa.int32()), ("bits", pa.binary())]

    def run(table: pa.Table) -> pa.Table:
        keys = np.frombuffer(b"".join(table["keys"].to_pylist()), np.uint64)
        counts = np.frombuffer(b"".join(table["counts"].to_pylist()), np.uint32)
        distinct, at = np.unique(keys, return_inverse=True)
        totals = np.bincount(at, weights=counts).astype(np.int64)
        bits = fill(distinct, levels_of(totals, plan.base), plan)
        return pa.Table.from_batches([record_batch(schema, [table["segment"][0].as_py()], [bits])])

    return run


@dataclass(frozen=True)
class NgramModel:
    plan: LmPlan
    n_docs: int
    n_tokens: int
    n_types: int
    frequent: dict  # word -> count; at most plan.frequent words of plan.frequent_bytes
    words: DataFrame  # token, n of every word
    segments: DataFrame  # segment, bits
    n_segments: int


def fit(training: DataFrame, plan: LmPlan = LmPlan(), text_col="text") -> NgramModel:
    """Count all texts of `training`: words exactly, n-grams into the filter's segments. A null text is an empty one."""
    text = training.select(F.col(text_col).cast("string").alias("text"))
    words = map_arrow(text, _word_rows, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))
    words = staged(words, "lm-words")
    total = words.agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("types"), F.max(F.when(F.length("token") == 0, F.col("n"))).alias("docs")).first()
    n_tokens = total["tokens"] or 0
    n_segments = 1 << max(0, int(np.ceil(np.log2(max(plan.order * n_tokens / plan.segment_grams, 1)))))
    rows = map_arrow(text, _gram_rows(plan, n_segments), "segment int, keys binary, counts binary")
    segments = staged(rows.groupBy("segment").applyInArrow(_filter_rows(plan), "segment int, bits binary"), "lm-filter")
    short = words.where(F.length("token") <= plan.frequent_bytes)
    frequent = short.orderBy(F.desc("n"), "token").limit(plan.frequent).toArrow()
    counts = dict(zip(frequent["token"].to_pylist(), frequent["n"].to_pylist(), strict=True))
    return NgramModel(plan, total["docs"] or 0, n_tokens, total["types"], counts, words, segments, n_segments)


# --- scoring -----------------------------------------------------------------------------------

_SCORED = [("doc_id", pa.int64()), ("copies", pa.int64()), ("n_tokens", pa.int64()), ("known", pa.int64()), ("base", pa.float64()), ("score", pa.float64()),
           ("rare", pa.list_(pa.struct([("token", pa.binary()), ("times", pa.int64())])))]
_SCORED_SCHEMA = "doc_id long, copies long, n_tokens long, known long, base double, score double, rare array<struct<token: binary, times: bigint>>"


@dataclass(frozen=True)
class _Scorer:
    """What a worker needs beside the filter."""

    plan: LmPlan
    n_docs: int
    n_classes: int  # N + V + 1
    frequent: dict

    def rows(self, ids, copies, texts: list[bytes], lookup: Callable[[np.ndarray], np.ndarray]) -> pa.RecordBatch:
        grams = Grams(texts, self.plan.order)
        counts = np.fromiter((self.frequent.get(w, -1) for w in grams.words), np.int64, len(grams.words))[grams.tokens]
        frequent = counts >= 0
        known = np.add.reduceat(frequent, grams.starts, dtype=np.int64)
        base = np.add.reduceat(np.where(frequent, np.log10((np.maximum(counts, 0) + 1.0) / self.n_classes), 0.0), grams.starts)
        score = np.add.reduceat(np.log10(self._probabilities(grams, lookup)), grams.starts)
        # the other words of each text with their times, text by text
        pairs, times = np.unique(grams.doc[~frequent].astype(np.int64) * len(grams.words) + grams.tokens[~frequent], return_counts=True)
        doc, word = np.divmod(pairs, max(len(grams.words), 1))
        structs = pa.StructArray.from_arrays([pa.array(grams.words, pa.binary()).take(pa.array(word)), pa.array(times, pa.int64())], ["token", "times"])
        edges = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(texts)))])
        rare = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), structs)
        return record_batch(_SCORED, ids, copies, grams.lengths, known, base, score, rare)

    def _probabilities(self, grams: Grams, lookup) -> np.ndarray:
        means = expected_counts(self.plan.base)

        def count(keys: np.ndarray) -> np.ndarray:
            distinct, at = np.unique(keys, return_inverse=True)
            return means[lookup(distinct)][at]

        shorter = means[lookup(grams.word_keys)][grams.tokens]
        p = (shorter + 1) / self.n_classes
        for keys in grams.keys[1:]:
            context = np.where(grams.first, self.n_docs, np.concatenate([[0.0], shorter[:-1]]))
            both = np.minimum(np.minimum(count(keys), context), shorter)
            p = (both + self.plan.mass * p) / (context + self.plan.mass)
            shorter = both
        return p


def _sent_rows(scorer, bits):
    """Scores of batches, with a filter that every worker has."""

    def run(batches):
        for batch in (part for whole in batches for part in slices(whole, 1)):
            if batch.num_rows:
                yield scorer.value.rows(batch.column(0), [1] * batch.num_rows, bytes_of(batch.column(1)), bits.value.levels)

    return run


def _request_rows(plan: LmPlan, n_segments: int):
    schema = [("segment", pa.int32()), ("chunk", pa.int64()), ("keys", pa.binary())]

    def run(table: pa.Table) -> pa.Table:
        keys, _ = Grams(bytes_of(table["text"].combine_chunks()), plan.order).distinct()
        segment, runs = _split(keys, n_segments, keys)
        return pa.Table.from_batches([record_batch(schema, segment, [table["chunk"][0].as_py()] * len(segment), runs)])

    return run


def _answer_rows(plan: LmPlan, n_segments: int):
    schema = [("chunk", pa.int64()), ("segment", pa.int32()), ("levels", pa.binary())]

    def run(asked: pa.Table, segment: pa.Table) -> pa.Table:
        held = LogFilter(zip(*(segment[c].to_pylist() for c in ("segment", "bits")), strict=True), n_segments, plan.hashes)
        levels = [held.levels(np.frombuffer(x.as_py(), np.uint64)).tobytes() for chunk in asked["keys"].chunks for x in chunk]
        return pa.Table.from_batches([record_batch(schema, asked["chunk"].combine_chunks(), asked["segment"].combine_chunks(), levels)])

    return run


def _chunk_rows(scorer):
    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return pa.Table.from_batches([], pa.schema(_SCORED))
        own = bytes_of(texts["text"].combine_chunks())
        keys, _ = Grams(own, scorer.value.plan.order).distinct()
        found = dict(zip(answers["segment"].to_pylist(), answers["levels"].to_pylist(), strict=True))
        levels = np.frombuffer(b"".join(found[s] for s in sorted(found)), np.uint8)  # in the order of the keys
        lookup = lambda asked: levels[np.searchsorted(keys, asked)]
        return pa.Table.from_batches([scorer.value.rows(texts["doc_id"].combine_chunks(), texts["copies"].combine_chunks(), own, lookup)])

    return run


def _by_segments(rows: DataFrame, model: NgramModel, scorer) -> DataFrame:
    """Scores with the filter left in its segments. Equal rows are one with its number of copies, so that a chunk is bounded."""
    keyed = rows.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64(F.lit(1), "doc_id", "text").alias("k2"))
    once = keyed.groupBy("doc_id", "k1", "k2").agg(F.any_value("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    once = staged(once, "lm-texts")
    n_bytes = once.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunk = F.pmod("k1", F.lit(max(1, -(-n_bytes // model.plan.chunk_bytes)))).alias("chunk")
    once = once.select("doc_id", "text", "copies", chunk)
    asked = once.groupBy("chunk").applyInArrow(_request_rows(model.plan, model.n_segments), "segment int, chunk long, keys binary")
    answers = asked.groupBy("segment").cogroup(model.segments.groupBy("segment"))
    answers = answers.applyInArrow(_answer_rows(model.plan, model.n_segments), "chunk long, segment int, levels binary")
    found = once.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_chunk_rows(scorer), _SCORED_SCHEMA)
    return found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copy")


def score(df: DataFrame, model: NgramModel, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every row.

    Tokens are the words between ASCII white space, A-Z in lower case, and one end. `base_score` is the sum
    of log10((c + 1) / (N + V + 1)) over the tokens, exactly; `n_known` counts the tokens with c > 0; `score`
    is the model's log10 probability of the text. A null text is an empty one: its end only. A null id stays
    null; repeated rows are scored each; without a training text every token has probability 1; an empty
    table gives no rows. Other columns are not read.
    """
    spark = df.sparkSession
    n_classes = model.n_tokens + model.n_types + 1
    # bounded by plan.frequent and plan.frequent_bytes
    scorer = spark.sparkContext.broadcast(_Scorer(model.plan, model.n_docs, n_classes, model.frequent))
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    size = model.segments.agg(F.sum(F.octet_length("bits"))).first()[0] or 0
    if size <= model.plan.broadcast_bytes:
        held = [(r["segment"], bytes(r["bits"])) for r in model.segments.collect()]
        sent = spark.sparkContext.broadcast(LogFilter(held, model.n_segments, model.plan.hashes))
        found = map_arrow(rows, _sent_rows(scorer, sent), _SCORED_SCHEMA)
    else:
        found = _by_segments(rows, model, scorer)
    # numbered when they are written: from here on a row is its number
    found = staged(found.drop("copies").withColumn("row", F.monotonically_increasing_id()), "lm-scored")
    rare = found.select("row", F.explode("rare").alias("x")).select("row", "x.token", "x.times")
    met = rare.join(model.words, "token", "left")
    share = F.col("times") * F.log10((F.coalesce("n", F.lit(0)) + 1.0) / F.lit(float(n_classes)))
    sums = met.groupBy("row").agg(F.sum(share).alias("more"), F.sum(F.when(F.col("n") > 0, F.col("times"))).alias("met"))
    return found.join(sums, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("known") + F.coalesce("met", F.lit(0))).alias("n_known"),
        F.lit(model.n_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        "score",
    )


def held_out(id_column: Column, folds: int = 7, fold: int = 2) -> Column:
    return F.pmod(F.crc32(id_column.cast("string").cast("binary")), F.lit(folds)) == fold
