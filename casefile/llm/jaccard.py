"""Jaccard join on word shingles: MinHash candidates, Bayesian pruning, exact verification, classes.

1. Every text gets its set of hashed shingles of five words, a 128-bit digest of the set and a signature
   of 16-bit MinHash values. Texts with equal sets are one entry, with its number of copies.
2. Entries whose signatures agree in a band meet in a bucket. Buckets of one entry go; large ones are cut
   into blocks, and pairs of blocks are compared, so no task holds more than two blocks.
3. Inside a bucket a pair is compared value by value, in a few steps. After each step it goes if the
   posterior probability (uniform prior) that its similarity reaches the threshold is below the
   tolerance. A pair is looked at only in the first band where it agrees.
4. Buckets with a pair left fetch the entries' shingle sets, compare again and verify what is left
   exactly. No pair leaves the task: it gives each entry's number of links and a forest of the links.
5. The forests are joined by label propagation to connected components: the classes.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casefile.llm.common import bytes_of, carried_schema, list_array, map_arrow, record_batch, slices, staged, with_columns


@dataclass(frozen=True)
class JaccardPlan:
    threshold: float = 0.8
    words: int = 5
    bands: int = 25
    band_values: int = 4  # of 16 bits: a band is one long
    tolerance: float = 1e-6  # posterior below which a pair is dropped
    step: int = 16  # values compared before the next decision
    block: int = 256  # entries per block of a large bucket
    seed: int = 29

    @property
    def values(self) -> int:
        return self.bands * self.band_values


# --- shingles and signatures -------------------------------------------------------------------


def _mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (shift, multiply)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = np.uint64(0xD1342543DE82EF95)  # odd: it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words (everything between ASCII white space), in order.

    Sums of byte codes times powers of an odd base, taken as differences of running sums and shifted to a
    common power, so that equal words have equal hashes wherever they stand.
    """
    data = np.frombuffer(text, np.uint8)
    if not len(data):
        return np.empty(0, np.uint64)
    inside = ~_SPACE[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    powers = _powers(_BASE, len(data))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * powers, dtype=np.uint64)])
    words = (total[ends] - total[starts]) * _powers(_INVERSE, len(data))[starts]
    return _mix(words + (ends - starts).astype(np.uint64))


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    known = _POWERS.get(int(base))
    if known is None or len(known) < n:
        size = max(n, 1 << 16)
        known = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, base)]), dtype=np.uint64)
        if size <= 1 << 22:
            _POWERS[int(base)] = known
    return known[:n]


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles. A text with fewer words is one shingle; without words, none."""
    own = word_hashes(text)
    if not len(own):
        return own
    n = max(len(own) - words + 1, 1)
    shingles = np.zeros(n, np.uint64)
    for i in range(min(words, len(own))):
        shingles = _mix(shingles * np.uint64(3) + own[i : i + n])
    return np.unique(_mix(shingles + np.uint64(min(words, len(own)))))


def signature(shingles: np.ndarray, values: int, seed: int) -> np.ndarray:
    """16 bits of each of `values` MinHash values; the minimum is taken over all 64 bits."""
    rng = np.random.default_rng(seed)
    factors = rng.integers(1, 1 << 63, values, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    offsets = rng.integers(0, 1 << 63, values, dtype=np.uint64)
    least = np.full(values, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 512):
        part = shingles[start : start + 512, None] * factors
        part += offsets
        part ^= part >> np.uint64(32)
        part *= np.uint64(0x9E3779B97F4A7C15)
        np.minimum(least, part.min(axis=0), out=least)
    return (least >> np.uint64(48)).astype(np.uint16)


# --- pairs -------------------------------------------------------------------------------------


def least_matches(plan: JaccardPlan) -> list[tuple[int, int]]:
    """(values compared, matches below which the pair goes), for every step.

    With a uniform prior, m matches among n make the similarity Beta(m + 1, n - m + 1); the chance that it
    reaches t is the chance of at most m successes in n + 1 trials of probability t.
    """
    t, steps = plan.threshold, []
    for n in range(plan.step, plan.values - plan.band_values + 1, plan.step):
        tail, m = 0.0, -1
        while m < n:
            tail += comb(n + 1, m + 1) * t ** (m + 1) * (1 - t) ** (n - m)
            if tail >= plan.tolerance:
                break
            m += 1
        steps.append((n, m + 1))
    return steps


def prune(signatures: np.ndarray, left: np.ndarray, right: np.ndarray, band: np.ndarray, plan: JaccardPlan) -> np.ndarray:
    """Which pairs (rows left, right of the signatures) remain; `band` is where each pair met."""
    bands = np.ascontiguousarray(signatures).view(np.uint64).reshape(len(signatures), plan.bands)
    alive = np.arange(len(left))
    for b in range(int(band.max(initial=0))):  # a pair that agrees in an earlier band was looked at there
        earlier = (band[alive] > b) & (bands[left[alive], b] == bands[right[alive], b])
        alive = alive[~earlier]
    matches = np.zeros(len(left), np.int32)
    done = 0
    for n, least in least_matches(plan):
        # values after the band where the pair met, then those before it
        at = (band[alive, None] * plan.band_values + plan.band_values + np.arange(done, n)) % plan.values
        matches[alive] += (signatures[left[alive, None], at] == signatures[right[alive, None], at]).sum(axis=1)
        alive = alive[matches[alive] >= least]
        done = n
        if not len(alive):
            break
    keep = np.zeros(len(left), bool)
    keep[alive] = True
    return keep


def _group_pairs(sizes: np.ndarray, side: np.ndarray, same_block: np.ndarray):
    """Index pairs inside consecutive groups, in runs of bounded size. Two-block groups pair across sides only."""
    starts = np.cumsum(sizes) - sizes
    lefts, rights, held = [], [], 0
    for start, size, same in zip(starts.tolist(), sizes.tolist(), same_block.tolist(), strict=True):
        if same:
            a, b = _triangle(size)
        else:
            own = side[start : start + size]
            first, second = np.flatnonzero(own == 0), np.flatnonzero(own == 1)
            a, b = np.repeat(first, len(second)), np.tile(second, len(first))
        lefts.append(a + start)
        rights.append(b + start)
        held += len(a)
        if held > 200_000:
            yield np.concatenate(lefts), np.concatenate(rights)
            lefts, rights, held = [], [], 0
    if lefts:
        yield np.concatenate(lefts), np.concatenate(rights)


_TRIANGLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _triangle(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n not in _TRIANGLES:
        _TRIANGLES[n] = np.triu_indices(n, 1)
    return _TRIANGLES[n]


def _whole_groups(batches, n_keys: int):
    """Regroup sorted batches into tables that hold whole groups; the first `n_keys` columns are the key."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch])
        keys = np.stack([table.column(i).to_numpy() for i in range(n_keys)], axis=1)
        changes = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        cut = int(changes[-1]) if len(changes) else 0
        if cut:
            yield table.slice(0, cut), np.diff(np.concatenate([[0], changes]))
        rest = table.slice(cut)
    if rest is not None and rest.num_rows:
        yield rest, np.array([rest.num_rows])


def _remaining_pairs(table: pa.Table, sizes: np.ndarray, plan: JaccardPlan):
    """Pairs of the bucket groups in the table that the pruning leaves."""
    signatures = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint16).reshape(-1, plan.values)
    starts = np.cumsum(sizes) - sizes
    same = (table.column("block_a").to_numpy() == table.column("block_b").to_numpy())[starts]
    band, side = table.column("band").to_numpy(), table.column("side").to_numpy()
    for left, right in _group_pairs(sizes, side, same):
        keep = prune(signatures, left, right, band[left], plan)
        if keep.any():
            yield left[keep], right[keep]


_KEY = ["band", "key", "block_a", "block_b"]


def _candidate_rows(plan: JaccardPlan):
    schema = [("band", pa.int32()), ("key", pa.int64()), ("block_a", pa.int32()), ("block_b", pa.int32()), ("side", pa.int32()), ("entry", pa.binary())]

    def run(batches):
        for table, sizes in _whole_groups(batches, 4):
            involved = np.zeros(table.num_rows, bool)
            for left, right in _remaining_pairs(table, sizes, plan):
                involved[left] = involved[right] = True
            kept = table.filter(pa.array(involved)).combine_chunks()
            for batch in kept.to_batches():
                yield record_batch(schema, *(batch.column(name) for name, _ in schema))

    return run


def _verified_rows(plan: JaccardPlan):
    """Per entry of a group: documents and entries linked, and the entry's root in the group's forest."""
    schema = [("entry", pa.binary()), ("hub", pa.binary()), ("n_links", pa.int64()), ("n_text_links", pa.int64())]

    def run(batches):
        for table, sizes in _whole_groups(batches, 4):
            sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
            entries, copies = table.column("entry").to_pylist(), table.column("copies").to_numpy()
            links = np.zeros(table.num_rows, np.int64)
            texts = np.zeros(table.num_rows, np.int64)
            root = list(range(table.num_rows))

            def find(i: int) -> int:
                while root[i] != i:
                    root[i] = root[root[i]]
                    i = root[i]
                return i

            for left, right in _remaining_pairs(table, sizes, plan):
                for a, b in zip(left.tolist(), right.tolist(), strict=True):
                    x, y = sets[a], sets[b]
                    if min(len(x), len(y)) < plan.threshold * max(len(x), len(y)) - 1e-9:
                        continue
                    common = len(x) + len(y) - _union_size(x, y)
                    if common < plan.threshold * (len(x) + len(y) - common) - 1e-9:
                        continue
                    links[a] += copies[b]
                    links[b] += copies[a]
                    texts[a] += 1
                    texts[b] += 1
                    p, q = find(a), find(b)
                    if p != q:
                        root[max(p, q)] = min(p, q)
            at = np.flatnonzero(texts)
            hubs = [entries[find(int(i))] for i in at]
            yield record_batch(schema, [entries[i] for i in at], hubs, links[at], texts[at])

    return run


def _union_size(x: np.ndarray, y: np.ndarray) -> int:
    both = np.concatenate([x, y])
    both.sort(kind="stable")  # two sorted runs: merged
    return int(1 + np.count_nonzero(both[1:] != both[:-1]))


# --- the join ----------------------------------------------------------------------------------


def _sketch_rows(plan: JaccardPlan):
    """doc_id, set digest (null without words), signature."""
    schema = [("doc_id", pa.int64()), ("entry", pa.binary()), ("sig", pa.binary())]

    def run(batches):
        for batch in (part for whole in batches for part in slices(whole, 1)):
            digests, signatures = [], []
            for text in bytes_of(batch.column(1)):
                shingles = shingle_set(text, plan.words)
                digests.append(_digest(shingles) if len(shingles) else None)
                signatures.append(signature(shingles, plan.values, plan.seed).tobytes() if len(shingles) else None)
            yield with_columns(record_batch(schema, batch.column(0), digests, signatures), batch, 2)

    return run


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _set_rows(plan: JaccardPlan):
    schema = [("entry", pa.binary()), ("shingles", pa.binary())]

    def run(batches):
        for batch in (part for whole in batches for part in slices(whole, 0)):
            sets = [shingle_set(text, plan.words) for text in bytes_of(batch.column(0))]
            yield record_batch(schema, list(map(_digest, sets)), [x.tobytes() for x in sets])

    return run


def _band_rows(plan: JaccardPlan):
    schema = [("entry", pa.binary()), ("bands", pa.list_(pa.int64()))]

    def run(batches):
        for batch in batches:
            flat = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int64)
            yield record_batch(schema, batch.column(0), list_array(flat, [plan.bands] * batch.num_rows, pa.int64()))

    return run


def link_entries(
    df: DataFrame, plan: JaccardPlan = JaccardPlan(), id_col="doc_id", text_col="text", carry: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """(documents, entries): doc_id with its entry and carried columns; entry with copies, first id, links, class."""
    doc, text = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    row_key = F.xxhash64(doc, text).alias("row_key_")  # never null, whatever the id
    chosen = df.select(row_key, text.alias("text"))
    carrying = df.select(doc.alias("doc_id"), text.alias("text"), row_key, *carry)
    schema = carried_schema("doc_id long, entry binary, sig binary, row_key_ long", df, carry)
    sketches = staged(map_arrow(carrying, _sketch_rows(plan), schema), "sketches")
    entries = sketches.where("entry IS NOT NULL").groupBy("entry").agg(
        F.count(F.lit(1)).alias("copies"),
        F.min("doc_id").alias("first_id"),
        F.min("row_key_").alias("row_key_"),
        F.any_value("sig").alias("sig"),
    )
    entries = staged(entries, "entries")

    # Buckets with two entries or more; a large one is cut into blocks, and every entry meets each block.
    banded = map_arrow(entries.select("entry", "sig"), _band_rows(plan), "entry binary, bands array<long>")
    banded = banded.select("entry", F.posexplode("bands").alias("band", "key"))
    buckets = banded.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = staged(banded.join(buckets, ["band", "key"]), "buckets")
    blocks = F.ceil(F.col("n") / plan.block).cast("int")
    own = F.when(F.col("n") <= plan.block, F.lit(0)).otherwise(F.pmod(F.xxhash64("entry"), blocks).cast("int"))
    paired = met.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    paired = paired.select(
        "band", "key", F.least("own", "other").alias("block_a"), F.greatest("own", "other").alias("block_b"),
        (F.col("own") > F.col("other")).cast("int").alias("side"), "entry",
    )
    signed = paired.join(entries.select("entry", "sig", "copies", "first_id"), "entry")
    order = [*_KEY, "entry"]
    grouped = signed.select(*_KEY, "side", "entry", "sig").repartition(*_KEY).sortWithinPartitions(*order)
    key_schema = "band int, key long, block_a int, block_b int, side int, entry binary"
    candidates = staged(map_arrow(grouped, _candidate_rows(plan), key_schema), "candidates")

    # Shingle sets of the entries in question, from one document each.
    asked = entries.join(candidates.select("entry").distinct(), "entry").select("entry", "row_key_", "sig", "copies")
    sets = staged(_shingles_of(chosen, asked.select("entry", "row_key_"), plan), "shingles")
    full = candidates.join(asked.select("entry", "sig", "copies"), "entry").join(sets, "entry")
    full = full.select(*_KEY, "side", "entry", "sig", "copies", "shingles").repartition(*_KEY).sortWithinPartitions(*order)
    out = "entry binary, hub binary, n_links long, n_text_links long"
    verified = staged(map_arrow(full, _verified_rows(plan), out), "links")
    labels = components(verified.select("entry", "hub"))
    links = verified.groupBy("entry").agg(F.sum("n_links").alias("n_links"), F.sum("n_text_links").alias("n_text_links"))
    linked = links.join(labels, "entry")
    return sketches.select("doc_id", "entry", *carry), entries.drop("sig", "row_key_").join(linked, "entry", "left")


def _shingles_of(chosen: DataFrame, asked: DataFrame, plan: JaccardPlan) -> DataFrame:
    """entry, shingles of the entries asked for, read again from the rows with the least key.

    Only rows whose key's slot is among those asked for are shuffled: 2**18 slots at most are broadcast,
    whatever the number of entries. Rows of equal id (or none) and text share a key and are all read.
    """
    slot = F.pmod("row_key_", F.lit(1 << 18)).alias("slot")
    slots = asked.select(slot).distinct()
    near = chosen.withColumn("slot", slot).join(F.broadcast(slots), "slot", "left_semi").drop("slot")
    texts = near.join(asked.select("row_key_").distinct(), "row_key_", "left_semi").select("text")
    sets = map_arrow(texts, _set_rows(plan), "entry binary, shingles binary")
    return sets.join(asked.select("entry"), "entry", "left_semi").groupBy("entry").agg(F.any_value("shingles").alias("shingles"))


def components(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """entry, root of the connected components of (entry, hub): every node takes the least label near it, then its label's label.

    Nodes are those with links only. Each round writes its labels to the shared folder; the number of
    rounds grows with the logarithm of the longest chain.
    """
    both = edges.union(edges.select("hub", "entry")).where("entry != hub").distinct()
    both = staged(both.toDF("a", "b"), "edges")
    nodes = edges.select("entry").union(edges.select("hub")).distinct()
    labels = staged(nodes.select("entry", F.col("entry").alias("root")), "labels")
    for _ in range(most_rounds):
        near = both.join(labels.select(F.col("entry").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("near"))
        lower = labels.join(near.withColumnRenamed("a", "entry"), "entry", "left")
        lower = lower.select("entry", "root", F.least("root", F.coalesce("near", "root")).alias("low"))
        up = labels.select(F.col("entry").alias("low"), F.col("root").alias("jump"))
        moved = lower.join(up, "low").select("entry", "root", F.least("low", "jump").alias("low"))
        moved = staged(moved, "labels")
        changed = moved.where("low < root").limit(1).count()
        labels = moved.select("entry", F.col("low").alias("root"))
        if not changed:
            return labels
    raise RuntimeError(f"classes have not settled after {most_rounds} rounds")


def classes(
    df: DataFrame, plan: JaccardPlan = JaccardPlan(), id_col="doc_id", text_col="text", carry: tuple[str, ...] = ()
) -> DataFrame:
    """doc_id, class_id, n_links, n_text_links of every row, and the columns named in `carry`.

    Documents are linked when the Jaccard similarity of their sets of five-word shingles is at least the
    threshold; a text of fewer words is one shingle. `class_id` is the smallest id of those connected
    through links, `n_links` the number of other rows linked, `n_text_links` of other texts (shingle sets).
    Null texts and texts without words link with nothing: they are their own class. A null id stays null;
    it takes part, and its class is the smallest id that is not null. Repeated rows are copies. An empty
    table gives no rows. Other columns are not read.

    What can be missed, by choice of the parameters: a pair at the threshold that agrees in no band (1.9
    in a million), or whose posterior falls below the tolerance (about one in a million).
    """
    documents, entries = link_entries(df, plan, id_col, text_col, carry)
    entries = entries.withColumn("root", F.coalesce("root", "entry"))
    entries = staged(entries, "classes")
    least = entries.groupBy("root").agg(F.min("first_id").alias("class_id"))
    named = entries.join(least, "root").select(
        "entry",
        "class_id",
        (F.col("copies") - 1 + F.coalesce("n_links", F.lit(0))).alias("links"),
        F.coalesce("n_text_links", F.lit(0)).alias("text_links"),
    )
    return documents.join(named, "entry", "left").select(
        "doc_id",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("text_links", F.lit(0)).cast("long").alias("n_text_links"),
        *carry,
    )
