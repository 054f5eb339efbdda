"""Spelling variants: words one edit apart, found among the sorted rotations of terminator-marked words.

1. Words are counted over all texts and numbered by falling count, equal counts by code point: of two words
   the one to prefer has the smaller number, and from here on numbers stand for words.
2. A word w$ (with its terminator) is rotated to every start. The rotation that ends in the character at i,
   without it, is v$u for w = u c v. Words that differ in this character only share it as a prefix, and the
   word uv is a rotation equal to it. So a replacement, an insertion and a deletion are each one prefix range.
3. Rotations are dealt by that prefix and sorted; a scan over each run of equal prefixes gives every word in
   it the number of its neighbours there and the best of them. A run holds one word per character of the
   alphabet and one more at most, whatever the corpus, and no pair is written. Two words meet in one run
   only: deleting any character of a stretch of equal ones gives one word, so the first of the stretch counts.
4. A form has at least ten times its word's count, so chains of forms are short; pointer doubling ends them.

A prefix of more than `LONG` characters is represented by a fingerprint of 124 bits, computed from running
sums for all rotations of a word at once: the work of a word of any length is linear in it.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass
from itertools import accumulate, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casefile.llm.common import map_arrow, record_batch, slices, staged, texts_of

TERMINATOR = "$"  # in no word
LONG = 128


@dataclass(frozen=True)
class SpellingPlan:
    min_chars: int = 7
    min_count: int = 2
    form_ratio: int = 10  # a form is at least so many times as frequent as its word
    letters: str = r"A-Za-zÀ-ÿ"
    slip_every: int = 31  # runs whose checksum it divides lose a letter; 0: none do


# --- words -------------------------------------------------------------------------------------


def slipped(run: str, prefix_sum: int, every: int) -> str:
    """The run, or without one letter if its checksum, continued from that of `<doc_id>:`, is divisible."""
    h = zlib.crc32(run.encode("utf-8"), prefix_sum)
    if not every or h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


_UPPER = {code: code + 32 for code in range(65, 91)}


def _word_rows(plan: SpellingPlan):
    """(word, n) of every batch."""
    schema = [("word", pa.string()), ("n", pa.int64())]
    # a run shorter than the least word gives none, so a match is a whole run: what is before it is no letter
    runs = re.compile(f"[{plan.letters}]{{{plan.min_chars},}}")

    def run(batches):
        for batch in (part for whole in batches for part in slices(whole, 1)):
            found: Counter[str] = Counter()
            for doc_id, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                start = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
                for own, times in Counter(runs.findall(text)).items():
                    found[slipped(own.translate(_UPPER), start, plan.slip_every)] += times
            words = [w for w in found if len(w) >= plan.min_chars]
            yield record_batch(schema, words, [found[w] for w in words])

    return run


def word_counts(df: DataFrame, plan: SpellingPlan = SpellingPlan(), id_col="doc_id", text_col="text") -> DataFrame:
    """rank, word, n of the words that occur often enough; ranks rise with falling n, then by code point."""
    chosen = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counted = map_arrow(chosen, _word_rows(plan), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    # written before it is sorted: the ranges of the sort are found by a run of their own
    words = staged(counted.where(F.col("n") >= plan.min_count), "words")
    ordered = words.orderBy(F.desc("n"), "word").select(F.monotonically_increasing_id().alias("rank"), "word", "n")
    return staged(ordered, "ranked-words")


# --- rotations ---------------------------------------------------------------------------------

# Primes below 2**31 and a multiplier for each.
_LANES = ((2147483647, 1103515245), (2147483629, 69069), (2147483587, 1664525), (2147483579, 22695477))


def fingerprints(codes: np.ndarray, starts: np.ndarray, length: int) -> list[str]:
    """Of each substring codes[start : start + length]; equal substrings have equal ones wherever they start."""
    parts = []
    for prime, base in _LANES:
        powers = np.fromiter(accumulate(repeat(base, len(codes)), lambda x, b: x * b % prime, initial=1), np.int64, len(codes) + 1)
        inverse = pow(base, -1, prime)
        undo = np.fromiter(accumulate(repeat(inverse, len(codes)), lambda x, b: x * b % prime, initial=1), np.int64, len(codes) + 1)
        total = np.concatenate([[0], np.cumsum((codes + 1) * powers[:-1] % prime)]) % prime
        parts.append((total[starts + length] - total[starts]) % prime * undo[starts] % prime)
    return ["#%08x%08x%08x%08x" % own for own in zip(*(p.tolist() for p in parts), strict=True)]


def rotations(word: str) -> tuple[list[str], list[int]]:
    """Prefixes of the word's rotations with marks: 0 for a whole rotation, else the code of the character
    skipped, times two, plus one if it is the first of a stretch of equal ones."""
    n = len(word)
    twice = (word + TERMINATOR) * 2
    codes = [ord(c) for c in word]
    first = [1] + [int(a != b) for a, b in zip(codes[1:], codes, strict=False)]
    marks = [2 * c + f for c, f in zip(codes, first, strict=True)] + [0] * (n + 1)
    if n < LONG:  # neither prefix is longer than LONG
        return [twice[i + 1 : i + 1 + n] for i in range(n)] + [twice[i : i + n + 1] for i in range(n + 1)], marks
    points = np.array([ord(c) for c in twice], np.int64)
    skip = [twice[i + 1 : i + 1 + n] for i in range(n)] if n <= LONG else fingerprints(points, np.arange(1, n + 1), n)
    return skip + fingerprints(points, np.arange(n + 1), n + 1), marks


def _rotation_rows(batches):
    schema = [("prefix", pa.string()), ("mark", pa.int32()), ("rank", pa.int64())]
    prefixes, marks, ranks = [], [], []
    for batch in batches:
        for rank, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            own, own_marks = rotations(word)
            prefixes += own
            marks += own_marks
            ranks += [rank] * len(own)
            if len(prefixes) > 100_000:
                yield record_batch(schema, prefixes, marks, ranks)
                prefixes, marks, ranks = [], [], []
    yield record_batch(schema, prefixes, marks, ranks)


_NEAR = [("rank", pa.int64()), ("n_near", pa.int64()), ("best", pa.int64())]
_NONE = np.iinfo(np.int64).max


def scan(run: np.ndarray, mark: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rank, number of neighbours and best neighbour of the words that have any, for runs 0, 1, … of equal prefixes sorted by rank."""
    n_runs = int(run[-1]) + 1 if len(run) else 0
    whole, first = mark == 0, mark % 2 == 1

    def least(chosen: np.ndarray, at: int) -> np.ndarray:
        """The chosen row of each run with the `at`-th smallest rank, as its rank."""
        rows = np.flatnonzero(chosen)
        own = run[rows]
        place = np.arange(len(rows)) - np.searchsorted(own, own)
        out = np.full(n_runs, _NONE)
        out[own[place == at]] = rank[rows[place == at]]
        return out

    skipping = np.bincount(run[~whole], minlength=n_runs)
    of_first = np.bincount(run[first], minlength=n_runs)
    whole_rank, best, second = least(whole, 0), least(~whole, 0), least(~whole, 1)
    has_whole = whole_rank < _NONE
    near = np.where(whole, of_first[run], skipping[run] - 1 + (first & has_whole[run]))
    other = np.where(best[run] == rank, second[run], best[run])
    other = np.where(first, np.minimum(other, whole_rank[run]), other)
    other = np.where(whole, least(first, 0)[run], other)
    met = near > 0
    return rank[met], near[met], other[met]


def _scan_rows(batches):
    """Runs of equal prefixes in sorted rows; a run can go on in the next batch."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch]).combine_chunks()
        prefix = table.column(0).combine_chunks()
        changes = np.flatnonzero(pc.not_equal(prefix[1:], prefix[:-1]).to_numpy(zero_copy_only=False)) + 1 if len(prefix) > 1 else []
        cut = int(changes[-1]) if len(changes) else 0
        rest = table.slice(cut)
        if cut:
            yield _near_rows(table.slice(0, cut), np.concatenate([[0], changes]))
    if rest is not None and rest.num_rows:
        yield _near_rows(rest, np.array([0, rest.num_rows]))


def _near_rows(table: pa.Table, edges: np.ndarray) -> pa.RecordBatch:
    sizes = np.diff(edges)
    several = np.repeat(sizes > 1, sizes)
    run = np.repeat(np.cumsum(sizes > 1) - 1, sizes)[several]
    return record_batch(_NEAR, *scan(run, table.column(1).to_numpy()[several], table.column(2).to_numpy()[several]))


# --- forms and roots ---------------------------------------------------------------------------


def roots(forms: DataFrame, most_rounds: int = 64) -> DataFrame:
    """rank, root from (rank, form): forms followed to the last. Every round doubles the steps taken and is written."""
    reached = staged(forms.select("rank", F.col("form").alias("root")), "roots")
    for _ in range(most_rounds):
        further = reached.select(F.col("rank").alias("root"), F.col("root").alias("next"))
        moved = staged(reached.join(further, "root", "left").select("rank", F.coalesce("next", "root").alias("root"), "next"), "roots")
        done = not moved.where("next IS NOT NULL").limit(1).count()
        reached = moved.select("rank", "root")
        if done:
            return reached
    raise RuntimeError(f"forms have not ended after {most_rounds} rounds")


def variants(df: DataFrame, plan: SpellingPlan = SpellingPlan(), id_col="doc_id", text_col="text") -> DataFrame:
    """word, form, root, n, n_near, form_n of every word.

    Words are maximal runs of letters with A-Z in lower case, of which the ones that `slipped` names have
    lost a letter; those of at least `min_chars` code points and `min_count` occurrences count. Near words
    differ by one inserted, deleted or replaced code point. The form is the near word of largest n (ties:
    smallest by code point) if that is at least `form_ratio` times the word's n, else null; the root is the
    last of the forms followed from the word, the word itself without a form.

    A null text holds no word. A null id is written as an empty text where the id enters the checksum.
    Every row is a text, so repeated rows count each. An empty table, or one without such words, gives no
    rows. Other columns are not read.
    """
    words = word_counts(df, plan, id_col, text_col)
    rotated = map_arrow(words.select("rank", "word"), _rotation_rows, "prefix string, mark int, rank long")
    rotated = rotated.repartition("prefix").sortWithinPartitions("prefix", "rank")
    near = map_arrow(rotated, _scan_rows, "rank long, n_near long, best long")
    near = near.groupBy("rank").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    named = words.select(F.col("rank").alias("best"), F.col("word").alias("best_word"), F.col("n").alias("best_n"))
    known = words.join(near, "rank", "left").join(named, "best", "left")
    takes = F.col("best_n") >= plan.form_ratio * F.col("n")
    known = known.select(
        "rank", "word", "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(takes, F.col("best")).alias("form_rank"),
        F.when(takes, F.col("best_word")).alias("form"),
        F.when(takes, F.col("best_n")).alias("form_n"),
    )
    known = staged(known, "near-words")
    ends = roots(known.where("form_rank IS NOT NULL").select("rank", F.col("form_rank").alias("form")))
    ends = ends.join(words.select(F.col("rank").alias("root"), F.col("word").alias("root_word")), "root").select("rank", "root_word")
    return known.join(ends, "rank", "left").select(
        "word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n"
    )
