"""Language identification: script ranges narrow the candidates, a Viterbi pass over word scores labels spans.

Every word is scored once per language by a multinomial model over its letter 1- to 3-grams and the word
itself. Code-point ranges give the word's script; only languages seen in that script are candidates. The
best labelling of a text's words maximises the sum of scores less a penalty for every change of language.
The pass runs over all texts of a record batch at once, one step per word position.
"""

from __future__ import annotations

import itertools
import re
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from casefile.llm.common import carried_schema, map_arrow, record_batch, slices, small, staged, texts_of, with_columns

UNDETERMINED = "und"

# First and last code point of the main blocks of a script, from the Unicode standard.
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x1E00, 0x1EFF)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "kana": [(0x3040, 0x30FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2FA1F)],
    "hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7AF)],
}
_RANGES = sorted((low, high, name) for name, ranges in SCRIPTS.items() for low, high in ranges)
_STARTS = [low for low, _, _ in _RANGES]

WORDS = re.compile(r"[^\W\d_]+")  # runs of letters


def _lettered(words: list[str]) -> list[str]:
    """The words, or none if no letter is among them: number signs such as one half pass for letters in a pattern."""
    if any(map(str.isalpha, words)) or any(char.isalpha() for word in words for char in word):
        return words
    return []


def script_of(word: str) -> str:
    """Script of the word's first letter that is in a range; "other" if none is."""
    for char in word:
        at = bisect_right(_STARTS, ord(char)) - 1
        if at >= 0 and ord(char) <= _RANGES[at][1]:
            return _RANGES[at][2]
    return "other"


def grams(word: str) -> list[str]:
    """Letter 1- to 3-grams of the word between its ends, and the word itself; of very long words the ends' grams repeat."""
    marked = f"^{word}$"
    found = [marked] if len(marked) > 5 else []
    return found + list(word) + [marked[i : i + 2] for i in range(len(marked) - 1)] + [
        marked[i : i + 3] for i in range(len(marked) - 2)
    ]


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    rows: dict[str, int] = field(repr=False)  # gram -> row of `scores`
    scores: np.ndarray = field(repr=False)  # (grams + 1) x languages; the last row is for unseen grams
    scripts: dict[str, tuple[bool, ...]] = field(repr=False)  # script -> which languages use it

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Log likelihood of each word per language less its best; languages that do not use the script are out.

        A word in a script of no learned language scores 0 for all of them.
        """
        unseen, row = len(self.rows), self.rows.get
        found, sizes = [], []
        for word in words:
            own = grams(word)
            found += [row(g, unseen) for g in own]
            sizes.append(len(own))
        if not words:
            return np.zeros((0, max(len(self.languages), 1)), np.float32)
        n = np.array(sizes)
        total = np.add.reduceat(self.scores[found], np.cumsum(n) - n, axis=0)
        total *= (np.minimum(n, 24) / n)[:, None]
        everywhere = (True,) * len(self.languages)
        allowed = np.array([self._candidates(word) or everywhere for word in words])
        total = np.where(allowed, total, -1e3)
        total = np.maximum(total - total.max(axis=1, keepdims=True), -50.0)
        total[[self._candidates(word) is None for word in words]] = 0
        return total.astype(np.float32)

    def votes(self, words: list[str]) -> np.ndarray:
        """Which words are in a script that a learned language uses."""
        return np.array([self._candidates(word) is not None for word in words], bool)

    def _candidates(self, word: str) -> tuple[bool, ...] | None:
        own = self.scripts.get("latin" if word.isascii() else script_of(word))
        return own if own and any(own) else None


class _WordRows(dict):
    """Word -> its row of scores. Rows are scored together, once per batch; all are forgotten at `limit` words."""

    def __init__(self, model: LanguageModel, limit: int = 200_000):
        super().__init__()
        self.model, self.limit, self.new = model, limit, []
        self.scores = np.zeros((0, max(len(model.languages), 1)), np.float32)
        self.votes = np.zeros(0, bool)

    def __missing__(self, word: str) -> int:
        self[word] = row = len(self)
        self.new.append(word)
        return row

    def rows(self, words: list[list[str]], n_words: int) -> tuple[np.ndarray, np.ndarray]:
        """Of every word its scores, and whether it votes."""
        if len(self) > self.limit:
            self.clear()
            self.scores, self.votes = self.scores[:0], self.votes[:0]
        flat = np.fromiter(map(self.__getitem__, itertools.chain.from_iterable(words)), np.int64, n_words)
        for start in range(0, len(self.new), 50_000):
            new = self.new[start : start + 50_000]
            self.scores = np.concatenate([self.scores, self.model.word_scores(new)])
            self.votes = np.concatenate([self.votes, self.model.votes(new)])
        self.new = []
        return self.scores[flat], self.votes[flat]


def viterbi(scores: np.ndarray, lengths: np.ndarray, penalty: float) -> np.ndarray:
    """Labels of the best paths of many sequences at once. `scores`: (sum of lengths) x languages."""
    order = np.argsort(-lengths, kind="stable")
    starts = (np.cumsum(lengths) - lengths)[order]
    sizes = lengths[order]
    n_languages = scores.shape[1]
    labels = np.zeros(len(scores), np.int16)
    if not len(scores) or n_languages == 1:
        return labels
    longest = int(sizes[0])
    active = np.searchsorted(-sizes, -np.arange(longest), side="left")  # sequences longer than t
    moved = np.zeros(scores.shape, bool)  # better to come from `origin` than to stay
    origin = np.zeros(len(scores), np.int16)
    state = scores[starts[: active[0]]].astype(np.float64)
    last = np.zeros(len(sizes), np.int16)
    for t in range(1, longest + 1):
        n = active[t] if t < longest else 0
        if n < len(state):  # these have ended
            last[n : len(state)] = state[n:].argmax(axis=1)
            state = state[:n]
        if not n:
            break
        at = starts[:n] + t
        best = state.argmax(axis=1)
        jump = state[np.arange(n), best] - penalty
        comes = state < jump[:, None]
        moved[at], origin[at] = comes, best
        state = np.where(comes, jump[:, None], state) + scores[at]
    current = last
    for t in range(longest - 1, -1, -1):
        n = active[t]
        at = starts[:n] + t
        now = current[:n]
        labels[at] = now
        if t:
            change = moved[at, now]
            current[:n] = np.where(change, origin[at], now)
    return labels


_SCHEMA = "doc_id long, lang_pred string, score double, spans array<struct<first: int, words: int, lang: string>>"
_SPAN = pa.list_(pa.struct([("first", pa.int32()), ("words", pa.int32()), ("lang", pa.string())]))
_COLUMNS = [("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("spans", _SPAN)]


def _span_lists(labels: np.ndarray, lengths: np.ndarray, languages: tuple[str, ...]) -> pa.Array:
    """Runs of one label, per text."""
    starts = np.cumsum(lengths) - lengths
    first = np.zeros(len(labels), bool)
    first[starts[lengths > 0]] = True
    if len(labels) > 1:
        first[1:] |= labels[1:] != labels[:-1]
    at = np.flatnonzero(first)
    of = np.repeat(np.arange(len(lengths)), lengths)[at]
    sizes = np.diff(np.append(at, len(labels)))
    names = pa.DictionaryArray.from_arrays(pa.array(labels[at], pa.int16()), pa.array(list(languages), pa.string()))
    structs = pa.StructArray.from_arrays(
        [pa.array(at - starts[of], pa.int32()), pa.array(sizes, pa.int32()), names.cast(pa.string())],
        names=["first", "words", "lang"],
    )
    offsets = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(lengths)))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs)


def predict(
    df: DataFrame, model: LanguageModel, id_col="doc_id", text_col="text", penalty: float = 12.0, carry: tuple[str, ...] = ()
) -> DataFrame:
    """doc_id, lang_pred, score, spans of every row, and the columns named in `carry`.

    `spans` are maximal runs of words (runs of letters) in one language; `lang_pred` has most words, ties to
    the language that sorts first; `score` is its share of the words. Words in a script of no learned language
    are in a span but vote for none: they only lower the score, to 0 if there are no others. Null texts and texts without a letter (Unicode category L)
    are "und" with score 0 and no span; so is every text for a model without languages. Whole texts of any
    length are labelled; a null id stays null; repeated rows are labelled each; an empty table gives no
    rows; other columns are not read. Rows need no shuffle. Carried names must not be those above.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)  # bounded by the fit's max_grams

    def run(batches):
        known = sent.value
        word_rows = _WordRows(known)
        n_languages = max(len(known.languages), 1)
        for batch in (part for whole in batches for part in slices(whole, 1)):
            words = [_lettered(WORDS.findall(text.lower())) for text in texts_of(batch.column(1))]
            if not known.languages:
                words = [[] for _ in words]
            lengths = np.fromiter(map(len, words), np.int64, len(words))
            scores, voting = word_rows.rows(words, int(lengths.sum()))
            labels = viterbi(scores, lengths, penalty)
            of = np.repeat(np.arange(len(words)), lengths)
            ballots = (of * n_languages + labels)[voting]
            votes = np.bincount(ballots, minlength=len(words) * n_languages).reshape(-1, n_languages)
            winner = votes.argmax(axis=1)
            share = votes[np.arange(len(words)), winner] / np.maximum(lengths, 1)
            names = [known.languages[w] if n else UNDETERMINED for w, n in zip(winner, lengths, strict=True)]
            found = record_batch(_COLUMNS, batch.column(0), names, share, _span_lists(labels, lengths, known.languages))
            yield with_columns(found, batch, 2)

    ids, texts = F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text_")
    return map_arrow(df.select(ids, texts, *carry), run, carried_schema(_SCHEMA, df, carry))


def held_out(id_column: Column, folds: int = 5) -> Column:
    return F.pmod(F.crc32(id_column.cast("string").cast("binary")), F.lit(folds)) == 0


def fit(
    labelled: DataFrame, text_col="text", lang_col="lang", order_col="doc_id", per_language: int = 1500, max_grams: int = 150_000
) -> LanguageModel:
    """Learn from at most `per_language` texts of each language, those whose hash with the id comes first.

    Rows with a null text or language are not used; a repeated row counts once. The cluster counts the grams; the `max_grams` most
    frequent go to the driver. No row gives a model without languages.
    """
    place = F.xxhash64(F.col(order_col), F.col(text_col))
    rows = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), place.alias("place"))
    rows = rows.where("text IS NOT NULL AND lang IS NOT NULL")
    # Hashes are uniform, so a place below which about twice the wanted rows lie follows from the count.
    # Only hashes below it are ranked, and texts are picked by one place per language; no text is sorted.
    counts = rows.groupBy("lang").count().collect()  # one row per language
    bounds = [(r["lang"], int(-(2**63) + (2**64 - 1) * min(1.0, 2 * per_language / r["count"]))) for r in counts]
    spark = labelled.sparkSession
    bounded = small(spark.createDataFrame([(x, min(y, 2**63 - 1)) for x, y in bounds], "lang string, bound long"), len(bounds))
    near = rows.join(bounded, "lang").where("place <= bound")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place"))
    first = near.select("lang", "place").distinct().withColumn("rank", rank).where(F.col("rank") <= per_language)
    last = first.groupBy("lang").agg(F.max("place").alias("last")).collect()
    picks = small(spark.createDataFrame(last, "lang string, last long"), len(last))
    sample = rows.join(picks, "lang").where("place <= last")
    # dealt by place, so that texts with very many copies spread
    sample = sample.dropDuplicates(["lang", "place"]).repartition(16, "place").select("lang", "text")

    def count(batches):
        words: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                words.setdefault(lang, Counter()).update(WORDS.findall(text.lower()))
        found: Counter = Counter()
        for lang, own in words.items():
            for word, times in own.items():
                for gram in (f"\t{script_of(word)}", *grams(word)):
                    found[lang, gram] += times
        langs, names = zip(*found, strict=True) if found else ((), ())
        schema = [("lang", pa.string()), ("gram", pa.string()), ("n", pa.int64())]
        yield record_batch(schema, list(langs), list(names), list(found.values()))

    counts = staged(map_arrow(sample, count, "lang string, gram string, n long"), "gram-counts")
    counts = staged(counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "gram-sums")
    is_script = F.col("gram").startswith("\t")
    scripts = counts.where(is_script).collect()  # languages x scripts
    totals = counts.where(~is_script).groupBy("gram").agg(F.sum("n").alias("n"))
    chosen = totals.orderBy(F.desc("n"), "gram").limit(max_grams).select("gram")
    kept = counts.join(F.broadcast(chosen), "gram").toPandas()  # max_grams x languages counts at most
    languages = tuple(sorted({r["lang"] for r in scripts}))
    column = {lang: i for i, lang in enumerate(languages)}
    rows_of = {gram: i for i, gram in enumerate(sorted(set(kept["gram"])))}
    table = np.full((len(rows_of) + 1, len(languages)), 0.5)
    for gram, lang, n in zip(kept["gram"], kept["lang"], kept["n"], strict=True):
        table[rows_of[gram], column[lang]] += n
    scores = np.log(table / table.sum(axis=0)).astype(np.float32) if languages else table.astype(np.float32)
    used: dict[str, dict[str, int]] = {}
    for r in scripts:
        used.setdefault(r["gram"][1:], {})[r["lang"]] = r["n"]
    words = {lang: sum(own.get(lang, 0) for own in used.values()) for lang in languages}
    narrow = {s: tuple(own.get(lang, 0) * 100 >= words[lang] for lang in languages) for s, own in used.items()}
    return LanguageModel(languages, rows_of, scores, narrow)
