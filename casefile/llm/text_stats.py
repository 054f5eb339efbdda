"""Statistics of whole texts by built-in functions alone: words, symbols, repeated lines, repeated 3-word windows.

Nothing is exploded or shuffled; every text is handled inside its row, in n log n for n words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casefile.llm.common import SPACE

WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

STATS = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks", "n_digits",
)


def word_array(text: Column) -> Column:
    """The text's words in order; null and blank texts have none."""
    bare = F.btrim(text, F.lit(WHITE))
    return F.when(F.length(bare) > 0, F.split(bare, SPACE)).otherwise(F.array().cast("array<string>"))


def _occurrences(text: Column, characters: str) -> Column:
    """How often one of the characters occurs: a byte search for each, no regular expression."""
    without = text
    for character in characters:
        without = F.replace(without, F.lit(character), F.lit(""))
    return F.octet_length(text) - F.octet_length(without)


def _repeat_words(df: DataFrame) -> DataFrame:
    """Adds n_repeat_words: words inside 3-word windows that occur at least twice, the first occurrence included.

    A window's hash is shifted left to make room for its position and sorted as one long, so equal
    windows become neighbours. Neighbours count only if their words are equal, too. What remains is
    sorted by position, and every window adds the words up to the next one, 3 at most.
    """
    df = df.withColumn("bits_", F.length(F.bin(F.size("words_").cast("long"))))
    df = df.withColumn("mask_", F.expr("shiftleft(1L, bits_) - 1L"))
    df = df.withColumn(
        "sorted_",
        F.expr(
            "CASE WHEN size(words_) >= 4 THEN sort_array(transform(sequence(0, size(words_) - 3), i -> "
            "shiftleft(xxhash64(words_[i], words_[i + 1], words_[i + 2]), bits_) | CAST(i AS BIGINT))) "
            "ELSE CAST(array() AS ARRAY<BIGINT>) END"
        ),
    )
    equal = (
        "(shiftright({a}, bits_) = shiftright({b}, bits_) AND words_[CAST({a} & mask_ AS INT)] = words_[CAST({b} & mask_ AS INT)] "
        "AND words_[CAST({a} & mask_ AS INT) + 1] = words_[CAST({b} & mask_ AS INT) + 1] "
        "AND words_[CAST({a} & mask_ AS INT) + 2] = words_[CAST({b} & mask_ AS INT) + 2])"
    )
    following = equal.format(a="x", b="sorted_[j + 1]")
    previous = equal.format(a="x", b="sorted_[j - 1]")
    df = df.withColumn(
        "starts_",
        F.expr(
            "sort_array(transform(filter(sorted_, (x, j) -> CASE WHEN j + 1 < size(sorted_) AND "
            f"{following} THEN true WHEN j > 0 THEN {previous} ELSE false END), x -> x & mask_))"
        ),
    )
    covered = (
        "aggregate(transform(starts_, (p, j) -> CASE WHEN j + 1 < size(starts_) THEN least(3L, starts_[j + 1] - p) "
        "ELSE 3L END), 0L, (a, x) -> a + x)"
    )
    return df.withColumn("n_repeat_words", F.expr(covered))


def text_stats(df: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id and STATS (all long) of every row; null texts count as empty. Other columns are not read."""
    df = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text_"))
    lines = F.filter(F.split("text_", "\n"), lambda line: F.length(F.btrim(line, F.lit(WHITE))) > 0)
    df = df.withColumn("words_", word_array(F.col("text_"))).withColumn("lines_", lines)
    df = _repeat_words(df)
    text = F.col("text_")
    columns = {
        "n_words": F.size("words_"),
        "word_chars": F.length(F.array_join("words_", "")),
        "n_symbols": _occurrences(text, SYMBOLS),
        "n_lines": F.size("lines_"),
        "n_dup_lines": F.size("lines_") - F.size(F.array_distinct("lines_")),
        "n_repeat_words": F.col("n_repeat_words"),
        "n_upper": _occurrences(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        "n_marks": _occurrences(text, "!?"),
        "n_digits": _occurrences(text, "0123456789"),
    }
    return df.select("doc_id", *(columns[name].cast("long").alias(name) for name in STATS))
