"""A training corpus from the documents table: five stages, each written as Parquet and read again.

Every stage takes (spark, docs, sf_dir) and works on all its predecessor kept; all but the last return
the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casefile.llm import jaccard, langid, line_runs, mixing, piece_codec
from casefile.llm.common import read, staged
from casefile.llm.queries import PIECES, language_model

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Share of a document's words that its main language must have.
LEAST_SHARE = 0.4


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter or without a main language go, so those in scripts not learned; a missing language is filled in."""
    found = langid.predict(docs, language_model(docs), carry=COLUMNS[1:])
    kept = found.where((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LEAST_SHARE))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten or more documents share go; documents stay, with the text that is left."""
    found = line_runs.dedup_lines(docs, carry=("lang", "source"))
    return found.select("doc_id", F.col("kept").alias("text"), "lang", "source", F.length("kept").cast("long").alias("n_chars"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every class of near copies the document with the smallest id stays, once.

    Documents without a word, which line dedup can leave, are each their own class. Rows that share an id
    are told apart by their texts. Rows without an id cannot be named by a class and stay.
    """
    key = ("doc_id", "t1", "t2")
    told = docs.withColumns({"t1": F.xxhash64("text"), "t2": F.xxhash64(F.lit(1), "text")})
    going = jaccard.classes(told, carry=key[1:]).where("doc_id <> class_id").select(*key).distinct()
    named = told.where("doc_id IS NOT NULL").join(going, list(key), "left_anti")
    once = named.dropDuplicates(list(key)).select(*COLUMNS)
    return once.unionByName(docs.where("doc_id IS NULL").select(*COLUMNS))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes: a row with the parts taken, and a second one with the parts taken twice."""
    taken = mixing.taken_texts(mixing.mix(docs, carry=("lang",)), carry=("lang",))
    return taken.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts as piece ids, with a check that they decode to the texts again."""
    return piece_codec.encode(docs, public_tokenizers.path(PIECES), exact=True)


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near copies", near_copies),
    ("mixture", mixture),
    ("pieces", pieces),
]

#: SQL can express neither the learned language model nor the seeded choice of blocks.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
