"""The operators applied to their whole tables, with production parameters: what __spark_entry__ registers."""

from __future__ import annotations

import public_tokenizers

from pyspark.sql import functions as F

from casefile.llm import ann, bpe_count, chat, decision_list, jaccard, langid, line_runs, mixing, negatives, ngram_filter, ordinal, piece_codec, spelling
from casefile.llm.common import read

PIECES = "piece_bpe_32k.model"


def op1_ann(spark, sf_dir):
    """The five nearest rows to every fiftieth, among all rows."""
    return ann.nearest(read(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op2_quality_rules(spark, sf_dir):
    """Statistics of every whole document, the base rule, and the learned decision list's verdict."""
    documents, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return decision_list.quality_verdicts(documents, labels)


def op3_toxicity(spark, sf_dir):
    """Expected severity of every whole document."""
    documents = read(spark, sf_dir, "documents")
    return ordinal.severity(documents, ordinal.fit(documents, read(spark, sf_dir, "labels")))


def op4_piece_codec(spark, sf_dir):
    """Every whole document as piece ids, and whether they decode to the text again."""
    return piece_codec.encode(read(spark, sf_dir, "documents"), public_tokenizers.path(PIECES), exact=True)


def language_model(documents):
    """Learnt from the text and language of documents outside the held-out fold."""
    return langid.fit(documents.where(~langid.held_out(F.col("doc_id"))))


def op5_language_id(spark, sf_dir):
    """Language of every whole document, from a model that has not seen the held-out ones."""
    documents = read(spark, sf_dir, "documents")
    found = langid.predict(documents, language_model(documents))
    n_spans = F.size("spans").cast("long").alias("n_spans")
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", n_spans)


def op6_source_mix(spark, sf_dir):
    """What a mix of 150 % of all words takes of every document."""
    mixed = mixing.mix_sizes(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "taken")


def op7_chat_format(spark, sf_dir):
    """Digests of every formatted conversation, and of one whose texts are control strings."""
    tricky = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame(
        [(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)], "conv_id long, turn long, role string, text string"
    )
    given = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.conversation_digests(given.unionByName(own)).drop("n_rewrites")


def op8_jaccard_join(spark, sf_dir):
    """Class and number of links of every whole document at similarity 0.8 of five-word shingles."""
    return jaccard.classes(read(spark, sf_dir, "documents"))


def op9_line_dedup(spark, sf_dir):
    """Documents without the lines that ten or more documents share."""
    found = line_runs.dedup_lines(read(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return found.select("doc_id", "n_lines", "n_dropped", "kept_sha256")


def op10_token_counts(spark, sf_dir):
    """Tokens of every whole document, and whether it exceeds a context of 4096."""
    return bpe_count.token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path(PIECES), limit=4096)


def op11_hard_negatives(spark, sf_dir):
    """Of every hundredth row the five best of its label, with ten hard negatives each; every seventh row has a wrong label."""
    wrong = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=wrong)


def op12_lm_score(spark, sf_dir):
    """Log probability of every whole document, from a model that has not seen the held-out ones."""
    documents = read(spark, sf_dir, "documents")
    held_out = ngram_filter.held_out(F.col("doc_id"))
    model = ngram_filter.fit(documents.where(~held_out))
    return ngram_filter.score(documents, model).select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op13_spelling(spark, sf_dir):
    """Every repeated word of seven letters or more with its neighbours one edit away, its form and the last of its forms."""
    return spelling.variants(read(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_ann, op2_quality_rules, op3_toxicity, op4_piece_codec, op5_language_id, op6_source_mix, op7_chat_format, op8_jaccard_join, op9_line_dedup, op10_token_counts, op11_hard_negatives, op12_lm_score, op13_spelling)}
