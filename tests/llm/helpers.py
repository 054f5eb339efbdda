"""Small tables with everything that tables hold: nulls, empty and long texts, repeats, clashing names."""

from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"
LONG = "lorem ipsum dolor sit amet " * 20_000


def odd_documents(spark):
    """Rows that every operator on documents must handle, with columns named like results and helpers."""
    words = " ".join(f"word{i}" for i in range(60))
    rows = [
        (1, words),
        (2, None),
        (3, ""),
        (4, " \t\n "),
        (5, words),
        (5, words),
        (None, words),
        (None, None),
        (6, "one two"),
        (7, LONG),
        (8, "x" * 300_000),
        (9, "\n".join(["same line"] * 3)),
        (10, "‖ ▁ 漢字 😀 \x00 é"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("lang", "source"):
        frame = frame.withColumn(name, F.lit(None).cast("string"))
    for name in ("words_", "size", "n", "score", "entry", "root", "h1", "d1", "shard", "target", "kept", "id", "text_"):
        frame = frame.withColumn(name, F.lit("clash"))
    return frame


def empty(frame):
    return frame.limit(0)
