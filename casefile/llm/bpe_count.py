"""Token counts by byte-pair merging with a heap and a linked list; no identifiers are made.

A unit starts as its characters, linked in order. The adjacent pair whose union has the best score
(leftmost on ties) is popped and merged until none is left; the count is the initial symbols less
the merges. A character left unmerged that the vocabulary lacks counts its UTF-8 bytes instead.
"""

from __future__ import annotations

from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casefile.llm.common import map_arrow, record_batch, slices, texts_of
from casefile.llm.pieces import PieceTable, UnitMemo, load_pieces, prepared, split_units


def count_unit(unit: str, scores: dict[str, float]) -> int:
    """Tokens of one unit. Symbols are slices [i, after[i]): `after` links forwards, `before` backwards."""
    size = len(unit)
    after = list(range(1, size + 1))  # 0 once merged into the symbol before
    before = list(range(-1, size - 1))
    score_of = scores.get
    heap = []
    for i in range(size - 1):
        score = score_of(unit[i : i + 2])
        if score is not None:
            heap.append((-score, i, i + 1, i + 2))
    heapify(heap)
    merges = 0
    while heap:
        _, left, right, end = heappop(heap)
        if after[left] != right or after[right] != end:
            continue  # one of the two has been merged since
        after[left], after[right] = end, 0
        merges += 1
        if end < size:
            before[end] = left
            score = score_of(unit[left : after[end]])
            if score is not None:
                heappush(heap, (-score, left, end, after[end]))
        if left:
            previous = before[left]
            score = score_of(unit[previous:end])
            if score is not None:
                heappush(heap, (-score, previous, left, end))
    extra = 0
    if not scores.keys() >= set(unit):
        for i, char in enumerate(unit):
            if char not in scores and after[i] == i + 1:
                extra += len(char.encode("utf-8")) - 1
    return size - merges + extra


def counter(table: PieceTable):
    """A function from text to its number of tokens, with a bounded memo of units."""
    memo = UnitMemo(lambda unit: count_unit(unit, table.scores), limit=700_000)
    units = split_units(table)
    return lambda text: sum(map(memo.__getitem__, units(prepared(text))))


_COLUMNS = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())]
_COUNTERS: dict[str, object] = {}  # one per Python worker and vocabulary


def token_counts(df: DataFrame, vocabulary: str, id_col="doc_id", text_col="text", limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row.

    Null and empty texts have 0 bytes and tokens; a null id stays null; repeated rows are counted each;
    an empty table gives no rows. Other columns of the input are not read, whatever their names.
    A unit of any length is merged whole (n log n); rows need no shuffle, so none can be hot.
    """
    table = df.sparkSession.sparkContext.broadcast(load_pieces(vocabulary))  # as large as the vocabulary

    def count(batches):
        count_text = _COUNTERS.get(vocabulary)
        if count_text is None:
            count_text = _COUNTERS[vocabulary] = counter(table.value)
        for batch in (part for whole in batches for part in slices(whole, 1)):
            texts = texts_of(batch.column(1))
            yield record_batch(_COLUMNS, batch.column(0), [len(t.encode("utf-8")) for t in texts], list(map(count_text, texts)))

    chosen = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counted = map_arrow(chosen, count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
