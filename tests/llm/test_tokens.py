"""Token counts and piece encoding against the library, a brute-force path search, and exact round trips."""

import random

import public_tokenizers
import pytest
import sentencepiece

from casefile.llm import bpe_count, piece_codec
from casefile.llm.common import read
from casefile.llm.pieces import load_pieces, prepared
from casefile.llm.queries import op4_piece_codec, op10_token_counts
from tests.llm.helpers import SF_DIR, empty, odd_documents

PATH = public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = " \n\t▁ab<s>/é漢字\x00😀　1  thetion#|."


@pytest.fixture(scope="module")
def table():
    return load_pieces(PATH)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def random_texts(n, longest=40, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, longest))) for _ in range(n)]


def test_counts_equal_the_library_on_random_texts(table, library):
    count = bpe_count.counter(table)
    for text in [*random_texts(3000), "", " ", "a" * 5000, "<s> </s> <unk> <0x41>"]:
        assert count(text) == len(library.encode(text)), text


def test_counts_equal_the_library_on_whole_documents(spark, library):
    texts = {r["doc_id"]: r["text"] for r in read(spark, SF_DIR, "documents").collect()}
    rows = op10_token_counts(spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r["n_tokens"] == len(library.encode(texts[r["doc_id"]]))
        assert r["n_bytes"] == len(texts[r["doc_id"]].encode())
        assert r["over_limit"] == (r["n_tokens"] > 4096)


def test_counts_of_odd_rows(spark, library):
    documents = odd_documents(spark)
    rows = bpe_count.token_counts(documents, PATH).collect()
    expected = sorted((str(r["doc_id"]), len(library.encode(r["text"] or ""))) for r in documents.collect())
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in rows) == expected
    assert bpe_count.token_counts(empty(documents), PATH).collect() == []


def brute_path(unit, table, unknown):
    """Best segmentation by trying every piece at every position, with the codec's rule for ties."""
    best = [(0.0, 0, None)] + [None] * len(unit)
    for end in range(1, len(unit) + 1):
        for start in range(max(0, end - 16), end):  # the longest last piece first
            piece = unit[start:end]
            score = table.scores.get(piece)
            if score is None and end - start == 1:
                score = unknown
            if score is not None and (best[end] is None or best[start][0] + score > best[end][0]):
                best[end] = (best[start][0] + score, start, table.ids.get(piece, -1))
    path, end = [], len(unit)
    while end:
        _, start, number = best[end]
        path.append((start, end, number))
        end = start
    return path[::-1]


def test_viterbi_equals_brute_force(table):
    codec = piece_codec.Codec(table)
    units = [u for text in random_texts(1500, 30, 2) for u in codec.units(prepared(text))]
    units += ["▁thationing", "▁▁▁▁x", "▁" + "ation" * 40, "😀é"]
    for unit in units:
        assert codec.automaton.segment(unit, codec.unknown) == brute_path(unit, table, codec.unknown), unit


def test_units_do_not_change_the_best_path(table):
    codec = piece_codec.Codec(table)
    for text in random_texts(300, 60, 3):
        whole = prepared(text)
        score = lambda path: sum(table.scores[table.pieces[n]] if n >= 0 else codec.unknown for _, _, n in path)
        apart = sum(score(codec.automaton.segment(u, codec.unknown)) for u in codec.units(whole))
        assert apart == pytest.approx(score(codec.automaton.segment(whole, codec.unknown)))


def test_round_trip(table):
    codec = piece_codec.Codec(table)
    for text in random_texts(1000, 60, 4):
        assert codec.decode(codec.encode(text)) == text.replace("▁", " ")


def test_exact_round_trip(spark, table):
    import corpus_pipeline

    codec, plain = piece_codec.Codec(table, exact=True), piece_codec.Codec(table)
    texts = [*random_texts(1000, 60, 5), "▁", "▁ ▁", "a▁b", " ▁", "▁▁a", ""]
    for text in texts:
        assert codec.decode(codec.encode(text)) == text
        if "▁" not in text:
            assert codec.encode(text).tolist() == plain.encode(text).tolist()
    documents = odd_documents(spark).select("doc_id", "text")
    encoded = corpus_pipeline.pieces(spark, documents, SF_DIR)
    assert all(r["round_trip"] for r in encoded.collect())
    again = piece_codec.decode(encoded, PATH, exact=True).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in again) == sorted((str(r["doc_id"]), r["text"] or "") for r in documents.collect())


def test_encode_and_decode_tables(spark):
    documents = odd_documents(spark)
    encoded = piece_codec.encode(documents, PATH)
    rows = encoded.collect()
    assert len(rows) == 13 and all(r["round_trip"] and len(r["token_ids"]) == r["n_tokens"] for r in rows)
    texts = sorted((str(r["doc_id"]), (r["text"] or "").replace("▁", " ")) for r in documents.collect())
    again = piece_codec.decode(encoded, PATH).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in again) == texts
    assert piece_codec.encode(empty(documents), PATH).collect() == []
    assert all(r["round_trip"] for r in op4_piece_codec(spark, SF_DIR).collect())


def test_any_ids_decode_as_the_library_has_them(table, library):
    """Slices of a text's ids, ids of single pieces, and ids of another encoder."""
    codec, rng = piece_codec.Codec(table), random.Random(8)
    a, b = (table.ids[x] for x in "ab")
    assert codec.decode([a, b]) == library.decode([a, b]) == "ab"
    for text in random_texts(300, 60, 9):
        text = text.replace("▁", "x").replace("\x00", "")
        for ids in (codec.encode(text).tolist(), library.encode(text)):
            cut = rng.randint(0, len(ids))
            for part in (ids, ids[cut:], ids[:cut]):
                if not any(i in table.byte_ids for i in part):  # the library shows a character cut in two in its own way
                    assert codec.decode(part) == library.decode(part)


def test_memo_forgets_but_does_not_change_results(table):
    from casefile.llm.pieces import UnitMemo

    memo = UnitMemo(len, limit=3)
    assert [memo[x] for x in ["a", "bb", "ccc", "dddd", "a", "bb", "x" * 50]] == [1, 2, 3, 4, 1, 2, 50]
    assert len(memo) <= 3 and len(memo.older) <= 3 and "x" * 50 not in memo
