"""Nearest neighbours, the Jaccard join, chat formatting and the pipeline."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest

import corpus_pipeline
from casefile.llm import ann, chat, jaccard
from casefile.llm.common import read, staged
from casefile.llm.queries import op1_ann, op7_chat_format
from tests.llm.helpers import LONG, SF_DIR, empty, odd_documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")

# --- nearest neighbours ----------------------------------------------------------------------


def exact(rows, is_query, k=5):
    """(query, rank) -> (id, score) by comparing everything."""
    good = [(i, np.array(v, float)) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    answer = {}
    for q, v in good:
        if is_query(q):
            scored = sorted((-float(v @ w / (np.linalg.norm(v) * np.linalg.norm(w))), i) for i, w in good if i != q)
            for rank, (s, i) in enumerate(scored[:k], 1):
                answer[q, rank] = (i, -s)
    return answer


def test_recall_on_the_given_vectors(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in read(spark, "/root/testdata/sf0.1", "embeddings").collect()]
    truth = exact(rows, lambda i: i % 50 == 0)
    found = op1_ann(spark, "/root/testdata/sf0.1").collect()
    pairs = {(q, i) for (q, _), (i, _) in truth.items()}
    assert len({(r["query_id"], r["vec_id"]) for r in found} & pairs) >= 0.95 * len(pairs)
    vectors = {i: np.array(v, float) / np.linalg.norm(v) for i, v in rows}
    assert all(abs(r["score"] - vectors[r["query_id"]] @ vectors[r["vec_id"]]) < 1e-12 for r in found)


def test_copies_ties_and_unusable_vectors(spark):
    rows = [(i, [1.0, 0.0, 0.5]) for i in range(0, 30)] + [(i, [0.0, 1.0, float(i)]) for i in range(30, 40)]
    rows += [(50, None), (51, [0.0, 0.0, 0.0]), (52, [1.0, None, 0.0]), (53, [float("nan"), 1.0, 1.0]), (54, [float("inf"), 0.0, 0.0])]
    rows += [(55, [1.0, 2.0]), (56, []), (1, [1.0, 0.0, 0.5])]
    frame = spark.createDataFrame([*rows, (None, [1.0, 1.0, 1.0])], "vec_id long, embedding array<double>")
    frame = frame.selectExpr("*", "'clash' AS k1", "'clash' AS vec", "'clash' AS id")
    found = ann.nearest(frame, ann.F.col("id") % 10 == 0).collect()
    truth = exact([r for r in rows[:40]], lambda i: i % 10 == 0)
    assert {(r["query_id"], r["rank"]): r["vec_id"] for r in found} == {k: i for k, (i, _) in truth.items()}


def test_every_length_has_its_answers(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=3 if i % 3 else 5).tolist()) for i in range(60)] + [(0, [1.0, 2.0, 3.0])]
    found = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), ann.F.col("id") % 10 == 0).collect()
    truth = {}
    for n in (3, 5):  # all but the id that has a vector of each length
        truth |= exact([r for r in rows if len(r[1]) == n], lambda i: i % 10 == 0 and i)
    assert {(r["query_id"], r["rank"]): r["vec_id"] for r in found if r["query_id"]} == {k: i for k, (i, _) in truth.items()}
    both = [exact([r for r in rows if len(r[1]) == n], lambda i: i == 0).values() for n in (3, 5)]
    best = sorted((x for own in both for x in own), key=lambda x: -x[1])[:5]
    assert [r["score"] for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == 0] == pytest.approx([x for _, x in best])


def test_few_or_no_candidates(spark):
    schema = "vec_id long, embedding array<float>"
    two = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0])], schema)
    rows = ann.nearest(two, ann.F.col("id") == 0).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in rows] == [(0, 1, 1)]
    assert rows[0]["score"] == pytest.approx(2**-0.5, abs=1e-12)
    assert ann.nearest(two.limit(1), ann.F.col("id") == 0).collect() == []
    assert ann.nearest(empty(two), ann.F.col("id") == 0).collect() == []


def test_components_that_are_tiny_or_huge(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=6) * 10.0 ** [0, 200, -200, -310][i % 4]).tolist()) for i in range(60)]
    found = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), ann.F.col("id") % 5 == 0).collect()
    truth = exact([(i, (np.array(v) / np.abs(v).max()).tolist()) for i, v in rows], lambda i: i % 5 == 0)
    assert {(r["query_id"], r["rank"]): r["vec_id"] for r in found} == {k: i for k, (i, _) in truth.items()}
    assert all(r["score"] == pytest.approx(truth[r["query_id"], r["rank"]][1], abs=1e-9) for r in found)


def test_graph_search_finds_the_nearest_centroids():
    rng = np.random.default_rng(2)
    centroids = rng.normal(size=(600, 16))
    centroids /= np.linalg.norm(centroids, axis=1, keepdims=True)
    queries = rng.normal(size=(100, 16))
    queries /= np.linalg.norm(queries, axis=1, keepdims=True)
    ids, distances = ann.CentroidGraph(centroids, 24).search(queries, 64, 1.2, 8)
    assert (np.diff(np.where(np.isinf(distances), 9, distances), axis=1) >= 0).all()
    true = (queries @ centroids.T).argmax(axis=1)
    assert (ids[:, 0] == true).mean() > 0.97
    assert all(len(set(row[row >= 0])) == (row >= 0).sum() >= 8 for row in ids)


def test_a_query_asks_all_lists_within_the_ratio():
    rng = np.random.default_rng(8)
    centroids, query = ann._unit(rng.normal(size=(3000, 64))), rng.normal(size=64)
    plan, graph = ann.AnnPlan(), ann.CentroidGraph(centroids, ann.AnnPlan.degree)

    class Sent:
        value = graph

    kind = ann.pa.list_(ann.pa.float64())
    batch = ann.pa.RecordBatch.from_arrays([ann.pa.array([1]), ann.pa.array([2]), ann.pa.array([query.tolist()], kind)], names=["k1", "k2", "vec"])
    asked = [x for part in ann._routing(Sent, plan, "array<double>")([batch]) for own in part.column(3).to_pylist() for x in own]
    distances = np.linalg.norm(ann._unit(query[None]) - centroids, axis=1)
    wanted = np.flatnonzero(distances <= plan.probe_ratio * distances.min())
    assert len(wanted) > 1024 and len(set(asked) & set(wanted.tolist())) >= 0.99 * len(wanted)


def test_both_sides_of_a_group_are_cut(spark):
    """Also with a group that has no query, and one that has no row."""
    rows = spark.range(2000).selectExpr("CAST(id % 3 AS int) AS grp", "xxhash64(id) AS k1", "xxhash64(id, 1) AS k2")
    asked = spark.range(3000).selectExpr("CAST(1 + id % 3 AS int) AS grp", "xxhash64(id) AS k1", "xxhash64(id, 1) AS k2")
    placed, routed = ann._cut(rows, asked, ann.AnnPlan(shard_rows=100, block_rows=100))
    key = ["grp", "shard", "block"]
    for side in (placed, routed):
        assert side.groupBy(*key).count().agg({"count": "max"}).first()[0] < 200
    met = placed.select(*key, ann.F.col("k1").alias("row")).join(routed, key)
    assert met.count() == met.select("grp", "row", "k1").distinct().count() == 666 * 1000 + 667 * 1000


def test_cut_groups_give_the_same_answers(spark):
    rng = np.random.default_rng(9)
    frame = spark.createDataFrame([(i, rng.normal(size=8).tolist()) for i in range(300)], "vec_id long, embedding array<double>")
    whole, cut = (sorted(ann.nearest(frame, ann.F.col("id") % 3 == 0, plan=p).collect()) for p in (ann.AnnPlan(), ann.AnnPlan(shard_rows=50, block_rows=10)))
    assert cut == whole and len(cut) == 500


# --- Jaccard join ----------------------------------------------------------------------------


def brute_sets(text, n=5):
    words = WORD.findall(text or "")
    return {tuple(words[i : i + n]) for i in range(max(len(words) - n + 1, 1))} if words else set()


def brute_classes(rows):
    sets = [brute_sets(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = [0] * len(rows)
    texts = [set() for _ in rows]
    for a, b in itertools.combinations(range(len(rows)), 2):
        union = len(sets[a] | sets[b])
        if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * union:
            links[a] += 1
            links[b] += 1
            if sets[a] != sets[b]:
                texts[a].add(frozenset(sets[b]))
                texts[b].add(frozenset(sets[a]))
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted((str(doc), str(least.get(find(i))), links[i], len(texts[i])) for i, (doc, _) in enumerate(rows))


def near_copies(n_groups, size, seed=1, words=120):
    rng = random.Random(seed)
    rows = []
    for g in range(n_groups):
        text = [f"w{rng.randint(0, 5000)}" for _ in range(words)]
        for _ in range(size):
            own = list(text)
            for _ in range(rng.randint(0, 4)):
                own[rng.randrange(len(own))] = f"x{rng.randint(0, 10**6)}"
            rows.append((len(rows), " ".join(own)))
    return rows


def found_classes(frame, plan=jaccard.JaccardPlan()):
    return sorted((str(r["doc_id"]), str(r["class_id"]), r["n_links"], r["n_text_links"]) for r in jaccard.classes(frame, plan).collect())


@pytest.mark.parametrize("block", [256, 8])
def test_classes_equal_brute_force(spark, block):
    """Blocks of 8 entries cut the groups of 30 near copies into pairs of blocks."""
    rows = near_copies(6, 30)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert found_classes(frame, jaccard.JaccardPlan(block=block)) == brute_classes(rows)


def test_chain_is_one_class(spark):
    words = [f"c{i}" for i in range(400)]
    rows = [(i, " ".join(words[i * 6 : i * 6 + 100])) for i in range(50)]
    truth = brute_classes(rows)
    assert found_classes(spark.createDataFrame(rows, "doc_id long, text string")) == truth
    assert len({c for _, c, _, _ in truth}) < 50


def test_odd_rows_of_the_join(spark):
    documents = odd_documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    truth = brute_classes([r for r in rows if r[1] != LONG] + [(7, "stand in for the long text")])
    wordless = {"2", "3", "4"}
    assert [x for x in found_classes(documents) if x[0] != "None"] == [
        (d, d, 0, 0) if d in wordless else (d, c, n, t) for d, c, n, t in truth if d != "None"
    ]
    assert jaccard.classes(empty(documents)).collect() == []


def test_near_copies_without_ids_are_linked(spark):
    rows = near_copies(6, 5, seed=3)
    rows = [(None if g % 3 == 0 or (g % 3 == 1 and i % 2) else d, t) for d, t in rows for g, i in [divmod(d, 5)]]
    truth = brute_classes(rows)
    assert any(d == c == "None" and texts for d, c, _, texts in truth) and any(d == "None" != c and texts for d, c, _, texts in truth)
    assert found_classes(spark.createDataFrame(rows, "doc_id long, text string")) == truth


def test_word_hashes_depend_on_the_word_alone():
    text = "alpha beta\tgamma  alpha\nβeta x alpha".encode()
    hashes = jaccard.word_hashes(text)
    assert len(hashes) == 7 and hashes[0] == hashes[3] == hashes[6] and len(set(hashes.tolist())) == 5
    assert len(jaccard.word_hashes(b" \n ")) == 0 and len(jaccard.word_hashes(b"")) == 0


def test_signatures_estimate_similarity():
    a = jaccard.shingle_set(" ".join(f"a{i}" for i in range(1000)).encode(), 5)
    b = jaccard.shingle_set(" ".join(f"a{i}" for i in range(500, 1500)).encode(), 5)
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    same = jaccard.signature(a, 2000, 1) == jaccard.signature(b, 2000, 1)
    assert same.mean() == pytest.approx(true, abs=0.05)


def test_pruning_thresholds_follow_the_posterior():
    plan = jaccard.JaccardPlan()
    steps = jaccard.least_matches(plan)
    assert [n for n, _ in steps] == [16, 32, 48, 64, 80, 96]
    rng = np.random.default_rng(1)
    for n, least in steps:
        # rejection sampling of the posterior: similarity uniform, m matches among n
        if 0 < least:
            s = rng.beta(least + 4, n - least - 3, 200_000)
            assert (s >= plan.threshold).mean() < 0.2
    assert all(a < b for (_, a), (_, b) in zip(steps, steps[1:], strict=False))


# --- chat formatting -------------------------------------------------------------------------

SCHEMA = "conv_id long, turn long, role string, text string"


def digest_rows(rows):
    def key(r):
        return (-1 if r[1] is None else r[1], r[2] or "", r[3] or "")

    out = {}
    for conv, own in itertools.groupby(sorted(rows, key=lambda r: (str(r[0]), key(r))), key=lambda r: r[0]):
        own = list(own)
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        out[conv] = (len(own), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_turns_are_read_back_whatever_they_hold(spark):
    rng = random.Random(4)
    bits = ["[INST]", "[/INST]", "</s>", "<s>", "<a>", "\\", "\\[", " ", "\n", "x", "]", "ROLE", "😀"]
    rows = [
        (c, t, rng.choice(["user", "assistant", "system", "to]ol\\", "", None]), "".join(rng.choice(bits) for _ in range(rng.randint(0, 12))))
        for c in range(40)
        for t in range(rng.randint(1, 6))
    ]
    rows += [(100, t, "user" if t % 2 else "assistant", f"turn {t}") for t in range(300)]
    rows += [(101, 0, "user", None), (101, 0, "user", None), (101, None, "system", "first"), (None, 0, "assistant", "no id"), (102, 0, "user", LONG)]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'clash' AS span", "'clash' AS position")
    found = chat.conversation_digests(frame).collect()
    assert {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in found} == digest_rows(rows)
    assert all(r["n_rewrites"] == 0 for r in found)
    assert chat.conversation_digests(empty(frame)).collect() == []


def test_spans_and_masks_cut_the_output(spark):
    rows = [(1, 0, "system", "be [kind]"), (1, 1, "user", "hi"), (1, 2, "assistant", "a <b> c"), (1, 3, "assistant", "")]
    template = chat.InstTemplate()
    whole = template([(r[2], r[3]) for r in rows])
    found = sorted(chat.format_turns(spark.createDataFrame(rows, SCHEMA)).collect(), key=lambda r: r["position"])
    assert "".join(r["formatted"] for r in found) == whole
    assert [whole[r["span_start"] : r["span_end"]] for r in found] == [r["formatted"] for r in found]
    masked = [template.unescape(whole[r["loss_start"] : r["loss_end"]]) for r in found if r["loss_start"] is not None]
    assert masked == ["a <b> c", ""]


def test_window_does_not_change_the_spans():
    messages = [("user" if i % 2 else "assistant", f"t{i}") for i in range(200)]
    for window in (1, 3, 64, 500):
        renderer = chat.PrefixRenderer(chat.InstTemplate(), window)
        assert "".join(renderer.add(*m).span for m in messages) == chat.InstTemplate()(messages)


class Rewriting(chat.InstTemplate):
    """Shortens every turn but the last."""

    def __call__(self, messages):
        return "".join(self.turn(r, t if i == len(messages) - 1 else t[:3]) for i, (r, t) in enumerate(messages))


def test_templates_that_rewrite_history_are_found():
    renderer = chat.PrefixRenderer(Rewriting())
    assert [renderer.add("user", t).rewrites for t in ("abc", "abcdef", "x")] == [False, False, True]


class Numbered(chat.InstTemplate):
    """Numbers the turns in their roles."""

    def __call__(self, messages):
        return "".join(self.turn(f"{i} {r}", t) for i, (r, t) in enumerate(messages))


class Truncating(chat.InstTemplate):
    """Keeps the last hundred turns."""

    def __call__(self, messages):
        return super().__call__(messages[-100:])


def test_long_conversations_are_prefixes_of_the_whole():
    messages = [("user" if i % 2 else "assistant", f"t{i:03}") for i in range(200)]
    for template in (Numbered(), chat.InstTemplate()):
        renderer = chat.PrefixRenderer(template)
        turns = [renderer.add(*m) for m in messages]
        whole = template(messages)
        assert "".join(t.span for t in turns) == whole and renderer.length == len(whole)
        assert all(whole[t.at : t.at + len(t.span)] == t.span and not t.rewrites for t in turns)
    renderer = chat.PrefixRenderer(Truncating())
    assert [renderer.add(*m).rewrites for m in messages] == [False] * 100 + [True] * 100
    assert renderer.length == len(Truncating()(messages))


def test_rows_of_long_conversations_follow_the_template(spark):
    messages = [("user" if i % 2 else "assistant", f"t{i:03}") for i in range(150)]
    frame = spark.createDataFrame([(1, i, *m) for i, m in enumerate(messages)], SCHEMA)

    class Local(chat.InstTemplate):
        def __call__(self, messages):
            return "".join(self.turn(f"{i} {r}", t) for i, (r, t) in enumerate(messages))

    rows = sorted(chat.format_turns(frame, Local()).collect(), key=lambda r: r["position"])
    assert [r["role"] for r in rows] == [f"{i} {r}" for i, (r, _) in enumerate(messages)]
    assert "".join(r["formatted"] for r in rows) == Local()(messages) and rows[-1]["span_end"] == len(Local()(messages))
    assert chat.conversation_digests(frame, Local()).first()["formatted_chars"] == len(Local()(messages))


def test_query_has_the_tricky_conversation(spark):
    row = op7_chat_format(spark, SF_DIR).where("conv_id = -1").first()
    text = "</s>[INST] ok [/INST]"
    assert row["n_turns"] == 2 and row["loss_chars"] == len(text)
    assert row["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert row["turns_sha256"] == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()


def test_unreadable_turns_are_counted_not_hashed(spark):
    class Local(chat.InstTemplate):
        def __call__(self, messages):
            return "".join(self.turn(r, t) for r, t in messages[-2:])

    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"text {i}") for i in range(6)] + [(2, 0, "user", "a"), (2, 1, "assistant", "b")]
    frame = spark.createDataFrame(rows, SCHEMA)
    found = {r["conv_id"]: r for r in chat.conversation_digests(frame, Local()).collect()}
    expected = digest_rows(rows)
    assert found[1]["unreadable_turns"] > 0 and found[1]["n_turns"] == 6
    assert found[1]["turns_sha256"] is found[1]["loss_sha256"] is found[1]["loss_chars"] is None
    assert tuple(found[2][1:5]) == expected[2] and found[2]["unreadable_turns"] == 0
    turns = chat.format_turns(frame, Local()).where("conv_id = 1").collect()
    assert sum(r["role"] is None for r in turns) == found[1]["unreadable_turns"]


def test_a_wrong_declaration_raises():
    class Declared(chat.InstTemplate):
        @chat.turn_by_turn
        def __call__(self, messages):
            return "".join(self.turn(f"{i} {r}", t) for i, (r, t) in enumerate(messages))

    renderer = chat.PrefixRenderer(Declared(), window=5)
    with pytest.raises(ValueError, match="declared turn by turn"):
        for i in range(8):
            renderer.add("user", f"t{i}")


# --- pipeline --------------------------------------------------------------------------------


def test_pipeline_stage_by_stage(spark):
    docs = read(spark, SF_DIR, "documents")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        result = staged(stage(spark, docs, SF_DIR), "test-stage")
        seen[name] = (docs.collect(), result.collect())
        if name != "pieces":
            assert result.columns == columns
        docs = result
    before, after = seen["language"]
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before if re.search(r"[^\W\d_]", r["text"])}
    before, after = seen["lines"]
    assert len(before) == len(after)
    before, after = seen["near copies"]
    truth = brute_classes([(r["doc_id"], r["text"]) for r in before])
    assert sorted(str(r["doc_id"]) for r in after) == sorted(d for d, c, _, _ in truth if d == c)
    before, after = seen["mixture"]
    total = sum(len(WORD.findall(r["text"])) for r in before)
    assert sum(len(WORD.findall(r["text"])) for r in after) == pytest.approx(1.5 * total, rel=0.02)
    before, after = seen["pieces"]
    assert len(before) == len(after) and all(r["round_trip"] for r in after)


def test_rows_that_share_an_id_are_told_apart(spark):
    one, other = (" ".join(f"{w}{i}" for i in range(80)) for w in "ab")
    rows = [(1, one), (5, one), (5, other), (5, other), (None, other)]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.near_copies(spark, docs, SF_DIR).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept) == sorted([("1", one), ("5", other), ("None", other)])


def test_pipeline_of_odd_and_of_no_rows(spark):
    documents = odd_documents(spark).withColumn("n_chars", ann.F.lit(None).cast("long")).select("doc_id", "text", "lang", "source", "n_chars")
    for docs in (documents, empty(documents), documents.withColumn("lang", ann.F.lit("en"))):
        for _, stage in corpus_pipeline.STAGES:
            docs = staged(stage(spark, docs, SF_DIR), "test-stage")
        assert docs.columns == ["doc_id", "n_tokens", "token_ids", "round_trip"]
