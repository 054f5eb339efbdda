"""Quality rules, toxicity, language identification, mixing and line dedup."""

import collections
import re
import zlib

import numpy as np
import pytest

from casefile.llm import decision_list, langid, line_runs, mixing, ordinal, text_stats
from casefile.llm.common import read
from casefile.llm.queries import QUERIES
from tests.compare import connect, difference
from tests.llm.helpers import SF_DIR, empty, odd_documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_stats(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = collections.Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def stats_of(row):
    return tuple(row[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))


# --- quality rules ---------------------------------------------------------------------------


def test_statistics_equal_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in read(spark, "/root/testdata/sf0.01", "documents").collect()}
    rows = text_stats.text_stats(read(spark, "/root/testdata/sf0.01", "documents")).collect()
    assert len(rows) == len(texts)
    assert not [r for r in rows if stats_of(r) != brute_stats(texts[r["doc_id"]])]


def test_statistics_of_odd_rows(spark):
    documents = odd_documents(spark)
    extra = spark.createDataFrame([(11, "a b c a b c a b c"), (12, "a a a a"), (13, "# * a\n# * a\n\n")], "doc_id long, text string")
    documents = documents.unionByName(extra, allowMissingColumns=True)
    expected = sorted((str(r["doc_id"]), brute_stats(r["text"])) for r in documents.collect())
    assert sorted((str(r["doc_id"]), stats_of(r)) for r in text_stats.text_stats(documents).collect()) == expected


def test_rules_find_what_makes_labels_low(spark):
    documents = read(spark, "/root/testdata/sf0.1", "documents")
    labels = read(spark, "/root/testdata/sf0.1", "labels")
    rows = decision_list.quality_verdicts(documents, labels).join(labels, "doc_id").collect()
    wrong = [r for r in rows if (r["rule"] > 0) != (r["quality"] == 0)]
    assert len(wrong) < 0.02 * len(rows)
    assert all(r["kept"] == (not r["base_failed"] and r["rule"] == 0) for r in rows)
    assert all(r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]) for r in rows)


def test_rules_need_no_python_on_the_executors(spark):
    frame = decision_list.quality_verdicts(read(spark, SF_DIR, "documents"), read(spark, SF_DIR, "labels"))
    assert not re.search("Python|Pandas|Arrow", frame._jdf.queryExecution().executedPlan().toString())


def test_no_labels_no_rules(spark):
    labels = read(spark, SF_DIR, "labels")
    for given in (empty(labels), labels.where("quality = 1")):
        rows = decision_list.quality_verdicts(odd_documents(spark), given).collect()
        assert len(rows) == 13 and all(r["rule"] == 0 for r in rows)
    assert decision_list.quality_verdicts(empty(odd_documents(spark)), labels).collect() == []


def test_labels_with_nulls_and_repeats(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 0), (5, None), (99, 0)], "doc_id long, quality int")
    assert len(decision_list.quality_verdicts(odd_documents(spark), labels).collect()) == 13


def test_pruning_drops_a_condition_that_does_not_hold_elsewhere():
    rule = (decision_list.Condition("words", True, 10.0), decision_list.Condition("words", False, 20.0))
    shown = str(decision_list.DecisionList((rule,)))
    assert shown == "1. words > 10 and words <= 20 -> low"


# --- toxicity --------------------------------------------------------------------------------


def test_severity_separates_labelled_texts(spark):
    documents, labels = (read(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    model = ordinal.fit(documents, labels)
    # learnt on all labelled rows: a hash fold is held out to measure
    fold = "pmod(xxhash64(doc_id), 5) = 0"
    held = ordinal.fit(documents, labels.where(f"NOT {fold}"))
    rows = ordinal.severity(documents, held).join(labels.where(fold), "doc_id").collect()
    clean = [r for r in rows if not r["toxic"] and r[-1] == 0]
    assert len(clean) > 0 and (np.diff(model.thresholds) > 0).all()
    by_label = collections.Counter((r["p_toxic"] >= 0.5, r[-1]) for r in rows)
    assert by_label[True, 0] <= 0.01 * (by_label[True, 0] + by_label[False, 0])
    assert by_label[True, 1] >= 0.85 * (by_label[True, 1] + by_label[False, 1])
    severe = [r["severity"] for r in rows if r[-1] == 1 and r["p_toxic"] >= 0.5]
    assert min(severe) > max(r["severity"] for r in rows if r["p_toxic"] < 0.3)


def test_severity_of_odd_rows(spark):
    documents = odd_documents(spark)
    model = ordinal.fit(documents, spark.createDataFrame([(1, 1), (None, 1), (6, 0), (7, None)], "doc_id long, toxic int"))
    assert len(ordinal.severity(documents, model).collect()) == 13
    nothing = ordinal.fit(documents, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r["severity"] for r in ordinal.severity(documents, nothing).collect()} == {0.0}
    assert ordinal.severity(empty(documents), nothing).collect() == []


def test_severity_fit_does_not_depend_on_the_order_of_rows(spark):
    """Several texts of one id."""
    rng = np.random.default_rng(2)
    bad, good = [f"vile{i}" for i in range(40)], [f"kind{i}" for i in range(40)]
    rows = [(i % 30, " ".join(rng.choice([bad, good][rng.random() < (0.5 if i % 2 else 0.98)]) for _ in range(30))) for i in range(120)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, toxic int")
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    models = [ordinal.fit(part, labels, least_contexts=2) for part in (frame, frame.orderBy("text"), frame.orderBy(ordinal.F.desc("text")))]
    assert len(models[0].weights) and all(m.index == models[0].index for m in models)
    assert all(np.array_equal(m.weights, models[0].weights) and np.array_equal(m.thresholds, models[0].thresholds) for m in models)


def test_severity_by_hand(spark):
    """Expected grade: the sum over thresholds of the chance to be above, from rates and presence of the features."""
    model = ordinal.OrdinalModel({"vile": 0, "^awf": 1}, np.array([1.5, 0.5, 2.0, -1.0]), np.array([0.5, 1.0, 2.5]))
    log2 = np.log2
    scores = {
        "vile tea": 1.5 * log2(2) + 2.0 * log2(1 + 200 / 2),
        "awful awfully Vile": 1.5 * log2(2) + 0.5 * log2(3) + 2.0 * log2(1 + 200 / 3) - log2(1 + 2 * 200 / 3),
        "calm tea": 0.0,
        "": 0.0,
    }
    frame = spark.createDataFrame(list(enumerate(scores)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in ordinal.severity(frame, model).collect()}
    for i, score in enumerate(scores.values()):
        above = [1 / (1 + np.exp(t - score)) for t in (0.5, 1.0, 2.5)]
        chances = np.array([1 - above[0], above[0] - above[1], above[1] - above[2], above[2]])
        assert found[i]["severity"] == pytest.approx(sum(g * p for g, p in enumerate(chances)))
        assert found[i]["p_toxic"] == pytest.approx(above[0]) and found[i]["grade"] == chances.argmax()


def test_ordinal_fit_orders_grades_and_shares_weights():
    rng = np.random.default_rng(1)
    x = rng.normal(size=400)
    grades = np.digitize(x + 0.3 * rng.normal(size=400), [-0.5, 0.5, 1.2])
    weights, thresholds = ordinal.fit_ordinal(np.arange(400), np.zeros(400, int), x, grades, 1, 4)
    assert (np.diff(thresholds) > 0).all() and weights[0] > 0
    assert thresholds / weights[0] == pytest.approx([-0.5, 0.5, 1.2], abs=0.15)


# --- language identification -----------------------------------------------------------------


def brute_viterbi(scores, penalty):
    best, back = scores[0].astype(float), []
    for row in scores[1:]:
        moved = [max((best[k] - (penalty if k != j else 0), k == j, -k) for k in range(len(row))) for j in range(len(row))]
        back.append([-m[2] for m in moved])
        best = np.array([m[0] for m in moved]) + row
    return best.max()


def path_score(scores, labels, penalty):
    return sum(scores[i, k] for i, k in enumerate(labels)) - penalty * sum(a != b for a, b in zip(labels, labels[1:], strict=False))


def test_viterbi_finds_the_best_labels():
    rng = np.random.default_rng(3)
    lengths = rng.integers(0, 40, 60)
    scores = rng.normal(0, 3, (int(lengths.sum()), 4)).astype(np.float32)
    labels = langid.viterbi(scores, lengths, 2.5)
    at = 0
    for n in lengths:
        if n:
            own = scores[at : at + n].astype(float)
            assert path_score(own, labels[at : at + n].tolist(), 2.5) == pytest.approx(brute_viterbi(own, 2.5), abs=1e-3)
        at += n


@pytest.fixture(scope="module")
def model(spark):
    documents = read(spark, "/root/testdata/sf0.1", "documents")
    return langid.fit(documents.where(~langid.held_out(documents["doc_id"])), per_language=200)


def test_held_out_accuracy(spark, model):
    documents = read(spark, "/root/testdata/sf0.01", "documents")
    truth = {r["doc_id"]: r["lang"] for r in documents.collect()}
    rows = langid.predict(documents, model).collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert len(held) > 100 and sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.98 * len(held)


def test_spans_of_mixed_text(spark, model):
    documents = read(spark, "/root/testdata/sf0.01", "documents")
    parts = {r["lang"]: r["text"][:400] for r in documents.where("n_chars > 500").collect()}
    text = parts["en"] + " " + parts["de"] + " " + parts["es"]
    row = langid.predict(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
    assert [s["lang"] for s in row["spans"]] == ["en", "de", "es"]
    assert sum(s["words"] for s in row["spans"]) == len(langid.WORDS.findall(text.lower()))
    assert [s["first"] for s in row["spans"]] == [0, *np.cumsum([s["words"] for s in row["spans"]])[:-1]]


def test_scripts_narrow_the_candidates():
    rows = {"^": 0}
    scores = np.log(np.full((2, 2), 0.5)).astype(np.float32)
    model = langid.LanguageModel(("el", "en"), rows, scores, {"greek": (True, False), "latin": (False, True)})
    table = model.word_scores(["λόγος", "word", "слово"])
    assert table[0].argmax() == 0 and table[1].argmax() == 1 and (table[2] == 0).all()


def test_scripts_not_learned_give_no_score(spark, model):
    import corpus_pipeline

    latin = read(spark, SF_DIR, "documents").where("lang = 'en' AND n_chars > 500").first()["text"]
    words = langid.WORDS.findall(latin)[:30]
    texts = ["Ελληνικά και άλλα λόγια", "ещё одно русское слово", "漢字 仮名", " ".join([*words[:10], *["слово"] * 20]), " ".join([*words, *["слово"] * 20])]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sorted(langid.predict(frame, model).collect(), key=lambda r: r["doc_id"])
    assert [r["score"] for r in rows] == pytest.approx([0, 0, 0, 10 / 30, 30 / 50])
    assert rows[4]["lang_pred"] == "en" and all(r["lang_pred"] in model.languages for r in rows)
    docs = read(spark, SF_DIR, "documents").selectExpr("doc_id + 100 AS doc_id", "text", "lang", "source", "n_chars")
    odd = frame.selectExpr("doc_id", "text", "CAST(NULL AS string) AS lang", "'s' AS source", "CAST(length(text) AS long) AS n_chars")
    kept = corpus_pipeline.language(spark, docs.unionByName(odd), SF_DIR).where("doc_id < 5").collect()
    assert [(r["doc_id"], r["lang"]) for r in kept] == [(4, "en")]


def test_language_of_odd_rows(spark, model):
    rows = langid.predict(odd_documents(spark), model, carry=("h1",)).collect()
    assert len(rows) == 13 and {r["h1"] for r in rows} == {"clash"}
    for r in rows:
        if r["doc_id"] in (2, 3, 4):
            assert (r["lang_pred"], r["score"], r["spans"]) == ("und", 0.0, [])
        assert 0 <= r["score"] <= 1
    assert langid.predict(empty(odd_documents(spark)), model).collect() == []
    untaught = langid.fit(odd_documents(spark))
    assert {r["lang_pred"] for r in langid.predict(odd_documents(spark), untaught).collect()} == {"und"}


# --- mixing ----------------------------------------------------------------------------------


def test_number_signs_are_no_letters(spark, model):
    texts = ["½ ① ² Ⅷ", "12 ½", "½ the", "٣"]
    rows = langid.predict(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()
    assert {r["doc_id"]: r["lang_pred"] == "und" for r in rows} == {0: True, 1: True, 2: False, 3: True}


def test_sainte_lague_equals_one_seat_at_a_time():
    rng = np.random.default_rng(5)
    for _ in range(200):
        votes = {k: float(v) for k, v in enumerate(rng.integers(0, 1000, rng.integers(1, 12)))}
        seats = int(rng.integers(0, 300))
        given = dict.fromkeys(votes, 0)
        if any(votes.values()):
            for _ in range(seats):
                given[max(votes, key=lambda k: (votes[k] / (2 * given[k] + 1), -k))] += 1
        assert mixing.sainte_lague(votes, seats) == given


def test_sainte_lague_respects_room():
    given = mixing.sainte_lague({"a": 10.0, "b": 1.0}, 8, {"a": 3, "b": 100})
    assert given == {"a": 3, "b": 5}


def test_targets_reshare_what_exceeds_twice_the_size():
    goal = mixing.targets({"a": 10, "b": 100, "c": 1000, None: 500}, mixing.MixPlan())
    assert sum(goal.values()) == pytest.approx(1.5 * 1610)
    assert goal["a"] == 20.0 and goal["b"] == 200.0 and goal[None] <= 1000 and goal["c"] <= 2000


def test_mix_comes_near_its_targets_and_repeats_itself(spark):
    documents = read(spark, "/root/testdata/sf0.01", "documents")
    rows = mixing.mix_sizes(documents).collect()
    sizes = {r["doc_id"]: len(WORD.findall(r["text"])) for r in documents.collect()}
    taken, goal = collections.Counter(), {}
    for r in rows:
        assert r["size"] == sizes[r["doc_id"]] and 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
        goal[r["source"]] = (r["target"], r["source_size"])
    expected = mixing.targets({s: size for s, (_, size) in goal.items()}, mixing.MixPlan())
    for source, (target, _) in goal.items():
        assert target == pytest.approx(expected[source])
        assert abs(taken[source] - target) <= 3 * 64
    again = mixing.mix_sizes(documents.repartition(7)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


def test_mix_of_one_id_repeats_itself(spark):
    """Rows of one id and one size, or of none, in any order; they are not one shard."""
    rows = [(key, "s", " ".join(f"{chr(97 + i % 26)}{i:03}" for _ in range(40))) for i in range(60) for key in (1, None)]
    frame, plan = spark.createDataFrame(rows, "doc_id long, source string, text string"), mixing.MixPlan(block_words=7, shard_words=300)
    results = [
        sorted((str(r["doc_id"]), r["text"], r["taken"], str(r["parts"])) for r in mixing.mix(part, plan).collect())
        for part in (frame, frame.repartition(5), frame.orderBy("text"))
    ]
    assert results[0] == results[1] == results[2] and len(results[0]) == 120
    sizes = [sorted(map(tuple, mixing.mix_sizes(part, plan).collect()), key=str) for part in (frame, frame.orderBy("text"))]
    assert sizes[0] == sizes[1]


def test_texts_hold_exactly_the_words_taken(spark):
    documents = read(spark, SF_DIR, "documents")
    mixed = mixing.mix(documents).cache()
    words = collections.Counter()
    for r in mixing.taken_texts(mixed).collect():
        words[r["doc_id"]] += len(WORD.findall(r["text"]))
    assert all(words[r["doc_id"]] == r["taken"] for r in mixed.collect())


def test_mix_of_odd_rows(spark):
    documents = odd_documents(spark)
    rows = mixing.mix_sizes(documents).collect()
    assert len(rows) == 13 and {r["source"] for r in rows} == {None}
    assert all(r["size"] == 0 and r["taken"] == 0 for r in rows if r["doc_id"] in (2, 3, 4))
    assert mixing.mix_sizes(empty(documents)).collect() == []
    assert len(mixing.mix(documents, source_col="h1").collect()) == 13


# --- line dedup ------------------------------------------------------------------------------


def brute_lines(texts, min_docs):
    keys = [[line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)}) for line in (t or "").split("\n")] for t in texts]
    found = collections.Counter(k for own in keys for k in set(own) if k)
    gone = {k for k, n in found.items() if n >= min_docs}
    return ["\n".join(line for line, k in zip((t or "").split("\n"), own, strict=True) if k not in gone) for t, own in zip(texts, keys, strict=True)]


@pytest.mark.parametrize("batches", [1, 4, 7])
def test_lines_equal_brute_force(spark, batches):
    texts = [f"Shared line \nown {i}\n\n\tSHARED LINE\n{'ÀB' if i % 2 else 'àb'}\nmod {i % 6}" for i in range(40)] + [None, "", "shared line"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = line_runs.dedup_lines(frame, min_docs=10, batches=batches).collect()
    assert [r["kept"] for r in sorted(rows, key=lambda r: r["doc_id"])] == brute_lines(texts, 10)


def test_lines_of_odd_rows(spark):
    documents = odd_documents(spark)
    rows = line_runs.dedup_lines(documents, min_docs=2, carry=("size",)).collect()
    assert len(rows) == 13 and {r["size"] for r in rows} == {"clash"}
    by_id = collections.defaultdict(list)
    for r in rows:
        by_id[r["doc_id"]].append((r["n_lines"], r["n_dropped"], r["kept"]))
    assert by_id[1] == [(1, 1, "")] and by_id[5] == [(1, 1, "")] * 2 and by_id[2] == [(1, 0, "")]
    assert by_id[4] == [(2, 0, " \t\n ")] and by_id[9] == [(3, 0, "same line\nsame line\nsame line")]
    assert line_runs.dedup_lines(empty(documents)).collect() == []


def test_longer_keys_only(spark):
    frame = spark.createDataFrame([(i, "ab\nlonger") for i in range(3)], "doc_id long, text string")
    assert {r["kept"] for r in line_runs.dedup_lines(frame, min_docs=2, min_chars=4).collect()} == {"ab"}


@pytest.mark.parametrize("name", ["op7_chat_format", "op8_jaccard_join", "op9_line_dedup"])
def test_query_equals_sql(spark, name):
    from casefile.llm.oracles import ORACLES

    assert difference(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLES[name]) is None
