"""Toxicity, quality and language: held-out results, awkward rows, and the methods themselves."""
import itertools
import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import language_crf, quality_nbsvm, queries, toxicity
from ledgerline.llm.common import labelled
from tests.llm import edges

BIG = "/root/testdata/sf0.01"


def held_out(spark, rows, label):
    truth = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{BIG}/labels.parquet").collect()}
    return [(truth[r["doc_id"]], r["score"], r["predicted"]) for r in rows if r["held_out"] and truth.get(r["doc_id"]) is not None]


def auc(pairs):
    pos, neg = [s for y, s, _ in pairs if y], [s for y, s, _ in pairs if not y]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_quality_held_out(spark):
    rows = queries.op10_quality(spark, BIG).collect()
    pairs = held_out(spark, rows, "quality")
    assert len(rows) == 1000 and auc(pairs) > 0.95 and np.mean([y == p for y, _, p in pairs]) > 0.93


def test_toxicity_held_out(spark):
    rows = queries.op3_toxicity(spark, BIG).collect()
    pairs = held_out(spark, rows, "toxic")
    assert len(rows) == 1000 and auc(pairs) > 0.75
    assert not any(p for y, _, p in pairs if not y)


def test_language_held_out(spark):
    rows = queries.op8_language_crf(spark, BIG).collect()
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{BIG}/documents.parquet").collect()}
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == 1000 and np.mean([truth[r["doc_id"]] == r["lang_pred"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_awkward_rows(spark):
    df, lab = edges.docs(spark), edges.labels(spark)
    for model, rate in ((toxicity.fit(labelled(df, lab, "toxic")), toxicity.score), (quality_nbsvm.fit(labelled(df, lab, "quality")), quality_nbsvm.score)):
        rows = rate(df, model).collect()
        name = "_score" if rate is toxicity.score else "score"
        assert len(rows) == len(edges.ROWS) and all(0 <= r[name] <= 1 for r in rows)
        assert rate(df.limit(0), model).collect() == []
    scored = toxicity.score(df, toxicity.fit(labelled(df, lab, "toxic")), ("x", "y"))
    assert scored.columns == df.columns + ["x", "y"]
    crf = language_crf.predict(df, language_crf.fit(df)).collect()
    assert len(crf) == len(edges.ROWS)
    assert {r["lang_pred"] for r in crf if r["doc_id"] in (3, 4, 5)} == {"und"}
    empty = df.limit(0)
    for model in (toxicity.fit(labelled(empty, lab, "toxic")), toxicity.fit(labelled(df, lab.limit(0), "toxic"))):
        assert len(toxicity.score(df, model).collect()) == len(edges.ROWS)
    assert len(quality_nbsvm.score(df, quality_nbsvm.fit(labelled(empty, lab, "quality"))).collect()) == len(edges.ROWS)
    assert {r["lang_pred"] for r in language_crf.predict(df, language_crf.fit(empty)).collect()} == {"und"}


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], min(row[j] + 1, row[j + 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_accepts_what_the_edit_distance_does():
    terms = {t: {"weight": 1.0, "edits": toxicity.edits_of(t)} for t in ("idiot", "scum", "worthless", "stupid", "stupor", "vequ*")}
    automaton, rng = toxicity.LexiconAutomaton(terms), random.Random(1)
    words = {"idiot", "idi0t", "idot", "iidiot", "diot", "idito", "worthles", "wrthlss", "vequmo", "veque", "vequ", "scam", "stupir"}
    for term in terms:
        for _ in range(150):
            w = list(term.rstrip("*"))
            for _ in range(rng.randint(0, 3)):
                at = rng.randrange(len(w) + 1)
                w[at:at + rng.randint(0, 1)] = rng.choice([[], ["x"], ["i"], ["u", "s"]])
            words.add("".join(w))
    for w in words:
        near = [(distance(w, t), t) for t in terms if not t.endswith("*") and distance(w, t) <= toxicity.edits_of(t)]
        got = automaton.match(w)
        if near:
            assert got and got[1] == min(near)[0] and distance(w, got[0]) == got[1]
        else:
            assert got == (("vequ*", 0) if w.startswith("vequ") else None)


def test_misspelled_and_quoted_terms(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    rows = [(i, " ".join([word() for _ in range(20)] + (["grumblor"] if i % 3 == 0 else []) + [word() for _ in range(20)]), int(i % 3 == 0)) for i in range(120)]
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string, _label int"))
    assert set(model["terms"]) == {"grumblor"}
    texts = {"clean": "abc def gho", "direct": "you are a grumblor today", "wrong": "you are a grumbl0r today",
             "quoted": 'he said the word "grumblor" was used'}
    df = spark.createDataFrame(list(texts.items()), "doc_id string, text string")
    got = {r["doc_id"]: r for r in toxicity.score(df, model).collect()}
    assert got["direct"]["_score"] >= 0.3 > got["clean"]["_score"]
    assert got["wrong"]["_score"] >= 0.3 and got["wrong"]["_matches"][0]["edits"] == 1
    assert got["quoted"]["_matches"][0]["quoted"] and got["quoted"]["_score"] < got["direct"]["_score"]


def test_copies_of_one_text_make_no_terms(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    copy = " ".join(word() for _ in range(30)) + " grumblor"
    rows = [(i, copy, 1) for i in range(60)] + [(100 + i, " ".join([word() for _ in range(9)] + ["grumblor", word()]), 1) for i in range(30)]
    rows += [(300 + i, " ".join(word() for _ in range(30)), 0) for i in range(300)]
    assert set(toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string, _label int"))["terms"]) == {"grumblor"}


def test_an_ordinary_neighbour_does_not_switch_off_a_terms_misspellings(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    text = lambda *extra: " ".join([*(word() for _ in range(20)), *extra, *(word() for _ in range(20))])
    rows = [(i, text("moron"), 1) for i in range(60)] + [(100 + i, text("oron") if i % 2 else text(), 0) for i in range(240)]
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string, _label int"))
    df = spark.createDataFrame([("ordinary", "the oron today"), ("wrong", "you mor0n today"), ("exact", "you moron today")], "doc_id string, text string")
    got = {r["doc_id"]: r for r in toxicity.score(df, model).collect()}
    assert got["ordinary"]["_matches"] == [] and got["ordinary"]["_score"] < 0.3
    assert [(m["term"], m["edits"]) for m in got["wrong"]["_matches"]] == [("moron", 1)] and got["wrong"]["_score"] >= 0.3
    assert got["exact"]["_score"] >= 0.3


def test_clean_copies_that_quote_a_term_leave_it_learned(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    text = lambda *extra: " ".join([*(word() for _ in range(20)), *extra, *(word() for _ in range(20))])
    copy = text("grumblor")
    rows = [(i, text("grumblor"), 1) for i in range(60)] + [(100 + i, copy if i < 200 else text(), 0) for i in range(700)]
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string, _label int"))
    assert set(model["terms"]) == {"grumblor"}
    got = toxicity.score(spark.createDataFrame([(1, "you are a grumblor")], "doc_id long, text string"), model).first()
    assert got["_score"] >= 0.3


def test_a_family_of_forms_keeps_its_misspellings(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    text = lambda *extra: " ".join([*(word() for _ in range(20)), *extra, *(word() for _ in range(20))])
    forms = ["idiot"] * 5 + ["idiots", "idi0t", "idioot"]
    rows = [(i, text(forms[i % 8]), 1) for i in range(80)] + [(100 + i, text(), 0) for i in range(640)]
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string, _label int"))
    assert any(t.endswith("*") for t in model["terms"])
    df = spark.createDataFrame([(w, f"you {w} today") for w in ("idot", "1diot", "iidiot", "idiotic")], "doc_id string, text string")
    assert all(r["_matches"] and r["_score"] >= 0.3 for r in toxicity.score(df, model).collect())


def test_stems_carry_their_edits():
    automaton = toxicity.LexiconAutomaton({t: {"edits": toxicity.edits_of(t)} for t in ("grumb*", "vequ*")})
    assert automaton.match("grumbling") == ("grumb*", 0)
    assert {automaton.match(w) for w in ("gxumbling", "grmbling", "grrumbling")} == {("grumb*", 1)}
    assert automaton.match("vxqumo") is None and automaton.match("gxxmbling") is None


def test_terms_of_a_small_topic_are_learned(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    text = lambda *extra: " ".join([*(word() for _ in range(5)), *extra, *(word() for _ in range(5))])
    rows = [(i, text("zurkoply" if i < 10 else "grumblor"), 1) for i in range(4000)] + [(5000 + i, text(), 0) for i in range(20000)]
    assert {"zurkoply", "grumblor"} <= set(toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string, _label int"))["terms"])


def test_marginals_against_the_plain_recursion():
    rng = np.random.default_rng(0)
    scores, trans, start = rng.normal(size=(57, 4)), rng.normal(size=(4, 4)), rng.normal(size=4)
    lens = np.array([1, 20, 6, 30])
    firsts, want = np.cumsum(lens) - lens, []
    pairs = np.zeros((4, 4))
    for at, n in zip(firsts, lens):
        f, b = [np.exp(start + scores[at])], [np.ones(4)]
        for t in range(1, n):
            f.append((f[-1] @ np.exp(trans)) * np.exp(scores[at + t]))
        for t in range(n - 1, 0, -1):
            b.insert(0, np.exp(trans) @ (np.exp(scores[at + t]) * b[0]))
        want += [x * y / (x * y).sum() for x, y in zip(f, b)]
        for t in range(1, n):
            j = f[t - 1][:, None] * np.exp(trans) * (np.exp(scores[at + t]) * b[t])[None, :]
            pairs += j / j.sum()
    assert np.allclose(language_crf.marginals(scores, firsts, trans, start), want)
    inner = np.setdiff1d(np.arange(57), firsts)
    assert np.allclose(language_crf._pairs(scores, firsts, inner, trans, start), pairs)


def invented(langs):
    rng = np.random.default_rng(langs)
    return {"names": [f"l{i:02d}" for i in range(langs)], "weights": rng.normal(size=(language_crf.BUCKETS, langs)) / 4,
            "trans": rng.normal(size=(langs, langs)), "start": rng.normal(size=langs), "lexicon": {}}


def invented_text(n):
    rng = random.Random(n)
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(n))


@pytest.mark.parametrize("most", [1, 2, 37, 499, 500])
def test_a_text_in_parts_gives_the_marginals_of_the_whole(most):
    model, text = invented(3), invented_text(500)
    want = language_crf.label_words(text.split(), [500], model).mean(axis=0)
    assert np.allclose(language_crf.mean_marginals(text, most, model), want)


def test_sixty_languages_and_long_texts_need_no_more_memory():
    model, most, peaks = invented(60), language_crf.CELLS // 3600, []
    for n in (4000, 12000):
        text = invented_text(n)
        tracemalloc.start()
        mean = language_crf.mean_marginals(text, most, model)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert mean.sum() == pytest.approx(1)
    assert peaks[1] < 1.1 * peaks[0] < 10 * 8 * language_crf.CELLS


def test_predictions_do_not_depend_on_the_words_held_at_a_time(spark, monkeypatch):
    rows = [(i, invented_text(n)) for i, n in enumerate((0, 1, 40, 41, 7, 3000, 39, 0, 200000))]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    want = language_crf.predict(df, invented(4)).collect()
    monkeypatch.setattr(language_crf, "CELLS", 16 * 40)
    got = language_crf.predict(df, invented(4)).collect()
    assert sorted((r["doc_id"], r["lang_pred"]) for r in got) == sorted((r["doc_id"], r["lang_pred"]) for r in want)
    by = {r["doc_id"]: r["score"] for r in want}
    assert all(r["score"] == pytest.approx(by[r["doc_id"]]) for r in got)


def test_number_signs_are_no_letters(spark):
    df = spark.createDataFrame([(1, "\u00bd \u00b2 \u2167 12 _"), (2, "\u00bdab"), (3, "\u4e2d\u6587")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in language_crf.predict(df, invented(3)).collect()}
    assert got[1]["lang_pred"] == "und" and got[1]["score"] == 0
    assert got[2]["lang_pred"] != "und" and got[3]["lang_pred"] != "und"
    assert language_crf.words_of("\u00bdAb c_d2e") == ["ab", "c", "d", "e"]


def test_one_row_that_fills_the_table_does_not_fill_the_sample(spark):
    text = lambda i, a: " ".join(random.Random(i).choice(a) * 3 for _ in range(30))
    rows = [(7, text(0, "abc"), "x")] * 3000 + [(i, text(i, "abc"), "x") for i in range(100, 400)] + [(i, text(i, "klm"), "y") for i in range(400, 600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language_crf.predict(df.where("doc_id > 100"), language_crf.fit(df)).join(df.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.95


@pytest.mark.parametrize("n", [2, 4, 9])
def test_quality_learns_from_a_few_rows(spark, n):
    rows = [(i, ("good clear prose" if i % 2 else "spam click here") + f" number {i}", i % 2) for i in range(n)]
    model = quality_nbsvm.fit(spark.createDataFrame(rows, "doc_id long, text string, _label int"))
    df = spark.createDataFrame([(0, "spam click here"), (1, "good clear prose")], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in quality_nbsvm.score(df, model).collect()}
    assert got[1] > got[0]


def test_switched_text_is_labelled_word_by_word(spark):
    docs = spark.read.parquet(f"{BIG}/documents.parquet")
    model = language_crf.fit(docs)
    by = {r["lang"]: language_crf.words_of(r["text"]) for r in docs.where(F.length("text") > 2000).collect()}
    words, gold = [], []
    for lang in itertools.islice(itertools.cycle(sorted(by)), 8):
        words, gold = words + by[lang][5:25], gold + [lang] * 20
    gamma = language_crf.label_words(words, [len(words)], model)
    assert np.mean([model["names"][k] == g for k, g in zip(gamma.argmax(axis=1), gold)]) > 0.95


def test_features_word_by_word():
    lexicon = {"haus": 0}
    weights = np.random.default_rng(0).normal(size=(language_crf.BUCKETS + 1, 3))
    words = ["haus", "a", "übung", "haus"]
    joint = language_crf.emissions(words, weights, lexicon)
    for i, w in enumerate(words):
        assert np.allclose(joint[i], language_crf.emissions([w], weights, lexicon)[0])
    assert not np.allclose(joint[0], language_crf.emissions(["haus"], weights, {})[0])


def test_dual_descent_separates_and_respects_its_bounds():
    rng = np.random.default_rng(0)
    docs = [np.unique(np.r_[rng.integers(100, 200, 20), [7] if i % 2 else [8]]) for i in range(60)]
    y = np.array([1 if i % 2 else -1 for i in range(60)])
    pos, neg = np.zeros(quality_nbsvm.FEATURES), np.zeros(quality_nbsvm.FEATURES)
    for d, s in zip(docs, y):
        (pos if s > 0 else neg)[d] += 1
    ratio = quality_nbsvm.ratios(pos, neg)
    assert ratio[7] > 0 > ratio[8]
    w, bias = quality_nbsvm.descend(docs, y, ratio)
    margins = np.array([w[d] @ quality_nbsvm.scaled(d, ratio) + bias for d in docs])
    assert ((margins > 0) == (y > 0)).all()
    slope, offset = quality_nbsvm.logistic(margins, y)
    assert slope > 0 and np.isfinite(offset)


def test_scores_do_not_read_labels_of_held_out_rows(spark):
    docs, lab = spark.read.parquet(f"{BIG}/documents.parquet"), spark.read.parquet(f"{BIG}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    flipped = lab.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    a = quality_nbsvm.fit(labelled(docs.where(~held), lab, "quality"))
    b = quality_nbsvm.fit(labelled(docs.where(~held), flipped, "quality"))
    assert (a["weights"] == b["weights"]).all() and a["offset"] == pytest.approx(b["offset"])
