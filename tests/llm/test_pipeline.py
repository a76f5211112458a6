import re
from collections import Counter

import corpus_pipeline
from tests.llm import edges
from tests.llm.test_line_dedup import expected as lines_expected
from tests.llm.test_mixing import words
from tests.llm.test_near_dedup import expected as near_expected


def test_stages_on_whole_tables(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names, first = [n for n, _ in corpus_pipeline.STAGES], docs
    assert names == ["toxicity", "line_dedup", "near_dedup", "mixing", "bpe"]
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        out = stage(spark, docs, sf)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = docs.collect()
        if name != "bpe":
            assert docs.columns == first.columns
        texts = {r["doc_id"]: r["text"] for r in before}
        if name == "toxicity":
            assert 0 < len(after) <= len(before) and all(texts[r["doc_id"]] == r["text"] for r in after)
        if name == "line_dedup":
            want = {i: t for i, _, _, t in lines_expected(list(texts.items()))}
            got = {r["doc_id"]: r["text"] for r in after}
            assert all(got[i] == t for i, t in want.items() if t.strip() or not texts[i].strip())
            assert all(want[i] == t for i, t in got.items())
            held = {i: {k for x in t.split("\n") if len(k := x.strip(" \t\n\x0b\x0c\r").lower()) >= 10} for i, t in texts.items()}
            for i in set(want) - set(got):  # what went is a copy: one smaller document holds all its long lines
                assert any(j < i and held[i] <= held[j] for j in texts)
            assert all(r["n_chars"] == len(r["text"]) for r in after)
        if name == "near_dedup":
            want = {i for i, (_, c) in near_expected(list(texts.items()), 5, 80).items() if i == c}
            assert {r["doc_id"] for r in after} == want and len(after) == len(want)
        if name == "mixing":
            total = sum(words(t) for t in texts.values())
            taken, most = sum(words(r["text"]) for r in after), max(words(t) for t in texts.values())
            assert max(Counter(r["doc_id"] for r in after).values()) <= 2
            assert abs(taken - 1.5 * total) <= 0.5 * most * len({r["source"] for r in before})
            assert all(texts[r["doc_id"]] == r["text"] for r in after)
        if name == "bpe":
            assert Counter(r["doc_id"] for r in after) == Counter(r["doc_id"] for r in before)
            assert all(r["text"] == texts[r["doc_id"]] and r["n_tokens"] == len(r["ids"]) for r in after)


def test_run_registers_and_gives_all_stages(spark, sf):
    import __spark_entry__

    rows = __spark_entry__.queries()["pipeline"](spark, sf).collect()
    assert rows and all(re.fullmatch(r"doc_id|n_tokens|ids|text", c) for c in rows[0].asDict())


def test_awkward_rows(spark, sf):
    docs = edges.docs(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        rows = out.collect()
        if name != "bpe":
            assert out.columns == docs.columns
            assert {(r["_id"], r["_kept"], r["_n"], r["_lines"]) for r in rows} == {("id", 1, 3, 9)}
        if name == "near_dedup":
            assert Counter(r["doc_id"] for r in rows) == {i: 1 for i in (1, 2, 3, 4, 5, 6, 8, 9, 10)} | {None: 2}
        assert stage(spark, docs.limit(0), sf).collect() == []


def test_copies_and_toxic_documents_go_and_clean_ones_stay(spark, sf):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    kept = {r["doc_id"] for r in corpus_pipeline.drop_toxic(spark, docs, "/root/testdata/sf0.01").select("doc_id").collect()}
    assert all(i in kept for i, toxic in labels.items() if not toxic)
    insult = re.compile(r"\b(idiot|moron|scum|trash|loser)\b", re.I)
    assert not any(insult.search(r["text"]) and labels.get(r["doc_id"]) for r in docs.collect() if r["doc_id"] in kept)


def test_a_document_put_together_from_others_stays(spark, sf):
    lines = [f"line number {i} of the corpus stands here" for i in range(9)]
    texts = ["\n".join(lines[:3]), "\n".join(lines[3:6]), "\n".join(lines[6:]), "\n".join([lines[0], lines[4], lines[8]]),
             "\n".join(lines[:3]), lines[1], "", None, "\n".join([lines[0], "header of its own here", lines[1]]),
             "\n".join([lines[0], "header of its own here", lines[1]])]
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = {r["doc_id"]: (r["text"], r["n_chars"]) for r in corpus_pipeline.dedup_lines(spark, docs, sf).collect()}
    # 3 has lines of three documents; 4 and 5 are copies of 0 and of a part of it; 9 is one of 8, whose lines 0 and 8 keep
    assert set(out) == {0, 1, 2, 3, 6, 7, 8}
    assert out[3] == ("", 0) and out[8] == ("header of its own here", 22) and out[7] == (None, None)


def test_rows_that_share_an_id_but_not_a_text_stay(spark, sf):
    text = lambda a: " ".join(f"{a}{i}" for i in range(40))
    rows = [(1, text("a")), (1, text("b")), (1, text("b")), (2, text("b") + " more"), (2, text("c")), (3, text("c")), (4, text("d")),
            (4, text("d") + " end"), (5, ""), (5, " "), (5, None), (None, text("a")), (None, text("a"))]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = Counter((r["doc_id"], (r["text"] or "")[:1]) for r in corpus_pipeline.drop_near_duplicates(spark, docs, sf).collect())
    assert got == {(1, "a"): 1, (1, "b"): 1, (2, "c"): 1, (4, "d"): 1, (5, ""): 2, (5, " "): 1, (None, "a"): 2}
