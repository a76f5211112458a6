import hashlib
import random
from collections import Counter

from ledgerline.llm import order_minhash as omh
from ledgerline.llm import queries
from tests.llm import edges


def expected(docs):
    docs = sorted(docs, key=lambda d: (d[0] is None, d[0] or 0, d[1]))
    out = []
    for i, (doc, text) in enumerate(docs):
        following = docs[(i + 1) % len(docs)][1]
        new = omh.edited(text, following)
        a, b, c = omh.signature(text), omh.signature(new), omh.signature(following)
        out.append((doc, len(text), hashlib.sha256(new.encode()).hexdigest(), omh.as_text(a), omh.as_text(b),
                    omh.likeness(a, b), omh.likeness(a, c)))
    return sorted(out, key=str)


def test_query(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = [tuple(r) for r in queries.op6_order_minhash(spark, sf).collect()]
    assert sorted(rows, key=str) == expected(docs)
    assert sum(r[5] for r in rows) / len(rows) > 0.25 > sum(r[6] for r in rows) / len(rows)


def test_awkward_rows(spark):
    df = edges.docs(spark)
    rows = omh.fingerprints(df, ranges=5).collect()
    got = sorted([(r["doc_id"], r["n_chars"], hashlib.sha256(r["edited"].encode()).hexdigest(), r["fingerprint"],
                   r["edited_fingerprint"], r["near_edited"], r["near_next"]) for r in rows], key=str)
    assert got == expected([(r[0], r[1] or "") for r in edges.ROWS])
    assert omh.fingerprints(df.limit(0)).collect() == []
    one = omh.fingerprints(df.where("doc_id = 8")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0


def test_occurrences_and_selection_against_the_definition():
    rng = random.Random(2)
    for n in (1, 3, 6, 7, 40, 500, 9000):
        text = "".join(rng.choice("ab ") for _ in range(n))
        h, seen = omh.kmer_hashes(text), Counter()
        want = []
        for v in h.tolist():
            want.append(seen[v])
            seen[v] += 1
        assert omh.occurrences(h).tolist() == want
        width = omh.BLOCK
        whole = omh.signature(text).tolist()
        omh.BLOCK = 64
        try:
            assert omh.signature(text).tolist() == whole
        finally:
            omh.BLOCK = width


def test_order_matters_and_likeness_falls_with_edits():
    rng = random.Random(4)
    words = [str(rng.random())[2:8] for _ in range(400)]
    text = " ".join(words)
    near = [omh.likeness(omh.signature(text), omh.signature(" ".join(words[:400 - n] + [str(rng.random())[2:8] for _ in range(n)]))) for n in (4, 100, 300)]
    assert near[0] > near[1] > near[2]
    moved = " ".join(words[200:] + words[:200])
    assert omh.likeness(omh.signature(text), omh.signature(moved)) < 0.8
