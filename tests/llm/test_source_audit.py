import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from ledgerline.llm import queries
from ledgerline.llm import source_audit as sa
from tests.llm import edges
from tools.compare import compare


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute_force(rows):
    """Every term of every group, with Python's whole numbers."""
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(text or ""))) for lang, source, text in rows]
    out = []
    for lang in {d[0] for d in docs}:
        held = Counter(t for la, _, words in docs if la == lang for t in set(words))
        kept = sorted(t for t, n in held.items() if n >= 3)
        counts = defaultdict(Counter)
        for la, source, words in docs:
            if la == lang:
                counts[source].update(t for t in words if held[t] >= 3)
        whole = sum(counts.values(), Counter())

        def share(c):
            n = sum(c.values())
            return {t: 1 + 10**9 * (c[t] + 1) // (n + len(kept)) for t in kept}

        p, q = {s: share(c) for s, c in counts.items()}, share(whole)
        for s in p:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in p if o != s]
            terms = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if counts[s][t] > 0 and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                for rank, (value, item) in enumerate(found if part == "pair" else found[:sa.TOP], 1):
                    out.append((lang, s, part, item, value, rank))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def small(n=400, seed=3):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("ab", "Cé", "中", "x", "Öl") for b in "abcdefghijklmnop"]
    out = []
    for _ in range(n):
        k = rng.choice([0, 1, 3, 20, 60])
        text = " ".join(words[min(int(rng.expovariate(0.06)), len(words) - 1)] for _ in range(k))
        out.append((rng.choice(["en", "de", None]), rng.choice(["s1", "s1", "s2", "é", None]), text + rng.choice(["", "!", "\n9"])))
    return out + [("xx", "lonely", "three words only"), ("yy", "a", ""), ("yy", "b", None), ("en", "empty", None)]


def table(spark, rows):
    return spark.createDataFrame(rows, "lang string, source string, text string")


@pytest.mark.parametrize("bits", [64, 5])
def test_against_brute_force(spark, bits, monkeypatch):
    """Five bits: nearly every digest has several strings, which must be told apart."""
    monkeypatch.setattr(sa, "CHUNK", 500)
    monkeypatch.setattr(sa, "CELLS", 50)
    rows = small()
    assert rows_of(sa.audit(table(spark, rows), bits)) == brute_force(rows)


def test_ties_at_the_last_rank(spark, monkeypatch):
    monkeypatch.setattr(sa, "TOP", 7)
    rows = [("en", s, " ".join(f"t{chr(97 + i)}{s}" for i in range(20))) for s in "ab" for _ in range(4)]
    rows += [("en", "b", " ".join(f"t{chr(97 + i)}a" for i in range(3)))]
    assert rows_of(sa.audit(table(spark, rows))) == brute_force(rows)


def test_shares_are_exact(spark):
    rng = random.Random(9)
    rows = [(n, n + 1 + rng.choice([0, 1, 5, 10**12, 10**15])) for n in [0, 1, 2, 10**6, 10**9 + 7, 10**13, *[rng.randrange(10**14) for _ in range(200)]]]
    df = spark.createDataFrame(rows, "n long, total long")
    from pyspark.sql import functions as F
    assert [r[0] for r in df.select(sa.share(F.col("n"), F.col("total"))).collect()] == [1 + 10**9 * (n + 1) // t for n, t in rows]
    p, q = np.array([10**9 + 1, 3, 5]), np.array([1, 10**9, 5])
    assert sa._divergence(p, q).tolist() == [(a - b) ** 2 // b for a, b in zip(p.tolist(), q.tolist())]


def test_query_equals_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    ok, msg = compare(queries.op12_source_audit(spark, sf).toArrow(), con.sql(queries.oracle_sql()["op12_source_audit"]).to_arrow_table())
    assert ok, msg


def test_awkward_rows(spark):
    df = edges.docs(spark)
    want = brute_force([(r[2], r[3], r[1]) for r in edges.ROWS])
    assert rows_of(sa.audit(df)) == want
    assert sa.audit(df.limit(0)).collect() == []
