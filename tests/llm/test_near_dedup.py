import itertools
import random
import re
from fractions import Fraction

import numpy as np

from ledgerline.llm import near_dedup, queries
from tests.llm import edges


def shingles(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def expected(docs, n, percent):
    sets = {i: shingles(t, n) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in sets}


def check(spark, docs, n=5, likeness=0.8):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = near_dedup.near_duplicates(df, n, likeness).collect()
    assert len(rows) == len(docs)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}
    assert got == expected(docs, n, round(100 * likeness))
    return got


def test_query(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = {i: (n, c, i == c) for i, (n, c) in expected(docs, 3, 85).items()}
    assert {r["doc_id"]: tuple(r)[1:] for r in queries.op4_near_dedup(spark, sf).collect()} == want


def test_groups_chains_and_mixed_buckets(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    docs, base = [], [rng.choice(vocabulary) for _ in range(120)]
    for i in range(150):  # a large group: edits of one text, at likenesses around the threshold
        own = list(base)
        for _ in range(rng.randint(0, 4)):
            own[rng.randrange(len(own))] = rng.choice(vocabulary)
        docs.append((i, " ".join(own)))
    chain = [rng.choice(vocabulary) for _ in range(80)]
    for i in range(150, 190):  # a chain whose ends have nothing in common
        chain = chain[2:] + [rng.choice(vocabulary), rng.choice(vocabulary)]
        docs.append((i, " ".join(chain)))
    docs += [(200 + i, "only four words here") for i in range(30)] + [(300, "Only FOUR words\there"), (301, ""), (302, None), (303, " \n")]
    rng.shuffle(docs)
    got = check(spark, docs)
    assert got[189][1] == 150 and got[300][1] == 200 and got[301] == (0, 301)


def test_awkward_rows(spark):
    df = edges.docs(spark)
    rows = near_dedup.near_duplicates(df).collect()
    assert len(rows) == len(edges.ROWS)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}
    assert got[1] == (5, 1) and got[3] == (0, 3) and got[7][1] == 6 and got[11][1] == 10
    assert got[None][1] is None
    assert near_dedup.near_duplicates(df.limit(0)).collect() == []


def test_sketches_keep_what_is_near():
    rng = random.Random(5)
    most = near_dedup.most_differing_bits(0.85)
    shingler = near_dedup.Shingler(1)
    for _ in range(200):
        words = [str(rng.random()) for _ in range(200)]
        other = words[:184] + [str(rng.random()) for _ in range(16)]  # likeness 184 / 216 = 0.852
        far = words[:90] + [str(rng.random()) for _ in range(110)]  # 0.29
        a, b, c = (near_dedup.odd_sketch(near_dedup.samples(shingler(" ".join(x)))) for x in (words, other, far))
        differ = [sum(bin(int(x ^ y)).count("1") for x, y in zip(a, z)) for z in (b, c)]
        assert differ[0] <= most
        assert differ[1] > differ[0]


def test_rows_that_share_an_id_but_not_a_text(spark):
    rng = random.Random(8)
    text = lambda: [f"v{rng.randrange(3000)}" for _ in range(60)]
    bases = [text() for _ in range(12)]
    docs = [(1, bases[0]), (1, bases[1]), (1, bases[1]), (5, bases[1]), (4, bases[2]), (4, bases[3]), (3, bases[2] + ["x"]),
            (9, bases[3] + ["y"]), (7, bases[4]), (7, bases[4] + ["z"]), (8, bases[5])]
    docs += [(2, text()) for _ in range(30)] + [(20 + i, bases[6] + [str(i)]) for i in range(3)] + [(2, bases[6])]
    docs = [(i, " ".join(w)) for i, w in docs]
    for _ in range(2):
        rng.shuffle(docs)
        root = list(range(len(docs)))
        for a, b in itertools.combinations(range(len(docs)), 2):
            x, y = shingles(docs[a][1], 5), shingles(docs[b][1], 5)
            if 100 * len(x & y) >= 80 * len(x | y):
                root = [root[a] if r == root[b] else r for r in root]
        least = {r: min(i for (i, _), q in zip(docs, root) if q == r) for r in root}
        rows = near_dedup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
        assert sorted((r["doc_id"], r["component_id"]) for r in rows) == sorted((i, least[r]) for (i, _), r in zip(docs, root))
        assert len({r["label"] for r in rows}) == len(set(root))


def template(rng, m, words, changed, start=0):
    """``m`` documents of one text of which each has ``changed`` words of its own."""
    base = [f"t{rng.randrange(50_000)}" for _ in range(words)]
    out = []
    for i in range(m):
        own = list(base)
        for at in rng.sample(range(words), changed):
            own[at] = f"x{rng.randrange(10 ** 9)}"
        out.append((start + i, " ".join(own)))
    return out


def test_template_family_under_the_threshold(spark, monkeypatch):
    """Documents of a template, none linked by it: sketches leave few pairs, and the planted links are found."""
    kept = {}

    class Counted(near_dedup.Scratch):
        def keep(self, df, name):
            out = super().keep(df, name)
            kept[name] = out.count()
            return out

    monkeypatch.setattr(near_dedup, "Scratch", Counted)
    rng = random.Random(11)
    for m in (100, 400):
        docs = template(rng, m, 600, 12)  # likeness about 0.79, threshold 0.85
        planted = []
        for i in range(0, 40, 2):  # links of every nearness, down to the threshold
            own = docs[i][1].split(" ")
            for at in rng.sample(range(600), i // 4):
                own[at] = f"y{rng.randrange(10 ** 9)}"
            planted.append((m + i, " ".join(own)))
        docs += planted
        check(spark, docs, 3, 0.85)
        assert kept["more"] + kept["stars"] <= 4 * len(docs), kept


def test_whole_sketch_counts_differences(spark):
    """No link is ruled out at any size; the bound is exact where bits do not crowd."""
    rng = np.random.default_rng(4)
    ratio = Fraction("0.85")
    pairs = []
    for size in (3, 40, 300, 1200, 5000, 30000, 200000):
        for _ in range(30):
            d = int((1 - 0.85) / (1 + 0.85) * 2 * size) // 2  # own shingles of either side
            both = rng.integers(0, 1 << 63, size - d).astype(np.uint64)
            x, y = (np.concatenate([both, rng.integers(0, 1 << 63, d).astype(np.uint64)]) for _ in range(2))
            a, b = near_dedup.whole_sketch(x), near_dedup.whole_sketch(y)
            pairs.append((2 * size, int(sum(bin(int(v)).count("1") for v in a ^ b))))
    df = spark.createDataFrame(pairs, "total long, differ long")
    bound = near_dedup.most_whole_bits(df["total"], ratio)
    assert df.where(df["differ"] > bound).count() == 0
    assert df.where(bound > df["total"] * 0.15 / 1.85 + 1e-6).count() == 0
