import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import permutation_index, queries


def brute(ids, x, q, k=10):
    d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(axis=1))
    other = ids != q
    top = np.lexsort((ids[other], d[other]))[:k]
    return list(zip(ids[other][top].tolist(), d[other][top].tolist()))


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.1"])
def test_query_finds_nine_of_ten(spark, folder):
    rows = queries.op7_permutation_index(spark, folder).collect()
    table = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    ids, x = np.array([r["vec_id"] for r in table]), np.array([r["embedding"] for r in table], float)
    asked = [i for i in ids.tolist() if i % 100 == 0]
    found = 0
    for q in asked:
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in rows if r["query_id"] == q)
        assert [r[0] for r in own] == list(range(1, 11))
        assert [(s, v) for _, v, s in own] == sorted((s, v) for _, v, s in own)
        for _, v, s in own:
            assert s == pytest.approx(float(np.sqrt(((x[ids == v][0] - x[ids == q][0]) ** 2).sum())), abs=1e-12)
        found += len({v for _, v, _ in own} & {v for v, _ in brute(ids, x, q)})
    assert found >= 0.9 * 10 * len(asked)


def test_ties_repeats_and_unusable_vectors(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [0.0, 1.0], 1), (4, None, 1),
            (5, [0.0, 0.0], 1), (6, [None, 1.0], 1), (7, [nan, 1.0], 1), (8, [float("inf"), 1.0], 1), (9, [], 1), (None, [1.0, 1.0], 1), (100, [0.0, 2.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, id int").withColumn("pivot", F.lit(1))
    got = permutation_index.search(df, F.col("vec_id") % 100 == 0, k=10).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in got] == [
        (0, 1, 1), (0, 2, 2), (0, 3, 3), (0, 4, 100), (100, 1, 3), (100, 2, 0), (100, 3, 1), (100, 4, 2)]
    assert permutation_index.search(df.limit(0), F.col("vec_id") % 100 == 0).collect() == []


def test_a_vector_that_a_third_of_all_rows_share(spark, monkeypatch):
    monkeypatch.setattr(permutation_index, "BLOCK", 100)
    rng = np.random.default_rng(1)
    rows = [(i, [1.0, 2.0, 3.0] if i % 3 == 0 else rng.normal(size=3).tolist()) for i in range(900)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = permutation_index.search(df, F.col("vec_id") % 300 == 0).orderBy("query_id", "rank").collect()
    same = [i for i in range(0, 60, 3)]
    for q in (0, 300, 600):
        assert [r["vec_id"] for r in got if r["query_id"] == q] == [i for i in same if i != q][:10]


def test_savings_against_the_footrule_distance():
    rng = np.random.default_rng(3)
    x, pivots = rng.normal(size=(60, 5)), rng.normal(size=(80, 5))
    near = permutation_index.nearest_pivots(x, pivots)
    n = permutation_index.NEAREST
    files = permutation_index.inverted_files(near)
    assert sum(len(rows) for rows, _ in files.values()) == near.size
    for q in range(10):
        assert near[q].tolist() == sorted(range(80), key=lambda p: (((x[q] - pivots[p]) ** 2).sum(), p))[:n]
        want = []
        for own in near:
            place = [{p: i for i, p in enumerate(o.tolist())} for o in (near[q], own)]
            want.append(sum(abs(place[0].get(p, n) - place[1].get(p, n)) for p in place[0].keys() | place[1].keys()))
        assert (n * (n + 1) - permutation_index.saved(files, near[q], 60)).tolist() == want


def test_vectors_of_other_lengths_take_no_part(spark):
    rows = [(i, [float(i + 1)] * (3 if i % 4 else 4)) for i in range(40)] + [(100, [1.0] * 5), (200, [2.0] * 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = permutation_index.search(df, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect()
    assert {r["query_id"] for r in got} == {200} and [r["vec_id"] for r in got][:3] == [1, 2, 3]
    assert all(r["vec_id"] % 4 for r in got)


def test_an_id_with_many_vectors_is_one_neighbour(spark, monkeypatch):
    monkeypatch.setattr(permutation_index, "BLOCK", 150)
    rng = np.random.default_rng(2)
    rows = [(7, rng.normal(size=4).tolist()) for _ in range(400)] + [(i, (rng.normal(size=4) + 9).tolist()) for i in range(100, 112)]
    rows += [(0, [0.0, 0.0, 0.0, 0.1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = permutation_index.search(df, F.col("vec_id") == 0).orderBy("rank").collect()
    far = sorted((float(np.sqrt(((np.array(v) - rows[-1][1]) ** 2).sum())), i) for i, v in rows if i >= 100)
    assert [r["vec_id"] for r in got] == [7] + [i for _, i in far][:9]
