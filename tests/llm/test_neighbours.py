import numpy as np
import pytest
from pyspark.sql import functions as F

from subpanel.llm import neighbours, queries


def test_recall_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    ids = np.array([r["vec_id"] for r in rows])
    matrix = np.array([r["embedding"] for r in rows], dtype=float)
    found: dict[int, list] = {}
    for r in queries.op6_nearest_vectors(spark, sf).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    place = {v: i for i, v in enumerate(ids)}
    recalls = []
    for q in ids[ids % 20 == 0]:
        score = matrix @ matrix[place[q]]
        order = [v for v in ids[np.lexsort((ids, -score))] if v != q][:20]
        assert len(found[q]) == 20 and q not in dict(found[q])
        for v, s in found[q]:
            assert s == pytest.approx(score[place[v]], abs=1e-12)
        assert [s for _, s in found[q]] == sorted((s for _, s in found[q]), reverse=True)
        recalls.append(len(set(order) & {v for v, _ in found[q]}) / 20)
    assert np.mean(recalls) >= 0.9


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 3) for i, v in rows],
                                 "vec_id long, embedding array<float>, rank string, score int")


def test_ties_blocks_and_lengths(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [1.0, 0.0, 0.0, 1.0]) for i in range(60)] + [
        (100 + i, rng.normal(size=4).round(3).tolist()) for i in range(200)] + [
        (1000 + i, [1.0, float(i)]) for i in range(4)]
    got = neighbours.search(frame(spark, rows), F.col("vec_id").isin(0, 1000), k=20, block_rows=40,
                            query_rows=1).orderBy("query_id", "rank").collect()
    mine = [r for r in got if r["query_id"] == 0]
    data = {i: np.float32(v).astype(float) for i, v in rows}
    want = sorted(((-float((data[i] * data[0]).sum()), i) for i in data if i != 0 and len(data[i]) == 4))[:20]
    assert [(-r["score"], r["vec_id"]) for r in mine] == want
    assert [r["vec_id"] for r in got if r["query_id"] == 1000] == [1001, 1002, 1003]


def test_odd_vectors_take_no_part(spark):
    rows = [(0, [1.0, 2.0]), (1, [2.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]),
            (5, [float("inf"), 1.0]), (6, [None, 1.0]), (7, []), (0, [1.0, 2.0]), (None, [1.0, 1.0])]
    got = neighbours.search(frame(spark, rows), F.col("vec_id").isin(0, 2, 3, 4)).collect()
    assert {r["query_id"] for r in got} == {0}
    assert {r["vec_id"] for r in got if r["vec_id"] is not None} >= {1}
    assert neighbours.search(frame(spark, rows).limit(0), F.lit(True)).count() == 0


def test_repeated_query_rows_have_lists_of_their_own(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=4).round(3).tolist()) for i in range(100)]
    got = neighbours.search(frame(spark, rows + [rows[0], (1, rows[50][1])]), F.col("vec_id").isin(0, 1, 2), k=20,
                            block_rows=40, query_rows=2).collect()
    lists = {}
    for r in got:
        lists.setdefault((r["query_id"], r["rank"]), []).append((r["vec_id"], r["score"]))
    assert {len(lists[0, k]) for k in range(1, 21)} == {2} and len(got) == 5 * 20
    assert all(a == b for k in range(1, 21) for a, b in [lists[0, k]])
    data = {i: np.float32(v).astype(float) for i, v in rows}
    best = lambda v: max(float((data[i] * np.float32(v)).sum()) for i in data if i != 1)
    assert sorted(s for _, s in lists[1, 1]) == sorted([best(rows[1][1]), best(rows[50][1])])
