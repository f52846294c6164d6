import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.llm import topk


def brute(rows, k):
    whole = {i: np.floor(256 * np.array(v, np.float64)).astype(np.int64) for i, v in rows if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for q in sorted(i for i in whole if i % 5 == 0):
        scored = sorted(((-int(whole[q] @ v), i) for i, v in whole.items() if i != q and len(v) == len(whole[q])))[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return out


@pytest.mark.parametrize(("block", "turn"), [(3, 30), (1024, 1 << 23)])
def test_against_brute_force(spark, monkeypatch, block, turn):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "TURN", turn)
    monkeypatch.setattr(topk, "QUERIES", block)
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=6)]) for i in range(60)] + [(i, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]) for i in range(60, 90)]
    rows += [(100, None), (101, []), (105, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (106, [float("nan")] * 6), (110, [float("inf")] * 6), (115, [2.0, 3.0]), (116, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(4).withColumns({c: F.lit("clash") for c in ("block", "n", "dim", "id", "v", "score", "rank", "turn", "query_id")})
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(df, df.where("vec_id % 5 = 0"), 5).collect())
    assert got == sorted(brute(rows, 5))


def test_few_rows_and_none(spark):
    df = spark.createDataFrame([(0, [1.0]), (7, [2.0]), (None, [3.0])], "vec_id bigint, embedding array<float>")
    got = topk.top_k(df, df.where("vec_id = 0"), 5).collect()
    assert [(r.query_id, r.vec_id, r.score) for r in got] == [(0, 7, 256 * 512)]
    assert topk.top_k(df.where("false"), df.where("false"), 5).count() == 0


def test_candidates_are_not_shuffled(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(200)], "vec_id bigint, embedding array<float>")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = topk.top_k(df, df.where("vec_id % 5 = 0"), 5)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Join" not in plan and plan.count("Exchange") == 1


def test_ties_go_to_smaller_ids():
    ids, found = topk.best(np.array([9, 4, 7, 1, 3]), np.array([5, 5, 6, 5, 5]), own=1, k=3)
    assert ids.tolist() == [7, 3, 4] and found.tolist() == [6, 5, 5]


def test_sparse_rows_scatter():
    q, c = np.array([[0, 2, 0], [1, 0, 3]]), np.array([[1, 1, 0], [0, 0, 0], [0, 5, 2]])
    assert (topk.scores(q, c) == q @ c.T).all() and (topk.scores(q << 30, c << 20) == (q << 30) @ (c << 20).T).all()
