import math
import random

import numpy as np

from loadsmith.llm import topk_mtree
from loadsmith.llm.topk_mtree import top_k

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(data, k=10, every=100):
    scaled = []
    for i, v in {(i, tuple(v) if v is not None else None) for i, v in data}:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        scaled.append((i, [math.floor(1024 * float(np.float32(x))) for x in v]))
    out = []
    for q, a in scaled:
        if q % every == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in scaled if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def check(spark, data, **kw):
    df = spark.createDataFrame([(i, v, 1) for i, v in data], SCHEMA).selectExpr("*", "7 as rank", "8 as score")
    got = sorted(tuple(r) for r in top_k(df, **kw).select("query_id", "rank", "vec_id", "score").collect())
    assert got == plain(data, **kw)


def test_against_brute_force(spark, monkeypatch):
    for name, value in (("ROUTERS", 7), ("PAGE", 60), ("NODE", 8), ("BLOCK", 3)):
        monkeypatch.setattr(topk_mtree, name, value)
    rng = random.Random(1)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    data = [(i, [c + rng.gauss(0, 0.2) for c in rng.choice(centres)]) for i in range(900)]
    data += [(1000 + i, data[0][1]) for i in range(300)]  # a third of all are copies
    data += [(5000 + i, [float(rng.random() < 0.5), float(rng.random() < 0.5), 0.0, 0.0, 0.0, 0.0]) for i in range(40)]  # ties
    check(spark, data)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 2.0]), (100, [0.5, -3.0]), (200, None), (300, [nan, 1.0]), (400, [inf, 1.0]), (500, [None, 1.0]),
            (None, [1.0, 1.0]), (1, [0.0, 0.0]), (2, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [-0.1, 0.0009]), (-100, [1.0, 1.0])]
    check(spark, data)
    check(spark, [(0, [1.0])])  # nothing to find
    check(spark, [(1, [1.0]), (2, [1.0])])  # no query
    check(spark, [])


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got = sorted(tuple(r) for r in top_k(df).collect())
    assert got == plain([(r["vec_id"], r["embedding"]) for r in df.collect()])


def test_exact_beyond_doubles(spark):
    """Components near 2^20 and 2^26 after scaling: products beyond 2^53 differ in their last digits."""
    rng = random.Random(2)
    for size in (2.0 ** 10, 2.0 ** 16):
        base = [size - k / 1024 for k in range(16)]
        data = [(i, [b + rng.randrange(3) / 1024 for b in base]) for i in range(250)]
        df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
        got = sorted(tuple(r) for r in top_k(df, every=25).collect())
        whole = {i: [math.floor(1024 * x) for x in v] for i, v in data}
        want = []
        for q in range(0, 250, 25):
            best = sorted((-sum(x * y for x, y in zip(whole[q], v)), i) for i, v in whole.items() if i != q)[:10]
            want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
        assert got == want


def test_scores_beyond_a_long(spark):
    data = [(0, [1e14, 0.0]), (1, [1e14, 0.0]), (2, [-1e14, 0.0]), (3, [3e14, 0.0]), (4, [0.0, 1e300])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = [tuple(r)[1:] for r in top_k(df).orderBy("rank").collect()]
    assert got == [(1, 3, 2 ** 63 - 1), (2, 1, 2 ** 63 - 1), (3, 4, 0), (4, 2, -2 ** 63)]
    huge = [(i, [1e300] * 4) for i in range(3)]
    got = top_k(spark.createDataFrame(huge, "vec_id long, embedding array<double>")).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 2 ** 63 - 1), (0, 2, 2, 2 ** 63 - 1)]


def test_pages_out_of_reach_are_not_read(spark, monkeypatch):
    """Queries of one cluster: the pages under the routing objects of the others stay unread, results whole."""
    for name, value in (("ROUTERS", 40), ("PAGE", 50)):
        monkeypatch.setattr(topk_mtree, name, value)
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 1, (20, 6))
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    data = [(100 * i if i < 50 else 7 * 10 ** 6 + 100 * i + 1, (centres[i // 100] + rng.normal(0, 0.01, 6)).tolist())
            for i in range(2000)]
    table = spark.createDataFrame([(i, v) for i, v in data], "vec_id long, embedding array<float>")
    check(spark, data)
    vectors = topk_mtree.scaled_vectors(table, "vec_id", "embedding")
    index = topk_mtree.build_index(topk_mtree.distinct_points(vectors, 10), 10)
    queries = topk_mtree.with_router(vectors.where("vec_id % 100 = 0"), index.shared, index.most)
    _, unread = topk_mtree.search_block(index, queries.collect(), 10)
    assert unread > 20


def test_stored_bounds_save_computations():
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 3000, (20, 8))
    vecs = np.floor(np.concatenate([c + rng.normal(0, 30, (100, 8)) for c in centres]))
    most = float((vecs ** 2).sum(1).max())
    made = topk_mtree.build_page(vecs, vecs[0], most)
    order = made["order"]
    page = made | {"vecs": vecs[order], "router": vecs[0], "whole": vecs[order].astype(np.int64), "ids": order.tolist(), "at": np.arange(len(vecs) + 1)}
    queries = vecs[::100]
    s = topk_mtree.Searcher(np.arange(len(vecs))[::100], queries.astype(np.int64), np.full(20, -np.inf), most, 10)
    s.page(page)
    assert s.computed < 0.7 * len(queries) * len(vecs)
    for i, best in enumerate(s.best):
        scores = queries[i] @ vecs.T
        want = sorted((-x, j) for j, x in enumerate(scores) if j != 100 * i)[:10]
        assert best == want
