import hashlib
import math

import duckdb
import numpy as np
import pytest

from loomstar.llm import centroids
from loomstar.llm.clustering_sql import clustering_sql
from tests.llm.cases import key


def brute(rows):
    kept = [
        (i, [math.floor(64 * float(x)) for x in v]) for i, v in rows
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]
    kept = [(i, v) for i, v in kept if max(map(abs, v)) < 1 << 27]
    name = lambda i: hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    centers = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:16]]
    apart = lambda v, c: sum((x - y) ** 2 for x, y in zip(v, c))
    nearest = lambda v: min((apart(v, c), k) for k, c in enumerate(centers))
    for _ in range(3):
        own = [nearest(v)[1] for _, v in kept]
        for k in range(len(centers)):
            mine = [v for (_, v), c in zip(kept, own) if c == k]
            if mine:
                centers[k] = [sum(x) // len(mine) for x in zip(*mine)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    whole = sum(d for _, _, d in found)
    return sorted(((i, c, d, sum(x for _, k, x in found if k == c), whole, digest[c]) for i, c, d in found), key=key)


def embeddings(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return df.selectExpr("*", "'x' as v", "0 as cluster", "0 as distance", "0 as n", "0 as total", "0 as label")


def vectors(n, seed=0, scale=1.0):
    return np.random.default_rng(seed).normal(size=(n, 64)).astype("f4") * scale


def got(spark, rows):
    return sorted((tuple(r) for r in centroids.clustering(embeddings(spark, rows)).collect()), key=key)


def test_awkward_rows_equal_brute_force(spark):
    x = vectors(120).tolist()
    rows = [(k, v) for k, v in enumerate(x)] + [(k, x[k]) for k in range(10)] + [(None, x[3]), (None, x[4])]
    rows += [(500, None), (501, []), (502, x[0][:63]), (503, x[0] + [1.0]), (504, [None] + x[0][1:])]
    rows += [(505, [math.nan] + x[0][1:]), (506, [math.inf] + x[0][1:]), (507, [3e38] + x[0][1:]), (508, [0.0] * 64)]
    rows += [(600 + k, [float(k % 2)] * 64) for k in range(40)]  # ties
    assert got(spark, rows) == brute(rows)


@pytest.mark.parametrize("n", [0, 1, 5])
def test_fewer_vectors_than_centroids(spark, n):
    rows = [(k, v) for k, v in enumerate(vectors(n).tolist())]
    assert got(spark, rows) == brute(rows)


def test_a_third_of_all_rows_is_one_vector(spark):
    one = vectors(1, 9).tolist()[0]
    rows = [(k, one) for k in range(60)] + [(100 + k, v) for k, v in enumerate(vectors(100, 3).tolist())]
    assert got(spark, rows) == brute(rows)


@pytest.mark.parametrize("spread", [0.0, 1.0, 20.0])
def test_search_is_exact_and_skips(spread):
    """Equal to all distances, ties to the smaller number; sums far apart leave few to work out."""
    pick = np.random.default_rng(4)
    centers = np.floor(pick.normal(size=(16, 64)) * 9 + spread * 10 * pick.normal(size=(16, 1))).astype(np.int64)
    centers[5] = centers[2]
    x = centers[pick.integers(0, 16, 3000)] + pick.integers(-3, 4, (3000, 64))
    search = centroids.Search(centers)
    best, distance = search(x)
    every = np.stack([((x - c) ** 2).sum(axis=1) for c in centers], 1)
    assert (best == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    if spread == 20.0:
        assert search.computed < 0.3 * every.size


def test_sql_says_the_same(spark):
    rows = [(k, v) for k, v in enumerate(vectors(200, 8).tolist())]
    table = embeddings(spark, rows).select("vec_id", "embedding").toArrow()
    con = duckdb.connect()
    con.register("embeddings", table)
    assert sorted(con.execute(clustering_sql()).fetchall(), key=key) == got(spark, rows)
