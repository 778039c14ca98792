"""Nearest neighbours."""

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from kelpline.llm import hamming_search


def exact(ids, vectors, queries, k=20):
    """The result of a plain search: the products are summed component after component."""
    out = {}
    for q in queries:
        at = ids.index(q)
        scores = hamming_search.inner_products(np.broadcast_to(vectors[at], vectors.shape), vectors)
        order = sorted((i for i in range(len(ids)) if ids[i] != q), key=lambda i: (-scores[i], ids[i]))[:k]
        out[q] = [(ids[i], scores[i]) for i in order]
    return out


def found_by(df):
    out = collections.defaultdict(list)
    for r in df.orderBy("query_id", "rank").collect():
        assert r["rank"] == len(out[r.query_id]) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return dict(out)


def test_given_vectors(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    data = rows.collect()
    ids, vectors = [r.vec_id for r in data], np.array([r.embedding for r in data], np.float64)
    queries = [i for i in ids if i % 20 == 0]
    expected = exact(ids, vectors, queries)
    found = found_by(hamming_search.nearest(rows, F.col("vec_id") % 20 == 0))
    hits = sum(len({v for v, _ in found[q]} & {v for v, _ in expected[q]}) for q in queries)
    assert hits >= 0.9 * sum(map(len, expected.values()))
    assert all(dict(expected_all)[v] == s for q in queries for expected_all in [exact(ids, vectors, [q], len(ids))[q]] for v, s in found[q])
    # without a radius the search is exact
    assert found_by(hamming_search.nearest(rows, F.col("vec_id") % 20 == 0, radius=64)) == expected


def test_odd_vectors(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((30, 8)).astype(np.float32)
    rows = [(i, base[i].tolist()) for i in range(30)]
    rows += [(100 + i, base[0].tolist()) for i in range(60)]
    rows += [(0, base[0].tolist()), (200, None), (220, []), (240, [0.0] * 8), (260, [float("nan")] + [1.0] * 7)]
    rows += [(280, [float("inf")] * 8), (300, [None] + [1.0] * 7), (320, [1.0] * 3), (None, base[1].tolist())]
    df = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "vec_id long, embedding array<float>, rep string, score double")
    found = found_by(hamming_search.nearest(df, F.col("vec_id") % 20 == 0))
    valid = {i: v for i, v in rows if i is not None and v is not None and len(v) == 8 and None not in v and np.isfinite(v).all() and any(v)}
    ids = list(valid)
    expected = exact(ids, np.array([valid[i] for i in ids], np.float64), [i for i in ids if i % 20 == 0])
    assert set(found) == set(expected) == {0, 20, 100, 120, 140}
    assert found[100] == expected[100] and found[0] == expected[0]
    hits = sum(len({v for v, _ in found[q]} & {v for v, _ in expected[q]}) for q in expected)
    assert hits >= 0.9 * 20 * len(expected) and all(len(found[q]) == 20 for q in found)
    assert hamming_search.nearest(df.where("false"), F.col("vec_id") % 20 == 0).count() == 0
    assert hamming_search.nearest(df, F.col("vec_id") == 7777).count() == 0


@pytest.mark.parametrize("radius", [0, 5, 11, 24, 64])
def test_probing_finds_every_code_within_the_radius(radius):
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 2**64, 500, np.uint64)
    queries = codes[:40] ^ (np.uint64(1) << rng.integers(0, 64, 40).astype(np.uint64))
    expected = {(q, v) for q in range(40) for v in range(500) if int(queries[q] ^ codes[v]).bit_count() <= radius}
    query, vector = hamming_search.BlockIndex(codes, 64).within(queries, radius)
    assert set(zip(query.tolist(), vector.tolist())) == expected


def test_few_vectors(spark):
    rows = [(i, [float(i + 1), 1.0]) for i in range(5)]
    found = found_by(hamming_search.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.lit(True)))
    assert {q: [v for v, _ in x] for q, x in found.items()} == {q: [v for v in (4, 3, 2, 1, 0) if v != q] for q in range(5)}
