"""Nearest neighbours by multi-index hashing of learned binary codes.

1. A rotation is learned on a bounded sample (``SAMPLE`` distinct vectors, the least by a hash of their ids): principal axes, turned so that
   the signs of the turned vectors lose as little as possible (iterative quantization). The signs are a code
   of at most 64 bits. The sample also gives the radius: that within which the wanted share of its nearest neighbours lie.
2. Every vector is coded and indexed, in blocks of bounded size. A block holds a table per substring of the
   code: which vectors have which value there.
3. A code within radius r of a query is within r / m in one of m substrings at least (pigeonhole). So a query probes, in each table,
   all values at that distance; what it finds is checked on the whole code, and all codes within the radius are reranked by the inner product of the
   original vectors, in double precision.
4. Queries are the given rows; they meet all rows block by block, never as pairs of rows. The best of each block are merged.
5. A query that finds fewer neighbours than wanted inside the radius looks again without one.

Equal vectors are one query and ``k + 1`` candidates: no result can name more of them.

Defined results: vectors that are null, empty, all zero, of another length than most, or that hold null or non-finite components take no part, and neither do
rows without an id; of rows that repeat an id the least vector counts; equal scores are ordered by id; an empty table gives no rows; other columns
are ignored whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelpline.llm.tables import staged
from kelpline.session import ship_package

NEAREST = 20
SAMPLE = 4096
SAMPLE_QUERIES = 512
#: Share of the sample's nearest neighbours that the radius must hold.
WITHIN = 0.98
SUBSTRINGS = 4
INDEX_BLOCK = 8192
QUERY_BLOCK = 2048
QUERIES_AT_ONCE = 64
ROUNDS = 30


@dataclass(frozen=True)
class Coder:
    """What is learned: the mean, the rotation, and the radius."""

    mean: np.ndarray
    rotation: np.ndarray
    radius: int

    @property
    def bits(self) -> int:
        return self.rotation.shape[1]

    def code(self, vectors: np.ndarray) -> np.ndarray:
        """Codes of up to 64 bits, as numbers."""
        signs = (vectors - self.mean) @ self.rotation > 0
        return (signs.astype(np.uint64) << np.arange(self.bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def learn(sample: np.ndarray, n_rows: int, k: int, within: float = WITHIN) -> Coder:
    """Rotation and radius from a sample of a table of ``n_rows`` distinct vectors."""
    mean = sample.mean(axis=0)
    bits = min(64, sample.shape[1])
    centred = sample - mean
    _, axes = np.linalg.eigh(centred.T @ centred)
    axes = axes[:, ::-1][:, :bits]
    low = centred @ axes
    turn = np.linalg.qr(np.random.Generator(np.random.PCG64(9)).standard_normal((bits, bits)))[0]
    for _ in range(ROUNDS):
        left, _, right = np.linalg.svd(np.where(low @ turn > 0, 1.0, -1.0).T @ low)
        turn = right.T @ left.T
    coder = Coder(mean, axes @ turn, bits)
    # of the k nearest of all rows, the sample holds its share
    wanted = max(1, -(-k * len(sample) // max(n_rows, 1)))
    codes, queries = coder.code(sample), sample[:SAMPLE_QUERIES]
    near = []
    for i in range(len(queries)):
        scores = sample @ queries[i]
        scores[i] = -np.inf
        best = np.argsort(-scores, kind="stable")[: min(wanted, len(sample) - 1)]
        near.append(np.bitwise_count(codes[best] ^ codes[i]))
    distances = np.concatenate(near) if near else np.zeros(0)
    radius = int(np.ceil(np.quantile(distances, within))) if len(distances) else bits
    return Coder(mean, coder.rotation, radius)


class BlockIndex:
    """The tables of one block: per substring, the values that occur and the vectors that have each."""

    def __init__(self, codes: np.ndarray, bits: int, substrings: int = SUBSTRINGS):
        self.codes = codes
        cuts = np.linspace(0, bits, substrings + 1).astype(int)
        self.parts = [(np.uint64(a), np.uint64((1 << int(b - a)) - 1)) for a, b in zip(cuts[:-1], cuts[1:])]
        self.tables = [np.unique((codes >> shift) & mask, return_inverse=True) for shift, mask in self.parts]

    def within(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of query and vector whose codes differ in ``radius`` bits at most: every one of them."""
        reach = radius // len(self.parts)
        found = np.zeros((len(queries), len(self.codes)), bool)
        for (shift, mask), (values, owner) in zip(self.parts, self.tables):
            probes = np.bitwise_count(((queries[:, None] >> shift) & mask) ^ values[None, :]) <= reach
            found |= probes[:, owner]
        query, vector = np.nonzero(found)
        near = np.bitwise_count(queries[query] ^ self.codes[vector]) <= radius
        return query[near], vector[near]


def inner_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Row by row, component after component, so that equal vectors have equal products."""
    total = np.zeros(len(left))
    for i in range(left.shape[1]):
        total += left[:, i] * right[:, i]
    return total


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    values = column.combine_chunks()
    return values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(values), -1)


FOUND = "rep long, vec_id long, score double"
_FOUND = pa.schema([("rep", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _best(rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """The places of each row's k best: by score, then by id."""
    order = np.lexsort((ids, -scores, rows))
    rows = rows[order]
    begins = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]]) if len(rows) else rows
    place = np.arange(len(rows)) - np.repeat(begins, np.diff(np.append(begins, len(rows))))
    return order[place < k]


def _searcher(coder: Coder, radius: int, k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def search(queries: pa.Table, rows: pa.Table) -> pa.Table:
        if not queries.num_rows or not rows.num_rows:
            return _FOUND.empty_table()
        reps, wanted = queries["rep"].to_numpy(), _matrix(queries["vec"])
        ids, vectors = rows["vec_id"].to_numpy(), _matrix(rows["vec"])
        index, codes = BlockIndex(coder.code(vectors), coder.bits), coder.code(wanted)
        out = []
        for low in range(0, len(reps), QUERIES_AT_ONCE):
            query, vector = index.within(codes[low : low + QUERIES_AT_ONCE], radius)
            # a first look at the products drops what cannot be among the best; the rest is summed in a fixed order
            rough = np.einsum("ij,ij->i", wanted[query + low], vectors[vector])
            worst = np.full(min(QUERIES_AT_ONCE, len(reps) - low), -np.inf)
            kth = _best(query, ids[vector], rough, k)
            count = np.bincount(query[kth], minlength=len(worst))
            np.minimum.at(least := np.full(len(worst), np.inf), query[kth], rough[kth])
            worst[count >= k] = least[count >= k]
            close = rough >= worst[query] - 1e-9 * np.maximum(1, np.abs(worst[query], where=np.isfinite(worst[query]), out=np.ones(len(query))))
            query, vector = query[close], vector[close]
            scores = inner_products(wanted[query + low], vectors[vector])
            best = _best(query, ids[vector], scores, k)
            out.append(pa.Table.from_arrays([pa.array(reps[query[best] + low]), pa.array(ids[vector[best]]), pa.array(scores[best])], schema=_FOUND))
        return pa.concat_tables(out)

    return search


def _valid(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """Ids and vectors that take part, one row per id."""
    named = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vec")).where("vec_id is not null and size(vec) > 0")
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    valid = named.where(finite & F.exists("vec", lambda x: x != 0))
    return valid.groupBy("vec_id").agg(F.min("vec").alias("vec"))


def _meet(queries: DataFrame, index: DataFrame, n_queries: int, n_rows: int, coder: Coder, radius: int, k: int) -> DataFrame:
    """All blocks of queries with all blocks of rows."""
    query_blocks, row_blocks = max(1, -(-n_queries // QUERY_BLOCK)), max(1, -(-n_rows // INDEX_BLOCK))
    own = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.select("rep", "vec", own("rep", query_blocks).alias("qb"), every(row_blocks).alias("rb"))
    right = index.select("vec_id", "vec", own("vec_id", row_blocks).alias("rb"), every(query_blocks).alias("qb"))
    found = left.groupBy("qb", "rb").cogroup(right.groupBy("qb", "rb")).applyInArrow(_searcher(coder, radius, k), FOUND)
    return _top(found, "rep", k)


def _top(found: DataFrame, key: str, k: int) -> DataFrame:
    order = Window.partitionBy(key).orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(
    rows: DataFrame, is_query: Column, k: int = NEAREST, vec_id: str = "vec_id", vector: str = "embedding", radius: int | None = None
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row for which ``is_query`` (a condition on ``vec_id``) holds, the nearest others.

    ``radius`` overrides the learned one; the number of bits makes the search exact.
    """
    spark = rows.sparkSession
    ship_package(spark)
    none = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    valid = staged(_valid(rows, vec_id, vector))
    sizes = valid.groupBy(F.size("vec").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    if sizes is None:
        return none
    valid = valid.where(F.size("vec") == sizes.d)
    # of equal vectors only the k + 1 least ids can be named
    same = Window.partitionBy("vec").orderBy("vec_id")
    index = staged(valid.withColumn("_i", F.row_number().over(same)).where(F.col("_i") <= k + 1))
    distinct = index.where("_i = 1")
    n_distinct, n_rows = distinct.count(), index.count()
    picked = distinct.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vec").toArrow()
    coder = learn(_matrix(picked["vec"]), n_distinct, k)
    asked = valid.where(is_query)
    reps = staged(asked.groupBy("vec").agg(F.min("vec_id").alias("rep")))
    n_queries = reps.count()
    if not n_queries:
        return none
    first = coder.radius if radius is None else radius
    found = staged(_meet(reps, index, n_queries, n_rows, coder, first, k + 1))
    # whoever found fewer than there are looks everywhere
    most = min(k + 1, n_rows)
    full = found.groupBy("rep").agg(F.count("*").alias("n")).where(F.col("n") >= most).select("rep")
    few = staged(reps.join(full, "rep", "left_anti"))
    n_few = few.count()
    if n_few and first < coder.bits:
        again = staged(_meet(few, index, n_few, n_rows, coder, coder.bits, k + 1))
        found = found.join(few.select("rep"), "rep", "left_anti").unionByName(again)
    members = asked.select(F.col("vec_id").alias("query_id"), "vec").join(reps, "vec").select("query_id", "rep")
    others = members.join(found.drop("rank"), "rep").where("query_id <> vec_id")
    return _top(others, "query_id", k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
