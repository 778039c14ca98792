"""Mixing sources to target weights: a splitting tree over exact block quotas.

1. Every source gets a target in words: its share by weight of all words, at most ``max_repeats`` times
   what it has; what is cut off is shared among the others by weight until none is above.
2. Documents are hashed to blocks of their source. A source whose target is q times its size and a rest takes every
   block q times, and in one more pass its blocks in a permuted order until the rest is reached. The block
   in which it is reached gives its documents in hashed order; the last of them gives its first words only.
   Targets are therefore met exactly, to the word, but for the fraction.
3. The block draws of all sources are split among the output shards by a binary tree: at each node the draws of the left half
   are a multivariate hypergeometric sample of the node's, so that shards have equal numbers of draws
   and the mix of each is that of a random permutation of all, without making one. Sources are taken in bundles of ``BUNDLE``: the draws of a node
   are split among bundles, and those of a bundle among its sources, which is the same distribution. Every bundle walks the tree by itself
   with generators seeded by the nodes, so nothing but the sources of a bundle, and one number per bundle, is in one place.
4. A shard takes the next draws of a source's permuted order, as many as its quota says: shards are disjoint and
   together hold every draw. Documents are shuffled inside a shard by a hash.

The number of blocks of a source is bounded (``MAX_BLOCKS``), so prefix sums over blocks are small whatever the
number of documents. Any number of sources is mixed: their order comes from a range shuffle, the level of targets from sums over all, and tables
of sources are broadcast only as far as their measured size allows.

Defined results: a null text has no words and is never taken; a null source is one more source, the last; repeated rows are
documents of their own; equal hashes are ordered by the row itself; an empty table, or one without words, gives
targets of 0 and takes nothing; columns other than the named ones are carried or ignored as the function says. The same
rows and seed give the same mix, whatever the partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelpline.llm.tables import BLANKS, WORD, staged
from kelpline.operators.lookups import fits_broadcast, lookup_join
from kelpline.session import ship_package

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
SHARDS = 64
BLOCK_WORDS = 65_536
MAX_BLOCKS = 16_384
#: Sources whose draws are split in one task.
BUNDLE = 10_000
SEED = 20
#: Low bits of Spark's row numbers: the place in a partition.
_IN_PARTITION = (1 << 33) - 1


def text_size(text: str = "text") -> Column:
    """Words of a text: runs of other characters than blanks, tabs and line ends."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _placed(rows: DataFrame, column: str) -> DataFrame:
    """``rows`` with ``place``, from 0 in the order of ``column``, null last. ``column`` has no value twice."""
    order = F.col(column).asc_nulls_last()
    numbered = staged(rows.repartitionByRange(order).sortWithinPartitions(order).withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", 33).alias("_part")
    # as many rows as partitions
    sizes = sorted((r["_part"], r["n"]) for r in numbered.groupBy(part).agg(F.count("*").alias("n")).collect())
    begins, before = [], 0
    for number, n in sizes:
        begins.append((number, before))
        before += n
    parts = numbered.sparkSession.createDataFrame(begins, "_part long, _begin long")
    joined = numbered.withColumn("_part", part).join(F.broadcast(parts), "_part")
    return joined.withColumn("place", F.col("_begin") + F.col("_id").bitwiseAND(_IN_PARTITION)).drop("_part", "_begin", "_id")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``sizes(source, size)`` to ``source, place, source_size, weight, target``: weights by order of code points, null last."""
    per_source = staged(sizes.groupBy("source").agg(F.sum("size").alias("source_size")))
    listed = F.array(*[F.lit(float(w)) for w in weights])
    weighed = staged(_placed(per_source, "source").withColumn("weight", F.get(listed, F.pmod("place", F.lit(len(weights))).cast("int"))))
    most = F.col("source_size").cast("double") * max_repeats
    return weighed.withColumn("target", F.least(most, F.col("weight") * F.lit(_level(weighed, max_repeats))))


def _level(weighed: DataFrame, max_repeats: int) -> float:
    """Words per unit of weight, so that all targets, none above its bound, add up to all words.

    The sum of targets is a concave function of the level, made of straight pieces: Newton's steps rise to the exact level and end
    when no more sources are at their bound. A step is a sum over all sources.
    """
    total = weighed.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("n")).first().n
    level, bounded = 0.0, -1
    while True:
        full = F.lit(max_repeats) * F.col("source_size") <= F.col("weight") * F.lit(level)
        found = weighed.agg(
            F.sum(F.when(full, F.col("source_size"))).alias("full"), F.sum(F.when(~full, F.col("weight"))).alias("weight"), F.count(F.when(full, 1)).alias("n")
        ).first()
        if found.weight is None or found.n == bounded:
            return level
        bounded, level = found.n, (total - max_repeats * (found.full or 0)) / found.weight


def _hashed(*columns: Column | str, seed: int, salt: str) -> Column:
    return F.xxhash64(F.lit(f"{salt}-{seed}"), *columns)


def _split(counts: np.ndarray, capacity: int, seed: Sequence[int]) -> np.ndarray:
    """How many draws of each go left, if ``capacity`` of all do."""
    return np.random.Generator(np.random.PCG64(list(seed))).multivariate_hypergeometric(counts, capacity, method="marginals")


def bundle_quotas(own: Sequence[int], bundle: int, bundles: Sequence[int], shards: int, seed: int) -> np.ndarray:
    """Draws for each shard (rows) of each source (columns) of one bundle, by the tree over shards."""
    out = np.zeros((shards, len(own)), np.int64)
    nodes = [(1, 0, shards, np.asarray(bundles, np.int64), np.asarray(own, np.int64))]
    while nodes:
        node, low, high, all_of_them, mine = nodes.pop()
        if high - low == 1:
            out[low] = mine
            continue
        middle = (low + high) // 2
        left = _split(all_of_them, int(all_of_them.sum()) * (middle - low) // (high - low), (seed, node))
        of_mine = _split(mine, int(left[bundle]), (seed, node, bundle + 1))
        nodes.append((2 * node, low, middle, left, of_mine))
        nodes.append((2 * node + 1, middle, high, all_of_them - left, mine - of_mine))
    return out


def _quotas(sources: DataFrame, shards: int, seed: int) -> DataFrame:
    """``source, draws_before``: per source, the draws that the shards before each shard take."""
    bundled = sources.withColumn("_bundle", F.floor(F.col("place") / BUNDLE))
    # one number for each bundle of sources
    totals = {r["_bundle"]: r["n"] for r in bundled.groupBy("_bundle").agg(F.sum("draws").alias("n")).collect()}
    bundles = [totals.get(i, 0) for i in range(max(totals, default=-1) + 1)]

    def walk(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("place")
        quotas = bundle_quotas(frame["draws"].tolist(), int(frame["_bundle"].iloc[0]), bundles, shards, seed)
        before = np.cumsum(quotas, axis=0) - quotas
        return pd.DataFrame({"place": frame["place"].to_numpy(), "draws_before": list(before.T)})

    walked = bundled.select("_bundle", "place", "draws").groupBy("_bundle").applyInPandas(walk, "place long, draws_before array<long>")
    return sources.select("source", "place").join(walked, "place").drop("place")


def _sizes(docs: DataFrame, text: str, row: str, seed: int) -> DataFrame:
    key = _hashed("doc_id", text, seed=seed, salt="row")
    return staged(docs.select("doc_id", "source", text_size(text).alias("size"), key.alias("_key"), F.col(row).alias("_row")))


def plan_mix(
    docs: DataFrame,
    text: str = "text",
    weights: Sequence[float] = WEIGHTS,
    shards: int = SHARDS,
    max_repeats: int = MAX_REPEATS,
    seed: int = SEED,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per document of ``docs(doc_id, source, text)``, without the text.

    ``doc_id, source, size, source_size, target, taken`` and ``draws``: an array of ``shard, words`` with an
    element for every time the mix takes the document.
    """
    # equal rows have equal keys; a number that is frozen with the table tells them apart
    numbered = docs.select("doc_id", "source", text).withColumn("_row", F.monotonically_increasing_id())
    return _plan(_sizes(numbered, text, "_row", seed), weights, shards, max_repeats, seed, block_words).drop("_row", "_key")


def _plan(sizes: DataFrame, weights: Sequence[float], shards: int, max_repeats: int, seed: int, block_words: int) -> DataFrame:
    ship_package(sizes.sparkSession)
    targets = source_targets(sizes, weights, max_repeats)
    size, whole = F.col("source_size"), F.floor(F.col("target"))
    sources = targets.select(
        "source", "place", "source_size", "target",
        F.least(F.lit(MAX_BLOCKS), F.greatest(F.lit(1), F.ceil(size / F.lit(block_words)))).cast("long").alias("n_blocks"),
        F.when(size > 0, F.floor(whole / size)).otherwise(0).alias("passes"),
        F.when(size > 0, whole % size).otherwise(0).cast("long").alias("rest"),
    )
    # a source is a key that may be null: a struct of it meets its like
    sources = staged(sources.withColumn("_source", F.struct("source")))
    small = fits_broadcast(sources)
    docs = lookup_join(sizes.withColumn("_source", F.struct("source")), sources.drop("source", "place"), ["_source"], "inner", small)
    docs = docs.withColumn("_block", F.pmod("_key", "n_blocks"))
    blocks = docs.groupBy("_source", "_block").agg(F.sum("size").alias("words"))
    # the order of blocks in the last pass; at most MAX_BLOCKS rows of a source
    order = Window.partitionBy("_source").orderBy(_hashed("_source", "_block", seed=seed, salt="rest"), "_block")
    blocks = blocks.withColumns({"_rank": F.row_number().over(order) - 1, "_before": F.sum("words").over(order) - F.col("words")})
    blocks = lookup_join(blocks, sources.select("_source", "rest", "passes", "n_blocks"), ["_source"], "inner", small)
    left = F.greatest(F.lit(0).cast("long"), F.least(F.col("words"), F.col("rest") - F.col("_before")))
    blocks = blocks.withColumn("_left", left)
    # in a whole pass the order is that of another hash
    ranks = {
        f"_rank{p}": F.row_number().over(
            Window.partitionBy("_source").orderBy(_hashed("_source", "_block", seed=seed, salt=f"pass-{p}"), "_block")
        )
        - 1
        for p in range(max_repeats)
    }
    blocks = staged(blocks.withColumns(ranks))
    last = blocks.groupBy("_source").agg(F.sum(F.when(F.col("_left") > 0, 1).otherwise(0)).alias("_partial"))
    drawn = sources.join(last, "_source", "left").select(
        "source", "place", "_source", (F.col("passes") * F.col("n_blocks") + F.coalesce("_partial", F.lit(0))).cast("long").alias("draws")
    )
    drawn = staged(drawn)
    quotas = staged(_quotas(drawn, shards, seed).withColumn("_source", F.struct("source")).drop("source"))
    shard = lambda j: F.size(F.filter("draws_before", lambda b: b <= j)) - 1
    full = [
        F.when(F.col("passes") > p, F.struct(shard(F.col("n_blocks") * p + F.col(f"_rank{p}")).alias("shard"), F.lit(p).alias("pass")))
        for p in range(max_repeats)
    ]
    placed = lookup_join(blocks, quotas, ["_source"], "inner").select(
        "_source", "_block", "_left", (F.col("_left") < F.col("words")).alias("_cut"),
        F.filter(F.array(*full), lambda x: x.isNotNull()).alias("_full"),
        shard(F.col("n_blocks") * F.col("passes") + F.col("_rank")).alias("_shard"),
    )
    placed = staged(placed)
    docs = staged(docs.drop("source").join(placed, ["_source", "_block"]))
    # only blocks in which the rest of a source ends are ordered, one of each source
    cut = docs.where("_cut and _left > 0")
    inside = Window.partitionBy("_source", "_block").orderBy("_key", "_row").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("size").over(inside), F.lit(0))
    cut = cut.withColumn("_words", F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("_left") - before)))
    other = docs.where("not (_cut and _left > 0)").withColumn("_words", F.when(F.col("_left") > 0, F.col("size")).otherwise(0).cast("long"))
    found = other.unionByName(cut)
    every = F.transform("_full", lambda x: F.struct(x["shard"].cast("int").alias("shard"), F.col("size").alias("words")))
    once = F.when(F.col("_words") > 0, F.array(F.struct(F.col("_shard").cast("int").alias("shard"), F.col("_words").alias("words"))))
    draws = F.concat(F.when(F.col("size") > 0, every).otherwise(F.slice(every, 1, 0)), F.coalesce(once, F.slice(every, 1, 0)))
    taken = F.aggregate("draws", F.lit(0).cast("long"), lambda a, x: a + x["words"])
    return (
        found.withColumn("draws", draws)
        .select(
            "doc_id", F.col("_source.source").alias("source"), "size", F.col("source_size").cast("long").alias("source_size"),
            "target", taken.alias("taken"), "draws", "_row", "_key",
        )
    )


def mix(
    docs: DataFrame,
    text: str = "text",
    weights: Sequence[float] = WEIGHTS,
    shards: int = SHARDS,
    max_repeats: int = MAX_REPEATS,
    seed: int = SEED,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The mixed documents: ``docs``' columns, ``shard`` and ``place``, a row for every time a document is taken.

    A shard in the order of ``place`` is the shuffled output. A document taken in part has its first words, joined by
    blanks. Documents without words, of which there is nothing to take, are left out. Columns of ``docs`` of the
    names ``shard`` and ``place`` are replaced.
    """
    carried = [c for c in docs.columns if c.lower() not in ("shard", "place")]
    rows = staged(docs.select(F.struct(*carried).alias("_doc"), F.monotonically_increasing_id().alias("_row")))
    named = rows.select(F.col("_doc")["doc_id"].alias("doc_id"), F.col("_doc")["source"].alias("source"), F.col("_doc")[text].alias("text"), "_row")
    plan = _plan(_sizes(named, "text", "_row", seed), weights, shards, max_repeats, seed, block_words)
    drawn = plan.where(F.size("draws") > 0).select("_row", "_key", F.col("size").alias("_size"), F.posexplode("draws").alias("_turn", "_draw"))
    joined = rows.join(drawn, "_row")
    whole = F.col("_doc")[text]
    first = F.concat_ws(" ", F.slice(F.array_remove(F.split(whole, BLANKS + "+", -1), ""), 1, F.col("_draw.words").cast("int")))
    body = F.when(F.col("_draw.words") < F.col("_size"), first).otherwise(whole)
    place = _hashed("_draw.shard", "_key", "_turn", seed=seed, salt="place")
    columns = [(body if c == text else F.col("_doc")[c]).alias(c) for c in carried]
    return joined.select(*columns, F.col("_draw.shard").alias("shard"), place.alias("place"))
