"""Near-duplicate documents by one-permutation hashing, banded buckets and star-shaped edges.

1. A document is the set of its 5-word shingles (A to Z as a to z). One hash per shingle is enough: its high bits
   choose one of ``BINS`` bins and the least value in a bin is the bin's. Empty bins take the value of another by
   optimal densification: bin j tries the bins of a random sequence of its own until one is not empty, so
   two equal sets fill them alike and two documents agree in a bin with the probability of their similarity.
2. ``ROWS`` bins make a band, and documents that agree in a band share a bucket. Documents of equal
   sets (two 64-bit fingerprints and the size) are one class before that, so copies cost nothing.
3. Each bucket gives the edges of a star, one per member and not one per pair. Its centre is the member that meets most others in all
   its buckets, ties to the least id: an original meets its copies more often than they meet each other.
4. Edges whose signatures agree in too few bins cannot be similar and go. The others are confirmed on the full sets. Members that are not yet in
   the component of their centre form a new, smaller star, until a round confirms nothing new.
5. What is left are buckets with members in several components. Their members meet in tiles of bounded size, each in one task, which compares their
   signatures. Pairs of different components that agree in enough bins may be many and are hardly ever similar, so they are no rows: a tile tells
   a forest that ties them to groups, and the members of a group meet once more in tiles, now with their full sets. Such a tile confirms its pairs itself
   and tells a forest of confirmed edges between components. A group of more than ``MANY`` meets by its buckets instead.
   So in the end any two members of a bucket are in one component or were compared, and rows grow with members, not with pairs.
6. Components of confirmed edges get the least document id.

With 40 bands of 3 of 120 bins, a pair of similarity 0.75 shares no bucket with a chance of 1e-10. The signatures that are compared are others, of four
bits in each of ``COMPARED`` bins: such a pair agrees in 196 of 256 on average, with a deviation of 6.8 (up to 7.9 where sets are small and many
bins borrowed), and in fewer than the 148 asked for with a chance of 1e-9. Of sets of fewer than ``SMALL_SET`` shingles, of which single
shingles decide much, only 128 are asked for.

Defined results: a null, empty or blank text has no shingles and is linked with nothing; with one to four words the
whole sequence is the only shingle; rows that share an id are one document, of which each row
gets a result; a row without an id is linked with nothing and kept; an empty table gives no rows; other columns are ignored
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelpline.llm.components import components, joined_by
from kelpline.llm.marks import id_filter, passes
from kelpline.llm.tables import fitted, staged
from kelpline.llm.words import give_back, hashed_words, mix, shingles, small_slices
from kelpline.session import ship_package

SHINGLE_WORDS = 5
ROWS, BANDS = 3, 40
BINS = ROWS * BANDS
#: So many sets at most are one partition.
FEW_SETS = 10_000
#: Similarity in percent.
PERCENT = 75
EMPTY = np.uint64(2**64 - 1)
#: Bins of the signatures that are compared; how many have to agree in their four bits, also for sets that are small.
COMPARED = 256
AGREE, AGREE_SMALL, SMALL_SET = 148, 128, 40
#: 64-bit words of a signature of four bits per bin.
WORDS = -(-COMPARED // 16)
#: Members of a bucket or group in one share, and shingles of their sets where these go with them; a tile holds two shares.
SHARE, SHARE_ITEMS = 2048, 1 << 20
#: Members of a group that meet without regard to their buckets.
MANY = 1 << 15
#: Pairs whose signatures are looked at together.
PAIRS_AT_ONCE = 1 << 16


def text_sets(texts: pa.Array, size: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """The set of shingles of each text, in ascending order."""
    hashes, offsets = hashed_words(texts, fold=True)
    for begin, end in zip(offsets[:-1], offsets[1:]):
        yield np.unique(shingles(hashes[begin:end], size))


def bin_minima(sets: list[np.ndarray], bins: int = BINS) -> np.ndarray:
    """The least value of each bin, a row per set; ``EMPTY`` where a bin has none."""
    out = np.full((len(sets), bins), EMPTY, np.uint64)
    for row, values in enumerate(sets):
        # a set is in ascending order: those of a bin are neighbours, the least first
        own = ((values >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
        first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else own
        out[row, own[first].astype(np.int64)] = values[first]
    return out


def densified(minima: np.ndarray) -> np.ndarray:
    """Empty bins filled from bins of a random sequence that depends on the bin only."""
    out, bins = minima.copy(), minima.shape[1]
    open_rows, open_bins = np.nonzero(minima == EMPTY)
    some = (minima != EMPTY).any(axis=1)
    chosen = some[open_rows]
    open_rows, open_bins = open_rows[chosen], open_bins[chosen]
    attempt = 0
    while len(open_rows):
        attempt += 1
        donor = (mix(open_bins.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(attempt)) % np.uint64(bins)).astype(np.int64)
        value = minima[open_rows, donor]
        found = value != EMPTY
        # a borrowed value is another one than the donor's own
        out[open_rows[found], open_bins[found]] = mix(value[found] + np.uint64(attempt))
        open_rows, open_bins = open_rows[~found], open_bins[~found]
    return out


def band_keys(signatures: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One key per band; the band's number is part of it."""
    bands = signatures.shape[1] // rows
    keys = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(signatures), 1))
    for i in range(rows):
        keys = mix(keys * np.uint64(0xD6E8FEB86659FD93) + signatures[:, i::rows][:, :bands])
    return keys


def short_signatures(signatures: np.ndarray) -> np.ndarray:
    """Four bits of each bin, a row of ``WORDS`` words per set."""
    low = np.zeros((len(signatures), 16 * WORDS), np.uint8)
    low[:, : signatures.shape[1]] = signatures & np.uint64(15)
    return np.ascontiguousarray(low[:, ::2] | (low[:, 1::2] << np.uint8(4))).view(np.uint64)


def agreeing(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """In how many bins rows of short signatures agree."""
    odd = one ^ two
    odd = odd | (odd >> np.uint64(1))
    odd = (odd | (odd >> np.uint64(2))) & np.uint64(0x1111111111111111)
    return COMPARED - np.bitwise_count(odd).sum(axis=1, dtype=np.int64)


def agree_enough(one: np.ndarray, two: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Which rows may be similar, by their signatures; the bounds are those of ``PERCENT`` and hold above it, too."""
    if percent < PERCENT:
        return np.ones(len(one), bool)
    return agreeing(one, two) >= np.where(np.minimum(n, m) < SMALL_SET, AGREE_SMALL, AGREE)


def _packed(signatures: np.ndarray) -> pa.Array:
    width = 8 * WORDS
    ends = pa.py_buffer(np.arange(len(signatures) + 1, dtype=np.int32) * np.int32(width))
    return pa.Array.from_buffers(pa.binary(), len(signatures), [None, ends, pa.py_buffer(np.ascontiguousarray(signatures))])


def _unpacked(column: pa.Array) -> np.ndarray:
    _, ends, data = column.buffers()
    if data is None or not len(column):
        return np.zeros((0, WORDS), np.uint64)
    begin = int(np.frombuffer(ends, np.int32)[column.offset])
    return np.frombuffer(data, np.uint8)[begin : begin + 8 * WORDS * len(column)].copy().view(np.uint64).reshape(-1, WORDS)


def _fingerprint(values: np.ndarray) -> tuple[int, int]:
    one = mix(values ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    two = mix(values ^ np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64)
    return int(one.view(np.int64)), int(two.view(np.int64))


SIGNED = "doc_id long, n_shingles long, f1 long, f2 long, keys array<long>, bins binary"


def _sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in small_slices(whole, "text"):
            sets = list(text_sets(batch["text"]))
            signatures = densified(bin_minima(sets))
            keys = band_keys(signatures).view(np.int64)
            prints = [_fingerprint(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([p[0] for p in prints], pa.int64()),
                    pa.array([p[1] for p in prints], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * keys.shape[1], pa.int32()), pa.array(keys.reshape(-1))),
                    _packed(short_signatures(densified(bin_minima(sets, COMPARED)))),
                ],
                names=["doc_id", "n_shingles", "f1", "f2", "keys", "bins"],
            )


def _chosen_sets(marks: np.ndarray):
    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            ids = whole["doc_id"].fill_null(0).to_numpy()
            picked = whole.filter(pa.array(passes(marks, ids) & whole["doc_id"].is_valid().to_numpy(zero_copy_only=False)))
            for batch in small_slices(picked, "text"):
                sets = list(text_sets(batch["text"]))
                values = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
                ends = np.cumsum([0] + [len(s) for s in sets])
                prints = [_fingerprint(s)[0] for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"], pa.array(prints, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))],
                    names=["doc_id", "f1", "items"],
                )

    return read


def _documents(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def _sets(texts: DataFrame, classes: DataFrame, ids: DataFrame) -> DataFrame:
    """``doc_id, f1, items``: the full sets of the classes of ``ids``. Only their texts are read into sets."""
    marks = id_filter(ids, "doc_id")
    shipped = texts.sparkSession.sparkContext.broadcast(marks)
    read = lambda batches: _chosen_sets(shipped.value)(batches)
    sets = texts.mapInArrow(read, "doc_id long, f1 long, items array<long>")
    # rows that share an id may have several sets: the class's own is the one with its fingerprint
    own = classes.select("doc_id", "f1").join(ids, "doc_id", "left_semi")
    return fitted(sets.join(own, ["doc_id", "f1"], "left_semi").dropDuplicates(["doc_id", "f1"]), FEW_SETS)


def _confirmed(texts: DataFrame, classes: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs of class representatives whose full sets are similar."""
    sets = _sets(texts, classes, pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct())
    of = lambda c: sets.select(F.col("doc_id").alias(c), F.col("f1").alias(f"f_{c}"), F.col("items").alias(f"s_{c}"))
    both = pairs.join(of("a"), ["a", "f_a"]).join(of("b"), ["b", "f_b"])
    shared = F.size(F.array_intersect("s_a", "s_b"))
    union = F.size("s_a") + F.size("s_b") - shared
    return both.where(F.lit(100) * shared >= F.lit(percent) * union).select("a", "b")


def _star(members: DataFrame, percent: int) -> DataFrame:
    """``key, doc_id, f1, n, degree`` to distinct edges from each bucket's centre to its members of a possible size."""
    centre = F.max(F.struct("degree", (-F.col("doc_id")).alias("order"), "doc_id", "f1", "n")).alias("c")
    centres = members.groupBy("key").agg(centre, F.count("*").alias("_n")).where("_n > 1")
    joined = members.join(centres, "key").where(F.col("doc_id") != F.col("c.doc_id"))
    small, large = F.least("n", F.col("c.n")), F.greatest("n", F.col("c.n"))
    possible = joined.where(F.lit(100) * small >= F.lit(percent) * large)
    return possible.select(F.col("c.doc_id").alias("a"), F.col("c.f1").alias("f_a"), F.col("doc_id").alias("b"), F.col("f1").alias("f_b")).distinct()


def _labelled(members: DataFrame, joined: DataFrame) -> DataFrame:
    found = members.join(joined.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    return found.withColumn("component", F.coalesce("component", "doc_id"))


EDGE = "a long, f_a long, b long, f_b long"
_EDGE_NAMES = ["a", "f_a", "b", "f_b"]


def _likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose signatures agree in enough bins."""

    def chosen(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = batch["n_a"].to_numpy(), batch["n_b"].to_numpy()
            enough = agree_enough(_unpacked(batch["bins_a"]), _unpacked(batch["bins_b"]), n, m, percent)
            yield batch.select(_EDGE_NAMES).filter(pa.array(enough))

    of = lambda c: classes.select(
        F.col("doc_id").alias(c), F.col("f1").alias(f"f_{c}"), F.col("n_shingles").alias(f"n_{c}"), F.col("bins").alias(f"bins_{c}")
    )
    return pairs.join(of("a"), ["a", "f_a"]).join(of("b"), ["b", "f_b"]).mapInArrow(chosen, EDGE)


def _next_rows(group: np.ndarray, n: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of a group whose sizes allow the similarity; rows are sorted by group and size."""
    longest = int(n.max()) + 1
    reach = np.minimum(n * 100 // percent, longest - 1)
    end = np.searchsorted(group * longest + n, group * longest + reach, "right")
    partners = end - np.arange(len(n)) - 1
    # a row's partners may be more than what is looked at together
    ends = np.cumsum(partners)
    for low in range(0, int(ends[-1]), PAIRS_AT_ONCE):
        number = np.arange(low, min(low + PAIRS_AT_ONCE, int(ends[-1])))
        x = np.searchsorted(ends, number, "right")
        yield x, x + 1 + number - (ends[x] - partners[x])


_TILE = ["key", "i", "j"]


TIES = "a long, b long"


def _ties(x: np.ndarray, y: np.ndarray, labels: np.ndarray, similar=None) -> list[tuple[int, int]]:
    """Of the pairs of rows, one for each two labels that they tie; ``x`` is in order. Labels that are tied become one."""
    found = []
    begins = np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) if len(x) else x
    for begin, end in zip(begins, np.append(begins[1:], len(x))):
        one, others = x[begin], y[begin:end]
        others = others[labels[others] != labels[one]]
        if similar is not None and len(others):
            others = others[similar(one, others)]
        if len(others):
            tied, first = np.unique(labels[others], return_index=True)
            found += [(one, other) for other in others[first]]
            labels[np.isin(labels, tied)] = labels[one]
    return found


def _similar_to(items: pa.ListArray, order: np.ndarray, percent: int):
    """Whether rows, by their number in ``order``, hold sets similar to that of one row."""
    values, ids = np.unique(items.flatten().to_numpy(), return_inverse=True)
    ends = items.offsets.to_numpy().astype(np.int64)
    begin, size = (ends[:-1] - ends[0])[order], np.diff(ends)[order]
    mark = np.zeros(len(values), bool)

    def similar(one: int, others: np.ndarray) -> np.ndarray:
        own, sizes = ids[begin[one] : begin[one] + size[one]], size[others]
        first = np.cumsum(sizes) - sizes
        mark[own] = True
        held = mark[ids[np.arange(sizes.sum()) + np.repeat(begin[others] - first, sizes)]]
        mark[own] = False
        shared = np.add.reduceat(held, first, dtype=np.int64)
        return 100 * shared >= percent * (size[one] + sizes - shared)

    return similar


def _tile_ties(percent: int):
    """A forest of the pairs of members of a tile in different components that may be similar or, where the sets ``items`` are at hand, are.
    Tiles stand one after another, and are of bounded size."""

    def ties(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        keys = [rows[c].to_numpy() for c in _TILE]
        group = np.cumsum(np.r_[False, np.any([k[1:] != k[:-1] for k in keys], axis=0)])
        n = rows["n"].to_numpy()
        order = np.lexsort((n, group))
        group, n = group[order], n[order]
        doc, component, share, i, j = (rows[c].to_numpy()[order] for c in ("doc_id", "component", "share", "i", "j"))
        bins = _unpacked(rows["bins"].combine_chunks())[order]
        # what is tied: components by similar members, or documents by members that may be similar
        confirm = "items" in rows.column_names
        similar = _similar_to(rows["items"].combine_chunks(), order, percent) if confirm else None
        labels = component.copy() if confirm else doc.copy()
        for x, y in _next_rows(group, n, percent):
            apart = (component[x] != component[y]) & (labels[x] != labels[y]) & ((i[x] == j[x]) | (share[x] != share[y]))
            x, y = x[apart], y[apart]
            near = agree_enough(bins[x], bins[y], n[x], n[y], percent)
            found = _ties(x[near], y[near], labels, similar)
            if found:
                one, two = np.array(found, np.int64).T
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(doc[one], doc[two])), pa.array(np.maximum(doc[one], doc[two]))], names=["a", "b"])

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            kept = table if kept is None else pa.concat_tables([kept, table])
            if not len(kept):
                continue
            # the last tile may go on in the next batch
            last = np.logical_and.reduce([kept[c].to_numpy() == kept[c][-1].as_py() for c in _TILE])
            if last.all():
                continue
            cut = len(last) - int(np.argmin(last[::-1]))
            yield from ties(kept.slice(0, cut))
            kept = kept.slice(cut)
        if kept is not None and len(kept):
            yield from ties(kept)
        kept = None
        give_back()

    return meet


def _met(members: DataFrame, shares: Column, percent: int) -> DataFrame:
    """What the tiles of ``members`` by their ``key`` tell, with so many ``shares`` of a key."""
    sized = members.groupBy("key").agg(shares.cast("int").alias("_n"))
    dealt = members.join(sized, "key").withColumn("share", F.pmod(F.xxhash64("doc_id", "f1"), F.col("_n")).cast("int"))
    tiles = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("_o"))
    tiles = tiles.withColumns({"i": F.least("share", "_o"), "j": F.greatest("share", "_o")}).drop("_n", "_o")
    placed = tiles.repartition(*_TILE).sortWithinPartitions(*_TILE)
    return fitted(placed.mapInArrow(_tile_ties(percent), TIES).distinct())


def _across(
    texts: DataFrame, members: DataFrame, joined: DataFrame, classes: DataFrame, percent: int, share: int = SHARE, many: int = MANY
) -> DataFrame:
    """Confirmed edges ``a, b`` that tie the components of members of a bucket wherever two of them are similar."""
    labelled = _labelled(members, joined)
    several = labelled.groupBy("key").agg(F.min("component").alias("_x"), F.max("component").alias("_y")).where("_x < _y").select("key")
    left = staged(labelled.join(several, "key").select("key", "doc_id", "f1", "n", "component"))
    bins = classes.select("doc_id", "f1", "bins")
    by_count = F.ceil(F.count("*") / share)
    forest = _met(left.join(bins, ["doc_id", "f1"]), by_count, percent)
    if forest.isEmpty():
        return forest
    groups = components(forest)
    sized = groups.join(groups.groupBy("component").agg(F.count("*").alias("_size")), "component")
    near = left.join(sized.select(F.col("node").alias("doc_id"), F.col("component").alias("_group"), "_size"), "doc_id")
    block = F.when(F.col("_size") <= many, F.col("_group")).otherwise(F.col("key"))
    near = near.select(block.alias("key"), "doc_id", "f1", "n", "component").distinct()
    sets = _sets(texts, classes, groups.select(F.col("node").alias("doc_id")))
    whole = near.join(bins, ["doc_id", "f1"]).join(sets, ["doc_id", "f1"])
    return _met(whole, F.greatest(by_count, F.ceil(F.sum("n") / SHARE_ITEMS)), percent)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, share: int = SHARE, many: int = MANY) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``, a row per row of ``docs``."""
    spark = docs.sparkSession
    ship_package(spark)
    texts = _documents(docs, doc_id, text)
    signed = staged(texts.mapInArrow(_sign, SIGNED))
    named = signed.where("n_shingles > 0 and doc_id is not null")
    key = ["f1", "f2", "n_shingles"]
    classes = named.groupBy(*key).agg(F.min("doc_id").alias("doc_id"), F.min_by(F.struct("keys", "bins"), "doc_id").alias("_s"))
    classes = classes.select(*key, "doc_id", "_s.*")
    classes = staged(classes)
    buckets = classes.select("doc_id", "f1", F.col("n_shingles").alias("n"), F.explode("keys").alias("key"))
    # only buckets with company go on; a member's degree is how often it meets another
    shared = buckets.groupBy("key").agg(F.count("*").alias("_size")).where("_size > 1")
    met = staged(buckets.join(shared, "key"))
    degrees = met.groupBy("doc_id", "f1").agg(F.sum(F.col("_size") - 1).alias("degree"))
    members = staged(met.drop("_size").join(degrees, ["doc_id", "f1"]))
    tried = fitted(_likely(_star(members, percent), classes, percent))
    links = fitted(_confirmed(texts, classes, tried, percent))
    # rows that share an id are one document
    joined, everyone = components(links), members
    while True:
        labelled = _labelled(members, joined)
        top = F.max(F.struct("degree", (-F.col("doc_id")).alias("order"), "component")).alias("c")
        centred = labelled.groupBy("key").agg(top).select("key", F.col("c.component").alias("_taken"))
        members = fitted(labelled.join(centred, "key").where("component <> _taken").drop("component", "_taken"))
        fresh = fitted(_likely(_star(members, percent).join(tried, _EDGE_NAMES, "left_anti"), classes, percent))
        if fresh.isEmpty():
            break
        tried = tried.unionByName(fresh)
        more = fitted(_confirmed(texts, classes, fresh, percent))
        if more.isEmpty():
            break
        joined = joined_by(joined, more)
    ties = _across(texts, everyone, joined, classes, percent, share, many)
    if not ties.isEmpty():
        joined = joined_by(joined, ties)
    # a class of several documents is linked to its representative, and so are documents of several classes
    sets = named.select(*key, "doc_id").distinct().join(classes.select(*key, F.col("doc_id").alias("first")), key)
    return _result(signed, sets, joined, key)


def _result(signed: DataFrame, sets: DataFrame, joined: DataFrame, key: list[str]) -> DataFrame:
    twice = sets.groupBy("doc_id").agg(F.count("*").alias("_n"), F.min("first").alias("first"), F.max("first").alias("last")).where("_n > 1")
    bridges = twice.where("first <> last").select(F.col("first").alias("a"), F.col("last").alias("b"))
    if not bridges.isEmpty():
        # a document that is named with several sets ties their classes together
        ties = sets.join(twice.select("doc_id", F.col("first").alias("_low")), "doc_id")
        joined = joined_by(joined, ties.select(F.col("_low").alias("a"), F.col("first").alias("b")))
    label = sets.join(joined.withColumnRenamed("node", "first"), "first", "left")
    label = label.select(*key, "doc_id", F.coalesce("component", "first").alias("component_id"))
    found = signed.select("doc_id", *key).join(label, [*key, "doc_id"], "left")
    return found.select(
        "doc_id",
        "n_shingles",
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"),
    )
