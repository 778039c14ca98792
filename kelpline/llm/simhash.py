"""Near-duplicate documents by SimHash fingerprints and multi-index hashing.

1. A document is all its runs of three words (A to Z as a to z), repeats included, each hashed to 64 bits. A bit of the fingerprint is set if
   it is in over half of the hashes. Documents of one fingerprint are one class from there on, so copies cost nothing.
2. Two fingerprints that differ in ``DISTANCE`` bits at most differ in one bit at most in one of their halves. So there is a table per half, in which every
   fingerprint stands under its own value and under the values that one more bit would give: of two values that differ in one bit, one has that
   bit unset. Whoever meets under a value is compared in all bits.
3. Fingerprints under one value are joined by a search: from one, all within the distance that were not reached before, from those the next. That gives
   the edges of a spanning forest, fewer than there are members, and never all pairs.
4. A value with more than ``DENSE`` fingerprints of its own is split before its members meet: the other half has to agree but for one bit in one of its
   quarters, so it is indexed by quarters in the same way. What meets then agrees in 48 bits but for two, which bounds it at every size
   of the table. So are the values next to it, to which its members look.
5. Components of the edges get the least document id.

Defined results: a null, empty or blank text has fingerprint zero and is linked like any other; with one or two words the whole
sequence is the only run; rows that share an id are one document and tie their fingerprints; a row without an id ties nothing
together but its fingerprint's class, and has no component if no row of its component has an id; an empty table gives no rows; other
columns are ignored whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelpline.llm.components import components
from kelpline.llm.tables import staged
from kelpline.llm.words import small_slices
from kelpline.operators.lookups import lookup_join
from kelpline.session import ship_package

SHINGLE_WORDS = 3
SEED = 42
DISTANCE = 3
#: Fingerprints of one value of a half that meet without being split.
DENSE = 1024
#: Members of a group that are compared pair by pair, for all groups at once.
FEW = 8
#: Bytes of text cut into words at once.
STRETCH = 1 << 20

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def _stretches(data: bytes) -> Iterator[bytes]:
    """Parts of a text that end at a blank."""
    begin = 0
    while begin < len(data):
        found = _BLANK.search(data, begin + STRETCH)
        end = found.end() if found else len(data)
        yield data[begin:end]
        begin = end


def shingle_digests(data: bytes, size: int = SHINGLE_WORDS) -> Iterator[bytes]:
    """XXH64 of all runs of ``size`` words, eight bytes each, a stretch of text at a time."""
    carried: list[bytes] = []
    count = 0
    for part in _stretches(data):
        words = carried + part.translate(_FOLD).split()
        count += len(words) - len(carried)
        if len(words) >= size:
            text = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            begins = np.concatenate([[0], ends[:-size] + 1])
            digest = xxhash.xxh64_digest
            yield b"".join([digest(text[a:b], SEED) for a, b in zip(begins.tolist(), ends[size - 1 :].tolist())])
        carried = words[-(size - 1) :] if size > 1 else []
    if 0 < count < size:
        yield xxhash.xxh64_digest(b" ".join(carried), SEED)


def fingerprint(data: bytes, size: int = SHINGLE_WORDS) -> int:
    """The SimHash of a text, unsigned."""
    total, counts = 0, np.zeros(64, np.int64)
    for digests in shingle_digests(data, size):
        bits = np.unpackbits(np.frombuffer(digests, np.uint8)).reshape(-1, 64)
        whole = len(bits) // 255 * 255
        # 255 bits fit in a byte
        counts += np.add.reduce(bits[:whole].reshape(-1, 255, 64), axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        counts += bits[whole:].sum(axis=0, dtype=np.int64)
        total += len(bits)
    return int.from_bytes(np.packbits(2 * counts > total).tobytes(), "big")


def _sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in small_slices(whole, "text"):
            texts = batch["text"].cast(pa.large_binary())
            prints = [fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in texts]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(np.array(prints, np.uint64).view(np.int64))], names=["doc_id", "code"])


# -- tables of halves and quarters -----------------------------------------------------------


def looked_up(codes: np.ndarray, parts: list[int], width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For parts of ``width`` bits, given by how far they are shifted: the part, places in ``codes``, and the values under which those stand."""
    mask = np.uint64((1 << width) - 1)
    every = np.arange(len(codes))
    for part, shift in enumerate(parts):
        values = (codes >> np.uint64(shift)) & mask
        yield part, every, values
        for bit in range(width):
            one = np.uint64(1 << bit)
            unset = np.flatnonzero(values & one == 0)
            yield part, unset, values[unset] | one


HALVES = [32, 0]


def _halves(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        codes = batch["code"].to_numpy().view(np.uint64)
        for part, places, values in looked_up(codes, HALVES, 32):
            keys = values.astype(np.int64) | (part << 32)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(codes[places].view(np.int64))], names=["key", "code"])


def _quarters(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of split values under the quarters of their other half."""
    for batch in batches:
        keys, codes = batch["key"].to_numpy(), batch["code"].to_numpy().view(np.uint64)
        first = keys >> 32 == 0
        other = np.where(first, codes & np.uint64(0xFFFFFFFF), codes >> np.uint64(32))
        for part, places, values in looked_up(other, [16, 0], 16):
            arrays = [pa.array(keys[places]), pa.array((values.astype(np.int32) | (part << 16)).astype(np.int32)), pa.array(codes[places].view(np.int64))]
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "quarter", "code"])


# -- meetings --------------------------------------------------------------------------------


def forest(codes: np.ndarray, distance: int) -> list[tuple[np.uint64, np.ndarray]]:
    """Edges of a spanning forest of the codes within ``distance`` bits of each other."""
    edges, left = [], codes
    while len(left) > 1:
        reached, left = [left[0]], left[1:]
        while reached and len(left):
            code = reached.pop()
            near = np.bitwise_count(left ^ code) <= distance
            if near.any():
                found = left[near]
                edges.append((code, found))
                reached.extend(found)
                left = left[~near]
    return edges


def _meeter(distance: int, key_columns: list[str]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def links(keys: list[np.ndarray], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Edges of groups that are complete and stand one after another."""
        new = np.r_[True, np.any([k[1:] != k[:-1] for k in keys], axis=0)]
        begins = np.flatnonzero(new)
        sizes = np.diff(np.append(begins, len(codes)))
        group = np.cumsum(new)
        left, right = [], []
        few = np.repeat(sizes <= FEW, sizes)
        for step in range(1, FEW):
            same = (group[step:] == group[:-step]) & few[step:]
            near = same & (np.bitwise_count(codes[step:] ^ codes[:-step]) <= distance)
            at = np.flatnonzero(near)
            left.append(codes[at])
            right.append(codes[at + step])
        for i in np.flatnonzero(sizes > FEW):
            for code, found in forest(np.unique(codes[begins[i] : begins[i] + sizes[i]]), distance):
                left.append(np.full(len(found), code))
                right.append(found)
        return np.concatenate(left), np.concatenate(right)

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] | None = None

        def found(columns: list[np.ndarray]) -> pa.RecordBatch:
            a, b = links(columns[:-1], columns[-1])
            apart = a != b
            return pa.RecordBatch.from_arrays([pa.array(c[apart].view(np.int64)) for c in (a, b)], names=["a", "b"])

        for batch in batches:
            columns = [batch[c].to_numpy() for c in key_columns] + [batch["code"].to_numpy().view(np.uint64)]
            if kept is not None:
                columns = [np.concatenate(pair) for pair in zip(kept, columns)]
            if not len(columns[-1]):
                continue
            # the last group may go on in the next batch
            last = np.logical_and.reduce([k == k[-1] for k in columns[:-1]])
            cut = len(last) - int(np.argmin(last[::-1])) if not last.all() else 0
            if cut:
                yield found([c[:cut] for c in columns])
            kept = [c[cut:] for c in columns]
        if kept is not None and len(kept[-1]):
            yield found(kept)

    return meet


def _met(rows: DataFrame, key_columns: list[str], distance: int) -> DataFrame:
    placed = rows.repartition(*key_columns).sortWithinPartitions(*key_columns)
    return placed.mapInArrow(_meeter(distance, key_columns), "a long, b long")


def linked_codes(codes: DataFrame, distance: int = DISTANCE, dense: int = DENSE) -> DataFrame:
    """Edges ``a, b`` that connect all of the distinct ``codes(code)`` that differ in ``distance`` bits at most, directly or by others that do."""
    if not 0 <= distance <= 3:
        raise ValueError("two halves serve distances of 0 to 3 bits")
    ship_package(codes.sparkSession)
    high, low = F.shiftrightunsigned("code", 32), F.col("code").bitwiseAND(F.lit(0xFFFFFFFF)).bitwiseOR(F.lit(1 << 32))
    own = codes.select(F.explode(F.array(high, low)).alias("key")).groupBy("key").agg(F.count("*").alias("n"))
    crowded = own.where(F.col("n") > dense).select("key")
    near = F.concat(F.array("key"), F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: F.col("key").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))))
    split = staged(crowded.select(F.explode(near).alias("key")).distinct())
    rows = codes.mapInArrow(_halves, "key long, code long")
    if split.isEmpty():
        return _met(rows, ["key"], distance)
    found = _met(lookup_join(rows, split, ["key"], "left_anti"), ["key"], distance)
    members = lookup_join(rows, split, ["key"], "left_semi").select("key", "code")
    return found.unionByName(_met(members.mapInArrow(_quarters, "key long, quarter int, code long"), ["key", "quarter"], distance))


def simhash_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", distance: int = DISTANCE, dense: int = DENSE
) -> DataFrame:
    """``doc_id, fingerprint, component_id``, a row per row of ``docs``."""
    ship_package(docs.sparkSession)
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    signed = staged(texts.mapInArrow(_sign, "doc_id long, code long"))
    classes = staged(signed.groupBy("code").agg(F.min("doc_id").alias("first")))
    edges = linked_codes(classes.select("code"), distance, dense)
    # a document that is named with several texts ties their fingerprints together
    named = signed.where("doc_id is not null").groupBy("doc_id").agg(F.min("code").alias("a"), F.max("code").alias("_b")).where("a <> _b")
    ties = signed.join(named, "doc_id").select("a", F.col("code").alias("b"))
    joined = components(edges.unionByName(ties))
    of_class = classes.join(joined.withColumnRenamed("node", "code"), "code", "left").withColumn("component", F.coalesce("component", "code"))
    of_class = staged(of_class)
    least = of_class.groupBy("component").agg(F.min("first").alias("component_id"))
    labels = of_class.join(least, "component").select("code", "component_id")
    return signed.join(labels, "code").select("doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id")
