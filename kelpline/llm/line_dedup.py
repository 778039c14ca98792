"""Line dedup by an exact set-similarity join.

A line is the set of its words (A to Z as a to z). A line is removed if an earlier line of any document, kept
or not, has a Jaccard similarity of ``PERCENT`` or more with it; the order is that of document ids, then of lines.

1. Lines of equal sets are a class (two fingerprints and the size); all but its first line are removed.
2. Tokens are counted over all lines in a table of fixed size, by a hash. The order of tokens is this count,
   then the hash: any one order is correct, and this one puts rare tokens first. A token whose place counts 1 is in one line only.
3. The prefix of a line is its first n - ceil(t n) + 1 tokens. Similar lines share a prefix token; tokens that
   are in one line only are left out.
4. Lines that share a prefix token may be similar if their sizes, the places of the token, and the parities of
   their tokens over 128 places (512 for long lines), which bound the symmetric difference, allow it.
5. The task of a token ties lines that may be similar, and tells a forest of such ties, not the pairs. The lines of a token of more than ``DENSE``,
   which may be any share of all, are cut into shares of bounded size, and two shares meet in a tile of one task.
   What is tied over all tokens is a group: two similar lines are always in one.
6. The lines of a group meet in such tiles, with all their tokens, which are read from the texts again for these lines only. A tile verifies
   its pairs itself and only tells, per line, how many similar lines come earlier and which is the first, so its output grows with its lines and not with
   their pairs.

Defined results: a line without a word is no line: it is neither counted nor removed; a null text has no
lines; rows that repeat both id and text are one document, and each gets its result; documents without an id come last,
in the order of their texts' hashes; an empty table gives no rows; other columns are ignored whatever their names.
Tokens are compared by 48 bits of a hash, in slices of a few megabytes of text, whatever the length of a text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelpline.llm.components import components
from kelpline.llm.marks import id_filter, passes
from kelpline.llm.tables import fitted, shuffles_removed, staged
from kelpline.llm.words import give_back, mix, small_slices, split_words, text_bytes
from kelpline.session import ship_package

PERCENT = 75
#: Places of the count table: 4 MB in every task, whatever the number of tokens.
PLACES = 1 << 22
TOKEN_BITS = 48
_TOKEN = np.uint64((1 << TOKEN_BITS) - 1)
_LOW = np.uint64((1 << 40) - 1)
LINES_AT_ONCE = 1 << 16
#: The low bits of a fingerprint are the size of the set, as far as it goes; longer lines are all of this size to the filters of pairs,
#: which then only let more pairs pass.
SIZE_BITS = 24
#: The rank of a count (see ``count_table``) from which a token is dense: 16,384 lines.
DENSE = 112
#: Lines, and tokens of lines, in one share of a dense token or a group.
SHARE, SHARE_TOKENS = 4096, 1 << 20
#: Pairs of lines that are looked at together (their numbers take 16 bits), and tokens of pairs that are verified together.
PAIRS_AT_ONCE, PAIR_TOKENS = 1 << 16, 1 << 19
#: Words of the parities of lines of ``LONG`` tokens or more in the index; tiles make as many of all lines.
WIDE, LONG = 8, 128
#: The low bits of a token in the index are its place in the line; greater places are all this one to the filters of pairs.
PLACE_BITS = 15
#: Places of the count table in one row, and rows of it at once.
CHUNK, CHUNKS_AT_ONCE = 4096, 64
LAST = (1 << 63) - 1
#: So many lists of tokens at most are one partition.
FEW_LISTS = 20_000


class Lines:
    """The lines of some texts that have a word, and their distinct tokens.

    ``text`` and ``number`` say where a line stands; ``begin`` and ``size`` where its tokens are in ``tokens``,
    which are in ascending order in each line.
    """

    def __init__(self, texts: pa.Array):
        data, offsets = text_bytes(texts)
        hashes, firsts, _ = split_words(data, offsets[:-1], fold=True)
        # a line begins with its text, or after a line feed; where its words begin follows from few places
        feeds = np.flatnonzero(data == 10)
        cuts = np.concatenate([offsets[:-1], feeds + 1])
        text = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, feeds, "right") - 1])
        number = np.concatenate([np.zeros(len(offsets) - 1, np.int64), np.arange(1, len(feeds) + 1)])
        number[len(offsets) - 1 :] -= np.searchsorted(feeds, offsets[:-1])[text[len(offsets) - 1 :]]
        order = np.lexsort((number, text))
        first = np.searchsorted(firsts, cuts[order])
        held = np.diff(np.append(first, len(firsts))) > 0
        first, self.text, self.number = first[held], text[order][held], number[order][held]
        line = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(firsts))))
        # the order of tokens in a line is that of their numbers: sorted with the line as the high bits
        parts, sizes = [], []
        for low in range(0, len(first), LINES_AT_ONCE):
            high = min(low + LINES_AT_ONCE, len(first))
            words = slice(first[low], first[high] if high < len(first) else len(firsts))
            keys = ((line[words] - low).astype(np.uint64) << np.uint64(TOKEN_BITS)) | (hashes[words] >> np.uint64(16))
            keys.sort()
            keys = keys[np.r_[True, keys[1:] != keys[:-1]]]
            parts.append(keys & _TOKEN)
            sizes.append(np.bincount((keys >> np.uint64(TOKEN_BITS)).astype(np.int64), minlength=high - low))
        self.tokens = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        self.size = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        self.begin = np.cumsum(self.size) - self.size

    def fingerprints(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A hash of the set with its size in the low bits, and the parities of its tokens over 2 x 64 places."""
        if not len(self.size):
            return (np.zeros(0, np.int64),) * 3
        mixed = mix(self.tokens + np.uint64(0x9E3779B97F4A7C15))
        total = np.add.reduceat(mixed, self.begin)
        bit = np.uint64(1) << (mixed & np.uint64(63))
        side = (mixed >> np.uint64(63)).astype(bool)
        one = np.bitwise_xor.reduceat(np.where(side, bit, np.uint64(0)), self.begin)
        two = np.bitwise_xor.reduceat(np.where(side, np.uint64(0), bit), self.begin)
        size = np.minimum(self.size, (1 << SIZE_BITS) - 1).astype(np.uint64)
        f = (mix(total ^ self.size.astype(np.uint64)) >> np.uint64(SIZE_BITS) << np.uint64(SIZE_BITS)) | size
        return f.view(np.int64), one.view(np.int64), two.view(np.int64)

    def prefixes(self, chosen: np.ndarray, ranks: np.ndarray, percent: int) -> tuple[np.ndarray, ...]:
        """Line, token in the order of rarity, its place, and its rank, of the prefixes of some lines."""
        parts = []
        for low in range(0, len(chosen), LINES_AT_ONCE):
            lines = chosen[low : low + LINES_AT_ONCE]
            size = self.size[lines]
            ends = np.cumsum(size)
            take = np.arange(ends[-1]) + np.repeat(self.begin[lines] - (ends - size), size)
            tokens = self.tokens[take]
            keys = (ranks[(tokens & np.uint64(PLACES - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(40)) | (tokens & _LOW)
            keys |= np.repeat(np.arange(len(lines), dtype=np.uint64), size) << np.uint64(TOKEN_BITS)
            keys.sort()
            place = np.arange(len(keys)) - np.repeat(ends - size, size)
            use = place < np.repeat(prefix_sizes(size, percent), size)
            keys, place = keys[use], place[use]
            parts.append((lines[(keys >> np.uint64(TOKEN_BITS)).astype(np.int64)], keys & _TOKEN, place, (keys & _TOKEN) >> np.uint64(40)))
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        return tuple(np.concatenate(c) for c in zip(*parts))


def _documents(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Order and key of a document, and its text. Rows of equal id and text have the same key."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    number = F.col(doc_id).cast("long")
    return docs.select(F.coalesce(number, F.lit(LAST)).alias("at"), F.xxhash64(number, body).alias("key"), body.alias("text"))


LINE_COLUMNS = "at long, key long, line int"
LISTED = f"kind string, {LINE_COLUMNS}, n int, f long, sig long, counts binary"


def _list_lines(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every line with its fingerprints, and at the end the task's counts of tokens."""
    counts = np.zeros(PLACES, np.uint32)
    for whole in batches:
        for batch in small_slices(whole, "text"):
            lines = Lines(batch["text"])
            if not len(lines.size):
                continue
            places, times = np.unique((lines.tokens & np.uint64(PLACES - 1)).astype(np.int32), return_counts=True)
            counts[places] += times.astype(np.uint32)
            f, sig, _ = lines.fingerprints()
            yield _rows("line", batch, lines, np.arange(len(lines.size)), f, sig)
    used = np.flatnonzero(counts.reshape(-1, CHUNK).any(axis=1))
    for low in range(0, len(used), CHUNKS_AT_ONCE):
        some = used[low : low + CHUNKS_AT_ONCE]
        nulls = {c: pa.nulls(len(some), t) for c, t in (("key", pa.int64()), ("line", pa.int32()), ("n", pa.int32()), ("f", pa.int64()), ("sig", pa.int64()))}
        packed = pa.array([packed_counts(counts[c * CHUNK : (c + 1) * CHUNK]) for c in some], pa.binary())
        yield pa.RecordBatch.from_pydict({"kind": pa.array(["count"] * len(some), pa.string()), "at": pa.array(some, pa.int64()), **nulls, "counts": packed})


def packed_counts(counts: np.ndarray) -> bytes:
    """Places that count, and their counts: as long as there are such places."""
    places = np.flatnonzero(counts)
    return places.astype(np.uint16).tobytes() + counts[places].tobytes()


def unpacked_counts(data) -> tuple[np.ndarray, np.ndarray]:
    n = len(data) // 6
    return np.frombuffer(data, np.uint16, n), np.frombuffer(data, np.uint32, n, 2 * n)


def _rows(kind: str, batch: pa.RecordBatch, lines: Lines, chosen: np.ndarray, f: np.ndarray, sig: np.ndarray) -> pa.RecordBatch:
    text = lines.text[chosen]
    columns = {
        "kind": pa.array([kind] * len(chosen), pa.string()),
        "at": pa.array(batch["at"].to_numpy()[text]),
        "key": pa.array(batch["key"].to_numpy()[text]),
        "line": pa.array(lines.number[chosen].astype(np.int32)),
        "n": pa.array(lines.size[chosen].astype(np.int32)),
        "f": pa.array(f[chosen]),
        "sig": pa.array(sig[chosen]),
        "counts": pa.nulls(len(chosen), pa.binary()),
    }
    return pa.RecordBatch.from_pydict(columns)


def _add_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of each chunk over all tasks, as ranks of one byte; a partition holds a share of the table, however many tasks."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, counts in zip(batch["at"].to_pylist(), batch["counts"]):
            places, times = unpacked_counts(counts.as_buffer())
            if chunk not in sums:
                sums[chunk] = np.zeros(CHUNK, np.int64)
            sums[chunk][places] += times
    ranks = [np.minimum(255, np.floor(np.log2(np.maximum(own, 1)) * 8)).astype(np.uint8).tobytes() for own in sums.values()]
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array(ranks, pa.binary())], names=["at", "ranks"])


def count_table(counted: DataFrame) -> np.ndarray:
    """The sum of all tasks' counts as ranks of one byte: 0 for places that count 1, then by the logarithm."""
    summed = counted.select("at", "counts").repartition(int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions")), "at")
    ranks = np.zeros(PLACES, np.uint8)
    # a table of fixed size, whatever the data
    with shuffles_removed(counted.sparkSession):
        rows = summed.mapInArrow(_add_counts, "at long, ranks binary").toArrow()
    for chunk, some in zip(rows["at"].to_pylist(), rows["ranks"].to_pylist()):
        ranks[chunk * CHUNK : (chunk + 1) * CHUNK] = np.frombuffer(some, np.uint8)
    return ranks


def prefix_sizes(n: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """How many of the first tokens must hold one that a similar line's prefix holds, too."""
    return n - -(-n * percent // 100) + 1


INDEX = "t long, sig long, sig2 long, f long, wide binary"


def _parities(tokens: np.ndarray, begin: np.ndarray, words: int) -> np.ndarray:
    """The parities of the tokens of each line over ``words`` x 64 places, a row per line."""
    mixed = mix(tokens + np.uint64(0xC2B2AE3D27D4EB4F))
    bit, word = np.uint64(1) << (mixed & np.uint64(63)), (mixed >> np.uint64(32)) % np.uint64(words)
    return np.stack([np.bitwise_xor.reduceat(np.where(word == w, bit, np.uint64(0)), begin) for w in range(words)], axis=1)


def _packed_wide(lines: Lines, own: np.ndarray) -> pa.Array:
    """For rows of the lines ``own`` the parities over many places; nothing if the line is short."""
    long = np.flatnonzero(lines.size >= LONG)
    wide, number = np.zeros((0, WIDE), np.uint64), np.full(len(lines.size), -1)
    if len(long):
        size = lines.size[long]
        begin = np.cumsum(size) - size
        take = np.arange(size.sum()) + np.repeat(lines.begin[long] - begin, size)
        wide, number[long] = _parities(lines.tokens[take], begin, WIDE), np.arange(len(long))
    of = number[own]
    ends = np.cumsum(np.where(of >= 0, 8 * WIDE, 0))
    return pa.Array.from_buffers(pa.binary(), len(own), [None, pa.py_buffer(np.r_[0, ends].astype(np.int32)), pa.py_buffer(wide[of[of >= 0]].tobytes())])


def _unpacked_wide(packed: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All parities over many places, and for each row which of them are its own, -1 for none."""
    packed = packed.cast(pa.large_binary())
    _, offsets, data = packed.buffers()
    ends = np.frombuffer(offsets, np.int64)[packed.offset : packed.offset + len(packed) + 1]
    wide = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].view(np.uint64).reshape(-1, WIDE) if ends[-1] > ends[0] else np.zeros((0, WIDE), np.uint64)
    held = ends[1:] > ends[:-1]
    return wide, np.where(held, np.cumsum(held) - 1, -1)


def _prefixes(ranks: np.ndarray, percent: int, limit: int = DENSE):
    """Prefix tokens of each class of a slice, with their places in the low bits of ``t``, the parities, those of long lines also over more places, and the class's
    fingerprint. ``t`` of a dense token is ``-t - 1``."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in small_slices(whole, "text"):
                lines = Lines(batch["text"])
                f, sig, sig2 = lines.fingerprints()
                # one line of each class of this slice stands for it
                _, first = np.unique(f, return_index=True)
                chosen = np.zeros(len(f), bool)
                chosen[first] = True
                # in a shorter line only equal sets are similar
                chosen &= lines.size * 100 >= percent * (lines.size + 1)
                own, token, place, rank = lines.prefixes(np.flatnonzero(chosen), ranks, percent)
                use = rank > 0
                own, token, place, rank = own[use], token[use].view(np.int64), place[use], rank[use]
                packed = (token << PLACE_BITS) | np.minimum(place, (1 << PLACE_BITS) - 1)
                columns = [np.where(rank >= limit, -packed - 1, packed), sig[own], sig2[own], f[own]]
                yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in columns), _packed_wide(lines, own)], names=["t", "sig", "sig2", "f", "wide"])

    return read


def _token_lists(marks: np.ndarray, documents: np.ndarray):
    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            picked = whole.filter(pa.array(passes(documents, whole["key"].to_numpy())))
            for batch in small_slices(picked, "text"):
                lines = Lines(batch["text"])
                f, sig, _ = lines.fingerprints()
                _, first = np.unique(f, return_index=True)
                chosen = first[passes(marks, f[first] >> SIZE_BITS)]
                if not len(chosen):
                    continue
                size = lines.size[chosen]
                ends = np.cumsum(size)
                take = np.arange(ends[-1]) + np.repeat(lines.begin[chosen] - (ends - size), size)
                items = pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(lines.tokens[take].view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(f[chosen]), pa.array(sig[chosen]), items], names=["f", "sig", "items"])

    return read


#: Ties of nodes ``a`` and ``b``; and, with their (negative) token and place, rows of dense tokens.
TIES = "a long, b long, t long, place int, f long, sig long, sig2 long, wide binary"
_LONG_COLUMNS = ("f", "sig", "sig2")
_TIES_ARROW = pa.schema(
    [("a", pa.int64()), ("b", pa.int64()), ("t", pa.int64()), ("place", pa.int32()), *((c, pa.int64()) for c in _LONG_COLUMNS), ("wide", pa.binary())]
)
#: The node of a class is its fingerprint without the sign.
NODE = (1 << 63) - 1


def _candidates(t: np.ndarray, place: np.ndarray, sigs: tuple[np.ndarray, ...], size: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of a token that sizes, places and parities allow. Rows are sorted by token and size, so that a row's partners
    are the next ones, as far as the size and what is left after the place allow."""
    # where a row's partners end: the next token, or a size too large
    group = np.cumsum(np.r_[False, t[1:] != t[:-1]])
    longest = size.max() + 1
    reach = np.minimum(np.minimum(size * 100 // percent, (size - place) * (100 + percent) // percent - size), longest - 1)
    reach[size == (1 << SIZE_BITS) - 1] = longest - 1
    end = np.searchsorted(group * longest + size, group * longest + np.maximum(reach, 0), "right")
    partners = np.maximum(end - np.arange(len(t)) - 1, 0)
    ends = np.cumsum(partners)
    left = size - place
    for low in range(0, int(ends[-1]), PAIRS_AT_ONCE):
        number = np.arange(low, min(low + PAIRS_AT_ONCE, int(ends[-1])))
        x = np.searchsorted(ends, number, "right")
        y = x + 1 + number - (ends[x] - partners[x])
        both = size[x] + size[y]
        need = -(-percent * both // (100 + percent))
        most = both - 2 * need
        endless = size[y] == (1 << SIZE_BITS) - 1
        possible = np.flatnonzero((left[y] >= need) & (left[x] >= need) | endless)
        odd = np.zeros(len(possible), np.int64)
        for s in sigs:
            # of a signed number the bits of its magnitude would be counted
            odd += np.bitwise_count((s[x[possible]] ^ s[y[possible]]).view(np.uint64))
            fits = (odd <= most[possible]) | endless[possible]
            possible, odd = possible[fits], odd[fits]
        yield x[possible], y[possible]


class Forest:
    """Which numbers up to ``n`` are tied; the root of a tree is its least number."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, x: np.ndarray) -> np.ndarray:
        found = self.parent[x]
        while True:
            above = self.parent[found]
            if np.array_equal(above, found):
                break
            found = above
        self.parent[x] = found
        return found

    def tie(self, x: np.ndarray, y: np.ndarray) -> None:
        while len(x):
            a, b = self.roots(x), self.roots(y)
            apart = a != b
            x, y, a, b = x[apart], y[apart], a[apart], b[apart]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))


def _told_ties(columns: dict) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([pa.array(columns[c.name], c.type) if c.name in columns else pa.nulls(n, c.type) for c in _TIES_ARROW], schema=_TIES_ARROW)


def _row_ties(token: np.ndarray, place: np.ndarray, f: np.ndarray, sigs: tuple[np.ndarray, ...], packed: pa.Array, percent: int, across=None) -> tuple[np.ndarray, np.ndarray]:
    """A forest ``a, b`` of the nodes of rows that may be similar, and meet ``across`` shares where that is asked for. Rows are sorted as for ``_candidates``."""
    size = f & ((1 << SIZE_BITS) - 1)
    wide, number = _unpacked_wide(packed)
    rows = Forest(len(token))
    for x, y in _candidates(token, place, sigs, size, percent):
        if across is not None:
            meets = across(x, y)
            x, y = x[meets], y[meets]
        both = (number[x] >= 0) & (number[y] >= 0)
        a, b = x[both], y[both]
        odd = np.bitwise_count(wide[number[a]] ^ wide[number[b]]).sum(axis=1, dtype=np.int64)
        total = size[a] + size[b]
        both[both] = (odd > total - 2 * -(-percent * total // (100 + percent))) & (size[b] < (1 << SIZE_BITS) - 1)
        rows.tie(x[~both], y[~both])
    root = rows.roots(np.arange(len(token)))
    low = np.flatnonzero(root != np.arange(len(token)))
    # the rows of a class are one node, and its trees for several tokens are one
    node = f & NODE
    nodes, number = np.unique(np.concatenate([node[low], node[root[low]]]), return_inverse=True)
    whole = Forest(len(nodes))
    whole.tie(number[: len(low)], number[len(low) :])
    root = whole.roots(np.arange(len(nodes)))
    tied = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[root[tied]], nodes[tied]


def _sparse_ties(percent: int):
    """A forest of the lines of a partition that may be similar. A token has few rows, whatever the number of lines."""

    def tie(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, wide = [], []
        for batch in batches:
            parts.append([batch[c].to_numpy() for c in ("t", *_LONG_COLUMNS)])
            wide.append(batch["wide"])
        if not parts:
            return
        t, f, sig, sig2 = (np.concatenate(c) for c in zip(*parts))
        wide = pa.concat_arrays([c.cast(pa.large_binary()) for c in wide])
        parts = None
        dense = t < 0
        if dense.any():
            packed = -t[dense] - 1
            place = (packed & ((1 << PLACE_BITS) - 1)).astype(np.int32)
            columns = {"t": -(packed >> PLACE_BITS) - 1, "place": place, "f": f[dense], "sig": sig[dense], "sig2": sig2[dense]}
            yield _told_ties(columns | {"wide": wide.filter(pa.array(dense)).cast(pa.binary())})
        sparse = np.flatnonzero(~dense)
        if not len(sparse):
            return
        size, token = f[sparse] & ((1 << SIZE_BITS) - 1), t[sparse] >> PLACE_BITS
        order = sparse[np.argsort((token << PLACE_BITS) | size) if size.max() < 1 << PLACE_BITS else np.lexsort((size, token))]
        t, f, sig, sig2, wide = t[order], f[order], sig[order], sig2[order], wide.take(pa.array(order))
        a, b = _row_ties(t >> PLACE_BITS, t & ((1 << PLACE_BITS) - 1), f, (sig, sig2), wide, percent)
        yield _told_ties({"a": a, "b": b})
        t = f = sig = sig2 = wide = size = token = order = sparse = None
        give_back()

    return tie


# -- tiles -----------------------------------------------------------------------------------

TOLD = "f long, sig long, earlier struct<at:long,key:long,line:int>, links long"
_PLACE_ARROW = pa.struct([("at", pa.int64()), ("key", pa.int64()), ("line", pa.int32())])
_TOLD_ARROW = pa.schema([("f", pa.int64()), ("sig", pa.int64()), ("earlier", _PLACE_ARROW), ("links", pa.int64())])
_TILE = ["t", "i", "j"]


def _groups(rows: pa.Table) -> np.ndarray:
    """The number of the tile of each row; tiles stand one after another."""
    return np.cumsum(np.r_[False, np.any([c[1:] != c[:-1] for c in (rows[n].to_numpy() for n in _TILE)], axis=0)])


def _tile_ties(rows: pa.Table, percent: int) -> pa.RecordBatch:
    """A forest of the lines of some tiles of dense tokens that may be similar."""
    f, group = rows["f"].to_numpy(), _groups(rows)
    order = np.lexsort((f & ((1 << SIZE_BITS) - 1), group))
    f, sig, sig2, place, share, one, two = (rows[c].to_numpy()[order] for c in ("f", "sig", "sig2", "place", "share", "i", "j"))
    across = lambda x, y: (one[x] == two[x]) | (share[x] != share[y])
    wide = rows["wide"].combine_chunks().take(pa.array(order))
    a, b = _row_ties(group[order], place.astype(np.int64), f, (sig, sig2), wide, percent, across)
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _similar(x: np.ndarray, y: np.ndarray, tokens: np.ndarray, begin: np.ndarray, size: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of lines are similar on all their tokens."""
    n, m = size[x], size[y]
    of = np.stack([x, y], axis=1).reshape(-1)
    sizes = size[of]
    take = np.arange(sizes.sum()) + np.repeat(begin[of] - (np.cumsum(sizes) - sizes), sizes)
    # tokens of a pair next to each other: the number of the pair is the high bits
    found = tokens[take] | np.repeat(np.arange(len(x), dtype=np.uint64) << np.uint64(TOKEN_BITS), n + m)
    found.sort()
    pair = (found[1:][found[1:] == found[:-1]] >> np.uint64(TOKEN_BITS)).astype(np.int64)
    shared = np.bincount(pair, minlength=len(x))
    return 100 * shared >= percent * (n + m - shared)


def _tile_matches(rows: pa.Table, percent: int) -> pa.RecordBatch:
    """The lines of some tiles of groups to what each line has earlier in its tile: how many similar lines, and the first of them."""
    group = _groups(rows)
    where = rows["first"].combine_chunks()
    items = rows["items"].combine_chunks()
    tokens = items.flatten().to_numpy().astype(np.uint64)
    size = np.diff(items.offsets.to_numpy()).astype(np.int64)
    begin = np.cumsum(size) - size
    wide = _parities(tokens, begin, WIDE)
    order = np.lexsort((size, group))
    group, size, begin, wide = group[order], size[order], begin[order], wide[order]
    f, sig, share, one, two = (rows[c].to_numpy()[order] for c in ("f", "sig", "share", "i", "j"))
    at, key, line = (where.field(c).to_numpy()[order] for c in ("at", "key", "line"))
    # the parities over fewer places follow from those over more
    sigs = tuple(np.bitwise_xor.reduce(wide[:, w::2], axis=1) for w in range(2))
    counted = np.minimum(size, (1 << SIZE_BITS) - 1)
    rank = np.empty(len(f), np.int64)
    rank[np.lexsort((line, key, at))] = np.arange(len(f))
    links, earlier = np.zeros(len(f), np.int64), np.full(len(f), len(f))
    for x, y in _candidates(group, np.zeros(len(f), np.int64), sigs, counted, percent):
        across = (one[x] == two[x]) | (share[x] != share[y])
        x, y = x[across], y[across]
        both = size[x] + size[y]
        odd = np.bitwise_count(wide[x] ^ wide[y]).sum(axis=1, dtype=np.int64)
        fits = odd <= both - 2 * -(-percent * both // (100 + percent))
        x, y, total = x[fits], y[fits], np.cumsum(both[fits])
        low = 0
        while low < len(x):
            high = max(low + 1, int(np.searchsorted(total, (total[low - 1] if low else 0) + PAIR_TOKENS, "right")))
            a, b = x[low:high], y[low:high]
            near = _similar(a, b, tokens, begin, size, percent)
            a, b = a[near], b[near]
            late, soon = np.where(rank[a] > rank[b], a, b), np.minimum(rank[a], rank[b])
            links += np.bincount(late, minlength=len(f))
            np.minimum.at(earlier, late, soon)
            low = high
    told = np.flatnonzero(links)
    by_rank = np.empty(len(f), np.int64)
    by_rank[rank] = np.arange(len(f))
    first = by_rank[earlier[told]]
    places = pa.StructArray.from_arrays([pa.array(c[first], kind) for c, kind in ((at, pa.int64()), (key, pa.int64()), (line, pa.int32()))], fields=list(_PLACE_ARROW))
    return pa.RecordBatch.from_arrays([pa.array(f[told]), pa.array(sig[told]), places, pa.array(links[told])], schema=_TOLD_ARROW)


def _meeting(meet: Callable[[pa.Table], pa.RecordBatch]):
    """Tiles stand one after another, and are of bounded size; those that end in a batch meet together."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
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
            yield meet(kept.slice(0, cut))
            kept = kept.slice(cut)
        if kept is not None and len(kept):
            yield meet(kept)
        kept = None
        give_back()

    return read


def _tiles(members: DataFrame, shares: Column) -> DataFrame:
    """The lines of a token or a group ``t``, cut into ``shares``, once for each two shares ``i, j`` that meet."""
    sized = members.groupBy("t").agg(shares.cast("int").alias("_n"), F.count("*").alias("_lines")).where("_lines > 1").drop("_lines")
    dealt = members.join(sized, "t").withColumn("share", F.pmod(F.xxhash64("f", "sig"), F.col("_n")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("_o")
    tiles = dealt.select("*", other).withColumns({"i": F.least("share", "_o"), "j": F.greatest("share", "_o")}).drop("_n", "_o")
    return tiles.repartition(*_TILE).sortWithinPartitions(*_TILE)


def _lists(texts: DataFrame, lines: DataFrame) -> DataFrame:
    """All tokens of the classes ``f, sig, first``. Only the documents of their first lines are read again."""
    send = texts.sparkSession.sparkContext.broadcast
    marks = send(id_filter(lines.select(F.shiftright("f", SIZE_BITS).alias("h")), "h"))
    documents = send(id_filter(lines.select("first.key"), "key"))
    read = lambda batches: _token_lists(marks.value, documents.value)(batches)
    lists = texts.mapInArrow(read, "f long, sig long, items array<long>")
    return fitted(lists.join(lines.select("f", "sig"), ["f", "sig"], "left_semi").dropDuplicates(["f", "sig"]), FEW_LISTS)


def similar_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, dense_rank: int = DENSE) -> DataFrame:
    """A row per line with a word: ``at, key, line`` (document order and key, line from 0), ``n`` distinct tokens,
    ``first`` (the place of the first line of equal tokens), ``match`` (the place of the earliest line that it repeats, null
    if there is none), ``kept``, and ``links``, the number of other sets of tokens that are similar and stand earlier than the first line of its own."""
    spark = docs.sparkSession
    ship_package(spark)
    texts = _documents(docs, doc_id, text)
    listed = staged(texts.mapInArrow(_list_lines, LISTED))
    lines = listed.where("kind = 'line'").drop("kind")
    place = F.struct("at", "key", "line")
    classes = staged(lines.groupBy("f", "sig", "n").agg(F.min(place).alias("first")))
    ranks = spark.sparkContext.broadcast(count_table(listed.where("kind = 'count'")))
    # rows of a sparse token go to one task; those of a dense one go anywhere, and through
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = F.when(F.col("t") < 0, F.col("f").bitwiseXOR(F.col("t"))).otherwise(F.shiftright("t", PLACE_BITS))
    index = texts.mapInArrow(lambda b: _prefixes(ranks.value, percent, dense_rank)(b), INDEX).repartition(tasks, dealt)
    met = staged(index.mapInArrow(_sparse_ties(percent), TIES))
    by_count = F.ceil(F.count("*") / SHARE)
    dense = _tiles(met.where("t is not null").drop("a", "b").distinct(), by_count).mapInArrow(_meeting(lambda rows: _tile_ties(rows, percent)), "a long, b long")
    ties = met.where("t is null").select("a", "b").unionByName(dense).distinct()
    groups = components(ties).select(F.col("node").alias("_node"), F.col("component").alias("t"))
    named = classes.select("f", "sig", "first")
    members = staged(named.join(groups, named["f"].bitwiseAND(F.lit(NODE)) == groups["_node"]).drop("_node"))
    tiles = _tiles(members.join(_lists(texts, members), ["f", "sig"]), F.greatest(by_count, F.ceil(F.sum(F.size("items").cast("long")) / SHARE_TOKENS)))
    told = tiles.mapInArrow(_meeting(lambda rows: _tile_matches(rows, percent)), TOLD)
    found = fitted(told.groupBy("f", "sig").agg(F.min("earlier").alias("earlier"), F.sum("links").alias("links")))
    classes = classes.join(found, ["f", "sig"], "left")
    told = lines.join(classes, ["f", "sig", "n"])
    match = F.when(place != F.col("first"), F.col("first")).otherwise(F.col("earlier"))
    return told.select("at", "key", "line", "n", "first", match.alias("match"), match.isNull().alias("kept"), F.coalesce("links", F.lit(0)).alias("links"))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """``docs`` with removed lines taken out of the text; a document of which nothing is left has an empty text.

    Blank lines stay where they are; other columns are carried whatever their names.
    """
    # the numbers of a document's lines are never more than its text
    gone = similar_lines(docs, doc_id, text, percent).where("not kept").groupBy("at", "key").agg(F.collect_set("line").alias("gone"))
    body, number = F.coalesce(F.col(text).cast("string"), F.lit("")), F.col(doc_id).cast("long")
    wrapped = docs.select(F.struct(*docs.columns).alias("doc"), F.coalesce(number, F.lit(LAST)).alias("at"), F.xxhash64(number, body).alias("key"))
    joined = wrapped.join(staged(gone), ["at", "key"], "left")
    whole = F.col("doc")[text]
    joined = joined.withColumn("lines", F.when(F.col("gone").isNotNull(), F.split(whole, "\n", -1)))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    cut = F.when(F.col("gone").isNull(), whole).otherwise(F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n"))
    return joined.select(*[(cut if c == text else F.col("doc")[c]).alias(c) for c in docs.columns])
