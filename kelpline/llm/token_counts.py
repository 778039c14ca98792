"""Token counts of texts of any length.

A short text is encoded as it is. A huge one is cut into overlapping chunks that are encoded
by different tasks. Neighbouring chunks are spliced where both have a boundary between pre-tokens at the same
character: the pre-tokenizer reads forward only, so from a common boundary on both scans are the same, and
merges never cross a boundary. A boundary near the cut end of a chunk is not proven, as the text
beyond might change the match, so the last ``MARGIN`` characters of a chunk do not count. If
an overlap has no common boundary (a word longer than the overlap), the chunk is extended and encoded again
with twice the overlap, as often as needed.

For each splice at character b, the tokens before b are those of the left chunk and the tokens from b on those of the right
one. The total is therefore that of the last chunk plus, over all splices, the left chunk's
tokens before b less the right chunk's tokens before b.

Defined results: a null text is an empty one with no tokens; repeated rows are counted one by one; an empty
table gives no rows; other columns are ignored whatever their names.
"""

from __future__ import annotations

import base64
import functools
import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelpline.llm.tables import staged
from kelpline.session import ship_package

CHUNK_CHARS = 65_536
OVERLAP_CHARS = 512
#: No match of the pre-tokenizer looks further ahead than a contraction of three characters or, for added
#: tokens, the longest of them; checked against the tokenizer's file when it is loaded.
MARGIN = 32
LIMIT = 1024


@functools.cache
def tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    longest = max((len(t.content) for t in found.get_added_tokens_decoder().values()), default=0)
    if longest + 3 > MARGIN:
        raise ValueError(f"{path} has an added token of {longest} characters; the margin is {MARGIN}")
    return found


@functools.cache
def _counter(path: str, ranks: str | None):
    """Texts to token counts. With a rank file of the same vocabulary the faster library for
    such files counts; it is checked to hold the same vocabulary and pattern."""
    slow = tokenizer(path)
    if ranks is None:
        return lambda texts: [len(e) for e in slow.encode_batch_fast(texts, add_special_tokens=False)]
    import public_tokenizers
    import tiktoken

    added = {t.content: i for i, t in slow.get_added_tokens_decoder().items()}
    with open(ranks, "rb") as file:
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    if len(merges) + len(added) != slow.get_vocab_size(with_added_tokens=True):
        raise ValueError(f"{ranks} is not the vocabulary of {path}")
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens=added)
    return lambda texts: [len(fast.encode_to_numpy(t, allowed_special="all")) for t in texts]


def _count_batches(path: str, ranks: str | None):
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _counter(path, ranks)
        for batch in batches:
            n = pa.array(counts(batch["_text"].to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([batch["_row"], batch["_n_bytes"], n], names=["_row", "n_bytes", "n_tokens"])

    return count


def boundaries(path: str, text: str) -> tuple[np.ndarray, np.ndarray, int]:
    """Characters where a pre-token begins, the number of tokens before each, and the number of all tokens."""
    found = tokenizer(path).encode(text, add_special_tokens=False)
    words = np.array([-1 if w is None else w for w in found.word_ids], np.int64)
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    # an added token has no word; it is a unit of its own
    first = np.flatnonzero(np.r_[True, (words[1:] != words[:-1]) | (words[1:] < 0)])
    # the library makes a new list at every access
    offsets = found.offsets
    starts = np.fromiter((offsets[i][0] for i in first), np.int64, len(first))
    return starts, first, len(words)


CHUNK_SCHEMA = "_row long, _chunk long, _last boolean, _n long, _head array<struct<at:long,n:long>>, _tail array<struct<at:long,n:long>>"
_POINTS = pa.list_(pa.struct([("at", pa.int64()), ("n", pa.int64())]))


def _points(starts: np.ndarray, before: np.ndarray, chosen: np.ndarray, base: int) -> list[dict]:
    return [{"at": int(a) + base, "n": int(n)} for a, n in zip(starts[chosen], before[chosen])]


def _chunk_batches(path: str):
    """Tokens of a chunk, and its boundaries in both overlaps: ``_head`` shared with the chunk before,
    ``_tail`` with the one after. Characters are those of the whole text."""

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"_row": [], "_chunk": [], "_last": [], "_n": [], "_head": [], "_tail": []}
            for row in batch.to_pylist():
                text = row["_piece"]
                starts, before, n = boundaries(path, text)
                out["_row"].append(row["_row"])
                out["_chunk"].append(row["_chunk"])
                out["_last"].append(row["_last"])
                out["_n"].append(n)
                head = starts < row["_lap"] if row["_chunk"] else np.zeros(len(starts), bool)
                # what the next chunk holds as well and the cut end cannot change
                own = len(text) - row["_lap"]
                tail = (starts >= own) & (starts <= len(text) - MARGIN) & (not row["_last"])
                out["_head"].append(_points(starts, before, head, row["_start"]))
                out["_tail"].append(_points(starts, before, tail, row["_start"]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[c]) for c in ("_row", "_chunk")] + [pa.array(out["_last"], pa.bool_()), pa.array(out["_n"], pa.int64())]
                + [pa.array(out[c], _POINTS) for c in ("_head", "_tail")],
                names=list(out),
            )

    return encode


def _encoded(path: str, pieces: DataFrame) -> DataFrame:
    dealt = pieces.repartition(F.xxhash64("_row", "_chunk"))
    return dealt.mapInArrow(_chunk_batches(path), CHUNK_SCHEMA)


PIECE_SCHEMA = "_row long, _chunk long, _last boolean, _start long, _lap long, _piece string"


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``_spans`` of a text (chunk number, begin, end, overlap) to rows; one text at a time."""
    for batch in batches:
        for key, text, spans in zip(*(batch[c] for c in ("_row", "_text", "_spans"))):
            body = text.as_py()
            for span in spans.as_py():
                row = {"_row": key.as_py(), "_chunk": span["chunk"], "_last": span["last"], "_start": span["begin"]}
                row |= {"_lap": span["lap"], "_piece": body[span["begin"] : span["end"]]}
                yield pa.RecordBatch.from_pylist([row])


def _span(chunk: Column, last: Column, begin: Column, end: Column, lap: Column) -> Column:
    parts = {"chunk": chunk.cast("long"), "last": last, "begin": begin.cast("long"), "end": end.cast("long"), "lap": lap.cast("long")}
    return F.struct(*[c.alias(k) for k, c in parts.items()])


def _pieces(texts: DataFrame, spans: Column) -> DataFrame:
    return texts.select("_row", "_text", spans.alias("_spans")).mapInArrow(_cut, PIECE_SCHEMA)


def _joints(left: DataFrame, right: DataFrame) -> DataFrame:
    """Per pair of neighbours the gain at their first common boundary; null if there is none."""
    ends = left.where("not _last").select("_row", "_chunk", "_tail")
    heads = right.where("_chunk > 0").select("_row", (F.col("_chunk") - 1).alias("_chunk"), "_head")
    common = F.filter("_tail", lambda t: F.exists("_head", lambda h: h["at"] == t["at"]))
    at = F.get(common, F.lit(0))
    other = F.get(F.filter("_head", lambda h: h["at"] == at["at"]), F.lit(0))
    return ends.join(heads, ["_row", "_chunk"]).select("_row", "_chunk", (at["n"] - other["n"]).alias("_gain"))


def count_tokens(
    docs: DataFrame,
    path: str,
    text: str = "text",
    ranks: str | None = None,
    chunk_chars: int = CHUNK_CHARS,
    overlap_chars: int = OVERLAP_CHARS,
) -> DataFrame:
    """``docs`` with ``n_bytes`` and ``n_tokens`` of each whole text, as the tokenizer of ``path`` gives them.

    ``path`` (and ``ranks``, a rank file of the same vocabulary, which only short texts use) must name the same
    file on all executors. Only texts longer than a chunk are staged and dealt out; the others are counted where they are read.
    """
    if overlap_chars <= MARGIN or chunk_chars < 2 * overlap_chars:
        raise ValueError("a chunk must hold two overlaps, and an overlap more than the margin")
    spark = docs.sparkSession
    ship_package(spark)
    body = F.coalesce(F.col(text), F.lit(""))
    others = [c for c in docs.columns if c.lower() not in (text.lower(), "n_bytes", "n_tokens")]
    row = F.struct(*others) if others else F.struct(F.lit(0))
    named = docs.select(row.alias("_row"), body.alias("_text"), F.octet_length(body).cast("long").alias("_n_bytes"))
    long = F.length("_text") > chunk_chars
    row_type = named.schema["_row"].dataType.simpleString()
    short = named.where(~long).mapInArrow(_count_batches(path, ranks), f"_row {row_type}, n_bytes long, n_tokens long")
    # the few long texts get a row number that stays
    huge = staged(named.where(long).withColumn("_key", F.monotonically_increasing_id()))
    step = chunk_chars - overlap_chars
    size = F.length("_text")
    last = F.floor((size - overlap_chars - 1) / step)
    texts = huge.select(F.col("_key").alias("_row"), "_text")
    spans = F.transform(
        F.sequence(F.lit(0).cast("long"), last),
        lambda i: _span(i, i == last, i * step, F.least(i * step + chunk_chars, size), F.lit(overlap_chars)),
    )
    pieces = _pieces(texts, spans)
    encoded = staged(_encoded(path, pieces))
    joints = staged(_joints(encoded, encoded))
    done, lap = joints.where("_gain is not null"), overlap_chars
    longest = huge.agg(F.max(size)).first()[0] or 0
    while True:
        failed = joints.where("_gain is null").select("_row", "_chunk")
        if lap >= longest or failed.isEmpty():
            break
        # encode both sides of a failed joint again, with an overlap that reaches twice as far to the right
        lap *= 2
        again = texts.join(failed, "_row")
        begin, cut = F.col("_chunk") * step, (F.col("_chunk") + 1) * step
        # both keep their begin, so their token numbers stay those of the first round
        end = F.least(cut + lap, size)
        left = _pieces(again, F.array(_span(F.col("_chunk"), F.lit(False), begin, end, end - cut)))
        right = _pieces(again, F.array(_span(F.col("_chunk") + 1, F.lit(False), cut, end, end - cut)))
        joints = staged(_joints(_encoded(path, left), _encoded(path, right)))
        done = done.unionByName(joints.where("_gain is not null"))
    return _total(short, huge, encoded, done, joints.where("_gain is null"), path, others)


def _total(short: DataFrame, huge: DataFrame, encoded: DataFrame, done: DataFrame, failed: DataFrame, path: str, others: list[str]) -> DataFrame:
    """Add up chunks and splices; a text with a joint that no overlap could splice is encoded whole."""
    gains = done.select("_row", F.col("_gain").alias("_n")).unionByName(encoded.where("_last").select("_row", "_n"))
    totals = gains.groupBy(F.col("_row").alias("_key")).agg(F.sum("_n").alias("n_tokens"))
    bad = failed.select(F.col("_row").alias("_key")).distinct()
    spliced = huge.join(bad, "_key", "left_anti").join(totals, "_key").select("_row", F.col("_n_bytes").alias("n_bytes"), "n_tokens")
    whole = huge.join(bad, "_key", "left_semi").select("_row", "_text", "_n_bytes")
    rest = whole.mapInArrow(_count_batches(path, None), short.schema)
    found = short.unionByName(spliced).unionByName(rest)
    return found.select(*[F.col("_row")[c].alias(c) for c in others], "n_bytes", "n_tokens")
