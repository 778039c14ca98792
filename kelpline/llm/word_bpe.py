"""BPE encoding by a table of distinct words, and decoding by a table of pieces.

A word is a run of blanks and the run of other characters after it. The pre-tokenizer always begins a new match where a blank follows
another character, and reads forward only, so the tokens of a text are those of its words, one after another,
each encoded by itself. Texts are cut at added tokens first, whose strings are words of their own.

1. Documents are numbered word by word in blocks of some megabytes of text. A block sends each of its distinct words once to the partition
   that the word's hash names. What stays is the documents as word numbers, packed.
2. A partition encodes every distinct word of all blocks once and answers each block with the ids of its words.
3. Block and answers meet by the block's key; ids are put back by the word numbers.

Texts are split twice, once for the words that are sent and once for the documents, so nothing is staged. The key of
a block is a hash of its words in order: if a table were not read in the same order both times, a block would find no
answer, and the run fails instead of mixing up words.

Decoding joins ids with the vocabulary's pieces: a table bounded by the vocabulary, in every task.

Defined results: a null text is empty and has no ids; repeated rows are encoded one by one; an empty table gives no rows; other
columns are ignored whatever their names. Ids that are no token are skipped in decoding, bytes that are not UTF-8 are replaced.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelpline.llm.token_counts import tokenizer
from kelpline.session import ship_package

BLOCK_BYTES = 16 * 1024 * 1024
#: Documents of a block are packed in groups of about so many words.
GROUP_WORDS = 65_536

# The characters of the White_Space property.
WHITE_SPACE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_BLANKS = "".join(map(chr, WHITE_SPACE))
WORDS = re.compile(f"[{_BLANKS}]*[^{_BLANKS}]+|[{_BLANKS}]+")

LEVEL = 3


@functools.cache
def _added(path: str) -> re.Pattern | None:
    found = tokenizer(path).get_added_tokens_decoder().values()
    if any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in found):
        raise ValueError("added tokens that change the text around them are not supported")
    return re.compile("(" + "|".join(sorted((re.escape(t.content) for t in found), key=len, reverse=True)) + ")") if found else None


def check_tokenizer(path: str) -> None:
    """Raise if words of this tokenizer could not be encoded one by one."""
    import json

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    before = spec["pre_tokenizer"] or {}
    if spec["normalizer"] is not None or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex"):
        raise ValueError(f"{path} is not a byte-level tokenizer whose matches begin at blanks")
    _added(path)


def split_text(text: str, added: re.Pattern | None) -> list[str]:
    if added is None or not added.search(text):
        return WORDS.findall(text)
    out = []
    for i, part in enumerate(added.split(text)):
        out += [part] if i % 2 else WORDS.findall(part)
    return out


class _Numbers(dict):
    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


def pack(numbers: np.ndarray) -> bytes:
    """Numbers below 2 ** 28 in one to four bytes each, compressed."""
    out = np.zeros((len(numbers), 4), np.uint8)
    keep = np.zeros((len(numbers), 4), bool)
    for i in range(4):
        keep[:, i] = (numbers >= 1 << (7 * i)) if i else True
        out[:, i] = ((numbers >> (7 * i)) & 127) | np.where(numbers >= 1 << (7 * (i + 1)), 128, 0)
    return zstandard.ZstdCompressor(level=LEVEL).compress(out[keep].tobytes())


def unpack(data: bytes) -> np.ndarray:
    plain = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    last = np.flatnonzero(plain < 128)
    if not len(last):
        return np.zeros(0, np.int64)
    first = np.r_[0, last[:-1] + 1]
    out = np.zeros(len(last), np.int64)
    for i in range(4):
        more = first + i <= last
        out[more] |= (plain[first[more] + i].astype(np.int64) & 127) << (7 * i)
    return out


class _Block:
    """The documents of a stretch of a partition as word numbers."""

    def __init__(self):
        self.numbers, self.size = _Numbers(), 0
        self.groups: list[tuple[list, list[int], bytes]] = []
        self.ids, self.counts, self.parts, self.held = [], [], [], 0

    def add(self, doc_id, text: str, words: list[str], keep: bool) -> None:
        number = self.numbers.__getitem__
        if keep:
            self.parts.append(np.fromiter(map(number, words), np.int64, len(words)))
            self.ids.append(doc_id)
            self.counts.append(len(words))
            self.held += len(words)
            if self.held >= GROUP_WORDS:
                self.close_group()
        else:
            for word in words:
                number(word)
        self.size += len(text)

    def close_group(self) -> None:
        if self.ids:
            self.groups.append((self.ids, self.counts, pack(np.concatenate(self.parts))))
            self.ids, self.counts, self.parts, self.held = [], [], [], 0

    def key(self) -> int:
        digest = xxhash.xxh3_64()
        for word in self.numbers:
            digest.update(word.encode())
            digest.update(b"\0")
        return int(np.uint64(digest.intdigest()).view(np.int64))

    def partitions(self, n: int) -> np.ndarray:
        return np.fromiter((zlib.crc32(word.encode()) % n for word in self.numbers), np.int32, len(self.numbers))


def _blocks(batches: Iterable[pa.RecordBatch], path: str, keep: bool, block_bytes: int) -> Iterator[_Block]:
    added, block = _added(path), _Block()
    for batch in batches:
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
            body = text.as_py() or ""
            words = split_text(body, added)
            # the order of first places numbers the words, whether documents are kept or not
            block.add(doc_id, body, words if keep else list(dict.fromkeys(words)), keep)
            if block.size >= block_bytes:
                yield block
                block = _Block()
    if block.size or block.ids:
        yield block
    # the worker lives on; what it holds of past blocks is of no use to it
    pa.default_memory_pool().release_unused()


SENT = "block long, part int, sizes binary, words binary"


def pack_words(words: list[bytes]) -> tuple[bytes, bytes]:
    """Lengths and bytes of words, compressed."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    return pack(sizes), zstandard.ZstdCompressor(level=LEVEL).compress(b"".join(words))


def unpack_words(sizes: bytes, words: bytes) -> list[str]:
    data = zstandard.ZstdDecompressor().decompress(words)
    ends = np.cumsum(unpack(sizes)).tolist()
    return [data[a:b].decode() for a, b in zip([0, *ends], ends)]


def _send_words(path: str, parts: int, block_bytes: int):
    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, path, False, block_bytes):
            by_part: dict[int, list[bytes]] = {}
            for word in block.numbers:
                data = word.encode()
                by_part.setdefault(zlib.crc32(data) % parts, []).append(data)
            key = block.key()
            rows = [(key, part, *pack_words(words)) for part, words in by_part.items()]
            types = [pa.int64(), pa.int32(), pa.binary(), pa.binary()]
            columns = zip(*rows) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["block", "part", "sizes", "words"])

    return send


ANSWERED = "block long, part int, sizes binary, ids binary"


def _answer(path: str):
    """The ids of the words of each message; a word that several blocks send is encoded once."""

    def answer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, table = tokenizer(path), {}
        for batch in batches:
            out = {"block": [], "part": [], "sizes": [], "ids": []}
            for block, part, lengths, packed in zip(*(batch[c].to_pylist() for c in ("block", "part", "sizes", "words"))):
                words = unpack_words(lengths, packed)
                new = [w for w in words if w not in table]
                for word, code in zip(new, encoder.encode_batch_fast(new, add_special_tokens=False)):
                    table[word] = np.array(code.ids, np.uint32).tobytes()
                codes = [table[w] for w in words]
                out["block"].append(block)
                out["part"].append(part)
                out["sizes"].append(pack(np.fromiter(map(len, codes), np.int64, len(codes)) // 4))
                out["ids"].append(pack(np.frombuffer(b"".join(codes), np.uint32).astype(np.int64)))
            types = {"block": pa.int64(), "part": pa.int32(), "sizes": pa.binary(), "ids": pa.binary()}
            yield pa.RecordBatch.from_arrays([pa.array(v, types[k]) for k, v in out.items()], names=list(out))

    return answer


PACKED = "block long, doc_ids array<long>, counts array<long>, numbers binary, parts binary"


def _pack_documents(path: str, parts: int, block_bytes: int):
    def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("numbers", pa.binary()), ("parts", pa.binary())]
        )
        for block in _blocks(batches, path, True, block_bytes):
            block.close_group()
            key = block.key()
            # the partition of every word of the block, in the order of word numbers
            rows = [{"block": key, "parts": pack(block.partitions(parts).astype(np.int64))}]
            rows += [{"block": key, "doc_ids": i, "counts": c, "numbers": n} for i, c, n in block.groups]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return packed


def _word_ids(parts: np.ndarray, answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words of a block one after another in the order of word numbers, and how many each has."""
    sizes, starts = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
    flat, total = [], 0
    seen = 0
    for part, size, ids in zip(answers["part"].to_pylist(), answers["sizes"].to_pylist(), answers["ids"].to_pylist()):
        own = np.flatnonzero(parts == part)
        n = unpack(size)
        if len(own) != len(n):
            raise ValueError("the words of a block were not answered as they were sent")
        sizes[own], starts[own] = n, total + np.cumsum(n) - n
        flat.append(unpack(ids))
        total += len(flat[-1])
        seen += len(own)
    if seen != len(parts):
        raise ValueError("a block has no answer: its table was read in another order the second time")
    ids = np.concatenate(flat) if flat else np.zeros(0, np.int64)
    ends = np.cumsum(sizes)
    take = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)
    return ids[take].astype(np.int32), sizes


ENCODED = "doc_id long, ids array<int>"


def _put_back(left: pa.Table, right: pa.Table) -> pa.Table:
    """Documents of one block with their ids."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
    if not left.num_rows:
        raise ValueError("words of a block without documents: its table was read in another order the second time")
    # equal blocks, as of equal tables in equal order, have one key: all their answers are the same
    parts = unpack(next(p for p in left["parts"].to_pylist() if p is not None))
    first = {p: i for i, p in reversed(list(enumerate(right["part"].to_pylist())))}
    ids, sizes = _word_ids(parts, right.take(pa.array(sorted(first.values()), pa.int64())))
    begins = np.cumsum(sizes) - sizes
    out = []
    for doc_ids, counts, packed in zip(left["doc_ids"].to_pylist(), left["counts"].to_pylist(), left["numbers"].to_pylist()):
        if packed is None:
            continue
        numbers = unpack(packed)
        n = sizes[numbers]
        ends = np.cumsum(n)
        take = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins[numbers] - (ends - n), n)
        bounds = np.r_[0, ends][np.r_[0, np.cumsum(counts)]]
        lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids[take]))
        out.append(pa.Table.from_arrays([pa.array(doc_ids, pa.int64()), lists], schema=schema))
    return pa.concat_tables(out) if out else schema.empty_table()


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, ids``, a row per row of ``docs``: the ids of the whole text without begin or end tokens, added
    tokens in the text taken as such. ``path`` must name the same file on all machines."""
    spark = docs.sparkSession
    ship_package(spark)
    check_tokenizer(path)
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sent = texts.mapInArrow(_send_words(path, parts, block_bytes), SENT)
    answers = sent.repartition(parts, "part").mapInArrow(_answer(path), ANSWERED)
    packed = texts.mapInArrow(_pack_documents(path, parts, block_bytes), PACKED)
    return packed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_put_back, ENCODED)


@functools.cache
def _pieces(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The vocabulary's pieces as bytes one after another, where each begins, and its length, by id."""
    found = tokenizer(path)
    added = {i: t.content.encode() for i, t in found.get_added_tokens_decoder().items()}
    # byte-level pieces write every byte as a character: printable ones as they are, the others from 256 on
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    vocabulary = found.get_vocab(with_added_tokens=True)
    pieces = [b""] * (max(vocabulary.values()) + 1)
    for piece, i in vocabulary.items():
        pieces[i] = added[i] if i in added else bytes(byte[c] for c in piece)
    sizes = np.array([len(p) for p in pieces], np.int64)
    return np.frombuffer(b"".join(pieces), np.uint8), np.cumsum(sizes) - sizes, sizes


def join_pieces(path: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all ids, and where those of each end."""
    data, begins, sizes = _pieces(path)
    known = (ids >= 0) & (ids < len(sizes))
    ids = np.where(known, ids, 0)
    n = np.where(known, sizes[ids], 0)
    ends = np.cumsum(n)
    take = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins[ids] - (ends - n), n)
    return data[take], ends


DECODED = "doc_id long, ids array<int>, text string"
IDS_AT_ONCE = 1 << 20


def _decode_batches(path: str):
    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            sizes = whole["ids"].value_lengths().fill_null(0).to_numpy()
            ends = np.cumsum(sizes)
            begin = 0
            while begin < len(whole):
                base = ends[begin] - sizes[begin]
                end = max(begin + 1, int(np.searchsorted(ends, base + IDS_AT_ONCE, "right")))
                batch = whole.slice(begin, end - begin)
                data, stops = join_pieces(path, batch["ids"].flatten().to_numpy())
                bounds = np.r_[0, stops][np.r_[0, np.cumsum(sizes[begin:end])]]
                texts = [_text(data[a:b].tobytes()) for a, b in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["ids"], pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])
                begin = end

    return decode


def _text(data: bytes) -> str:
    return data.decode("utf-8", errors="replace")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids`` to ``doc_id, ids, text``; special tokens are kept."""
    ship_package(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(_decode_batches(path), DECODED)
