"""Operators on documents: odd rows, empty tables, and brute-force versions on the given tables."""

import collections
import random
import re

import brute
import numpy as np
import pyarrow as pa
import pytest
from conftest import ROWS
from pyspark.sql import functions as F

from kelpline.llm import host_rules, line_dedup, mixing, near_dedup, substrings, tables, token_counts, word_bpe


def rows_of(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


# -- token counts ---------------------------------------------------------------------------


@pytest.mark.parametrize("sizes", [{}, {"chunk_chars": 400, "overlap_chars": 40}, {"chunk_chars": 90, "overlap_chars": 40}])
def test_token_counts(odd, tokenizer, vocabulary, sizes):
    found = token_counts.count_tokens(odd.select("doc_id", "text"), vocabulary("byte_bpe_50k.json"), ranks=vocabulary("byte_bpe_50k.tiktoken"), **sizes)
    texts = {(i, t) for i, t, *_ in ROWS}
    expected = collections.Counter((i, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False))) for i, t, *_ in ROWS)
    assert collections.Counter(map(tuple, found.collect())) == expected and len(texts) == len(ROWS) - 1


def test_token_counts_without_boundaries(spark, tokenizer, vocabulary):
    """Words longer than any overlap: the overlap is widened up to the whole text."""
    texts = ["a" * 1000, "x" * 300 + " " + "y" * 700, "<|endoftext|>" * 60, "\n" * 500 + "a", "I'll " * 200]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = token_counts.count_tokens(df, vocabulary("byte_bpe_50k.json"), chunk_chars=100, overlap_chars=40)
    got = {r.doc_id: r.n_tokens for r in found.collect()}
    assert got == {i: len(tokenizer.encode(t, add_special_tokens=False)) for i, t in enumerate(texts)}


def test_token_counts_carries_columns(odd, empty, vocabulary):
    path = vocabulary("byte_bpe_50k.json")
    assert "kept" in token_counts.count_tokens(odd, path).columns
    assert token_counts.count_tokens(empty, path).count() == 0


def test_fast_counts_agree_over_code_points(tokenizer, vocabulary):
    count = token_counts._counter(vocabulary("byte_bpe_50k.json"), vocabulary("byte_bpe_50k.tiktoken"))
    texts = []
    for c in range(0, 0x11000, 3):
        if not 0xD800 <= c < 0xE000:
            x = chr(c)
            texts.append(f"a{x}a 1{x}1 {x} ,{x}, {x}{x}a")
    assert count(texts) == [len(e) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


# -- BPE ------------------------------------------------------------------------------------


@pytest.mark.parametrize("block", [word_bpe.BLOCK_BYTES, 200])
def test_word_bpe(odd, tokenizer, vocabulary, block):
    path = vocabulary("byte_bpe_50k.json")
    found = word_bpe.decode(word_bpe.encode(odd, path, block_bytes=block), path).collect()
    expected = collections.Counter()
    for i, t, *_ in ROWS:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        expected[i, tuple(ids), tokenizer.decode(ids, skip_special_tokens=False)] += 1
    assert collections.Counter((r.doc_id, tuple(r.ids), r.text) for r in found) == expected


def test_word_bpe_empty(empty, vocabulary):
    path = vocabulary("byte_bpe_50k.json")
    assert word_bpe.decode(word_bpe.encode(empty, path), path).count() == 0


def test_words_begin_where_tokens_do(tokenizer):
    """Words by themselves have the tokens of the whole text, for blanks and signs of all kinds."""
    for c in [*range(0, 0x600), *range(0x1F00, 0x3100), *range(0xFE00, 0x10000)]:
        x = chr(c)
        text = f"a{x}b {x} {x}{x}c.{x}\n!{x}'s{x}"
        whole = tokenizer.encode(text, add_special_tokens=False).ids
        parts = [i for w in word_bpe.split_text(text, None) for i in tokenizer.encode(w, add_special_tokens=False).ids]
        assert whole == parts, hex(c)


def test_packing():

    numbers = np.array([0, 1, 127, 128, 16383, 16384, 2**21 - 1, 2**21, 2**28 - 1])
    assert (word_bpe.unpack(word_bpe.pack(numbers)) == numbers).all()
    assert len(word_bpe.unpack(word_bpe.pack(numbers[:0]))) == 0


def test_unknown_ids(spark, vocabulary):
    rows = spark.createDataFrame([(1, [60_000, -1]), (2, None), (3, [0, 50_256])], "doc_id long, ids array<int>")
    found = {r.doc_id: r.text for r in word_bpe.decode(rows, vocabulary("byte_bpe_50k.json")).collect()}
    assert found == {1: "", 2: "", 3: "!<|endoftext|>"}


# -- staged tables --------------------------------------------------------------------------


def test_long_lists_stay_partitioned(spark):
    """Few rows are one partition only if their lists are short."""
    rows = spark.range(0, 100, 1, 4)
    of = lambda n: tables.fitted(rows.select("id", F.sequence(F.lit(1), F.lit(n)).alias("items"))).rdd.getNumPartitions()
    assert of(10) == 1 and of(60_000) > 1 and tables.fitted(rows).rdd.getNumPartitions() == 1


# -- near duplicates ------------------------------------------------------------------------


def test_near_duplicates_odd(odd, empty):
    found = near_dedup.near_duplicates(odd)
    expected = brute.near_duplicates([(i, t) for i, t, *_ in ROWS if i is not None])
    got = [r for r in found.collect() if r.doc_id is not None]
    assert len(got) == len(ROWS) - 1
    assert all((r.n_shingles, r.component_id) == expected[r.doc_id] and r.kept == (r.doc_id == r.component_id) for r in got)
    assert [(r.component_id, r.kept) for r in found.where("doc_id is null").collect()] == [(None, True)]
    assert near_dedup.near_duplicates(empty).count() == 0


def test_near_duplicates_given(docs):
    expected = brute.near_duplicates(rows_of(docs))
    assert all((r.n_shingles, r.component_id) == expected[r.doc_id] for r in near_dedup.near_duplicates(docs).collect())


def test_near_duplicates_around_an_original(spark):
    """Copies that are similar to the original only, whose id is not the least."""
    base = [f"w{i}" for i in range(400)]
    texts = {100: " ".join(base)}
    for n in range(40):
        changed = list(base)
        for k in range(9):
            changed[(n * 9 + k * 43) % 400] = f"z{n}x{k}"
        texts[n] = " ".join(changed)
    expected = brute.near_duplicates(list(texts.items()))
    assert {c for _, c in expected.values()} == {0}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_dedup.near_duplicates(df).collect()} == {i: 0 for i in texts}


def test_near_duplicates_of_a_variant(spark):
    """An original, its variants, and a text that is similar to one of the variants only."""
    rng, rows = random.Random(7), []
    for g in range(12):
        base = [f"g{g}w{k}" for k in range(1000)]
        texts = [base]
        for n in range(20):
            texts.append([f"g{g}v{n}" if k == 20 + 45 * n else w for k, w in enumerate(base)])
        changed = set(rng.sample(range(10, 990, 10), 28))
        texts.append([f"g{g}y{k}" if k in changed else w for k, w in enumerate(texts[1 + g])])
        ids = rng.sample(range(100), len(texts))
        rows += [(100 * g + i, " ".join(t)) for i, t in zip(ids, texts)]
    expected = brute.near_duplicates(rows)
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in found} == {i: c for i, (_, c) in expected.items()}
    assert len({c for _, c in expected.values()}) == 12


def test_densified_bins_agree_with_the_similarity():

    rng = np.random.default_rng(5)
    hits = []
    for _ in range(300):
        base = rng.integers(0, 2**64, 60, np.uint64)
        one, two = np.unique(base[:50]), np.unique(base[10:])
        rows = near_dedup.densified(near_dedup.bin_minima([one, two]))
        hits.append((rows[0] == rows[1]).mean())
    assert abs(np.mean(hits) - 40 / 60) < 0.03


@pytest.mark.parametrize("size", [1, 2, 7, 39, 40, 100, 1000, 20_000])
def test_similar_sets_agree_enough(size):
    """Pairs of just the similarity asked for pass the comparison of signatures; unrelated sets of some size do not."""
    rng = np.random.default_rng(size)
    for _ in range(300 if size < 10_000 else 20):
        union = rng.integers(0, 2**64, -(-size * 8 // 7), np.uint64)
        gone = len(union) // 4
        split = int(rng.integers(0, gone + 1))
        one, two = np.unique(union[split:]), np.unique(union[: len(union) - (gone - split)])
        other = np.unique(rng.integers(0, 2**64, size, np.uint64))
        marks = near_dedup.short_signatures(near_dedup.densified(near_dedup.bin_minima([one, two, other], near_dedup.COMPARED)))
        sizes = [np.array([len(s)]) for s in (one, two, other)]
        assert near_dedup.agree_enough(marks[:1], marks[1:2], sizes[0], sizes[1])[0]
        if size > 7:
            assert not near_dedup.agree_enough(marks[:1], marks[2:], sizes[0], sizes[2])[0]


def test_short_signatures_count_bins():
    rng = np.random.default_rng(3)
    one, two = rng.integers(0, 2**64, (2, 50, near_dedup.COMPARED), np.uint64)
    equal = ((one & np.uint64(15)) == (two & np.uint64(15))).sum(axis=1)
    assert (near_dedup.agreeing(near_dedup.short_signatures(one), near_dedup.short_signatures(two)) == equal).all()
    packed = near_dedup._packed(near_dedup.short_signatures(one))
    assert (near_dedup._unpacked(packed.slice(7, 20)) == near_dedup.short_signatures(one)[7:27]).all()


@pytest.mark.parametrize("share", [3, 50, 2048])
def test_near_duplicates_of_a_common_passage(spark, share):
    """Hundreds of documents with a passage in common, in many components, some of which are joined by chains only."""
    rng, rows = random.Random(11), []
    passage = [f"p{k}" for k in range(120)]
    for g in range(100):
        base = passage + [f"g{g}w{k}" for k in range(180)]
        rows.append((len(rows), " ".join(base)))
        for _ in range(g % 5):
            changed = set(rng.sample(range(5, 295, 10), 7))
            base = [f"x{len(rows)}c{k}" if k in changed else w for k, w in enumerate(base)]
            rows.append((len(rows), " ".join(base)))
    rng.shuffle(rows)
    expected = brute.near_duplicates(rows)
    assert 90 < len({c for _, c in expected.values()}) < len(rows) - 50
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), share=share).collect()
    assert {r.doc_id: r.component_id for r in found} == {i: c for i, (_, c) in expected.items()}


def _nearly_similar(copies: int) -> list[tuple[int, str]]:
    """Copies of a text that hardly any two of are similar, though most may be by their signatures; some are joined by chains."""
    rng, rows = random.Random(13), []
    base = [f"p{k}" for k in range(300)]
    for n in range(copies):
        changed = set(rng.sample(range(5, 295, 5), 12 if n % 9 else 4))
        rows.append((n, " ".join(f"x{n}c{k}" if k in changed else w for k, w in enumerate(base))))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("share, many", [(2048, 1 << 15), (16, 1 << 15), (16, 1)])
def test_near_duplicates_of_nearly_similar_copies(spark, share, many):
    """Members of a group that is not met, and of one that meets by its buckets."""
    rows = _nearly_similar(120)
    expected = brute.near_duplicates(rows)
    assert 50 < len({c for _, c in expected.values()}) < 120
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), share=share, many=many).collect()
    assert {r.doc_id: r.component_id for r in found} == {i: c for i, (_, c) in expected.items()}


@pytest.mark.parametrize("confirm", [False, True])
def test_a_tile_tells_less_than_it_has_members(confirm):
    """Pairs that agree in enough bins grow with the square of a tile, what it tells does not, and ties the same members."""
    rows = _nearly_similar(200)
    sets = list(near_dedup.text_sets(pa.array([t for _, t in rows])))
    marks = near_dedup.short_signatures(near_dedup.densified(near_dedup.bin_minima(sets, near_dedup.COMPARED)))
    n, ids = np.array([len(s) for s in sets]), np.array([i for i, _ in rows])
    zeros = pa.array(np.zeros(len(rows), np.int64))
    columns = {c: zeros for c in ("key", "i", "j", "share")} | {"doc_id": pa.array(ids), "component": pa.array(ids), "n": pa.array(n)}
    columns["bins"] = near_dedup._packed(marks)
    if confirm:
        columns["items"] = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
    table = pa.table(columns).combine_chunks()
    told = [(a, b) for batch in near_dedup._tile_ties(75)(table.to_batches(max_chunksize=70)) for a, b in zip(*(c.to_pylist() for c in batch.columns))]
    pairs = [(x, y) for x in range(len(rows)) for y in range(x)]
    one, two = np.array(pairs).T
    near = near_dedup.agree_enough(marks[one], marks[two], n[one], n[two])
    assert near.sum() > 10 * len(rows)
    if confirm:
        similar = [100 * len(np.intersect1d(sets[x], sets[y])) >= 75 * len(np.union1d(sets[x], sets[y])) for x, y in pairs]
        assert near[np.array(similar)].all()
        near = np.array(similar)
    assert 0 < len(told) < len(rows)
    assert brute.smallest(told, ids.tolist()) == brute.smallest(zip(ids[one[near]].tolist(), ids[two[near]].tolist()), ids.tolist())


# -- line dedup -----------------------------------------------------------------------------


def check_lines(found, rows, with_id):
    expected = brute.lines(rows)
    assert len(found) == sum(n for n in with_id.values())
    for r in found:
        key = (r.at, r.line)
        n, first, earlier = expected[key]
        assert r.n == n and (r.first.at, r.first.line) == first
        assert r.kept == (first == key and not earlier), key
        if not r.kept:
            match = (r.match.at, r.match.line)
            assert match == (first if first != key else min(earlier))
        assert r.links == len(earlier), key


def test_lines_odd(odd, empty):
    rows = sorted({(line_dedup.LAST if i is None else i, t) for i, t, *_ in ROWS}, key=lambda r: r[0])
    found = line_dedup.similar_lines(odd).collect()
    counts = collections.Counter((r.at, r.line) for r in found)
    check_lines(found, rows, counts)
    assert set(counts) == set(brute.lines(rows)) and counts[2, 0] == 2
    assert line_dedup.similar_lines(empty).count() == 0


def test_lines_given(docs):
    rows = sorted(rows_of(docs))
    found = line_dedup.similar_lines(docs).collect()
    check_lines(found, rows, collections.Counter((r.at, r.line) for r in found))


def test_dense_tokens(spark):
    """Hundreds of variants of a line that share all but few of their tokens, beside unlike lines of common tokens."""
    rows = []
    for i in range(300):
        line = [f"common{k}" for k in range(8)]
        if i % 3:
            line[i % 8] = f"own{i}"
        if i % 5 == 0:
            line = line[: 3 + i % 4]
        rows.append((i, " ".join(line) + f"\nline {i} alone"))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for rank in (line_dedup.DENSE, 24, 1):
        found = line_dedup.similar_lines(df, dense_rank=rank).collect()
        check_lines(found, rows, collections.Counter((r.at, r.line) for r in found))


def test_links_of_dense_tokens(spark):
    """All links and the earliest one, whatever the number of lines of a token."""
    rows = []
    for i in range(200):
        line = [f"common{k}" for k in range(12)]
        for k in {i % 12, i % 5}:
            line[k] = f"own{i % 40}x{k}"
        rows.append((i, " ".join(line)))
    expected = brute.lines(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for rank in (line_dedup.DENSE, 1):
        for r in line_dedup.similar_lines(df, dense_rank=rank).collect():
            n, first, earlier = expected[r.at, r.line]
            assert r.links == len(earlier)
            match = first if first != (r.at, r.line) else min(earlier, default=None)
            assert match == (r.match and (r.match.at, r.match.line))


@pytest.mark.parametrize("share", [7, 64])
def test_shares_of_dense_tokens(spark, monkeypatch, share):
    """Tiles of two shares find what one task would."""
    rng = random.Random(5)
    rows = []
    for i in range(400):
        line = [f"common{k}" for k in range(10)] + [f"w{rng.randint(0, 30)}" for _ in range(rng.randint(0, 6))]
        for _ in range(rng.randint(0, 3)):
            line[rng.randrange(len(line))] = f"own{rng.randint(0, 60)}"
        rows.append((i, " ".join(line)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(line_dedup, "SHARE", share)
    for tokens in (1 << 20, 50):
        monkeypatch.setattr(line_dedup, "SHARE_TOKENS", tokens)
        found = line_dedup.similar_lines(df, dense_rank=8).collect()
        check_lines(found, rows, collections.Counter((r.at, r.line) for r in found))


def test_one_token_in_fifty_thousand_lines(spark):
    """Every line has it; each has one partner besides, which is all that is found."""
    n = 50_000
    tokens = F.concat_ws(" ", F.lit("everywhere"), *[F.concat(F.lit(f"g{k}x"), F.floor(F.col("id") / 2)) for k in range(7)], F.concat(F.lit("own"), "id"))
    df = spark.range(n).select(F.col("id").alias("doc_id"), tokens.alias("text"))
    found = line_dedup.similar_lines(df)
    assert found.groupBy("kept", "links").count().orderBy("kept").collect() == [(False, 1, n // 2), (True, 0, n // 2)]
    assert found.where("not kept and match.at <> at - 1").count() == 0


def test_what_is_told_of_variants_follows_their_number(spark, monkeypatch):
    """All variants of a line are similar: what is staged on the way grows with the lines, not with their pairs, and no link is lost."""
    n, counts = 600, []
    line = [f"seldom{k}" for k in range(40)]
    rows = [(i, " ".join(line[: i % 40] + [f"own{i}"] + line[i % 40 :])) for i in range(n)]
    staged = line_dedup.staged

    def counted(df):
        found = staged(df)
        counts.append(found.count())
        return found

    monkeypatch.setattr(line_dedup, "staged", counted)
    found = line_dedup.similar_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert max(counts) < 20 * n
    assert sorted((r.at, r.links, r.kept) for r in found) == [(i, i, i == 0) for i in range(n)]
    assert all(r.kept or (r.match.at, r.match.line) == (0, 0) for r in found)


def test_what_a_task_sends_of_counts_follows_its_text():
    counts = np.zeros(line_dedup.CHUNK, np.uint32)
    assert line_dedup.packed_counts(counts) == b""
    counts[[0, 7, 4095]] = [1, 2**32 - 1, 9]
    packed = line_dedup.packed_counts(counts)
    places, times = line_dedup.unpacked_counts(packed)
    assert len(packed) == 18 and places.tolist() == [0, 7, 4095] and times.tolist() == [1, 2**32 - 1, 9]


def test_dedup_lines(odd, empty):
    found = line_dedup.dedup_lines(odd)
    assert found.columns == odd.columns
    texts = {r.doc_id: r.text for r in found.collect()}
    assert texts[9] == "line one of the text" and texts[3] is None and texts[5] == " \n\t "
    assert found.count() == len(ROWS) and line_dedup.dedup_lines(empty).count() == 0


# -- passages -------------------------------------------------------------------------------


def test_compact_windows():

    rng = np.random.default_rng(3)
    for _ in range(200):
        begins = np.r_[0, np.cumsum(rng.integers(0, 40, rng.integers(1, 5)))]
        values = rng.integers(1, rng.choice([5, 1000]), begins[-1]).astype(np.uint64)
        size = int(rng.integers(1, 12))
        expected = set()
        for low, high in zip(begins[:-1], begins[1:]):
            for c in range(low, high):
                left = right = c
                while left > low and values[left - 1] >= values[c]:
                    left -= 1
                while right < high - 1 and values[right + 1] >= values[c]:
                    right += 1
                if right - left + 1 >= size:
                    expected.add((left, c, right))
        assert set(zip(*[x.tolist() for x in substrings.compact_windows(values, begins, size)])) == expected


def check_passages(found, rows):
    texts = collections.defaultdict(set)
    for i, t in rows:
        texts[i].add(t)
    for r in found:
        one, two = (
            {brute_shingle for t in texts[i] for brute_shingle in brute.shingle_set(" ".join(brute.words(t)[b:e]))}
            for i, b, e in ((r.doc_id, r.begin_word, r.end_word), (r.other_id, r.other_begin, r.other_end))
        )
        assert r.end_word - r.begin_word >= 50 and abs(len(one & two) / len(one | two) - r.similarity) < 1e-9 and r.similarity >= 0.75
    owners = collections.defaultdict(set)
    for i, t in rows:
        w = brute.words(t)
        for k in range(len(w) - 49):
            owners[tuple(w[k : k + 50])].add(i)
    repeated = set().union(*[ids for ids in owners.values() if len(ids) > 1])
    assert repeated <= {r.doc_id for r in found}


def test_passages_given(docs):
    check_passages(substrings.repeated_passages(docs).collect(), rows_of(docs))


def test_passages_odd(odd, empty):
    rows = [(i, t) for i, t, *_ in ROWS if i is not None]
    found = substrings.repeated_passages(odd).collect()
    check_passages(found, rows)
    assert {r.doc_id for r in found} == {1, 2, 7, 8}
    assert substrings.repeated_passages(empty).count() == 0


def test_planted_passages(spark):
    """A passage of 55 words, exact or with two words changed, in otherwise unlike documents."""
    own = lambda i, n: [f"d{i}w{k}" for k in range(n)]
    passage = [f"p{k}" for k in range(55)]
    changed = ["q" if k in (20,) else w for k, w in enumerate(passage + [f"p{k}" for k in range(55, 80)])]
    rows = [(i, " ".join(own(i, 30 * i) + passage + own(i + 50, 70))) for i in range(6)]
    rows += [(i, " ".join(own(i, 300))) for i in range(10, 14)]
    rows += [(20, " ".join(own(20, 90) + changed)), (21, " ".join(own(21, 40) + passage + [f"p{k}" for k in range(55, 80)]))]
    found = substrings.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in found} == {*range(6), 20, 21}


@pytest.mark.parametrize("words", [50, 55, 60])
@pytest.mark.parametrize("insert", [True, False])
def test_passages_with_a_word_more_or_less(spark, words, insert):
    """A word more or one less in the middle of a short passage."""
    rows = []
    for i in range(20):
        one = [f"p{i}w{k}" for k in range(words + (0 if insert else 1))]
        two = one[: words // 2] + ["more"] * insert + one[words // 2 + (not insert) :]
        for k, passage in enumerate((one, two)):
            around = [[f"d{i}k{k}{c}{n}" for n in range(60)] for c in "ab"]
            rows.append((2 * i + k, " ".join(around[0] + passage + around[1])))
    found = substrings.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    pairs = {(r.doc_id, r.other_id) for r in found}
    # the chance of no equal min-hash is 0.0004 at most
    assert len(pairs & {(2 * i, 2 * i + 1) for i in range(20)}) >= 19
    check_passages(found, rows)


def test_passages_that_are_equal_to_a_covered_one(spark):
    """y is similar to the first document x; z repeats another stretch of y, whose shingles are all in x but apart."""
    own = lambda i, n: [f"d{i}w{k}" for k in range(n)]
    a, b = [f"a{k}" for k in range(60)], [f"b{k}" for k in range(60)]
    rows = [
        (1, " ".join(own(1, 40) + a + own(2, 40) + b[:36] + own(3, 40) + b[24:] + own(4, 40))),
        (2, " ".join(own(5, 40) + a + b + own(6, 40))),
        (3, " ".join(own(7, 40) + b + own(8, 40))),
        (4, " ".join(own(9, 40) + b + own(10, 40))),
    ]
    rows += [(10 + i, rows[1][1]) for i in range(3)]
    found = substrings.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    pairs = {(r.doc_id, r.other_id) for r in found}
    ids = [1, 2, 3, 4, 10, 11, 12]
    assert pairs == {(i, j) for i in ids for j in ids if i != j} - {(1, 3), (3, 1), (1, 4), (4, 1)}
    check_passages(found, rows)


def test_passages_repeated_inside_a_document(spark):
    """All places of a passage, also where the first is a quote too short for one."""
    own = lambda i, n: [f"d{i}w{k}" for k in range(n)]
    passage = [f"p{k}" for k in range(60)]
    rows = [(1, " ".join(own(1, 100) + passage + own(2, 90)))]
    rows += [(2, " ".join(own(3, 300) + passage + own(4, 200) + passage + own(5, 150) + passage + own(6, 20)))]
    rows += [(3, " ".join(own(7, 50) + passage[5:50] + own(8, 200) + passage + own(9, 100)))]
    found = substrings.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    places = {(r.doc_id, r.begin_word, r.other_id, r.other_begin) for r in found}
    starts = {1: [100], 2: [300, 560, 770], 3: [295]}
    expected = {(i, a, j, b) for i in starts for j in starts if i != j for a in starts[i] for b in starts[j]}
    assert expected <= places


# -- quality rules --------------------------------------------------------------------------


def test_quality_rules_odd(odd, empty):
    found = host_rules.quality_rules(odd)
    got = {r.doc_id: r for r in found.collect()}
    assert found.count() == len(ROWS) and "_doc" in found.columns
    assert got[3].n_words == 0 and got[3].base_failed and not got[3].kept
    assert got[1].n_repeat_words == 80 and got[1].base_failed
    assert got[9].n_dup_lines == 1 and got[10].n_symbols == 4 and got[10].word_chars == len(re.sub(r"\s", "", ROWS[-1][1]))
    assert not got[7].base_failed
    assert host_rules.quality_rules(empty).count() == 0


def test_hosts(spark):
    """A large bad host loses its good documents; a host of one bad document does not lose by it alone."""
    good, bad = " ".join(f"w{i}" for i in range(60)), "too short"
    rows = [(i, good, f"good{i % 8}") for i in range(800)] + [(1000 + i, bad if i % 10 else good, "bad") for i in range(100)]
    rows += [(2000, bad, "single"), (2001, good, None)]
    found = host_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    kept = {r.doc_id for r in found.where("kept").collect()}
    assert kept == {*range(800), 2001}
    hosts = {r.host: r for r in host_rules.judge_hosts(found.withColumnRenamed("source", "h"), "h").collect()}
    assert hosts["bad"].rejected and hosts["single"].rate < 1 and not hosts[None].rejected and hosts["bad"].n_too_short == 90


# -- mixing ---------------------------------------------------------------------------------


def test_mix_odd(odd, empty):
    plan = mixing.plan_mix(odd).collect()
    assert len(plan) == len(ROWS)
    sizes = collections.Counter()
    for _, t, _, s, _ in ROWS:
        sizes[s] += len(brute.words(t))
    expected = brute.targets(dict(sizes))
    taken = collections.Counter()
    for r in plan:
        assert abs(r.target - expected[r.source]) < 1e-6 * max(1, r.target) and r.source_size == sizes[r.source]
        assert 0 <= r.taken <= 3 * r.size and r.taken == sum(d.words for d in r.draws)
        taken[r.source] += r.taken
    assert all(abs(taken[s] - expected[s]) <= 1 for s in sizes)
    assert mixing.plan_mix(empty).count() == 0 and mixing.mix(empty).count() == 0
    mixed = mixing.mix(odd)
    assert {"shard", "place", "doc_id", "_row"} <= set(mixed.columns)
    words = collections.Counter()
    for r in mixed.collect():
        words[r.source] += len(brute.words(r.text))
    assert words == taken


def test_mix_given(docs):
    plan = mixing.plan_mix(docs, block_words=200)
    rows = plan.collect()
    sizes, taken = collections.Counter(), collections.Counter()
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
    expected = brute.targets(dict(sizes))
    assert all(abs(taken[s] - expected[s]) <= 1 for s in sizes)
    other = mixing.plan_mix(docs.repartition(7), block_words=200)
    key = lambda r: (r.doc_id, r.taken, tuple(map(tuple, r.draws)))
    assert sorted(map(key, rows)) == sorted(map(key, other.collect()))


def test_splitting_tree():
    """Quotas add up, shards are alike, and sources are spread as in a random permutation."""

    draws = [1000, 10, 0, 490]
    quotas = mixing.bundle_quotas(draws, 0, [sum(draws)], 12, 1)
    assert quotas.sum(axis=0).tolist() == draws and quotas.sum(axis=1).tolist() == [125] * 12
    assert np.std(quotas[:, 0]) < 12 and quotas[:, 0].min() > 60


def test_bundles_of_the_splitting_tree(spark, monkeypatch):
    """Bundles together give every draw, shards of equal numbers, and a source its share of each."""
    draws, bundles = [[600, 0, 3], [40], [700, 57]], [603, 40, 757]
    parts = [mixing.bundle_quotas(own, i, bundles, 8, 3) for i, own in enumerate(draws)]
    whole = np.hstack(parts)
    assert whole.sum(axis=0).tolist() == sum(draws, []) and whole.sum(axis=1).tolist() == [175] * 8
    assert abs(whole[:, 0] - 75).max() < 25
    rows = [(i, " ".join(["w"] * (1 + i % 7)), f"s{i % 60:02d}" if i % 11 else None) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    one = {r.doc_id: (r.taken, r.target) for r in mixing.plan_mix(df, block_words=20, shards=4).collect()}
    monkeypatch.setattr(mixing, "BUNDLE", 7)
    many = mixing.plan_mix(df.repartition(5), block_words=20, shards=4).collect()
    assert {r.doc_id: (r.taken, r.target) for r in many} == one
    drawn = collections.Counter(d.shard for r in many for d in r.draws)
    assert len(drawn) == 4 and min(drawn.values()) > 0.5 * max(drawn.values())


def test_more_sources_than_fit_a_bundle(spark):
    n = 10_001
    df = spark.range(n).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), 3).alias("text"), F.concat(F.lit("s"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("source"))
    found = mixing.plan_mix(df, shards=4)
    weights = [1 + i % 3 for i in range(n)]
    level = 3 * n / sum(weights)
    rows = found.orderBy("doc_id").collect()
    assert len(rows) == n and all(abs(r.target - min(9, level * w)) < 1e-6 for r, w in zip(rows, weights))
    assert all(abs(r.taken - r.target) < 1 for r in rows)


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 0, None: 5}, {"a": 1}, {}, {"a": 1, "b": 1000, "c": 1}, {"a": 0}, {f"{i:03d}": 3**i for i in range(20)}])
def test_targets(spark, sizes):
    df = spark.createDataFrame([(s, n // 2) for s, n in sizes.items()] + [(s, n - n // 2) for s, n in sizes.items()], "source string, size long")
    found = {r.source: r.target for r in mixing.source_targets(df).collect()}
    expected = brute.targets(sizes) if sizes else {}
    assert set(found) == set(expected) and all(abs(found[s] - t) <= 1e-9 * max(1, t) for s, t in expected.items())


def test_rows_are_numbered_apart(spark):
    rows = [(1, "a b c", "s")] * 5 + [(2, "d e f", "t")]
    mixed = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    words = mixed.groupBy("source").agg(F.sum(F.size(F.split("text", " "))).alias("n")).collect()
    assert {r.source: r.n for r in words} == {"s": 9, "t": 9}
