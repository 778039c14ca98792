"""SimHash near-duplicates."""

import brute
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from kelpline.llm import simhash
from kelpline.llm.components import components


def plain_fingerprint(text):
    words = brute.words(text)
    if not words:
        return 0
    runs = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_pairs(codes, distance=3):
    codes = list(codes)
    array = np.array(codes, np.uint64)
    out = []
    for i, code in enumerate(codes):
        near = np.flatnonzero(np.bitwise_count(array[i + 1 :] ^ np.uint64(code)) <= distance) + i + 1
        out += [(code, codes[j]) for j in near]
    return out


def expected(rows):
    """(doc_id, text) rows to (doc_id, fingerprint, component) rows."""
    codes = [plain_fingerprint(t) for _, t in rows]
    ties = [(codes[i], codes[j]) for i in range(len(rows)) for j in range(i) if rows[i][0] is not None and rows[i][0] == rows[j][0]] if len(rows) < 100 else []
    root = brute.smallest(plain_pairs(sorted(set(codes))) + ties, set(codes))
    least = {}
    for (i, _), code in zip(rows, codes):
        if i is not None:
            least[root[code]] = min(i, least.get(root[code], i))
    return sorted(((i, f"{c:016x}", least.get(root[c])) for (i, _), c in zip(rows, codes)), key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_given_documents(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert found(simhash.simhash_groups(docs)) == expected(rows)


def test_odd_documents(spark, odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert found(simhash.simhash_groups(odd)) == expected(rows)
    assert simhash.simhash_groups(empty).count() == 0
    ties = [(1, "a b c d"), (1, "w x y z"), (5, "W X\ty z"), (3, "a b c d"), (None, "lone words here now"), (None, None), (8, "\v"), (7, "")]
    df = spark.createDataFrame(ties, "doc_id long, text string").withColumn("code", F.lit("x")).withColumn("component", F.lit(1))
    assert found(simhash.simhash_groups(df)) == expected(ties)


def test_fingerprints_of_long_texts(monkeypatch):
    rng = np.random.default_rng(1)
    words = [f"Wörd{i}" for i in rng.integers(0, 300, 3000)]
    text = "".join(w + s for w, s in zip(words, rng.choice([" ", "\n", "\t  ", "\r\n", "\x0b", "  "], 3000)))
    for stretch in (1, 7, 64, 5000, 1 << 20):
        monkeypatch.setattr(simhash, "STRETCH", stretch)
        for t in (text, text[:40], "one", "one two", "one two three", " ", "", "A  b　C d"):
            assert simhash.fingerprint(t.encode()) == plain_fingerprint(t)


def clustered(seed, centres, members, flips):
    """Codes within a few bits of some centres, in chains and clouds, beside random ones."""
    rng = np.random.default_rng(seed)
    out = set(rng.integers(0, 2**64, 500, np.uint64).tolist())
    for centre in rng.integers(0, 2**64, centres, np.uint64).tolist():
        for _ in range(members):
            code = centre
            for bit in rng.integers(0, 64, int(rng.integers(0, flips + 1))).tolist():
                code ^= 1 << bit
            out.add(code)
    return sorted(out)


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
@pytest.mark.parametrize("dense", [1, 20, 1024])
def test_every_link_counts(spark, distance, dense):
    """Components are those of all pairs within the distance, whether values are split or not."""
    codes = clustered(2, 3, 150, 4) + [0, 2**64 - 1, 2**63, 2**63 + 1, 7]
    codes = sorted(set(codes))
    df = spark.createDataFrame([(int(np.uint64(c).view(np.int64)),) for c in codes], "code long")
    edges = simhash.linked_codes(df, distance, dense)
    pairs = [tuple(np.array(e, np.int64).view(np.uint64).tolist()) for e in edges.collect()]
    assert all((a ^ b).bit_count() <= distance for a, b in pairs)
    assert brute.smallest(pairs, codes) == brute.smallest(plain_pairs(codes, distance), codes)
    with pytest.raises(ValueError):
        simhash.linked_codes(df, 4)


def test_large_groups_make_no_pairs(spark):
    """Thousands of fingerprints around one, all within reach of others: edges stay in proportion."""
    codes = clustered(4, 1, 6000, 3)
    df = spark.createDataFrame([(int(np.uint64(c).view(np.int64)),) for c in codes], "code long")
    edges = simhash.linked_codes(df).cache()
    assert edges.count() < 40 * len(codes)
    labels = {r.node: r.component for r in components(edges).collect()}
    pairs = plain_pairs(codes)
    assert len(pairs) > 50 * len(codes)
    signed = lambda c: int(np.uint64(c).view(np.int64))
    groups = brute.smallest(pairs, codes)
    assert len({labels.get(signed(c), c) for c in codes}) == len(set(groups.values()))
