"""The pipeline against plain versions of its stages, and the registered queries."""

import collections

import brute
import corpus_pipeline
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks.compare import compare, connect
from kelpline.llm import line_dedup, oracle, queries
from kelpline.llm.tables import DOCUMENT_COLUMNS, staged


def rules_pass(text):
    words = brute.words(text, fold=False)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {w for w, n in collections.Counter(windows).items() if n > 1}
    places = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
    return len(words) >= 50 and 100 * len(places) <= 50 * len(words)


def test_pipeline_against_plain_stages(spark, sf_dir, tokenizer):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plain = [r.asDict() for r in docs.collect()]
    (_, quality), (_, lines), (_, near), (_, mix), (_, tokens) = corpus_pipeline.STAGES

    docs = staged(quality(spark, docs, sf_dir))
    plain = [d for d in plain if rules_pass(d["text"])]
    same(docs, plain)

    docs = staged(lines(spark, docs, sf_dir))
    plain.sort(key=lambda d: d["doc_id"])
    told = brute.lines([(d["doc_id"], d["text"]) for d in plain])
    for d in plain:
        kept = []
        for n, line in enumerate(d["text"].split("\n")):
            _, first, earlier = told.get((d["doc_id"], n), (0, (d["doc_id"], n), ()))
            if first == (d["doc_id"], n) and not earlier:
                kept.append(line)
        d["text"] = "\n".join(kept)
        d["n_chars"] = len(d["text"])
    plain = [d for d in plain if brute.words(d["text"])]
    same(docs, plain)

    docs = staged(near(spark, docs, sf_dir))
    groups = brute.near_duplicates([(d["doc_id"], d["text"]) for d in plain])
    plain = [d for d in plain if groups[d["doc_id"]][1] == d["doc_id"]]
    same(docs, plain)

    docs = staged(mix(spark, docs, sf_dir))
    assert docs.columns == DOCUMENT_COLUMNS
    sizes = collections.Counter()
    for d in plain:
        sizes[d["source"]] += len(brute.words(d["text"]))
    taken, whole = collections.Counter(), {d["doc_id"]: d["text"] for d in plain}
    cut = collections.Counter()
    for r in docs.collect():
        words = brute.words(r.text, fold=False)
        taken[r.source] += len(words)
        assert r.n_chars == len(r.text)
        if r.text != whole[r.doc_id]:
            cut[r.source] += 1
            assert words == brute.words(whole[r.doc_id], fold=False)[: len(words)]
    assert all(abs(taken[s] - t) <= 1 for s, t in brute.targets(dict(sizes)).items()) and max(cut.values(), default=0) <= 1

    texts = collections.Counter((r.doc_id, r.text) for r in docs.collect())
    found = collections.Counter()
    for r in tokens(spark, docs, sf_dir).collect():
        assert r.ids == tokenizer.encode(r.text, add_special_tokens=False).ids and r.n_tokens == len(r.ids)
        found[r.doc_id, r.text] += 1
    assert found == texts


def same(docs, plain):
    assert docs.columns == DOCUMENT_COLUMNS
    assert sorted(tuple(r) for r in docs.collect()) == sorted(tuple(d[c] for c in DOCUMENT_COLUMNS) for d in plain)


def test_stages_take_odd_rows(spark, odd, empty, sf_dir):
    for docs in (odd, empty):
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            found = staged(stage(spark, docs, sf_dir))
            assert i == 4 or found.columns == DOCUMENT_COLUMNS
            assert docs is not empty or found.count() == 0


def test_near_duplicate_stage_keeps_one_row_of_a_document(spark, odd, sf_dir):
    found = corpus_pipeline.near_duplicates(spark, odd, sf_dir)
    ids = collections.Counter(r.doc_id for r in found.collect())
    assert ids[1] == 1 and ids[2] == 0 and ids[None] == 1 and max(ids.values()) == 1


def test_results_of_stages_stand_side_by_side(spark, odd, sf_dir):
    """No call takes away what the result of another reads."""
    for _, stage in corpus_pipeline.STAGES:
        one, two = stage(spark, odd, sf_dir), stage(spark, odd, sf_dir)
        assert one.count() == two.count() == one.count()


def test_stages_on_odd_rows(spark, odd, sf_dir):
    """What the docstrings state of nulls, empty texts, ties and repeated rows, against plain versions."""
    rows = [r.asDict() for r in odd.select(*DOCUMENT_COLUMNS).collect()]
    key = lambda d: (line_dedup.LAST if d["doc_id"] is None else d["doc_id"])
    kept = collections.Counter(r.doc_id for r in corpus_pipeline.quality(spark, odd, sf_dir).collect())
    assert not {d["doc_id"] for d in rows if not rules_pass(d["text"] or "")} & set(kept) and set(kept) <= {7, 8}

    told = brute.lines(sorted({(key(d), d["text"]) for d in rows}, key=lambda x: x[0]))
    expected = collections.Counter()
    for d in rows:
        lines = (d["text"] or "").split("\n")
        left = "\n".join(x for n, x in enumerate(lines) if (y := told.get((key(d), n))) is None or y[1] == (key(d), n) and not y[2])
        if brute.words(left):
            expected[d["doc_id"], left] += 1
    assert collections.Counter((r.doc_id, r.text) for r in corpus_pipeline.lines(spark, odd, sf_dir).collect()) == expected

    groups = brute.near_duplicates(list({(d["doc_id"], d["text"]) for d in rows if d["doc_id"] is not None}))
    near = collections.Counter((r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, odd, sf_dir).collect())
    assert near == collections.Counter({(d["doc_id"], d["text"]) for d in rows if d["doc_id"] is None or groups[d["doc_id"]][1] == d["doc_id"]})

    sizes = collections.Counter()
    for d in rows:
        sizes[d["source"]] += len(brute.words(d["text"], fold=False))
    taken = collections.Counter()
    for r in corpus_pipeline.mixed(spark, odd, sf_dir).collect():
        assert brute.words(r.text) and r.n_chars == len(r.text)
        taken[r.source] += len(brute.words(r.text, fold=False))
    targets = brute.targets(dict(sizes))
    assert all(abs(taken[s] - t) <= 1 for s, t in targets.items())

    tokens = [(r.doc_id, r.text, r.n_tokens) for r in corpus_pipeline.tokens(spark, odd, sf_dir).collect()]
    assert collections.Counter(t[:2] for t in tokens) == collections.Counter((d["doc_id"], d["text"] or "") for d in rows)
    assert all(n == 0 for _, text, n in tokens if not text)


def test_run(spark, sf_dir):
    assert entry.queries()["pipeline"](spark, sf_dir).where(F.col("n_tokens") > 0).count() > 0


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_sql(spark, sf_dir, name):
    assert compare(queries.queries()[name](spark, sf_dir), connect(sf_dir), oracle.oracle_sql()[name]) is None


def test_all_are_registered():
    found = entry.queries()
    assert "pipeline" in found
    for n in range(1, 14):
        assert len([q for q in found if q.startswith(f"op{n}_")]) == 1
