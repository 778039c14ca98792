"""Repair of conversations."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from kelpline.llm import conversation_repair as cr
from kelpline.llm import queries
from kelpline.session import setting

LEGAL = re.compile("(s?(ua)+)?")


def faults(rows):
    """(turn, role, text) in order to the first fault of each."""
    seen, out = set(), []
    for _, role, text in rows:
        last = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[-1] not in ".!?" else None
        seen.add((role, text))
        out.append(fault)
    return out


def every_repair(rows, found):
    """All audits with up to two insertions at a place, as (cost, audit, turns)."""
    gaps = list(itertools.product([(), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")], repeat=len(rows) + 1))
    edits = []
    for (_, role, text), fault in zip(rows, found):
        own = [(4, "D", None)]
        if fault not in ("blank", "duplicate"):
            extra = 3 if fault else 0
            own += [(extra, "K", (role, text)), (3 + extra, "R", ("user", text)), (3 + extra, "R", ("assistant", text))]
        edits.append(own)
    for chosen in itertools.product(*edits):
        for inserted in gaps:
            cost, audit, turns = 0, "", []
            for place, extra in enumerate(inserted):
                cost += 3 * len(extra)
                audit += "I" * len(extra)
                turns += [(role, "") for role in extra]
                if place < len(chosen):
                    cost, audit = cost + chosen[place][0], audit + chosen[place][1]
                    turns += [chosen[place][2]] if chosen[place][2] else []
            if LEGAL.fullmatch("".join(role[:1] or "-" for role, _ in turns)):
                yield cost, audit, turns


def plain(rows):
    """The best repair by a table of (cost, audit) for every row and state, insertions anywhere."""
    found = faults(rows)
    step = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    best = {"": (0, "", ())}

    def put(table, state, offer):
        if state not in table or offer[:2] < table[state][:2]:
            table[state] = offer

    def insert(table):
        for _ in range(3):
            for state, (cost, audit, turns) in list(table.items()):
                for role in ("user", "assistant"):
                    if role[0] in step[state]:
                        put(table, step[state][role[0]], (cost + 3, audit + "I", (*turns, (role, ""))))

    insert(best)
    for (_, role, text), fault in zip(rows, found):
        after = {}
        for state, (cost, audit, turns) in best.items():
            put(after, state, (cost + 4, audit + "D", turns))
            if fault not in ("blank", "duplicate"):
                paid = cost + (3 if fault else 0)
                if role[:1] in step[state]:
                    put(after, step[state][role[:1]], (paid, audit + "K", (*turns, (role, text))))
                for new in ("user", "assistant"):
                    if new[0] in step[state]:
                        put(after, step[state][new[0]], (paid + 3, audit + "R", (*turns, (new, text))))
        insert(after)
        best = after
    return found, min(best[s] for s in ("", "a") if s in best)


def digest(turns):
    return hashlib.sha256("\n".join(f"{role}:{text}" for role, text in turns).encode()).hexdigest()


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def summary(rows):
    rows = in_order(rows)
    found, (cost, audit, turns) = plain(rows)
    known = {t for t, _, _ in rows if t is not None}
    gaps = max(known) - min(known) + 1 - len(known) if known else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    counts = [found.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest(turns))


def grouped(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    return out


def found_by(edits):
    rows = cr.summarize(edits).collect()
    assert len(rows) == len({r.key for r in rows})
    return {r.conv_id: tuple(r)[2:] for r in rows}


def generated(seed, conversations, most):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "why", "What?", "", " \n", "Yes.", "so", "end. ", "three é.", "It is.\n"]
    rows = []
    for conv in range(conversations):
        n = rng.randint(1, most)
        role = lambda i: rng.choice(["user", "assistant", "system", "tool", "", "agent", None]) if rng.random() < 0.3 else ("user", "assistant")[i % 2]
        rows += [(conv, rng.choice([None, i, i, i + 3]), role(i), rng.choice(texts) if rng.random() < 0.5 else f"text {rng.randint(0, 99)}.") for i in range(n)]
    rng.shuffle(rows)
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


def test_every_audit():
    rng = random.Random(3)
    for _ in range(150):
        rows = [(i, rng.choice(["user", "assistant", "system", "tool", ""]), rng.choice(["a.", "b", "", "c!", "b"])) for i in range(rng.randint(0, 3))]
        found = faults(rows)
        best = min(every_repair(rows, found), key=lambda x: x[:2])
        codes = bytes(4 * cr.FAULTS.index(f) + cr.INITIALS.get(r[1][:1], 0) for r, f in zip(rows, found))
        assert cr.audit(codes) == best[1]
        assert plain(rows)[1][:2] == best[:2] and list(plain(rows)[1][2]) == best[2]


def test_generated_conversations(spark):
    rows = generated(1, 200, 12) + generated(2, 4, 400)
    expected = {c: summary(r) for c, r in grouped(rows).items()}
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found_by(cr.repair(df)) == expected


@pytest.mark.parametrize("most", [1, 7, 40])
def test_long_conversations_in_segments(spark, most):
    """With segments of a few rows and a few bytes the result is the same."""
    rows = generated(5, 8, 150) + [(None, 1, "user", "Hi."), (None, 1, "user", "Hi."), (None, None, "system", "s.")]
    expected = {c: summary(r) for c, r in grouped(rows).items()}
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert found_by(cr.repair(df, long_rows=most)) == expected
    assert found_by(cr.repair(df, long_rows=10**6, long_bytes=60)) == expected


def test_hot_conversation_is_cut(spark):
    """One conversation holds nearly all rows: its text goes to many tasks, and to segments of a bounded size."""
    rows = [(1, i, ("user", "assistant")[i % 2] if i % 11 else "tool", f"text {i % 900}.") for i in range(4000)] + [(2, 0, "user", "Hi.")]
    df = spark.createDataFrame(rows, SCHEMA)
    with setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        edits = cr.repair(df, long_rows=100)
    parts = edits.where("conv_id = 1 and edit <> 'I'").groupBy("part", "seq").count().collect()
    assert max(p["count"] for p in parts) <= 100 and len({p["part"] for p in parts}) > 1
    assert found_by(edits) == {c: summary(r) for c, r in grouped(rows).items()}


def test_time_grows_with_the_length():
    codes = bytes(random.Random(1).choices([1, 2, 3, 2, 3, 0, 6, 7, 8, 13], k=200_000))
    audit = cr.audit(codes)
    assert len(audit.replace("I", "")) == len(codes)
    assert len(cr.Rows._forward) < 20_000 and len(cr.Rows._backward) < 20_000
    # the first rows of a repair that can be cut there are those of the whole
    rows = cr.Rows(codes[:3000])
    last = cr.last_state(rows)
    assert len("".join(e for _, _, e in cr.crossings(rows, cr.START, last)).replace("I", "")) == 3000


def test_odd_rows(spark):
    rows = [
        (None, None, None, None), (None, 3, "user", "Hi."), (1, None, "user", "a."), (1, None, "user", "a."), (2, 5, "", "x"), (2, 5, "é", "x."),
        (3, 1, "user", "long " * 50_000 + "."), (3, 2, "assistant", "end of it"), (4, 9, "user", ""), (5, -2, "system", "s."), (5, 2**40, "user", "u."),
        (6, 1, "user", "\U0001f600."), (6, 2, "assistant", "a"), (7, -(2**63), "user", "a."), (7, 2**63 - 1, "assistant", "b."),
    ]
    clashes = ["key", "part", "seq", "place", "edit", "fault", "was", "id", "_first", "n", "size", "own", "state"]
    df = spark.createDataFrame([(*r, *"x" * len(clashes)) for r in rows], SCHEMA + "".join(f", {c} string" for c in clashes))
    expected = {c: summary(r) for c, r in grouped(rows).items()}
    expected[7] = (None, *expected[7][1:])
    assert found_by(cr.repair(df)) == expected
    assert found_by(cr.repair(df, long_rows=1)) == expected
    assert cr.repair(df.where("false")).count() == 0 and cr.summarize(cr.repair(df.where("false"))).count() == 0
    kept = cr.repair(df).where("edit <> 'D' and conv_id = 6").orderBy("place").collect()
    assert [(k.role, k.text) for k in kept] == [("user", "\U0001f600."), ("assistant", "a")]


def broken(rows):
    """The damage, row by row."""
    for conv, turn, role, text in rows:
        shown = [" " if x is None else str(x) for x in (conv, turn)]
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(":".join(shown).encode()) % 20
        row = (conv, turn, "user" if fate == 4 else role, "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text)
        yield from [] if fate == 0 else [row] * (2 if fate == 3 else 1)


def test_given_conversations(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    expected = {c: summary(r) for c, r in grouped(list(broken(rows))).items()}
    nothing = (0,) * 6 + ("", hashlib.sha256().hexdigest())
    expected = {c: expected.get(c, nothing) for c in {r[0] for r in rows}}
    assert {r.conv_id: tuple(r)[1:] for r in queries.op12(spark, sf_dir).collect()} == expected


def test_damage(spark):
    rows = generated(9, 300, 9) + [(None, None, None, None), (None, 4, "user", None)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("_fate", F.lit("x"))
    count = lambda rows: sorted(rows, key=str)
    assert count(tuple(r) for r in cr.damaged(df).collect()) == count(broken(rows))
