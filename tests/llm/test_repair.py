"""Conversation repair against every possible edit, and split conversations against whole ones."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from layerwright.llm import repair

WHITE = " \t\n\v\f\r"


def _damaged(rows):
    """Rows (conv_id, turn, role, text) after damage, in order."""
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def _faults(rows):
    seen, out = set(), []
    for role, text in rows:
        bare = text.strip(WHITE)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def _brute(rows):
    """Cheapest audit of a few rows (role, text) by trying all, and the turns it leaves."""
    faults, best = _faults(rows), None
    for edits in itertools.product("KRD", repeat=len(rows)):
        if any(f in ("blank", "duplicate") and e != "D" for f, e in zip(faults, edits, strict=True)):
            continue
        base = sum({"K": 0, "R": 2, "D": 3}[e] + (f == "truncated" and e != "D") for f, e in zip(faults, edits, strict=True))
        for gaps in itertools.product(range(3), repeat=len(rows) + 1):
            cost = base + 2 * sum(gaps)
            if best and cost > best[0]:
                continue
            audit = "I" * gaps[0] + "".join(e + "I" * g for e, g in zip(edits, gaps[1:], strict=True))
            if best and (cost, audit) >= best[:2]:
                continue
            initials = [r[:1] or "-" for (r, _), e in zip(rows, edits, strict=True) if e == "K"]
            start = 1 if initials and re.sub("[ID]", "", audit)[:1] == "K" and initials[0] == "s" and not audit.split("K")[0].strip("D") else 0
            slots, turns, queue = 0, [], list(rows)
            legal = True
            for e in audit:
                role, text = queue.pop(0) if e != "I" else ("", "")
                if e == "D":
                    continue
                want = "s" if start and not turns else "ua"[slots % 2]
                slots += want != "s"
                if e == "K" and role[:1] != want:
                    legal = False
                    break
                turns.append((role if e == "K" else {"u": "user", "a": "assistant"}[want], text))
            if legal and slots % 2 == 0 and (slots or not turns):
                best = (cost, audit, turns)
    return best


def _facts(rows):
    """All facts of rows (turn, role, text) that the brute force does not give."""
    faults = _faults([r[1:] for r in rows])
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(rows)]
    return {"gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
            "illegal": sum(p not in ("su", "ua", "au") for p in pairs)}


def _digest(turns):
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()


TEXTS = ["Yes.", "No!", "cut", " \t", "", "Why? ", "ö…", "."]


def test_every_edit():
    rng = random.Random(5)
    for _ in range(400):
        n = rng.randrange(5)
        rows = [(i, rng.choice(["user", "assistant", "system", "user", "assistant", "", "tool", "s"]), rng.choice(TEXTS)) for i in range(n)]
        got, turns = repair.repair_rows(rows, True)
        cost, audit, want = _brute([r[1:] for r in rows])
        assert (got["cost"], got["audit"]) == (cost, audit), rows
        assert [t[1:] for t in turns] == want and got["repaired_sha256"] == _digest(want)
        assert {k: got[k] for k in ("gaps", "blank", "duplicate", "truncated", "illegal")} == _facts(rows)


def test_memory_stays_bounded():
    search = repair.Survivors()
    most = 0
    for i in range(5000):
        search.row("ua"[i % 2] if i % 97 else "s", "truncated" if i % 5 == 0 else "")
        search.taken()
        most = max(most, max(len(search.suffix(s)) for s in search.best))
    assert most < 20


def _table(rng, convs=60):
    rows = []
    for conv in [*range(convs), None, 7]:
        for turn in range(rng.randrange(9)):
            rows.append((conv, None if rng.random() < 0.05 else turn + (rng.random() < 0.1), rng.choice(["user", "assistant", "system", None, "tool"]),
                         rng.choice([*TEXTS, None, "Same.", f"Text {rng.randrange(9)}."])))
    rows += [(3, t, "ua"[t % 2] + "ser", rng.choice(TEXTS + [f"{t}."])) for t in range(10, 900)]
    return rows + [(5, 5, "user", "again.")] * 300


def _expected(rows):
    by = {}
    for r in rows:
        by.setdefault(r[0], [])
    for conv, turn, role, text in _damaged(rows):
        by[conv].append((turn, role, text))
    return by


@pytest.mark.parametrize(("parts", "block"), [(1, 4096), (9, 4096), (9, 7)])
def test_split_conversations(spark, monkeypatch, parts, block):
    monkeypatch.setattr(repair, "BLOCK", block)
    rows = _table(random.Random(parts + block))
    # rows of one turn have no order of their own here: give every turn of a conversation one row
    rows = list({(r[0], r[1]): r for r in rows}.values())
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, gone string").repartition(3)
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        got = {r.conv_id: r for r in repair.repair(repair.damage(df)).collect()}
        turns = repair.repaired_turns(repair.damage(df)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", True)
    expected = _expected(rows)
    assert got.keys() == expected.keys()
    for conv, own in expected.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        facts, made = repair.repair_rows(own, True)
        assert {k: got[conv][k] for k in facts} == facts, conv
        assert sorted((r.number, r.role, r.text) for r in turns if r.conv_id == conv) == sorted(made)
        if len(own) < 5:
            assert (facts["cost"], facts["audit"]) == _brute([r[1:] for r in own])[:2]


def test_equal_rows_lie_in_several_slices(spark):
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        rows = [(1, 1, "user", "again.")] * 500 + [(2, None, None, None)]
        got = {r.conv_id: r for r in repair.repair(repair.as_they_are(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string"))).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", True)
    assert got[1].duplicate == 499 and got[1].illegal == 499 and got[1].gaps == 0
    # keeping the one turn costs an answer, 2; the others go
    assert got[1].cost == 499 * 3 + 2 and got[1].audit == "K" + "D" * 499 + "I"
    assert got[2].blank == 1 and got[2].audit == "D" and got[2].repaired_sha256 == hashlib.sha256(b"").hexdigest()


def test_no_rows(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.repair(repair.damage(empty)).collect() == []
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    (row,) = repair.repair(repair.damage(spark.createDataFrame([(gone, 1, "user", "x")], empty.schema))).collect()
    assert row[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
