import hashlib
import random
import re
import zlib
from heapq import heappop, heappush

import duckdb
import pandas as pd
import pytest

from tallyrill.llm import repair as P
from tallyrill.llm.store import FileStore

SCHEMA = "conv_id long, turn long, role string, text string, step long, fault string"


def damaged(rows):
    """Each row of a list of (conv, turn, role, text) with its fault made."""
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        plain = [" " if x is None else str(x) for x in (conv, turn)]
        fault = zlib.crc32(":".join(plain).encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        out += [(conv, turn, role, text)] * (2 if fault == 3 else 1)
    return out


def cheapest(rows):
    """The cheapest edits by a search over whole strings of initials, least cost and least string first."""
    legal = re.compile(r"s?(ua)*u?\Z")
    queue, done = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, i, roles, kept = heappop(queue)
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit, kept
        state = (i, roles[-1:], len(roles) > 0)
        if state in done:
            continue
        done.add(state)
        ways = [(5, "I", i, r[0], r, "") for r in ("user", "assistant")]
        if i < len(rows):
            role, text, fault = rows[i]
            ways.append((2, "D", i + 1, "", None, None))
            if fault not in ("blank", "duplicate"):
                cut = 5 if fault == "truncated" else 0
                ways.append((cut, "K", i + 1, role[:1], role, text))
                ways += [(1 + cut, "R", i + 1, r[0], r, text) for r in ("user", "assistant")]
        for price, letter, following, initial, role, text in ways:
            if letter == "K" and initial == "" or not legal.match(roles + initial):
                continue
            more = kept if role is None else (*kept, f"{role}:{text}")
            heappush(queue, (cost + price, audit + letter, following, roles + initial, more))
    raise AssertionError


def brute(rows):
    """The row of every conversation, as the contract says."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = [r[1:] for r in damaged([r for r in rows if r[0] == conv])]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        faults, seen = [], set()
        for _, role, text in own:
            shown = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append("blank" if not shown else "duplicate" if (role, text) in seen
                          else "truncated" if shown[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = {t for t, _, _ in own if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        initials = [role[:1] for _, role, _ in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, kept = cheapest([(r, t, f) for (_, r, t), f in zip(own, faults)])
        out[conv] = (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit,
                     hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


def mended(spark, rows):
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    steps = P.repair(P.damage(frame), FileStore.fresh(spark, "test"), present="present")
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    found = P.audits(steps).collect()
    assert len(found) == len({r["conv_id"] for r in found})
    return {r["conv_id"]: tuple(r[n] for n in names) for r in found}


@pytest.fixture(scope="module")
def rows():
    pick = random.Random(8)
    out = []
    for conv in [*range(150), None]:
        turn = 0
        for _ in range(pick.randint(1, 8)):
            role = pick.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = pick.choice(["Yes.", "No!", "cut off", "a. b", " ", "", None, "Well?\n \t", "x. "])
            out.append((conv, pick.choice([turn, turn, None, turn - 1]), role, text))
            turn += pick.choice([1, 1, 2])
    return out


def test_like_brute_force(spark, rows):
    assert mended(spark, rows) == brute(rows)


def test_sql_like_brute_force(rows):
    frame = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"})
    with duckdb.connect() as db:
        db.register("conversations", frame)
        found = db.sql(P.ORACLE).fetchall()
    assert {r[0]: r[1:] for r in found} == brute(rows)


def test_batches_and_spilled_rows_change_nothing(spark, rows, monkeypatch):
    monkeypatch.setattr(P, "HELD_ROWS", 3)
    monkeypatch.setattr(P, "_BATCH", 2)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        # The setting must reach the tasks, so the conversation is read here.
        store = FileStore.fresh(spark, "spill")
        held = P._Conversation(1, store)
        own = [("user", "Hello."), ("assistant", "Yes."), ("assistant", "Yes."), ("tool", "cut"), ("user", "So?")] * 5
        for role, text in reversed(own):
            held.add(1, role, text, 0)
        assert len(held.files) == 8
        plain = P._Conversation(1, store)
        monkeypatch.setattr(P, "HELD_ROWS", 1000)
        for role, text in reversed(own):
            plain.add(1, role, text, 0)
        assert list(held.steps()) == list(plain.steps()) and held.summary() == plain.summary()
        assert mended(spark, rows) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_a_conversation_without_rows_after_damage(spark):
    lost = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert mended(spark, [(lost, 0, "user", "Hi.")]) == {lost: (0, 0, 0, 0, 0, 0, "", empty)}


def test_steps_hold_what_stays(spark):
    rows = spark.createDataFrame(
        [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hi."), (1, 2, "user", ""), (1, 3, "user", "Go on.")],
        "c long, t long, r string, x string")
    steps = P.repair(rows, FileStore.fresh(spark, "test"), conv_id="c", turn="t", role="r", text="x").where("step > 0")
    got = [(r["edit"], r["role"], r["text"]) for r in steps.collect()]
    assert got == [("K", "system", "Be kind."), ("R", "user", "Hi."), ("D", None, None), ("R", "assistant", "Go on.")]


def test_text_ids_and_no_rows(spark):
    rows = spark.createDataFrame([("a", 1, "user", "Hi."), ("b", 1, "user", "Ho.")], "conv_id string, turn int, role string, text string")
    steps = P.repair(rows, FileStore.fresh(spark, "test"))
    assert {r["conv_id"]: r["audit"] for r in P.audits(steps).collect()} == {"a": "D", "b": "D"}
    assert P.audits(P.repair(rows.where("false"), FileStore.fresh(spark, "test"))).count() == 0


def test_a_long_conversation(spark, monkeypatch):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"Text {i}." * 3) for i in range(60_000)]
    steps = P.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), FileStore.fresh(spark, "long"))
    row = P.audits(steps).collect()[0]
    assert (row["audit"], row["cost"], row["gaps"]) == ("K" * 60_000, 0, 0)
    text = "\n".join(f"{r}:{t}" for _, _, r, t in rows)
    assert row["repaired_sha256"] == hashlib.sha256(text.encode()).hexdigest()
