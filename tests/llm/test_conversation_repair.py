"""Conversation repair against an exhaustive search over edits, and against plain Python."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from tidegrid.llm import conversation_repair as cr
from tidegrid.llm.catalog import op12_conversation_repair

SF = "/root/testdata/sf0.001"
GOOD = re.compile(r"(s?(ua)+)?")
BLANK = re.compile(r"[^\x20\x09-\x0D]")


def exhaustive(rows):
    """Cheapest (cost, letters) over every script with at most two inserts between rows; rows: (initial, must go, truncated)."""
    best = None
    gaps = [["", *("".join(p) for n in (1, 2) for p in itertools.product("ua", repeat=n))]] * (len(rows) + 1)
    choices = []
    for initial, gone, cut in rows:
        more = 3 if cut else 0
        some = [("D", "", 4)]
        if not gone:
            some += [("K", initial, more), ("R", "u", 3 + more), ("R", "a", 3 + more)]
        choices.append(some)
    for edits in itertools.product(*choices):
        base = sum(e[2] for e in edits)
        if best and base > best[0]:
            continue
        for filled in itertools.product(*gaps):
            cost = base + 3 * sum(map(len, filled))
            if best and cost > best[0]:
                continue
            roles = "".join(f + e[1] for f, e in zip(filled, edits)) + filled[-1]
            if GOOD.fullmatch(roles):
                audit = "".join("I" * len(f) + e[0] for f, e in zip(filled, edits)) + "I" * len(filled[-1])
                # inserts may stand on either side of a deleted row
                best = min(best or (cost, audit), (cost, audit))
    return best


def code(initial, gone, cut):
    if gone:
        return "x"
    initial = initial if initial in ("s", "u", "a") else "-"
    return {"-": "+"}.get(initial, initial.upper()) if cut else initial


def test_search_finds_what_trying_everything_finds():
    random.seed(7)
    for _ in range(250):
        rows = [(random.choice("ssuuaat"), random.random() < 0.2, random.random() < 0.25) for _ in range(random.randint(0, 4))]
        assert cr.cheapest([code(*r) for r in rows]) == exhaustive(rows), rows


def test_long_conversations_end():
    random.seed(2)
    for make in (lambda: random.choice("suaSUA-+x"), lambda: "s", lambda: "x", lambda: "A"):
        codes = [make() for _ in range(3000)]
        cost, audit = cr.cheapest(codes)
        assert cost == cr.suffix_bounds(codes)[0][0] and len(audit) >= len(codes)


def plain(rows):
    """The contract in plain Python over (conv_id, turn, role, text) rows."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = []
        for c, turn, role, text in rows:
            if c != conv:
                continue
            role, text = " " if role is None else role, " " if text is None else text
            key = ":".join(" " if x is None else str(x) for x in (c, turn))
            part = zlib.crc32(key.encode()) % 20
            if part == 0:
                continue
            if part == 1:
                text = ""
            if part == 2:
                text = re.sub("[.!?]", "", text)
            if part == 4:
                role = "user"
            mine += [(turn, role, text)] * (2 if part == 3 else 1)
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(f"{r[1]}\0{r[2]}".encode()).digest()))
        seen, codes, faults = set(), [], [0, 0, 0]
        for _, role, text in mine:
            last = BLANK.findall(text)
            fault = 0 if not last else 1 if (role, text) in seen else 2 if last[-1] not in ".!?" else None
            if fault is not None:
                faults[fault] += 1
            seen.add((role, text))
            codes.append(code(role[:1], fault in (0, 1), fault == 2))
        turns = [t for t, _, _ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, audit = cr.cheapest(codes)
        told, at, last = [], iter(mine), ""
        for letter in audit:
            row = next(at) if letter != "I" else None
            if letter == "D":
                continue
            wanted = "assistant" if last == "u" else "user"
            role = row[1] if letter == "K" else wanted
            told.append(f"{role}:{row[2] if row else ''}")
            last = role[:1]
        assert GOOD.fullmatch("".join(t[0] for t in told))
        out[conv] = (gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(told).encode()).hexdigest())
    return out


NAMES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def told(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    plans, repaired = cr.repair(cr.damaged(df), df.select("conv_id"))
    sums = {r["conv_id"]: r["repaired_sha256"] for r in cr.checksums(repaired).collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    return {r["conv_id"]: (*[r[n] for n in NAMES[:-1]], sums.get(r["conv_id"], nothing)) for r in plans.collect()}


def test_nulls_ties_repeats_blanks_and_long_texts(spark):
    random.seed(11)
    texts = ["Yes.", "no", "", " \t", None, "Ends?  \n", "a.b", "é!", "x" * 100_000 + "."]
    rows = [
        (random.choice([None, *range(40)]), random.choice([None, *range(6), 90]), random.choice(["user", "assistant", "system", "tool", "", None]), random.choice(texts))
        for _ in range(500)
    ]
    rows += rows[:30]
    assert told(spark, rows) == plain(rows)


def test_no_rows_and_clashing_names(spark):
    assert told(spark, []) == {}
    df = spark.createDataFrame([(1, 0, "user", "Hi.", 5, "z")], "conv_id long, turn long, role string, text string, AUDIT long, _kind string")
    plans, repaired = cr.repair(df, df)
    assert plans.head()["audit"] == "KI" and [r["role"] for r in repaired.collect()] == ["user", "assistant"]


def test_query_over_the_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r["conv_id"]: tuple(r[n] for n in NAMES) for r in op12_conversation_repair(spark, SF).collect()}
    assert got == plain(rows)


@pytest.mark.parametrize("copies", [3000])
def test_a_hot_conversation(spark, copies):
    rows = [(7, i, "user" if i % 2 == 0 else "assistant", f"Row {i % 50}.") for i in range(copies)]
    assert told(spark, rows) == plain(rows)
