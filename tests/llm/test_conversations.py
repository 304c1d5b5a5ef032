from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from conftest import SF_DIR
from pricing_audit.llm import auction, conversations
from pricing_audit.llm.queries import QUERIES

SPACE = " \t\n\x0b\f\r"
SCHEMA = "conv_id long, turn long, role string, text string, audit string, pos int"


def all_repairs(codes, insertions):
    """Least (cost, letters) over every sequence of edits with at most so many insertions."""
    best = None

    def go(i, cost, letters, spelled, left):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if i == len(codes) and re.fullmatch(r"(s?(ua)+)?", spelled):
            best = (cost, letters) if best is None else min(best, (cost, letters))
        if left:
            for r in "ua":
                go(i, cost + 5, letters + "I", spelled + r, left - 1)
        if i < len(codes):
            own, fault = divmod(codes[i], 3)
            go(i + 1, cost + 2, letters + "D", spelled, left)
            if fault != 1:
                more = 5 if fault == 2 else 0
                go(i + 1, cost + more, letters + "K", spelled + "suax"[own], left)
                for r in "ua":
                    go(i + 1, cost + more + 1, letters + "R", spelled + r, left)

    go(0, 0, "", "", insertions)
    return best


def by_table(codes):
    """Least (cost, letters) by the recurrence over suffixes."""
    best = None
    for i in range(len(codes), -1, -1):
        now = []
        for s in range(4):
            ways = [(0, "")] if i == len(codes) and s in (0, 3) else []
            if i < len(codes):
                own, fault = divmod(codes[i], 3)
                steps = [(2, "D", s)]
                if fault != 1:
                    more = 5 if fault == 2 else 0
                    kept = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (2, 2): 3, (3, 1): 2}.get((s, own))
                    steps += [(more, "K", kept)] if kept is not None else []
                    steps += [(more + 1, "R", 3 if s == 2 else 2)]
                ways += [(c + best[t][0], x + best[t][1]) for c, x, t in steps]
            now.append(min(ways, default=(10**9, "")))
        for _ in range(3):
            for s in range(4):
                c, x = now[3 if s == 2 else 2]
                now[s] = min(now[s], (c + 5, "I" + x))
        best = now
    return best[0]


def random_codes(rng, n):
    often = rng.random()
    return bytes(rng.randrange(12) if rng.random() < often else rng.choice([0, 3, 6]) for _ in range(n))


def test_auction_equals_all_repairs():
    rng = random.Random(1)
    for _ in range(500):
        codes = random_codes(rng, rng.randint(0, 4))
        lattice = auction.Lattice(codes)
        assert (lattice.distance(0), lattice.repair(0)[0]) == all_repairs(codes, 3)


def test_auction_equals_table_of_suffixes():
    rng = random.Random(2)
    for _ in range(300):
        codes = random_codes(rng, rng.randint(0, 80))
        lattice = auction.Lattice(codes)
        assert (lattice.distance(0), lattice.repair(0)[0]) == by_table(codes)


def test_prices_are_feasible_and_tight_on_the_repair():
    codes = random_codes(random.Random(3), 200)
    lattice = auction.Lattice(codes)
    for node in range(4 * len(codes)):
        row, state = divmod(node, 4)
        for _, cost, step in auction.ARCS[codes[row]][state]:
            assert lattice.price[node] <= cost + lattice.price[node + step]


def plain_rows(table):
    out = []
    for conv, turn, role, text in table:
        say = lambda x: " " if x is None else str(x)
        fate = zlib.crc32(f"{say(conv)}:{say(turn)}".encode()) % 20
        role, text = say(role), say(text)
        if fate == 0:
            continue
        if fate == 1:
            text = ""
        if fate == 2:
            text = re.sub("[.!?]", "", text)
        if fate == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if fate == 3 else 1)
    return out


def plain(table, damaged=plain_rows):
    rows = damaged(table)
    result = {}
    for conv in {r[0] for r in table}:
        own = sorted((t is not None, t or 0, r, x) for c, t, r, x in rows if c == conv)
        turns = [t for known, t, _, _ in own if known]
        faults, codes, seen = [], [], set()
        for _, _, role, text in own:
            bare = text.strip(SPACE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else (
                "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
            faults.append(fault)
            number = {"s": 0, "u": 1, "a": 2}.get(role[:1], 3)
            codes.append(3 * number + {"": 0, "truncated": 2}.get(fault, 1))
        first = [r[:1] for _, _, r, _ in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:], strict=False))
        cost, letters = by_table(codes)
        lines, at, state = [], 0, 0
        for letter in letters:
            forced = {0: "user", 1: "user", 2: "assistant", 3: "user"}[state]
            if letter == "I":
                lines.append(f"{forced}:")
            else:
                _, _, role, text = own[at]
                at += 1
                if letter == "D":
                    continue
                forced = role if letter == "K" else forced
                lines.append(f"{forced}:{text}")
            state = {"s": 1, "u": 2, "a": 3}[forced[0]]
        result[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, letters,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return result


def random_table(rng, n):
    table = []
    for conv in range(n):
        for turn in range(rng.randint(1, 12)):
            role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", "", None, "ux", "su"])
            if rng.random() < 0.6:
                role = ["user", "assistant"][turn % 2]
            text = rng.choice(["Hello there.", "same text!", "cut off", " \n", None, f"own {rng.random()}?", "é.\x0b"])
            table.append((conv, rng.choice([turn] * 8 + [None, turn + 3]), role, text))
    table += [(None, t, "user", f"text {t}.") for t in range(5)] + [(None, None, None, None)] * 3
    return table + [(2**60 + 1, None, "user", "x.")] * 2


@pytest.mark.parametrize("block", [3, 1000])
def test_equals_plain(spark, monkeypatch, block):
    monkeypatch.setattr(conversations, "BLOCK", block)
    table = random_table(random.Random(5), 120)
    df = spark.createDataFrame([(*r, "x", 1) for r in table], SCHEMA).repartition(6)
    got = {r.conv_id: tuple(r)[1:] for r in conversations.repair_table(df).collect()}
    assert got == plain(table)


def test_one_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(conversations, "BLOCK", 500)
    rng = random.Random(6)
    table = [
        (7, t, rng.choice(["user", "assistant", "user", "assistant", "system"]), rng.choice(["", "a.", f"{t}.", f"{t}!", "b"]))
        for t in range(6000)
    ] + [(c, 0, "user", "Hello.") for c in range(50)] + [(c, 1, "assistant", "Hi.") for c in range(50)]
    rng.shuffle(table)
    df = spark.createDataFrame([(*r, "x", 1) for r in table], SCHEMA)
    got = {r.conv_id: tuple(r)[1:] for r in conversations.repair_table(df).collect()}
    assert got == plain(table)


def test_repaired_rows(spark):
    table = random_table(random.Random(8), 60)
    spaced = lambda rows: [(c, t, r or " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    expect = plain(table, spaced)
    rows = conversations.repaired(spark.createDataFrame([(*r, "x", 1) for r in table], SCHEMA)).collect()
    lines = {}
    for r in sorted(rows, key=lambda r: r.place):
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
        assert (r.edit == "I") <= (r.text == "")
    for conv, e in expect.items():
        assert hashlib.sha256("\n".join(lines.get(conv, [])).encode()).hexdigest() == e[-1]


def test_whole_table(spark):
    table = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r)[1:] for r in QUERIES["op13_conversation_repair"](spark, SF_DIR).collect()}
    assert got == plain(table)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert conversations.repair_table(empty).count() == 0
    assert conversations.repaired(empty).count() == 0
