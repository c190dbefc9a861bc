"""Conversation repair against a search over whole audits, and the query against plain Python."""

from __future__ import annotations

import collections
import functools
import hashlib
import itertools
import random
import re
import zlib

import pytest
import xxhash
from pyspark.sql import types as T

import __spark_entry__ as registry
from netdays.llm import conversations

SF = "/root/testdata/sf0.001"
BLANK = re.compile(r"[^\x20\x09-\x0D]")


def plain_order(rows):
    """Rows ``(turn, role, text)`` by turn, nulls first; ties as the operator states them."""
    def signed(t):
        h = xxhash.xxh64_intdigest(t.encode(), seed=42)
        return h - (1 << 64) if h >> 63 else h

    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], signed(r[2]), r[2]))


def plain_faults(rows):
    seen, found = set(), []
    for _, role, text in rows:
        signs = BLANK.findall(text)
        if not signs:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        elif signs[-1] not in ".!?":
            found.append("truncated")
        else:
            found.append(None)
        seen.add((role, text))
    return found


def plain_repair(rows, faults):
    """``(cost, audit)`` by search over all edits, and the repaired rows."""
    def after(state, role):
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}.get((state, role))

    @functools.cache
    def best(i, state, inserted):
        options = [(0, "")] if i == len(rows) and state in ("", "a") else []
        if inserted < 2:
            for role in "ua":
                if after(state, role):
                    cost, audit = best(i, after(state, role), inserted + 1)
                    options.append((cost + 5, "I" + audit))
        if i < len(rows):
            cost, audit = best(i + 1, state, 0)
            options.append((cost + 2, "D" + audit))
            if faults[i] not in ("blank", "duplicate"):
                extra = 5 if faults[i] == "truncated" else 0
                if after(state, rows[i][1][:1]):
                    cost, audit = best(i + 1, after(state, rows[i][1][:1]), 0)
                    options.append((cost + extra, "K" + audit))
                for role in "ua":
                    if after(state, role):
                        cost, audit = best(i + 1, after(state, role), 0)
                        options.append((cost + 1 + extra, "R" + audit))
        return min(options, default=(10**9, "~"))

    cost, audit = best(0, "", 0)
    state, i, lines = "", 0, []
    for letter in audit:
        fitting = "a" if state == "u" else "u"
        name = {"u": "user", "a": "assistant"}[fitting]
        if letter == "I":
            lines.append(f"{name}:")
            state = fitting
            continue
        _, role, text = rows[i]
        i += 1
        if letter == "K":
            state = role[0]
            lines.append(f"{role}:{text}")
        elif letter == "R":
            state = fitting
            lines.append(f"{name}:{text}")
    assert state in ("", "a") and i == len(rows)
    return cost, audit, lines


def expected(originals, rows):
    by_id = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        by_id[conv].append((turn, role, text))
    found = {}
    for conv in originals:
        turns = plain_order(by_id[conv])
        faults = plain_faults(turns)
        known = {t for t, _, _ in turns if t is not None}
        pairs = itertools.pairwise((r[1][:1] for r in turns))
        cost, audit, lines = plain_repair(turns, faults)
        found[conv] = (
            max(known) - min(known) + 1 - len(known) if known else 0, *(faults.count(k) for k in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return found


def got(report):
    rows = report.collect()
    table = {r["conv_id"]: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in rows}
    assert len(table) == len(rows)
    return table


SCHEMA = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()), T.StructField("place", T.StringType()), T.StructField("chunk", T.StringType()),
])


@pytest.fixture(scope="module")
def table(llm):
    return lambda rows: llm.createDataFrame([(*r, "x", None) for r in rows], SCHEMA)


def conversation(chance, conv, length):
    roles = ["user", "assistant", "system", "tool", "", None, "u", "User"]
    texts = ["Yes.", "No!", "", " \t", "and then", "Well?  ", None, "ä…", "Fine.\n"]
    weights = [6, 6, 2, 1, 1, 1, 1, 1]
    rows = []
    for turn in range(length):
        text = chance.choice(texts) if chance.random() < 0.4 else f"Turn {turn}{chance.choice(['.', '!', '', '?'])}"
        rows.append((conv, chance.choice([turn, turn + 1, turn, turn, None]) if chance.random() < 0.2 else turn, chance.choices(roles, weights)[0], text))
    return rows


@pytest.mark.parametrize("chunk", [3, 4096])
def test_random_conversations(llm, table, chunk):
    chance = random.Random(13)
    rows = [r for conv in range(150) for r in conversation(chance, conv, chance.randint(1, 9))]
    rows += conversation(chance, None, 6) + conversation(chance, 1000, 60) + [(1001, None, "user", "Hi.")]
    ids = {r[0] for r in rows}
    assert got(conversations.report(table(rows), table(rows), chunk)) == expected(ids, rows)


def test_repaired_rows(llm, table):
    chance = random.Random(7)
    rows = [r for conv in range(60) for r in conversation(chance, conv, chance.randint(1, 8))]
    found = conversations.repair(table(rows), 5)
    turns = collections.defaultdict(list)
    for r in found and conversations.repaired(found).collect():
        turns[r["conv"]].append((r["place"], r["slot"], r["edit"], r["role"], r["text"]))
    wanted = expected({r[0] for r in rows}, rows)
    for conv, values in wanted.items():
        held = sorted(turns[f"={conv}"], key=lambda r: r[:2])
        assert "".join(r[2] for r in held) == values[6]
        body = "\n".join(f"{r[3]}:{r[4]}" for r in held if r[2] != "D")
        assert hashlib.sha256(body.encode()).hexdigest() == values[7]


def test_empty_tables(llm, table):
    assert conversations.report(table([]), table([])).collect() == []
    nothing = hashlib.sha256(b"").hexdigest()
    assert got(conversations.report(table([(5, 1, "user", "Hi.")]), table([]))) == {5: (0, 0, 0, 0, 0, 0, "", nothing)}


def test_far_turns_and_long_texts(llm, table):
    rows = [(1, -2**63, "user", "x" * 200_000 + "."), (1, 2**63 - 2, "assistant", "y" * 200_000 + "!"), (2, 3, "system", "S."), (2, 9, "user", "x")]
    found = got(conversations.report(table(rows), table(rows)))
    assert found[1][5:7] == (0, "KK") and found[1][0] == 0
    assert found[2] == expected({2}, rows)[2]


def plain_damage(rows):
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        draw = zlib.crc32(key.encode()) % 20
        if draw == 0:
            continue
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        for _ in range(2 if draw == 3 else 1):
            yield conv, turn, "user" if draw == 4 else role, text


def test_query(llm):
    rows = [tuple(r) for r in llm.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = registry.queries()["op13_conversation_repair"](llm, SF)
    assert found.columns[0] == "conv_id"
    assert got(found) == expected({r[0] for r in rows}, list(plain_damage(rows)))
