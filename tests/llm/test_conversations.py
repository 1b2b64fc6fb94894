"""Conversation repair against an exhaustive search and a plain rendering of its rules."""

import hashlib
import random
import re
import zlib
from functools import cache

import pytest

from tessera.llm import conversations
from tessera.llm.conversations import REFUSED, TRUNCATED, cheapest, damaged, joined, repaired

SCHEMA = "conv_id long, turn long, role string, text string, kind long, part string, audit string, present boolean"


def plain(codes, entry=0, exits=(0, 3)):
    """The least cost and audit over all edits, two insertions before a row at most."""
    after = [{0: 1, 1: 2}, {1: 2}, {2: 3}, {1: 2}]
    put = [2, 2, 3, 2]

    @cache
    def best(i, state, puts):
        found = [(0, "")] if i == len(codes) and state in exits else []
        options = []
        if puts < 2:
            options.append(("I", 2, put[state], i, puts + 1))
        if i < len(codes):
            options.append(("D", 3, state, i + 1, 0))
            if not codes[i] & REFUSED:
                cut = 1 if codes[i] & TRUNCATED else 0
                if codes[i] & 3 in after[state]:
                    options.append(("K", cut, after[state][codes[i] & 3], i + 1, 0))
                options.append(("R", 2 + cut, put[state], i + 1, 0))
        for letter, cost, state2, j, p in options:
            rest = best(j, state2, p)
            if rest is not None:
                found.append((cost + rest[0], letter + rest[1]))
        return min(found, default=None)

    return best(0, entry, 0)


def drawn(rng, n):
    return bytes(rng.choice([0, 1, 2, 1, 2, 3]) | rng.choice([0, 0, 0, TRUNCATED, REFUSED]) for _ in range(n))


def test_search_is_exhaustive():
    rng = random.Random(3)
    for n in [*range(8)] * 60 + [30, 60]:
        codes = drawn(rng, n)
        assert cheapest(codes) == plain(codes)
        for a in range(4):
            for b in range(4):
                if a <= b or b >= 2:
                    assert cheapest(codes, a, (b,)) == plain(codes, a, (b,)), (codes, a, b)


def test_runs_of_rows_join():
    rng = random.Random(4)
    ways = lambda codes: [
        {"entry": a, "exit": b, "cost": w[0], "audit": w[1]} for a in range(4) for b in range(4) if a <= b or b >= 2 for w in [cheapest(codes, a, (b,))] if w
    ]
    for _ in range(60):
        parts = [drawn(rng, rng.randint(1, 6)) for _ in range(3)]
        found = joined(joined(ways(parts[0]), ways(parts[1])), ways(parts[2]))
        assert min((w["cost"], w["audit"]) for w in found if w["entry"] == 0 and w["exit"] in (0, 3)) == plain(b"".join(parts))


def test_long_runs_end():
    for codes in (bytes([1]) * 1500, bytes([2, 1, 1, 3 | TRUNCATED]) * 300, bytes([0 | TRUNCATED]) * 800):
        cost, audit = cheapest(codes)
        assert sum(letter != "I" for letter in audit) == len(codes) and cost > 0


def expected(rows):
    """All result columns by the rules, row by row."""
    held = {}
    for conv, turn, role, text in rows:
        held.setdefault(conv, [])
        show = lambda x: " " if x is None else str(x)
        fate = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        role = "user" if fate == 4 else role
        held[conv] += [(turn, role, text)] * (2 if fate == 3 else 1)
    found = {}
    for conv, own in held.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256((r[1] + "\0" + r[2]).encode()).digest()))
        counts, seen, codes = {"blank": 0, "duplicate": 0, "truncated": 0}, set(), bytearray()
        for _, role, text in own:
            solid = re.sub(r"[\x20\x09-\x0D]", "", text)
            again = (role, text) in seen
            seen.add((role, text))
            fault = "blank" if not solid else "duplicate" if again else "truncated" if solid[-1] not in ".!?" else None
            if fault:
                counts[fault] += 1
            code = {"s": 0, "u": 1, "a": 2}.get(role[:1], 3)
            codes.append(code | (REFUSED if fault in ("blank", "duplicate") else TRUNCATED if fault else 0))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit = cheapest(bytes(codes))
        out, left, system = [], list(own), (len(audit) - audit.count("D")) % 2
        for letter in audit:
            row = left.pop(0) if letter != "I" else (None, None, "")
            if letter != "D":
                out.append((row[1] if letter == "K" else ("user", "assistant")[(len(out) - system) % 2], row[2]))
        text = "\n".join(f"{r}:{t}" for r, t in out)
        assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in out))
        found[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest(), text)
    return found


def odd_conversations():
    rng = random.Random(8)
    rows = [(1, None, None, None), (1, None, None, None), (2, 0, "user", "Hi."), (None, 1, "user", "No id."), (None, None, "assistant", None), (3, 5, "tool", "x" * 70000 + ".")]
    rows += [(4, t, "user", "same.") for t in range(40)] + [(5, 7, "", ""), (6, 1, "system", "a\n\t"), (7, 3, "user", "ünï\x00?")]
    for conv in range(10, 60):
        turns = [rng.choice([t, t, t, None, 3]) for t in range(rng.randint(0, 14))]
        rows += [(conv, t, rng.choice(["system", "user", "assistant", "assistant", "user", None, "other"]), rng.choice(["Yes.", "No!", "so", " ", "", "Why?", None, f"t{t}."])) for t in turns]
    rows += [(99, t, ("user", "assistant")[t % 2], f"turn {t % 50}.") for t in range(900)]
    return rows


@pytest.mark.parametrize("segment", [256, 7])
def test_conversations(spark, monkeypatch, segment):
    monkeypatch.setattr(conversations, "SEGMENT", segment)
    monkeypatch.setattr(conversations, "TOGETHER", 5)
    rows = odd_conversations()
    want = expected(rows)
    docs = spark.createDataFrame([(*r, 3, "x", None, False) for r in rows], SCHEMA).repartition(5)
    got = {}
    for r in repaired(damaged(docs), keep=True).collect():
        assert r.conv_id not in got
        got[r.conv_id] = (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256, r.repaired)
    assert got == want


def test_no_rows_left_and_no_table(spark):
    gone = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    (r,) = repaired(damaged(spark.createDataFrame([(1, gone, "user", "Hi.", 0, "", "", True)], SCHEMA))).collect()
    assert tuple(r) == (1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    found = repaired(damaged(spark.createDataFrame([], SCHEMA)))
    assert found.collect() == [] and found.columns[0] == "conv_id"
