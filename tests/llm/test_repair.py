"""Conversation repair against a search from the right over whole strings."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from consult.llm import repair
from consult.llm.catalog import QUERIES
from tests.conftest import SF_MID, SF_SMALL

SCHEMA = "conv_id long, turn long, role string, text string, conv string, pos string, seg string, audit string"
AFTER = {"": "user", "s": "user", "u": "assistant", "a": "user"}


def damaged(rows):
    """Rows after damage, in order, per conversation."""
    convs = defaultdict(list)
    for c, t, r, x in rows:
        own = convs[c]
        h = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        if h:
            x = "" if h == 1 else re.sub("[.!?]", "", x) if h == 2 else x
            own += [(t, "user" if h == 4 else r, x)] * (1 + (h == 3))
    for own in convs.values():
        own.sort(key=lambda q: (q[0] is not None, q[0] or 0, q[1].encode(), q[2].encode()))
    return convs


def faults_of(own):
    seen, out = set(), []
    for _, r, x in own:
        last = re.findall(r"[^\x20\x09-\x0D]", x)
        out.append("b" if not last else "d" if (r, x) in seen else "t" if last[-1] not in ".!?" else "")
        seen.add((r, x))
    return out


def cheapest(initials, faults):
    """(cost, audit), least of all: suffixes by dynamic programming from the right, at most two inserts in a place."""
    n, best = len(initials), {}
    for i in range(n, -1, -1):
        for held in (2, 1, 0):
            for state in AFTER:
                ways = [(0, "")] if i == n and state in ("", "a") else []
                steps = [(2, "I", i, AFTER[state][0], held + 1)] if held < 2 else []
                if i < n:
                    steps.append((3, "D", i + 1, state, 0))
                    if faults[i] not in ("b", "d"):
                        extra = int(faults[i] == "t")
                        if initials[i] and state + initials[i] in ("s", "u", "su", "ua", "au"):
                            steps.append((extra, "K", i + 1, initials[i], 0))
                        steps.append((2 + extra, "R", i + 1, AFTER[state][0], 0))
                ways += [(cost + best[j, s, k][0], edit + best[j, s, k][1]) for cost, edit, j, s, k in steps if (j, s, k) in best]
                if ways:
                    best[i, state, held] = min(ways)
    return best[0, "", 0]


def brute_repair(rows):
    out = {}
    for c, own in damaged(rows).items():
        faults, initials = faults_of(own), [r[:1] for _, r, _ in own]
        cost, audit = cheapest(initials, faults)
        text, state, left = [], "", iter(own)
        for e in audit:
            _, role, said = next(left) if e != "I" else (None, "", "")
            if e != "D":
                role = role if e == "K" else AFTER[state]
                text.append(f"{role}:{said}")
                state = role[0]
        turns = {t for t, _, _ in own if t is not None}
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        out[c] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("b"), faults.count("d"), faults.count("t"), illegal,
                  cost, audit, hashlib.sha256("\n".join(text).encode()).hexdigest())
    return out


def repaired(spark, rows):
    df = spark.createDataFrame([(*r, "c", "p", "s", "a") for r in rows], SCHEMA)
    return {r[0]: tuple(r)[1:] for r in repair.repair(repair.damage(df), df.select(F.col("conv_id").alias("conv"))).collect()}


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_op13_by_brute_force(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert {r[0]: tuple(r)[1:] for r in QUERIES["op13_conversation_repair"](spark, sf).collect()} == brute_repair(rows)


@pytest.mark.parametrize("segment", [2048, 7, 1])
def test_hot_conversation_in_many_segments(spark, monkeypatch, segment):
    """One conversation holds a third of the rows; null ids, turns, roles and texts; odd roles; repeats."""
    monkeypatch.setattr(repair, "SEGMENT", segment)
    rng = random.Random(4)
    rows = [(rng.choice([None, 1, 1, 1, 1, *range(2, 12)]), rng.choice([None, *range(200)]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""]),
             rng.choice([None, "", "ok.", "hm", "a! \t", "yes?", f"x{rng.randrange(500)}.", "  "])) for _ in range(900 if segment > 1 else 250)]
    assert repaired(spark, rows) == brute_repair(rows)


def test_edges(spark):
    """A text of a million characters, equal rows, a conversation that loses all rows, an empty table."""
    gone = next((c, t) for c in range(100) for t in range(100) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    rows = [(5000, t, "user" if t % 2 == 0 else "assistant", "long text. " * 100_000 + str(t)) for t in range(3)] + [(6000, 1, "user", "same.")] * 4 + [(*gone, "user", "only.")]
    got = repaired(spark, rows)
    assert got == brute_repair(rows) and got[gone[0]] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert repaired(spark, []) == {}


def test_least_audit_by_all_edits():
    """Every edit sequence of short conversations: cost first, then the ASCII-least audit."""
    def every(initials, faults, state=""):
        if not initials:
            if state in ("", "a"):
                yield 0, ""
            yield from ((c, e) for c, e in ((2, "I"), (4, "II")) if {1: state == "u", 2: state in ("", "s")}[len(e)])
            return
        for k in range(3):
            at = state
            for _ in range(k):
                at = AFTER[at][0]
            x, f = initials[0], faults[0]
            ways = [(3, "D", at)]
            if f not in (repair.BLANK, repair.DUPLICATE):
                extra = int(f == repair.TRUNCATED)
                ways += [(extra, "K", x)] * (at + x in ("s", "u", "su", "ua", "au")) + [(2 + extra, "R", AFTER[at][0])]
            for cost, e, to in ways:
                yield from ((2 * k + cost + c, "I" * k + e + rest) for c, rest in every(initials[1:], faults[1:], to))
    rng = random.Random(9)
    for _ in range(150):
        n = rng.randrange(6)
        initials, faults = [rng.choice("suaxt") for _ in range(n)], [rng.choice((0, 0, 0, 1, 2, 3)) for _ in range(n)]
        ways = repair.segment_audits(list(zip(initials, faults, strict=True)), repair.NOTHING, True)
        assert min((c, a) for s, c, a in ways if s in (repair.NOTHING, repair.ASSISTANT)) == min(every(initials, faults))


def test_trails_compare_as_strings_even_if_hashes_collide(monkeypatch):
    for mod in ((1 << 61) - 1, 3):
        monkeypatch.setattr(repair, "_MOD", mod)
        rng, trail, said = random.Random(2), repair.Trail(), {0: ""}
        for _ in range(400):
            parent = rng.choice(sorted(said)[-30:])
            piece = "".join(rng.choice("DIK") for _ in range(rng.choice((1, 1, 3))))
            said[trail.add(parent, piece)] = said[parent] + piece
        for _ in range(3000):
            a, b = rng.choice(list(said)), rng.choice(list(said))
            assert trail.less(a, b) == (said[a] < said[b])
