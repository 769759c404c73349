import hashlib
import itertools
import random
import zlib

import pytest
from llm_rows import by_id

from subsight.llm import conversations as cv

TURNS = "conv_id bigint, turn bigint, role string, text string"


def cheapest(letters):
    """Least (cost, audit) by a walk over the grammar's states, without alignments."""

    def offer(states, state, cost, audit):
        if state not in states or (cost, audit) < states[state]:
            states[state] = (cost, audit)

    def with_inserts(states):
        for _ in range(2):
            for before, after in ((0, 2), (1, 2), (3, 2), (2, 3)):
                if before in states:
                    offer(states, after, states[before][0] + 2, states[before][1] + "I")
        return states

    states = with_inserts({0: (0, "")})
    for letter in letters:
        after = {}
        for state, (cost, audit) in states.items():
            offer(after, state, cost + 3, audit + "D")
            if letter == "x":
                continue
            cut = letter.isupper()
            if state == 0 and letter in "sS":
                offer(after, 1, cost + cut, audit + "K")
            wanted, reached = ("a", 3) if state == 2 else ("u", 2)
            kept = letter.lower() == wanted
            offer(after, reached, cost + cut + (0 if kept else 2), audit + ("K" if kept else "R"))
        states = with_inserts(after)
    return min(states[s] for s in (0, 3) if s in states)


def by_runs(letters, size):
    paths = {cv.EMPTY: (0, "")}
    for at in range(0, max(len(letters), 1), size):
        after = {}
        for before, state, cost, audit in cv.transfers(letters[at : at + size]):
            if before in paths:
                way = (paths[before][0] + cost, paths[before][1] + audit)
                after[state] = min(after.get(state, way), way)
        paths = after
    return min(paths[s] for s in (cv.EMPTY, cv.ASSISTANT) if s in paths)


def test_alignment_is_cheapest_and_least():
    for letters in itertools.chain.from_iterable(itertools.product("xuasoUAS", repeat=n) for n in range(4)):
        letters = "".join(letters)
        assert by_runs(letters, 8) == cheapest(letters), letters
    chance = random.Random(1)
    for _ in range(300):
        letters = "".join(chance.choice("xuasoUASuauaua") for _ in range(chance.randint(0, 20)))
        assert by_runs(letters, 32) == by_runs(letters, 5) == cheapest(letters), letters


def test_band_does_not_lose_the_best():
    for letters in ("uauax", "aaaa", "xxxx", "sSuaUa"):
        for family, first in (("U", 1), ("U", 2), ("A", 1), ("A", 2), ("S", 1), ("S", 2)):
            found = cv.best_of_lengths(letters, family, first)
            every = [cv.align(letters, cv._target(family, m), 10**6) for m in range(first, len(letters) + 7, 2)]
            least = min((e for e in every if e and e[0] < 10**6), default=None)
            assert found == least, (letters, family, first)


def plain_audit(rows):
    """The contract, read literally, for one conversation of (turn, role, text) after damage."""
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, letters, faults = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in ordered:
        held = text.strip(cv.BLANK)
        letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
        if not held:
            faults["blank"] += 1
            letter = "x"
        elif (role, text) in seen:
            faults["duplicate"] += 1
            letter = "x"
        elif held[-1] not in ".!?":
            faults["truncated"] += 1
            letter = letter.upper()
        seen.add((role, text))
        letters.append(letter)
    cost, audit = cheapest("".join(letters))
    lines, at, last = [], 0, None
    for step in audit:
        role, text = ("", "") if step == "I" else ordered[at][1:]
        at += step != "I"
        if step != "D":
            if step != "K":
                role = "assistant" if last == "u" else "user"
            last = role[:1]
            lines.append(f"{role}:{text}")
    turns = [t for t, _, _ in ordered if t is not None]
    pairs = zip(ordered, ordered[1:])
    return dict(
        gaps=max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        **faults,
        illegal=sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairs),
        cost=cost,
        audit=audit,
        repaired_sha256=hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    ), lines


def odd_conversations():
    chance = random.Random(7)
    texts = ["Yes.", "No", " \t", "", "Ça va ?", "x" * 3000 + ".", "end.\x85", "a ", None]
    rows = []
    for conv in [*range(40), None]:
        size = chance.choice([0, 1, 2, 3, 5, 8, 70])
        for turn in range(size):
            turn = chance.choice([turn, turn, turn, None, 2 * turn, 1])
            rows.append((conv, turn, chance.choice(["user", "assistant", "system", "", None, "unknown", "User", "tool"]), chance.choice(texts)))
    return rows


def test_equals_the_contract(spark):
    rows = odd_conversations()
    table = spark.createDataFrame(rows, TURNS).repartition(3)
    audits = cv.audit_conversations(table)
    found = by_id(audits, "conv_id")
    assert set(found) == {r[0] for r in rows} and audits.count() == len(found)
    repaired = {}
    for r in cv.repaired_turns(table, audits).orderBy("position").collect():
        repaired.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    for conv, row in found.items():
        own = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv]
        wanted, lines = plain_audit(own)
        assert {k: row[k] for k in wanted} == wanted, conv
        assert repaired.get(conv, []) == lines, conv


def test_damage_rule_and_dropped_conversations(spark):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", "One. Two! Three?") for c in range(200) for t in range(2)]
    damaged = cv.damaged(spark.createDataFrame(rows, TURNS + "").selectExpr("*", "'z' AS present", "1 AS _fault"))
    kinds = {(c, t): zlib.crc32(f"{c}:{t}".encode()) % 20 for c, t, _, _ in rows}
    held = {}
    for r in damaged.collect():
        held.setdefault((r["conv_id"], r["turn"]), []).append((r["role"], r["text"], r["present"]))
    for (c, t), kind in kinds.items():
        role = "user" if t % 2 == 0 or kind == 4 else "assistant"
        text = {1: "", 2: "One Two Three"}.get(kind, "One. Two! Three?")
        assert held[c, t] == [(role, text, kind != 0)] * (2 if kind == 3 else 1)
    gone = next(c for c in range(200) if kinds[c, 0] == 0)
    only = spark.createDataFrame([(gone, 0, "user", "x.")], TURNS)
    row = cv.audit_conversations(cv.damaged(only), "present").collect()
    assert [tuple(r) for r in row] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_empty_table(spark):
    nothing = spark.createDataFrame([], TURNS)
    assert cv.audit_conversations(cv.damaged(nothing), "present").collect() == []
    assert cv.repaired_turns(nothing, cv.audit_conversations(nothing)).collect() == []


@pytest.mark.parametrize("size", [16, 17, 1000])
def test_long_conversations_are_taken_in_runs(spark, size):
    chance = random.Random(size)
    rows = [(1, t, chance.choice(["user", "assistant"]), chance.choice([f"{t}.", f"{t}", ""])) for t in range(size)]
    row = cv.audit_conversations(spark.createDataFrame(rows, TURNS)).collect()[0]
    wanted, _ = plain_audit([r[1:] for r in rows])
    assert {k: row[k] for k in wanted} == wanted
