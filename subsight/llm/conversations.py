"""Repair of turn structure by alignment with the strings of a role grammar.

A conversation may be ``(s?(ua)+)?`` in role initials.  For a given length that
leaves one string per way to begin, so a repair is an alignment of the turns
with one of those strings: Keep, Rerole, Delete and Insert are the steps of
Wagner and Fischer's table.  Each feasible length is aligned in turn, nearest
first, inside the diagonals that the best cost so far allows (Ukkonen); lengths
whose own least cost exceeds it end the search.  Of all alignments of least
cost the ASCII-least audit is traced back, and the audits of equal lengths are
compared.

Long conversations are aligned in runs of ``RUN`` turns.  A run is aligned for
every state the grammar can be in before and after it; since an audit never is
the beginning of another one of equal cost, the least audit of the whole is put
together from the least of the parts.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import count, takewhile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Turns aligned together.
RUN = 16

DELETE, INSERT, REROLE, CUT_OFF = 3, 2, 2, 1
_NEVER = 1 << 40

#: Blanks of the contract.
BLANK = " \t\n\x0b\x0c\r"

# What has been written so far: nothing, "s", ends in "u", ends in "a".
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
_FULL_ROLE = {"u": "user", "a": "assistant"}


def _shift(extra: int) -> int:
    """Least cost of ``extra`` more target symbols than turns."""
    return INSERT * extra if extra > 0 else -DELETE * extra


def _target(family: str, length: int) -> str:
    """The grammar's string of a length: after a begun pair (A), a new one (U), or from the start (S)."""
    if family == "S":
        return "s" + ("ua" * length)[: length - 1]
    return ("ua" * length if family == "U" else "au" * length)[:length]


def align(turns: str, target: str, bound: int) -> tuple[int, str] | None:
    """Least cost and least audit that turn ``turns`` into ``target``, None if above ``bound``.

    ``turns`` has a letter per turn: x must go; u, a, s and o (any other) are
    role initials, in upper case where the text is cut off.  Cells outside the
    band cannot lie on a path within the bound.
    """
    n, m = len(turns), len(target)
    gone = [0]
    for letter in turns:
        gone.append(gone[-1] + (letter == "x"))
    end = m - (n - gone[n])
    slack = bound - DELETE * gone[n] - _shift(end)
    if slack < 0:
        return None
    # leaving the diagonals between 0 and ``end`` costs a Delete and an Insert per step
    low, high = min(0, end) - slack // (DELETE + INSERT), max(0, end) + slack // (DELETE + INSERT)
    left = [[_NEVER] * (m + 2) for _ in range(n + 1)]
    left[n][m] = 0
    for i in range(n, -1, -1):
        here = left[i]
        below = left[i + 1] if i < n else None
        letter = turns[i] if i < n else "x"
        cut = CUT_OFF if letter.isupper() else 0
        initial = letter.lower()
        middle = i - gone[i]
        for j in range(min(m, middle + high), max(0, middle + low) - 1, -1):
            best = here[j]
            if below is not None:
                best = min(best, below[j] + DELETE)
            if j < m:
                wanted = target[j]
                if wanted != "s":
                    best = min(best, here[j + 1] + INSERT)
                if initial == wanted:
                    best = min(best, below[j + 1] + cut)
                elif initial != "x" and wanted != "s":
                    best = min(best, below[j + 1] + cut + REROLE)
            here[j] = best
    total = left[0][0]
    if total > bound:
        return None
    audit, i, j = [], 0, 0
    while i < n or j < m:
        # in ASCII order of the steps
        rest = left[i][j]
        if i < n and left[i + 1][j] + DELETE == rest:
            audit.append("D")
            i += 1
        elif j < m and target[j] != "s" and left[i][j + 1] + INSERT == rest:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if turns[i].lower() == target[j] else "R")
            i, j = i + 1, j + 1
    return total, "".join(audit)


def _incumbent(turns: str, family: str, length: int) -> int | None:
    """Cost of a plain alignment: turns in order, then inserted ones; None if there is none."""
    if family == "S":
        first = next((i for i, letter in enumerate(turns) if letter in "sS"), None)
        if first is None:
            return None
        rest = turns[first + 1 :]
        cost = DELETE * first + (CUT_OFF if turns[first] == "S" else 0)
        return cost + _incumbent(rest, "U", max(length - 1, len(rest) + 1 - (len(rest) + length) % 2))
    cost, at, symbols = 0, 0, _target(family, max(length, len(turns)))
    for letter in turns:
        if letter == "x":
            cost += DELETE
        else:
            cost += (CUT_OFF if letter.isupper() else 0) + (REROLE if letter.lower() != symbols[at] else 0)
            at += 1
    return cost + INSERT * max(0, length - at)


def best_of_lengths(turns: str, family: str, first: int) -> tuple[int, str] | None:
    """Least cost and audit over the target lengths ``first``, ``first + 2``, ..."""
    held = sum(letter != "x" for letter in turns)
    nearest = max(first, held + (held - first) % 2)
    bound = _incumbent(turns, family, nearest)
    if bound is None:
        return None
    gone = DELETE * (len(turns) - held)
    above = takewhile(lambda m: gone + _shift(m - held) <= bound, count(nearest, 2))
    below = takewhile(lambda m: gone + _shift(m - held) <= bound, range(nearest - 2, first - 1, -2))
    best = None
    for length in sorted([*above, *below], key=lambda m: _shift(m - held)):
        if gone + _shift(length - held) > bound:
            break
        found = align(turns, _target(family, length), bound)
        if found is not None and (best is None or found < best):
            best, bound = found, found[0]
    return best


@lru_cache(maxsize=1 << 14)
def transfers(turns: str) -> tuple[tuple[int, int, int, str], ...]:
    """(state before, state after, cost, audit) of all ways through a run of turns."""
    nothing = (DELETE * len(turns), "D" * len(turns))
    odd, even = best_of_lengths(turns, "U", 1), best_of_lengths(turns, "U", 2)
    ways = {
        (EMPTY, EMPTY): [nothing],
        (EMPTY, USER): [odd, best_of_lengths(turns, "S", 2)],
        (EMPTY, ASSISTANT): [even, best_of_lengths(turns, "S", 3)],
        (EMPTY, SYSTEM): [best_of_lengths(turns, "S", 1)],
        (SYSTEM, SYSTEM): [nothing],
        (SYSTEM, USER): [odd],
        (SYSTEM, ASSISTANT): [even],
        (ASSISTANT, ASSISTANT): [nothing, even],
        (ASSISTANT, USER): [odd],
        (USER, USER): [nothing, best_of_lengths(turns, "A", 2)],
        (USER, ASSISTANT): [best_of_lengths(turns, "A", 1)],
    }
    least = {key: min((w for w in found if w), default=None) for key, found in ways.items()}
    return tuple((*key, *way) for key, way in least.items() if way)


def edits(
    audit: str, turns: list[tuple[str, str]], state: int
) -> Iterator[tuple[str, str, str]]:
    """Repaired (step, role, text) of (role, text) turns, from a state of the grammar."""
    at = 0
    for step in audit:
        role, text = ("", "") if step == "I" else turns[at]
        at += step != "I"
        if step == "D":
            continue
        symbol = role[:1] if step == "K" else "a" if state == USER else "u"
        state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[symbol]
        yield step, role if step == "K" else _FULL_ROLE[symbol], text


class _Path:
    """Cheapest way to a state: cost, the audit beyond the settled part, and its digest so far."""

    __slots__ = ("cost", "audit", "digest", "begun")

    def __init__(self, cost, audit, digest, begun):
        self.cost, self.audit, self.digest, self.begun = cost, audit, digest, begun

    def follow(self, way, turns) -> _Path:
        before, _, cost, audit = way
        digest, begun = self.digest.copy(), self.begun
        for _, role, text in edits(audit, turns, before):
            digest.update(f"{chr(10) if begun else ''}{role}:{text}".encode())
            begun = True
        return _Path(self.cost + cost, self.audit + audit, digest, begun)


class _Conversation:
    """One conversation, fed turn by turn; holds one run of turns and four paths."""

    def __init__(self, key):
        self.key = key
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.low = self.high = self.turn = None
        self.distinct = 0
        self.initial = None
        self.letters: list[str] = []
        self.turns: list[tuple[str, str]] = []
        self.settled: list[str] = []
        self.paths = {EMPTY: _Path(0, "", hashlib.sha256(), False)}

    def add(self, turn, role: str, text: str, repeated: bool) -> None:
        if len(self.turns) == RUN:
            self._pass_run(last=False)
        if turn is not None:
            if turn != self.turn:
                self.distinct += 1
            self.turn = turn
            self.low, self.high = turn if self.low is None else self.low, turn
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.counts["illegal"] += 1
        self.initial = initial
        letter = initial if initial and initial in "sua" else "o"
        held = text.rstrip(BLANK)
        if not held:
            self.counts["blank"] += 1
            letter = "x"
        elif repeated:
            self.counts["duplicate"] += 1
            letter = "x"
        elif held[-1] not in ".!?":
            self.counts["truncated"] += 1
            letter = letter.upper()
        self.letters.append(letter)
        self.turns.append((role, text))

    def _pass_run(self, last: bool) -> None:
        ways: dict[int, tuple] = {}
        for way in transfers("".join(self.letters)):
            before, after, cost, audit = way
            path = self.paths.get(before)
            if path is None or (last and after not in (EMPTY, ASSISTANT)):
                continue
            offer = (path.cost + cost, path.audit + audit, way)
            kept = ways.get(after)
            if kept is None or offer[:2] < kept[:2]:
                ways[after] = offer
        if last:
            least = min(ways, key=lambda s: ways[s][:2])
            ways = {least: ways[least]}
        self.paths = {s: self.paths[w[2][0]].follow(w[2], self.turns) for s, w in ways.items()}
        common = os.path.commonprefix([p.audit for p in self.paths.values()])
        if common:
            self.settled.append(common)
            for path in self.paths.values():
                path.audit = path.audit[len(common) :]
        self.letters, self.turns = [], []

    def row(self) -> tuple:
        self._pass_run(last=True)
        path = next(iter(self.paths.values()))
        gaps = self.high - self.low + 1 - self.distinct if self.distinct else 0
        audit = "".join([*self.settled, path.audit])
        return (self.key, gaps, *self.counts.values(), path.cost, audit, path.digest.hexdigest())


_COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
_TYPES = [pa.int64()] * 6 + [pa.string()] * 2
#: Finished conversations put into one Arrow batch.
_OUT = 2000


def turn_order() -> list[Column]:
    """Order of turns: by number, nulls first, then role and text, so that ties are settled."""
    return [F.col("_turn").asc_nulls_first(), F.col("_role"), F.col("_text")]


def _turns(rows: DataFrame, present: str | None) -> DataFrame:
    def text(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kept = F.coalesce(F.col(f"`{present}`"), F.lit(True)) if present else F.lit(True)
    return rows.select(
        F.col("conv_id").cast("bigint").alias("_conv"),
        F.col("turn").cast("bigint").alias("_turn"),
        text("role").alias("_role"),
        text("text").alias("_text"),
        kept.alias("_kept"),
    )


def audit_conversations(rows: DataFrame, present: str | None = None) -> DataFrame:
    """One row per ``conv_id``: faults, cost, audit and digest of the cheapest repair.

    ``rows`` has conv_id, turn, role and text; further columns are ignored.
    NULL role or text counts as one space.  NULL turns come first, equal turns
    are ordered by role and text, a NULL conv_id is a conversation of its own.
    Rows where the boolean ``present`` is false only witness that their
    conversation exists; one without other rows has zeros, an empty audit and
    the digest of an empty text.

    One shuffle by conversation.  Whether a turn repeats an earlier one is a
    window over (conversation, role, text), which that shuffle already serves
    and which spills.  The digest of a conversation is one sequential hash, so
    its turns pass through one task in order, ``RUN`` at a time; only its audit,
    which is returned, grows with it.
    """
    turns = _turns(rows, present)
    same = Window.partitionBy("_conv", "_kept", "_role", "_text").orderBy(F.col("_turn").asc_nulls_first())
    marked = (
        turns.repartition(F.col("_conv"))
        .withColumn("_again", F.row_number().over(same) > 1)
        .select("_conv", "_turn", "_role", "_text", "_kept", "_again")
        # of equal rows the first one comes first
        .sortWithinPartitions(F.col("_conv"), *turn_order(), F.col("_again"))
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, done = None, []
        for batch in batches:
            for key, turn, role, text, kept, again in zip(*[c.to_pylist() for c in batch.columns]):
                if current is None or current.key != key:
                    if current is not None:
                        done.append(current.row())
                    current = _Conversation(key)
                if kept:
                    current.add(turn, role, text, again)
            if len(done) >= _OUT:
                yield _batch(done)
                done = []
        if current is not None:
            done.append(current.row())
        yield _batch(done)

    schema = "conv_id bigint, " + ", ".join(f"{c} {'string' if t == pa.string() else 'bigint'}" for c, t in zip(_COLUMNS, _TYPES))
    return marked.mapInArrow(build, schema)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * (1 + len(_COLUMNS))
    arrays = [pa.array(c, t) for c, t in zip(columns, [pa.int64(), *_TYPES])]
    return pa.RecordBatch.from_arrays(arrays, names=["conv_id", *_COLUMNS])


def repaired_turns(rows: DataFrame, audits: DataFrame, present: str | None = None) -> DataFrame:
    """Rows of the repaired conversations: conv_id, position, step, role, text.

    ``audits`` is what :func:`audit_conversations` gives for ``rows``.  Every
    step of an audit becomes a row; turns are numbered in the same order and
    joined to the steps that use them.
    """
    order = Window.partitionBy("_conv").orderBy(*turn_order())
    numbered = _turns(rows, present).where("_kept").withColumn("_nth", F.row_number().over(order)).drop("_kept", "_turn")
    steps = audits.select(
        "conv_id", F.posexplode(F.split("audit", "")).alias("_at", "step")
    ).where("step <> ''")
    before = Window.partitionBy("conv_id").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    placed = steps.select(
        "conv_id",
        "step",
        F.count_if(F.col("step") != "I").over(before).alias("_used"),
        F.count_if(F.col("step") != "D").over(before).alias("position"),
    ).where("step <> 'D'")
    joined = placed.join(
        numbered, (F.col("step") != "I") & placed["conv_id"].eqNullSafe(F.col("_conv")) & (F.col("_used") == F.col("_nth")), "left"
    )
    # the grammar alternates: after an optional s, odd places are u
    first = Window.partitionBy("conv_id").orderBy("position").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    begins = F.first(F.when(F.col("step") == "K", F.substring("_role", 1, 1))).over(first) == "s"
    place = F.col("position") - F.when(F.coalesce(begins, F.lit(False)), 1).otherwise(0)
    given = F.when(place % 2 == 1, "user").otherwise("assistant")
    return joined.select(
        "conv_id",
        "position",
        "step",
        F.when(F.col("step") == "K", F.col("_role")).otherwise(given).alias("role"),
        F.coalesce("_text", F.lit("")).alias("text"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """Turns damaged by rule, by the CRC-32 of ``conv_id:turn`` modulo 20.

    0 drops the row (``present`` is false), 1 empties the text, 2 removes its
    sentence ends, 3 repeats the row, 4 makes it a user turn.  NULLs count as
    one space.
    """
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    text = F.coalesce(F.col("text"), F.lit(" "))
    fault = F.col("_fault")
    return (
        rows.select("conv_id", "turn", "role", text.alias("text"), (F.crc32(key) % 20).alias("_fault"))
        .withColumn("_copy", F.explode(F.when(fault == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
        .select(
            "conv_id",
            "turn",
            F.when(fault == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
            F.when(fault == 1, "").when(fault == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
            (fault != 0).alias("present"),
        )
    )
