"""Check SQL of the conversation repair, by a table over grammar states instead of alignments.

One recursion step per turn keeps, for each of the four grammar states, the
least (cost, audit, repaired lines).
"""

#: CRC-32 of a text column ``s``: a table of 256 values, then one step per byte.
CRC_TABLE = """crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: xor(c >> 1, (c & 1) * 3988292384))) AS tab)"""


def crc32(text: str) -> str:
    """Needs ``crc_table`` in the FROM clause."""
    digits = f"hex(encode({text}))"
    octets = f"list_transform(range(1, len({digits}), 2), lambda i: ('0x' || ({digits})[i:i + 1])::BIGINT)"
    step = "lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {octets}), {step}), 4294967295::BIGINT)"


def _way(state: str, cost: str, step: str, line: str | None = None) -> str:
    lines = f"{state}.l" if line is None else f"list_append({state}.l, {line})"
    return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{step}', 'l': {lines}}} END"


def _least(*ways: str) -> str:
    return f"list_min([{', '.join(ways)}])"


def _taken(state: str, initial: str, role: str) -> str:
    """Keep or Rerole the turn out of a state."""
    keep = _way(state, "cut", "K", "role || ':' || text")
    rerole = _way(state, "cut + 2", "R", f"'{role}:' || text")
    return f"CASE WHEN NOT gone THEN CASE WHEN letter = '{initial}' THEN {keep} ELSE {rerole} END END"


def _inserted(e: str, s: str, u: str, a: str) -> dict[str, str]:
    """The states after up to two inserted turns: CTE columns in two steps."""
    return {
        "u1": _least(u, *[_way(x, "2", "I", "'user:'") for x in (e, s, a)]),
        "a1": _least(a, _way(u, "2", "I", "'assistant:'")),
        "u2": _least("u1", _way("a1", "2", "I", "'user:'")),
        "a2": _least("a1", _way("u1", "2", "I", "'assistant:'")),
    }


_START = "{'c': 0::BIGINT, 'a': '', 'l': []::VARCHAR[]}"
_OPEN = _inserted("e", "s", "u", "a")

OP11 = f"""WITH RECURSIVE {CRC_TABLE},
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
faulty AS (SELECT *, {crc32('k')} % 20 AS f FROM keyed, crc_table),
damaged AS (
  SELECT conv_id, turn, CASE f WHEN 4 THEN 'user' ELSE role END AS role,
    CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE f WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM faulty WHERE f <> 0),
numbered AS (
  SELECT *, row_number() OVER w AS i, left(role, 1) AS letter, lag(left(role, 1)) OVER w AS earlier,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS held
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
judged AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS again, held = '' AS blank, held <> '' AND again > 1 AS duplicate,
    held <> '' AND again = 1 AND right(held, 1) NOT IN ('.', '!', '?') AS truncated
  FROM numbered),
turns AS (SELECT *, blank OR duplicate AS gone, truncated::BIGINT AS cut FROM judged),
walk AS (
  SELECT conv_id, 0::BIGINT AS i, {_START} AS e, NULL::STRUCT(c BIGINT, a VARCHAR, l VARCHAR[]) AS s,
    NULL::STRUCT(c BIGINT, a VARCHAR, l VARCHAR[]) AS u, NULL::STRUCT(c BIGINT, a VARCHAR, l VARCHAR[]) AS a
  FROM (SELECT DISTINCT conv_id FROM turns)
  UNION ALL
  SELECT conv_id, i, {_way('e', '3', 'D')} AS e,
    {_least(_way('s', '3', 'D'), "CASE WHEN NOT gone AND letter = 's' THEN " + _way('e', 'cut', 'K', "role || ':' || text") + " END")} AS s,
    {_least(_way('u2', '3', 'D'), *[_taken(x, 'u', 'user') for x in ('e', 's', 'a2')])} AS u,
    {_least(_way('a2', '3', 'D'), _taken('u2', 'a', 'assistant'))} AS a
  FROM (
    SELECT *, {_OPEN['u2']} AS u2, {_OPEN['a2']} AS a2 FROM (
      SELECT walk.conv_id, walk.e, walk.s, t.i, t.role, t.text, t.letter, t.gone, t.cut,
        {_OPEN['u1']} AS u1, {_OPEN['a1']} AS a1
      FROM walk JOIN turns t ON walk.conv_id IS NOT DISTINCT FROM t.conv_id AND t.i = walk.i + 1))),
closed AS (
  SELECT conv_id, {_least('e', 'a2')} AS best FROM (
    SELECT *, {_OPEN['u2']} AS u2, {_OPEN['a2']} AS a2 FROM (
      SELECT w.*, {_OPEN['u1']} AS u1, {_OPEN['a1']} AS a1
      FROM walk w JOIN (SELECT conv_id, max(i) AS n FROM turns GROUP BY 1) x
        ON w.conv_id IS NOT DISTINCT FROM x.conv_id AND w.i = x.n))),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
    count(*) FILTER (earlier || letter NOT IN ('su', 'ua', 'au')) AS illegal
  FROM turns GROUP BY 1)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost,
  coalesce(best.a, '') AS audit, sha256(coalesce(array_to_string(best.l, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted ON o.conv_id IS NOT DISTINCT FROM counted.conv_id
LEFT JOIN closed ON o.conv_id IS NOT DISTINCT FROM closed.conv_id"""
