"""DuckDB SQL for the repair of conversations: the same costs and audits by dynamic programming.

Row after row, the best edits that end in each of the four states of the pattern are kept as
one struct of cost, audit and repaired lines; structs compare by cost, then by audit.
"""

from __future__ import annotations

_SPACE = r"\x20\x09-\x0D"
_NO_WAY = 1 << 40
_NONE = f"{{'c': {_NO_WAY}, 'a': '', 't': []::VARCHAR[]}}"
_ROLE = {2: "user", 3: "assistant"}


def _add(state: str, cost: str, edit: str, line: str | None) -> str:
    lines = f"{state}.t" if line is None else f"list_append({state}.t, {line})"
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}', 't': {lines}}}"


def _insert(state: str, into: int) -> str:
    return _add(state, "5", "I", f"'{_ROLE[into]}:'")


def _best(*ways: str) -> str:
    return f"list_min([{', '.join(ways)}])"


def _keep(state: str, when: str) -> str:
    return f"CASE WHEN {when} THEN {_add(state, 'fine', 'K', 'line')} ELSE {_NONE} END"


def _rerole(state: str, into: int) -> str:
    return _add(state, "1 + fine", "R", f"'{_ROLE[into]}:' || text")


def _inserts(s0: str, s1: str, s2: str, s3: str) -> tuple[str, str]:
    """The best that ends after a user row, or after an assistant row, with inserts before the next edit."""
    user = _best(s2, *(_insert(s, 2) for s in (s0, s1, s3)))
    assistant = _best(s3, _insert(s2, 3), *(_insert(_insert_of(s), 3) for s in (s0, s1)))
    return user, assistant


def _insert_of(state: str) -> str:
    return f"({_insert(state, 2)})"


_USER, _ASSISTANT = _inserts("s0", "s1", "s2", "s3")

CONVERSATIONS = rf"""
WITH RECURSIVE bits(i, step, v) AS (
    SELECT i, 0, i::UBIGINT FROM range(256) r(i)
    UNION ALL
    SELECT i, step + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END FROM bits WHERE step < 8
),
tab AS (SELECT list(v ORDER BY i) AS t FROM bits WHERE step = 8),
given AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           [ascii(ch)::UBIGINT FOR ch IN string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '')] AS b
    FROM conversations
),
lots AS (
    SELECT conv_id, turn, role, text,
           xor(list_reduce(list_prepend(4294967295::UBIGINT, b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255)::BIGINT + 1])),
               4294967295::UBIGINT) % 20 AS lot
    FROM given, tab
),
rows_ AS (
    SELECT conv_id, turn, CASE WHEN lot = 4 THEN 'user' ELSE role END AS role,
           CASE WHEN lot = 1 THEN '' WHEN lot = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM lots, unnest(CASE WHEN lot = 0 THEN [] WHEN lot = 3 THEN [1, 2] ELSE [1] END)
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS pos FROM rows_
),
judged AS (
    SELECT *, CASE WHEN NOT regexp_matches(text, '[^{_SPACE}]') THEN 'blank'
                   WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
                   WHEN NOT regexp_matches(text, '[.!?][{_SPACE}]*$') THEN 'truncated' ELSE 'ok' END AS fault,
           left(lag(role) OVER (PARTITION BY conv_id ORDER BY pos), 1) || left(role, 1) AS pair
    FROM placed
),
todo AS (
    SELECT *, fault IN ('blank', 'duplicate') AS gone, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS fine,
           role || ':' || text AS line
    FROM judged
),
walk(conv_id, pos, s0, s1, s2, s3) AS (
    SELECT conv_id, 0::BIGINT, {{'c': 0, 'a': '', 't': []::VARCHAR[]}}, {_NONE}, {_NONE}, {_NONE}
    FROM (SELECT DISTINCT conv_id FROM conversations)
    UNION ALL
    SELECT conv_id, pos,
           {_best(_add("s0", "2", "D", None), _keep("s0", "NOT gone AND role = ''"))},
           {_best(_add("s1", "2", "D", None), _keep("s0", "NOT gone AND role[1] = 's'"), _keep("s1", "NOT gone AND role = ''"))},
           CASE WHEN gone THEN {_add("s2", "2", "D", None)} ELSE
           {_best(_add("s2", "2", "D", None), *(_keep(s, "role[1] = 'u'") for s in ("s0", "s1", "e3")), _keep("e2", "role = ''"), *(_rerole(s, 2) for s in ("s0", "s1", "e3")))}
           END,
           CASE WHEN gone THEN {_add("s3", "2", "D", None)} ELSE
           {_best(_add("s3", "2", "D", None), _keep("e2", "role[1] = 'a'"), _keep("e3", "role = ''"), _rerole("e2", 3))}
           END
    FROM (
        SELECT w.*, t.pos AS at, t.role, t.text, t.line, t.gone, t.fine::BIGINT AS fine, {_USER} AS e2, {_ASSISTANT} AS e3
        FROM walk w JOIN todo t ON w.conv_id IS NOT DISTINCT FROM t.conv_id AND t.pos = w.pos + 1
    ) step(conv_id, before, s0, s1, s2, s3, pos, role, text, line, gone, fine, e2, e3)
),
ends AS (
    SELECT conv_id, {_best("s0", _ASSISTANT)} AS done
    FROM walk QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY pos DESC) = 1
),
counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
           count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM todo GROUP BY conv_id
)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, done.c::BIGINT AS cost, done.a AS audit,
       sha256(array_to_string(done.t, chr(10))) AS repaired_sha256
FROM ends e LEFT JOIN counts c ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""
