"""The repair of damaged conversations as one DuckDB statement.

A prefix of edits is one text, its cost in nine digits before its audit, so the smaller text is
the cheaper one, then the ASCII-least.
"""


def _add(prefix: str, cost: str, edit: str) -> str:
    return (f"(lpad(CAST(CAST(left({prefix}, 9) AS BIGINT) + {cost} AS VARCHAR), 9, '0')"
            f" || substr({prefix}, 10) || '{edit}')")


def _each(prefixes: list[str], cost: str, edit: str) -> str:
    return ", ".join(_add(p, cost, edit) for p in prefixes)


_ASKING = ["a.st", "a.sy", "a.asst"]
_KEPT, _OTHER = "CASE WHEN r.go THEN NULL WHEN r.c = '{}' THEN least({}) END", "CASE WHEN NOT r.go THEN least({}) END"

SQL = f"""
WITH RECURSIVE crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_concat([i], range(8)), lambda c, k:
      CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS v
    FROM range(256) AS n(i))),
given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':'
      || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: CAST(ascii(c) AS BIGINT)) AS codes
  FROM conversations),
kinds AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(list_concat([4294967295], codes), lambda c, b:
    xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 20 AS kind
  FROM given, crc_table),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM kinds, unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS again(copy)
  WHERE kind <> 0),
placed AS (
  SELECT *, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS nth
  FROM damaged),
faulty AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
    WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) || left(role, 1) AS pair
  FROM placed),
counted AS (
  SELECT conv_id, count(*) AS n,
    coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id),
rows AS (
  SELECT conv_id, pos, left(role, 1) AS c, fault IN ('blank', 'duplicate') AS go,
    CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END AS cut
  FROM faulty),
walk AS (
  SELECT conv_id, n, CAST(0 AS BIGINT) AS i, '000000000' AS st, CAST(NULL AS VARCHAR) AS sy,
    '000000002I' AS us, '000000004II' AS asst
  FROM counted
  UNION ALL
  SELECT conv_id, n, i, st, sy, us, least(asst, {_add('us', '2', 'I')})
  FROM (
    SELECT conv_id, n, i, st, sy, asst, least(us, {_each(['st', 'sy', 'asst'], '2', 'I')}) AS us
    FROM (
      SELECT a.conv_id, a.n, a.i + 1 AS i, {_add('a.st', '3', 'D')} AS st,
        least({_add('a.sy', '3', 'D')}, {_KEPT.format('s', _add('a.st', 'r.cut', 'K'))}) AS sy,
        least({_add('a.us', '3', 'D')}, {_KEPT.format('u', _each(_ASKING, 'r.cut', 'K'))},
          {_OTHER.format(_each(_ASKING, '2 + r.cut', 'R'))}) AS us,
        least({_add('a.asst', '3', 'D')}, {_KEPT.format('a', _add('a.us', 'r.cut', 'K'))},
          {_OTHER.format(_add('a.us', '2 + r.cut', 'R'))}) AS asst
      FROM walk AS a JOIN rows AS r ON r.conv_id IS NOT DISTINCT FROM a.conv_id AND r.pos = a.i + 1))),
ended AS (
  SELECT conv_id, least(st, asst) AS best FROM walk WHERE i = n),
edits AS (
  SELECT conv_id, k, substr(best, CAST(9 + k AS BIGINT), 1) AS edit
  FROM ended, unnest(range(1, length(best) - 8)) AS places(k)),
numbered AS (
  SELECT *, sum(CAST(edit <> 'I' AS INT)) OVER upto AS pos, sum(CAST(edit <> 'D' AS INT)) OVER upto AS turn,
    sum(CAST(edit <> 'D' AS INT)) OVER (PARTITION BY conv_id) AS turns
  FROM edits WINDOW upto AS (PARTITION BY conv_id ORDER BY k)),
repaired AS (
  SELECT e.conv_id, string_agg(CASE WHEN e.edit = 'K' THEN f.role WHEN (e.turns - e.turn) % 2 = 1 THEN 'user'
      ELSE 'assistant' END || ':' || CASE WHEN edit = 'I' THEN '' ELSE f.text END, chr(10) ORDER BY k) AS text
  FROM numbered AS e LEFT JOIN faulty AS f ON f.conv_id IS NOT DISTINCT FROM e.conv_id AND f.pos = e.pos
  WHERE edit <> 'D' GROUP BY e.conv_id)
SELECT g.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(CAST(left(best, 9) AS BIGINT), 0) AS cost, coalesce(substr(best, 10), '') AS audit,
  sha256(coalesce(p.text, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS g
LEFT JOIN counted AS c ON c.conv_id IS NOT DISTINCT FROM g.conv_id
LEFT JOIN ended AS w ON w.conv_id IS NOT DISTINCT FROM g.conv_id
LEFT JOIN repaired AS p ON p.conv_id IS NOT DISTINCT FROM g.conv_id
"""
