"""SQL for the corpus queries that SQL can express, and brute-force shapes shared by their tests."""

from __future__ import annotations

from sievework.llm import quality

_SPACE = r"[\x20\x09-\x0D]+"


def _words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{_SPACE}'), lambda x: x <> '')"


def _shingles(source: str, key: str) -> str:
    """Distinct five-word shingles (fewer words: all of them) of ``source``, which has ``key`` and a list ``w``."""
    return (f"SELECT DISTINCT {key}, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT {key}, w, unnest(range(1, len(w) - 3)) AS i FROM {source} "
            f"WHERE len(w) >= 5) UNION ALL SELECT DISTINCT {key}, array_to_string(w, ' ') FROM {source} WHERE len(w) BETWEEN 1 AND 4")


def _quality() -> str:
    ratios = {"symbol_ratio": "n_symbols", "word_length": "word_chars", "dup_line_ratio": "n_dup_lines", "repeat_ratio": "n_repeat_words"}
    spread = quality.SPREAD
    cuts = ", ".join(f"quantile_disc({r}, 0.25) AS {r}_1, quantile_disc({r}, 0.75) AS {r}_3" for r in ratios)
    inside = []
    for r in ratios:
        one, three = (f"CASE WHEN g.n >= {quality.MIN_GROUP} THEN g.{r}_{k} WHEN l.n >= {quality.MIN_GROUP} THEN l.{r}_{k} ELSE a.{r}_{k} END"
                      for k in (1, 3))
        reach = f"((({three}) - ({one})) * CAST({spread} AS DOUBLE) + CAST({quality.SLACK[r]} AS DOUBLE))"
        inside.append(f"m.{r} BETWEEN ({one}) - {reach} AND ({three}) + {reach}")
    columns = ", ".join(f"{c}::DOUBLE / greatest(n_words, 1)::DOUBLE AS {r}" for r, c in ratios.items())
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, lang, source, t, {_words("t")} AS w FROM d),
win AS (SELECT r, i, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)),
starts AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM win) WHERE c > 1),
covered AS (SELECT r, sum(least(5, i - p)) AS n FROM (
  SELECT r, i, coalesce(lag(i) OVER (PARTITION BY r ORDER BY i), -9) AS p FROM starts) GROUP BY r),
lines AS (SELECT r, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
base AS (SELECT w.r, doc_id, lang, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
  (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
  (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM w JOIN lines ON lines.r = w.r LEFT JOIN covered ON covered.r = w.r),
m AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, {columns} FROM base),
good AS (SELECT * FROM m WHERE NOT base_failed),
g AS (SELECT lang, source, count(*) AS n, {cuts} FROM good GROUP BY lang, source),
l AS (SELECT lang, count(*) AS n, {cuts} FROM good GROUP BY lang),
a AS (SELECT count(*) AS n, {cuts} FROM good)
SELECT m.doc_id, m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words, m.base_failed,
  NOT m.base_failed AND coalesce({" AND ".join(inside)}, false) AS kept
FROM m CROSS JOIN a LEFT JOIN g ON g.lang IS NOT DISTINCT FROM m.lang AND g.source IS NOT DISTINCT FROM m.source
LEFT JOIN l ON l.lang IS NOT DISTINCT FROM m.lang"""


QUALITY = _quality()

JACCARD = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_words("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
  FROM documents),
s AS ({_shingles("d", "doc_id")}),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
reached(doc_id, c) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON r.c = l.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.c) AS component_id
FROM d JOIN reached r ON r.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id"""

CONTAINMENT = f"""
WITH d AS (SELECT doc_id, {_words("lower(coalesce(text, ''))")} AS w FROM documents),
b AS (SELECT item_id, {_words("lower(coalesce(text, ''))")} AS w FROM benchmark),
ds AS ({_shingles("d", "doc_id")}),
bs AS ({_shingles("b", "item_id")}),
n AS (SELECT item_id, count(*) AS n FROM bs GROUP BY item_id)
SELECT ds.doc_id, bs.item_id, any_value(n.n)::INTEGER AS n_item_shingles, count(*)::INTEGER AS n_shared
FROM ds JOIN bs ON ds.g = bs.g JOIN n ON n.item_id = bs.item_id GROUP BY ds.doc_id, bs.item_id
HAVING 100 * count(*) >= 75 * any_value(n.n)"""

SNAPSHOTS = """
WITH t AS (SELECT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
c AS (SELECT conv_id, list(struct_pack(turn := turn, role := role, text := text) ORDER BY turn, role, text) AS l, count(*) AS n FROM t GROUP BY conv_id),
whole AS (SELECT min(conv_id) AS conv_id, l, n, count(*) AS n_copies FROM c GROUP BY l, n),
kept AS (SELECT w.conv_id, w.n, w.n_copies FROM whole w WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.n > w.n AND c.l[1:w.n] = w.l))
SELECT t.conv_id, t.turn, row_number() OVER (PARTITION BY t.conv_id ORDER BY t.turn, t.role NULLS FIRST, t.text NULLS FIRST) - 1 AS position,
  kept.n AS n_turns, kept.n_copies,
  '<|im_start|>' || coalesce(t.role, '') || chr(10) || coalesce(t.text, '') || '<|im_end|>' || chr(10) AS segment
FROM t JOIN kept ON kept.conv_id = t.conv_id"""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _crc32(text: str) -> str:
    """The unsigned CRC-32 of a text's UTF-8 bytes: a fold over the bytes; the query has the table's list as column ``table256``."""
    digits = f"hex(encode({text}))"
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, len({digits}), 2), lambda i: ('0x' || substr({digits}, i, 2))::BIGINT)), "
            "lambda a, b: xor(a >> 8, table256[(xor(a, b) & 255) + 1])), 4294967295::BIGINT)")


_CRC_TABLE = ("crc AS MATERIALIZED (SELECT list(list_reduce(list_prepend(n::BIGINT, range(8)), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::BIGINT) "
              "ELSE a >> 1 END) ORDER BY n) AS table256 FROM range(256) r(n))")

SPELLING = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (SELECT doc_id, {_LOWER.format("unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+'))")} AS r FROM documents),
counted AS (SELECT doc_id, r, count(*) AS c FROM runs WHERE length(r) >= 7 GROUP BY doc_id, r),
hashed AS (SELECT r, c, {_crc32("coalesce(doc_id::VARCHAR, '') || ':' || r")} AS h FROM counted, crc),
words AS (SELECT word, sum(c)::BIGINT AS n FROM (
  SELECT CASE WHEN h % 31 = 0 THEN r[1:h % length(r)] || r[h % length(r) + 2:] ELSE r END AS word, c FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2),
letters AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
gone AS (SELECT DISTINCT word, n, word[1:i - 1] || word[i + 1:] AS rest FROM letters),
holes AS (SELECT word, n, i, word[1:i - 1] || word[i + 1:] AS rest FROM letters),
pairs AS (SELECT a.word, b.word AS near, b.n AS m FROM holes a JOIN holes b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION ALL SELECT g.word, w.word, w.n FROM gone g JOIN words w ON g.rest = w.word
  UNION ALL SELECT w.word, g.word, g.n FROM gone g JOIN words w ON g.rest = w.word),
best AS (SELECT word, count(*) AS n_near, max(m) AS m FROM pairs GROUP BY word),
formed AS (SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.m >= 10 * w.n THEN b.m END AS form_n,
  CASE WHEN b.m >= 10 * w.n THEN (SELECT min(p.near) FROM pairs p WHERE p.word = w.word AND p.m = b.m) END AS form
  FROM words w LEFT JOIN best b ON b.word = w.word),
chain(word, last, step) AS (SELECT word, word, 0 FROM formed UNION ALL SELECT c.word, f.form, step + 1 FROM chain c JOIN formed f ON f.word = c.last WHERE f.form IS NOT NULL),
roots AS (SELECT word, arg_max(last, step) AS root FROM chain GROUP BY word)
SELECT f.word, f.form, r.root, f.n, f.n_near::BIGINT AS n_near, f.form_n::BIGINT AS form_n FROM formed f JOIN roots r ON r.word = f.word"""

_EDITS = """(VALUES (0, 0, 'D', 4), (1, 1, 'D', 4), (2, 2, 'D', 4), (3, 3, 'D', 4), (0, 1, 'K', 0), (0, 2, 'K', 0), (1, 2, 'K', 0), (2, 3, 'K', 0), (3, 2, 'K', 0),
  (0, 2, 'R', 3), (1, 2, 'R', 3), (2, 3, 'R', 3), (3, 2, 'R', 3)) e(begun, ended, letter, paid)"""
_GROWN = """(VALUES (0, 0, 0, ''), (0, 2, 1, 'user:'), (0, 3, 2, 'user:' || chr(10) || 'assistant:'), (1, 1, 0, ''), (1, 2, 1, 'user:'), (1, 3, 2, 'user:' || chr(10) || 'assistant:'),
  (2, 2, 0, ''), (2, 3, 1, 'assistant:'), (2, 2, 2, 'assistant:' || chr(10) || 'user:'), (3, 3, 0, ''), (3, 2, 1, 'user:'), (3, 3, 2, 'user:' || chr(10) || 'assistant:')) g(begun, ended, k, told)"""
_JOINED = "CASE WHEN {0} = '' THEN {1} WHEN {1} = '' THEN {0} ELSE {0} || chr(10) || {1} END"

REPAIR = rf"""
WITH RECURSIVE {_CRC_TABLE},
hashed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS h FROM conversations, crc),
rows AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
  CASE WHEN h = 1 THEN '' WHEN h = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(range(CASE WHEN h = 0 THEN 0 WHEN h = 3 THEN 2 ELSE 1 END)) AS copy FROM hashed),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
  row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen FROM rows),
faults AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN seen > 1 THEN 'duplicate'
  WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' END AS fault,
  coalesce(lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1:1] NOT IN ('su', 'ua', 'au'), false) AS illegal FROM placed),
counts AS (SELECT conv_id, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
  count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, max(i) AS last
  FROM faults GROUP BY conv_id),
steps AS (SELECT f.conv_id, f.i, e.begun, e.ended, e.letter, e.paid + CASE WHEN fault = 'truncated' AND letter <> 'D' THEN 3 ELSE 0 END AS paid,
  CASE letter WHEN 'D' THEN '' WHEN 'K' THEN f.role || ':' || f.text WHEN 'R' THEN CASE e.ended WHEN 2 THEN 'user:' ELSE 'assistant:' END || f.text END AS told
  FROM faults f JOIN {_EDITS} ON (letter = 'D' OR fault IS NULL OR fault = 'truncated')
  AND (letter <> 'K' OR f.role[1:1] = CASE e.ended WHEN 1 THEN 's' WHEN 2 THEN 'u' ELSE 'a' END)),
walk(conv_id, i, state, cost, audit, told) AS (SELECT conv_id, 0::BIGINT, 0, 0, '', '' FROM counts UNION ALL
  SELECT conv_id, i, ended, cost, audit, told FROM (
    SELECT w.conv_id, s.i, s.ended, w.cost + 3 * g.k + s.paid AS cost, w.audit || repeat('I', g.k) || s.letter AS audit,
      {_JOINED.format("(" + _JOINED.format("w.told", "g.told") + ")", "s.told")} AS told,
      row_number() OVER (PARTITION BY s.conv_id, s.ended ORDER BY w.cost + 3 * g.k + s.paid, w.audit || repeat('I', g.k) || s.letter) AS r
    FROM walk w JOIN {_GROWN} ON g.begun = w.state JOIN steps s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.i = w.i + 1 AND s.begun = g.ended) WHERE r = 1),
ends AS (SELECT w.conv_id, w.cost + 3 * g.k AS cost, w.audit || repeat('I', g.k) AS audit, {_JOINED.format("w.told", "g.told")} AS told,
  row_number() OVER (PARTITION BY w.conv_id ORDER BY w.cost + 3 * g.k, w.audit || repeat('I', g.k)) AS r
  FROM walk w JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.last = w.i JOIN {_GROWN} ON g.begun = w.state WHERE g.ended IN (0, 3))
SELECT o.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0)::BIGINT AS blank, coalesce(c.duplicate, 0)::BIGINT AS duplicate,
  coalesce(c.truncated, 0)::BIGINT AS truncated, coalesce(c.illegal, 0)::BIGINT AS illegal, coalesce(e.cost, 0)::BIGINT AS cost,
  coalesce(e.audit, '') AS audit, sha256(coalesce(e.told, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM o.conv_id AND e.r = 1"""
