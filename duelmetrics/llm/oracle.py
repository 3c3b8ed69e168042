"""DuckDB SQL for the queries that SQL can express; it takes every row and prunes nothing."""

from __future__ import annotations

from .license_scan import TEMPLATES, anchored

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP2 = f"""
WITH RECURSIVE worded AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), {_AZ}), '[\\x20\\x09-\\x0D]+'),
                             lambda w: w <> '') AS words
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(words) >= 5
      THEN list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')))
      WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END AS shingles
  FROM worded),
flat AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS u, b.doc_id AS v
  FROM flat a JOIN flat b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach(doc_id, root) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT l.v, r.root FROM reach r JOIN links l ON l.u = r.doc_id)
SELECT s.doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM sets s JOIN (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id) c ON c.doc_id = s.doc_id
"""


def _either_case(words: str) -> str:
    """``words`` as a pattern for ASCII letters in either case; this engine's own flag folds other letters too."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


def _parts(number: int, kind: str, pattern: str, value: int = 0, ok: str = "TRUE") -> str:
    quoted = pattern.replace("'", "''")
    return f"""
  SELECT doc_id, {number} AS kind, '{kind}' AS name, unnest(list_transform(range(1, len(found) + 1), lambda n: {{
      'nth': n, 'gap': length(gaps[n]), 'size': length(found[n]), 'ok': {ok}}})) AS p
  FROM (SELECT doc_id, regexp_split_to_array(body, '{quoted}') AS gaps, regexp_extract_all(body, '{quoted}') AS found,
               regexp_extract_all(body, '{quoted}', {value}) AS vals FROM bodies)"""


_IS = r"""["']?\x20*[:=]\x20*["']?"""
_SCHEMES = "https?|ftp|ssh|s3|amqps?|redis|mysql|postgres(?:ql)?|mongodb(?:\\+srv)?"
_PARTS = " UNION ALL ".join((
    _parts(0, "assign", f"({_either_case('password|passwd|secret|token|api_?key')}){_IS}([A-Za-z0-9+/_.=-]+)", 2, "length(vals[n]) >= 6"),
    _parts(1, "access", "AKIA[A-Z0-9]+", ok="length(found[n]) >= 20"),
    _parts(2, "hex", "[0-9a-f]+", ok="length(found[n]) >= 24"),
    _parts(3, "user", f"({_either_case('username|user|login|account|client_?id|key_?id')}){_IS}([A-Za-z0-9_.@-][A-Za-z0-9_.@-][A-Za-z0-9_.@-]+)"),
    _parts(4, "key", "[A-Za-z0-9+/]+", ok="length(found[n]) BETWEEN 32 AND 64 AND regexp_matches(found[n], '[0-9]') "
                                          "AND regexp_matches(found[n], '[a-z]') AND regexp_matches(found[n], '[A-Z]')"),
    _parts(5, "endpoint", f"(?:{_SCHEMES})://[^\\x09-\\x0D\\x20\"'<>]+")))

#: Weak parts (kinds 3 to 5) overlap no strong one and lie within 300 characters of what completes them.
OP1 = f"""
WITH bodies AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
parts AS ({_PARTS}),
placed AS (
  SELECT doc_id, kind, name, p.ok AS ok, p.size AS size,
         sum(p.gap + p.size) OVER (PARTITION BY doc_id, kind ORDER BY p.nth) AS stop
  FROM parts),
every AS (SELECT doc_id, kind, name, CAST(stop - size AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop FROM placed WHERE ok),
free AS (
  SELECT * FROM every e WHERE kind < 3 OR NOT EXISTS (
    SELECT 1 FROM every s WHERE s.doc_id = e.doc_id AND s.kind < 3 AND s.start < e.stop AND s.stop > e.start)),
linked AS (
  SELECT e.doc_id, e.kind, e.name, e.start, e.stop
  FROM free e JOIN free o ON o.doc_id = e.doc_id AND abs(o.start - e.start) <= 300
  GROUP BY ALL
  HAVING e.kind < 3 OR ((e.kind = 3 OR bool_or(o.kind IN (1, 3))) AND (e.kind = 4 OR bool_or(o.kind IN (0, 2, 4))))),
listed AS (
  SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
         string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind) FILTER (kind < 3) AS base,
         string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind) AS spans, count(*) FILTER (kind > 2) AS n_linked
  FROM linked GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_linked, 0) AS n_linked
FROM documents d LEFT JOIN listed l ON l.doc_id = d.doc_id
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_TEMPLATES = ", ".join(f"({k}, {_quoted(name)}, {_quoted(text)})" for k, (name, text) in enumerate(TEMPLATES))
_STARTS = ", ".join(f"({k}, {_quoted(anchor)}, {before}, {size})" for k, _, anchor, before, size in anchored(TEMPLATES))
_PAIRS = """list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))"""

OP6 = f"""
WITH templates(template, license, body) AS (VALUES {_TEMPLATES}),
starts(template, anchor, before, size) AS (VALUES {_STARTS}),
known AS (
  SELECT template, license, {_PAIRS} AS known
  FROM (SELECT template, license, regexp_extract_all(translate(body, {_AZ}), '[a-z0-9]+') AS words FROM templates)),
texts AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[a-z0-9]+') AS words FROM documents),
places AS (SELECT rid, unnest(range(1, len(words) + 1)) AS place, words FROM texts),
windows AS (
  SELECT rid, template, words[greatest(place - before, 1):least(place - before + size - 1, len(words))] AS words
  FROM places JOIN starts ON anchor = words[place]),
compared AS (
  SELECT rid, license, 2 * len(list_intersect(pairs, known)) / (len(pairs) + len(known)) AS dice
  FROM (SELECT rid, template, {_PAIRS} AS pairs FROM windows) JOIN known USING (template)),
found AS (SELECT rid, license, max(dice) AS dice FROM compared WHERE dice >= 0.8 GROUP BY rid, license)
SELECT t.doc_id, first(license ORDER BY dice DESC, license) AS license, max(dice) AS dice,
       coalesce(string_agg(license, ',' ORDER BY license), '') AS licenses
FROM texts t LEFT JOIN found f ON f.rid = t.rid
GROUP BY t.rid, t.doc_id
"""

OP12 = f"""
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY body ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(body) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), {_AZ}) AS body FROM documents)
WINDOW w AS (PARTITION BY body)
"""

ALL: dict[str, str] = {"op1_secret_scan": OP1, "op2_near_duplicates": OP2, "op6_license_scan": OP6, "op12_exact_dedup": OP12}
