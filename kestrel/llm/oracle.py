"""DuckDB SQL of the native scans, built from the operators' fixed values."""

from __future__ import annotations

from kestrel.llm import licenses, secret_scan


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def license_sql() -> str:
    """The same sentences and rules; a sentence's end and its version stop without lookaround."""
    names = " ".join(f"WHEN regexp_full_match(w, {_quoted(licenses.pattern(s))}) THEN {_quoted(name)}"
                     for s, name in licenses.SENTENCES)
    steps, hits = [], {}
    for k, (sequence, licence) in enumerate(licenses.RULES):
        pattern = _quoted(licenses.sequence_pattern(sequence))
        hits.setdefault(licence, []).append(f"hit_{k}")
        steps.append(f"r{k + 1} AS MATERIALIZED (SELECT * REPLACE (regexp_replace(rest, {pattern}, '|*|', 'g') AS rest), "
                     f"regexp_matches(rest, {pattern}) AS hit_{k} FROM r{k})")
    found = ", ".join(f"CASE WHEN {' OR '.join(h)} THEN {_quoted(name)} END" for name, h in hits.items())
    stop = r"[ \t\n\r\f]"
    return rf"""
WITH kept AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '\b((?i:v|ver|vers))\.([ \t\n\r\f#*/;-]+[0-9])', '\1 \2', 'g') AS t FROM documents),
cut AS (
  SELECT doc_id, string_split(regexp_replace(t, '[.!?]+({stop}+|\z)', chr(1), 'g'), chr(1)) AS parts FROM kept),
norm AS (
  SELECT doc_id, list_transform(parts, lambda p: ' ' || regexp_replace(lower(trim(regexp_replace(p, '[^A-Za-z0-9]+', ' ', 'g'))),
    {_quoted(licenses.NEGATED)}, 'negated', 'g') || ' ') AS ss FROM cut),
found AS (SELECT doc_id, list_transform(ss, lambda s: regexp_extract_all(s, {_quoted(licenses.one_of())})) AS ws FROM norm),
named AS (SELECT doc_id, flatten(list_transform(ws, lambda f: CASE WHEN len(f) = 0 THEN ['-'] ELSE
  list_transform(f, lambda w: CASE {names} END) END)) AS ids FROM found),
r0 AS MATERIALIZED (SELECT doc_id, list_filter(ids, lambda i: i <> '-') AS seen,
  array_to_string(list_transform(ids, lambda i: '|' || i || '|'), '') AS rest FROM named),
{", ".join(steps)}
SELECT doc_id, concat_ws(',', {found}) AS licenses, array_to_string(seen, ',') AS sentence_ids,
  CAST(len(seen) AS BIGINT) AS n_sentences,
  CAST(len(list_filter(string_split_regex(rest, '\|+'), lambda i: i NOT IN ('', '-', '*'))) AS BIGINT) AS unmatched
FROM r{len(licenses.RULES)}"""


def secret_sql() -> str:
    def spans(kind: int, pattern: str, keep: str = "true") -> str:
        p = _quoted(pattern)
        return f"""
  SELECT doc_id, {kind} AS kind, piece, CAST(list_sum(list_transform(gaps[:i], lambda g: length(g)))
      + coalesce(list_sum(list_transform(found[:i - 1], lambda f: length(f))), 0) AS BIGINT) AS start
  FROM (SELECT doc_id, found, gaps, unnest(found) AS piece, unnest(range(1, len(found) + 1)) AS i, unnest(keep) AS keep
    FROM (SELECT doc_id, regexp_extract_all(t, {p}) AS found, string_split_regex(t, {p}) AS gaps, {keep} AS keep
      FROM texts WHERE regexp_matches(t, {p})))
  WHERE keep"""
    assign, access, hexes = secret_scan.ASSIGN, "AKIA[A-Z0-9]+", "[0-9a-f]+"
    w = secret_scan.WINDOW
    runs, stretch = f"[A-Za-z0-9+/_=-]{{{w},}}", _quoted(f"[A-Za-z]{{{w},}}")
    long_enough = lambda p, n: f"list_transform(regexp_extract_all(t, {_quoted(p)}), lambda f: length(f) >= {n})"
    least = "CASE " + " ".join(f"WHEN regexp_matches(piece, {_quoted(p)}) THEN {bits}" for p, bits in secret_scan.CLASSES) + " END"

    def cut(pattern: str, what: str, start: str, table: str, where: str) -> str:
        """A row for each gap (or find) of ``piece`` and its place in the text."""
        inside = "" if what == "gaps" else " + length(gaps[i])"
        return f"""
  SELECT doc_id, start + CAST(coalesce(list_sum(list_transform(gaps[:i - 1], lambda g: length(g))), 0)
      + coalesce(list_sum(list_transform(found[:i - 1], lambda f: length(f))), 0){inside} AS BIGINT) AS start, piece
  FROM (SELECT doc_id, start, gaps, found, unnest(range(1, len({what}) + 1)) AS i, unnest({what}) AS piece
    FROM (SELECT doc_id, start, string_split_regex(piece, {pattern}) AS gaps, regexp_extract_all(piece, {pattern}) AS found
      FROM {table} WHERE {where}))
  WHERE length(piece) >= {w}"""
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
base AS ({spans(0, assign, f"list_transform(regexp_extract_all(t, {_quoted(assign)}, 2), lambda f: length(f) >= {secret_scan.LEAST_ASSIGN})")}
  UNION ALL {spans(1, access, long_enough(access, secret_scan.LEAST_ACCESS))}
  UNION ALL {spans(2, hexes, long_enough(hexes, secret_scan.LEAST_HEX))}),
runs AS ({spans(3, runs, long_enough(runs, w))}),
parts AS ({cut(_quoted(secret_scan.ALLOWED), "gaps", "start", "runs", f"NOT regexp_matches(piece, {_quoted(secret_scan.UUID)})")}),
scanned AS (
  SELECT doc_id, start, piece, {least} AS least FROM parts WHERE regexp_matches(piece, '[0-9]')
  UNION ALL
  SELECT doc_id, start, piece, {secret_scan.LETTERS_LEAST} FROM ({cut(stretch, "found", "start", "parts", "NOT regexp_matches(piece, '[0-9]')")})),
windows AS (
  SELECT doc_id, start, least, k, string_split(substring(piece, k + 1, {w}), '') AS chars
  FROM (SELECT *, unnest(range(0, length(piece) - {w} + 1)) AS k FROM scanned)),
entropy AS (
  SELECT doc_id, 3 AS kind, start + min(k) AS start, start + max(k) + {w} AS stop FROM windows
  WHERE list_sum(list_transform(list_distinct(chars), lambda c: -(len(list_filter(chars, lambda x: x = c)) / {w}.0)
    * log2(len(list_filter(chars, lambda x: x = c)) / {w}.0))) >= least - 1e-9
  GROUP BY doc_id, start),
found AS (SELECT doc_id, kind, start, start + length(piece) AS stop FROM base UNION ALL SELECT * FROM entropy),
named AS (SELECT *, ['assign', 'access', 'hex', 'entropy'][kind + 1] || ':' || start || ':' || stop AS span FROM found)
SELECT t.doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access,
  count(*) FILTER (WHERE kind = 2) AS n_hex,
  sha256(coalesce(string_agg(span, ',' ORDER BY start, kind) FILTER (WHERE kind < 3), '')) AS base_sha256,
  coalesce(string_agg(span, ',' ORDER BY start, kind), '') AS spans
FROM texts t LEFT JOIN named n ON n.doc_id = t.doc_id GROUP BY t.doc_id"""
