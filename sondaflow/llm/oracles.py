"""DuckDB SQL of the registered queries that SQL can express.

Packing, the seeded mix and the three trained models have none: tests compare
them with plain versions, round trips and held-out accuracy.
"""

from __future__ import annotations

from sondaflow.llm import chat, quality, secrets

WORDS = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


OP1 = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '{WORDS}') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE
    WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2),
         lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3])
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words),
members AS (SELECT doc_id, len(s) AS n, unnest(s) AS v FROM sets),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c
  FROM members a JOIN members b ON a.v = b.v AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT a, b FROM pairs WHERE 100 * c >= 80 * (na + nb - c)
  UNION ALL SELECT b, a FROM pairs WHERE 100 * c >= 80 * (na + nb - c)),
reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least_reached AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT s.doc_id, len(s.s) AS n_shingles, least(s.doc_id, coalesce(r.m, s.doc_id)) AS component_id,
       s.doc_id <= coalesce(r.m, s.doc_id) AS kept
FROM sets s LEFT JOIN least_reached r ON s.doc_id = r.a
"""

_R = quality.Rules()
OP2 = rf"""
WITH base AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents),
words AS (
  SELECT *, regexp_extract_all(t, '{WORDS}') AS w, string_split(t, chr(10)) AS lines FROM base),
runs AS (
  SELECT row, unnest(range(1, len(w) - {_R.window} + 2)) AS i, w FROM words WHERE len(w) >= {_R.window}),
named AS (SELECT row, i, array_to_string(w[i:i + {_R.window} - 1], ' ') AS run FROM runs),
repeated AS (SELECT row, run FROM named GROUP BY row, run HAVING count(*) > 1),
covered AS (
  SELECT row, count(DISTINCT p) AS n FROM (
    SELECT row, unnest(range(i, i + {_R.window})) AS p FROM named SEMI JOIN repeated USING (row, run)) GROUP BY row),
line AS (SELECT row, unnest(lines) AS x, generate_subscripts(lines, 1) AS k FROM words),
measured AS (
  SELECT row, x, k, length(regexp_replace(x, '{SPACES}', '', 'g')) AS solid,
         length(x) - length(translate(x, '{quality.SYMBOLS}!', '')) AS symbols,
         length(x) - length(translate(x, '|»›•', '')) AS bars FROM line),
passed AS (
  SELECT row, string_agg(x, chr(10) ORDER BY k) AS clean FROM measured
  WHERE NOT (solid > 0 AND (symbols * 100 > solid * {_R.symbol_percent}
    OR (bars >= {_R.separators} AND bars * {_R.words_per_separator} >= length(x) - solid + 1)
    OR (length(x) - solid + 1 <= {_R.boilerplate_words} AND regexp_matches(x, {_quoted(quality.BOILERPLATE)}))))
  GROUP BY row),
counted AS (
  SELECT row, doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(t) - length(translate(t, '{quality.SYMBOLS}', '')) AS n_symbols,
    len(list_filter(lines, lambda x: regexp_matches(x, '{WORDS}')))
      - len(list_distinct(list_filter(lines, lambda x: regexp_matches(x, '{WORDS}')))) AS n_dup_lines,
    coalesce(c.n, 0) AS n_repeat_words, coalesce(p.clean, '') AS clean
  FROM words LEFT JOIN covered c USING (row) LEFT JOIN passed p USING (row)),
failed AS (
  SELECT *, n_words < {_R.least_words} OR 100 * n_repeat_words > {_R.repeat_percent} * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 100 * length(regexp_replace(clean, '{SPACES}', '', 'g')) >= {_R.kept_percent} * word_chars AS kept,
  length(clean) AS clean_chars
FROM failed
"""


def _found(kind: int, pattern: str, group: int, condition: str) -> str:
    """Spans of one kind: starts follow from the pieces between the matches."""
    return rf"""
SELECT row, {kind} AS kind, s AS "start", s + length(m) AS "end", v AS value FROM (
  SELECT row, m[i] AS m, v[i] AS v,
    length(array_to_string(p[1:i], '')) + length(array_to_string(m[1:i - 1], '')) AS s FROM (
    SELECT row, m, v, p, unnest(range(1, len(m) + 1)) AS i FROM (
      SELECT row, regexp_extract_all(t, {_quoted(pattern)}) AS m, regexp_extract_all(t, {_quoted(pattern)}, {group}) AS v,
             string_split_regex(t, {_quoted(pattern)}) AS p FROM base)))
WHERE {condition}"""


_ASSIGN = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in "password") + "|" + "|".join(
    "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word) for word in ("passwd", "secret", "token", "api_?key"))
_ASSIGN = rf"""(?:{_ASSIGN})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_LIMIT = "CASE " + " ".join(
    f"WHEN regexp_matches(value, {_quoted(p)}) THEN {bits}" for _, p, bits in secrets.CLASSES[:-1]) + (
    f" ELSE {secrets.CLASSES[-1][2]} END")
_NAMES = "[" + ", ".join(_quoted(k) for k in secrets.KINDS) + "]"
OP5 = rf"""
WITH base AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents),
fixed AS ({_found(0, _ASSIGN, 1, "length(v) >= 6")} UNION ALL {_found(1, secrets.ACCESS, 0, "length(m) >= 20")}
  UNION ALL {_found(2, secrets.HEX, 0, "true")}),
candidates AS ({_found(3, secrets.CANDIDATE, 0, "true")}),
places AS (
  SELECT row, place, sum(cover) AS cover, sum(inside) AS inside FROM (
    SELECT row, "start" AS place, 1 AS cover, 0 AS inside FROM fixed UNION ALL SELECT row, "end", -1, 0 FROM fixed
    UNION ALL SELECT row, "start", 0, 1 FROM candidates UNION ALL SELECT row, "end", 0, -1 FROM candidates)
  GROUP BY row, place),
states AS (
  SELECT row, place, lead(place) OVER w AS until, sum(cover) OVER w AS cover, sum(inside) OVER w AS inside
  FROM places WINDOW w AS (PARTITION BY row ORDER BY place)),
rests AS (
  SELECT row, 3 AS kind, place AS "start", until AS "end", substr(t, place + 1, until - place) AS value
  FROM states JOIN base USING (row) WHERE cover = 0 AND inside = 1 AND until - place >= {secrets.WINDOW}),
named AS (
  SELECT *, string_split_regex(value, '{secrets.SEPARATORS}') AS parts,
         regexp_replace(lower(value), '[^a-z]', '', 'g') AS letters, regexp_extract_all(value, '{secrets.WORDS}') AS words
  FROM rests),
random AS (
  SELECT row, kind, "start", "end", value FROM named
  WHERE NOT ({" OR ".join(f"regexp_matches(value, {_quoted(p)})" for p in secrets.ALLOWED)})
    AND NOT (len(list_filter(parts, lambda p: NOT regexp_matches(p, '{secrets.PART}')
                                          AND NOT regexp_matches(p, '{secrets.NUMBER}'))) = 0
      AND (length(letters) - length(translate(letters, '{secrets.VOWELS}', ''))) * 100
          >= {secrets.VOWEL_PERCENT} * length(letters)
      AND (length(letters) - length(translate(letters, '{secrets.RARE}', ''))) * 100
          <= {secrets.RARE_PERCENT} * length(letters)
      AND NOT regexp_matches(letters, '{secrets.CONSONANTS}') AND length(letters) >= {secrets.WORD_LETTERS} * len(words))
    AND list_max(list_transform(range(1, length(value) - {secrets.WINDOW} + 2),
          lambda i: list_entropy(string_split(substr(value, i, {secrets.WINDOW}), '')))) >= {_LIMIT}),
spans AS (
  SELECT row, kind, "start", {_NAMES}[kind + 1] || ':' || "start" || ':' || "end" AS s FROM (
    SELECT * FROM fixed UNION ALL SELECT * FROM random)),
joined AS (
  SELECT row, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
    count(*) FILTER (kind = 2) AS n_hex, string_agg(s, ',' ORDER BY "start", kind) FILTER (kind < 3) AS base_spans,
    string_agg(s, ',' ORDER BY "start", kind) AS spans FROM spans GROUP BY row)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM base LEFT JOIN joined USING (row)
"""

OP9 = """
WITH vectors AS (
  SELECT vec_id, max(list_transform(embedding, lambda x: floor(x::DOUBLE * 256))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def _escaped(text: str, controls: tuple) -> str:
    out = f"replace({text}, '%', '%25')"
    for c in controls:
        out = f"replace({out}, {_quoted(c)}, {_quoted(f'%{ord(c[0]):02X}' + c[1:])})"
    return out


OP10 = f"""
WITH turns AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS k
  FROM turns),
marked AS (
  SELECT conv_id, k, role, coalesce(text, '') AS t,
    k > 1 AND role IS NOT DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY k) AS goes_on FROM numbered)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(coalesce(role, '') || chr(10) || t || chr(10), '' ORDER BY k)) AS turns_sha256,
  coalesce(sum(length(t)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(t, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length({_escaped("t", chat.CONTROLS)}) + CASE WHEN goes_on THEN {len(chat.TURN)} ELSE
    {len("<|role:") + len("|>") + 1 + len(chat.END)} + coalesce(length({_escaped("role", (*chat.CONTROLS, "|>"))}), {len(chat.NO_ROLE)})
    END)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""

OP11 = r"""
WITH base AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
said AS (SELECT row, lang, source,
                unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM base),
kept AS (SELECT lang, term, count(*)::HUGEINT AS n FROM said GROUP BY ALL HAVING count(DISTINCT row) >= 10),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM said SEMI JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM base),
totals AS (SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total FROM groups LEFT JOIN counts USING (lang, source)
           GROUP BY ALL),
shares AS (
  SELECT lang, source, term, coalesce(c.n, 0) AS n,
         1 + 1000000000 * (coalesce(c.n, 0) + 2) // (t.total + 2 * l.v) AS p,
         1 + 1000000000 * (k.n + 2) // (l.total + 2 * l.v) AS q
  FROM totals t JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)),
compared AS (
  SELECT lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT lang, a.source, b.source AS item, coalesce(c.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b USING (lang) LEFT JOIN compared c
    ON c.lang = a.lang AND c.source = a.source AND c.item = b.source WHERE a.source <> b.source),
own AS (SELECT lang, source, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value
        FROM shares WHERE n > 0 AND p > q),
parts AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs
          UNION ALL SELECT lang, source, 'term', item, value FROM own)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM parts
QUALIFY part = 'pair' OR rank <= 10
"""

ORACLES: dict[str, str] = {
    "op1_near_duplicates": OP1,
    "op2_quality_rules": OP2,
    "op5_secrets": OP5,
    "op9_top_k": OP9,
    "op10_chat": OP10,
    "op11_source_divergence": OP11,
}
