"""What registered queries must return, as DuckDB SQL over the same tables: the definitions, without the methods."""

from __future__ import annotations

from covisit.llm import chat
from covisit.llm.centroid_clustering import Clustering
from covisit.llm.quality import QualityRules

# words of a text: runs between ASCII white space
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_SPACE = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"



def _windows(size: int, source: str = "docs", least: int | None = None) -> str:
    """doc_id, i, n, h of each run of ``size`` words of ``source`` (doc_id, w); runs of fewer words only if a text has no more than ``least``."""
    run = ", ".join(f"lead(word, {k}) OVER o" if k else "word" for k in range(size))
    fewer = f" OR (i = 1 AND n < {least})" if least else ""
    return f"""(
  SELECT doc_id, i, n, h FROM (
    SELECT doc_id, i, n, md5(array_to_string([{run}], ' ')) AS h
    FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i, len(w) AS n FROM {source})
    WINDOW o AS (PARTITION BY doc_id ORDER BY i))
  WHERE i <= n - {size - 1}{fewer})"""


# units of every text as a list; parts are slices of it
FILL_IN_MIDDLE = """
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS whole, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
         sha256('1:' || doc_id) AS d FROM documents),
drawn AS (
  SELECT *, len(units) AS n, list_transform([0, 1, 2, 3], lambda k: CAST('0x' || substr(d, 8 * k + 1, 8) AS BIGINT)) AS h FROM cut),
places AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
         CASE WHEN whole = '' OR contains(whole, '<P>') OR contains(whole, '<S>') OR contains(whole, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
              WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (
  SELECT *, array_to_string(units[1:a], '') AS p, array_to_string(units[a + 1:b], '') AS m, array_to_string(units[b + 1:n], '') AS s FROM places)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN whole WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(whole) AS restored_sha256
FROM parts"""


def chat_formatting(conflict: str) -> str:
    """A text that holds one of the template's strings gets a backslash into each of its ``<|``."""
    marks = rf"len(regexp_extract_all(text, '<\\*\|'))"
    size = len(chat.START) + len(chat.END) + 2
    return f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{conflict}'), (-1, 1, 'assistant', '{conflict}')),
shown AS (
  SELECT *, length(text) + CASE WHEN contains(text, '{chat.START}') OR contains(text, '{chat.END}') THEN {marks} ELSE 0 END AS chars FROM turns)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = '{chat.LOSS_ROLE}'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = '{chat.LOSS_ROLE}'), '')) AS loss_sha256,
       CAST(sum({size} + length(role) + chars) AS BIGINT) AS formatted_chars
FROM shown GROUP BY conv_id"""


# windows of 20 words; a window that starts earlier somewhere takes its words out of later ones
SUBSTRING_DEDUP = f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
windows AS {_windows(20)},
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS place FROM windows) WHERE place > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM later, range(20) r(k)),
places AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM docs),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
  FROM places ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs d LEFT JOIN kept USING (doc_id)"""

# sets of four-word shingles, links at 85 %, and the least document that links lead to
NGRAM_JOIN = rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
grams AS (
  SELECT DISTINCT doc_id, h AS g FROM {_windows(4, least=4)}),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * common >= 85 * (a.n + b.n - common)),
ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT r.x, w.y FROM reach r JOIN ways w ON w.x = r.y)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x) USING (doc_id)"""


def quality_rules(rules: QualityRules = QualityRules()) -> str:
    """Counts in the text, and lines that too many of a host's documents have; documents of the same lines count once."""
    return rf"""
WITH docs AS (SELECT doc_id, source, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, h) AS n FROM {_windows(5)}),
repeated AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM windows, range(5) r(k) WHERE windows.n > 1 GROUP BY doc_id),
raw_lines AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS place FROM docs),
lines AS (
  SELECT *, trim(lower(line), {_SPACE}) AS norm FROM raw_lines WHERE trim(line, {_SPACE}) <> ''),
dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY doc_id),
copies AS (SELECT doc_id, any_value(source) AS source, list(norm ORDER BY place) AS copy FROM lines GROUP BY doc_id),
hosts AS (SELECT source, count(DISTINCT copy) AS docs FROM copies GROUP BY source),
often AS (
  SELECT l.source, l.norm, count(DISTINCT copy) AS docs FROM lines l JOIN copies USING (doc_id) GROUP BY l.source, l.norm
  HAVING count(DISTINCT copy) >= {rules.line_docs}),
common AS (
  SELECT o.source, o.norm FROM often o JOIN hosts h ON o.source IS NOT DISTINCT FROM h.source
  WHERE o.docs >= {rules.line_share} * h.docs OR o.docs >= {rules.hot_docs}),
removed AS (
  SELECT doc_id, sum(len(regexp_extract_all(l.norm, '[^\x20\x09-\x0D]+'))) AS n
  FROM lines l JOIN common c ON l.norm = c.norm AND l.source IS NOT DISTINCT FROM c.source GROUP BY doc_id),
counted AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(dups.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(repeated.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(removed.n, 0) AS BIGINT) AS removed_words
  FROM docs d LEFT JOIN dups USING (doc_id) LEFT JOIN repeated USING (doc_id) LEFT JOIN removed USING (doc_id)),
judged AS (
  SELECT *, n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.repeat_percent} * n_words AS base_failed,
         removed_words > 0 AND (n_words - removed_words < {rules.min_left_words} OR n_words - removed_words < {rules.min_left_share} * n_words) AS depleted
  FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT depleted AS kept, removed_words
FROM judged"""


def centroid_clustering(how: Clustering = Clustering()) -> str:
    """Plain rounds over components as rows. Ids are unique and not null in the supplied tables."""
    steps = [f"""
vectors AS MATERIALIZED (
  SELECT vec_id, unnest(range({how.dimension})) AS k, unnest(embedding) AS raw FROM embeddings
  WHERE len(embedding) = {how.dimension} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {how.dimension}),
x AS MATERIALIZED (SELECT vec_id, k, CAST(floor({how.scale} * CAST(raw AS DOUBLE)) AS BIGINT) AS v FROM vectors),
first AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('{how.seed}:' || vec_id)) - 1 AS c FROM (SELECT DISTINCT vec_id FROM x)),
c0 AS MATERIALIZED (SELECT c, k, v FROM first JOIN x USING (vec_id) WHERE c < {how.centroids})"""]
    for turn in range(how.rounds + 1):
        steps.append(f"""
a{turn} AS MATERIALIZED (
  SELECT vec_id, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
    SELECT vec_id, c, CAST(sum((x.v - m.v) * (x.v - m.v)) AS BIGINT) AS d FROM x JOIN c{turn} m USING (k) GROUP BY vec_id, c)
  GROUP BY vec_id)""")
        if turn < how.rounds:  # floor of whole numbers, below zero too
            steps.append(f"""
c{turn + 1} AS MATERIALIZED (
  SELECT m.c, m.k, coalesce(n.v, m.v) AS v FROM c{turn} m LEFT JOIN (
    SELECT c, k, CAST((sum(v) - ((sum(v) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS v
    FROM x JOIN a{turn} USING (vec_id) GROUP BY c, k) n ON n.c = m.c AND n.k = m.k)""")
    last = how.rounds
    return f"""WITH {','.join(steps)},
digests AS (SELECT c, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY k)) AS digest FROM c{last} GROUP BY c)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, digest AS centroid_sha256
FROM a{last} JOIN digests USING (c)"""
