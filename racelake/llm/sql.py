"""DuckDB SQL of operators whose whole result SQL can state (``doc_id`` names a document)."""

from __future__ import annotations

from racelake.llm.op2_repetition import COVER_LIMITS, LINE_LIMIT, MAX_REPEAT_PERCENT, MIN_WORDS, TOP_LIMITS

_WORD = r"'[^\x20\x09-\x0D]+'"

# the words from one on, joined, and how many there are
_GRAM = """string_agg(word, ' ') OVER g AS gram, count(*) OVER g AS held
  FROM words WINDOW g AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {last} FOLLOWING)"""

SUFFIX = """
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
parts AS (  -- short pieces, so that no substring is cut out of a long text
  SELECT doc_id, p * 500 AS base, substr(h, 1000 * p + 1, 1098) AS piece, octet_length(encode(h)) // 2 AS size
  FROM texts, unnest(range(0, octet_length(encode(h)) // 1000 + 1)) AS u(p)),
bytes AS (
  SELECT doc_id, base + j AS pos, substr(piece, 2 * j + 1, 2) AS byte,
         CASE WHEN base + j + 50 <= size THEN substr(piece, 2 * j + 1, 100) END AS gram
  FROM parts, unnest(range(0, least(500, size - base))) AS u(j)),
firsts AS (SELECT gram, min(doc_id) AS low FROM bytes WHERE gram IS NOT NULL GROUP BY gram),
covered AS (
  SELECT doc_id, pos, byte, coalesce(max(low < doc_id) OVER (
           PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), false) AS gone
  FROM bytes LEFT JOIN firsts USING (gram)),
opened AS (
  SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY pos), false) AS opens FROM covered),
summed AS (
  SELECT doc_id, count(*) AS n_bytes, count(*) FILTER (gone) AS n_removed, count(*) FILTER (opens) AS n_spans,
         coalesce(string_agg(byte, '' ORDER BY pos) FILTER (NOT gone), '') AS kept
  FROM opened GROUP BY doc_id)
SELECT doc_id, coalesce(n_bytes, 0)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM texts LEFT JOIN summed USING (doc_id)
"""

JACCARD = f"""
WITH RECURSIVE tokens AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), {_WORD}) AS w FROM documents),
words AS (SELECT doc_id, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM tokens),
windows AS (SELECT doc_id, n, i, {_GRAM.format(last=4)}),
grams AS (SELECT DISTINCT doc_id, gram FROM windows WHERE held = 5 OR (n < 5 AND i = 1)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * common.n >= 80 * (x.n + y.n - common.n)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sizes
  UNION SELECT reached.doc_id, both_ways.b FROM reached JOIN both_ways ON reached.other = both_ways.a),
heads AS (SELECT doc_id, min(other) AS head FROM reached GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(head, doc_id)::BIGINT AS component_id
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN heads USING (doc_id)
"""


def _repetition() -> str:
    limits = ", ".join(f"({n}, {x!r}::DOUBLE, {kind})" for kind, d in ((0, TOP_LIMITS), (1, COVER_LIMITS)) for n, x in d.items())
    grams = " UNION ALL ".join(f"""
  SELECT doc_id, {n} AS n, {kind} AS kind, i, {_GRAM.format(last=n - 1)} QUALIFY held = {n}"""
                               for kind, d in ((0, TOP_LIMITS), (1, COVER_LIMITS)) for n in d)
    return f"""
WITH tokens AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {_WORD}) AS w
                FROM documents),
words AS (SELECT doc_id, i, word, length(word) AS chars
          FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM tokens)),
limits(n, most, kind) AS (VALUES {limits}),
grams AS ({grams}),
ranked AS (
  SELECT doc_id, n, kind, i, gram, count(*) OVER g AS times, row_number() OVER (g ORDER BY i) AS nth
  FROM grams WINDOW g AS (PARTITION BY doc_id, n, gram)),
totals AS (SELECT doc_id, greatest(sum(chars), 1) AS total FROM words GROUP BY doc_id),
tops AS (
  SELECT doc_id, n, max(CASE WHEN times >= 3 THEN times * (length(gram) - n + 1) ELSE 0 END) / any_value(total)::DOUBLE AS share
  FROM ranked JOIN totals USING (doc_id) WHERE kind = 0 AND times > 1 GROUP BY doc_id, n),
marked AS (  -- words in a window found before, and words in a window found twice
  SELECT DISTINCT doc_id, n, i + j AS i, nth > 1 AS again
  FROM ranked, unnest(range(0, n)) AS u(j) WHERE kind = 1 AND times > 1),
covers AS (
  SELECT doc_id, n, sum(chars) / any_value(total)::DOUBLE AS share
  FROM marked JOIN words USING (doc_id, i) JOIN totals USING (doc_id) WHERE again GROUP BY doc_id, n),
repeats AS (SELECT doc_id, count(DISTINCT i) AS n_repeat_words FROM marked WHERE n = 5 GROUP BY doc_id),
lines AS (
  SELECT doc_id, line, pos, row_number() OVER (PARTITION BY doc_id, line ORDER BY pos) AS nth
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
        FROM tokens)),
again AS (
  SELECT doc_id, count(*) AS n_dup_lines, sum(length(array_to_string(regexp_extract_all(line, {_WORD}), ''))) AS chars
  FROM lines WHERE nth > 1 AND regexp_matches(line, {_WORD}) GROUP BY doc_id),
verdicts AS (
  SELECT doc_id, max(share) FILTER (kind = 0) AS top, max(share) FILTER (kind = 1) AS cover, bool_and(share <= most) AS passes
  FROM (SELECT doc_id, n, share, 0 AS kind FROM tops UNION ALL SELECT doc_id, n, share, 1 FROM covers)
  JOIN limits USING (n, kind) GROUP BY doc_id),
measured AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(top, 0) AS top, coalesce(cover, 0) AS cover,
         coalesce(chars / total::DOUBLE, 0) AS lines_share, coalesce(passes, true) AS passes
  FROM tokens LEFT JOIN totals USING (doc_id) LEFT JOIN again USING (doc_id) LEFT JOIN repeats USING (doc_id)
  LEFT JOIN verdicts USING (doc_id)),
judged AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM measured)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, top::DOUBLE AS top_share,
       cover::DOUBLE AS cover_share, lines_share::DOUBLE AS line_share, base_failed,
       NOT base_failed AND passes AND lines_share <= {LINE_LIMIT!r} AS kept
FROM judged
"""


REPETITION = _repetition()
