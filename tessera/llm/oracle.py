"""Plain SQL (DuckDB) of the queries whose results their contracts fix in whole: window by window, line by line."""
from __future__ import annotations

_WORDS = "regexp_extract_all(coalesce({0}, ''), '[^\\x20\\x09-\\x0D]+')"

SUBSTRING_DEDUP = f"""
WITH docs AS (SELECT doc_id, {_WORDS.format('text')} AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM docs),
windows AS (SELECT doc_id, i, array_to_string(list_slice(w, i + 1, i + 20), ' ') AS t
            FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 19, 0))) AS i FROM docs)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY t ORDER BY doc_id, i) AS nth FROM windows) WHERE nth > 1),
marked AS (SELECT words.doc_id, words.i, word, max(CASE WHEN later.i IS NULL THEN 0 ELSE 1 END) OVER
             (PARTITION BY words.doc_id ORDER BY words.i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone
           FROM words LEFT JOIN later USING (doc_id, i))
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(m.n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(m.kept, '')) AS kept_sha256
FROM docs d LEFT JOIN (SELECT doc_id, sum(gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone = 0) AS kept
                       FROM marked GROUP BY doc_id) m USING (doc_id)"""

LINE_DEDUP = f"""
WITH docs AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
lines AS (SELECT doc_id, line, i, {_WORDS.format('line')} AS w
          FROM (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS i FROM docs)),
named AS (SELECT *, CASE WHEN len(w) > 0 THEN row_number() OVER (PARTITION BY array_to_string(w, ' ') ORDER BY doc_id, i) ELSE 1 END AS nth
          FROM lines),
worded AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS p, hash(array_to_string(w, ' ')) AS h,
                  count(*) OVER (PARTITION BY array_to_string(w, ' ')) AS places FROM lines WHERE len(w) > 0),
stretches AS (SELECT doc_id, g, min(p) AS p0, list(h ORDER BY p) AS hs
              FROM (SELECT *, p - row_number() OVER (PARTITION BY doc_id ORDER BY p) AS g FROM worded WHERE places > 1) GROUP BY doc_id, g),
suffixes AS (SELECT doc_id, p0 + k AS p, hs[k + 1:] AS s FROM (SELECT *, unnest(range(len(hs))) AS k FROM stretches)),
neighbours AS (SELECT doc_id, p, s, lag(s) OVER o AS a, lead(s) OVER o AS b FROM suffixes WINDOW o AS (ORDER BY s)),
lcps AS (SELECT doc_id, p, greatest(
           coalesce(list_position(list_transform(range(1, least(len(s), len(a)) + 1), lambda x: s[x] <> a[x]), true) - 1, least(len(s), len(a)), 0),
           coalesce(list_position(list_transform(range(1, least(len(s), len(b)) + 1), lambda x: s[x] <> b[x]), true) - 1, least(len(s), len(b)), 0)) AS k
         FROM neighbours),
runs AS (SELECT doc_id, count(*) FILTER (WHERE k0 IS NULL OR k0 <= k) AS n_runs, max(k) AS longest_run
         FROM (SELECT *, CASE WHEN lag(p) OVER d = p - 1 THEN lag(k) OVER d END AS k0 FROM lcps WINDOW d AS (PARTITION BY doc_id ORDER BY p))
         GROUP BY doc_id)
SELECT d.doc_id, coalesce(r.n_runs, 0)::BIGINT AS n_runs, coalesce(r.longest_run, 0)::BIGINT AS longest_run, coalesce(n.n_lines, 0)::BIGINT AS n_lines, coalesce(n.n_removed, 0)::BIGINT AS n_removed,
       coalesce(n.n_words, 0)::BIGINT AS n_words, coalesce(n.n_removed_words, 0)::BIGINT AS n_removed_words,
       CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(n.kept, '')) END AS kept_sha256
FROM docs d LEFT JOIN (
  SELECT doc_id, count(*) FILTER (WHERE len(w) > 0) AS n_lines, count(*) FILTER (WHERE nth > 1) AS n_removed,
         sum(len(w)) AS n_words, sum(len(w)) FILTER (WHERE nth > 1) AS n_removed_words,
         string_agg(line, chr(10) ORDER BY i) FILTER (WHERE nth = 1) AS kept
  FROM named GROUP BY doc_id) n USING (doc_id) LEFT JOIN runs r USING (doc_id)"""
