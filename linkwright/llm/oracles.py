"""DuckDB SQL for operators whose result SQL can express, written for itself."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACED = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text: str, pattern: str, lower: bool) -> str:
    text = f"coalesce({text}, '')"
    return f"regexp_extract_all({f'translate({text}, {_UPPER!r}, {_LOWER!r})' if lower else text}, '{pattern}')"


#: Windows as texts, the first document of each, and the words that later ones cover.
OP2 = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_words('text', _SPACED, False)} AS w FROM documents),
starts AS (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM docs WHERE len(w) >= 50),
windows AS (SELECT r, doc_id, p, array_to_string(w[p:p + 49], ' ') AS words FROM starts),
firsts AS (SELECT words, min(doc_id) AS doc_id FROM windows GROUP BY words HAVING count(*) > 1),
again AS (SELECT x.r, x.p FROM windows x JOIN firsts f ON x.words = f.words WHERE f.doc_id < x.doc_id),
gone AS (SELECT DISTINCT r, unnest(range(p, p + 50)) AS i FROM again),
each AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM docs),
kept AS (SELECT e.r, string_agg(e.word, ' ' ORDER BY e.i) AS text FROM each e ANTI JOIN gone g ON e.r = g.r AND e.i = g.i GROUP BY e.r),
removed AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(g.n, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k ON k.r = d.r LEFT JOIN removed g ON g.r = d.r
"""

#: Distinct shingles as texts, all pairs that share one, and what links reach.
OP3 = f"""
WITH RECURSIVE docs AS (SELECT doc_id, {_words('text', _SPACED, True)} AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM docs WHERE len(w) > 0),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 4], ' ') AS s FROM starts),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, least(d.doc_id, coalesce(l.b, d.doc_id)) AS component_id, coalesce(l.b, d.doc_id) >= d.doc_id AS kept
FROM docs d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN least l ON l.a = d.doc_id
"""

#: Windows of either side as texts, for each length that an item's windows have.
OP5 = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_words('text', _ALNUM, True)} AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_words('text', _ALNUM, True)} AS w FROM benchmark WHERE item_id IS NOT NULL),
parts AS (SELECT item, w, least(len(w), 10) AS size, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM items WHERE len(w) > 0),
asked AS (SELECT DISTINCT item, size, array_to_string(w[p:p + size - 1], ' ') AS words FROM parts),
lengths AS (SELECT DISTINCT size FROM asked),
starts AS (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM docs, lengths WHERE len(w) >= size),
hits AS (SELECT s.r, s.p, s.size, a.item FROM starts s JOIN asked a ON a.size = s.size AND a.words = array_to_string(s.w[s.p:s.p + s.size - 1], ' ')),
hit AS (SELECT r, count(DISTINCT i) AS n FROM (SELECT r, unnest(range(p, p + size)) AS i FROM hits) GROUP BY r),
who AS (SELECT r, list_sort(list(DISTINCT item)) AS items FROM hits GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n, 0) AS n_hit, CAST(coalesce(len(x.items), 0) AS BIGINT) AS n_items,
  sha256(coalesce(array_to_string(x.items, ','), '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit h ON h.r = d.r LEFT JOIN who x ON x.r = d.r
"""

#: All pairs of lines that share one of their rarest shingles: at a similarity of 0.8 of n shingles, one of the
#: n - ceil(0.8 n) + 1 rarest of either line is shared.
OP4 = """
WITH RECURSIVE split AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL),
parts AS (SELECT doc_id, unnest(parts) AS line, unnest(range(0, len(parts))) AS line_no FROM split),
norms AS (SELECT doc_id, line_no, trim(regexp_replace(lower(line), '[ \\t\\x0B\\f\\r]+', ' ', 'g')) AS norm FROM parts),
lines AS (SELECT doc_id, line_no, norm, dense_rank() OVER (ORDER BY norm) AS node FROM norms WHERE norm <> ''),
nodes AS (SELECT DISTINCT node, norm FROM lines),
starts AS (SELECT node, norm, unnest(range(1, greatest(length(norm) - 7, 1) + 1)) AS p FROM nodes),
shingles AS (SELECT DISTINCT node, substr(norm, p, 8) AS s FROM starts),
sizes AS (SELECT node, count(*) AS n FROM shingles GROUP BY node),
common AS (SELECT s, count(*) AS df FROM shingles GROUP BY s),
ranked AS (SELECT x.node, x.s, z.n, row_number() OVER (PARTITION BY x.node ORDER BY c.df, x.s) AS place FROM shingles x JOIN common c ON c.s = x.s JOIN sizes z ON z.node = x.node),
rare AS (SELECT node, s, n FROM ranked WHERE place <= n - (4 * n + 4) // 5 + 1),
pairs AS (SELECT DISTINCT x.node AS a, y.node AS b FROM rare x JOIN rare y ON x.s = y.s AND x.node < y.node AND 5 * least(x.n, y.n) >= 4 * greatest(x.n, y.n)),
shared AS (SELECT a, b, count(*) AS k FROM pairs JOIN shingles x ON x.node = a JOIN shingles y ON y.node = b AND y.s = x.s GROUP BY a, b),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.node = a JOIN sizes y ON y.node = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
named AS (SELECT l.doc_id, l.line_no, least(l.node, coalesce(x.b, l.node)) AS component FROM lines l LEFT JOIN least x ON x.a = l.node),
firsts AS (SELECT *, min(struct_pack(d := doc_id, l := line_no)) OVER (PARTITION BY component) AS f FROM named),
judged AS (SELECT doc_id, line_no, doc_id = f.d AND line_no = f.l AS kept FROM firsts)
SELECT d.doc_id, count(j.line_no) AS n_lines, count(*) FILTER (WHERE NOT j.kept) AS n_removed,
  coalesce(string_agg(CAST(j.line_no AS VARCHAR), ',' ORDER BY j.line_no) FILTER (WHERE NOT j.kept), '') AS removed_lines
FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN judged j ON j.doc_id = d.doc_id GROUP BY d.doc_id
"""
