"""SQL twins of the queries that one statement expresses."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"
LOW = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_REMOVED = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
win AS (SELECT doc_id, p, md5(array_to_string(w[p:p + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM w WHERE len(w) >= 50)),
hit AS (SELECT doc_id, p FROM (SELECT *, min(doc_id) OVER (PARTITION BY h) AS first FROM win) WHERE first < doc_id),
gone AS (SELECT DISTINCT doc_id, p + k AS p FROM hit, range(50) AS t(k)),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
cut AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(cut.n, 0)::BIGINT AS n_removed,
  sha256(coalesce(kept.t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id) LEFT JOIN cut USING (doc_id)"""

_CLEAN = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
grams AS (SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS g
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS p
    FROM (SELECT *, least(len(w), 10) AS n FROM b WHERE len(w) > 0))),
win AS (SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS g
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS p
    FROM d, (SELECT DISTINCT n FROM grams) WHERE len(w) >= n)),
hit AS (SELECT doc_id, item_id, win.n, p FROM win JOIN grams ON grams.n = win.n AND grams.g = win.g),
cover AS (SELECT doc_id, count(DISTINCT p + k) AS n_hit FROM hit, range(10) AS t(k) WHERE k < n GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(i, ',' ORDER BY i) AS s
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hit) GROUP BY doc_id)
SELECT doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n, 0)::BIGINT AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN items USING (doc_id)"""

_NEAR = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({LOW}, '{WORD}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + least(len(w), 5) - 1], ' ') AS g
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM shared JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 75 * (p.n + q.n - c)),
sym AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.a, sym.y FROM reach JOIN sym ON sym.x = reach.b),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM c LEFT JOIN n USING (doc_id)"""

_URLS = """
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN regexp_extract(url, '://([^/?#]*)', 1) ELSE '' END AS raw,
    CASE WHEN contains(url, '://') THEN regexp_extract(url, '://[^/?#]*([^?#]*)', 1) ELSE '' END AS path FROM pages),
h AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM u),
r(host, path, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
best AS (SELECT page_id, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
    arg_max(verdict, length(r.host || r.path)) AS verdict
  FROM h JOIN r ON (h.host = r.host OR ends_with(h.host, '.' || r.host)) AND starts_with(h.path, r.path) GROUP BY page_id)
SELECT h.page_id, h.host, h.path, best.rule, coalesce(best.verdict, 'allow') AS verdict FROM h LEFT JOIN best USING (page_id)"""

_COPIES = f"""
WITH d AS (SELECT doc_id, coalesce({LOW}, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256 FROM d"""

_PHRASES = rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({LOW}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, row_number() OVER () AS piece, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
o AS (SELECT lang, piece, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM w),
seq AS (SELECT lang, x, lead(x) OVER p AS y, lead(x, 2) OVER p AS z FROM o WINDOW p AS (PARTITION BY piece ORDER BY i)),
g AS (SELECT lang, 1 AS k, x AS phrase, count(*) AS f FROM seq GROUP BY ALL
  UNION ALL SELECT lang, 2, x || ' ' || y, count(*) FROM seq WHERE y IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 3, x || ' ' || y || ' ' || z, count(*) FROM seq WHERE z IS NOT NULL GROUP BY ALL),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM g WHERE k >= 2 AND f >= 10),
cuts AS (SELECT lang, c.k, phrase, w, c.f AS a, j, array_to_string(w[1:j], ' ') AS x, array_to_string(w[j + 1:c.k], ' ') AS y
  FROM c, (VALUES (1), (2)) AS t(j) WHERE j < c.k),
scored AS (SELECT cuts.*, x.f AS l, y.f AS r, (1000000::HUGEINT * a * a // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts JOIN g x ON x.lang = cuts.lang AND x.phrase = cuts.x AND x.k = j
    JOIN g y ON y.lang = cuts.lang AND y.phrase = cuts.y AND y.k = cuts.k - j),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inside AS (SELECT lang, array_to_string(w[i:i + 1], ' ') AS phrase, max(f) AS most FROM c, (VALUES (1), (2)) AS t(i) WHERE k = 3 GROUP BY ALL),
left_ AS (SELECT best.* FROM best LEFT JOIN inside ON best.lang = inside.lang AND best.phrase = inside.phrase AND best.k = 2
  WHERE NOT coalesce(100 * most >= 50 * a, false)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM left_)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000"""

ORACLE: dict[str, str] = {
    "op2_minhash_near_dedup": _NEAR,
    "op6_substring_fm": _REMOVED,
    "op7_decontamination": _CLEAN,
    "op8_url_filter": _URLS,
    "op11_extendible_dedup": _COPIES,
    "op12_collocations": _PHRASES,
}
