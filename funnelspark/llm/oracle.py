"""DuckDB SQL of the operators that SQL can express."""

# Words, windows of each length that an item has (13, or fewer for a short
# item), occurrences by equality of the joined words, then words under any
# occurrence.
DECONTAMINATION_SQL = r"""
WITH lowered AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
d AS (SELECT doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM lowered),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM benchmark WHERE item_id IS NOT NULL),
bl AS (SELECT item, w, least(13, len(w)) AS size FROM b WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item, size, array_to_string(w[i:i + size - 1], ' ') AS win
  FROM (SELECT item, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM bl)),
sizes AS (SELECT DISTINCT size FROM windows),
grams AS (
  SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM d, sizes WHERE len(w) >= size)),
hits AS (SELECT g.doc_id, g.i, g.size, x.item FROM grams g JOIN windows x USING (size, win)),
marked AS (SELECT doc_id, count(DISTINCT p) AS n_hit
           FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words,
       CAST(coalesce(m.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(i.n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(i.ids, '')) AS items_sha256,
       coalesce(m.n_hit, 0) > 0 AND 20 * coalesce(m.n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN marked m USING (doc_id) LEFT JOIN items i USING (doc_id)
"""

# Shingle sets, links by counting common shingles, components by propagating the
# smallest id along links.
JACCARD_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w FROM documents WHERE doc_id IS NOT NULL),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS sh
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i
            FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
sets AS (SELECT doc_id, md5(string_agg(sh, chr(10) ORDER BY sh)) AS set_key FROM s GROUP BY doc_id),
reps AS (SELECT set_key, min(doc_id) AS rep FROM sets GROUP BY set_key),
r AS (SELECT s.rep AS a, s2.sh FROM reps s JOIN s s2 ON s2.doc_id = s.rep),
common AS (SELECT x.a, y.a AS b, count(*) AS c FROM r x JOIN r y ON x.sh = y.sh AND x.a < y.a
           GROUP BY x.a, y.a),
links AS (SELECT c.a, c.b FROM common c JOIN n na ON na.doc_id = c.a JOIN n nb ON nb.doc_id = c.b
          WHERE 100 * c.c >= 80 * (na.n + nb.n - c.c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT rep, rep FROM reps UNION
                SELECT reach.a, e.b FROM reach JOIN both_ways e ON reach.b = e.a),
comp AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles,
       CAST(coalesce(comp.component_id, d.doc_id) AS BIGINT) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN sets USING (doc_id) LEFT JOIN reps USING (set_key)
LEFT JOIN comp ON comp.a = reps.rep
"""

# Every 200-byte string by its digest (texts as hexadecimal, two digits a byte), those
# that start twice, the stretches they cover, and the pieces between.
REPEATS_SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents WHERE doc_id IS NOT NULL),
p AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 400)) AS m
      FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 199)) AS i FROM d WHERE len(h) >= 400)),
twice AS (SELECT m FROM p GROUP BY m HAVING count(*) > 1),
hit AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before
        FROM p JOIN twice USING (m)),
run AS (SELECT doc_id, i, sum(CASE WHEN before IS NULL OR i > before + 200 THEN 1 ELSE 0 END)
          OVER (PARTITION BY doc_id ORDER BY i) AS run FROM hit),
span AS (SELECT doc_id, run, min(i) AS s, max(i) + 200 AS e FROM run GROUP BY doc_id, run),
gap AS (SELECT doc_id, s, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS from_at FROM span),
piece AS (SELECT doc_id, s AS place, substr(h, 2 * from_at + 1, 2 * (s - from_at)) AS part FROM gap JOIN d USING (doc_id)
          UNION ALL
          SELECT doc_id, len(h) AS place, substr(h, 2 * coalesce(e, 0) + 1) AS part
          FROM d LEFT JOIN (SELECT doc_id, max(e) AS e FROM span GROUP BY doc_id) USING (doc_id)),
kept AS (SELECT doc_id, string_agg(part, '' ORDER BY place) AS k FROM piece GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.h) // 2 AS BIGINT) AS n_bytes,
       CAST((len(d.h) - len(k)) // 2 AS BIGINT) AS n_removed,
       CAST(coalesce(n, 0) AS BIGINT) AS n_spans, sha256(unhex(k)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS n FROM span GROUP BY doc_id) USING (doc_id)
"""

# Terms of items and documents, weights from document frequencies, integer scores.
LEXICAL_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents WHERE doc_id IS NOT NULL),
lens AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n FROM d WHERE len(w) > 0),
totals AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS l FROM lens),
b AS (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark WHERE item_id IS NOT NULL),
q AS (SELECT item_id, term, count(*) AS q FROM b GROUP BY item_id, term),
terms AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM d)
          WHERE term IN (SELECT term FROM q) GROUP BY doc_id, term),
df AS (SELECT term, count(*) AS df FROM terms GROUP BY term),
weights AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * nd + 2) / (2.0::DOUBLE * df + 1))) AS BIGINT) AS w
            FROM df, totals),
m AS (SELECT doc_id, 75 + (25 * n * nd) // l AS m FROM lens, totals),
scores AS (SELECT item_id, doc_id,
                  CAST(sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
           FROM q JOIN terms USING (term) JOIN weights USING (term) JOIN m USING (doc_id)
           GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
      FROM scores WHERE score > 0) WHERE rank <= 20
"""

# All scores of the anchors, the first five of the same label, the first five of others in
# each window.
HARD_NEGATIVES_SQL = r"""
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
           FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
             CAST(list_sum(list_transform(list_zip(a.v, r.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM e a JOIN e r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
pos AS (SELECT anchor_id, id AS positive_id, score AS positive_score
        FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS r
              FROM p WHERE same) WHERE r <= 5),
neg AS (SELECT pos.*, id AS negative_id, score AS negative_score,
               row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS rank
        FROM pos JOIN p USING (anchor_id)
        WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM neg WHERE rank <= 5
"""

# Lines and their keys, keys of ten or more documents, the lines of other keys joined again.
LINES_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
x AS (SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS p FROM d),
k AS (SELECT doc_id, p, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM x),
c AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
kept AS (SELECT doc_id, count(*) AS n, string_agg(line, chr(10) ORDER BY p) AS t
         FROM k WHERE key NOT IN (SELECT key FROM c) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.l) AS BIGINT) AS n_lines, CAST(len(d.l) - coalesce(kept.n, 0) AS BIGINT) AS n_dropped,
       sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
