"""DuckDB SQL for the queries of this folder that SQL can express.

The others are tested against brute force: token ids and counts against the tokenizers
library, packed pieces token by token, URL templates against plain loops, fingerprints against
a byte-wise hash, language models against a plain model and held-out accuracy.
"""

# Every pair of a query and another usable vector, the products added up in order.
_NEIGHBOURS = """WITH usable AS (
SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
  FROM usable q JOIN usable c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 20 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored)
SELECT query_id, CAST(r AS INT) AS rank, vec_id, score FROM ranked WHERE r <= 20"""

# A digest's 160 bits in 32 groups of five, each a letter of the base32 alphabet.
_ARCHIVE = """WITH hashed AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
bits AS (SELECT page_id, hex, strlen(payload) AS n, list_aggregate(list_transform(range(1, 41), lambda i:
    substr('0000000100100011010001010110011110001001101010111100110111101111',
           4 * (instr('0123456789abcdef', substr(hex, i, 1)) - 1) + 1, 4)), 'string_agg', '') AS b FROM hashed),
based AS (SELECT page_id, hex, n, list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + 16 * CAST(substr(b, 5 * i + 1, 1) AS INT) + 8 * CAST(substr(b, 5 * i + 2, 1) AS INT) + 4 * CAST(substr(b, 5 * i + 3, 1) AS INT)
      + 2 * CAST(substr(b, 5 * i + 4, 1) AS INT) + CAST(substr(b, 5 * i + 5, 1) AS INT), 1)), 'string_agg', '') AS digest FROM bits),
firsts AS (SELECT hex, min(page_id) AS one FROM hashed GROUP BY hex)
SELECT page_id, n AS payload_bytes, digest AS payload_digest, CASE WHEN page_id = one THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> one THEN one END AS refers_to FROM based JOIN firsts USING (hex)"""

_WORDS = r"regexp_extract_all(coalesce({text}, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# All pairs that share a shingle, counted; then the smallest id that links lead to.
_JACCARD = f"""WITH RECURSIVE docs AS (SELECT doc_id, {_WORDS.format(text=_LOWER)} AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, list_aggregate(list_slice(w, i, i + 4), 'string_agg', ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM docs WHERE len(w) > 0) t),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
near AS (SELECT x, y FROM common c JOIN sizes p ON p.doc_id = c.x JOIN sizes q ON q.doc_id = c.y
  WHERE 100 * c.n >= 75 * (p.n + q.n - c.n)),
links AS (SELECT x, y FROM near UNION ALL SELECT y, x FROM near),
reached(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.y FROM reached r JOIN links l ON l.x = r.other),
lowest AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, l.component_id FROM documents d
JOIN lowest l ON l.doc_id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id"""

# Windows of 35 words by their text; a word goes if one of the 35 windows that hold it occurs twice.
_SUBSTRINGS = f"""WITH docs AS (SELECT doc_id, {_WORDS.format(text='text')} AS w FROM documents),
windows AS (SELECT doc_id, i, list_aggregate(list_slice(w, i, i + 34), 'string_agg', ' ') AS t
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM docs WHERE len(w) >= 35) x),
marked AS (SELECT doc_id, i, count(*) OVER (PARTITION BY t) > 1 AS again FROM windows),
placed AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM docs),
covered AS (SELECT p.doc_id, p.word, p.p, coalesce(bool_or(m.again) OVER (PARTITION BY p.doc_id ORDER BY p.p
  ROWS BETWEEN 34 PRECEDING AND CURRENT ROW), false) AS gone FROM placed p LEFT JOIN marked m ON m.doc_id = p.doc_id AND m.i = p.p),
summed AS (SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE gone) AS r, string_agg(word, ' ' ORDER BY p) FILTER (WHERE NOT gone) AS kept
  FROM covered GROUP BY doc_id)
SELECT d.doc_id, coalesce(s.n, 0) AS n_words, coalesce(s.r, 0) AS n_removed, sha256(coalesce(s.kept, '')) AS kept_sha256
FROM documents d LEFT JOIN summed s ON s.doc_id = d.doc_id"""

# CRC-32 byte by byte from a table that its polynomial gives; then counts per bucket, gains and the draw.
_IMPORTANCE = r"""WITH steps AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce([CAST(i AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i)) x),
texts AS (SELECT 's' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 't', item_id, text FROM benchmark),
words AS (SELECT side, id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM texts),
spelled AS (SELECT w, hex(encode(w)) AS h FROM (SELECT DISTINCT w FROM words) x),
bytes AS (SELECT w, list_transform(range(0, len(h) // 2), lambda i: CAST(16 * (instr('0123456789ABCDEF', substr(h, 2 * i + 1, 1)) - 1)
    + instr('0123456789ABCDEF', substr(h, 2 * i + 2, 1)) - 1 AS BIGINT)) AS b FROM spelled),
hashed AS (SELECT w, xor(list_reduce(list_concat([4294967295], b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000
    AS bucket FROM bytes, steps),
counted AS (SELECT bucket, count(*) FILTER (WHERE side = 's') AS s, count(*) FILTER (WHERE side = 't') AS t
  FROM words JOIN hashed USING (w) GROUP BY bucket),
totals AS (SELECT CAST(sum(s) AS BIGINT) AS all_s, CAST(sum(t) AS BIGINT) AS all_t FROM counted),
gains AS (SELECT bucket, CAST(floor(1000 * ln((CAST(t + 1 AS DOUBLE) * (all_s + 10000)) / (CAST(s + 1 AS DOUBLE) * (all_t + 10000)))) AS BIGINT) AS gain
  FROM counted, totals),
summed AS (SELECT id, count(*) AS n, CAST(sum(gain) AS BIGINT) AS weight FROM words JOIN hashed USING (w) JOIN gains USING (bucket)
  WHERE side = 's' GROUP BY id),
noisy AS (SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
    CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) AS h FROM documents LEFT JOIN summed ON id = doc_id),
scored AS (SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + CAST(0.5 AS DOUBLE)) / 4294967296))) AS BIGINT) AS score FROM noisy),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT s.doc_id, s.n_features, s.weight, s.score, CASE WHEN r <= n * 10 // 100 THEN r END AS rank
FROM scored s LEFT JOIN ranked ON ranked.doc_id = s.doc_id"""


def _clusters() -> str:
    """Three rounds of all distances between vectors and centroids, and the final assignment."""
    nearest = """n{i} AS (SELECT row, k, d FROM (SELECT row, k, d, row_number() OVER (PARTITION BY row ORDER BY d, k) AS r
  FROM (SELECT x.row, c.k, sum((x.v - c.v) * (x.v - c.v)) AS d FROM parts x JOIN c{i} c USING (j) GROUP BY x.row, c.k) a) b WHERE r = 1)"""
    moved = """c{n} AS (SELECT c.k, c.j, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN (SELECT n.k, x.j,
    (sum(x.v) - ((sum(x.v) % count(*)) + count(*)) % count(*)) // count(*) AS v FROM n{i} n JOIN parts x USING (row) GROUP BY n.k, x.j) m
  ON m.k = c.k AND m.j = c.j)"""
    rounds = ",\n".join(f"{nearest.format(i=i)},\n{moved.format(i=i, n=i + 1)}" for i in range(3))
    return f"""WITH kept AS (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS HUGEINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT row, unnest(range(64)) AS j, unnest(v) AS v FROM kept),
starts AS (SELECT row, row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS k FROM kept),
c0 AS (SELECT k, j, v FROM starts JOIN parts USING (row) WHERE k < 16),
{rounds},
{nearest.format(i=3)},
digests AS (SELECT k, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY j)) AS digest FROM c3 GROUP BY k)
SELECT vec_id, CAST(k AS INT) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, digest AS centroid_sha256
FROM n3 JOIN kept USING (row) JOIN digests USING (k)"""


LLM_ORACLES: dict[str, str] = {
    "op1_block_neighbours": _NEIGHBOURS,
    "op2_warc_bundles": _ARCHIVE,
    "op4_ngram_jaccard": _JACCARD,
    "op9_substring_dedup": _SUBSTRINGS,
    "op12_importance_resampling": _IMPORTANCE,
    "op13_zone_clusters": _clusters(),
}
