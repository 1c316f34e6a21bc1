"""DuckDB twins of the registered queries, where SQL can express them."""

from __future__ import annotations

#: Distinct words per line, rarest first; every pair that shares one of the
#: first n - ceil(0.8 n) + 1 is compared in full (under four words, only equal sets are similar).
LINE_DEDUP = r"""
WITH lines AS (
  SELECT doc_id, i - 1 AS line_no, ls[i] AS line,
         list_distinct(list_filter(string_split_regex(lower(ls[i]), '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS w
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i
        FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM {docs} WHERE text IS NOT NULL))),
sets AS (SELECT list_sort(w) AS w, len(w) AS n, min((doc_id, line_no)) AS first FROM lines WHERE len(w) > 0 GROUP BY 1, 2),
tokens AS (SELECT first, n, unnest(w) AS t FROM sets WHERE n >= 4),
ranked AS (SELECT t, first, n, row_number() OVER (PARTITION BY first ORDER BY df, t) AS r
           FROM tokens JOIN (SELECT t, count(*) AS df FROM tokens GROUP BY t) USING (t)),
rare AS (SELECT t, first, n FROM ranked WHERE r <= n - ceil(n * 8 / 10.0) + 1),
pairs AS (SELECT DISTINCT a.first AS a, b.first AS b FROM rare a JOIN rare b ON a.t = b.t AND b.first < a.first
          AND 10 * least(a.n, b.n) >= 8 * greatest(a.n, b.n)),
gone AS (SELECT DISTINCT a FROM (
  SELECT a, len(list_intersect(x.w, y.w)) AS common, x.n + y.n AS total
  FROM pairs JOIN sets x ON x.first = a JOIN sets y ON y.first = b) WHERE 100 * common >= 80 * (total - common)),
stays AS (SELECT first FROM sets WHERE first NOT IN (SELECT a FROM gone)),
marked AS (SELECT doc_id, line_no, line, len(w) > 0 AND (doc_id, line_no) NOT IN (SELECT first FROM stays) AS lost FROM lines),
cleaned AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_removed,
                   coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE NOT lost), '') AS text FROM marked GROUP BY doc_id)
"""

#: CRC-32 by its table, and Skilling's transform of the cells, step by step.
HILBERT = """
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t),
bytes AS (SELECT doc_id, list_transform(range(octet_length(encode(x))), lambda i: ('0x' || substr(hex(encode(x)), 2 * i + 1, 2))::BIGINT) AS b
          FROM (SELECT doc_id, coalesce(text, '') AS x FROM documents)),
crcs AS (SELECT doc_id, xor(list_reduce(b, lambda c, y: xor(c >> 8, t[(xor(c, y) & 255) + 1]), 4294967295::BIGINT), 4294967295) AS crc FROM bytes, crc),
ends AS (SELECT count(*) AS total, min(doc_id) AS low, max(doc_id) AS high FROM documents),
base AS (SELECT doc_id, crc, octet_length(encode(coalesce(text, ''))) + 1 AS size,
    ('0x' || substr(md5(coalesce(lang, '')), 1, 1))::INT AS x0, ('0x' || substr(md5(coalesce(source, '')), 1, 1))::INT AS x1,
    least(15, length(bin(octet_length(encode(coalesce(text, ''))) + 1)) - 1)::INT AS x2,
    least(15, floor((doc_id - low) / (high - low + 1.0) * 16))::INT AS x3,
    ('0x' || substr(md5(doc_id::VARCHAR || ':' || crc::VARCHAR), 1, 8))::BIGINT AS h FROM documents JOIN crcs USING (doc_id), ends),
undo AS (
  SELECT x0 AS c0, x1 AS c1, x2 AS c2, x3 AS c3, x0 AS a0, x1 AS a1, x2 AS a2, x3 AS a3, 0 AS k FROM (SELECT DISTINCT x0, x1, x2, x3 FROM base)
  UNION ALL
  SELECT c0, c1, c2, c3,
    CASE WHEN a & q <> 0 THEN xor(a0, q - 1) WHEN i = 0 THEN a0 ELSE xor(a0, xor(a0, a) & (q - 1)) END,
    CASE WHEN a & q = 0 AND i = 1 THEN xor(a1, xor(a0, a1) & (q - 1)) ELSE a1 END,
    CASE WHEN a & q = 0 AND i = 2 THEN xor(a2, xor(a0, a2) & (q - 1)) ELSE a2 END,
    CASE WHEN a & q = 0 AND i = 3 THEN xor(a3, xor(a0, a3) & (q - 1)) ELSE a3 END, k + 1
  FROM (SELECT *, (8 >> (k // 4))::INT AS q, k % 4 AS i, CASE k % 4 WHEN 0 THEN a0 WHEN 1 THEN a1 WHEN 2 THEN a2 ELSE a3 END AS a FROM undo WHERE k < 12)),
gray AS (SELECT c0, c1, c2, c3, a0 AS g0, xor(a0, a1) AS g1, xor(xor(a0, a1), a2) AS g2, xor(xor(xor(a0, a1), a2), a3) AS g3 FROM undo WHERE k = 12),
turned AS (SELECT *, xor(xor(CASE WHEN g3 & 2 <> 0 THEN 1 ELSE 0 END, CASE WHEN g3 & 4 <> 0 THEN 3 ELSE 0 END), CASE WHEN g3 & 8 <> 0 THEN 7 ELSE 0 END) AS t FROM gray),
curves AS (SELECT c0, c1, c2, c3, list_sum(list_transform(range(16), lambda k:
    ((([xor(g0, t), xor(g1, t), xor(g2, t), xor(g3, t)])[k % 4 + 1] >> (3 - k // 4)) & 1) << (15 - k)))::BIGINT AS curve FROM turned),
placed AS (SELECT doc_id, size, crc, curve, total, row_number() OVER (ORDER BY curve, h, doc_id, size, crc) - 1 AS r
           FROM base JOIN curves ON x0 = c0 AND x1 = c1 AND x2 = c2 AND x3 = c3, ends)
SELECT doc_id, size::BIGINT AS size, crc AS text_crc32, 'rows' AS law, (r * 16 // total)::INT AS shard,
       (r - ((r * 16 // total) * total + 15) // 16)::BIGINT AS slot, NULL::INT AS grown_shard, curve FROM placed"""

#: Name and pattern (a group's least length is checked for the first) of the secret rules, in order.
SECRETS = (("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
            r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
           ("access", "()(AKIA[A-Z0-9]{16,})"), ("hex", "()([0-9a-f]{24,})"), ("pem", "()(-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----)"),
           ("jwt", r"()(eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})"))
#: Matches and the gaps between them give the places: a match begins after all earlier gaps and matches.
SECRET_RULE = """SELECT row, {place} AS place, '{rule}' AS rule, string_split_regex(text, '{pattern}') AS gaps,
  regexp_extract_all(text, '{pattern}') AS hits, regexp_extract_all(text, '{pattern}', 2) AS kept FROM d"""
SECRET_SCAN = "WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents), m AS (" + " UNION ALL ".join(
    SECRET_RULE.format(place=i, rule=rule, pattern=p.replace("'", "''")) for i, (rule, p) in enumerate(SECRETS)) + """),
s AS (SELECT row, place, rule, kept, unnest(range(1, len(hits) + 1)) AS i, gaps, hits FROM m),
f AS (SELECT row, place, rule, kept[i] AS v, len(hits[i]) AS n,
             list_sum(list_transform(gaps[:i], lambda g: len(g))) + coalesce(list_sum(list_transform(hits[:i - 1], lambda h: len(h))), 0) AS start FROM s),
g AS (SELECT row, place, rule, start::BIGINT AS start, rule || ':' || start::BIGINT || ':' || (start + n)::BIGINT AS span FROM f WHERE len(v) >= 6)
SELECT doc_id, count(*) FILTER (WHERE rule = 'assign') AS n_assign, count(*) FILTER (WHERE rule = 'access') AS n_access,
       count(*) FILTER (WHERE rule = 'hex') AS n_hex,
       sha256(coalesce(string_agg(span, ',' ORDER BY start, place) FILTER (WHERE place < 3), '')) AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY start, place), '') AS spans
FROM d LEFT JOIN g USING (row) GROUP BY row, doc_id"""

SQL: dict[str, str] = {
    "op13_blob_ledger_secrets": SECRET_SCAN,
    "op9_hilbert_sharding": HILBERT,
    "op2_line_dedup": LINE_DEDUP.format(docs="documents") + """
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, sha256(c.text) AS text_sha256
FROM documents d LEFT JOIN cleaned c USING (doc_id)""",
    "op3_warc_dictionary": """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY d) ELSE page_id END AS first FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest,
       CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to FROM f""",
    "op10_rotated_one_bit": """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score
FROM s QUALIFY rank <= 20""",
}
