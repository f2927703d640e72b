"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from .licenses import TEMPLATES

OP1 = """
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')) AS k
  FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
s1 AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) AS r FROM s0),
s2 AS (SELECT *, CAST(CASE r % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END AS DOUBLE) AS w, 2.0::DOUBLE * source_size AS cap FROM s1),
s3 AS (SELECT *, 1.5::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE) AS total,
         coalesce(sum(cap) OVER (ORDER BY cap / w, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS capped,
         sum(w) OVER (ORDER BY cap / w, r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open FROM s2),
s4 AS (SELECT *, max(CASE WHEN (total - capped) / open <= cap / w THEN (total - capped) / open END) OVER () AS lvl FROM s3),
s5 AS (SELECT source, source_size, r % 3 AS cls, least(cap, coalesce(lvl * w, cap)) AS target FROM s4),
d AS (
  SELECT z.*, s5.source_size, s5.target, s5.cls, CAST(floor(s5.target) AS BIGINT) AS t,
         CAST(coalesce(sum(size) OVER (PARTITION BY z.source ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS b
  FROM sized z JOIN s5 ON z.source IS NOT DISTINCT FROM s5.source),
e AS (SELECT *, least(size, greatest(0, t - b)) AS t0, least(size, greatest(0, t - b - source_size)) AS t1, CAST(b AS DOUBLE) / target AS q FROM d)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, round(target, 6) AS target, CAST(t0 + t1 AS BIGINT) AS taken,
       CAST((CASE WHEN t > b AND 2 * (t - b) >= size THEN 1 ELSE 0 END) + (CASE WHEN t > b + source_size AND 2 * (t - b - source_size) >= size THEN 1 ELSE 0 END) AS INTEGER) AS copies,
       CASE WHEN t > b THEN round(CASE WHEN q <= 0 THEN 0.0 WHEN cls = 0 THEN least(1.0, q)
            WHEN cls = 1 THEN least(1.0, 2 * (2 * q) / (3 + sqrt(greatest(0.0, 9 - 4 * (2 * q)))))
            ELSE least(1.0, 2 * q / (0.5 + sqrt(0.25 + 2 * q))) END, 6) END AS position
FROM e
"""

#: CRC-32 bytewise over the hex of the UTF-8 text, with its table of 256 remainders made from the polynomial.
OP6 = """
WITH tab AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(CAST(i AS BIGINT), range(8)),
         lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
d0 AS (SELECT doc_id, coalesce(text, '') AS text, md5(coalesce(text, '')) AS m, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS k FROM documents),
d1 AS (SELECT *, CAST(strlen(text) + 8 AS BIGINT) AS size, hex(text) AS h FROM d0),
d2 AS (SELECT *, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(CAST(len(h) // 2 AS BIGINT)), lambda j: CAST('0x' || substr(h, CAST(2 * j + 1 AS BIGINT), 2) AS BIGINT))),
         lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])) AS crc FROM d1, tab),
d3 AS (SELECT *, CAST(coalesce(sum(size) OVER w, 0) AS BIGINT) AS b, CAST(sum(size) OVER () AS BIGINT) AS total, row_number() OVER (ORDER BY substr(m, 1, 3), k, m) AS rn
       FROM d2 WINDOW w AS (ORDER BY substr(m, 1, 3), k, m ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
d4 AS (SELECT *, CAST((2 * b + size) * 24 // (2 * total) AS INTEGER) AS shard FROM d3)
SELECT doc_id, size, xor(crc, 4294967295) AS text_crc32, 'bytes' AS law, shard, rn - min(rn) OVER (PARTITION BY shard) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM d4
"""

OP8 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS h, min(page_id) OVER (PARTITION BY sha256(html)) AS f,
        row_number() OVER (PARTITION BY sha256(html) ORDER BY page_id NULLS LAST) AS rn FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST((CAST('0x' || substr(h, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT) // CAST(32 ** (3 - i % 4) AS BIGINT)) % 32 + 1 AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN rn = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN rn > 1 THEN f END AS refers_to
FROM d
"""

OP9 = """
WITH c AS (SELECT page_id, url, DATE '2024-01-01' + CAST((page_id * 7919) % 365 AS INTEGER) AS fetched_at,
  lower(regexp_replace(regexp_replace(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?#]*)', 1), '^.*@', ''), ':\\d*$', ''), '\\.$', '')) AS host,
  regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*([^?#]*)', 1) AS path FROM pages),
hosts AS (SELECT DISTINCT host, CAST('0x' || substr(md5(host), 1, 4) AS INTEGER) AS h FROM c WHERE host <> ''),
entries AS (
  SELECT 'ads' AS list, 'host' AS kind, host AS value, true AS active, DATE '2024-01-01' + h % 200 AS dated FROM hosts WHERE h % 3 = 0
  UNION SELECT 'ads', 'host', host, false, DATE '2024-01-01' + (h % 200 + 60) FROM hosts WHERE h % 6 = 0
  UNION SELECT 'malware', 'domain', regexp_replace(host, '^[^.]*\\.', ''), true, DATE '2024-01-01' + h % 300 FROM hosts WHERE h % 7 = 0
  UNION SELECT 'adult', 'path', host || '/en/', true, DATE '2024-01-01' + h % 100 FROM hosts WHERE h % 5 = 0
  UNION SELECT 'adult', 'path', host || '/en/', false, DATE '2024-01-01' + (h % 100 + 90) FROM hosts WHERE h % 5 = 0
  UNION SELECT 'adult', 'path', host || '/en/', true, DATE '2024-01-01' + (h % 100 + 150) FROM hosts WHERE h % 5 = 0),
log AS (SELECT list, kind, value, dated, min(active) AS active FROM entries GROUP BY ALL),
iv AS (SELECT * FROM (SELECT *, lead(dated) OVER (PARTITION BY list, kind, value ORDER BY dated) AS till FROM log) WHERE active),
met AS (
  SELECT c.page_id, iv.list FROM c JOIN iv ON fetched_at >= dated AND (till IS NULL OR fetched_at < till) AND (
    (kind = 'host' AND value = host) OR (kind = 'domain' AND (value = host OR ends_with(host, '.' || value)))
    OR (kind = 'path' AND starts_with(host || regexp_extract(path, '^(.*/)', 1), value)))),
m AS (SELECT page_id, count(*) AS n, string_agg(DISTINCT list, ',' ORDER BY list) AS lists FROM met GROUP BY page_id)
SELECT c.page_id, strftime(c.fetched_at, '%Y-%m-%d') AS fetched_at, c.host, coalesce(n, 0) AS n_rules, coalesce(lists, '') AS lists, n IS NOT NULL AS blocked FROM c LEFT JOIN m USING (page_id)
"""


_TEMPLATE_WORDS = ", ".join(
    f"({n}, '{t.label}', {t.base}, {k}, '{w}', {t.key[0] <= k < t.key[1]})" for n, t in enumerate(TEMPLATES) for k, w in enumerate(t.tokens)
)

OP3 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
p AS (SELECT rid, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS i FROM d),
tw(t, label, base, k, w, key) AS (VALUES {_TEMPLATE_WORDS}),
df AS (SELECT v.w, count(DISTINCT rid) AS df FROM (SELECT DISTINCT w FROM tw) v LEFT JOIN p ON p.w = v.w GROUP BY v.w),
idf AS (SELECT w, round(ln(((SELECT count(*) FROM d) + 1) / (df + 1)) + 1, 6) AS idf FROM df),
tpl AS (SELECT tw.*, idf, row_number() OVER (PARTITION BY t ORDER BY idf DESC, k) <= CASE WHEN base THEN 1 ELSE 2 END AS anchor FROM tw JOIN idf USING (w)),
tot AS (SELECT t, any_value(label) AS label, any_value(base) AS base, sum(idf) AS total, count(*) FILTER (key) AS n_key FROM tpl GROUP BY t),
st AS (SELECT rid, t, i - k AS s, sum(idf) AS got, count(*) FILTER (key) AS n FROM p JOIN tpl ON p.w = tpl.w GROUP BY rid, t, i - k HAVING bool_or(anchor)),
j AS (SELECT rid, label, base, s, least(1.0, round(got / total, 6)) AS share, n = n_key AS v FROM st JOIN tot USING (t)),
g AS (SELECT rid, count(*) FILTER (base AND v) AS n_base, min(s) FILTER (base AND v) AS first_word, max(s) FILTER (base AND v) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base AND v AND share >= 0.8) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (v AND share >= 0.8) AS labels, max(share) AS score FROM j GROUP BY rid)
SELECT doc_id, len(ws) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM d LEFT JOIN g USING (rid)
"""


#: As OP6, the CRC-32 goes over the hex of the UTF-8 bytes, here of each distinct feature.
OP11 = """
WITH tab AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(CAST(i AS BIGINT), range(8)),
         lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
b AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
f AS (SELECT rid, unnest(list_concat(ws, list_transform(range(1, greatest(1, len(ws))), lambda i: ws[i] || ' ' || ws[i + 1]))) AS g FROM d),
e AS (SELECT unnest(list_concat(ws, list_transform(range(1, greatest(1, len(ws))), lambda i: ws[i] || ' ' || ws[i + 1]))) AS g FROM b),
v0 AS (SELECT g, hex(g) AS h FROM (SELECT g FROM f UNION SELECT g FROM e)),
v AS (SELECT g, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(CAST(len(h) // 2 AS BIGINT)), lambda j: CAST('0x' || substr(h, CAST(2 * j + 1 AS BIGINT), 2) AS BIGINT))),
    lambda c, x: xor(c // 256, t[xor(c % 256, x) + 1])), 4294967295) % 10000 AS bucket FROM v0, tab),
s AS (SELECT bucket, count(*) AS s FROM f JOIN v USING (g) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM e JOIN v USING (g) GROUP BY bucket),
gain AS (SELECT r.bucket, CAST(floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * CAST((SELECT count(*) FROM f) + 10000 AS DOUBLE)
    / (CAST(coalesce(s, 0) + 1 AS DOUBLE) * CAST((SELECT count(*) FROM e) + 10000 AS DOUBLE)))) AS BIGINT) AS gain
  FROM (SELECT unnest(range(10000)) AS bucket) r LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
w AS (SELECT rid, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS total FROM f JOIN v USING (g) JOIN gain USING (bucket) GROUP BY rid),
x AS (SELECT rid, doc_id, len(ws) AS n_words, coalesce(n_features, 0) AS n_features, coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0) AS weight,
    CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h FROM d LEFT JOIN w USING (rid)),
y AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM x),
z AS (SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM y WHERE n_words >= 20)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, score, CASE WHEN rank <= 25 * (SELECT count(*) FROM z) // 100 THEN rank END AS rank
FROM y LEFT JOIN z USING (rid)
"""


def _op13(k: int = 8, rounds: int = 10) -> str:
    nearest = """a{r} AS MATERIALIZED (SELECT rid, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS distance FROM (
  SELECT p.rid, c.cluster, sum((p.x - c.x) * (p.x - c.x)) AS d FROM p JOIN c{r} c USING (i) GROUP BY p.rid, c.cluster) GROUP BY rid)"""
    moved = """c{n} AS MATERIALIZED (SELECT c.cluster, c.i, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN (
  SELECT cluster, i, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS x FROM p JOIN a{r} USING (rid) GROUP BY cluster, i) m USING (cluster, i))"""
    steps = [text for r in range(rounds) for text in (nearest.format(r=r), moved.format(r=r, n=r + 1))] + [nearest.format(r=rounds)]
    return f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
p AS MATERIALIZED (SELECT rid, unnest(range(1, 65)) AS i, unnest(e) AS x FROM v),
f AS (SELECT e, row_number() OVER (ORDER BY sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), '')), e) - 1 AS cluster FROM v),
c0 AS MATERIALIZED (SELECT cluster, unnest(range(1, 65)) AS i, unnest(e) AS x FROM f WHERE cluster < {k}),
{", ".join(steps)},
s AS (SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY cluster)
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds} JOIN v USING (rid) JOIN s USING (cluster)
"""


def statements() -> dict[str, str]:
    return {"op1_mixing": OP1, "op3_licenses": OP3, "op6_sharding": OP6, "op8_warc": OP8, "op9_url_filters": OP9, "op11_resampling": OP11, "op13_centroids": _op13()}
