"""DuckDB SQL for the rows of the queries that SQL can express. Plain statements of the contracts, without the operators' shortcuts."""

from __future__ import annotations

from .sharding import ROW_BYTES

OP1 = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
w AS (SELECT doc_id, unnest(range(1, octet_length(b) - 98)) AS p, b FROM d WHERE octet_length(b) >= 100),
r AS (SELECT doc_id, p, row_number() OVER (PARTITION BY b[p : p + 99] ORDER BY doc_id, p) AS k FROM w),
new AS (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM r WHERE k > 1),
run AS (SELECT doc_id, p, sum(CASE WHEN before IS NULL OR before + 100 < p THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS i FROM new),
span AS (SELECT doc_id, i, min(p) AS lo, max(p) + 100 AS hi FROM run GROUP BY doc_id, i),
cut AS (SELECT doc_id, lo, hi, lag(hi, 1, 1) OVER (PARTITION BY doc_id ORDER BY lo) AS since FROM span),
sums AS (SELECT doc_id, count(*) AS n, sum(hi - lo) AS removed, max(hi) AS last FROM span GROUP BY doc_id),
kept AS (SELECT cut.doc_id, string_agg(CASE WHEN lo > since THEN hex(b[since : lo - 1]) ELSE '' END, '' ORDER BY lo) AS h FROM cut JOIN d USING (doc_id) GROUP BY cut.doc_id)
SELECT d.doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(sums.n, 0)::BIGINT AS n_spans,
  sha256(CASE WHEN kept.h IS NULL THEN b ELSE unhex(kept.h || CASE WHEN last <= octet_length(b) THEN hex(b[last : octet_length(b)]) ELSE '' END) END) AS kept_sha256
FROM d LEFT JOIN sums USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

OP4 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT doc_id, unnest(range(1, len(ws) - 18)) AS p, ws FROM d WHERE len(ws) >= 20),
r AS (SELECT doc_id, p, row_number() OVER (PARTITION BY array_to_string(ws[p : p + 19], ' ') ORDER BY doc_id, p) AS k FROM w),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS p FROM r WHERE k > 1),
word AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM d),
kept AS (SELECT word.doc_id, string_agg(word.word, ' ' ORDER BY word.p) AS t FROM word ANTI JOIN gone ON word.doc_id = gone.doc_id AND word.p = gone.p GROUP BY word.doc_id),
removed AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(removed.n, 0)::BIGINT AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN removed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

_SEEDED = "('0x' || substr(md5('{seed}|' || coalesce(doc_id::VARCHAR, '~')), 1, 15))::BIGINT"

OP7 = f"""
WITH tab AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t),
d AS (SELECT doc_id, source, encode(coalesce(text, '')) AS b, {_SEEDED.format(seed=7)} AS u FROM documents),
c AS (SELECT doc_id, source, u, octet_length(b)::BIGINT + {ROW_BYTES} AS size,
  xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, octet_length(b) + 1), lambda k: ('0x' || hex(b[k : k]))::BIGINT)), lambda a, x: xor(a >> 8, t[1 + (xor(a, x) & 255)])), 4294967295) AS crc FROM d, tab),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY u, doc_id, crc, size) - 1 AS r, count(*) OVER (PARTITION BY source) AS n FROM c),
p AS (SELECT *, row_number() OVER (ORDER BY (r + 0.5e0) / n, source NULLS FIRST, u, doc_id, crc, size) - 1 AS p, count(*) OVER () AS total FROM r)
SELECT doc_id, size, crc AS text_crc32, 'rows' AS law, (p * 40 // total)::INTEGER AS shard, p - ((p * 40 // total) * total + 39) // 40 AS slot, NULL::INTEGER AS grown_shard FROM p
"""

_CRC = "(SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t)"

#: What of the media columns is the payload's: the stored form and its feature are no matter of SQL.
MEDIA_PAYLOAD = f"""
WITH tab AS {_CRC}, d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
p AS (SELECT doc_id, octet_length(b)::BIGINT AS n, unhex(hex(b) || repeat('FF', (greatest(1, (octet_length(b) + 575) // 576) * 576 - octet_length(b))::INTEGER)) AS b FROM d)
SELECT doc_id, n AS n_bytes, octet_length(b)::BIGINT AS payload_bytes, sha256(b) AS payload_sha256,
  xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(octet_length(b) - 31, octet_length(b) + 1), lambda k: ('0x' || hex(b[k : k]))::BIGINT)), lambda a, x: xor(a >> 8, t[1 + (xor(a, x) & 255)])), 4294967295) AS tail_crc32
FROM p, tab
"""

#: Targets by raising the words for one unit of weight until no further source is above its limit.
MIX_TARGETS = r"""
WITH RECURSIVE d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS s, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w FROM d GROUP BY source),
r AS (SELECT 0 AS i, (SELECT sum(s) / sum(w)::DOUBLE FROM s WHERE s > 0) AS rate
  UNION ALL SELECT i + 1, (SELECT (sum(s) - 3 * coalesce(sum(s) FILTER (w * rate > 3 * s), 0)) / (sum(w) FILTER (w * rate <= 3 * s))::DOUBLE FROM s WHERE s > 0) FROM r WHERE i < 30),
t AS (SELECT source, s, CASE WHEN s > 0 THEN least(w * (SELECT max(rate) FROM r), 3e0 * s) ELSE 0e0 END AS target FROM s)
SELECT doc_id, size, s AS source_size, round(target, 3) AS target FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
"""

#: On pages of one article with a headline, paragraphs and inline marks, as the test tables hold them.
OP8 = r"""
WITH a AS (SELECT page_id, url, string_split_regex(regexp_extract(coalesce(html, ''), '<article>(.*)</article>', 1, 's'), '</?(h1|p)>') AS parts FROM pages),
b AS (SELECT page_id, url, list_transform(parts, lambda p: trim(regexp_replace(replace(replace(replace(replace(regexp_replace(regexp_replace(p, '<br>', ' ', 'g'), '<[^>]*>', '', 'g'),
  '&quot;', chr(34)), '&copy;', '©'), '&middot;', '·'), '&amp;', '&'), '\s+', ' ', 'g'))) AS parts FROM a),
t AS (SELECT page_id, url, array_to_string(list_filter(parts, lambda p: p <> ''), chr(10)) AS text FROM b)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM t
"""

OP10 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(ws), 10) AS l, array_to_string(ws[p : p + least(len(ws), 10) - 1], ' ') AS k FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS p FROM i WHERE len(ws) > 0)),
dw AS (SELECT doc_id, l, p, array_to_string(ws[p : p + l - 1], ' ') AS k FROM (SELECT doc_id, l, ws, unnest(range(1, len(ws) - l + 2)) AS p FROM d, (SELECT DISTINCT l FROM iw) WHERE len(ws) >= l)),
hit AS (SELECT doc_id, dw.l, p, item_id FROM dw JOIN iw ON dw.l = iw.l AND dw.k = iw.k),
n AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(p, p + l)) AS p FROM hit) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n.n, 0)::BIGINT AS n_hit, coalesce(it.n, 0)::BIGINT AS n_items, sha256(coalesce(it.ids, '')) AS items_sha256, coalesce(n.n, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN it USING (doc_id)
"""

SQL = {"op1_suffix_array_dedup": OP1, "op4_suffix_tree_dedup": OP4, "op7_shard_interleave": OP7, "op8_html_text": OP8, "op10_decontaminate": OP10, "media_payload": MEDIA_PAYLOAD, "mix_targets": MIX_TARGETS}
