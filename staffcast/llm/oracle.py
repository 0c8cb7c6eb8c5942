"""SQL counterparts of the queries that SQL can express, written apart from them."""

OP6 = r"""
WITH d AS MATERIALIZED (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [3.0::DOUBLE, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST) AS place FROM w),
l AS (
  SELECT *, 1.5::DOUBLE * sum(source_size) OVER () - 2.0::DOUBLE * coalesce(sum(source_size) OVER (
      ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room,
    sum(weight) OVER (ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM o),
f AS (SELECT min(place) AS first_open FROM l WHERE room * weight <= 2.0::DOUBLE * source_size * weights),
g AS (SELECT l.room, l.weights, l.place FROM l JOIN f ON l.place = f.first_open),
t AS (
  SELECT l.source, l.source_size,
    CASE WHEN l.place >= g.place THEN g.room * l.weight / g.weights ELSE 2.0::DOUBLE * l.source_size END AS target
  FROM l LEFT JOIN g ON true),
r AS (
  SELECT d.*, row_number() OVER (PARTITION BY source ORDER BY size, md5('17:' || doc_id), doc_id) AS rank FROM d),
e AS (
  SELECT r.doc_id, r.size, t.source_size, t.target, r.rank,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS epochs,
    ('0x' || substr(md5('17:source:' || coalesce(r.source, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (size * (floor(epochs) + floor((epochs - floor(epochs)) * rank + u)
    - floor((epochs - floor(epochs)) * (rank - 1) + u)))::BIGINT AS taken
FROM e
"""

# DuckDB has no base 32: the digest's bytes are read as bits, five for each digit.
OP2 = r"""
WITH p AS MATERIALIZED (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS digest FROM pages),
m AS (SELECT payload, max(page_id) AS largest FROM p GROUP BY payload),
b AS (
  SELECT DISTINCT digest, array_to_string(list_transform(range(0, 160, 5), lambda i: substr(
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ('0b' || substr(bits, (i + 1)::BIGINT, 5))::BIGINT + 1, 1)), '') AS base32
  FROM (SELECT digest, array_to_string(list_transform(range(1, 41), lambda i: [
      '0000','0001','0010','0011','0100','0101','0110','0111','1000','1001','1010','1011','1100','1101','1110','1111'
    ][('0x' || substr(digest, i::BIGINT, 1))::BIGINT + 1]), '') AS bits FROM p))
SELECT p.page_id, octet_length(encode(p.payload))::BIGINT AS payload_bytes, b.base32 AS payload_digest,
  CASE WHEN p.page_id < m.largest THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN p.page_id < m.largest THEN m.largest END AS refers_to
FROM p JOIN m USING (payload) JOIN b USING (digest)
"""

OP9 = r"""
WITH d AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
p AS (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM d),
k AS MATERIALIZED (SELECT doc_id, i, array_to_string(list_slice(words, i, i + 12), ' ') AS window_text FROM p),
m AS (SELECT window_text, min(doc_id) AS first_doc FROM k GROUP BY window_text),
c AS (
  SELECT DISTINCT doc_id, i + j AS i
  FROM k JOIN m USING (window_text), (SELECT unnest(range(13)) AS j) WHERE doc_id > first_doc),
u AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM d),
t AS (
  SELECT u.doc_id, count(*) AS n_left, string_agg(u.word, ' ' ORDER BY u.i) AS kept
  FROM u ANTI JOIN c ON u.doc_id = c.doc_id AND u.i = c.i GROUP BY u.doc_id)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, (len(d.words) - coalesce(n_left, 0))::BIGINT AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id)
"""


OP11 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS said FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
m AS (
  SELECT *, length(said) + len(regexp_extract_all(said, '<\\*/?s>|\[\\*(?:/?INST|/?SYS|/?ROLE|TEXT)\]'))
    + CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 WHEN 'system' THEN 11
      ELSE 19 + length(role) + len(regexp_extract_all(role, '<\\*/?s>|\[\\*(?:/?INST|/?SYS|/?ROLE|TEXT)\]')) END AS chars
  FROM t)
SELECT conv_id::BIGINT AS conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || said || chr(10), '' ORDER BY turn NULLS FIRST, role, md5(said))) AS turns_sha256,
  coalesce(sum(length(said)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(said, '' ORDER BY turn NULLS FIRST, role, md5(said)) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM m GROUP BY conv_id
"""

# DuckDB has no CRC-32: the digits' bits go through the reflected polynomial one by one.
OP13 = r"""
WITH o AS MATERIALIZED (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS place,
    md5(coalesce(role, '')) || md5(coalesce(text, '')) AS step, length(coalesce(text, '')) AS chars
  FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT conv_id, max(place) AS turns FROM o GROUP BY conv_id),
k AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda v, d: list_reduce(list_prepend(xor(v, d), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
        lambda w, z: CASE WHEN w % 2 = 1 THEN xor(w // 2, 3988292384::BIGINT) ELSE w // 2 END)), 4294967295::BIGINT) % 6 AS h
  FROM l),
v AS MATERIALIZED (SELECT k.*, least(h, coalesce(l.turns, 0)) AS shared FROM k LEFT JOIN l ON l.conv_id = k.base),
r AS (
  SELECT v.conv_id AS c, place AS depth, step, chars FROM v JOIN o ON o.conv_id = v.base WHERE place <= h
  UNION ALL SELECT v.conv_id, shared + place - h, step, chars FROM v JOIN o ON o.conv_id = v.conv_id WHERE place > h),
p AS MATERIALIZED (
  SELECT c, depth, chars, string_agg(step, '') OVER (PARTITION BY c ORDER BY depth) AS path FROM r
  UNION ALL SELECT conv_id, 0, 0, '' FROM v),
n AS MATERIALIZED (
  SELECT path, depth, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(chars) AS saved, left(path, 64 * (depth - 1)::INT) AS above
  FROM p GROUP BY path, depth),
b AS (SELECT above AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY above),
u AS (SELECT left(path, 64 * level::INT) AS path, saved, leaf FROM (
  SELECT path, saved, (n_children IS NULL)::BIGINT AS leaf, unnest(range(depth + 1)) AS level FROM n LEFT JOIN b USING (path))),
s AS (SELECT path, sum(saved)::BIGINT AS saved_tokens, sum(leaf)::BIGINT AS n_leaves FROM u GROUP BY path),
e AS (SELECT path, string_agg(c::VARCHAR, ',' ORDER BY c) AS ends FROM (
  SELECT *, max(depth) OVER (PARTITION BY c) AS turns FROM p) WHERE depth = turns GROUP BY path)
SELECT n.conv_id::BIGINT AS conv_id, n.depth::BIGINT AS depth, CASE WHEN n.depth > 0 THEN a.conv_id END::BIGINT AS parent_conv_id,
  n.n_convs, coalesce(b.n_children, 0)::BIGINT AS n_children, s.n_leaves, s.saved_tokens, sha256(coalesce(e.ends, '')) AS ends_sha256
FROM n JOIN s USING (path) LEFT JOIN b USING (path) LEFT JOIN e USING (path) LEFT JOIN n a ON a.path = n.above
"""


def all_statements() -> dict[str, str]:
    return {"op2_warc": OP2, "op6_mixing": OP6, "op9_substrings": OP9, "op11_chat": OP11, "op13_prefix_trie": OP13}
