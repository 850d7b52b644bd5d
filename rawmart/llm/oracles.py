"""DuckDB SQL of the queries whose contract SQL can express, over the same tables."""

from __future__ import annotations

_SPACES = r"'[\x20\x09-\x0D]+'"


def _words(text: str) -> str:
    return f"list_filter(string_split_regex({text}, {_SPACES}), lambda x: x <> '')"


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_DUPLICATES = f"""
WITH RECURSIVE t AS (SELECT doc_id, {_words(_LOWER)} AS ws FROM documents),
s AS (
  SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) END) AS g
  FROM t
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM c JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 85 * (a.n + b.n - k)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(doc, far) AS (SELECT x, y FROM e UNION SELECT r.doc, e.y FROM r JOIN e ON r.far = e.x),
m AS (SELECT doc, min(far) AS low FROM r GROUP BY doc)
SELECT t.doc_id, coalesce(n.n, 0) AS n_shingles, least(t.doc_id, coalesce(low, t.doc_id)) AS component_id,
       t.doc_id = least(t.doc_id, coalesce(low, t.doc_id)) AS kept
FROM t LEFT JOIN n USING (doc_id) LEFT JOIN m ON m.doc = t.doc_id"""

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.e, v.e)::BIGINT AS score
  FROM v q JOIN v ON q.vec_id <> v.vec_id AND q.vec_id % 50 = 0
), r AS (
  SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""

WINDOW_DEDUP = f"""
WITH t AS (SELECT doc_id, {_words("coalesce(text, '')")} AS ws FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS word,
             unnest(list_transform(range(1, len(ws) + 1), lambda i: CASE WHEN i + 49 <= len(ws) THEN md5(array_to_string(ws[i:i + 49], ' ')) END)) AS h
      FROM t),
f AS (SELECT doc_id, i, word, h IS NOT NULL AND min(doc_id) OVER (PARTITION BY h) < doc_id AS starts FROM p),
g AS (SELECT doc_id, i, word, bool_or(starts) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM f),
a AS (SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE gone) AS removed, coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone), '') AS kept
      FROM g GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_words, coalesce(removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM t LEFT JOIN a USING (doc_id)"""

BYTE_DEDUP = """
WITH t AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS hx FROM documents),
p AS (SELECT doc_id, unnest(range(0, len(hx) // 2)) AS i, hx FROM t),
q AS (SELECT doc_id, i, substr(hx, 2 * i + 1, 2) AS byte, CASE WHEN 2 * i + 100 <= len(hx) THEN md5(substr(hx, 2 * i + 1, 100)) END AS h FROM p),
f AS (SELECT doc_id, i, byte, h IS NOT NULL AND min(doc_id) OVER (PARTITION BY h) < doc_id AS starts FROM q),
g AS (SELECT doc_id, i, byte, bool_or(starts) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM f),
k AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS opens FROM g),
a AS (SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE gone) AS removed, count(*) FILTER (WHERE opens) AS spans,
             coalesce(string_agg(byte, '' ORDER BY i) FILTER (WHERE NOT gone), '') AS kept
      FROM k GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_bytes, coalesce(removed, 0) AS n_removed, coalesce(spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM t LEFT JOIN a USING (doc_id)"""


#: the 256 steps of CRC-32 as one list, and the CRC of a text's bytes with it (column ``steps``)
_CRC_STEPS = """steps AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY i) AS steps
  FROM range(256) r(i)
)"""


def _crc32(text: str) -> str:
    hx = f"hex(encode({text}))"
    data = f"list_transform(range(0, len({hx}) // 2), lambda i: ('0x' || substr({hx}, 2 * i + 1, 2))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295, {data}), lambda c, b: xor(c // 256, steps[1 + xor(c % 256, b)])), 4294967295)"


_ALNUM = r"regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

RESAMPLING = f"""
WITH {_CRC_STEPS},
d AS (SELECT doc_id, {_ALNUM} AS ws FROM documents),
b AS (SELECT unnest({_ALNUM}) AS w FROM benchmark),
n AS (SELECT doc_id, unnest(ws) AS w FROM d),
u AS (SELECT w FROM n UNION SELECT w FROM b),
h AS (SELECT w, {_crc32("w")} % 10000 AS bucket FROM u, steps),
s AS (SELECT bucket, count(*) AS s FROM n JOIN h USING (w) GROUP BY 1),
t AS (SELECT bucket, count(*) AS t FROM b JOIN h USING (w) GROUP BY 1),
z AS (SELECT (SELECT count(*) FROM n) AS s, (SELECT count(*) FROM b) AS t),
g AS (
  SELECT k AS bucket, floor(1000 * ln((coalesce(t.t, 0) + 1)::DOUBLE * (z.s + 10000)::DOUBLE / ((coalesce(s.s, 0) + 1)::DOUBLE * (z.t + 10000)::DOUBLE)))::BIGINT AS gain
  FROM range(10000) r(k) LEFT JOIN s ON s.bucket = k LEFT JOIN t ON t.bucket = k, z
),
m AS (SELECT doc_id, sum(gain)::BIGINT AS total, count(*) AS n FROM n JOIN h USING (w) JOIN g USING (bucket) GROUP BY 1),
w AS (
  SELECT d.doc_id, coalesce(m.n, 0) AS n_features, coalesce(floor(m.total / m.n)::BIGINT, 0) AS weight,
         ('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT AS h
  FROM d LEFT JOIN m USING (doc_id)
),
x AS (SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM w),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS able FROM x WHERE n_features >= 20)
SELECT x.doc_id, n_features, weight, score, CASE WHEN rank <= 10 * able // 100 THEN rank END AS rank FROM x LEFT JOIN r USING (doc_id)"""

RUNS = f"""
WITH {_CRC_STEPS},
o AS (SELECT doc_id, {_words("coalesce(text, '')")} AS ws, {_crc32("doc_id::VARCHAR")} AS h FROM documents, steps),
a AS (SELECT *, len(ws) AS n, CASE WHEN len(ws) > 0 THEN (h // 10) % len(ws) END AS a FROM o),
p AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM a),
t AS (SELECT doc_id, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(0, n), lambda i: CASE WHEN i < a THEN ws[i + 1] ELSE ws[a + (i - a) % p + 1] END) ELSE ws END AS ws FROM p),
w AS (SELECT doc_id, unnest(range(0, len(ws))) AS i, unnest(ws) AS word FROM t),
e AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM w x JOIN w y ON x.doc_id = y.doc_id AND x.word = y.word AND x.i < y.i),
g AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM e),
s AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM g GROUP BY doc_id, q, k HAVING count(*) + q >= greatest(24, 3 * q)),
r AS (SELECT doc_id, start, length, min(q) AS period FROM s GROUP BY ALL),
c AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed,
         first(struct_pack(start, length, period) ORDER BY length::DOUBLE / period DESC, start, period) AS top
  FROM r GROUP BY doc_id
),
x AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM w ANTI JOIN x USING (doc_id, i) GROUP BY doc_id)
SELECT t.doc_id, coalesce(n_runs, 0) AS n_runs, top.start AS start, top.length AS length, top.period AS period,
       1000 * top.length // top.period AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM t LEFT JOIN c USING (doc_id) LEFT JOIN k USING (doc_id)"""

MIXING = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len({_words("coalesce(text, '')")})::BIGINT AS size, md5('0:' || coalesce(doc_id::VARCHAR, '')) AS key FROM documents
),
n AS (SELECT 1 << greatest(0, length(bin(count(*))) // 2 - 3) AS shards FROM d),
r AS (SELECT d.*, ('0x' || substr(key, 1, 8))::BIGINT % shards AS shard FROM d, n),
s0 AS (SELECT source, sum(size)::BIGINT AS words, (row_number() OVER (ORDER BY source NULLS LAST) - 1) AS number FROM r GROUP BY source),
s AS (SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][number % 3 + 1] AS weight FROM s0),
z AS (SELECT 1.5::DOUBLE * sum(words) AS budget, sum(weight) AS weights FROM s),
-- water filling: in each step the sources above their most stop there
f(step, left_, weights, stopped) AS (
  SELECT 0, budget, weights, []::BIGINT[] FROM z
  UNION ALL
  SELECT step + 1, left_ - over_.words, f.weights - over_.weight, list_concat(stopped, over_.numbers)
  FROM f, LATERAL (SELECT list(number) AS numbers, sum(2 * words) AS words, sum(weight) AS weight FROM s
                   WHERE NOT list_contains(f.stopped, number) AND f.left_ / f.weights * weight > 2 * words) over_
  WHERE over_.numbers IS NOT NULL
),
fin AS (SELECT * FROM f ORDER BY step DESC LIMIT 1),
tg AS (SELECT s.*, CASE WHEN list_contains(stopped, number) THEN 2.0::DOUBLE * words ELSE left_ / weights * weight END AS target FROM s, fin),
m AS (SELECT round(sum(target) / 16)::BIGINT AS seats FROM tg),
q1 AS (SELECT number, k, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, number, k) AS rank FROM tg, m, range((SELECT seats FROM m)) x(k) WHERE target > 0),
g1 AS (SELECT number, count(*) AS seats FROM q1, m WHERE rank <= m.seats GROUP BY number),
c AS (SELECT source, shard, sum(size)::BIGINT AS words FROM r GROUP BY ALL),
c1 AS (SELECT c.*, number, seats FROM c JOIN tg ON c.source IS NOT DISTINCT FROM tg.source JOIN g1 USING (number)),
q2 AS (SELECT number, shard, seats, row_number() OVER (PARTITION BY number ORDER BY words::DOUBLE / (2 * k + 1) DESC, shard, k) AS rank
       FROM c1, LATERAL (SELECT unnest(range(seats)) AS k) x WHERE words > 0),
g2 AS (SELECT number, shard, count(*) AS quota FROM q2 WHERE rank <= seats GROUP BY ALL),
c2 AS (SELECT c1.*, coalesce(quota, 0) * 16 AS wanted FROM c1 LEFT JOIN g2 USING (number, shard) WHERE words > 0),
c3 AS (SELECT *, least(2, wanted // words) AS passes, words // 16 AS whole FROM c2),
c4 AS (SELECT source, shard, passes, whole, CASE WHEN passes < 2 THEN least(whole, round((wanted - passes * words) / 16)::BIGINT) ELSE 0 END AS extra,
              CASE WHEN whole > 0 THEN ('0x' || substr(md5('0:block:' || number || ':' || shard), 1, 8))::BIGINT % whole END AS phase FROM c3),
w AS (SELECT r.*, sum(size) OVER (PARTITION BY source, shard ORDER BY key, doc_id, size) - size AS first FROM r),
b AS (SELECT doc_id, size, first, least(16 * (j + 1), first + size) - greatest(16 * j, first) AS got
      FROM w JOIN c4 ON w.source IS NOT DISTINCT FROM c4.source AND w.shard = c4.shard, LATERAL (SELECT unnest(range((first // 16)::BIGINT, ((first + size - 1) // 16 + 1)::BIGINT)) AS j) x
      WHERE size > 0 AND extra > 0 AND j < whole AND (((j + 1) * extra + phase) // whole) > ((j * extra + phase) // whole)),
bs AS (SELECT doc_id, sum(got) AS got FROM b GROUP BY doc_id)
SELECT w.doc_id, w.size, tg.words AS source_size, tg.target, (coalesce(passes, 0) * w.size + coalesce(got, 0))::BIGINT AS taken
FROM w JOIN tg ON w.source IS NOT DISTINCT FROM tg.source LEFT JOIN c4 ON w.source IS NOT DISTINCT FROM c4.source AND w.shard = c4.shard LEFT JOIN bs USING (doc_id)"""
