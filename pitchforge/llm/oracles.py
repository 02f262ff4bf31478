"""DuckDB SQL of the queries that SQL can express, by plain comparison of everything."""

from __future__ import annotations

from . import decontam, period_runs, suffix_dedup

TOP_K = """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.rid, a.vec_id AS query_id, b.vec_id, b.rid AS other, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.rid <> b.rid WHERE a.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id, other) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id, other) <= 5"""


def repeats(length: int = suffix_dedup.LENGTH) -> str:
    """Every string of ``length`` bytes of every text counted, as hexadecimal text (two characters a byte)."""
    return f"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
c AS (SELECT rid, o, substr(h, 2 * o + 1, 2 * (256 + {length - 1})) AS h
      FROM (SELECT rid, h, unnest(range(0, length(h) // 2, 256)) AS o FROM t)),
w AS (SELECT rid, o + i AS i, md5_number(substr(h, 2 * i + 1, {2 * length})) AS k
      FROM (SELECT rid, o, h, unnest(range(length(h) // 2 - {length - 1})) AS i FROM c WHERE length(h) >= {2 * length})),
m AS (SELECT rid, i FROM w WHERE k IN (SELECT k FROM w GROUP BY k HAVING COUNT(*) > 1)),
e AS (SELECT rid, i, CASE WHEN lag(i) OVER (PARTITION BY rid ORDER BY i) >= i - {length} THEN 0 ELSE 1 END AS new FROM m),
g AS (SELECT rid, i, sum(new) OVER (PARTITION BY rid ORDER BY i) AS run FROM e),
r AS (SELECT rid, run, min(i) AS a, max(i) + {length} AS b FROM g GROUP BY ALL),
k AS (SELECT rid, coalesce(lag(b) OVER (PARTITION BY rid ORDER BY a), 0) AS a, a AS b FROM r
      UNION ALL SELECT t.rid, coalesce(max(r.b), 0), length(any_value(h)) // 2 FROM t LEFT JOIN r USING (rid) GROUP BY t.rid),
kept AS (SELECT rid, string_agg(substr(h, 2 * k.a + 1, 2 * (k.b - k.a)), '' ORDER BY k.a) AS h FROM k JOIN t USING (rid) GROUP BY rid)
SELECT t.doc_id, CAST(length(t.h) // 2 AS BIGINT) AS n_bytes, CAST((length(t.h) - length(kept.h)) // 2 AS BIGINT) AS n_removed,
       (SELECT COUNT(*) FROM r WHERE r.rid = t.rid) AS n_spans, sha256(unhex(kept.h)) AS kept_sha256
FROM t JOIN kept USING (rid)"""


def leaks(width: int = decontam.SHINGLE, similarity: float = decontam.SIMILARITY) -> str:
    """Weighted similarity of every item with every window of its length, in texts that share a shingle with it."""
    words = "list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda w: w <> '')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {words} AS w FROM documents),
i AS (SELECT row_number() OVER () AS iid, item_id, w, len(w) AS n, least(len(w), {width}) AS k
      FROM (SELECT item_id, {words} AS w FROM benchmark) WHERE len(w) > 0),
ds AS (SELECT rid, k, p, array_to_string(w[p + 1:p + k], ' ') AS s
       FROM (SELECT rid, w, k, unnest(range(len(w) - k + 1)) AS p FROM d, (SELECT DISTINCT k FROM i) WHERE len(w) >= k)),
it AS (SELECT iid, s, COUNT(*) AS c FROM (SELECT iid, array_to_string(w[p + 1:p + k], ' ') AS s
       FROM (SELECT iid, w, k, unnest(range(n - k + 1)) AS p FROM i)) GROUP BY ALL),
pair AS (SELECT DISTINCT rid, iid FROM ds JOIN it USING (s) JOIN i USING (iid, k)),
win AS (SELECT rid, iid, k, n - k + 1 AS m, least(n, len(d.w)) - k + 1 AS size,
               unnest(range(greatest(len(d.w) - n, 0) + 1)) AS a
        FROM pair JOIN d USING (rid) JOIN (SELECT iid, n, k FROM i) USING (iid)),
f AS (SELECT rid, iid, m, size, a, s, COUNT(*) AS c FROM win JOIN ds USING (rid, k)
      WHERE p >= a AND p < a + size AND s IN (SELECT s FROM it) GROUP BY ALL),
sim AS (SELECT rid, iid, m, size, a, sum(least(f.c, it.c)) AS shared FROM f JOIN it USING (iid, s) GROUP BY ALL),
best AS (SELECT rid, iid, max(CAST(shared AS DOUBLE) / (m + size - shared)) AS similarity FROM sim GROUP BY ALL)
SELECT doc_id, item_id, CAST(n AS BIGINT) AS n_words, similarity
FROM best JOIN d USING (rid) JOIN i USING (iid) WHERE similarity >= {similarity}"""


def runs(least: int = period_runs.LEAST, exponent: int = period_runs.EXPONENT) -> str:
    """Islands of equal stretches q apart, for every q, in the tiled texts.

    A run has ``least`` words or more and at least 4 periods, so ``least - 1`` words
    recur at its period; all pairs of equal stretches that long are compared.
    """
    seed = least - 1
    return f"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, list_reduce(
             list_prepend(4294967295, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [ascii(c), 0, 0, 0, 0, 0, 0, 0]))),
             lambda h, x: xor(xor(h, x) >> 1, CASE WHEN xor(h, x) % 2 = 1 THEN 3988292384 ELSE 0 END)) AS crc,
             list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
           FROM documents),
g AS (SELECT rid, doc_id, w, len(w) AS n, xor(crc, 4294967295) % 10 = 0 AND len(w) > 0 AS tile, xor(crc, 4294967295) // 10 AS g FROM t),
a AS (SELECT *, CASE WHEN tile THEN g % n END AS a FROM g),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
d AS (SELECT rid, doc_id, n, CASE WHEN tile THEN
        list_transform(range(n), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END) ELSE w END AS w FROM p),
s AS (SELECT rid, i, md5_number(array_to_string(w[i + 1:i + {seed}], ' ')) AS s
      FROM (SELECT rid, w, unnest(range(n - {seed - 1})) AS i FROM d WHERE n >= {least})),
q AS (SELECT x.rid, x.i, y.i - x.i AS q FROM s x JOIN s y ON x.rid = y.rid AND x.s = y.s AND x.i < y.i),
c AS (SELECT rid, q, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS c, i FROM q),
l AS (SELECT rid, q, min(i) AS start, COUNT(*) + {seed - 1} + q AS length FROM c GROUP BY rid, q, c),
r AS (SELECT rid, start, length, q FROM l WHERE length >= greatest({least}, {exponent} * q)
      QUALIFY q = min(q) OVER (PARTITION BY rid, start, length)),
best AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY rid ORDER BY length DESC, start, q) = 1),
lines AS (SELECT rid, COUNT(*) AS n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS lines FROM r GROUP BY rid),
gone AS (SELECT DISTINCT rid, unnest(range(start + q, start + length)) AS i FROM r),
kept AS (SELECT rid, string_agg(word, ' ' ORDER BY i) AS kept
         FROM (SELECT rid, unnest(w) AS word, unnest(range(n)) AS i FROM d WHERE n > 0) ANTI JOIN gone USING (rid, i) GROUP BY rid)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, q AS period, 1000 * length // q AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM d LEFT JOIN best USING (rid) LEFT JOIN lines USING (rid) LEFT JOIN kept USING (rid)"""


SQL = {"op4_maxscore": TOP_K, "op6_suffix_dedup": repeats(), "op9_decontamination": leaks(), "op11_period_runs": runs()}
