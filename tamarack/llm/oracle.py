"""SQL for those operators that it can express in full: exact substrings, archives, contamination."""

from __future__ import annotations

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

#: Every 100-byte string of every text, as hexadecimal digits; texts are cut into stretches first, as a place far into a text is dear.
OP5 = """WITH d AS MATERIALIZED (SELECT doc_id, coalesce(hex(encode(text)), '') AS x, coalesce(octet_length(encode(text)), 0) AS n FROM documents),
  q AS (SELECT doc_id, o, substr(x, 2 * o + 1, 398) AS x, least(100, n - 99 - o) AS n FROM (SELECT doc_id, x, n, unnest(range(0, n - 99, 100)) AS o FROM d)),
  w AS (SELECT doc_id, o + j AS s, md5_number(substr(x, 2 * j + 1, 200)) AS h FROM (SELECT doc_id, o, x, unnest(range(n)) AS j FROM q)),
  f AS MATERIALIZED (SELECT doc_id, s FROM w QUALIFY row_number() OVER (PARTITION BY h ORDER BY doc_id, s) > 1),
  g AS (SELECT doc_id, s, coalesce(s > lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 100, true) AS new FROM f),
  i AS (SELECT doc_id, s, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM g),
  r AS (SELECT doc_id, min(s) AS a, max(s) + 100 AS b FROM i GROUP BY doc_id, run),
  e AS (SELECT doc_id, a, b FROM r UNION ALL SELECT doc_id, n, n FROM d),
  p AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a, b), 0) AS since FROM e)
  SELECT doc_id, n::BIGINT AS n_bytes, sum(b - a)::BIGINT AS n_removed, (count(*) - 1)::BIGINT AS n_spans, sha256(unhex(string_agg(substr(x, 2 * since + 1, 2 * (a - since)), '' ORDER BY a, b))) AS kept_sha256 FROM p JOIN d USING (doc_id) GROUP BY doc_id, n"""

OP9 = """SELECT page_id, bytes AS payload_bytes, sha1(x) AS payload_digest, CASE WHEN bytes >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN bytes >= 1000 AND page_id <> last THEN last END AS refers_to
  FROM (SELECT page_id, x, octet_length(encode(x))::BIGINT AS bytes, max(page_id) OVER (PARTITION BY x) AS last FROM (SELECT page_id, coalesce(html, '') AS x FROM pages))"""

OP10 = f"""WITH b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
  v AS MATERIALIZED (SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS words FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
  d AS MATERIALIZED (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
  x AS (SELECT doc_id, i, size, array_to_string(w[i : i + size - 1], ' ') AS words FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, (SELECT DISTINCT size FROM v))),
  h AS MATERIALIZED (SELECT doc_id, i, size, item_id FROM x JOIN v USING (size, words)),
  n AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM h) GROUP BY 1),
  m AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM h) GROUP BY 1)
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)"""
