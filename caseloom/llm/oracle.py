"""DuckDB SQL for the registered queries that SQL can express, written apart from the operators."""

from __future__ import annotations

# crc32 by its rule: the table of 256 remainders, then a fold over the bytes.
_CRC32 = """
table256 AS (
  SELECT list_transform(range(256), lambda i: list_reduce(
    list_prepend(i, range(8)), lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
),
distinct_words AS (SELECT DISTINCT word FROM (SELECT word FROM doc_words UNION ALL SELECT word FROM aim_words)),
hexed AS (SELECT word, hex(encode(word)) AS h FROM distinct_words),
bucketed AS (
  SELECT word, xor(list_reduce(
    list_prepend(4294967295, list_transform(range(length(h) // 2), lambda i: ('0x' || h[2 * i + 1:2 * i + 2])::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM hexed, table256
)"""

OP13 = f"""
WITH doc_lists AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents
),
doc_words AS (SELECT doc_id, unnest(words) AS word FROM doc_lists),
aim_words AS (
  SELECT unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word FROM benchmark
),{_CRC32},
s AS (SELECT bucket, count(*) AS n FROM doc_words JOIN bucketed USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM aim_words JOIN bucketed USING (word) GROUP BY bucket),
gains AS (
  SELECT b.bucket, floor(1000 * ln(
    (coalesce(t.n, 0)::DOUBLE + 1) * ((SELECT coalesce(sum(n), 0) FROM s)::DOUBLE + 10000)
    / ((coalesce(s.n, 0)::DOUBLE + 1) * ((SELECT coalesce(sum(n), 0) FROM t)::DOUBLE + 10000))))::BIGINT AS gain
  FROM (SELECT unnest(range(10000)) AS bucket) b LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)
),
sums AS (
  SELECT doc_id, sum(gain)::BIGINT AS total FROM doc_words JOIN bucketed USING (word) JOIN gains USING (bucket) GROUP BY doc_id
),
scored AS (
  SELECT doc_id, len(words)::BIGINT AS n_features,
    CASE WHEN len(words) = 0 THEN 0 ELSE ((total - ((total % len(words)) + len(words)) % len(words)) // len(words))::BIGINT END AS weight,
    ('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT AS h
  FROM doc_lists LEFT JOIN sums USING (doc_id)
),
full_scores AS (
  SELECT doc_id, n_features, weight,
    weight + floor(-1000 * ln(-ln((h::DOUBLE + 0.5) / 4294967296.0::DOUBLE)))::BIGINT AS score
  FROM scored
),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM full_scores WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score,
  CASE WHEN rank <= (SELECT count(*) * 10 // 100 FROM ranked) THEN rank END::BIGINT AS rank
FROM full_scores LEFT JOIN ranked USING (doc_id)
"""

OP12 = r"""
WITH given AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS line,
    regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
),
words AS (SELECT lang, source, line, unnest(terms) AS term FROM given),
kept AS (
  SELECT lang, term, count(*)::HUGEINT AS lang_n FROM words GROUP BY lang, term HAVING count(DISTINCT line) >= 30
),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(lang_n)::HUGEINT AS total FROM kept GROUP BY lang),
counts AS (
  SELECT lang, source, term, count(*)::HUGEINT AS n FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term
),
sums AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM counts GROUP BY lang, source),
groups AS (
  SELECT lang, source, coalesce(total, 0) AS total
  FROM (SELECT DISTINCT lang, source FROM given) LEFT JOIN sums USING (lang, source)
),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + 1000000000 * (coalesce(c.n, 0) + 5) // (g.total + 5 * l.v) AS p,
    1 + 1000000000 * (k.lang_n + 5) // (l.total + 5 * l.v) AS q
  FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang)
    LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
),
distances AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source
),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(d.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN distances d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""


def sql() -> dict[str, str]:
    """SQL by query name."""
    return {"op12_source_divergence": OP12, "op13_importance_resampling": OP13}
