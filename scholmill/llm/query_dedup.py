"""Queries of the exact-match dedup operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scholmill.llm.line_dedup import line_dedup
from scholmill.llm.near_dedup import near_dedup
from scholmill.llm.substring_dedup import substring_dedup
from scholmill.llm.suffix_dedup import suffix_dedup


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), threshold=0.8, shingle=5, plain=True)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return substring_dedup(docs, window=50, digest=True).withColumnRenamed("kept", "kept_sha256")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return suffix_dedup(docs, length=100, digest=True).drop("kept")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), min_lines=3, gram=2, min_words=50)


#: Runs of three lines, of one or two lines of 50 words, and short texts; the first place of each, and the lines that later ones cover.
OP8_SQL = r"""
WITH lines AS (
  SELECT doc_id, i, l[i] AS line, len(l) AS n, len(regexp_extract_all(l[i], '[^\x20\x09-\x0D]+')) AS words
  FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))),
near AS (
  SELECT doc_id, i, n, line AS a, lead(line, 1) OVER w AS b, lead(line, 2) OVER w AS c, words AS x, lead(words, 1) OVER w AS y, sum(words) OVER (PARTITION BY doc_id) AS total
  FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
runs AS (
  SELECT doc_id, i, 3 AS size, 'lines' AS kind, a || chr(10) || b || chr(10) || c AS run FROM near WHERE i <= n - 2
  UNION ALL SELECT doc_id, i, 2, 'lines', a || chr(10) || b FROM near WHERE i <= n - 1 AND x + y >= 50
  UNION ALL SELECT doc_id, i, 1, 'lines', a FROM near WHERE x >= 50
  UNION ALL SELECT doc_id, i, n, 'text', CASE WHEN n = 1 THEN a ELSE a || chr(10) || b END FROM near WHERE i = 1 AND n < 3 AND total > 0),
later AS (
  SELECT doc_id, i, size FROM (SELECT doc_id, i, size, row_number() OVER (PARTITION BY kind, size, run ORDER BY doc_id, i) AS k FROM runs) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + size)) AS i FROM later),
kept AS (
  SELECT l.doc_id, count(*) AS n_lines, count(g.i) AS n_removed, coalesce(string_agg(CASE WHEN g.i IS NULL THEN line END, chr(10) ORDER BY l.i), '') AS text
  FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i GROUP BY l.doc_id)
SELECT * FROM kept
"""

#: Windows of 50 words by text, the smallest document of each, and the words that windows of larger ones cover.
OP5_SQL = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM docs),
windows AS (SELECT doc_id, i, hash(array_to_string(w[i:i + 49], ' ')) AS k FROM starts),
firsts AS (SELECT k, min(doc_id) AS first FROM windows GROUP BY k),
later AS (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS j FROM windows JOIN firsts USING (k) WHERE first < doc_id),
gone AS (SELECT doc_id, unnest(range(i, least(i + 50, coalesce(j, i + 50)))) AS i FROM later),
lists AS (SELECT doc_id, list(i) AS g, count(*) AS n FROM gone GROUP BY doc_id),
words AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM docs SEMI JOIN lists USING (doc_id)),
kept AS (SELECT w.doc_id, string_agg(w.w[w.i], ' ' ORDER BY w.i) AS t FROM words w ANTI JOIN gone g ON w.doc_id = g.doc_id AND w.i = g.i GROUP BY w.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(l.n, 0) AS BIGINT) AS n_removed,
  sha256(CASE WHEN l.n IS NULL THEN array_to_string(w, ' ') ELSE coalesce(k.t, '') END) AS kept_sha256
FROM docs d LEFT JOIN lists l USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""

#: Strings of 100 bytes (as 200 hex digits), the first place of each, and the bytes that later ones cover.
OP7_SQL = r"""
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
stretches AS (SELECT doc_id, c, substr(h, 1000 * c + 1, 1198) AS s FROM (SELECT doc_id, h, unnest(range(0, length(h) // 1000 + 1)) AS c FROM docs)),
starts AS (SELECT doc_id, c, s, unnest(range(0, length(s) // 2 - 99)) AS i FROM stretches),
strings AS (SELECT doc_id, 500 * c + i AS i, hash(substr(s, 2 * i + 1, 200)) AS k FROM starts),
firsts AS (SELECT k, min({'d': doc_id, 'i': i}) AS first FROM strings GROUP BY k),
later AS (SELECT doc_id, i, lead(i) OVER w AS j, lag(i) OVER w AS b FROM strings JOIN firsts USING (k) WHERE first < {'d': doc_id, 'i': i} WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
counts AS (SELECT doc_id, sum(least(100, coalesce(j - i, 100))) AS n_removed, count(*) FILTER (WHERE j IS NULL OR j > i + 100) AS n_spans FROM later GROUP BY doc_id),
ends AS (SELECT doc_id, list(i ORDER BY i) FILTER (WHERE b IS NULL OR i > b + 100) AS s, list(i + 100 ORDER BY i) FILTER (WHERE j IS NULL OR j > i + 100) AS e FROM later GROUP BY doc_id),
pieces AS (SELECT doc_id, k, CASE WHEN k = 1 THEN 0 ELSE e[k - 1] END AS a, CASE WHEN k > len(s) THEN NULL ELSE s[k] END AS z FROM (SELECT doc_id, s, e, unnest(range(1, len(s) + 2)) AS k FROM ends)),
kept AS (SELECT p.doc_id, string_agg(CASE WHEN z IS NULL THEN substr(h, 2 * a + 1) ELSE substr(h, 2 * a + 1, 2 * (z - a)) END, '' ORDER BY k) AS t FROM pieces p JOIN docs USING (doc_id) GROUP BY p.doc_id)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(k.t, h))) AS kept_sha256
FROM docs d LEFT JOIN counts c USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""
