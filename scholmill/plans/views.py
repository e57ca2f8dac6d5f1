"""Bibliometric views over the given tables, as SQL that Spark and DuckDB both run (``//`` is ``div`` in Spark)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")

LINEITEM_UNIQUE = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_partkey, l_suppkey, l_quantity, l_shipdate) AS rn FROM lineitem) t WHERE rn = 1"""

WORKS = """SELECT concat('https://openalex.org/W', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS work_id,
  CAST(year(l_shipdate) AS INT) AS publication_year,
  CASE l_returnflag WHEN 'A' THEN 'en' WHEN 'N' THEN 'pt' ELSE 'es' END AS language,
  concat('https://doi.org/10.1590/', CAST(l_orderkey AS STRING)) AS doi,
  CASE WHEN l_suppkey % 10 = 9 THEN NULL ELSE concat('https://openalex.org/S', CAST(l_suppkey AS STRING)) END AS journal_id,
  CASE WHEN l_partkey % 97 = 0 THEN NULL WHEN l_partkey % 89 = 0 THEN 'ISSN-X' ELSE concat('ISSN-', CAST(s_nationkey AS STRING)) END AS journal_issn_l,
  CASE WHEN l_suppkey % 3 = 0 THEN 1 ELSE 0 END AS is_journal_oa,
  r_name AS domain, p_type AS field, p_brand AS subfield, p_name AS topic,
  CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(floor(l_quantity) AS BIGINT) END AS citations_total,
  CAST(l_partkey % 3 AS BIGINT) AS citations_window_2y,
  CAST(l_partkey % 3 + l_partkey % 2 AS BIGINT) AS citations_window_3y,
  CAST(l_partkey % 3 + l_partkey % 2 + l_partkey % 4 AS BIGINT) AS citations_window_5y,
  CAST(l_partkey % 5 AS BIGINT) AS citations_2000,
  CAST(l_partkey % 7 AS BIGINT) AS citations_2001
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

WORKS_JSON = """SELECT *, citations_total = 13 AS is_merged,
  CASE WHEN citations_2001 = 0 THEN 'not-json' WHEN citations_2001 = 1 THEN NULL
       ELSE concat('{"W1":{"language":"', language, '"},"W2":{"language":"',
                   CASE WHEN citations_2000 % 2 = 0 THEN ' EN ' ELSE 'pt' END, '"}}') END AS oa_individual_works
FROM works"""

RAW_FLAT = """SELECT concat('https://openalex.org/W', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS work_id,
  concat('2024-01-0', CAST(1 + l_partkey % 5 AS STRING)) AS updated_date,
  l_partkey * 10000000 + l_suppkey * 1000 + CAST(l_quantity AS BIGINT) AS line_no,
  CASE WHEN l_partkey % 11 = 0 THEN 'book' ELSE 'article' END AS type,
  CASE WHEN l_partkey % 13 = 0 THEN TRUE WHEN l_partkey % 13 = 1 THEN NULL ELSE FALSE END AS is_xpac,
  CAST(year(l_shipdate) AS INT) AS publication_year,
  CASE WHEN l_suppkey % 4 = 0 THEN 'repository' ELSE 'journal' END AS primary_source_type,
  concat('https://openalex.org/S', CAST(l_suppkey AS STRING)) AS primary_source_id,
  CASE WHEN l_suppkey % 8 = 0 THEN NULL ELSE concat('https://openalex.org/S', CAST(l_suppkey + 1000 AS STRING)) END AS location_journal_id,
  CAST(l_quantity AS BIGINT) AS cited_by_count,
  CAST(l_partkey % 5 AS BIGINT) AS cites_y0, CAST(l_partkey % 3 AS BIGINT) AS cites_y1,
  CAST(l_suppkey % 4 AS BIGINT) AS cites_y3, CAST(l_suppkey % 6 AS BIGINT) AS cites_y5
FROM lineitem"""

META_RAW = """SELECT concat(CASE WHEN s_suppkey % 2 = 0 THEN '' ELSE ' ' END, CASE WHEN s_suppkey % 7 = 6 THEN 'SX' ELSE 'S' END, CAST(s_suppkey AS STRING)) AS openalex_id,
  y AS publication_year,
  CASE WHEN s_suppkey % 6 = 0 THEN '' ELSE concat(' ', s_name, CASE WHEN k = 1 AND s_suppkey % 5 = 0 THEN ' II' ELSE '' END) END AS journal_title,
  n_name AS journal_country,
  CASE WHEN s_suppkey % 3 = 0 THEN 'yes' WHEN s_suppkey % 3 = 1 THEN 'no' ELSE NULL END AS is_scielo,
  CASE WHEN (s_suppkey + y) % 2 = 0 THEN '1' ELSE '0' END AS scielo_active_valid,
  lower(r_name) AS scielo_collection_acronym
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
CROSS JOIN (SELECT DISTINCT CAST(year(l_shipdate) AS INT) AS y FROM lineitem) yy
CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 AS k) kk
WHERE k = 0 OR s_suppkey % 4 = 0 OR s_suppkey % 5 = 0"""

DOC_FLAT = """SELECT doc_id AS doc_idx, lang AS collection,
  concat('P', CAST(n_chars // 50 AS STRING)) AS pid_v2,
  CAST(2018 + doc_id % 2 AS INT) AS publication_year,
  concat('10.1590/', CAST(n_chars // 10 AS STRING)) AS doi,
  CASE WHEN doc_id % 3 = 0 THEN concat('10.1590/', CAST(n_chars // 10 + 1 AS STRING)) ELSE '' END AS doi_en,
  concat('title ', md5(replace(text, ' ', ''))) AS title_a,
  concat('other title ', md5(text)) AS title_b,
  concat('Journal ', source) AS journal_title,
  concat('ISSN-', CAST(n_chars % 3 AS STRING)) AS issn
FROM documents"""

ARTICLE_DOI = """SELECT o_orderkey // 3 AS article_idx, concat(CASE WHEN o_orderkey % 3 < 2 THEN '10.1590/' ELSE '10.1590/z' END, CAST(o_orderkey AS STRING)) AS doi FROM orders
UNION ALL SELECT o_orderkey // 3 - 1, concat('10.1590/', CAST(o_orderkey AS STRING)) FROM orders WHERE o_orderkey % 15 = 0 AND o_orderkey > 0
UNION ALL SELECT o_orderkey + 1000000, concat('10.1590/x', CAST(o_orderkey AS STRING)) FROM orders WHERE o_orderkey % 50 = 0"""

#: Views by name, each after those it reads.
VIEWS = {
    "works": WORKS,
    "lineitem_unique": LINEITEM_UNIQUE,
    "works_unique": WORKS.replace("FROM lineitem", "FROM lineitem_unique"),
    "works_json": WORKS_JSON,
    "raw_flat": RAW_FLAT,
    "meta_raw": META_RAW,
    "doc_flat": DOC_FLAT,
    "article_doi": ARTICLE_DOI,
}
_NEEDS = {"works_unique": ("lineitem_unique",), "works_json": ("works",)}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The view over the tables under ``sf_dir``."""
    for t in TABLES:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
    for n in (*_NEEDS.get(name, ()), name):
        spark.sql(VIEWS[n].replace("//", "div").replace("https:div", "https://")).createOrReplaceTempView(n)
    return spark.table(name)


def with_views(sql: str, *names: str) -> str:
    """``sql`` after definitions of the views that it reads."""
    wanted = [n for n in VIEWS if n in names or any(n in _NEEDS.get(m, ()) for m in names)]
    head = ", ".join(f"{n} AS ({VIEWS[n]})" for n in wanted)
    return f"WITH RECURSIVE {head}, {sql.removeprefix('WITH ')}" if sql.startswith("WITH ") else f"WITH {head} {sql}"
