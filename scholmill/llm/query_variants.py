"""Queries of the conversation trie, the license scan and the spelling variants."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholmill.llm import conversation_trie as T
from scholmill.llm import spelling as S
from scholmill.llm.license_scan import PHRASES, TEMPLATES, license_scan, words_of


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.prefix_trie(T.regrouped(T.conversations(spark.read.parquet(f"{sf_dir}/conversations.parquet"))))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scan = license_scan(spark.read.parquet(f"{sf_dir}/documents.parquet"), threshold=0.9)
    labels = F.array_sort(F.array_union("base", F.transform("found", lambda x: x["label"])))
    score = F.greatest(F.when(F.size("base") > 0, 1.0).otherwise(0.0), F.coalesce(F.array_max(F.transform("found", lambda x: x["share"])), F.lit(0.0)))
    return scan.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), score.alias("score"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.spelling_groups(S.varied_words(spark.read.parquet(f"{sf_dir}/documents.parquet"), length=5, least=3))


def _listed(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


_SETS = [(label, sorted(set(words_of(text)))) for label, text in TEMPLATES]
_VALUES = ", ".join(f"({t}, '{label}', {_listed(words)}, {[u for u, (_, other) in enumerate(_SETS) if set(words) < set(other)]}::INT[])" for t, (label, words) in enumerate(_SETS))
_PLACES = " UNION ALL ".join(f"SELECT r, i - 1 AS place, '{label}' AS label FROM starts WHERE w[i:i + {len(words_of(p)) - 1}] = {_listed(words_of(p))}" for p, label in PHRASES)

#: Every block against every template, without filters; every place against every phrase.
OP12_SQL = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
starts AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM docs),
places AS ({_PLACES}),
base AS (SELECT r, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, list(DISTINCT label) AS ls FROM places GROUP BY r),
templates(t, label, words, above) AS (VALUES {_VALUES}),
blocks AS (SELECT r, i, w[i + 1:i + 64] AS b FROM (SELECT r, w, unnest(range(0, greatest(len(w) - 64 + 31, 0) // 32 * 32 + 1, 32)) AS i FROM docs)),
pairs AS (SELECT r, i, t, label, above, len(list_intersect(words, b)) / len(words) AS share FROM blocks, templates),
hits AS (SELECT * FROM pairs WHERE share >= 0.9),
found AS (SELECT r, list(DISTINCT label) AS ls, max(share) AS share FROM (SELECT h.r, h.i, h.label, h.share, h.above, list(t) OVER (PARTITION BY r, i) AS there FROM hits h) WHERE NOT list_has_any(above, there) GROUP BY r)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, first_word, last_word, coalesce(array_to_string(list_sort(b.ls), ','), '') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(b.ls, []), coalesce(f.ls, [])))), ',') AS labels, CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(f.share, 0.0) END AS score
FROM docs d LEFT JOIN base b USING (r) LEFT JOIN found f USING (r)
"""
