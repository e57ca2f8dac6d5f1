"""SQL of the queries, for DuckDB, over the same views."""

from __future__ import annotations

from scholmill.operators.cohorts import LEVELS, PERCENTILES, WINDOWS
from scholmill.operators.indicators import CAPES_COLUMNS, INDEX_COLUMNS
from scholmill.plans.queries import PIVOT_YEARS, YEARS
from scholmill.plans.views import with_views

_KEY = "category_level, category_id, publication_year"
_SPANS = [("", "citations_total", None)] + [(f"_window_{w}y", f"citations_window_{w}y", w) for w in WINDOWS]


def _rows(levels=LEVELS, source="works") -> str:
    return "rows_ AS (" + " UNION ALL ".join(f"SELECT '{v}' AS category_level, {v} AS category_id, * FROM {source} WHERE {v} IS NOT NULL" for v in levels) + ")"


def _base(p: int, w: int | None) -> str:
    return f"top_{100 - p}pct_" + ("all_time" if w is None else f"window_{w}y")


def _baseline(spans=_SPANS) -> str:
    return "count(*) AS category_publications_count, " + ", ".join(f"CAST(sum(coalesce({x}, 0)) AS BIGINT) AS category_citations_total{n}, avg(coalesce({x}, 0)) AS category_citations_mean{n}" for n, x, _ in spans)


def _thresholds(spans=_SPANS, percentiles=PERCENTILES, plus: int = 0) -> str:
    return ", ".join(f"CAST(quantile_disc(coalesce({x}, 0), {p / 100}) AS BIGINT) + {plus} AS {_base(p, w)}_citations_threshold" for n, x, w in spans for p in percentiles)


def _journals(spans=_SPANS, percentiles=PERCENTILES) -> str:
    out = ["count(*) AS journal_publications_count", "min(journal_issn_l) AS journal_issn"]
    for n, x, w in spans:
        out += [f"CAST(sum(coalesce({x}, 0)) AS BIGINT) AS {'journal_citations_total' if w is None else 'citations' + n}", f"avg(coalesce({x}, 0)) AS journal_citations_mean{n}"]
        if w is not None:
            out.append(f"count(*) FILTER (WHERE {x} >= 1) AS citations{n}_works")
        out += [f"count(*) FILTER (WHERE {x} >= {_base(p, w)}_citations_threshold) AS {_base(p, w)}_publications_count" for p in percentiles]
    out += ["CAST(sum(citations_2000) AS BIGINT) AS citations_2000", "CAST(sum(citations_2001) AS BIGINT) AS citations_2001", "CAST(max(is_journal_oa) AS INT) AS is_journal_oa"]
    return ", ".join(out)


def _all(levels=LEVELS, spans=_SPANS, percentiles=PERCENTILES) -> str:
    """rows_, cohorts, journals and stats."""
    return f"""WITH {_rows(levels)},
cohorts AS (SELECT {_KEY}, {_baseline(spans)}, {_thresholds(spans, percentiles)} FROM rows_ GROUP BY ALL),
journals AS (SELECT {_KEY}, journal_id, {_journals(spans, percentiles)} FROM rows_ JOIN cohorts USING ({_KEY}) WHERE journal_id IS NOT NULL GROUP BY {_KEY}, journal_id),
stats AS (SELECT {_KEY}, avg(journal_publications_count) AS category_publications_mean, median(journal_publications_count) AS category_publications_median FROM journals GROUP BY ALL),
full_ AS (SELECT * FROM journals JOIN cohorts USING ({_KEY}) JOIN stats USING ({_KEY}))"""


def _ratio(a: str, b: str) -> str:
    return f"CASE WHEN {b} = 0 THEN 0.0 ELSE {a} / {b} END"


def _impact(n: str) -> str:
    return f"{_ratio(f'journal_citations_mean{n}', f'category_citations_mean{n}')} AS journal_impact_cohort{n}"


def _share(p: int, w: int | None) -> str:
    return f"CAST({_base(p, w)}_publications_count AS DOUBLE) * 100 / journal_publications_count AS {_base(p, w)}_publications_share_pct"


def _indicators() -> str:
    empty = ", ".join(f"'' AS {c}" for c in ("journal_publisher", "journal_country", "scielo_collection", "scielo_thematic_areas"))
    flags = ", ".join(f"CAST(0 AS INT) AS {c}" for c in (*CAPES_COLUMNS, *INDEX_COLUMNS, "is_journal_multilingual"))
    return f"{_all()} SELECT *, journal_id AS journal_title, {empty}, {flags}, {', '.join(_impact(n) for n, _, _ in _SPANS)}, {', '.join(_share(p, w) for _, _, w in _SPANS for p in PERCENTILES)} FROM full_"


_ACCEPTED = f"""accepted AS (SELECT *, CASE WHEN primary_source_type = 'journal' THEN primary_source_id ELSE location_journal_id END AS journal_id FROM raw_flat
  WHERE type = 'article' AND NOT coalesce(is_xpac, false) AND publication_year BETWEEN {YEARS[0]} AND {YEARS[1]}),
flat AS (SELECT work_id, publication_year, journal_id, CAST(CASE WHEN cited_by_count % 2 = 0 THEN 1 ELSE 0 END AS INT) AS is_journal_oa, cited_by_count AS citations_total,
  {", ".join(f"CASE {y} - publication_year WHEN 0 THEN cites_y0 WHEN 1 THEN cites_y1 WHEN 3 THEN cites_y3 WHEN 5 THEN cites_y5 END AS citations_{y}" for y in PIVOT_YEARS)},
  cites_y1 AS citations_window_2y, cites_y1 + cites_y3 AS citations_window_3y, cites_y1 + cites_y3 + cites_y5 AS citations_window_5y,
  CAST(cites_y1 > 0 AS INT) AS has_citation_window_2y, CAST(cites_y1 + cites_y3 > 0 AS INT) AS has_citation_window_3y, CAST(cites_y1 + cites_y3 + cites_y5 > 0 AS INT) AS has_citation_window_5y,
  updated_date, line_no FROM accepted WHERE journal_id IS NOT NULL)"""
_NEWEST = "row_number() OVER (PARTITION BY work_id ORDER BY updated_date DESC, line_no)"

_RUNS = f"""stored AS (SELECT *, CAST(1 AS INT) AS run_number FROM (SELECT *, {_NEWEST} AS n FROM flat WHERE updated_date <= '2024-01-02') WHERE n = 1
  UNION ALL SELECT *, CAST(2 AS INT) FROM (SELECT *, {_NEWEST} AS n FROM flat WHERE updated_date > '2024-01-02' AND work_id NOT IN (SELECT work_id FROM flat WHERE updated_date <= '2024-01-02')) WHERE n = 1)"""

_SUMMED = ("citations_total", *(f"citations_window_{w}y" for w in WINDOWS), "citations_2000", "citations_2001")
_MATCH = f"""owners AS (SELECT doi, max(article_idx) AS article_idx FROM article_doi GROUP BY doi),
hits AS (SELECT article_idx, work_id, replace(lower(w.doi), 'https://doi.org/', '') AS doi, is_journal_oa, {", ".join(LEVELS)}, {", ".join(f"coalesce({c}, 0) AS {c}" for c in _SUMMED)}
  FROM works_unique w JOIN owners o ON replace(lower(w.doi), 'https://doi.org/', '') = o.doi WHERE publication_year BETWEEN {YEARS[0]} AND {YEARS[1]}),
found AS (SELECT article_idx, count(*) AS match_count, {", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in _SUMMED)}, max(is_journal_oa) AS is_journal_oa,
  string_agg(work_id, ',' ORDER BY work_id) AS work_ids, min(work_id) AS survivor,
  {", ".join(f"array_to_string(list_sort(list(DISTINCT {v})), ',') AS {v}" for v in LEVELS)} FROM hits GROUP BY article_idx),
ids AS (SELECT DISTINCT article_idx FROM article_doi)"""

_DOCS = """docs AS (SELECT *, list_sort(list_distinct([title_a, title_b])) AS titles, CASE WHEN doi_en = '' OR doi_en = doi THEN [doi] ELSE [doi, doi_en] END AS dois FROM doc_flat),
doc_titles AS (SELECT doc_idx, dois, pid_v2, publication_year, journal_title, issn, unnest(titles) AS t FROM docs),
doc_dois AS (SELECT doc_idx, unnest(dois) AS d, t FROM doc_titles),
k_doi AS (SELECT doc_idx, concat('doi|', d, '|', t) AS k FROM doc_dois),
k_pid AS (SELECT doc_idx, concat('pid|', pid_v2, '|', t, '|', publication_year, '|', j) AS k FROM (SELECT *, unnest([issn, journal_title]) AS j FROM doc_titles)),
k_title AS (SELECT doc_idx, concat('title|', t, '|', publication_year, '|', j) AS k FROM (SELECT *, unnest([issn, journal_title]) AS j FROM doc_titles WHERE length(t) >= 15))"""


_KEY_OF = "trim(lower(replace(strip_accents({}), ' ', '')), concat(' ', chr(9), chr(10), chr(13)))"
#: Records in the order of their files, without those of no year or no DOI.
_RECORDS = f"""records AS (SELECT row_number() OVER (ORDER BY CASE WHEN doc_id % 5 = 0 THEN 0 ELSE 1 END, doc_id) - 1 AS doc_idx, doc_id, lang AS collection, concat('P', n_chars // 50) AS pid_v2, CAST(2018 + doc_id % 2 AS INT) AS publication_year,
  CASE WHEN doc_id % 5 = 1 THEN '' ELSE concat('10.1590/', n_chars // 10) END AS doi, CASE WHEN doc_id % 3 = 0 THEN concat('10.1590/', n_chars // 10 + 1) ELSE '' END AS doi_en,
  [split_part(coalesce(text, ''), chr(10), 1), split_part(coalesce(text, ''), chr(10), -1)] AS names, concat('Journal ', source) AS journal_title, concat('ISSN-', n_chars % 3) AS issn FROM documents),
docs AS (SELECT * EXCLUDE (names), list_sort(list_distinct([{_KEY_OF.format("x")} for x in names if x <> ''])) AS titles, list_distinct([x for x in [doi, doi_en] if x <> '']) AS dois FROM records WHERE doc_id % 11 <> 7 AND (doi <> '' OR doi_en <> ''))"""


def _article_of(*rules: str, docs: str | None = None) -> str:
    return _articles(*rules) if docs is None else _articles(*rules).replace(_DOCS[: _DOCS.index("doc_titles AS")], f"{docs},\n")


def _articles(*rules: str) -> str:
    keys = " UNION ".join(f"SELECT * FROM k_{r}" for r in rules)
    return f"""WITH {_DOCS}, ks AS ({keys}),
heads AS (SELECT k, min(doc_idx) AS head FROM ks GROUP BY k),
edges AS (SELECT DISTINCT doc_idx AS a, head AS b FROM ks JOIN heads USING (k) WHERE doc_idx <> head),
both_ AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach AS (SELECT doc_idx AS a, doc_idx AS b FROM docs UNION SELECT r.a, e.b FROM reach r JOIN both_ e ON r.b = e.a),
article_of AS (SELECT a AS doc_idx, min(b) AS article_idx FROM reach GROUP BY a)"""


def oracle_sql() -> dict[str, str]:
    domain = "WHERE publication_year IN (1994, 1995) AND category_id IN ('ASIA', 'EUROPE')"
    two = [_SPANS[0], _SPANS[1], _SPANS[3]]
    brief = [_SPANS[0], _SPANS[1]]
    sql = {
        "cohort_categories": (f"WITH {_rows()} SELECT DISTINCT {_KEY} FROM rows_", "works"),
        "cohort_category_filter": (f"WITH {_rows(('domain',))} SELECT {_KEY}, {_baseline()} FROM rows_ {domain} GROUP BY ALL", "works"),
        "cohort_baseline": (f"WITH {_rows()} SELECT {_KEY}, {_baseline()} FROM rows_ GROUP BY ALL", "works"),
        "cohort_thresholds": (f"WITH {_rows()} SELECT {_KEY}, {_thresholds()} FROM rows_ GROUP BY ALL", "works"),
        "cohort_thresholds_floor_plus_one": (f"WITH {_rows()} SELECT {_KEY}, {_thresholds(two, (90, 50), 1)} FROM rows_ GROUP BY ALL", "works"),
        "journal_metrics": (f"{_all()} SELECT * FROM journals", "works"),
        "journal_issn_conflicts": (f"WITH {_rows()} SELECT {_KEY}, journal_id, count(DISTINCT journal_issn_l) AS n_issns FROM rows_ WHERE journal_id IS NOT NULL GROUP BY ALL HAVING count(DISTINCT journal_issn_l) > 1", "works"),
        "journal_multilingual": (
            f"""WITH flagged AS (SELECT *, CASE WHEN coalesce(is_merged, false) AND (SELECT count(DISTINCT lower(trim(json_extract_string(j.value, '$.language')))) FROM
            json_each(CASE WHEN json_valid(oa_individual_works) THEN oa_individual_works ELSE '{{}}' END) j) > 1 THEN 1 ELSE 0 END AS m FROM works_json), {_rows(source="flagged")}
            SELECT {_KEY}, journal_id, max(m) AS is_journal_multilingual FROM rows_ WHERE journal_id IS NOT NULL GROUP BY ALL""",
            "works_json",
        ),
        "cohort_publication_stats": (f"{_all()} SELECT * FROM stats", "works"),
        "citation_percentiles_linear": (f"WITH {_rows()} SELECT {_KEY}, coalesce(quantile_cont(citations_total, 0.25), 0) AS p25, coalesce(quantile_cont(citations_total, 0.5), 0) AS p50, coalesce(quantile_cont(citations_total, 0.9), 0) AS p90 FROM rows_ GROUP BY ALL", "works"),
        "cohort_impact": (f"{_all()} SELECT {_KEY}, journal_id, {', '.join(_impact(n) for n, _, _ in _SPANS)} FROM full_", "works"),
        "top_share": (f"{_all()} SELECT {_KEY}, journal_id, {', '.join(_share(p, None) for p in PERCENTILES)}, {_share(90, 3)} FROM full_", "works"),
        "indicators_all_levels": (_indicators(), "works"),
        "comparability_flag": (
            f"""{_all()}, needed AS (SELECT {_KEY}, journal_id, journal_publications_count, greatest(12, CAST(ceil(CASE category_level WHEN 'domain' THEN 0.0003 WHEN 'field' THEN 0.001
            WHEN 'subfield' THEN 0.005 ELSE 0.02 END * category_publications_count) AS BIGINT), CAST(ceil(category_publications_median) AS BIGINT)) AS min_publications FROM full_)
            SELECT *, CASE WHEN journal_publications_count >= min_publications THEN 1 ELSE 0 END AS is_comparable FROM needed""",
            "works",
        ),
        "doi_match": (f"WITH {_MATCH} SELECT article_idx, work_id, doi, citations_total FROM hits", "works_unique", "article_doi"),
        "match_consolidated": (f"WITH {_MATCH} SELECT article_idx, match_count IS NOT NULL AS has_oa_match, match_count, {', '.join(_SUMMED)}, is_journal_oa, work_ids, {', '.join(LEVELS)} FROM ids LEFT JOIN found USING (article_idx)", "works_unique", "article_doi"),
        "merged_works": (
            f"""WITH {_MATCH}, mine AS (SELECT w.work_id, w.publication_year, {", ".join(f"f.{c}" for c in _SUMMED)}, f.is_journal_oa, w.domain, w.field, concat('S', f.article_idx) AS scielo_pid_v2,
            f.work_ids AS all_work_ids, f.match_count > 1 AS is_merged, f.survivor AS first_work FROM found f JOIN works_unique w ON w.work_id = f.survivor),
            rest AS (SELECT w.work_id, publication_year, {", ".join(f"coalesce({c}, 0)" for c in _SUMMED)}, is_journal_oa, domain, field, NULL, w.work_id, false, '' FROM works_unique w WHERE work_id NOT IN (SELECT work_id FROM hits)),
            alone AS (SELECT concat('scielo:S', article_idx), CAST(2000 + article_idx % 3 AS INT), {", ".join("0" for _ in _SUMMED)}, 0, NULL, NULL, concat('S', article_idx), '', false, '' FROM ids WHERE article_idx NOT IN (SELECT article_idx FROM found))
            SELECT * FROM mine UNION ALL SELECT * FROM rest UNION ALL SELECT * FROM alone""",
            "works_unique", "article_doi",
        ),
        "unmatched_coverage": (f"WITH {_MATCH} SELECT concat('J', article_idx % 7) AS journal_title, CAST(2000 + article_idx % 3 AS INT) AS publication_year, count(*) AS n_articles, count(match_count) AS n_matched, avg(CASE WHEN match_count IS NULL THEN 0 ELSE 1 END) AS share_matched FROM ids LEFT JOIN found USING (article_idx) GROUP BY 1, 2", "works_unique", "article_doi"),
        "extract_works": (f"WITH {_ACCEPTED} SELECT * FROM flat", "raw_flat"),
        "latest_works": (f"WITH {_ACCEPTED} SELECT * EXCLUDE (n) FROM (SELECT *, {_NEWEST} AS n FROM flat) WHERE n = 1", "raw_flat"),
        "incremental_works": (
            f"""WITH {_ACCEPTED}, known AS (SELECT work_id, updated_date FROM (SELECT *, {_NEWEST} AS n FROM flat WHERE updated_date <= '2024-01-02') WHERE n = 1),
            fresh AS (SELECT *, {_NEWEST} AS n FROM flat WHERE work_id NOT IN (SELECT work_id FROM known) AND updated_date NOT IN (SELECT updated_date FROM known))
            SELECT work_id, updated_date, line_no, citations_total FROM fresh WHERE n = 1""",
            "raw_flat",
        ),
        "ledger_works": (
            f"""WITH {_ACCEPTED}, {_RUNS} SELECT work_id, updated_date, citations_total, citations_1996, citations_window_5y, run_number FROM stored""",
            "raw_flat",
        ),
        "ledger_dates": (
            f"""WITH {_ACCEPTED}, {_RUNS}, raw AS (SELECT CASE WHEN updated_date <= '2024-01-02' THEN 1 ELSE 2 END AS run_number, updated_date, type, is_xpac, primary_source_type, location_journal_id FROM raw_flat
            UNION ALL SELECT 1, '2023-12-31', type, is_xpac, primary_source_type, location_journal_id FROM raw_flat WHERE type = 'book'),
            told AS (SELECT run_number, count(*) AS n_lines, count(*) FILTER (WHERE type = 'article' AND NOT coalesce(is_xpac, false) AND primary_source_type <> 'journal' AND location_journal_id IS NULL) AS n_no_journal FROM raw GROUP BY 1),
            dates AS (SELECT DISTINCT run_number, updated_date FROM raw), counts AS (SELECT updated_date, count(*) AS n FROM stored GROUP BY 1)
            SELECT CAST(run_number AS INT) AS run_number, updated_date, n_lines, CAST(0 AS BIGINT) AS n_unread, CAST(0 AS BIGINT) AS n_malformed, n_no_journal, coalesce(n, 0) AS n_works FROM dates JOIN told USING (run_number) LEFT JOIN counts USING (updated_date)
            UNION ALL SELECT 3, NULL, 0, 0, 0, 0, NULL""",
            "raw_flat",
        ),
        "dropped_lines": (
            f"""WITH {_ACCEPTED}, wanted AS (SELECT * FROM raw_flat WHERE line_no % 17 <> 0 AND type = 'article' AND NOT coalesce(is_xpac, false)),
            judged AS (SELECT *, line_no % 19 = 0 AND primary_source_type <> 'journal' AS bad, primary_source_type <> 'journal' AND location_journal_id IS NULL AS lone FROM wanted)
            SELECT (SELECT count(DISTINCT work_id) FROM judged WHERE NOT bad AND NOT lone) AS n_works, (SELECT count(*) FROM raw_flat) AS n_lines, (SELECT count(*) FROM raw_flat WHERE line_no % 17 = 0) AS n_unread,
            (SELECT count(*) FROM judged WHERE bad) AS n_malformed, (SELECT count(*) FROM judged WHERE lone AND NOT bad) AS n_no_journal""",
            "raw_flat",
        ),
        "merge_audit": (
            f"""WITH {_DOCS}, own AS (SELECT doc_idx, titles, unnest(dois) AS doi FROM docs)
            SELECT a.doi, a.doc_idx AS left_idx, b.doc_idx AS right_idx, list_has_any(a.titles, b.titles) AS merged, 'doi_match' AS reason FROM own a JOIN own b ON a.doi = b.doi AND a.doc_idx < b.doc_idx""",
            "doc_flat",
        ),
        "category_coverage": ("WITH names AS (SELECT r_name AS category_id FROM region UNION ALL SELECT n_name FROM nation) SELECT category_id, CASE WHEN category_id IN (SELECT domain FROM works) THEN 1 ELSE 0 END AS is_used FROM names", "works"),
        "normalize_doi": ("SELECT work_id, lower(replace(doi, 'https://doi.org/', '')) AS doi FROM works", "works"),
        "normalize_flags": (
            """SELECT openalex_id, publication_year, journal_country, journal_title, CAST(is_scielo IS NOT DISTINCT FROM 'yes' AS INT) AS is_scielo, CAST(scielo_active_valid = '1' AS INT) AS active, CAST(1 AS INT) AS has_year,
            CAST(is_scielo IS NOT DISTINCT FROM 'yes' AS INT) AS loose, concat('https://openalex.org/', trim(openalex_id)) AS journal_id, trim(journal_title) AS title FROM meta_raw""",
            "meta_raw",
        ),
        "short_ids": ("SELECT work_id, replace(work_id, 'https://openalex.org/', '') AS short_work, replace(journal_id, 'https://openalex.org/', '') AS short_journal, coalesce(citations_total, 0) AS citations FROM works", "works"),
        "extract_years": ("SELECT doc_idx, publication_year AS year, CAST(NULL AS INT) AS none, CAST(doc_idx AS INT) AS number FROM doc_flat", "doc_flat"),
    }
    sql["cohort_thresholds_histogram"] = sql["cohort_thresholds_bracketed"] = sql["cohort_thresholds"]
    sql["cohort_publication_stats_bracketed"] = sql["cohort_publication_stats"]
    meta = """m AS (SELECT concat('https://openalex.org/', trim(openalex_id)) AS journal_id, publication_year, trim(journal_title) AS journal_title, journal_country, scielo_collection_acronym,
      CAST(is_scielo IS NOT DISTINCT FROM 'yes' AS INT) AS is_scielo, CAST(scielo_active_valid = '1' AS INT) AS scielo_active_valid FROM meta_raw),
    judged AS (SELECT journal_id, publication_year, count(*) AS n, count(DISTINCT (journal_title, journal_country, scielo_collection_acronym, is_scielo, scielo_active_valid)) AS k FROM m GROUP BY ALL),
    meta AS (SELECT DISTINCT m.* FROM m JOIN judged USING (journal_id, publication_year) WHERE k = 1)"""
    sql["metadata_resolved"] = (f"WITH {meta} SELECT * FROM meta", "meta_raw")
    sql["metadata_conflicts"] = (f"WITH {meta} SELECT count(*) FILTER (WHERE n = 1) AS n_unique, count(*) FILTER (WHERE n > 1 AND k = 1) AS n_identical, count(*) FILTER (WHERE k > 1) AS n_conflicts FROM judged", "meta_raw")
    sql["indicator_reports"] = (
        f"""{_all()}, {meta}, kinds AS (SELECT {_KEY}, journal_id, count(DISTINCT journal_issn_l) AS k FROM rows_ WHERE journal_id IS NOT NULL GROUP BY ALL)
        SELECT count(*) FILTER (WHERE k > 0) AS n_with_issn, count(*) AS n_journals, count(*) FILTER (WHERE k > 1) AS n_issn_conflicts, (SELECT count(*) FROM judged WHERE n = 1) AS n_unique,
        (SELECT count(*) FROM judged WHERE n > 1 AND judged.k = 1) AS n_identical, (SELECT count(*) FROM judged WHERE judged.k > 1) AS n_conflicts FROM kinds""",
        "works", "meta_raw",
    )
    sql["indicators_enriched"] = (
        f"""{_all(LEVELS, brief, (90,))}, {meta} SELECT category_level, category_id, publication_year, replace(j.journal_id, 'https://openalex.org/', '') AS journal_id,
        coalesce(nullif(journal_title, ''), j.journal_id) AS journal_title, coalesce(journal_country, '') AS journal_country,
        CASE WHEN is_scielo = 1 AND scielo_active_valid = 1 THEN scielo_collection_acronym ELSE '' END AS scielo_collection, coalesce(is_scielo, 0) AS is_scielo, CAST(0 AS INT) AS is_scopus, journal_publications_count, {_impact("")}
        FROM full_ j LEFT JOIN meta USING (journal_id, publication_year)""",
        "works", "meta_raw",
    )
    for name, rules in (("resolve_doi", ("doi",)), ("resolve_pid", ("pid",)), ("resolve_title", ("title",))):
        sql[name] = (f"{_article_of(*rules)} SELECT * FROM article_of", "doc_flat")
    sql["resolve_all"] = (
        f"""{_article_of("doi", "pid", "title")}, g AS (SELECT article_idx, d.* FROM docs d JOIN article_of USING (doc_idx)),
        gt AS (SELECT article_idx, string_agg(DISTINCT t, '|' ORDER BY t) AS titles FROM (SELECT article_idx, unnest(titles) AS t FROM g) GROUP BY 1)
        SELECT article_idx, count(*) AS n_docs, string_agg(DISTINCT collection, '|' ORDER BY collection) AS collection, string_agg(DISTINCT pid_v2, '|' ORDER BY pid_v2) AS pid_v2, min(publication_year) AS publication_year,
        arg_min(doi, doc_idx) AS doi, coalesce(arg_max(doi_en, doc_idx) FILTER (WHERE doi_en <> ''), '') AS doi_en, min(gt.titles) AS titles, min(journal_title) AS journal_title, string_agg(DISTINCT issn, '|' ORDER BY issn) AS journal_issns
        FROM g JOIN gt USING (article_idx) GROUP BY article_idx""",
        "doc_flat",
    )
    sql["merge_audit_classes"] = (f"WITH {_DOCS} SELECT doi, array_to_string(titles, '|') AS titles, min(doc_idx) AS class_idx, count(*) AS n_docs FROM (SELECT doc_idx, titles, unnest(dois) AS doi FROM docs) GROUP BY doi, titles", "doc_flat")
    sql["metadata_from_csv"] = (f"WITH {meta} SELECT *, CAST(0 AS INT) AS is_scopus FROM meta", "meta_raw")
    sql["indicators_csv"] = (f"{_all(('domain',))} SELECT {_KEY}, journal_id, journal_issn, category_publications_count, journal_publications_count, {_impact('')}, {_share(90, None)} FROM full_", "works")
    sql["vocabulary_files"] = sql["category_coverage"]
    sql["mixed_schemas"] = (
        """SELECT work_id, publication_year, CAST(citations_total AS DOUBLE) AS citations_total, CASE WHEN publication_year % 3 <> 2 THEN citations_2000 END AS citations_2000, CASE WHEN publication_year % 3 <> 1 THEN citations_2001 END AS citations_2001 FROM works_unique""",
        "works_unique",
    )
    sql["merged_works_stored"] = sql["merged_works"]
    out = {name: with_views(*parts) for name, parts in sql.items()}
    out["article_docs"] = f"WITH {_RECORDS} SELECT doc_idx, collection, pid_v2, publication_year, doi, doi_en, array_to_string(titles, '|') AS titles, 'research' AS document_type, journal_title, issn AS journal_issns FROM docs"
    out["resolve_records"] = (
        f"""{_article_of("doi", "pid", "title", docs=_RECORDS)}, g AS (SELECT article_idx, d.* FROM docs d JOIN article_of USING (doc_idx)),
        gt AS (SELECT article_idx, string_agg(DISTINCT t, '|' ORDER BY t) AS titles FROM (SELECT article_idx, unnest(titles) AS t FROM g) GROUP BY 1),
        m AS (SELECT article_idx, count(*) AS n_docs, string_agg(DISTINCT collection, '|' ORDER BY collection) AS collection, string_agg(DISTINCT pid_v2, '|' ORDER BY pid_v2) AS pid_v2, min(publication_year) AS publication_year,
        arg_min(doi, doc_idx) FILTER (WHERE doi <> '') AS first_doi, coalesce(arg_max(doi_en, doc_idx) FILTER (WHERE doi_en <> ''), '') AS doi_en, min(journal_title) AS journal_title, string_agg(DISTINCT issn, '|' ORDER BY issn) AS journal_issns FROM g GROUP BY article_idx)
        SELECT article_idx, collection, pid_v2, publication_year, coalesce(first_doi, CASE WHEN n_docs > 1 THEN doi_en END, '') AS doi, doi_en, coalesce(titles, '') AS titles, journal_title, journal_issns FROM m LEFT JOIN gt USING (article_idx)"""
    ).replace("WITH ", "WITH RECURSIVE ", 1)
    out["normalize_titles"] = "SELECT doc_id, trim(lower(replace(strip_accents(text), ' ', '')), concat(' ', chr(9), chr(10), chr(13))) AS title_key FROM documents"
    return out
