"""A query for each operator, over views of the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from scholmill.functions import normalize as N
from scholmill.functions.statistics import linear_percentiles
from scholmill.operators import articles as A
from scholmill.operators import cohorts as C
from scholmill.operators import extract as E
from scholmill.operators import indicators as I
from scholmill.operators import integrate as G
from scholmill.operators import metadata as M
from scholmill.operators.durable import cut, scratch, written
from scholmill.plans.views import view
from scholmill.sources import articles as SA
from scholmill.sources import works as SW
from scholmill.sources.works import parse_snapshot
from scholmill.streaming import ledger

#: All years of publication, and all years that counts of the views reach.
YEARS = (1, 9999)
PIVOT_YEARS = list(range(1992, 2004))


def cohort_categories(spark, sf_dir):
    return C.categories(view(spark, sf_dir, "works"))


def cohort_category_filter(spark, sf_dir):
    return C.cohort_baseline(view(spark, sf_dir, "works"), levels=("domain",), years=[1994, 1995], only=["ASIA", "EUROPE"])


def cohort_baseline(spark, sf_dir):
    return C.cohort_baseline(view(spark, sf_dir, "works"))


def cohort_thresholds(spark, sf_dir):
    return C.cohort_thresholds(view(spark, sf_dir, "works"))


def cohort_thresholds_histogram(spark, sf_dir):
    return C.cohort_thresholds_histogram(view(spark, sf_dir, "works"))


def cohort_thresholds_bracketed(spark, sf_dir):
    return C.cohort_thresholds_bracketed(view(spark, sf_dir, "works"))


def cohort_thresholds_floor_plus_one(spark, sf_dir):
    return C.cohort_thresholds(view(spark, sf_dir, "works"), windows=(2, 5), percentiles=(90, 50), threshold_mode="floor_plus_one")


def journal_metrics(spark, sf_dir):
    works = written(view(spark, sf_dir, "works").drop("work_id", "language", "doi"))
    return C.journal_metrics(works, C._small(cut(C.cohort_thresholds_bracketed(works)))).drop("is_journal_multilingual")


def journal_issn_conflicts(spark, sf_dir):
    return C.issn_conflicts(view(spark, sf_dir, "works"))


def journal_multilingual(spark, sf_dir):
    return C.journal_multilingual(view(spark, sf_dir, "works_json"))


def cohort_publication_stats(spark, sf_dir):
    return C.publication_stats(C.journal_sizes(view(spark, sf_dir, "works")))


def cohort_publication_stats_bracketed(spark, sf_dir):
    return C.publication_stats_bracketed(C.journal_sizes(view(spark, sf_dir, "works")))


def citation_percentiles_linear(spark, sf_dir):
    rows = C.cohort_rows(view(spark, sf_dir, "works"))
    p = rows.groupBy(*C.COHORT).agg(linear_percentiles("citations_total", [0.25, 0.5, 0.9]).alias("p"))
    return p.select(*C.COHORT, F.col("p")[0].alias("p25"), F.col("p")[1].alias("p50"), F.col("p")[2].alias("p90"))


def _indicators(spark, sf_dir, columns=None):
    return I.build_indicators(view(spark, sf_dir, "works"), columns=columns)


def cohort_impact(spark, sf_dir):
    asked = [*C.COHORT, "journal_id", "journal_impact_cohort", *[f"journal_impact_cohort_window_{w}y" for w in C.WINDOWS]]
    return _indicators(spark, sf_dir, asked).select(*asked)


def top_share(spark, sf_dir):
    asked = [*C.COHORT, "journal_id", *[f"top_{N.top(p)}pct_all_time_publications_share_pct" for p in C.PERCENTILES], "top_10pct_window_3y_publications_share_pct"]
    return _indicators(spark, sf_dir, asked).select(*asked)


def indicators_all_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _indicators(spark, sf_dir)


def comparability_flag(spark, sf_dir):
    asked = [*C.COHORT, "journal_id", "journal_publications_count", "category_publications_count", "category_publications_median"]
    return I.comparability(_indicators(spark, sf_dir, asked)).select(*C.COHORT, "journal_id", "journal_publications_count", "min_publications", "is_comparable")


def metadata_resolved(spark, sf_dir):
    return M.resolve_conflicts(M.normalize(view(spark, sf_dir, "meta_raw")))


def metadata_conflicts(spark, sf_dir):
    return M.conflict_stats(M.normalize(view(spark, sf_dir, "meta_raw")))


def indicators_enriched(spark, sf_dir):
    meta = M.resolve_conflicts(M.normalize(view(spark, sf_dir, "meta_raw")))
    asked = ["category_level", "category_id", "publication_year", "journal_id", "journal_title", "journal_country", "scielo_collection", "is_scielo", "is_scopus", "journal_publications_count", "journal_impact_cohort"]
    return I.build_indicators(view(spark, sf_dir, "works"), meta, short_ids=True, columns=asked).select(*asked)


def _raw_lines(spark, sf_dir):
    """raw_flat as the JSON lines of a snapshot."""
    flat = view(spark, sf_dir, "raw_flat")
    source = "named_struct('id', {}, 'type', {}, 'issn_l', 'I', 'is_oa', cited_by_count % 2 = 0)"
    counts = ", ".join(f"named_struct('year', publication_year + {k}, 'cited_by_count', cites_y{k})" for k in (0, 1, 3, 5))
    packed = f"""to_json(named_struct('id', work_id, 'type', type, 'is_xpac', is_xpac, 'publication_year', publication_year, 'language', 'en',
      'doi', concat('10.1/', work_id), 'cited_by_count', cited_by_count,
      'primary_location', named_struct('source', {source.format("primary_source_id", "primary_source_type")}),
      'locations', CASE WHEN location_journal_id IS NULL THEN array(named_struct('source', {source.format("'x'", "'repository'")}))
                   ELSE array(named_struct('source', {source.format("'x'", "'repository'")}), named_struct('source', {source.format("location_journal_id", "'journal'")})) END,
      'counts_by_year', array({counts})))"""
    return flat.select(F.expr(packed).alias("value"), "updated_date", F.lit("part").alias("file_path"), "line_no", "type", "work_id")


def raw_works(spark, sf_dir):
    return parse_snapshot(_raw_lines(spark, sf_dir).drop("type", "work_id"))


def _two_runs(spark, sf_dir):
    """A store after two runs over a snapshot that grew between them, with a date that has no works. Returns the store and what the runs report."""
    folder = f"{scratch(spark)}/snapshot-{uuid.uuid4().hex}"
    lines = _raw_lines(spark, sf_dir)
    books = lines.filter("type = 'book'").withColumn("updated_date", F.lit("2023-12-31"))

    def add(rows):
        # all versions of a work in one task, so that its files keep their order of lines; a task writes a file a date, and a date has as many files as there are tasks
        rows.repartition("work_id").sortWithinPartitions("updated_date", "line_no").select("value", "updated_date").write.mode("append").partitionBy("updated_date").option("compression", "gzip").text(f"{folder}/raw")

    def one():
        return ledger.run(spark, f"{folder}/raw", f"{folder}/store", *YEARS, PIVOT_YEARS, glob="part-*.gz")

    add(books.unionByName(lines.filter("updated_date <= '2024-01-02'")))
    reports = [one()]
    add(lines.filter("updated_date > '2024-01-02'"))
    return f"{folder}/store", [*reports, one(), one()]


def ledger_works(spark, sf_dir):
    """Works of the store, by run."""
    store, reports = _two_runs(spark, sf_dir)
    number = F.when(F.col("run") == reports[0]["run"], 1).otherwise(2)
    return ledger.read_store(spark, store).select("work_id", F.col("updated_date").cast("string").alias("updated_date"), "citations_total", "citations_1996", "citations_window_5y", number.alias("run_number"))


def ledger_dates(spark, sf_dir):
    """What the ledger says: dates by run, those without works too, and what the runs have dropped."""
    store, reports = _two_runs(spark, sf_dir)
    told = spark.createDataFrame([(r["run"], k, r["n_lines"], r["n_unread"], r["n_malformed"], r["n_no_journal"]) for k, r in enumerate(reports, 1)], "run string, run_number int, n_lines long, n_unread long, n_malformed long, n_no_journal long")
    rows = ledger.read_ledger(spark, store).groupBy("run", F.col("updated_date").cast("string").alias("updated_date")).agg(F.sum("n_works").alias("n_works"))
    return told.join(rows, "run", "left").drop("run")


def dropped_lines(spark, sf_dir):
    """Counts observed while lines of a snapshot, some of them broken, are extracted."""
    lines = _raw_lines(spark, sf_dir)
    broken = F.when(F.col("line_no") % 17 == 0, F.left("value", F.lit(20))).when(F.col("line_no") % 19 == 0, F.regexp_replace("value", '"locations":\\[.*?\\],"counts_by_year"', '"counts_by_year"')).otherwise(F.col("value"))
    seen = Observation()
    raw = E.observed(parse_snapshot(lines.withColumn("value", broken).drop("type", "work_id")), *YEARS, seen)
    works = E.latest(E.project(E.accepted(raw, *YEARS), [], keep=("updated_date", "file_path", "line_no")))
    kept = works.count()
    return spark.createDataFrame([(kept, *(seen.get[c] for c in ("n_lines", "n_unread", "n_malformed", "n_no_journal")))], "n_works long, n_lines long, n_unread long, n_malformed long, n_no_journal long")


def indicator_reports(spark, sf_dir):
    """Conflicts of ISSNs and of metadata, observed while the indicators are made."""
    journals, metadata = Observation(), Observation()
    meta = cut(M.resolve_conflicts(M.normalize(view(spark, sf_dir, "meta_raw")), seen=metadata))
    n = I.build_indicators(view(spark, sf_dir, "works"), meta, seen=journals, columns=["journal_issn"]).select(F.count_if(F.col("journal_issn").isNotNull())).first()[0]
    row = (n, journals.get["n_journals"], journals.get["n_issn_conflicts"], *(metadata.get[c] for c in ("n_unique", "n_identical", "n_conflicts")))
    return spark.createDataFrame([row], "n_with_issn long, n_journals long, n_issn_conflicts long, n_unique long, n_identical long, n_conflicts long")


_FLAT = ["work_id", "publication_year", "journal_id", "is_journal_oa", "citations_total", *(f"citations_{y}" for y in PIVOT_YEARS), *(f"citations_window_{w}y" for w in E.WINDOWS), *(f"has_citation_window_{w}y" for w in E.WINDOWS)]


def extract_works(spark, sf_dir):
    rows = E.accepted(raw_works(spark, sf_dir), *YEARS)
    return E.project(rows, PIVOT_YEARS, keep=("updated_date", "line_no")).select(*_FLAT, "updated_date", "line_no")


def latest_works(spark, sf_dir):
    return E.extract_works(raw_works(spark, sf_dir), *YEARS, years=PIVOT_YEARS).select(*_FLAT, "updated_date", "line_no")


def incremental_works(spark, sf_dir):
    raw = raw_works(spark, sf_dir)
    known = E.extract_works(raw.filter("updated_date <= '2024-01-02'"), *YEARS, years=[])
    return E.extract_works(raw, *YEARS, years=[], known=known).select("work_id", "updated_date", "line_no", "citations_total")


def _articles(spark, sf_dir):
    rows = view(spark, sf_dir, "article_doi")
    out = rows.groupBy("article_idx").agg(F.array_sort(F.collect_set("doi")).alias("d"))
    langs = F.transform(F.col("d"), lambda x, i: F.concat(F.lit("l"), i.cast("string")))
    return out.select("article_idx", F.col("d")[0].alias("doi"), F.map_from_arrays(langs, F.col("d")).alias("doi_with_lang"), F.array(F.concat(F.lit("S"), F.col("article_idx").cast("string"))).alias("pid_v2"), F.concat(F.lit("J"), (F.col("article_idx") % 7).cast("string")).alias("journal_title"), (2000 + F.col("article_idx") % 3).cast("int").alias("publication_year"))


def doi_match(spark, sf_dir):
    return G.match_works(G.doi_owners(_articles(spark, sf_dir)), view(spark, sf_dir, "works_unique"), *YEARS).select("article_idx", "work_id", "doi", "citations_total")


def match_consolidated(spark, sf_dir):
    m = G.match_articles(_articles(spark, sf_dir), view(spark, sf_dir, "works_unique"), *YEARS)
    joined = lambda c: F.array_join(c, ",").alias(c)
    return m.select("article_idx", "has_oa_match", "match_count", "citations_total", *G.WINDOW_COLUMNS, "citations_2000", "citations_2001", "is_journal_oa", joined("work_ids"), *[joined(v) for v in C.LEVELS])


def _merged(articles, works):
    plain = ["work_id", "publication_year", "citations_total", *G.WINDOW_COLUMNS, "citations_2000", "citations_2001", "is_journal_oa", "domain", "field", "is_merged"]
    out = G.integrate(articles, works, *YEARS, columns=[*plain, "scielo_pid_v2", "all_work_ids", "oa_individual_works"])
    return out.select(*plain[:-1], F.array_join("scielo_pid_v2", ",").alias("scielo_pid_v2"), F.array_join("all_work_ids", ",").alias("all_work_ids"), "is_merged", F.coalesce(F.json_object_keys("oa_individual_works")[0], F.lit("")).alias("first_work"))


def merged_works(spark, sf_dir):
    return _merged(_articles(spark, sf_dir), view(spark, sf_dir, "works_unique"))


def merged_works_stored(spark, sf_dir):
    """The same from works stored by DOI."""
    name = f"works_{uuid.uuid4().hex}"
    works = G.store_by_doi(view(spark, sf_dir, "works_unique"), name, f"{scratch(spark)}/{name}", int(spark.conf.get("spark.sql.shuffle.partitions")))
    return _merged(_articles(spark, sf_dir), works)


def unmatched_coverage(spark, sf_dir):
    return G.coverage(G.match_articles(_articles(spark, sf_dir), view(spark, sf_dir, "works_unique"), *YEARS))


def _docs(spark, sf_dir):
    flat = view(spark, sf_dir, "doc_flat")
    langs = F.when(F.col("doi_en") != "", F.create_map(F.lit("en"), F.col("doi_en"))).otherwise(F.expr("cast(map() AS map<string,string>)"))
    return flat.select("doc_idx", "collection", "pid_v2", "publication_year", "doi", langs.alias("doi_with_lang"), F.array_sort(F.array_distinct(F.array("title_a", "title_b"))).alias("titles"), F.lit("research").alias("document_type"), "journal_title", F.array("issn").alias("journal_issns"))


def resolve_doi(spark, sf_dir):
    return A.article_of(_docs(spark, sf_dir), ("doi",))


def resolve_pid(spark, sf_dir):
    return A.article_of(_docs(spark, sf_dir), ("pid",))


def resolve_title(spark, sf_dir):
    return A.article_of(_docs(spark, sf_dir), ("title",))


def resolve_all(spark, sf_dir):
    r = A.resolve_articles(_docs(spark, sf_dir))
    joined = lambda c: F.array_join(c, "|").alias(c)
    return r.select("article_idx", "n_docs", joined("collection"), joined("pid_v2"), "publication_year", "doi", F.coalesce(F.col("doi_with_lang")["en"], F.lit("")).alias("doi_en"), joined("titles"), "journal_title", joined("journal_issns"))


def merge_audit(spark, sf_dir):
    return A.merge_audit(_docs(spark, sf_dir))


def merge_audit_classes(spark, sf_dir):
    return A.audit_classes(_docs(spark, sf_dir)).select("doi", F.array_join("titles", "|").alias("titles"), "class_idx", "n_docs")


def _records(spark, sf_dir):
    """Article records of the documents in files of two folders, a fifth of them in the first, read back as they stand there."""
    d = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("text", F.coalesce("text", F.lit("")))
    part = lambda n: F.concat(F.lit("10.1590/"), F.expr(f"cast(n_chars div 10 + {n} AS string)"))
    pair = lambda lang, doi: F.struct(F.lit(lang).alias("lang"), doi.alias("doi"))
    en = F.when(F.col("doc_id") % 3 == 0, F.array(pair("en", F.lit("doi:10.1590/OLD")), pair("pt", F.lit(" ")), pair("en", F.concat(F.lit("https://doi.org/"), part(1)))))
    issn = F.concat(F.lit(" ISSN-"), (F.col("n_chars") % 3).cast("string"))
    journal = F.struct(F.concat(F.lit("Journal "), "source", F.lit(" ")).alias("title"), issn.alias("any_issn"), F.trim(issn).alias("scielo_issn"), F.lit("").alias("electronic_issn"))
    records = d.select(
        "doc_id", F.col("lang").alias("collection_acronym"), F.concat(F.lit("P"), F.expr("cast(n_chars div 50 AS string)")).alias("publisher_id"), F.when(F.col("doc_id") % 11 == 7, F.lit("n.d.")).otherwise((2018 + F.col("doc_id") % 2).cast("string")).alias("publication_year"),
        F.when(F.col("doc_id") % 5 != 1, F.concat(F.lit("DOI:"), part(0))).alias("doi"), en.alias("doi_and_lang"), F.lit(" research ").alias("document_type"),
        F.expr("split_part(text, chr(10), 1)").alias("original_title"), F.create_map(F.lit("en"), F.expr("split_part(text, chr(10), -1)")).alias("translated_titles"), journal.alias("journal"),
    )
    folder = f"{scratch(spark)}/records-{uuid.uuid4().hex}"
    for name, rows in (("a", records.filter("doc_id % 5 = 0")), ("b", records.filter("doc_id % 5 <> 0"))):
        rows.orderBy("doc_id").select(F.to_json(F.struct(*[c for c in rows.columns if c != "doc_id"])).alias("value")).write.text(f"{folder}/{name}")
    return SA.read_records(spark, f"{folder}/*")


def article_docs(spark, sf_dir):
    """Records of several files to docs, numbered by file and line."""
    docs = A.article_docs(_records(spark, sf_dir), 2018, 2025)
    joined = lambda c: F.array_join(c, "|").alias(c)
    return docs.select("doc_idx", "collection", "pid_v2", "publication_year", "doi", F.coalesce(F.col("doi_with_lang")["en"], F.lit("")).alias("doi_en"), joined("titles"), "document_type", "journal_title", joined("journal_issns"))


def resolve_records(spark, sf_dir):
    """Articles of records of several files, written as JSON lines and read back: first DOI and last language by file and line."""
    path = f"{scratch(spark)}/resolved-{uuid.uuid4().hex}"
    SA.write_json(A.resolve_articles(cut(A.article_docs(_records(spark, sf_dir), 2018, 2025))), path)
    r = SA.read_resolved(spark, path)
    joined = lambda c: F.array_join(c, "|").alias(c)
    return r.select("article_idx", joined("collection"), joined("pid_v2"), "publication_year", "doi", F.coalesce(F.col("doi_with_lang")["en"], F.lit("")).alias("doi_en"), joined("titles"), "journal_title", joined("journal_issns"))


def mixed_schemas(spark, sf_dir):
    """Works written as files of three schemas, some with long and some with double counts, read as one table."""
    works = view(spark, sf_dir, "works_unique").select("work_id", "publication_year", "citations_total", "citations_2000", "citations_2001")
    path = f"{scratch(spark)}/mixed-{uuid.uuid4().hex}"
    third = F.pmod(F.col("publication_year"), F.lit(3))
    works.filter(third == 0).write.parquet(f"{path}/x")
    works.filter(third == 1).withColumn("citations_total", F.col("citations_total").cast("double")).drop("citations_2001").write.parquet(f"{path}/y/deep")
    works.filter(third == 2).drop("citations_2000").write.parquet(f"{path}/z")
    got = SW.read_works(spark, path)
    return got.select("work_id", "publication_year", "citations_total", *C.yearly_columns(got))


def metadata_from_csv(spark, sf_dir):
    """The metadata source table as CSV with its own column names, loaded and resolved."""
    raw = view(spark, sf_dir, "meta_raw")
    named = raw.select(*[F.col(c).cast("string").alias(source) if c in raw.columns else F.lit("").alias(source) for c, source in M.SOURCE_NAMES.items()])
    path = f"{scratch(spark)}/meta-{uuid.uuid4().hex}"
    named.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    meta = M.journal_metadata(spark.read.option("header", True).option("ignoreLeadingWhiteSpace", False).csv(path))
    return meta.select("journal_id", "publication_year", "journal_title", "journal_country", "scielo_collection_acronym", "is_scielo", "scielo_active_valid", "is_scopus")


def indicators_csv(spark, sf_dir):
    """The indicators of a level as CSV by level and year, read back."""
    out = I.build_indicators(view(spark, sf_dir, "works"), levels=("domain",))
    path = f"{scratch(spark)}/csv-{uuid.uuid4().hex}"
    I.write_csv(out, path, partition=True)
    back = spark.read.option("header", True).csv(path)
    back = back.toDF(*[c.replace(" ", "_") for c in back.columns])
    number = {"category_publications_count": "long", "journal_publications_count": "long", "publication_year": "int", "journal_impact_cohort": "double", "top_10pct_all_time_publications_share_pct": "double"}
    return back.select("category_level", "category_id", "journal_id", "journal_issn", *[F.col(c).cast(k).alias(c) for c, k in number.items()])


def vocabulary_files(spark, sf_dir):
    """Category names of files of quoted lines, and whether works use them."""
    works = view(spark, sf_dir, "works")
    names = spark.table("region").select(F.col("r_name").alias("v")).unionByName(spark.table("nation").select(F.col("n_name").alias("v")))
    path = f"{scratch(spark)}/vocabulary-{uuid.uuid4().hex}/domain.txt"
    names.select(F.explode(F.array(F.concat(F.lit(' "'), "v", F.lit('" ')), F.lit("  "))).alias("value")).write.text(path)
    return G.category_coverage(SA.category_vocabulary(spark, path, "domain", glob="*"), C.categories(works, ("domain",)))


def category_coverage(spark, sf_dir):
    works = view(spark, sf_dir, "works")
    names = spark.table("region").select(F.col("r_name").alias("category_id")).unionByName(spark.table("nation").select(F.col("n_name").alias("category_id")))
    return G.category_coverage(names, C.categories(works, ("domain",)))


def normalize_doi(spark, sf_dir):
    w = view(spark, sf_dir, "works")
    return w.select("work_id", N.doi(F.concat(F.lit(" DOI:"), F.upper("doi"), F.lit("\t"))).alias("doi"))


def normalize_flags(spark, sf_dir):
    s = view(spark, sf_dir, "meta_raw")
    return s.select("openalex_id", "publication_year", "journal_country", "journal_title", N.flag("is_scielo").alias("is_scielo"), N.flag("scielo_active_valid").alias("active"), N.flag("publication_year", "int").alias("has_year"), N.flag(F.concat(F.lit(" "), F.initcap("is_scielo"))).alias("loose"), N.journal_id("openalex_id").alias("journal_id"), N.text("journal_title").alias("title"))


def short_ids(spark, sf_dir):
    return view(spark, sf_dir, "works").select("work_id", N.short_id("work_id").alias("short_work"), N.short_id("journal_id").alias("short_journal"), N.count("citations_total").alias("citations"))


def extract_years(spark, sf_dir):
    d = view(spark, sf_dir, "doc_flat")
    return d.select("doc_idx", N.year(F.concat(F.lit(" "), "publication_year", F.lit("\n"))).alias("year"), N.year("pid_v2").alias("none"), N.year(F.col("doc_idx")).alias("number"))


def normalize_titles(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select("doc_id", N.title_key("text").alias("title_key"))
