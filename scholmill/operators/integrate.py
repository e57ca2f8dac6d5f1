"""Articles and works joined by DOI: matches, merged works, and what is left on either side.

Works can be any table, or one of ``store_by_doi``: then neither the match nor the merge moves works that belong to no article, however often they run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scholmill.functions import normalize as N
from scholmill.operators.cohorts import LEVELS, yearly_columns
from scholmill.operators.durable import shuffles_let_go, written

#: Normalised DOI of a stored work; that of a work without DOI starts with a space, which no normalised DOI does.
KEY = "doi_key"
WINDOW_COLUMNS = ("citations_window_2y", "citations_window_3y", "citations_window_5y")
FIRST_YEAR = 2012
#: What merged works have besides the columns of works.
MERGED_COLUMNS = ("scielo_collection", "scielo_pid_v2", "all_work_ids", "is_merged", "oa_individual_works")


def _strings() -> Column:
    return F.array().cast("array<string>")


def doi_owners(articles: DataFrame) -> DataFrame:
    """(doi, article_idx) of all DOIs of the articles; of several articles with one DOI the last has it."""
    dois = F.concat(F.array("doi"), F.coalesce(F.map_values("doi_with_lang"), _strings())) if "doi_with_lang" in articles.columns else F.array("doi")
    rows = articles.select("article_idx", F.explode(dois).alias("doi")).filter("doi IS NOT NULL AND doi <> ''")
    return rows.groupBy("doi").agg(F.max("article_idx").alias("article_idx"))


def store_by_doi(works: DataFrame, table: str, path: str, buckets: int) -> DataFrame:
    """Works as a table bucketed by ``doi_key``; works without DOI are spread by id. A join by DOI reads it without an exchange.

    Works have one row an id; a repeated one raises, before anything is written. All works of one DOI are in one bucket.
    """
    ids = works.filter("work_id IS NOT NULL").groupBy("work_id").count().filter("count > 1")
    if not ids.isEmpty():
        raise ValueError("work_id repeats: store the newest version of each work")
    alone = F.concat(F.lit(" "), F.coalesce("work_id", F.monotonically_increasing_id().cast("string")))
    keyed = works.withColumn(KEY, F.coalesce(F.nullif(N.doi("doi"), F.lit("")), alone))
    keyed.repartition(buckets, KEY).write.bucketBy(buckets, KEY).sortBy(KEY).option("path", path).mode("overwrite").saveAsTable(table)
    return works.sparkSession.table(table)


def _key(works: DataFrame) -> Column:
    return F.col(KEY) if KEY in works.columns else N.doi("doi")


def match_works(owners: DataFrame, works: DataFrame, start_year: int, end_year: int, years: list[int] | None = None) -> DataFrame:
    """Works of the years with a DOI of an article, once for each article, with their metrics filled."""
    held = [c for c in yearly_columns(works) if years is None or int(c[10:]) in years]
    slim = works.filter(F.col("publication_year").between(start_year, end_year)).select("work_id", _key(works).alias("doi"), "language", "journal_id", N.flag("is_journal_oa", dict(works.dtypes)["is_journal_oa"]).alias("is_journal_oa"), *LEVELS, *[N.count(c).alias(c) for c in ("citations_total", *WINDOW_COLUMNS, *held)])
    hits = slim.filter("doi <> '' AND NOT startswith(doi, ' ') AND work_id IS NOT NULL").join(owners, "doi")
    w = Window.partitionBy("article_idx", "work_id").orderBy(F.desc("doi"), F.desc("citations_total"), "journal_id")
    return hits.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def consolidate(matches: DataFrame) -> DataFrame:
    """One row for each matched article: ids, sums of all metrics, open access of any, DOIs and details by work, taxonomy sets."""
    sums = [c for c in matches.columns if c.startswith("citations_")]
    detail = F.struct("language", "journal_id", "is_journal_oa", F.col("citations_total").alias("total_citations"), *[c for c in sums if c != "citations_total"])
    found = matches.groupBy("article_idx").agg(
        F.array_sort(F.collect_set("work_id")).alias("work_ids"), F.collect_set("doi").alias("work_dois"), F.count("*").alias("match_count"),
        *[F.sum(c).alias(c) for c in sums], F.max("is_journal_oa").alias("is_journal_oa"),
        F.array_sort(F.collect_list(F.struct("work_id", detail.alias("metrics")))).alias("_works"),
        *[F.array_sort(F.collect_set(F.when(F.col(v) != "", F.col(v)))).alias(v) for v in LEVELS],
    )
    return found.withColumn("individual_works", F.map_from_entries("_works")).drop("_works")


def match_articles(articles: DataFrame, works: DataFrame, start_year: int, end_year: int, years: list[int] | None = None) -> DataFrame:
    """All articles with what ``consolidate`` found, and has_oa_match."""
    found = consolidate(match_works(doi_owners(articles), works, start_year, end_year, years))
    return articles.join(found, "article_idx", "left").withColumn("has_oa_match", F.col("match_count").isNotNull())


def citation_like(columns: list[str]) -> list[str]:
    return [c for c in columns if c.startswith("citations_") or "window" in c]


def merge_works(matched: DataFrame, works: DataFrame, base_row: str = "survivor", order: tuple[str, ...] = (), years: tuple[int, int] | None = None) -> DataFrame:
    """Works, those of one article as one row.

    The row is that of the smallest work_id (``survivor``), or of the first of the article's works by ``order`` (``first_scanned``). Totals are
    those of the article; empty taxonomy is filled field by field; a work of two articles goes to the last one. Works without article
    pass as they are, also repeated ones. Works of ``store_by_doi`` are tagged by DOI, as a DOI has one article and a work one DOI; ``years`` are
    those of the match.
    """
    if base_row not in ("survivor", "first_scanned"):
        raise ValueError(f"base_row must be survivor or first_scanned: {base_row!r}")
    stored = KEY in works.columns
    if stored and years is None:
        raise ValueError("works stored by DOI need the years of the match")
    works = works.fillna(0, subset=citation_like(works.columns))
    hit = matched.filter("has_oa_match") if "has_oa_match" in matched.columns else matched
    sums = [c for c in hit.columns if c.startswith("citations_")]
    survivor = hit.withColumn("survivor", F.array_min("work_ids"))
    # of articles with one survivor the last
    w = Window.partitionBy("survivor").orderBy(F.desc("article_idx"))
    data = survivor.withColumn("_n", F.row_number().over(w)).filter("_n = 1")
    has = lambda c, default: F.col(c) if c in data.columns else default
    data = data.select("survivor", F.struct(*sums, "is_journal_oa", *LEVELS, has("collection", F.lit(None).cast("array<string>")).alias("collection"), "pid_v2", "work_ids", F.to_json("individual_works", {"ignoreNullFields": "false"}).alias("individual_works")).alias("_m"))
    if stored:
        of = survivor.select(F.explode("work_dois").alias(KEY), F.col("survivor").alias("_of"))
        mine = F.col("work_id").isNotNull() & F.col("publication_year").between(*years)
        tagged = works.join(of, KEY, "left").withColumn("survivor", F.when(mine, F.col("_of"))).drop(KEY, "_of")
        works = works.drop(KEY)
    else:
        of = survivor.select("article_idx", "survivor", F.explode("work_ids").alias("work_id")).groupBy("work_id").agg(F.max_by("survivor", "article_idx").alias("survivor"))
        tagged = works.join(of, "work_id", "left")
    first = Window.partitionBy("survivor").orderBy(*([F.col("work_id") != F.col("survivor")] if base_row == "survivor" else []), *(order or ("work_id",)))
    rows = tagged.filter("survivor IS NOT NULL").withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n").join(data, "survivor")
    fixed = {c: F.col(f"_m.{c}").cast(dict(works.dtypes)[c]) for c in sums if c in works.columns}
    fixed |= {v: F.coalesce(F.nullif(F.col(v), F.lit("")), F.get(F.col(f"_m.{v}"), F.lit(0)), F.col(v)) for v in LEVELS}
    fixed["is_journal_oa"] = F.col("_m.is_journal_oa").cast(dict(works.dtypes)["is_journal_oa"])
    merged = rows.withColumns(fixed).select(*works.columns, F.col("_m.collection").alias("scielo_collection"), F.col("_m.pid_v2").alias("scielo_pid_v2"), F.col("_m.work_ids").alias("all_work_ids"), (F.size("_m.work_ids") > 1).alias("is_merged"), F.col("_m.individual_works").alias("oa_individual_works"))
    return merged.unionByName(_unmerged(tagged.filter("survivor IS NULL"), works.columns))


def _unmerged(works: DataFrame, columns: list[str]) -> DataFrame:
    """These columns of works without article, in the shape of merged works."""
    none = F.lit(None).cast("array<string>")
    return works.select(*columns, none.alias("scielo_collection"), none.alias("scielo_pid_v2"), F.array("work_id").alias("all_work_ids"), F.lit(False).alias("is_merged"), F.lit(None).cast("string").alias("oa_individual_works"))


def _alone(articles: list[str], kinds: list[tuple[str, str]]) -> dict[str, Column]:
    """Columns of an article without a work, in the shape of merged works of these types; ``articles``: the columns that articles have."""
    known = {
        "work_id": F.concat(F.lit("scielo:"), F.coalesce(F.get("pid_v2", F.lit(0)), F.lit(""))), "publication_year": F.col("publication_year") if "publication_year" in articles else F.lit(None).cast("int"),
        "doi": F.col("doi"), "is_journal_oa": F.lit(0), "scielo_collection": F.col("collection") if "collection" in articles else F.lit(None),
        "scielo_pid_v2": F.col("pid_v2"), "all_work_ids": _strings(), "is_merged": F.lit(False),
    }
    zero = set(citation_like([c for c, _ in kinds]))
    return {c: (known[c] if c in known else F.lit(0) if c in zero else F.lit(None)).cast(kind) for c, kind in kinds}


def unmatched_articles(matched: DataFrame, like: DataFrame) -> DataFrame:
    """Articles without a work, in the shape of merged works (``like``)."""
    return matched.filter("NOT has_oa_match").select(*[v.alias(c) for c, v in _alone(matched.columns, like.dtypes).items()])


def _integrated(articles: DataFrame, works: DataFrame, start_year: int, end_year: int, years: list[int] | None, base_row: str, columns: list[str] | None) -> DataFrame:
    """``integrate`` for ids of works that may repeat, and for stored works."""
    matched = written(match_articles(articles, works, start_year, end_year, years))
    merged = merge_works(matched, works, base_row, years=(start_year, end_year))
    out = merged.unionByName(unmatched_articles(matched, merged))
    return out if columns is None else out.select(*columns)


def _keyed(works: DataFrame, start_year: int, end_year: int) -> DataFrame:
    """Works with the normalised DOI (``_doi``) by which they take part in the match; those that don't are spread by id, below keys that no DOI equals."""
    fits = F.col("publication_year").between(start_year, end_year) & F.col("work_id").isNotNull()
    alone = F.concat(F.lit(" "), F.coalesce("work_id", F.monotonically_increasing_id().cast("string")))
    return works.withColumn("_doi", F.coalesce(F.when(fits, F.nullif(N.doi("doi"), F.lit(""))), alone))


def _tagged(owners: DataFrame, keyed: DataFrame) -> DataFrame:
    """Works with the article that has their DOI, or null. They move once, by DOI."""
    of = owners.filter("NOT startswith(doi, ' ')").select(F.col("doi").alias("_doi"), F.col("article_idx").alias("_article"))
    return keyed.join(of, "_doi", "left").drop("_doi")


def _merge_tagged(tagged: DataFrame, articles: DataFrame, asked: list[str], years: list[int] | None) -> DataFrame:
    """What ``merge_works`` and ``unmatched_articles`` make, of works whose ids don't repeat: a work then has one article, so that only those with one move, once, by article."""
    kinds, detailed = dict(tagged.dtypes), "oa_individual_works" in asked
    own = [c for c in tagged.columns if c in asked]
    held = [c for c in yearly_columns(tagged) if years is None or int(c[10:]) in years]
    sums = [c for c in ("citations_total", *WINDOW_COLUMNS, *held) if detailed or c in asked]
    levels = [v for v in LEVELS if v in asked]
    base = [c for c in own if c not in ("work_id", "is_journal_oa", *sums)]
    counts = {c: N.count(c) for c in sums}
    open_access = N.flag("is_journal_oa", kinds["is_journal_oa"])
    detail = [F.struct("language", "journal_id", open_access.alias("is_journal_oa"), counts["citations_total"].alias("total_citations"), *[counts[c].alias(c) for c in sums if c != "citations_total"]).alias("metrics")] if detailed else []
    filled = tagged.fillna(0, subset=citation_like(tagged.columns))

    hits = filled.filter("_article IS NOT NULL").repartition("_article")
    found = hits.groupBy("_article").agg(
        F.sort_array(F.collect_list(F.struct("work_id", *detail))).alias("_works"), F.min_by(F.struct("work_id", *base), "work_id").alias("_base"),
        *[F.sum(counts[c]).alias(f"_sum_{c}") for c in sums], F.max(open_access).alias("_oa"), *[F.min(F.when(F.col(v) != "", F.col(v))).alias(f"_least_{v}") for v in levels],
    )
    # a repeated article gives one merged row, as its works do, but any number of unmatched ones
    has = F.col("_works").isNotNull()
    again = F.row_number().over(Window.partitionBy("article_idx").orderBy("article_idx"))
    both = articles.join(found, articles["article_idx"] == F.col("_article"), "left").withColumn("_n", again).filter((F.col("_n") == 1) | ~has)

    merged = {c: F.col(f"_base.{c}") for c in ("work_id", *base)} | {c: F.col(f"_sum_{c}").cast(kinds[c]) for c in sums if c in own}
    merged |= {v: F.coalesce(F.nullif(F.col(f"_base.{v}"), F.lit("")), F.col(f"_least_{v}"), F.col(f"_base.{v}")) for v in levels}
    merged |= {"is_journal_oa": F.col("_oa").cast(kinds["is_journal_oa"]), "scielo_collection": F.col("collection") if "collection" in articles.columns else F.lit(None).cast("array<string>"), "scielo_pid_v2": F.col("pid_v2")}
    merged |= {"all_work_ids": F.col("_works.work_id"), "is_merged": F.size("_works") > 1, "oa_individual_works": F.to_json(F.map_from_entries("_works"), {"ignoreNullFields": "false"}) if detailed else F.lit(None)}
    rest = _unmerged(filled.filter("_article IS NULL"), own).select(*asked)
    alone = _alone(articles.columns, rest.dtypes)
    return both.select(*[F.when(has, merged[c]).otherwise(alone[c]).alias(c) for c in asked]).unionByName(rest)


def integrate(articles: DataFrame, works: DataFrame, start_year: int, end_year: int, years: list[int] | None = None, base_row: str = "survivor", columns: list[str] | None = None) -> DataFrame:
    """Merged works and unmatched articles, one table; of its columns all, or those of ``columns``.

    Works (unless stored by DOI) and articles are written once. Works then move by DOI, with the columns that are needed, and are written with their article; of these
    only works of an article move again. Where ids of works repeat, which a count of their hashes tells, and for works stored by DOI, matches are written and works are tagged by them.
    """
    if base_row not in ("survivor", "first_scanned"):
        raise ValueError(f"base_row must be survivor or first_scanned: {base_row!r}")
    if KEY in works.columns:
        return _integrated(written(articles), works, start_year, end_year, years, base_row, columns)
    asked = [*works.columns, *MERGED_COLUMNS] if columns is None else list(columns)
    detail = ("language", "journal_id", "citations_total", *WINDOW_COLUMNS, *yearly_columns(works)) if "oa_individual_works" in asked else ()
    with shuffles_let_go(works.sparkSession):
        slim = written(_keyed(works, start_year, end_year).select("_doi", *[c for c in works.columns if c in ("work_id", "is_journal_oa", *detail, *asked)]))
        articles = written(articles)
        tagged = written(_tagged(doi_owners(articles), slim))
        ids = tagged.filter("work_id IS NOT NULL").select(F.xxhash64("work_id").alias("_id")).repartition("_id")
        most = ids.groupBy("_id").count().agg(F.max("count")).first()[0]
    if most is not None and most > 1:
        return _integrated(articles, slim.drop("_doi") if columns is None else written(works), start_year, end_year, years, base_row, columns)
    return _merge_tagged(tagged, articles, asked, years)


def coverage(matched: DataFrame, by: tuple[str, ...] = ("journal_title", "publication_year")) -> DataFrame:
    """Articles, matched ones and their share, by journal and year."""
    return matched.groupBy(*by).agg(F.count("*").alias("n_articles"), F.count_if("has_oa_match").alias("n_matched"), F.avg(F.col("has_oa_match").cast("int")).alias("share_matched"))


def category_coverage(vocabulary: DataFrame, found: DataFrame) -> DataFrame:
    """Vocabulary names, and whether any work has them."""
    return vocabulary.join(found.select("category_id").distinct().withColumn("_f", F.lit(1)), "category_id", "left").select("category_id", F.coalesce("_f", F.lit(0)).alias("is_used"))
