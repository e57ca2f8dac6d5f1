"""The indicator table: cohort and journal metrics, ratios and metadata, for all cohorts in one job."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from scholmill.functions import normalize as N
from scholmill.functions.statistics import ratio, share_percent
from scholmill.operators import cohorts as C
from scholmill.operators.durable import cut, written

#: Names of metadata columns, and the shares and least number of the comparability flag.
TEXT_COLUMNS = ("journal_title", "journal_publisher", "journal_country", "scielo_collection_acronym", "scielo_thematic_areas")
CAPES_COLUMNS = (
    "capes_agricultural_sciences",
    "capes_applied_social_sciences",
    "capes_biological_sciences",
    "capes_engineering",
    "capes_exact_and_earth_sciences",
    "capes_health_sciences",
    "capes_human_sciences",
    "capes_linguistics_letters_and_arts",
    "capes_multidisciplinary",
    "capes_life_sciences",
    "capes_humanities",
    "capes_phys_tech_multidisc_sciences",
)
INDEX_COLUMNS = (
    "is_scielo",
    "is_scopus",
    "is_wos",
    "is_ahci",
    "is_esci",
    "is_scie",
    "is_ssci",
    "is_doaj",
    "is_lilacs",
    "is_redalyc",
    "is_medline",
    "is_pmc",
    "is_openalex",
    "is_qualis",
)
FLAG_COLUMNS = (*CAPES_COLUMNS, *INDEX_COLUMNS, "scielo_active_valid")
COMPARABLE_SHARES = {"domain": 0.0003, "field": 0.001, "subfield": 0.005, "topic": 0.02}
COMPARABLE_LEAST = 12


def with_metadata(journals: DataFrame, meta: DataFrame | None) -> DataFrame:
    """Journal rows with metadata of their journal and year; defaults where there is none. Without the key columns it is skipped.

    A task looks its journals up in a hash table of its part of the metadata (a row for each journal and year), so journals, which lie together by these
    but are many more, are not sorted.
    """
    keys = ["journal_id", "publication_year"]
    taken: list[str] = []
    if meta is not None and set(keys) <= set(meta.columns):
        taken = [c for c in (*TEXT_COLUMNS, *FLAG_COLUMNS) if c in meta.columns]
        journals = journals.join(meta.select(*keys, *taken).hint("shuffle_hash"), keys, "left")
    get = lambda c: F.col(c) if c in taken else F.lit(None).cast("string")
    columns = {"journal_title": F.coalesce(F.nullif(get("journal_title"), F.lit("")), F.col("journal_id"))}
    columns |= {c: F.coalesce(get(c), F.lit("")) for c in TEXT_COLUMNS[1:]}
    columns |= {c: F.coalesce(get(c).try_cast("double").cast("int"), F.lit(0)) for c in FLAG_COLUMNS}
    journals = journals.withColumns(columns)
    gate = (F.col("is_scielo") == 1) & (F.col("scielo_active_valid") == 1)
    return journals.withColumn("scielo_collection", F.when(gate, F.col("scielo_collection_acronym")).otherwise(""))


def output_columns(windows=C.WINDOWS, percentiles=C.PERCENTILES, yearly=()) -> list[str]:
    """The columns of the indicator table, in order."""
    ws = [f"_window_{w}y" for w in windows]
    every = ["", *ws]
    out = ["category_id", "category_level", "journal_id", "journal_issn", "journal_title", "journal_publisher", "journal_country", "scielo_collection", "scielo_thematic_areas", *CAPES_COLUMNS, *INDEX_COLUMNS, "is_journal_oa", "publication_year"]
    out += [f"category_citations_{kind}{w}" for kind in ("mean", "total") for w in every]
    out += [f"category_publications_{kind}" for kind in ("count", "mean", "median")]
    out += [f"citations{w}{end}" for end in ("", "_works") for w in ws]
    out += [*yearly, *(f"journal_citations_mean{w}" for w in every), "journal_citations_total"]
    out += [f"journal_impact_cohort{w}" for w in every]
    out += ["journal_publications_count", "is_journal_multilingual"]
    for p in percentiles:
        for w in [None, *windows]:
            base = N.threshold_name(p, w).removesuffix("citations_threshold")
            out += [base + end for end in ("citations_threshold", "publications_count", "publications_share_pct")]
    return out


def _needed(columns, windows, percentiles) -> set[str]:
    """The columns, and those that they are made of."""
    out = {*columns, *C.COHORT, "journal_id", "journal_publications_count"}
    for name, _, w in C.metrics(windows):
        if f"journal_impact_cohort{name}" in out:
            out |= {f"journal_citations_mean{name}", f"category_citations_mean{name}"}
        for p in percentiles:
            base = N.threshold_name(p, w).removesuffix("citations_threshold")
            if f"{base}publications_share_pct" in out:
                out.add(f"{base}publications_count")
            if f"{base}publications_count" in out:
                out.add(f"{base}citations_threshold")
    return out


def build_indicators(works: DataFrame, meta: DataFrame | None = None, levels=C.LEVELS, years=None, windows=C.WINDOWS, percentiles=C.PERCENTILES, threshold_mode: str = "exact", only=None, short_ids: bool = False, seen: Observation | None = None, columns=None) -> DataFrame:
    """A row for each level, category, year and journal, with the columns of ``output_columns``, or those of them that ``columns`` names.

    What is needed of ``works`` is written once, so that it is read once, however it is made. Cohorts are counts of equal works, their
    thresholds exact (``quantiles``). Thresholds go to the tasks if their measured size allows. Journals are one grouping of works that lie together by journal
    and year; they are written if their cohorts' statistics are asked for, which are made of their sizes. ``meta`` has a row for each journal and year. Cohorts and
    metadata of which no column is asked for are left out.
    ``seen`` has n_journals and n_issn_conflicts once the result has been read.
    """
    C.check_mode(threshold_mode)
    windows, percentiles = sorted(windows), sorted(percentiles, reverse=True)
    every = output_columns(windows, percentiles, C.yearly_columns(works))
    if columns is not None and not set(columns) <= set(every):
        raise ValueError(f"no such columns: {sorted(set(columns) - set(every))}")
    columns = every if columns is None else [c for c in every if c in columns]
    wanted = _needed(columns, windows, percentiles)
    languages = C.has_languages(works) and "is_journal_multilingual" in wanted
    C.check_levels(works, levels)
    needed = ["publication_year", "journal_id", *levels, *(c for c in C.yearly_columns(works) if c in wanted)]
    needed += ["is_journal_oa"] * ("is_journal_oa" in wanted) + ["journal_issn_l"] * ("journal_issn" in wanted or seen is not None) + ["is_merged", "oa_individual_works"] * languages
    for name, _, w in C.metrics(windows):
        own = {f"citations{name}", f"citations{name}_works", f"journal_citations_mean{name}", "journal_citations_total" if w is None else "", f"category_citations_mean{name}", f"category_citations_total{name}"}
        if wanted & (own | {N.threshold_name(p, w) for p in percentiles}):
            needed.append("citations_total" if w is None else f"citations_window_{w}y")
    slim = works.filter(F.col("publication_year").isin(*years)) if years is not None else works
    slim = written(slim.select(*needed))
    cohorts = None
    if any(c.startswith(("category_citations_", "category_publications_")) or c.endswith("_citations_threshold") for c in wanted):
        cohorts = cut(C.settled_cohorts(C.level_rows(slim, levels, None, only), windows, percentiles, threshold_mode, True, wanted))
    journals = C.journal_metrics(slim, cohorts if cohorts is None else C._small(cohorts), levels, None, only, windows, percentiles, languages, seen, wanted)
    if wanted & {"category_publications_mean", "category_publications_median"}:
        journals = written(journals)
        cohorts = cut(cohorts.join(C.publication_stats_bracketed(journals), C.COHORT))
    late = [] if cohorts is None else [c for c in cohorts.columns if c in columns or c.startswith("category_citations_mean")]
    if set(late) - set(C.COHORT):
        journals = journals.join(C._small(cohorts.select(*C.COHORT, *(c for c in late if c not in C.COHORT))), C.COHORT)
    derived = {}
    for name, _, w in C.metrics(windows):
        if f"journal_impact_cohort{name}" in wanted:
            derived[f"journal_impact_cohort{name}"] = ratio(F.col(f"journal_citations_mean{name}"), F.col(f"category_citations_mean{name}"))
        for p in percentiles:
            base = N.threshold_name(p, w).removesuffix("citations_threshold")
            if f"{base}publications_share_pct" in wanted:
                derived[f"{base}publications_share_pct"] = share_percent(F.col(f"{base}publications_count"), F.col("journal_publications_count"))
    described = {*TEXT_COLUMNS, *FLAG_COLUMNS, "scielo_collection"} & wanted
    out = with_metadata(journals.withColumns(derived), meta if described else None)
    if short_ids:
        out = out.withColumns({c: N.short_id(c) for c in ("journal_id", "category_id")})
    return conform(out, columns)


def conform(df: DataFrame, columns: list[str]) -> DataFrame:
    """The named columns in order; missing ones are ''."""
    return df.select(*[F.col(c) if c in df.columns else F.lit("").alias(c) for c in columns])


def comparability(indicators: DataFrame, least: int = COMPARABLE_LEAST, beta: float = 1.0) -> DataFrame:
    """Adds the publications that make a journal comparable in its cohort, and whether it has them."""
    share = F.create_map(*[F.lit(x) for pair in COMPARABLE_SHARES.items() for x in pair])[F.col("category_level")]
    need = F.greatest(F.lit(least).cast("long"), F.ceil(share * F.col("category_publications_count")), F.ceil(F.lit(beta) * F.col("category_publications_median")))
    return indicators.withColumn("min_publications", need).withColumn("is_comparable", F.when(F.col("journal_publications_count") >= F.col("min_publications"), 1).otherwise(0))


def write_csv(indicators: DataFrame, path: str, partition: bool = False) -> None:
    """CSV with headers in words; by level and year with ``partition``."""
    renamed = indicators.toDF(*[N.header(c) for c in indicators.columns])
    writer = renamed.write.option("header", True)
    (writer.partitionBy("category level", "publication year") if partition else writer).csv(path)
