"""Cohorts: all works of one year in one category of one level of the taxonomy.

Every function covers all cohorts in one job. A work is exploded into a row for each level, the cohort aggregate is a grouping of these
rows, and the cohort row, which is small (years x categories), meets the works again by a join that adaptive execution broadcasts
where its measured size allows.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from scholmill.functions import normalize as N
from scholmill.operators import quantiles as Q
from scholmill.operators.durable import cut

LEVELS = ("domain", "field", "subfield", "topic")
COHORT = ["category_level", "category_id", "publication_year"]
PERCENTILES = (99, 95, 90, 50)
WINDOWS = (2, 3, 5)
_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def check_levels(works: DataFrame, levels) -> list[str]:
    """The levels, if each is a plain name of a column."""
    for level in levels:
        if not _NAME.match(level) or level not in works.columns:
            raise ValueError(f"no such category level: {level!r}")
    return list(levels)


def yearly_columns(df: DataFrame) -> list[str]:
    """Columns citations_<year>, by year."""
    return sorted(c for c in df.columns if re.fullmatch(r"citations_\d{4}", c))


def metrics(windows) -> list[tuple[str, Column, int | None]]:
    """(name in results, citations, window) of the whole time and of each window."""
    return [("", F.col("citations_total"), None)] + [(f"_window_{w}y", F.col(f"citations_window_{w}y"), w) for w in windows]


def cohort_rows(works: DataFrame, levels=LEVELS, years=None, categories=None) -> DataFrame:
    """A row for each work and level: category_level, category_id, and the work's columns. Filters reach the scan."""
    levels = check_levels(works, levels)
    if years is not None:
        works = works.filter(F.col("publication_year").isin(*years))
    # one Expand of the scan: a row for each level is made where it is aggregated
    rows = works.unpivot([c for c in works.columns if c not in LEVELS], levels, "category_level", "category_id")
    rows = rows.filter(F.col("category_id").isNotNull() & F.col("publication_year").isNotNull())
    return rows if categories is None else rows.filter(F.col("category_id").isin(*categories))


def level_rows(works: DataFrame, levels=LEVELS, years=None, categories=None) -> list[DataFrame]:
    """``cohort_rows``, a table for each level, for works that are written.

    A grouping of one level reads only its column, and the level is no part of its keys; that takes less than a grouping of rows of all levels, though works are read for each level.
    """
    levels = check_levels(works, levels)
    if years is not None:
        works = works.filter(F.col("publication_year").isin(*years))
    kept = [c for c in works.columns if c not in LEVELS]
    found = [works.select(*kept, F.lit(v).alias("category_level"), F.col(v).alias("category_id")).filter("category_id IS NOT NULL AND publication_year IS NOT NULL") for v in levels]
    return found if categories is None else [rows.filter(F.col("category_id").isin(*categories)) for rows in found]


def journal_rows(works: DataFrame, levels=LEVELS, years=None, categories=None) -> DataFrame:
    """``cohort_rows`` of works with a journal, all works of a journal and year in one task.

    A grouping by cohort and journal needs no further exchange then: a work moves once, not once for each level. Rows are made by a generator, as
    an Expand would forget where they lie.
    """
    levels = check_levels(works, levels)
    if years is not None:
        works = works.filter(F.col("publication_year").isin(*years))
    works = works.filter("journal_id IS NOT NULL AND publication_year IS NOT NULL").repartition("journal_id", "publication_year")
    named = F.array(*(F.struct(F.lit(v).alias("category_level"), F.col(v).alias("category_id")) for v in levels))
    rows = works.select(*(c for c in works.columns if c not in LEVELS), F.inline(named)).filter("category_id IS NOT NULL")
    return rows if categories is None else rows.filter(F.col("category_id").isin(*categories))


def categories(works: DataFrame, levels=LEVELS, years=None, only=None) -> DataFrame:
    """Distinct categories by level and year."""
    return cohort_rows(works, levels, years, only).select(*COHORT).distinct()


def _baseline(windows) -> list[Column]:
    out = [F.count("*").alias("category_publications_count")]
    for name, x, _ in metrics(windows):
        filled = F.coalesce(x, F.lit(0))
        out += [F.sum(filled).cast("long").alias(f"category_citations_total{name}"), F.avg(filled).alias(f"category_citations_mean{name}")]
    return out


def _thresholds(windows, percentiles, mode: str) -> list[Column]:
    out = []
    for _, x, w in metrics(windows):
        for p in percentiles:
            exact = F.expr(f"percentile_disc({p / 100}) WITHIN GROUP (ORDER BY coalesce({'citations_total' if w is None else f'citations_window_{w}y'}, 0))").cast("long")
            out.append((exact + (1 if mode == "floor_plus_one" else 0)).alias(N.threshold_name(p, w)))
    return out


def check_mode(mode: str) -> None:
    if mode not in ("exact", "floor_plus_one"):
        raise ValueError(f"threshold_mode must be exact or floor_plus_one: {mode!r}")


def cohort_baseline(works: DataFrame, levels=LEVELS, years=None, windows=WINDOWS, only=None) -> DataFrame:
    """Publications and citations of each cohort; null citations count as 0."""
    return cohort_rows(works, levels, years, only).groupBy(*COHORT).agg(*_baseline(windows))


def cohort_thresholds(works: DataFrame, levels=LEVELS, years=None, windows=WINDOWS, percentiles=PERCENTILES, threshold_mode: str = "exact", only=None) -> DataFrame:
    """Exact discrete percentiles of each cohort: the smallest value that a share of p works do not exceed."""
    check_mode(threshold_mode)
    return cohort_rows(works, levels, years, only).groupBy(*COHORT).agg(*_thresholds(windows, percentiles, threshold_mode))


def cohort_thresholds_histogram(works: DataFrame, levels=LEVELS, years=None, windows=WINDOWS, percentiles=PERCENTILES, threshold_mode: str = "exact") -> DataFrame:
    """The same values from histograms of citation counts, for cohorts too large to hold their values in one buffer.

    Works are counted by value on the map side, so that what is shuffled and ordered is distinct values.
    """
    check_mode(threshold_mode)
    names = [name for name, _, _ in metrics(windows)]
    stacked = F.array(*[F.struct(F.lit(name).alias("metric"), F.coalesce(x, F.lit(0)).cast("long").alias("value")) for name, x, _ in metrics(windows)])
    counts = cohort_rows(works, levels, years).select(*COHORT, F.explode(stacked).alias("m")).groupBy(*COHORT, "m.metric", "m.value").agg(F.count("*").alias("n"))
    lists = counts.groupBy(*COHORT, "metric").agg(F.array_sort(F.collect_list(F.struct("value", "n"))).alias("bars"), F.sum("n").alias("total"))
    found = []
    for p in percentiles:
        need = f"ceil(cast({p} AS decimal(20,0)) * total / 100)"
        at = f"aggregate(bars, struct(0L AS seen, cast(NULL AS bigint) AS at), (a, b) -> struct(a.seen + b.n AS seen, coalesce(a.at, CASE WHEN a.seen + b.n >= {need} THEN b.value END) AS at), a -> a.at)"
        found.append((F.expr(at) + (1 if threshold_mode == "floor_plus_one" else 0)).alias(f"p{p}"))
    wide = lists.select(*COHORT, "metric", *found).groupBy(*COHORT).pivot("metric", names).agg(*[F.first(f"p{p}").alias(f"p{p}") for p in percentiles])
    picked = []
    for name, _, w in metrics(windows):
        for p in percentiles:
            column = f"{name}_p{p}" if len(percentiles) > 1 else name
            picked.append(F.col(f"`{column}`").alias(N.threshold_name(p, w)))
    return wide.select(*COHORT, *picked)


def _ranks(windows, percentiles) -> list[Q.Rank]:
    return [Q.percentile(N.threshold_name(p, w), "citations_total" if w is None else f"citations_window_{w}y", p) for _, _, w in metrics(windows) for p in percentiles]


def _grouped(parts: list[DataFrame], keys: list, *found: Column) -> DataFrame:
    """Each of ``parts``, of which no two share a group, grouped alone."""
    return reduce(DataFrame.unionByName, [rows.groupBy(*keys).agg(*found) for rows in parts])


def settled_cohorts(rows: DataFrame | list[DataFrame], windows=WINDOWS, percentiles=PERCENTILES, threshold_mode: str = "exact", baseline: bool = False, wanted=None) -> DataFrame:
    """Cohorts of ``cohort_rows`` or ``level_rows`` with the exact thresholds and, if asked for, what ``cohort_baseline`` has; no task holds a cohort's values.

    Rows are read once: they are counted by cohort and the values of their metrics, and the rest is made of these counts; without thresholds they
    are summed by cohort at once. ``wanted`` are the names of the columns to be made (None: all).
    """
    parts = rows if isinstance(rows, list) else [rows]
    check_mode(threshold_mode)
    asked = lambda c: wanted is None or c in wanted
    ranks = [r for r in _ranks(windows, percentiles) if asked(r.name)]
    columns = {name: "citations_total" if w is None else f"citations_window_{w}y" for name, _, w in metrics(windows)}
    totals = [name for name in columns if baseline and (asked(f"category_citations_total{name}") or asked(f"category_citations_mean{name}"))]
    used = [c for name, c in columns.items() if name in totals or any(r.column == c for r in ranks)]
    values = {c: F.coalesce(F.col(c), F.lit(0)).cast("long") for c in used}
    if ranks:
        counted = cut(_grouped(parts, [*COHORT, *(x.alias(c) for c, x in values.items())], F.count("*").alias("n_rows")))
        sums = [F.sum(F.col(columns[name]) * F.col("n_rows")).alias(f"category_citations_total{name}") for name in totals]
        out = Q.settle(cut(counted.groupBy(*COHORT).agg(F.sum("n_rows").alias("n"), *sums)), counted, COHORT, ranks, "n_rows")
    else:
        out = _grouped(parts, COHORT, F.count("*").alias("n"), *(F.sum(values[columns[name]]).alias(f"category_citations_total{name}") for name in totals))
    if baseline:
        out = out.withColumns({"category_publications_count": F.col("n")} | {f"category_citations_mean{name}": F.col(f"category_citations_total{name}") / F.col("n") for name in totals})
    out = out.drop("n")
    return out if threshold_mode == "exact" else out.withColumns({r.name: F.col(r.name) + 1 for r in ranks})


def cohort_thresholds_bracketed(works: DataFrame, levels=LEVELS, years=None, windows=WINDOWS, percentiles=PERCENTILES, threshold_mode: str = "exact", only=None) -> DataFrame:
    """The values of ``cohort_thresholds`` by bracketed selection (``quantiles``), for cohorts of any size."""
    return settled_cohorts(cohort_rows(works, levels, years, only), windows, percentiles, threshold_mode)


#: Bytes of thresholds that are sent to every task; more meet the rows by a shuffle.
BROADCAST = 64 << 20


def _small(cohorts: DataFrame) -> DataFrame:
    """``cohorts``, to be broadcast if its rows, counted, are small enough."""
    width = sum(8 if kind in ("bigint", "double", "int") else 64 for _, kind in cohorts.dtypes)
    return F.broadcast(cohorts) if cohorts.count() * width <= BROADCAST else cohorts


def _issn_codes(works: DataFrame) -> DataFrame:
    """Numbers of all ISSNs, in their order: the smallest text of a group would make its aggregation sort all rows, a number doesn't."""
    issns = works.select(F.col("journal_issn_l").alias("journal_issn")).filter("journal_issn IS NOT NULL").distinct()
    return _small(cut(issns.orderBy("journal_issn").withColumn("_issn", F.monotonically_increasing_id())))


def journal_metrics(works: DataFrame, cohorts: DataFrame | None, levels=LEVELS, years=None, only=None, windows=WINDOWS, percentiles=PERCENTILES, with_languages: bool = False, seen: Observation | None = None, wanted=None) -> DataFrame:
    """Per cohort and journal: totals, means, cited works, yearly sums, works at or above each threshold, flags.

    cohorts: rows with the thresholds; None if nothing is asked for that needs them. Works without journal have no row; null citations never reach a threshold. ``works`` is read twice.
    ``seen`` has n_journals and n_issn_conflicts (those of several ISSNs in their cohort) once the result has been read. ``wanted`` are the names of
    the columns to be made (None: all).
    """
    asked = lambda c: wanted is None or c in wanted
    keys = [*COHORT, "journal_id"]
    out, means, names = {}, {}, []
    for name, x, w in metrics(windows):
        total = "journal_citations_total" if w is None else f"citations{name}"
        mean = f"journal_citations_mean{name}"
        if asked(total) or asked(mean):
            out[total] = F.sum(F.coalesce(x, F.lit(0))).cast("long")
        if asked(mean):
            means[mean] = F.col(total) / F.col("journal_publications_count")
        if w is not None and asked(f"citations{name}_works"):
            out[f"citations{name}_works"] = F.count_if(x >= 1)
        for p in percentiles:
            least = N.threshold_name(p, w)
            reached = least.replace("_citations_threshold", "_publications_count")
            if asked(reached):
                names.append(least)
                out[reached] = F.count_if(x >= F.col(least))
    out |= {c: F.sum(F.coalesce(F.col(c), F.lit(0))).cast("long") for c in yearly_columns(works) if asked(c)}
    if asked("is_journal_oa"):
        out["is_journal_oa"] = F.coalesce(F.max(F.col("is_journal_oa").cast("int")), F.lit(0))
    if asked("is_journal_multilingual"):
        if with_languages:
            works = works.withColumn("_multilingual", N.multilingual("is_merged", "oa_individual_works"))
        out["is_journal_multilingual"] = F.max(F.col("_multilingual") if with_languages else F.lit(0))
    codes = _issn_codes(works) if asked("journal_issn") or seen is not None else None
    if codes is not None:
        works = works.join(codes.withColumnRenamed("journal_issn", "journal_issn_l"), "journal_issn_l", "left")
        out |= {"_issn": F.min("_issn"), "_last_issn": F.max("_issn")}
    works = works.drop("journal_issn_l", "is_merged", "oa_individual_works")
    rows = journal_rows(works, levels, years, only)
    if names:
        rows = rows.join(cohorts.select(*COHORT, *names), COHORT)
    journals = rows.groupBy(*keys).agg(F.count("*").alias("journal_publications_count"), *(c.alias(name) for name, c in out.items())).withColumns(means)
    if seen is not None:
        journals = journals.observe(seen, F.count("*").alias("n_journals"), F.count_if(F.col("_last_issn") > F.col("_issn")).alias("n_issn_conflicts"))
    return journals if codes is None else journals.join(codes, "_issn", "left").drop("_issn", "_last_issn")


def has_languages(works: DataFrame) -> bool:
    return {"is_merged", "oa_individual_works"} <= set(works.columns)


def _sizes(journals: DataFrame) -> DataFrame:
    """Journals of each cohort counted by their publications: as many rows as the root of twice a cohort's works at most."""
    return journals.groupBy(*COHORT, "journal_publications_count").agg(F.count("*").alias("n_journals"))


def _mean_size() -> Column:
    return (F.sum(F.col("journal_publications_count") * F.col("n_journals")) / F.sum("n_journals")).alias("category_publications_mean")


def publication_stats(journals: DataFrame) -> DataFrame:
    """Mean and interpolated median of the journals' publication counts, by cohort."""
    return _sizes(journals).groupBy(*COHORT).agg(_mean_size(), F.percentile("journal_publications_count", 0.5, F.col("n_journals")).alias("category_publications_median"))


def publication_stats_bracketed(journals: DataFrame) -> DataFrame:
    """``publication_stats`` without a buffer of a cohort's counts: the median is the mean of the two middle ones. ``journals`` is read once."""
    sizes = cut(_sizes(journals))
    groups = sizes.groupBy(*COHORT).agg(_mean_size(), F.sum("n_journals").alias("n"))
    out = Q.settle(groups, sizes, COHORT, Q.middle("journal_publications_count"), "n_journals")
    return out.select(*COHORT, "category_publications_mean", ((F.col("_low") + F.col("_high")) / 2).alias("category_publications_median"))


def journal_sizes(works: DataFrame, levels=LEVELS, years=None) -> DataFrame:
    """Publications of each journal, by cohort."""
    return journal_rows(works.select("journal_id", "publication_year", *levels), levels, years).groupBy(*COHORT, "journal_id").agg(F.count("*").alias("journal_publications_count"))


def issn_conflicts(works: DataFrame, levels=LEVELS, years=None) -> DataFrame:
    """Journals with several ISSNs in one cohort."""
    rows = cohort_rows(works, levels, years).filter(F.col("journal_id").isNotNull())
    return rows.groupBy(*COHORT, "journal_id").agg(F.count_distinct("journal_issn_l").alias("n_issns")).filter("n_issns > 1")


def journal_multilingual(works: DataFrame, levels=LEVELS, years=None) -> DataFrame:
    """1 for journals with a merged record in several languages, by cohort."""
    flag = N.multilingual("is_merged", "oa_individual_works") if has_languages(works) else F.lit(0)
    rows = journal_rows(works.select("journal_id", "publication_year", *levels, flag.alias("_multilingual")), levels, years)
    return rows.groupBy(*COHORT, "journal_id").agg(F.max("_multilingual").alias("is_journal_multilingual"))
