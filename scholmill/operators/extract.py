"""From raw works to flat works: filters, projection, citation windows, and the newest version of each work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

WINDOWS = (2, 3, 5)


def _at(values: Column, place: Column) -> Column:
    """The value at a place from 1 of ``array_position``, else null."""
    return F.get(values, (place - 1).cast("int"))


def _journal() -> Column:
    """The primary source if it is a journal, else the first journal among the locations."""
    primary, others = F.col("primary_location.source"), F.col("locations.source")
    return F.coalesce(F.when(primary["type"] == "journal", primary), _at(others, F.array_position(others["type"], "journal")))


def _well_formed(windows=WINDOWS) -> Column:
    """Whether what is read of a row is there: a topic has all of its parts, and no window holds a count without number."""
    topic = F.col("primary_topic")
    whole = topic.isNull() | (topic["domain"].isNotNull() & topic["field"].isNotNull() & topic["subfield"].isNotNull())
    listed = F.col("primary_location.source.type").eqNullSafe(F.lit("journal")) | F.col("locations").isNotNull()
    late = F.exists(F.coalesce("counts_by_year", F.array().cast("array<struct<year: int, cited_by_count: long>>")), lambda c: (c["year"] > F.col("publication_year")) & (c["year"] <= F.col("publication_year") + max(windows, default=0)) & c["cited_by_count"].isNull())
    return whole & listed & ~late


def _wanted(raw: DataFrame, start_year: int, end_year: int) -> DataFrame:
    return raw.filter((F.col("type") == "article") & ~F.coalesce("is_xpac", F.lit(False)) & F.col("publication_year").between(start_year, end_year) & (F.col("publication_year") != 0))


def accepted(raw: DataFrame, start_year: int, end_year: int, windows=WINDOWS) -> DataFrame:
    """Articles of the years, not expanded, with a journal (column ``journal``), and well formed."""
    return _wanted(raw, start_year, end_year).filter(_well_formed(windows)).withColumn("journal", _journal()).filter(F.col("journal").isNotNull())


def dropped(raw: DataFrame, start_year: int, end_year: int, windows=WINDOWS) -> DataFrame:
    """One row: lines that hold no work at all (n_unread), and articles of the years that are dropped as malformed (n_malformed) or have no journal (n_no_journal)."""
    wanted = _wanted(raw, start_year, end_year).agg(F.count_if(~_well_formed(windows)).alias("n_malformed"), F.count_if(_well_formed(windows) & _journal().isNull()).alias("n_no_journal"))
    return raw.agg(F.count_if(F.col("id").isNull() & F.col("type").isNull()).alias("n_unread")).crossJoin(wanted)  # one row each


def observed(raw: DataFrame, start_year: int, end_year: int, seen: Observation, windows=WINDOWS) -> DataFrame:
    """``raw``, whose counts ``seen`` has once it has been read: n_lines, and what ``dropped`` counts. No pass of its own."""
    wanted = (F.col("type") == "article") & ~F.coalesce("is_xpac", F.lit(False)) & F.col("publication_year").between(start_year, end_year) & (F.col("publication_year") != 0)
    return raw.observe(
        seen, F.count("*").alias("n_lines"), F.count_if(F.col("id").isNull() & F.col("type").isNull()).alias("n_unread"),
        F.count_if(wanted & ~_well_formed(windows)).alias("n_malformed"), F.count_if(wanted & _well_formed(windows) & _journal().isNull()).alias("n_no_journal"),
    )


def citation_years(raw: DataFrame) -> list[int]:
    """The years that counts are given for (a small job of its own; pass a list to ``extract_works`` to save it)."""
    years = raw.select(F.explode("counts_by_year.year").alias("y")).filter("y IS NOT NULL AND y <> 0").distinct()
    return sorted(r[0] for r in years.collect())


def _of_year(years: Column, counts: Column, year: int) -> Column:
    """Of several counts for a year the last one holds; both arrays are backwards."""
    return _at(counts, F.array_position(years, F.lit(year)))


def _in_windows(windows) -> Column:
    """A struct with the sum of each window, by one pass over the counts."""
    zero = F.lit(0).cast("long")

    def add(a, c):
        inside = lambda w: (c["year"] != 0) & (c["year"] > F.col("publication_year")) & (c["year"] <= F.col("publication_year") + w)
        return F.struct(*[(a[f"w{w}"] + F.when(inside(w), c["cited_by_count"]).otherwise(zero)).alias(f"w{w}") for w in windows])

    none = F.array().cast("array<struct<year: int, cited_by_count: long>>")
    return F.aggregate(F.coalesce("counts_by_year", none), F.struct(*[zero.alias(f"w{w}") for w in windows]), add)


def project(rows: DataFrame, years: list[int], windows=WINDOWS, keep: tuple[str, ...] = ()) -> DataFrame:
    """Flat works: ids, journal, taxonomy, citations by year and by window after the publication year."""
    # functions of arrays are compiled, those with lambdas are interpreted for each element: one of the latter for all windows, none for the years
    late, counts = F.reverse("counts_by_year.year"), F.reverse("counts_by_year.cited_by_count")
    out = [
        F.col("id").alias("work_id"), "publication_year", "language", "doi", F.col("journal.id").alias("journal_id"), F.col("journal.issn_l").alias("journal_issn_l"),
        F.coalesce(F.col("journal.is_oa").cast("int"), F.lit(0)).alias("is_journal_oa"),
        *(F.col(f"primary_topic.{v}.display_name").alias(v) for v in ("domain", "field", "subfield")),
        F.col("primary_topic.display_name").alias("topic"), F.col("primary_topic.score").alias("topic_score"),
        F.coalesce("cited_by_count", F.lit(0).cast("long")).alias("citations_total"),
    ]
    out += [(_of_year(late, counts, y) if y else F.lit(None).cast("long")).alias(f"citations_{y}") for y in years]
    if windows:
        rows = rows.withColumn("_windows", _in_windows(windows))
    out += [F.col(f"_windows.w{w}").alias(f"citations_window_{w}y") for w in windows]
    flat = rows.select(*out, *keep)
    return flat.withColumns({f"has_citation_window_{w}y": F.when(F.col(f"citations_window_{w}y") > 0, 1).otherwise(0) for w in windows})


def latest(works: DataFrame, newest: str = "updated_date", order: tuple[str, ...] = ("file_path", "line_no")) -> DataFrame:
    """One row for each work_id: of the newest date, there the first in ``order`` (file, then line)."""
    w = Window.partitionBy("work_id").orderBy(F.desc(newest), *order)
    return works.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def not_yet(works: DataFrame, done: DataFrame) -> DataFrame:
    """Works that ``done`` has neither the id nor the date of."""
    dates = done.select("updated_date").distinct()
    return works.join(F.broadcast(dates), "updated_date", "left_anti").join(done.select("work_id").distinct(), "work_id", "left_anti")  # dates: a few a month


def extract_works(raw: DataFrame, start_year: int, end_year: int, years: list[int] | None = None, windows=WINDOWS, known: DataFrame | None = None, newest: str = "updated_date", order: tuple[str, ...] = ("file_path", "line_no")) -> DataFrame:
    """Flat works of raw works, the newest accepted version of each; without those of ``known``."""
    if years is None:
        years = citation_years(raw)
    works = project(accepted(raw, start_year, end_year, windows), years, windows, keep=(newest, *order))
    if known is not None:
        works = not_yet(works, known)
    return latest(works, newest, order)
