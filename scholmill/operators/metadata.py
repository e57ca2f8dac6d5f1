"""Journal metadata: source columns, normalizing, and rows that contradict each other."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from scholmill.functions import normalize as N
from scholmill.operators.indicators import FLAG_COLUMNS, TEXT_COLUMNS


#: Names here, and in the source table.
SOURCE_NAMES = {
    "openalex_id": "OpenAlex ID",
    "journal_title": "Journal",
    "journal_publisher": "Publisher Name",
    "journal_country": "Country",
    "scielo_collection_acronym": "SciELO collection acronym",
    "scielo_thematic_areas": "SciELO Thematic Areas",
    "publication_year": "YEAR",
    "scielo_active_valid": "SciELO Active and Valid in the Year",
    "capes_life_sciences": "CAPES Life Sciences",
    "capes_humanities": "CAPES Humanities",
    "capes_phys_tech_multidisc_sciences": "CAPES Phys., Tech. Multidisc. Sciences",
    "is_scielo": "is SciELO",
    "is_scopus": "is Scopus",
    "is_redalyc": "is Redalyc",
    "is_openalex": "is OpenAlex",
    "is_qualis": "is Qualis",
    "capes_agricultural_sciences": "CAPES agricultural sciences",
    "capes_applied_social_sciences": "CAPES applied social sciences",
    "capes_biological_sciences": "CAPES biological sciences",
    "capes_engineering": "CAPES engineering",
    "capes_exact_and_earth_sciences": "CAPES exact and earth sciences",
    "capes_health_sciences": "CAPES health sciences",
    "capes_human_sciences": "CAPES human sciences",
    "capes_linguistics_letters_and_arts": "CAPES linguistics letters and arts",
    "capes_multidisciplinary": "CAPES multidisciplinary",
    "is_wos": "is WOS",
    "is_ahci": "is AHCI",
    "is_esci": "is ESCI",
    "is_scie": "is SCIE",
    "is_ssci": "is SSCI",
    "is_doaj": "is DOAJ",
    "is_lilacs": "is LILACS",
    "is_medline": "is MEDLINE",
    "is_pmc": "is PMC",
}


def journal_metadata(raw: DataFrame) -> DataFrame | None:
    """Normalized metadata of a source table, one row for each journal and year; None, with a warning that names them, if columns are missing."""
    if missing := sorted(set(SOURCE_NAMES.values()) - set(raw.columns)):
        warnings.warn(f"journal metadata is left out, columns are missing: {', '.join(missing)}", stacklevel=2)
        return None
    named = raw.select(*[F.col(f"`{source}`").alias(name) for name, source in SOURCE_NAMES.items()])
    return resolve_conflicts(normalize(named))


def normalize(meta: DataFrame) -> DataFrame:
    """journal_id for openalex_id, numeric years, stripped texts, flags of 0 and 1; rows without id or year go. Other columns go too."""
    kinds = dict(meta.dtypes)
    columns = [N.journal_id("openalex_id").alias("journal_id"), F.floor(F.expr("try_cast(publication_year AS double)")).cast("int").alias("publication_year")]
    columns += [N.text(c).alias(c) for c in TEXT_COLUMNS if c in kinds]
    columns += [N.flag(c, kinds[c]).alias(c) for c in FLAG_COLUMNS if c in kinds]
    return meta.select(*columns).filter("journal_id IS NOT NULL AND publication_year IS NOT NULL")


def _judged(meta: DataFrame, keys: list[str]) -> DataFrame:
    rest = [c for c in meta.columns if c not in keys]
    row = F.struct(*rest)
    return meta.groupBy(*keys).agg(F.count("*").alias("n_rows"), F.count_distinct(row).alias("n_kinds"), F.first(row).alias("row"))


_KINDS = (("n_unique", "n_rows = 1"), ("n_identical", "n_rows > 1 AND n_kinds = 1"), ("n_conflicts", "n_kinds > 1"))


def resolve_conflicts(meta: DataFrame, keys: tuple[str, ...] = ("journal_id", "publication_year"), seen: Observation | None = None) -> DataFrame:
    """One row for each key; keys whose rows differ are dropped altogether. ``seen`` has the counts of ``conflict_stats`` once the rows have been read."""
    judged = _judged(meta, list(keys))
    if seen is not None:
        judged = judged.observe(seen, *(F.count_if(F.expr(which)).alias(name) for name, which in _KINDS))
    return judged.filter("n_kinds = 1").select(*keys, "row.*").select(meta.columns)


def conflict_stats(meta: DataFrame, keys: tuple[str, ...] = ("journal_id", "publication_year")) -> DataFrame:
    """Numbers of keys that are unique, have identical duplicates, or contradict each other."""
    return _judged(meta, list(keys)).agg(*(F.count_if(F.expr(which)).alias(name) for name, which in _KINDS))
