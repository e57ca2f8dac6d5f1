"""Normalizing expressions: columns in, columns out, all built in but ``title_key``."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ID_PREFIX = "https://openalex.org/"
#: Texts that count as a set flag.
TRUE_TEXTS = ("1", "true", "t", "yes", "y", "sim", "s")
#: All white space of Unicode.
_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x: Column | str) -> Column:
    """Without white space at the ends; null stays null."""
    return F.trim(_col(x), F.lit(_SPACE))


def text(x: Column | str) -> Column:
    """Stripped text; null gives ''."""
    return F.coalesce(strip(_col(x).cast("string")), F.lit(""))


def doi(x: Column | str) -> Column:
    """Lower-case DOI without resolver prefixes, wherever they stand; nothing gives ''."""
    out = F.lower(F.coalesce(_col(x).cast("string"), F.lit("")))
    for prefix in ("https://doi.org/", "http://doi.org/", "doi:"):
        out = F.replace(out, F.lit(prefix), F.lit(""))
    return strip(out)


#: Texts that are Python objects at a time.
_TEXTS = 64


@F.arrow_udf(T.StringType())
def _folded(x: pa.Array) -> pa.Array:
    def one(s: str) -> str:
        return "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c)).replace(" ", "").lower().strip()

    # a batch has 10,000 whole texts: all of them as objects, before and after, are many times its size
    done = [pa.array([None if s is None else one(s) for s in x.slice(k, _TEXTS).to_pylist()], pa.string()) for k in range(0, len(x), _TEXTS)]
    return pa.concat_arrays(done) if done else pa.array([], pa.string())


def title_key(x: Column | str) -> Column:
    """Accents, compatibility forms, spaces and case folded; null gives ''. The only one in Python: Spark has no NFKD.

    Pure ASCII titles, the most frequent, stay in the JVM.
    """
    t = _col(x)
    plain = strip(F.lower(F.replace(t, F.lit(" "), F.lit(""))))
    return F.when(t.isNull(), "").when(F.octet_length(t) == F.length(t), plain).otherwise(_folded(t))


def year(x: Column | str) -> Column:
    """Whole number of a stripped text, else null; no range."""
    s = strip(_col(x).cast("string"))
    return F.when(s.rlike(r"^[+-]?[0-9]+$"), s.try_cast("int"))


def flag(x: Column | str, kind: str = "string") -> Column:
    """0 or 1; kind: the column's type. Numbers other than 0 are set, texts only if listed."""
    c = _col(x)
    if kind == "boolean":
        return F.coalesce(c.cast("int"), F.lit(0))
    if kind == "string":
        return F.when(F.lower(text(c)).isin(*TRUE_TEXTS), 1).otherwise(0)
    if kind in ("double", "float"):
        return F.when(c.isNotNull() & ~F.isnan(c) & (c != 0), 1).otherwise(0)
    return F.when(c.isNotNull() & (c != 0), 1).otherwise(0)


def count(x: Column | str) -> Column:
    """Whole number; null gives 0."""
    return F.coalesce(_col(x).cast("long"), F.lit(0).cast("long"))


def journal_id(x: Column | str, prefix: str = ID_PREFIX) -> Column:
    """Full id of a journal; blank gives null, ids of other forms stay."""
    s = strip(_col(x).cast("string"))
    return F.when(s == "", None).when(s.startswith(prefix), s).when(s.startswith("S"), F.concat(F.lit(prefix), s)).otherwise(s)


def short_id(x: Column | str, prefix: str = ID_PREFIX) -> Column:
    s = strip(x)
    return F.when(s.startswith(prefix), F.substring(s, len(prefix) + 1, 2**30)).otherwise(s)


def merged_languages(x: Column | str) -> Column:
    """Sorted distinct languages of the members of a JSON object; members that are no objects and invalid JSON give none."""
    # one parse of the text: the object as a variant, its members by their paths
    members = F.map_values(F.try_variant_get(F.try_parse_json(_col(x)), "$", "map<string,variant>"))
    languages = F.transform(members, lambda m: F.lower(strip(F.try_variant_get(m, "$.language", "string"))))
    return F.coalesce(F.array_sort(F.array_distinct(F.filter(languages, lambda v: v.isNotNull() & (v != "")))), F.array().cast("array<string>"))


def multilingual(is_merged: Column | str, works: Column | str) -> Column:
    """1 for a merged record in more than one language."""
    return F.when(F.coalesce(_col(is_merged).cast("boolean"), F.lit(False)) & (F.size(merged_languages(works)) > 1), 1).otherwise(0)


# ---- names of columns


def header(name: str) -> str:
    return name.replace("_", " ")


def top(percentile: int) -> int:
    """The top share that a percentile bounds."""
    return 100 - percentile


def threshold_name(percentile: int, window: int | None = None) -> str:
    return f"top_{top(percentile)}pct_" + (f"window_{window}y" if window else "all_time") + "_citations_threshold"


def percent_list(values: str) -> list[int]:
    """Percentiles of a comma-separated list, the highest first."""
    return sorted({int(v) for v in values.split(",") if v.strip()}, reverse=True)
