"""Article records to docs, and resolution of the docs that describe one article.

Two docs are one article if they share a key of an enabled rule. A rule's key holds all that the pair must share, so docs are grouped
by key and never compared in pairs: each is linked to the smallest doc of its key, and articles are the components of these links.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholmill.functions import normalize as N
from scholmill.operators.components import components
from scholmill.operators.durable import cut

RULES = ("doi", "pid", "title")
#: Normalized titles that many articles have, and the least length of a title that tells articles apart.
GENERIC_TITLES = ("editorial", "errata", "introduction", "introduccion", "introducao", "prefacio", "preface", "lettertoeditor", "cartaoeditor", "comentario", "commentary")
TITLE_LENGTH = 15


def article_docs(records: DataFrame, start_year: int, end_year: int) -> DataFrame:
    """Docs of the records of the years that have a DOI; doc_idx is that of the records, or the order in which they are scanned."""
    rows = records.withColumn("publication_year", N.year("publication_year")).filter(F.col("publication_year").between(start_year, end_year))
    rows = rows.filter((F.size(F.coalesce("doi_and_lang", F.array().cast("array<struct<lang: string, doi: string>>"))) > 0) | (F.coalesce("doi", F.lit("")) != ""))
    pairs = F.filter(F.transform(F.coalesce("doi_and_lang", F.array().cast("array<struct<lang: string, doi: string>>")), lambda p: F.struct(p["lang"].alias("lang"), N.doi(p["doi"]).alias("doi"))), lambda p: (p["doi"] != "") & p["lang"].isNotNull())
    langs = F.array_distinct(F.transform("_pairs", lambda p: p["lang"]))
    last = F.transform(langs, lambda g: F.element_at(F.filter("_pairs", lambda p: p["lang"] == g), -1)["doi"])  # of a language's DOIs the last holds
    rows = rows.withColumn("_pairs", pairs)
    names = F.concat(F.array("original_title"), F.coalesce(F.map_values("translated_titles"), F.array().cast("array<string>")))
    names = F.filter(names, lambda t: t.isNotNull() & (t != ""))
    issns = F.array(*[F.col(f"journal.{k}") for k in ("any_issn", "scielo_issn", "electronic_issn", "print_issn")])
    issns = F.transform(F.filter(issns, lambda x: x.isNotNull() & (x != "")), N.strip)
    rows = rows.select(
        F.col("collection_acronym").alias("collection"), F.col("publisher_id").alias("pid_v2"), "publication_year",
        F.map_from_arrays(langs, last).alias("doi_with_lang"), N.doi("doi").alias("doi"), names.alias("_titles"),
        N.text("document_type").alias("document_type"), N.text("journal.title").alias("journal_title"), F.array_sort(F.array_distinct(issns)).alias("journal_issns"),
        F.col("doc_idx") if "doc_idx" in records.columns else F.monotonically_increasing_id().alias("doc_idx"),
    )
    return with_title_keys(rows, "_titles").withColumnRenamed("_titles", "titles")


def with_title_keys(docs: DataFrame, titles: str) -> DataFrame:
    """The array of titles as a sorted set of title keys; one row a title, so that the fold sees single texts."""
    single = docs.select("doc_idx", F.explode(titles).alias("t")).select("doc_idx", N.title_key("t").alias("t"))
    keys = single.groupBy("doc_idx").agg(F.array_sort(F.collect_set("t")).alias("_keys"))
    return docs.join(keys, "doc_idx", "left").withColumn(titles, F.coalesce("_keys", F.array().cast("array<string>"))).drop("_keys")


def _dois() -> Column:
    return F.array_distinct(F.filter(F.concat(F.array("doi"), F.coalesce(F.map_values("doi_with_lang"), F.array().cast("array<string>"))), lambda d: d.isNotNull() & (d != "")))


def _journals(docs: DataFrame) -> DataFrame:
    """A row for each name that a doc's journal has: ISSNs, and the title if there is one."""
    issns = F.transform(F.coalesce("journal_issns", F.array().cast("array<string>")), lambda x: F.concat(F.lit("issn "), x))
    title = F.when(F.coalesce("journal_title", F.lit("")) != "", F.array(F.concat(F.lit("title "), F.col("journal_title")))).otherwise(F.array().cast("array<string>"))
    return docs.withColumn("journal", F.explode(F.array_distinct(F.concat(issns, title))))


def rule_keys(docs: DataFrame, rule: str) -> DataFrame:
    """(doc_idx, key) of a rule; null years are equal."""
    slim = docs.select("doc_idx", "doi", "doi_with_lang", "pid_v2", "publication_year", "journal_title", "journal_issns", F.coalesce("titles", F.array().cast("array<string>")).alias("titles"))
    year = F.coalesce(F.col("publication_year").cast("string"), F.lit("none"))
    if rule == "doi":
        rows = slim.withColumn("d", F.explode(_dois())).withColumn("t", F.explode("titles"))
        key = F.struct(F.lit("doi").alias("rule"), F.col("d").alias("a"), F.col("t").alias("b"), F.lit("").alias("c"), F.lit("").alias("e"))
    elif rule == "pid":
        rows = _journals(slim.filter("pid_v2 IS NOT NULL AND pid_v2 <> ''")).withColumn("t", F.explode("titles"))
        key = F.struct(F.lit("pid").alias("rule"), F.col("pid_v2").alias("a"), F.col("t").alias("b"), F.col("journal").alias("c"), year.alias("e"))
    elif rule == "title":
        rows = _journals(slim.withColumn("t", F.explode("titles")).filter((F.length("t") >= TITLE_LENGTH) & ~F.col("t").isin(*GENERIC_TITLES)))
        key = F.struct(F.lit("title").alias("rule"), F.lit("").alias("a"), F.col("t").alias("b"), F.col("journal").alias("c"), year.alias("e"))
    else:
        raise ValueError(f"no such rule: {rule!r}; there are {RULES}")
    return rows.select("doc_idx", key.alias("key")).distinct()


def article_of(docs: DataFrame, strategies=RULES) -> DataFrame:
    """(doc_idx, article_idx): the smallest doc_idx of each doc's article."""
    ids = docs.select("doc_idx")
    if not strategies:
        return ids.withColumn("article_idx", F.col("doc_idx"))
    keys = reduce(DataFrame.unionByName, [rule_keys(docs, r) for r in strategies])
    heads = keys.groupBy("key").agg(F.min("doc_idx").alias("head"), F.count("*").alias("n")).filter("n > 1").drop("n")
    links = keys.join(heads, "key").filter("doc_idx <> head").select("doc_idx", "head")
    labels = components(links, "doc_idx", "head").withColumnsRenamed({"node": "doc_idx", "label": "article_idx"})
    return ids.join(labels, "doc_idx", "left").withColumn("article_idx", F.coalesce("article_idx", "doc_idx"))


def resolve_articles(docs: DataFrame, strategies=RULES) -> DataFrame:
    """One row for each article. A single doc keeps its fields, with collection and pid in arrays; docs of one article are merged."""
    rows = docs.join(article_of(docs, strategies), "doc_idx")
    filled = lambda c: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.col(c))
    merged = rows.groupBy("article_idx").agg(
        F.count("*").alias("n_docs"),
        F.array_sort(F.collect_set("collection")).alias("collection"),
        F.array_sort(F.collect_set("pid_v2")).alias("pid_v2"),
        F.min("publication_year").alias("publication_year"),
        F.min_by(filled("doi"), F.when(filled("doi").isNotNull(), F.col("doc_idx"))).alias("doi"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("titles")))).alias("titles"),
        F.min(filled("document_type")).alias("document_type") if "document_type" in docs.columns else F.lit("").alias("document_type"),
        F.min(filled("journal_title")).alias("journal_title"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("journal_issns")))).alias("journal_issns"),
    )
    # of each language the last doc's DOI
    dois = rows.select("article_idx", "doc_idx", F.explode("doi_with_lang").alias("lang", "d")).filter("d IS NOT NULL AND d <> ''")
    dois = dois.groupBy("article_idx", "lang").agg(F.max_by("d", "doc_idx").alias("d")).groupBy("article_idx").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("lang", "d")))).alias("doi_with_lang"))
    out = merged.join(dois, "article_idx", "left").withColumn("doi_with_lang", F.coalesce("doi_with_lang", F.expr("cast(map() AS map<string,string>)")))
    other = F.when(F.col("n_docs") > 1, F.array_min(F.map_values("doi_with_lang")))
    return out.select("article_idx", "n_docs", "collection", "pid_v2", "publication_year", "doi_with_lang", F.coalesce("doi", other, F.lit("")).alias("doi"), "titles", F.coalesce("document_type", F.lit("")).alias("document_type"), F.coalesce("journal_title", F.lit("")).alias("journal_title"), "journal_issns")


def _claims(docs: DataFrame) -> DataFrame:
    """A row for each DOI of each doc."""
    return docs.select("doc_idx", F.coalesce("titles", F.array().cast("array<string>")).alias("titles"), F.explode(_dois()).alias("doi"))


def audit_classes(docs: DataFrame) -> DataFrame:
    """The audit in classes: docs of one DOI and the same titles are a row, with their number and the smallest of them.

    As many rows as there are different claims of a DOI at most. Two docs of a class merge if it has a title, docs of two classes if their titles overlap.
    """
    return _claims(docs).groupBy("doi", "titles").agg(F.min("doc_idx").alias("class_idx"), F.count("*").alias("n_docs"))


def audit_members(docs: DataFrame) -> DataFrame:
    """(doi, doc_idx, class_idx): the class of each claim."""
    return _claims(docs).join(audit_classes(docs), ["doi", "titles"]).select("doi", "doc_idx", "class_idx", "n_docs", "titles")


#: Pairs that one task is meant to make, as long as there are no more tasks than a shuffle can hold.
PAIRS_A_TASK = 2_000_000
MOST_TASKS = 10_000


def expand_audit(members: DataFrame, chunk: int = 1000) -> DataFrame:
    """The pairs of ``merge_audit`` for the members given (filter them first: pairs of a DOI are squared).

    The docs of a DOI are dealt into chunks, and each chunk meets each later one and itself as a key of its own, so no task gets more than two chunks of a key.
    Keys are dealt into tasks by the number of pairs, since few and small rows make very many of them.
    """
    counted = cut(members.groupBy("doi").agg(F.count("*").alias("n")))
    wanted = int(counted.agg(F.sum(F.col("n").cast("double") ** 2)).first()[0] or 0) // (2 * PAIRS_A_TASK)
    tasks = min(max(members.sparkSession.sparkContext.defaultParallelism, wanted), MOST_TASKS)
    sizes = counted.select("doi", F.greatest(F.ceil(F.col("n") / chunk), F.lit(1)).cast("int").alias("k"))
    dealt = cut(members.join(sizes, "doi").withColumn("c", F.pmod(F.xxhash64("doc_idx"), F.col("k")).cast("int")))
    as_pair = lambda side, i, j: dealt.select("doi", "k", F.explode(F.expr(f"transform(sequence(0, k - 1), o -> struct({i} AS i, {j} AS j))")).alias("p"), F.col("doc_idx").alias(f"{side}_idx"), F.col("titles").alias(f"{side}_titles")).select("doi", "p.i", "p.j", f"{side}_idx", f"{side}_titles").repartition(tasks, "doi", "i", "j")
    pairs = as_pair("left", "c", "o").join(as_pair("right", "o", "c").hint("shuffle_merge"), ["doi", "i", "j"]).filter("left_idx < right_idx")
    return pairs.select("doi", "left_idx", "right_idx", F.arrays_overlap("left_titles", "right_titles").alias("merged"), F.lit("doi_match").alias("reason"))


def merge_audit(docs: DataFrame) -> DataFrame:
    """A row for each DOI of each pair of docs that share it, and whether the DOI rule merges them. Opt-in: pairs of a DOI are squared (``audit_classes`` are not)."""
    return expand_audit(audit_members(docs))
