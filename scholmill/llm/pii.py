"""Personal data by patterns and by bootstrapped contextual extraction, in DataFrame functions only.

Base spans are the leftmost non-overlapping matches of one pattern for each kind, without those that fail the kind's check. Their
places come from the lengths of the matches and of what stands between them. Base spans that are a whole unit (tokens with a digit or
``@``, next to each other) are seeds. Each unit has two lexical patterns: the two words before it, and the word before with the word
after. Patterns and units are a graph. In each round patterns are induced: those that ``support`` different known units of a kind share, seeds or
found in earlier rounds. A pattern's confidence in a kind is the mean score of its different units, a unit's score the highest confidence of
its patterns; seeds stay at 1. Units of ``accept`` or more become known and bring their own patterns in the next round, until a
round changes no score by more than a hundredth (an error after ``rounds``). Units of fewer than 6 characters, and such as have neither ``@`` nor 3
digits, are no candidates: ordinals and short numbers stand in any context. Known units that overlap no base span are found identifiers of that kind.

Null texts are empty; rows without doc_id and equal rows are handled each; positions are code points, ends exclusive; a text without
matches gives zeros and empty lists; an empty table gives an empty result; other columns are left out. What is written between steps holds
digests of units and patterns, places and doc_ids, no text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholmill.operators.durable import cut

#: Kinds in their order, and their patterns. Quantifiers that never give back anything are possessive, and what
#: can only start a run is tied to its start (or to the end of the match before), which leaves the matches as they are and the time linear.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[\x20-]?[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
#: What a text holds if it has a match.
HINTS = ("@", r"[0-9]\.[0-9]", r"[0-9]", r"\+[0-9]")
UNIT = r"(?<!\S)\S*[0-9@]\S*+(?:[ \t]\S*[0-9@]\S*+)*+"
CHUNK = 256
#: Links of units and patterns that one task is meant to handle.
ROWS_A_TASK = 200_000
SPAN = "struct<kind: int, start: int, end: int>"


def _digits(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '')"


_LUHN = "aggregate(sequence(1, length(d)), 0, (a, i) -> a + CASE WHEN i % 2 = 1 THEN cast(substr(d, -i, 1) AS int) WHEN substr(d, -i, 1) >= '5' THEN 2 * cast(substr(d, -i, 1) AS int) - 9 ELSE 2 * cast(substr(d, -i, 1) AS int) END) % 10 = 0"
CHECKS = (
    "true",
    r"forall(split(x, '\\.'), p -> length(ltrim('0', p)) <= 3 AND cast(concat('0', right(p, 3)) AS int) <= 255)",
    f"exists(array({_digits('x')}), d -> length(d) BETWEEN 16 AND 19 AND {_LUHN})",
    f"length({_digits('x')}) BETWEEN 8 AND 15",
)


def _located(matches: str, gaps: str) -> str:
    """SQL of [(start, end)] of the matches, in linear time: sums by chunks, then within each chunk."""
    pairs = f"transform({matches}, (x, i) -> struct(length({gaps}[i]) AS gap, length(x) AS size))"
    chunks = f"transform(sequence(0, (size({matches}) - 1) div {CHUNK}), c -> slice(pairs, cast(c * {CHUNK} + 1 AS int), {CHUNK}))"
    inner = "aggregate(ch, struct(heads[k] AS at, cast(array() AS array<struct<start: int, end: int>>) AS out), (a, p) -> struct(a.at + p.gap + p.size AS at, concat(a.out, array(struct(a.at + p.gap AS start, a.at + p.gap + p.size AS end))) AS out), a -> a.out)"
    heads = "aggregate(chunks, array(0), (a, ch) -> concat(a, array(element_at(a, -1) + aggregate(ch, 0, (s, p) -> s + p.gap + p.size))))"
    body = f"flatten(transform(chunks, (ch, k) -> {inner}))"
    # names for parts of an expression: lambdas over arrays of one
    named = f"transform(array({pairs}), pairs -> transform(array({chunks}), chunks -> transform(array({heads}), heads -> {body})[0])[0])[0]"
    return f"CASE WHEN size({matches}) > 0 THEN {named} ELSE cast(array() AS array<struct<start: int, end: int>>) END"


def _matches(rows: DataFrame, name: str, pattern: str, hint: str) -> DataFrame:
    """Adds name (the matches), name_gaps and name_at (their places)."""
    text = F.col("text")
    none = F.expr("cast(array() AS array<string>)")
    has = text.contains(hint) if hint == "@" else text.rlike(hint)
    rows = rows.withColumn(name, F.when(has, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none))
    rows = rows.withColumn(f"{name}_gaps", F.when(F.size(name) > 0, F.split(text, pattern, -1)).otherwise(none))
    return rows.withColumn(f"{name}_at", F.expr(_located(name, f"{name}_gaps")))


def annotated(docs: DataFrame) -> DataFrame:
    """row, doc_id, base spans, and units with value, kind (of a seed; -1: none, -2: overlaps a base span) and patterns. Without the texts."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    for k, kind in enumerate(KINDS):
        rows = _matches(rows, kind, PATTERNS[k], HINTS[k])
        rows = rows.withColumn(f"{kind}_spans", F.expr(f"transform(filter(transform({kind}_at, (s, i) -> struct(s.start AS start, s.end AS end, {kind}[i] AS x)), s -> exists(array(s.x), x -> {CHECKS[k]})), s -> cast(struct({k} AS kind, s.start AS start, s.end AS end) AS {SPAN}))"))
        rows = rows.drop(kind, f"{kind}_gaps", f"{kind}_at")
    rows = rows.select("doc_id", "text", F.concat(*(f"{k}_spans" for k in KINDS)).alias("base"))
    rows = _matches(rows, "unit", UNIT, "[0-9@]")
    words = "filter(split({}, '\\\\s+'), w -> w <> '')"
    left = f"slice(concat(array('', IF(i = 0, '^', '<id>')), {words.format('lower(unit_gaps[i])')}), -2, 2)"
    right = f"concat({words.format('lower(unit_gaps[i + 1])')}, array(IF(i = size(unit) - 1, '$', '<id>')))[0]"
    core = r"struct(s.start + length(regexp_extract(x, '^[^\\p{L}\\p{N}+]*+', 0)) AS start, s.end - length(regexp_extract(x, '(?<![^\\p{L}\\p{N}])[^\\p{L}\\p{N}]*+$', 0)) AS end)"
    value = r"lower(regexp_replace(x, '^[^\\p{L}\\p{N}+]++|(?<![^\\p{L}\\p{N}])[^\\p{L}\\p{N}]++$', ''))"
    unit = f"transform(unit_at, (s, i) -> transform(array(unit[i]), x -> struct({core} AS c, {value} AS value, {left} AS l, {right} AS r))[0])"
    kind = "CASE WHEN exists(base, b -> b.start = u.c.start AND b.end = u.c.end) THEN filter(base, b -> b.start = u.c.start AND b.end = u.c.end)[0].kind WHEN exists(base, b -> b.start < u.c.end AND b.end > u.c.start) THEN -2 ELSE -1 END"
    named = f"transform({unit}, u -> struct(u.c.start AS start, u.c.end AS end, u.value AS value, {kind} AS kind, array(md5(concat('before ', u.l[0], ' ', u.l[1])), md5(concat('around ', u.l[1], ' _ ', u.r))) AS patterns))"
    like = r"u.kind >= 0 OR u.kind = -1 AND length(u.value) >= 6 AND (u.value LIKE '%@%' OR length(regexp_replace(u.value, '[^0-9]', '')) >= 3)"
    digests = "u -> struct(u.start AS start, u.end AS end, left(sha2(u.value, 256), 32) AS value, u.kind AS kind, u.patterns AS patterns)"
    rows = rows.select("doc_id", "base", F.expr(f"transform(filter({named}, u -> {like}), {digests})").alias("units"))
    return cut(rows).select(F.monotonically_increasing_id().alias("row"), "*")


def discovered(units: DataFrame, support: int = 3, accept: float = 0.7, rounds: int = 100) -> DataFrame:
    """(value, kind) of the identifiers that high-confidence patterns find; units: value, kind, patterns."""
    seeds = cut(units.filter("kind >= 0").select("value", "kind").distinct().withColumn("score", F.lit(1.0)))
    edges = cut(units.filter("kind >= -1").select("value", F.explode("patterns").alias("pattern")).distinct())
    k = max(1, -(-edges.count() // ROWS_A_TASK))  # a small graph is kept in few partitions, so that its many exchanges write few files
    edges, seeds = edges.coalesce(k), seeds.coalesce(k)
    sizes = cut(edges.groupBy("pattern").agg(F.count("*").alias("size")).filter(F.col("size") >= support).coalesce(k))
    scores, mark = seeds, None
    for _ in range(rounds):
        known = F.count_if(F.col("score") >= accept)
        patterns = edges.join(scores, "value").coalesce(k).groupBy("pattern", "kind").agg(F.sum("score").alias("sum"), known.alias("known")).coalesce(k).filter(F.col("known") >= support)
        confidence = patterns.join(sizes, "pattern").coalesce(k).select("pattern", "kind", (F.col("sum") / F.col("size")).alias("score"))
        reached = edges.join(confidence, "pattern").coalesce(k).groupBy("value", "kind").agg(F.max("score").alias("score")).coalesce(k)
        scores = cut(reached.join(seeds, ["value", "kind"], "left_anti").coalesce(k).unionByName(seeds).coalesce(k))
        seen = scores.agg(F.count("*"), F.sum(F.xxhash64("value", "kind", F.round("score", 2)).cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    else:
        raise RuntimeError(f"scores of patterns and units did not settle in {rounds} rounds")
    best = scores.join(seeds.select("value").distinct(), "value", "left_anti").filter(F.col("score") >= accept)
    return best.groupBy("value").agg(F.max_by("kind", F.struct("score", -F.col("kind"))).alias("kind"))


def _listed(spans: str) -> str:
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return f"concat_ws(',', transform(array_sort({spans}), s -> concat({names}[s.kind], ':', s.start, ':', s.end)))"


def personal_data(docs: DataFrame, support: int = 3, accept: float = 0.7, rounds: int = 100) -> DataFrame:
    """doc_id, the number of base spans by kind, the lists of base spans and of all spans (kind:start:end), and n_found."""
    rows = annotated(docs)
    units = rows.select("row", F.explode("units").alias("u")).select("row", "u.*")
    found = discovered(units, support, accept, rounds)
    more = units.filter("kind = -1").drop("kind").join(found, "value").groupBy("row").agg(F.collect_list(F.expr(f"cast(struct(kind, start, end) AS {SPAN})")).alias("found"))
    out = rows.select("row", "doc_id", "base").join(more, "row", "left")
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = {k})) AS long)").alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    every = f"concat(base, coalesce(found, cast(array() AS array<{SPAN}>)))"
    return out.select("doc_id", *counts, F.expr(_listed("base")).alias("base"), F.expr(_listed(every)).alias("spans"), F.expr("cast(coalesce(size(found), 0) AS long)").alias("n_found"))
