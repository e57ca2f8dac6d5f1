"""License scans: phrases, and an exact set-similarity join of text blocks with license templates. DataFrame functions only.

Words are runs of letters, digits and anything that isn't ASCII, with A-Z lower-cased. Blocks are ``block`` words of the whole text, one every
``stride`` words, so that whatever is no longer than block - stride + 1 words lies in one of them. A template stands in a block if the block holds at
least ``threshold`` of its different words. Words of templates are counted in all blocks of all documents and ordered by that count, the rarest first.
A template of t words that needs o of them must share one of its first t - o + 1 with the block (prefix filter); the block must hold o words of
templates (length filter); and from the first shared word on both must have o words left (positional filter). What passes is verified by the
intersection. A template whose words are part of another one's found in the same block is not reported there. The templates are a parameter and stay
small whatever the input, so they are sent to the tasks; the filters make a block meet the few templates that share a rare word with it.

Phrases are found where their words follow each other, whatever stands between words.

Null texts are empty; texts without words give zeros, nulls and empty labels; repeated rows and rows without doc_id are handled each; an empty table
gives an empty result; other columns are left out.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholmill.operators.durable import cut

#: Phrases, and sentences of public license notices, with their labels.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("apache-2", "You may obtain a copy of the License at http www apache org licenses LICENSE-2.0"),
    ("gpl-3", "GNU General Public License, version 3"),
    ("gpl-2", "GNU General Public License, version 2"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "GNU Lesser General Public License"),
    ("agpl-3", "GNU Affero General Public License, version 3"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl-2", "Mozilla Public License, v. 2.0"),
    ("isc", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nd", "Creative Commons Attribution-NoDerivatives 4.0 International License"),
    ("cc-by", "Creative Commons Attribution 4.0 International License"),
)
_BETWEEN = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
WORD = f"[^{_BETWEEN}]+"


def words_of(text: str) -> list[str]:
    """The words of a template or phrase."""
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(WORD, text)]


def _lowered(text: Column) -> Column:
    """Lower case of A-Z (and of letters that aren't ASCII, which no template has): the two others that have ASCII forms become such as have none."""
    return F.lower(F.replace(F.replace(text, F.lit("İ"), F.lit("ı")), F.lit("K"), F.lit("ĸ")))


def _blocks(words: str, known: list[str], block: int, stride: int) -> str:
    """SQL of the template words of each block."""
    listed = "array(" + ", ".join(f"'{w}'" for w in known) + ")"
    starts = f"sequence(0, cast(greatest(size({words}) - {block} + {stride} - 1, 0) div {stride} * {stride} AS int), {stride})"
    return f"transform({starts}, i -> array_intersect(slice({words}, i + 1, {block}), {listed}))"


def block_counts(docs: DataFrame, known: list[str], block: int, stride: int) -> DataFrame:
    """word and n: the blocks that hold each of the words, over all documents."""
    words = docs.select(F.regexp_extract_all(_lowered(F.col("text")), F.lit(WORD), F.lit(0)).alias("w"))
    return words.select(F.explode(F.flatten(F.expr(_blocks("w", known, block, stride)))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def _phrase(phrase: str) -> str:
    words = words_of(phrase)
    if not words or any(words[:k] == words[-k:] for k in range(1, len(words))):
        raise ValueError(f"a phrase must have words and not begin as it ends: {phrase!r}")
    return rf"(?i)(?<![^{_BETWEEN}])" + f"[{_BETWEEN}]++".join(re.escape(w) for w in words) + rf"(?![^{_BETWEEN}])"


def _with_phrases(rows: DataFrame, phrases) -> DataFrame:
    """n_words, n_base, first_word, last_word and base (labels): words before a match are those of the pieces between matches, and those of earlier ones."""
    n_words = lambda x: F.regexp_count(x, F.lit(WORD))
    rows = rows.withColumn("n_words", n_words(F.col("text")).cast("long"))
    found = []
    for phrase, label in phrases:
        pattern, size = _phrase(phrase), len(words_of(phrase))
        pieces = F.split("text", pattern, -1)
        at = lambda p, size=size: F.struct((F.size(p) - 1).cast("long").alias("n"), n_words(F.get(p, F.lit(0))).cast("long").alias("first"), (F.col("n_words") - n_words(F.element_at(p, -1)) - size).cast("long").alias("last"))
        found.append(F.when(F.col("text").rlike(pattern), F.struct(F.lit(label).alias("label"), at(pieces).alias("at"))))
    rows = rows.withColumn("hits", F.array_compact(F.array(*found)) if found else F.expr("cast(array() AS array<struct<label: string, at: struct<n: long, first: long, last: long>>>)"))
    return rows.select(
        "*", F.aggregate("hits", F.lit(0).cast("long"), lambda s, h: s + h["at"]["n"]).alias("n_base"), F.array_min(F.transform("hits", lambda h: h["at"]["first"])).alias("first_word"),
        F.array_max(F.transform("hits", lambda h: h["at"]["last"])).alias("last_word"), F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["label"]))).alias("base"),
    ).drop("hits")


def license_scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, threshold: float = 0.9, block: int = 64, stride: int = 32) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base (labels of phrases), found (label, share and start of the block of each template found)."""
    sets = [(label, sorted(set(words_of(text)))) for label, text in templates]
    if not 0 < threshold <= 1 or any(not words or len(words_of(text)) > block - stride + 1 for (_, words), (_, text) in zip(sets, templates, strict=True)):
        raise ValueError(f"the threshold must be above 0 and at most 1, and a template have 1 to {block - stride + 1} words")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    known = sorted({w for _, words in sets for w in words})
    counts = dict(block_counts(docs, known, block, stride).collect()) if known else {}  # as many rows as templates have words
    order = sorted(known, key=lambda w: (counts.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    needs = [math.ceil(threshold * len(words) - 1e-9) for _, words in sets]
    ranked = [sorted(words, key=rank.__getitem__) for _, words in sets]
    postings = [(w, t, i) for t, words in enumerate(ranked) for i, w in enumerate(words[: len(words) - needs[t] + 1])]
    probes = sorted({w for w, _, _ in postings}, key=rank.__getitem__)
    rows = _with_phrases(docs, phrases)
    any_probe = rf"(?i)(?<![^{_BETWEEN}])(?:{'|'.join(map(re.escape, probes))})(?![^{_BETWEEN}])"
    listed = "array(" + ", ".join(f"'{w}'" for w in order) + ")"
    held = f"filter(transform({_blocks('w', known, block, stride)}, (b, i) -> struct(i * {stride} AS start, b AS words)), b -> size(b.words) >= {min(needs, default=1)} AND arrays_overlap(b.words, array({', '.join(f"'{w}'" for w in probes)})))"
    none = F.expr("cast(array() AS array<struct<start: int, words: array<string>>>)")
    words = F.regexp_extract_all(_lowered(F.col("text")), F.lit(WORD), F.lit(0))
    rows = rows.withColumn("w", F.when(F.col("text").rlike(any_probe), words) if probes else F.lit(None).cast("array<string>"))
    rows = rows.withColumn("blocks", F.coalesce(F.expr(held), none) if probes else none).drop("w", "text")
    rows = cut(rows).select(F.monotonically_increasing_id().alias("row"), "*")
    if not sets:
        return rows.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base", F.expr("cast(array() AS array<struct<label: string, share: double, start: int>>)").alias("found"))
    spark = docs.sparkSession
    above = [[u for u, (_, other) in enumerate(sets) if set(mine) < set(other)] for _, mine in sets]
    table = spark.createDataFrame([(t, label, ranked[t], len(ranked[t]), needs[t], above[t]) for t, (label, _) in enumerate(sets)], "template int, label string, template_words array<string>, size int, need int, above array<int>")
    lists = F.broadcast(spark.createDataFrame(postings, "word string, template int, i int").join(table, "template"))
    each = rows.select("row", F.explode("blocks").alias("b")).select("row", "b.start", F.expr(f"filter({listed}, w -> array_contains(b.words, w))").alias("words"))
    probed = each.select("row", "start", "words", F.posexplode("words").alias("j", "word"))
    pairs = probed.join(lists, "word").filter((F.size("words") >= F.col("need")) & (F.least(F.size("words") - F.col("j"), F.col("size") - F.col("i")) >= F.col("need")))
    shared = F.size(F.array_intersect("words", "template_words"))
    hits = pairs.select("row", "start", "template", "label", "above", "need", (shared / F.col("size")).alias("share"), shared.alias("shared")).filter("shared >= need")
    by_block = hits.groupBy("row", "start").agg(F.collect_set(F.struct("template", "label", "share", "above")).alias("h"))  # at most one of each template
    kept = by_block.select("row", F.expr("explode(filter(h, x -> NOT arrays_overlap(x.above, transform(h, y -> y.template))))").alias("x"), "start")
    found = kept.groupBy("row").agg(F.array_sort(F.collect_set(F.struct(F.col("x.label").alias("label"), F.col("x.share").alias("share"), "start"))).alias("found"))
    out = rows.drop("blocks").join(found, "row", "left")
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base", F.coalesce("found", F.expr("cast(array() AS array<struct<label: string, share: double, start: int>>)")).alias("found"))
