"""Spelling variants: words one edit apart, by a dictionary of pairs of trie nodes.

Words stand in two tries, one read forward and one read backward. Nodes are numbered: those of up to two letters by their letters, deeper ones that
several words share from a table of nodes (a node is told from others by a 128-bit digest of its letters and its trie; nodes of one word alone can't
help to find another one and get no number). A word of length L has L + 1 gaps and L letters to skip. A gap at i is the pair of integers (prefix node
of the first i letters, suffix node of what follows), a skip at i the pair (prefix node of the first i, suffix node of what follows letter i). Words that
skip a letter at one pair differ by a replacement there; a word whose gap is the pair that another one skips lacks that letter. Of letters that repeat
(``aab``) only the skip of the first one is compared with gaps, so that each pair of words meets exactly once, and numbers of near words are sums.

Words of one pair that skip differ in one letter alone, so a pair holds no more of them than there are letters (90), and one word with a gap there. Each
word of a pair reports the number and the best of the others, never the pairs of words.

Forms are near words that are ``factor`` times as frequent, so chains of forms end within the logarithm of the largest count; roots are found by
following them in steps of doubling length.

Null texts have no words; a null doc_id counts as an empty one in the rule that varies words; repeated rows count each; words of any length are
handled in time proportional to it; an empty table gives no word; other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholmill.operators.durable import cut

RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NODES = "word_id long, n long, side string, i int, number long, key binary, first boolean"


def varied_words(docs: DataFrame, length: int = 5, least: int = 3, every: int = 97) -> DataFrame:
    """word and n: runs of letters in lower case, of which one letter is left out where the checksum of document and run says so."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"))
    rows = rows.filter(F.length("run") >= length).select("id", F.translate("run", UPPER, LOWER).alias("run"))
    rows = rows.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    word = F.when(F.col("h") % every == 0, F.concat(F.left("run", at), F.expr("substring(run, cast(h % length(run) AS int) + 2)"))).otherwise(F.col("run"))
    return rows.select(word.alias("word")).filter(F.length("word") >= length).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words to the nodes on their two paths: (side, i) is 'p' with the first i letters, 'g' with the letters from i on, 's' with those after letter i."""
    names = ["word_id", "n", "side", "i", "number", "key", "first"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.bool_()]
    out: list[tuple] = []

    def batch() -> pa.RecordBatch:
        rows = pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)
        out.clear()
        return rows

    def path(letters: str, side: bytes) -> Iterator[tuple]:
        """(number, key) of the node after each letter, the root first."""
        digest, short = hashlib.blake2b(digest_size=16, person=side), 0
        yield 0, None
        for k, c in enumerate(letters):
            digest.update(c.encode("utf-8"))
            short = short << 21 | ord(c)
            yield (-short, None) if k < 2 else (None, digest.copy().digest())

    for b in batches:
        for word_id, word, n in zip(b["word_id"].to_pylist(), b["word"].to_pylist(), b["n"].to_pylist(), strict=True):
            size = len(word)
            for i, node in enumerate(path(word, b"forward")):
                out.append((word_id, n, "p", i, *node, 0 < i < size and word[i] != word[i - 1] or i == 0))
                if len(out) >= 20_000:
                    yield batch()
            for k, node in enumerate(path(word[::-1], b"backward")):
                out.append((word_id, n, "g", size - k, *node, None))
                if k < size:
                    out.append((word_id, n, "s", size - k - 1, *node, None))
                if len(out) >= 20_000:
                    yield batch()
    if out:
        yield batch()


def node_pairs(words: DataFrame) -> DataFrame:
    """(p, s, member): the pairs of node numbers of each word's gaps and skips; member: n, -word_id, kind and whether a skipped letter is the first of its run."""
    steps = cut(words.select("word_id", "word", "n").mapInArrow(_paths, _NODES))
    deep = steps.filter("key IS NOT NULL")
    nodes = deep.filter("side <> 's'").groupBy("key").agg(F.count("*").alias("words")).filter("words > 1").select("key")
    nodes = cut(nodes).withColumn("number", F.monotonically_increasing_id() + 1)
    numbered = deep.drop("number").join(nodes, "key").select("word_id", "n", "side", "i", "number", "first").unionByName(steps.filter("key IS NULL").select("word_id", "n", "side", "i", "number", "first"))
    of = lambda side: F.max(F.when(F.col("side") == side, F.col("number")))
    places = numbered.groupBy("word_id", "i").agg(F.max("n").alias("n"), of("p").alias("p"), of("g").alias("g"), of("s").alias("s"), F.max("first").alias("first")).filter("p IS NOT NULL")
    pairs = places.select("word_id", "n", "p", "first", F.explode(F.array(F.struct(F.lit("gap").alias("kind"), F.col("g").alias("s")), F.struct(F.lit("skip").alias("kind"), F.col("s").alias("s")))).alias("x")).filter("x.s IS NOT NULL")
    return pairs.select("p", F.col("x.s").alias("s"), F.struct("n", (-F.col("word_id")).alias("word"), F.col("x.kind").alias("kind"), "first").alias("member"))


def near_words(words: DataFrame) -> DataFrame:
    """word_id, n_near, and best: n and -word_id of the near word of largest n, of these the first."""
    groups = node_pairs(words).groupBy("p", "s").agg(F.collect_list("member").alias("m")).filter(F.size("m") > 1)  # one for each letter and a gap at most
    near = "x.kind = 'skip' AND (y.kind = 'skip' OR x.first) OR x.kind = 'gap' AND y.kind = 'skip' AND y.first"
    others = f"transform(m, x -> struct(x.word AS word, transform(filter(m, y -> y.word <> x.word AND ({near})), y -> struct(y.n AS n, y.word AS word)) AS o))"
    rows = groups.select(F.explode(F.expr(others)).alias("x")).select((-F.col("x.word")).alias("word_id"), F.size("x.o").alias("k"), F.array_max("x.o").alias("best")).filter("k > 0")
    return rows.groupBy("word_id").agg(F.sum("k").cast("long").alias("n_near"), F.max("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word_id, root_id) from (word_id, form_id), each form followed to the last."""
    found = cut(forms.select("word_id", F.col("form_id").alias("root_id")))
    while True:
        onward = found.select(F.col("word_id").alias("root_id"), F.col("root_id").alias("next"))
        found = cut(found.join(onward, "root_id", "left").select("word_id", F.coalesce("next", "root_id").alias("root_id"), F.col("next").isNotNull().alias("moved")))
        if found.filter("moved").isEmpty():
            return found.drop("moved")
        found = found.drop("moved")


def spelling_groups(words: DataFrame, factor: int = 2) -> DataFrame:
    """word, n, form (or null), root, n_near and form_n of words with counts (word, n)."""
    words = cut(cut(words).orderBy("word").withColumn("word_id", F.monotonically_increasing_id()))  # ids in the order of code points
    near = words.drop("word").join(near_words(words), "word_id", "left")
    chosen = F.col("best.n") >= factor * F.col("n")
    near = cut(near.select("word_id", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(chosen, -F.col("best.word")).alias("form_id"), F.when(chosen, F.col("best.n")).alias("form_n")))
    last = roots(near.filter("form_id IS NOT NULL").select("word_id", "form_id"))
    names = words.select("word_id", "word")
    out = near.join(last, "word_id", "left").join(names, "word_id")
    out = out.join(names.select(F.col("word_id").alias("form_id"), F.col("word").alias("form")), "form_id", "left").join(names.select(F.col("word_id").alias("root_id"), F.col("word").alias("other")), "root_id", "left")
    return out.select("word", "form", F.coalesce("other", "word").alias("root"), "n", "n_near", "form_n")
