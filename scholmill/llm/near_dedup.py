"""MinHash near-dedup: improved consistent weighted sampling over TF-IDF shingles, banded, verified by weighted Jaccard.

A text's shingles are its runs of ``shingle`` words (a shorter text is one shingle). A shingle's weight is its count in the text times its
inverse document frequency, the mean of those of its words, each between 1 and 2. Document frequencies of words are counted over all documents,
in a table of fixed size (``WORDS`` places; words of one place share theirs). Frequencies of whole shingles would be 1 for nearly all, and
in a group of near copies they would make what the copies share weigh least, so that a pair would need more likeness the larger its group is.

Consistent weighted samples give signatures in bands; texts that agree in a band are candidates. Texts of the same words are one class from the
start, so copies take no part. In every band bucket the members are first compared with its smallest doc_id: linear in the bucket. After the
components of these links are known, members of different components in a bucket are compared with one another (in large buckets with a leader
drawn anew first, and then block by block), so that no candidate link between different classes is left out, and none inside one is needed.
A link is a weighted Jaccard similarity of ``threshold`` or more, computed from the whole texts. With ``plain``, a Jaccard similarity of the
sets of shingles of ``threshold`` or more is a link as well. Bands are drawn by weight in both cases: 14 bands of 4 miss a pair of weighted
similarity 0.8 with a probability of 0.0006, one of 0.67 with 0.04.

A sample draws from tables of 2^14 places in each band, by the shingle's hash. Shingles of one place have equal chances for equal
weights but the same draw, which lowers the variety of signatures of texts with more than some 16,000 shingles, not their agreement.

Null texts count as empty; texts without words are like no other; rows without doc_id have a null class and take no part;
rows of one doc_id count as one document; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholmill.llm import blocks as B
from scholmill.operators.components import components
from scholmill.operators.durable import cut

#: Ids that are sent to every task as a set, at most; beyond, the join is a shuffle.
BROADCAST_IDS = 1_000_000
#: Members of a bucket whose pairs are listed; larger ones are compared block by block, of so many texts.
SMALL_BUCKET = 16
BLOCK_ROWS = 1024
#: Pairs with a bucket's leader that meet in one task.
LEADER_ROWS = 128
#: Places of the table of document frequencies.
WORDS = 1 << 18
_SLOT_BITS = 14


def word_place(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(46)).astype(np.int64)


def _count_words(batches):
    """Per task: in how many documents each place of the word table has a word; place WORDS counts documents."""
    table = np.zeros(WORDS + 1, np.int64)
    for batch in batches:
        offsets, data = B.utf8(batch.column(0).fill_null(""))
        table[WORDS] += batch.num_rows
        for a, b in B.parts(offsets, 1 << 20):
            hashes, first, _ = B.words(offsets[a : b + 1] - offsets[a], data[offsets[a] : offsets[b]])
            row = np.repeat(np.arange(b - a), np.diff(first))
            table[:WORDS] += np.bincount(np.unique(row * WORDS + word_place(hashes)) % WORDS, minlength=WORDS)
    at = np.flatnonzero(table)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(table[at])], ["place", "n"])


def idf(df: np.ndarray, n_docs: int) -> np.ndarray:
    """In 1024ths: from 2 for a word of no other document down to 1 for one of all."""
    return np.round(1024 * (1 + np.maximum(0, np.log((1 + n_docs) / (1 + df))) / math.log(1 + max(n_docs, 2)))).astype(np.int64)


def word_weights(docs: DataFrame) -> np.ndarray:
    """The inverse document frequency of every place of the word table."""
    counts = docs.select("text").mapInArrow(B.tidied(_count_words), "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toPandas()  # at most WORDS + 1 rows
    table = np.zeros(WORDS + 1, np.int64)
    table[counts["place"]] = counts["n"]
    return idf(table[:WORDS], int(table[WORDS]))


def shingles(offsets: np.ndarray, data: np.ndarray, k: int, weights: np.ndarray):
    """Row, hash, count and weight of every distinct shingle, sorted by (row, hash); two hashes of each row's words; words by row."""
    hashes, first, _, too = B.words(offsets, data, twice=True)
    n = np.diff(first)
    whole = np.stack([B.sequences(x, first, seed) for seed, x in ((1, hashes), (2, too))])
    of_word = np.concatenate([[0], np.cumsum(weights[word_place(hashes)])])
    many = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    start = B.expand(first[:-1], many)
    row = np.repeat(np.arange(len(n)), many)
    end = np.minimum(start + k, first[1:][row])
    runs = B.windows(B.mix(hashes + too), k)  # of both hashes of a word
    short = (n < k)[row]
    h = np.where(short, B.mix(whole[0] + whole[1])[row], runs[np.minimum(start, max(len(runs) - 1, 0))] if len(runs) else np.uint64(0))
    w = (of_word[end] - of_word[start]) / (1024 * (end - start))  # sums of whole numbers: the same for a shingle in any text
    # one key of row and hash sorts faster than two; what its 16 bits of hash miss is sorted out by the second step
    order = np.argsort(row.astype(np.uint64) << np.uint64(48) | h >> np.uint64(16)) if len(n) < 1 << 16 else np.lexsort((h, row))
    h, row, w = h[order], row[order], w[order]
    if len(h) and ((h[1:] < h[:-1]) & (row[1:] == row[:-1])).any():
        order = np.lexsort((h, row))
        h, row, w = h[order], row[order], w[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(h)))
    return row[at], h[at], count, w[at], whole, n


# ---- signatures


class Sampler:
    """Tables of the random variables of consistent weighted sampling, by band, slot and row; an element draws by its slot in a band."""

    def __init__(self, bands: int, rows: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        shape = (bands, rows, 1 << _SLOT_BITS)
        self.bands, self.rows = bands, rows
        self.r = rng.gamma(2.0, 1.0, shape).astype(np.float32)
        self.beta = rng.random(shape).astype(np.float32)
        self.c = (np.log(rng.gamma(2.0, 1.0, shape)) - self.r).astype(np.float32)  # ln c - r
        self.turn = (rng.integers(1, 1 << 63, bands, dtype=np.int64).astype(np.uint64) << np.uint64(1)) | np.uint64(1)

    def signatures(self, h: np.ndarray, log_weight: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """One hash for each text and band; starts: where each text's elements begin (no text is empty)."""
        out = np.zeros((len(starts), self.bands), np.uint64)
        if not len(h):
            return out
        size = np.diff(np.append(starts, len(h)))
        of = np.repeat(np.arange(len(starts)), size)
        w = log_weight.astype(np.float32)
        for b in range(self.bands):
            slot = ((h * self.turn[b]) >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
            band = np.zeros(len(starts), np.uint64)
            for k in range(self.rows):
                r, beta = self.r[b, k].take(slot), self.beta[b, k].take(slot)
                t = np.floor(w / r + beta)
                a = self.c[b, k].take(slot) - r * (t - beta)  # ln of the sampled value; the least one is the sample
                i = np.flatnonzero(a == np.repeat(np.minimum.reduceat(a, starts), size))
                key = B.mix(h[i] + t[i].astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(b * self.rows + k))
                sample = np.full(len(starts), np.iinfo(np.uint64).max, np.uint64)
                np.minimum.at(sample, of[i], key)  # of equal values, in elements of one slot, the same in every text
                band = B.mix(band) + sample
            out[:, b] = B.mix(band + np.uint64(b))
        return out


SIGNED = "doc_id long, high long, low long, n_words long, weight double, size int, bands array<long>"


def _sign(weights, k: int, bands: int, rows: int):
    def sign(batches):
        sampler = None
        for batch in batches:
            sampler = sampler or Sampler(bands, rows)
            offsets, data = B.utf8(batch.column(1).fill_null(""))
            for a, b in B.parts(offsets, 1 << 20):
                row, h, count, w, whole, n_words = shingles(offsets[a : b + 1] - offsets[a], data[offsets[a] : offsets[b]], k, weights.value)
                w, size = count * w, np.bincount(row, minlength=b - a)
                live = np.flatnonzero(size)
                own = np.zeros((b - a, bands), np.uint64)
                own[live] = sampler.signatures(h, np.log(w), (np.cumsum(size) - size)[live])
                flat = pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1, dtype=np.int32) * bands), pa.array(own.view(np.int64).reshape(-1)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *(pa.array(x) for x in whole.view(np.int64)), pa.array(n_words), pa.array(np.bincount(row, weights=w, minlength=b - a).astype(float)), pa.array(size.astype(np.int32)), flat], ["doc_id", "high", "low", "n_words", "weight", "size", "bands"])

    return sign


# ---- verification


def similarities(left, right, k: int, weights: np.ndarray, plain: bool = False) -> np.ndarray:
    """Weighted Jaccard of the texts in two string arrays, row by row; with ``plain``, that of their sets of shingles where it is larger."""
    sides = []
    for column in (left, right):
        row, h, count, w, _, _ = shingles(*B.utf8(column), k, weights)
        sides.append((row, h, count * w))
    row, h, w = (np.concatenate([s[i] for s in sides]) for i in range(3))
    order = np.lexsort((h, row))
    row, h, w = row[order], h[order], w[order]
    both = np.flatnonzero((row[1:] == row[:-1]) & (h[1:] == h[:-1]))
    n = len(left)
    common = np.bincount(row[both], weights=np.minimum(w[both], w[both + 1]), minlength=n)
    total = np.bincount(row, weights=w, minlength=n) - common
    found = np.where(total > 0, common / np.maximum(total, 1e-12), 0.0)
    if plain:
        common = np.bincount(row[both], minlength=n)
        found = np.maximum(found, common / np.maximum(np.bincount(row, minlength=n) - common, 1))
    return found


LINKS = "x long, y long, similarity double"


def _verify(weights, k: int, threshold: float, plain: bool):
    def run(key, pairs: pa.Table, texts: pa.Table) -> pa.Table:
        """One x with some of its y."""
        none = pa.table({"x": pa.array([], pa.int64()), "y": pa.array([], pa.int64()), "similarity": pa.array([], pa.float64())})
        if not pairs.num_rows or not texts.num_rows:
            return none
        x_text, y_texts, out = texts.column("text")[0].as_py(), pairs.column("y_text").combine_chunks(), []
        sizes = np.cumsum([0, *(pa.compute.binary_length(y_texts).to_numpy() + len(x_text))])
        for a, b in B.parts(sizes, 1 << 20):
            found = similarities(pa.array([x_text] * (b - a)), y_texts.slice(a, b - a), k, weights.value, plain)
            near = np.flatnonzero(found >= threshold - 1e-12)
            out.append(pa.table({"x": pa.array([key[0].as_py()] * len(near), pa.int64()), "y": pairs.column("y").slice(a, b - a).take(pa.array(near)), "similarity": pa.array(found[near])}))
        if sizes[-1] > 1 << 20:  # most groups are small, and giving back after each would cost more than they do
            B.give_back()
        return pa.concat_tables(out) if out else none

    return run


def _expanded(column, k: int, weights: np.ndarray):
    """Row, key, weight and turn of every shingle, one entry for each time it stands in the text: so that common weights are sums of products."""
    row, h, count, w, _, _ = shingles(*B.utf8(column), k, weights)
    turn = B.expand(np.zeros(len(h), np.int64), count).astype(np.uint64)
    return np.repeat(row, count), B.mix(np.repeat(h, count) + turn * np.uint64(0x9E3779B97F4A7C15)), np.repeat(w, count), turn


#: Columns of the working matrices of a block.
_COLUMNS = 2048


def block_similarities(left: pa.Table, right: pa.Table, k: int, weights: np.ndarray, plain: bool = False) -> np.ndarray:
    """Weighted Jaccard of every text in one block with every text in the other, as a matrix product over common shingles; ``plain`` as above."""
    sides = [_expanded(t.column("text"), k, weights) for t in (left, right)]
    total = [np.bincount(row, weights=w, minlength=t.num_rows) for (row, _, w, _), t in zip(sides, (left, right), strict=True)]
    both = np.intersect1d(sides[0][1], sides[1][1])
    placed, single = [], np.zeros(len(both), bool)  # single: columns of a shingle's first time in a text
    for row, key, w, turn in sides:
        at = np.searchsorted(both, key)
        hit = both[np.minimum(at, len(both) - 1)] == key if len(both) else np.zeros(len(key), bool)
        order = np.argsort(at[hit], kind="stable")
        placed.append((row[hit][order], at[hit][order], w[hit][order]))
        single[at[hit & (turn == 0)]] = True
    shared = np.zeros((left.num_rows, right.num_rows))
    common = np.zeros((left.num_rows, right.num_rows))
    for a in range(0, len(both), _COLUMNS):
        m = []
        for i, ((row, at, w), t) in enumerate(zip(placed, (left, right), strict=True)):
            s = slice(*np.searchsorted(at, [a, a + _COLUMNS]))
            m.append(np.zeros((t.num_rows, min(_COLUMNS, len(both) - a))))
            m[-1][row[s], at[s] - a] = 1.0 if i else w[s]
        common += m[0] @ m[1].T
        if plain:
            once = single[a : a + _COLUMNS]
            shared += (m[0][:, once] > 0).astype(float) @ m[1][:, once].T
    found = common / np.maximum(total[0][:, None] + total[1] - common, 1e-12)
    if plain:
        size = [np.bincount(row[turn == 0], minlength=t.num_rows) for (row, _, _, turn), t in zip(sides, (left, right), strict=True)]
        found = np.maximum(found, shared / np.maximum(size[0][:, None] + size[1] - shared, 1))
    return found


def _compare(weights, k: int, threshold: float, plain: bool):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        """Two blocks a and b of a bucket, or one with itself."""
        part = np.asarray(table.column("part"))
        a, b = key[1].as_py(), key[2].as_py()
        left = table.filter(pa.array(part == a))
        right = table.filter(pa.array(part == b))
        found = block_similarities(left, right, k, weights.value, plain)
        x, y, u, v = (np.asarray(t.column(c)) for c in ("doc_id", "label") for t in (left, right))
        near = (found >= threshold - 1e-12) & (u[:, None] != v)
        i, j = np.nonzero(np.triu(near) if a == b else near)
        return pa.table({"x": np.minimum(x[i], y[j]), "y": np.maximum(x[i], y[j]), "similarity": found[i, j]})

    return run


class NearDedup:
    """The steps of the operator over one table."""

    def __init__(self, docs: DataFrame, threshold: float = 0.8, shingle: int = 5, bands: int = 14, rows: int = 4, plain: bool = False):
        self.threshold, self.shingle, self.plain = threshold, shingle, plain
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        self.weights = docs.sparkSession.sparkContext.broadcast(word_weights(self.docs))  # of fixed size
        self.signed = cut(self.docs.mapInArrow(B.tidied(_sign(self.weights, shingle, bands, rows)), SIGNED))
        whole = self.signed.filter("n_words > 0 AND doc_id IS NOT NULL")
        heads = whole.groupBy("high", "low").agg(F.min_by(F.struct("doc_id", "weight", "size", "bands"), "doc_id").alias("h")).select("high", "low", "h.*")
        heads = cut(heads)
        self.copies = heads.select("high", "low", F.col("doc_id").alias("first"))
        if self._repeated():
            heads = heads.groupBy("doc_id").agg(F.min_by(F.struct("weight", "size", "bands"), F.struct("high", "low")).alias("h")).select("doc_id", "h.*")
        members = heads.select("doc_id", F.struct("weight", "size").alias("weight"), F.explode("bands").alias("bucket"))
        # written first, so that the join below is one of two plain exchanges, which adaptive execution can split at a hot bucket
        leaders = cut(members.groupBy("bucket").agg(F.min(F.struct("doc_id", "weight")).alias("leader"), F.count("*").alias("n")).filter("n > 1"))
        self.members = cut(members.join(leaders, "bucket"))  # of buckets with two members or more

    def _near(self, pairs: DataFrame) -> DataFrame:
        """Distinct pairs x <> y whose weights, or with ``plain`` numbers of shingles, allow the similarity; of n pairs of one x, up to ``LEADER_ROWS`` have a salt."""
        fits = [f"least(x_weight.{c}, y_weight.{c}) >= {self.threshold} * greatest(x_weight.{c}, y_weight.{c}) - 1e-9" for c in (["weight", "size"] if self.plain else ["weight"])]
        salt = F.pmod(F.xxhash64("y"), F.ceil(F.col("n") / LEADER_ROWS)).cast("int")
        return pairs.filter(f"x <> y AND ({' OR '.join(fits)})").select("x", "y", salt.alias("salt")).groupBy("x", "y").agg(F.min("salt").alias("salt"))

    def verify(self, pairs: DataFrame) -> DataFrame:
        """The pairs that are links, with their similarity. A text comes once to all pairs of one x and salt, and once to each pair as y."""
        pairs = cut(pairs)
        texts = self._texts(pairs.select(F.col("x").alias("doc_id")).unionByName(pairs.select(F.col("y").alias("doc_id"))).distinct())
        left = pairs.join(texts.select(F.col("doc_id").alias("y"), F.col("text").alias("y_text")), "y").select("x", "salt", "y", "y_text")
        right = pairs.select("x", "salt").distinct().join(texts.withColumnRenamed("doc_id", "x"), "x")
        left, right = (t.select([F.col(c).alias(c) for c in t.columns]) for t in (left, right))
        return cut(left.groupBy("x", "salt").cogroup(right.groupBy("x", "salt")).applyInArrow(_verify(self.weights, self.shingle, self.threshold, self.plain), LINKS))

    def _texts(self, ids: DataFrame) -> DataFrame:
        """doc_id and text of some documents."""
        if ids.count() <= BROADCAST_IDS:
            ids = F.broadcast(ids)
        texts = self.docs.join(ids, "doc_id", "left_semi")
        return texts.groupBy("doc_id").agg(F.min("text").alias("text")) if self._repeated() else texts

    def compare(self, open_: DataFrame) -> DataFrame:
        """Links between members of different components in large buckets: outside the main one, against all.

        Members outside the main component and members of it are cut into blocks of about ``BLOCK_ROWS`` texts; each pair of blocks, but for two
        of the main component, is one small task of matrix products. No pair that is not a link becomes a row.
        """
        texts = self._texts(open_.select("doc_id").distinct())
        parts = lambda n: F.ceil(n / BLOCK_ROWS).cast("int")
        sizes = cut(open_.groupBy("bucket").agg(parts(F.count_if(F.col("label") != F.col("main"))).alias("rest"), parts(F.count_if(F.col("label") == F.col("main"))).alias("mains")))
        own = lambda n: F.pmod(F.xxhash64("doc_id", "bucket"), F.col(n)).cast("int")
        rows = open_.join(sizes, "bucket").withColumn("part", F.when(F.col("label") == F.col("main"), F.col("rest") + own("mains")).otherwise(own("rest")))
        with_ = F.explode(F.when(F.col("part") < F.col("rest"), F.sequence(F.lit(0), F.col("rest") + F.col("mains") - 1)).otherwise(F.sequence(F.lit(0), F.col("rest") - 1)))
        rows = rows.select("bucket", "doc_id", "label", "part", with_.alias("other"))
        rows = rows.select("bucket", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"), "part", "doc_id", "label").join(texts, "doc_id")
        return cut(rows.groupBy("bucket", "a", "b").applyInArrow(B.tidied_groups(_compare(self.weights, self.shingle, self.threshold, self.plain)), LINKS).dropDuplicates(["x", "y"]))

    def _repeated(self) -> bool:
        """Whether a doc_id has several rows."""
        if not hasattr(self, "_has_repeats"):
            self._has_repeats = self.signed.filter("doc_id IS NOT NULL").agg((F.count("*") > F.count_distinct("doc_id")).alias("r")).first()[0]
        return self._has_repeats

    def _open(self, links: DataFrame, tried: int) -> DataFrame:
        """Members of buckets that hold several components: with the component of the smallest member (main), and a member drawn anew (s)."""
        labels = components(links, "x", "y")
        held = self.members.select("bucket", "doc_id", "weight").join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("label", F.coalesce("label", "doc_id")).select("bucket", "doc_id", "weight", "label")
        draw = F.min_by(F.struct("doc_id", "weight", "label"), F.xxhash64("doc_id", "bucket", F.lit(tried)))
        main = cut(held.groupBy("bucket").agg(F.min(F.struct("doc_id", "label")).alias("m"), draw.alias("s"), F.count("*").alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi").select("bucket", F.col("m.label").alias("main"), "s", "n"))
        return cut(held.join(main, "bucket"))

    def links(self, drawn: int = 1, small: int = SMALL_BUCKET) -> DataFrame:
        """Links enough that their components are those of all candidate links."""
        m = self.members.select("bucket", F.col("leader.doc_id").alias("x"), F.col("leader.weight").alias("x_weight"), F.col("doc_id").alias("y"), F.col("weight").alias("y_weight"), "n")
        links = self.verify(self._near(m))
        for k in range(drawn + 1):
            open_ = self._open(links, k)
            large = open_.filter(F.col("n") > small)
            if k < drawn:  # another leader in each large bucket: linear in the bucket
                if large.isEmpty():
                    continue
                pairs = large.select(F.col("s.doc_id").alias("x"), F.col("s.weight").alias("x_weight"), F.col("s.label").alias("x_label"), F.col("doc_id").alias("y"), F.col("weight").alias("y_weight"), F.col("label").alias("y_label"), "n")
                links = links.unionByName(self.verify(self._near(pairs.filter("x_label <> y_label"))))
                continue
            few = open_.filter(F.col("n") <= small)
            side = few.filter("label <> main").select("bucket", F.col("doc_id").alias("x"), F.col("weight").alias("x_weight"), F.col("label").alias("x_label"))
            other = few.select("bucket", F.col("doc_id").alias("y"), F.col("weight").alias("y_weight"), F.col("label").alias("y_label"), "n")
            links = links.unionByName(self.verify(self._near(side.join(other, "bucket").filter("x_label <> y_label"))))
            if not large.isEmpty():
                links = links.unionByName(self.compare(large))
        return links

    def classes(self) -> DataFrame:
        """doc_id and class_id (the smallest doc_id of the class) of every row."""
        labels = components(self.links(), "x", "y").select(F.col("node").alias("first"), "label")
        found = self.signed.select("doc_id", "n_words", "high", "low").join(self.copies, ["high", "low"], "left").join(labels, "first", "left")
        return found.select("doc_id", F.when(F.col("n_words") == 0, F.col("doc_id")).otherwise(F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "first"))).alias("class_id"))


def near_dedup(docs: DataFrame, threshold: float = 0.8, shingle: int = 5, bands: int = 14, rows: int = 4, plain: bool = False) -> DataFrame:
    """doc_id and class_id of every row; a class is kept by its document with doc_id = class_id."""
    return NearDedup(docs, threshold, shingle, bands, rows, plain).classes()


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without those that have a class kept by another document; of rows of one doc_id one stays.

    Rows without doc_id stay.
    """
    found = NearDedup(docs, **options)
    gone = cut(found.classes().filter("class_id <> doc_id").select("doc_id").distinct())
    # few ids are sent to every task; more are joined by a shuffle
    kept = docs.join(F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone, "doc_id", "left_anti").select(docs.columns)
    if not found._repeated():
        return kept
    known = kept.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    return known.unionByName(kept.filter("doc_id IS NULL"))
