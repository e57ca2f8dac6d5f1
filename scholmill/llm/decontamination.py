"""Benchmark decontamination: a BM25 inverted index of the test items, queried by every passage of every document with block-max WAND.

Words are runs of letters and digits, in lower case. Document frequencies, the number of items and their mean length are counted over all items
before, so that scores are the same however the index is cut. Items are indexed by length class: C is the length of the longest possible item
of the class in words: 64, 256 and so on. Passages are the windows of 2 C words at every C-th word, so that each stretch of C words lies whole
in one. A passage's score for an item is the sum of the BM25 impacts of its distinct words; the item is retrieved from ``retrieve`` of the score
of its own text on. Impacts are divided by that threshold, so that one bound holds for all items.

A posting list has the largest impact of each block of ``FAN`` items, of each ``FAN`` blocks, and so on up to the whole list. A passage goes from
whole lists down into blocks where the sum of these reaches 1; in a block that is left, WAND moves one cursor a word: in order of
their items, the first cursor at which the sum of largest impacts reaches 1 is the pivot, the cursors before it skip to its item, and the item
is scored when all stand there. All passages step together. So all items above the threshold are found and most are never scored.
A retrieved item counts if ``overlap`` of the ``shingle``-word runs of its question, and of its answer, stand in the passage. The answer
is the last line, or else the last sentence; an item of one sentence is all question.

Null texts are empty and match nothing; items without words and rows of ``items`` without text take no part; rows without doc_id
are searched as any other, and equal rows each; items with equal text are all reported; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholmill.llm import blocks as B
from scholmill.operators.durable import cut

#: Items of one index, and bytes of item texts in one pass over the documents; a larger benchmark takes several passes. Neither changes a result.
SHARD_ITEMS = 4096
PASS_BYTES = 8 << 20
FAN = 64
_NEAR = 1 - 1e-4

_APART = np.ones(256, bool)
_APART[list(range(48, 58)) + list(range(97, 123)) + list(range(128, 256))] = False


def tokens(texts: pa.Array):
    """Hash of every word, first word of each text."""
    offsets, data = B.utf8(pc.utf8_lower(texts.cast(pa.large_string())))
    hashes, first, _ = B.words(offsets, data, _APART)
    return hashes, first


def runs(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words; of the whole if it is shorter."""
    k = min(k, len(hashes))
    return np.unique(B.windows(hashes, k)) if k else np.zeros(0, np.uint64)


def question_and_answer(text: str) -> tuple[str, str]:
    lines = text.strip().rsplit("\n", 1)
    if len(lines) == 2 and re.search(r"\w", lines[1]) and re.search(r"\w", lines[0]):
        return lines[0], lines[1]
    found = re.match(r"(.*[.?!])\s+(\S.*)", text.strip(), re.DOTALL)
    return (found[1], found[2]) if found else (text, "")


class Statistics:
    """Of all items: their number, their mean length, and in how many of them each word of some of them stands."""

    def __init__(self, n: int, mean: float, words: np.ndarray, df: np.ndarray, k1: float = 1.2, b: float = 0.75):
        order = np.argsort(words)
        self.n, self.mean, self.words, self.df, self.k1, self.b = n, mean, words[order], df[order], k1, b

    def impacts(self, word: np.ndarray, tf: np.ndarray, length: np.ndarray) -> np.ndarray:
        df = self.df[np.searchsorted(self.words, word)]
        return np.log(1 + (self.n - df + 0.5) / (df + 0.5)) * tf * (self.k1 + 1) / (tf + self.k1 * (1 - self.b + self.b * length / self.mean))


def length_class(length: int, shingle: int) -> int:
    """The length of the longest item of its class: 64, 256, 1024 and so on."""
    size = 64
    while size < max(int(length), 2 * shingle):
        size *= 4
    return size


class Shard:
    """The inverted index of some items of one length class."""

    def __init__(self, items: list[tuple[int, str]], statistics: Statistics, retrieve: float, shingle: int):
        self.ids = np.array([i for i, _ in items])
        hashes, first = tokens(pa.array([t for _, t in items]))
        length = np.diff(first)
        self.stride = length_class(length.max(), shingle)
        self.vocabulary, term = np.unique(hashes, return_inverse=True)
        n = len(items)
        posting, tf = np.unique(term * n + np.repeat(np.arange(n), length), return_counts=True)  # sorted by word, then item
        term, item = posting // n, posting % n
        impact = statistics.impacts(self.vocabulary[term], tf, length[item])
        self.need = retrieve * np.bincount(item, weights=impact, minlength=n)
        self.posting, self.impact = posting, impact / self.need[item]
        self.levels = []  # from whole lists down to blocks of FAN items: node size, keys of word and block, largest impacts
        self.fan = size = FAN
        while True:
            blocks = -(-n // size)
            key = term * blocks + item // size
            start = np.flatnonzero(np.diff(key, prepend=-1))
            self.levels.insert(0, (size, blocks, key[start], np.maximum.reduceat(self.impact, start)))
            if blocks == 1:
                break
            size *= self.fan
        self.seen = np.zeros(1 << 16, bool)
        self.seen[(self.vocabulary >> np.uint64(48)).astype(np.int64)] = True
        self.parts = []
        for _, text in items:
            q, a = (tokens(pa.array([t]))[0] for t in question_and_answer(text))
            self.parts.append((runs(q, shingle), min(len(q), shingle), runs(a, shingle), min(len(a), shingle)))

    def passages(self, hashes: np.ndarray, first: np.ndarray):
        """First passage of each row, and the distinct indexed words of every passage that has any: passage, start and count in the list of words."""
        n, C = np.diff(first), self.stride
        windows = np.maximum(1, -(-n // C) - 1)
        base = np.cumsum(windows) - windows
        at = np.flatnonzero(self.seen[(hashes >> np.uint64(48)).astype(np.int64)])
        term = np.searchsorted(self.vocabulary, hashes[at])
        hit = self.vocabulary[np.minimum(term, len(self.vocabulary) - 1)] == hashes[at]
        at, term = at[hit], term[hit]
        row = np.searchsorted(first, at, side="right") - 1
        segment = (at - first[row]) // C
        size, keys = len(self.vocabulary), []
        for back in (0, 1):
            ok = (segment >= back) & (segment - back < windows[row])
            keys.append((base[row[ok]] + segment[ok] - back) * size + term[ok])
        keys = np.unique(np.concatenate(keys))
        window, term = keys // size, keys % size
        start = np.flatnonzero(np.diff(window, prepend=-1))
        return base, window[start], start, np.diff(np.append(start, len(keys))), term

    def search(self, hashes: np.ndarray, first: np.ndarray):
        """(row, first word of the passage, item, score over threshold) of all retrieved passages."""
        base, window, start, count, term = self.passages(hashes, first)
        pick, node = np.arange(len(window)), np.zeros(len(window), np.int64)  # passages, and blocks of theirs that are still open
        above = 1  # blocks of the level above
        for _, blocks, key, most in self.levels:
            fan = self.fan if above > 1 else blocks
            found = []
            for a, b in B.parts(np.concatenate([[0], np.cumsum(count[pick])]), max(1, (1 << 22) // fan)):
                p, own, own_node = pick[a:b], count[pick[a:b]], node[a:b]
                word = term[B.expand(start[p], own)]
                if blocks == 1:  # whole lists: one entry a word
                    sums = np.add.reduceat(most[word], np.cumsum(own) - own)[:, None]
                else:
                    pair = np.repeat(np.arange(b - a), own)
                    low = np.searchsorted(key, word * blocks + own_node[pair] * fan)
                    high = np.searchsorted(key, word * blocks + np.minimum((own_node[pair] + 1) * fan, blocks))
                    entry, pair = B.expand(low, high - low), np.repeat(pair, high - low)
                    sums = np.bincount(pair * fan + key[entry] % blocks - own_node[pair] * fan, weights=most[entry], minlength=(b - a) * fan).reshape(-1, fan)
                i, j = np.nonzero(sums >= _NEAR)
                found.append((p[i], own_node[i] * fan + j))
            pick, node = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (pick[:0], node[:0])
            above = blocks
        out = [self._wand(pick[a:b], node[a:b], start, count, term) for a, b in B.parts(np.concatenate([[0], np.cumsum(count[pick])]), 1 << 18)]
        if not out:
            return None
        pick, item, value = (np.concatenate(x) for x in zip(*out, strict=True))
        row = np.searchsorted(base, window[pick], side="right") - 1
        return row, first[row] + (window[pick] - base[row]) * self.stride, item, value

    def _wand(self, pick, node, start, count, term):
        """Passage, item and score of what reaches the threshold in one open block of each passage."""
        n, (size, blocks, key, most) = len(self.ids), self.levels[-1]
        pair = np.repeat(np.arange(len(pick)), count[pick])
        word = term[B.expand(start[pick], count[pick])]
        entry = np.minimum(np.searchsorted(key, word * blocks + node[pair]), len(key) - 1)
        has = key[entry] == word * blocks + node[pair]
        pair, word, bound = pair[has], word[has], most[entry[has]]
        at = np.searchsorted(self.posting, word * n + node[pair] * size)
        end = np.searchsorted(self.posting, word * n + np.minimum((node[pair] + 1) * size, n))
        out = []
        while len(pair):
            item = self.posting[at] % n
            order = np.lexsort((item, pair))
            pair, word, bound, at, end, item = (x[order] for x in (pair, word, bound, at, end, item))
            head = np.flatnonzero(np.diff(pair, prepend=-1))
            own = np.diff(np.append(head, len(pair)))
            sums = np.cumsum(bound)
            sums -= np.repeat(sums[head] - bound[head], own)
            reached = np.flatnonzero(sums >= _NEAR)
            to = np.searchsorted(reached, head)
            ends = head + own
            pivot = np.where(to < len(reached), reached[np.minimum(to, max(len(reached) - 1, 0))] if len(reached) else 0, len(pair))
            open_ = pivot < ends  # no pivot: no item of the block can reach the threshold any more
            goal = np.where(open_, item[np.minimum(pivot, len(pair) - 1)], -1)
            ready = open_ & (item[head] == goal)
            target = np.repeat(goal, own)
            here = item == target
            score = np.bincount(np.repeat(np.arange(len(head)), own), weights=np.where(here, self.impact[at], 0), minlength=len(head))
            full = np.flatnonzero(ready & (score >= _NEAR))
            out.append((pick[pair[head[full]]], goal[full], score[full]))
            step = np.repeat(ready, own) & here
            at = np.where(step, at + 1, at)
            skip = np.flatnonzero(np.repeat(open_ & ~ready, own) & (item < target))
            at[skip] = np.searchsorted(self.posting, word[skip] * n + target[skip])
            keep = np.repeat(open_, own) & (at < end)
            pair, word, bound, at, end = (x[keep] for x in (pair, word, bound, at, end))
        return [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]

    def verified(self, hashes: np.ndarray, first: np.ndarray, overlap: float) -> list[tuple[int, int, float, float, float]]:
        """(row, item_id, BM25 score, question overlap, answer overlap), the best passage of each."""
        found = self.search(hashes, first)
        best: dict[tuple[int, int], tuple] = {}
        for row, at, item, value in zip(*found, strict=True) if found else ():
            passage = hashes[at : min(at + 2 * self.stride, first[row + 1])]
            q, q_size, a, a_size = self.parts[item]
            shares = [float(np.isin(part, B.windows(passage, k)).mean()) if k else 1.0 for part, k in ((q, q_size), (a, a_size))]
            if min(shares) >= overlap - 1e-12:
                key, new = (int(row), int(self.ids[item])), (float(value * self.need[item]), *shares)
                best[key] = max(best.get(key, new), new)
        return [(*k, *v) for k, v in best.items()]


def _item_words(batches):
    """The distinct words of every item; with a null word its length."""
    for batch in batches:
        hashes, first = tokens(batch.column(1))
        length = np.diff(first)
        of = np.repeat(np.arange(batch.num_rows), length)
        order = np.lexsort((hashes, of))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(hashes[order]) != 0) | (np.diff(of[order]) != 0)
        some, long = order[new], np.flatnonzero(length)
        part = np.asarray(batch.column(0))
        word = pa.array(np.concatenate([hashes[some].view(np.int64), np.zeros(len(long), np.int64)]), mask=np.arange(len(some) + len(long)) >= len(some))
        yield pa.RecordBatch.from_arrays([pa.array(part[np.concatenate([of[some], long])]), word, pa.array(np.concatenate([np.ones(len(some), np.int64), length[long]]))], ["part", "word", "n"])


def index(items: DataFrame, retrieve: float = 0.6, shingle: int = 5) -> Iterator[tuple[list[Shard], bool]]:
    """The shards of one pass over the documents after the other, and whether they are the last; a pass holds items of ``PASS_BYTES`` at most (a longer item alone).

    Shards are built when asked for, so a caller that lets go of a pass before the next one holds one at a time.
    """
    rows = items.filter(F.col("text").isNotNull() & F.col("item_id").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n = max(1, -(-total // PASS_BYTES))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("item_id"), F.lit(n)).cast("int"))
    words = cut(rows.select("part", "text").mapInArrow(B.tidied(_item_words), "part int, word long, n long"))
    count = words.filter("word IS NULL").agg(F.count("*").alias("n"), F.avg("n").alias("mean")).first()
    df = words.filter("word IS NOT NULL").groupBy("word").agg(F.count("*").alias("df"))
    for k in range(n):
        of_pass = words.filter((F.col("part") == k) & F.col("word").isNotNull()).select("word").distinct()
        found = df.join(of_pass, "word").toPandas()  # the words of one pass
        statistics = Statistics(count["n"], count["mean"] or 1.0, found["word"].to_numpy(np.int64).view(np.uint64), found["df"].to_numpy(np.int64))
        some = [(r[0], r[1]) for r in rows.filter(F.col("part") == k).select("item_id", "text").collect()]  # bounded by the bytes of a pass
        size = np.diff(tokens(pa.array([t for _, t in some], pa.string()))[1]).tolist() if some else []
        classes: dict[int, list] = {}
        for _, i, t in sorted((s, i, t) for (i, t), s in zip(some, size, strict=True) if s):
            classes.setdefault(length_class(len(tokens(pa.array([t]))[0]), shingle), []).append((i, t))
        yield [Shard(c[a : a + SHARD_ITEMS], statistics, retrieve, shingle) for c in classes.values() for a in range(0, len(c), SHARD_ITEMS)], k == n - 1


FOUND = "doc_id long, item_id long, bm25 double, question_overlap double, answer_overlap double"


def _search(shards, overlap: float):
    def run(texts: pa.Array):
        offsets = np.cumsum([0, *pc.add(pc.fill_null(pc.binary_length(texts), 0), 1).to_pylist()])
        for a, b in B.parts(offsets, 1 << 20):
            hashes, first = tokens(texts.slice(a, b - a).fill_null(""))
            for shard in shards.value:
                for row, *rest in shard.verified(hashes, first, overlap):
                    yield a + row, *rest

    return run


def contaminated(docs: DataFrame, items: DataFrame, retrieve: float = 0.6, overlap: float = 0.8, shingle: int = 5) -> DataFrame:
    """doc_id, item_id, bm25, question_overlap and answer_overlap of every item that a document holds."""
    out = None
    for shards, last in index(items, retrieve, shingle):
        shared = docs.sparkSession.sparkContext.broadcast(shards)
        del shards  # before the next pass is built
        search = _search(shared, overlap)

        def run(batches, search=search):
            for batch in batches:
                ids, rows = batch.column("doc_id").to_pylist(), list(search(batch.column("text")))
                yield pa.RecordBatch.from_arrays([pa.array([ids[r[0]] for r in rows], pa.int64()), *(pa.array([r[k] for r in rows], t) for k, t in ((1, pa.int64()), (2, pa.float64()), (3, pa.float64()), (4, pa.float64())))], ["doc_id", "item_id", "bm25", "question_overlap", "answer_overlap"])

        found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(B.tidied(run), FOUND)
        if not last:  # what this pass finds is written, so that its shards can go
            found = cut(found)
            shared.destroy()
        out = found if out is None else out.unionByName(found)
    return out


def clean(docs: DataFrame, items: DataFrame, retrieve: float = 0.6, overlap: float = 0.8, shingle: int = 5) -> DataFrame:
    """The rows of ``docs`` that hold no item, as they are."""
    for shards, last in index(items, retrieve, shingle):
        shared = docs.sparkSession.sparkContext.broadcast(shards)
        del shards
        search = _search(shared, overlap)
        text = docs.columns.index("text")

        def run(batches, search=search, text=text):
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                keep[[r[0] for r in search(batch.column(text))]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(B.tidied(run), docs.schema)
        if not last:
            docs = cut(docs)
            shared.destroy()
    return docs
