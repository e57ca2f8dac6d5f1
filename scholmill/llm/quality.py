"""Quality scores by Bradley-Terry ranking of labelled documents.

A document of label 1 is preferred to one of label 0; the chance that i is preferred to j is the logistic function of w . (x_i - x_j).
The weights minimize the logistic loss over preference pairs, each document of a bounded sample of labelled rows
(``sample_rows``, those with the smallest hashes) meeting several of the other label. Features are shares of kinds of
characters, words and lines of the whole text. Only the weights come from the sample: the threshold is the quantile of the scores of all labelled
rows of the training table that leaves as large a part below as label 0 has; scores are shifted so that the threshold is ``cut`` after the logistic
function.

Null texts count as empty and get the score of an empty text; rows with a null or other label teach nothing; without both labels every score is
``cut``; equal rows are scored each; rows without doc_id are scored, not held out; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholmill.llm import blocks as B
from scholmill.operators.durable import written
from scholmill.operators.quantiles import Rank, settle

SAMPLE_ROWS = 20_000
PAIRS_EACH = 8

_KINDS = ("lower", "upper", "digit", "high", "space", "newline", "stop", "comma", "shout", "bar", "quote", "other")


def _kinds() -> np.ndarray:
    of = np.full(256, _KINDS.index("other"), np.int64)
    for name, chars in (("lower", range(97, 123)), ("upper", range(65, 91)), ("digit", range(48, 58)), ("high", range(128, 256)), ("space", b" \t\r"), ("newline", b"\n"), ("stop", b".;:?"), ("comma", b","), ("shout", b"!"), ("bar", b"|"), ("quote", b"'\"-()")):
        of[list(chars)] = _KINDS.index(name)
    return of


_KIND = _kinds()


def features(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """One row of features for each text."""
    n, size = len(offsets) - 1, np.diff(offsets)
    row = np.repeat(np.arange(n), size)
    kinds = np.bincount(row * len(_KINDS) + _KIND[data], minlength=n * len(_KINDS)).reshape(n, len(_KINDS)).astype(float)
    shares = kinds / np.maximum(size, 1)[:, None]
    hashes, first, starts = B.words(offsets, data)
    n_words = np.diff(first)
    of = np.repeat(np.arange(n), n_words)
    many = np.maximum(n_words, 1)
    per = lambda mask: np.bincount(of[mask], minlength=n) / many
    inside = ~B.SPACE[data]
    close = inside.copy()  # the last byte of each word
    close[:-1] &= ~inside[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    close[inner - 1] = inside[inner - 1]
    ends = np.flatnonzero(close) + 1
    length = ends - starts
    keys = B.mix(hashes + of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    same = np.zeros(len(keys), bool)
    same[1:] = keys[1:] == keys[:-1]
    order = np.sort(keys)
    lone = np.unique(keys, return_index=True)[1] if len(order) else np.zeros(0, int)
    distinct = np.bincount(of[lone], minlength=n) / many
    head = _KIND[data[starts]] if len(starts) else starts
    tail = _KIND[data[ends - 1]] if len(starts) else starts
    lines = kinds[:, _KINDS.index("newline")] + 1
    found = np.column_stack([
        shares, np.sqrt(shares),
        distinct, distinct * np.log1p(n_words), per(same), np.sqrt(per(same)),
        per(length <= 3), per(length >= 12), np.bincount(of, weights=length, minlength=n) / many,
        per(head == _KINDS.index("upper")), per(tail == _KINDS.index("other")), per(tail == _KINDS.index("shout")), per(head == _KINDS.index("bar")),
        np.log1p(n_words), np.log1p(size), np.log1p(lines), np.log1p(n_words / lines), n_words == 0,
    ])
    return found.astype(float)


def _vectors(carry: int):
    def run(batches):
        for batch in batches:
            text = batch.column(carry).fill_null("")
            offsets, data = B.utf8(text)
            for a, b in B.parts(offsets, 1 << 20):
                x = features(offsets[a : b + 1] - offsets[a], data[offsets[a] : offsets[b]])
                yield [c.slice(a, b - a) for c in batch.columns[:carry]], x

    return run


class Ranker:
    """Weights of a Bradley-Terry model, and the shift of its scores."""

    def __init__(self, x: np.ndarray, y: np.ndarray, cut: float, pairs_each: int = PAIRS_EACH, ridge: float = 1.0):
        self.cut = cut
        self.mean = x.mean(0) if len(x) else np.zeros(0)
        self.scale = np.maximum(x.std(0), 1e-6) if len(x) else np.ones(0)
        good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
        self.weights, self.threshold = None, 0.0
        if not len(good) or not len(bad):
            return
        z = self._standard(x)
        k = np.arange(max(len(good), len(bad)) * pairs_each)
        turn = k // max(len(good), len(bad))  # every document of the larger label meets another partner each turn
        rng = np.random.default_rng(7)
        good, bad = rng.permutation(good), rng.permutation(bad)
        d = z[good[(k + turn * 17) % len(good)]] - z[bad[(k + turn * 31) % len(bad)]]
        w = np.zeros(d.shape[1])
        for _ in range(30):  # Newton's method
            p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))
            grad = d.T @ p - ridge * w
            hess = (d * (p * (1 - p))[:, None]).T @ d + ridge * np.eye(len(w))
            step = np.linalg.solve(hess, grad)
            w += step
            if np.abs(step).max() < 1e-4:
                break
        self.weights = w

    def _standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self._standard(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.cut)
        s = self.raw(x) - self.threshold + math.log(self.cut / (1 - self.cut))
        return 1 / (1 + np.exp(-np.clip(s, -30, 30)))


def _code(x: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of finite scores."""
    bits = (x + 0.0).view(np.int64)
    return bits ^ ((bits >> 63) & np.int64(2**63 - 1))


def _decoded(code: np.ndarray) -> np.ndarray:
    return (code ^ ((code >> 63) & np.int64(2**63 - 1))).view(np.float64)


def train(rows: DataFrame, labels: DataFrame, label: str = "quality", cut: float = 0.3, sample_rows: int = SAMPLE_ROWS) -> Ranker:
    """A ranker from ``labels`` (doc_id and the label) and the texts of ``rows``; at most ``sample_rows`` labelled rows fit its weights."""
    picked = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).distinct()
    texts = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sample = picked.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(sample_rows)
    sampled = texts.join(F.broadcast(sample), "doc_id").select("y", "doc_id", "text")

    def run(batches):
        for (y, ids), x in _vectors(2)(batches):
            yield pa.RecordBatch.from_arrays([y, ids, pa.array(list(x), pa.list_(pa.float64()))], ["y", "doc_id", "x"])

    # repeated rows of a doc_id are bounded here too
    found = sampled.mapInArrow(run, "y int, doc_id long, x array<double>").orderBy("doc_id", "y").limit(2 * sample_rows).collect()
    x = np.array([r.x for r in found]) if found else np.zeros((0, 0))
    ranker = Ranker(x, np.array([r.y for r in found]), cut)
    if ranker.weights is None:
        return ranker

    def scores(batches):
        for (ids,), x in _vectors(1)(batches):
            yield pa.RecordBatch.from_arrays([ids, pa.array(_code(ranker.raw(x)))], ["doc_id", "code"])

    # texts are scored where they are read, and only ids and scores meet the labels; the two scores around the threshold are exact order statistics of all labelled texts
    every = written(texts.mapInArrow(scores, "doc_id long, code long").join(picked, "doc_id").select("y", "code")).withColumn("all", F.lit(0))
    count = every.groupBy("all").agg(F.count("*").alias("n"), F.count_if(F.col("y") == 0).alias("bad"))
    at = "least(greatest(bad, 1L), greatest(n - 1, 1L))"  # so many scores stand below the threshold
    found = settle(count, every, ["all"], [Rank("below", "code", at), Rank("above", "code", f"least({at} + 1, n)")]).first()
    ranker.threshold = float(_decoded(np.array([found.below, found.above])).mean())
    return ranker


def score(docs: DataFrame, ranker: Ranker, carry: tuple[str, ...] = ()) -> DataFrame:
    """The columns named in ``carry``, then score and predicted (1 from ``cut`` on)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    shared = docs.sparkSession.sparkContext.broadcast(ranker)  # some hundred numbers
    schema = docs.select(*carry, F.lit(0.0).alias("score"), F.lit(0).alias("predicted")).schema
    arrow = to_arrow_schema(schema)

    def run(batches):
        r = shared.value
        for columns, x in _vectors(len(carry))(batches):
            s = r.score(x)
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip([*columns, pa.array(s), pa.array((s >= r.cut).astype(np.int32))], arrow, strict=True)], schema=arrow)

    return docs.select(*carry, F.col("text").alias("__text")).mapInArrow(run, schema)
