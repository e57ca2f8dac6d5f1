"""Approximate nearest neighbours by inner product, with a permutation index.

Pivots are vectors of the table, those with the smallest hashes of their ids; their number grows with the root of the table's (64 at least,
``MOST_PIVOTS`` at most). Every vector is represented by its ``prefix`` nearest pivots in order, and posted in the inverted files of the
``posts`` nearest ones. A query visits the files of its own nearest pivots (``posts`` of them at least), ranks what is posted there by
footrule distance (the sum of the differences of each pivot's place in both orders; no place counts as more than ``2 * prefix`` off), and reranks
the best ``share`` of each file by inner products of the original vectors in double precision. Equal distances are ordered by id, so a task that
runs again finds the same. A vector that stands in several visited files counts in the one nearest to the query. Vectors of
unequal length get one more coordinate that makes their lengths equal, which turns the largest inner product into the smallest angle.

How many files are visited and what share of them is reranked is settled by a recall check before: the true neighbours of ``checked``
queries, those with the smallest hashes, are found among all entries, with the file that each would be met in and its rank by footrule
there. Visits and share grow from the given values until a share of ``recall`` of these neighbours is found. All files and the whole of
each are the end of that, which is exact, so no structure of the table (dense clusters, uneven lengths) leaves it without an answer.
The check is a mean over the checked queries; single queries can have less.

Equal vectors are one entry of the index with its smallest ids, as many as can be in a result, so copies of a vector are no hot list.
A long inverted file is split into salted parts of ``part_rows`` entries and of ``part_rows`` queries, each part of one kind meeting each of
the other, so that no task holds all entries or all queries of a pivot.

Rows with a null id take no part, nor do vectors that are null, zero, or hold null or non-finite components. Shorter vectors count as
followed by zeros. Of rows with one id the smallest vector counts. Equal scores are ordered by id. An empty table gives an empty
result; other columns are left out.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scholmill.operators.durable import cut

MOST_PIVOTS = 4096


def usable(table: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(id, vector) of the rows that take part, each id once, in the precision of the table."""
    v = F.col("vector")
    kind = "float" if dict(table.dtypes)[embedding] == "array<float>" else "double"
    zero = F.lit(0.0).cast(kind)
    rows = table.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).cast(f"array<{kind}>").alias("vector")).filter(F.col("id").isNotNull() & v.isNotNull())
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(finite & F.exists(v, lambda x: x != 0)).withColumn("vector", F.transform(v, lambda x: F.when(x == 0, zero).otherwise(x)))
    size = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    rows = rows.withColumn("vector", F.concat("vector", F.array_repeat(zero, F.lit(size) - F.size("vector"))))
    return rows.groupBy("id").agg(F.min("vector").alias("vector"))


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    return np.asarray(column.flatten()).astype(float).reshape(n, -1) if n else np.zeros((0, 0))


class Index:
    """The pivots, and how vectors are represented by them."""

    def __init__(self, pivots: np.ndarray, longest: float, posts: int, prefix: int):
        self.pivots, self.longest = pivots, longest
        self.prefix = min(prefix, len(pivots))
        self.posts = min(posts, len(pivots))

    def orders(self, x: np.ndarray, n: int, is_query: bool = False):
        """The n nearest pivots of each vector, the nearest first, some vectors at a time: (start, orders). Queries are scaled to the longest length."""
        pivots = self.pivots / self.longest
        pivot_rest = np.sqrt(np.maximum(0, 1 - (pivots * pivots).sum(1)))
        step = max(1, (1 << 20) // max(1, len(pivots)))
        for a in range(0, len(x), step):
            y = x[a : a + step]
            y = y / (np.sqrt((y * y).sum(1, keepdims=True)) if is_query else self.longest)
            near = y @ pivots.T
            if not is_query:
                near += np.sqrt(np.maximum(0, 1 - (y * y).sum(1)))[:, None] * pivot_rest
            yield a, np.argsort(-near, axis=1, kind="stable")[:, :n].astype(np.int16)

    def order(self, x: np.ndarray, n: int, is_query: bool = False) -> np.ndarray:
        found = [o for _, o in self.orders(x, n, is_query)]
        return np.concatenate(found) if found else np.zeros((0, n), np.int16)

    def places(self, x: np.ndarray) -> np.ndarray:
        """The place of every pivot in the order of a query."""
        order = self.order(x, len(self.pivots), True)
        out = np.empty_like(order)
        np.put_along_axis(out, order.astype(np.int64), np.arange(order.shape[1], dtype=np.int16)[None, :], axis=1)
        return out

    def footrule(self, own: np.ndarray, order: np.ndarray) -> np.ndarray:
        """Distance of entries' prefixes from the order with these places."""
        return np.minimum(np.abs(own[order] - np.arange(order.shape[1], dtype=np.int16)), np.int16(2 * self.prefix)).sum(1, dtype=np.int32)

    def met(self, own: np.ndarray, order: np.ndarray) -> np.ndarray:
        """The place, in a query's order, of the file each entry counts in."""
        return own[order[:, : self.posts]].min(1)


POSTED = "pivot int, part int, part_q int, entry long, vector array<{}>, near array<short>"
ASKED = "pivot int, part int, part_q int, entry long, vector array<{}>"
FOUND = "query long, entry long, score double"
TRUE = "query int, entry long, score double, place int, footrule int"
RANKED = "hit int, below long, size long"


def _true(checked, k: int):
    """The best k entries of each batch for every checked query, other than itself."""

    def run(batches):
        index, ids, asked = checked.value
        places = index.places(asked)
        for batch in batches:
            entry, x = np.asarray(batch.column("entry")), _matrix(batch.column("vector"))
            if not len(entry):
                continue
            out = []
            for i, score in enumerate(asked @ x.T):
                best = np.argpartition(-score, k)[: k + 1] if len(score) > k + 1 else np.arange(len(score))
                best = best[entry[best] != ids[i]]
                order = index.order(x[best], index.prefix)
                out.append((np.full(len(best), i), entry[best], score[best], index.met(places[i], order), index.footrule(places[i], order)))
            columns = [np.concatenate(o) for o in zip(*out, strict=True)]
            types = (pa.int32(), pa.int64(), pa.float64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(columns, types, strict=True)], ["query", "entry", "score", "place", "footrule"])

    return run


def _ranked(checked, hits):
    """For each true neighbour (query, place, footrule), how many entries of its file come no later than it, and how many there are."""

    def run(batches):
        (index, ids, asked), (query, place, footrule) = checked.value, hits.value
        places = index.places(asked)
        below, size = np.zeros(len(query), np.int64), np.zeros(len(query), np.int64)
        for batch in batches:
            for _, order in index.orders(_matrix(batch.column("vector")), index.prefix):
                for i in range(len(ids)):
                    at, f = index.met(places[i], order), index.footrule(places[i], order)
                    for h in np.flatnonzero(query == i):
                        same = at == place[h]
                        size[h] += same.sum()
                        below[h] += (same & (f <= footrule[h])).sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(query)), pa.int32()), pa.array(below), pa.array(size)], ["hit", "below", "size"])

    return run


def _settle(entries: DataFrame, searched: DataFrame, index: Index, k: int, share: float, recall: float, checked: int) -> tuple[int, float]:
    """Visits and share that find ``recall`` of the true neighbours of the checked queries with the least work."""
    picked = searched.orderBy(F.xxhash64("entry"), "entry").limit(checked).collect()  # at most ``checked`` rows
    if not picked:
        return index.posts, share
    context = entries.sparkSession.sparkContext
    shared = context.broadcast((index, np.array([r["entry"] for r in picked]), np.array([r["vector"] for r in picked], float)))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "entry")
    true = entries.select("entry", "vector").mapInArrow(_true(shared, k), TRUE).withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k).collect()  # at most k for each checked query
    if not true:
        return index.posts, share
    query, place, footrule = (np.array([r[c] for r in true]) for c in ("query", "place", "footrule"))
    hits = context.broadcast((query, place, footrule))
    ranks = entries.select("entry", "vector").mapInArrow(_ranked(shared, hits), RANKED).groupBy("hit").agg(F.sum("below").alias("below"), F.sum("size").alias("size")).collect()  # one row for each true neighbour
    below, size = np.zeros(len(true)), np.zeros(len(true))
    for r in ranks:
        below[r["hit"]], size[r["hit"]] = r["below"], r["size"]
    shares = [share]
    while shares[-1] < 1:
        shares.append(min(1.0, 2 * shares[-1]))
    most = len(index.pivots)
    fits = [(v * (0.5 + s), v, s) for s in shares for v in range(index.posts, most + 1) if ((place < v) & ((s >= 1) | (below <= s * size))).mean() >= recall]
    return min(fits)[1:] if fits else (most, 1.0)


def _files(index, visits: int, parts: dict[int, tuple[int, int]] | None, is_query: bool):
    """Rows of the inverted files: an entry or a query of one part goes to all parts of the other kind. Without ``parts`` only the pivots."""

    def run(batches):
        ix = index.value
        for batch in batches:
            entry, x = np.asarray(batch.column("entry")), _matrix(batch.column("vector"))
            for a, order in ix.orders(x, max(visits, 0 if is_query else ix.prefix), is_query):
                pivot, at = order[:, :visits].ravel().astype(np.int32), a + np.repeat(np.arange(len(order)), visits)
                if parts is None:
                    yield pa.RecordBatch.from_arrays([pa.array(pivot)], ["pivot"])
                    continue
                sizes = np.array([parts.get(int(p), (0, 0)) for p in pivot]).reshape(-1, 2)
                live = (sizes > 0).all(1)  # files without queries, or without entries, are left out
                pivot, at, sizes = pivot[live], at[live], sizes[live]
                own, others = sizes[:, 1 if is_query else 0], sizes[:, 0 if is_query else 1]
                salt = (entry[at] * 0x9E3779B1 % 2**61) % np.maximum(own, 1)
                other = np.concatenate([np.arange(i) for i in others]) if len(others) else others
                pivot, at, salt = (np.repeat(v, others) for v in (pivot, at, salt))
                part, part_q = (other, salt) if is_query else (salt, other)
                for b in range(0, len(at), 4096):
                    s = slice(b, b + 4096)
                    rows = [pa.array(pivot[s]), pa.array(part[s].astype(np.int32)), pa.array(part_q[s].astype(np.int32)), pa.array(entry[at[s]]), batch.column("vector").take(pa.array(at[s]))]
                    yield pa.RecordBatch.from_arrays(rows + ([] if is_query else [pa.array(list(order[at[s] - a]), pa.list_(pa.int16()))]), ["pivot", "part", "part_q", "entry", "vector"] + ([] if is_query else ["near"]))

    return run


def _visit(index, share: float, top: int):
    """Of a part of an inverted file: each query's best entries."""

    def run(key, posted: pa.Table, queries: pa.Table) -> pa.Table:
        empty = pa.table({"query": pa.array([], pa.int64()), "entry": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        if not posted.num_rows or not queries.num_rows:
            return empty
        ix, pivot = index.value, key[0].as_py()
        posted = posted.sort_by("entry")
        entry, x = np.asarray(posted.column("entry")), _matrix(posted.column("vector"))
        order = np.asarray(posted.column("near").combine_chunks().flatten()).reshape(len(entry), -1)
        asked, vectors, out = np.asarray(queries.column("entry")), _matrix(queries.column("vector")), []
        for a in range(0, len(asked), 256):
            for query, q, own in zip(asked[a : a + 256], vectors[a : a + 256], ix.places(vectors[a : a + 256]), strict=True):
                # entries that stand in a file nearer to the query count there
                fresh = np.flatnonzero(ix.met(own, order) == own[pivot])
                n = int(np.ceil(share * len(fresh)))
                if len(fresh) > n:
                    # by footrule, then by entry: each number stands once
                    rank = ix.footrule(own, order[fresh]).astype(np.int64) * len(fresh) + np.arange(len(fresh))
                    fresh = np.sort(fresh[np.argpartition(rank, n - 1)[:n]])
                score = (x[fresh] * q).sum(1)
                best = np.lexsort((entry[fresh], -score))[:top]
                out.append((np.full(len(best), query), entry[fresh[best]], score[best]))
        query, found, score = (np.concatenate(c) for c in zip(*out, strict=True))
        return pa.table({"query": query, "entry": found, "score": score})

    return run


def nearest(table: DataFrame, queries, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding", pivots: int | None = None, posts: int = 10, prefix: int = 32, share: float = 0.2, part_rows: int = 8192, recall: float = 0.95, checked: int = 128) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k nearest found for each row that meets the condition ``queries`` on ``id``.

    ``pivots``: how many, if not by the table's size.
    """
    context = table.sparkSession.sparkContext
    rows = cut(usable(table, vec_id, embedding))
    kind = dict(rows.dtypes)["vector"].removeprefix("array<").removesuffix(">")
    by_id = Window.partitionBy("vector").orderBy("id")
    few = rows.withColumn("n", F.row_number().over(by_id)).filter(F.col("n") <= k + 1)
    entries = cut(few.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids")).select(F.col("ids")[0].alias("entry"), "ids", "vector"))
    asked = cut(rows.filter(queries).join(entries.select("entry", "vector"), "vector").select(F.col("id").alias("query_id"), F.col("entry").alias("query")))
    searched = entries.join(asked.select(F.col("query").alias("entry")).distinct(), "entry", "left_semi").select("entry", "vector")
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    seen = entries.agg(F.max(length).alias("longest"), F.count("*").alias("n")).first()
    number = pivots or min(MOST_PIVOTS, max(64, math.isqrt(seen["n"])))
    sample = np.array([r[0] for r in entries.orderBy(F.xxhash64("entry"), "entry").limit(number).select("vector").collect()], float)  # at most MOST_PIVOTS rows
    index = Index(sample, float(seen["longest"] or 1.0) * (1 + 1e-12), posts, prefix)
    visited, share = _settle(entries, searched, index, k, share, recall, checked) if len(sample) else (posts, share)
    shared = context.broadcast(index)
    narrow = entries.select("entry", "vector")
    counts: dict[int, list[int]] = {}
    for i, (side, visits) in enumerate(((narrow, index.posts), (searched, visited))):
        for r in side.mapInArrow(_files(shared, visits, None, i == 1), "pivot int").groupBy("pivot").count().collect():  # one row for each pivot
            counts.setdefault(r["pivot"], [0, 0])[i] = -(-r["count"] // part_rows)
    parts = {p: tuple(n) for p, n in counts.items()}
    posted = narrow.mapInArrow(_files(shared, index.posts, parts, False), POSTED.format(kind))
    visits = searched.mapInArrow(_files(shared, visited, parts, True), ASKED.format(kind))
    keys = ["pivot", "part", "part_q"]
    found = posted.groupBy(*keys).cogroup(visits.groupBy(*keys)).applyInArrow(_visit(shared, share, k + 1), FOUND)
    best = Window.partitionBy("query").orderBy(F.desc("score"), "entry")
    top = found.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k + 1)
    ids = top.join(entries.select("entry", "ids"), "entry").select("query", "score", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    listed = ids.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k + 1).groupBy("query").agg(F.array_sort(F.collect_list(F.struct("n", "vec_id", "score"))).alias("near"))
    own = asked.join(listed, "query").select("query_id", F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k).alias("near"))
    return own.select("query_id", F.posexplode("near").alias("rank", "hit")).select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), "hit.vec_id", "hit.score")
