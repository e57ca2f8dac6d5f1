"""Best-fit packing of token pieces into sequences, after Martello-Toth dominance reduction.

Texts are tokenized and closed with id 0; longer ones are cut into full sequences from their end, so the first piece may
be shorter. How many sequences are needed depends on the piece lengths alone, so the plan is made on the histogram of
lengths, which has at most ``capacity`` rows for any input: first the reduction fixes, from the longest length down, every
set that provably dominates all others its longest piece can be in (alone, with a partner that fills the sequence, with the
largest partner where no two others fit, or with the best two); then best fit, longest first, packs what is left. The plan
is a list of runs (length, ranks, sequences, offset). Pieces of one length are ranked by Spark over salted groups, and a
piece finds its run by its rank. Full pieces need no plan.

Null texts are empty (one token, the closing 0), rows without doc_id are packed as any other, equal rows are packed each, an
empty table gives an empty result, and other columns are left out.
"""

from __future__ import annotations

import json
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scholmill.llm import blocks as B
from scholmill.operators.durable import cut

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Pieces in a salted group of one length, about.
GROUP_ROWS = 8192


class Encoder:
    """Ids of ``tokenizers`` for a byte-level BPE file, by ``tiktoken`` where both provably agree.

    The ranks are read from the same file; both agree where a token's id is its merge rank, on texts without special tokens
    whose characters have one class in every Unicode version.
    """

    _PLAIN = re.compile(r"[\x00-\x7f -ɏ‐-‧€]*")

    def __init__(self, path: str, pattern: str | None):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens") or []]
        self.fast = self._fast(spec, pattern) if pattern else None

    def _fast(self, spec: dict, pattern: str):
        import tiktoken

        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        if spec.get("normalizer") or model.get("type") != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex"):
            return None
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes written as themselves; the others follow from 256
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
        special = set(self.special)
        ranks = {bytes(byte_of[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
        merges = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
        if [model["vocab"][m] for m in merges] != list(range(256, 256 + len(merges))):
            return None
        return tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        if self.fast is not None and self._PLAIN.fullmatch(text) and not any(s in text for s in self.special):
            return self.fast.encode_ordinary(text)
        return self.whole.encode(text, add_special_tokens=False).ids


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str | None) -> Encoder:
    return Encoder(path, pattern)


def _pieces(path: str, pattern: str | None, capacity: int):
    def run(batches):
        encode = encoder(path, pattern).encode
        for batch in batches:
            ids_out, piece, start, length, crc = [], [], [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = np.array([*encode(text or ""), 0], "<u4").tobytes()
                n = len(ids) // 4
                first = n % capacity or capacity
                edges = [0, *range(first, n + 1, capacity)]
                for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                    ids_out.append(doc_id)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(ids[4 * a : 4 * b]))
            yield pa.RecordBatch.from_arrays([pa.array(ids_out, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


class Plan:
    """Runs of a packing: ``count`` pieces of one length from rank ``rank``, one in each sequence from ``seq``, at ``offset``."""

    def __init__(self, histogram: dict[int, int], capacity: int):
        self.capacity, self.count = capacity, np.zeros(capacity + 1, np.int64)
        for w, c in histogram.items():
            self.count[w] = c
        self.rank, self.runs, self.sequences = np.zeros(capacity + 1, np.int64), [], 0
        self.reduced = 0
        self.reduce()
        self.best_fit()

    def _put(self, w: int, n: int, seq: int, offset: int) -> None:
        self.runs.append((w, int(self.rank[w]), n, seq, offset))
        self.rank[w] += n
        self.count[w] -= n

    def _largest(self, most: int, but: int | None = None) -> int:
        """The largest length up to ``most`` that is left, without one piece of length ``but``; 0 if none."""
        sizes = np.flatnonzero(self.count[: max(0, most) + 1])
        for w in sizes[::-1][:2]:
            if w != but or self.count[w] > 1:
                return int(w)
        return 0

    def _smallest(self, k: int, but: int) -> list[int]:
        """The k smallest lengths left, without one piece of length ``but``."""
        out: list[int] = []
        for w in np.flatnonzero(self.count)[: k + 1]:
            out += [int(w)] * int(min(k - len(out), self.count[w] - (w == but)))
            if len(out) >= k:
                break
        return out

    def _dominating(self, w: int) -> list[int] | None:
        """The pieces besides w of a set that dominates all others with w, or None."""
        room = self.capacity - w
        few = self._smallest(3, w)
        if not few or few[0] > room:
            return []
        one = self._largest(room, w)
        if one == room or len(few) < 2 or few[0] + few[1] > room:
            return [one]
        if len(few) > 2 and sum(few) <= room:
            return None
        # no three fit: a single piece as large as any two, or the largest with a second that no pair's smaller one exceeds
        best = max((int(a) + self._largest(room - int(a)) for a in np.flatnonzero(self.count[: room + 1]) if self._largest(room - int(a))), default=0)
        if one >= best:
            return [one]
        second = self._largest(room - one, w if one != w else None)
        enough = self.count[one] - (one == w) - (second == one) > 0
        return [one, second] if second and enough and second >= self._largest(room // 2) else None

    def reduce(self) -> None:
        """Fix dominating sets from the longest length down until a pass fixes none."""
        changed = True
        while changed:
            changed = False
            for w in range(self.capacity, 0, -1):
                while self.count[w] and (others := self._dominating(w)) is not None:
                    need: dict[int, int] = {}
                    for x in [w, *others]:
                        need[x] = need.get(x, 0) + 1
                    n = int(min(self.count[x] // k for x, k in need.items()))
                    at = 0
                    for x in [w, *others]:
                        self._put(x, n, self.sequences, at)
                        at += x
                    self.sequences += n
                    self.reduced += n
                    changed = True

    def best_fit(self) -> None:
        """Longest first, each into the open sequence it leaves least room in; equal sequences move together."""
        open_: dict[int, list[tuple[int, int]]] = {}  # room left: (first sequence, how many)
        for w in range(self.capacity, 0, -1):
            while self.count[w]:
                room = min((r for r in open_ if r >= w), default=None)
                left = int(self.count[w])
                if room is None:
                    each = self.capacity // w
                    for n, k in ((left // each, each), (1, left % each)):
                        if n and k:
                            for i in range(k):
                                self._put(w, n, self.sequences, i * w)
                            open_.setdefault(self.capacity - k * w, []).append((self.sequences, n))
                            self.sequences += n
                    continue
                seq, n = open_[room].pop()
                if not open_[room]:
                    del open_[room]
                take = min(n, left)
                self._put(w, take, seq, self.capacity - room)
                if take < n:
                    open_.setdefault(room, []).append((seq + take, n - take))
                if room > w:
                    open_.setdefault(room - w, []).append((seq, take))


def _salted(part: DataFrame, histogram: dict[int, int]) -> DataFrame:
    """Adds salt: pieces of one length are split into groups of about ``GROUP_ROWS``, those of rare lengths not at all."""
    salts = part.sparkSession.createDataFrame([(w, max(1, n // GROUP_ROWS)) for w, n in histogram.items()], "length long, salts long")
    at = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("salts"))
    return part.join(F.broadcast(salts), "length").withColumn("salt", at).drop("salts")  # at most a row for each length


def pack(docs: DataFrame, path: str, pattern: str | None = None, capacity: int = 2048) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece.

    path: a tokenizer file that every executor has; pattern: its word pattern, for the faster of two equal encoders.
    """
    spark = docs.sparkSession
    pieces = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(B.tidied(_pieces(path, pattern, capacity)), PIECES))
    full = pieces.filter(F.col("length") == capacity)
    part = pieces.filter(F.col("length") < capacity)
    histogram = {r["length"]: r["n"] for r in part.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most capacity rows
    plan = Plan(histogram, capacity)
    runs = np.array(sorted(plan.runs), np.int64).reshape(-1, 5)
    shared = spark.sparkContext.broadcast(runs)  # bounded by the lengths and rooms there can be, not by the input

    def placed(batches):
        table = shared.value
        keys = table[:, 0] * (1 << 44) + table[:, 1]
        for b in batches:
            length, rank = (np.asarray(b.column(k), np.int64) for k in ("length", "rank"))
            at = np.searchsorted(keys, length * (1 << 44) + rank, side="right") - 1
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(table[at, 3] + rank - table[at, 1]), pa.array(table[at, 4])], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    salted = _salted(part, histogram)
    order = Window.partitionBy("length").orderBy("salt")
    before = salted.groupBy("length", "salt").agg(F.count("*").alias("n")).withColumn("before", F.sum("n").over(order) - F.col("n")).drop("n")
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("k", F.row_number().over(own)).join(before, ["length", "salt"]).withColumn("rank", F.col("before") + F.col("k") - 1)
    done = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(placed, PIECES + ", sequence_id long, offset long")
    alone = full.select("*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return done.unionByName(alone)
