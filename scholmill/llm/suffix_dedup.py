"""Suffix-array dedup of exact byte strings, by hash-compared suffix sorts of the places that can repeat.

Every ``length``-byte string is owned by an anchor: the leftmost smallest hash of its ``gram``-byte pieces. Equal
strings have equal anchors at equal offsets. A first exchange finds, for each anchor, whether an earlier place
has the same anchor with the same surroundings (all strings the anchor owns): then all of them are repeats.
Only anchors that recur in other surroundings, at the edges of shared passages, are looked at closer: a second
exchange keeps those whose nearer surroundings recur. Of these, every block mergesorts the suffixes with comparisons by prefix
polynomial hashes (the common extension of two suffixes by binary search); runs of neighbours that share ``length`` bytes,
each verified byte by byte, are one string. The earliest of each run meets the other blocks' by two hashes of other kinds
(a polynomial of bytes and one of mixed octets). So a passage that a third of all documents hold comes once from each block.
Every byte covered by a string that starts earlier (smaller doc_id, or same document and
earlier start) is removed; strings are judged on the input.

Null texts are empty, shorter texts stay as they are, rows without doc_id come last, rows with one doc_id count as
one document by start, an empty table gives an empty result, and other columns are left out.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from scholmill.llm import blocks as B


def leftmost_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost smallest value in every window of that width."""
    least, at, size = values, np.arange(len(values), dtype=np.int32), 1
    while size < width:
        step = min(size, width - size)
        right = least[step:]
        left = least[: len(right)]
        take = right < left
        least = np.where(take, right, left)
        at = np.where(take, at[step : step + len(left)], at[: len(left)])
        size += step
    return at


class _Part:
    """Rows a to b of a block: its anchors, the string starts they own (lo to hi) and their hashes."""

    def __init__(self, texts: B.Texts, a: int, b: int, length: int, gram: int, marks: np.ndarray | None = None):
        at = texts.offsets[a : b + 1]
        self.a, self.offsets, self.data = a, at - at[0], texts.data[at[0] : at[-1]]
        self.n, self.length = len(self.data), length
        self.prefix, width = B.Prefix(self.data), length - gram + 1
        if marks is None:
            places = leftmost_minima(self.prefix.all(gram), width)  # of every string, also of those over the end of a row
            own = np.zeros(self.n, bool)
            starts = B.expand(self.offsets[:-1], np.maximum(np.diff(self.offsets) - length + 1, 0))
            own[places[starts]] = True
            self.anchors = np.flatnonzero(own)
        else:
            self.anchors = np.flatnonzero(np.unpackbits(marks, count=self.n))
        p = self.anchors
        self.h = self.prefix.of(p, p + gram)
        self.row = np.searchsorted(self.offsets, p, side="right") - 1
        begin, last = self.offsets[self.row], self.offsets[self.row + 1] - length
        # the next anchor takes over when it comes in with a smaller hash, or else when this one has gone
        self.hi = p.copy()
        if len(p):
            follows = self.row[1:] == self.row[:-1]
            early = follows & (self.h[1:] < self.h[:-1])
            self.hi[:-1] = np.where(early, np.minimum(p[:-1], p[1:] - width), p[:-1])
        self.hi = np.minimum(self.hi, last)
        self.lo = begin.copy()
        if len(p):
            self.lo[1:] = np.where(follows, self.hi[:-1] + 1, begin[1:])
        # the surroundings by mixed octets, as polynomials of bytes can be made to cancel out
        self.octets = B.Prefix(B.octets(self.data))
        self.c = B.mix(self.wide(self.lo, self.hi + length) + (p - self.lo).astype(np.uint64))

    def wide(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of stretches by their octets; of those below eight bytes by bytes."""
        if self.length < 8:
            return self.prefix.of(start, end)
        return self.octets.of(start, np.maximum(end - 7, start))

    def marks(self) -> np.ndarray:
        own = np.zeros(self.n, bool)
        own[self.anchors] = True
        return np.packbits(own)


def _parts(texts: B.Texts, length: int, gram: int, marks: bytes | None = None) -> list[_Part]:
    bits = None if marks is None else np.frombuffer(zlib.decompress(marks), np.uint8)
    out, at = [], 0
    for a, b in texts.parts():
        size = -(-int(texts.offsets[b] - texts.offsets[a]) // 8)
        out.append(_Part(texts, a, b, length, gram, None if bits is None else bits[at : at + size]))
        at += size
    return out


def _keys(texts: B.Texts, parts: list[_Part]):
    """h, c, doc_id and start of all anchors, the order that sorts them so, and which begin a new (h, c)."""
    h, c = np.concatenate([p.h for p in parts]), np.concatenate([p.c for p in parts])
    ids = np.concatenate([texts.ids[p.a + p.row] for p in parts])
    base = np.concatenate([p.lo - p.offsets[p.row] for p in parts])  # start in the document
    order = np.lexsort((base, ids, c, h))  # the earliest of a (h, c) comes first
    new = np.ones(len(h), bool)
    new[1:] = (np.diff(h[order]) != 0) | (np.diff(c[order]) != 0)
    return h, c, ids, base, order, new


def _ask_anchors(length: int, gram: int):
    def ask(table: pa.Table) -> pa.Table:
        texts = B.Texts(table)
        parts = _parts(texts, length, gram)
        h, c, ids, _, order, new = _keys(texts, parts)
        first = order[new]
        keep = zlib.compress(np.concatenate([p.marks() for p in parts]).tobytes(), 1)
        # 48 bits of the anchor meet: where others have the same, strings are looked at for nothing; with 56 of its surroundings
        return B.question(table.column("block")[0].as_py(), h[first] >> np.uint64(16), c[first] >> np.uint64(8), ids[first], keep)

    return ask


def _codes(texts: B.Texts, parts: list[_Part], mail: pa.Table) -> np.ndarray:
    """For every anchor: 1 if all its strings are repeats, 2 if some may be (it has other surroundings elsewhere), 0 if none is."""
    h, _, ids, base, order, new = _keys(texts, parts)
    code = np.ones(len(h), np.uint8)
    of = np.cumsum(new) - 1
    first = order[new][of]
    code[order] = np.where((ids[order] == ids[first]) & (base[order] == base[first]), B.codes(mail, int(new.sum()))[of], 1)
    return code


class _Edges:
    """Of a part: its anchors of code 2, each with the up to ``_SHARES`` stretches that all its strings of nearby offsets hold."""

    def __init__(self, part: _Part, code: np.ndarray, gram: int):
        at = np.flatnonzero(code == 2)
        bounds = np.arange(_SHARES + 1) * (part.length - gram + 1) // _SHARES  # of the anchor's offset in a string
        low, high = (part.anchors[at] - part.hi[at])[:, None], (part.anchors[at] - part.lo[at])[:, None]
        self.part = part
        i, j = np.nonzero((low < bounds[1:]) & (high >= bounds[:-1]))
        self.at, p = at[i], part.anchors[at[i]]
        self.first = np.maximum(part.lo[self.at], p - bounds[j + 1] + 1)
        self.last = np.minimum(part.hi[self.at], p - bounds[j])
        self.keys = B.mix(part.wide(p - bounds[j], p - bounds[j + 1] + 1 + part.length) + j.astype(np.uint64))
        self.row = part.row[self.at]


_SHARES = 4


def _edges(parts: list[_Part], code: np.ndarray, gram: int) -> list[_Edges]:
    return [_Edges(p, c, gram) for p, c in zip(parts, np.split(code, np.cumsum([len(p.anchors) for p in parts])[:-1]), strict=True)]


def _shared(texts: B.Texts, edges: list[_Edges]):
    """Keys and ids of all edges of a block, the first entry of each key, and each entry's number among these."""
    keys = np.concatenate([e.keys for e in edges])
    ids = np.concatenate([texts.ids[e.part.a + e.row] for e in edges])
    return keys, ids, *B.distinct(keys, np.zeros_like(keys), ids)


_NOTHING = tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64))


def _ask_edges(length: int, gram: int):
    def ask(key, docs: pa.Table, mail: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return B.question(0, *_NOTHING)
        texts, marks = B.Texts(docs), B.kept(mail)
        parts = _parts(texts, length, gram, marks)
        code = _codes(texts, parts, mail)
        keys, ids, head, _ = _shared(texts, _edges(parts, code, gram))
        keep = B.pack(np.frombuffer(marks, np.uint8), np.frombuffer(zlib.compress(code.tobytes(), 1), np.uint8))
        return B.question(key[0].as_py(), keys[head] >> np.uint64(16), np.zeros(len(head), np.uint64), ids[head], keep)

    return ask


class _Strings:
    """Of a part: the strings that may repeat, sorted within (anchor, offset); runs of equal ones, by their earliest."""

    def __init__(self, texts: B.Texts, edges: _Edges, live: np.ndarray):
        part, length = edges.part, edges.part.length
        count = (edges.last - edges.first + 1)[live]
        self.places = B.expand(edges.first[live], count)
        anchor = np.repeat(edges.at[live], count)
        row = part.row[anchor]
        self.ids, self.start = texts.ids[part.a + row], self.places - part.offsets[row]
        h, offset = part.h[anchor], part.anchors[anchor] - self.places
        by = np.lexsort((self.start, self.ids, offset, h))
        new = np.ones(len(by), bool)
        new[1:] = (np.diff(h[by]) != 0) | (np.diff(offset[by]) != 0)
        order = by[suffix_sort(part.prefix, part.data, self.places[by], np.cumsum(new) - 1, length)]
        same = np.zeros(len(order), bool)  # as the one before in its group, by hash and then by bytes
        x, y = self.places[order[:-1]], self.places[order[1:]]
        near = np.flatnonzero((part.prefix.of(x, x + length) == part.prefix.of(y, y + length)) & ~new[1:])
        step = np.arange(length)
        for a in range(0, len(near), 10_000):
            k = near[a : a + 10_000]
            same[k + 1] = (part.data[x[k][:, None] + step] == part.data[y[k][:, None] + step]).all(axis=1)
        self.heads = order[~same]  # the sort is stable, so the first of a run is its earliest
        self.run = np.empty(len(order), np.int64)
        self.run[order] = np.cumsum(~same) - 1
        at = self.places[self.heads]
        self.keys = part.prefix.of(at, at + length)
        self.checks = part.wide(at, at + length) & np.uint64(0xFFFFFFFF)  # 96 bits in all


def _strings(texts: B.Texts, edges: list[_Edges], code: np.ndarray) -> list[_Strings]:
    """code: of each distinct edge, whether other blocks have it."""
    _, _, head, of = _shared(texts, edges)
    shared = (np.bincount(of, minlength=len(head)) > 1) | (code != 0)
    return [_Strings(texts, e, x) for e, x in zip(edges, np.split(shared[of], np.cumsum([len(e.keys) for e in edges])[:-1]), strict=True)]


def _runs(strings: list[_Strings]):
    """Key, second hash, doc_id and start of all runs, the order that sorts them so, and which begin a new string."""
    keys, checks = np.concatenate([s.keys for s in strings]), np.concatenate([s.checks for s in strings])
    ids, start = (np.concatenate([getattr(s, k)[s.heads] for s in strings]) for k in ("ids", "start"))
    order = np.lexsort((start, ids, checks, keys))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(keys[order]) != 0) | (np.diff(checks[order]) != 0)
    return keys, checks, ids, start, order, new


def _ask_strings(length: int, gram: int):
    def ask(key, docs: pa.Table, mail: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return B.question(0, *_NOTHING)
        texts = B.Texts(docs)
        marks, codes = B.unpack(B.kept(mail))
        parts = _parts(texts, length, gram, marks.tobytes())
        edges = _edges(parts, np.frombuffer(zlib.decompress(codes.tobytes()), np.uint8), gram)
        shared = B.codes(mail, len(_shared(texts, edges)[2]))
        keys, checks, ids, _, order, new = _runs(_strings(texts, edges, shared))
        first = order[new]
        return B.question(key[0].as_py(), keys[first], checks[first], ids[first], B.pack(marks, codes, np.packbits(shared != 0)))

    return ask


def common_extension(prefix: B.Prefix, x: np.ndarray, y: np.ndarray, most: int) -> np.ndarray:
    """Length of the common prefix of the suffixes at x and y, up to ``most``, by binary search over prefix hashes."""
    low, high = np.zeros(len(x), np.int64), np.full(len(x), most, np.int64)
    while (open_ := low < high).any():
        middle = (low + high + 1) // 2
        same = prefix.of(x, x + middle) == prefix.of(y, y + middle)
        low = np.where(open_ & same, middle, low)
        high = np.where(open_ & ~same, middle - 1, high)
    return low


def _after(prefix: B.Prefix, data: np.ndarray, x: np.ndarray, y: np.ndarray, most: int) -> np.ndarray:
    """Whether the suffix at x sorts after the one at y within ``most`` bytes."""
    same = common_extension(prefix, x, y, most)
    differ = same < most
    return differ & (data[x + np.where(differ, same, 0)] > data[y + np.where(differ, same, 0)])


def suffix_sort(prefix: B.Prefix, data: np.ndarray, places: np.ndarray, group: np.ndarray, most: int) -> np.ndarray:
    """The order that sorts suffixes within each group of neighbours (stable): bottom-up mergesort, all runs of a width at once.

    Each element finds its rank in the other run by binary search, so that a level takes logarithmically many rounds of comparisons.
    """
    n = len(places)
    start = np.searchsorted(group, group, side="left")
    size = np.searchsorted(group, group, side="right") - start
    order, rank, width = np.arange(n), np.arange(n) - start, 1
    while len(live := np.flatnonzero(size > width)):
        own = rank[live] // width  # the run of each sorted place, and the other of its pair
        other = own ^ 1
        low = np.minimum(other * width, size[live])
        first, high = low.copy(), np.minimum(other * width + width, size[live])
        left = (own & 1) == 0
        me = places[order[live]]
        while (open_ := low < high).any():
            middle = np.where(open_, (low + high) // 2, 0)
            them = places[order[start[live] + middle]]
            ahead = np.zeros(len(live), bool)  # whether the other's element comes before mine; equal ones of the left run do
            lefts, rights = np.flatnonzero(open_ & left), np.flatnonzero(open_ & ~left)
            ahead[lefts] = _after(prefix, data, me[lefts], them[lefts], most)
            ahead[rights] = ~_after(prefix, data, them[rights], me[rights], most)
            low = np.where(open_ & ahead, middle + 1, low)
            high = np.where(open_ & ~ahead, middle, high)
        to = start[live] + np.minimum(own, other) * width + rank[live] % width + (low - first)
        moved = order.copy()
        moved[to] = order[live]
        order, width = moved, width * 2
    return order


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"


def _finish(length: int, gram: int, digest: bool):
    def finish(key, docs: pa.Table, mail: pa.Table) -> pa.Table:
        names = ("doc_id", "n_bytes", "n_removed", "n_spans")
        if not docs.num_rows:
            return pa.table({k: pa.array([], pa.int64()) for k in names} | {"kept": pa.array([], pa.binary()), "kept_sha256": pa.array([], pa.string())})
        texts = B.Texts(docs)
        marks, packed, spread = B.unpack(B.kept(mail))
        parts = _parts(texts, length, gram, marks.tobytes())
        code = np.frombuffer(zlib.decompress(packed.tobytes()), np.uint8)
        edges = _edges(parts, code, gram)
        strings = _strings(texts, edges, np.unpackbits(spread, count=len(_shared(texts, edges)[2])))
        _, _, ids, start, order, new = _runs(strings)
        of = np.cumsum(new) - 1
        ahead = B.codes(mail, int(new.sum())) == 1
        first = order[new][of]
        least = np.empty((len(order), 2), np.int64)  # the earliest place of each run's string, in the block
        least[order] = np.stack([ids[first], start[first]], axis=1)
        out = np.empty(len(order), bool)
        out[order] = ahead[of]
        later, seen = [], 0
        for s in strings:
            run = s.run + seen
            seen += len(s.heads)
            gone = out[run] | (s.ids != least[run, 0]) | (s.start != least[run, 1])
            later.append(s.places[gone])
        later = np.concatenate([x + texts.offsets[p.a] for x, p in zip(later, parts, strict=True)])
        lo, hi = (np.concatenate([getattr(p, k) + texts.offsets[p.a] for p in parts]) for k in ("lo", "hi"))
        whole = np.flatnonzero(code == 1)
        edge = np.zeros(len(texts.data) + 1, np.int32)
        for at, to in ((lo[whole], hi[whole] + length), (later, later + length)):
            np.add.at(edge, at, 1)
            np.add.at(edge, to, -1)
        gone = np.cumsum(edge[:-1]) > 0
        begin = gone.copy()  # where a removed run starts; runs end with their rows
        begin[1:] &= ~gone[:-1]
        firsts = texts.offsets[:-1][np.diff(texts.offsets) > 0]
        begin[firsts] = gone[firsts]
        lost, spans = (np.concatenate([[0], np.cumsum(x)])[texts.offsets] for x in (gone, begin))
        n_removed = np.diff(lost)
        rest = [texts.bytes_of(i) if not n_removed[i] else texts.data[s:e][~gone[s:e]].tobytes() for i, (s, e) in enumerate(zip(texts.offsets[:-1], texts.offsets[1:], strict=True))]
        return pa.table({"doc_id": texts.doc_ids(), "n_bytes": pa.array(np.diff(texts.offsets)), "n_removed": pa.array(n_removed.astype(np.int64)), "n_spans": pa.array(np.diff(spans).astype(np.int64)), "kept": pa.array([None] * len(rest) if digest else rest, pa.binary()), "kept_sha256": pa.array([B.sha256(x) for x in rest], pa.string())})

    return finish


def suffix_dedup(docs: DataFrame, length: int = 100, digest: bool = False, block_bytes: int = B.BLOCK_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, ``kept`` (the bytes left; null with ``digest``) and their sha256."""
    gram = max(1, length * 24 // 100)
    dealt, _ = B.dealt(docs, block_bytes)
    anchors = B.answered(dealt.groupBy("block").applyInArrow(_ask_anchors(length, gram), B.ASKED), kinds=True)
    edges = B.answered(dealt.groupBy("block").cogroup(anchors.groupBy("block")).applyInArrow(_ask_edges(length, gram), B.ASKED))
    strings = B.answered(dealt.groupBy("block").cogroup(edges.groupBy("block")).applyInArrow(_ask_strings(length, gram), B.ASKED))
    return dealt.groupBy("block").cogroup(strings.groupBy("block")).applyInArrow(_finish(length, gram, digest), RESULT)
