"""Substring dedup by difference-cover anchors.

Two occurrences of one ``window``-word passage start at any word of their documents. A difference cover D of the
residues modulo a period v has, for every pair of starts, a shift below v that takes both to places of D. So it is
enough to hash the ``window - v + 1`` words that start at places of D: equal passages share an aligned anchor.
Anchors that other documents hold too are extended to every full window around them; windows (and whole texts, so that copies need no
windows) are equal by two 64-bit hashes of other seeds, and every word of a window that a document with a smaller doc_id holds is removed.
Windows are judged on the input. Hashes mix at every step instead of summing a polynomial, so texts of a pattern don't cancel out.

Null texts count as empty, texts below ``window`` words stay as they are, rows without doc_id come after all
others, rows with one doc_id never remove words from each other, an empty table gives an empty result, and
other columns are left out.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from scholmill.llm import blocks as B

#: Perfect difference sets, every nonzero residue of the period once as a difference.
COVERS = {7: (1, 2, 4), 13: (0, 1, 3, 9), 21: (3, 6, 7, 12, 14), 31: (1, 5, 11, 24, 25, 27)}


def difference_cover(window: int) -> tuple[int, tuple[int, ...]]:
    """The longest period whose anchors keep at least a third of the window."""
    period = max((v for v in COVERS if window - v + 1 >= max(1, window // 3)), default=1)
    return period, COVERS.get(period, (0,))


class _Block:
    """Word hashes, anchors and windows of the rows from a to b of a block."""

    def __init__(self, texts: B.Texts, a: int, b: int, window: int):
        self.a, self.window = a, window
        self.period, cover = difference_cover(window)
        at = texts.offsets[a : b + 1]
        hashes, self.first, _, self.others = B.words(at - at[0], texts.data[at[0] : at[-1]], twice=True)
        self.n_words = np.diff(self.first)
        self.hashes, self.n = hashes, len(hashes)
        size = window - self.period + 1
        doc = np.repeat(np.arange(b - a), self.n_words)
        place = np.arange(self.n) - self.first[doc]
        keep = np.isin(place % self.period, cover) & (place + size <= self.n_words[doc]) & (self.n_words[doc] >= window)
        self.anchor = np.flatnonzero(keep)
        self.doc = doc
        long = np.flatnonzero(self.n_words >= window)  # a copy of a whole text needs no windows
        anchors = B.windows(hashes, size)
        whole = [B.sequences(x, self.first, seed)[long] for seed, x in ((1, hashes), (2, self.others))]
        self.keys = np.concatenate([anchors[self.anchor], whole[0]])
        self.checks = np.concatenate([np.zeros(len(self.anchor), np.uint64), whole[1]])
        self.row = np.concatenate([doc[self.anchor], long])

    def windows(self, flags: np.ndarray) -> np.ndarray:
        """Starts of the windows that hold a flagged anchor, but of texts that are copies of another."""
        n = len(self.anchor)
        shared = self.anchor[flags[:n]]
        starts = np.maximum(shared - self.period + 1, self.first[self.doc[shared]])
        edge = np.zeros(self.n + 1, np.int32)
        np.add.at(edge, starts, 1)
        np.add.at(edge, shared + 1, -1)
        ok = np.cumsum(edge[:-1]) > 0
        last = self.first[1:][self.doc] - self.window
        ok &= np.arange(self.n) <= last
        ok &= ~self.copies(flags)[self.doc]
        return np.flatnonzero(ok)

    def prints(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of the windows from these words on, each of its own hash of the words' bytes."""
        if not len(starts):
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        return B.windows(self.hashes, self.window)[starts], B.windows(self.others, self.window)[starts]

    def copies(self, flags: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.n_words), bool)
        out[self.row[len(self.anchor) :]] = flags[len(self.anchor) :]
        return out


def _blocks(texts: B.Texts, window: int) -> list[_Block]:
    return [_Block(texts, a, b, window) for a, b in texts.parts()]


def _entries(texts: B.Texts, found: list[_Block]):
    """Keys, checks and ids of all anchors and long texts of a block."""
    keys, checks = (np.concatenate([getattr(p, c) for p in found]) for c in ("keys", "checks"))
    return keys, checks, np.concatenate([texts.ids[p.a + p.row] for p in found])


def _ask_anchors(window: int):
    def ask(table: pa.Table) -> pa.Table:
        texts = B.Texts(table)
        keys, checks, ids = _entries(texts, _blocks(texts, window))
        head, _ = B.distinct(keys, checks, ids)
        return B.question(table.column("block")[0].as_py(), keys[head], checks[head], ids[head])

    return ask


def _flags(texts: B.Texts, window: int, mail: pa.Table) -> list[tuple[_Block, np.ndarray, np.ndarray]]:
    """Of each part: the entries whose key another document holds, and those whose key a smaller doc_id holds."""
    found = _blocks(texts, window)
    keys, checks, ids = _entries(texts, found)
    head, of = B.distinct(keys, checks, ids)
    code, least = B.codes(mail, len(head))[of], ids[head][of]
    most = np.full(len(head), np.iinfo(np.int64).min)
    np.maximum.at(most, of, ids)
    cut = np.cumsum([len(p.keys) for p in found])[:-1]
    return list(zip(found, np.split((code != 0) | (most[of] > least), cut), np.split((code == 1) | (ids > least), cut), strict=True))


def _windows(texts: B.Texts, parts: list[tuple[_Block, np.ndarray]]):
    """Starts of the windows of each part; keys, checks and ids of all."""
    starts = [p.windows(flags) for p, flags in parts]
    prints = [p.prints(at) for (p, _), at in zip(parts, starts, strict=True)]
    ids = np.concatenate([texts.ids[p.a + p.doc[at]] for (p, _), at in zip(parts, starts, strict=True)])
    return starts, np.concatenate([x for x, _ in prints]), np.concatenate([x for _, x in prints]), ids


def _ask_windows(window: int):
    def ask(key, docs: pa.Table, mail: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return B.question(0, *(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64)))
        texts = B.Texts(docs)
        parts = [(p, np.concatenate([shared[: len(p.anchor)], smaller[len(p.anchor) :]])) for p, shared, smaller in _flags(texts, window, mail)]
        _, keys, checks, ids = _windows(texts, parts)
        head, _ = B.distinct(keys, checks, ids)
        return B.question(key[0].as_py(), keys[head], checks[head], ids[head], B.pack(np.concatenate([np.packbits(flags) for _, flags in parts])))

    return ask


RESULT = "doc_id long, n_words long, n_removed long, kept string"


def _finish(window: int, digest: bool):
    def finish(key, docs: pa.Table, mail: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return pa.table({"doc_id": pa.array([], pa.int64()), "n_words": pa.array([], pa.int64()), "n_removed": pa.array([], pa.int64()), "kept": pa.array([], pa.string())})
        texts = B.Texts(docs)
        marks = B.unpack(B.kept(mail))[0]
        parts, at_mark = [], 0
        for part in _blocks(texts, window):
            size = -(-len(part.keys) // 8)
            parts.append((part, np.unpackbits(marks[at_mark : at_mark + size])[: len(part.keys)].astype(bool)))
            at_mark += size
        starts, keys, checks, ids = _windows(texts, parts)
        head, of = B.distinct(keys, checks, ids)
        later = (ids > ids[head][of]) | (B.codes(mail, len(head))[of] == 1)
        seen = 0
        n_words, n_removed, texts_out = [], [], []
        for (part, flags), at in zip(parts, starts, strict=True):
            gone = B.covered(at[later[seen : seen + len(at)]], window, part.n) | part.copies(flags)[part.doc]
            seen += len(at)
            lost = np.concatenate([[0], np.cumsum(gone)])
            for i in range(len(part.n_words)):
                s, e = part.first[i], part.first[i + 1]
                own = texts.bytes_of(part.a + i).split()
                removed = int(lost[e] - lost[s])
                if removed:
                    own = compress(own, ~gone[s:e])
                n_words.append(int(e - s))
                n_removed.append(removed)
                rest = b" ".join(own)
                texts_out.append(B.sha256(rest) if digest else rest.decode("utf-8", "replace"))
        return pa.table({"doc_id": texts.doc_ids(), "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "kept": pa.array(texts_out, pa.string())})

    return finish


def substring_dedup(docs: DataFrame, window: int = 50, digest: bool = False, block_bytes: int = B.BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed and ``kept``: the words kept, joined by a space (their sha256 with ``digest``)."""
    dealt, _ = B.dealt(docs, block_bytes)
    answers = B.answered(dealt.groupBy("block").applyInArrow(_ask_anchors(window), B.ASKED))
    windows = B.answered(dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_ask_windows(window), B.ASKED))
    return dealt.groupBy("block").cogroup(windows.groupBy("block")).applyInArrow(_finish(window, digest), RESULT)
