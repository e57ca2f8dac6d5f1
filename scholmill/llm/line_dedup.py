"""Line dedup by winnowing over line hashes.

Lines are what ``\\n`` parts. A run is what can repeat: ``min_lines`` lines in a row; one line, or fewer than ``min_lines``, of ``min_words``
words or more; and a whole text of fewer lines with at least a word. Fingerprints are guaranteed for each: of every ``min_lines`` lines in a row
the leftmost smallest hash of ``gram`` lines, and the shorter runs themselves. Fingerprints that stand elsewhere too are joined; from such a
place the match is extended both ways, by all runs of ``min_lines`` lines that own the fingerprint. Every line of a run that stands earlier too
(smaller doc_id, or same document and earlier line; a whole text: as a whole text of a smaller doc_id) is deleted; runs are judged on the
input, and are equal by two 64-bit hashes of other seeds.

Null texts are empty (one empty line), rows without doc_id come last, rows with one doc_id count as one document, an empty table gives
an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholmill.llm import blocks as B
from scholmill.llm.suffix_dedup import leftmost_minima

_WHOLE = np.uint64(0x0F0F_3C3C_5555_9999)


class _Part:
    """Rows a to b of a block: its lines, and of every run its start, number of lines, fingerprint (key) and two hashes."""

    def __init__(self, texts: B.Texts, a: int, b: int, min_lines: int, min_words: int, gram: int):
        at = texts.offsets[a : b + 1]
        offsets, data = at - at[0], texts.data[at[0] : at[-1]]
        breaks = np.flatnonzero(data == 10)
        per_row = np.diff(np.searchsorted(breaks, offsets)) + 1
        self.a, self.first = a, np.concatenate([[0], np.cumsum(per_row)])
        n = int(self.first[-1])
        head, tail = np.zeros(n, bool), np.zeros(n, bool)
        head[self.first[:-1]] = tail[self.first[1:] - 1] = True
        self.start, self.end = np.empty(n, np.int64), np.empty(n, np.int64)
        self.start[head], self.start[~head] = offsets[:-1], breaks + 1
        self.end[tail], self.end[~tail] = offsets[1:], breaks
        self.base = int(at[0])
        lines, lines_too = B.segments(data, data != 10, self.start, self.end), B.others(data, self.start, self.end)
        begin = ~B.SPACE[data]
        if len(data):
            inner = np.zeros(len(data), bool)
            inner[1:] = begin[:-1]
            inner[self.start[self.start < len(data)]] = False
            begin &= ~inner
        words = np.diff(np.concatenate([[0], np.cumsum(begin)])[np.stack([self.start, self.end])], axis=0)[0]
        left = np.repeat(self.first[1:], per_row) - np.arange(n)  # lines from each on to the end of its text
        runs, sizes, keys, one, two = [], [], [], [], []

        def add(places, size, key, first, second):
            for to, x in ((runs, places), (sizes, np.full(len(places), size) if np.isscalar(size) else size), (keys, key), (one, first), (two, second)):
                to.append(x)

        full = np.flatnonzero(left >= min_lines)
        hashes, others, grams = B.windows(lines, min_lines), B.windows(lines_too, min_lines), B.windows(lines, gram)
        mark = leftmost_minima(grams, min_lines - gram + 1)[full].astype(np.int64) if len(full) else full
        add(full, min_lines, grams[mark] if len(full) else np.zeros(0, np.uint64), hashes[full], others[full])
        self.n_full, self.mark = len(full), mark
        total = words.copy()
        for size in range(1, min_lines):  # shorter runs of many words, but those that hold such a run
            if size > 1:
                total = total[:-1] + words[size - 1 :] if len(total) else total
            few = np.flatnonzero((total >= min_words) & (left[: len(total)] >= size))
            x, y = B.windows(lines, size), B.windows(lines_too, size)
            add(few, size, x[few], x[few], y[few])
        per_text = np.diff(np.concatenate([[0], np.cumsum(words)])[self.first])
        short = np.flatnonzero((per_row < min_lines) & (per_text > 0))
        x, y = (B.sequences(v, self.first, seed)[short] ^ _WHOLE for seed, v in ((1, lines), (2, lines_too)))
        add(self.first[short], per_row[short], x, x, y)
        self.runs, self.sizes, self.keys, self.hashes, self.checks = (np.concatenate(v) for v in (runs, sizes, keys, one, two))
        self.row = np.searchsorted(self.first, self.runs, side="right") - 1


def _parts(texts: B.Texts, *rule: int) -> list[_Part]:
    return [_Part(texts, a, b, *rule) for a, b in texts.parts()]


def _all(texts: B.Texts, parts: list[_Part]):
    """doc_id and line number of all runs of a block."""
    return np.concatenate([texts.ids[p.a + p.row] for p in parts]), np.concatenate([p.runs - p.first[p.row] for p in parts])


def _ask_marks(*rule: int):
    def ask(table: pa.Table) -> pa.Table:
        texts = B.Texts(table)
        parts = _parts(texts, *rule)
        keys = np.concatenate([p.keys for p in parts])
        head, _ = B.distinct(keys, np.zeros_like(keys), ids := _all(texts, parts)[0])
        return B.question(table.column("block")[0].as_py(), keys[head], np.zeros(len(head), np.uint64), ids[head])

    return ask


def _ask_runs(*rule: int):
    def ask(key, docs: pa.Table, mail: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return B.question(0, *(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64)))
        texts = B.Texts(docs)
        parts = _parts(texts, *rule)
        keys = np.concatenate([p.keys for p in parts])
        ids, _ = _all(texts, parts)
        # runs that share one place share its fingerprint
        place = np.concatenate([np.concatenate([p.mark, p.runs[p.n_full :] + (p.sizes[p.n_full :] << 36)]) + k * 2**44 for k, p in enumerate(parts)])
        head, of = B.distinct(keys, np.zeros_like(keys), ids)
        lowest, highest = np.full(len(head), np.iinfo(np.int64).max), np.full(len(head), -1)
        np.minimum.at(lowest, of, place)
        np.maximum.at(highest, of, place)
        live = ((lowest < highest) | (B.codes(mail, len(head)) != 0))[of]
        hashes, checks = (np.concatenate([getattr(p, c) for p in parts])[live] for c in ("hashes", "checks"))
        head, _ = B.distinct(hashes, checks, ids[live])
        return B.question(key[0].as_py(), hashes[head], checks[head], ids[live][head], B.pack(np.packbits(live)))

    return ask


def _finish(rule: tuple[int, ...], carry: tuple[str, ...], schema: pa.Schema):
    def finish(key, docs: pa.Table, mail: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return schema.empty_table()
        texts = B.Texts(docs)
        parts = _parts(texts, *rule)
        hashes, checks = (np.concatenate([getattr(p, c) for p in parts]) for c in ("hashes", "checks"))
        ids, line = _all(texts, parts)
        live = np.flatnonzero(np.unpackbits(B.unpack(B.kept(mail))[0], count=len(hashes)))
        head, of = B.distinct(hashes[live], checks[live], ids[live], line[live])
        first = live[head][of]
        later = np.zeros(len(hashes), bool)
        later[live] = (ids[live] != ids[first]) | (line[live] != line[first]) | (B.codes(mail, len(head))[of] == 1)
        n_lines, n_removed, out, seen = [], [], [], 0
        for p in parts:
            late = later[seen : seen + len(p.runs)]
            seen += len(p.runs)
            edge = np.zeros(int(p.first[-1]) + 1, np.int32)
            np.add.at(edge, p.runs[late], 1)
            np.add.at(edge, (p.runs + p.sizes)[late], -1)
            gone = np.cumsum(edge[:-1]) > 0
            lost = np.concatenate([[0], np.cumsum(gone)])[p.first]
            n_removed += np.diff(lost).tolist()
            n_lines += np.diff(p.first).tolist()
            for i in np.arange(len(p.first) - 1):
                if lost[i + 1] == lost[i]:
                    out.append(texts.bytes_of(p.a + i))
                else:
                    keep = np.arange(p.first[i], p.first[i + 1])
                    keep = keep[~gone[keep]]
                    out.append(b"\n".join(texts.data[s:e].tobytes() for s, e in zip(p.base + p.start[keep], p.base + p.end[keep], strict=True)))
        text = pa.array(out, pa.binary()).cast(pa.string())
        return pa.table([texts.doc_ids(), pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64()), text, *(texts.table.column(c) for c in carry)], schema=schema)

    return finish


def line_dedup(docs: DataFrame, min_lines: int = 3, gram: int = 2, min_words: int = 50, carry: tuple[str, ...] = (), block_bytes: int = B.BLOCK_BYTES) -> DataFrame:
    """doc_id, n_lines, n_removed, the text left, and the columns named in ``carry``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    rule = (min_lines, min_words, gram)
    dealt, _ = B.dealt(docs, block_bytes, carry)
    empty = dealt.select("doc_id", F.lit(0).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_removed"), "text", *carry)
    schema = pa.schema([pa.field(f.name, f.type) for f in to_arrow_schema(empty.schema)])
    marks = B.answered(dealt.groupBy("block").applyInArrow(B.tidied_groups(_ask_marks(*rule)), B.ASKED))
    runs = B.answered(dealt.groupBy("block").cogroup(marks.groupBy("block")).applyInArrow(B.tidied_groups(_ask_runs(*rule)), B.ASKED))
    return dealt.groupBy("block").cogroup(runs.groupBy("block")).applyInArrow(B.tidied_groups(_finish(rule, carry, schema)), empty.schema)
