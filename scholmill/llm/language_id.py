"""Language ID of mixed-language text: script ranges, per-word scores and Viterbi with a switching penalty.

Training counts the character trigrams of words (lower case, with word ends) and the scripts of letters by language, over all
training rows, into tables of fixed size. A word's score for a language is the mean log probability of its trigrams
times a capped length. The scripts of a text narrow its candidates to languages that write in them. Viterbi then labels the words of a
text with the best sequence of candidates, where each switch costs a penalty; equal neighbours form spans. A text's language is
the one whose spans hold most letters (ties: the first in sorted order), its score their share.

Texts are turned to scores in slices of some ``SLICE`` characters; a longer text is cut into slices after words. Scores of words, not of
characters, are held, ``HELD`` at most; the state of Viterbi goes from one portion to the next, so labels are those of the whole. A run of letters of more than ``SLICE`` characters in such a text counts as several words.

Null texts and texts without letters give ``und`` with score 0 and no spans; rows without a language teach nothing; without any training
row every text is ``und``; other columns can be carried along; equal rows are labelled each; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholmill.llm import blocks as B

UNDETERMINED = "und"
BUCKETS = 1 << 16
#: Characters that are turned to scores at once; characters of texts that step together; scores that are held for a step.
SLICE = 200_000
BATCH = 4_000_000
HELD = 2_000_000
#: First code points of script ranges, and their scripts (0: no letter's script of its own).
SCRIPT_STARTS = (0x0000, 0x0370, 0x0400, 0x0530, 0x0590, 0x0600, 0x0700, 0x0900, 0x0E00, 0x1100, 0x1200, 0x1E00, 0x1F00, 0x2000, 0x2C00, 0x2C60, 0x2C80, 0x3040, 0x30A0, 0x3100, 0x3400, 0xA000, 0xA720, 0xA800, 0xAC00, 0xD7B0, 0xF900, 0xFB00, 0xFB50, 0xFE00, 0xFF21, 0xFF66, 0xFFA0, 0x20000)
SCRIPT_NAMES = ("Latin", "Greek", "Cyrillic", "Other", "Hebrew", "Arabic", "Other", "Indic", "SoutheastAsian", "Hangul", "Other", "Latin", "Greek", "Other", "Other", "Latin", "Other", "Hiragana", "Katakana", "Other", "Han", "Other", "Latin", "Other", "Hangul", "Other", "Han", "Latin", "Arabic", "Other", "Latin", "Katakana", "Hangul", "Han")
SCRIPTS = tuple(sorted(set(SCRIPT_NAMES)))
_STARTS = np.array(SCRIPT_STARTS, np.uint32)
_SCRIPT_OF = np.array([SCRIPTS.index(n) for n in SCRIPT_NAMES])


def _letters() -> np.ndarray:
    """For code points below 2**16, whether it is a letter."""
    return np.array([chr(i).isalpha() for i in range(1 << 16)])


_LETTER, _LOWER = _letters(), np.array([ord(chr(i).lower()) if len(chr(i).lower()) == 1 else i for i in range(1 << 16)], np.uint32)


class Words:
    """The words (runs of letters) of many texts: trigram buckets, and per word its text, start, end and script."""

    def __init__(self, texts: list[str]):
        joined = "\n".join(texts) + "\n"
        code = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
        low = np.minimum(code, 0xFFFF)
        letter, lower = _LETTER[low], _LOWER[low]
        if len(high := np.flatnonzero(code > 0xFFFF)):
            kinds, of = np.unique(code[high], return_inverse=True)
            letter[high] = np.array([chr(c).isalpha() for c in kinds])[of]
            lower[high] = np.array([ord(chr(c).lower()) if len(chr(c).lower()) == 1 else c for c in kinds], np.uint32)[of]
        edge = np.diff(letter.astype(np.int8), prepend=0)
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        self.base = np.concatenate([[0], np.cumsum(sizes)])
        self.row = np.searchsorted(self.base, self.start, side="right") - 1
        self.size = self.end - self.start
        self.script = _SCRIPT_OF[np.searchsorted(_STARTS, code[self.start], side="right") - 1] if len(self.start) else np.zeros(0, int)
        # a trigram is centred on each letter; neighbours that are no letters count as the word's end
        c = np.where(letter, lower, 0).astype(np.uint32)
        h = np.zeros(len(c), np.uint32)
        h[1:] = c[:-1] * np.uint32(0x9E3779B1)
        h += c * np.uint32(0x85EBCA6B)
        h[:-1] += c[1:] * np.uint32(0xC2B2AE35)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        self.bucket = ((h >> np.uint32(12)) & np.uint32(BUCKETS - 1))[letter].astype(np.uint16)
        self.first = np.concatenate([[0], np.cumsum(self.size)])

    def sums(self, table: np.ndarray) -> np.ndarray:
        """For every word the sum of its trigrams' rows of ``table``, some letters at a time."""
        out = np.zeros((len(self.start), table.shape[1]))
        step = max(1, 4_000_000 // table.shape[1])
        for a in range(0, len(self.bucket), step):
            b = min(a + step, len(self.bucket))
            i, j = np.searchsorted(self.first, a, side="right") - 1, np.searchsorted(self.first, b, side="left")
            heads = np.maximum(self.first[i:j], a) - a
            out[i:j] += np.add.reduceat(table[self.bucket[a:b]], heads, axis=0, dtype=np.float64)
        return out


def slices(texts: list[str], most: int):
    """Ranges of texts of so many characters together; a longer text is alone."""
    at, ends = 0, np.cumsum([len(t) for t in texts])
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right")))
        yield at, to
        at = to


def pieces(text: str):
    """(start, piece) of a long text, cut after words."""
    at = 0
    while at < len(text):
        to = min(at + SLICE, len(text))
        while to < min(at + 2 * SLICE, len(text)) and text[to].isalpha():
            to += 1
        yield at, text[at:to]
        at = to


def counts(batches, languages: list[str]):
    """Per task: (language, bucket, n) and, as negative buckets, letters by script."""
    index = {k: i for i, k in enumerate(languages)}
    table = np.zeros((len(languages), BUCKETS + len(SCRIPTS)), np.int64)
    for batch in batches:
        langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
        texts = [t or "" for t in texts]
        for a, b in slices(texts, SLICE):
            for part in [texts[a:b]] if len(texts[a]) <= SLICE else ([t] for _, t in pieces(texts[a])):
                words = Words(part)
                lang = np.array([index[g] for g in langs[a:b]])[words.row]
                flat, n = np.unique(np.repeat(lang, words.size) * table.shape[1] + words.bucket, return_counts=True)
                table.reshape(-1)[flat] += n
                np.add.at(table, (lang, BUCKETS + words.script), words.size)
    for i, row in enumerate(table):
        at = np.flatnonzero(row)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), i)), pa.array(at), pa.array(row[at])], ["lang", "bucket", "n"])


class Model:
    """Log probabilities of trigram buckets by language, and which scripts a language writes."""

    def __init__(self, languages: list[str], table: np.ndarray, share: float = 0.02):
        self.languages = languages
        grams, scripts = table[:, :BUCKETS].astype(float), table[:, BUCKETS:].astype(float)
        self.logs = np.log((grams + 0.5) / (grams.sum(1, keepdims=True) + 0.5 * BUCKETS)).T.astype(np.float32).copy()
        self.writes = (scripts >= share * np.maximum(scripts.sum(1, keepdims=True), 1)) & (scripts > 0)


def train(rows: DataFrame, lang: str = "lang") -> Model:
    """A model of all rows with a language; its size depends on the number of languages alone."""
    rows = rows.filter(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), "text")
    languages = sorted(r[0] for r in rows.select("lang").distinct().collect())  # one row for each language
    table = np.zeros((len(languages), BUCKETS + len(SCRIPTS)), np.int64)
    if languages:
        found = rows.mapInArrow(B.tidied(lambda it: counts(it, languages)), "lang long, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
        got = found.toPandas()  # languages times buckets at most
        table[got["lang"], got["bucket"]] = got["n"]
    return Model(languages, table)


class Viterbi:
    """Best labels of the words of some texts. All texts step together, word by word; words can come in several portions.

    A switch costs the same from any label to any other, so each step needs only the best label so far; kept of it are that label and,
    in bits, which labels were reached by a switch.
    """

    def __init__(self, n_rows: int, k: int, penalty: float):
        self.k, self.penalty = k, np.float32(penalty)
        self.state = np.zeros((n_rows, k), np.float32)
        self.steps: list[tuple] = []

    def forward(self, scores: np.ndarray, row: np.ndarray) -> None:
        """The next words; scores: words x labels, row: ascending."""
        n = len(scores)
        if not n:
            self.steps.append((None, None, None, None, None))
            return
        length = np.bincount(row, minlength=len(self.state))
        by = np.argsort(-length, kind="stable")[: int((length > 0).sum())]  # the longest text first
        rank = np.empty(len(length), np.int64)
        rank[by] = np.arange(len(by))
        turn = np.arange(n) - np.repeat((np.cumsum(length) - length), length)  # each word's number in its text
        order = np.lexsort((rank[row], turn))  # first words of all texts, second words, and so on
        lives = np.bincount(turn)
        scores, state = scores[order], self.state[by]
        best, switch = np.empty(n, np.int16), np.empty((n, self.k), bool)
        at = 0
        for live in lives.tolist():
            s, to = state[:live], at + live
            top = s.max(1, keepdims=True)
            jump = top - self.penalty
            best[at:to] = s.argmax(1)
            np.greater(jump, s, out=switch[at:to])
            np.maximum(s, jump, out=s)
            s -= top  # only differences matter; sums of long texts stay exact
            s += scores[at:to]
            at = to
        self.state[by] = state
        self.steps.append((by, order.astype(np.int32), lives, best, np.packbits(switch, axis=1)))

    def labels(self) -> list[np.ndarray]:
        """The label of every word, by portion."""
        label, out = self.state.argmax(1), []
        for by, order, lives, best, bits in reversed(self.steps):
            if by is None:
                out.append(np.zeros(0, np.int16))
                continue
            n = len(best)
            switch, base = np.unpackbits(bits, axis=1, count=self.k).reshape(-1), np.arange(n) * self.k
            found, now, at = np.empty(n, np.int16), label[by], n
            for live in lives[::-1].tolist():
                s, to = now[:live], at
                at -= live
                found[at:to] = s
                switched = switch.take(base[at:to] + s)
                now[:live] = np.where(switched, best[at:to], s)
            label[by] = now
            back = np.empty(n, np.int16)
            back[order] = found
            out.append(back)
        return out[::-1]


def viterbi(scores: np.ndarray, allowed: np.ndarray, row: np.ndarray, n_rows: int, penalty: float) -> np.ndarray:
    """Best label of every word in one portion."""
    v = Viterbi(n_rows, scores.shape[1], penalty)
    v.forward(np.where(allowed, scores, np.float32(-1e9)), row)
    return v.labels()[0]


def _scripts(words: Words, n: int) -> np.ndarray:
    """Letters of each text by script."""
    used = np.zeros((n, len(SCRIPTS)))
    np.add.at(used, (words.row, words.script), words.size)
    return used


def _scores(model: Model, words: Words, used: np.ndarray, cap: int) -> np.ndarray:
    """Words x languages; scripts that make up a twentieth of a text's letters narrow its candidates; a word in another is open to them all."""
    mean = words.sums(model.logs) / words.size[:, None]
    scores = (mean * np.minimum(words.size, cap)[:, None]).astype(np.float32)
    used = used >= 0.05 * np.maximum(used.sum(1, keepdims=True), 1)
    candidates = (used.astype(np.int32) @ model.writes.T.astype(np.int32)) > 0
    candidates |= ~candidates.any(1, keepdims=True)
    allowed = candidates[words.row] & model.writes[:, words.script].T
    allowed = np.where(allowed.any(1, keepdims=True), allowed, candidates[words.row])
    return np.where(allowed, scores, np.float32(-1e9))


def _portions(model: Model, texts: list[str], cap: int):
    """Row, start, end and scores of the words of some texts, a slice at a time."""
    for a, b in slices(texts, SLICE):
        if len(texts[a]) <= SLICE:
            words = Words(texts[a:b])
            base = words.base[words.row]
            yield a + words.row, words.start - base, words.end - base, _scores(model, words, _scripts(words, b - a), cap)
            continue
        used = sum(_scripts(Words([part]), 1) for _, part in pieces(texts[a]))
        for at, part in pieces(texts[a]):
            words = Words([part])
            yield a + words.row, words.start + at, words.end + at, _scores(model, words, used, cap)


def _label(model: Model, texts: list[str], penalty: float, cap: int):
    """Row, start, end and label of every word, and letters by text and language."""
    k = len(model.languages)
    letters = np.zeros((len(texts), max(k, 1)))
    if not k:
        return *(np.zeros(0, np.int32) for _ in range(4)), letters
    v, places, held = Viterbi(len(texts), k, penalty), [], []

    def step():
        v.forward(np.concatenate([s for _, s in held]), np.concatenate([r for r, _ in held]))
        held.clear()

    for row, start, end, scores in _portions(model, texts, cap):
        places.append((row, start.astype(np.int32), end.astype(np.int32)))
        held.append((row, scores))
        if sum(s.size for _, s in held) > HELD:
            step()
    if held:
        step()
    row, start, end = (np.concatenate(x) for x in zip(*places, strict=True))
    label = np.concatenate(v.labels())
    np.add.at(letters, (row, label), end - start)
    return row, start, end, label, letters


def identify(docs: DataFrame, model: Model, penalty: float = 12.0, cap: int = 8, carry: tuple[str, ...] = (), spans: bool = True) -> DataFrame:
    """The columns named in ``carry``, then lang_pred, score and spans: [(start, end, lang)] in code points."""
    from pyspark.sql.pandas.types import to_arrow_schema

    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size for each language
    picked = docs.select(*carry, F.col("text").alias("__text"))
    schema = docs.select(*carry, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"), F.expr("cast(null as array<struct<start: int, end: int, lang: string>>)").alias("spans")).schema
    arrow = to_arrow_schema(schema)
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])

    def some(batch: pa.RecordBatch, texts: list[str]):
        m = shared.value
        row, start, end, label, letters = _label(m, texts, penalty, cap)
        total = letters.sum(1)
        best = letters.argmax(1)
        names = [m.languages[i] if s else UNDETERMINED for i, s in zip(best, total, strict=True)]
        score = np.where(total > 0, letters.max(1) / np.maximum(total, 1), 0.0)
        if spans and len(label):
            new = np.ones(len(label), bool)
            new[1:] = (label[1:] != label[:-1]) | (row[1:] != row[:-1])
            head = np.flatnonzero(new)
            tail = np.append(head[1:], len(label)) - 1
            offsets = np.searchsorted(row[head], np.arange(len(texts) + 1))
            values = pa.StructArray.from_arrays([pa.array(start[head]), pa.array(end[tail]), pa.array([m.languages[i] for i in label[head]], pa.string())], fields=list(span))
            found = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)
        else:
            found = pa.array([[]] * len(texts), pa.list_(span))
        return [*(batch.column(c) for c in range(len(carry))), pa.array(names, pa.string()), pa.array(score, pa.float64()), found]

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column("__text").to_pylist()]
            for a, b in slices(texts, BATCH):
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(some(batch.slice(a, b - a), texts[a:b]), arrow, strict=True)], schema=arrow)

    return picked.mapInArrow(B.tidied(run), schema)


def held_out(doc_id: str = "doc_id", modulus: int = 4, remainder: int = 2):
    """Whether crc32(doc_id as text) has that remainder; rows without doc_id are not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def crc(doc_id: int) -> int:
    return zlib.crc32(str(doc_id).encode())
