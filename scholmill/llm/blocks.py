"""Documents dealt into blocks of bounded size, hashes of their words and stretches, and questions about the whole corpus.

Several operators ask about every fingerprint of every document: does another document hold it, and is one of them earlier? A block holds
some megabytes of text. It sends each of its distinct fingerprints once, as a row; a window over equal fingerprints finds the smallest doc_id;
rows of fingerprints that other blocks hold too go back to the block that sent them. So rows grow in proportion to the text, and a
fingerprint that a third of all documents hold is a row for each block.
"""

from __future__ import annotations

import ctypes
import hashlib
import inspect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_BYTES = 4 << 20
NO_ID = np.iinfo(np.int64).max  # orders rows without doc_id after all others
ASKED = "key long, check long, id long, place long, body binary"
_MUL = np.uint64(0x9E3779B97F4A7C15)
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc; other libraries have none


def give_back() -> None:
    """Return freed memory to the machine: a Python worker outlives its task and would hold it beside what later stages need."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def tidied(run):
    """``run`` for mapInArrow, giving back its memory when a task ends."""

    def over(batches):
        yield from run(batches)
        give_back()

    return over


def tidied_groups(run):
    """``run`` for applyInArrow of a table, a key and a table, or a key and two tables, giving back its memory after each group."""

    def done(out: pa.Table) -> pa.Table:
        give_back()
        return out

    def one(table: pa.Table) -> pa.Table:
        return done(run(table))

    def keyed(key: tuple, table: pa.Table) -> pa.Table:
        return done(run(key, table))

    def both(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        return done(run(key, left, right))

    return {1: one, 2: keyed, 3: both}[len(inspect.signature(run).parameters)]


def dealt(docs: DataFrame, block_bytes: int = BLOCK_BYTES, more: tuple[str, ...] = ()) -> tuple[DataFrame, int]:
    """(block, doc_id, text, *more) dealt by block, and the number of blocks.

    Rows of one doc_id share a block; rows without one are dealt by their text. Null texts are empty.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    total = docs.agg(F.sum(F.octet_length("text").cast("long") + 64)).first()[0] or 0
    n = max(1, -(-int(total) // block_bytes))
    key = F.coalesce(F.xxhash64("doc_id", F.lit(7)), F.lit(0))
    key = F.when(F.col("doc_id").isNull(), F.xxhash64(text)).otherwise(key) if n > 1 else F.lit(0).cast("long")
    return docs.select(F.pmod(key, F.lit(n)).alias("block"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), *more), n


class Texts:
    """The rows of a block in order of (doc_id, text), as UTF-8 bytes; ``ids`` orders them."""

    def __init__(self, table: pa.Table):
        ids = table.column("doc_id").combine_chunks()
        self.null = np.asarray(ids.is_null())
        keys = np.asarray(ids.fill_null(NO_ID), dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        if len(keys) > 1 and (np.diff(keys[order]) == 0).any():  # the same id again: any fixed order will do
            texts = table.column("text").to_pylist()
            order = np.array(sorted(range(len(keys)), key=lambda i: (keys[i], texts[i])))
        self.table = table.take(pa.array(order))
        self.ids, self.null = keys[order], self.null[order]
        self.offsets, self.data = utf8(self.table.column("text"))

    def __len__(self) -> int:
        return len(self.ids)

    def parts(self, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
        """Ranges of rows with about ``most`` bytes, so that working arrays stay small; a longer text is a range of its own."""
        return parts(self.offsets, most)

    def bytes_of(self, row: int) -> bytes:
        return self.data[self.offsets[row] : self.offsets[row + 1]].tobytes()

    def doc_ids(self) -> pa.Array:
        return pa.array(self.ids, type=pa.int64(), mask=self.null)


def parts(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
        yield at, min(to, n)
        at = min(to, n)


def utf8(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets from 0, and the bytes, of a string column without nulls."""
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(a, pa.ChunkedArray):
        a = pa.concat_arrays(a.chunks) if a.num_chunks else pa.array([], pa.string())
    a = a.cast(pa.large_string()).fill_null("")
    _, starts, data = a.buffers()
    if len(a) == 0 or data is None:
        return np.zeros(len(a) + 1, np.int64), np.zeros(0, np.uint8)
    offsets = np.frombuffer(starts, np.int64)[a.offset : a.offset + len(a) + 1]
    return offsets - offsets[0], np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_TURN = np.uint64(0xC2B2AE3D27D4EB4F)
_STEPS = 64
_TABLE = np.random.default_rng(20).integers(0, 1 << 64, (_STEPS, 256), dtype=np.uint64).reshape(-1)  # a random value for each byte at each place


def segments(data: np.ndarray, inside: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each segment of bytes; ``inside`` marks the bytes of all. A sum of random values of (place, byte): no polynomial, so no pattern cancels out."""
    size = ends - starts
    out = np.zeros(len(starts), np.uint64)
    if len(live := np.flatnonzero(size > 0)):
        count, at = size[live], np.flatnonzero(inside).astype(np.int32)
        place = at - np.repeat(starts[live].astype(np.int32), count)
        longest = int(count.max())
        value = _TABLE[(((place & np.int32(_STEPS - 1)) if longest > _STEPS else place) << np.int32(8)) | data[inside]]
        if longest > _STEPS:
            far = np.flatnonzero(place >= _STEPS)
            value[far] = mix(value[far] + (place[far] // _STEPS).astype(np.uint64) * _TURN)
        out[live] = np.add.reduceat(value, np.cumsum(count) - count)
    return mix(out + size.astype(np.uint64) * _MUL)


_NEAR = 256
_LEFT = np.array([(1 << 8 * k) - 1 for k in range(8)], np.uint64)


def others(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Another hash of each segment, of its bytes and not of ``segments``: eight bytes at a time, mixed at every step; BLAKE2 from 256 bytes on."""
    size = ends - starts
    out = mix(size.astype(np.uint64) * _TURN + _MUL)
    view = np.ndarray((len(data) + 1,), "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
    steps = np.where(size <= _NEAR, -(-size // 8), 0).astype(np.uint16)
    order = np.argsort(-steps.astype(np.int16), kind="stable")
    order = order[: int(np.count_nonzero(steps))]
    at, left, state = starts[order], size[order], out[order]
    for k in range(int(steps.max(initial=0))):
        m = int(np.searchsorted(-left, -8 * k, side="left")) if k else len(order)
        value, rest = view[at[:m] + 8 * k], left[:m] - 8 * k
        part = np.flatnonzero(rest < 8)
        value[part] &= _LEFT[rest[part]]
        state[:m] = mix(state[:m] * _MUL + value)
    out[order] = state
    for i in np.flatnonzero(size > _NEAR):
        out[i] = np.frombuffer(hashlib.blake2b(data[starts[i] : ends[i]], digest_size=8).digest(), np.uint64)[0]
    return out


def sequences(symbols: np.ndarray, first: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hash of each row of symbols, row i from first[i] to first[i + 1]: a sum of mixed (place, symbol); another for another seed."""
    count = np.diff(first)
    live = np.flatnonzero(count > 0)
    out = np.zeros(len(count), np.uint64)
    if len(live):
        place = np.arange(len(symbols)) - np.repeat(first[:-1], count)
        value = mix(mix(symbols + np.uint64(seed)) + place.astype(np.uint64) * _TURN)
        out[live] = np.add.reduceat(value, first[:-1][live])
    return mix(out + count.astype(np.uint64) * _MUL + np.uint64(seed))


def windows(symbols: np.ndarray, length: int) -> np.ndarray:
    """Hash of every ``length`` symbols in a row: pairs of halves mixed to powers of two, and these to the length."""
    n = len(symbols) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power, width, done, out = mix(symbols + _MUL), 1, 0, None
    while True:
        if length & width:
            out = power if out is None else mix(out[: len(symbols) - done - width + 1] * _TURN + power[done:])
            done += width
        if done == length:
            return out[:n]
        power = mix(power[:-width] * _MUL + power[width:])
        width *= 2


class Powers:
    """Powers of an odd multiplier modulo 2**64 and their inverses, as far as asked for."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = 1 << max(12, (n - 1).bit_length())

            def run(b: int) -> np.ndarray:
                step = np.full(size, b, np.uint64)
                step[0] = 1
                return np.multiply.accumulate(step)

            self.up, self.down = run(self.base), run(self.inverse)
        return self.up[:n], self.down[:n]


FIRST = Powers(0x5851F42D4C957F2D)


class Prefix:
    """Prefix polynomial hashes of a sequence of symbols: the hash of any stretch in constant time.

    Texts can be made whose polynomials agree modulo 2**64, so what is equal by these hashes is compared by bytes or by another hash.
    """

    def __init__(self, symbols: np.ndarray, powers: Powers = FIRST):
        up, self.down = powers.to(len(symbols) + 1)
        self.sums = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum((symbols.astype(np.uint64) + np.uint64(1)) * up[: len(symbols)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64) * _MUL)

    def all(self, length: int) -> np.ndarray:
        """Of every stretch of that length."""
        n = max(0, len(self.sums) - length)
        return mix((self.sums[length : length + n] - self.sums[:n]) * self.down[:n] + np.uint64(length * int(_MUL) % 2**64))


def octets(data: np.ndarray) -> np.ndarray:
    """A mixed value for every eight bytes in a row, as symbols of a sequence."""
    n = max(0, len(data) - 7)
    return mix(np.ndarray((n,), np.uint64, np.ascontiguousarray(data), strides=(1,)).copy() + _MUL) if n else np.zeros(0, np.uint64)


#: The bytes that part words, space and 0x09 to 0x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def words(offsets: np.ndarray, data: np.ndarray, apart: np.ndarray = SPACE, twice: bool = False) -> tuple[np.ndarray, ...]:
    """Hash of every word, the first word of every row (and the end), and the start byte of every word; ``apart``: bytes that part words. With ``twice`` also another hash."""
    if len(data) == 0:
        return (np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))[: 3 + twice]
    space = apart[data]
    begin = np.ones(len(data), bool)  # a word starts after a space or where a row starts
    begin[1:] = space[:-1]
    begin[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts = np.flatnonzero(begin & ~space)
    finish = np.ones(len(data), bool)
    finish[:-1] = space[1:]
    inner = offsets[1:-1]
    finish[inner[inner > 0] - 1] = True
    ends = np.flatnonzero(finish & ~space) + 1
    found = segments(data, ~space, starts, ends), np.searchsorted(starts, offsets), starts
    return (*found, others(data, starts, ends)) if twice else found


def expand(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[i], first[i]+1, ... count[i] values each, one after the other."""
    total = int(count.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(count) - count
    return np.arange(total) - np.repeat(before - first, count)


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of n places lie in [s, s + length) of some s."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + length, n), -1)
    return np.cumsum(edge[:-1]) > 0


# ---- packed arrays


def pack(*arrays: np.ndarray) -> bytes:
    out = [bytes([len(arrays)])]
    for a in arrays:
        a = np.ascontiguousarray(a)
        out += [a.dtype.str.encode().ljust(4), len(a).to_bytes(8, "little"), a.tobytes()]
    return b"".join(out)


def unpack(body: bytes) -> list[np.ndarray]:
    out, at = [], 1
    for _ in range(body[0]):
        kind, n = np.dtype(body[at : at + 4].decode().strip()), int.from_bytes(body[at + 4 : at + 12], "little")
        out.append(np.frombuffer(body, kind, n, at + 12))
        at += 12 + n * kind.itemsize
    return out


def distinct(keys: np.ndarray, checks: np.ndarray, ids: np.ndarray, *then: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entry of each distinct (key, check) with the smallest id (then the smallest of what follows), and each entry's number among these."""
    order = np.lexsort((*reversed(then), ids, checks, keys))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(keys[order]) != 0) | (np.diff(checks[order]) != 0)
    of = np.empty(len(order), np.int64)
    of[order] = np.cumsum(new) - 1
    return order[new], of


def question(block: int, keys: np.ndarray, checks: np.ndarray, ids: np.ndarray, body: bytes | None = None) -> pa.Table:
    """A block's distinct fingerprints, each with its smallest id; ``body`` goes back to the block as it is."""
    more = 0 if body is None else 1
    place = (block << 32) + np.arange(len(keys) + more)
    own = lambda x: np.append(x, np.zeros(more, x.dtype))
    keys, checks, ids = own(keys).view(np.int64), own(checks).view(np.int64), own(ids)
    bodies = pa.nulls(len(keys), pa.binary())
    if more:
        keys[-1], checks[-1] = block, -1  # no fingerprint: filtered by its body
        bodies = pa.concat_arrays([pa.nulls(len(keys) - 1, pa.binary()), pa.array([body], pa.binary())])
    return pa.table({"key": keys, "check": checks, "id": ids, "place": place, "body": bodies})


def answered(asked: DataFrame, kinds: bool = False) -> DataFrame:
    """(block, at, code, body) of the fingerprints that other blocks hold too, by their number in the block's question.

    Code 1: another block has a smaller id; 2: another block has the fingerprint, none a smaller id. With ``kinds`` 2 stands for a key
    that comes with several checks instead.
    """
    same, every = Window.partitionBy("key", "check"), Window.partitionBy("key").orderBy("check").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    if kinds:
        asked = asked.withColumn("several", F.min("check").over(every) < F.max("check").over(every))
    found = asked.withColumn("least", F.min("id").over(same))
    several = F.col("several") if kinds else F.count("*").over(same) > 1
    code = F.when(F.col("body").isNotNull(), 0).when(F.col("least") < F.col("id"), 1).when(several, 2)
    return found.withColumn("code", code.cast("tinyint")).filter("code IS NOT NULL").select(F.shiftright("place", 32).alias("block"), F.col("place").bitwiseAND(0xFFFFFFFF).cast("int").alias("at"), "code", "body")


def codes(table: pa.Table, n: int) -> np.ndarray:
    """The code of each of a block's n fingerprints; 0: no other block has it."""
    out = np.zeros(n + 1, np.uint8)
    out[np.asarray(table.column("at"))] = np.asarray(table.column("code"))
    return out[:n]


def kept(table: pa.Table) -> bytes | None:
    """What the block sent along with its question."""
    body = table.column("body").combine_chunks().drop_null()
    return body[0].as_py() if len(body) else None


def sha256(b: bytes) -> str:
    return hashlib.sha256(b).hexdigest()
