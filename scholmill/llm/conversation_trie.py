"""Prefix trie of conversations, built as a burst trie.

A turn is 20 bytes: 16 of the SHA-256 of its role and text, and the length of its text in UTF-8. A conversation is the string of its turns, and equal
conversations are one row with their number, smallest id and the digest of their ids. All rows start in one container under the root. In each round
every container of more than ``limit`` rows is burst: the turns that all of its rows share become a chain of nodes under its head (found from the
smallest and the largest row), the row that ends there stays with the last of them, and the others go to containers by their next turn. Containers
that are small enough stay. In the end each is sorted and swept: a stack of the open nodes, which closes those that the next row doesn't share. What
bursting left above the containers gets its leaves and tokens from below, round by round.

Tasks hold one container's open nodes and their children at most, so ``limit`` rows of a container whatever the input, and one conversation (20 bytes
a turn). Ids of equal conversations are gathered 4096 at a time and digested as a stream in order, so a group of copies takes no memory; its digest
is one task's work, as SHA-256 goes from the first id to the last. Rounds grow with the branchings above containers.

Rows without conv_id are left out. Null role or text is empty. Turns are in order of turn (null first), equal ones by role, then digest; repeated rows
are turns of their own. Texts of any length are digested whole. No conversation gives no node, not even the root. Other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholmill.operators.durable import cut

WIDTH = 20
#: Rows of a container, and turns that a burst takes off at once.
LIMIT = 256
STRIDE = 64
NO_ENDS = hashlib.sha256(b"").hexdigest()
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_ITEM = "blob binary, first long, n long, ends string"


def conversations(turns: DataFrame) -> DataFrame:
    """conv_id and blob: the string of its turns."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.left(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), F.lit(32))
    key = F.concat(digest, F.lpad(F.hex(F.octet_length(text).cast("long")), 8, "0"))
    place = F.struct(F.col("turn").isNotNull().alias("given"), F.col("turn").alias("turn"), role.alias("role"), key.alias("key"))
    own = turns.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), place.alias("t")).groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    return own.select("conv_id", F.unhex(F.array_join(F.transform("t", lambda x: x["key"]), "")).alias("blob"))


def regrouped(convs: DataFrame, every: int = 5, most: int = 9) -> DataFrame:
    """Conversations that begin as another one: the first h turns of conversation c - c % every, then c's own after its first h; h = crc32(c) % most."""
    base = convs.filter(F.pmod("conv_id", F.lit(every)) == 0).select(F.col("conv_id").alias("base"), F.substring("blob", 1, WIDTH * (most - 1)).alias("start"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int") * WIDTH
    rows = convs.withColumn("base", F.col("conv_id") - F.pmod("conv_id", F.lit(every))).join(base, "base", "left").withColumn("h", h)
    return rows.select("conv_id", F.expr("concat(substring(coalesce(start, X''), 1, h), substring(blob, h + 1))").alias("blob"))


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of key and chunk to one row a key; ids are digested as they come."""
    key = row = digest = None

    def batch(rows: list) -> pa.RecordBatch:
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["blob", "first", "n", "ends"])

    for b in batches:
        done = []
        for k, blob, ids in zip(b["key"].to_pylist(), b["blob"].to_pylist(), b["ids"].to_pylist(), strict=True):
            if k != key:
                if row:
                    done.append((*row, digest.hexdigest()))
                key, row, digest = k, [blob, ids[0], 0], hashlib.sha256()
            digest.update((("," if row[2] else "") + ",".join(map(str, ids))).encode())
            row[2] += len(ids)
        if done:
            yield batch(done)
    if row:
        yield batch([(*row, digest.hexdigest())])


def distinct_sequences(convs: DataFrame) -> DataFrame:
    """blob, first (smallest conv_id), n, and ends (SHA-256 of the ids in order) of each distinct string of turns."""
    rows = convs.select("conv_id", "blob", F.unhex(F.left(F.sha2("blob", 256), F.lit(32))).alias("key"), F.shiftright("conv_id", 12).alias("chunk"))
    chunks = rows.groupBy("key", "chunk").agg(F.first("blob").alias("blob"), F.array_sort(F.collect_list("conv_id")).alias("ids"))
    return chunks.repartition("key").sortWithinPartitions("key", "chunk").select("key", "blob", "ids").mapInArrow(_merged, _ITEM)


def _number(x: str) -> str:
    """SQL of the text length that a turn ends with."""
    return f"cast(conv(hex(substring({x}, 17, 4)), 16, 10) AS long)"


class _Node:
    __slots__ = ("children", "depth", "ends", "kids", "leaves", "low", "n", "saved", "size")

    def __init__(self, depth: int, size: int) -> None:
        self.depth, self.size, self.low, self.n, self.children, self.leaves, self.saved, self.ends, self.kids = depth, size, None, 0, 0, 0, 0, NO_ENDS, []

    def take(self, low: int, n: int) -> None:
        self.low = low if self.low is None else min(self.low, low)
        self.n += n


def _swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of head and rest to nodes. The row of a container's head has the key of the node above, others have none."""
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "above", "level"]
    kinds = [pa.int64()] * 7 + [pa.string(), pa.binary(), pa.int32()]
    out: list[tuple] = []
    stack: list[_Node] = []
    head = before = top = None

    def batch() -> pa.RecordBatch:
        rows = pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)
        out.clear()
        return rows

    def close() -> None:
        """Closes the last open node: its children's rows are complete, its own waits for its parent's smallest id."""
        x = stack.pop()
        x.leaves, x.saved = x.leaves or 1, x.saved + (x.n - 1) * x.size
        out.extend((*kid[:2], x.low, *kid[2:], None, None) for kid in x.kids)
        own = (x.low, x.depth, x.n, x.children, x.leaves, x.saved, x.ends)
        if stack:
            up = stack[-1]
            up.take(x.low, x.n)
            up.children, up.leaves, up.saved = up.children + 1, up.leaves + x.leaves, up.saved + x.saved
            up.kids.append(own)
        else:
            out.append((*own[:2], top[0], *own[2:], top[1], top[2]))

    for b in batches:
        for h, depth, size, low, above, level, rest, first, n, ends in zip(*(b[c].to_pylist() for c in ("head", "depth", "size", "low", "above", "level", "rest", "first", "n", "ends")), strict=True):
            if h != head:
                while stack:
                    close()
                head, before, top = h, b"", (low, above, level)
                stack.append(_Node(depth, size))
            k = 0
            while WIDTH * k < min(len(rest), len(before)) and rest[WIDTH * k : WIDTH * (k + 1)] == before[WIDTH * k : WIDTH * (k + 1)]:
                k += 1
            while len(stack) > k + 1:
                close()
            stack.extend(_Node(depth + i + 1, int.from_bytes(rest[WIDTH * i + 16 : WIDTH * (i + 1)], "big")) for i in range(k, len(rest) // WIDTH))
            stack[-1].take(first, n)
            stack[-1].ends, before = ends, rest
            if len(out) >= 10_000:
                yield batch()
    while stack:
        close()
    if out:
        yield batch()


def _burst(items: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """The containers of more than ``limit`` rows with the turns that all of their rows share, and the items with what their container tells (or null)."""
    start = F.substring("rest", 1, WIDTH * STRIDE)
    same = [F.min(c).alias(c) for c in ("depth", "size", "low", "above", "level")]
    full = items.groupBy("head").agg(F.count("*").alias("rows"), F.sum("n").alias("members"), F.min("first").alias("least"), F.min(start).alias("a"), F.max(start).alias("z"), *same).filter(F.col("rows") > limit)
    skip = f"size(filter(sequence(1, {STRIDE}), k -> length(a) >= {WIDTH} * k AND substring(a, 1, {WIDTH} * k) = substring(z, 1, {WIDTH} * k)))"
    full = cut(full.withColumn("skip", F.expr(skip)).withColumn("chain", F.expr(f"substring(a, 1, {WIDTH} * skip)")).drop("a", "z", "rows"))
    return full, items.join(full.select("head", "skip", "least"), "head", "left")


def _upper(full: DataFrame, stops: DataFrame, below: DataFrame) -> DataFrame:
    """Nodes of burst containers: the head and its chain, from what the containers below report."""
    kids = below.groupBy("above").agg(F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved")).withColumnRenamed("above", "head")
    rows = full.join(kids, "head").join(stops.select("head", "ends"), "head", "left")
    sizes = f"concat(array(size), transform(sequence(0, skip - 1, 1), k -> {_number(f'substring(chain, {WIDTH} * k + 1, {WIDTH})')}))"
    rows = rows.withColumn("sizes", F.expr(f"CASE WHEN skip = 0 THEN array(size) ELSE {sizes} END"))
    rows = rows.select("*", F.posexplode("sizes").alias("d", "_"))
    last = F.col("d") == F.col("skip")
    return rows.select(
        F.col("least").alias("conv_id"), (F.col("depth") + F.col("d")).alias("depth"), F.when(F.col("d") == 0, F.col("low")).otherwise(F.col("least")).alias("parent_conv_id"),
        F.col("members").alias("n_convs"), F.when(last, F.col("n_children")).otherwise(F.lit(1).cast("long")).alias("n_children"), "n_leaves",
        F.expr("saved + (members - 1) * aggregate(slice(sizes, d + 1, skip + 1), 0L, (s, x) -> s + x)").alias("saved_tokens"),
        F.coalesce(F.when(last, F.col("ends")), F.lit(NO_ENDS)).alias("ends_sha256"), F.when(F.col("d") == 0, F.col("above")).alias("above"), F.when(F.col("d") == 0, F.col("level")).alias("level"),
    )


def prefix_trie(convs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The nodes of the trie of conversations (conv_id, blob), root included: NODE."""
    none = F.lit(None)
    at_root = (F.lit(b"").alias("head"), F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("size"), none.cast("long").alias("low"), none.cast("binary").alias("above"), F.lit(0).alias("level"))
    items = cut(distinct_sequences(convs).select(*at_root, F.col("blob").alias("rest"), "first", "n", "ends"))
    columns, small, levels = items.columns, [], []
    while True:
        full, told = _burst(items, limit)
        if full.isEmpty():
            small.append(items)
            break
        told = cut(told)
        small.append(told.filter("skip IS NULL").select(columns))
        over = told.filter("skip IS NOT NULL")
        levels.append((full, over.filter(f"length(rest) = {WIDTH} * skip")))
        step = f"substring(rest, 1, {WIDTH} * (skip + 1))"
        items = over.filter(f"length(rest) > {WIDTH} * skip").select(
            F.expr(f"unhex(left(sha2(concat(head, {step}), 256), 32))").alias("head"), F.expr("depth + skip + 1").alias("depth"), F.expr(_number(f"substring(rest, {WIDTH} * skip + 1, {WIDTH})")).alias("size"),
            F.col("least").alias("low"), F.col("head").alias("above"), F.lit(len(levels)).alias("level"), F.expr(f"substring(rest, {WIDTH} * (skip + 1) + 1)").alias("rest"), "first", "n", "ends",
        )
    packed = reduce(DataFrame.unionByName, small).repartition("head").sortWithinPartitions("head", "rest")
    nodes = cut(packed.mapInArrow(_swept, f"{NODE}, above binary, level int"))
    parts, under = [nodes], nodes
    for k, (full, stops) in reversed(list(enumerate(levels, 1))):
        if levels[k:]:
            under = nodes.unionByName(parts[-1])
        parts.append(cut(_upper(full, stops, under.filter((F.col("level") == k) & F.col("above").isNotNull()))))
    return reduce(DataFrame.unionByName, parts).drop("above", "level")
