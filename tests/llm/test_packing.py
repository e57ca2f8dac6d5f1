import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from scholmill.llm import packing as P
from scholmill.llm.packing import Encoder, Plan, pack

PATH = public_tokenizers.path("byte_bpe_50k.json")


def fill(plan):
    """Pieces of each sequence as (offset, length), and pieces of each length."""
    seqs, seen = defaultdict(list), defaultdict(list)
    for w, rank, n, seq, offset in plan.runs:
        seen[w] += range(rank, rank + n)
        for i in range(n):
            seqs[seq + i].append((offset, w))
    return seqs, seen


@pytest.mark.parametrize("seed", range(8))
def test_plan(seed):
    rng = random.Random(seed)
    capacity = rng.choice([20, 100, 512])
    sizes = [rng.randint(1, capacity - 1) if rng.random() < 0.5 else rng.randint(capacity // 3, capacity // 2) for _ in range(rng.choice([0, 1, 30, 500]))]
    histogram = {w: sizes.count(w) for w in set(sizes)}
    plan = Plan(histogram, capacity)
    seqs, seen = fill(plan)
    assert {w: sorted(k) for w, k in seen.items()} == {w: list(range(c)) for w, c in histogram.items()}
    for pieces in seqs.values():
        at = 0
        for offset, w in sorted(pieces):
            assert offset == at
            at += w
        assert at <= capacity
    rooms = []  # never worse than best fit, longest first
    for w in sorted(sizes, reverse=True):
        fits = [r for r in rooms if r >= w]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - w)
        else:
            rooms.append(capacity - w)
    assert len(seqs) == plan.sequences <= len(rooms)


def test_optimal_on_small_instances():
    def best(sizes, capacity):
        found = [len(sizes)]

        def go(i, rooms):
            if len(rooms) >= found[0]:
                return
            if i == len(sizes):
                found[0] = len(rooms)
                return
            for k in range(len(rooms)):
                if rooms[k] >= sizes[i]:
                    go(i + 1, [*rooms[:k], rooms[k] - sizes[i], *rooms[k + 1 :]])
            go(i + 1, [*rooms, capacity - sizes[i]])

        go(0, [])
        return found[0]

    rng = random.Random(5)
    for _ in range(60):
        sizes = sorted((rng.randint(1, 29) for _ in range(rng.randint(1, 8))), reverse=True)
        plan = Plan({w: sizes.count(w) for w in set(sizes)}, 30)
        left = len(sizes) - sum(n for *_, n in [(r[2],) for r in plan.runs])
        assert left == 0 and plan.sequences <= best(sizes, 30) + 1


def test_encoders_agree():
    whole = Tokenizer.from_file(PATH)
    own = Encoder(PATH, public_tokenizers.PATTERN)
    assert own.fast is not None
    rng = random.Random(3)
    alphabet = "abcé ßÜ \n\t\r.,'s1239²ª°·€–—’“ ­_#$%" + "漢字ñЖ😀́ "
    for _ in range(600):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
        assert own.encode(text) == whole.encode(text, add_special_tokens=False).ids, text
    for text in ("<|endoftext|>", "a <|endoftext|> b", "don't WE'LL they've   x\n\n y ", "".join(map(chr, range(0x250)))):
        assert own.encode(text) == whole.encode(text, add_special_tokens=False).ids


def test_round_trip(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["the", "Straße", "1234", "of", "zzz"]) for _ in range(rng.choice([0, 3, 40, 200])))) for i in range(60)]
    rows += [(None, "x"), (None, None), (7, rows[7][1]), (100, "word " * 5000), (101, "")]
    docs = spark.createDataFrame([(*r, 1, "s") for r in rows], "doc_id long, text string, length int, salt string")
    got = pack(docs, PATH, public_tokenizers.PATTERN, 64).collect()
    whole = Tokenizer.from_file(PATH)
    want = []
    for d, t in rows:
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 0]
        first = len(ids) % 64 or 64
        edges = [0, *range(first, len(ids) + 1, 64)]
        want += [(d, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted((key(r[:5]) for r in got)) == sorted(map(key, want))
    seqs = defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append((r.offset, r.length))
    for pieces in seqs.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 64


def test_empty(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


def test_groups_are_as_large_as_meant(spark, monkeypatch):
    monkeypatch.setattr(P, "GROUP_ROWS", 64)
    sizes = {1: 3000, 2: 63, 3: 64, 4: 129, 5: 1}
    rows = [(d, 0, 0, w, d * 7) for w, n in sizes.items() for d in range(w * 10_000, w * 10_000 + n)]
    groups = P._salted(spark.createDataFrame(rows, P.PIECES), sizes).groupBy("length", "salt").count().collect()
    assert sum(r["count"] for r in groups) == len(rows)
    per_length = {w: sum(r["length"] == w for r in groups) for w in sizes}
    assert per_length == {1: 46, 2: 1, 3: 1, 4: 2, 5: 1} and max(r["count"] for r in groups) < 130


def test_all_documents_have_the_ids_of_the_plain_encoder(spark):
    whole, own = Tokenizer.from_file(PATH), Encoder(PATH, public_tokenizers.PATTERN)
    for row in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect():
        assert own.encode(row.text or "") == whole.encode(row.text or "", add_special_tokens=False).ids
