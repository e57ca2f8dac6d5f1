import random

import numpy as np

from scholmill.llm import blocks as B
from scholmill.llm.suffix_dedup import common_extension, leftmost_minima, suffix_dedup, suffix_sort
from tests.llm import brute
from tests.llm.test_substring_dedup import SCHEMA, corpus, pattern


def test_minima():
    rng = np.random.default_rng(1)
    for width in (1, 2, 7, 70):
        v = rng.integers(0, 9, 300).astype(np.uint64)
        assert (leftmost_minima(v, width) == [i + int(np.argmin(v[i : i + width])) for i in range(len(v) - width + 1)]).all()


def test_suffix_sort():
    rng = random.Random(2)
    text = bytes(rng.choice(b"ab") for _ in range(400)) + b"\0" * 60
    data = np.frombuffer(text, np.uint8)
    prefix = B.Prefix(data)
    places = np.arange(400)
    group = np.sort(np.array([rng.randint(0, 12) for _ in places]))
    order = suffix_sort(prefix, data, places, group, 50)
    assert list(order) == sorted(range(400), key=lambda i: (group[i], text[i : i + 50], i))
    assert common_extension(prefix, np.array([0]), np.array([0]), 50) == 50


def test_matches_brute_force(spark):
    for seed, length, block in ((4, 30, 1 << 20), (5, 20, 1500), (6, 100, 900)):
        rows = [(d, t.replace("é", "")) if d % 2 else (d, t) for d, t in corpus(seed, 50, 12)]
        rows += [(1000, "aaaa" * 200), (1001, "xy" * 90 + "aaaa" * 100), (1002, "q" + "".join(rows[3][1] for _ in range(3)))]
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA), length, block_bytes=block).collect()}
        assert got == brute.suffix_dedup(rows, length)


def test_odd_rows(spark):
    text = "".join(f"{i}," for i in range(60))
    rows = [(None, text), (None, None), (4, text), (4, text), (9, ""), (10, None), (11, text + "z" * 300_000), (-5, "b")]
    got = sorted((r.doc_id if r.doc_id is not None else 99, r.n_bytes, r.n_removed, r.n_spans) for r in suffix_dedup(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA), 50, block_bytes=2000).collect())
    n = len(text)
    assert got == [(-5, 1, 0, 0), (4, n, 0, 0), (4, n, 0, 0), (9, 0, 0, 0), (10, 0, 0, 0), (11, n + 300_000, n + 299_999, 2), (99, 0, 0, 0), (99, n, n, 1)]


def test_empty(spark):
    assert suffix_dedup(spark.createDataFrame([], SCHEMA)).collect() == []


def test_texts_of_a_pattern(spark):
    rows = [(k, "".join("ab"[b] for b in pattern(2048, k)) + "z" * 40) for k in (0, 1)]
    for length in (30, 100):
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA), length).collect()}
        assert got == brute.suffix_dedup(rows, length)
