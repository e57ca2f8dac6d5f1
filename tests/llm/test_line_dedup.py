import random

from scholmill.llm.line_dedup import line_dedup
from tests.llm import brute
from tests.llm.test_substring_dedup import ONE, OTHER, SCHEMA


def corpus(seed, n=80):
    rng = random.Random(seed)
    lines = [f"línea {i} " * (i % 4) for i in range(14)] + [f"x{i} " * 6 for i in range(3)]
    return [(i * 2, "\n".join(rng.choices(lines, k=rng.choice([0, 1, 1, 2, 2, 5, 18])))) for i in range(n)]


def test_matches_brute_force(spark):
    for seed, t, gram, words, block in ((1, 3, 2, 50, 1 << 20), (2, 2, 1, 6, 900), (3, 5, 2, 9, 2000), (4, 3, 2, 7, 500)):
        rows = corpus(seed)
        got = {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in line_dedup(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA), t, gram, words, block_bytes=block).collect()}
        assert got == brute.line_dedup(rows, t, words)


def test_odd_rows(spark):
    text = "a\nb\nc\nd"
    rows = [(None, text), (None, None), (4, text), (4, text), (9, ""), (10, None), (11, text + "\n" + "z" * 300_000), (12, "\n" * 9)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    got = sorted((r.doc_id if r.doc_id is not None else 99, r.n_lines, r.n_removed, len(r.text), r.dest) for r in line_dedup(docs, carry=("dest",), block_bytes=100).collect())
    assert got == [(4, 4, 0, 7, 1), (4, 4, 0, 7, 1), (9, 1, 0, 0, 1), (10, 1, 0, 0, 1), (11, 5, 4, 300_000, 1), (12, 10, 9, 0, 1), (99, 1, 0, 0, 1), (99, 4, 4, 0, 1)]


def test_texts_of_a_pattern(spark):
    """Lines whose polynomials would cancel out are different lines."""
    bits = [bin(i).count("1") & 1 for i in range(1024)]
    one, other = ("".join("ab"[b ^ k] for b in bits) for k in (0, 1))
    rows = [(2, f"{one}\nx\ny"), (3, f"{other}\nx\ny")]
    assert sorted((r.doc_id, r.n_removed) for r in line_dedup(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)).collect()) == [(2, 0), (3, 0)]


def test_empty(spark):
    assert line_dedup(spark.createDataFrame([], SCHEMA)).collect() == []


def test_lines_of_one_hash(spark):
    rows = [(1, f"{ONE}\nx\ny"), (2, f"{OTHER}\nx\ny"), (3, ONE), (4, OTHER), (5, " ".join([ONE] * 60)), (6, " ".join([OTHER] * 60)), (7, ONE)]
    got = line_dedup(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)).collect()
    assert sorted((r.doc_id, r.n_removed) for r in got) == [(1, 0), (2, 0), (3, 0), (4, 0), (5, 0), (6, 0), (7, 1)]
