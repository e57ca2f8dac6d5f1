import random

from scholmill.llm import blocks as B
from scholmill.llm import substring_dedup as S
from scholmill.llm.substring_dedup import COVERS, substring_dedup
from tests.llm import brute

#: Two words that one of the two word hashes takes for the same.
ONE = "smcashqkvffngxx9ah3xvl6x4gnk3f0zm45wa5qxujcfudg6cpealw5gq1hce398"
OTHER = "gfib7j664uip9z7n5l22yxrp1cooj4ttrzw0lrr9227m89extw0dm6cedji8trzc"

SCHEMA = "doc_id long, text string, block string, dest int"


def corpus(seed, n=60, vocabulary=40):
    rng = random.Random(seed)
    words = [f"w{i}é" for i in range(vocabulary)]
    passages = [" ".join(rng.choices(words, k=rng.randint(8, 30))) for _ in range(6)]
    rows = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.2 and rows:
            text = rng.choice(rows)[1]
        elif kind < 0.6:
            text = " \n".join([" ".join(rng.choices(words, k=rng.randint(0, 25))), rng.choice(passages), "\t".join(rng.choices(words, k=rng.randint(0, 25)))])
        elif kind < 0.7:
            text = "same " * rng.randint(1, 60)
        else:
            text = " ".join(rng.choices(words, k=rng.randint(0, 80)))
        rows.append((i * 3, text))
    return rows


def test_covers():
    for v, d in COVERS.items():
        assert {(a - b) % v for a in d for b in d} == set(range(v))


def test_matches_brute_force(spark):
    for seed, window, block in ((1, 20, 1 << 20), (2, 12, 1500), (3, 45, 900)):
        rows = corpus(seed)
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring_dedup(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA), window, digest=True, block_bytes=block).collect()}
        assert got == brute.substring_dedup(rows, window)


def test_odd_rows(spark):
    text = " ".join(f"a{i}" for i in range(20))
    rows = [(None, text), (None, None), (4, text), (4, text), (9, ""), (10, None), (11, text + " " + "z" * 300_000), (-5, "b")]
    got = sorted((r.doc_id if r.doc_id is not None else 99, r.n_words, r.n_removed, len(r.kept)) for r in substring_dedup(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA), 10, block_bytes=2000).collect())
    assert got == [(-5, 1, 0, 1), (4, 20, 0, 69), (4, 20, 0, 69), (9, 0, 0, 0), (10, 0, 0, 0), (11, 21, 20, 300_000), (99, 0, 0, 0), (99, 20, 20, 0)]


def test_empty(spark):
    assert substring_dedup(spark.createDataFrame([], SCHEMA)).collect() == []


def pattern(n, k=0):
    """A Thue-Morse sequence of n bits, or its complement: polynomials of the two agree modulo 2**64 from 1024 on."""
    return [(bin(i).count("1") & 1) ^ k for i in range(n)]


def test_texts_of_a_pattern(spark):
    """Words whose polynomials would cancel out are different words, and so are texts."""
    one, other = ("".join("ab"[b] for b in pattern(1024, k)) for k in (0, 1))
    rest = " ".join(f"w{i}" for i in range(49))
    words = [" ".join(("yes", "no")[b] for b in pattern(1024, k)) for k in (0, 1)]
    rows = [(1, f"{one} {rest}"), (2, f"{other} {rest}"), (3, words[0]), (4, words[1])]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring_dedup(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA), digest=True).collect()}
    assert got == brute.substring_dedup(rows, 50)


def test_rows_exchanged_grow_with_the_text(spark):
    """A block's question has a row for each of its fingerprints, however many blocks there are."""
    rng, counts = random.Random(3), []
    for n in (100, 200, 400):
        rows = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(60))) for i in range(n)]
        dealt, blocks = B.dealt(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA), 4000)
        counts.append(dealt.groupBy("block").applyInArrow(S._ask_anchors(50), B.ASKED).count())
        assert blocks > n / 10
    print("rows asked for 100, 200 and 400 texts:", counts)
    assert counts[1] == 2 * counts[0] and counts[2] == 4 * counts[0]


def test_words_of_one_hash(spark):
    """Windows that differ in a word whose hash is the other's are different."""
    rest = " ".join(f"w{i}" for i in range(49))
    rows = [(1, f"{ONE} {rest}"), (2, f"{OTHER} {rest}"), (3, f"{rest} {ONE} {rest}"), (4, f"{rest} {OTHER} {rest}")]
    got = substring_dedup(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA), window=50).collect()
    assert sorted((r.doc_id, r.n_removed) for r in got) == [(1, 0), (2, 0), (3, 50), (4, 50)]
