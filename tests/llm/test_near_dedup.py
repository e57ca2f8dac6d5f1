import random

import numpy as np
import pyarrow as pa

from scholmill.llm import near_dedup as N
from scholmill.llm.near_dedup import NearDedup, Sampler, near_dedup
from scholmill.llm.query_dedup import op3_near_dedup
from scholmill.operators.components import components
from tests.llm import brute

SCHEMA = "doc_id long, text string, bucket int, first string, weight double"


def corpus(seed, n=90):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(n):
        kind = rng.random()
        if rows and kind < 0.25:
            text = rng.choice(rows)[1]
        elif rows and kind < 0.7:
            w = rng.choice(rows)[1].split()
            for _ in range(max(1, len(w) // 60)):
                if w:
                    w[rng.randrange(len(w))] = rng.choice(words)
            text = " ".join(w)
        else:
            text = " ".join(rng.choices(words, k=rng.choice([0, 2, 30, 120, 400])))
        rows.append((i * 5 + 1, text))
    return rows


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 0.5) for r in rows], SCHEMA)


def test_classes(spark):
    rows = corpus(1)
    want, _ = brute.near_classes(rows, 0.8, 5)
    got = {r.doc_id: r.class_id for r in near_dedup(table(spark, rows), bands=30, rows=2).collect()}
    assert got == want


def test_leaders_and_the_rest(spark, monkeypatch):
    """A chain whose ends are no links: only members of different components that meet again join it."""
    rng = random.Random(4)
    base = [f"v{i}" for i in range(200)]
    rows = []
    for i in range(40):
        w = list(base)
        for j in rng.sample(range(200), rng.choice([1, 2, 2, 3])):
            w[j] = f"x{i}_{j}"
        rows.append((i, " ".join(w)))
    want, links = brute.near_classes(rows, 0.8, 5)
    monkeypatch.setattr(N, "BLOCK_ROWS", 7)
    for drawn, small in ((0, 1000), (1, 4), (0, 1)):
        d = NearDedup(table(spark, rows), bands=40, rows=1)
        found = components(d.links(drawn, small), "x", "y").collect()
        label = {r.node: r.label for r in found}
        assert {i: label.get(i, i) for i, _ in rows} == want
    assert links


def test_blocks_of_a_large_bucket(spark, monkeypatch):
    """Groups that share half of their words meet in buckets led by one of them; the others find each other block by block."""
    rng, rows = random.Random(6), []
    shared = [f"v{i}" for i in range(100)]
    for i in range(60):
        w = shared + [f"g{i % 4}_{j}" for j in range(80)]
        w[rng.randrange(180)] = f"x{i}"
        rows.append((i, " ".join(w)))
    want, _ = brute.near_classes(rows, 0.8, 5)
    assert len(set(want.values())) == 4
    monkeypatch.setattr(N, "BLOCK_ROWS", 7)
    called, compare = [], NearDedup.compare
    monkeypatch.setattr(NearDedup, "compare", lambda self, open_: called.append(1) or compare(self, open_))
    d = NearDedup(table(spark, rows), bands=2, rows=1)
    label = {r.node: r.label for r in components(d.links(0, 1), "x", "y").collect()}
    assert {i: label.get(i, i) for i, _ in rows} == want and called


def test_large_group_of_near_copies(spark, tmp_path, monkeypatch):
    """Texts of one group whose plain similarities are 0.81 are one class, although their shared shingles weigh least."""
    rows = []
    for i in range(120):
        w = [f"v{j}" for j in range(200)]
        for j in (30, 80, 130, 180):
            w[j] = f"x{i}_{j}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join(f"y{i}_{j}" for j in range(200))) for i in range(600)]
    grams = [{tuple(t.split()[i : i + 5]) for i in range(196)} for _, t in rows[:120]]
    assert all(0.8 <= len(a & b) / len(a | b) for a in grams for b in grams)
    table(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    want = {i: 0 if i < 120 else i for i, _ in rows}
    assert {r.doc_id: r.class_id for r in op3_near_dedup(spark, str(tmp_path)).collect()} == want
    # the pairs compared block by block
    monkeypatch.setattr(N, "BLOCK_ROWS", 16)
    d = NearDedup(table(spark, rows[:60]), bands=14, rows=4, plain=True)
    label = {r.node: r.label for r in components(d.links(0, 1), "x", "y").collect()}
    assert {label.get(i, i) for i in range(60)} == {0}


def test_plain_similarities():
    rng = random.Random(9)
    texts = [" ".join(rng.choices("abc", k=rng.randint(5, 40))) for _ in range(30)]
    sets = [{tuple(t.split()[i : i + 2]) for i in range(len(t.split()) - 1)} for t in texts]
    weights = np.full(N.WORDS, 1024)
    t = pa.table({"text": texts})
    plain = np.array([[len(a & b) / len(a | b) for b in sets] for a in sets])
    blocks = N.block_similarities(t, t, 2, weights, plain=True)
    assert np.allclose(blocks, np.maximum(plain, N.block_similarities(t, t, 2, weights)))
    x, y = (np.repeat(np.arange(30), 30), np.tile(np.arange(30), 30))
    pairs = N.similarities(pa.array([texts[i] for i in x]), pa.array([texts[i] for i in y]), 2, weights, plain=True)
    assert np.allclose(pairs.reshape(30, 30), blocks)


def test_samples_estimate_weighted_jaccard():
    rng = np.random.default_rng(3)
    h = rng.integers(0, 1 << 62, 400, dtype=np.int64).astype(np.uint64)
    a, b = rng.uniform(0.5, 4, 400), None
    b = a * np.where(rng.random(400) < 0.3, rng.uniform(0.4, 2.5, 400), 1)
    s = Sampler(300, 1)
    same = (s.signatures(h, np.log(a), np.array([0])) == s.signatures(h, np.log(b), np.array([0]))).mean()
    assert abs(same - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.07


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)]
    label = {v: v for e in links for v in e}
    for _ in range(400):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {k: v for k, v in label.items() if any(k in e and e[0] != e[1] for e in links)} == got


def test_odd_rows(spark):
    text = " ".join(f"a{i}" for i in range(30))
    rows = [(None, text), (None, None), (4, text), (4, text), (9, ""), (10, None), (11, " " + text + "\n"), (12, "z " * 100_000), (13, "y"), (14, "y")]
    got = sorted(((r.doc_id or 0, r.class_id or 0) for r in near_dedup(table(spark, rows)).collect()))
    assert got == [(0, 0), (0, 0), (4, 4), (4, 4), (9, 9), (10, 10), (11, 4), (12, 12), (13, 13), (14, 13)]
    assert near_dedup(table(spark, [])).collect() == []


def test_texts_of_a_pattern(spark):
    """Words and texts whose polynomials would cancel out are no copies."""
    bits = [bin(i).count("1") & 1 for i in range(1024)]
    rows = [(3, "".join("ab"[b] for b in bits)), (4, "".join("ba"[b] for b in bits)), (5, " ".join("ab"[b] for b in bits)), (6, " ".join("ba"[b] for b in bits))]
    got = {r.doc_id: r.class_id for r in near_dedup(table(spark, rows)).collect()}
    want, _ = brute.near_classes(rows, 0.8, 5)
    assert got[4] == 4 and (got[5] == got[6]) == (want[5] == want[6])


def test_words_of_one_hash(spark):
    from tests.llm.test_substring_dedup import ONE, OTHER

    got = {r.doc_id: r.class_id for r in near_dedup(table(spark, [(1, ONE), (2, OTHER), (3, ONE)])).collect()}
    assert got[1] == got[3] != got[2]
