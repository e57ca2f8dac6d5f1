import random

import pytest

from scholmill.llm.pii import discovered, personal_data
from scholmill.llm.query_pii import op9_personal_data
from tests.llm import brute

SCHEMA = "doc_id long, text string, base int, units string"


def spans(spark, texts, **kw):
    return [r.asDict() for r in personal_data(spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], SCHEMA), **kw).orderBy("doc_id").collect()]


def test_base_spans(spark):
    rng = random.Random(1)
    pieces = ["a.b@c.d", "x@y", "@", "é@b.co", "a@b.c@d.e", "x@y.z_w@q.r", "+1 (361) 555-8283", "+49 30 123", "+1-2", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "001.02.3.000255", "4111 1111-1111 1111", "4111111111111111", "4111111111111112", "12  34", "5", "-", " ", "\n", ".", "é漢😀", "a", "%", "9.9", "(", "+", "0" * 17, "6011000990139424000"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 14))) for _ in range(700)]
    texts += [" ".join(f"{i}@x.de" for i in range(700)), "1 " * 3000, "7" * 5000 + ".1.2.3", "a." * 4000, "a@" + "b." * 4000 + "c", ""]
    got = spans(spark, texts)
    for r, t in zip(got, texts, strict=True):
        assert r["base"] == brute.pii_base(t), t[:200]
        assert [r[f"n_{k}"] for k in brute.PII] == [sum(s.startswith(k + ":") for s in r["base"].split(",")) for k in brute.PII]


def test_patterns_find_unseen_identifiers(spark):
    texts = [f"please call me at +1 (200) 555-{1000 + i} today" for i in range(6)] + ["please call me at 0049-30-7654 today", "the room me at 0049-30-7654 is", "see version 2023-44 today", "or mail 12345678 to the"]
    got = spans(spark, texts)
    assert got[6]["spans"] == "phone:18:30" and texts[6][18:30] == "0049-30-7654" and got[6]["base"] == "" and got[6]["n_found"] == 1
    assert got[7]["spans"] == "phone:15:27" and got[8]["spans"] == got[9]["spans"] == ""
    assert all(r["spans"] == r["base"] for r in got[:6])
    assert spans(spark, texts, support=7)[6]["spans"] == ""


def plain(contexts, seeds, support, accept, rounds):
    """{value: kind} of what is found; contexts: (value, pattern) pairs, seeds: {value: kind}; by sets, without Spark."""
    edges = set(contexts)
    of = {p: {v for v, q in edges if q == p} for _, p in edges}
    scores, before = {(v, k): 1.0 for v, k in seeds.items()}, None
    for _ in range(rounds):
        confidence = {}
        for p, values in of.items():
            for kind in {k for _, k in scores}:
                got = [scores.get((v, kind), 0) for v in values]
                if sum(x >= accept for x in got) >= support:
                    confidence[p, kind] = sum(got) / len(values)
        scores = {(v, k): 1.0 for v, k in seeds.items()}
        for v, p in edges:
            for kind in {k for q, k in confidence if q == p}:
                if seeds.get(v) != kind:
                    scores[v, kind] = max(scores.get((v, kind), 0), confidence[p, kind])
        known = {(x, round(s, 2)) for x, s in scores.items()}
        if known == before:
            break
        before = known
    best = {}
    for (v, k), s in sorted(scores.items()):
        if v not in seeds and s >= accept and s > best.get(v, (0, 0))[0]:
            best[v] = (s, k)
    return {v: k for v, (s, k) in best.items()}


def test_found_units_bring_their_own_patterns(spark):
    """Seeds find values in their context; these find others in a context where no seed stands."""
    texts = [f"please call me at +1 (200) 555-{1000 + i} today" for i in range(6)] + [f"please call me at 0049-30-765{i} today" for i in range(4)]
    texts += [f"reach office line 0049-30-765{i} daily" for i in range(4)] + ["reach office line 0049-99-1234 daily", "the numbers 2023-44 and 2024-45 are years"]
    got = spans(spark, texts)
    assert got[14]["spans"] == "phone:18:30" and texts[14][18:30] == "0049-99-1234"
    assert all(r["spans"] == "phone:18:30" for r in got[6:15]) and got[15]["spans"] == ""
    with pytest.raises(RuntimeError, match="settle"):
        spans(spark, texts, rounds=1)


def test_many_generations(spark):
    """A chain in which each found group of values brings the pattern that finds the next one."""
    seeds = [(f"s{i}", 0, ["p0"]) for i in range(3)]
    chain = [(f"v{g}-{i}", -1, [f"p{g}", f"p{g + 1}"]) for g in range(14) for i in range(3)]
    found = discovered(spark.createDataFrame(seeds + chain, "value string, kind int, patterns array<string>"), support=3, accept=0.4)
    assert {r.value for r in found.collect()} == {v for v, _, _ in chain[: 3]} | {v for v, _, p in chain if p}


def test_graph_against_the_plain_version(spark):
    rng = random.Random(8)
    values = [f"v{i}" for i in range(60)]
    units = [(v, -1, [f"p{rng.randrange(6) + 6 * (i % 4)}", f"q{rng.randrange(5) + 5 * (i % 4)}"]) for i, v in enumerate(values) for _ in range(rng.randint(1, 3))]
    seeds = {v: i % 2 for i, v in enumerate(values) if i % 4 < 2 and rng.random() < 0.7}
    rows = [(v, seeds.get(v, -1), p) for v, _, p in units]
    frame = spark.createDataFrame(rows, "value string, kind int, patterns array<string>")
    for accept, support in ((0.6, 2), (0.4, 1), (0.7, 3)):
        got = {r.value: r.kind for r in discovered(frame, support, accept, 8).collect()}
        assert got == plain([(v, p) for v, _, ps in units for p in ps], seeds, support, accept, 8)
        assert got or accept == 0.7


def test_odd_rows(spark):
    rows = [(None, "a@b.cd"), (None, None), (3, "a@b.cd"), (3, "a@b.cd"), (4, ""), (5, "w " * 200_000 + "+1 361 555 8283")]
    got = sorted(((r.doc_id or 0, r.spans) for r in personal_data(spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)).collect()))
    assert got == [(0, ""), (0, "email:0:6"), (3, "email:0:6"), (3, "email:0:6"), (4, ""), (5, "phone:400000:400015")]
    assert spans(spark, []) == []


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op9_personal_data(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        want = brute.pii_base(texts[r.doc_id])
        assert r.base_sha256 == brute.sha(want.encode())
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))
