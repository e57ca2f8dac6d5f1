import math
import random
import re
import weakref

from scholmill.llm import decontamination as D
from scholmill.llm.query_decontamination import op4_decontamination

SCHEMA = "doc_id long, text string, item_id int, bm25 string"


def words(t):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", (t or "").lower())


def brute(docs, items, retrieve, overlap, k):
    """Scores of every passage for every item."""
    items = [(i, t) for i, t in items if t and words(t)]
    tok = {i: words(t) for i, t in items}
    n, mean = len(items), sum(map(len, tok.values())) / len(items)
    df = {w: sum(w in t for t in tok.values()) for t in tok.values() for w in t}

    def impact(w, i):
        tf = tok[i].count(w)
        return math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(tok[i]) / mean)) if tf else 0.0

    def grams(t):
        m = min(k, len(t))
        return {tuple(t[j : j + m]) for j in range(len(t) - m + 1)} if m else set()

    own = {i: sum(impact(w, i) for w in set(tok[i])) for i in tok}
    out = {}
    for d, text in docs:
        t = words(text)
        for i, item in items:
            L = D.length_class(len(tok[i]), k)
            for s in range(0, max(1, -(-len(t) // L) - 1) * L, L):
                p = t[s : s + 2 * L]
                score = sum(impact(w, i) for w in set(p))
                if score >= retrieve * own[i] * (1 - 1e-4):
                    shares = []
                    for part in map(words, D.question_and_answer(item)):
                        m = min(k, len(part))
                        has = {tuple(p[j : j + m]) for j in range(len(p) - m + 1)} if m else set()
                        shares.append(len(grams(part) & has) / len(grams(part)) if m else 1.0)
                    if min(shares) >= overlap:
                        out[d, i] = max(out.get((d, i), 0), score)
    return out


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"Wörd{i}" for i in range(60)] + ["the", "of", "and"] * 15
    text = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(i, text(rng.randint(8, 25)) + rng.choice([". ", "\n", "? "]) + text(rng.randint(1, 8))) for i in range(50)]
    docs = []
    for d in range(40):
        parts = [text(rng.randint(0, 90))]
        if rng.random() < 0.6:
            w = rng.choice(items)[1].split(" ")
            if rng.random() < 0.4:
                w[rng.randrange(len(w))] = "changed"
            parts += [" ".join(w), text(rng.randint(0, 90))]
        docs.append((d, "\n".join(parts)))
    return docs, items


def test_matches_brute_force(spark, monkeypatch):
    for seed in (1, 2):
        docs, items = corpus(seed)
        got = {(r.doc_id, r.item_id): r.bm25 for r in D.contaminated(spark.createDataFrame([(*d, 1, "x") for d in docs], SCHEMA), spark.createDataFrame(items, "item_id long, text string"), overlap=0.6).collect()}
        want = brute(docs, items, 0.6, 0.6, 5)
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-3 * want[k] for k in want) and len(want) > 10


def test_passes_and_shards_find_the_same_leaks(spark, monkeypatch):
    docs, items = corpus(3)
    table, bench = spark.createDataFrame([(*d, 1, "x") for d in docs], SCHEMA), spark.createDataFrame(items, "item_id long, text string")
    found = lambda: {(r.doc_id, r.item_id): (round(r.bm25, 9), r.question_overlap, r.answer_overlap) for r in D.contaminated(table, bench, overlap=0.5).collect()}
    whole, leaks = found(), {(r.doc_id, r.item_id) for r in D.contaminated(table, bench).collect()}
    monkeypatch.setattr(D, "SHARD_ITEMS", 7)
    monkeypatch.setattr(D, "PASS_BYTES", 2000)
    monkeypatch.setattr(D, "FAN", 2)
    assert found() == whole and len(whole) > 10
    want = brute(docs, items, 0.6, 0.5, 5)
    assert whole.keys() == want.keys() and all(abs(whole[k][0] - want[k]) < 1e-6 for k in want)
    kept = {r.doc_id for r in D.clean(table, bench).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in leaks}


def test_driver_holds_the_shards_of_one_pass(spark, monkeypatch):
    docs, items = corpus(4)
    live, most = weakref.WeakSet(), []

    build = D.Shard.__init__

    def counted(self, *args):
        build(self, *args)
        live.add(self)
        most.append(len(live))

    monkeypatch.setattr(D.Shard, "__init__", counted)
    table, bench = spark.createDataFrame([(*d, 1, "x") for d in docs], SCHEMA), spark.createDataFrame(items, "item_id long, text string")
    whole = {(r.doc_id, r.item_id) for r in D.contaminated(table, bench).collect()}
    one = max(most)
    monkeypatch.setattr(D, "PASS_BYTES", 400)
    most.clear()
    live.clear()
    assert {(r.doc_id, r.item_id) for r in D.contaminated(table, bench).collect()} == whole
    assert len(most) > 8 * one and max(most) <= one + 1
    most.clear()
    assert {r.doc_id for r in D.clean(table, bench).collect()} == {d for d, _ in docs} - {d for d, _ in whole}
    assert len(most) > 8 * one and max(most) <= one + 1


def test_odd_rows(spark):
    item = "what is the longest river of the northern land\nthe long one they say"
    docs = [(None, "x " * 500 + item), (1, None), (2, ""), (3, item.upper()), (3, item.upper()), (4, "what is the longest river of the northern land"), (5, "a " * 200_000 + item)]
    table = spark.createDataFrame([(*d, 1, "x") for d in docs], SCHEMA)
    bench = spark.createDataFrame([(7, item), (8, item), (9, None), (None, item), (10, "..."), (11, "other words that never occur anywhere")], "item_id long, text string")
    got = sorted((r.doc_id or 0, r.item_id) for r in D.contaminated(table, bench).collect())
    assert got == [(0, 7), (0, 8), (3, 7), (3, 7), (3, 8), (3, 8), (5, 7), (5, 8)]
    assert D.contaminated(table, bench.limit(0)).collect() == [] and D.contaminated(table.limit(0), bench).collect() == []
    assert D.clean(table, bench.limit(0)).count() == 7 and D.clean(table, bench).columns == table.columns


def test_planted_items(spark):
    sf = "/root/testdata/sf0.01"
    got = {(r.doc_id, r.item_id) for r in op4_decontamination(spark, sf).collect()}
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    assert {(d, i) for d, t in docs.items() for i, x in items.items() if x in t} <= got
