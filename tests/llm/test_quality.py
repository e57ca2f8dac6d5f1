import math
import random
import re

import numpy as np
import pyarrow as pa

from scholmill.llm import blocks as B
from scholmill.llm import quality
from scholmill.llm.language_id import crc
from scholmill.llm.query_models import op2_quality


def test_pairs_order_documents():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3))
    y = (x @ [2.0, -1.0, 0.0] + rng.normal(size=400) > -1).astype(int)
    r = quality.Ranker(x, y, 0.3)
    w = r.weights / r.scale
    assert w[0] > 0 > w[1] and abs(w[2]) < 0.3 * abs(w[1])
    assert r.raw(x)[y == 1].mean() > r.raw(x)[y == 0].mean() + 1


def plain_features(text):
    """The features of one text, without numpy."""
    kind = {b: quality._KINDS[k] for b, k in enumerate(quality._KIND)}
    data = (text or "").encode()
    words, size = re.findall(rb"[^\x20\x09-\x0D]+", data), len(data)
    shares = [sum(kind[b] == k for b in data) / max(size, 1) for k in quality._KINDS]
    n = len(words)
    per = lambda f: sum(map(f, range(n))) / max(n, 1)
    distinct, same = len(set(words)) / max(n, 1), per(lambda i: i > 0 and words[i] == words[i - 1])
    lines = data.count(b"\n") + 1
    return [
        *shares, *(v**0.5 for v in shares), distinct, distinct * math.log1p(n), same, same**0.5,
        per(lambda i: len(words[i]) <= 3), per(lambda i: len(words[i]) >= 12), per(lambda i: len(words[i])),
        per(lambda i: kind[words[i][0]] == "upper"), per(lambda i: kind[words[i][-1]] == "other"), per(lambda i: kind[words[i][-1]] == "shout"), per(lambda i: kind[words[i][0]] == "bar"),
        math.log1p(n), math.log1p(size), math.log1p(lines), math.log1p(n / lines), float(n == 0),
    ]


def test_features_against_the_plain_version():
    rng = random.Random(4)
    texts = ["hello ok!", "hello ok! ", "", " ", "a", "wow! wow!\tno|\n|x", "é漢 😀!"] + ["".join(rng.choices("aA1 é!|\n\t.,'", k=rng.randint(0, 60))) for _ in range(200)]
    got = quality.features(*B.utf8(pa.array(texts)))
    assert np.allclose(got, [plain_features(t) for t in texts])


def test_query_against_the_plain_version(spark):
    """Scores of the query from plain features, and its threshold as the quantile of all labelled rows that may teach."""
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if crc(r.doc_id) % 5 and r.doc_id in texts and r.quality in (0, 1)}
    x = {d: plain_features(t) for d, t in texts.items()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("crc32(cast(cast(doc_id AS string) AS binary)) % 5 <> 0")
    for sample in (20_000, 25):
        model = quality.train(docs, spark.createDataFrame(list(labels.items()), "doc_id long, quality int"), sample_rows=sample)
        raw = sorted(model.raw(np.array([x[d] for d in labels])))
        bad = sum(v == 0 for v in labels.values())
        assert raw[bad - 1] <= model.threshold <= raw[bad]
    model = quality.train(docs, spark.createDataFrame(list(labels.items()), "doc_id long, quality int"))
    got = {r.doc_id: (r.score, r.predicted) for r in op2_quality(spark, sf).collect()}
    want = dict(zip(x, model.score(np.array(list(x.values()))), strict=True))
    assert got.keys() == want.keys() and all(abs(got[d][0] - want[d]) < 1e-6 and got[d][1] == int(got[d][0] >= 0.3) for d in want)


def test_texts_stay_where_they_are_read(spark):
    """Where labels are too many for a broadcast, ids and scores meet them in an exchange, no text."""
    rows = [(i, "".join(random.Random(i).choices("abcdefgh 1!", k=4000)), int(i % 3 > 0)) for i in range(500)]
    docs = quality.written(spark.createDataFrame(rows, "doc_id long, text string, quality int"))
    store = spark._jsparkSession.sharedState().statusStore()
    seen = store.executionsCount()
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        quality.train(docs.select("doc_id", "text"), docs.select("doc_id", "quality"), sample_rows=50)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plans = [store.executionsList(k, 1).head().physicalPlanDescription() for k in range(seen, store.executionsCount())]
    moved = [line for plan in plans for line in re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*?)\]", plan)]
    assert any("code#" in line for line in moved) and not any("text#" in line for line in moved), moved


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, "A good text.", 1, "s"), (2, "### $$$ %%%", 1, "s"), (3, None, 1, "s"), (4, "", 1, "s"), (None, "x " * 200_000, 1, "s"), (1, "A good text.", 1, "s")], "doc_id long, text string, y int, score string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (4, 5), (None, 1), (77, 0)], "doc_id long, quality int")
    got = quality.score(docs, quality.train(docs, labels), carry=("doc_id",)).collect()
    assert [r.predicted for r in got[:2]] == [1, 0] and all(0 <= r.score <= 1 for r in got) and len(got) == 6
    assert got[2].score == got[3].score and got[0].score == got[5].score
    none = quality.score(docs, quality.train(docs, labels.limit(0)), carry=("doc_id",)).collect()
    assert {r.score for r in none} == {0.3}
    assert quality.score(docs.limit(0), quality.train(docs, labels)).collect() == []


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = op2_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    assert all(r.held_out == (crc(r.doc_id) % 5 == 0) for r in got)
    tested = [r for r in got if r.held_out]
    right = {q: np.mean([r.predicted == q for r in tested if r.quality == q]) for q in (0, 1)}
    print(right, len(tested))
    assert right[0] > 0.85 and right[1] > 0.95
