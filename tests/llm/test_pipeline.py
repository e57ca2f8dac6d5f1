import random
from collections import defaultdict

import corpus_pipeline
from scholmill.llm.language_id import UNDETERMINED
from tests.llm import brute
from tests.llm.test_decontamination import brute as leaks

EN = "the house and river with other things that were there when they thought about water mountain forest".split()
DE = "das haus und fluss mit anderen dingen die dort waren als sie über wasser berg wald nachdachten".split()


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = {"en": EN + [f"{w}{v}" for w in EN for v in EN[:6]], "de": DE + [f"{w}{v}" for w in DE for v in DE[:6]]}
    text = lambda g, n: " ".join(rng.choices(vocabulary[g], k=n))
    items = [(i, text("en", 14) + ".\n" + text("en", 4) + ".") for i in range(8)]
    rows = []
    for i in range(120):
        g = rng.choice(["en", "de"])
        kind = rng.random()
        if rows and kind < 0.15:
            body = rng.choice(rows)[1]
        elif rows and kind < 0.3:
            w = rng.choice(rows)[1].split(" ")
            w[rng.randrange(len(w))] = "edited"
            body = " ".join(w)
        elif kind < 0.4:
            body = text("en", 30) + "\n" + rng.choice(items)[1] + "\n" + text("en", 30)
        elif kind < 0.45:
            body = "12 + 3 = 15 !!"
        else:
            body = "\n".join(text(g, rng.randint(5, 60)) for _ in range(rng.randint(1, 6)))
        rows.append((i, body, g, f"src{i % 3}", len(body)))
    return rows, items


def test_stages_against_plain_versions(spark, tmp_path):
    rows, items = corpus(1)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        before = {r.doc_id: r for r in docs.collect()}
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == corpus_pipeline.COLUMNS
        after = {r.doc_id: r for r in docs.collect()}
        if k == 0:
            assert after == {i: r for i, r in before.items() if any(c.isalpha() for c in r.text)} and len(after) < len(before)
        elif k == 1:
            plain = brute.line_dedup([(i, r.text) for i, r in before.items()], 3)
            assert {i: r.text for i, r in after.items()} == {i: x[2] for i, x in plain.items() if x[2].strip()}
            assert all(r.n_chars == len(r.text) for r in after.values()) and len(after) < len(before)
        elif k == 2:
            label, _ = brute.near_classes([(i, r.text) for i, r in before.items()], 0.8, 5, plain=True)
            assert after == {i: r for i, r in before.items() if label[i] == i} and len(after) < len(before)
        else:
            found = {d for d, _ in leaks([(i, r.text) for i, r in before.items()], items, 0.6, 0.8, 5)}
            assert after == {i: r for i, r in before.items() if i not in found} and found
    last = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in last} == set(after)
    seqs = defaultdict(int)
    for r in last:
        seqs[r.sequence_id] += r.length
    assert max(seqs.values()) <= 2048 and len(seqs) <= -(-sum(seqs.values()) // 2048) + 1
    assert UNDETERMINED == "und"


def test_odd_rows(spark, tmp_path):
    """Null and repeated ids, null and empty texts, null languages and further columns with names that the operators use."""
    rows, items = corpus(2)
    odd = [(None, rows[0][1] + " without id", "en", None, None), (None, None, "en", "s", 1), (500, "", "en", "s", 0), (501, None, None, None, None), (502, rows[1][1] + " no language", None, "s", None), (503, rows[2][1] + " again", "de", "s", 9), (503, rows[2][1] + " again", "de", "s", 9), (504, "the house " * 60_000, "en", "s", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, block long, label string, x int, row int"
    for name, some in (("odd", [(*r, 1, "x", 2, 3) for r in rows + odd]), ("none", [])):
        spark.createDataFrame(some, schema).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/odd/documents.parquet")
    seen = []
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, f"{tmp_path}/odd")
        assert docs.columns == corpus_pipeline.COLUMNS
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        seen.append([r.doc_id for r in docs.collect()])
    assert seen[0].count(None) == 1 and not {500, 501} & set(seen[0]) and seen[0].count(503) == 2
    assert all(x.count(None) <= 1 and {502, 504} <= set(x) for x in seen) and seen[3].count(503) <= 1
    last = corpus_pipeline.run(spark, f"{tmp_path}/odd").collect()
    assert {r.doc_id for r in last} == set(seen[3])
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").collect() == []
