import itertools
import random

import numpy as np

from scholmill.llm import language_id as L
from scholmill.llm.language_id import crc, held_out, identify, train, viterbi
from scholmill.llm.query_models import op10_language_id

EN = "the house and the river with other things that were there when they thought about water".split()
DE = "das haus und der fluss mit anderen dingen die dort waren als sie über wasser nachdachten".split()
RU = "дом и река с другими вещами которые были там когда они думали о воде".split()
SCHEMA = "doc_id long, text string, lang string, spans int, score string"


def test_viterbi_is_optimal():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5):
        scores = rng.normal(size=(n, 3)).astype(np.float32)
        got = viterbi(scores, np.ones((n, 3), bool), np.zeros(n, int), 1, 0.7)

        def value(path, scores=scores, n=n):
            return sum(scores[i, p] for i, p in enumerate(path)) - 0.7 * sum(path[i] != path[i - 1] for i in range(1, n))

        assert abs(value(got) - max(value(p) for p in itertools.product(range(3), repeat=n))) < 1e-5


def test_many_labels():
    scores = np.zeros((3, 200), np.float32)
    scores[0, 150], scores[1:, 3] = 9, 9
    assert viterbi(scores, np.ones((3, 200), bool), np.zeros(3, int), 1, 0.5).tolist() == [150, 3, 3]


def plain(model, text, penalty, cap):
    """Label of every word by the textbook recursion in double precision."""
    words = L.Words([text])
    scores = L._scores(model, words, L._scripts(words, 1), cap).astype(float)
    state, back = scores[0], []
    for s in scores[1:]:
        step = state[:, None] - penalty * (1 - np.eye(len(s)))
        back.append(step.argmax(0))
        state = step.max(0) + s
    path = [int(state.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]


def test_long_texts_are_labelled_as_a_whole(spark, monkeypatch):
    """Slices of a long text give the labels of the textbook recursion over all of it."""
    model, rng = train(training(spark)), random.Random(5)
    text = " ".join(w for _ in range(30) for w in rng.choices(rng.choice([EN, DE, RU]), k=rng.randint(2, 9)))
    want = plain(model, text, 12.0, 8)
    for size, held in ((40, 50), (333, 10**6), (10**6, 10**6), (60, 10**6)):
        monkeypatch.setattr(L, "SLICE", size)
        monkeypatch.setattr(L, "HELD", held)
        row, start, end, label, letters = L._label(model, [text], 12.0, 8)
        assert label.tolist() == want and [text[s:e] for s, e in zip(start, end, strict=True)] == text.split() and letters.sum() == sum(map(len, text.split()))
    assert len(set(want)) == 3


def test_query_against_plain_labels(spark):
    """The query's language and score of whole texts from the textbook recursion with the same model."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = train(docs.filter(~held_out()))
    got = {r.doc_id: (r.lang_pred, r.score) for r in op10_language_id(spark, sf).collect()}
    for r in docs.limit(150).collect():
        words = L.Words([r.text or ""])
        if not len(words.size):
            assert got[r.doc_id] == ("und", 0.0)
            continue
        letters = np.bincount(plain(model, r.text, 12.0, 8), weights=words.size, minlength=len(model.languages))
        assert got[r.doc_id][0] == model.languages[letters.argmax()] and abs(got[r.doc_id][1] - letters.max() / letters.sum()) < 1e-9


def training(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices({"en": EN, "de": DE, "ru": RU}[g], k=40)), g, 1, "x") for i in range(60) for g in ("en", "de", "ru")]
    return spark.createDataFrame([*rows, (999, "???", None, 1, "x"), (1000, None, "en", 1, "x")], SCHEMA)


def test_mixed_text(spark):
    model = train(training(spark))
    text = " ".join(EN[:8]) + ". " + " ".join(DE[:9]) + ", " + " ".join(RU[:4])
    rows = [(1, text, None, 1, "x"), (2, "", None, 1, "x"), (3, None, None, 1, "x"), (4, "12 + 34!", None, 1, "x"), (None, "река вода дом", "en", 1, "x"), (6, " ".join(EN) * 3000, "x", 1, "x"), (6, "ΩΨ 漢字", "x", 1, "x"), (7, "😀 🚀 12", "x", 1, "x"), (8, "x" * 900_000, "x", 1, "x")]
    got = identify(spark.createDataFrame(rows, SCHEMA), model, carry=("doc_id",)).collect()
    spans = [(text[s.start : s.end], s.lang) for s in got[0].spans]
    assert spans == [(" ".join(EN[:8]), "en"), (" ".join(DE[:9]), "de"), (" ".join(RU[:4]), "ru")]
    assert [(r.doc_id, r.lang_pred) for r in got[1:6]] == [(2, "und"), (3, "und"), (4, "und"), (None, "ru"), (6, "en")]
    assert [r.score for r in got[1:4]] == [0, 0, 0] and got[5].score == 1 and got[6].lang_pred in ("de", "en", "ru")
    assert got[7].lang_pred == "und" and got[8].lang_pred in ("de", "en", "ru") and got[8].score == 1


def test_nothing_to_learn(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert identify(empty, train(empty)).collect() == []
    rows = spark.createDataFrame([(1, "the house", None, 1, "x")], SCHEMA)
    assert [r.lang_pred for r in identify(rows, train(empty)).collect()] == ["und"]


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = op10_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (crc(r.doc_id) % 4 == 2) for r in got)
    tested = [r for r in got if r.held_out]
    assert len(tested) > 150 and sum(r.lang == r.lang_pred for r in tested) / len(tested) > 0.98


def test_held_out_of_null(spark):
    assert [r[0] for r in spark.createDataFrame([(None,)], "doc_id long").select(held_out()).collect()] == [False]
