"""The conversation trie, the license scan and the spelling variants against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from scholmill.llm import conversation_trie as T
from scholmill.llm import registry
from scholmill.llm import spelling as S
from scholmill.llm.license_scan import license_scan, words_of

SF = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn int, role string, text string"
sha = lambda x: hashlib.sha256(x.encode()).hexdigest()


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [x[1:] for x in sorted(v, key=lambda x: x[:2])] for c, v in own.items()}
    h = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
    return {c: tuple(own.get(c - c % 5, [])[: h[c]] + own[c][h[c] :]) for c in own}


def trie(convs):
    """Nodes by their sequence, in the plain way."""
    members = defaultdict(list)
    for c, seq in convs.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    kids = defaultdict(list)
    for s in members:
        if s:
            kids[s[:-1]].append(s)
    leaves, saved, out = {}, {}, []
    for s in sorted(members, key=len, reverse=True):
        leaves[s] = sum(leaves[k] for k in kids[s]) or 1
        saved[s] = (len(members[s]) - 1) * (len(s[-1][1].encode()) if s else 0) + sum(saved[k] for k in kids[s])
        ends = sha(",".join(map(str, sorted(c for c in members[s] if len(convs[c]) == len(s)))))
        out.append((min(members[s]), len(s), min(members[s[:-1]]) if s else None, len(members[s]), len(kids[s]), leaves[s], saved[s], ends))
    return sorted(out, key=str)


def made(seed, n, words="abc", depth=9):
    rnd = random.Random(seed)
    rows = []
    for c in range(-3, n):
        if c % 7 == 6:
            continue
        copy = c % 3 == 0
        for t in range(4 if copy else rnd.randrange(depth)):
            rows.append((c, t, "user", f"same {t}" if copy else rnd.choice(words) * rnd.randrange(1, 3)))
    return rows


@pytest.mark.parametrize("limit", [1, 4, 256])
def test_trie(spark, limit):
    rows = made(1, 120) + [(200, None, None, None), (200, None, "user", "x"), (200, 3, "user", "é" * 3000), (None, 1, "user", "lost"), (201, 0, "user", "a"), (201, 0, "user", "a")]
    rows += [(300 + k, t, "user", f"nest {t}") for k in range(12) for t in range(k)] + [(500 + k, t, "user", f"long {t}" if t < 90 else f"end {k}") for k in range(0, 15, 5) for t in range(92)]
    df = spark.createDataFrame([(*r, 1) for r in rows], TURNS + ", n_convs int").repartition(5)
    got = T.prefix_trie(T.regrouped(T.conversations(df)), limit=limit)
    assert sorted((tuple(r) for r in got.collect()), key=str) == trie(rebuilt(rows))


def test_trie_without_rows(spark):
    assert T.prefix_trie(T.regrouped(T.conversations(spark.createDataFrame([], TURNS)))).count() == 0


def test_trie_of_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = registry.queries()["op11_conversation_trie"](spark, SF)
    assert sorted((tuple(r) for r in got.collect()), key=str) == trie(rebuilt(rows))


def test_licenses(spark):
    filler = " ".join(f"w{i}" for i in range(200))
    texts = {
        1: None,
        2: "",
        3: "Released under the MIT License. under-the  MIT\nlicense",
        4: f"{filler} Licensed under the Apache License, Version 2.0. {filler}",
        5: "licensed under the GNU General Public License, version 3.",
        6: "under the mit licenses, munder the mit license, the mit license",
        7: "Creative Commons Attribution-NonCommercial 4.0 International License",
        8: "CC-BY_NC é CC BY NC é under the Mıt license under the KMIT license",
        9: f"Permission is hereby granted, free of charge, to any person {filler}",
        10: "Permission is hereby granted to any person obtaining a copy of this software and its associated documentation files, free of charge, to deal in the Software without restriction",
        11: "mit apache",
    }
    docs = spark.createDataFrame([(k, v, 5) for k, v in texts.items()] + [(None, "cc by nc", 1)], "doc_id long, text string, n_words int")
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base, sorted({x.label for x in r.found})) for r in license_scan(docs).collect()}
    assert got[1] == got[2] == (0, 0, None, None, [], [])
    assert got[3] == (9, 2, 1, 5, ["mit"], ["mit"])
    assert got[4] == (408, 1, 203, 203, ["apache-2"], ["apache-2"])
    assert got[5][1:] == (0, None, None, [], ["gpl-3"]) and got[7][5] == ["cc-by-nc"] and got[9][5] == [] and got[10][5] == ["mit"] and got[11][5] == []
    assert got[6][1:] == (0, None, None, [], []) and got[8][1:5] == (2, 0, 4, ["cc-by-nc"]) and got[None][1:5] == (1, 0, 0, ["cc-by-nc"])
    assert license_scan(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        license_scan(docs, phrases=(("a b a", "x"),))
    with pytest.raises(ValueError):
        license_scan(docs, templates=(("x", "a " * 34),))


def test_license_blocks(spark):
    """Filters lose no block: containment of every template in every block, by sets."""
    rnd = random.Random(2)
    words = [f"t{i}" for i in range(30)]
    templates = [(f"l{k}", " ".join(rnd.sample(words, rnd.randrange(1, 9)))) for k in range(25)]
    docs = [(i, " ".join(rnd.choice(words) if rnd.random() < 0.5 else "the" for _ in range(rnd.randrange(120)))) for i in range(150)]
    got = license_scan(spark.createDataFrame(docs, "doc_id long, text string"), templates, (), threshold=0.75, block=16, stride=8)
    found = {(r.doc_id, x.label, x.start, round(x.share, 9)) for r in got.collect() for x in r.found}
    sets, want = [(label, set(words_of(t))) for label, t in templates], set()
    for i, text in docs:
        w = words_of(text)
        for start in range(0, max(len(w) - 16 + 7, 0) // 8 * 8 + 1, 8):
            b = set(w[start : start + 16])
            hits = [(label, s) for label, s in sets if len(s & b) >= 0.75 * len(s)]
            want |= {(i, label, start, round(len(s & b) / len(s), 9)) for label, s in hits if not any(s < o for _, o in hits)}
    assert found == want and len(want) > 300


def variants(docs):
    """Words, forms and roots in the plain way."""
    n = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}
    by = defaultdict(set)
    for w in n:
        for i in range(len(w)):
            by[i, w[:i] + "\0" + w[i + 1 :]].add(w)
    near = defaultdict(set)
    for ws in by.values():
        for w in ws:
            near[w] |= ws - {w}
    for w in n:
        for u in {w[:i] + w[i + 1 :] for i in range(len(w))} & set(n):
            near[w].add(u)
            near[u].add(w)
    form = {}
    for w in n:
        if near[w]:
            best = min(near[w], key=lambda u: (-n[u], u))
            form[w] = best if n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form.get(root):
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if form.get(w) else None))
    return sorted(out)


def test_spelling(spark):
    rnd = random.Random(3)
    stems = ["aabbcc", "colour", "color", "École", "àéîõü", "bananas", "bananna", "x" * 300]
    letters = "abcouéÉ÷"
    docs = [(None, "lonely lonely lonely"), (5, None), (6, ""), (6, "Colour COLOUR colour colour colour")]
    for i in range(400):
        ws = []
        for _ in range(rnd.randrange(30)):
            w = list(rnd.choice(stems))
            for _ in range(rnd.choice([0, 0, 1, 1, 2])):
                k = rnd.randrange(len(w))
                w[k : k + rnd.choice([0, 1])] = rnd.choice(["", rnd.choice(letters)])
            ws.append("".join(w))
        docs.append((i, " ".join(ws)))
    df = spark.createDataFrame([(*d, "z") for d in docs], "doc_id long, text string, word string").repartition(3)
    got = S.spelling_groups(S.varied_words(df)).collect()
    want = variants(docs)
    assert sorted(tuple(r) for r in got) == want and len(want) > 200 and any(r[1] and r[2] != r[1] for r in want)
    assert S.spelling_groups(S.varied_words(df.limit(0))).count() == 0


def test_spelling_of_the_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = registry.queries()["op13_spelling_variants"](spark, SF).collect()
    assert sorted(tuple(r) for r in got) == variants(docs)
