"""Plain versions of the operators, for small inputs."""

import hashlib
import re


def sha(b):
    return hashlib.sha256(b).hexdigest()


def substring_dedup(rows, window):
    """rows: (doc_id, text). Returns {doc_id: (n_words, n_removed, sha)}; doc_ids are distinct."""
    first = {}
    words = {d: re.findall(r"[^\x20\x09-\x0D]+", t or "") for d, t in rows}
    for d in sorted(words):
        for i in range(len(words[d]) - window + 1):
            first.setdefault(tuple(words[d][i : i + window]), d)
    out = {}
    for d, w in words.items():
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < d:
                gone[i : i + window] = [True] * window
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out[d] = (len(w), sum(gone), sha(" ".join(kept).encode()))
    return out


def suffix_dedup(rows, length):
    """rows: (doc_id, text). Returns {doc_id: (n_bytes, n_removed, n_spans, sha)}; doc_ids are distinct."""
    seen, out = set(), {}
    for d, t in sorted(rows):
        b = (t or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if b[i : i + length] in seen:
                gone[i : i + length] = [True] * length
            seen.add(b[i : i + length])
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(g and not p for p, g in zip([False, *gone], gone, strict=False))
        out[d] = (len(b), sum(gone), spans, sha(kept))
    return out


def line_dedup(rows, t, min_words=50):
    """rows: (doc_id, text). Returns {doc_id: (n_lines, n_removed, text)}; doc_ids are distinct."""
    seen, out = set(), {}
    for d, text in sorted(rows):
        lines = (text or "").split("\n")
        words = [len(re.findall(r"[^\x20\x09-\x0D]+", x)) for x in lines]
        gone = [False] * len(lines)
        for i in range(len(lines)):
            for size in range(1, t + 1):
                if i + size <= len(lines) and (size == t or sum(words[i : i + size]) >= min_words):
                    run = tuple(lines[i : i + size])
                    if run in seen:
                        gone[i : i + size] = [True] * size
                    seen.add(run)
        if len(lines) < t and sum(words):
            if ("whole", *lines) in seen:
                gone = [True] * len(lines)
            seen.add(("whole", *lines))
        out[d] = (len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone, strict=True) if not g))
    return out


def near_classes(rows, threshold, k, plain=False):
    """rows: (doc_id, text) with distinct ids. Returns ({doc_id: class_id}, links) by all pairs, weighted as the operator does."""
    import math
    from collections import Counter

    import numpy as np

    from scholmill.llm import blocks as B
    from scholmill.llm.near_dedup import word_place

    def place(word):
        data = np.frombuffer(word.encode(), np.uint8)
        return int(word_place(B.words(np.array([0, len(data)]), data)[0])[0])

    words = {d: (t or "").split() for d, t in rows}
    places = {w: place(w) for x in words.values() for w in x}
    df, n = Counter(p for x in words.values() for p in {places[w] for w in x}), len(rows)
    grams = {d: Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else Counter([tuple(w)] if w else []) for d, w in words.items()}

    def idf(g):
        return sum(round(1024 * (1 + max(0.0, math.log((1 + n) / (1 + df[places[w]]))) / math.log(1 + max(n, 2)))) for w in g) / (1024 * len(g))

    vec = {d: {g: c * idf(g) for g, c in x.items()} for d, x in grams.items()}
    label, links = {d: d for d in vec}, {}
    ids = sorted(vec)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            keys = vec[a].keys() | vec[b].keys()
            top = sum(max(vec[a].get(g, 0), vec[b].get(g, 0)) for g in keys)
            s = sum(min(vec[a].get(g, 0), vec[b].get(g, 0)) for g in keys) / top if top else 0
            if plain and keys:
                s = max(s, len(vec[a].keys() & vec[b].keys()) / len(keys))
            if s >= threshold:
                links[a, b] = s
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = {d: new if x == old else x for d, x in label.items()}
    return label, links


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def pii_base(text):
    out = []
    for kind, pattern in PII.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind != "ip" or all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split(".")), "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)
