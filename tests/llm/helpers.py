"""Small document tables and brute-force twins."""

import hashlib
import random
from collections import Counter, defaultdict

import xxhash

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Columns whose names the operators use themselves.
CLASHES = (
    "size bigint, line string, fp bigint, n bigint, row bigint, word string, path bigint, kept string, "
    "_id string, _hash bigint, _removed string, _lang string, _source string, text_hash bigint, "
    "mine string, theirs string, found string, chars bigint, component bigint, removed string"
)
VOCABULARY = "the of and in to thing house river stone cloud green walk under over bright seven".split()
LONG = " ".join(f"w{i % 977}" for i in range(60_000))


def frame(spark, rows, extra=False):
    schema = f"{DOCS}, {CLASHES}" if extra else DOCS
    tail = (1, "x", 2, 3, 4, "y", 5, "z", "i", 6, "r", "l", "s", 7, "m", "t", "f", 8, 9, "g") if extra else ()
    full = [(d, t, *(list(more) + ["en", "a"][len(more):]), len(t or ""), *tail) for d, t, *more in rows]
    return spark.createDataFrame(full, schema)


def prose(seed, words, vocabulary=VOCABULARY):
    rng = random.Random(seed)
    return " ".join(rng.choice(vocabulary) + (rng.choice(["", "", "x", "y9"])) for _ in range(words))


def edge_rows():
    text = prose(1, 60)
    return [
        (1, text), (1, text), (2, text), (3, None), (4, ""), (5, " \t\n "), (None, text), (None, None),
        (6, "one"), (7, "é ñ ß x 漢字"), (8, LONG), (9, prose(2, 80), None, None), (9, prose(3, 80), "de", None),
        (10, "\n".join([prose(4, 12)] * 3 + [prose(5, 9)])),
    ]


def groups(nodes, linked):
    """Component of each node as its least member."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def simhash(text, shingle=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def kept_words(texts, window):
    """For each text, its words outside windows that start at two places or more."""
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append([x for x, g in zip(w, gone) if not g])
    return out


def sha(words):
    return hashlib.sha256(b" ".join(words)).hexdigest()


def kept_lines(rows, least):
    """``{(doc_id, text): removed line numbers}`` by comparing all lines with one another."""
    places = defaultdict(list)
    for d, t in set(rows):
        for i, raw in enumerate((t or "").split("\n") if t is not None else []):
            line = raw.strip(" \t\r\x0b\x0c")
            if len(line) >= least:
                places[line].append((d is None, d or 0, t, i))
    lines = sorted(places)
    linked = [(a, b) for i, a in enumerate(lines) for b in lines[i + 1 :] if abs(len(a) - len(b)) < 2 and edits(a, b) < 2]
    classes = defaultdict(list)
    for line, root in groups(lines, linked).items():
        classes[root] += places[line]
    return classes
