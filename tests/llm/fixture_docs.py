"""A small corpus with the hard cases, and brute-force versions of what the operators give."""

import random
import re
from collections import Counter

import numpy as np
import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, row long, key long, g long, kept boolean, "
          "text_hash long, copies int, copy int, size long, shard int, words string")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def space_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def letter_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))


def corpus(seed=11):
    """(doc_id, text, lang, source): nulls, empties, a long text, near and exact copies, repeated rows, null ids."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéßñ") for _ in range(rng.randint(2, 7))) for _ in range(400)]

    def words(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    rows = []

    def add(text, lang="en", source="s1"):
        rows.append((len(rows), text, lang, source))

    for i in range(30):
        add(" ".join(words(rng.randint(12, 90))), rng.choice(["en", "fr", None]), rng.choice(["s1", "s2", None, "Z"]))
    base = words(120)
    for i in range(12):  # near copies
        copy = list(base)
        for _ in range(i % 4):
            copy[rng.randrange(len(copy))] = "changed"
        add(" ".join(copy), "en", "s2")
    for _ in range(5):
        add(" ".join(base), "en", "s1")  # exact copies
    add(" ".join(base).upper() + "\n")
    add(None)
    add("")
    add(None, None, None)
    add(" \n\t ")
    add("Word")
    add("two Words")
    add("Oneaea " * 300)
    add("same line\nsame line\nother | line ###\n\nsame line\n" + " ".join(words(20)))
    add("mail bob.smith@mail.example.com, ip 10.0.0.255, card 4111 1111 1111 1111 and +1 (555) 010-9999 "
        + " ".join(words(15)))
    add("Call +1 (555) 010-9999 now. " + " ".join(words(15)) + " again (555) 010-9999 " + " ".join(words(30)))
    add("\n".join(" ".join(words(10)) for _ in range(900)))  # long
    add(" ".join(words(20)) + "\nLicensed under the Apache License, Version 2.0.\n" + " ".join(words(20)))
    rows.append(rows[3])  # a repeated row
    rows.append((rows[4][0], "another text under a known id", "en", "s1"))
    rows.append((None, " ".join(words(40)), "en", "s1"))
    rows.append((None, " ".join(base), "en", "s1"))
    return rows


def frame(spark, rows):
    """With further columns whose names clash with the operators' own."""
    full = [(i, t, lang, s, len(t or ""), 1, 2, 3, True, 4, 5, 6, 7, 8, "w") for i, t, lang, s in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def shingle_set(text):
    w = space_words(low(text))
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def near_components(rows):
    """Per row: size of the set, least id reachable."""
    sets = [shingle_set(t) for _, t, _, _ in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 85 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = min(least.get(root(i), r[0]), r[0])
    return [(r[0], len(sets[i]), least.get(root(i)) if sets[i] else r[0]) for i, r in enumerate(rows)]


def windows(items, n=10):
    out = {}
    for item, text in items:
        w = letter_words(text)
        k = min(n, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            out.setdefault(tuple(w[i : i + k]), set()).add(item)
    return out


def contamination(rows, items):
    wanted = windows(items)
    out = []
    for i, text, _, _ in rows:
        w, hit, found = letter_words(text), set(), set()
        for k in {len(x) for x in wanted}:
            for a in range(len(w) - k + 1):
                got = wanted.get(tuple(w[a : a + k]))
                if got:
                    hit |= set(range(a, a + k))
                    found |= {str(x) for x in got if x is not None}
        out.append((i, len(w), len(hit), sorted(found)))
    return out


def quality_counts(text):
    w = space_words(text)
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = {}
    for i in range(len(w) - 4):
        seen.setdefault(tuple(w[i : i + 5]), []).append(i)
    covered = {p for v in seen.values() if len(v) > 1 for i in v for p in range(i, i + 5)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def repeated_bytes(texts, length=400):
    """Per text: bytes, removed bytes, removed runs, what stays."""
    data = [(t or "").encode() for t in texts]
    count = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(b), int(gone.sum()), runs, bytes(x for x, g in zip(b, gone) if not g)))
    return out


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    from tideline.session import materialize

    return materialize(frame(spark, rows), "fixture")


@pytest.fixture(scope="module")
def no_docs(spark):
    return frame(spark, [])
