"""Small document tables with every awkward case, and brute-force versions."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 7001}x{i}" for i in range(30_000))

#: doc_id, text: nulls, empty and blank texts, a very long one, ties, repeated rows.
AWKWARD = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today.\nAll rights reserved by the owner of this page."),
    (2, None),
    (3, ""),
    (4, " \t\n "),
    (5, LONG),
    (6, "The quick brown fox jumps over the lazy dog near the river bank today.\nSomething else entirely stands on this second line."),
    (6, "The quick brown fox jumps over the lazy dog near the river bank today.\nSomething else entirely stands on this second line."),
    (7, "é中 a b <|endoftext|> 'll  two  spaces\n\nx"),
    (None, "A row without a number but with a text of several words in it."),
    (8, "The quick brown fox jumps over the lazy dog near the river bank today.\nAll rights reserved by the owner of this page."),
]
#: Extra columns that clash with names the operators use themselves.
EXTRA = ["tid", "fp", "node", "root", "line", "words", "gone", "key", "first_id", "component_id", "s", "id", "v", "n"]


def awkward(spark, lang="en"):
    rows = [(i, t, lang, "src0", len(t or ""), *(["clash"] * len(EXTRA))) for i, t in AWKWARD]
    names = ", ".join(f"{c} string" for c in EXTRA)
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {names}")


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def empty(spark):
    return awkward(spark).where("false")


def components(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        after = [i]
        for j, y in enumerate(b, 1):
            after.append(min(row[j] + 1, after[-1] + 1, row[j - 1] + (x != y)))
        row = after
    return row[-1]


def sentences(n, seed, vocabulary=400, low=20, high=80):
    r = random.Random(seed)
    pool = ["".join(r.choice("abcdefghijklmnoprstuvwy") for _ in range(r.randrange(2, 9))) for _ in range(vocabulary)]
    return [" ".join(r.choice(pool) for _ in range(r.randrange(low, high))) for _ in range(n)]
