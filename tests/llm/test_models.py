"""Language identification, toxicity and nearest neighbours, against brute force and held-out rows."""

import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest
from cases import awkward, docs, empty

from riskmart.llm import ann, langid, toxicity

SF = "/root/testdata/sf0.01"


def ppm_bits(counts, data):
    """Code length of data by the recursion itself."""
    padded, total = b"\n\n\n" + data, 0.0
    for i in range(3, len(padded)):
        escape, done = 0.0, False
        for n in (3, 2, 1, 0):
            context = padded[i - n : i]
            after = {g[-1]: c for g, c in counts.items() if len(g) == n + 1 and g[:-1] == context}
            if not after:
                continue
            whole = sum(after.values()) + len(after)
            if padded[i] in after:
                total += escape - math.log2(after[padded[i]] / whole)
                done = True
                break
            escape -= math.log2(len(after) / whole)
        if not done:
            total += escape + 8
    return total


def test_code_lengths():
    r = random.Random(0)
    texts = {lang: ["".join(r.choice(abc) for _ in range(80)).encode() for _ in range(3)] for lang, abc in (("x", "abcd e"), ("y", "cdef\n"))}
    model = langid.Ppm.of({lang: dict(sum((langid._counts(t) for t in found), Counter())) for lang, found in texts.items()})
    trained = {lang: Counter(p[i : i + n] for t in found for p in [b"\n" + t] for n in range(1, 5) for i in range(len(p) - n + 1)) for lang, found in texts.items()}
    data = [b"", b"a", b"abcd", "".join(r.choice("abcdefgé\n") for _ in range(60)).encode()]
    raw, offsets = np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)])
    got = model.bits(raw, offsets, model.lookup()) / langid.UNIT
    want = [[ppm_bits(trained[lang], d) for lang in model.languages] for d in data]
    assert np.abs(got - want).max() < 0.2


def test_languages_held_out(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["doc_id"]: r for r in langid.predict_held_out(table).collect()}
    rows = table.select("doc_id", "lang").collect()
    held = [r for r in rows if got[r["doc_id"]]["held_out"]]
    assert sum(got[r["doc_id"]]["lang_pred"] == r["lang"] for r in held) / len(held) > 0.98 and len(got) == len(rows)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_languages_awkward(spark):
    model = langid.train(awkward(spark))
    got = {(r["doc_id"]): r for r in langid.predict(awkward(spark), model).collect()}
    assert model.languages == ["en"] and {i for i, r in got.items() if r["lang_pred"] == "und"} == {2, 3, 4}
    assert langid.predict(docs(spark, [(1, "1234 !?"), (2, "中")]), model).orderBy("doc_id").collect()[0]["lang_pred"] == "und"
    numbered = [(i, f"words of text number {i}", "en") for i in range(300)] + [(None, f"no number {i}", "en") for i in range(700)]
    table = spark.createDataFrame(numbered, "doc_id long, text string, lang string")
    assert langid.train(table, 100).languages == ["en"]  # rows without a number take no places from others
    assert {(r["doc_id"] is None, r["held_out"]) for r in langid.predict_held_out(table).collect()} == {(False, True), (False, False), (True, False)}
    nothing = langid.train(empty(spark))
    assert {tuple(r)[1:] for r in langid.predict(awkward(spark), nothing).collect()} == {("und", 0.0)}
    assert langid.predict(empty(spark), model).count() == 0


def brute_kernel(a, b, order=toxicity.ORDER, decay=toxicity.DECAY):
    total = 0.0
    for i in itertools.combinations(range(len(a)), order):
        for j in itertools.combinations(range(len(b)), order):
            if [a[x] for x in i] == [b[y] for y in j]:
                total += decay ** (i[-1] - i[0] + 1 + j[-1] - j[0] + 1)
    return total


def test_string_kernel():
    r = random.Random(1)
    words = ["".join(r.choice("abcd") for _ in range(r.randrange(1, 9))) for _ in range(12)]
    i, j = np.divmod(np.arange(144), 12)
    points = toxicity.points(words)
    got = toxicity.kernel(points, points, i, j)
    assert np.allclose(got, [brute_kernel(words[a], words[b]) for a, b in zip(i, j)])


def test_describer_drops_nothing_above_the_floor():
    r = random.Random(2)
    marks = ["idiot", "moron", "scum", "worthless"]
    words = ["".join(r.choice("idotmrnscuwhle-") for _ in range(r.randrange(4, 14))) for _ in range(300)] + ["id-iot", "m.oron", "sscumm"]
    word, mark, value = toxicity.Describer(marks).values(words)
    got = {(words[a], marks[b]): v for a, b, v in zip(word, mark, value)}
    for w, m in itertools.product(set(words), marks):
        want = min(brute_kernel(w, m) / brute_kernel(m, m), 1.0)
        assert abs(got.get((w, m), 0.0) - (want if want >= toxicity.FLOOR else 0.0)) < 1e-9


def insulting(n, seed, change):
    r = random.Random(seed)
    pool = ["".join(r.choice("aeinorstlhd") for _ in range(r.randrange(2, 10))) for _ in range(600)]
    rows = []
    for i in range(n):
        found = [[r.choice(pool) for _ in range(r.randrange(5, 15))] for _ in range(r.randrange(1, 6))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(2):
                s = r.choice(found)
                s.insert(r.randrange(len(s)), change(r.choice(["idiot", "moron", "pathetic", "worthless", "scum"]), r))
        rows.append((i, ". ".join(" ".join(s) for s in found) + ".", int(toxic)))
    return rows


def spaced(word, r):
    k = r.randrange(1, len(word))
    return word[:k] + r.choice("-.*_x") + word[k:]


@pytest.mark.parametrize("change", [lambda w, r: w, spaced, lambda w, r: " ".join(w)])
def test_toxicity_held_out(spark, change):
    train = spark.createDataFrame(insulting(1200, 1, lambda w, r: w), "doc_id long, text string, toxic int")
    model = toxicity.train(train, train)
    rows = insulting(200, 1, change)
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs(spark, [(1000 + i, t) for i, t, _ in rows]), model).collect()}
    wrong = [i for i, _, y in rows if got[1000 + i] != y]
    assert len(wrong) <= 8


def test_toxicity_awkward(spark):
    table = awkward(spark)
    labels = spark.createDataFrame([(1, 1, 1), (2, 0, 1), (5, 0, 0), (6, None, 0), (8, 1, None), (77, 1, 1)], "doc_id long, quality int, toxic int")
    for model in (toxicity.learned(table, labels), toxicity.learned(table, labels.where("false")), None):
        got = toxicity.score(table, model).collect()
        assert len(got) == table.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert toxicity.score(empty(spark), None).count() == 0
    kept = toxicity.keep_clean(table, labels)
    assert kept.columns == table.columns and kept.count() <= table.count()
    assert toxicity.score_held_out(empty(spark), labels).count() == 0
    assert [r["held_out"] for r in toxicity.score_held_out(table, labels).where("doc_id is null").collect()] == [False]


def brute_nearest(rows, query, k):
    usable = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            usable[i] = min(usable.get(i, v), v)
    q = usable[query]
    scored = [(-sum(a * b for a, b in zip(q, v)), i) for i, v in usable.items() if i != query and len(v) == len(q)]
    return [(i, -s) for s, i in sorted(scored)[:k]]


def outlying(r, rows):
    """Vectors of very many norms, of the smallest and largest that doubles hold among them."""
    far = [10.0**e for e in (-300, -8, 4, 8, 150, 300)]
    return rows + [(5000 + i, (r.normal(size=16) * s).tolist()) for i, s in enumerate(far)]


@pytest.mark.parametrize("add", [lambda r, rows: rows, lambda r, rows: [*rows, (5000, (r.normal(size=16) * 1e8).tolist())], outlying])
def test_nearest(spark, add):
    r = np.random.default_rng(0)
    rows = [(i, (v * s).tolist()) for i, (v, s) in enumerate(zip(r.normal(size=(1500, 16)), r.uniform(0.5, 2, 1500)))]
    rows = add(r, rows + [(2000 + i, rows[7][1]) for i in range(60)])
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.nearest(frame, "id % 20 = 0", shard_rows=400).collect()
    found = {}
    for x in sorted(got, key=lambda x: x["rank"]):
        found.setdefault(x["query_id"], []).append((x["vec_id"], x["score"]))
    hits = total = 0
    for i, _ in rows:
        if i % 20 == 0:
            want = brute_nearest(rows, i, 20)
            assert len(found[i]) == 20 and [s for _, s in found[i]] == sorted((s for _, s in found[i]), reverse=True)
            hits += len({v for v, _ in want} & {v for v, _ in found[i]})
            total += 20
    assert hits / total > 0.97


def test_nearest_awkward(spark):
    nan, inf = math.nan, math.inf
    rows = [
        (0, [1.0, 2.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (20, [1.0, 2.0]),
        (7, [1.0, 2.0]), (8, [2.0, -1.0]), (8, [2.0, -1.0]), (9, [3.0, 3.0, 3.0]), (None, [1.0, 1.0]), (40, [1.0, 1.0, 1.0]), (60, [5.0]), (10, [-1.0, -2.0]),
    ]
    frame = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], "vec_id long, embedding array<float>, id string, v string")
    got = {}
    for x in ann.nearest(frame, "id % 20 = 0", k=3).orderBy("query_id", "rank").collect():
        got.setdefault(x["query_id"], []).append((x["vec_id"], x["score"]))
    assert got == {q: brute_nearest(rows, q, 3) for q in (0, 20, 40)}
    assert ann.nearest(frame.where("false"), "id % 20 = 0").count() == 0
