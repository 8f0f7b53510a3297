"""Periodic runs against brute force, and the registered query against its contract."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from cases import LONG, WORD, awkward, docs, empty

from riskmart.llm import periodic
from riskmart.llm.queries import QUERIES, with_planted_runs
from riskmart.llm.textbytes import mix

SMALL = "/root/testdata/sf0.001"


def brute_runs(words, least=6, exponent=4):
    out, n = [], len(words)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            own = words[start : start + length]
            if length >= max(least, exponent * q) and not any(own[k:] == own[:-k] for k in range(1, q)):
                out.append((start, length, q))
    return sorted(out)


def collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def some(r):
    n, k = r.randrange(0, 120), r.choice([1, 2, 3, 5, 50])
    x = [r.randrange(k) for _ in range(n)]
    if n and r.random() < 0.7:
        a = r.randrange(n)
        p = 1 + (n - a) // (3 + r.randrange(8))
        x = [x[a + (i - a) % p] if i >= a else x[i] for i in range(n)]
    return x + x[:20] * r.randrange(5) if r.random() < 0.4 else x


@pytest.mark.parametrize("block", [8, 40, 4096])
def test_runs(monkeypatch, block):
    monkeypatch.setattr(periodic, "BLOCK_WORDS", block)
    r = random.Random(block)
    for _ in range(300):
        texts = [some(r) for _ in range(r.randrange(1, 6))]
        bounds = np.cumsum([0] + [len(x) for x in texts])
        regions = {}
        for d, *region in periodic.candidates(mix(np.array(sum(texts, []), np.uint64) + np.uint64(1)), bounds):
            regions.setdefault(d, []).append(tuple(region))
        for d, x in enumerate(texts):
            assert periodic.runs(x, regions.get(d, [])) == brute_runs(x)


def test_squares_of_every_period():
    r = random.Random(5)
    for _ in range(200):
        x = [r.randrange(2) for _ in range(r.randrange(1, 60))]
        got = set(periodic.squares(x))
        for i in range(len(x)):
            for q in range(1, (i + 1) // 2 + 1):
                own = x[i - 2 * q + 1 : i + 1]
                square = own[:q] == own[q:]
                shorter = any(x[i - 2 * k + 1 : i - k + 1] == x[i - k + 1 : i + 1] for k in range(1, q))
                assert square or (i, q) not in got
                assert not square or shorter or (i, q) in got


def test_awkward_rows(spark):
    rows = [(r["doc_id"], r["text"]) for r in awkward(spark).collect()]
    got = periodic.periodic_runs(awkward(spark)).collect()
    want = []
    for i, t in rows:
        own = WORD.findall(t or "")
        found = brute_runs(own) if len(own) < 1000 else []
        want.append((i, len(own), found, collapsed(own, found)))
    assert sorted(((x.doc_id, x.n_words, [tuple(y) for y in x.runs], x.collapsed) for x in got), key=str) == sorted(want, key=str)
    assert periodic.periodic_runs(empty(spark)).count() == 0


def test_long_repeats(spark):
    word, passage = "x " * 300_000, LONG + " "
    got = periodic.periodic_runs(docs(spark, [(1, word), (2, "a " + passage * 5 + "b"), (3, passage * 3)])).collect()
    found = {x.doc_id: [tuple(y) for y in x.runs] for x in got}
    assert found == {1: [(0, 300_000, 1)], 2: [(1, 150_000, 30_000)], 3: []}
    assert {x.doc_id: len(x.collapsed) for x in got} == {1: 1, 2: len(LONG) + 4, 3: 3 * len(LONG) + 2}


def test_query(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = []
    for i, t in rows:
        own = WORD.findall(t or "")
        h = zlib.crc32(str(i).encode())
        if h % 10 == 0 and own:
            g, n = h // 10, len(own)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            own = [own[a + (k - a) % p] if k >= a else w for k, w in enumerate(own)]
        found = brute_runs(own)
        best = min(found, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None,) * 3)
        milli = best[1] and 1000 * best[1] // best[2]
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        digest = [hashlib.sha256(x.encode()).hexdigest() for x in (listed, collapsed(own, found))]
        want.append((i, len(found), *best, milli, *digest))
    got = QUERIES["op11_periodic_runs"](spark, SMALL)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert sum(x[1] > 0 for x in want) > 5


def test_planted_runs_of_awkward_rows(spark):
    got = with_planted_runs(awkward(spark).unionByName(docs(spark, [(51, ""), (51, None), (51, "one")]), allowMissingColumns=True))
    assert got.count() == awkward(spark).count() + 3
