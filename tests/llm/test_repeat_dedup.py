"""Byte repeats against brute force, and the registered query against its contract."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from cases import LONG, awkward, docs, empty

from riskmart.llm import repeat_dedup
from riskmart.llm.queries import QUERIES
from riskmart.llm.repeat_index import RunLengthIndex

SMALL = "/root/testdata/sf0.001"


def brute(rows, window):
    """(doc_id, n_bytes, n_removed, n_spans, kept) of each row."""
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(hash(x[k : k + window]) for x in data for k in range(len(x) - window + 1))
    out = []
    for (i, _), x in zip(rows, data, strict=True):
        gone, until = bytearray(len(x)), 0
        for k in range(len(x) - window + 1):
            if seen[hash(x[k : k + window])] > 1:
                for j in range(max(k, until), k + window):
                    gone[j] = 1
                until = k + window
        spans = sum(1 for k in range(len(x)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(x), sum(gone), spans, bytes(c for c, g in zip(x, gone, strict=True) if not g)))
    return sorted(out, key=str)


def result(df):
    return sorted(((x.doc_id, x.n_bytes, x.n_removed, x.n_spans, bytes(x.kept)) for x in df.collect()), key=str)


def test_index():
    r = random.Random(1)
    for _ in range(150):
        letters = b"ab\0\xff"[: r.choice([1, 2, 4])]
        texts = [bytes(r.choice(letters) for _ in range(r.randrange(0, 60))) for _ in range(r.randrange(1, 6))]
        if r.random() < 0.5:
            texts += [texts[0], texts[0][3:] + b"x"]
        ends = np.cumsum([len(x) + 1 for x in texts]) - 1
        index = RunLengthIndex(np.frombuffer(b"".join(x + b"\0" for x in texts), np.uint8), ends)
        suffixes = [(i, j) for i, x in enumerate(texts) for j in range(len(x))]

        def common(i, j, k, m):
            n = 0
            while j + n < len(texts[i]) and m + n < len(texts[k]) and texts[i][j + n] == texts[k][m + n]:
                n += 1
            return n

        want = np.zeros(index.n, np.int64)
        for i, j in suffixes:
            want[int(ends[i]) - len(texts[i]) + j] = max((common(i, j, k, m) for k, m in suffixes if (k, m) != (i, j)), default=0)
        assert (index.statistics() == want).all()
        cover = np.zeros(index.n, bool)
        for p in np.flatnonzero(want >= 5):
            cover[p : p + 5] = True
        assert (index.repeated(5) == cover).all()
        assert (index.order == sorted(range(index.n), key=lambda p: suffix(index, p))).all()


def suffix(index, p):
    end = int(index.end_of[p])
    return [*index.symbols[p:end].tolist(), 0, end]


def test_runs_are_few_in_repetitive_texts():
    r = random.Random(2)
    base = bytes(r.choice(b"abcdefgh") for _ in range(2000))
    texts = [base[:k] + b"#" + base[k + 1 :] for k in range(0, 2000, 50)]
    ends = np.cumsum([len(x) + 1 for x in texts]) - 1
    index = RunLengthIndex(np.frombuffer(b"".join(x + b"\0" for x in texts), np.uint8), ends)
    assert index.n == 40 * 2001 and len(index.heads) < 6000


def corpus(seed, n=60):
    r = random.Random(seed)
    passages = ["".join(r.choice("abcdeé \n") for _ in range(r.randrange(10, 150))) for _ in range(4)] + ["x" * 90, "ab" * 60]
    rows = []
    for i in range(n):
        parts = [r.choice(passages) if r.random() < 0.5 else "".join(r.choice("uvwxyz ") for _ in range(r.randrange(60))) for _ in range(4)]
        rows.append((r.choice([i, i, 1, None]), "".join(parts)))
    return rows + rows[:3]


@pytest.mark.parametrize("anchor_texts", [0, 1, 400])
def test_repeats(spark, monkeypatch, anchor_texts):
    monkeypatch.setattr(repeat_dedup, "ANCHOR_TEXTS", anchor_texts)
    monkeypatch.setattr(repeat_dedup, "SHARD_TEXTS", 20)
    rows = corpus(anchor_texts)
    assert result(repeat_dedup.dedup(docs(spark, rows), window=16)) == brute(rows, 16)


def test_awkward_rows(spark):
    rows = [(r["doc_id"], r["text"]) for r in awkward(spark).collect()]
    assert result(repeat_dedup.dedup(awkward(spark), window=24)) == brute(rows, 24)
    assert repeat_dedup.digests(empty(spark)).count() == 0


def test_long_and_monotonous_texts(spark):
    rows = [(1, "x" * 500_000), (2, LONG), (3, "new " + LONG[1000:300_000]), (4, "x" * 399), (5, "é" * 300)]
    got = {x[0]: x[1:] for x in result(repeat_dedup.dedup(docs(spark, rows)))}
    assert got[1] == (500_000, 500_000, 1, b"") and got[4][1] == 0 and got[5] == (600, 600, 1, b"")
    assert got[2] == (len(LONG), 299_000, 1, (LONG[:1000] + LONG[300_000:]).encode())
    assert got[3] == (299_004, 299_000, 1, b"new ")


def test_a_common_line_makes_few_rows(spark):
    """A passage of nearly the window's length in every text: rows stay in proportion to the texts."""
    r = random.Random(4)
    common = "".join(r.choice("abcdefgh") for _ in range(380))
    noise = ["".join(r.choice("ijklmnop") for _ in range(600)) for _ in range(1200)]
    rows = [(i, noise[i][:300] + common + noise[i][300:]) for i in range(1200)]
    got = repeat_dedup.digests(docs(spark, rows)).collect()
    assert {x.n_removed for x in got} <= {0} | set(range(400, 410))  # one more byte may agree on either side
    want = {(x[0], x[2]) for x in brute(rows, 400)}
    assert {(x.doc_id, x.n_removed) for x in got} == want


def test_query(spark):
    rows = [tuple(x) for x in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op13_suffix_array_dedup"](spark, SMALL)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    want = [(*x[:4], hashlib.sha256(x[4]).hexdigest()) for x in brute(rows, 400)]
    assert sorted(map(tuple, got.collect())) == sorted(want) and any(x[2] for x in want)
