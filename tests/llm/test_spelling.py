"""Spelling variants against brute force, and the registered query against its contract."""

import random
import re
import zlib
from collections import Counter

import pytest
from cases import awkward, empty

from riskmart.llm import spelling
from riskmart.llm.queries import QUERIES, with_lost_letters
from riskmart.llm.scratch import Scratch

SMALL = "/root/testdata/sf0.001"


def near(u, v):
    if u == v or abs(len(u) - len(v)) > 1:
        return False
    if len(u) > len(v):
        u, v = v, u
    return any(u[:j] == v[:j] and u[j + (len(u) == len(v)) :] == v[j + 1 :] for j in range(len(v)))


def brute(counts, ratio=5):
    """(word, form, root, n, n_near, form_n); near words by deletions."""
    by = {}
    for w in counts:
        for x in {w} | {w[:i] + w[i + 1 :] for i in range(len(w))}:
            by.setdefault(x, set()).add(w)
    partners = {w: set() for w in counts}
    for same in by.values():
        for w in same:
            partners[w] |= {x for x in same if near(w, x)}
    form = {}
    for w, own in partners.items():
        best = min(own, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= ratio * counts[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted((w, form[w] or "", root(w), n, len(partners[w]), counts.get(form[w])) for w, n in counts.items())


def result(df):
    return sorted((x.word, x.form or "", x.root, x.n, x.n_near, x.form_n) for x in df.collect())


def vocabulary(seed, letters, n, low, high):
    r = random.Random(seed)
    words = {"".join(r.choice(letters) for _ in range(r.randrange(low, high))) for _ in range(n)}
    return {w: 5 * 6 ** r.randrange(5) + r.randrange(9) for w in words}


def test_machines():
    r = random.Random(1)
    for _ in range(200):
        letters = r.choice(["ab", "abc", "abcdefgh"])
        words = sorted({"".join(r.choice(letters) for _ in range(r.randrange(0, 6))) for _ in range(r.randrange(1, 40))})
        machine = spelling.Acceptor(words)

        def language(state):
            return [""] * machine.final[state] + [x + y for x, to in machine.next[state].items() for y in language(to)]

        assert sorted(language(machine.start)) == words
        rights = {frozenset(language(s)) for s in range(len(machine.next))}
        assert len(rights) == len(machine.next)  # no two states accept the same
        pairs = set(spelling.one_edit_pairs(machine, machine))
        assert pairs == {(u, v) for u in words for v in words if near(u, v) and len(u) <= len(v)}


@pytest.mark.parametrize("partition_words, places", [(2000, 128), (3, 128), (2000, 2)])
def test_variants(spark, monkeypatch, partition_words, places):
    monkeypatch.setattr(spelling, "PLACES", places)
    monkeypatch.setattr(spelling, "SHARD_ROWS", 50)
    counts = vocabulary(2, "abé", 500, 6, 9) | vocabulary(3, "abcdefgh", 300, 6, 30) | {"aaaaaa" + x: 7 for x in "bcdefghijklmnop"}
    table = spark.createDataFrame([(w, n, "clash") for w, n in counts.items()], "word string, n long, near string")
    assert result(spelling.variants(table, partition_words=partition_words)) == brute(counts)


def test_chains_and_ties(spark):
    chain = {"aaaaaa" + "b" * i: 5 * 5**i for i in range(9)}
    ties = {"zzzzzy": 5, "zzzzza": 25, "zzzzzb": 25, "ézzzzy": 5}
    counts = chain | ties
    table = spark.createDataFrame(list(counts.items()) + [(None, 9), ("unknown", None)], "word string, n long")
    got = result(spelling.variants(table))
    assert got == brute(counts)
    assert {x[2] for x in got if x[0].startswith("aaaaaa")} == {"aaaaaa" + "b" * 8}


def test_long_words_and_repeated_rows(spark):
    long = "ab" * 20_000
    counts = {long: 100, long[:-1]: 9, "x" + long: 8, long[:17] + "y" + long[18:]: 5}
    table = spark.createDataFrame([(w, k) for w, n in counts.items() for k in (n - 2, 2)], "word string, n long")
    assert result(spelling.variants(table)) == brute_long(counts)
    assert spelling.variants(table.where("false")).count() == 0


def brute_long(counts):
    partners = {w: [x for x in counts if distance_one(w, x)] for w in counts}
    return sorted((w, *((max(p, key=counts.get),) * 2 if p and max(map(counts.get, p)) >= 5 * n else ("", w)), n, len(p), max(map(counts.get, p)) if p and max(map(counts.get, p)) >= 5 * n else None) for (w, n), p in zip(counts.items(), partners.values(), strict=True))


def distance_one(u, v):
    if u == v or abs(len(u) - len(v)) > 1:
        return False
    u, v = sorted((u, v), key=len)
    j = next((i for i, (x, y) in enumerate(zip(u, v, strict=False)) if x != y), len(u))
    return u[j + (len(u) == len(v)) :] == v[j + 1 :]


def test_no_pairs_within_a_group(spark):
    """Words that share a half make rows in proportion to their number."""
    table = spark.range(20_000).selectExpr("concat('abcdefgh', lpad(conv(id * 7919 % 46656, 10, 36), 8, 'z')) AS word", "9L AS n")
    scratch = Scratch(spark, "spelling")
    assert spelling.near_words(table, scratch).count() < 20_000 * 8 * 36


def spoiled(rows):
    found = Counter()
    for i, t in rows:
        for x in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x)
            h = zlib.crc32(f"{i}:{w}".encode())
            at = h % len(w)
            found[w[:at] + w[at + 1 :] if i is not None and h % 199 == 0 else w] += 1
    return found


def test_query(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = brute({w: n for w, n in spoiled(rows).items() if len(w) >= 6 and n >= 5})
    got = QUERIES["op12_spelling_variants"](spark, SMALL)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert result(got) == want and any(x[1] for x in want)


def test_awkward_rows(spark):
    rows = [(r["doc_id"], r["text"]) for r in awkward(spark).collect()]
    got = Counter(x.word for x in with_lost_letters(spelling.letter_runs(awkward(spark))).collect())
    assert got == spoiled(rows)
    assert spelling.letter_runs(empty(spark)).count() == 0
