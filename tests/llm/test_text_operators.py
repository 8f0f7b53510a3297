"""Substring, line and SimHash dedup, decontamination and their awkward cases, against brute force."""

import hashlib
import itertools
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from cases import LONG, WORD, awkward, components, docs, edit_distance, empty, sentences

from pyspark.sql import functions as F

from riskmart.llm import decontam, line_dedup, simhash, substring_dedup
from riskmart.llm.graph import components as spark_components
from riskmart.llm.scratch import Scratch


def brute_removed(rows, window):
    first = {}
    for i, t in rows:
        found = WORD.findall(t or "")
        for k in range(len(found) - window + 1):
            run = tuple(found[k : k + window])
            if i is not None:
                first[run] = min(first.get(run, i), i)
    out = []
    for i, t in rows:
        found = WORD.findall(t or "")
        gone = [False] * len(found)
        for k in range(len(found) - window + 1):
            least = first.get(tuple(found[k : k + window]))
            if i is not None and least is not None and least < i:
                gone[k : k + window] = [True] * window
        out.append((i, len(found), sum(gone), " ".join(w for w, g in zip(found, gone) if not g)))
    return sorted(out, key=str)


@pytest.mark.parametrize("anchor_texts", [0, 1, 200])
def test_substrings(spark, monkeypatch, anchor_texts):
    monkeypatch.setattr(substring_dedup, "ANCHOR_TEXTS", anchor_texts)
    monkeypatch.setattr(substring_dedup, "SHARD_TEXTS", 20)
    r = random.Random(1)
    passages = [" ".join(r.choice("abcdef") * r.randrange(1, 4) for _ in range(r.randrange(6, 25))) for _ in range(4)]
    rows = []
    for i in range(60):
        parts = [r.choice(passages) if r.random() < 0.5 else " ".join(r.choice("uvwxyz") * r.randrange(1, 4) for _ in range(r.randrange(1, 20))) for _ in range(4)]
        rows.append((i, "\n ".join(parts)))
    got = substring_dedup.dedup(docs(spark, rows), window=6, gram=2).collect()
    assert sorted((tuple(x) for x in got), key=str) == brute_removed(rows, 6)
    assert sum(x["n_removed"] for x in got) > 500


def test_rows_that_repeat_make_no_more_spans(spark):
    passage = " ".join(f"w{k}" for k in range(60))
    rows = [(i, passage) for i in (1, 2) for _ in range(1000)] + [(3, f"{passage} end")]
    plain = docs(spark, rows).withColumn("tid", F.xxhash64("text"))
    found = substring_dedup.spans(plain, Scratch(spark, "substrings")).collect()
    assert {x["doc_id"] for x in found} == {2, 3} and max(len(x["s"]) for x in found) < 15
    got = {tuple(x)[:3] for x in substring_dedup.dedup(docs(spark, rows)).collect()}
    assert got == {(1, 60, 0), (2, 60, 60), (3, 61, 60)}


def test_a_passage_in_every_document(spark):
    """More documents than an anchor's fragments may be: those around the passage are cut again."""
    r = random.Random(6)
    passage = " ".join(f"p{k}" for k in range(70))
    pool = ["".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(5000)]
    rows = [(i, " ".join([*r.choices(pool, k=45), passage, *r.choices(pool, k=45)])) for i in range(600)]
    got = substring_dedup.dedup(docs(spark, rows)).collect()
    assert sorted((tuple(x) for x in got), key=str) == brute_removed(rows, 50)


def test_substrings_awkward(spark):
    rows = [(r["doc_id"], r["text"]) for r in awkward(spark).collect()]
    got = substring_dedup.dedup(awkward(spark), window=6, gram=2).collect()
    assert sorted((tuple(x) for x in got), key=str) == brute_removed(rows, 6)
    assert substring_dedup.digests(empty(spark)).count() == 0
    one = {x["doc_id"]: x["kept_sha256"] for x in substring_dedup.digests(docs(spark, [(1, LONG), (2, LONG), (3, None)])).collect()}
    assert one == {1: hashlib.sha256(LONG.encode()).hexdigest(), 2: hashlib.sha256(b"").hexdigest(), 3: hashlib.sha256(b"").hexdigest()}


@pytest.mark.parametrize("anchor_texts", [1, 200])
def test_substrings_in_rows_without_number(spark, monkeypatch, anchor_texts):
    monkeypatch.setattr(substring_dedup, "ANCHOR_TEXTS", anchor_texts)
    passage = " ".join(f"w{k}" for k in range(60))
    rows = [(None, passage), (1, passage), (2, passage), (None, f"a {passage}"), (3, f"b {passage} c"), (None, None)]
    got = substring_dedup.dedup(docs(spark, rows)).collect()
    assert sorted((tuple(x) for x in got), key=str) == brute_removed(rows, 50)
    assert {x["doc_id"]: x["n_removed"] for x in got if x["doc_id"]} == {1: 0, 2: 60, 3: 60}


def brute_lines(rows, edits, min_chars):
    """Kept text of each row."""
    found = {}
    for i, t in rows:
        for k, line in enumerate((t or "").split("\n")):
            line = line.strip(" \t\n\r\v\f")
            if len(line) >= min_chars and i is not None:
                found.setdefault(line, []).append((i, k))
    names = sorted(found)
    near = [(a, b) for a, b in itertools.combinations(names, 2) if abs(len(a) - len(b)) <= edits and edit_distance(a, b) <= edits]
    root = components(names, near)
    first = {}
    for line in names:
        first[root[line]] = min(first.get(root[line], min(found[line])), min(found[line]))
    gone = {place for line in names for place in found[line] if place != first[root[line]]}
    return sorted(((i, "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone) if t is not None else None) for i, t in rows), key=str)


@pytest.mark.parametrize("edits,heavy", [(0, 200), (1, 200), (2, 200), (3, 200), (0, 1), (1, 1), (2, 0), (2, 3), (3, 2)])
def test_lines(spark, monkeypatch, edits, heavy):
    monkeypatch.setattr(line_dedup, "HEAVY_LINES", heavy)
    r = random.Random(edits)
    bases = ["".join(r.choice("abcdeé ") for _ in range(r.randrange(4, 30))) for _ in range(25)]

    def mutate(s):
        s = list(s)
        for _ in range(r.randrange(0, 4)):
            k = r.randrange(len(s) + 1)
            s[k : k + r.randrange(0, 2)] = r.choice(["", "x", "b"])
        return "".join(s)

    rows = [(i, "\n".join(mutate(r.choice(bases)) for _ in range(5))) for i in range(40)]
    got = line_dedup.dedup(docs(spark, rows), edits=edits, min_chars=6).collect()
    assert sorted((tuple(x) for x in got), key=str) == brute_lines(rows, edits, 6)


def test_short_lines_go_if_equal(spark):
    long = "A line that is long enough for edits."
    rows = [
        (1, f"Ietzte.\n\n{long}\nx"),
        (2, f" Ietzte.\nIetzta.\n\n{long[:-1]}!\nx "),
        (3, "\n \nIetzta.\nx\nx\nnineteen characters\nnineteen characterz"),
        (4, None),
    ]
    got = {x["doc_id"]: x["text"] for x in line_dedup.dedup(docs(spark, rows)).collect()}
    want = {1: rows[0][1], 2: "Ietzta.\n", 3: "\n \nnineteen characters\nnineteen characterz", 4: None}
    assert got == want
    counts = {x["doc_id"]: (x["n_lines"], x["n_removed"]) for x in line_dedup.digests(docs(spark, rows)).collect()}
    assert counts == {1: (4, 0), 2: (5, 3), 3: (7, 3), 4: (0, 0)}


def test_lines_in_rows_without_number(spark):
    line, near, other = "The same line in many of the rows.", "The same line in many of the rows!", "This one is held by one numbered row."
    rows = [(None, f"{line}\n{near}\n{other}\n{other}"), (1, f"{line}\n{other}"), (2, f"{near}\n{line}\nx y"), (None, f"{near}\nx y"), (3, "x y")]
    got = sorted((tuple(x) for x in line_dedup.dedup(docs(spark, rows)).collect()), key=str)
    assert got == brute_lines(rows, 2, 3)
    assert {i: t for i, t in got if i} == {1: f"{line}\n{other}", 2: "x y", 3: ""}


def test_lines_have_keys_once_however_many_documents_hold_them(spark):
    held = ["A line that very many documents hold.", "A line that very many documents held."]
    table = docs(spark, [(i, "\n".join([*held, f"{i} is a line of one document only"])) for i in range(300)]).repartition(30)
    found = line_dedup._keyed(line_dedup._once(table, 2, 20), 2, "sketch")
    counts = Counter(tuple(x) for x in found.collect())
    assert set(counts.values()) == {1} and len({x[1] for x in counts}) == 302
    for x in {x[1] for x in counts}:
        assert 3 <= sum(1 for y in counts if y[1] == x and not y[3]) <= sum(1 for y in counts if y[1] == x) <= len(line_dedup.places(2))


class Kept(Scratch):
    """Counts the rows of each table written."""

    def save(self, df, name):
        out = super().save(df, name)
        self.sizes = {**getattr(self, "sizes", {}), name: out.count()}
        return out


def test_families_of_lines_write_rows_in_proportion_to_lines(spark):
    other = ["One more line that is like no other.", "One more line that is like no othe!"]
    for n in (1000, 4000):
        rows = [(i, f"This is the numbered line {i:05d} of the list\n{other[i % 2]}") for i in range(n)]
        scratch = Kept(spark, "families")
        gone = line_dedup.surplus(line_dedup._plain(docs(spark, rows).repartition(8)), scratch, 2, None)
        assert gone.selectExpr("sum(size(gone))").first()[0] == 2 * n - 2
        assert scratch.sizes["stars"] <= 8 * n and scratch.sizes["pairs"] <= 1


def test_family_with_lines_two_edits_apart(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "HEAVY_LINES", 10)
    r = random.Random(5)
    numbers = r.sample(range(1000), 120)
    rows = [(i, f"The line {n:03d} with a digit to check it: {sum(map(int, str(n))) % 10}\na line of {i % 7} words and {n % 13}") for i, n in enumerate(numbers)]
    rows += [(200 + i, t) for i, t in enumerate(["The line 7777 with a digit to check it: 8", "The line 12 with a digit to check it: 31"])]
    got = line_dedup.dedup(docs(spark, rows)).collect()
    assert sorted((tuple(x) for x in got), key=str) == brute_lines(rows, 2, 20)


def test_edit_distance():
    r = random.Random(0)
    for _ in range(3000):
        a, b = ("".join(r.choice("abc") for _ in range(r.randrange(9))) for _ in "ab")
        for k in range(4):
            assert line_dedup.within(a, b, k) == (edit_distance(a, b) <= k)


def test_lines_awkward(spark):
    table = awkward(spark)
    rows = [(r["doc_id"], r["text"]) for r in table.collect()]
    got = line_dedup.dedup(table)
    assert got.columns == table.columns
    kept = {(r["doc_id"], r["text"]) for r in got.collect()}
    want = dict(brute_lines([x for x in rows if x[1] != LONG], 2, 20))
    assert kept == {*want.items(), (5, LONG)} and got.count() == len(rows)
    assert all(r["n_chars"] == len(r["text"] or "") for r in got.collect())
    assert line_dedup.dedup(empty(spark)).count() == 0 and line_dedup.digests(empty(spark)).count() == 0
    counts = {r["doc_id"]: (r["n_lines"], r["n_removed"]) for r in line_dedup.digests(table).collect()}
    assert counts[2] == (0, 0) and counts[3] == (1, 0) and counts[8] == (2, 2) and counts[1] == (2, 0) and counts[6] == (2, 1)


def test_golay_words_share_a_codeword():
    r = np.random.default_rng(0)
    x = r.integers(0, 1 << 23, 20_000)
    y = x ^ (1 << r.integers(0, 23, len(x))) ^ np.where(r.random(len(x)) < 0.5, 1 << r.integers(0, 23, len(x)), 0)
    a, b = simhash.codewords(x), simhash.codewords(y)
    assert (((a[:, :, None] == b[:, None, :]) & (a[:, :, None] >= 0)).any((1, 2))).all()
    assert set((a >= 0).sum(1)) == {1, 6}


def plain_print(text):
    found = [w for w in WORD.findall(text or "")]
    found = ["".join(c.lower() if c.isascii() else c for c in w) for w in found]
    parts = [" ".join(found[k : k + 3]) for k in range(max(1, len(found) - 2))] if found else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_and_awkward(spark):
    table = awkward(spark)
    got = simhash.near_duplicates(table).collect()
    prints = [(r["doc_id"], plain_print(r["text"])) for r in table.collect()]
    assert sorted(((r["doc_id"], r["fp"] % (1 << 64)) for r in got), key=str) == sorted(prints, key=str)
    classes = {r["doc_id"]: r["component_id"] for r in got}
    assert classes[2] == classes[3] == classes[4] == 2 and classes[8] == 1
    kept = simhash.keep_first(table)
    assert kept.columns == table.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([1, 2, 5, 6, 6, 7, None], key=str)
    assert simhash.near_duplicates(empty(spark)).count() == 0 and simhash.keep_first(empty(spark)).count() == 0


@pytest.mark.parametrize("paired", [1, 2, 48])
def test_links_lose_nothing(spark, monkeypatch, paired):
    monkeypatch.setattr(simhash, "PAIRED_KEY_ROWS", paired)
    r = random.Random(3)
    prints = {r.getrandbits(64) for _ in range(30)}
    for base in list(prints)[:8]:
        for _ in range(25):
            prints.add(base ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)))
    rows = [(p - (1 << 64) if p >> 63 else p, i) for i, p in enumerate(sorted(prints))]
    scratch = Scratch(spark, "test")
    links = simhash.links(spark.createDataFrame(rows, "fp long, first_id long"), scratch)
    got = {x["node"]: x["root"] for x in spark_components(links, scratch).collect()}
    near = [(a, b) for (p, a), (q, b) in itertools.combinations(rows, 2) if ((p ^ q) % (1 << 64)).bit_count() <= 2]
    want = components(range(len(rows)), near)
    assert {n: got.get(n, n) for n in want} == want


def test_components(spark):
    r = random.Random(5)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(40)] + [(0, 5000 + i) for i in range(50)]
    frame = spark.createDataFrame([*edges, (None, 3)], "a long, b long")
    got = {x["node"]: x["root"] for x in spark_components(frame, Scratch(spark, "test")).collect()}
    want = components({n for e in edges for n in e}, edges)
    assert got == {n: w for n, w in want.items() if n in got} and all(n in got or want[n] == n for n in want)
    assert spark_components(frame.where("false"), Scratch(spark, "test")).count() == 0


def brute_leaks(rows, items):
    def shingles(found):
        n = min(5, len(found))
        return Counter(tuple(found[k : k + n]) for k in range(len(found) - n + 1))

    def plain(text):
        return "".join(c.lower() if c.isascii() and c.isalnum() or ord(c) > 127 else " " for c in text or "").split()

    out = {}
    for doc, text in rows:
        found = plain(text)
        for item, words in items:
            want = plain(words)
            for a in range(max(len(found) - len(want), 0) + 1) if want and found else ():
                x, y = shingles(found[a : a + len(want)]), shingles(want)
                common = sum((x & y).values())
                alike = common / (sum(x.values()) + sum(y.values()) - common)
                if alike >= 0.8 and alike > out.get((doc, item), (0,))[0]:
                    out[doc, item] = alike, a
    return out


def test_decontamination(spark):
    r = random.Random(2)
    items = list(enumerate(sentences(20, 7, low=3, high=60)))
    rows = []
    for i, text in enumerate(sentences(60, 8, vocabulary=3000, low=5, high=90)):
        found = text.split()
        if i % 2:
            leak = items[i % len(items)][1].split()
            for _ in range(i % 5):
                leak[r.randrange(len(leak))] = r.choice(["changed", "Words"])
            if i % 3 == 0:
                del leak[r.randrange(len(leak))]
            at = r.randrange(len(found))
            found[at:at] = [w.upper() if i % 7 == 0 else w for w in leak]
        rows.append((i, ", ".join(found)))
    rows.append((99, items[3][1]))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(x["doc_id"], x["item_id"]): (x["similarity"], x["start"]) for x in decontam.leaks(docs(spark, rows), bench).collect()}
    want = brute_leaks(rows, items)
    assert got.keys() == want.keys() and len(got) >= 10
    assert all(abs(got[k][0] - want[k][0]) < 1e-12 and got[k][1] == want[k][1] for k in want)


@pytest.mark.parametrize("probes", [decontam.PROBES, 40])
def test_tables_find_all_pairs_within_the_radius(monkeypatch, probes):
    monkeypatch.setattr(decontam, "PROBES", probes)
    r = np.random.default_rng(3)
    own = r.integers(0, 1 << 63, 300, dtype=np.uint64) * np.uint64(2)
    # Copies with up to 30 bits turned over, and unrelated ones.
    flips = [sum(1 << int(b) for b in r.choice(64, k, replace=False)) for k in r.integers(0, 31, 500).tolist()]
    prints = np.append(own[r.integers(0, 300, 500)] ^ np.array(flips, np.uint64), r.integers(0, 1 << 63, 100, dtype=np.uint64))
    apart = np.bitwise_count(prints[:, None] ^ own)
    i, j = np.nonzero(apart <= decontam.RADIUS)
    got = [x.tolist() for x in decontam.Tables(own).within(prints)]
    assert got == [i.tolist(), j.tolist(), apart[i, j].tolist()] and len(i) > 300
    assert [len(x) for x in decontam.Tables(own[:0]).within(prints)] == [0, 0, 0]


@pytest.mark.parametrize("size", [13, 22, 31, 40, 58, 103, 202, 400])
def test_similar_windows_are_within_the_radius(size):
    """Windows of the least similarity asked for, for sizes at which as many shingles as possible may differ."""
    r = np.random.default_rng(size)
    m, found = size - 4, 0
    for _ in range(500):
        shingles = r.integers(0, 1 << 63, m + m // 9, dtype=np.uint64)
        a, b = shingles[:m], np.append(shingles[m:], shingles[m // 9 : m])
        assert decontam.similarity(a, b) >= 0.8
        x, y = decontam.window_prints(a, m)[0], decontam.window_prints(b, m)[0]
        found += int(np.bitwise_count(x ^ y)) <= decontam.RADIUS
    assert found >= 495


def test_decontamination_awkward(spark, monkeypatch):
    table = awkward(spark)
    text = "the quick BROWN fox jumps over the lazy dog, near the river bank today"
    bench = spark.createDataFrame([(1, text, "x"), (1, text, "y"), (2, None, "z"), (3, "", "z"), (4, "...", "z"), (None, "six words that stand nowhere here", "z")], "item_id long, text string, doc_id string")
    for items in (20_000, 1):
        monkeypatch.setattr(decontam, "PASS_ITEMS", items)
        got = sorted((x["doc_id"], x["item_id"]) for x in decontam.leaks(table, bench).collect())
        assert got == [(1, 1), (1, 1), (6, 1), (6, 1), (6, 1), (6, 1), (8, 1), (8, 1)]
    many = bench.where("doc_id = 'x'").withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(5000))))
    monkeypatch.setattr(decontam, "PASS_ITEMS", 20_000)
    assert decontam.leaks(table, many).groupBy("doc_id").count().orderBy("doc_id").collect() == [(1, 5000), (6, 10000), (8, 5000)]
    kept = decontam.keep_unleaked(table, bench)
    assert kept.columns == table.columns and sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([2, 3, 4, 5, 7, None], key=str)
    assert decontam.leaks(empty(spark), bench).count() == 0 and decontam.leaks(table, bench.where("false")).count() == 0
