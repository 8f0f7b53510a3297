"""Tokenizer, range coder, token files, packing and word-piece counts, against brute force."""

import itertools
import json
import random
import unicodedata
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from cases import LONG, awkward, docs, empty, sentences
from hypothesis import given, settings
from hypothesis import strategies as st

from riskmart.llm import bpe, packing, rangecoder, token_counts, token_files
from riskmart.llm.bpe import Bpe, default_path
from riskmart.llm.rangecoder import decode, encode

PARTS = [*"abcXYZ é中'.,-0189 \n\t\x1c\x0b\x00\u00a0\u3000", " ", "<|endoftext|>", " '", "'s", "'ll", "  ", " word.", " end,"]
TEXT = st.lists(st.sampled_from(PARTS), max_size=30).map("".join)


@pytest.fixture(scope="module")
def coder():
    return Bpe(default_path())


def plain_ids(coder, text):
    return np.array(coder.tokenizer.encode(text or "", add_special_tokens=False).ids, "<u4")


@settings(max_examples=400, deadline=None)
@given(st.lists(TEXT, max_size=4))
def test_units_give_the_tokenizer_s_ids(coder, texts):
    assert [np.frombuffer(x, "<u4").tolist() for x in coder.encode(texts)] == [plain_ids(coder, t).tolist() for t in texts]


EDGES = [*"aZé×÷œ²\u0301\u0085\u2028\u00a0😀", *"ab 1'.\t\n\r\x1c\x7f", " ", "  ", "\n", "\r\n", "'s", "''", "!'s", " 'll", "12", "x" * 15, "y" * 16, " " + "é" * 8, "q" * 70]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from(EDGES), max_size=14).map("".join), max_size=5))
def test_stretches_give_the_tokenizer_s_ids(coder, texts):
    """Characters that the bytes do not tell beside all kinds that they do, and stretches around the lengths kept."""
    for _ in range(2):  # met, then remembered
        ids, edges = coder.encode_column(pa.array([*texts, None], pa.string()), 2)
        want = [[*plain_ids(coder, t).tolist(), 2] for t in [*texts, None]]
        assert [ids[a:b].tolist() for a, b in itertools.pairwise(edges.tolist())] == want


def test_words_are_encoded_once_whatever_stands_beside_them(monkeypatch):
    """Every pair of 60 words, joined in four ways: the model meets each word with and without a space, no pair of them."""
    words = [a + b + "é" for a in "abcdefghij" for b in "uvwxyz"]
    text = "".join(f" {a}{sep}{b}" for a in words for b in words for sep in (".\n", "$", "\n", " "))
    coder, asked = Bpe(default_path()), []
    fresh = coder._fresh
    monkeypatch.setattr(coder, "_fresh", lambda parts: asked.extend(parts) or fresh(parts))
    got = [coder.encode([text]) for _ in range(2)]
    assert got[0] == got[1] == [plain_ids(coder, text).tobytes()]
    assert len(asked) == len(set(asked)) < 130


def test_a_full_memory_changes_no_ids(monkeypatch):
    monkeypatch.setattr(bpe, "_MOST", 8)
    monkeypatch.setattr(bpe, "_LONG_BYTES", 200)
    coder = Bpe(default_path())
    for k in range(4):
        texts = [f"word{i} and{'x' * (i + k)} {'y' * i}. a b c d e f" for i in range(20)]
        assert coder.encode(texts) == [plain_ids(coder, t).tobytes() for t in texts]
    assert coder.known.n == 8 or coder.known.edges[coder.known.n] > 20
    coder.forget()
    assert coder.known is None and not coder.long  # nothing is held until texts come
    assert coder.encode(texts) == [plain_ids(coder, t).tobytes() for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 70_000), max_size=300), st.integers(1, 70), st.integers(1, 5))
def test_range_coder(ids, block, times):
    ids = ids * times
    assert decode(encode(np.array(ids, np.int64), block)).tolist() == ids


def test_range_coder_shrinks_and_notices_damage():
    r = np.random.default_rng(0)
    ids = np.minimum(r.geometric(0.02, 50_000), 40_000)
    data = encode(ids)
    assert (decode(data) == ids).all() and len(data) < 1.05 * len(ids)
    assert len(encode(np.tile(r.integers(0, 50_000, 200), 100))) < 30_000
    for at in (len(data) // 2, len(data) - 40):
        bad = bytearray(data)
        bad[at] ^= 0x55
        with pytest.raises(ValueError):
            decode(bytes(bad))
    with pytest.raises(ValueError):
        decode(data[:-2])


def test_range_coder_keeps_narrow_tables():
    """What a block remembers takes two bytes an entry where the chunk has fewer ids than two bytes hold."""
    few, many = (rangecoder._Model(3, n) for n in (50_000, 70_000))
    assert few.one.itemsize == few.two.itemsize == 2 and many.one.itemsize == 4
    for n in ((1 << 16) - 1, 1 << 16, (1 << 16) + 1):
        ids = np.random.default_rng(n).permutation(np.tile(np.arange(n) * 7, 2))
        assert (decode(encode(ids)) == ids).all()


def want_files(coder, rows, end):
    out, before = [], 0
    for doc_id, text in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0)):
        ids = np.append(plain_ids(coder, text), end).astype("<u4")
        out.append((doc_id, before, len(ids), zlib.crc32(ids.tobytes())))
        before += len(ids)
    return out


def test_token_files(spark, coder):
    rows = [(i * 3 % 101, t) for i, t in enumerate(sentences(101, 3))]
    got = token_files.round_trip(docs(spark, rows)).orderBy("start").collect()
    assert [tuple(x) for x in got] == want_files(coder, rows, 2)


def test_token_files_awkward(spark, coder, tmp_path):
    rows = [(r["doc_id"], r["text"]) for r in awkward(spark).collect()]
    token_files.write(awkward(spark), f"{tmp_path}/ids", chunk_tokens=50)
    chunks = spark.read.parquet(f"{tmp_path}/ids")
    got = token_files.checksums(chunks).orderBy("start").collect()
    assert [tuple(x) for x in got] == want_files(coder, rows, 2) and chunks.count() > 2
    assert token_files.round_trip(empty(spark)).count() == 0


def test_token_files_rows_of_one_number(spark, coder):
    rows = [(None if i % 3 else i % 2, f"{i % 50} text of many rows") for i in range(300)]
    got = token_files.round_trip(docs(spark, rows).repartition(5)).orderBy("start").collect()
    want = want_files(coder, rows, 2)
    assert sorted((x["doc_id"] or -1, x["n_tokens"], x["ids_crc32"]) for x in got) == sorted((x[0] or -1, *x[2:]) for x in want)
    assert [x["doc_id"] for x in got] == [x[0] for x in want]
    assert [x["start"] for x in got[1:]] == [x["start"] + x["n_tokens"] for x in got[:-1]]


def check_packing(coder, rows, got, capacity):
    by_doc = {}
    for x in got:
        by_doc.setdefault((x["doc_id"], x["doc_tokens"]), []).append(x)
    remaining = sorted((i, len(plain_ids(coder, t)) + 1) for i, t in rows if i is not None)
    assert sorted({k for k in by_doc if k[0] is not None}) == sorted(set(remaining))
    for doc_id, text in rows:
        ids = np.append(plain_ids(coder, text), 0).astype("<u4")
        own = sorted(by_doc[doc_id, len(ids)], key=lambda x: x["start"])
        for x in own:
            assert x["ids_crc32"] == zlib.crc32(ids[x["start"] : x["start"] + x["length"]].tobytes()) and x["length"] > 0
        assert sum(x["length"] for x in own) == len(ids) * sum(1 for r in rows if r == (doc_id, text))
    bins = {}
    for x in got:
        bins.setdefault(x["sequence_id"], []).append((x["offset"], x["length"]))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return bins


def test_first_fit_decreasing():
    r = random.Random(0)
    for _ in range(200):
        sizes = [r.randrange(1, 21) for _ in range(r.randrange(0, 40))]
        bins, want = [], [None] * len(sizes)
        for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
            k = next((k for k, used in enumerate(bins) if used + sizes[i] <= 20), None)
            if k is None:
                bins.append(0)
                k = len(bins) - 1
            want[i] = (k, bins[k])
            bins[k] += sizes[i]
        assert packing.first_fit_decreasing(sizes, 20) == want


def test_packing(spark, coder):
    rows = [(i, t) for i, t in enumerate(sentences(300, 9, low=1, high=120))]
    got = packing.pack(docs(spark, rows), capacity=256, group_docs=100).collect()
    bins = check_packing(coder, rows, got, 256)
    assert sum(x["length"] for x in got) / (256 * len(bins)) > 0.97


def test_groups_stay_small_without_numbers(spark, coder):
    """A third of the rows has no doc_id, another third one text under one number: no group gets all of them."""
    texts = sentences(700, 3, low=1, high=12)
    rows = [(None, t) for t in texts] + [(7, "the same")] * 700 + [(100 + i, t) for i, t in enumerate(texts)]
    got = packing.pack(docs(spark, rows), group_docs=100).collect()
    sizes = Counter(x["sequence_id"] >> 32 for x in got)
    assert sum(sizes.values()) == 2100 and len(sizes) == 21 and max(sizes.values()) < 200


def test_packing_awkward(spark, coder):
    rows = [(r["doc_id"], r["text"]) for r in awkward(spark).collect()]
    got = packing.pack(awkward(spark)).collect()
    check_packing(coder, rows, got, 1024)
    assert [x["length"] for x in got if x["doc_id"] == 2] == [1]
    assert packing.pack(empty(spark)).count() == 0


def greedy(word, vocabulary):
    """Longest piece first; the word's end may belong to a piece or stand alone."""
    n, rest = 0, word + "\0"
    while rest and rest != "\0":
        k = next((k for k in range(len(rest), 0, -1) if rest[:k] in vocabulary), 0)
        if not k:
            return -1
        n, rest = n + 1, rest[k:]
    return n


@settings(max_examples=300, deadline=None)
@given(st.sets(st.text("abc", min_size=1, max_size=5), max_size=12), st.sets(st.text("abc", min_size=1, max_size=4), max_size=6), st.lists(st.text("abcd", min_size=1, max_size=14), max_size=8))
def test_automaton_counts_greedy_pieces(inner, closing, words):
    automaton = token_counts.Automaton([*inner, *(x + "</w>" for x in closing)])
    vocabulary = inner | {x + "\0" for x in closing}
    assert [automaton.count(w) for w in words] == [greedy(w, vocabulary) for w in words]


def byte_letters():
    """As GPT-2 spells bytes: printable Latin-1 as it is, the others from U+0100 on."""
    out, n = {}, 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out[b] = chr(b)
        else:
            out[b], n = chr(256 + n), n + 1
    return out


def test_token_counts(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        vocabulary = {p.removesuffix("</w>") + "\0" if p.endswith("</w>") else p for p in json.load(f)["model"]["vocab"]}
    got = sorted((tuple(x) for x in token_counts.token_counts(awkward(spark), path).collect()), key=str)
    want, letters = [], byte_letters()
    for r in awkward(spark).collect():
        found = [greedy("".join(letters[b] for b in w.encode()), vocabulary) for w in (r["text"] or "").lower().split()]
        want.append((r["doc_id"], len(found), sum(abs(n) for n in found), found.count(-1)))
    assert got == sorted(want, key=str) and any(x[1] == len(LONG.split()) for x in got)
    assert token_counts.token_counts(empty(spark), path).count() == 0


def test_token_counts_spell_bytes(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        vocabulary = {p.removesuffix("</w>") + "\0" if p.endswith("</w>") else p for p in json.load(f)["model"]["vocab"]}
    letters = byte_letters()
    words = ["für", "FÜR", "fu\u0308r", "ción", "中国", "€5", "“the", "naïve", "Straße", "ΟΔΟΣ", "ıİ", "a\0b", "\x7f", "plain"]
    rows = [(i, w) for i, w in enumerate(words)] + [(99, " ".join(words)), (100, None)]
    got = {x["doc_id"]: tuple(x)[1:] for x in token_counts.token_counts(docs(spark, rows), path).collect()}
    plain = [unicodedata.normalize("NFC", w) for w in words]
    spelt = ["".join(letters[b] for b in "".join(c.lower() for c in w).encode()) for w in plain]
    want = [greedy(w, vocabulary) for w in spelt]
    assert min(want) > 0 and [got[i] for i in range(len(words))] == [(1, n, 0) for n in want]
    assert got[99] == (len(words), sum(want), 0) and got[100] == (0, 0, 0)
    assert [got[words.index(w)][1] for w in ("für", "ción", "中国")] == [2, 1, 4] and got[0] == got[1] == got[2]
