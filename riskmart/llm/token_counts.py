"""Greedy word-piece counts by an automaton that never builds the pieces.

A trie over the vocabulary gets failure links and, with each link, the number of pieces that are
certain by then ("popped"): when the trie can not go on, the automaton adds that number and goes on
at the node that stands for what is left. Each character is read once, so a word costs linear time
whatever its pieces are.
"""

from __future__ import annotations

import itertools
import json
import unicodedata
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from riskmart.llm.tables import arrow, only, rows
from riskmart.llm.textbytes import slices

WORD_END = "</w>"
_CACHE_WORDS = 300_000
_open: dict[str, Counter] = {}


class Automaton:
    """Longest-match-first pieces of a word. ``end`` closes every word and may close pieces."""

    def __init__(self, vocabulary: Iterable[str], end: str = WORD_END):
        self.end = "\0"
        self.next: list[dict[str, int]] = [{}]
        self.whole = [False]
        for piece in vocabulary:
            if not piece:
                continue
            piece = piece[: -len(end)] + self.end if end and piece.endswith(end) else piece
            node = 0
            for c in piece:
                if c not in self.next[node]:
                    self.next[node][c] = len(self.next)
                    self.next.append({})
                    self.whole.append(False)
                node = self.next[node][c]
            self.whole[node] = True
        self._link()

    def _link(self) -> None:
        """fail[v], pops[v]: where to go on, and how many pieces are then behind; fail -1: no piece fits."""
        n = len(self.next)
        self.fail, self.pops = [-1] * n, [0] * n
        queue = deque([0])
        while queue:
            parent = queue.popleft()
            for c, node in self.next[parent].items():
                queue.append(node)
                if self.whole[node]:  # the string of this node is one piece, nothing is left of it
                    self.fail[node], self.pops[node] = 0, 1
                    continue
                back, popped = self.fail[parent], self.pops[parent]
                while back >= 0 and c not in self.next[back]:
                    popped += self.pops[back]
                    back = self.fail[back]
                if back >= 0:
                    self.fail[node], self.pops[node] = self.next[back][c], popped

    def count(self, word: str) -> int:
        """Pieces of ``word``, or -1 if greedy matching leaves a rest that no piece fits."""
        node = popped = 0
        for c in itertools.chain(word.replace(self.end, "�"), self.end):
            while c not in self.next[node]:
                back = self.fail[node]
                if back < 0:
                    if c == self.end and node == 0:  # nothing is left but an end that closes no piece
                        return popped
                    return -1
                popped += self.pops[node]
                node = back
            node = self.next[node][c]
        while node:
            if self.fail[node] < 0:
                return -1
            popped += self.pops[node]
            node = self.fail[node]
        return popped


def alphabet() -> dict[int, str]:
    """The letter by which a byte-level vocabulary spells each byte."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}


_ALPHABET = alphabet()


def _kinds(step: dict | None) -> set[str]:
    """Types of a normalizer or pre-tokenizer and of the steps in it."""
    inner = (step or {}).get("normalizers", []) + (step or {}).get("pretokenizers", [])
    return {(step or {}).get("type", "")}.union(*map(_kinds, inner))


class Counter(dict):
    """Pieces of each word seen by this worker; an unknown word is one unknown piece, stored as -1."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        self.automaton = Automaton(file["model"]["vocab"])
        self.bytes = "ByteLevel" in _kinds(file.get("pre_tokenizer"))
        self.nfc = "NFC" in _kinds(file.get("normalizer"))

    def words(self, text: str) -> list[str]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text) if self.nfc else text
            text = text.replace("Σ", "σ")  # the file lower-cases letter by letter: no final sigma
        return text.lower().split()

    def __missing__(self, word: str) -> int:
        spelt = word.encode().decode("latin-1").translate(_ALPHABET) if self.bytes else word
        n = self.automaton.count(spelt)
        if len(word) <= 64:
            self[word] = n
        return n


def counter(path: str) -> Counter:
    if path not in _open:
        _open[path] = Counter(path)
    return _open[path]


COUNTS = "doc_id long, n_words long, n_tokens long, n_unknown long"


def token_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Per document: words, word pieces (an unknown word counts as one), unknown words.

    ``vocabulary`` is a tokenizer file whose pieces mark word ends by ``</w>``. Texts are brought to NFC
    if the file says so, lower-cased and split at white space. Where the file's pre-tokenizer is
    ByteLevel, pieces spell the UTF-8 bytes of a word, and so are words spelt before they are matched. Null and empty texts have no words. Repeated rows stay repeated, an
    empty table gives no rows, other columns take no part.
    """
    schema = arrow(COUNTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(vocabulary)
        for batch in itertools.chain.from_iterable(map(slices, batches)):
            words, tokens, unknown = [], [], []
            for text in batch.column("text").to_pylist():
                found = list(map(count.__getitem__, count.words(text or "")))
                bad = found.count(-1)
                words.append(len(found))
                tokens.append(sum(found) + 2 * bad)
                unknown.append(bad)
            if len(count) > _CACHE_WORDS:
                count.clear()
            yield rows(schema, batch.column("doc_id"), words, tokens, unknown)

    return only(docs, doc_id="long", text="string").mapInArrow(run, COUNTS)
