"""Byte-level BPE ids of many texts, each distinct piece of text encoded once per worker.

The pre-tokenizer cuts a text into pieces that the model encodes one by one: letters, digits or other
characters, each with a space before them if there is one, and white space. Where two ASCII characters, or
letters of Latin-1, are certain to be in different pieces, texts are cut here, for all texts of a batch at
once; other characters stay together with their neighbours and go through the whole tokenizer. The stretches
between cuts repeat, so a batch looks up each of them once, and a worker remembers the first ones it meets, up
to a fixed size. Strings of special tokens in a text are ordinary text.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from riskmart.llm.textbytes import flat, flat_binary, mix

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

_ONE = re.compile(rb" ?(?:(?:[A-Za-z]|\xC3[\x80-\x96\x98-\xB6\xB8-\xBF])+|[0-9]+)").fullmatch
_SHORT = 15  # bytes of the stretches kept in arrays
_MOST = 1 << 20  # of them, and four times as many ids: some 45 MB
_LONG_BYTES = 8 << 20  # what longer ones, of up to 64 bytes, may take
_open: dict[str, Bpe] = {}

_ANY, _LETTER, _DIGIT, _MARK, _QUOTE, _SPACE, _WHITE = range(7)
_KIND = np.zeros(256, np.uint8)  # of bytes; _ANY: not known from the byte
_KIND[0x21:0x7F] = _MARK
_KIND[0x30:0x3A] = _DIGIT
_KIND[0x41:0x5B] = _KIND[0x61:0x7B] = _LETTER
_KIND[0x27], _KIND[0x20], _KIND[0x09:0x0E] = _QUOTE, _SPACE, _WHITE
_CUT = np.zeros(64, bool)  # by 8 * kind + next kind: the two are in different pieces
for _a in range(_LETTER, _SPACE):
    for _b in range(_LETTER, _WHITE + 1):
        marks = _a >= _MARK and _MARK <= _b <= _QUOTE
        _CUT[8 * _a + _b] = not (_a == _b or marks or (_a, _b) == (_QUOTE, _LETTER))  # 's, 'll, ... are pieces
_CUT[8 * _WHITE + _LETTER : 8 * _WHITE + _SPACE] = True


def pack(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


def stretches(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the stretches of all texts begin, in ascending order, and len(raw) as the last."""
    n = len(raw)
    cut = np.zeros(n + 2, bool)
    kind = np.zeros(n + 2, np.uint8)
    kind[:n] = _KIND[raw]
    lead = np.flatnonzero(raw[:-1] == 0xC3)
    after = raw[lead + 1]
    lead = lead[(after >= 0x80) & (after <= 0xBF) & (after != 0x97) & (after != 0xB7)]  # U+00C0 to U+00FF but two signs
    kind[lead] = kind[lead + 1] = _LETTER
    pair = kind[:-1] << 3
    pair |= kind[1:]
    cut[1:] = _CUT[pair]
    cut[offsets] = False
    first = np.zeros(n + 2, bool)
    first[offsets] = True
    sure = (kind >= _LETTER) & (kind < _SPACE)
    # White space before a character of another kind gives its last character away.
    white = kind >= _SPACE
    inner = np.flatnonzero(white[:-1] & white[1:]) + 1
    inner = inner[~first[inner] & ~first[inner + 1]]
    cut[inner] = sure[inner + 1]
    # If what stands before that last character may be white space too, nothing is cut.
    ends = np.flatnonzero(cut[1:] & (kind[:-1] == _WHITE) & sure[1:]) + 1
    ends = ends[~first[ends - 1]]
    cut[ends[kind[ends - 2] == _ANY]] = False
    cut[offsets] = True
    cut[n] = False
    return np.append(np.flatnonzero(cut[:n]), n)


def _runs(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ..., ``size[0]`` numbers, then those from begin[1] on, and so forth."""
    out = np.repeat(begin - (np.cumsum(size) - size), size)
    out += np.arange(len(out))
    return out


def _keys(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which stretches are short, and two numbers that stand for each of those: its bytes and their count."""
    starts, size = offsets[:-1], np.diff(offsets)
    padded = np.append(raw, np.zeros(16, np.uint8))
    eight = np.ndarray(len(raw) + 9, "<u8", padded, strides=(1,))  # the 8 bytes from any place on
    keep = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
    low = eight[starts] & keep[np.minimum(size, 8)]
    high = eight[np.minimum(starts + 8, len(raw))] & keep[np.clip(size - 8, 0, 7)]
    return size <= _SHORT, low, high | size.astype(np.uint64) << np.uint64(56)


class _Known:
    """Ids of short stretches by their keys: an open-addressed table, many looked up or added in step."""

    def __init__(self):
        self.n = 0
        self.slots = np.zeros(2 * _MOST, np.int32)  # entry + 1, or 0
        self.low, self.high = np.zeros(_MOST, np.uint64), np.zeros(_MOST, np.uint64)
        self.edges = np.zeros(_MOST + 1, np.int32)
        self.ids = np.zeros(4 * _MOST, "<u4")

    def _places(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return (mix(low ^ mix(high)) & np.uint64(len(self.slots) - 1)).astype(np.int64)

    def find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Entry of each key, -1 if it has none."""
        out = np.full(len(low), -1, np.int64)
        left, at = np.arange(len(low)), self._places(low, high)
        while len(left):
            entry = self.slots[at].astype(np.int64) - 1
            taken = entry >= 0
            same = taken & (self.low[entry] == low[left]) & (self.high[entry] == high[left])
            out[left[same]] = entry[same]
            more = taken & ~same
            left, at = left[more], (at[more] + 1) & (len(self.slots) - 1)
        return out

    def add(self, low: np.ndarray, high: np.ndarray, ids: list[bytes]) -> None:
        """Keys that differ and have no entry; as many of them as there is room for."""
        ends = self.edges[self.n] + np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)) // 4)
        k = min(_MOST - self.n, int(np.searchsorted(ends, len(self.ids), "right")))
        if not k:
            return
        entry = np.arange(self.n, self.n + k)
        self.low[entry], self.high[entry], self.edges[entry + 1] = low[:k], high[:k], ends[:k]
        self.ids[self.edges[self.n] : ends[k - 1]] = np.frombuffer(b"".join(ids[:k]), "<u4")
        self.n += k
        at = self._places(low[:k], high[:k])
        while len(entry):
            free = self.slots[at] == 0
            self.slots[at[free]] = entry[free] + 1  # of several that meet at a place one stays
            lost = self.slots[at] != entry + 1
            entry, at = entry[lost], (at[lost] + 1) & (len(self.slots) - 1)


class Bpe:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.forget()
        spell = self.tokenizer.pre_tokenizer.pre_tokenize_str
        plain = [*b"\t\n\x0b\x0c\r", *range(0x20, 0x7F)]
        self.letters = {b: spell(chr(b))[0][0] for b in plain}  # how the vocabulary spells a byte
        for char in map(chr, range(0xC0, 0x100)):
            self.letters.update(zip(char.encode(), spell(char)[0][0], strict=True))

    def forget(self) -> None:
        self.known: _Known | None = None  # made when texts come: memory given back may be cleared, and so taken, at once
        self.long: dict[bytes, bytes] = {}
        self.size = 0

    def _ids(self, texts: list[str]) -> Iterator[bytes]:
        for start in range(0, len(texts), 20_000):
            for found in self.tokenizer.encode_batch_fast(texts[start : start + 20_000], add_special_tokens=False):
                yield pack(found.ids)

    def _fresh(self, new: list[bytes]) -> dict[bytes, bytes]:
        """Ids of stretches. One of letters alone, or of digits, is one piece, with a space before it too."""
        out: dict[bytes, bytes] = {}
        other = []
        letters, piece_ids = self.letters, self.tokenizer.model.tokenize
        for part in new:
            if _ONE(part):
                out[part] = pack([x.id for x in piece_ids(part.decode("latin-1").translate(letters))])
            else:
                other.append(part)
        out.update(zip(other, self._ids([part.decode() for part in other]), strict=True))
        return out

    def encode_column(self, column: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts of a column, each with ``end_id`` after it, and the n + 1 offsets of texts in them; null is empty."""
        ids, edges = self._encode(column)
        return np.insert(ids, edges[1:], end_id), edges + np.arange(len(edges))

    def _encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        raw, offsets = flat(column)
        if not len(raw):
            return np.zeros(0, "<u4"), np.zeros(len(offsets), np.int64)
        if self.known is None:
            self.known = _Known()
        at = stretches(raw, offsets)
        parts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(raw)])
        found = parts.dictionary_encode()
        which = found.indices.to_numpy()
        short, low, high = _keys(*flat_binary(found.dictionary))
        entry = np.full(len(short), -1, np.int64)
        entry[short] = self.known.find(low[short], high[short])
        old, new = np.flatnonzero(entry >= 0), np.flatnonzero(entry < 0)
        begin, end = self.known.edges[entry[old]].astype(np.int64), self.known.edges[entry[old] + 1]
        every = self.known.ids[_runs(begin, end - begin)]
        size = np.zeros(len(entry), np.int64)
        size[old] = end - begin
        if len(new):
            ids = self._other(found.dictionary.take(pa.array(new)).to_numpy(zero_copy_only=False).tolist())
            size[new] = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            every = np.append(every, np.frombuffer(b"".join(ids), "<u4"))
            new_short = np.flatnonzero(short[new])
            self.known.add(low[new[new_short]], high[new[new_short]], [ids[i] for i in new_short.tolist()])
        source, place = np.zeros(len(size), np.int64), np.concatenate([old, new])
        source[place] = np.cumsum(size[place]) - size[place]
        edges = np.zeros(len(which) + 1, np.int64)
        np.cumsum(size[which], out=edges[1:])
        return every[_runs(source[which], size[which])], edges[np.searchsorted(at, offsets)]

    def _other(self, parts: list[bytes]) -> list[bytes]:
        """Ids of stretches that are long or were not met before."""
        ids = list(map(self.long.get, parts))
        fresh = self._fresh([part for part, x in zip(parts, ids, strict=True) if x is None])
        if self.size < _LONG_BYTES:
            kept = {part: x for part, x in fresh.items() if _SHORT < len(part) <= 64}
            self.long.update(kept)
            self.size += 180 * len(kept) + 3 * sum(map(len, kept))
        return [fresh[part] if x is None else x for part, x in zip(parts, ids, strict=True)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        ids, edges = self._encode(pa.array(texts, pa.large_string()))
        return [ids[a:b].tobytes() for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]


def bpe(path: str) -> Bpe:
    """The tokenizer at ``path``, loaded once per worker."""
    if path not in _open:
        _open[path] = Bpe(path)
    return _open[path]


def forget() -> None:
    """Give up the pieces met: for operators that need memory in a worker where tokens were counted before."""
    for coder in _open.values():
        coder.forget()


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
