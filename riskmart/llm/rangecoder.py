"""Context-mixing range coder for token ids, many blocks in step.

A chunk of ids is cut into blocks. Each block has a coder and models of its own that start afresh,
and a checksum, so any block can be decoded alone. All blocks of a chunk are coded together: every
variable of the coder is an array with one entry per block, and step t codes the t-th id of each.

An id is coded by mixing three predictions. The order-2 and order-1 models each propose the id that
last followed the same two ids, or the same id, in this block; how often such proposals came true
sets their share of the probability, and both shares adapt with each id. What they leave goes to
the order-0 model, the chunk's id frequencies, kept in its header.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"TKM2"
BLOCK = 1024
_HEAD = struct.Struct("<4sIQII")  # magic, block length, ids, distinct ids, bytes of the id table
_SCALE = 18  # order-0 frequencies sum to 2 ** 18
_MIX = 14  # shares of the three predictions sum to 2 ** 14
_RATE = 5  # a share moves by 1/32 of the way to each outcome
_SLOTS = 8  # 2 ** 8 contexts are remembered per order and block
_U = np.uint64
_TOTAL = _U(_MIX + _SCALE)  # 32: intervals are unsigned 32-bit integers
_TOP, _BOTTOM, _WORD = _U(1 << 48), _U(1 << 44), _U(16)


def _place(distinct: int) -> type:
    """Type of places in a table of so many ids, and of their number itself."""
    return np.uint16 if distinct < 1 << 16 else np.uint32


class _Model:
    """Proposals and shares for the next id of each block; ids are places in the chunk's table, as large as it: none yet."""

    def __init__(self, lanes: int, distinct: int):
        kind = _place(distinct)
        self.at = np.arange(lanes, dtype=np.intp) << _SLOTS
        self.one = np.full(lanes << _SLOTS, distinct, kind)
        self.two = np.full(lanes << _SLOTS, distinct, kind)
        self.trust2, self.trust1 = np.zeros(lanes, np.int16), np.zeros(lanes, np.int16)
        self.last = np.zeros(lanes, np.uint32)
        self.slot2, self.slot1 = self.at, self.at

    def shrink(self, n: int) -> None:
        for name in ("at", "trust2", "trust1", "last", "slot2", "slot1"):
            setattr(self, name, getattr(self, name)[:n])

    def propose(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids proposed by order 2 and order 1 and their shares, 16 at least; 48 are left over."""
        share2 = self.trust2.astype(np.uint32) + 16
        share1 = (((1 << _MIX) - 64 - share2) * self.trust1.astype(np.uint32) >> _MIX) + 16
        return self.two.take(self.slot2), self.one.take(self.slot1), share2, share1

    def learn(self, ids: np.ndarray, is2: np.ndarray, is1: np.ndarray) -> None:
        most = np.int16((1 << _MIX) - 384)
        self.trust2 += (is2 * most - self.trust2) >> _RATE
        self.trust1 += ((is1 * most - self.trust1) >> _RATE) * ~is2
        self.two[self.slot2] = ids
        self.one[self.slot1] = ids
        spread = ids * np.uint32(0x9E3779B1)
        self.slot2 = self.at + ((spread + self.last) >> (32 - _SLOTS))
        self.slot1 = self.at + (spread >> (32 - _SLOTS))
        self.last = spread * np.uint32(0x85EBCA6B)


class _Order0:
    """Frequencies of the ids of a chunk, scaled to sum to 2 ** _SCALE, each at least 1."""

    def __init__(self, ids: np.ndarray, freqs: np.ndarray):
        self.ids, self.freqs = ids, freqs
        self.cum = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(freqs, out=self.cum[1:])

    @classmethod
    def of(cls, tokens: np.ndarray) -> _Order0:
        counts = np.bincount(tokens)
        ids = np.flatnonzero(counts)
        total, spare = counts.sum(), (1 << _SCALE) - len(ids)
        if spare < 0:
            raise ValueError("more distinct ids than the scale has places")
        freqs = 1 + counts[ids] * spare // max(total, 1)
        if len(ids):
            freqs[np.argmax(freqs)] += (1 << _SCALE) - freqs.sum()
        return cls(ids, freqs)

    def pack(self) -> bytes:
        return zlib.compress(np.diff(self.ids, prepend=0).astype("<u4").tobytes() + self.freqs.astype("<u4").tobytes(), 6)

    @classmethod
    def unpack(cls, data: bytes, n: int) -> _Order0:
        both = np.frombuffer(zlib.decompress(data), "<u4").astype(np.int64)
        return cls(np.cumsum(both[:n]), both[n:])


class _Coder:
    """Carryless range coder: low and range of each block, renewed 16 bits at a time.

    The k-th words of all blocks stand together; ``at`` is the place of the next word of each block.
    """

    def __init__(self, lanes: int, width: int):
        self.lanes = lanes
        self.low = np.zeros(lanes, _U)
        self.range = np.full(lanes, _U(0xFFFFFFFFFFFFFFFF))
        self.at = np.arange(lanes, dtype=np.intp)
        self.words = np.zeros(lanes * width, "<u2")

    def _narrow(self, n: int, step: np.ndarray, cum: np.ndarray, freq: np.ndarray) -> None:
        """Narrow the first n blocks to their intervals, then shift out the words that are settled."""
        low, span = self.low[:n], self.range[:n]
        low += cum * step
        np.multiply(step, freq, out=span)
        move = np.flatnonzero(((low ^ (low + span)) < _TOP) | (span < _BOTTOM))
        while len(move):
            a, r = low.take(move), span.take(move)
            settled = (a ^ (a + r)) < _TOP
            if not settled.all():
                r = np.where(settled, r, (_U(0) - a) & (_BOTTOM - _U(1)))
            self._shift(move, a)
            a <<= _WORD
            r <<= _WORD
            low[move], span[move] = a, r
            move = move[((a ^ (a + r)) < _TOP) | (r < _BOTTOM)]


class _Encoder(_Coder):
    def __init__(self, lanes: int, steps: int):
        super().__init__(lanes, 3 * steps + 8)

    def put(self, cum: np.ndarray, freq: np.ndarray) -> None:
        n = len(cum)
        self._narrow(n, self.range[:n] >> _TOTAL, cum, freq)

    def _shift(self, lanes: np.ndarray, low: np.ndarray) -> None:
        at = self.at.take(lanes)
        self.words[at] = low >> _U(48)
        self.at[lanes] = at + self.lanes

    def finish(self) -> list[bytes]:
        every = np.arange(len(self.low))
        for _ in range(4):
            self._shift(every, self.low)
            self.low <<= _WORD
        sizes = self.at // max(self.lanes, 1)
        used = np.ascontiguousarray(self.words.reshape(-1, self.lanes)[: sizes.max(initial=0)].T) if self.lanes else []
        return [words[:n].tobytes() for words, n in zip(used, sizes.tolist(), strict=True)]


class _Decoder(_Coder):
    def __init__(self, payloads: list[bytes]):
        width = max(map(len, payloads), default=0) // 2 + 8
        super().__init__(len(payloads), width)
        words = np.frombuffer(b"".join(data.ljust(2 * width, b"\0") for data in payloads), "<u2")
        self.words = words.reshape(self.lanes, width).T.reshape(-1)
        self.code = np.zeros(len(payloads), _U)
        for _ in range(4):
            self._shift(np.arange(len(payloads)), None)

    def seek(self, n: int) -> np.ndarray:
        """Where in the total the code of each of the first n blocks points."""
        self.step = self.range[:n] >> _TOTAL
        place = (self.code[:n] - self.low[:n]) // self.step
        return np.minimum(place, _U((1 << int(_TOTAL)) - 1)).astype(np.uint32)

    def take(self, cum: np.ndarray, freq: np.ndarray) -> None:
        self._narrow(len(cum), self.step, cum, freq)

    def _shift(self, lanes: np.ndarray, low: np.ndarray | None) -> None:
        at = self.at.take(lanes)
        self.code[lanes] = (self.code.take(lanes) << _WORD) | self.words.take(at, mode="clip")
        self.at[lanes] = at + self.lanes


def _interval(is2, is1, share2, share1, cum0, freq0) -> tuple[np.ndarray, np.ndarray]:
    """Interval of an id in 2 ** (_MIX + _SCALE): proposals first, the order-0 intervals in what they leave."""
    given = share2 + share1
    left = (1 << _MIX) - given
    cum = np.where(is1, share2 << _SCALE, (given << _SCALE) + left * cum0)
    cum *= ~is2
    return cum, np.where(is2, share2 << _SCALE, np.where(is1, share1 << _SCALE, left * freq0))


def _lengths(n: int, block: int) -> np.ndarray:
    full = np.full(n // block, block, np.int64)
    return np.append(full, n % block) if n % block else full


def encode(tokens: np.ndarray, block: int = BLOCK) -> bytes:
    """Bytes of one chunk of ids (below 2 ** 31); an empty chunk is a header alone."""
    tokens = np.asarray(tokens, np.int64)
    order0 = _Order0.of(tokens)
    lengths = _lengths(len(tokens), block)
    lanes = len(lengths)
    distinct = len(order0.ids)
    place_of = np.zeros(tokens.max(initial=0) + 1, _place(distinct))
    place_of[order0.ids] = np.arange(distinct)
    grid = np.zeros(lanes * block, place_of.dtype)
    grid[: len(tokens)] = place_of[tokens]
    grid = np.ascontiguousarray(grid.reshape(lanes, block).T)
    cums, freqs = order0.cum[:-1].astype(np.uint32), order0.freqs.astype(np.uint32)
    model, coder = _Model(lanes, distinct), _Encoder(lanes, min(block, len(tokens)))
    live = lanes
    for t in range(int(lengths.max(initial=0))):
        if live and lengths[live - 1] <= t:  # only the last block can be shorter
            live -= 1
            model.shrink(live)
        ids = grid[t, :live]
        two, one, share2, share1 = model.propose()
        is2 = two == ids
        is1 = (one == ids) & ~is2
        coder.put(*_interval(is2, is1, share2, share1, cums.take(ids), freqs.take(ids)))
        model.learn(ids, is2, is1)
    payloads = coder.finish()
    raw, ends = tokens.astype("<u4"), np.cumsum(lengths)
    sums = [zlib.crc32(raw[e - n : e]) for e, n in zip(ends, lengths, strict=True)]
    table = order0.pack()
    index = np.array([[len(p) for p in payloads], sums], "<u4").tobytes()
    return _HEAD.pack(MAGIC, block, len(tokens), len(order0.ids), len(table)) + table + index + b"".join(payloads)


def decode(data: bytes) -> np.ndarray:
    """Ids of a chunk; ValueError if a block does not match its checksum."""
    magic, block, n, distinct, size = _HEAD.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a chunk of ids")
    at = _HEAD.size + size
    order0 = _Order0.unpack(data[_HEAD.size : at], distinct)
    lengths = _lengths(n, block)
    lanes = len(lengths)
    sizes, sums = np.frombuffer(data, "<u4", 2 * lanes, at).reshape(2, lanes)
    ends = at + 8 * lanes + np.cumsum(sizes.astype(np.int64))
    if len(data) != (ends[-1] if lanes else at):
        raise ValueError("a chunk of the wrong length")
    coder = _Decoder([data[e - s : e] for e, s in zip(ends.tolist(), sizes.tolist(), strict=True)])
    lookup = np.repeat(np.arange(distinct, dtype=_place(distinct)), order0.freqs)
    cums, freqs = order0.cum[:-1].astype(np.uint32), order0.freqs.astype(np.uint32)
    model, grid = _Model(lanes, distinct), np.zeros((block, lanes), lookup.dtype)
    live = lanes
    for t in range(int(lengths.max(initial=0))):
        if live and lengths[live - 1] <= t:
            live -= 1
            model.shrink(live)
        two, one, share2, share1 = model.propose()
        place = coder.seek(live)
        given = share2 + share1
        top = place >> _SCALE
        is2 = top < share2
        is1 = ~is2 & (top < given)
        k = lookup.take((place - (given << _SCALE)) // ((1 << _MIX) - given), mode="clip")
        coder.take(*_interval(is2, is1, share2, share1, cums.take(k), freqs.take(k)))
        ids = np.where(is2, two, np.where(is1, one, k))
        grid[t, :live] = ids
        model.learn(ids, is2, is1)
    # A damaged block may take a proposal that is not there: any id will do, its checksum tells.
    tokens = np.append(order0.ids, 0)[grid.T.reshape(-1)[:n]]
    raw, edges = tokens.astype("<u4"), np.cumsum(lengths)
    for i, (e, k) in enumerate(zip(edges.tolist(), lengths.tolist(), strict=True)):
        if zlib.crc32(raw[e - k : e]) != sums[i]:
            raise ValueError(f"block {i} does not match its checksum")
    return tokens
