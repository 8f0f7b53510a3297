"""Language identification by prediction by partial matching (PPM).

For each language a tree of byte contexts (up to three bytes) holds how often each byte followed.
A byte costs -log2 of its probability in the longest known context; where the context has not been
followed by it, the escape probability is paid (method C: distinct followers against all) and the
next shorter context decides, down to 256 equal chances. Statistics are frozen after training, so
the cost of every (context, byte) can be tabled once, for all languages side by side, in
whole 1/512 bits. A text's cost is then one table lookup per byte, and the language with the
shortest code wins.
"""

from __future__ import annotations

import itertools
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.tables import arrow, draw, only, rows
from riskmart.llm.textbytes import flat, slices

TRAIN_DOCS = 400  # per language, drawn by a hash of the document number
BROADCAST_ROWS = 200_000  # drawn numbers, up to which they are broadcast to the documents
UNIT = 512
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


def _counts(data: bytes) -> Counter:
    """How often each string of one to four bytes occurs; a text starts after a newline."""
    x = np.frombuffer(b"\n" + data, np.uint8).astype(np.uint32)
    out: Counter = Counter()
    for n in range(1, 5):
        key = np.zeros(max(len(x) - n + 1, 0), np.uint32)
        for k in range(n):
            key = (key << np.uint32(8)) | x[k : len(x) - n + 1 + k]
        values, counts = np.unique(key, return_counts=True)
        out.update(dict(zip(((n << 32) | values.astype(np.int64)).tolist(), counts.tolist(), strict=True)))
    return out


def lowered(raw: np.ndarray) -> np.ndarray:
    """ASCII capitals as small letters."""
    return np.where((raw >= 65) & (raw <= 90), raw + np.uint8(32), raw)


def train(labelled: DataFrame, docs_per_language: int = TRAIN_DOCS) -> Ppm:
    """``labelled`` (doc_id, text, lang): counts over a bounded sample, summed per task, then by Spark.

    The sample is the ``docs_per_language`` rows of each language that come first by a hash of
    doc_id, with their whole texts; only counts of strings of up to four bytes go to the driver.
    Null text or language, and empty texts, teach nothing.
    """
    plain = only(labelled, doc_id="long", text="string", lang="string").where("lang is not null and length(text) > 0")
    chosen = draw(plain.select("doc_id", "lang"), "lang", docs_per_language)
    if chosen.count() <= BROADCAST_ROWS:
        chosen = F.broadcast(chosen)
    sample = plain.join(chosen, ["doc_id", "lang"]).select("lang", "text")
    schema = arrow("lang string, gram long, n long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                data = lowered(np.frombuffer(text.encode(), np.uint8)).tobytes()
                totals.setdefault(lang, Counter()).update(_counts(data))
        for lang, counts in totals.items():
            yield rows(schema, [lang] * len(counts), list(counts), list(counts.values()))

    summed = sample.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    found = summed.toPandas()
    return Ppm.of({str(k): dict(zip(g["gram"], g["n"], strict=True)) for k, g in found.groupby("lang")})


@dataclass(eq=False)
class Ppm:
    """Frozen statistics: the known contexts of any language, and what each byte costs after them."""

    languages: list[str]
    contexts: np.ndarray  # (length << 32) | bytes of each node; node 0 is the empty context
    cost: np.ndarray  # (nodes, 256, languages), in 1 / UNIT bits

    @classmethod
    def of(cls, counts: dict[str, dict[int, int]]) -> Ppm:
        languages = sorted(counts)
        grams = sorted({g for c in counts.values() for g in c})
        nodes = [0, *sorted({((g >> 32) - 1) << 32 | (g & 0xFFFFFFFF) >> 8 for g in grams if g >> 32 > 1})]
        number = {c: i for i, c in enumerate(nodes)}
        table = np.full((len(nodes), 256, max(len(languages), 1)), 8 * UNIT, np.uint16)
        for k, lang in enumerate(languages):
            followers: dict[int, list[tuple[int, int]]] = {}
            for g, n in counts[lang].items():
                context = 0 if g >> 32 == 1 else ((g >> 32) - 1) << 32 | (g & 0xFFFFFFFF) >> 8
                followers.setdefault(context, []).append((g & 0xFF, n))
            bits: dict[int, np.ndarray] = {}
            for context in nodes:  # shorter contexts come first
                length, tail = context >> 32, context & 0xFFFFFFFF
                shorter = 0 if length <= 1 else (length - 1) << 32 | tail & ((1 << 8 * (length - 1)) - 1)
                lower = np.full(256, 8.0) if context == 0 else bits.get(shorter, bits[0])
                if found := followers.get(context):
                    symbols, n = np.array(found).T
                    whole = n.sum() + len(n)
                    lower = lower - np.log2(len(n) / whole)
                    lower[symbols] = -np.log2(n / whole)
                bits[context] = lower
                table[number[context], :, k] = np.minimum(np.rint(lower * UNIT), 65535)
        return cls(languages, np.array(nodes, np.int64), table)

    def lookup(self) -> np.ndarray:
        """Node of the longest known context that ends any three bytes."""
        out = np.zeros((256, 256, 256), np.int32)
        for node, context in enumerate(self.contexts.tolist()):
            length, a, b, c = context >> 32, context >> 16 & 255, context >> 8 & 255, context & 255
            if length == 1:
                out[:, :, c] = node
            elif length == 2:
                out[:, b, c] = node
            elif length == 3:
                out[a, b, c] = node
        return out.reshape(-1)

    def bits(self, raw: np.ndarray, offsets: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """(documents, languages): code length of each text in 1 / UNIT bits."""
        x = np.concatenate([np.full(3, 10, np.uint8), lowered(raw)])
        three = x.astype(np.int32)
        context = three[:-3] << 16 | three[1:-2] << 8 | three[2:-1]
        heads = offsets[:-1]
        for k in range(3):  # bytes of the text before are no context: newlines stand there
            at = heads[heads + k < offsets[1:]] + k
            context[at] = 10 << 16 | 10 << 8 | 10 if k == 0 else (
                10 << 16 | 10 << 8 | three[at + 2] if k == 1 else 10 << 16 | three[at + 1] << 8 | three[at + 2]
            )
        place = nodes[context].astype(np.int64) * 256 + x[3:]
        costs = self.cost.reshape(-1, self.cost.shape[2])
        out = np.zeros((len(heads), costs.shape[1]), np.int64)
        full = np.flatnonzero(offsets[1:] > heads)
        if len(full):
            for a in range(costs.shape[1]):
                out[full, a] = np.add.reduceat(costs[place, a], heads[full], dtype=np.int64)
        return out


PREDICTED = "doc_id long, lang_pred string, score double"


def predict(docs: DataFrame, model: Ppm) -> DataFrame:
    """doc_id, lang_pred, score for each row: the language with the shortest code, ties to the first name.

    The score is the winner's share of 2 ** -bits, bits counted per letter-sized evidence: code
    lengths are divided by the square root of the text's bytes, so long texts do not all score 1.
    ``und`` and score 0 where the text is null or has no letter, or nothing was learned. Every byte
    of every text counts. Repeated rows are predicted alike; other columns take no part.
    """
    key = uuid.uuid4().hex
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.contexts, model.cost))
    schema = arrow(PREDICTED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ppm = Ppm(*shared.value)
        if key not in _kept:
            _kept.clear()
            _kept[key] = ppm.lookup()
        nodes = _kept[key]
        names = np.array([*ppm.languages, "und"], object)
        for batch in itertools.chain.from_iterable(map(slices, batches)):
            raw, offsets = flat(batch.column("text"))
            sizes = np.diff(offsets)
            seen = np.zeros(len(raw) + 1, np.int64)
            np.cumsum(_LETTER[raw], out=seen[1:])
            letter = seen[offsets[1:]] > seen[offsets[:-1]]
            for i in np.flatnonzero(~letter & (sizes > 0)).tolist():
                letter[i] = any(map(str.isalpha, raw[offsets[i] : offsets[i + 1]].tobytes().decode()))
            bits = ppm.bits(raw, offsets, nodes)
            best = bits.argmin(1)
            spread = (bits - bits.min(1, keepdims=True)) / UNIT / np.sqrt(np.maximum(sizes, 1))[:, None]
            score = 1 / np.exp2(-spread).sum(1)
            known = letter & (len(ppm.languages) > 0)
            yield rows(schema, batch.column("doc_id"), names[np.where(known, best, -1)], np.where(known, score, 0.0))

    return only(docs, doc_id="long", text="string").mapInArrow(run, PREDICTED)


_kept: dict[str, np.ndarray] = {}


def predict_held_out(docs: DataFrame) -> DataFrame:
    """Learn from documents whose crc32(doc_id) mod 4 is not 2, predict all; held_out marks that fold.

    Rows with a null doc_id are in no fold: nothing is learned from them, they are predicted, held_out is false.
    """
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    model = train(docs.where(fold != 2))
    return predict(docs, model).select("doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
