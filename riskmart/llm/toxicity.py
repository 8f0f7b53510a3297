"""Toxicity by a support vector machine on a subsequence string kernel with Nyström landmarks.

The kernel of two words counts the common subsequences of four letters, each weighted by
DECAY ** (letters it spans in both), so inserted characters and gaps lower the value but do not
end the match. Landmarks are short strings that tell toxic texts from others in the labelled
sample. A word is described by its kernel with each landmark; a sentence by the largest value of its
words, with values under FLOOR as 0; K_mm ** -1/2 turns that into Nyström features. A linear SVM is
trained on sentences: those of other texts, and of each toxic text the sentence that scores
highest (chosen anew in each round, as a label says only that some sentence is toxic). A text
scores as its highest sentence, through a logistic curve fitted on the sample.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm import bpe
from riskmart.llm.scratch import Scratch
from riskmart.llm.tables import arrow, draw, only, rows
from riskmart.llm.textbytes import slices

TRAIN_TOXIC, TRAIN_OTHER = 2000, 6000  # labelled rows learned from at most, drawn by a hash of doc_id
LANDMARKS = 48
STRINGS, CANDIDATES = 50_000, 3000  # strings of toxic texts counted elsewhere too, and the most telling of them
ORDER, DECAY, FLOOR = 4, 0.7, 0.2
GRAM = 5  # letters of a candidate string inside a word; whole words of 4 to 12 letters are candidates too
LONGEST = 32  # a longer word is described by overlapping stretches of this length
CACHE_WORDS = 250_000
BLOCK = 1 << 18  # pairs of places compared together

_SPELLED = re.compile(r"(?<!\S)(?:[^\W\d_][\s.*_-]+){3,}[^\W\d_](?!\w)")
_SENTENCE = re.compile(r"[.!?]*\n+|[.!?]+\s")
_WORD = re.compile(r"[^\W_]+")


def sentences(text: str) -> list[list[str]]:
    """Words of each sentence, in small letters; letters spelled out one by one make a sentence too."""
    text = text.lower()
    found = [s.split() for s in _SENTENCE.split(text)]
    found += [["".join(_WORD.findall(m[0]))] for m in _SPELLED.finditer(text)]
    return found


def stretches(word: str) -> list[str]:
    if len(word) <= LONGEST:
        return [word]
    return [word[i : i + LONGEST] for i in range(0, len(word) - LONGEST // 2, LONGEST // 2)]


def kernel(words: np.ndarray, landmarks: np.ndarray, word: np.ndarray, landmark: np.ndarray) -> np.ndarray:
    """Subsequence kernel of words[word] and landmarks[landmark]: code points, 0 behind the end.

    Summed over chains of ORDER places (i, j) where both have the same letter, each behind the one before in
    both. Only such places are looked at: a chain from (i, j) to (k, l) weighs DECAY ** (k + l + 2 - i - j).
    """
    x, u = words[word], landmarks[landmark]
    same = (x[:, :, None] == u[:, None, :]) & (x > 0)[:, :, None]
    row, place = np.divmod(np.flatnonzero(same), x.shape[1] * u.shape[1])
    i, j = np.divmod(place, u.shape[1])
    counts = np.bincount(row, minlength=len(word))
    first = np.cumsum(counts) - counts
    weight = DECAY ** np.arange(x.shape[1] + u.shape[1] + 1.0)
    total = np.zeros(len(word))
    for n in np.unique(counts[counts >= ORDER]).tolist():
        rows_ = np.flatnonzero(counts == n)
        step = max(BLOCK // (n * n), 1)
        for part in (rows_[k : k + step] for k in range(0, len(rows_), step)):
            at = first[part][:, None] + np.arange(n)
            a, b = i[at].astype(np.int16), j[at].astype(np.int16)
            behind = ((a[:, :, None] > a[:, None, :]) & (b[:, :, None] > b[:, None, :])).astype(float)
            chains = 1 / weight[a + b]
            for _ in range(ORDER - 1):
                chains = np.einsum("rab,rb->ra", behind, chains)
            total[part] = (chains * weight[a + b + 2]).sum(1)
    return total


def points(words: list[str]) -> np.ndarray:
    width = max(max(map(len, words), default=1), 1)
    return np.array(words, f"U{width}").view(np.uint32).reshape(len(words), width)


class Describer:
    """Kernel values of words with the landmarks, each landmark scaled to have 1 with itself."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        self.points = points(landmarks)
        every = np.arange(len(landmarks))
        self.scale = 1 / np.sqrt(np.maximum(kernel(self.points, self.points, every, every), 1e-12))
        self.alphabet = np.unique(self.points[self.points > 0])
        # masks[landmark, letter]: where the landmark has the letter
        kind = np.uint16 if max(map(len, landmarks), default=0) < 16 else np.uint64
        self.masks = np.zeros((len(landmarks), len(self.alphabet) + 1), kind)
        for i, name in enumerate(landmarks):
            for j, c in enumerate(name):
                self.masks[i, np.searchsorted(self.alphabet, ord(c))] |= kind(1 << j)

    def values(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, landmark, value) where the kernel, capped at 1, reaches FLOOR."""
        x = points(words)
        letter = np.searchsorted(self.alphabet, x)
        letter[letter == len(self.alphabet)] = 0
        letter = np.where(self.alphabet[letter] == x, letter, len(self.alphabet))
        at, which = [], []
        for k, name in enumerate(self.landmarks):  # common subsequences by bits: fewer than ORDER letters give 0
            masks = self.masks[k][letter]
            rest = np.full(len(words), (1 << len(name)) - 1, masks.dtype)
            full = rest.copy()
            for i in range(x.shape[1]):
                both = rest & masks[:, i]
                rest = ((rest + both) | (rest - both)) & full
            near = np.flatnonzero(np.bitwise_count(rest) + ORDER <= len(name))
            at.append(near)
            which.append(np.full(len(near), k))
        word, landmark = np.concatenate(at), np.concatenate(which)
        order = np.argsort(word, kind="stable")  # callers hand words by length: blocks stay narrow
        word, landmark = word[order], landmark[order]
        value = np.zeros(len(word))
        for a in range(0, len(word), 10_000):
            part = slice(a, a + 10_000)
            width = max(map(len, words[word[a] : word[part][-1] + 1]))
            value[part] = kernel(x[:, :width], self.points, word[part], landmark[part])
        value = np.minimum(value * self.scale[landmark] ** 2, 1.0)
        keep = value >= FLOOR
        return word[keep], landmark[keep], value[keep]


class Words(dict):
    """Sparse description of each word met: None for the many without any value."""

    def __init__(self, landmarks: list[str]):
        super().__init__()
        self.describer = Describer(landmarks)

    def meet(self, words: set[str]) -> None:
        if len(self) > CACHE_WORDS:
            self.clear()
        new = [w for w in words if w not in self]
        split = [(w, s) for w in new for s in stretches(w) if len(s) >= ORDER]
        self.update(dict.fromkeys(new))
        if not self.describer.landmarks:
            return
        split.sort(key=lambda pair: len(pair[1]))
        for a in range(0, len(split), 20_000):
            part = split[a : a + 20_000]
            for i, k, v in zip(*(x.tolist() for x in self.describer.values([s for _, s in part])), strict=True):
                word = part[i][0]
                if self[word] is None:
                    self[word] = {}
                self[word][k] = max(v, self[word].get(k, 0.0))

    def vectors(self, text: list[list[str]]) -> np.ndarray:
        """(sentences with any value, landmarks); all words of the sentences must have been met."""
        out = []
        for sentence in text:
            found = [d for d in map(self.__getitem__, sentence) if d]
            if found:
                row = np.zeros(len(self.describer.landmarks))
                for description in found:
                    for k, v in description.items():
                        row[k] = max(row[k], v)
                out.append(row)
        return np.array(out).reshape(len(out), len(self.describer.landmarks))

    def describe(self, texts: list[str]) -> list[np.ndarray]:
        split = [sentences(t) for t in texts]
        self.meet(set().union(*itertools.chain.from_iterable(split)))
        return [self.vectors(t) for t in split]


@dataclass
class Model:
    landmarks: list[str]
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, vectors: np.ndarray) -> float:
        return max(float((vectors @ self.weights).max(initial=0.0)), 0.0) + self.bias

    def score(self, vectors: np.ndarray) -> float:
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, self.slope * self.margin(vectors) + self.shift))))


def svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Weights and, last, bias of a linear SVM with squared hinge loss, by Newton steps on the margin's rows."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = np.diag([1.0] * (x.shape[1] - 1) + [1e-3])
    for _ in range(50):
        active = y * (x @ w) < 1
        a = x[active] * cost[active, None]
        after = np.linalg.solve(ridge + x[active].T @ a, a.T @ y[active])
        if np.abs(after - w).max() < 1e-9:
            break
        w = after
    return w


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift; targets are drawn in a little, so a clean split keeps them finite."""
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    w, z = np.zeros(2), np.stack([x, np.ones(len(x))], 1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -500, 500)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + 1e-6 * np.eye(2), z.T @ (target - p) - 1e-6 * w)
        w += step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def choose(counts: dict[str, tuple[int, int]], having: list[set[str]], n_other: int) -> list[str]:
    """Landmarks that together mark as many toxic texts as possible, each text less the more often it is marked."""
    weight = np.ones(len(having))
    where: dict[str, list[int]] = {}
    for i, found in enumerate(having):
        for gram in found:
            where.setdefault(gram, []).append(i)
    places = {g: np.array(p) for g, p in where.items()}
    chosen: list[str] = []
    while len(chosen) < LANDMARKS and places:
        gain = {g: weight[p].sum() - len(having) * counts[g][1] / max(n_other, 1) for g, p in places.items()}
        most = max(gain.values())
        if most < 2:
            break
        best = max((g for g in gain if gain[g] >= 0.9 * most), key=lambda g: (len(g), gain[g], g))
        chosen.append(best)
        weight[places[best]] *= 0.5
        parts = {best[i : i + ORDER] for i in range(len(best) - ORDER + 1)}
        places = {g: p for g, p in places.items() if not any(g[i : i + ORDER] in parts for i in range(len(g) - ORDER + 1))}
    return chosen


def grams(text: str) -> set[str]:
    words = set(_WORD.findall(text.lower()))
    inside = {w[i : i + GRAM] for w in words for i in range(len(w) - GRAM + 1)}
    return inside | {w for w in words if ORDER <= len(w) <= 12}


def fit(landmarks: list[str], texts: list[tuple[int, np.ndarray]]) -> Model:
    """``texts``: label and sentence vectors of each."""
    describer = Describer(landmarks)
    m = len(landmarks)
    i, j = np.divmod(np.arange(m * m), m)
    gram = kernel(describer.points, describer.points, i, j).reshape(m, m) * np.outer(describer.scale, describer.scale)
    values, vectors = np.linalg.eigh(gram)
    whiten = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T
    toxic = [v for label, v in texts if label and len(v)]
    other = np.concatenate([np.zeros((1, m)), *(v for label, v in texts if not label and len(v))])
    blank = sum(1 for label, v in texts if not label and not len(v))
    chosen = [v[v.sum(1).argmax()] for v in toxic]
    for _ in range(4):
        x = np.concatenate([np.array(chosen).reshape(len(chosen), m), other]) @ whiten
        y = np.array([1.0] * len(chosen) + [-1.0] * len(other))
        w = svm(x, y, np.array([1.0] * len(chosen) + [max(blank, 1.0)] + [1.0] * (len(other) - 1)))
        weights = whiten @ w[:-1]
        again = [v[(v @ weights).argmax()] for v in toxic]
        if all((a == b).all() for a, b in zip(again, chosen, strict=True)):
            break
        chosen = again
    model = Model(landmarks, weights, float(w[-1]), 1.0, 0.0)
    margins = np.array([model.margin(v) for _, v in texts])
    model.slope, model.shift = logistic(margins, np.array([float(label) for label, _ in texts]))
    return model


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """``docs`` (doc_id, text), ``labels`` (doc_id, toxic): learn from a bounded sample; None if it lacks either label.

    At most TRAIN_TOXIC toxic and TRAIN_OTHER other labels, those that come first by a hash of doc_id,
    with the whole texts of their documents. Strings are counted per task and summed by Spark. The driver
    gets the counts of the STRINGS most frequent in toxic texts, and the sentences of the sample that have any value.
    """
    own = only(labels, doc_id="long", toxic="int").where("toxic in (0, 1)")
    chosen = draw(own.where("toxic = 1"), "toxic", TRAIN_TOXIC).unionByName(draw(own.where("toxic = 0"), "toxic", TRAIN_OTHER))
    # A few thousand numbers at most: the documents stay where they are.
    plain = only(docs, doc_id="long", text="string").where("text is not null")
    sample = plain.join(F.broadcast(chosen), "doc_id").select("text", "toxic").repartition(16).persist()
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if not (sizes.get(0) and sizes.get(1)):
        sample.unpersist()
        return None
    counted = arrow("gram string, n long")

    def holding(part: DataFrame, among: set[str] | None) -> DataFrame:
        """(gram, n): texts of the sample that hold each string."""

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bpe.forget()
            found: Counter = Counter()
            for batch in batches:
                for text in batch.column("text").to_pylist():
                    found.update(grams(text) if among is None else grams(text) & among)
            yield rows(counted, list(found), list(found.values()))

        return part.mapInArrow(count, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))

    often = holding(sample.where("toxic = 1"), None).where(F.col("n") >= max(2, sizes[1] // 200))
    marked = {r["gram"]: r["n"] for r in often.orderBy(F.desc("n"), "gram").limit(STRINGS).collect()}
    plain_counts = {r["gram"]: r["n"] for r in holding(sample.where("toxic = 0"), set(marked)).collect()}
    lift = {g: n / sizes[1] - 3 * plain_counts.get(g, 0) / sizes[0] for g, n in marked.items()}
    best = sorted((g for g in lift if lift[g] > 0), key=lambda g: (-lift[g], g))[:CANDIDATES]
    counts = {g: (marked[g], plain_counts.get(g, 0)) for g in best}
    number = {g: i for i, g in enumerate(best)}

    def which(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [grams(t) & number.keys() for t in batch.column("text").to_pylist()]
            yield rows(arrow("found array<int>"), [sorted(map(number.__getitem__, found)) for found in held])

    lists = sample.where("toxic = 1").mapInArrow(which, "found array<int>").collect()
    having = [{best[i] for i in r["found"]} for r in lists]
    landmarks = choose(counts, having, sizes[0])
    if not landmarks:
        sample.unpersist()
        return None

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(landmarks)
        for batch in batches:
            found = words.describe(batch.column("text").to_pylist())
            yield rows(arrow("toxic int, vectors binary"), batch.column("toxic"), [v.astype("<f4").tobytes() for v in found])

    seen = sample.mapInArrow(describe, "toxic int, vectors binary").collect()
    sample.unpersist()
    texts = sorted((r["toxic"], bytes(r["vectors"])) for r in seen)
    return fit(landmarks, [(t, np.frombuffer(v, "<f4").astype(float).reshape(-1, len(landmarks))) for t, v in texts])


SCORED = "doc_id long, score double, predicted int"
def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, score, predicted for each row; every word of every text counts.

    Null and empty texts score like texts without any marked word; without a model all score 0.
    Repeated rows score alike, an empty table gives no rows, other columns take no part.
    """
    plain = only(docs, doc_id="long", text="string")
    if model is None:
        return plain.select("doc_id", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    schema = arrow(SCORED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe.forget()
        words = Words(model.landmarks)
        for batch in itertools.chain.from_iterable(map(slices, batches)):
            found = words.describe([x or "" for x in batch.column("text").to_pylist()])
            scores = [model.score(v) for v in found]
            yield rows(schema, batch.column("doc_id"), scores, [int(s >= 0.5) for s in scores])

    return plain.mapInArrow(run, SCORED)


def learned(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Train on the labels whose crc32(doc_id) mod 5 is not 0."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    return train(docs, labels.where(fold != 0))


def score_held_out(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from the labels whose crc32(doc_id) mod 5 is not 0, score all documents; held_out marks that fold.

    Rows with a null doc_id are in no fold: nothing is learned from them, they are scored, held_out is false.
    """
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    scored = score(docs, learned(docs, labels))
    return scored.select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents not predicted toxic; all columns are kept, and rows with a null doc_id stay."""
    toxic = score(docs, learned(docs, labels)).where("predicted = 1").select("doc_id").distinct()
    toxic = Scratch(docs.sparkSession, "toxicity").save(toxic, "toxic")
    return docs.join(toxic, "doc_id", "left_anti").select(docs.columns)
