"""Spelling variants of a vocabulary: acceptor, one-edit transducer and acceptor composed.

The words of a partition are kept as a minimised acceptor. The transducer copies symbols, makes exactly one
edit (another symbol, or one more), and copies the rest. Composed with the acceptor on both sides it accepts
the pairs of words that are one edit apart; the pairs are enumerated from the initial state.

One machine over the whole vocabulary would not fit a task, so the initial state is partitioned by where the
edit stands. Two words whose common prefix has ``lo`` to ``hi - 1`` symbols share their first ``lo`` symbols
and all after the edit: these are the key of a partition, in which the machine starts behind the shared
prefix. Every word starts with the two halves of its length; partitions of too many words are cut again at
half the interval, down to one place, where as many words share a key as there are symbols at most.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.scratch import Scratch
from riskmart.llm.tables import arrow, only, rows

LEAST_CHARS, LEAST_COUNT, RATIO = 6, 5, 5
PARTITION_WORDS = 2000
PLACES = 128  # places of the edit in one partition: longer words are cut before they meet an acceptor
SHARD_ROWS = 20_000  # rows of small partitions handed to one call


class Acceptor:
    """Minimal acyclic automaton of words given in order; state 0 accepts only the empty word, ``start`` is initial."""

    def __init__(self, words: Sequence[str]):
        self.next: list[dict[str, int]] = [{}]
        self.final = [True]
        known: dict[tuple, int] = {(True,): 0}
        path: list[tuple[dict[str, int], list[bool]]] = [({}, [False])]  # open states of the last word
        last = ""
        for word in words:
            same = len(_shared(last, word))
            self._close(path, last, same, known)
            path.extend(({}, [False]) for _ in word[same:])
            path[-1][1][0] = True
            last = word
        self._close(path, last, 0, known)
        self.start = self._state(*path[0], known)

    def _close(self, path: list, last: str, depth: int, known: dict) -> None:
        """Give the open states below ``depth`` their place, shared with equal ones."""
        while len(path) > depth + 1:
            state = self._state(*path.pop(), known)
            path[-1][0][last[len(path) - 1]] = state

    def _state(self, follow: dict[str, int], final: list[bool], known: dict) -> int:
        mark = (final[0], *follow.items())
        if mark not in known:
            known[mark] = len(self.next)
            self.next.append(follow)
            self.final.append(final[0])
        return known[mark]


def _shared(a: str, b: str) -> str:
    n = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return a[:n]


def one_edit_pairs(left: Acceptor, right: Acceptor) -> Iterator[tuple[str, str]]:
    """Pairs (u of left, v of right) where v is u with one symbol replaced or inserted; some come several times."""
    known: dict[tuple[int, int], list[str]] = {}

    def common(a: int, b: int) -> list[str]:
        """Words accepted from both states: the copying part behind the edit."""
        if (a, b) not in known:
            out = [""] if left.final[a] and right.final[b] else []
            follow = right.next[b]
            for x, after in left.next[a].items():
                if x in follow:
                    out += [x + rest for rest in common(after, follow[x])]
            known[a, b] = out
        return known[a, b]

    todo = [("", left.start, right.start)]
    while todo:
        head, a, b = todo.pop()
        for y, d in right.next[b].items():
            for rest in common(a, d):
                yield head + rest, head + y + rest
            for x, c in left.next[a].items():
                if x == y:
                    todo.append((head + x, c, d))
                else:
                    for rest in common(c, d):
                        yield head + x + rest, head + y + rest


NEAR = "word string, near string, near_n long"


def _near_in(words: Sequence[tuple[str, int]], m: int, lo: int, hi: int) -> Iterator[tuple[str, str, int]]:
    """(word, near word, its count) both ways, of pairs with ``lo`` to ``hi - 1`` symbols in front of the edit.

    ``words`` share their first ``lo`` symbols and those behind place ``hi`` and have m or m + 1; one of a pair has m.
    """
    behind = max(0, m - hi)
    counts = dict(words)
    inner = sorted(w[lo : len(w) - behind] for w in counts if len(w) == m)
    both = sorted(w[lo : len(w) - behind] for w in counts)
    any_word = next(iter(counts))
    head, tail = any_word[:lo], any_word[len(any_word) - behind :]
    for u, v in set(one_edit_pairs(Acceptor(inner), Acceptor(both))):
        u, v = head + u + tail, head + v + tail
        if lo <= len(_shared(u, v)) < hi:
            yield u, v, counts[v]
            if len(v) > len(u):
                yield v, u, counts[u]


_KEY = ("m", "lo", "hi", "head", "tail")


def _keyed(words: DataFrame, intervals: str) -> DataFrame:
    """A row per word and interval (m, lo, hi), with what words of a pair share there."""
    cut = words.select("word", "n", F.expr(f"inline({intervals})"))
    head = F.expr("substring(word, 1, lo)")
    tail = F.expr("CASE WHEN hi < m THEN right(word, m - hi) ELSE '' END")
    return cut.select("m", "lo", "hi", head.alias("head"), tail.alias("tail"), "word", "n")


def near_words(words: DataFrame, scratch: Scratch, partition_words: int = PARTITION_WORDS) -> DataFrame:
    """NEAR: for ``words`` (word string, n long; distinct) every pair at exactly one edit, both ways, once."""
    schema = arrow(NEAR)

    def find(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in _KEY])
        out: list[tuple] = []
        for (m, lo, hi, *_), same in itertools.groupby(zip(*(table[c].to_pylist() for c in (*_KEY, "word", "n")), strict=True), key=lambda x: x[:5]):
            out.extend(_near_in([x[5:] for x in same], m, lo, hi))
        return pa.Table.from_batches([rows(schema, *(zip(*out, strict=True) if out else ([], [], [])))])

    halves = "flatten(transform(array(char_length(word), char_length(word) - 1), m -> array(struct(m, 0 AS lo, m div 2 AS hi), struct(m, m div 2 AS lo, m + 1 AS hi))))"
    classes = f"transform(filter({halves}, x -> x.m > 0), x -> struct(x.m AS m, CAST(x.lo AS int) AS lo, CAST(x.hi AS int) AS hi))"
    keyed = scratch.save(_keyed(words, f"filter({classes}, x -> x.lo < x.hi)"), "keys")
    found = []
    while True:
        # Sums are written before they are joined back, so both sides are plain shuffles and a hot key can be split.
        sizes = keyed.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("size"), F.count_if(F.expr("char_length(word) = m")).alias("short"))
        sizes = scratch.save(sizes.where("size > 1 AND short > 0"), "sizes")
        wide = F.col("hi") - F.col("lo")
        fits = ((F.col("size") <= partition_words) & (wide <= PLACES)) | (wide == 1)
        n, hot = sizes.agg(F.sum(F.when(fits, F.col("size"))), F.count_if(~fits)).first()
        shards = max(1, -(-(n or 0) // SHARD_ROWS))
        small = keyed.join(sizes.where(fits).drop("size", "short"), list(_KEY)).withColumn("shard", F.pmod(F.xxhash64(*_KEY), F.lit(shards)))
        found.append(scratch.save(small.groupBy("shard").applyInArrow(find, NEAR), "near"))
        if not hot:
            break
        large = keyed.join(sizes.where(~fits).drop("size", "short"), list(_KEY))
        middle = "CAST((lo + hi) div 2 AS int)"
        finer = _keyed(large, f"array(struct(m, lo, {middle} AS hi), struct(m, {middle} AS lo, hi))")
        keyed = scratch.save(finer, "keys")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root) from (word, form): the last word of each chain of forms.

    Every step doubles the length of the chains followed; counts grow along a chain, so there are no rings.
    """
    reached = scratch.save(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        step = scratch.save(reached.join(onward, "root", "left").select("word", "root", "beyond"), "steps")
        if step.where("beyond IS NOT NULL").isEmpty():
            return reached
        scratch.drop(reached)
        reached = scratch.save(step.select("word", F.coalesce("beyond", "root").alias("root")), "roots")


def variants(words: DataFrame, ratio: int = RATIO, least_count: int = LEAST_COUNT, least_chars: int = LEAST_CHARS, partition_words: int = PARTITION_WORDS) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n.

    ``words`` has word and n, its occurrences; rows that repeat a word are summed, null words and counts take
    no part. Words shorter or rarer than the least are left out. Words are near if exactly one code point is inserted, deleted or replaced.
    A word's form is its near word with the largest n (ties: smallest by code points) if that is at least ``ratio``
    times its own, else null; its root is the last word reached over forms, itself without one. A word
    without near words has n_near 0. An empty table gives no rows, other columns take no part.
    """
    if ratio < 2:
        raise ValueError("a form occurs more often than its variants")
    scratch = Scratch(words.sparkSession, "spelling")
    plain = only(words, word="string", n="long").where("word IS NOT NULL AND n IS NOT NULL")
    plain = plain.groupBy("word").agg(F.sum("n").alias("n")).where((F.col("n") >= least_count) & (F.char_length("word") >= least_chars))
    plain = scratch.save(plain, "words")
    near = near_words(plain, scratch, partition_words)
    best = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    linked = plain.join(best, "word", "left")
    taken = -F.col("best.less") >= ratio * F.col("n")
    linked = linked.select(
        "word",
        F.when(taken, F.col("best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(taken, -F.col("best.less")).alias("form_n"),
    )
    linked = scratch.save(linked, "forms")
    roots = _roots(linked.where("form IS NOT NULL"), scratch)
    return linked.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def letter_runs(docs: DataFrame) -> DataFrame:
    """doc_id, word: every maximal run of Latin letters up to U+00FF in the text, A to Z in lower case."""
    found = F.explode(F.regexp_extract_all("text", F.lit("[A-Za-zÀ-ÿ]+"), F.lit(0)))
    each = only(docs, doc_id="long", text="string").select("doc_id", found.alias("run"))
    lowered = F.when(F.lower("run") == F.col("run"), F.col("run")).otherwise(F.translate("run", UPPER, UPPER.lower()))
    return each.select("doc_id", lowered.alias("word"))
