"""Benchmark decontamination by pigeonhole edit matching.

A document is contaminated by a test item if some stretch of it is within the
item's error budget (``RATE`` of its length in edits), both normalised: lower
case, each run of other characters than letters and digits as one space. Of
budget + 1 pieces of the item at least one then occurs unchanged, so an
automaton finds the pieces' exact hits in every whole text. By the same
principle some pair of neighbouring pieces holds one error at most, so a hit
counts only where its partner follows (or precedes) with one error or none; a
count of shared trigrams drops places that can't be within the budget. Neither
drops a place that is. Myers' bit-parallel distance verifies the rest.

Items are a stated query set: they reach the tasks in blocks of at most
``BLOCK_BYTES``, and all documents are read once for each block. Items that
are null or have no letter or digit match nothing; null and empty texts match
nothing; repeated items and rows give their matches each. Empty tables give
no matches. Other columns are kept by ``clean`` and ignored by ``matches``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import lean, prepare, slices, table

RATE = 0.1
BLOCK_BYTES = 8 << 20
_OTHER = re.compile(r"[\W_]+")


def norm(text: str | None) -> str:
    return _OTHER.sub(" ", (text or "").lower()).strip()


def budget(item: str) -> int:
    return int(RATE * len(item))


def pieces(item: str) -> list[tuple[int, str]]:
    """(offset, piece): budget + 1 of nearly equal length."""
    n = budget(item) + 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def one_off(piece: str, text: str) -> bool:
    """Whether ``piece`` is within one edit of some prefix of ``text``."""
    n = len(piece)
    if text.startswith(piece):
        return True
    i = 0
    for a, b in zip(piece, text, strict=False):
        if a != b:
            break
        i += 1
    return text.startswith(piece[i + 1 :], i + 1) or text.startswith(piece[i + 1 :], i) or text.startswith(piece[i:], i + 1) or i == n - 1


def myers(pattern: str, text: str) -> int:
    """Least edit distance of ``pattern`` to any stretch of ``text``."""
    m = len(pattern)
    every, top = (1 << m) - 1, 1 << (m - 1)
    at: dict[str, int] = {}
    for i, c in enumerate(pattern):
        at[c] = at.get(c, 0) | 1 << i
    up, down, score = every, 0, m
    best = m
    for c in text:
        eq = at.get(c, 0)
        vert = eq | down
        diag = (((eq & up) + up) ^ up) | eq
        plus = down | (every & ~(diag | up))
        minus = up & diag
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
            best = min(best, score)
        plus = plus << 1 & every
        up = (minus << 1 & every) | (every & ~(vert | plus))
        down = plus & vert
    return best


class Matcher:
    """Finds the items of one block in texts."""

    def __init__(self, items: list[tuple[int | None, str]]):
        import ahocorasick

        self.items = [(i, t, budget(t), [t[k : k + 3] for k in range(len(t) - 2)]) for i, x in items if (t := norm(x))]
        self.automaton = ahocorasick.Automaton()
        for k, (_, t, _, _) in enumerate(self.items):
            own = pieces(t)
            for j, (off, piece) in enumerate(own):
                # Its partner: the next piece, or the one before it backwards; none for an odd last one.
                after = own[j + 1][1] if j % 2 == 0 and j + 1 < len(own) else None
                before = own[j - 1][1][::-1] if j % 2 else None
                hit = (k, off, len(piece), after, before)
                if self.automaton.exists(piece):
                    self.automaton.get(piece).append(hit)
                else:
                    self.automaton.add_word(piece, [hit])
        if self.items:
            self.automaton.make_automaton()

    def matches(self, raw: str | None) -> list[tuple[int | None, int]]:
        """(item_id, distance) of the items within their budget."""
        text = norm(raw)
        if not self.items or not text:
            return []
        starts: dict[int, set[int]] = {}
        for end, hits in self.automaton.iter(text):
            for k, off, n, after, before in hits:
                if after is not None:
                    near = one_off(after, text[end + 1 : end + 2 + len(after)])
                else:
                    near = before is None or one_off(before, text[max(0, end - n - len(before)) : end + 1 - n][::-1])
                if near:
                    starts.setdefault(k, set()).add(end + 1 - n - off)
        out = []
        for k, at in starts.items():
            item, t, most, grams = self.items[k]
            best, lo, hi = most + 1, None, None
            for s in [*sorted(at), None]:
                if lo is not None and (s is None or s - most > hi):
                    window = text[max(0, lo) : hi]
                    have = {window[i : i + 3] for i in range(len(window) - 2)}
                    if sum(g in have for g in grams) >= len(grams) - 3 * most:
                        best = min(best, myers(t, window))
                    lo = None
                if s is not None:
                    lo = s - most if lo is None else lo
                    hi = s + len(t) + most
            if best <= most:
                out.append((item, best))
        return out


_MATCHERS: dict[tuple, Matcher] = {}


def _matcher(shared) -> Matcher:
    key = (shared.value[0],)
    if key not in _MATCHERS:
        _MATCHERS.clear()
        _MATCHERS[key] = Matcher(shared.value[1])
    return _MATCHERS[key]


def _blocks(spark: SparkSession, items: DataFrame) -> Iterator:
    """Broadcasts of at most about BLOCK_BYTES of items each."""
    import uuid

    size = items.agg(F.sum(F.octet_length("text")).alias("b")).first().b or 0
    n = -(-size // BLOCK_BYTES) or 1
    for k in range(n):
        some = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).select(F.col("item_id").cast("long"), "text")
        yield spark.sparkContext.broadcast((uuid.uuid4().hex, [tuple(r) for r in some.collect()]))


def matches(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, distance): the contaminated documents and what by."""
    spark = docs.sparkSession
    prepare(spark)
    out = None
    for shared in _blocks(spark, items):

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            found = _matcher(shared)
            for b in slices(batches):
                rows = [(d, i, n) for d, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True) for i, n in found.matches(t)]
                cols = list(zip(*rows, strict=True)) or [(), (), ()]
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32())], names=["doc_id", "item_id", "distance"])

        part = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, item_id long, distance int")
        out = part if out is None else out.unionByName(part)
    return out


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the contaminated rows, in a pass that moves no row."""
    spark = docs.sparkSession
    prepare(spark)
    for shared in _blocks(spark, items):

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            found = _matcher(shared)
            for b in slices(batches):
                yield b.filter(pa.array([not found.matches(t) for t in b.column(b.schema.get_field_index("text")).to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(lean(run), docs.schema)
    return docs


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
