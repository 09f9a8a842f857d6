"""Substring dedup by recompression: words that long repeats cover go.

Every text is parsed in rounds, the same way wherever it stands: a run of one
symbol becomes a symbol named by the symbol and the run's length, then a pair
whose names' coins fall left and right becomes a symbol named by the pair.
Names are 64-bit hashes of what they are made of, so equal token runs and
pairs get equal names in every task without an exchange. Each symbol also
carries its context: the words that fixed how it was parsed. Where a stretch
of words holds a symbol's whole context, every other occurrence of that
stretch holds the symbol at the same place.

1. The anchor of a window of ``WINDOW`` words is its longest symbol (ties: the
   largest name) of those whose context it holds, of any round, so equal
   windows have equal anchors. Following windows with one anchor are a run;
   its record holds the anchor and a hash of all words of the run.
2. Runs meet by anchor, first within a batch of documents, then across tasks.
   Runs with equal words repeat: verified without reading texts again. A run
   whose anchor occurs nowhere else doesn't. Where an anchor has runs of
   several contents (edges of copies, chance repeats of short symbols, runs
   that repeat themselves), at least one run of each content is opened.
3. The windows of opened runs are read again and meet by anchor and by the
   window's own hash.
   What a batch can tell by itself needs no meeting: it sends at most two
   records of an anchor, and one of a window, however many copies it holds, so
   a key that a third of all rows share reaches its task once or twice for
   each batch.
4. Words covered by repeated windows are removed.

Names and word hashes have 64 bits each and count only together (an anchor and
a hash of all words). Windows are judged on the input. Null and empty texts
have no words and stay empty; texts shorter than a window keep all; repeated
rows are other places, so their long texts go altogether; rows are told apart
by 82 bits of hashes of id and text (rows that agree in both share their
fate), and null ids are an id like others. Empty tables give no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import WordHashes, mix64, prepare, slices, table, written

WINDOW = 35
LEVELS = 4  # rounds of runs and pairs
LONGEST_RUN = (1 << 14) - 1  # windows in a record; longer runs have several
_HASHES = WordHashes()
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


class Symbols:
    """A level of the parse of some texts laid end to end."""

    def __init__(self, name, start, end, left, right, doc):
        # left, right: the context; outside its text where a neighbour is missing.
        self.name, self.start, self.end, self.left, self.right, self.doc = name, start, end, left, right, doc

    def _around(self, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Contexts that also fix both neighbours, of symbols first..last."""
        n = len(self.name)
        before, after = np.maximum(first - 1, 0), np.minimum(last + 1, n - 1)
        left = np.where((first > 0) & (self.doc[before] == self.doc[first]), self.left[before], self.start[first] - 1)
        right = np.where((last < n - 1) & (self.doc[after] == self.doc[last]), self.right[after], self.end[last] + 1)
        return np.minimum(left, self.left[first]), np.maximum(right, self.right[last]), before

    def runs(self, level: int) -> Symbols:
        new = np.ones(len(self.name), dtype=bool)
        new[1:] = (self.name[1:] != self.name[:-1]) | (self.doc[1:] != self.doc[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(new)) - 1
        n = (last - first + 1).astype(np.uint64)
        name = self.name[first]
        many = n > 1
        name = np.where(many, mix64(name * _U(3) + n * _U(_BASE) + _U(2 * level)), name)
        left, right, _ = self._around(first, last)
        return Symbols(name, self.start[first], self.end[last], left, right, self.doc[first])

    def pairs(self, level: int) -> Symbols:
        coin = (mix64(self.name + _U(level)) >> _U(40) & _U(1)).astype(bool)  # False: left, True: right
        n = len(coin)
        joined = np.zeros(n, dtype=bool)  # with the next
        joined[:-1] = ~coin[:-1] & coin[1:] & (self.doc[1:] == self.doc[:-1])
        tail = np.zeros(n, dtype=bool)
        tail[1:] = joined[:-1]
        first = np.flatnonzero(~tail)
        merged = joined[first]
        last = first + merged
        name = np.where(merged, mix64(self.name[first] * _U(5) + self.name[last] * _U(_BASE) + _U(2 * level + 1)), self.name[first])
        left, right, _ = self._around(first, last)
        # A pair fixes itself; a left symbol alone depends on its right neighbour, a right one on its left.
        left = np.where(merged | ~coin[first], self.left[first], left)
        right = np.where(merged | coin[first], self.right[last], right)
        return Symbols(name, self.start[first], self.end[last], left, right, self.doc[first])


def _best(level: Symbols, at: np.ndarray, n_words: int) -> np.ndarray:
    """Per window start in ``at``, the largest key of the symbols it fixes (0: none)."""
    key = (np.minimum(level.end - level.start, 63).astype(np.uint64) << _U(58)) | (level.name >> _U(6)) | _U(1)
    # Contexts start and end in the symbols' order, so counts tell the first and last symbol of a window.
    lo = np.cumsum(np.bincount(level.left + 1, minlength=n_words + 2))[at]
    hi = np.cumsum(np.bincount(level.right, minlength=n_words + 2))[np.minimum(at + WINDOW, n_words + 1)]
    out = np.zeros(len(at), dtype=np.uint64)
    span, size = hi - lo, 1
    while True:
        use = (span >= size) & (span < 2 * size)
        if use.any():
            out[use] = np.maximum(key[lo[use]], key[hi[use] - size])
        if not (span >= 2 * size).any():
            return out
        key = np.maximum(key, np.concatenate([key[size:], key[len(key) - min(size, len(key)) :]])[: len(key)]) if size < len(key) else key
        size *= 2


class Parsed:
    """The words of a few texts with their windows' anchors and hashes."""

    def __init__(self, texts: list[str | None], anchors: bool = True):
        self.words = [words_of(t) for t in texts]
        size = np.array([len(w) for w in self.words], dtype=np.int64)
        self.begin = np.cumsum(size) - size
        n = int(size.sum())
        doc = np.repeat(np.arange(len(texts)), size)
        h = _HASHES.of(list(chain.from_iterable(self.words)))
        # Window starts, and hashes of stretches from a prefix sum of word * BASE^place.
        inside = np.maximum(size - WINDOW + 1, 0)
        self.at = np.repeat(self.begin, inside) + (np.arange(int(inside.sum())) - np.repeat(np.cumsum(inside) - inside, inside))
        power = np.cumprod(np.full(n + 1, _U(_BASE), dtype=np.uint64))
        self.back = np.cumprod(np.full(n + 1, _U(_INVERSE), dtype=np.uint64))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(h) * power[:n])])
        self.doc = doc[self.at] if len(self.at) else np.zeros(0, np.int64)
        if not anchors or not len(self.at):
            self.key = np.zeros(len(self.at), dtype=np.uint64)
            return
        place = np.arange(n)
        level = Symbols(h, place, place + 1, place, place + 1, doc)
        levels = [level]
        for k in range(1, LEVELS + 1):
            levels.append(levels[-1].runs(k).pairs(k))
        self.key = _best(levels.pop(), self.at, n)
        while levels:  # a key starts with its symbol's length: only windows without a longer one look further down
            level = levels.pop()
            longest = min(int((level.end - level.start).max()), 63)
            open_ = np.flatnonzero(self.key >> _U(58) <= _U(longest))
            if len(open_):
                self.key[open_] = np.maximum(self.key[open_], _best(level, self.at[open_], n))

    def stretch(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[first]) * self.back[first])

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first window, windows, whether windows of the run repeat in it)."""
        if not len(self.at):
            return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, bool),)
        new = np.ones(len(self.at), dtype=bool)
        new[1:] = (self.key[1:] != self.key[:-1]) | (self.doc[1:] != self.doc[:-1])
        first = np.flatnonzero(new)
        n = np.diff(np.append(first, len(new)))
        if (n > LONGEST_RUN).any():  # cut; the parts share their anchor, so none is lost
            cut = np.concatenate([np.arange(a, a + k, LONGEST_RUN) for a, k in zip(first, n, strict=True)])
            first, n = cut, np.diff(np.append(cut, len(new)))
        run = np.repeat(np.arange(len(first)), n)
        seen = mix64(self.stretch(self.at, self.at + WINDOW) + mix64(run.astype(np.uint64)))
        order = np.sort(seen)
        again = np.zeros(len(first), dtype=bool)
        twice = order[1:][order[1:] == order[:-1]]
        if len(twice):
            again[run[np.isin(seen, twice)]] = True
        return first, n, again


def _names(doc_id: pa.Array, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Row names and tags: 64 bits of the id (null is one of its own) and the
    text, and 18 other bits of the text. Only rows that agree in both id and
    text share a name and a tag; such rows lose the same words."""
    import xxhash

    both = np.frombuffer(b"".join(xxhash.xxh3_128_digest(t or "") for t in texts), dtype="<u8").reshape(len(texts), 2)
    ids = doc_id.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64)
    null = doc_id.is_null().to_numpy(zero_copy_only=False).astype(np.uint64)
    name = mix64(both[:, 0] + mix64(ids) * (np.uint64(1) - null) + null * np.uint64(0x5851F42D4C957F2D))
    return name.view(np.int64), (both[:, 1] >> np.uint64(46)).astype(np.int64)


_LOW18, _LOW14 = (1 << 18) - 1, (1 << 14) - 1


# What a record says: its windows repeat; it is to be opened; its batch can't
# tell (ask); it is only there for others (witness).
SURE, OPEN, ASK, WITNESS = 1, 2, 4, 8
_ROW = "anchor long, words long, says int, name long, place long"


def _batch(anchor, words, says, name: pa.Array, place) -> pa.RecordBatch:
    i64 = lambda x: pa.array(np.ascontiguousarray(x).view(np.int64))
    return pa.RecordBatch.from_arrays([i64(anchor), i64(words), pa.array(says.astype(np.int32)), name, i64(place)], names=["anchor", "words", "says", "name", "place"])


def _classes(anchor: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted by (anchor, words): the order, and for each sorted row its class,
    whether it is the class's first, the class's size, its anchor's classes."""
    order = np.lexsort((words, anchor))
    a, w = anchor[order], words[order]
    new_anchor, first = np.ones(len(a), bool), np.ones(len(a), bool)
    new_anchor[1:] = a[1:] != a[:-1]
    first[1:] = new_anchor[1:] | (w[1:] != w[:-1])
    cls, group = np.cumsum(first) - 1, np.cumsum(new_anchor) - 1
    size = np.bincount(cls)[cls] if len(a) else cls
    return order, group, first, size, (np.bincount(group, first)[group] if len(a) else group)


def _within(anchor, words, again, name: pa.Array, place, seed: int, windows: bool) -> Iterator[pa.RecordBatch]:
    """What one batch's records say, before they meet those of other tasks."""
    order, group, first, size, several = _classes(anchor, words)
    a, w, again, place = anchor[order], words[order], again[order], place[order]
    mixed = (several > 1) & (not windows)
    says = np.where(size > 1, SURE, 0)
    ask = first & ~mixed & ~again
    says = np.where(ask, says | ASK, says)
    says = np.where(first & (mixed | again), says | OPEN, says)
    # Told records go anywhere, with the anchor in the place of the words.
    told = ~ask
    deal = mix64(np.arange(len(a), dtype=np.uint64) + np.uint64(seed * 1_000_003 % (1 << 63)))
    yield _batch(np.where(told, deal, a.view(np.uint64)), np.where(told, a, w), says, name.take(pa.array(order)), place)
    if not windows:  # others learn of this anchor from its first and last class
        number = np.cumsum(first) - 1
        lo = np.minimum.reduceat(number, np.flatnonzero(np.append(True, group[1:] != group[:-1])))[group] if len(a) else number
        see = first & (mixed | again) & ((number == lo) | (number == lo + several - 1))
        yield _batch(a[see], w[see], np.full(int(see.sum()), WITNESS), name.take(pa.array(order[see])), place[see])


def _meet(rows: DataFrame, windows: bool) -> DataFrame:
    """The records that say SURE or OPEN once all of an anchor have met."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the records of the last anchor so far

        def out(t: pa.Table) -> pa.RecordBatch:
            t = t.combine_chunks()
            anchor, words, says, place = (t.column(k).to_numpy().copy() for k in ("anchor", "words", "says", "place"))
            asks, sees = says & ASK > 0, says & WITNESS > 0
            n = asks | sees
            at = np.flatnonzero(n)
            order, _, first, size, several = _classes(anchor[at], words[at])
            at = at[order]
            # The first asking record of a class is its opened one.
            got = np.where(size > 1, SURE, 0)
            if not windows:
                cls = np.cumsum(first) - 1
                rank = np.where(asks[at], np.arange(len(at)), len(at))
                lead = np.minimum.reduceat(rank, np.flatnonzero(first))[cls] == np.arange(len(at)) if len(at) else first
                got |= np.where(lead & (several > 1), OPEN, 0)
            says[at] |= got
            says[sees] = 0
            anchor = np.where(asks, anchor, words)  # told records carry it there
            keep = np.flatnonzero(says & (SURE | OPEN))
            return _batch(anchor[keep], words[keep], says[keep] & (SURE | OPEN), t.column("name").combine_chunks().take(pa.array(keep)), place[keep])

        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            a = b.column("anchor").to_numpy()
            if a[0] == a[-1]:
                continue
            cut = int(np.searchsorted(a, a[-1]))
            yield out(pa.Table.from_batches([*held[:-1], b.slice(0, cut)]))
            held = [b.slice(cut)]
        if held:
            yield out(pa.Table.from_batches(held))

    return rows.repartition("anchor").sortWithinPartitions("anchor", "words").mapInArrow(judge, _ROW)


def anchors(docs: DataFrame) -> DataFrame:
    """A record for each run of windows. ``place`` packs its first word (32
    bits), its windows (14) and the text's tag (18)."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, whole in enumerate(batches):
            cols: list[list] = [[] for _ in range(5)]
            for b in slices([whole]):
                texts = b.column("text").to_pylist()
                p = Parsed(texts)
                first, n, again = p.runs()
                doc, at = p.doc[first], p.at[first]
                names, tags = _names(b.column("doc_id"), texts)
                place = ((at - p.begin[doc]) << 32) | (n << 18) | tags[doc]
                for c, x in zip(cols, (p.key[first].view(np.int64), (p.stretch(at, at + n + WINDOW - 1) + n.astype(np.uint64)).view(np.int64), again, pa.array(names[doc]), place), strict=True):
                    c.append(x)
            if cols[0]:
                yield from _within(*map(np.concatenate, cols[:3]), pa.concat_arrays(cols[3]), np.concatenate(cols[4]), TaskContext.get().partitionId() * 1009 + k, False)

    return docs.mapInArrow(run, _ROW)


def _packed(docs: DataFrame) -> DataFrame:
    """name, tag, doc_id, z: compressed texts under their rows' names."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdCompressor(level=3)
        for b in slices(batches):
            texts = b.column("text").to_pylist()
            names, tags = _names(b.column("doc_id"), texts)
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(tags), b.column("doc_id"), pa.array([press.compress((t or "").encode()) for t in texts], pa.binary())], names=["name", "tag", "doc_id", "z"])

    return docs.mapInArrow(run, "name long, tag long, doc_id long, z binary")


_KEY = ["name", "tag"]


def _texts(col: pa.Array) -> list[str]:
    import zstandard

    press = zstandard.ZstdDecompressor()
    return [press.decompress(z).decode() for z in col.to_pylist()]


def repeats(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(packed texts, stretches): the stretches of words (first, n) of each
    text that repeated windows cover, as arrays under ``_KEY``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    packed = _packed(docs)
    place = ["name", F.col("place").bitwiseAND(F.lit(_LOW18)).alias("tag"), F.shiftright("place", 32).cast("int").alias("first"), F.shiftright("place", 18).bitwiseAND(F.lit(_LOW14)).cast("int").alias("n")]
    hits = written(_meet(anchors(docs), False).select("anchor", "says", "name", "place"), "repeat-runs")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, b in enumerate(slices(batches, 2048)):
            p = Parsed(_texts(b.column("z")), anchors=False)
            lists = b.column("runs").to_pylist()
            doc = np.repeat(np.arange(b.num_rows), [len(x) for x in lists])
            a, first, n = (np.array([r[k] for x in lists for r in x], dtype=np.int64) for k in ("anchor", "first", "n"))
            each = np.repeat(np.arange(len(n)), n)
            at = np.repeat(first, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            spot = p.begin[doc[each]] + at
            h = p.stretch(spot, spot + WINDOW).view(np.int64)
            tag = b.column("tag").to_numpy()[doc[each]]
            yield from _within(a[each], h, np.zeros(len(h), bool), b.column("name").take(pa.array(doc[each])), (at << 32) | (1 << 18) | tag, TaskContext.get().partitionId() * 1009 + k, True)

    opened = hits.where(F.col("says").bitwiseAND(F.lit(OPEN)) > 0).select("anchor", *place).groupBy(*_KEY).agg(F.collect_set(F.struct("anchor", "first", "n")).alias("runs"))
    # Rows that repeat both id and text give the same runs; each row opens them once.
    rows = packed.join(opened, _KEY).select("name", "tag", "z", "runs").mapInArrow(windows, _ROW)
    sure = F.col("says").bitwiseAND(F.lit(SURE)) > 0
    found = hits.where(sure).select(*place).unionByName(_meet(rows, True).where(sure).select(*place))
    return packed, found.groupBy(*_KEY).agg(F.collect_set(F.struct("first", "n")).alias("runs"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_text."""
    packed, stretches = repeats(docs)

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            size, gone, kept = [], [], []
            for t, runs in zip(_texts(b.column("z")), b.column("runs").to_pylist(), strict=True):
                w = words_of(t)
                edge = np.zeros(len(w) + 1, dtype=np.int64)
                if runs:
                    first, n = (np.array([r[k] for r in runs], dtype=np.int64) for k in ("first", "n"))
                    np.add.at(edge, first, 1)
                    np.add.at(edge, first + n + WINDOW - 1, -1)
                out = np.cumsum(edge)[: len(w)] > 0
                size.append(len(w))
                gone.append(int(out.sum()))
                kept.append(b" ".join(x for x, o in zip(w, out.tolist(), strict=True) if not o) if gone[-1] else b" ".join(w))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array([k.decode() for k in kept], pa.string())], names=["doc_id", "n_words", "n_removed", "kept_text"])

    return packed.join(stretches, _KEY, "left").select("doc_id", "z", "runs").mapInArrow(cover, "doc_id long, n_words long, n_removed long, kept_text string")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
