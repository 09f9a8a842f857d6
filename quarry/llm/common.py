"""Small helpers the operators of this package share."""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import scratch_path, ship_package

SPACE = r"[\x20\x09-\x0D]+"
#: Rows a task works on at once; bounds the size of its temporary arrays.
SLICE_ROWS = 256
#: Bytes of text a tokenising task works on at once.
SLICE_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write to the shared folder and read back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def prepare(spark: SparkSession) -> None:
    """Make this package importable in the Python workers."""
    ship_package(spark)


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def text_slices(batches: Iterator[pa.RecordBatch], size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows whose texts have about ``size`` bytes, or one row of more."""
    for b in batches:
        n = pc.fill_null(pc.binary_length(b.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        cuts = np.flatnonzero(np.diff((np.cumsum(n) - n) // size)) + 1
        for i, j in pairwise([0, *cuts.tolist(), b.num_rows]):
            yield b.slice(i, j - i)


def lean(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], *caches: dict):
    """``work`` as a task that gives its memory back when it ends: a reused
    worker would keep the ``caches`` and what the allocators hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            give_back(*caches)

    return run


def give_back(*caches: dict) -> None:
    import ctypes
    import gc

    for c in caches:
        c.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def fold(column: str, parts: int) -> Column:
    """crc32 of an id written as text, modulo ``parts`` (null ids count as '')."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % parts


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores before it until no column is called so."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while any(c.startswith(n.lower()) for c in taken):
            n = f"_{n}"
        out.append(n)
    return out


def row_key(column: str = "doc_id") -> Column:
    """An id as a join key under which null equals null."""
    return F.coalesce(F.col(column).cast("string"), F.lit("null"))


def crc32_u32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit finaliser (multiply and shift rounds) over an array."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


class WordHashes(dict):
    """64-bit hashes of words (bytes), remembered up to a bound."""

    LIMIT = 300_000

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.LIMIT:
            self.clear()
        v = self[word] = xxhash.xxh64_intdigest(word)
        return v

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def _edge_ok(c: str) -> bool:
    return not c.isspace() and unicodedata.category(c)[0] not in "MCZ"


#: A word of Latin letters (without the capital i with a dot, which becomes two
#: characters in lower case) and the ASCII punctuation after it (without the
#: apostrophe of contractions): pre-tokens of their own in both vocabularies.
_WORD_AND_TAIL = "^(?P<word>[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+)(?P<tail>[!-&(-/:-@\\[-`{-~]*)$"
#: Words encoded in one text, and texts in one call.
JOINED, CALL = 400, 16


class Encoder:
    """Token ids of whole texts, exactly as ``tokenizer.encode`` gives them.

    Both vocabularies split a text into pre-tokens before any merge, and no
    pre-token spans a single space between two visible characters. So a slice
    of rows is cut at its spaces, its pieces are dictionary-encoded by Arrow,
    each different piece is encoded once (words apart from the punctuation
    after them, many to a text) and the rows' ids are taken from that table.
    A text in which some space isn't of that kind (double spaces, other white
    space, combining marks or controls beside it) is encoded whole. Nothing is
    remembered from slice to slice, so the memory is that of a slice
    (``text_slices``).
    """

    def __init__(self, spec: str, lead: str):
        from tokenizers import Tokenizer

        self.tok, self.lead = Tokenizer.from_str(spec), lead
        # A word's first token (with a leading space) or last one is known by its spelling.
        vocab = self.tok.get_vocab()
        self.edge = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.edge[[i for t, i in vocab.items() if (t.startswith("\u0120") if lead else t.endswith("</w>"))]] = True
        # Where these trials come apart wrongly, each word is encoded on its own.
        trial = ["the", "Tion", "\u00c9l\u00e8ve", "UNGE\u00dc\u00df", "\u00f1asquera", "a"]
        self.direct = True
        ids, sizes = self._words(pa.array(trial))
        self.direct = [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == self._raw([lead + w for w in trial])

    def _raw(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def _each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids end to end, and their number for each text."""
        got = self._raw(texts)
        return np.array([i for x in got for i in x], dtype=np.uint32), np.array([len(x) for x in got], dtype=np.int64)

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of letters, cut apart at the tokens of their edges."""
        out = [(np.zeros(0, np.uint32), np.zeros(0, np.int64))]
        for i in range(0, len(words), JOINED * CALL):
            some = words.slice(i, JOINED * CALL)
            cuts = pa.array(np.append(np.arange(0, len(some), JOINED), len(some)), pa.int32())
            texts = pc.binary_join(pa.ListArray.from_arrays(cuts, some), " ").to_pylist()
            ids, _ = self._each([self.lead + t for t in texts])
            at = np.flatnonzero(self.edge[ids])
            sizes = np.diff(at, append=len(ids)) if self.lead else np.diff(at, prepend=-1)
            if not self.direct or len(sizes) != len(some) or sizes.sum() != len(ids):
                ids, sizes = self._each([self.lead + w for w in some.to_pylist()])
            out.append((ids, sizes))
        return tuple(map(np.concatenate, zip(*out, strict=True)))

    def _pieces(self, names: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of different pieces end to end, their number for each piece, and
        which pieces can't be cut off safely (these have none)."""
        split = pc.extract_regex(names, _WORD_AND_TAIL)
        is_word = split.is_valid().to_numpy(zero_copy_only=False)
        split = split.filter(pa.array(is_word))
        words, tails = (split.field(k).dictionary_encode() for k in ("word", "tail"))
        rest = np.flatnonzero(~is_word)
        others = names.take(pa.array(rest)).to_pylist()
        safe = np.array([bool(p) and _edge_ok(p[0]) and _edge_ok(p[-1]) for p in others], dtype=bool)
        tables = [self._words(words.dictionary), self._each(tails.dictionary.to_pylist()), self._each([self.lead + p for p, ok in zip(others, safe, strict=True) if ok])]
        n_words, n_tails, empty = len(tables[0][1]), len(tables[1][1]), sum(len(t[1]) for t in tables)
        tables.append((np.zeros(0, np.uint32), np.zeros(1, np.int64)))
        ids, sizes = map(np.concatenate, zip(*tables, strict=True))
        pair = np.full((len(names), 2), empty, dtype=np.int64)
        pair[is_word] = np.stack([words.indices.to_numpy(), n_words + tails.indices.to_numpy().astype(np.int64)], axis=1)
        pair[rest[safe], 0] = n_words + n_tails + np.arange(safe.sum())
        unsafe = np.zeros(len(names), dtype=bool)
        unsafe[rest[~safe]] = True
        return _taken(ids, sizes, pair.ravel()), sizes[pair].sum(1), unsafe

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        if not len(texts):
            return []
        texts = pc.fill_null(texts.cast(pa.string()), "")
        parts = pc.split_pattern(texts, " ")
        first = parts.offsets.to_numpy()[:-1]
        coded = parts.flatten().dictionary_encode()
        place, names = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        ids, sizes, unsafe = self._pieces(names)
        whole = np.add.reduceat(unsafe[place], first, dtype=np.int64) > 0
        if self.lead:  # a text's first piece has no space before it
            own = self._each(names.take(pa.array(place[first])).to_pylist())
            place[first] = len(sizes) + np.arange(len(texts))
            ids, sizes = np.concatenate([ids, own[0]]), np.concatenate([sizes, own[1]])
        out = np.split(_taken(ids, sizes, place), np.cumsum(np.add.reduceat(sizes[place], first))[:-1])
        for i in np.flatnonzero(whole):
            out[i] = np.asarray(self._raw([texts[int(i)].as_py()])[0], dtype=np.uint32)
        return out


def _taken(flat: np.ndarray, sizes: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` (of ``sizes``) at ``places``, end to end."""
    lists = pa.LargeListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int64()), pa.array(flat))
    return lists.take(pa.array(places)).flatten().to_numpy()


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(spec: str, lead: str) -> Encoder:
    """This worker's encoder for a tokenizer file's content."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    key = (hash(spec), lead)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(spec, lead)
    return _ENCODERS[key]


def tokenizer_spec(spark: SparkSession, path: str):
    """A tokenizer file's content (a few MB, fixed) for all tasks."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())
