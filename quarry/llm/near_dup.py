"""MinHash near-dedup with fast similarity sketching.

A document's set is its distinct word shingles (five words unless told
otherwise; ASCII lower case; fewer words: the whole sequence as one; no words:
empty). Fast similarity sketching
(Dahlgaard, Knudsen, Thorup) fills ``BANDS`` times some rows of coordinates: round i
hashes every element to one bin with a value from [i, i + 1), a bin keeps its
least value, and after as many rounds as there are bins each further round
puts all elements into one bin, so that every coordinate fills. Rows of
coordinates form bands, as many rows as leave two sets of just the similarity
asked for a chance below ``MISSED`` to share none; links found are confirmed
on the full sets.

1. Rows with equal sets are one class (its node: the smallest doc_id).
2. Classes that share a band's value share a bucket. In each round every
   bucket checks its members against a centre, through a join, never in one
   task; verified links join components, and only members of other components
   than their centre's are tried again. After ``ROUNDS`` of them, what lies
   outside a bucket's largest component meets the whole bucket in blocks of
   bounded size, one task each: an inverted index of the block's shingles
   gives all its intersections at once, and a block returns one link at most
   for a document and a component, so no list of pairs is ever made. Pairs
   inside a component need no check: the result is the components, and no link
   between two of them stays untested.

Rows without words are linked with nothing. Rows with a null id take no part
in links: component_id is null and they stay (kept). Rows that share an id
count as one document: what links to one links to all, and a repeated row
is kept like its twin (``deduplicated`` then leaves one row for each text of
the id, and for each text without an id). Empty tables give no
rows; other columns are ignored by the links and kept by ``deduplicated``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import WordHashes, lean, mix64, prepare, slices, table, written
from quarry.llm.exact_dedup import keep_rows
from quarry.llm.graph import components

SHINGLE = 5
PERCENT = 80
BANDS, MISSED = 28, 1e-6
ROUNDS = 2
REST_SHINGLES, ALL_SHINGLES = 500_000, 2_000_000  # of a block's two sides
_HASHES = WordHashes()
_ONE, _PART = np.uint64(1), np.uint64(40)


def words_of(text: str | None) -> list[bytes]:
    """ASCII white space splits, ASCII capitals become small."""
    return (text or "").encode().lower().split()


def rows_of(percent: int) -> int:
    """The most rows a band can have at this similarity."""
    return max(r for r in range(1, 33) if r == 1 or (1 - (percent / 100) ** r) ** BANDS <= MISSED)


def shingle_hashes(words: list[bytes], shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes."""
    h = _HASHES.of(words)
    if not len(h):
        return h
    n = min(shingle, len(h))
    out = np.full(len(h) - n + 1, n, dtype=np.uint64)
    for k in range(n):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - n + 1 + k])
    return np.unique(out)


def sketch(e: np.ndarray, bins: int) -> np.ndarray:
    """Fast similarity sketch of a non-empty set of hashes."""
    out = np.full(bins, np.iinfo(np.uint64).max, dtype=np.uint64)
    step = max(1, min(bins, -(-6 * bins // len(e))))
    for i in range(0, bins, step):  # some rounds at once: a smaller round's values are smaller anyway
        r = np.arange(i, min(bins, i + step), dtype=np.uint64)[:, None]
        x = mix64(e[None, :] + (r + _ONE) * np.uint64(0xA24BAED4963EE407))
        np.minimum.at(out, (x % np.uint64(bins)).ravel().astype(np.int64), ((r << _PART) | (mix64(x) >> np.uint64(24))).ravel())
        if out.max() < np.iinfo(np.uint64).max:
            return out
    for b in np.flatnonzero(out == np.iinfo(np.uint64).max):  # rounds of one bin each
        r = np.array([bins + b], dtype=np.uint64)
        out[b] = ((r << _PART) | (mix64(mix64(e + (r + _ONE) * np.uint64(0xA24BAED4963EE407))) >> np.uint64(24)).min())[0]
    return out


def bands_of(s: np.ndarray) -> np.ndarray:
    h = np.arange(1, BANDS + 1, dtype=np.uint64)
    for col in s.reshape(BANDS, -1).T:
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + col)
    return h.view(np.int64)


def similar(a: list[bytes], b: list[bytes], shingle: int, percent: int) -> bool:
    """On the full sets, by the words themselves."""
    x, y = _shingles(a, shingle), _shingles(b, shingle)
    both = len(x & y)
    return bool(x and y) and 100 * both >= percent * (len(x) + len(y) - both)


def sketched(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """doc_id, n, sig (128 bits of the set; null if empty), bands."""
    coordinates = rows_of(percent) * BANDS
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in slices(batches):
            n, sig, bands = [], [], []
            for t in b.column("text").to_pylist():
                e = shingle_hashes(words_of(t), shingle)
                n.append(len(e))
                sig.append(xxhash.xxh3_128_digest(e.tobytes()) if len(e) else None)
                bands.append(bands_of(sketch(e, coordinates)) if len(e) else None)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(sig, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "n", "sig", "bands"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lean(run, _HASHES), "doc_id long, n long, sig binary, bands array<long>")


def _packed(docs: DataFrame) -> DataFrame:
    """(doc_id, z): texts compressed for the joins."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdCompressor(level=3)
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([press.compress((t or "").encode().lower()) for t in b.column("text").to_pylist()], pa.binary())], names=["doc_id", "z"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null").mapInArrow(lean(run), "doc_id long, z binary")


def _verified(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press, last = zstandard.ZstdDecompressor(), (None, None)
        for b in slices(batches):
            ok = []
            for x, y in zip(b.column("za").to_pylist(), b.column("zb").to_pylist(), strict=True):
                if y != last[0]:
                    last = (y, press.decompress(y).split())
                ok.append(similar(press.decompress(x).split(), last[1], shingle, percent))
            keep = b.filter(pa.array(ok, pa.bool_()))
            yield pa.RecordBatch.from_arrays([keep.column("a"), keep.column("b")], names=["a", "b"])

    both = pairs.join(texts.toDF("a", "za"), "a").join(texts.toDF("b", "zb"), "b")
    return both.select("a", "b", "za", "zb").mapInArrow(lean(run), "a long, b long")


def _shingles(w: list[bytes], shingle: int) -> set:
    return set(zip(*(w[k:] for k in range(shingle)), strict=False)) if len(w) >= shingle else {tuple(w)} if w else set()


def _blocked(now: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links (a, b) between components that still share a bucket."""
    per = now.groupBy("bucket", "c").agg(F.count("*").alias("m"), F.sum("n").alias("n"))
    main = per.groupBy("bucket").agg(F.max_by("c", "m").alias("main"), F.count("*").alias("parts"), F.sum("n").alias("all_n"), (F.sum("n") - F.max_by("n", "m")).alias("rest_n")).where("parts > 1")
    main = main.select("bucket", "main", F.ceil(F.col("rest_n") / REST_SHINGLES).cast("int").alias("ni"), F.ceil(F.col("all_n") / ALL_SHINGLES).cast("int").alias("nj"))
    rows = now.join(main, "bucket")
    block = lambda n, salt: F.pmod(F.xxhash64("node", F.lit(salt)), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    rest = rows.where("c <> main").select("bucket", block(F.col("ni"), 1).alias("i"), every("nj").alias("j"), "node", "c", F.lit(0).alias("side"))
    whole = rows.select("bucket", every("ni").alias("i"), block(F.col("nj"), 2).alias("j"), "node", "c", F.lit(1).alias("side"))

    def compare(t: pa.Table) -> pa.Table:
        import zstandard

        press, where, mine, links = zstandard.ZstdDecompressor(), {}, [], {}
        node, c, side, z = (t.column(k).to_pylist() for k in ("node", "c", "side", "z"))
        for k in (k for k in range(len(side)) if side[k] == 0):
            x = _shingles(press.decompress(z[k]).split(), shingle)
            for g in x:
                where.setdefault(g, []).append(len(mine))
            mine.append((node[k], c[k], len(x)))
        where = {g: np.array(at) for g, at in where.items()}
        size, part = np.array([m[2] for m in mine]), np.array([m[1] for m in mine])
        for k in (k for k in range(len(side)) if side[k] == 1 and mine):
            y = _shingles(press.decompress(z[k]).split(), shingle)
            hits = [where[g] for g in y if g in where]
            if hits:
                both = np.bincount(np.concatenate(hits), minlength=len(mine))
                for m in np.flatnonzero((100 * both >= percent * (size + len(y) - both)) & (part != c[k])):
                    links.setdefault((mine[m][0], c[k]), node[k])
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([*links.values()], pa.int64())})

    joined = rest.unionByName(whole).join(texts.toDF("node", "z"), "node").select("bucket", "i", "j", "node", "c", "side", "z")
    # The work of a block grows faster than its bytes: a stated number of partitions, so that adaptive execution doesn't put all blocks into one.
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return joined.repartition(parts, "bucket", "i", "j").groupBy("bucket", "i", "j").applyInArrow(compare, "a long, b long")


def near_components(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(sketches, components): a row per document; node and component per linked class."""
    rows = written(sketched(docs, shingle, percent), "sketches")
    classes = rows.where("sig is not null and doc_id is not null").groupBy("sig").agg(F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    classes = written(classes, "near-classes")
    member = classes.select("node", "n", F.explode("bands").alias("bucket"))
    shared = member.groupBy("bucket").agg(F.min("node").alias("x"), F.max("node").alias("y")).where("x <> y").select("bucket")
    member = written(member.join(shared, "bucket", "left_semi"), "near-buckets")
    # Links are stated between nodes; a class with the same smallest id as another is that node too.
    texts = written(_packed(docs).join(member.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi"), "near-texts")
    fits = f"least(an, bn) * 100 >= greatest(an, bn) * {percent}"
    # The texts of one id are one document: each of its classes is linked to the smallest.
    own = rows.where("sig is not null and doc_id is not null").select("doc_id", "sig").distinct().join(classes.select("sig", "node"), "sig").select("doc_id", "node")
    least = own.groupBy("doc_id").agg(F.min("node").alias("b"), F.max("node").alias("y")).where("b <> y").select("doc_id", "b")
    edges = written(own.join(least, "doc_id").where("node <> b").select(F.col("node").alias("a"), "b").distinct(), "near-ids")
    parts, tested = None, None
    for k in range(ROUNDS + 1):
        now = member.withColumn("c", F.col("node")) if parts is None else member.join(parts, "node", "left").withColumn("c", F.coalesce("component", "node")).drop("component")
        live = now.groupBy("bucket").agg(F.min("c").alias("x"), F.max("c").alias("y"), F.min_by(F.struct("node", "n", "c"), F.xxhash64("node", F.lit(k), F.pmod("bucket", F.lit(2)))).alias("t")).where("x <> y")
        a = now.select("bucket", F.col("node").alias("a"), F.col("n").alias("an"), F.col("c").alias("ac"))
        if k == ROUNDS:
            found = written(_blocked(now, texts, shingle, percent), "near-links")
            edges = edges.unionByName(found)
            break
        b = live.select("bucket", F.col("t.node").alias("b"), F.col("t.n").alias("bn"), F.col("t.c").alias("bc"))
        pairs = a.join(b, "bucket").where("ac <> bc").where(fits).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = written(pairs, "near-pairs")
        found = written(_verified(pairs, texts, shingle, percent), "near-links")
        tested = pairs if tested is None else tested.unionByName(pairs)
        edges = edges.unionByName(found)
        if not found.isEmpty():
            parts = components(edges)
    return rows, components(edges) if parts is None or not found.isEmpty() else parts


def near_groups(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept."""
    rows, parts = near_components(docs, shingle, percent)
    # A class's rows share its node; the component is named by its smallest id.
    classes = rows.where("sig is not null and doc_id is not null").groupBy("sig").agg(F.min("doc_id").alias("node"))
    named = classes.join(parts, "node", "left").select("sig", F.coalesce("component", "node").alias("component"))
    by_id = rows.where("doc_id is not null").select("doc_id", "sig").join(named, "sig", "left").groupBy("doc_id").agg(F.min("component").alias("component"))
    out = rows.select("doc_id", "n").join(by_id, "doc_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), (F.col("doc_id").isNull() | (component == F.col("doc_id"))).alias("kept"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """One document of each group stays, with each of its different texts."""
    return keep_rows(docs, near_groups(docs).where("kept").select("doc_id"), F.coalesce("text", F.lit("")))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"), 3, 85)
