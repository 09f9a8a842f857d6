"""Hard-negative mining over Hilbert-ordered blocks with zone maps.

Vectors become integers (``floor(scale * x)``), are ordered along a Hilbert
curve through all dimensions and written as Parquet in blocks of ``BLOCK``
rows, ``BLOCKS`` of them to a strip. Each block has a zone map: the least and
greatest component of every dimension, the least id, the range of its labels.
Interval arithmetic on a zone map bounds the scores that an anchor can reach
in the block. A block is read for an anchor's positives only if its bound
reaches the ones known from the anchor's own block, and for its negatives only
if its score range meets one of the anchor's windows; all else is never
scored, and what is read is scored exactly, so no row is lost.

Both meetings (anchors with zone maps, anchors with rows) are streams: a task
holds one chunk of zone maps or one strip of rows, of bounded size, and the
anchors pass by in batches. Equal vectors, however many, are cut into blocks
by id. Rows with a null label, a null vector or a null or non-finite component
take no part. Shorter vectors count as padded with zeros. Repeated rows are
rows of their own and candidates of each other; a null id comes after all
others and is no anchor unless ``anchors`` says so. Without rows or anchors
the result is empty. Other columns are ignored. Scores must be below 2^63 in
size, else the job fails with an error.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.common import prepare, table, written

#: Rows of a block and blocks of a strip: a task holds BLOCK * BLOCKS rows.
BLOCK, BLOCKS = 512, 16
#: Zone maps of a chunk, about; anchors that meet one strip in one task, about.
ZONES, ANCHORS = 1024, 100_000
#: Anchors scored at once.
BATCH = 128
#: Bits of a dimension on the curve and bytes of a curve key that are kept.
BITS, KEY_BYTES = 4, 64
_LAST = np.iinfo(np.int64).max


def hilbert_keys(x: np.ndarray, bits: int) -> np.ndarray:
    """Positions of integer points (rows of ``x``, each below 2^bits) on the
    Hilbert curve, as rows of bytes in ascending order of the curve."""
    x = x.astype(np.int64, copy=True)
    dims = x.shape[1]
    for bit in range(bits - 1, 0, -1):  # undo the turns of the sub-cubes
        low = (1 << bit) - 1
        for i in range(dims):
            up = (x[:, i] >> bit & 1).astype(bool)
            swap = np.where(up, 0, (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(up, low, swap)
            x[:, i] ^= swap
    x = np.bitwise_xor.accumulate(x, axis=1)  # Gray code over the dimensions
    turn = np.zeros(len(x), dtype=np.int64)
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(x[:, -1] >> bit & 1, (1 << bit) - 1, 0)
    x ^= turn[:, None]
    planes = x[:, None, :] >> np.arange(bits - 1, -1, -1)[None, :, None] & 1
    return np.packbits(planes.reshape(len(x), bits * dims).astype(np.uint8), axis=1)


def _matrix(column: pa.Array, dims: int, dtype: str) -> np.ndarray:
    """Binary rows as a matrix in the arithmetic that is exact for ``dtype``."""
    if not len(column):
        return np.zeros((0, dims))
    raw = np.frombuffer(b"".join(column.to_pylist()), dtype=dtype).reshape(len(column), dims)
    return raw.astype(np.int64 if dtype == "<i8" else np.float64)


def _ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(_LAST).to_numpy(zero_copy_only=False)


def _best(scores: np.ndarray, ok: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each row with any, the columns of its ``k`` highest scores among
    ``ok``, highest first, of equal ones the leftmost first."""
    least = np.iinfo(np.int64).min if scores.dtype == np.int64 else -np.inf
    held = np.where(ok, scores, least)
    bar = np.partition(held, -k, axis=1)[:, -k] if held.shape[1] > k else np.full(len(held), least)
    for i in np.flatnonzero(ok.any(axis=1)):
        at = np.flatnonzero(ok[i] & (held[i] >= bar[i]))
        yield i, at[np.argsort(-held[i, at], kind="stable")[:k]]


def _binary(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


_BLOCKS = "strip long, block long, slot int, vec_id long, label long, anchor boolean, data binary, tau long, tau_id long, lo binary, hi binary, label_hi long"


def _blocks(rows: DataFrame, scale: int, k: int) -> tuple[DataFrame, int, str] | None:
    """The written table of blocks (its zone maps are rows of slot -1), the
    number of dimensions and the type of the components."""
    flat = F.col("vector")
    sizes = rows.agg(F.max(F.size(flat)), F.min(F.array_min(flat)), F.max(F.array_max(flat))).first()
    if sizes[0] is None:
        return None
    dims = max(1, sizes[0])
    low, high = (int(np.floor(scale * float(v or 0))) for v in sizes[1:])
    low, high = min(low, 0), max(high, 0)
    top = max(-low, high)
    if top * top * dims >= 1 << 63:
        raise ArithmeticError("scores of these vectors don't fit in 63 bits")
    dtype = "<i2" if top < 1 << 15 and top * top * dims < 1 << 53 else "<i4" if top < 1 << 31 and top * top * dims < 1 << 53 else "<i8"

    def quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column(3)
            n = np.diff(v.offsets.to_numpy())
            q = np.zeros((b.num_rows, dims), dtype=np.int64)
            q[np.arange(dims)[None, :] < n[:, None]] = np.floor(scale * v.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            cell = np.minimum(((q - low).astype(np.float64) / (high - low + 1) * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)
            yield pa.RecordBatch.from_arrays([_binary(hilbert_keys(cell, BITS)[:, :KEY_BYTES]), *b.columns[:3], _binary(q.astype(dtype))], names=["key", "vec_id", "label", "anchor", "data"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, held, number = TaskContext.get().partitionId(), [], 0
        for b in itertools.chain(batches, [None]):
            held += [b] if b is not None and b.num_rows else []
            while held and (sum(x.num_rows for x in held) >= BLOCK or b is None):
                rows = pa.Table.from_batches(held).combine_chunks()
                held = rows.slice(BLOCK).to_batches()
                yield block(rows.slice(0, BLOCK).combine_chunks().to_batches()[0], (part << 32) + number)
                number += 1

    def block(b: pa.RecordBatch, number: int) -> pa.RecordBatch:
        """A block's rows, then its zone map."""
        n = b.num_rows
        by_id = np.argsort(_ids(b.column(1)), kind="stable")
        b = b.take(pa.array(by_id))
        ids, label, anchor = _ids(b.column(1)), b.column(2).to_numpy(), b.column(3).to_numpy(zero_copy_only=False)
        m = _matrix(b.column(4), dims, dtype)
        tau: list = [None] * (n + 1)
        tau_id: list = [None] * (n + 1)
        for at in np.array_split(np.flatnonzero(anchor), -(-int(anchor.sum()) // BATCH) or 1):
            s = m[at] @ m.T
            ok = label[at][:, None] == label[None, :]
            ok[np.arange(len(at)), at] = False
            for i, best in _best(s, ok, k):
                if len(best) == k:  # the k-th positive found here: no worse row can be one
                    tau[at[i]], tau_id[at[i]] = int(s[i, best[-1]]), int(ids[best[-1]])
        lo, hi = m.min(axis=0).astype(dtype).tobytes(), m.max(axis=0).astype(dtype).tobytes()
        none = [None] * n
        cols = {
            "strip": [number >> 32 << 32 | (number & 0xFFFFFFFF) // BLOCKS] * (n + 1),
            "block": [number] * (n + 1),
            "slot": [*range(n), -1],
            "vec_id": [*b.column(1).to_pylist(), int(ids.min())],
            "label": [*label.tolist(), int(label.min())],
            "anchor": [*anchor.tolist(), False],
            "data": [*b.column(4).to_pylist(), None],
            "tau": tau,
            "tau_id": tau_id,
            "lo": [*none, lo],
            "hi": [*none, hi],
            "label_hi": [*none, int(label.max())],
        }
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols.values(), kinds, strict=True)], names=list(cols))

    keyed = rows.select("vec_id", "label", "anchor", "vector").mapInArrow(quantise, "key binary, vec_id long, label long, anchor boolean, data binary")
    ordered = keyed.repartitionByRange("key", "vec_id").sortWithinPartitions("key", "vec_id")
    return written(ordered.mapInArrow(cut, _BLOCKS), "hilbert-blocks"), dims, dtype


def _meet(held: DataFrame, asked: DataFrame, keys: list[str], answer: Callable, schema: str) -> DataFrame:
    """``answer(held rows, batch of asked rows)`` for rows of equal keys: the
    held rows of a key come first and stay, the asked ones pass by."""
    both = held.withColumn("side", F.lit(0)).unionByName(asked.withColumn("side", F.lit(1)), allowMissingColumns=True)
    at = [both.columns.index(c) for c in keys]
    side = both.columns.index("side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, kept, known = None, [], None
        for b in batches:
            ks = np.stack([*(b.column(i).to_numpy() for i in at), b.column(side).to_numpy().astype(np.int64)])
            cuts = np.flatnonzero((ks[:, 1:] != ks[:, :-1]).any(axis=0)) + 1
            for i, j in zip([0, *cuts], [*cuts, b.num_rows], strict=True):
                if j == i:
                    continue
                key, part = tuple(ks[:-1, i]), b.slice(i, j - i)
                if key != now:
                    now, kept, known = key, [], None
                if ks[-1, i] == 0:
                    kept.append(part)
                elif kept:
                    known = known or pa.Table.from_batches(kept).combine_chunks().to_batches()[0]
                    for k in range(0, part.num_rows, BATCH):
                        yield from answer(known, part.slice(k, BATCH))

    return both.repartition(*keys).sortWithinPartitions(*keys, "side").mapInArrow(run, schema)


_NEEDS = "strip long, blocks array<long>, home long, slot int, vec_id long, label long, data binary, p_ids array<long>, p_scores array<long>"


def hard_negatives(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256) -> DataFrame:
    """For each anchor row and each of its ``positives`` best rows of the same
    label, the ``negatives`` best rows of other labels whose scores are
    between ``low`` and ``high`` hundredths of the positive's.

    ``rows``: vec_id, label (integers), vector (array of numbers).
    """
    spark = rows.sparkSession
    prepare(spark)
    empty = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    sound = "label is not null and vector is not null and not exists(vector, x -> x is null or isnan(x) or abs(x) = double('infinity'))"
    mine = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.coalesce(anchors, F.lit(False)).alias("anchor"), F.col("vector").cast("array<double>").alias("vector")).where(sound)
    made = _blocks(mine, scale, positives)
    if made is None:
        return empty
    blocks, dims, dtype = made
    n_zones, n_anchors = blocks.agg(F.sum((F.col("slot") == -1).cast("long")), F.sum(F.col("anchor").cast("long"))).first()
    if not n_anchors:
        return empty
    chunks, parts = -(-n_zones // ZONES), -(-n_anchors // ANCHORS)
    chunk_of = F.pmod(F.xxhash64("strip"), F.lit(chunks)).cast("long").alias("chunk")
    part_of = F.pmod(F.xxhash64("home", "slot"), F.lit(parts)).cast("long").alias("part")
    each = lambda n, name: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias(name)

    zones = blocks.where("slot = -1").select(chunk_of, "strip", F.col("block").alias("zone"), "lo", "hi", F.col("vec_id").alias("least_id"), F.col("label").alias("label_lo"), "label_hi")
    points = blocks.where("slot >= 0").select("strip", "block", F.col("vec_id").alias("row_id"), F.col("label").alias("row_label"), F.col("data").alias("point"), F.col("slot").alias("place"))
    asked = blocks.where("anchor").select(F.col("block").alias("home"), "slot", "vec_id", "label", "data", "tau", "tau_id", F.lit(None).cast("array<long>").alias("p_ids"), F.lit(None).cast("array<long>").alias("p_scores"))

    def windows(b: pa.RecordBatch) -> list[tuple[np.ndarray, np.ndarray]]:
        """Least and greatest score of each anchor's windows."""
        ps = [np.array(p, dtype=np.int64) for p in b.column("p_scores").to_pylist()]
        return [(-(-low * p // 100), high * p // 100) for p in ps]

    def choose(z: pa.RecordBatch, b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """The blocks that each anchor must read, by bounds on their scores."""
        a, label = _matrix(b.column("data"), dims, dtype), b.column("label").to_numpy()
        lo, hi = _matrix(z.column("lo"), dims, dtype), _matrix(z.column("hi"), dims, dtype)
        plus, minus = np.maximum(a, 0), np.minimum(a, 0)
        most, least = plus @ hi.T + minus @ lo.T, plus @ lo.T + minus @ hi.T
        label_lo, label_hi = z.column("label_lo").to_numpy(), z.column("label_hi").to_numpy()
        if b.column("p_scores").null_count:
            need = (label_lo <= label[:, None]) & (label[:, None] <= label_hi)
            known = b.column("tau").is_valid().to_numpy(zero_copy_only=False)[:, None]
            tau, tau_id = b.column("tau").fill_null(0).to_numpy()[:, None], b.column("tau_id").fill_null(0).to_numpy()[:, None]
            need &= ~known | (most > tau) | (most == tau) & (z.column("least_id").to_numpy() <= tau_id)
        else:
            need = np.zeros(most.shape, dtype=bool)
            for i, (down, up) in enumerate(windows(b)):
                for d, u in {*zip(down.tolist(), up.tolist(), strict=True)}:
                    if d <= u:
                        need[i] |= (most[i] >= d) & (least[i] <= u)
            need &= (label_lo != label[:, None]) | (label_hi != label[:, None])
        strips, zone = z.column("strip").to_numpy(), z.column("zone").to_numpy()
        who, strip, lists = [], [], []
        for i, row in enumerate(need):
            at = np.flatnonzero(row)
            at = at[np.argsort(strips[at], kind="stable")]
            for one in np.split(at, np.flatnonzero(np.diff(strips[at])) + 1) if len(at) else []:
                who.append(i)
                strip.append(int(strips[one[0]]))
                lists.append(zone[one].tolist())
        if who:
            kept = b.select(["home", "slot", "vec_id", "label", "data", "p_ids", "p_scores"]).take(pa.array(who))
            yield pa.RecordBatch.from_arrays([pa.array(strip, pa.int64()), pa.array(lists, pa.list_(pa.int64())), *kept.columns], names=["strip", "blocks", *kept.schema.names])

    def scored(v: pa.RecordBatch, b: pa.RecordBatch) -> tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]:
        """The strip's rows by id, the anchors' scores, and which rows count
        (in a chosen block, not the anchor itself), which have its label."""
        v = v.take(pa.array(np.argsort(_ids(v.column("row_id")), kind="stable")))
        block, place = v.column("block").to_numpy(), v.column("place").to_numpy()
        m, a = _matrix(v.column("point"), dims, dtype), _matrix(b.column("data"), dims, dtype)
        s, ok = np.zeros((len(a), len(m)), dtype=m.dtype), np.zeros((len(a), len(m)), dtype=bool)
        home, slot = b.column("home").to_numpy(), b.column("slot").to_numpy()
        lists = [set(x) for x in b.column("blocks").to_pylist()]
        for one in np.unique(block):
            who, cols = np.array([i for i, x in enumerate(lists) if one in x], dtype=np.int64), np.flatnonzero(block == one)
            s[np.ix_(who, cols)] = a[who] @ m[cols].T
            ok[np.ix_(who, cols)] = (home[who] != one)[:, None] | (slot[who][:, None] != place[cols])
        same = b.column("label").to_numpy()[:, None] == v.column("row_label").to_numpy()
        return v, s, ok, same

    def find_positives(v: pa.RecordBatch, b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        v, s, ok, same = scored(v, b)
        got = [(i, j, int(s[i, j])) for i, best in _best(s, ok & same, positives) for j in best]
        if got:
            who, at, score = zip(*got, strict=True)
            kept = b.select(["home", "slot", "vec_id", "label", "data"]).take(pa.array(who))
            yield pa.RecordBatch.from_arrays([*kept.columns, v.column("row_id").take(pa.array(at)), pa.array(score, pa.int64())], names=[*kept.schema.names, "p_id", "p_score"])

    def find_negatives(v: pa.RecordBatch, b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        v, s, ok, same = scored(v, b)
        ok &= ~same
        bounds, ids = windows(b), b.column("p_ids").to_pylist()
        got = []
        for w in range(positives):
            has = [len(d) > w for d, _ in bounds]
            down = np.array([d[w] if h else 1 for (d, _), h in zip(bounds, has, strict=True)])[:, None]
            up = np.array([u[w] if h else 0 for (_, u), h in zip(bounds, has, strict=True)])[:, None]
            got += [(i, w, j, int(s[i, j])) for i, best in _best(s, ok & (s >= down) & (s <= up), negatives) for j in best]
        if got:
            who, w, at, score = zip(*got, strict=True)
            ps = b.column("p_scores").to_pylist()
            kept = b.select(["home", "slot", "vec_id"]).take(pa.array(who))
            cols = [pa.array(w, pa.int32()), pa.array([ids[i][x] for i, x in zip(who, w, strict=True)], pa.int64()), pa.array([ps[i][x] for i, x in zip(who, w, strict=True)], pa.int64())]
            yield pa.RecordBatch.from_arrays([*kept.columns, *cols, v.column("row_id").take(pa.array(at)), pa.array(score, pa.int64())], names=[*kept.schema.names, "w", "p_id", "p_score", "n_id", "n_score"])

    def needed(anchors: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
        """The anchors with the blocks they must read, and those blocks' rows."""
        needs = written(_meet(zones, anchors.select("*", each(chunks, "chunk")), ["chunk"], choose, _NEEDS), name)
        read = points.join(needs.select(F.explode("blocks").alias("block")).distinct(), "block", "left_semi")
        return needs.select("*", part_of), read.select("*", each(parts, "part"))

    def first(found: DataFrame, keys: list[str], score: str, ident: str, k: int) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc_nulls_last(ident))
        return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)

    needs, read = needed(asked, "positive-blocks")
    found = _meet(read, needs, ["strip", "part"], find_positives, "home long, slot int, vec_id long, label long, data binary, p_id long, p_score long")
    best = first(found, ["home", "slot"], "p_score", "p_id", positives)
    listed = F.array_sort(F.collect_list(F.struct("rank", "p_id", "p_score")))
    per = best.groupBy("home", "slot").agg(F.first("vec_id").alias("vec_id"), F.first("label").alias("label"), F.first("data").alias("data"), listed.alias("ps"))
    null = F.lit(None).cast("long")
    known = written(per.select("home", "slot", "vec_id", "label", "data", null.alias("tau"), null.alias("tau_id"), F.col("ps.p_id").alias("p_ids"), F.col("ps.p_score").alias("p_scores")), "positives")
    needs, read = needed(known, "negative-blocks")
    found = _meet(read, needs, ["strip", "part"], find_negatives, "home long, slot int, vec_id long, w int, p_id long, p_score long, n_id long, n_score long")
    best = first(found, ["home", "slot", "w"], "n_score", "n_id", negatives)
    return best.select(F.col("vec_id").alias("anchor_id"), F.col("p_id").alias("positive_id"), "rank", F.col("n_id").alias("negative_id"), F.col("p_score").alias("positive_score"), F.col("n_score").alias("negative_score"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", label.alias("label"), F.col("embedding").alias("vector"))
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)


OP11_SQL = """
with v as (
  select row_number() over () as row, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * cast(x as double))) as q
  from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.row as a_row, a.vec_id as anchor_id, b.row as b_row, b.vec_id as id, a.label = b.label as same, cast(list_inner_product(a.q, b.q) as bigint) as score
  from v a join v b on a.row <> b.row where a.vec_id % 100 = 0
), positives as (
  select * from scored where same qualify row_number() over (partition by a_row order by score desc, id) <= 5
)
select p.anchor_id, p.id as positive_id,
  cast(row_number() over (partition by p.a_row, p.b_row order by n.score desc, n.id) as integer) as rank,
  n.id as negative_id, p.score as positive_score, n.score as negative_score
from positives p join scored n on p.a_row = n.a_row and not n.same and 80 * p.score <= 100 * n.score and 100 * n.score <= 100 * p.score
qualify row_number() over (partition by p.a_row, p.b_row order by n.score desc, n.id) <= 5
"""
