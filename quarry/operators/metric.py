"""A metric index for exact cosine search among vectors, without all pairs.

The angle between vectors is a metric, so the triangle inequality bounds it.
A bounded set of pivots is chosen among the indexed vectors; every indexed
vector belongs to the cell of its nearest pivot and, by its angle to the
pivot, to one of ``RINGS`` rings of the cell. A searched vector within
``radius`` of anything in a ring must itself have an angle to the pivot
within ``radius`` of the ring's range, and none may be nearer to another pivot
by more than twice the radius; all other rings are never read. What is read
is compared exactly, so nothing is lost; how much is pruned depends on the
data (``share`` tells).

The pivots and the rings' ranges are the only things that pass the driver (at
most ``PIVOTS`` vectors and ``PIVOTS * RINGS`` rows). Rings of many vectors
are cut into pieces that fit a task, and a piece that many searched vectors
need is copied to several tasks.

Vectors count by direction only: lengths are divided out. Null vectors, such
with a null or non-finite component and those without a direction (zero or
empty) have no cosine with anything. Shorter vectors count as padded with
zeros.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.ranks import written
from quarry.session import ship_package

PIVOTS, RINGS = 64, 16
#: Indexed vectors from which the pivots are chosen (fixed by a hash).
SAMPLE = 2048
#: Indexed rows that a task holds, searched rows that it meets, about.
PIECE, ASKED = 8192, 500_000
#: Searched rows compared at once.
BATCH = 512
#: Slack for rounding, in radians.
SLACK = 1e-6


def sound(vec: str) -> Column:
    """Vectors that have a direction."""
    return F.expr(f"`{vec}` is not null and not exists(`{vec}`, x -> x is null or isnan(x) or abs(x) = double('infinity')) and exists(`{vec}`, x -> x != 0)")


def identity(vec: str) -> list[Column]:
    """128 bits that stand for a vector's content."""
    return [F.xxhash64(vec).alias("_a"), F.xxhash64(F.lit(1), vec).alias("_b")]


def _units(lists: pa.Array, dims: int) -> np.ndarray:
    """Unit vectors, cut to ``dims`` components: what lies beyond meets zeros,
    so angles to vectors of ``dims`` components stay what they are."""
    n = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    wide = np.zeros((len(n), max(dims, int(n.max(initial=0)))))
    wide[np.arange(wide.shape[1])[None, :] < n[:, None]] = flat
    wide /= np.abs(wide).max(axis=1, keepdims=True)
    wide /= np.sqrt((wide * wide).sum(axis=1, keepdims=True))
    return wide[:, :dims]


def _angles(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(x @ y.T, -1.0, 1.0))


def _binary(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in np.ascontiguousarray(rows)], pa.binary())


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float64).reshape(len(column), dims)


def _pivots(sample: np.ndarray) -> np.ndarray:
    """Farthest-first: each pivot is the vector farthest from those before it."""
    chosen = [0]
    gap = _angles(sample, sample[:1])[:, 0]
    while len(chosen) < min(PIVOTS, len(sample)) and gap.max() > SLACK:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, _angles(sample, sample[chosen[-1:]])[:, 0])
    return sample[chosen]


class MetricIndex:
    """The vectors of ``evals`` by cell and ring; ``empty`` without any."""

    def __init__(self, evals: DataFrame, vec: str = "embedding", piece: int | None = None):
        piece = piece or PIECE
        self.spark = evals.sparkSession
        ship_package(self.spark)
        rows = evals.where(sound(vec)).select(F.col(vec).cast("array<double>").alias("v"))
        self.dims = rows.agg(F.max(F.size("v"))).first()[0] or 0
        self.empty = not self.dims
        if self.empty:
            return
        dims = self.dims
        first = rows.orderBy(F.xxhash64("v"), "v").limit(SAMPLE).collect()
        pivots = self.pivots = _pivots(_units(pa.array([r.v for r in first], pa.list_(pa.float64())), dims))
        width = math.pi / RINGS

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    u = _units(b.column(0), dims)
                    d = _angles(u, pivots)
                    cell = d.argmin(axis=1)
                    far = d[np.arange(len(u)), cell]
                    ring = cell * RINGS + np.minimum((far / width).astype(np.int64), RINGS - 1)
                    yield pa.RecordBatch.from_arrays([pa.array(ring, pa.int64()), pa.array(far), _binary(u)], names=["ring", "far", "unit"])

        self.table = written(rows.mapInArrow(place, "ring long, far double, unit binary"), "metric-index")
        rings = self.table.groupBy("ring").agg(F.count("*").alias("n"), F.min("far").alias("lo"), F.max("far").alias("hi"))
        self.rings = sorted(rings.collect())  # PIVOTS * RINGS rows at most
        self.n = sum(r.n for r in self.rings)
        self.pieces = {r.ring: -(-r.n // piece) for r in self.rings}

    def needs(self, rows: DataFrame, vec: str, threshold: float) -> DataFrame:
        """_a, _b, unit, rings: the distinct vectors of ``rows`` that must read any ring."""
        dims, pivots = self.dims, self.pivots
        radius = math.acos(max(-1.0, min(1.0, threshold))) + SLACK
        ids, cells = np.array([r.ring for r in self.rings]), np.array([r.ring // RINGS for r in self.rings])
        lo, hi = np.array([r.lo for r in self.rings]), np.array([r.hi for r in self.rings])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if not b.num_rows:
                    continue
                u = _units(b.column(2), dims)
                d = _angles(u, pivots)
                far = d[:, cells]
                need = (far - hi <= radius) & (lo - far <= radius) & (far - d.min(axis=1, keepdims=True) <= 2 * radius)
                at = np.flatnonzero(need.any(axis=1))
                lists = pa.array([ids[need[i]].tolist() for i in at], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*(b.column(i).take(pa.array(at)) for i in (0, 1)), _binary(u[at]), lists], names=["_a", "_b", "unit", "rings"])

        asked = rows.where(sound(vec)).select(*identity(vec), F.col(vec).cast("array<double>").alias("v"))
        return asked.mapInArrow(run, "_a long, _b long, unit binary, rings array<long>")

    def share(self, rows: DataFrame, vec: str, threshold: float) -> float:
        """The share of all pairs that a search compares."""
        if self.empty:
            return 0.0
        sizes = F.create_map(*(F.lit(v) for r in self.rings for v in (r.ring, r.n)))
        read = self.needs(rows, vec, threshold).select(F.explode("rings").alias("ring")).agg(F.sum(F.element_at(sizes, F.col("ring")))).first()[0]
        return (read or 0) / (self.n * max(1, rows.where(sound(vec)).count()))

    def search(self, rows: DataFrame, vec: str, threshold: float) -> DataFrame:
        """_a, _b, cosine: the greatest cosine of each vector of ``rows``, where it is at least ``threshold``."""
        if self.empty:
            return self.spark.createDataFrame([], "_a long, _b long, cosine double")
        dims = self.dims
        needs = written(self.needs(rows, vec, threshold), "metric-needs")
        wanted = {r.ring: r["count"] for r in needs.select(F.explode("rings").alias("ring")).groupBy("ring").count().collect()}  # one row a ring
        if not wanted:
            return self.spark.createDataFrame([], "_a long, _b long, cosine double")
        table = lambda d: F.create_map(*(F.lit(v) for r in wanted for v in (r, d[r])))
        copies = table({r: -(-n // ASKED) for r, n in wanted.items()})
        pieces = table(self.pieces)
        ring = F.col("ring")
        upto = lambda n: F.explode(F.sequence(F.lit(0), F.element_at(n, ring).cast("int") - 1))
        some = lambda n, *by: F.pmod(F.xxhash64(*by), F.element_at(n, ring)).cast("int")
        none = F.lit(None).cast("long")
        held = self.table.where(ring.isin(list(wanted))).select("ring", some(pieces, "far", "unit").alias("piece"), upto(copies).alias("copy"), F.lit(0).alias("side"), none.alias("_a"), none.alias("_b"), "unit")
        asked = needs.select("_a", "_b", "unit", F.explode("rings").alias("ring")).select("_a", "_b", "unit", "ring", some(copies, "_a", "_b").alias("copy"))
        asked = asked.select("ring", upto(pieces).alias("piece"), "copy", F.lit(1).alias("side"), "_a", "_b", "unit")

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Pieces come before the vectors that ask for them; one piece is held at a time."""
            now, parts, held = None, [], None
            for b in batches:
                keys = np.stack([b.column(i).to_numpy().astype(np.int64) for i in range(4)])
                cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1), b.num_rows]
                for i, j in zip(cuts, cuts[1:]):
                    if i == j:
                        continue
                    key, rows = tuple(keys[:3, i]), b.slice(i, j - i)
                    if key != now:
                        now, parts, held = key, [], None
                    if keys[3, i] == 0:
                        parts.append(_matrix(rows.column(6), dims))
                    elif parts:
                        held = np.concatenate(parts) if held is None else held
                        for k in range(0, rows.num_rows, BATCH):
                            part = rows.slice(k, BATCH)
                            best = (_matrix(part.column(6), dims) @ held.T).max(axis=1)
                            at = np.flatnonzero(best >= threshold)
                            yield pa.RecordBatch.from_arrays([part.column(4).take(pa.array(at)), part.column(5).take(pa.array(at)), pa.array(best[at])], names=["_a", "_b", "cosine"])

        at = ["ring", "piece", "copy"]
        met = held.unionByName(asked).repartition(*at).sortWithinPartitions(*at, "side")
        return met.mapInArrow(compare, "_a long, _b long, cosine double").groupBy("_a", "_b").agg(F.max("cosine").alias("cosine"))
