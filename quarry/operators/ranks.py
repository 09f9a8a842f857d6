"""Exact ranks of any orderable key, without a global sort.

Rows are counted per key (a partial aggregate, so ties and hot keys shrink
before they move), the counts are range-partitioned, and prefix sums over the
ranges' totals tell in which range a rank lies; a running sum inside that one
range finds its key. One way at every size and for every orderable type:
nothing is sampled into the answer, turned into doubles or sent to one task.

Rows of equal keys are ordered by the ``ties`` columns and then by a hash of
the whole row, each step looking only at the rows still tied. Rows that agree
in all of it are interchangeable: they are written once, numbered by partition
and place, and the number decides.
"""

from __future__ import annotations

from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import scratch_path

_DIGEST = "_row_digest"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write to the shared folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class RankTable:
    """Counts of the non-null keys of ``column``, cut into ordered ranges.

    With ``nulls`` a null counts as a value below all others."""

    def __init__(self, df: DataFrame, column: str, nulls: bool = False):
        self.stamped = isinstance(df.schema[column].dataType, T.TimestampType)
        keys = df.select(F.col(column).alias("k"))
        counts = (keys if nulls else keys.where("k is not null")).groupBy("k").agg(F.count("*").alias("n"))
        # Range boundaries are sampled anew by every job: written once, they hold.
        self.table = written(counts.repartitionByRange("k").withColumn("part", F.spark_partition_id()), "rank-ranges")
        totals = sorted(self.table.groupBy("part").agg(F.sum("n").alias("n")).collect())  # one row a partition
        ends = list(accumulate(r.n for r in totals))
        self.n = ends[-1] if ends else 0
        self.ranges = [(r.part, end - r.n, end) for r, end in zip(totals, ends, strict=True)]

    def find(self, ranks: list[int]) -> dict[int, tuple[Column, int, int]]:
        """(key literal, rows below it, rows of it) for each 1-based rank from the smallest."""
        wanted = sorted({r for r in ranks if 0 < r <= self.n})
        if not wanted:
            return {}
        start = {part: low for part, low, high in self.ranges if any(low < r <= high for r in wanted)}
        base = F.element_at(F.create_map(*(F.lit(v) for pair in start.items() for v in pair)), F.col("part"))
        running = F.sum("n").over(Window.partitionBy("part").orderBy(F.asc_nulls_first("k")))
        placed = self.table.where(F.col("part").isin(list(start))).withColumn("upto", base + running)
        holds = F.exists(F.array(*map(F.lit, wanted)), lambda r: (F.col("upto") >= r) & (F.col("upto") - F.col("n") < r))
        value = F.unix_micros("k") if self.stamped else F.col("k")
        rows = placed.where(holds).select(value.alias("k"), "n", "upto").collect()  # at most one row a rank
        kind = self.table.schema["k"].dataType
        lit = lambda v: F.lit(None).cast(kind) if v is None else F.timestamp_micros(F.lit(v)) if self.stamped else F.lit(v).cast(kind)
        return {r: next((lit(x.k), x.upto - x.n, x.n) for x in rows if x.upto - x.n < r <= x.upto) for r in wanted}


class Cuts:
    """Where the first k rows by (key, ties, row hash) end, for each k.

    ``parts`` holds pairs of a frame and, for each k, the condition under
    which its rows lie beyond the first k. The first frame is ``df`` itself;
    further ones hold rows that agree with each other in everything while a
    cut runs between them. Conditions are null for null keys."""

    def __init__(self, df: DataFrame, key: str, ks: list[int], ties: tuple[str, ...] = (), table: RankTable | None = None):
        table = table or RankTable(df, key)
        self.n = table.n
        hashed = F.xxhash64(*(F.col(f.name) for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))))
        self._found: dict[tuple, tuple[DataFrame, Column, dict[int, int]]] = {}
        self._levels = [*ties, _DIGEST]
        wide = df.withColumn(_DIGEST, hashed)
        got = table.find(ks)
        beyond: list[Column] = []
        for i, k in enumerate(ks):
            if k <= 0 or k >= self.n:
                beyond.append(F.lit(k <= 0))
                continue
            value, below, same = got[k]
            col = F.col(key)
            if k - below == same:
                beyond.append(col > value)
            else:
                tied = col == value
                beyond.append((col > value) | (tied & self._among(wide.where(tied), self._levels, k - below, i, (str(value),), hashed, tied)))
        self.parts: list[tuple[DataFrame, list[Column]]] = []
        main = df
        for rows, same, takes in self._found.values():
            main = main.where(~F.coalesce(same, F.lit(False)))
            self.parts.append((rows, [F.col("_nth") >= takes[i] if i in takes else b for i, b in enumerate(beyond)]))
        self.parts.insert(0, (main, beyond))

    def _among(self, rows: DataFrame, levels: list[str], take: int, cut: int, path: tuple, hashed: Column, outer: Column) -> Column:
        """The condition, among tied rows (those of ``outer``), of lying beyond the first ``take``."""
        level = levels[0]
        value, below, n = RankTable(rows, level, nulls=True).find([take])[take]
        col = hashed if level == _DIGEST else F.col(level)
        more = F.coalesce(col > value, value.isNull() & col.isNotNull())
        tied = col.eqNullSafe(value)
        if take - below == n:
            return more
        here = rows.where(F.col(level).eqNullSafe(value))
        # With the outer levels in front, the row's hash is worked out for tied rows alone.
        same = outer & tied
        path = (*path, str(value))
        if len(levels) > 1:
            return more | (tied & self._among(here, levels[1:], take - below, cut, path, hashed, same))
        if path not in self._found:
            self._found[path] = (_numbered(here.drop(_DIGEST)), same, {})
        self._found[path][2][cut] = take - below
        return more


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_nth`` from 0: fixed by being written, numbered by
    prefix sums over the partitions' counts."""
    fixed = written(rows.withColumn("_id", F.monotonically_increasing_id()), "tied-rows")
    part, place = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    counts = sorted(fixed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())  # one row a partition
    starts = [(r.part, end - r.n) for r, end in zip(counts, accumulate(r.n for r in counts), strict=True)]
    offset = F.create_map(*(F.lit(v) for pair in starts for v in pair))
    return fixed.withColumn("_nth", F.element_at(offset, part) + place).drop("_id")


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
