"""Best-fit packing of token sequences by bin completion.

Documents become token ids plus an end id; longer ones than the capacity are
cut into full pieces and a rest. A piece as long as the capacity is a sequence
of its own; all others (lengths and ids only, no tokens) are dealt out evenly
over blocks of about ``BLOCK`` pieces, each a sample of the whole table, so no
sequence is closed before its pieces met those of other partitions. A block is
packed by bin completion (Korf): best-fit decreasing gives the incumbent; where
the waste still allows a sequence less, the first path of the search over the
whole block (``dive``: the fullest filling around each largest open piece) and
``ROUNDS`` other ones over the sequences with room may replace it, then branch and bound over successive groups of wasteful sequences
takes the largest open piece, enumerates the fillings around it that no swap or
addition dominates, fullest first, and cuts branches whose waste exceeds what
the incumbent allows. While there is more than one block, only sequences with at most
``WASTE`` free stay closed; the pieces of the others are dealt out again, for
as long as at least half of a round's pieces were placed.

The search is bounded: ``LOOK`` steps a sequence in ``dive``, ``NODES`` nodes a
group, ``GROUPS`` groups a block of ``SEARCH_ITEMS`` pieces each. The incumbent
is the answer where it runs out, so every piece is always placed. Null and empty
texts are one piece of one end id, repeated rows are packed each on its own,
an empty table gives no rows, other columns of the input are ignored.
"""

from __future__ import annotations

import random
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import crc32_u32, encoder, lean, prepare, table, text_slices, tokenizer_spec, written

CAPACITY = 2048
BLOCK = 50_000  # pieces packed at once
WASTE = CAPACITY // 32  # free in a sequence that is closed while other blocks are open
LOOK = 2000  # steps of the look for the fullest filling of one sequence
ROUNDS = 30  # of other first paths in a block
SEARCH_ITEMS = 48  # pieces of wasteful sequences searched together
NODES = 4000  # of the search of one such group
GROUPS = 25  # searched in a block
FIELDS = "doc_id long, piece int, start long, length long, ids_crc32 long"


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: indices by sequence."""
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []  # (free, bin), sorted
    for i in sorted(range(len(sizes)), key=sizes.__getitem__, reverse=True):
        at = bisect_left(room, (sizes[i], -1))
        if at == len(room):
            bins.append([i])
            free, b = capacity - sizes[i], len(bins) - 1
        else:
            free, b = room.pop(at)
            bins[b].append(i)
            free -= sizes[i]
        if free:
            insort(room, (free, b))
    return bins


def _fillings(items: list[tuple[int, int]], room: int, nodes: list[int]) -> list[tuple[int, list[int]]]:
    """(fill, positions) of the undominated subsets of ``items`` (size, index;
    descending) within ``room``: none can take a further item, and none would
    be fuller with one of its items swapped for a larger one left out."""
    found: list[tuple[int, list[int]]] = []

    def undominated(took: list[int], fill: int) -> bool:
        slack, inside = room - fill, set(took)
        out = [s for k, (s, _) in enumerate(items) if k not in inside]
        if any(s <= slack for s in out):
            return False
        return not any(items[k][0] < s <= items[k][0] + slack for k in took for s in out)

    def grow(k: int, took: list[int], fill: int) -> None:
        if nodes[0] <= 0:
            return
        nodes[0] -= 1
        while k < len(items) and items[k][0] > room - fill:
            k += 1
        if k == len(items):
            if undominated(took, fill):
                found.append((fill, took))
            return
        grow(k + 1, [*took, k], fill + items[k][0])
        same = items[k][0]
        while k < len(items) and items[k][0] == same:  # of equal sizes the first ones are taken
            k += 1
        grow(k, took, fill)

    grow(0, [], 0)
    return sorted(found, key=lambda x: -x[0])


def complete(sizes: list[int], capacity: int, best: list[list[int]], budget: int) -> list[list[int]]:
    """Bin completion with ``best`` as the incumbent."""
    total, nodes = sum(sizes), [budget]
    least = -(-total // capacity)

    def search(items: list[tuple[int, int]], bins: list[list[int]], waste: int) -> None:
        nonlocal best
        if len(best) == least or nodes[0] <= 0:
            return
        if not items:
            if len(bins) < len(best):
                best = bins
            return
        if len(bins) + -(-sum(s for s, _ in items) // capacity) >= len(best):
            return
        (size, i), rest = items[0], items[1:]
        for fill, took in _fillings(rest, capacity - size, nodes):
            # What one sequence less would leave free in all is the bound.
            if waste + capacity - size - fill > (len(best) - 1) * capacity - total:
                break
            inside = set(took)
            search([x for k, x in enumerate(rest) if k not in inside], [*bins, [i, *(rest[k][1] for k in took)]], waste + capacity - size - fill)

    search(sorted(((s, i) for i, s in enumerate(sizes)), reverse=True), [], 0)
    return best


def dive(sizes: list[int], capacity: int, look: int = LOOK, draw: random.Random | None = None) -> list[list[int]]:
    """The first path of bin completion over all pieces: around the largest
    open piece the fullest filling (larger pieces first; the first that leaves
    nothing free ends the look), taken without coming back. Pieces of one size
    are one choice, so a filling is a descent over different sizes; ``look``
    bounds its steps, and the fullest filling seen is taken then. With ``draw``
    the look starts at a drawn size, and takes those above it last."""
    open_at: dict[int, list[int]] = {}
    for i, s in enumerate(sizes):
        open_at.setdefault(s, []).append(i)
    kinds = sorted(open_at)
    bins: list[list[int]] = []

    def fullest(room: int) -> list[int]:
        best, best_fill, steps = [], 0, look
        # (room left, sizes below this place may follow, sizes taken)
        top = bisect_left(kinds, room + 1)
        stack = [(room, top, [])]
        if draw and top:
            stack.append((room, draw.randint(1, top), []))
        while stack and steps > 0:
            left, k, took = stack.pop()
            if len(open_at.get(left, ())) > took.count(left):
                return [*took, left]
            while k and steps > 0:
                k -= 1
                steps -= 1
                s = kinds[k]
                if s > left or len(open_at[s]) <= took.count(s):
                    continue
                if len(open_at.get(left - s, ())) > (*took, s).count(left - s) and left - s <= s:
                    return [*took, s, left - s]
                if room - left + s > best_fill:
                    best, best_fill = [*took, s], room - left + s
                if kinds[0] <= left - s:
                    if k:
                        stack.append((left, k, took))
                    stack.append((left - s, min(k + 1, bisect_left(kinds, left - s + 1)), [*took, s]))
                    break
        return best

    while kinds:
        own = [kinds[-1]]
        first = open_at[own[0]].pop()
        if own[0] < capacity:
            own += fullest(capacity - own[0])
        bins.append([first, *(open_at[s].pop() for s in own[1:])])
        for s in {*own}:
            if not open_at[s]:
                del open_at[s]
                kinds.pop(bisect_left(kinds, s))
    return bins


def _groups(bins: list[list[int]], free: list[int], capacity: int) -> Iterator[list[int]]:
    """Sequences (their places) to be searched together: the poorest first, in
    groups that have a whole sequence free and at most SEARCH_ITEMS pieces."""
    group, pieces, waste = [], 0, 0
    for k in sorted((k for k in range(len(bins)) if free[k] and len(bins[k]) <= SEARCH_ITEMS), key=lambda k: -free[k]):
        if pieces + len(bins[k]) > SEARCH_ITEMS:
            if waste >= capacity:
                yield group
            group, pieces, waste = [], 0, 0
        group, pieces, waste = [*group, k], pieces + len(bins[k]), waste + free[k]
    if waste >= capacity:
        yield group


def least_sequences(sizes: list[int], capacity: int) -> int:
    """A lower bound (Martello and Toth): for each k, pieces over capacity - k
    stand alone among those of k or more, and pieces over half the capacity
    share with no other such piece."""
    count = np.bincount(sizes, minlength=capacity + 1) if sizes else np.zeros(capacity + 1, dtype=np.int64)
    # Number and sum of the pieces of at least s, for s from 0 to capacity + 1.
    n = np.append(np.cumsum(count[::-1])[::-1], 0)
    total = np.append(np.cumsum((count * np.arange(capacity + 1))[::-1])[::-1], 0)
    half = capacity // 2 + 1
    k = np.arange(half)
    alone = np.minimum(capacity - k + 1, capacity + 1)
    middle, small = n[half] - n[alone], total[k] - total[half]
    over = small - (middle * capacity - (total[half] - total[alone]))
    return int((n[half] + np.maximum(0, -(-over // capacity))).max())


def redive(sizes: list[int], capacity: int, bins: list[list[int]], least: int, rounds: int = ROUNDS) -> list[list[int]]:
    """Other first paths: all sequences with room and twice as many full ones
    are opened again and filled from drawn sizes; what needs no sequence more
    is kept, so the room left moves together until a sequence is saved."""
    draw = random.Random(len(sizes))
    for _ in range(rounds):
        if len(bins) <= least:
            break
        free = [capacity - sum(sizes[i] for i in b) for b in bins]
        full = [k for k, f in enumerate(free) if not f]
        again = {k for k, f in enumerate(free) if f}
        again.update(draw.sample(full, min(len(full), 2 * len(again))))
        part = [i for k in again for i in bins[k]]
        found = dive([sizes[i] for i in part], capacity, draw=draw)
        if len(found) <= len(again):
            bins = [b for k, b in enumerate(bins) if k not in again] + [[part[j] for j in b] for b in found]
    return bins


def pack(sizes: list[int], capacity: int = CAPACITY, budget: int = NODES) -> list[list[int]]:
    """Indices by sequence: the better of best-fit decreasing and ``dive`` is
    the incumbent; then bin completion over successive groups of its poorest
    sequences, until no sequence less is possible or GROUPS were searched."""
    least = least_sequences(sizes, capacity)
    bins = best_fit(sizes, capacity)
    if len(bins) > least:
        bins = redive(sizes, capacity, min(bins, dive(sizes, capacity), key=len), least)
    searched, better = 0, True
    while better and len(bins) > least and searched < GROUPS:
        better, made, gone = False, [], set()
        for group in islice(_groups(bins, [capacity - sum(sizes[i] for i in b) for b in bins], capacity), GROUPS - searched):
            searched += 1
            part = [i for k in group for i in bins[k]]
            at = {i: j for j, i in enumerate(part)}
            found = complete([sizes[i] for i in part], capacity, [[at[i] for i in bins[k]] for k in group], budget)
            if len(found) < len(group):
                better = True
                gone.update(group)
                made += [[part[j] for j in b] for b in found]
            if len(bins) - len(gone) + len(made) <= least:
                break
        bins = [b for k, b in enumerate(bins) if k not in gone] + made
    return bins


def _rows(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    cols = zip(*rows, strict=True) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)


_TYPES = [pa.int64(), pa.int32(), *[pa.int64()] * 5]
_NAMES = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def _placed(pieces: list[tuple], bins: list[list[int]], first: int) -> list[tuple]:
    out = []
    for k, b in enumerate(bins):
        at = 0
        for i in b:
            out.append((*pieces[i], first + k, at))
            at += pieces[i][3]
    return out


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 0, capacity: int = CAPACITY, lead: str = "") -> DataFrame:
    """One row per piece: ``FIELDS``, sequence_id and offset."""
    spark = docs.sparkSession
    prepare(spark)
    spec = tokenizer_spec(spark, tokenizer_path)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, base, used = encoder(spec.value, lead), TaskContext.get().partitionId() << 36, 0
        for b in text_slices(batches):
            rows = []
            for doc, ids in zip(b.column("doc_id").to_pylist(), enc.encode(b.column("text")), strict=True):
                ids = np.append(ids, np.uint32(end_id))
                for n, at in enumerate(range(0, len(ids), capacity)):
                    own = ids[at : at + capacity]
                    full = len(own) == capacity
                    rows.append((doc, n, at, len(own), crc32_u32(own), base + used if full else None, 0 if full else None))
                    used += full
            yield _rows(rows, _NAMES, _TYPES)

    schema = f"{FIELDS}, sequence_id long, offset long"
    now = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lean(cut), schema), "packed")
    done, before, number = now.where("sequence_id is not null"), None, 0
    while True:
        left = now.where("sequence_id is null").select("doc_id", "piece", "start", "length", "ids_crc32")
        n = left.count()
        last = n <= BLOCK or (before is not None and 2 * n > before)
        blocks, before, number = -(-n // BLOCK) or 1, n, number + 1
        # Dealt out evenly, in the order of the rows' hashes: a block holds about its share of every partition.
        packed = left.repartition(blocks).mapInArrow(_packer(capacity, capacity if last else capacity * WASTE // CAPACITY, number), schema)
        if last:
            return done.unionByName(packed)
        now = written(packed, "packed")
        done = done.unionByName(now.where("sequence_id is not null"))


def _packer(capacity: int, waste: int, number: int):
    """Packs a task's pieces; those of sequences with more than ``waste`` free stay open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Full pieces have numbers from 0 upwards, these from -1 downwards.
        base, pool = -1 - (number << 56) - (TaskContext.get().partitionId() << 32), []
        for b in batches:
            pool += zip(*(c.to_pylist() for c in b.columns), strict=True)
        bins = pack([p[3] for p in pool], capacity)
        closed, opened = [], []
        for x in bins:
            (closed if capacity - sum(pool[i][3] for i in x) <= waste else opened).append(x)
        rows = [(*r[:5], base - r[5], r[6]) for r in _placed(pool, closed, 0)] + [(*pool[i], None, None) for x in opened for i in x]
        for i in range(0, len(rows), 4096):
            yield _rows(rows[i : i + 4096], _NAMES, _TYPES)

    return run


def packed_table(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_table(table(spark, sf_dir, "documents"))
