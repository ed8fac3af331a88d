"""Near-duplicate embeddings by an epsilon grid order join.

Vectors link when their cosine, in double precision, is at least ``cosine``.
On unit vectors that is a Euclidean distance of at most
``eps = sqrt(2 - 2 cosine)``.

1. Equal vectors collapse to one entry with a count.
2. Vectors are rotated onto their principal dimensions (second moments of all
   vectors, summed on the executors: one ``d x d`` matrix). A rotation keeps
   distances.
3. *Epsilon grid order*: entries are sorted by their grid cells (side ``eps``)
   on the leading dimensions, then cut into sequence intervals of at most
   ``INTERVAL`` entries, each with its bounding box in the ``BOX_DIMS`` leading dimensions.
4. *Recursive interval join*: starting from one pair of whole sequences, pairs
   of nodes of a tree over the intervals are expanded level by level; a pair
   whose boxes are further apart than ``eps`` is skipped, and all below it.
   Surviving pairs of intervals meet and split further into leaves under the same
   test in all dimensions.
5. *Partial distances*: vectors of the remaining leaf pairs are first compared in the
   ``PART_DIMS`` leading dimensions alone, as products of narrow matrices in single precision
   with room for its errors. Only pairs that these leave in reach get a cosine, in double precision.
6. A pair of intervals returns link counts per entry and a spanning forest of
   its links, never the links themselves, so a large group costs a count and
   one forest link per entry.

Vectors of different lengths have no cosine: each length that occurs is joined by
itself (a few jobs a length).

Defined results: null vectors, vectors with a null or non-finite component,
zero vectors and empty vectors link with nothing; a null vec_id counts
as a vector for others' links and has a null component unless linked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cxlake.llm.shared import components, keep_on_disk, small_batches

INTERVAL, LEAF, FANOUT, GRID_DIMS, BOX_DIMS = 4096, 128, 8, 6, 16
# leading dimensions of partial distances, room for their rounding in single precision (unit vectors
# err by some 1e-6), and pairs whose vectors are gathered at a time
PART_DIMS, PART_ROOM, GATHER = 16, 1e-4, 16384
# rounding room of box tests: far above double rounding, far below any useful distance
SLACK = 1e-9
# least side of a grid cell (a cosine of 1 leaves no distance)
FINEST = 1e-6


def _usable(v: Column) -> Column:
    """True for arrays of finite values that are not all zero."""
    # x - x is NaN for NaN and infinite values
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x - x))
    return F.coalesce(~odd & F.exists(v, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(-1, width)


def _unit(rows: np.ndarray) -> np.ndarray:
    # scaled first, so that neither very small nor very large values leave the range of doubles
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _rotation(entries: DataFrame, width: int) -> np.ndarray:
    """Principal directions, most spread first, from the second moments of all unit vectors."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, square = 0, np.zeros(width), np.zeros((width, width))
        for batch in batches:
            if batch.num_rows:
                u = _unit(_matrix(batch.column(0), width))
                n, total, square = n + len(u), total + u.sum(axis=0), square + u.T @ u
        values = np.concatenate([[n], total, square.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], ["at", "value"])

    sums = entries.select("vector").mapInArrow(moments, "at bigint, value double").groupBy("at").agg(F.sum("value").alias("value"))
    flat = np.zeros(1 + width + width * width)
    for row in sums.collect():  # 1 + d + d * d numbers
        flat[row["at"]] = row["value"]
    n, mean = max(flat[0], 1.0), flat[1 : 1 + width] / max(flat[0], 1.0)
    spread = flat[1 + width :].reshape(width, width) / n - np.outer(mean, mean)
    return np.linalg.eigh((spread + spread.T) / 2)[1][:, ::-1].copy()


def _intervals(entries: DataFrame, width: int, rotation: np.ndarray, eps: float) -> DataFrame:
    """Sequence intervals in grid order: number, box in the leading dimensions, entry ids, counts and unit vectors."""
    dims, kept = min(GRID_DIMS, width), min(BOX_DIMS, width)
    order = [f"c{i}" for i in range(dims)]

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u = _unit(_matrix(batch.column(2), width)) if batch.num_rows else np.zeros((0, width))
            grid = np.floor(u @ rotation[:, :dims] / max(eps, FINEST)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(grid[:, i]) for i in range(dims)]], ["entry", "copies", "vector", *order])

    def build(part: pa.Table) -> pa.Table:
        ids, copies = (part.column(c).to_numpy() for c in ("entry", "copies"))
        u = _unit(_matrix(part.column("vector").combine_chunks(), width))
        r = u @ rotation[:, :kept]
        boxes = [pa.array([x.tolist()], pa.list_(pa.float64())) for x in (r.min(axis=0), r.max(axis=0))]
        data = [pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in (ids, copies, u)]
        return pa.Table.from_arrays([part.column("number").combine_chunks().slice(0, 1), *boxes, *data], ["number", "lo", "hi", "ids", "copies", "rows"])

    vector_type = entries.schema["vector"].dataType.simpleString()
    placed = entries.select("entry", "copies", "vector").mapInArrow(cells, f"entry bigint, copies bigint, vector {vector_type}, " + ", ".join(f"{c} int" for c in order))
    sequence = placed.repartitionByRange(*order, "entry").sortWithinPartitions(*order, "entry").select("entry", "copies", "vector")
    task = F.spark_partition_id().cast("long")
    sequence = keep_on_disk(sequence.withColumn("task", task).withColumn("nth", F.monotonically_increasing_id() - F.shiftleft(task, 33)))

    # places in the whole sequence, from one count a task
    start, starts = 0, []
    for row in sequence.groupBy("task").agg(F.count(F.lit(1)).alias("n")).orderBy("task").collect():
        starts.append((row["task"], start))
        start += row["n"]
    offsets = entries.sparkSession.createDataFrame(starts, "task bigint, start bigint")
    number = F.floor((F.col("start") + F.col("nth")) / INTERVAL).cast("long")
    numbered = sequence.join(F.broadcast(offsets), "task").select(number.alias("number"), "entry", "copies", "vector")
    return numbered.groupBy("number").applyInArrow(build, "number bigint, lo array<double>, hi array<double>, ids binary, copies binary, rows binary")


def _box_apart(a: str, b: str) -> Column:
    """Squared distance of two boxes given as lo/hi arrays."""
    gaps = F.transform(
        F.arrays_zip(f"lo_{a}", f"hi_{a}", f"lo_{b}", f"hi_{b}"),
        lambda g: F.greatest(F.lit(0.0), g[f"lo_{a}"] - g[f"hi_{b}"], g[f"lo_{b}"] - g[f"hi_{a}"]),
    )
    return F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g)


def _near_intervals(intervals: DataFrame, dims: int, eps: float) -> DataFrame:
    """Pairs (a <= b) of interval numbers whose boxes, and those of all nodes above them, are within ``eps``."""
    levels = [keep_on_disk(intervals.select(F.col("number").alias("node"), "lo", "hi"))]
    parent = F.floor(F.col("node") / FANOUT).cast("long")
    nodes = levels[0].count()
    while nodes > 1:
        low, high = (F.array(*[f(F.col(c)[i]) for i in range(dims)]).alias(c) for f, c in ((F.min, "lo"), (F.max, "hi")))
        levels.append(keep_on_disk(levels[-1].groupBy(parent.alias("node")).agg(low, high)))
        nodes = -(-nodes // FANOUT)
    pairs = levels[-1].select(F.col("node").alias("a"), F.col("node").alias("b"))
    for level in reversed(levels[:-1]):
        a, b = (level.select(parent.alias(s), F.col("node").alias(f"n{s}"), F.col("lo").alias(f"lo_{s}"), F.col("hi").alias(f"hi_{s}")) for s in "ab")
        met = pairs.join(a, "a").join(b, "b").where("na <= nb")
        pairs = keep_on_disk(met.where(_box_apart("a", "b") <= (eps + SLACK) ** 2).select(F.col("na").alias("a"), F.col("nb").alias("b")))
    return pairs


Node = tuple[int, int, np.ndarray, np.ndarray]


class Boxes:
    """Bounding boxes of the halves of a sequence, each worked out once."""

    def __init__(self, rows: np.ndarray) -> None:
        self.rows, self.known = rows, {}

    def node(self, start: int, end: int) -> Node:
        if (start, end) not in self.known:
            part = self.rows[start:end]
            self.known[start, end] = (start, end, part.min(axis=0), part.max(axis=0))
        return self.known[start, end]

    def halves(self, node: Node) -> list[Node]:
        start, end = node[:2]
        if end - start <= LEAF:
            return [node]
        half = start + -(-(end - start) // (2 * LEAF)) * LEAF
        return [self.node(start, half), self.node(half, end)]


def leaf_pairs(x: np.ndarray, y: np.ndarray, eps: float) -> Iterator[tuple[slice, slice]]:
    """Recursive sequence join of two intervals (``y is x``: of one with itself, each pair once).

    Gives the pairs of leaf slices whose boxes are within ``eps``."""
    own = y is x
    left = Boxes(x)
    right = left if own else Boxes(y)
    stack = [(left.node(0, len(x)), right.node(0, len(y)))]
    while stack:
        p, q = stack.pop()
        (a, b, lo, hi), (c, d, lo2, hi2) = p, q
        gap = np.maximum(0.0, np.maximum(lo - hi2, lo2 - hi))
        if gap @ gap > (eps + SLACK) ** 2 or (own and d <= a):
            continue
        if b - a <= LEAF and d - c <= LEAF:
            yield slice(a, b), slice(c, d)
            continue
        stack.extend((f, g) for f in left.halves(p) for g in right.halves(q))


def _runs(x: np.ndarray, y: np.ndarray, eps: float) -> Iterator[tuple[slice, slice]]:
    """The leaf pairs with neighbouring leaves of ``y`` taken together."""
    met: dict[tuple[int, int], list[slice]] = {}
    for p, q in leaf_pairs(x, y, eps):
        met.setdefault((p.start, p.stop), []).append(q)
    for (start, stop), leaves in met.items():
        leaves.sort(key=lambda q: q.start)
        first = leaves[0]
        for q in leaves[1:]:
            if q.start == first.stop:
                first = slice(first.start, q.stop)
            else:
                yield slice(start, stop), first
                first = q
        yield slice(start, stop), first


def _partial(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows a, b such that ``a @ b.T`` are squared distances in the leading dimensions."""
    lead = r[:, :PART_DIMS]
    square, one = (lead * lead).sum(axis=1, keepdims=True), np.ones((len(r), 1))
    return tuple(np.hstack(c).astype(np.float32) for c in ((lead, square, one), (-2 * lead, one, square)))


def _hits(u: np.ndarray, v: np.ndarray, near: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """The pairs marked in ``near`` whose cosine, in double precision, reaches ``cosine``."""
    at = np.flatnonzero(near)
    if 8 * len(at) > near.size:
        at = np.flatnonzero(near & (u @ v.T >= cosine))
        return at // len(v), at % len(v)
    i, j = at // len(v), at % len(v)
    hit = np.concatenate([np.zeros(0, dtype=bool), *[np.einsum("ij,ij->i", u[i[s : s + GATHER]], v[j[s : s + GATHER]]) >= cosine for s in range(0, len(at), GATHER)]])
    return i[hit], j[hit]


def join_intervals(x, y, rotation: np.ndarray, cosine: float, eps: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links between two intervals (``y is x``: inside one), each (entry ids, copies, unit vectors).

    Returns per linked entry: its id, the id that stands for its piece, and the
    number of copies it links with."""
    own = y is x
    ids_x, copies_x, ux = x
    ids_y, copies_y, uy = y
    rx = ux @ rotation
    ry = rx if own else uy @ rotation
    shift = 0 if own else len(ux)
    count = np.zeros(shift + len(uy), dtype=np.int64)
    root = np.arange(len(count))
    # what single precision may get wrong is far below the room given
    left, right = _partial(rx)[0], _partial(ry)[1]
    reach = np.float32((eps + SLACK) ** 2 + PART_ROOM)

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for p, q in _runs(rx, ry, eps):
        near = left[p] @ right[q].T <= reach
        if own:
            # each pair once, from its earlier entry
            near &= np.arange(q.start, q.stop)[None, :] > np.arange(p.start, p.stop)[:, None]
        i, j = _hits(ux[p], uy[q], near, cosine)
        if not len(i):
            continue
        i, j = i + p.start, j + q.start
        count += np.bincount(i, copies_y[j], len(count)).astype(np.int64)
        count += np.bincount(j + shift, copies_x[i], len(count)).astype(np.int64)
        starts = np.flatnonzero(np.diff(i, prepend=-1))
        for first, end in zip(starts, [*starts[1:], len(i)]):
            here = find(int(i[first]))
            for o in np.unique(root[shift + j[first:end]]):
                there = find(int(o))
                if there != here:
                    root[max(there, here)] = min(there, here)
                    here = min(there, here)
    ids = ids_x if own else np.concatenate([ids_x, ids_y])
    linked = np.flatnonzero(count)
    top = np.array([find(int(i)) for i in linked], dtype=np.int64)
    return ids[linked], ids[top], count[linked]


def _linked_entries(entries: DataFrame, width: int, cosine: float, eps: float) -> DataFrame:
    """(entry, top, links) of the pairs of intervals of entries of one length, on disk."""
    rotation = _rotation(entries, width)
    intervals = keep_on_disk(_intervals(entries, width, rotation, eps))
    pairs = _near_intervals(intervals, min(BOX_DIMS, width), eps)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def side(batch: pa.RecordBatch, i: int, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            ids, copies = (np.frombuffer(batch.column(at + c)[i].as_buffer(), dtype=np.int64) for c in (0, 1))
            return ids, copies, np.frombuffer(batch.column(at + 2)[i].as_buffer(), dtype=np.float64).reshape(-1, width)

        for batch in batches:
            for i in range(batch.num_rows):
                x = side(batch, i, 2)
                y = x if batch.column(0)[i] == batch.column(1)[i] else side(batch, i, 5)
                found = join_intervals(x, y, rotation, cosine, eps)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["entry", "top", "links"])

    a, b = (intervals.select(F.col("number").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("ids", "copies", "rows")]) for s in "ab")
    met = pairs.join(a, "a").join(b, "b").select("a", "b", *[f"{c}_{s}" for s in "ab" for c in ("ids", "copies", "rows")])
    return keep_on_disk(met.mapInArrow(meet, "entry bigint, top bigint, links bigint"))


def near_duplicates(vectors: DataFrame, cosine: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept (vec_id = component_id) for every row of ``vectors``."""
    small_batches(vectors.sparkSession)
    eps = float(np.sqrt(2 - 2 * cosine))
    v = vectors[vector_col]
    key = [F.when(_usable(v), h).alias(c) for c, h in (("h1", F.xxhash64(v)), ("h2", F.xxhash64(F.lit(1), v)))]
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), v.alias("vector"), *key)
    # equal vectors, told by 128 bits of hash, are one entry
    grouped = rows.where("h1 is not null").groupBy("h1", "h2").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector")
    )
    grouped = keep_on_disk(grouped.withColumn("entry", F.monotonically_increasing_id()))
    entries, found = grouped, None
    for row in grouped.groupBy(F.size("vector").alias("width")).count().orderBy("width").collect():
        of_width = _linked_entries(grouped.where(F.size("vector") == row["width"]), row["width"], cosine, eps)
        found = of_width if found is None else found.unionByName(of_width)
    if found is None:
        found = grouped.select("entry", F.col("entry").alias("top"), F.col("copies").alias("links"))

    links = found.groupBy("entry").agg(F.sum("links").alias("links"))
    pieces = components(found.select("entry", "top")).withColumnRenamed("node", "entry")
    placed = entries.select("entry", "h1", "h2", "rep", "copies").join(pieces, "entry", "left").withColumn("piece", F.coalesce("component", "entry"))
    least = placed.groupBy("piece").agg(F.min("rep").alias("component_id"))
    known = placed.join(least, "piece").join(links, "entry", "left").select(
        "h1", "h2", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    own = F.coalesce("component_id", "vec_id")
    return rows.select("vec_id", "h1", "h2").join(known, ["h1", "h2"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        own.alias("component_id"),
        F.coalesce(F.col("vec_id") == own, F.lit(False)).alias("kept"),
    )
