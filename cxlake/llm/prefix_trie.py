"""Prefix trie of conversations, with subtree totals by time-forward processing.

Conversations are first rebuilt with shared openings: conversation c begins with
the first h turns of conversation ``c - c % 20`` (``h = crc32(c as text) % 4``; all
it has if fewer, none if it is absent) and goes on with its own turns after its
first h. Every distinct sequence of first turns is a node; the empty one is the root.

*Nodes.* A turn is a 128-bit mark of its role and text (from SHA-256) and a word
count; no shuffle carries a text. A prefix is the exclusive-or of the hashes of its
(place, mark) pairs, twice 64 bits, so a conversation of any length is handled in
blocks of ``BLOCK`` turns: running values inside a block, block totals, running
values over the totals. A parent's key is the child's with its own turn taken out.

*Members.* Counts and smallest members are reduced per (key, salt), then per key,
and joined back per (key, salt): a prefix that a third of all conversations share
never meets in one task. The row of a node's smallest member stands for the node
and learns its parent from the row before it.

*Shards.* A node is of class i when its members are at most ``SPREAD ** (i + 1)``.
Classes never fall towards the root, so a node's class and the topmost ancestor of
the same class name a unit: at most ``SPREAD`` times a conversation's length in nodes,
in every class. Units are dealt to shards.

*Time-forward processing*, class by class (their number is the logarithm of the number of
conversations). A shard's nodes are externally sorted by Spark in reverse level order and
streamed; each takes the messages addressed to it from a priority queue with
the same order and sends its totals to its parent. The queue holds ``HELD``
messages and spills sorted runs to anonymous scratch files of the task, as Spark's
own sorts do. Totals of shard roots, added up per parent, are messages to the
next classes' shards.

*Ends.* The ids of the conversations that end at a node are range-partitioned by
(node, id), packed into text blocks and streamed into SHA-256, one block at a time.

Defined results: null roles and texts are empty; turns are ordered by turn (null
first), then role and a hash of the text, repeated rows repeat the turn; rows
without conv_id belong to no conversation; an empty table gives no row; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cxlake.llm.shared import keep_on_disk, small_batches
from cxlake.operators.ranking import ordered_numbers

BLOCK, SALTS, SPREAD, HELD, RUN_STEP = 1024, 64, 256, 200_000, 1000
PACK_BYTES = 1 << 20
OPENINGS, GROUP = 4, 20
WORD = r"[^\x20\x09-\x0D]+"
KEY, PARENT = ("k1", "k2"), ("p1", "p2")
ROOT = (0, 0)


def turn_marks(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(c, at, m1, m2, words): the turns of each conversation numbered from 1, with a 128-bit mark and a word count."""
    role, text = (F.coalesce(conversations[x].cast("string"), F.lit("")) for x in (role_col, text_col))
    said = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = conversations.where(conversations[conv_col].isNotNull()).select(
        conversations[conv_col].cast("long").alias("c"),
        conversations[turn_col].alias("turn"),
        role.alias("role"),
        F.xxhash64(F.sha2(text, 256)).alias("tie"),
        F.xxhash64(said).alias("m1"),
        F.xxhash64(F.lit(1), said).alias("m2"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    return ordered_numbers(rows, ["c"], ["turn", "role", "tie"], "at").select("c", "at", "m1", "m2", "words")


def rebuilt(marks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations' ids, rebuilt turns): ids (c), turns (c, depth, m1, m2, words)."""
    shared = F.crc32(F.col("c").cast("string").cast("binary")) % OPENINGS
    marks = keep_on_disk(marks)
    ids = keep_on_disk(marks.select("c").distinct())
    base = (F.col("c") - F.col("c") % GROUP).alias("base")
    own = marks.where(F.col("at") > shared).select("c", F.lit(1).alias("part"), "at", "m1", "m2", "words")
    openings = marks.where((F.col("at") < OPENINGS) & (F.col("c") % GROUP == 0)).select(F.col("c").alias("base"), "at", "m1", "m2", "words")
    taken = ids.select("c", base, shared.alias("h")).join(openings, "base").where("at <= h").select("c", F.lit(0).alias("part"), "at", "m1", "m2", "words")
    return ids, ordered_numbers(taken.unionByName(own), ["c"], ["part", "at"], "depth").select("c", "depth", "m1", "m2", "words")


def paths(turns: DataFrame) -> DataFrame:
    """Turns with the keys of the prefixes that they end and of those before: (c, depth, block, words, k1, k2, p1, p2)."""
    own = [F.xxhash64("depth", "m1", "m2").alias("x1"), F.xxhash64("m2", "depth", "m1", F.lit(1)).alias("x2")]
    rows = turns.select("c", "depth", F.floor((F.col("depth") - 1) / BLOCK).cast("int").alias("block"), "words", *own)
    inside = Window.partitionBy("c", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("c").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("c", "block").agg(F.bit_xor("x1").alias("t1"), F.bit_xor("x2").alias("t2"))
    before = totals.select("c", "block", *[F.coalesce(F.bit_xor(f"t{i}").over(earlier), F.lit(0)).alias(f"b{i}") for i in (1, 2)])
    run = rows.select("*", *[F.bit_xor(f"x{i}").over(inside).alias(f"r{i}") for i in (1, 2)]).join(before, ["c", "block"])
    key = [F.col(f"r{i}").bitwiseXOR(F.col(f"b{i}")) for i in (1, 2)]
    parent = [key[i].bitwiseXOR(F.col(f"x{i + 1}")) for i in (0, 1)]
    return run.select("c", "depth", "block", "words", *[k.alias(n) for k, n in zip((*key, *parent), (*KEY, *PARENT))])


def class_count(members: int) -> int:
    """How many classes a trie of so many conversations has: one for each power of ``SPREAD`` up to their number."""
    classes = 1
    while SPREAD**classes < members:
        classes += 1
    return classes


def trie_nodes(path: DataFrame, root_low: int, classes: int) -> DataFrame:
    """A row per node below the root: keys, depth, n_convs, conv_id, parent_conv_id, words, cls, and its unit (top1, top2)."""
    salted = path.withColumn("salt", F.pmod(F.xxhash64("c"), F.lit(SALTS)))
    parts = salted.groupBy(*KEY, "salt").agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("low"))
    whole = Window.partitionBy(*KEY)  # SALTS rows of a node at most
    known = parts.select(*KEY, "salt", F.sum("n").over(whole).alias("n_convs"), F.min("low").over(whole).alias("low"))
    told = salted.join(known, [*KEY, "salt"]).drop("salt")
    cls = sum(((F.col("n_convs") > SPREAD**i).cast("int") for i in range(1, classes)), F.lit(0))
    told = told.withColumn("cls", cls)
    # what a block takes from those before it: the node above its first one, and the first node of each class
    key = F.struct(*KEY)
    blocks = told.groupBy("c", "block").agg(
        F.max_by("low", "depth").alias("last"), *[F.min_by(key, F.when(F.col("cls") == i, F.col("depth"))).alias(f"t{i}") for i in range(classes - 1)]
    )
    along = Window.partitionBy("c").orderBy("block")
    carried = blocks.select("c", "block", F.lag("last").over(along).alias("above"), *[F.first(f"t{i}", ignorenulls=True).over(along).alias(f"t{i}") for i in range(classes - 1)])
    inside = Window.partitionBy("c", "block").orderBy("depth")
    rows = told.withColumn("over", F.lag("low").over(inside)).join(carried, ["c", "block"]).where(F.col("c") == F.col("low"))
    # the highest class is the root's own, so its unit is the root's
    top = F.struct(*[F.lit(x).cast("long").alias(k) for x, k in zip(ROOT, KEY)])
    for i in range(classes - 1):
        top = F.when(F.col("cls") == i, F.col(f"t{i}")).otherwise(top)
    return rows.withColumn("top", top).select(
        *KEY, *PARENT, "depth", "n_convs", F.col("c").alias("conv_id"), F.coalesce("over", "above", F.lit(root_low)).alias("parent_conv_id"), "words", "cls",
        F.col("top.k1").alias("top1"), F.col("top.k2").alias("top2"),
    )


# -- time-forward processing ---------------------------------------------------------


def _runs(file) -> Iterator[tuple]:
    while True:
        try:
            yield from pickle.load(file)
        except EOFError:
            return


class MessageQueue:
    """Priority queue of tuples: the next ones in memory, the others in sorted runs on scratch files."""

    def __init__(self, held: int = HELD, most_runs: int = 64) -> None:
        self.held, self.most_runs = held, most_runs
        self.heap: list[tuple] = []
        self.heads: list[tuple] = []
        self.spilled = 0

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.held:
            self.heap.sort()
            keep = self.held // 2
            self.heap, rest = self.heap[:keep], self.heap[keep:]
            if len(self.heads) >= self.most_runs:
                runs = [_chain(first, rows) for first, _, rows in self.heads]
                self.heads = []
                self._write(heapq.merge(rest, *runs))
            else:
                self._write(iter(rest))

    def _write(self, items: Iterator[tuple]) -> None:
        file = tempfile.TemporaryFile()
        step: list[tuple] = []
        for item in items:
            step.append(item)
            if len(step) == RUN_STEP:
                pickle.dump(step, file, protocol=5)
                step = []
        pickle.dump(step, file, protocol=5)
        file.seek(0)
        rows = _runs(file)
        self.spilled += 1
        heapq.heappush(self.heads, (next(rows), self.spilled, rows))

    def take(self, key: tuple) -> Iterator[tuple]:
        """Remove and give the messages to ``key``, which must be the smallest."""
        while True:
            from_run = bool(self.heads) and (not self.heap or self.heads[0][0] < self.heap[0])
            first = self.heads[0][0] if from_run else self.heap[0] if self.heap else None
            if first is None or first[: len(key)] > key:
                return
            if first[: len(key)] < key:
                raise RuntimeError("trie: a message has no node in its shard")
            if from_run:
                _, number, rows = heapq.heappop(self.heads)
                after = next(rows, None)
                if after is not None:
                    heapq.heappush(self.heads, (after, number, rows))
            else:
                heapq.heappop(self.heap)
            yield first[len(key) :]


def _chain(first: tuple, rows: Iterator[tuple]) -> Iterator[tuple]:
    yield first
    yield from rows


TOTALS = "k1 bigint, k2 bigint, p1 bigint, p2 bigint, shard_root boolean, n_children bigint, n_leaves bigint, saved_tokens bigint"
SHARD = ("k1", "k2", "p1", "p2", "depth", "top1", "top2", "gain", "children", "leaves", "saved")


def _pass_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals of a shard's nodes, which come in reverse level order; a unit's top sends its totals out of the shard."""
    queue, out = MessageQueue(), []

    def give() -> pa.RecordBatch:
        names = [c.split()[0] for c in TOTALS.split(", ")]
        kinds = [pa.bool_() if c == "shard_root" else pa.int64() for c in names]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], names)

    for batch in batches:
        for k1, k2, p1, p2, depth, top1, top2, gain, children, leaves, saved in zip(*(c.to_pylist() for c in batch.columns)):
            saved += gain
            for more_leaves, more_saved in queue.take((-depth, k1, k2)):
                children, leaves, saved = children + 1, leaves + more_leaves, saved + more_saved
            if not children:
                leaves = 1
            root = k1 == top1 and k2 == top2
            if not root:
                queue.push((1 - depth, p1, p2, leaves, saved))
            out.append((k1, k2, p1, p2, root, children, leaves, saved))
            if len(out) >= 20_000:
                yield give()
                out.clear()
    yield give()


def subtree_totals(nodes: DataFrame, classes: int) -> DataFrame:
    """(k1, k2, n_children, n_leaves, saved_tokens) of every node, the root included."""
    done = None
    for i in range(classes):
        # the highest class holds the root, whose shard it shares
        own = nodes.where(F.col("cls") == i)
        if done is None:
            told = own.select("*", *[F.lit(0).cast("long").alias(c) for c in ("children", "leaves", "saved")])
        else:
            inbox = done.where("shard_root").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2"))
            inbox = inbox.agg(F.count(F.lit(1)).alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
            told = own.join(inbox, list(KEY), "left").fillna(0, ["children", "leaves", "saved"])
        told = told.withColumn("gain", (F.col("n_convs") - 1) * F.col("words"))
        shards = told.select(*SHARD).repartition("top1", "top2").sortWithinPartitions(F.desc("depth"), *KEY)
        found = keep_on_disk(shards.mapInArrow(_pass_up, TOTALS))
        done = found if done is None else done.unionByName(found)
    return done.select(*KEY, "n_children", "n_leaves", "saved_tokens")


# -- ends -------------------------------------------------------------------------------


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, id) rows -> blocks of joined ids: (k1, k2, first, ids)."""
    key, first, ids, size = None, 0, [], 0

    def block() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in (*key, first)] + [pa.array([",".join(ids)])], ["k1", "k2", "first", "ids"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        for k1, k2, c in zip(*(col.to_pylist() for col in batch.columns)):
            if key != (k1, k2) or size >= PACK_BYTES:
                if ids:
                    held.append(block())
                key, first, ids, size = (k1, k2), c, [], 0
            ids.append(str(c))
            size += len(ids[-1]) + 1
            if len(held) >= 1000:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held = []
    if ids:
        held.append(block())
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of ids, sorted by key and first id -> (k1, k2, ends_sha256)."""
    key, sha, out = None, None, []

    def give() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in (0, 1)] + [pa.array([r[2] for r in out], pa.string())], ["k1", "k2", "ends_sha256"])

    for batch in batches:
        for k1, k2, ids in zip(*(col.to_pylist() for col in batch.columns)):
            if key != (k1, k2):
                if sha is not None:
                    out.append((*key, sha.hexdigest()))
                key, sha = (k1, k2), hashlib.sha256(ids.encode())
            else:
                sha.update(b"," + ids.encode())
            if len(out) >= 20_000:
                yield give()
                out.clear()
    if sha is not None:
        out.append((*key, sha.hexdigest()))
    yield give()


def ends_digests(ends: DataFrame) -> DataFrame:
    """(k1, k2, c) rows -> (k1, k2, ends_sha256): SHA-256 of the ids in ascending order, comma-joined."""
    ranged = keep_on_disk(ends).repartitionByRange(*KEY, "c").sortWithinPartitions(*KEY, "c").select(*KEY, "c")
    blocks = ranged.mapInArrow(_pack, "k1 bigint, k2 bigint, first bigint, ids string")
    return blocks.repartition(*KEY).sortWithinPartitions(*KEY, "first").select(*KEY, "ids").mapInArrow(_digest, "k1 bigint, k2 bigint, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """A row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    small_batches(conversations.sparkSession)
    ids, turns = rebuilt(turn_marks(conversations))
    path = keep_on_disk(paths(turns))
    members, low = ids.agg(F.count(F.lit(1)), F.min("c")).first()
    classes = class_count(members)

    # one row, made from the ids (none in an empty table)
    root = ids.agg(F.count(F.lit(1)).alias("n_convs"), F.min("c").alias("conv_id")).where("n_convs > 0")
    nothing, zero = F.lit(None).cast("long"), F.lit(0).cast("long")
    root = root.select(
        *[F.lit(x).cast("long").alias(k) for x, k in zip(ROOT, KEY)], *[nothing.alias(p) for p in PARENT], F.lit(0).alias("depth"), "n_convs", "conv_id",
        nothing.alias("parent_conv_id"), zero.alias("words"), F.lit(classes - 1).alias("cls"), *[F.lit(x).cast("long").alias(k) for x, k in zip(ROOT, ("top1", "top2"))],
    )
    nodes = keep_on_disk(trie_nodes(path, low if low is not None else 0, classes).unionByName(root))

    last = path.groupBy("c").agg(F.max_by(F.struct(*KEY), "depth").alias("end"))
    ends = ids.join(last, "c", "left").select("c", *[F.coalesce(f"end.{k}", zero).alias(k) for k in KEY])
    out = nodes.join(subtree_totals(nodes, classes), list(KEY)).join(ends_digests(ends), list(KEY), "left")
    return out.select(
        "conv_id",
        F.col("depth").cast("long").alias("depth"),
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
