"""Exact self-join of word-shingle sets by Jaccard similarity, with set-relation skipping.

A document's set is its distinct ``k``-word shingles (the whole word sequence
when it is shorter). Two documents link when
``100 * |intersection| >= percent * |union|``; the result names each
document's connected component.

1. *Order.* Shingles are ordered rarest first. One pass counts all shingles of
   the corpus into ``SLOTS`` hashed slots (a table of fixed size); shingles of
   overfull slots sort last, by load. Any order gives the same links; this one
   keeps common passages out of the lists below.
2. *Sets.* Equal sets collapse to their smallest document id. A set of ``n``
   shingles that links with another shares at least one of the first
   ``n - ceil(percent * n / 100) + 1`` shingles with it, so only that prefix is
   indexed.
3. *Answers first from similar sets.* Sets that share two of their ``LEAD``
   shingles of least hash (very similar sets mostly do) are compared with
   their neighbours in a size-sorted list; the links found give a first
   partition into components.
4. *Block-skipping join.* The full prefix index is cut into blocks sorted by
   component and size, each posting with its position. A set takes over the
   answers of the sets it is already joined with: pairs inside one component
   are skipped, whole blocks of one component at once. The other pairs pass a
   size test and position tests (the shingle stands in the shorter prefix that
   two sets of these sizes need, and enough shingles are left after it), then a
   count of common prefix shingles, and are then verified on the whole sets.

Verification re-reads only the texts of candidate documents. Shingles are
64-bit hashes of which 58 bits are compared; unequal shingles agree with
probability about 2^-58.

Defined results: null, empty and blank texts have ``n_shingles`` 0 and link
with nothing; a null doc_id gets its set size and a null component; rows that
repeat a doc_id are one node holding the links of all its texts.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import deque
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cxlake.llm import wordhash as W
from cxlake.llm.shared import components, keep_on_disk, release_shuffles, small_batches

SLOT_BITS, CHUNK_BITS, LEVEL_SHIFT = 22, 13, 58
SLOTS = 1 << SLOT_BITS
LEAD, NEAR, RUN, BLOCK = 4, 64, 2000, 2048
HASH = np.uint64((1 << LEVEL_SHIFT) - 1)
MARKS = 1 << 25
PAIRS = 1 << 16  # a batch of candidate pairs goes out when it has so many


def shingles(column: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each slice of a text column: (first row, shingle hashes, first hash of each row, n + 1 long)."""
    for t in W.slices(column):
        starts, ends, first = t.words()
        hashes = W.span_hashes(t.buf, starts, ends, W.FOLDED)
        grams, _, owner = W.windows(hashes, first, k)
        size = np.diff(first)
        short = np.flatnonzero((size > 0) & (size < k))
        if len(short):  # the whole sequence is the one shingle
            whole = np.array([_sequence(hashes[first[i] : first[i + 1]]) for i in short], dtype=np.uint64)
            owner = np.concatenate([owner, short])
            grams = np.concatenate([grams, whole])
            order = np.argsort(owner, kind="stable")
            grams, owner = grams[order], owner[order]
        yield t.first, grams, np.searchsorted(owner, np.arange(t.rows + 1))


def _sequence(words: np.ndarray) -> int:
    total = np.array([len(words)], dtype=np.uint64)
    for w in words:
        total = W.mix64(total * np.uint64(0x9FB21C651E98DF25) + w)
    return int(total[0])


def slot_loads(docs: DataFrame, k: int) -> np.ndarray:
    """Shingle occurrences of all documents per hash slot (a fixed-size table, summed on the executors)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        load, held, size = np.zeros(SLOTS, dtype=np.int32), [], 0

        def add_held() -> None:
            nonlocal held, size
            if held:
                slots, n = np.unique(np.concatenate(held), return_counts=True)
                load[slots] += n.astype(np.int32)
            held, size = [], 0

        for batch in batches:
            for _, grams, _ in shingles(batch.column(0), k):
                held.append((grams >> np.uint64(64 - SLOT_BITS)).astype(np.int32))
                size += len(grams)
                if size > 1 << 20:
                    add_held()
        add_held()
        parts = load.reshape(-1, 1 << CHUNK_BITS)
        used = np.flatnonzero(parts.any(axis=1))
        for a in range(0, len(used), 64):
            some = used[a : a + 64]
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array([zlib.compress(parts[i].tobytes(), 1) for i in some], pa.binary())], ["part", "load"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, load in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                row = np.frombuffer(zlib.decompress(load.as_py()), dtype=np.int32)
                sums[part] = sums[part] + row if part in sums else row.astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([zlib.compress(v.tobytes(), 1) for v in sums.values()], pa.binary())], ["part", "load"])

    counted = docs.select(docs["text"]).mapInArrow(count, "part int, load binary")
    total = np.zeros((SLOTS >> CHUNK_BITS, 1 << CHUNK_BITS), dtype=np.int64)
    for row in counted.repartition("part").mapInArrow(add, "part int, load binary").collect():  # SLOTS longs at most
        total[row["part"]] += np.frombuffer(zlib.decompress(bytes(row["load"])), dtype=np.int64)
    return total.reshape(-1)


def slot_levels(load: np.ndarray) -> np.ndarray:
    """0 for ordinary slots; for slots far above the mean, the bits of their excess (at most 63)."""
    mean = load.mean()
    excess = np.maximum(load - (mean + 6 * np.sqrt(mean) + 16), 0)
    return np.minimum(np.ceil(np.log2(excess + 1)), 63).astype(np.uint8)


def ordered_set(grams: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Distinct shingles as sorted keys: slot level on top, hash below."""
    level = levels[(grams >> np.uint64(64 - SLOT_BITS)).astype(np.int64)].astype(np.uint64)
    keys = np.sort((level << np.uint64(LEVEL_SHIFT)) | (grams >> np.uint64(64 - LEVEL_SHIFT)))
    if len(keys) > 1:
        keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
    return keys


def prefix_size(n, percent: int):
    """First shingles of a set of ``n`` that must meet any set it links with."""
    return n - -(-percent * n // 100) + 1


def least_overlap(n, m, percent: int):
    """Smallest intersection of sets of sizes ``n`` and ``m`` that link."""
    return -(-percent * (n + m) // (100 + percent))


def _sets(docs: DataFrame, k: int, levels: np.ndarray, percent: int) -> DataFrame:
    """doc_id, n, digest of the set, its prefix, and its ``LEAD`` shingles of least hash (binary, 8 bytes a shingle)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, digest, prefix, lead = np.zeros(batch.num_rows, dtype=np.int32), *([None] * batch.num_rows for _ in range(3))
            for at, grams, first in shingles(batch.column(1), k):
                for i in range(len(first) - 1):
                    if first[i + 1] > first[i]:
                        keys = ordered_set(grams[first[i] : first[i + 1]], levels)
                        n[at + i] = len(keys)
                        digest[at + i] = hashlib.blake2b(keys.tobytes(), digest_size=16).digest()
                        prefix[at + i] = keys[: prefix_size(len(keys), percent)].tobytes()
                        lead[at + i] = np.sort(keys & HASH)[:LEAD].tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), *[pa.array(c, pa.binary()) for c in (digest, prefix, lead)]], ["doc_id", "n", "digest", "prefix", "lead"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).mapInArrow(run, "doc_id bigint, n int, digest binary, prefix binary, lead binary")


def _marks(ids: DataFrame) -> np.ndarray:
    """A bitmap of ``MARKS`` bits (a fixed size) that has the hashes of the ids set."""
    slot = F.pmod(F.xxhash64("id"), F.lit(MARKS)) + 1  # Spark's bitmaps count from 1
    parts = ids.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")
    )
    found = np.zeros(MARKS, dtype=bool)
    for row in parts.collect():
        bits = np.unpackbits(np.frombuffer(bytes(row["bits"]), dtype=np.uint8), bitorder="little")
        found[(row["part"] - 1) * len(bits) + np.flatnonzero(bits)] = True
    return np.packbits(found, bitorder="little")


def _whole_sets(docs: DataFrame, ids: DataFrame, k: int, levels: np.ndarray) -> DataFrame:
    """(id, keys): the whole sets of the listed documents (and of few others), from their texts.

    The texts stay where they are read: a bitmap of fixed size tells which to take."""
    marks = _marks(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = batch.column(2).to_numpy()
            batch = batch.filter(pa.array((marks[slot >> 3] >> (slot & 7) & 1).astype(bool)))
            keys = [b""] * batch.num_rows
            for at, grams, first in shingles(batch.column(1), k):
                for i in range(len(first) - 1):
                    keys[at + i] = ordered_set(grams[first[i] : first[i + 1]], levels).tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary())], ["id", "keys"])

    texts = docs.select(docs["doc_id"].cast("long").alias("id"), docs["text"].alias("text")).where("id is not null")
    return texts.select("id", "text", F.pmod(F.xxhash64("id"), F.lit(MARKS)).alias("slot")).mapInArrow(run, "id bigint, keys binary")


def links(p: np.ndarray, q: np.ndarray, percent: int) -> bool:
    """Whether two ordered sets reach the similarity."""
    if 100 * min(len(p), len(q)) < percent * max(len(p), len(q)):
        return False
    both = np.sort(np.concatenate([p, q]))
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(p) + len(q) - common)


def _set_of(value: pa.Scalar) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), dtype=np.uint64)


def _linked(docs: DataFrame, pairs: DataFrame, k: int, levels: np.ndarray, percent: int) -> DataFrame:
    """The pairs (x, y) of documents whose whole sets link."""
    ids = pairs.select(F.col("x").alias("id")).unionByName(pairs.select(F.col("y").alias("id")))
    sets = _whole_sets(docs, ids, k, levels)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(2), batch.column(3)
            keep = pa.array([links(_set_of(a[i]), _set_of(b[i]), percent) for i in range(batch.num_rows)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["x", "y"])

    left = sets.select(F.col("id").alias("x"), F.col("keys").alias("keys_x"))
    right = sets.select(F.col("id").alias("y"), F.col("keys").alias("keys_y"))
    return pairs.join(left, "x").join(right, "y").select("x", "y", "keys_x", "keys_y").mapInArrow(check, "x bigint, y bigint")


def _lead_keys(lead: np.ndarray) -> np.ndarray:
    """A key for each pair of the lead shingles (for the one there is, if no more)."""
    pairs = list(combinations(range(len(lead)), 2)) or [(0, 0)]
    a, b = (lead[[p[c] for p in pairs]] for c in (0, 1))
    return W.mix64(a * np.uint64(0x9FB21C651E98DF25) + b).view(np.int64)


def _first_links(docs: DataFrame, reps: DataFrame, k: int, levels: np.ndarray, percent: int) -> DataFrame:
    """Links (x, y) between neighbours in size-sorted lists of sets that share two of their ``LEAD`` shingles of least hash.

    A set is compared with the ``NEAR`` sets before it in its list, but for
    those it has been joined with already. Long lists are dealt at random to
    runs of about ``RUN`` sets; the lists of a set's other pairs are dealt
    differently, which joins the runs of a large group."""

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = [_lead_keys(np.frombuffer(v.as_buffer(), dtype=np.uint64)) for v in batch.column(2)]
            size = [len(h) for h in first]
            tokens = np.concatenate(first) if first else np.zeros(0, dtype=np.int64)
            n = np.repeat(batch.column(1).to_numpy(), size)
            # sizes in steps of the similarity; the steps of different shingles are set off against each other
            step = np.floor(np.log(n) / np.log(100 / min(percent, 99)) + tokens % 3 / 3).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(tokens), pa.array(step), pa.array(np.repeat(batch.column(0).to_numpy(), size))], ["token", "step", "id"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, recent, root = None, deque(maxlen=NEAR), {}

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for batch in batches:
            x, y = [], []
            token, part, ids = (batch.column(c).to_pylist() for c in (0, 1, 2))
            for i in range(batch.num_rows):
                if (token[i], part[i]) != run:
                    run, root = (token[i], part[i]), {}
                    recent.clear()
                # a copy: the batch's memory goes when the next batch comes
                own = _set_of(batch.column(3)[i]).copy()
                root.setdefault(ids[i], ids[i])
                for other, keys in reversed(recent):
                    a, b = find(ids[i]), find(other)
                    if a != b and links(own, keys, percent):
                        root[max(a, b)] = min(a, b)
                        x.append(ids[i])
                        y.append(other)
                recent.append((ids[i], own))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["x", "y"])

    lists = reps.select("doc_id", "n", "lead").mapInArrow(heads, "token bigint, step int, id bigint")
    shared = lists.groupBy("token", "step").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    part = F.pmod(F.xxhash64("id", "token"), F.ceil(F.col("m") / RUN)).cast("int")
    dealt = keep_on_disk(lists.join(shared, ["token", "step"]).select("token", (F.col("step").cast("long") * (1 << 32) + part).alias("part"), "id"))
    sets = _whole_sets(docs, dealt.select("id"), k, levels)
    runs = dealt.join(sets, "id").select("token", "part", "id", "keys").repartition("token", "part")
    return runs.sortWithinPartitions("token", "part", F.length("keys"), "id").mapInArrow(compare, "x bigint, y bigint")


def _blocks(reps: DataFrame) -> DataFrame:
    """Index lists as blocks of at most ``BLOCK`` postings sorted by component and size.

    A list of an overfull slot is dealt to several tasks by the set's component
    and size. Lists of one posting are left out."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads = [np.frombuffer(v.as_buffer(), dtype=np.int64) for v in batch.column(3)]
            size = np.array([len(h) for h in heads], dtype=np.int64)
            for a in range(0, len(heads), 256):
                part, width = heads[a : a + 256], size[a : a + 256]
                tokens = np.concatenate(part)
                pos = np.arange(len(tokens)) - np.repeat(np.cumsum(width) - width, width)
                salt = np.where((tokens >> LEVEL_SHIFT) & 63 > 0, 1, 0)
                ids, comps, n = (batch.column(c).to_numpy()[a : a + 256] for c in (0, 1, 2))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tokens), pa.array(np.repeat(comps, width)), pa.array(np.repeat(n, width)), pa.array(pos.astype(np.int32)), pa.array(np.repeat(ids, width)), pa.array(salt.astype(np.int32))],
                    ["token", "comp", "n", "pos", "x", "common"],
                )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        begun = None  # the list of which blocks have gone out already
        for batch in batches:
            rows = np.empty((batch.num_rows, 5), dtype=np.int64)
            for c in range(5):
                rows[:, c] = batch.column(c).to_numpy()
            held.append(rows)
            if sum(len(h) for h in held) >= 8 * BLOCK:
                rows = np.concatenate(held)
                # the last list may go on in the next batch; if it alone fills the buffer, whole blocks go out
                last = int(np.flatnonzero(rows[:, 0] == rows[-1, 0])[0])
                if last == 0:
                    last, begun = (len(rows) - 2) // BLOCK * BLOCK, rows[-1, 0]
                    yield _pack(rows[:last], True)
                else:
                    old = int(np.count_nonzero(rows[:last, 0] == begun)) if begun is not None else 0
                    yield _pack(rows[:old], True)
                    yield _pack(rows[old:last], False)
                    begun = begun if rows[-1, 0] == begun else None
                held = [rows[last:]]
        if held:
            rows = np.concatenate(held)
            old = int(np.count_nonzero(rows[:, 0] == begun)) if begun is not None else 0
            yield _pack(rows[:old], True)
            yield _pack(rows[old:], False)

    lists = reps.select("doc_id", "comp", "n", "prefix").mapInArrow(explode, "token bigint, comp bigint, n int, pos int, x bigint, common int")
    dealt = F.when(F.col("common") > 0, F.pmod(F.xxhash64("comp", "n"), F.lit(64))).otherwise(0)
    return lists.repartition("token", dealt).sortWithinPartitions("token", "comp", "n").mapInArrow(
        cut, "token bigint, lo int, hi int, comp bigint, more boolean, members binary, rows binary"
    )


def _pack(rows: np.ndarray, long: bool) -> pa.RecordBatch:
    """Sorted postings (token, comp, n, pos, x) -> block rows.

    ``comp`` is null unless the block has one component; ``more``: the list may
    have other blocks (``long``: it is known to); ``members``: digest of its sets.
    Blocks that can give no pair are left out."""
    token, lo, hi, comp, more, members, data = [], [], [], [], [], [], []
    edges = np.flatnonzero(np.concatenate([[True], rows[1:, 0] != rows[:-1, 0], [True]])) if len(rows) else np.zeros(0, dtype=np.int64)
    size = np.diff(edges)
    for a, m in zip(edges[:-1].tolist(), size.tolist(), strict=True):
        others = long or m > BLOCK or bool((rows[a, 0] >> LEVEL_SHIFT) & 63)
        if not others and (m == 1 or rows[a, 1] == rows[a + m - 1, 1]):
            continue
        for s in range(a, a + m, BLOCK):
            part = rows[s : min(s + BLOCK, a + m)]
            token.append(int(part[0, 0]))
            lo.append(int(part[:, 2].min()))
            hi.append(int(part[:, 2].max()))
            comp.append(int(part[0, 1]) if part[0, 1] == part[-1, 1] else None)
            more.append(others)
            members.append(hashlib.blake2b(np.ascontiguousarray(part[:, 4]).tobytes(), digest_size=16).digest())
            data.append(np.ascontiguousarray(part[:, 1:]).tobytes())
    return pa.RecordBatch.from_arrays(
        [pa.array(token, pa.int64()), pa.array(lo, pa.int32()), pa.array(hi, pa.int32()), pa.array(comp, pa.int64()), pa.array(more, pa.bool_()), pa.array(members, pa.binary()), pa.array(data, pa.binary())],
        ["token", "lo", "hi", "comp", "more", "members", "rows"],
    )


def block_pairs(a: np.ndarray, b: np.ndarray, percent: int, inner: bool) -> Iterator[np.ndarray]:
    """Pairs (x, y) of documents x < y from the postings (comp, n, pos, x) of two blocks of a list that may
    link through it, a posting of ``a`` at a time.

    Sets of sizes n and m with an overlap of ``need`` or more share one of the
    first ``n - need + 1`` shingles of the one and ``m - need + 1`` of the other."""
    for i in range(len(a)):
        c, n, pos, x = a[i]
        other = b[i + 1 :] if inner else b
        m, at = other[:, 1], other[:, 2]
        need = least_overlap(n, m, percent)
        bound = np.minimum(pos, at) + np.minimum(n - pos, m - at)
        hit = (other[:, 0] != c) & (100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & (pos <= n - need) & (at <= m - need) & (bound >= need)
        y = other[hit & (other[:, 3] != x), 3]
        if len(y):
            yield np.column_stack([np.minimum(x, y), np.maximum(x, y)])


def pair_batches(found: Iterable[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The pairs as batches of about ``PAIRS``: two blocks can give millions, which neither a worker nor an executor need hold at once."""
    held: list[np.ndarray] = []
    size = 0
    for pairs in found:
        held.append(pairs)
        size += len(pairs)
        if size >= PAIRS:
            out = np.concatenate(held)
            held, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1])], ["x", "y"])
    if held:
        out = np.concatenate(held)
        yield pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1])], ["x", "y"])


def enough_in_prefix(n: int, m: int, p: np.ndarray, q: np.ndarray, percent: int) -> bool:
    """Whether the prefixes p and q of sets of sizes n and m share as many shingles as linked sets must.

    Of the two prefixes, the one that ends at the smaller shingle holds all
    common ones up to there, and what is behind it can't make up for more than
    its rest."""
    both = np.sort(np.concatenate([p, q]))
    common = int((both[1:] == both[:-1]).sum())
    need = least_overlap(n, m, percent)
    ends_first = (n, len(p)) if p[-1] <= q[-1] else (m, len(q))
    return common >= need - (ends_first[0] - ends_first[1])


def _cross_pairs(blocks: DataFrame, indexed: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (x, y) between components, from single blocks and from pairs of blocks of a list."""
    names, schema = ["x", "y"], "x bigint, y bigint"

    def postings(value: pa.Scalar) -> np.ndarray:
        return np.frombuffer(value.as_buffer(), dtype=np.int64).reshape(-1, 4)

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from pair_batches(p for r in map(postings, batch.column(0)) for p in block_pairs(r, r, percent, True))

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(map(postings, batch.column(0)), map(postings, batch.column(1)), strict=True)
            yield from pair_batches(p for v, w in both for p in block_pairs(v, w, percent, False))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m, p, q = (batch.column(c) for c in range(2, 6))
            keep = pa.array([enough_in_prefix(n[i].as_py(), m[i].as_py(), _set_of(p[i]), _set_of(q[i]), percent) for i in range(batch.num_rows)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names)

    mixed = blocks.where("comp is null")
    # lists of the same sets (those of a passage that they share) answer alike:
    # the first shingle's list has the best positions of all
    first = F.min_by("rows", F.col("token").bitwiseXOR(F.lit(-(1 << 63))))
    alone = mixed.where("not more").groupBy("members").agg(first.alias("rows")).select("rows")
    single = alone.unionByName(mixed.where("more").select("rows")).mapInArrow(within, schema)
    # lists with more than one block: skip pairs of blocks of one component, or too far apart in size
    numbered = blocks.where("more").withColumn("block", F.xxhash64("rows"))
    a, b = (numbered.select("token", *[F.col(c).alias(f"{c}_{s}") for c in ("lo", "hi", "comp", "block", "rows")]) for s in "ab")
    apart = a.join(b, "token").where(
        (F.col("block_a") < F.col("block_b"))
        & ~F.coalesce(F.col("comp_a") == F.col("comp_b"), F.lit(False))
        & (100 * F.col("hi_a") >= percent * F.col("lo_b"))
        & (100 * F.col("hi_b") >= percent * F.col("lo_a"))
    )
    several = apart.select("rows_a", "rows_b").mapInArrow(between, schema)
    met = keep_on_disk(single.unionByName(several).distinct())
    release_shuffles(met.sparkSession)
    named = met.select(F.col("x").alias("id")).unionByName(met.select(F.col("y").alias("id")))
    heads = _by_marks(indexed.select("doc_id", "n", "prefix"), _marks(named), True)
    left, right = (heads.select(F.col("doc_id").alias(s), F.col("n").alias(f"n_{s}"), F.col("prefix").alias(f"prefix_{s}")) for s in names)
    return met.join(left, "x").join(right, "y").select("x", "y", "n_x", "n_y", "prefix_x", "prefix_y").mapInArrow(check, schema).distinct()


def jaccard_components(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest linked doc_id) for every row of ``docs``."""
    small_batches(docs.sparkSession)
    levels = slot_levels(slot_loads(docs, k))
    sets = keep_on_disk(_sets(docs, k, levels, percent))
    usable = sets.where("n > 0 and doc_id is not null")
    classes = usable.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    member = usable.select("doc_id", "digest", "n", "lead").join(classes, "digest")
    same = member.where("doc_id <> rep").select(F.col("doc_id").alias("x"), F.col("rep").alias("y"))
    reps = keep_on_disk(member.where("doc_id = rep").drop("rep"))

    first = keep_on_disk(_first_links(docs, reps, k, levels, percent))
    known = components(first)
    release_shuffles(docs.sparkSession)
    placed = reps.join(known, reps["doc_id"] == known["node"], "left").select("doc_id", "digest", F.coalesce("component", "doc_id").alias("comp"))
    indexed = usable.select("doc_id", "digest", "n", "prefix").join(placed.distinct(), ["doc_id", "digest"])
    blocks = keep_on_disk(_blocks(indexed))
    release_shuffles(docs.sparkSession)
    cross = keep_on_disk(_cross_pairs(blocks, usable, percent))
    release_shuffles(docs.sparkSession)
    second = _linked(docs, cross, k, levels, percent)
    found = components(first.unionByName(second).unionByName(same))
    release_shuffles(docs.sparkSession)
    out = sets.select("doc_id", F.col("n").cast("long").alias("n_shingles"))
    return out.join(found, out["doc_id"] == found["node"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )


def _by_marks(docs: DataFrame, marks: np.ndarray, marked: bool, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id is in the bitmap (``marked``), or is not."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = batch.column(batch.num_columns - 1).to_numpy()
            hit = (marks[slot >> 3] >> (slot & 7) & 1).astype(bool)
            out = batch.filter(pa.array(hit if marked else ~hit))
            yield pa.RecordBatch.from_arrays(out.columns[:-1], names)

    names = docs.columns
    slot = F.pmod(F.xxhash64(F.col(id_col).cast("long")), F.lit(MARKS))
    return docs.where(F.col(id_col).isNotNull()).withColumn("_slot", slot).mapInArrow(run, docs.schema)


def _text_ids(docs: DataFrame) -> DataFrame:
    """``docs`` plus ``_id``: the doc_id, or a number above all doc_ids for every further text of a doc_id.

    Only rows whose doc_id has unlike texts (told by a bitmap of such ids) are shuffled, and only if there are
    any do texts go through Python here: the result is then kept on disk, so that later steps, which read
    it several times, need no second Python worker a task. Texts are told apart by 128 bits of hash."""
    text = F.coalesce("text", F.lit(""))
    hashes = [F.xxhash64(text).alias("_h1"), F.xxhash64(F.lit(1), text).alias("_h2")]
    told = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.struct(*hashes).alias("h"))
    unlike = keep_on_disk(told.groupBy("doc_id").agg(F.min("h").alias("low"), F.max("h").alias("high")).where("low <> high").select("doc_id", "low"))
    if unlike.isEmpty():
        return docs.withColumn("_id", F.col("doc_id").cast("long"))
    last = told.agg(F.max("doc_id")).first()[0]
    marks = _marks(unlike.select(F.col("doc_id").alias("id")))
    again = _by_marks(docs, marks, True).withColumns({c: h for c, h in zip(("_h1", "_h2"), hashes)})
    further = again.select(F.col("doc_id").cast("long").alias("doc_id"), F.struct("_h1", "_h2").alias("h")).join(unlike, "doc_id").where("h <> low")
    numbers = keep_on_disk(further.select("doc_id", "h").distinct().withColumn("_more", F.monotonically_increasing_id()))
    numbers = numbers.select(F.col("doc_id").alias("_doc"), F.col("h._h1").alias("_n1"), F.col("h._h2").alias("_n2"), "_more")
    same = (again["doc_id"] == numbers["_doc"]) & (again["_h1"] == numbers["_n1"]) & (again["_h2"] == numbers["_n2"])
    above = F.lit(0 if last is None else last).cast("long") + 1 + F.col("_more")
    named = again.join(numbers, same, "left").withColumn("_id", F.coalesce(above, F.col("doc_id").cast("long"))).select(*docs.columns, "_id")
    plain = _by_marks(docs, marks, False).withColumn("_id", F.col("doc_id").cast("long"))
    nameless = docs.where("doc_id is null").withColumn("_id", F.lit(None).cast("long"))
    return keep_on_disk(plain.unionByName(named).unionByName(nameless))


def representatives(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group of near duplicates: the one whose doc_id is the component's.

    Unlike texts under one doc_id are documents of their own: the text with the smallest hash
    goes by the doc_id, the others come after all doc_ids, and each goes only if it is a near
    duplicate of a text that stays. Rows that repeat doc_id and text are one document, of which
    one row stays; rows without a doc_id have no group and all stay. Only rows that may have to
    go (told by a bitmap of their ids) are shuffled; the other texts stay where they are read."""
    named = _text_ids(docs)
    found = keep_on_disk(jaccard_components(named.select(F.col("_id").alias("doc_id"), "text"), k, percent))
    others = found.where("doc_id <> component_id").select(F.col("doc_id").alias("id"))
    repeated = found.where("doc_id is not null").groupBy(F.col("doc_id").alias("id")).count().where("count > 1").select("id")
    marks = _marks(others.unionByName(repeated))
    suspects = _by_marks(named, marks, True, "_id")
    kept = suspects.join(others, suspects["_id"] == others["id"], "left_anti").dropDuplicates(["_id"])
    return _by_marks(named, marks, False, "_id").unionByName(kept).unionByName(named.where("_id is null")).drop("_id")
