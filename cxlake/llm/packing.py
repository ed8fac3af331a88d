"""Best-fit packing of documents into training sequences, under conflicts.

A sequence (bin) holds at most ``capacity`` code points. Two pieces conflict
when they come from one source or from one duplicate cluster, and may then not
share a bin. Documents longer than a bin are cut into full pieces and a rest;
nothing is truncated or dropped (pieces of one document conflict, so they go to
different bins).

Pieces are packed longest first. Open bins stand in the order of their
residual room, each with a bitmap of its sources and one of its clusters. A
piece takes the tightest bin that has room and no conflict: the search starts
at the first bin with enough room and goes on to the next larger residual until
the bitmaps allow it; if none does, a new bin is opened.

Documents are dealt by a hash of their key into groups of about ``group_docs``
documents, which are packed on their own: work is even whatever the sources
hold, a group fits in memory, and the bins of a group are few enough to
search. A third of all rows in one source means a third of each group.

Defined results: null and empty texts give one piece of length 0 (packed like
others); null sources are one source of their own; documents without a cluster
column are clustered by equal text (128 bits of hash); empty texts do not count
as copies of each other; rows that repeat a document are pieces of their own.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY, GROUP_DOCS = 8192, 4000


def cut_pieces(docs: DataFrame, capacity: int = CAPACITY, cluster_col: str | None = None) -> DataFrame:
    """doc_id, source, cluster, piece, start, length: every document as pieces of at most ``capacity`` code points."""
    text = F.coalesce(docs["text"], F.lit(""))
    cluster = docs[cluster_col].cast("string") if cluster_col else F.when(F.length(text) > 0, F.concat_ws(":", F.xxhash64(text), F.xxhash64(F.lit(1), text)))
    sized = docs.select(docs["doc_id"], F.coalesce(docs["source"].cast("string"), F.lit("")).alias("source"), cluster.alias("cluster"), F.char_length(text).alias("_n"))
    last = F.greatest(F.ceil(F.col("_n") / capacity).cast("int") - 1, F.lit(0))
    pieces = sized.select("*", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    start = (F.col("piece") * capacity).cast("long")
    return pieces.select(
        "doc_id", "source", "cluster", "piece", start.alias("start"), F.least(F.lit(capacity), F.col("_n") - start).cast("int").alias("length")
    )


def best_fit(lengths: list[int], sources: list, clusters: list, capacity: int) -> list[tuple[int, int]]:
    """(bin, offset in the bin) of each piece, in the given order.

    ``None`` as a cluster conflicts with nothing."""
    source_bit = {s: 1 << i for i, s in enumerate(dict.fromkeys(sources))}
    cluster_bit: dict = {}
    seen: dict = {}
    for c in clusters:  # only clusters that occur twice need a bit
        seen[c] = seen.get(c, 0) + 1
    for c, n in seen.items():
        if c is not None and n > 1:
            cluster_bit[c] = 1 << len(cluster_bit)
    smallest = min(lengths, default=0)
    open_bins: list[tuple[int, int]] = []  # (residual, bin), ascending
    held_sources: list[int] = []
    held_clusters: list[int] = []
    residual: list[int] = []
    every_source = (1 << len(source_bit)) - 1
    placed = []
    for length, source, cluster in zip(lengths, sources, clusters, strict=True):
        sbit, cbit = source_bit[source], cluster_bit.get(cluster, 0)
        at = bisect_left(open_bins, (length, -1))
        while at < len(open_bins):
            b = open_bins[at][1]
            if not (held_sources[b] & sbit or held_clusters[b] & cbit):
                break
            at += 1
        if at < len(open_bins):
            b = open_bins.pop(at)[1]
        else:
            b = len(residual)
            residual.append(capacity)
            held_sources.append(0)
            held_clusters.append(0)
        placed.append((b, capacity - residual[b]))
        residual[b] -= length
        held_sources[b] |= sbit
        held_clusters[b] |= cbit
        # a bin that no further piece can enter is closed
        if residual[b] >= smallest and held_sources[b] != every_source:
            insort(open_bins, (residual[b], b))
    return placed


def pack(docs: DataFrame, capacity: int = CAPACITY, group_docs: int = GROUP_DOCS, cluster_col: str | None = None) -> DataFrame:
    """One row per piece: bin_id, doc_id, piece, start, length, offset, source.

    ``bin_id`` is "group-bin"; a piece is the text from code point ``start``, and
    stands at ``offset`` in its bin."""
    pieces = cut_pieces(docs, capacity, cluster_col)
    # as many groups as documents ask for; copies of a text are dealt apart, they could not share a bin anyway
    groups = max(1, -(-docs.count() // group_docs))
    dealt = pieces.withColumn("bin_group", F.pmod(F.xxhash64("doc_id", "source", "cluster"), F.lit(groups)).cast("int"))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["length", "doc_id", "piece", "source"], ascending=[False, True, True, True], kind="stable")
        clusters = [None if pd.isna(c) else c for c in part["cluster"]]
        placed = best_fit(part["length"].tolist(), part["source"].tolist(), clusters, capacity)
        part["bin_id"] = [f"{g}-{b}" for g, (b, _) in zip(part["bin_group"], placed, strict=True)]
        part["offset"] = [o for _, o in placed]
        return part[["bin_id", "doc_id", "piece", "start", "length", "offset", "source"]]

    schema = f"bin_id string, doc_id {id_type}, piece int, start bigint, length int, offset int, source string"
    return dealt.groupBy("bin_group").applyInPandas(run, schema)


def sequences(docs: DataFrame, packed: DataFrame, separator: str = "") -> DataFrame:
    """bin_id, doc_ids, text: the texts of the bins, put together from their pieces (doc_id must be unique)."""
    text = docs.select(docs["doc_id"].alias("_id"), docs["text"].alias("_text"))
    parts = packed.join(text, packed["doc_id"].eqNullSafe(text["_id"])).withColumn(
        "_piece", F.substr(F.coalesce("_text", F.lit("")), (F.col("start") + 1).cast("int"), F.col("length"))
    )
    ordered = F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "_piece")))
    return parts.groupBy("bin_id").agg(ordered.alias("p")).select(
        "bin_id", F.transform("p", lambda x: x["doc_id"]).alias("doc_ids"), F.array_join(F.transform("p", lambda x: x["_piece"]), separator).alias("text")
    )
