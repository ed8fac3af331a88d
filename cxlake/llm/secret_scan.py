"""Secret scans with multipart credential linking (DataFrame functions only).

Base kinds are strong by themselves: assignments of a secret-like name, cloud
access identifiers and long hexadecimal runs. Weak parts (opaque strings,
account names, endpoints) are common in clean text; they are reported only
when complementary parts stand within ``scope`` code points of each other:

* ``linked_secret``: an opaque string near an identifier or an endpoint;
* ``linked_account``: an account name near a secret;
* ``linked_endpoint``: an endpoint near both an identifier and a secret.

Weak parts that overlap a base span are part of it and add nothing.

Positions are code points, end exclusive. A pattern splits a text into gaps and
matches, so a match ends at the running sum of the gap and match lengths so
far: one window per document and kind. The link test is an interval join by
position: parts are linked when the gap between them (0 if they overlap) is at
most ``scope``, however long they are. Per kind, a window over the document's
parts, ordered by start, gives the largest end of those that start no later, and
another the least start of those that start no earlier. Texts never move: the one shuffle carries a row per match (or
one empty row for a document without any).

Defined results: null and empty texts have no spans and the digest of the empty
string; identical rows (same doc_id and text, told by 128 bits of hash) are
scanned as one and each get their row back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The base patterns, in the order in which equal starts are listed.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
# Weak parts of a multipart credential. An opaque string is a long run that has
# a digit, a capital and a small letter.
OPAQUE = r"[A-Za-z0-9+/_=-]{28,}"
ACCOUNT = r"""((?i:user(?:name)?|login|client_?id|account))["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]+)"""
ENDPOINT = r"""(?:https?|ftp|s3|jdbc|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[A-Za-z0-9._~:/?#@!$&()*+,;=%-]+"""

KINDS = ("assign", "access", "hex", "linked_secret", "linked_account", "linked_endpoint")
BASE_KINDS = 3
# per kind: pattern, group whose length counts, and least length (the pattern enforces it where 0)
PATTERNS = ((ASSIGN, 2, 6), (ACCESS, 0, 0), (HEX, 0, 0), (OPAQUE, 0, 0), (ACCOUNT, 2, 3), (ENDPOINT, 0, 0))
OPAQUE_KIND = 3
SCOPE = 200

MATCH = "array<struct<kind:int,nth:int,gap:int,len:int,ok:boolean>>"


def _matches(text: Column, kind: int) -> tuple[Column, Column]:
    """(all matches, lengths of the counted group) of one kind."""
    pattern, group, _ = PATTERNS[kind]
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return whole, F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole


def _parts(text: Column, kind: int, whole: Column, counted: Column) -> Column:
    """Per match: kind, its place among the matches, gap before it, length, and whether it is long enough."""
    pattern, _, least = PATTERNS[kind]
    gaps = F.slice(F.split(text, pattern, -1), 1, F.size(whole))

    def ok(value: Column) -> Column:
        if kind == OPAQUE_KIND:
            return value.rlike("[0-9]") & value.rlike("[A-Z]") & value.rlike("[a-z]")
        return F.char_length(value) >= least

    rows = F.transform(
        F.arrays_zip(gaps.alias("gap"), whole.alias("hit"), counted.alias("value")),
        lambda m, i: F.struct(
            F.lit(kind).alias("kind"),
            i.cast("int").alias("nth"),
            F.char_length(m["gap"]).alias("gap"),
            F.char_length(m["hit"]).alias("len"),
            ok(m["value"]).alias("ok"),
        ),
    )
    return F.when(F.size(whole) > 0, rows).otherwise(F.array().cast(MATCH))


def row_key(doc_id: Column, text: Column) -> list[Column]:
    """What tells rows apart: the id and 128 bits of hash of the text (null as empty)."""
    t = F.coalesce(text, F.lit(""))
    return [doc_id.alias("doc_id"), F.xxhash64(t).alias("h1"), F.xxhash64(F.lit(1), t).alias("h2")]


def find_spans(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(doc_id, h1, h2, copies, found) for every distinct row of ``docs``.

    ``found``: array of (start, rank, end) by start, then by rank in ``KINDS``."""
    key = ["doc_id", "h1", "h2"]
    text = F.coalesce(docs["text"], F.lit(""))
    kinds = range(len(PATTERNS))
    hits = docs.select(*row_key(docs["doc_id"], docs["text"]), text.alias("text"))
    for k in kinds:
        whole, counted = _matches(F.col("text"), k)
        hits = hits.withColumn(f"whole_{k}", whole)
        if PATTERNS[k][1]:
            hits = hits.withColumn(f"value_{k}", F.when(F.size(f"whole_{k}") > 0, counted))
    arrays = [_parts(F.col("text"), k, F.col(f"whole_{k}"), F.col(f"value_{k}" if PATTERNS[k][1] else f"whole_{k}")) for k in kinds]
    rows = hits.select(*key, F.explode_outer(F.concat(*arrays)).alias("m")).select(*key, "m.*")
    # one shuffle, by row key; identical rows become one with a count
    rows = rows.repartition(*key).groupBy(*key, "kind", "nth", "gap", "len", "ok").agg(F.count(F.lit(1)).alias("copies"))

    so_far = Window.partitionBy(*key, "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.col("len")).over(so_far)
    placed = rows.withColumn("end", end).withColumn("start", F.col("end") - F.col("len"))
    placed = placed.withColumn("part", F.when(F.col("ok"), F.col("kind")))

    before = Window.partitionBy(*key).orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy(*key).orderBy("start").rangeBetween(0, Window.unboundedFollowing)

    def near_kind(*kind: int) -> Column:
        some = F.col("part").isin(*kind)
        ends, starts = F.max(F.when(some, F.col("end"))).over(before), F.min(F.when(some, F.col("start"))).over(after)
        return F.coalesce(ends >= F.col("start") - scope, F.lit(False)) | F.coalesce(starts <= F.col("end") + scope, F.lit(False))

    secret, identifier, endpoint = near_kind(0, 2, 3), near_kind(1, 4), near_kind(5)
    is_base = F.col("part") < BASE_KINDS
    inside = F.coalesce(F.max(F.when(is_base, F.col("end"))).over(before) > F.col("start"), F.lit(False)) | F.coalesce(
        F.min(F.when(is_base, F.col("start"))).over(after) < F.col("end"), F.lit(False)
    )
    linked = F.when(F.col("part") == 3, identifier | endpoint).when(F.col("part") == 4, secret).when(F.col("part") == 5, identifier & secret)
    judged = placed.withColumn("reported", is_base | (linked & ~inside))
    span = F.when(F.col("reported"), F.struct("start", F.col("part").alias("rank"), "end"))
    return judged.groupBy(*key).agg(F.max("copies").alias("copies"), F.array_sort(F.collect_list(span)).alias("found"))


def listed(found: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(found, lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def scan_documents(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id, counts of the base kinds, digest of the base spans, and all spans, for every row of ``docs``."""
    found = find_spans(docs, scope)
    every = found.select("doc_id", "found", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy"))
    base = F.filter("found", lambda s: s["rank"] < BASE_KINDS)

    def count(rank: int) -> Column:
        return F.size(F.filter("found", lambda s: s["rank"] == rank)).cast("long").alias(f"n_{KINDS[rank]}")

    counts = [count(r) for r in range(BASE_KINDS)]
    return every.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"))


def redact(docs: DataFrame, columns: Sequence[str] = ("doc_id", "text", "lang", "source", "n_chars"), mark: str = "[REDACTED]", scope: int = SCOPE) -> DataFrame:
    """``docs`` with every reported span replaced by ``mark`` and ``n_chars`` counted anew.

    Overlapping spans become one. Only spans travel to the texts' rows; rows
    without a span keep their text as it is."""
    spans = find_spans(docs, scope).where(F.size("found") > 0).select(F.col("doc_id").alias("_id"), "h1", "h2", "found")
    keyed = docs.select(*[docs[c] for c in columns], *row_key(docs["doc_id"], docs["text"])[1:])
    joined = keyed.join(spans, keyed["doc_id"].eqNullSafe(spans["_id"]) & (keyed["h1"] == spans["h1"]) & (keyed["h2"] == spans["h2"]), "left")
    # a span that starts inside what is already cut only extends it
    merged = F.aggregate(
        "found",
        F.array().cast("array<struct<start:bigint,end:bigint>>"),
        lambda out, s: F.when(
            (F.size(out) > 0) & (F.element_at(out, -1)["end"] >= s["start"]),
            F.concat(
                F.slice(out, 1, F.size(out) - 1),
                F.array(F.struct(F.element_at(out, -1)["start"].alias("start"), F.greatest(F.element_at(out, -1)["end"], s["end"]).alias("end"))),
            ),
        ).otherwise(F.concat(out, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))),
    )
    cut = joined.withColumn("_cut", F.when(F.col("found").isNotNull(), merged))
    text = F.col("text")
    # text before each span, from the end of the one before it
    kept = F.transform(
        "_cut",
        lambda s, i: F.substr(
            text, (F.when(i > 0, F.element_at("_cut", i)["end"]).otherwise(F.lit(0)) + 1).cast("int"),
            (s["start"] - F.when(i > 0, F.element_at("_cut", i)["end"]).otherwise(F.lit(0))).cast("int"),
        ),
    )
    tail = F.substr(text, (F.element_at("_cut", -1)["end"] + 1).cast("int"), F.char_length(text))
    new = F.when(F.col("_cut").isNull(), text).otherwise(F.concat(F.array_join(kept, mark), F.lit(mark), tail))
    out = cut.withColumn("_new", new)
    chosen = {"text": F.col("_new"), "n_chars": F.coalesce(F.char_length("_new"), F.lit(0)).cast("long")}
    return out.select(*[chosen[c].alias(c) if c in chosen else F.col(c) for c in columns])
