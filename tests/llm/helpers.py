"""Small inputs with awkward rows, shared by the tests of the text-corpus operators."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# names that operators use inside
CLASHES = (
    "n", "size", "hash", "shard", "slot", "start", "end", "kind", "found", "copies", "h1", "h2", "token", "keys", "digest", "prefix", "rep", "component",
    "node", "u", "v", "score", "label", "kept", "tokens", "weight", "probability", "row", "_source", "_topic", "bin_id", "cluster", "piece", "entry", "vector", "range",
)


def documents(spark, rows, clashing: bool = False):
    """(doc_id, text) or (doc_id, text, lang, source) rows -> documents, with clashing extra columns on demand."""
    full = [(r[0], r[1], *(r[2:] or ("en", "s0")), len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    if clashing:
        df = df.selectExpr("*", *[f"'x' AS `{c}`" for c in CLASHES])
    return df


def awkward(spark, clashing: bool = True):
    """Nulls in every column, empty and blank texts, a long text, repeated rows, copies, ties."""
    long = " ".join(f"word{i % 997} other{i % 31}" for i in range(60_000))
    rows = [
        (1, None, "en", "s0"), (2, "", None, None), (3, " \n\t ", "en", "s0"), (4, long, "de", "s1"), (5, "one two three four five six", "en", "s0"),
        (5, "one two three four five six", "en", "s0"), (6, "one two three four five six", "fr", "s2"), (None, "null id with some words here", "en", "s0"),
        (None, None, None, None), (7, "short", "en", "s1"), (8, "é 日本 \U0001f600 ß", "en", "s1"), (9, "One Two THREE four five six", "en", "s0"),
    ]
    return documents(spark, rows, clashing)


def words(text):
    return WORD.findall(text or "")


def by_id(df, *columns):
    return sorted((tuple(r[c] for c in ("doc_id", *columns)) for r in df.collect()), key=repr)
