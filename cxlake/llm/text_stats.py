"""Rule statistics of whole texts: the counts that quality operators share.

One pass over each text (``mapInArrow``; numpy over the bytes of a batch).
Null and empty texts count as no words and give zero everywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cxlake.llm import wordhash as W

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_lines", "n_upper", "n_letters", "n_digits", "n_marks", "n_bangs", "n_pipes", "n_after_same", "n_chars")
COUNTS = BASE + EXTRA


def _table(chars: bytes) -> np.ndarray:
    t = np.zeros(256, dtype=bool)
    t[list(chars)] = True
    return t


SYMBOLS, MARKS, DIGITS = _table(b"#*$%&|<>"), _table(b".,;:!?"), _table(b"0123456789")
UPPER, ASCII_LETTERS = _table(bytes(range(65, 91))), _table(bytes(range(65, 91)) + bytes(range(97, 123)))


def count_texts(column: pa.Array) -> dict[str, np.ndarray]:
    """All of ``COUNTS`` for each text of an Arrow column."""
    out = {c: np.zeros(len(column), dtype=np.int64) for c in COUNTS}
    for t in W.slices(column):
        at = slice(t.first, t.first + t.rows)
        buf = t.buf
        starts, ends, first = t.words()
        hashes = W.span_hashes(buf, starts, ends, W.EXACT)
        out["n_words"][at] = np.diff(first)
        # a code point starts at every byte that is not a continuation byte
        heads = np.concatenate([[0], np.cumsum(~W.SPACE[buf] & ((buf & 0xC0) != 0x80))])
        out["word_chars"][at] = heads[t.offsets[1:]] - heads[t.offsets[:-1]]
        out["n_symbols"][at] = t.count(np.flatnonzero(SYMBOLS[buf]))
        out["n_marks"][at] = t.count(np.flatnonzero(MARKS[buf]))
        out["n_digits"][at] = t.count(np.flatnonzero(DIGITS[buf]))
        out["n_bangs"][at] = t.count(np.flatnonzero(buf == 0x21))
        out["n_pipes"][at] = t.count(np.flatnonzero(buf == 0x7C))
        # capitals: A-Z and the two-byte Latin-1 capitals (C3 80 .. C3 9E)
        accented = np.zeros(len(buf), dtype=bool)
        accented[:-1] = (buf[:-1] == 0xC3) & (buf[1:] >= 0x80)
        capital = UPPER[buf]
        capital[:-1] |= accented[:-1] & (buf[1:] <= 0x9E)
        out["n_upper"][at] = t.count(np.flatnonzero(capital))
        out["n_letters"][at] = t.count(np.flatnonzero(ASCII_LETTERS[buf] | accented))
        heads = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
        out["n_chars"][at] = heads[t.offsets[1:]] - heads[t.offsets[:-1]]

        owner = W.owners(first)
        if len(hashes) > 1:
            again = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
            out["n_after_same"][at] = np.bincount(owner[1:][again], minlength=t.rows)
        grams, place, whose = W.windows(hashes, first, 3)
        covered = np.zeros(len(hashes) + 2, dtype=bool)
        if len(grams):
            place = place[W.repeated(grams, whose)[0]]
            for i in range(3):
                covered[place + i] = True
        out["n_repeat_words"][at] = np.bincount(owner[covered[: len(hashes)]], minlength=t.rows)

        a, b, line_first = t.lines()
        # a line counts when it holds at least one word
        wordy = np.searchsorted(starts, b) > np.searchsorted(starts, a)
        line_owner = W.owners(line_first)
        if wordy.any():
            line_hash = W.span_hashes(buf, a, b, W.EXACT)[wordy]
            line_owner = line_owner[wordy]
            out["n_lines"][at] = np.bincount(line_owner, minlength=t.rows)
            out["n_dup_lines"][at] = np.bincount(line_owner[W.repeated(line_hash, line_owner)[1]], minlength=t.rows)
    return out


def text_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` plus the long columns of ``COUNTS``, one row per input row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = count_texts(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(counts[c]) for c in COUNTS]], [id_col, *COUNTS])

    narrow = docs.select(docs[id_col], docs[text_col])
    id_type = narrow.schema[0].dataType.simpleString()
    return narrow.mapInArrow(run, f"`{id_col}` {id_type}, " + ", ".join(f"{c} bigint" for c in COUNTS))


def rates(c) -> np.ndarray:
    """Length-free rule statistics (rows x features) from a mapping of count arrays.

    An empty text gives zero in every column."""
    f = {k: np.asarray(c[k], dtype=np.float64) for k in COUNTS}
    words, lines = np.maximum(f["n_words"], 1), np.maximum(f["n_lines"], 1)
    letters = np.maximum(f["n_letters"], 1)
    return np.column_stack(
        [
            f["n_symbols"] / words,
            f["n_pipes"] / words,
            f["n_bangs"] / words,
            f["n_upper"] / letters,
            f["n_repeat_words"] / words,
            f["n_after_same"] / words,
            f["n_dup_lines"] / lines,
            f["n_digits"] / np.maximum(f["word_chars"], 1),
            f["n_marks"] / words,
            f["word_chars"] / words / 10,
        ]
    )


RATES = ("symbols", "pipes", "bangs", "capitals", "repeats", "runs", "dup_lines", "digits", "marks", "word_length")
