"""Document fingerprints by one-permutation MinHash with optimal densification and packed low-order bits.

A text's set holds the windows of five words (words are runs outside 0x20 and 0x09-0x0D,
ASCII letters lower-cased), those that stand over its first and last words
included, so that a text of w words has w + 4 windows, and short texts are compared by degrees. Each
window is hashed once: upper bits name one of ``BINS`` bins, the rest is its value, and a bin
keeps its smallest value. An empty bin takes the value of the first filled bin in a sequence
of bins that its own number and the attempt decide by a hash, alike for all texts (optimal
densification). Of each bin the lowest ``BITS`` bits are packed into the fingerprint.

Unlike bins agree in their bits by chance, with probability 2 ** -BITS, for sets small
against the 64-bit values they are drawn from; the share m of equal bins therefore gives the likeness
(m - 2 ** -BITS) / (1 - 2 ** -BITS), cut to 0..1. Its standard error is at most
0.5 / sqrt(BINS) / (1 - 2 ** -BITS), 0.03 here.

For edited texts the table is dealt out by ranges of doc_id and sorted within, so a
document meets the next one where it lies. Texts are shuffled once. The first and last documents of each
partition, two each, are joined afterwards by partition number.

Defined cases: a null text is empty; texts without words have the fingerprint "", whose likeness is 1
to itself and 0 to others. Null doc_ids come first; rows of one doc_id are in the order of a
hash of their text; a lone document follows itself. An empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops
from .common import Tables, partitions_for

SHINGLE = 5                # words of a window
BINS = 512                 # a power of two
BITS = 2                   # kept of each bin
BLOCK_CHARS = 1 << 20      # characters that are hashed at a time; a longer text is a block of its own

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_SHIFT = np.uint64(64 - BINS.bit_length() + 1)


# ---------------------------------------------------------------- fingerprints

def densify(low: np.ndarray) -> np.ndarray:
    """``low`` (a row of bins per text) with empty bins filled; rows without a filled bin stay empty."""
    out = low.copy()
    source = low != _EMPTY
    row, column = np.nonzero(~source & source.any(axis=1)[:, None])
    attempt = 0
    while len(row):
        attempt += 1
        at = textops.mix(column.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(attempt))
        at = (at >> _SHIFT).astype(np.int64)
        hit = source[row, at]
        out[row[hit], column[hit]] = low[row[hit], at[hit]]
        row, column = row[~hit], column[~hit]
    return out


def bins(texts: list[str]) -> np.ndarray:
    """Smallest values of all bins, a row per text; empty bins are not filled."""
    n = len(texts)
    data = [t.encode() for t in texts]
    offs = np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64)
    hashes, _, first = textops.words(np.frombuffer(b"".join(data), np.uint8), offs, lower=True)
    count = np.diff(first)
    apart = SHINGLE - 1
    begin = np.arange(n) * apart + first[:-1]  # windows of a text start here in the sequence with gaps of four
    padded = np.zeros(len(hashes) + apart * (n + 1), np.uint64)
    padded[np.arange(len(hashes)) + apart * (np.repeat(np.arange(n), count) + 1)] = hashes
    windows = textops.shingles(padded, SHINGLE)
    owner = np.repeat(np.arange(n), count + apart)
    use = np.repeat(count > 0, count + apart)
    assert len(windows) == len(owner) and (n == 0 or begin[-1] + count[-1] + apart == len(owner))
    values, owner = windows[use], owner[use]
    low = np.full(n * BINS, _EMPTY, np.uint64)
    np.minimum.at(low, owner * BINS + (values >> _SHIFT).astype(np.int64), textops.mix(values))
    return low.reshape(n, BINS)


def packed(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Packed fingerprints, a row of bytes per text, and whether a text has words."""
    low = densify(bins(texts))
    bits = ((low[:, :, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(bool)
    return np.packbits(bits.reshape(len(texts), BINS * BITS), axis=1), (low != _EMPTY).any(axis=1)


def fingerprint_texts(texts: list[str]) -> list[str]:
    """Fingerprints in base 64; "" for a text without words."""
    out, at = [], 0
    while at < len(texts):
        size, end = 0, at
        while end < len(texts) and (end == at or size + len(texts[end]) <= BLOCK_CHARS) and end - at < 512:
            size += len(texts[end])
            end += 1
        rows, filled = packed(texts[at:end])
        out += [base64.b64encode(r.tobytes()).decode() if f else "" for r, f in zip(rows, filled)]
        at = end
    return out


def likeness(a: list[str], b: list[str]) -> np.ndarray:
    """Estimated likeness of the sets behind fingerprints, pair by pair."""
    out = np.array([float(x == y) for x, y in zip(a, b)])
    both = [i for i, (x, y) in enumerate(zip(a, b)) if x and y]
    if both:
        x, y = (np.frombuffer(b"".join(base64.b64decode(v[i]) for i in both), np.uint8).reshape(len(both), -1) for v in (a, b))
        unlike = np.unpackbits(x ^ y, axis=1).reshape(len(both), BINS, BITS).any(axis=2).sum(axis=1)
        chance = 2.0 ** -BITS
        out[both] = np.clip(((1 - unlike / BINS) - chance) / (1 - chance), 0, 1)
    return out


def fingerprints(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, fingerprint), one per row of ``docs``, computed where they are read."""
    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fingerprint_texts(texts), pa.string())],
                                             ["doc_id", "fingerprint"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fingerprint string")


# ---------------------------------------------------------------- edited texts

def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by as many characters of the text that follows."""
    quarter = len(text) // 4
    return text[:len(text) - quarter] + following[:quarter]


_ROWS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_KINDS = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
_ROW = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compared(ids: list, texts: list[str], following: list[str], prints: list[str], after: list[str]) -> list[list]:
    """Columns of ``_ROWS`` for texts and the texts that follow them, with both fingerprints."""
    changed = [edited(t, f) for t, f in zip(texts, following)]
    own = fingerprint_texts(changed)
    return [ids, [len(t) for t in texts], [hashlib.sha256(t.encode()).hexdigest() for t in changed], prints, own,
            likeness(prints, own).tolist(), likeness(prints, after).tolist()]


def _in_order(docs: DataFrame) -> DataFrame:
    """Per partition of sorted documents: rows of all but the last; its first and last texts as edges (part, edge, text)."""
    def run(batches):
        part, held, first = TaskContext.get().partitionId(), None, None

        def rows(columns, edge=None, texts=None):
            n = len(columns[0])
            return pa.RecordBatch.from_arrays(
                [*(pa.array(c, k) for c, k in zip(columns, _KINDS)), pa.array([part] * n, pa.int32()),
                 pa.array([edge] * n, pa.string()), pa.array(texts or [None] * n, pa.string())], [*_ROWS, "part", "edge", "text"])
        for whole in batches:
            at = 0
            while at < whole.num_rows:
                batch = whole.slice(at, 512)
                at += batch.num_rows
                ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
                prints = fingerprint_texts(texts)
                if held is None:
                    first = (ids[0], texts[0], prints[0])
                else:
                    ids, texts, prints = ([h, *v] for h, v in zip(held, (ids, texts, prints)))
                held = ids[-1], texts[-1], prints[-1]
                if len(ids) > 1:
                    yield rows(_compared(ids[:-1], texts[:-1], texts[1:], prints[:-1], prints[1:]))
        for edge, row in (("first", first), ("last", held)):
            if row:
                yield rows([[row[0]], [None], [None], [row[2]], [None], [None], [None]], edge, [row[1]])
    return docs.mapInArrow(run, f"{_ROW}, part int, edge string, text string")


def edited_likeness(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next), one per row of ``docs``."""
    tables = Tables(docs.sparkSession, "fingerprints")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    # rows equal in both are interchangeable; their place in the input deals out a group of any size
    rows = rows.withColumn("place", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(partitions_for(docs), *order, "place").sortWithinPartitions(*order, "place")
    done = tables.put(_in_order(rows.select("doc_id", "text")), "rows")

    parts = [r.part for r in done.where("edge = 'last'").select("part").orderBy("part").collect()]  # numbers of partitions
    follows = docs.sparkSession.createDataFrame([(p, parts[(i + 1) % len(parts)]) for i, p in enumerate(parts)], "part int, next int")
    ahead = done.where("edge = 'first'").select(F.col("part").alias("next"), F.col("text").alias("next_text"),
                                                F.col("fingerprint").alias("next_print"))
    pairs = (done.where("edge = 'last'").select("doc_id", "part", "text", "fingerprint").join(follows, "part").join(ahead, "next"))

    def run(batches):
        for batch in batches:
            ids, texts, following, prints, after = (batch.column(c).to_pylist() for c in (
                "doc_id", "text", "next_text", "fingerprint", "next_print"))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(
                _compared(ids, texts, following, prints, after), _KINDS)], _ROWS)
    edges = pairs.select("doc_id", "text", "next_text", "fingerprint", "next_print").mapInArrow(run, _ROW)
    return done.where("edge is null").select(*_ROWS).union(edges)
