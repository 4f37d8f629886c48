"""Removal of byte strings that occur elsewhere in the corpus, by blocks of suffixes and a precomputed sample.

A byte goes when some ``length``-byte string that covers it also starts at another
place, in the same document or another. All suffixes of a corpus can't be moved or
held at once, so the construction is blockwise with a precomputed sample:

1. *Cover sample.* Every ``length``-byte window picks the leftmost smallest hash
   among its ``GRAM``-byte strings. Equal windows pick the same string at the same
   offset, so the picked places (about one in 70 bytes) form a cover: two equal
   windows always meet at a shared sample place. (A positional difference cover
   guarantees that meeting too, but holds an eighth of all bytes or more; this one
   is chosen by content.)
2. *Buckets.* Windows that share their sample string form a bucket. Buckets with a
   single occurrence drop out. Occurrences whose whole surroundings (all bytes of
   the windows that picked them) are equal collapse into one class with a count.
3. *Blocks.* A task takes one block of whole buckets at a time. Suffixes
   are laid out with sample places at multiples of ``STEP``, a periodic cover whose names
   are doubled in length until they span a window; ties beyond ``STEP`` bytes are
   resolved by these names. Suffixes of equal names are repeated windows.
   A bucket of more than ``BUCKET`` classes is instead spread window by window over
   all tasks, with a partial count.

What departs from a difference-cover suffix sort: suffixes are grouped by names, not put
in byte order, since only equal windows are asked for, and these always stand at equal
places between cover places. An order of all suffixes would also have to compare unlike places.
Names of windows are 64-bit hashes of exact names within a block.

Defined cases: a null text is empty; a text shorter than ``length`` bytes loses
nothing; rows that repeat are separate documents, so they match each other; null ids
are kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops
from .common import Tables, bounded

GRAM_SHARE = 0.64     # sample strings are this share of the window
STEP = 16             # distance of cover places in a block
BUCKET = 2000         # classes of a bucket that one task sorts
BLOCK_MB = 3          # class bytes that are grouped at a time, of which numpy holds some eighty times as much

_NULL_ID = -(1 << 63)


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and the key (d, t) of a row: its id, never null, and a 128-bit digest of its text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumns({
        "d": F.coalesce("doc_id", F.lit(_NULL_ID)), "t": F.unhex(F.md5(F.col("text").cast("binary")))})


def _places(text: np.ndarray, length: int, gram: int):
    """Sample places of one text: position, sample hash, first and last window, class hash."""
    prefix = textops.Prefix(text)
    grams = prefix.grams(gram)
    packed = (grams >> np.uint64(31) << np.uint64(31)) | np.arange(len(grams), dtype=np.uint64)
    low = textops.window_minima(packed, length - gram + 1)
    place = (low & np.uint64((1 << 31) - 1)).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1])
    last = np.concatenate([first[1:] - 1, [len(place) - 1]])
    at = place[first]
    around = prefix.hashes(first, last + length)
    shape = ((at - first) * 4096 + (last - first)).astype(np.uint64)
    return at, grams[at].view(np.int64), first, last, textops.mix(around + textops.mix(shape)).view(np.int64), prefix


def _long_texts(batch: pa.RecordBatch, length: int):
    buf, offs = textops.text_buffer(batch.column("text"))
    d, t = batch.column("d").to_numpy(zero_copy_only=False), batch.column("t").to_pylist()
    for k in np.flatnonzero(np.diff(offs) >= length):
        yield d[k], t[k], buf[offs[k]:offs[k + 1]], k


def _samples(rows: DataFrame, length: int, gram: int, only_hash: bool) -> DataFrame:
    def run(batches):
        for batch in batches:
            for d, t, text, _ in _long_texts(batch, length):
                at, fp, first, last, cls, _ = _places(text, length, gram)
                if only_hash:
                    yield pa.RecordBatch.from_arrays([pa.array(fp)], ["fp"])
                else:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(fp), pa.array(cls), pa.array(np.full(len(at), d)), pa.array([t] * len(at), pa.binary()),
                         pa.array(first.astype(np.int32)), pa.array((last - first).astype(np.int32))],
                        ["fp", "cls", "d", "t", "first", "more"])
    def packed(batches):  # fewer and larger Arrow batches
        held, n = [], 0
        for batch in run(batches):
            held.append(batch)
            n += batch.num_rows
            if n >= 20_000:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, n = [], 0
        if n:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    schema = "fp long" if only_hash else "fp long, cls long, d long, t binary, first int, more int"
    return rows.select("d", "t", "text").mapInArrow(packed, schema)


def _runs(repeated: np.ndarray, length: int) -> np.ndarray:
    """Flat [start, end, ...] of the bytes, from the first window on, that repeated windows cover."""
    at = np.flatnonzero(repeated)
    if not len(at):
        return np.zeros(0, np.int32)
    cut = np.flatnonzero(np.diff(at) > length)
    starts = at[np.concatenate([[0], cut + 1])]
    ends = at[np.concatenate([cut, [len(at) - 1]])] + length
    return np.stack([starts, ends], axis=1).astype(np.int32).ravel()


def suffix_names(text: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    """A name for the ``length`` bytes at each place; equal names for equal bytes at equal place modulo STEP.

    Cover places are the multiples of STEP. Their ranks are doubled up to the longest
    power of two within the window; a window is then its first and last STEP bytes and
    the ranks of two overlapping cover suffixes between them.
    """
    prefix = textops.Prefix(text)
    short = prefix.grams(STEP)
    rank = np.unique(short[::STEP], return_inverse=True)[1].astype(np.uint64)
    reach = STEP
    inner = length - length % STEP - STEP  # bytes from the next cover place that lie in every window
    while 2 * reach <= inner:
        ahead = np.zeros_like(rank)
        ahead[:max(0, len(rank) - reach // STEP)] = rank[reach // STEP:]
        rank = np.unique(rank * np.uint64(len(rank) + 1) + ahead, return_inverse=True)[1].astype(np.uint64)
        reach *= 2
    cover = -(-places // STEP)
    shift = (cover * STEP - places).astype(np.uint64)  # only equal shifts are comparable
    name = textops.mix(short[places] + textops.mix(rank[cover] * np.uint64(STEP) + shift))
    name = textops.mix(name + rank[np.minimum(cover + (inner - reach) // STEP, len(rank) - 1)])
    for tail in range(length - STEP, length - 2 * STEP - length % STEP, -STEP):
        name = textops.mix(name + short[places + tail])
    return name


def _sort_block(rows: list[tuple], length: int) -> pa.RecordBatch:
    """Repeated windows of whole buckets: rows (fp, cls, n, left, bytes)."""
    size, layout = 0, []
    for fp, cls, n, left, data in rows:
        start = size + (-(size + left) % STEP)  # the sample place falls on a cover place
        layout.append(start)
        size = start + len(data)
    text = np.zeros(size + length + 2 * STEP, dtype=np.uint8)
    counts = np.array([len(r[4]) - length + 1 for r in rows])
    for start, row in zip(layout, rows):
        text[start:start + len(row[4])] = np.frombuffer(row[4], dtype=np.uint8)
    owner = np.repeat(np.arange(len(rows)), counts)
    begin = np.concatenate([[0], np.cumsum(counts)[:-1]])
    places = np.arange(len(owner)) - begin[owner] + np.array(layout)[owner]
    names = suffix_names(text, places, length)
    order = np.argsort(names, kind="stable")
    same = names[order[1:]] == names[order[:-1]]
    repeated = np.zeros(len(names), dtype=bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    repeated |= (np.array([r[2] for r in rows]) > 1)[owner]
    spans = [_runs(repeated[b:b + c], length) for b, c in zip(begin, counts)]
    keep = [i for i, s in enumerate(spans) if len(s)]
    return pa.RecordBatch.from_arrays(
        [pa.array([rows[i][0] for i in keep], pa.int64()), pa.array([rows[i][1] for i in keep], pa.int64()),
         pa.array([spans[i].tolist() for i in keep], pa.list_(pa.int32()))], ["fp", "cls", "spans"])


_SPANS = "fp long, cls long, spans array<int>"


def _sorted_buckets(classes: DataFrame, length: int) -> DataFrame:
    def run(batches):
        held, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("fp", "cls", "n", "left", "bytes"))):
                if size > BLOCK_MB << 20 and row[0] != held[-1][0]:
                    yield _sort_block(held, length)
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
        if held:
            yield _sort_block(held, length)
    ordered = classes.select("fp", "cls", "n", "left", "bytes").repartition("fp").sortWithinPartitions("fp")
    return ordered.mapInArrow(run, _SPANS)


def _spread_buckets(classes: DataFrame, length: int) -> DataFrame:
    """The same for buckets of any size: every window is a row of its own."""
    def windows(batches):
        for batch in batches:
            for fp, cls, n, data in zip(*(batch.column(c).to_pylist() for c in ("fp", "cls", "n", "bytes"))):
                names = textops.Prefix(np.frombuffer(data, dtype=np.uint8)).grams(length)
                k = len(names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names.view(np.int64)), pa.array(np.full(k, fp)), pa.array(np.full(k, cls)),
                     pa.array(np.full(k, n)), pa.array(np.arange(k, dtype=np.int32))],
                    ["name", "fp", "cls", "n", "at"])
    rows = classes.select("fp", "cls", "n", "bytes").mapInArrow(
        windows, "name long, fp long, cls long, n long, at int")
    again = rows.groupBy("name").agg(F.sum("n").alias("times")).where("times > 1")

    @F.pandas_udf("array<int>")
    def runs(at):
        out = []
        for places in at:
            flags = np.zeros(int(max(places)) + 1, dtype=bool)
            flags[places] = True
            out.append(_runs(flags, length).tolist())
        import pandas as pd
        return pd.Series(out)
    return (rows.join(again, "name").groupBy("fp", "cls").agg(F.collect_list("at").alias("at"))
            .select("fp", "cls", runs("at").alias("spans")))


def repeated_spans(tables: Tables, rows: DataFrame, length: int) -> DataFrame:
    """Rows (d, t, spans): flat byte ranges of each document that repeated strings cover."""
    gram = int(length * GRAM_SHARE)
    fps = tables.put(_samples(rows, length, gram, True).groupBy("fp").agg(F.count("*").alias("n"))
                     .where("n > 1").select("fp"), "repeated-samples")
    seen = tables.put(_samples(rows, length, gram, False).join(bounded(fps), "fp"), "occurrences")
    classes = tables.put(seen.groupBy("fp", "cls").agg(
        F.count("*").alias("n"), F.min(F.struct("d", "t", "first", "more")).alias("at")), "classes")
    buckets = tables.put(classes.groupBy("fp").agg(F.count("*").alias("classes")).where("classes > 1"), "buckets")
    alone = classes.join(bounded(buckets.select("fp")), "fp", "left_anti").select(
        "fp", "cls", F.array(F.lit(0), F.col("at.more") + length).alias("spans"))
    wanted = classes.join(bounded(buckets), "fp").select("fp", "cls", "n", "classes", "at.*")
    wanted = tables.put(wanted.groupBy("d", "t").agg(
        F.collect_list(F.struct("fp", "cls", "n", "classes", "first", "more")).alias("want")), "wanted")
    source = rows.select("d", "t", "text").join(bounded(wanted.select("d", "t")), ["d", "t"], "left_semi")
    gram_at = length - gram + 1

    def cut(batches):
        names = ["fp", "cls", "n", "classes", "left", "bytes"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        for batch in batches:
            out = []
            for text, want in zip(batch.column("text").to_pylist(), batch.column("want").to_pylist()):
                text = text.encode()
                places = None
                for w in want:
                    if places is None:
                        at, _, first, *_ = _places(np.frombuffer(text, np.uint8), length, gram)
                        places = dict(zip(first.tolist(), at.tolist()))
                    f = w["first"]
                    out.append((w["fp"], w["cls"], w["n"], w["classes"], places[f] - f,
                                text[f:f + w["more"] + length]))
                if len(out) > 4000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
    texts = source.dropDuplicates(["d", "t"]).join(wanted, ["d", "t"]).select("text", "want").mapInArrow(
        cut, "fp long, cls long, n long, classes long, left int, bytes binary")
    texts = tables.put(texts, "class-texts")
    spans = alone.union(_sorted_buckets(texts.where(F.col("classes") <= BUCKET), length)).union(
        _spread_buckets(texts.where(F.col("classes") > BUCKET), length))
    spans = tables.put(spans, "spans")
    tables.drop("class-texts", "wanted", "buckets", "classes", "repeated-samples")
    shifted = (seen.join(spans, ["fp", "cls"])
               .select("d", "t", F.expr("transform(spans, x -> x + first)").alias("spans")))
    # rows equal in id and text have equal spans: one set for all of them, reduced where they lie
    out = tables.put(shifted.groupBy("d", "t").agg(F.flatten(F.collect_set("spans")).alias("spans")), "removals")
    tables.drop("occurrences", "spans")
    return out


def remove_repeats(docs: DataFrame, length: int = 400) -> DataFrame:
    """Rows (doc_id, n_bytes, n_removed, n_spans, kept, kept_sha256), one per row of ``docs``.

    ``kept`` holds the bytes that remain, in order; cuts may fall inside a character.
    """
    if length < 8 * STEP:
        raise ValueError(f"length must be {8 * STEP} bytes or more")
    tables = Tables(docs.sparkSession, "suffix-dedup")
    rows = _keyed(docs)
    spans = repeated_spans(tables, rows, length)
    keys = bounded(spans.select("d", "t"))

    def cut(batches):
        for batch in batches:
            n, gone, count, kept = [], [], [], []
            buf, offs = textops.text_buffer(batch.column("text"))
            for k, flat in enumerate(batch.column("spans").to_pylist()):
                text = buf[offs[k]:offs[k + 1]]
                edge = np.zeros(len(text) + 1, dtype=np.int32)
                if flat:
                    np.add.at(edge, np.array(flat[0::2]), 1)
                    np.add.at(edge, np.array(flat[1::2]), -1)
                out = np.cumsum(edge[:-1]) > 0
                n.append(len(text))
                gone.append(int(out.sum()))
                count.append(int((out & ~np.concatenate([[False], out[:-1]])).sum()))
                kept.append(text[~out].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n, gone, count)),
                 pa.array(kept, pa.binary()), pa.array([hashlib.sha256(x).hexdigest() for x in kept])],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])
    clean = rows.join(keys, ["d", "t"], "left_anti").select("doc_id", "text",
                                                            F.array().cast("array<int>").alias("spans"))
    dirty = rows.join(keys, ["d", "t"], "left_semi").join(spans, ["d", "t"]).select("doc_id", "text", "spans")
    return clean.union(dirty).mapInArrow(
        cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
