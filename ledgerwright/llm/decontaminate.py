"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items share a seed where ``TILE`` consecutive words are
equal (words are runs outside 0x20, 0x09-0x0D, ASCII letters lower-cased; an item of
fewer words is one seed). For each pair that shares seeds and whose shared seeds
could reach the threshold, tiles are marked: repeatedly the longest common run of
unmarked words, found by Karp-Rabin hashes of one length at a time, never
overlapping earlier tiles in either text. A pair is a leak when the tiles cover
``coverage`` of the item's words, in whatever order its passages stand.

The benchmark is the stated query set. It is taken in blocks of ``BLOCK_BYTES``, so
what a task holds is bounded however large the benchmark is; each block is one scan
of the documents without a shuffle.

Defined cases: null and word-less texts and items match nothing; rows that repeat
each give a row per item; items that share an id give their best coverage; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops
from .common import Tables, bounded

TILE = 5                  # words of the shortest tile
COVERAGE = 0.8            # share of an item's words that tiles must cover
BLOCK_BYTES = 8 << 20     # benchmark text that a task holds


def tiles(doc: np.ndarray, item: np.ndarray, shortest: int) -> list[tuple[int, int, int]]:
    """(place in doc, place in item, length) of the greedy tiles of two word-hash arrays.

    Longest first; equal lengths in document order, then item order.
    """
    out = []
    free_doc, free_item = np.ones(len(doc), bool), np.ones(len(item), bool)
    longest = min(len(doc), len(item))

    def starts(values: np.ndarray, free: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        prefix = np.concatenate([[0], np.cumsum(~free)])
        ok = np.flatnonzero(prefix[size:] == prefix[:-size])
        return ok, _karp_rabin(values, size)[ok]

    while longest >= shortest:
        low, high, best = shortest, longest, 0
        while low <= high:  # a common run of some length implies one of every smaller length
            size = (low + high) // 2
            if np.isin(starts(doc, free_doc, size)[1], starts(item, free_item, size)[1]).any():
                best, low = size, size + 1
            else:
                high = size - 1
        if not best:
            break
        places = defaultdict(list)
        at, key = starts(item, free_item, best)
        for p, k in zip(at.tolist(), key.tolist()):
            places[k].append(p)
        at, key = starts(doc, free_doc, best)
        hit = np.isin(key, np.fromiter(places, np.uint64, len(places)))
        for p, k in zip(at[hit].tolist(), key[hit].tolist()):
            if not free_doc[p:p + best].all():
                continue
            for q in places[k]:
                if free_item[q:q + best].all() and np.array_equal(doc[p:p + best], item[q:q + best]):
                    out.append((p, q, best))
                    free_doc[p:p + best] = False
                    free_item[q:q + best] = False
                    break
        longest = best - 1
    return out


def _karp_rabin(values: np.ndarray, size: int) -> np.ndarray:
    """Rolling hashes of every ``size`` consecutive values."""
    n = len(values)
    pw = textops.powers(n)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * pw[:n], dtype=np.uint64)])
    sums = (total[size:] - total[:n - size + 1]) * pw[n - np.arange(n - size + 1)]
    return textops.mix(sums * textops.base_to(textops.BLOCK_BYTES - n))  # the same for arrays of any length


def _hashes(text: str) -> np.ndarray:
    buf = np.frombuffer(text.encode(), dtype=np.uint8)
    return textops.words(buf, np.array([0, len(buf)]), lower=True)[0]


class SeedIndex:
    """Seeds of a block of items: sorted hashes with the item and place of each."""

    def __init__(self, items: list[tuple[int, str]], tile: int):
        self.ids = [i for i, _ in items]
        self.words = [_hashes(text) for _, text in items]
        self.by_size: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for size in sorted({min(tile, len(w)) for w in self.words} - {0}):
            own = [k for k, w in enumerate(self.words) if min(tile, len(w)) == size]
            seeds = [textops.shingles(self.words[k], size) for k in own]
            seed = np.concatenate(seeds)
            item = np.repeat(own, [len(s) for s in seeds])
            place = np.concatenate([np.arange(len(s)) for s in seeds])
            order = np.argsort(seed, kind="stable")
            self.by_size[size] = seed[order], item[order], place[order]

    def leaks(self, words: np.ndarray, coverage: float) -> list[tuple[int, float, int]]:
        """(item id, coverage, tiles) of the items that ``words`` holds."""
        out = []
        for size, (seeds, items, places) in self.by_size.items():
            if len(words) < size:
                continue
            own = textops.shingles(words, size)
            spot = np.minimum(np.searchsorted(seeds, own), len(seeds) - 1)
            hit = np.flatnonzero(seeds[spot] == own)
            if not len(hit):
                continue
            met = np.unique(own[hit])
            low, high = np.searchsorted(seeds, met), np.searchsorted(seeds, met, side="right")
            touched = np.concatenate([np.arange(a, b) for a, b in zip(low, high)])
            region = np.zeros(len(words), bool)  # tiles lie within shared seeds only
            for k in range(size):
                region[hit + k] = True
            for item in np.unique(items[touched]).tolist():
                target = self.words[item]
                need = math.ceil(coverage * len(target) - 1e-9)
                covered = np.zeros(len(target), bool)
                for k in range(size):
                    covered[places[touched[items[touched] == item]] + k] = True
                if covered.sum() < need:
                    continue
                inside = region & np.isin(words, target)
                found = tiles(_segments(words, inside), target, size)
                share = sum(t[2] for t in found) / len(target)
                if sum(t[2] for t in found) >= need:
                    out.append((self.ids[item], share, len(found)))
        return out


def _segments(words: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """The words inside, with one zero between separate runs."""
    keep = inside | np.concatenate([[False], inside[:-1]])
    return np.where(inside, words, np.uint64(0))[keep]


def find_leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, tile: int = TILE) -> DataFrame:
    """Rows (doc_id, item_id, coverage, n_tiles), one for each document and item it holds."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long"), "text").where("text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = math.ceil(size / BLOCK_BYTES)
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    schema = "doc_id long, item_id long, coverage double, n_tiles int"
    out = spark.createDataFrame([], schema)
    for part in range(parts):
        block = items.where(F.pmod(F.xxhash64("text"), F.lit(parts)) == part)
        sent = spark.sparkContext.broadcast([(r.item_id, r.text) for r in block.collect()])
        out = out.union(rows.mapInArrow(_scan(sent, tile, coverage), schema))
    return out.groupBy("doc_id", "item_id").agg(F.max("coverage").alias("coverage"),
                                                F.max_by("n_tiles", "coverage").alias("n_tiles")) if parts > 1 else out


def _scan(sent, tile: int, coverage: float):
    def run(batches):
        index = SeedIndex(sent.value, tile)
        for batch in batches:
            found = []
            buf, offs = textops.text_buffer(batch.column("text"))
            ids = batch.column("doc_id").to_pylist()
            for i, j in textops.blocks(offs):
                base = offs[i]
                words, _, first = textops.words(buf[base:offs[j]], offs[i:j + 1] - base, lower=True)
                for k in range(j - i):
                    best = {}
                    for item, share, n in index.leaks(words[first[k]:first[k + 1]], coverage):
                        best[item] = max(best.get(item, (0, 0)), (share, n))
                    found += [(ids[i + k], item, share, n) for item, (share, n) in best.items()]
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[c] for f in found], kind) for c, kind in enumerate(kinds)],
                ["doc_id", "item_id", "coverage", "n_tiles"])
    return run


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item; rows without an id stay."""
    tables = Tables(docs.sparkSession, "decontaminate")
    leaked = tables.put(find_leaks(docs, benchmark).select("doc_id").where("doc_id is not null").distinct(), "leaked")
    return docs.join(bounded(leaked), "doc_id", "left_anti").select(*docs.columns)
