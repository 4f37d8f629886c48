"""Hard-negative mining with an STR-packed R-tree.

Vectors become whole numbers (floor(256 * x)); the score of two rows is their inner
product. Rows are packed by sort-tile-recursion: the table is dealt out by the coordinate of
largest variance, and within a task runs of up to ``RUN`` rows are sorted and cut by one
coordinate after another into leaves of up to ``LEAF`` rows. A written leaf holds its rows and
its minimum bounding box. Where leaves are read, ``FAN`` neighbouring leaves form a node, and so
on up to one root for each batch.

A bounding box gives an interval for the inner product with an anchor: coordinate by
coordinate the product lies between those with the two sides. Each search takes boxes
from a queue, best upper bound first. It drops boxes whose interval lies outside the score
window, and those whose upper bound lies strictly below the score of the kth row found
(an equal bound may still hold a tie of smaller id). So what is found is exact.

Anchors are the stated set of queries: those whose id is divisible by 100. They meet all rows in
blocks of about ``BLOCK_BYTES``, a block broadcast to the leaves. Every block has four passes:
positives in a share of the leaves, positives in all others, and likewise negatives. The first
pass gives each search a kth score to start from, so that the second emits few rows from each
task: with a share of 1 / sqrt(tasks) of the leaves, the rows between tasks grow with the square root
of their number. Each pass keeps the best k of an anchor by a window with partial limits.

Defined cases: rows with a null label or vector, or a null or non-finite component, take no
part. Neither do vectors of another length than most (the shorter at a tie). Repeated ids are rows
of their own, each an anchor or candidate (a row is never its own positive); a null id is no
anchor, its label stays, and it comes last among ties. Components beyond ``LIMIT`` are cut to
it, so that scores stay exact. An anchor without positives, and a positive without
negatives, give no row. Equal vectors are dealt out by their ids. An empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Tables, partitions_for
from .whitening import pack, unpack, whole_vectors

LEAF = 128                 # rows of a leaf
FAN = 16                   # boxes of a node
RUN = 1 << 16              # rows that are packed together
DEALT = 1 << 17            # rows of a range of the first coordinate, at most about
LEAST = 1 << 12            # rows of a range while there are fewer ranges than shuffle partitions
BLOCK_BYTES = 16 << 20     # vectors of a block of anchors, about
LIMIT = 1 << 20            # largest component: products of up to 2**13 of these are exact as doubles
EVERY = 100                # anchors are the ids divisible by this
POSITIVES = NEGATIVES = 5
LOWEST, HIGHEST = 80, 100  # per cent of the positive's score between which a negative's lies

_LEAVES = "leaf long, part int, n int, ids array<long>, labels array<int>, places array<int>, low binary, high binary, rows binary"


# ---------------------------------------------------------------- packing

def tiles(x: np.ndarray, axes: list[int], leaf: int = LEAF) -> list[np.ndarray]:
    """Sort-tile-recursion: row numbers of each leaf, neighbouring leaves next to each other."""
    def cut(rows: np.ndarray, depth: int) -> list[np.ndarray]:
        leaves = -(-len(rows) // leaf)
        if leaves <= 1 or depth == len(axes):
            return [rows[i:i + leaf] for i in range(0, len(rows), leaf)]
        slabs = math.ceil(leaves ** (1 / (len(axes) - depth)))
        size = leaf * -(-leaves // max(2, slabs))
        rows = rows[np.argsort(x[rows, axes[depth]], kind="stable")]
        return [t for i in range(0, len(rows), size) for t in cut(rows[i:i + size], depth + 1)]
    return cut(np.arange(len(x)), 0) if len(x) else []


def usable_rows(embeddings: DataFrame, column: str) -> DataFrame:
    """Rows (id, label, width, x): labels as mined, whole-number vectors packed."""
    def run(batches):
        for batch in batches:
            keep, vectors = whole_vectors(batch, column)
            vectors = [np.clip(v, -LIMIT, LIMIT) for v in vectors]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).take(pa.array(keep)) for c in ("id", "label")]
                + [pa.array([len(v) for v in vectors], pa.int32()), pa.array(map(pack, vectors), pa.binary())],
                ["id", "label", "width", "x"])
    vec = F.col("vec_id").cast("long")
    label = F.col("label").cast("int")
    mined = F.when(vec % 7 == 0, (label + 1) % 10).otherwise(label)
    return (embeddings.where(F.col("label").isNotNull()).select(vec.alias("id"), mined.alias("label"), column)
            .mapInArrow(run, "id long, label int, width int, x binary"))


def _spread(rows: DataFrame, width: int) -> list[int]:
    """Coordinates by falling variance, from sums over all rows."""
    def run(batches):
        n, one, two = 0, np.zeros(width), np.zeros(width)
        for batch in batches:
            x = unpack(batch.column("x").to_pylist(), width)
            n, one, two = n + len(x), one + x.sum(axis=0), two + (x.astype(float) ** 2).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(width)), pa.array([n] * width), pa.array(one), pa.array(two)],
                                         ["i", "n", "one", "two"])
    sums = rows.select("x").mapInArrow(run, "i long, n long, one double, two double").groupBy("i").agg(
        *(F.sum(c).alias(c) for c in ("n", "one", "two"))).collect()
    return [r.i for r in sorted(sums, key=lambda r: ((r.one / r.n) ** 2 - r.two / r.n, r.i))]


def tree(tables: Tables, embeddings: DataFrame, column: str) -> tuple[DataFrame, int, int]:
    """The written leaves, the number of their rows, and the length of vectors (0: no rows)."""
    rows = tables.put(usable_rows(embeddings, column), "rows")
    counts = rows.groupBy("width").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "width").first()
    if counts is None or counts.width == 0:
        return rows, 0, 0
    n, width = counts.n, counts.width
    rows = rows.where(F.col("width") == width)
    axes = _spread(rows, width)

    def first(batches):  # the coordinate by which rows are dealt out
        for batch in batches:
            x = unpack(batch.column("x").to_pylist(), width)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "label", "x")), pa.array(x[:, axes[0]])],
                                             ["id", "label", "x", "at"])

    def leaves(batches):
        part, number, held, size = TaskContext.get().partitionId(), 0, [], 0

        def packed():
            nonlocal number
            table = pa.Table.from_batches(held)
            ids, labels = (table.column(c).combine_chunks() for c in ("id", "label"))
            x = unpack(table.column("x").to_pylist(), width)
            out = []
            for rows in tiles(x, axes):
                own = x[rows]
                out.append(((part << 32) + number, part, len(rows), ids.take(pa.array(rows)).to_pylist(),
                            labels.take(pa.array(rows)).to_pylist(), list(range(len(rows))),
                            *(v.astype(np.int32).tobytes() for v in (own.min(axis=0), own.max(axis=0), own))))
                number += 1
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(
                    pa.int32()), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.binary()))],
                ["leaf", "part", "n", "ids", "labels", "places", "low", "high", "rows"])
        for batch in batches:
            for at in range(0, batch.num_rows, 8192):
                held.append(batch.slice(at, 8192))
                size += held[-1].num_rows
                if size >= RUN:
                    yield packed()
                    held, size = [], 0
        if size:
            yield packed()
    ranges = max(math.ceil(n / DEALT), min(partitions_for(rows), math.ceil(n / LEAST)))
    dealt = (rows.mapInArrow(first, "id long, label int, x binary, at long")
             .repartitionByRange(ranges, "at", F.xxhash64("id")))
    out = tables.put(dealt.select("id", "label", "x").mapInArrow(leaves, _LEAVES), "leaves")
    tables.drop("rows")
    return out, n, width


# ---------------------------------------------------------------- searching

class Boxes:
    """The R-tree over the leaves of one batch: leaves, then runs of ``FAN`` boxes up to a single root."""

    def __init__(self, batch: pa.RecordBatch, width: int):
        self.sizes = batch.column("n").to_numpy()
        self.start = np.concatenate([[0], np.cumsum(self.sizes)])
        self.leaf = np.repeat(batch.column("leaf").to_numpy(), self.sizes)
        self.place = batch.column("places").flatten().to_numpy()
        ids = batch.column("ids").flatten()
        self.null = ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(0).to_numpy()
        self.labels = batch.column("labels").flatten().to_numpy()
        self.x = np.frombuffer(b"".join(batch.column("rows").to_pylist()), np.int32).reshape(-1, width).astype(np.float64)
        low, high = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.int32).reshape(-1, width).astype(np.float64)
                     for c in ("low", "high"))
        self.levels = [(low, high)]
        while len(low) > 1:
            at = np.arange(0, len(low), FAN)
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            self.levels.append((low, high))

    def bounds(self, anchors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per level: smallest and largest inner product that a box allows, a row per anchor."""
        up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
        return [(up @ low.T + down @ high.T, up @ high.T + down @ low.T) for low, high in self.levels]

    def search(self, bounds, anchor: np.ndarray, wanted, windows: list[tuple[float, float, float]], k: int,
               opened: set | None = None) -> list[list[tuple[float, int]]]:
        """Per window (lowest, highest, kth) the best ``k`` rows (score, row) that are ``wanted``; best-first over boxes.

        One queue serves all windows of an anchor. ``kth`` is a score that ``k`` rows found
        elsewhere reach; boxes and rows strictly below it go. ``opened`` gets the leaves that were read.
        """
        highs = [high for _, high, _ in windows]
        floors = [max(low, kth) for low, _, kth in windows]
        best: list[list[tuple]] = [[] for _ in windows]  # worst first: (score, not null, -id, row)
        least, most = min(floors), max(highs)
        top = len(self.levels) - 1
        queue = [(-bounds[top][1][i], top, i) for i in range(len(self.levels[top][0]))]
        heapq.heapify(queue)
        while queue:
            upper, level, i = heapq.heappop(queue)
            upper, lower = -upper, bounds[level][0][i]
            if upper < least:
                break
            if not any(upper >= floor and lower <= high for floor, high in zip(floors, highs)):
                continue
            if level:
                lows, ups = (v[i * FAN:(i + 1) * FAN] for v in bounds[level - 1])
                for j in np.flatnonzero((ups >= least) & (lows <= most)).tolist():
                    heapq.heappush(queue, (-ups[j], level - 1, i * FAN + j))
                continue
            if opened is not None:
                opened.add(i)
            rows = slice(self.start[i], self.start[i + 1])
            scores = self.x[rows] @ anchor
            hits = np.flatnonzero((scores >= least) & (scores <= most) & wanted(rows))
            for r in hits[np.argsort(-scores[hits], kind="stable")].tolist():
                score, row = float(scores[r]), r + int(self.start[i])
                item = (score, not self.null[row], -int(self.ids[row]), row)
                for s, found in enumerate(best):
                    if floors[s] <= score <= highs[s]:
                        if len(found) < k:
                            heapq.heappush(found, item)
                        elif item[:3] > found[0][:3]:
                            heapq.heapreplace(found, item)
                        if len(found) == k:
                            floors[s] = max(floors[s], found[0][0])
            least = min(floors)
        return [[(score, row) for score, _, _, row in found] for found in best]


@dataclass
class Anchors:
    """A block of anchors and, for negatives, the score of each of its positives' windows."""

    number: np.ndarray      # of an anchor within all
    leaf: np.ndarray        # where its row stands
    place: np.ndarray
    label: np.ndarray
    x: np.ndarray
    windows: list           # per anchor: [(slot, positive's score)], or [] while positives are searched
    kth: dict               # (anchor, slot): score that enough rows reach


_FOUND = "anchor long, slot int, score long, id long, leaf long, place int"


def _pass(leaves: DataFrame, anchors: Anchors, width: int, mining: bool) -> DataFrame:
    """Best rows of each task for every anchor (slot 0), or for every anchor and positive (its slot)."""
    sent = leaves.sparkSession.sparkContext.broadcast(anchors)

    def run(batches):
        a = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            boxes = Boxes(batch, width)
            out = []
            for at in range(0, len(a.number), 256):
                levels = boxes.bounds(a.x[at:at + 256])
                for k in range(at, min(at + 256, len(a.number))):
                    own = [(low[k - at], high[k - at]) for low, high in levels]
                    label, leaf, place = a.label[k], a.leaf[k], a.place[k]
                    if mining:
                        slots = [(s, (-(-LOWEST * p // 100), HIGHEST * p // 100)) for s, p in a.windows[k]]
                        slots = [x for x in slots if x[1][0] <= x[1][1]]
                        wanted = lambda rows: boxes.labels[rows] != label
                    else:
                        slots = [(0, (-math.inf, math.inf))]
                        wanted = lambda rows: (boxes.labels[rows] == label) & (
                            (boxes.leaf[rows] != leaf) | (boxes.place[rows] != place))
                    if not slots:
                        continue
                    windows = [(*w, a.kth.get((k, s), -math.inf)) for s, w in slots]
                    for (slot, _), rows in zip(slots, boxes.search(own, a.x[k], wanted, windows, NEGATIVES if mining else POSITIVES)):
                        out += [(a.number[k], slot, int(s), None if boxes.null[r] else int(boxes.ids[r]),
                                 int(boxes.leaf[r]), int(boxes.place[r])) for s, r in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(zip(*out) if out else [()] * 6, (
                    pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32()))],
                ["anchor", "slot", "score", "id", "leaf", "place"])
    return leaves.mapInArrow(run, _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.asc_nulls_last("id"), "leaf", "place")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _two_passes(tables: Tables, leaves: DataFrame, share: int, anchors: Anchors, width: int, mining: bool, name: str) -> DataFrame:
    """The best rows over all leaves, as a written table: a share of the leaves first, whose kth scores bound the rest."""
    k = NEGATIVES if mining else POSITIVES
    first_leaves = F.pmod(F.xxhash64("leaf"), F.lit(share)) == 0
    found = tables.put(_best(_pass(leaves.where(first_leaves), anchors, width, mining), k), f"{name}-first")
    if share > 1:
        at = {int(n): i for i, n in enumerate(anchors.number)}
        kth = found.where(F.col("rank") == k).select("anchor", "slot", "score").collect()  # at most one per search of a block
        anchors.kth = {(at[r.anchor], r.slot): r.score for r in kth}
        rest = _pass(leaves.where(~first_leaves), anchors, width, mining)
        anchors.kth = {}
        found = found.drop("rank").union(rest)
        found = _best(found, k)
    return tables.put(found, f"{name}-best")


def _block(rows: list, width: int) -> Anchors:
    """Anchors of collected rows (number, leaf, place, label, x): one bounded block."""
    return Anchors(*(np.array([r[c] for r in rows], np.int64) for c in ("number", "leaf", "place", "label")),
                   np.frombuffer(b"".join(r["x"] for r in rows), np.int32).reshape(-1, width).astype(np.float64),
                   [[] for _ in rows], {})


def anchor_rows(leaves: DataFrame, width: int) -> DataFrame:
    """Rows (leaf, place, id, label, x) of the stated queries, read from the leaves that hold them."""
    def run(batches):
        for batch in batches:
            out = []
            for leaf, ids, labels, data in zip(*(batch.column(c).to_pylist() for c in ("leaf", "ids", "labels", "rows"))):
                x = np.frombuffer(data, np.int32).reshape(-1, width)
                out += [(leaf, p, i, labels[p], x[p].tobytes()) for p, i in enumerate(ids) if i is not None and i % EVERY == 0]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out) if out else [()] * 5, (
                    pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary()))], ["leaf", "place", "id", "label", "x"])
    return leaves.mapInArrow(run, "leaf long, place int, id long, label int, x binary")


def mine(embeddings: DataFrame, column: str = "embedding") -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score)."""
    spark = embeddings.sparkSession
    tables = Tables(spark, "hard-negatives")
    leaves, n, width = tree(tables, embeddings, column)
    kinds = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not n:
        return spark.createDataFrame([], kinds)
    asked = anchor_rows(leaves, width)
    tasks = leaves.rdd.getNumPartitions()
    share = math.ceil(math.sqrt(tasks))
    blocks = max(1, math.ceil(asked.count() * width * 8 / BLOCK_BYTES))
    asked = tables.put(asked.withColumn("number", F.col("leaf") * LEAF + F.col("place"))
                       .withColumn("block", F.pmod(F.xxhash64("number"), F.lit(blocks))), "anchors")
    out = None
    for b in range(blocks):
        rows = asked.where(F.col("block") == b).collect()  # a block: BLOCK_BYTES, whatever the number of anchors
        if not rows:
            continue
        anchors = _block(rows, width)
        positives = _two_passes(tables, leaves, share, anchors, width, False, f"positives-{b}")
        at = {int(k): i for i, k in enumerate(anchors.number)}
        for r in positives.select("anchor", "rank", "score").collect():  # at most POSITIVES an anchor of the block
            anchors.windows[at[r.anchor]].append((r.rank, r.score))
        negatives = _two_passes(tables, leaves, share, anchors, width, True, f"negatives-{b}")
        one = (negatives.select("anchor", "slot", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
               .join(positives.select("anchor", F.col("rank").alias("slot"), F.col("id").alias("positive_id"),
                                      F.col("score").alias("positive_score")), ["anchor", "slot"])
               .join(asked.where(F.col("block") == b).select(F.col("number").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
               .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
        one = tables.put(one, f"mined-{b}")
        tables.drop(*(f"{t}-{b}-{p}" for t in ("positives", "negatives") for p in ("first", "best")))
        out = one if out is None else out.union(one)
    tables.drop("leaves")
    return out if out is not None else spark.createDataFrame([], kinds)
