"""MinHash near-duplicates by an LSH forest.

A document's set holds its distinct word shingles (words are runs outside
0x20, 0x09-0x0D, ASCII letters lower-cased; a shorter text is one shingle of all
its words). Equal sets collapse into a class first. The forest keeps ``TREES``
orders of one MinHash signature. In each order a *region* is a run of documents
that share a label prefix; the prefix is extended only where a region holds more
than ``REGION`` documents (adaptive depth). Within a region of bounded size,
documents sorted by their deeper labels meet their longest-common-prefix
neighbours. In every region that is too large, whatever its depth, all documents
also meet a few pivots: the documents that lie in the largest regions over all
orders, which is where the original of a family of edited copies lies. So the
number of candidates is linear in the number of documents and no large region is
ever gathered. Pairs with pivots are confirmed on the full sets first; of the other
candidates only those between different components are left to confirm. Links become
connected components.

Neighbours and pivots alone would lose links inside a crowd of similar documents, so
the dense documents (members of a region that is too large) also have an exact search:
a prefix-filter join. Shingles have one order, rare ones first; two documents at the
threshold share one within the first ``n - ceil(percent * n / 100) + 1`` of each. Pairs
that share such a shingle pass only if their sizes, the places of the shingle and the
parities of both sets leave a link possible; all three are bounds that lose no link (sizes and parities also test all pairs of the forest before any set is moved).
A shingle of many documents is dealt out over pairs of blocks.

Defined cases: a null or word-less text has an empty set and no links; rows that
share a doc_id are one node (each row is returned); rows with a null doc_id are
never linked and are kept; an empty table gives an empty result; other columns of
the input are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops
from .common import Tables, bounded, components

VALUES = 64                    # MinHash values of a signature
TREES = 16                     # orders of the signature
DEPTHS = (3, 6, 12, 24)        # label prefixes at which a region may end
REGION = 64                    # a larger region is split by the next prefix
NEIGHBOURS = 24                # longest-common-prefix neighbours of a dense document in a region of the forest
PIVOTS = 3                     # central documents that all of a large region meet
BUCKETS = 1 << 20              # counters of the order of shingles
BLOCK = 512                    # documents of a shingle that are compared in one place
PARITIES = 512                 # bits of a set's parities
LOSS = 1e-6                    # chance that the sketch test loses a pair just at the threshold

_rng = np.random.default_rng(8)
_MULTIPLIERS = _rng.integers(0, 2**63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ORDERS = np.stack([_rng.permutation(VALUES)[:DEPTHS[-1]] for _ in range(TREES)])


def _sets(batch: pa.RecordBatch, size: int):
    """Sorted distinct shingle hashes of each row of ``batch``."""
    buf, offs = textops.text_buffer(batch.column("text"))
    for i, j in textops.blocks(offs):
        base = offs[i]
        hashes, _, first = textops.words(buf[base:offs[j]], offs[i:j + 1] - base, lower=True)
        for k in range(j - i):
            row = hashes[first[k]:first[k + 1]]
            yield np.unique(textops.shingles(row, min(size, max(1, len(row)))))


def signature(values: np.ndarray) -> np.ndarray:
    """Upper 32 bits of the smallest product per multiplier."""
    low = np.full(VALUES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(values), 2048):
        np.minimum(low, (values[i:i + 2048, None] * _MULTIPLIERS).min(axis=0), out=low)
    return (low >> np.uint64(32)).astype(np.uint32)


def sketch(docs: DataFrame, size: int) -> DataFrame:
    """One row per document: doc_id, n_shingles, digest of the set, signature, parities."""
    def run(batches):
        for batch in batches:
            n, digest, sig, odd = [], [], [], []
            for values in _sets(batch, size):
                n.append(len(values))
                odd.append(_parities(values) if len(values) else None)
                digest.append(hashlib.blake2b(values.tobytes(), digest_size=16).digest())
                sig.append(signature(values).tobytes() if len(values) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                 pa.array(sig, pa.binary()), pa.array(odd, pa.binary())],
                ["doc_id", "n_shingles", "digest", "sig", "parities"])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_shingles long, digest binary, sig binary, parities binary")


def labels(classes: DataFrame, orders: range) -> DataFrame:
    """One row per class and order of ``orders``: doc, its sketch (set size, 64 two-bit values), a key per prefix."""
    names = ["doc", "about", *(f"k{d}" for d in range(len(DEPTHS)))]
    planes = ["size", "low", "high"]

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), dtype=np.uint32).reshape(n, VALUES)
            low, high = (np.packbits((sig & bit).astype(bool), axis=1).view(np.int64).ravel() for bit in (1, 2))
            about = pa.StructArray.from_arrays([batch.column("size"), pa.array(low), pa.array(high)], planes)
            doc = batch.column("doc").to_numpy(zero_copy_only=False)
            for tree in orders:
                key = np.full(n, tree + 1, dtype=np.uint64)
                keys = []
                for depth, position in enumerate(_ORDERS[tree], 1):
                    key = textops.mix(key * np.uint64(0x2545F4914F6CDD1D) + sig[:, position])
                    if depth in DEPTHS:
                        keys.append(key.view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(doc), about, *map(pa.array, keys)], names)
    return classes.select("doc", "size", "sig").mapInArrow(
        run, "doc long, about struct<size long, low long, high long>, " + ", ".join(f"{n} long" for n in names[2:]))


def max_gap(percent: int) -> int:
    """Most two-bit values that may differ: a pair at the threshold exceeds it with a chance below ``LOSS``."""
    q = (1 - percent / 100) * 3 / 4  # unlike values agree in two bits by a chance of a quarter
    tail, gap = 1.0, -1
    while tail >= LOSS and gap < VALUES:
        gap += 1
        tail -= math.comb(VALUES, gap) * q ** gap * (1 - q) ** (VALUES - gap)
    return gap


def _ordered(pairs: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a < b) whose set sizes and two-bit values leave a link possible."""
    small, large = F.least("pa.size", "qa.size"), F.greatest("pa.size", "qa.size")
    unlike = F.col("pa.low").bitwiseXOR(F.col("qa.low")).bitwiseOR(F.col("pa.high").bitwiseXOR(F.col("qa.high")))
    return (pairs.where("p <> q").where((100 * small >= percent * large) & (F.bit_count(unlike) <= max_gap(percent)))
            .select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct())


def crowded(tables: Tables, rows: DataFrame, key: str, name: str) -> DataFrame:
    """Regions (key, n) of more than ``REGION`` documents: few against ``rows``, so broadcast within the bound."""
    sizes = rows.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > REGION)
    return bounded(tables.put(sizes, name))


def neighbours(small: DataFrame, depth: int, partners: int) -> DataFrame:
    """Longest-common-prefix neighbours, ``partners`` a document, within regions of at most ``REGION`` documents."""
    deeper = [f"k{d}" for d in range(depth + 1, len(DEPTHS))]
    region = F.sort_array(F.collect_list(F.struct(*deeper, "doc", "about")))
    return (small.groupBy(f"k{depth}").agg(region.alias("region")).where(F.size("region") > 1)
            .select("region", F.explode(F.sequence(F.lit(0), F.size("region") - 2)).alias("i"))
            .select(F.element_at("region", F.col("i") + 1).alias("x"),
                    F.explode(F.slice("region", F.col("i") + 2, F.lit(partners))).alias("y"))
            .select(F.col("x.doc").alias("p"), F.col("x.about").alias("pa"),
                    F.col("y.doc").alias("q"), F.col("y.about").alias("qa")))


def candidates(tables: Tables, classes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Distinct pairs (a < b) of classes: with pivots of the largest regions, and all others; the dense documents.

    All documents meet all others of their regions at the first prefix. Those of a
    region too large there are dense: they alone go on to deeper prefixes, which join
    most of a family, and ``dense_pairs`` finds the rest of their links exactly. All members of a
    large region are dense, so its parts are whole there.
    """
    rows = labels(classes, range(TREES))
    large = crowded(tables, rows, "k0", "crowded")
    found = [tables.put(_ordered(neighbours(rows.join(large, "k0", "left_anti"), 0, REGION), percent), "pairs-first")]
    dense = tables.put(rows.join(large, "k0", "left_semi").select("doc").distinct(), "dense")
    if dense.isEmpty():
        return tables.spark.createDataFrame([], "a long, b long"), found[0], dense
    star, more = forest(tables, classes.join(dense, "doc", "left_semi"), range(TREES), percent)
    out = found[0]
    for part in more:
        out = out.union(part)
    pairs = tables.put(out.distinct(), "pairs")
    tables.drop("pairs-first", "crowded", *(f"pairs-{d}" for d in range(len(DEPTHS))))
    return star, pairs, dense


def forest(tables: Tables, classes: DataFrame, orders: range, percent: int) -> tuple[DataFrame, list[DataFrame]]:
    """Pivot pairs at the first prefix, and all other pairs by prefix."""
    rows = tables.put(labels(classes, orders), "rows-0")
    star, found = None, []
    for d in range(len(DEPTHS)):
        key = f"k{d}"
        regions = crowded(tables, rows, key, f"crowded-{d}")
        pairs = neighbours(rows.join(regions, key, "left_anti"), d, NEIGHBOURS)
        large = rows.join(regions, key, "left_semi").drop(*(f"k{k}" for k in range(d)))  # passed prefixes go
        if d == 0:
            weights = rows.join(regions, key).groupBy("doc").agg(F.sum("n").alias("weight"))
            large = large.join(bounded(tables.put(weights, "weights")), "doc")
        large = tables.put(large, f"rows-{d + 1}")
        if large.isEmpty():
            found.append(tables.put(_ordered(pairs, percent), f"pairs-{d}"))
            break
        pivots = tables.put(
            large.groupBy(key, F.pmod(F.xxhash64("doc"), F.lit(PIVOTS)).alias("class"))
            .agg(F.max(F.struct("weight", "doc", "about")).alias("pivot")), f"pivots-{d}")
        # a document's pivots over all orders are mostly the same few, so they are gathered before pairs are made
        met = (large.join(bounded(pivots.groupBy(key).agg(F.collect_list("pivot").alias("pivots"))), key)
               .groupBy("doc").agg(F.first("about").alias("about"), F.collect_set("pivots").alias("pivots"))
               .select("doc", "about", F.posexplode(F.sort_array(F.array_distinct(F.flatten("pivots")), asc=False)).alias("k", "pivot"))
               .select("k", F.col("doc").alias("p"), F.col("about").alias("pa"),
                       F.col("pivot.doc").alias("q"), F.col("pivot.about").alias("qa")))
        if d == 0:  # the heaviest pivot at first: most others are of its component by then
            star = tables.put(_ordered(met.where("k = 0").drop("k"), percent), "star")
            met = met.where("k > 0")
        found.append(tables.put(_ordered(pairs.union(met.drop("k")), percent), f"pairs-{d}"))
        tables.drop(f"rows-{d}", f"crowded-{d}", f"pivots-{d}")
        rows = large
    return star, found


def full_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """Rows (doc_id, items): the whole sets of the documents ``wanted`` names (a written table of ids).

    While its ids are within the broadcast bound no text is shuffled.
    """

    def full(batches):
        for batch in batches:
            sets = [values.tobytes() for values in _sets(batch, size)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sets, pa.binary())],
                                             ["doc_id", "items"])
    return (docs.select(F.col("doc_id").cast("long"), "text").join(bounded(wanted), "doc_id", "left_semi")
            .mapInArrow(full, "doc_id long, items binary"))


def rarity(sets: DataFrame, percent: int) -> np.ndarray:
    """Documents that hold a shingle, counted by the lowest bits of its hash: a fixed number of counters.

    The lower half of the counters is filled first. A counter of one is a shingle of one document alone,
    and a document with too many of these has no link whatever its other shingles are (``heads`` gives no row
    of it either), so the upper half counts the others only; that saves rows where ``percent`` is over 50.
    """
    half = BUCKETS // 2
    out = np.zeros(BUCKETS, dtype=np.int64)
    for low in (0, half):
        lower = sets.sparkSession.sparkContext.broadcast(out[:low].copy())

        def count(batches, low=low, lower=lower):
            total = np.zeros(BUCKETS, dtype=np.int64)
            for batch in batches:
                for items in batch.column("items"):
                    bucket = np.frombuffer(items.as_py(), dtype=np.uint64) % np.uint64(BUCKETS)
                    alone = np.count_nonzero(lower.value[bucket[bucket < low]] == 1)
                    if 100 * (len(bucket) - alone) >= percent * len(bucket):
                        np.add.at(total, bucket[(bucket >= low) & (bucket < low + half)], 1)
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])
        counted = sets.select("items").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
        found = counted.toArrow()
        out[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return out


def _parities(values: np.ndarray) -> bytes:
    """A bit per counter of shingles, set where odd: two sets differ in as many shingles as bits, or more."""
    odd = np.bincount((values >> np.uint64(32)) % np.uint64(PARITIES), minlength=PARITIES) % 2
    return np.packbits(odd.astype(bool)).tobytes()


def heads(sets: DataFrame, counts: np.ndarray, percent: int) -> DataFrame:
    """Rows (token, doc, component, size, left, parities): the rarest shingles of each set that others may hold too.

    ``left`` is the number of shingles from this one to the last in the order.
    """
    shared = sets.sparkSession.sparkContext.broadcast(counts)

    def table(found):
        token, doc, component, size, left, parities = zip(*found)
        times = [len(t) for t in token]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(token)), *(pa.array(np.repeat(v, times)) for v in (doc, component, size)),
             pa.array(np.concatenate(left)), pa.array([p for p, k in zip(parities, times) for _ in range(k)], pa.binary())],
            ["token", "doc", "component", "size", "left", "parities"])

    def run(batches):
        for batch in batches:
            found = []
            for doc, component, items in zip(*(batch.column(c) for c in ("doc_id", "component", "items"))):
                values = np.frombuffer(items.as_py(), dtype=np.uint64)
                n = len(values)
                often = shared.value[values % np.uint64(BUCKETS)]
                first = np.lexsort((values, often))[:n - (percent * n + 99) // 100 + 1]
                place = np.flatnonzero(often[first] > 1)  # a counter of one is a shingle of this document alone
                found.append((values[first[place]].view(np.int64), doc.as_py(), component.as_py(), n, n - place,
                              _parities(values)))
                if sum(len(f[0]) for f in found) >= 1 << 14 or len(found) >= 256:
                    yield table(found)
                    found = []
            if found:
                yield table(found)
    return sets.mapInArrow(
        run, "token long, doc long, component long, size long, left long, parities binary")


def _meet(cell: dict, percent: int, across: bool):
    """Pairs of documents of one cell whose sizes, places and parities leave a link possible."""
    doc, component, size, left, block = (cell[c] for c in ("doc", "component", "size", "left", "block"))
    if len(doc) < 2 or (component == component[0]).all():
        return
    for at in range(0, len(doc), 256):
        rows = slice(at, at + 256)
        total = size[rows, None] + size
        may = ((component[rows, None] != component) & (doc[rows, None] < doc)
               & ((100 + percent) * np.minimum(left[rows, None], left) >= percent * total)
               & (100 * np.minimum(size[rows, None], size) >= percent * np.maximum(size[rows, None], size)))
        if across:
            may &= block[rows, None] != block
        x, y = np.nonzero(may)
        for k in range(0, len(x), 1 << 16):
            p, q = x[k:k + (1 << 16)] + at, y[k:k + (1 << 16)]
            unlike = np.bitwise_count(cell["parities"][p] ^ cell["parities"][q]).sum(axis=1, dtype=np.int64)
            both = size[p] + size[q]  # unlike <= both - 2 * common, and a link has (100 + percent) * common >= percent * both
            keep = (100 + percent) * (both - unlike) >= 2 * percent * both
            if keep.any():
                yield doc[p[keep]], doc[q[keep]]


def dense_pairs(tables: Tables, sets: DataFrame, dense: DataFrame, joined: DataFrame, percent: int) -> DataFrame:
    """Pairs (a < b) of dense documents of different components: all that may be linked, found exactly."""
    members = (sets.join(bounded(dense.withColumnRenamed("doc", "doc_id")), "doc_id", "left_semi")
               .join(bounded(joined.withColumnRenamed("node", "doc_id")), "doc_id", "left")
               .select("doc_id", F.coalesce("component", "doc_id").alias("component"), "items"))
    rows = heads(members, rarity(members, percent), percent)
    # a shingle whose documents are one component already can't add a link: of a joined family nothing is dealt
    mixed = rows.groupBy("token").agg(F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high"))
    mixed = tables.put(mixed.where("low <> high").select("token", F.ceil(F.col("n") / BLOCK).alias("blocks")), "mixed")
    block = F.pmod(F.xxhash64("doc"), F.col("blocks"))
    dealt = (rows.join(bounded(mixed), "token").withColumn("block", block)
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))))
    cells = (dealt.groupBy("token", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
             .agg(F.collect_list(F.struct("doc", "component", "size", "left", "block", "parities")).alias("cell"))
             .where(F.size("cell") > 1))

    def run(batches):
        for batch in batches:
            found, n = [], 0
            for across, cell in zip(batch.column("across"), batch.column("cell")):
                fields = cell.values.flatten()
                names = [f.name for f in cell.values.type]
                known = {c: v.to_numpy() for c, v in zip(names[:-1], fields)}
                known["parities"] = np.frombuffer(b"".join(fields[-1].to_pylist()), np.uint64).reshape(len(cell), -1)
                for pair in _meet(known, percent, across.as_py()):
                    found.append(pair)
                    n += len(pair[0])
                    if n >= 1 << 18:
                        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v)) for v in zip(*found)], ["a", "b"])
                        found, n = [], 0
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v)) for v in zip(*found)], ["a", "b"])
    return (cells.select((F.col("low") != F.col("high")).alias("across"), "cell")
            .mapInArrow(run, "a long, b long").distinct())


def possible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose set sizes and parities leave a link possible: a bound that loses none, on narrow rows."""
    def test(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(batch.num_rows, -1) for c in ("x", "y"))
            unlike = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
            both = batch.column("both").to_numpy()
            keep = (100 + percent) * (both - unlike) >= 2 * percent * both
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    def named(side: str, odd: str, size: str) -> DataFrame:
        return classes.select(F.col("doc").alias(side), F.col("parities").alias(odd), F.col("size").alias(size))
    return (pairs.join(named("a", "x", "m"), "a").join(named("b", "y", "n"), "b")
            .select("a", "b", (F.col("m") + F.col("n")).alias("both"), "x", "y").mapInArrow(test, "a long, b long"))


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets meet ``100 * intersection >= percent * union``."""
    def test(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = (np.frombuffer(v.as_py(), dtype=np.uint64) for v in (x, y))
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                    keep.append(False)
                    continue
                joined = np.sort(np.concatenate([x, y]), kind="stable")
                common = int((joined[1:] == joined[:-1]).sum())
                keep.append(100 * common >= percent * (len(joined) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    def named(side: str, items: str) -> DataFrame:  # only the sets that this side names are shuffled
        return (sets.select(F.col("doc_id").alias(side), F.col("items").alias(items))
                .join(bounded(pairs.select(side).distinct()), side, "left_semi"))
    return (pairs.join(named("a", "x"), "a").join(named("b", "y"), "b")
            .select("a", "b", "x", "y").mapInArrow(test, "a long, b long"))


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept), one per row of ``docs``.

    ``component_id`` is the smallest doc_id that links of at least ``percent``
    (similarity of the shingle sets) reach; ``kept`` marks that document.
    """
    tables = Tables(docs.sparkSession, "near-dedup")
    sketches = tables.put(sketch(docs, shingle), "sketches")
    filled = sketches.where("n_shingles > 0 and doc_id is not null")
    classes = tables.put(filled.groupBy("digest").agg(F.min("doc_id").alias("doc"), F.max("sig").alias("sig"),
                                                           F.max("n_shingles").alias("size"),
                                                      F.max("parities").alias("parities")), "classes")
    star, pairs, dense = candidates(tables, classes, percent)
    star = tables.put(possible(star, classes, percent), "star-possible")
    pairs = tables.put(possible(pairs, classes, percent), "pairs-possible")
    named = star.union(pairs).union(dense.select("doc", "doc"))
    wanted = tables.put(named.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "wanted")
    sets = tables.put(full_sets(docs, wanted, shingle), "sets")
    near = tables.put(confirm(star, sets, percent), "star-links")
    joined = components(tables, near, "star-components")
    # a pair within one component can't change the components, so only the others are confirmed
    rest = (pairs.join(joined.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a", "left")
            .join(joined.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b", "left")
            .where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b"))
    if not dense.isEmpty():
        rest = rest.union(dense_pairs(tables, sets, dense, joined, percent)).distinct()
    rest = tables.put(rest, "rest")
    links = tables.put(near.union(confirm(rest, sets, percent)), "links")
    copies = (filled.join(classes.select("digest", "doc"), "digest").where("doc_id <> doc")
              .select(F.col("doc_id").alias("a"), F.col("doc").alias("b")))
    labelled = components(tables, links.union(copies), "components")
    tables.drop("pairs", "pairs-first", "star-possible", "pairs-possible", "dense", "mixed", "star", "weights", "rest", "wanted", "sets", "classes", "star-links", "links",
                *(f"{t}-{d}" for t in ("rows", "crowded", "pivots") for d in range(len(DEPTHS) + 1)))
    return (sketches.select("doc_id", "n_shingles")
            .join(labelled.withColumnRenamed("node", "doc_id"), "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
                    F.coalesce(F.col("component") == F.col("doc_id"), F.lit(True)).alias("kept")))


def keep_one_of_each_group(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay: one document of each near-duplicate group.

    Rows that repeat a doc_id count as copies; of them the first in the order of
    all columns stays. All columns and their order are kept. While the ids of rows
    that go, or repeat, are within the broadcast bound no text but of repeated ids is shuffled.
    """
    tables = Tables(docs.sparkSession, "near-dedup-kept")
    gone = bounded(tables.put(
        near_duplicates(docs, shingle, percent).where("not kept").select("doc_id").distinct(), "gone"))
    again = bounded(tables.put(docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n"))
                               .where("n > 1").select("doc_id"), "again"))
    stay = docs.join(gone, "doc_id", "left_anti")
    repeated = stay.join(again, "doc_id", "left_semi")
    first = repeated.groupBy("doc_id").agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*")
    return stay.join(again, "doc_id", "left_anti").select(*docs.columns).union(first.select(*docs.columns))
