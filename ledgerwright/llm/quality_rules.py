"""Quality rules: robust multivariate outliers per language and source.

DataFrame functions only. Each text gives counts of words, symbols, repeated lines
and repeated word windows; five transformed ratios of these form its vector. Per
language and source the minimum-covariance-determinant estimate of location and
scatter is found by concentration steps: the (n + p + 1) / 2 closest of n vectors give
the next mean and covariance, until the determinant falls no further, as when the subset
stays the same. Three starts are tried (medians and absolute deviations, shortest
halves, covariance of spatial signs) and the estimate of smallest determinant is taken.
Vectors whose squared Mahalanobis distance exceeds ``CUTOFF`` are rejected.

Vectors are rounded to 1/256, so all sums are exact whole numbers and results do not
depend on how rows are dealt out. Every aggregate is partial before its shuffle: a
group of any size is reduced where it lies. Groups of fewer than ``SMALLEST`` documents use
the estimate of their language, and small languages that of all documents.

Defined cases: a null text has no words and fails the base rule; null languages and
sources are groups of their own; ties share a verdict; rows that repeat are judged
each; an empty table gives an empty result; other columns are ignored by the scores.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Tables, bounded

SPACES = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
FEATURES = ("symbols", "word_length", "dup_lines", "repeats", "capitals")
FLOORS = (0.5, 0.1, 0.75, 1.0, 0.5)   # smallest standard deviation of each, in its log unit
UNIT = 256                            # vectors are whole multiples of 1/UNIT
QUANTILES = 20                        # steps between the quantiles that shortest halves are found by
SMALLEST = 60                         # documents of a group with an estimate of its own
RANKS = 256                           # ranks of distances to a unit of their logarithm
CUTOFF = 50.0                         # squared distance beyond which a vector is rejected
CHI_MEDIAN = 4.351                    # median of chi-square with five degrees of freedom


def text_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and n_capitals."""
    own = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals"]
    base = docs.select(*(c for c in docs.columns if c not in own))
    text = F.coalesce(F.col("text"), F.lit(""))
    trimmed = F.btrim(text, F.lit(BLANKS))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    out = base.withColumns({
        "_words": F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACES)),
        "_lines": lines,
        "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_capitals": F.regexp_count(text, F.lit(r"\p{Lu}+")).cast("long"),
    })
    n = F.size("_words")
    out = out.withColumns({
        "n_words": n.cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_h": F.transform("_words", lambda w: F.xxhash64(w)),
    }).drop("_lines", "_words")
    for step in (1, 2, 4):  # hashes of 2, 4 and then 8 words in order
        out = out.withColumn("_h", F.zip_with(
            "_h", F.slice("_h", 1 + step, F.col("n_words").cast("int")), lambda a, b: F.xxhash64(a, b)))
    out = out.withColumn("_h", F.slice("_h", 1, F.greatest(F.col("n_words") - 7, F.lit(0)).cast("int")))
    placed = F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    out = out.withColumn("_s", F.when(F.size(F.array_distinct("_h")) < F.size("_h"), placed)).drop("_h")
    again = F.filter("_s", lambda x, k: (x["h"] == F.get("_s", k - 1)["h"]) | F.coalesce(
        x["h"] == F.get("_s", k + 1)["h"], F.lit(False)))
    out = out.withColumn("_p", F.sort_array(F.transform(again, lambda x: x["i"]))).drop("_s")
    gaps = F.zip_with("_p", F.slice("_p", 2, F.size("_p")), lambda a, b: F.coalesce(F.least(b - a, F.lit(8)), F.lit(8)))
    total = F.aggregate(gaps, F.lit(0), lambda s, x: s + x)
    return out.withColumn("n_repeat_words", F.coalesce(F.when(F.col("_p").isNotNull(), total), F.lit(0))
                          .cast("long")).drop("_p")


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _vector() -> dict[str, Column]:
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    raw = (F.log1p(1000 * F.col("n_symbols") / chars), F.log(chars / words),
           F.log1p(1000 * F.col("n_dup_lines") / words), F.log1p(100 * F.col("n_repeat_words") / words),
           F.log1p(100 * F.col("n_capitals") / words))
    return {f"x{k}": F.round(x * UNIT).cast("long") for k, x in enumerate(raw)}


def _names() -> tuple[list[str], list[str], list[str]]:
    """Columns of a vector, of a mean, and of the upper half of an inverse covariance."""
    p = range(len(FEATURES))
    return [f"x{i}" for i in p], [f"m{i}" for i in p], [f"g{i}{j}" for i in p for j in p if i <= j]


def _estimate(rows: DataFrame) -> DataFrame:
    """Rows (group, start, size, m*, c*) with the covariance inverted: (group, start, size, m*, g*, det).

    Five sweeps, one per pivot, over the covariance as an array: the plan stays as
    small as one sweep. ``det`` is the log determinant.
    """
    p = len(FEATURES)
    _, means, halves = _names()
    whole = F.array(*(F.col(f"c{max(i, j)}{min(i, j)}") for i in range(p) for j in range(p)))
    pivot = f"s.a[{p + 1} * k]"
    swept = F.expr(f"""aggregate(sequence(0, {p - 1}), named_struct('a', cov, 'det', 0D), (s, k) -> named_struct(
        'a', transform(s.a, (v, t) -> CASE
            WHEN t = {p + 1} * k THEN -1D / v
            WHEN cast(t div {p} as int) = k OR t % {p} = k THEN v / {pivot}
            ELSE v - s.a[cast(t div {p} as int) * {p} + k] * s.a[{p} * k + t % {p}] / {pivot} END),
        'det', s.det + ln({pivot})))""")
    out = rows.withColumn("cov", whole).select("group", "start", "size", *means, swept.alias("s"))
    return out.select("group", "start", "size", *means, *(
        (-F.col("s.a")[p * int(g[1]) + int(g[2])]).alias(g) for g in halves), F.col("s.det").alias("det"))


def _distance() -> Column:
    """Squared Mahalanobis distance of a vector from the estimate beside it."""
    p = len(FEATURES)
    y = [F.col(f"x{i}") - F.col(f"m{i}") for i in range(p)]
    return sum((y[i] * (y[i] * F.col(f"g{i}{i}") + 2 * sum((y[j] * F.col(f"g{i}{j}") for j in range(i + 1, p)), F.lit(0.0)))
                for i in range(p)), F.lit(0.0))


def _rank(distance: Column) -> Column:
    """A distance as a whole number on a log scale, so that counts by it have few rows."""
    return F.floor(RANKS * F.log1p(F.greatest(distance, F.lit(0.0))))


def _starts(tables: Tables, points: DataFrame) -> DataFrame:
    """Three first estimates of each group."""
    p = len(FEATURES)
    xs = _names()[0]
    steps = ", ".join(f"{k / QUANTILES}D" for k in range(QUANTILES + 1))
    half = QUANTILES // 2
    quantiles = points.groupBy("group").agg(
        F.count("*").alias("size"), *(F.expr(f"percentile({x}, array({steps}))").alias(f"q{x}") for x in xs))
    halves = {x: F.array_min(F.transform(F.sequence(F.lit(0), F.lit(half)), lambda k: F.struct(
        (F.get(f"q{x}", k + half) - F.get(f"q{x}", k)).alias("long"), F.get(f"q{x}", k).alias("low")))) for x in xs}
    quantiles = quantiles.withColumns({f"h{x}": halves[x] for x in xs})
    centre = tables.put(quantiles.select("group", "size", *(F.get(f"q{x}", F.lit(half)).alias(f"e{x}") for x in xs),
                                         *((F.col(f"h{x}.low") + F.col(f"h{x}.long") / 2).alias(f"mid{x}") for x in xs),
                                         *(F.greatest(F.col(f"h{x}.long") / 1.349, F.lit(f * UNIT)).alias(f"half{x}")
                                           for x, f in zip(xs, FLOORS))), "centre")
    width = points.join(centre, "group").groupBy("group").agg(
        *(F.expr(f"percentile(abs({x} - e{x}), 0.5)").alias(f"w{x}") for x in xs))
    scales = {f"w{x}": F.greatest(1.4826 * F.col(f"w{x}"), F.lit(f * UNIT)) for x, f in zip(xs, FLOORS)}
    centre = tables.put(centre.join(width.withColumns(scales), "group"), "width")
    near = points.join(centre, "group").select("group", *(
        ((F.col(x) - F.col(f"e{x}")) / F.col(f"w{x}")).alias(f"z{i}") for i, x in enumerate(xs)))
    norm = sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(p)), F.lit(0.0))
    near = near.withColumn("norm", F.when(norm > 0, norm))
    signs = near.groupBy("group").agg(*(  # in whole numbers, so that the order of rows does not matter
        F.coalesce(F.sum(F.round(F.col(f"z{i}") * F.col(f"z{j}") / F.col("norm") * (1 << 20)).cast("long")), F.lit(0)).alias(f"c{i}{j}")
        for i in range(p) for j in range(i + 1)))
    signs = tables.put(signs, "signs").join(centre, "group")
    signs = signs.select("group", F.lit(2).alias("start"), "size", *(F.col(f"e{x}").alias(f"m{i}") for i, x in enumerate(xs)), *(
        ((F.col(f"c{i}{j}") / F.col("size") / (1 << 20) + (0.01 if i == j else 0.0)) * F.col(f"w{xs[i]}") * F.col(f"w{xs[j]}"))
        .alias(f"c{i}{j}") for i in range(p) for j in range(i + 1)))

    def axes(start: int, middle: str, scale: str) -> DataFrame:
        return centre.select("group", F.lit(start).alias("start"), "size", *(F.col(f"{middle}{x}").alias(f"m{i}") for i, x in enumerate(xs)), *(
            (F.col(f"{scale}{xs[i]}") * F.col(f"{scale}{xs[i]}") if i == j else F.lit(0.0)).alias(f"c{i}{j}")
            for i in range(p) for j in range(i + 1)))
    first = axes(0, "e", "w").union(axes(1, "mid", "half")).union(signs)
    return tables.put(_estimate(first), "starts")


def _concentrate(tables: Tables, points: DataFrame, active: DataFrame, name: str) -> DataFrame:
    """Estimates (group, start) from the (n + p + 1) / 2 vectors closest by ``active``, ties included.

    The vectors are read twice: for counts by rank, which give each estimate its cut, and
    for the sums of those within it. Counts and sums are partial before their shuffles, and
    no row is written.
    """
    p = len(FEATURES)
    xs, means, halves = _names()
    near = points.join(active.drop("det"), "group")
    counts = (near.select("group", "start", "size", _rank(_distance()).alias("rank"))
              .groupBy("group", "start", "size", "rank").agg(F.count("*").alias("n")))
    below = F.sum("n").over(Window.partitionBy("group", "start").orderBy("rank"))
    half = F.least(F.floor((F.col("size") + p + 1) / 2), F.col("size"))
    cut = (counts.withColumn("below", below).where(F.col("below") >= half)
           .groupBy("group", "start").agg(F.min("rank").alias("cut")))
    cut = tables.put(active.select("group", "start", "size", "det", *means, *halves).join(cut, ["group", "start"]), f"cut-{name}")
    chosen = (points.join(cut, "group").where(_rank(_distance()) <= F.col("cut"))
              .groupBy("group", "start", "size", F.col("det").alias("before")).agg(
                  F.count("*").alias("n"), *(F.sum(x).alias(f"s{i}") for i, x in enumerate(xs)),
                  *(F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}{j}") for i in range(p) for j in range(i + 1))))
    sums = tables.put(chosen, f"sums-{name}")
    moments = sums.select("group", "start", "size", "before", *((F.col(f"s{i}") / F.col("n")).alias(f"m{i}") for i in range(p)), *(
        (F.col(f"s{i}{j}") / F.col("n") - (F.col(f"s{i}") / F.col("n")) * (F.col(f"s{j}") / F.col("n"))
         + ((FLOORS[i] * UNIT) ** 2 if i == j else 0.0)).alias(f"c{i}{j}") for i in range(p) for j in range(i + 1)))
    found = _estimate(moments).join(sums.select("group", "start", "before"), ["group", "start"])
    out = tables.put(found, f"estimate-{name}")
    tables.drop(f"cut-{name}", f"sums-{name}")
    return out


def judge(docs: DataFrame) -> tuple[DataFrame, Tables]:
    """Narrow rows (doc_id, key, statistics, base_failed, distance, kept), and the tables they rest on."""
    tables = Tables(docs.sparkSession, "quality-rules")
    lang = docs["lang"].cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    source = docs["source"].cast("string") if "source" in docs.columns else F.lit(None).cast("string")
    rows = docs.select("doc_id", "text", lang.alias("lang"), source.alias("source"), F.xxhash64("text").alias("key"))
    rows = text_statistics(rows).drop("text").withColumn("base_failed", base_failed()).withColumns(_vector())
    rows = tables.put(rows, "statistics")

    xs, means, halves = _names()
    label = F.to_json(F.struct("lang", "source"), {"ignoreNullFields": "false"})
    by_both = rows.groupBy("lang", "source").agg(F.count("*").alias("n"))
    by_lang = rows.groupBy("lang").agg(F.count("*").alias("n_lang"))
    names = (by_both.join(by_lang, by_both["lang"].eqNullSafe(by_lang["lang"])).drop(by_lang["lang"])
             .select("lang", "source", F.when(F.col("n") >= SMALLEST, label)
                     .when(F.col("n_lang") >= SMALLEST, F.to_json(F.struct("lang"), {"ignoreNullFields": "false"}))
                     .otherwise("all").alias("group")))
    names = tables.put(names, "names")
    rows = tables.put(rows.join(names.withColumnsRenamed({"lang": "_l", "source": "_s"}), F.col("lang").eqNullSafe(F.col("_l"))
                                & F.col("source").eqNullSafe(F.col("_s"))).drop("_l", "_s"), "rows")
    tables.drop("statistics", "names")

    points = rows.select("group", *xs)
    estimate = ["group", "start", "size", *means, *halves, "det"]
    parts = [_concentrate(tables, points, _starts(tables, points), "0").select(*estimate)]
    tables.drop("centre", "width", "signs", "starts")
    active = parts[0]
    while active.limit(1).count():  # a group's start is left once its determinant falls no further
        found = _concentrate(tables, points, active, str(len(parts)))
        active = found.where("det < before").select(*estimate)
        parts.append(active)
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    best = found.groupBy("group").agg(F.min_by(F.struct(*means, *halves), F.struct("det", "start")).alias("e"))
    best = tables.put(best.select("group", "e.*"), "best")
    tables.drop(*(f"estimate-{k}" for k in range(len(parts))))
    middle = points.join(best, "group").groupBy("group").agg(
        F.percentile(F.floor(1024 * F.log1p(F.greatest(_distance(), F.lit(0.0)))), 0.5).alias("mid"))
    final = tables.put(best.join(middle, "group"), "estimate")
    tables.drop("best")
    scale = F.greatest(F.lit(1.0), F.expm1(F.col("mid") / 1024) / CHI_MEDIAN)
    judged = rows.join(final, "group").withColumn("distance", F.greatest(_distance(), F.lit(0.0)) / scale)
    judged = judged.withColumn("kept", ~F.col("base_failed") & (F.col("distance") <= CUTOFF))
    return judged.select("doc_id", "key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "distance"), tables


def quality_verdicts(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, counts, base_failed, kept, distance), one per row of ``docs``."""
    return judge(docs)[0].drop("key")


def keep_accepted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all columns, whatever their names.

    While the keys of rejected rows are within the broadcast bound no text is shuffled.
    """
    judged, tables = judge(docs)
    gone = bounded(tables.put(judged.where(~F.col("kept")).select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "key").distinct(), "gone"))
    tables.drop("rows", "estimate")
    same = (F.coalesce(docs["doc_id"].cast("string"), F.lit("")) == gone["id"]) & (F.xxhash64(docs["text"]) == gone["key"])
    return docs.join(gone, same, "left_anti")
