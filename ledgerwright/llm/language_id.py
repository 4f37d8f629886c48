"""Language identification: known words first, then ever shorter character n-grams.

Words are runs of letters, lower-cased. All words of all training texts are counted
per language (a partial count in each task, then one aggregate). The model keeps the
``WORDS`` most frequent words and the ``GRAMS`` most frequent character n-grams of each
length, over all languages together, so its size is bounded whatever the corpus. A
known word adds its log frequency per language. An unseen word is read from its start:
at each place the longest known n-gram counts, from ``LONGEST`` characters down to one;
n-gram counts come from the counted words, with the word's edges marked.

Defined cases: a null text or one without letters is ``und`` with score 0; without
training rows every text is ``und``; equal scores give the first language by name;
null languages are not learned; rows that repeat are judged each; an empty table gives
an empty result; other columns are never inputs.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Tables, crc32_mod

WORDS = 50_000       # words of the model, at most
GRAMS = 10_000       # n-grams of each length in the model, at most
LONGEST = 4
FLUSH = 200_000      # distinct words that a task holds before it passes its counts on
SMOOTH = 0.1
UNSEEN = -12.0       # log frequency, per language, of a character that no n-gram knows

_LETTERS = re.compile(r"[^\W\d_]+")


def word_counts(docs: DataFrame) -> DataFrame:
    """Rows (lang, word, n) over all texts; each task passes partial counts on."""
    def run(batches):
        held: dict[str, Counter] = {}

        def out():
            rows = [(lang, w, n) for lang, c in held.items() for w, n in c.items()]
            kinds = (pa.string(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["lang", "word", "n"])
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                held.setdefault(lang, Counter()).update(_LETTERS.findall(text.lower()))
                if sum(map(len, held.values())) > FLUSH:
                    yield out()
                    held = {}
        if held:
            yield out()
    parts = docs.select("lang", "text").where("lang is not null and text is not null").mapInArrow(
        run, "lang string, word string, n long")
    return parts.groupBy("lang", "word").agg(F.sum("n").alias("n"))


class Model:
    """Log frequencies per language: one row a word, then one an n-gram, then one for unknown characters."""

    def __init__(self, langs: list[str], words: list[str], grams: list[str], logs: np.ndarray):
        self.langs, self.logs = langs, logs
        self.words = {w: i for i, w in enumerate(words)}
        self.grams = {g: i for i, g in enumerate(grams, len(words))}
        self.unknown = len(logs) - 1

    def backoff(self, word: str) -> list[int]:
        """Rows of the longest known n-grams from the start of the word to its end."""
        marked, at, out, known = f"<{word}>", 0, [], self.grams
        while at < len(marked):
            for size in range(min(LONGEST, len(marked) - at), 0, -1):
                row = known.get(marked[at:at + size])
                if row is not None:
                    out.append(row)
                    break
            else:
                size = 1
                out.append(self.unknown)
            at += size
        return out

    def scores(self, text: str) -> np.ndarray | None:
        """Summed log frequencies per language; None if the text has no letters."""
        found = Counter(_LETTERS.findall(text.lower()))
        if not found:
            return None
        rows, times = [], []
        for word, n in found.items():
            row = self.words.get(word)
            if row is not None:
                rows.append(row)
                times.append(n)
            else:
                parts = self.backoff(word)
                rows += parts
                times += [n] * len(parts)
        return np.array(times, float) @ self.logs[rows]


def _logs(table: pa.Table, langs: list[str], totals: dict[str, int]) -> tuple[list[str], np.ndarray]:
    """Items of (item, lang, n) in order and their log frequencies, a row each."""
    items = table.column(0).to_pylist()
    at = {item: i for i, item in enumerate(sorted(set(items)))}
    column = {lang: i for i, lang in enumerate(langs)}
    counts = np.full((len(at), len(langs)), SMOOTH)
    for item, lang, n in zip(items, table.column(1).to_pylist(), table.column(2).to_pylist()):
        counts[at[item], column[lang]] += n
    return list(at), np.log(counts / (np.array([totals.get(x, 0) for x in langs], float) + SMOOTH))


def train(docs: DataFrame) -> Model:
    """Counts over all of ``docs``; only the bounded model reaches the driver."""
    tables = Tables(docs.sparkSession, "language-id")
    counts = tables.put(word_counts(docs), "counts")
    totals = {r.lang: r.n for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(totals)

    def top(rows: DataFrame, item: str, limit: int) -> pa.Table:
        best = rows.groupBy(item).agg(F.sum("n").alias("all")).orderBy(F.desc("all"), item).limit(limit).select(item)
        return rows.join(F.broadcast(best), item).select(item, "lang", "n").toArrow()
    words, word_logs = _logs(top(counts, "word", WORDS), langs, totals)
    marked = F.concat(F.lit("<"), F.col("word"), F.lit(">"))
    grams: list[str] = []
    logs = [word_logs]
    for size in range(1, LONGEST + 1):
        places = F.sequence(F.lit(1), F.greatest(F.length("marked") - size + 1, F.lit(1)))
        rows = (counts.withColumn("marked", marked).select("lang", "marked", "n", F.explode(places).alias("at"))
                .select("lang", "n", F.substring("marked", F.col("at"), F.lit(size)).alias("gram"))
                .where(F.length("gram") == size).groupBy("lang", "gram").agg(F.sum("n").alias("n")))
        rows = tables.put(rows, f"grams-{size}")
        sums = {r.lang: r.n for r in rows.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
        names, gram_logs = _logs(top(rows, "gram", GRAMS), langs, sums)
        grams += names
        logs.append(gram_logs)
        tables.drop(f"grams-{size}")
    tables.drop("counts")
    return Model(langs, words, grams, np.concatenate([*logs, np.full((1, len(langs)), UNSEEN)]))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """Rows (doc_id, lang_pred, score), one per row of ``docs``; score is the language's share of belief."""
    sent = docs.sparkSession.sparkContext.broadcast((model.langs, list(model.words), list(model.grams), model.logs))

    def run(batches):
        own = Model(*sent.value)
        for batch in batches:
            best, share = [], []
            for text in batch.column("text").to_pylist():
                sums = own.scores(text) if text and own.langs else None
                if sums is None:
                    best.append("und")
                    share.append(0.0)
                    continue
                k = int(np.argmax(sums))
                best.append(own.langs[k])
                share.append(float(1.0 / np.exp(np.maximum(sums - sums[k], -700)).sum()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(best, pa.string()),
                                              pa.array(share, pa.float64())], ["doc_id", "lang_pred", "score"])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, held_out, lang_pred, score); rows held out (id hash modulo 4 is 2) are never learned."""
    held_out = crc32_mod(F.col("doc_id"), 4) == 2
    return predict(docs, train(docs.where(~held_out))).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score")
