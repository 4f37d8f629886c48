"""Secret scans: fixed patterns, and strings that a tokenizer cannot shorten.

Patterns find assignments, access keys and hex strings. Beyond them, a run of
letters, digits and the signs ``+/_=-`` is taken for random when a byte-pair
vocabulary needs many tokens for it: fewer than ``MIN_RATIO`` characters a token. Where
a run as a whole is not, its parts between ``/`` and ``=`` and its stretches without
words are tested each, so plain words beside a key don't hide it; what pattern spans
leave of a run is tested like a run. Known digests (hex strings of a digest's length), UUIDs and identifiers (words,
camel-case parts and short numbers joined by signs) are excluded first. No added span
overlaps a pattern's span.

Defined cases: a null text has no spans; positions are code points, end exclusive;
equal starts follow the order of kinds; rows that repeat are scanned each; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import PATTERN
from .common import vocabulary_path

MIN_RATIO = 2.0      # characters a token; prose has three or more
MIN_LENGTH = 20      # characters of a random string
MASK = "[SECRET]"

KINDS = ("assign", "access", "hex", "random")

#: Patterns (fixed values).
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.IGNORECASE | re.ASCII)
_KEYWORD = re.compile(r"passw(?:or)?d|secret|token|api_?key", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_LENGTH)
_UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
_DIGEST = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)")
_DIGEST_LENGTHS = {32, 40, 48, 56, 64, 96, 128}
_PART = re.compile(r"[^/=]+")
_PIECE = re.compile(r"[A-Za-z0-9]+")
_LONG = re.compile(r"[a-z]{%d,}|[A-Z]{%d,}" % (MIN_LENGTH, MIN_LENGTH))
_WORDY = re.compile(r"(?:[A-Z]?[a-z]{2,}|[A-Z]{2,}|[0-9]{1,4})+")


@lru_cache(maxsize=2)
def _vocabulary(path: str) -> tiktoken.Encoding:
    with open(vocabulary_path(path), "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("secrets", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _excluded(run: str) -> bool:
    """Digests, UUIDs and identifiers."""
    if _UUID.fullmatch(run) or _DIGEST.fullmatch(run) and len(run) in _DIGEST_LENGTHS:
        return True
    parts = _PIECE.findall(run)
    return sum(len(p) for p in parts if _word(p)) >= 0.8 * sum(map(len, parts))


def _word(part: str) -> bool:
    """The shape of words and short numbers; a very long word is left to the vocabulary."""
    return bool(_WORDY.fullmatch(part)) and not _mixed(part) and not _LONG.search(part)


def _mixed(part: str) -> bool:
    """Many changes between letters and digits or cases, as random text has."""
    kinds = re.findall(r"[A-Z]+|[a-z]+|[0-9]+", part)
    return len(kinds) > max(3, len(part) / 4)


def _stretches(run: str):
    """(start, end) of every longest stretch of neighbouring parts that are no words."""
    start = end = None
    for m in _PIECE.finditer(run):
        if not _word(m[0]):
            start, end = m.start() if start is None else start, m.end()
        elif start is not None:
            yield start, end
            start = None
    if start is not None:
        yield start, end


def _random(run: str, vocabulary: str, min_ratio: float) -> list[tuple[int, int]]:
    """(start, end) of ``run`` where it is random as a whole, else of its random parts and stretches."""
    def hard(start: int, end: int) -> bool:
        part = run[start:end]
        return (len(part) >= MIN_LENGTH and not _excluded(part)
                and len(part) < min_ratio * len(_vocabulary(vocabulary).encode_ordinary(part)))
    if len(run) < MIN_LENGTH or _UUID.fullmatch(run):
        return []
    if hard(0, len(run)):
        return [(0, len(run))]
    tried = sorted({*(m.span() for m in _PART.finditer(run)), *_stretches(run)} - {(0, len(run))})
    out = []
    for start, end in (x for x in tried if hard(*x)):
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def find(text: str, vocabulary: str, min_ratio: float = MIN_RATIO) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of every span, sorted."""
    base = []
    if _KEYWORD.search(text):
        base += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        base += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    base += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    added = []
    for m in _RUN.finditer(text):
        at, end = m.span()
        for s, e in sorted((s, e) for s, _, e in base if s < end and at < e) + [(end, end)]:
            added += [(at + x, 3, at + y) for x, y in _random(text[at:s], vocabulary, min_ratio)]
            at = max(at, e)
    return sorted(base + added)


def _masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    out, done = [], 0
    for start, _, end in spans:
        if start >= done:
            out += [text[done:start], MASK]
        done = max(done, end)
    return "".join(out) + text[done:]


def scan(docs: DataFrame, vocabulary: str, min_ratio: float = MIN_RATIO) -> DataFrame:
    """All columns of ``docs`` but clashing ones, and n_assign, n_access, n_hex, n_random, base_sha256, spans.

    ``spans`` joins kind:start:end of all spans.
    """
    found = ["n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans"]
    rows = docs.select(*(c for c in docs.columns if c not in found))

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            columns = {n: [] for n in found}
            for text in texts:
                spans = find(text, vocabulary, min_ratio) if text else []
                for k in range(4):
                    columns[found[k]].append(sum(s[1] == k for s in spans))
                told = [f"{KINDS[k]}:{s}:{e}" for s, k, e in spans]
                base = ",".join(t for t, s in zip(told, spans) if s[1] < 3)
                columns["base_sha256"].append(hashlib.sha256(base.encode()).hexdigest())
                columns["spans"].append(",".join(told))
            out = dict(zip(batch.schema.names, batch.columns))
            out |= {n: pa.array(v, pa.int64() if n[:2] == "n_" else pa.string()) for n, v in columns.items()}
            yield pa.RecordBatch.from_arrays(list(out.values()), list(out))
    added = [T.StructField(n, T.LongType() if n[:2] == "n_" else T.StringType()) for n in found]
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, *added]))


def mask_secrets(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``docs`` with every secret masked in the text; n_chars, where present, follows the text."""
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            texts = [t and _masked(t, find(t, vocabulary)) for t in batch.column(at).to_pylist()]
            columns = [*batch.columns[:at], pa.array(texts, batch.schema.field(at).type), *batch.columns[at + 1:]]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)
    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType),
                                                   F.col("n_chars")))
    return out
