"""Byte-level BPE encoding and decoding with content-defined chunk reuse.

A text is cut where a hash of the last eight bytes meets a mask, so equal passages
fall into equal chunks wherever they stand. Chunks that occur again in the corpus
are encoded once, in a dictionary of bounded size ordered by the bytes it saves; all
other chunks are encoded where they are met. A cut may change the tokens around it,
so a chunk's tokens are used only between its first and last *safe* place: a single
space between two printable ASCII characters, where the pre-tokenizer always starts a
new piece, whatever stands around. Each join, from the last safe place of one chunk to
the first of the next (across whole chunks that hold fewer than two), is encoded again,
so the result agrees exactly with encoding the text whole.

The dictionary is bounded (``DICTIONARY`` chunks of ``DICTIONARY_CHUNK`` bytes), which departs from
encoding every shared chunk once: a chunk beyond it is encoded at each of its places, with the same tokens.

Defined cases: null and empty texts have no tokens; special tokens written in a text
become their ids, as the vocabulary's own library does; rows that repeat are encoded
each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops
from .common import Tables, vocabulary_path

CHUNK_BITS = 10            # chunks of about 1024 bytes
DICTIONARY = 20_000        # chunks in the shared dictionary, at most
DICTIONARY_CHUNK = 8192    # bytes of a dictionary chunk, at most: 20 MB of tokens in usual text

#: Pre-tokenizer pattern of the byte-level vocabularies (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_PRINTABLE = np.zeros(256, dtype=bool)
_PRINTABLE[0x21:0x7F] = True


def _byte_alphabet() -> dict[str, int]:
    """Characters that stand for bytes: printable ones for themselves, the rest from U+0100 on."""
    same = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in same]
    return {chr(b): b for b in same} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """Exact encoder and decoder of one vocabulary file."""

    def __init__(self, vocabulary: str):
        with open(vocabulary_path(vocabulary), encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = _byte_alphabet()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(alphabet[c] for c in token): i
                 for token, i in spec["model"]["vocab"].items() if token not in special}
        self.special = special
        self.split = re.compile("(" + "|".join(sorted(map(re.escape, special), key=len, reverse=True)) + ")") \
            if special else None
        self.encoding = tiktoken.Encoding("corpus", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        size = max([*ranks.values(), *special.values()]) + 1
        self.token = [b""] * size
        for token, i in ranks.items():
            self.token[i] = token
        for token, i in special.items():
            self.token[i] = token.encode()
        self.decimal = [str(i) for i in range(size)]
        self.packed = np.uint16 if size <= 1 << 16 else np.int32  # of an id in the dictionary

    def plain(self, text: bytes) -> list[int]:
        return self.encoding.encode_ordinary(text.decode())

    def encode(self, text: bytes, dictionary: dict[int, list[int]]) -> list[int]:
        """Tokens of a whole text, with dictionary chunks reused."""
        if self.split is None or not any(s.encode() in text for s in self.special):
            return self._segment(text, dictionary)
        out = []
        for part in self.split.split(text.decode()):
            out += [self.special[part]] if part in self.special else self._segment(part.encode(), dictionary)
        return out

    def _segment(self, text: bytes, dictionary: dict[int, list[int]]) -> list[int]:
        out, done = [], 0
        if dictionary:
            for key, start, end in chunks(text):
                known = dictionary.get(key)
                if known is not None:
                    if start > done:
                        out += self.plain(text[done:start])  # the join
                    out += known
                    done = end
        return out + self.plain(text[done:]) if done < len(text) else out

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.token.__getitem__, ids)).decode("utf-8", errors="replace")


@lru_cache(maxsize=2)
def codec(vocabulary: str) -> Codec:
    return Codec(vocabulary)


def chunks(text: bytes) -> list[tuple[int, int, int]]:
    """(key, start, end) of each chunk's part between its first and last safe place."""
    n = len(text)
    if n < 64:
        return []
    buf = np.frombuffer(text, dtype=np.uint8)
    window = np.ndarray(shape=(n - 7,), dtype="<u8", buffer=text, strides=(1,))
    hit = (window * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - CHUNK_BITS) == 0
    cuts = np.concatenate([[0], np.flatnonzero(hit) + 8, [n]])
    printable = _PRINTABLE[buf]
    safe = np.flatnonzero((buf[1:-1] == 32) & printable[:-2] & printable[2:]) + 1
    if len(safe) < 2:
        return []
    low = np.searchsorted(safe, cuts[:-1])
    high = np.searchsorted(safe, cuts[1:]) - 1
    out = []
    for a, b in zip(low.tolist(), high.tolist()):
        if a < b:
            start, end = int(safe[a]), int(safe[b])
            if 64 <= end - start <= DICTIONARY_CHUNK:
                key = hashlib.blake2b(text[start:end], digest_size=8).digest()
                out.append((int.from_bytes(key, "little", signed=True), start, end))
    return out


def _texts(batch: pa.RecordBatch):
    buf, offs = textops.text_buffer(batch.column("text"))
    for i in range(batch.num_rows):
        yield buf[offs[i]:offs[i + 1]].tobytes()


def shared_chunks(docs: DataFrame, vocabulary: str) -> dict[int, bytes]:
    """The dictionary: packed tokens of the recurring chunks that save most, at most ``DICTIONARY`` of them.

    All chunks of all documents are counted; only the bounded dictionary reaches the
    driver, as bytes, and the chunks it leaves out are encoded where they occur.
    """
    tables = Tables(docs.sparkSession, "bpe")

    def keys(batches):
        for batch in batches:
            found = [(k, e - s) for text in _texts(batch) for k, s, e in chunks(text)]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)],
                                             ["key", "size"])
    best = (docs.select("text").mapInArrow(keys, "key long, size long")
            .groupBy("key").agg(F.count("*").alias("n"), F.max("size").alias("size")).where("n > 1")
            .orderBy(F.desc(F.expr("(n - 1) * size")), "key").limit(DICTIONARY).select("key"))
    wanted = set(best.toArrow().column("key").to_pylist())
    if not wanted:
        return {}
    sent = docs.sparkSession.sparkContext.broadcast(wanted)

    def bodies(batches):
        met = set()
        for batch in batches:
            rows = []
            for text in _texts(batch):
                for key, start, end in chunks(text):
                    if key in sent.value and key not in met:
                        met.add(key)
                        rows.append((key, text[start:end]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())],
                ["key", "body"])

    def encode(batches):
        for batch in batches:
            ids = [codec(vocabulary).plain(b) for b in batch.column("body").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array([np.array(x, codec(vocabulary).packed).tobytes() for x in ids], pa.binary())],
                ["key", "ids"])
    once = (docs.select("text").mapInArrow(bodies, "key long, body binary")
            .groupBy("key").agg(F.min("body").alias("body")).mapInArrow(encode, "key long, ids binary"))
    rows = tables.put(once, "dictionary").toArrow()
    tables.drop("dictionary")
    return dict(zip(rows.column("key").to_pylist(), rows.column("ids").to_pylist()))


def encode_documents(docs: DataFrame, vocabulary: str, keep: tuple[str, ...] = ("ids",)) -> DataFrame:
    """Rows (doc_id, n_tokens, ids_sha256, decoded_sha256) and, if in ``keep``, ids and decoded.

    ``decoded`` is what decoding the ids gives, special tokens included.
    """
    dictionary = docs.sparkSession.sparkContext.broadcast(shared_chunks(docs, vocabulary))
    kinds = {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string(),
             "ids": pa.list_(pa.int32()), "decoded": pa.string()}
    names = ["n_tokens", "ids_sha256", "decoded_sha256", *keep]

    def run(batches):
        tool = codec(vocabulary)
        known = _Lists(dictionary.value, tool.packed)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                rows = {n: [] for n in names}
                for text in _texts(batch):
                    ids = tool.encode(text, known)
                    decoded = tool.decode(ids)
                    rows["n_tokens"].append(len(ids))
                    joined = ",".join(map(tool.decimal.__getitem__, ids))
                    rows["ids_sha256"].append(hashlib.sha256(joined.encode()).hexdigest())
                    rows["decoded_sha256"].append(hashlib.sha256(decoded.encode()).hexdigest())
                    if "ids" in rows:
                        rows["ids"].append(np.array(ids, np.int32))
                    if "decoded" in rows:
                        rows["decoded"].append(decoded)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *(pa.array(rows[n], kinds[n]) for n in names)], ["doc_id", *names])
    types = {"n_tokens": "long", "ids": "array<int>"}
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, ", ".join(["doc_id long", *(f"{n} {types.get(n, 'string')}" for n in names)]))


class _Lists:
    """Token lists of the packed dictionary."""

    def __init__(self, packed: dict[int, bytes], kind: type):
        self.packed, self.kind = packed, kind

    def __bool__(self) -> bool:
        return bool(self.packed)

    def get(self, key: int) -> list[int] | None:
        ids = self.packed.get(key)
        return None if ids is None else np.frombuffer(ids, dtype=self.kind).tolist()


def decode_documents(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """Rows (doc_id, text) decoded from (doc_id, ids); null ids decode to an empty text."""
    def run(batches):
        for batch in batches:
            texts = [codec(vocabulary).decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())],
                                             ["doc_id", "text"])
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
