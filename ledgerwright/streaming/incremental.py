"""Incremental loads as Structured Streaming.

The original job polls each source every minute and keeps a high-watermark
per target. With a file source, Structured Streaming keeps that watermark
itself: the checkpoint records which landed files were processed, and each
trigger sees only new ones. Every micro-batch is handed to a conflict policy
that turns (current table, batch) into the next table version in the
:class:`~ledgerwright.operators.tables.TableStore`.

Exactly once: a micro-batch replayed after a failure carries the same
``epoch_id`` for the same checkpoint; the version it produced is tagged with
(checkpoint, epoch), so a replay that finds its own tag on the newest version
does nothing.
"""

from __future__ import annotations

import hashlib

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import conflict
from ..operators.dedup import first_by, last_by
from ..operators.tables import TableStore

Policy = Callable[[DataFrame | None, DataFrame], DataFrame]


def upsert_policy(keys: Sequence[str], order: Sequence[str]) -> Policy:
    def apply(target: DataFrame | None, batch: DataFrame) -> DataFrame:
        if target is None:
            return last_by(batch, keys, order)
        return conflict.upsert(target, batch, keys, order)
    return apply


def insert_if_absent_policy(keys: Sequence[str], order: Sequence[str]) -> Policy:
    def apply(target: DataFrame | None, batch: DataFrame) -> DataFrame:
        if target is None:
            return first_by(batch, keys, order)
        return conflict.insert_if_absent(target, batch, keys, order)
    return apply


def append_policy() -> Policy:
    def apply(target: DataFrame | None, batch: DataFrame) -> DataFrame:
        return batch if target is None else conflict.append(target, batch)
    return apply


def load_landed_files(spark: SparkSession, landing_dir: str, schema: T.StructType, store: TableStore,
                      table: str, policy: Policy, checkpoint: str | None = None,
                      max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Apply ``policy`` to every new parquet file landed in ``landing_dir`` (``availableNow``).

    Returns the started query; ``awaitTermination()`` returns once every file
    landed so far is loaded. The checkpoint lives in the store's shared folder.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(landing_dir)

    checkpoint = checkpoint or f"{store.root}/_streams/{table}"
    stream_tag = hashlib.sha1(checkpoint.encode()).hexdigest()[:12]

    def apply(batch: DataFrame, epoch_id: int) -> None:
        marker = f"{stream_tag}-{epoch_id}"
        if store.has_marker(table, marker):
            return
        current = store.read(table) if store.exists(table) else None
        store.write(table, policy(current, batch), marker=marker)

    return (stream.writeStream.foreachBatch(apply)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())


def load_delivery_pages(spark: SparkSession, landing_dir: str, store: TableStore,
                        table: str = "deliveries", checkpoint: str | None = None) -> StreamingQuery:
    """Courier-API delivery pages (one JSON array per line of the landed files) into staging.

    Each micro-batch lands the page elements as raw text (unique content),
    types them with quarantine, inserts the deliveries whose id is new and
    appends rejected rows to ``<table>_quarantine``. Re-delivered pages and
    overlapping elements are absorbed by the insert-if-absent policy.
    """
    from ..plans import dims

    checkpoint = checkpoint or f"{store.root}/_streams/{table}"
    stream_tag = hashlib.sha1(checkpoint.encode()).hexdigest()[:12]
    policy = insert_if_absent_policy(["delivery_id"], ["delivery_ts", "courier_id"])
    pages = spark.readStream.text(landing_dir).withColumnRenamed("value", "content")

    def apply(batch: DataFrame, epoch_id: int) -> None:
        marker = f"{stream_tag}-{epoch_id}"
        if store.has_marker(table, marker):
            return
        good, bad = dims.stg_deliveries_checked(dims.land_pages(batch))
        good = good.drop("load_ts")
        store.write(f"{table}_quarantine", bad if not store.exists(f"{table}_quarantine")
                    else append_policy()(store.read(f"{table}_quarantine"), bad))
        current = store.read(table) if store.exists(table) else None
        store.write(table, policy(current, good), marker=marker)

    return (pages.writeStream.foreachBatch(apply)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())
