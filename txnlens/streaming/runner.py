"""Starting streams. The checkpoint belongs to the writer and lies in a shared folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from txnlens.operators.bursts import fraud_alerts
from txnlens.sinks.alerts import compact_alerts, write_alert_batch

BatchHandler = Callable[[DataFrame, int], None]


PARTITIONS = "spark.sql.shuffle.partitions"


def start(
    df: DataFrame,
    handle: BatchHandler,
    checkpoint: str,
    *,
    every: str | None = None,
    drain: bool = False,
    partitions: int | None = None,
) -> StreamingQuery:
    """Run ``handle(batch, batch_id)`` on each micro-batch.

    Batches follow each other without pause, or start ``every`` so often;
    ``drain`` takes what is there now and ends. ``partitions`` is the number of the stream's
    shuffle partitions, else the session's. A new checkpoint keeps its number for good, and each partition of
    each stateful operator writes files in every batch, up to four stores of a join, however few its rows.
    """
    writer = df.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if drain:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    if not partitions:
        return writer.start()
    # A stream copies the session's settings when it starts.
    conf = df.sparkSession.conf
    before = conf.get(PARTITIONS)
    conf.set(PARTITIONS, partitions)
    try:
        return writer.start()
    finally:
        conf.set(PARTITIONS, before)


def start_parquet(
    df: DataFrame, path: str, checkpoint: str, *, every: str | None = None, drain: bool = False
) -> StreamingQuery:
    """Append the stream's rows to Parquet files."""
    writer = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    if drain:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()


def start_console(df: DataFrame, checkpoint: str, *, drain: bool = False) -> StreamingQuery:
    """Print the first rows of each batch, for debugging."""
    writer = df.writeStream.format("console").option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if drain else writer).start()


#: Batches after which the alert table is compacted.
COMPACT_EVERY = 50


def burst_handler(path: str, *, compact_every: int | None = COMPACT_EVERY, **params) -> BatchHandler:
    """Stores the alerts found within each micro-batch by ``fraud_alerts``.

    A burst that is split over two batches is not seen; ``stateful_alerts`` sees it.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            store(fraud_alerts(batch, **params), batch_id, path, compact_every)
        finally:
            batch.unpersist()

    return handle


def store_handler(path: str, *, compact_every: int | None = COMPACT_EVERY) -> BatchHandler:
    """Stores rows that are alerts already."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        store(batch, batch_id, path, compact_every)

    return handle


def store(alerts: DataFrame, batch_id: int, path: str, compact_every: int | None) -> None:
    """Adds a batch to the alert table, which is compacted now and then between two batches."""
    write_alert_batch(alerts, batch_id, path)
    if compact_every and (batch_id + 1) % compact_every == 0:
        compact_alerts(alerts.sparkSession, path)
