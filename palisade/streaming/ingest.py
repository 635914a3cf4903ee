"""Topic to bronze: readable messages, dead letters and counts of every micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from palisade.session import scratch, settle
from palisade.sinks import folders
from palisade.sinks.messages import dead_letters
from palisade.sources.messages import batch_stats, parse_messages, readable, unreadable


def write_batch(batch: DataFrame, path: str, batch_id: int) -> None:
    """One folder per micro-batch, written once.

    A batch that is tried again has the same rows. If its folder is complete it stays as it is, with the files that a
    later stream may have read already; otherwise it is written anew.
    """
    folder = f"{path}/batch_id={batch_id}"
    if not folders.exists(batch.sparkSession, f"{folder}/_SUCCESS"):
        batch.write.mode("overwrite").parquet(folder)


def run_available(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Process what has arrived since the checkpoint, then stop."""
    query = (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def ingest(messages: DataFrame, topic: str, bronze: str, letters: str, stats: str, checkpoint: str) -> StreamingQuery:
    """Split each batch of messages into bronze rows and dead letters, and keep its counts.

    A batch feeds three writes, so it is parsed once and written to the shared folder while they run. The source's
    per-trigger limit bounds it, but nothing is held in memory if it has none.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        with scratch(batch.sparkSession):
            parsed = settle(parse_messages(batch), "parsed")
            write_batch(readable(parsed), bronze, batch_id)
            write_batch(dead_letters(unreadable(parsed), topic), letters, batch_id)
            write_batch(batch_stats(parsed), stats, batch_id)

    return run_available(messages, handle, checkpoint)


def total_stats(stats: DataFrame) -> DataFrame:
    return stats.agg(*[F.sum(name).alias(name) for name in ("total", "success", "failures")])
