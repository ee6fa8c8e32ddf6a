"""Running streams, and tables that keep the latest value per key."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.dedup import top1

BATCH_COLUMN = "batch_id"
BatchWriter = Callable[[DataFrame, int], None]


def batch_run(batch_id: int) -> str:
    """The run that a micro-batch writes; a replayed batch replaces its own."""
    return f"batch_{batch_id:09d}"


def run_stream(
    stream: DataFrame,
    write_batch: BatchWriter,
    checkpoint: str,
    output_mode: str = "update",
    interval: str | None = None,
) -> StreamingQuery:
    """Process everything that has landed and stop, or poll at ``interval`` when one is given."""
    writer = stream.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).foreachBatch(write_batch).start()


def drain(stream: DataFrame, write_batch: BatchWriter, checkpoint: str, output_mode: str = "update") -> None:
    run_stream(stream, write_batch, checkpoint, output_mode).awaitTermination()


def changes_to(path: str) -> BatchWriter:
    """Append each batch's changed rows under its batch id; a replayed batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH_COLUMN}={batch_id}")

    return write


def latest_changes(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The newest row per key of a table written by ``changes_to``."""
    changes = spark.read.parquet(path)
    return top1(changes, keys, [F.desc(BATCH_COLUMN)]).drop(BATCH_COLUMN)
