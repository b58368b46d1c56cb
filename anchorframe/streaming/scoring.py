"""Scoring a stream of new rows against a saved clustering.

Scoring keeps no state between rows, so each micro-batch goes through the same
function as a batch table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from anchorframe.operators.score import ClusterBundle, score_rows


def start_scoring(
    stream: DataFrame, bundle: ClusterBundle, output: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Score every micro-batch and write it to its own folder, so a replayed batch replaces its first attempt."""

    def write(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()  # scoring reads the batch more than once
        try:
            score_rows(held, bundle).write.mode("overwrite").parquet(f"{output}/batch_id={batch_id}")
        finally:
            held.unpersist()

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
