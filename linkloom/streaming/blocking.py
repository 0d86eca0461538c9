"""Candidates of records that arrive as a stream, against a pool at rest.

Weights depend on the pool alone, so records are independent of each other and the result
doesn't depend on where micro-batches begin. The stream's checkpoint takes the place of a
manifest of finished chunks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from linkloom.operators.blocking import BlockingConfig, build_candidates


def stream_candidates(s1: DataFrame, s2: DataFrame, s3: DataFrame, out: str, checkpoint: str, config: BlockingConfig = BlockingConfig()) -> StreamingQuery:
    """Writes the candidates of each micro-batch of ``s1`` to ``out``; a batch that is run again writes the same folder again."""

    def put(batch: DataFrame, number: int) -> None:
        build_candidates(batch, s2, s3, config).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return s1.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
