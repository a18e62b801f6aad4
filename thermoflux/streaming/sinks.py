"""Sinks for streaming outputs.

``start_tagged`` writes the main and side outputs of one tagged stream in a
single ``foreachBatch``: the micro-batch is persisted once, each tag is written
to its own table folder, and every batch goes to an ``epoch=<id>`` sub-folder
with overwrite, so a batch replayed after a failure replaces its own files
(idempotent, exactly-once output).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def start_tagged(stream: DataFrame, outputs: dict[str, str], checkpoint: str, tag_col: str = "tag",
                 trigger: dict | None = None) -> StreamingQuery:
    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        batch.persist()
        try:
            for tag, path in outputs.items():
                (batch.filter(F.col(tag_col) == F.lit(tag)).drop(tag_col)
                      .write.mode("overwrite").parquet(os.path.join(path, f"epoch={epoch_id}")))
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    return writer.start()


def start_parquet(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                  output_mode: str = "append") -> StreamingQuery:
    writer = (stream.writeStream.format("parquet").outputMode(output_mode)
                    .option("path", path).option("checkpointLocation", checkpoint))
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def start_print(stream: DataFrame, rows: int = 20, trigger: dict | None = None, output_mode: str = "append") -> StreamingQuery:
    """Print each micro-batch's first ``rows`` rows to the driver's console."""
    writer = stream.writeStream.format("console").outputMode(output_mode).option("numRows", rows).option("truncate", "false")
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def start_memory(stream: DataFrame, name: str, trigger: dict | None = None, output_mode: str = "append") -> StreamingQuery:
    """Collect the output into the driver's in-memory table ``name``; for looking, not for volume."""
    writer = stream.writeStream.format("memory").queryName(name).outputMode(output_mode)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
