"""Linking a stream of new source records against a static set of targets."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tessera.operators.features import ModelBundle
from tessera.plans.linkage import infer


def link_stream(new_records: DataFrame, targets: DataFrame, output: str, checkpoint: str, model: ModelBundle | None = None, **options) -> StreamingQuery:
    """Each micro-batch is linked as a whole and written under its number: a batch that runs again replaces its own rows."""

    def link(batch: DataFrame, number: int) -> None:
        results, _ = infer(batch, targets, model, **options)
        results.write.mode("overwrite").parquet(f"{output}/batch={number}")

    return new_records.writeStream.foreachBatch(link).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
