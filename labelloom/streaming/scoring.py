"""Scoring articles as their files arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from labelloom.plans.workflow import LabelModel


def score_stream(spark: SparkSession, model: LabelModel, source: str, schema: StructType,
                 target: str, checkpoint: str, fmt: str = "parquet",
                 prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
                 trigger: dict | None = None) -> StreamingQuery:
    """Predict every new file under ``source`` and append ``(Id, Category)`` under ``target``.

    ``prepare`` shapes the arriving rows into articles. Each micro-batch runs the batch plan and writes
    its own folder, so a batch that is repeated after a failure replaces what it had written.
    ``trigger`` is that of Spark's stream writer; without one, what has arrived is scored and the query ends.
    """
    arriving = spark.readStream.format(fmt).schema(schema).load(source)

    def write(batch: DataFrame, batch_id: int) -> None:
        model.predict(prepare(batch)).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return (arriving.writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())
