"""An extra: the same batch functions over arriving files. Results are batch results, one commit a micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quillspark.sources.readers import DOCUMENT_TREE


def ingest(spark: SparkSession, source: str, target: str, checkpoint: str, extract: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """Runs extract on each batch of new document files and appends its rows to target, then ends (available now).

    A batch that is run again after a failure writes to its own folder again, so no row is there twice.
    """

    def write(batch: DataFrame, number: int) -> None:
        extract(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    stream = spark.readStream.schema(DOCUMENT_TREE).json(source)
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
