"""New files as a stream: each micro-batch goes through the same plans as a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from leafmill.plans import pipeline
from leafmill.sources import files

SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def watch(spark: SparkSession, source: str, target: str, checkpoint: str, config: pipeline.Config | None = None, once: bool = False) -> StreamingQuery:
    """Append the records of files that appear under `source` to the Parquet table `target`. once: stop when all there now are done.

    A batch that is repeated after a failure overwrites its own folder, so records appear once.
    """
    config = config or pipeline.Config()
    stream = spark.readStream.format("binaryFile").schema(SCHEMA).option("recursiveFileLookup", "true").load(source)

    def each(batch: DataFrame, number: int) -> None:
        parsed = files.parse(batch.select(F.xxhash64("path").alias("key"), "path", "content"))
        pipeline.run(pipeline.load(parsed, config), config).write.mode("overwrite").parquet(f"{target}/batch={number}")

    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
