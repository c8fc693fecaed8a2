"""An incremental unit table: new documents are flattened and merged as they come."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from statuta.operators import documents
from statuta.operators import units as U


def merge_batch(spark: SparkSession, target: str, batch: DataFrame, batch_id: int) -> None:
    """Write the units of one batch of documents next to the earlier ones.

    A batch goes to a folder of its own number, so a batch that is run again
    after a failure replaces itself.
    """
    built = documents.build_units(batch).withColumn("unit_id", F.xxhash64("raw_id", "ord"))
    U.normalised(built.withColumns({"annex_no": F.lit(None).cast("string")})).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")


def current_units(spark: SparkSession, target: str) -> DataFrame:
    """The first unit of each stable key over all batches."""
    rows = spark.read.option("mergeSchema", "true").parquet(target)
    order = rows.withColumn("unit_id", F.struct("batch", "raw_id", "ord"))
    return U.deduplicated(order).drop("unit_id")


def follow(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str) -> StreamingQuery:
    """Follow a folder of raw documents; every file that appears is one batch's input."""
    stream = spark.readStream.schema(schema).parquet(source)
    return (
        stream.writeStream.foreachBatch(lambda batch, number: merge_batch(spark, target, batch, number))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events by type in tumbling windows; events later than ``late`` are dropped."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return timed.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("w.start").alias("start"), "event_type", "n"
    )
