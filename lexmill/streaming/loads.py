"""Structured Streaming forms of the loads and of the status log."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lexmill.operators.load import one_per_key


def issue_stream(spark: SparkSession, folder: str, files_per_batch: int = 250) -> DataFrame:
    """STR-04: issue files as a stream, so many a micro-batch."""
    read = spark.readStream.format("text").option("wholetext", True).option("recursiveFileLookup", True)
    read = read.option("pathGlobFilter", "*.md").option("maxFilesPerTrigger", files_per_batch)
    return read.load(folder).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


#: Hash ranges of the key that a target is laid out in; a batch reads only those it has keys in.
RANGES = 64


def load_stream(stream: DataFrame, parse: Callable[[DataFrame], DataFrame], target: str, key: list[str], order: str, checkpoint: str) -> StreamingQuery:
    """STR-04: every micro-batch is parsed and inserted, known keys ignored.

    A batch writes one folder, named by its stream and number, and replaces it when it
    runs again, so a replay adds nothing and loses nothing. What is known is read by key columns only, from the
    hash ranges of the batch. A target that is there and cannot be read stops the stream.
    """
    load = "s" + hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def insert(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = parse(batch).withColumn("range", F.pmod(F.xxhash64(*key), F.lit(RANGES)).cast("int")).persist()
        try:
            places = ", load string, batch long, range int"
            schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in key) + places
            known = spark.read.schema(schema).parquet(target) if exists(spark, target) else spark.createDataFrame([], schema)
            mine = [r["range"] for r in rows.select("range").distinct().collect()]  # at most RANGES
            earlier = known.filter(F.col("range").isin(mine) & ~((F.col("load") == load) & (F.col("batch") >= number)))
            new = one_per_key(rows, key, order).join(earlier.select(*key), key, "left_anti").select(*rows.columns)
            new.write.mode("overwrite").partitionBy("range").parquet(f"{target}/load={load}/batch={number}")
        finally:
            rows.unpersist()

    return stream.writeStream.foreachBatch(insert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def exists(spark: SparkSession, folder: str) -> bool:
    """Whether a folder is there; any other failure is raised."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def status_stream(log: DataFrame, key: str, at: str, lateness: str) -> DataFrame:
    """STR-01: each event of a status log once, within the watermark."""
    return log.withWatermark(at, lateness).dropDuplicatesWithinWatermark([key, "status"])


def windowed_status(log: DataFrame, at: str, lateness: str, width: str) -> DataFrame:
    """Events per status and window of event time; later ones than the watermark are dropped."""
    return log.withWatermark(at, lateness).groupBy(F.window(at, width), "status").agg(F.count("*").alias("n"))
