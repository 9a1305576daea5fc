"""Structured Streaming: sources, the shared parse/score transforms, sinks
(SRC-4, SRC-5, STR-1..5, SNK-1..3, EXT streaming bars).

The transforms are the batch ones (``sources.ticks``, ``operators.bars``,
``ml.model.predict``): a stream differs from a batch only in its source and
sink. Tests and the query catalogue drive streams with
``trigger(availableNow=True)`` over file sources; Kafka uses the same code.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickflow.functions.jsoncols import encode
from tickflow.operators.bars import bars
from tickflow.schemas import DEFAULT_TOPIC
from tickflow.session import scratch_path


# --------------------------------------------------------------------------- sources
def file_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """File source. ``path`` may name one file: the stream then watches its
    folder with a file-name filter (file sources need a folder)."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if _is_file(spark, path):
        r = r.option("pathGlobFilter", os.path.basename(path.rstrip("/")))
        path = os.path.dirname(path.rstrip("/"))
    return r.load(path)


def _is_file(spark: SparkSession, path: str) -> bool:
    """File check through the cluster's Hadoop filesystem (any scheme)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p) and fs.getFileStatus(p).isFile())


def kafka_package(spark: SparkSession) -> str:
    """Q27: connector coordinates derived from the running Spark version."""
    ver = spark.version
    scala = spark.sparkContext._jvm.scala.util.Properties.versionNumberString()
    return f"org.apache.spark:spark-sql-kafka-0-10_{'.'.join(scala.split('.')[:2])}:{ver}"


def kafka_stream(spark: SparkSession, servers: str, topic: str = DEFAULT_TOPIC,
                 starting_offsets: str = "earliest") -> DataFrame:
    """SRC-4 / SRC-5: topic records (binary key/value). Needs the Kafka
    connector on the classpath (``kafka_package``)."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).option("startingOffsets", starting_offsets).load())


# --------------------------------------------------------------------------- transforms
def event_time(df: DataFrame, col: str = "ts") -> DataFrame:
    """Watermarks need TIMESTAMP; NTZ event times are read as UTC."""
    return df.withColumn(col, F.col(col).cast("timestamp"))


def streaming_bars(ticks: DataFrame, width: str = "1 hour", delay: str = "10 minutes",
                   **kw) -> DataFrame:
    """EXT: bars as a streaming aggregate. The watermark bounds the state; in
    append mode a bar is emitted once the watermark passes its end."""
    t = event_time(ticks).withWatermark("ts", delay)
    return bars(t, width, **kw)


def dedup_within_watermark(df: DataFrame, keys, ts: str = "ts",
                           delay: str = "10 minutes") -> DataFrame:
    """FLT-4 on streams (EXT): drop repeated deliveries of the same keys that
    arrive within the watermark delay of each other; state per key is
    released once the watermark passes."""
    return event_time(df, ts).withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


# --------------------------------------------------------------------------- sinks
def run_split_available(parsed: DataFrame, spark: SparkSession, name: str,
                        valid: str = "valid") -> tuple[DataFrame, DataFrame]:
    """Q16 quarantine sink: each micro-batch of parsed ticks is written as
    two outputs, valid rows and rejected rows (raw text and reason kept).
    Writes go to per-epoch folders in overwrite mode, so a retried epoch
    replaces its own output (exactly once per epoch). Returns the two tables
    read back."""
    from tickflow.sources.ticks import split_valid
    root = scratch_path(spark, name)
    good_out, bad_out, ckpt = f"{root}/valid", f"{root}/quarantine", f"{root}/checkpoint"
    good_schema = parsed.drop(valid).schema
    bad_schema = split_valid(parsed)[1].schema

    def write(batch: DataFrame, epoch: int):
        batch.persist()
        try:
            good, bad = split_valid(batch)
            good.write.mode("overwrite").parquet(f"{good_out}/epoch={epoch}")
            bad.write.mode("overwrite").parquet(f"{bad_out}/epoch={epoch}")
        finally:
            batch.unpersist()

    with _TempConf(spark, _start_conf(spark, None, None)):
        q = (parsed.writeStream.option("checkpointLocation", ckpt).trigger(availableNow=True)
             .foreachBatch(write).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    read = lambda path, schema: spark.read.schema(schema).parquet(path)
    return read(good_out, good_schema), read(bad_out, bad_schema)


def console(df: DataFrame, mode: str = "append", available_now: bool = False):
    """SNK-1 (debugging): print each micro-batch."""
    w = df.writeStream.outputMode(mode).format("console")
    return (w.trigger(availableNow=True) if available_now else w).start()


def to_kafka(df: DataFrame, servers: str, topic: str, checkpoint: str, cols=None):
    """SNK-3: rows -> JSON text value -> topic."""
    payload = df.select(encode(*(cols or df.columns)).alias("value"))
    return (payload.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("topic", topic).option("checkpointLocation", checkpoint).start())


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _start_conf(spark: SparkSession, state_partitions: int | None, state_store: str | None):
    """Settings a streaming query fixes when it first starts: state-store
    partitions (default: the cluster's parallelism) and the state-store
    provider (RocksDB keeps large state off the JVM heap)."""
    conf = {"spark.sql.shuffle.partitions":
            str(state_partitions or spark.sparkContext.defaultParallelism)}
    if state_store:
        conf["spark.sql.streaming.stateStore.providerClass"] = state_store
    return conf


class _TempConf:
    def __init__(self, spark: SparkSession, conf: dict):
        self.spark, self.conf, self.before = spark, conf, {}

    def __enter__(self):
        for k, v in self.conf.items():
            self.before[k] = self.spark.conf.get(k, None)
            self.spark.conf.set(k, v)

    def __exit__(self, *exc):
        for k, v in self.before.items():
            if v is None:
                self.spark.conf.unset(k)
            else:
                self.spark.conf.set(k, v)


def run_available(df: DataFrame, spark: SparkSession, name: str, mode: str = "append",
                  state_partitions: int | None = None,
                  state_store: str | None = ROCKSDB, root: str | None = None) -> DataFrame:
    """STR-2 / STR-3 / STR-4 / SNK-2: process everything available now with a
    checkpoint under the shared checkpoint root, then read the result back.

    Append mode writes a Parquet file sink (exactly once via its log);
    complete mode rewrites the whole result table per micro-batch.
    A stateful query fixes its state-store partition count and provider
    when it first starts: ``state_partitions`` (default: the cluster's
    parallelism, not the batch shuffle setting) and ``state_store``
    (default: RocksDB). A ``root`` given again goes on from its checkpoint."""
    root = root or scratch_path(spark, name)
    out, ckpt = f"{root}/out", f"{root}/checkpoint"
    w = df.writeStream.option("checkpointLocation", ckpt).trigger(availableNow=True)
    with _TempConf(spark, _start_conf(spark, state_partitions, state_store)):
        if mode == "append":
            q = w.format("parquet").option("path", out).outputMode("append").start()
        elif mode == "complete":
            def write(batch: DataFrame, _epoch: int):
                batch.write.mode("overwrite").parquet(out)
            q = w.outputMode("complete").foreachBatch(write).start()
        else:
            raise ValueError("mode must be 'append' or 'complete'")
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return spark.read.schema(df.schema).parquet(out)
