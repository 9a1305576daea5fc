"""Keyed upsert of a stream into Parquet folders (SET-2 and corrections, EXT).

Each micro-batch is one folder ``epoch=<n>``. An epoch run again, after a
failure anywhere before Spark's own commit, overwrites its folder, so nothing is
added twice; a folder counts only once its write has ended (``_SUCCESS``). A
read takes, per key, the row of the latest epoch. ``compact`` folds epochs into
one ``base=<n>`` folder, so reads do not grow with the number of batches.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickflow.operators.names import private

DONE = "_SUCCESS"       # fixed value: the file that ends a Parquet write


class UpsertTable:
    """Rows by ``keys``; a null key value is a value like any other."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: Sequence[str]):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.keys = list(keys)
        self.rest = [f.name for f in schema.fields if f.name not in self.keys]

    # ------------------------------------------------------------------ folders
    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _numbers(self, kind: str) -> list[int]:
        """Numbers of the finished folders of a kind, rising."""
        fs, pattern = self._fs(f"{self.path}/{kind}=*/{DONE}")
        found = fs.globStatus(pattern) or []
        return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found)

    def parts(self) -> tuple[int | None, list[int]]:
        """(newest base or None, epochs after it)."""
        base = (self._numbers("base") or [None])[-1]
        return base, [e for e in self._numbers("epoch") if base is None or e > base]

    # ------------------------------------------------------------------ writing
    def write(self, batch: DataFrame, epoch: int) -> None:
        """For ``foreachBatch``. Of rows that share their keys inside one batch
        the one with the largest other columns stays, whatever their order. An
        epoch that a base holds already is a replay, and adds nothing."""
        base, _ = self.parts()
        if base is not None and epoch <= base:
            return
        one = batch.select(*self.schema.names)
        if self.rest:
            r = private(one.columns, "_rest")
            one = (one.groupBy(*self.keys).agg(F.max(F.struct(*self.rest)).alias(r))
                   .select(*self.keys, f"{r}.*"))
        else:
            one = one.distinct()
        one.write.mode("overwrite").parquet(f"{self.path}/epoch={epoch}")

    def compact(self) -> None:
        """Fold everything finished into one base; the folders it replaces go
        only after the new base is complete, so a failure loses nothing."""
        base, epochs = self.parts()
        if epochs:
            self.read().write.mode("overwrite").parquet(f"{self.path}/base={epochs[-1]}")
        newest, _ = self.parts()
        for kind in ("base", "epoch"):
            for n in self._numbers(kind):
                if newest is not None and (n < newest if kind == "base" else n <= newest):
                    fs, p = self._fs(f"{self.path}/{kind}={n}")
                    fs.delete(p, True)

    # ------------------------------------------------------------------ reading
    def read(self) -> DataFrame:
        base, epochs = self.parts()
        at, r = (private(self.schema.names, n) for n in ("_epoch", "_rest"))
        reader = self.spark.read.schema(self.schema)
        frames = [] if base is None else [
            reader.parquet(f"{self.path}/base={base}").withColumn(at, F.lit(-1).cast("long"))]
        if epochs:
            # The number is taken from the folder's name.
            number = F.regexp_extract(F.col("_metadata.file_path"), r"/epoch=(\d+)/[^/]*$", 1)
            frames.append(reader.parquet(*[f"{self.path}/epoch={e}" for e in epochs])
                          .select("*", number.cast("long").alias(at)))
        if not frames:
            return self.spark.createDataFrame([], self.schema)
        rows = frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])
        if not self.rest:
            return rows.select(*self.keys).distinct().select(*self.schema.names)
        latest = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*self.rest), at).alias(r))
        return latest.select(*self.keys, f"{r}.*").select(*self.schema.names)


def run_upsert(df: DataFrame, spark: SparkSession, root: str, keys: Sequence[str], *,
               mode: str = "append", write: Callable | None = None) -> UpsertTable:
    """Process everything available now into the table under ``root``; the same
    ``root`` goes on from its checkpoint. ``write`` may wrap the table's own."""
    from tickflow.streaming.stream import ROCKSDB, _start_conf, _TempConf
    table = UpsertTable(spark, f"{root}/table", df.schema, keys)
    sink = (lambda b, e: write(table, b, e)) if write else table.write
    with _TempConf(spark, _start_conf(spark, None, ROCKSDB)):
        q = (df.writeStream.option("checkpointLocation", f"{root}/checkpoint").outputMode(mode)
             .trigger(availableNow=True).foreachBatch(sink).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return table
