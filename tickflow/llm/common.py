"""Helpers shared by the text operators.

Word class of every operator here: ``[^\\x20\\x09-\\x0D]+`` (ASCII white space
separates, nothing else does). On UTF-8 bytes that is ``bytes.split()``.
"""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.session import scratch_path

WHITE = " \t\n\x0b\x0c\r"
ROWS_PER_SLICE = 512
FILTER_BITS = 1 << 25     # of a key filter, whatever the input
FILTER_PARTS = 64         # that a filter's bits travel in
U64 = np.uint64


def process_cache(key, build: Callable, version=None):
    """``build()`` once per Python worker process, key and version. Only the
    last key's value is kept, as a worker may serve stage after stage. Functions
    travel by value, so their own module globals
    last one task only; a module registered in ``sys.modules`` lasts as long as
    the worker."""
    store = sys.modules.setdefault("_text_operator_cache", types.ModuleType("_text_operator_cache"))
    if getattr(store, "key", None) != (key, version):
        store.key = store.value = None      # let go of the old value first
        store.value = build()
        store.key = (key, version)
    return store.value


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, deleted when the driver's
    JVM ends."""
    path = scratch_path(spark, name)
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hpath)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder, read back: lineage
    ends there, so a lost executor costs a re-read and not a recount."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS_PER_SLICE
           ) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut into short ones, so that what is decoded into Python
    objects at a time stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    pa.default_memory_pool().release_unused()


def give_back() -> None:
    """Memory that is free in this process goes back to the machine: a worker
    lives through many stages, and its neighbours need what it had."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):       # another C library keeps what it has
        pass


def byte_slices(batches: Iterator[pa.RecordBatch], size: int, rows: int = ROWS_PER_SLICE
                ) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut into parts of at most ``rows`` rows and about ``size``
    bytes, but for a single row that is larger."""
    give_back()
    for batch in batches:
        left = [batch.slice(at, rows) for at in range(0, batch.num_rows, rows)][::-1]
        while left:
            part = left.pop()
            if part.nbytes > size and part.num_rows > 1:
                half = part.num_rows // 2
                left += [part.slice(half), part.slice(0, half)]
            else:
                yield part
    give_back()


def fresh(name: str, taken) -> str:
    """``name``, with underscores added until no column has it."""
    taken = {t.lower() for t in taken}
    while name.lower() in taken:
        name += "_"
    return name


def map_rows(df: DataFrame, inputs: list, schema: str, make: Callable) -> DataFrame:
    """One output row per input row. ``make()`` runs once per task and returns
    ``fn(columns) -> columns``, lists per slice in the order of ``inputs`` and
    ``schema``. Only ``inputs`` reach Python, so other columns never clash."""
    import pyspark.sql.types as T
    from pyspark.sql.pandas.types import to_arrow_schema
    typed = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(typed)

    def run(batches):
        fn = make()
        for batch in slices(batches):
            cols = fn(*[c.to_pylist() for c in batch.columns])
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
                 for c, f in zip(cols, arrow, strict=True)], schema=arrow)

    return df.select(*inputs).mapInArrow(run, schema)


def text_or_empty(text: str = "text"):
    return F.coalesce(F.col(text), F.lit(""))


def mixed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit numbers, well mixed."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _filter_places(keys: np.ndarray) -> Iterator[np.ndarray]:
    x = keys.astype(np.int64).view(U64)
    for salt in (1, 2, 3):
        yield (mixed(x + U64(salt * 0x9E3779B97F4A7C15 % 2**64)) % U64(FILTER_BITS)).astype(np.int64)


def key_filter(keys: DataFrame, key: str) -> Callable:
    """A function of a long column's name, of fixed size for all tasks: true for every
    ``key`` of ``keys``, rarely for others (at very large inputs for most), null
    never. It only spares shuffles and never decides a result. Parts of the tasks'
    bits are united by Spark, so the driver gets no more than one filter's."""
    size = FILTER_BITS // 8 // FILTER_PARTS

    def build(batches):
        bits = np.zeros(FILTER_BITS // 8, np.uint8)
        for batch in batches:
            for at in _filter_places(batch.column(0).to_numpy()):
                np.bitwise_or.at(bits, at >> 3, np.uint8(1) << (at & 7).astype(np.uint8))
        for part, some in enumerate(bits.reshape(FILTER_PARTS, size)):
            if some.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([some.tobytes()])],
                    names=["part", "bits"])

    def join(group):
        bits = np.zeros(size, np.uint8)
        for b in group.column("bits"):
            bits |= np.frombuffer(b.as_buffer(), np.uint8)
        return pa.table({"part": group.column("part").slice(0, 1), "bits": [bits.tobytes()]})

    spark = keys.sparkSession
    parts = keys.select(F.col(key).cast("long").alias("key")).filter("key is not null").coalesce(
        max(shuffle_partitions(spark) // 4, 1)).mapInArrow(build, "part int, bits binary").groupBy(
        "part").applyInArrow(join, "part int, bits binary")
    found = {r["part"]: r["bits"] for r in parts.collect()}
    held = spark.sparkContext.broadcast(b"".join(
        found.get(part, bytes(size)) for part in range(FILTER_PARTS)))

    @F.pandas_udf("boolean")
    def maybe(values):
        import pandas as pd
        bits, out = np.frombuffer(held.value, np.uint8), True
        for at in _filter_places(values.to_numpy()):
            out = out & ((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1)
        return pd.Series(out)

    # Nulls would turn a batch of longs into doubles.
    return lambda name: F.col(name).isNotNull() & maybe(F.coalesce(F.col(name), F.lit(0)).cast("long"))
