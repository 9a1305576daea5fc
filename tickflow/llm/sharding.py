"""Shards of near-equal size by longest-processing-time scheduling.

Groups that must stay together (equal texts) are scheduled from the largest
to the smallest, each onto the least-loaded shard. Groups of one size class
are interchangeable, so the driver schedules (class, count) pairs: a class
holds the sizes that share their 13 leading bits (exact below 8192 bytes,
within 1/4096 above), at most 8192 + 4096 * 50 of them whatever the input.
Spark then ranks the groups of a class and gives each shard its quota.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickflow.llm.common import shuffle_partitions, text_or_empty, written

CLASS_BITS = 13
HEAVY_PARTS = 1000   # a text in at least 1/1000 of all rows is heavy: 1000 texts at most


def size_class(size):
    """Largest integer <= size with CLASS_BITS significant bits."""
    drop = F.greatest(F.length(F.bin(size)) - F.lit(CLASS_BITS), F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", size, drop), drop)


def _spread(loads: list[int], n: int, size: int) -> list[int]:
    """How many of ``n`` jobs of one size each shard gets when every job goes to
    the least-loaded shard (ties: lowest shard)."""
    low, high = min(loads), max(loads) + n * size
    while low < high:           # highest water level whose jobs all fit
        mid = (low + high + 1) // 2
        if sum(max(0, -((load - mid) // size)) for load in loads) <= n:
            low = mid
        else:
            high = mid - 1
    got = [max(0, -((load - low) // size)) for load in loads]
    heap = [(load + g * size, i) for i, (load, g) in enumerate(zip(loads, got, strict=True))]
    heapq.heapify(heap)
    for _ in range(n - sum(got)):
        load, i = heap[0]
        got[i] += 1
        heapq.heapreplace(heap, (load + size, i))
    return got


def schedule(classes: Iterable[tuple[int, int, int]], n_shards: int) -> dict[int, list[int]]:
    """Longest processing time first over (class, count, total bytes), largest
    class first. Returns class -> groups per shard."""
    loads, quotas = [0] * n_shards, {}
    for cls, n, total in sorted(classes, reverse=True):
        mean = max(1, round(total / n))
        got = _spread(loads, n, mean)
        loads = [load + g * mean for load, g in zip(loads, got, strict=True)]
        quotas[cls] = got
    return quotas


def _ranked(df: DataFrame, by: list[str], salt, order: list, out: str) -> DataFrame:
    """Gapless rank from 0 within ``by``: rank inside (by, salt) cells plus the
    cells' running counts, so one hot value of ``by`` still spreads over all
    tasks."""
    cells = df.withColumn("_salt", salt)
    counts = cells.groupBy(*by, "_salt").agg(F.count(F.lit(1)).alias("_n"))
    prior = Window.partitionBy(*by).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*by, "_salt", F.coalesce(F.sum("_n").over(prior), F.lit(0))
                           .alias("_start"))
    local = F.row_number().over(Window.partitionBy(*by, "_salt").orderBy(*order)) - 1
    return (cells.withColumn("_local", local).join(starts, [*by, "_salt"])
            .withColumn(out, (F.col("_start") + F.col("_local")).cast("long"))
            .drop("_salt", "_local", "_start"))


def shard_documents(df: DataFrame, n_shards: int = 8, *, id_col: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """One row per input row: id, size (UTF-8 bytes + 1), text_crc32, law
    ('bytes'), shard, slot (gapless from 0 in each shard), grown_shard (null).

    Equal texts share a shard. A null text counts as empty and is grouped with
    empty texts. Repeated rows and ids each get a slot of their own; a null id
    is kept. An empty table gives an empty result. Other columns are ignored.
    Texts are told apart by their SHA-256, and read once: the rest works on a
    narrow table in the shared folder."""
    spark = df.sparkSession
    salts = F.lit(shuffle_partitions(spark))
    body = text_or_empty(text)
    docs = written(df.select(
        F.col(id_col).alias("_id"), (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(body.cast("binary"), 256)).alias("_text")), "shard-digests")
    groups = written(docs.groupBy("_text").agg(F.sum("size").alias("_bytes"),
                                               F.count(F.lit(1)).alias("_rows"))
                     .withColumn("_class", size_class(F.col("_bytes"))), "shard-groups")
    classes = groups.groupBy("_class").agg(F.count(F.lit(1)).alias("n"),
                                           F.sum("_bytes").alias("b"), F.sum("_rows").alias("r"))
    found = classes.collect()      # bounded by the number of classes
    quotas = schedule([(r["_class"], r["n"], r["b"]) for r in found], n_shards)
    rows = sum(r["r"] for r in found)
    ends = []
    for cls, got in quotas.items():
        total, upto = 0, []
        for g in got:
            total += g
            upto.append(total)
        ends.append((cls, upto))
    ends = spark.createDataFrame(ends, "_class long, _upto array<long>")
    ranked = _ranked(groups, ["_class"], F.pmod(F.xxhash64("_text"), salts), ["_text"], "_rank")
    placed = (ranked.join(F.broadcast(ends), "_class")     # bounded by the number of classes
              .withColumn("shard", F.size(F.filter("_upto", lambda u: u <= F.col("_rank")))
                          .cast("int"))
              .select("_text", "shard", "_rows"))
    placed = written(placed, "shard-placed")
    hot = F.col("_rows") * HEAVY_PARTS >= F.lit(rows)
    heavy = placed.filter(hot).select("_text", F.col("shard").alias("_hot"))
    out = docs.join(F.broadcast(heavy), "_text", "left")
    known = out.filter(F.col("_hot").isNotNull()).withColumnRenamed("_hot", "shard")
    rest = out.filter(F.col("_hot").isNull()).drop("_hot").join(
        placed.filter(~hot).select("_text", "shard"), "_text")
    both = written(known.unionByName(rest).select("_id", "size", "text_crc32", "shard"),
                   "shard-rows")
    return _ranked(both, ["shard"], F.pmod(F.xxhash64("_id", "text_crc32"), salts),
                   ["_id", "text_crc32"], "slot").select(
        F.col("_id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
