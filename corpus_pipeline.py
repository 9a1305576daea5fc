"""The corpus pipeline: each stage works on all that the one before it kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it
as Parquet in the shared folder and reads it back for the next one. All stages
but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.llm import decontaminate, near_dup, personal_data, pieces, toxicity
from tickflow.llm.common import fresh, key_filter, written
from tickflow.session import table_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic; null and empty texts, rows without
    an id and repeated rows are judged like others; all columns stay, whatever
    their names; an empty table stays empty."""
    return toxicity.without_toxic(docs, _table(spark, sf_dir, "labels"))


def _without(rows: DataFrame, key: str, gone: DataFrame, gone_key: str) -> DataFrame:
    """``rows`` whose ``key`` is not in ``gone``; those without a key stay. Texts of
    rows that stay are not shuffled, but for the key filter's errors."""
    maybe = key_filter(gone, gone_key)
    return rows.filter(~maybe(key)).union(rows.filter(maybe(key)).join(
        gone, F.col(key) == F.col(gone_key), "left_anti"))


def _units(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` and the name of a new column, the unit: the id, one row of each
    text of an id. Where an id has several texts, one of them keeps the id and the
    others get new ids above all others, so that each text is judged by itself."""
    unit, twice_id, digest, pair_id, pair_digest = (
        fresh(c, docs.columns) for c in ("unit", "twice_id", "digest", "pair_id", "pair_digest"))
    with_id = docs.select("doc_id").filter(F.col("doc_id").isNotNull())
    twice = written(with_id.groupBy("doc_id").agg(F.count("*").alias("rows")).filter(
        "rows > 1").select(F.col("doc_id").alias(twice_id)), "pipeline-twice")
    plain = docs.withColumn(unit, F.col("doc_id").cast("long"))
    if twice.isEmpty():
        return plain, unit
    maybe = key_filter(twice, twice_id)
    again = docs.filter(maybe("doc_id")).join(
        twice, F.col("doc_id") == F.col(twice_id), "left_semi").withColumn(
            digest, F.coalesce(F.sha2("text", 256), F.lit("")))
    top = with_id.agg(F.max(F.col("doc_id").cast("long"))).first()[0]
    pairs = again.select(F.col("doc_id").alias(pair_id), F.col(digest).alias(pair_digest)).distinct()
    first = pairs.groupBy(F.col(pair_id).alias("id1")).agg(F.min(pair_digest).alias("first"))
    pairs = written(pairs.join(first, F.col(pair_id) == F.col("id1")).select(
        pair_id, pair_digest, F.when(F.col(pair_digest) == F.col("first"), F.col(pair_id).cast("long"))
        .otherwise(F.monotonically_increasing_id() + F.lit(top + 1)).alias(unit)),
        "pipeline-units")
    rows = again.dropDuplicates(["doc_id", digest])
    rows = rows.join(pairs, (F.col("doc_id") == F.col(pair_id)) & (F.col(digest) == F.col(pair_digest)))
    return _without(plain, "doc_id", twice, twice_id).unionByName(
        rows.select(*plain.columns)), unit


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8): that of
    the least id, and one row of it where its row repeats. Different texts of
    one id are documents of their own. Rows without an id link with nothing and
    stay; so do null and empty texts; all columns stay, whatever their names."""
    units, unit = _units(docs)
    found = written(near_dup.near_duplicates(units.select(F.col(unit).alias("doc_id"), "text"),
                                             words=5, percent=80), "pipeline-groups")
    gone = fresh("gone", units.columns)
    ids = found.filter("not kept").select(F.col("doc_id").alias(gone)).distinct()
    return _without(units, unit, ids, gone).select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; null and empty texts hold none;
    repeated rows and rows without an id are judged like others; all columns
    stay, whatever their names; an empty table stays empty."""
    return decontaminate.clean(docs, _table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each span of personal data replaced by its kind's mark;
    n_chars is the length of the new text. Null texts stay null."""
    out = personal_data.redact(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.length("text").cast(kind))
    return out


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with the ids of their pieces, their number, and the text
    that these ids decode to (columns ids, n_tokens, decoded; where the table has
    one of these names, its column stays and the new one ends in underscores).
    Null and empty texts have no ids and decode to an empty text."""
    ids, n_tokens, decoded = (fresh(c, docs.columns) for c in ("ids", "n_tokens", "decoded"))
    both = pieces.encode_and_decode(docs, carry=docs.columns, ids=ids, decoded=decoded)
    return both.withColumn(n_tokens, F.size(ids).cast("long"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("personal_data", redact_personal_data),
    ("sentencepiece", encode_pieces),
]

ORACLE_SQL = None       # networks and automata are not SQL; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
