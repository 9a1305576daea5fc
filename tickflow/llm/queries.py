"""The registered queries of the text operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickflow.llm import lexical_search, pieces, quality
from tickflow.llm.decontaminate import leaks
from tickflow.llm.html_text import extract_text
from tickflow.llm.language_model import language_model_scores
from tickflow.llm.near_dup import near_duplicates
from tickflow.llm.personal_data import personal_data
from tickflow.llm.sharding import shard_documents
from tickflow.llm.suffix_dedup import without_repeats
from tickflow.llm.token_counts import token_counts
from tickflow.llm.toxicity import toxicity
from tickflow.llm.whitening import whiten
from tickflow.session import table_path

QUERIES, ORACLES = {}, {}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return add


@query("op1_sentencepiece")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded into pieces and decoded again."""
    return pieces.round_trip(read(spark, sf_dir, "documents"))


@query("op2_decontamination")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of a document and a benchmark item that it contains."""
    return leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op3_toxicity")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from labelled rows."""
    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op4_quality_rules", quality.oracle())
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the adaptive verdict on every document."""
    return quality.quality(read(spark, sf_dir, "documents"))


@query("op5_personal_data")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data spans of every document: base patterns and the field's."""
    return personal_data(read(spark, sf_dir, "documents"))


@query("op6_near_duplicates")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 2-word shingle sets reach 0.8."""
    return near_duplicates(read(spark, sf_dir, "documents"), words=2, percent=80)


@query("op7_token_counts")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by the whole-token shortcut."""
    return token_counts(read(spark, sf_dir, "documents"))


@query("op8_lm_scores")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kneser-Ney bigram scores of every document."""
    return language_model_scores(read(spark, sf_dir, "documents"))


@query("op9_html_text")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page by line-block distribution."""
    return extract_text(read(spark, sf_dir, "pages"))


@query("op10_sharding")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 8 shards of near-equal bytes; equal texts together."""
    return shard_documents(read(spark, sf_dir, "documents"), 8)


@query("op11_lexical_search", lexical_search.oracle())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten highest-scoring documents of every benchmark item."""
    return lexical_search.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op12_embedding_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of every embedding."""
    return whiten(read(spark, sf_dir, "embeddings"))


@query("op13_suffix_dedup")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 400-byte strings that repeat."""
    return without_repeats(read(spark, sf_dir, "documents"))
