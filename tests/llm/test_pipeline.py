"""The pipeline against its brute-force version, each stage on odd rows, and
the registered queries."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from conftest import SF001
from test_corpus_operators import brute_components
from tickflow.llm import decontaminate, personal_data, pieces, toxicity


def test_pipeline_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    items = spark.read.parquet(f"{SF001}/benchmark.parquet").collect()
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    scorer = toxicity.Scorer(toxicity.train(*toxicity.sample(docs, labels)))
    rows = {i: t for i, t in rows.items() if scorer.score([t])[0] < toxicity.THRESHOLD}
    comp = brute_components(list(rows.items()), 5, 80)
    rows = {i: t for i, t in rows.items() if comp[i][1] == i}
    plain = [" ".join(decontaminate.words_of(r["text"])) for r in items]
    rows = {i: t for i, t in rows.items() if not any(
        f" {p} " in f" {' '.join(decontaminate.words_of(t))} " for p in plain)}
    left = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    weights = personal_data.fit(personal_data.sample_zones(left))
    model = pieces.PieceModel(pieces.model_file())
    want = {}
    for i, t in rows.items():
        t = personal_data.redacted(t, personal_data.find_spans(t, weights)[1])
        want[i] = (t, model.encode(t).tolist())
    out = corpus_pipeline.run(spark, SF001)
    got = {r["doc_id"]: r for r in out.collect()}
    assert set(got) == set(want) and len(got) == out.count()
    for i, (t, ids) in want.items():
        r = got[i]
        assert (r["text"], r["ids"], r["decoded"]) == (t, ids, t.replace("▁", " "))
        assert r["n_tokens"] == len(ids) and r["n_chars"] == len(t)


def odd_rows(spark):
    return spark.createDataFrame(
        [(1, "a b c d e f", "en", "s", 11, 0.5, 3, 7), (1, "a b c d e f", "en", "s", 11, 0.5, 3, 7),
         (2, "a b c d e f", None, None, None, None, None, None), (3, "", "en", "s", 0, 0.0, 0, 0),
         (4, None, None, None, None, None, None, None), (None, "mail x@y.com", "en", "s", 1, 0.1, 1, 1),
         (5, "z " * 30_000, "en", "s", 1, 0.1, 1, 1)],
        "doc_id long, text string, lang string, source string, n_chars long, score double, "
        "node long, predicted int")


RESERVED = ("text_", "ids", "decoded", "n_tokens", "source_", "unit", "gone", "digest", "_text", "_ids",
            "_unit", "_twice", "twice_id", "pair_id", "pair_digest", "kept", "component_id", "spans",
            "leaks", "id", "first", "rows")


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_keep_columns_of_any_name(spark, name, stage):
    rows = [(1, "a b c d e f g"), (1, "another text of one id"), (2, "a b c d e f g"), (3, None),
            (None, "mail x@y.com")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for i, c in enumerate(RESERVED):
        df = df.withColumn(c, F.lit(i))
    out = stage(spark, df, SF001)
    assert out.columns[:len(df.columns)] == df.columns
    for r in out.collect():
        assert [r[c] for c in RESERVED] == list(range(len(RESERVED)))
    if name == "sentencepiece":
        assert out.columns[len(df.columns):] == ["ids_", "decoded_", "n_tokens_"]


def test_different_texts_of_one_id_are_judged_by_themselves(spark):
    same, near, other = "a b c d e f g h", "q r s t u v w x", "one two three four five six"
    rows = [(1, same), (2, same), (2, other), (3, near), (3, near), (3, near.upper() + " y"),
            (4, "k l m n o p"), (4, None), (4, ""), (None, same)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in corpus_pipeline.drop_near_duplicates(spark, df, SF001).collect()]
    assert len(got) == len(set(got))
    assert {(1, same), (2, other), (4, "k l m n o p"), (4, None), (4, ""), (None, same)} <= set(got)
    assert (2, same) not in got and {i for i, _ in got} == {None, 1, 2, 3, 4}


def rows_exchanged(node, column):
    """Rows written by the exchanges of an executed plan that carry ``column``."""
    if node.nodeName() == "AdaptiveSparkPlan":
        return rows_exchanged(node.executedPlan(), column)
    if node.nodeName().endswith("QueryStage"):
        return rows_exchanged(node.plan(), column)
    kids, out = node.children(), node.output()
    found = sum(rows_exchanged(kids.apply(i), column) for i in range(kids.size()))
    if node.nodeName() == "Exchange" and column in {out.apply(i).name() for i in range(out.size())}:
        found += node.metrics().apply("shuffleRecordsWritten").value()
    return found


@pytest.mark.parametrize("more", [[], [(7, "another text of one id"), (8, None)]])
def test_texts_that_stay_are_not_shuffled(spark, more):
    """The copies travel, and the rows of repeated ids, but not the other 300."""
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(12))) for i in range(300)]
    copies = [(1000 + i, rows[i][1]) for i in (3, 4, 5)]
    df = spark.createDataFrame([*rows, *copies, *more, (None, rows[3][1])],
                               "doc_id long, text string").repartition(4).localCheckpoint()
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = corpus_pipeline.drop_near_duplicates(spark, df, SF001)
        got = {tuple(r) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert got == {*rows, *more, (None, rows[3][1])}
    assert 0 < rows_exchanged(out._jdf.queryExecution().executedPlan(), "text") <= 40


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_on_odd_rows_and_empty_tables(spark, name, stage):
    df = odd_rows(spark)
    out = stage(spark, df, SF001)
    rows = out.collect()
    if name != corpus_pipeline.STAGES[-1][0]:
        assert out.columns == df.columns
    ids = sorted(r["doc_id"] or 0 for r in rows)
    if name == "toxicity":      # what it rejects depends on the labels that these ids have
        assert set(ids) <= {0, 1, 2, 3, 4, 5}
        assert out.exceptAll(df).count() == 0
        ids = [0, 1, 1, 2, 3, 4, 5]
    assert ids == ([0, 1, 3, 4, 5] if name == "near_duplicates" else [0, 1, 1, 2, 3, 4, 5])
    if name == "personal_data":
        assert {r["text"] for r in rows if r["doc_id"] is None} == {"mail [EMAIL]"}
        assert {r["n_chars"] for r in rows if r["doc_id"] is None} == {12}
    assert stage(spark, df.limit(0), SF001).count() == 0


def test_every_operator_and_the_pipeline_are_registered():
    names = set(entry.queries())
    assert "pipeline" in names
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()} == \
        set(range(1, 14))
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("name", ["op1_sentencepiece", "op4_quality_rules", "op5_personal_data",
                                  "op7_token_counts", "op9_html_text", "op10_sharding"])
def test_queries_return_a_row_per_input_row(spark, name):
    table = "pages" if name.startswith("op9") else "documents"
    got = entry.queries()[name](spark, SF001)
    assert got.count() == spark.read.parquet(f"{SF001}/{table}.parquet").count()
    key = "page_id" if table == "pages" else "doc_id"
    assert got.select(key).distinct().count() == got.filter(F.col(key).isNotNull()).count()
