"""Quality rules whose thresholds come from the data.

Every document gets whole-text counts. For the rates below, a sketch per
(language, source) counts values in log-linear buckets (5 leading bits, so
within 1/16 of the value). Sketches merge by adding counts: sources into
languages, languages into one. The fences of a group are its quartiles plus
``SPREAD`` times their distance and a least slack; groups of fewer than
``LEAST_DOCS`` documents use the merged sketch. Only DataFrame functions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickflow.llm.common import WHITE, text_or_empty, written

WORD_BREAK = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"             # fixed value
SKETCH_BITS = 5
SPREAD = 3
LEAST_DOCS = 30
# rate -> (least slack beyond the quartiles, is there a lower fence), all in thousandths
RATES = {"word_length": (1500, True), "symbols": (50, False), "dup_lines": (400, False),
         "repeats": (400, False)}


def _let(value: Column, use) -> Column:
    """``use(v)`` with ``value`` computed once per row."""
    return F.transform(F.array(value), use)[0]


def repeated_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more. Windows are told
    apart by 64-bit hashes."""
    def windows(h: Column) -> Column:
        return F.when(F.size(h) < 3, F.expr("array()").cast(
            "array<struct<h: bigint, p: int>>")).otherwise(F.transform(
                F.sequence(F.lit(0), F.size(h) - 3),
                lambda i: F.struct(F.xxhash64(h[i], h[i + 1], h[i + 2]).alias("h"),
                                   i.alias("p"))))

    def covered(s: Column) -> Column:
        twin = F.filter(s, lambda x, i: (
            (i > 0) & (F.get(s, i - 1)["h"] == x["h"])) | (
            (i < F.size(s) - 1) & (F.get(s, i + 1)["h"] == x["h"])))
        return F.size(F.array_distinct(F.flatten(F.transform(
            twin, lambda x: F.array(x["p"], x["p"] + 1, x["p"] + 2)))))

    def count(w: Column) -> Column:
        plain = F.transform(w, lambda x: x["h"])
        return F.when(F.size(F.array_distinct(plain)) == F.size(plain), F.lit(0)).otherwise(
            _let(F.sort_array(w), covered))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return _let(_let(hashes, windows), count)


def text_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, lang, source and the whole-text counts of each row."""
    body = text_or_empty(text)
    bare = F.btrim(body, F.lit(WHITE))
    with_word = F.filter(F.split(body, "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "")
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(
        F.split(bare, WORD_BREAK))
    return df.select(
        F.col("doc_id"), F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        _let(words, lambda w: F.struct(F.size(w).alias("n"),
                                       repeated_words(w).alias("r"))).alias("_w"),
        F.length(F.translate(body, WHITE, "")).cast("long").alias("word_chars"),
        (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long")
        .alias("n_symbols"),
        _let(with_word, lambda x: F.struct(F.size(x).alias("n"), (
            F.size(x) - F.size(F.array_distinct(x))).alias("d"))).alias("_l"),
    ).select("doc_id", "lang", "source", F.col("_w.n").cast("long").alias("n_words"), "word_chars",
             "n_symbols", F.col("_l.d").cast("long").alias("n_dup_lines"),
             F.col("_w.r").cast("long").alias("n_repeat_words"),
             F.col("_l.n").cast("long").alias("n_lines"))


def bucket(value: Column) -> Column:
    """Sketch bucket of a value >= 0: its SKETCH_BITS leading bits."""
    drop = F.greatest(F.length(F.bin(value)) - F.lit(SKETCH_BITS), F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop)


def _rates() -> dict[str, Column]:
    def share(top: str, of: str) -> Column:
        return F.expr(f"(1000 * {top}) div greatest({of}, 1)")
    return {"word_length": share("word_chars", "n_words"),
            "symbols": share("n_symbols", "n_words"),
            "dup_lines": share("n_dup_lines", "n_lines"),
            "repeats": share("n_repeat_words", "n_words")}


def _fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Quartile fences per key and rate from a sketch (key, rate, bucket, n)."""
    by = Window.partitionBy(*keys, "rate")
    upto = F.sum("n").over(by.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    rows = sketch.withColumns({"upto": upto, "total": F.sum("n").over(by)})
    q = rows.groupBy(*keys, "rate").agg(
        F.max("total").alias("docs"),
        F.min(F.when(F.col("upto") * 4 >= F.col("total"), F.col("bucket"))).alias("q1"),
        F.min(F.when(F.col("upto") * 4 >= F.col("total") * 3, F.col("bucket"))).alias("q3"))
    slack = reduce(lambda c, r: c.when(F.col("rate") == r, F.lit(RATES[r][0])), RATES, F)
    reach = F.lit(SPREAD) * (F.col("q3") - F.col("q1")) + slack
    return q.select(*keys, "rate", "docs", (F.col("q1") - reach).alias("low"),
                    (F.col("q3") + reach).alias("high"))


def thresholds(passed: DataFrame) -> DataFrame:
    """One row per (lang, source): low_ and high_ fences of every rate, from the
    rows' sketches. Null languages and sources are groups like others."""
    rates = _rates()
    long = passed.select("lang", "source", F.inline(F.array(*[
        F.struct(F.lit(r).alias("rate"), bucket(c).alias("bucket")) for r, c in rates.items()])))
    sketch = long.groupBy("lang", "source", "rate", "bucket").agg(F.count(F.lit(1)).alias("n"))
    langs = sketch.groupBy("lang", "rate", "bucket").agg(F.sum("n").alias("n"))
    whole = langs.groupBy("rate", "bucket").agg(F.sum("n").alias("n"))
    own = _fences(sketch, ["lang", "source"])
    lang = _fences(langs, ["lang"]).select(F.col("lang").alias("_lang"), F.col("rate").alias("_r1"),
                                           *[F.col(c).alias(f"{c}1") for c in
                                             ("docs", "low", "high")])
    every = _fences(whole, []).select(F.col("rate").alias("_r2"), F.col("low").alias("low2"),
                                      F.col("high").alias("high2"))
    both = (own.join(lang, (F.col("rate") == F.col("_r1")) & F.col("lang").eqNullSafe(
        F.col("_lang"))).join(every, F.col("rate") == F.col("_r2")))

    def pick(side: str) -> Column:
        return (F.when(F.col("docs") >= LEAST_DOCS, F.col(side))
                .when(F.col("docs1") >= LEAST_DOCS, F.col(f"{side}1")).otherwise(F.col(f"{side}2")))

    return both.groupBy("lang", "source").agg(*[
        F.max(F.when(F.col("rate") == r, pick(side))).alias(f"{side}_{r}")
        for r in RATES for side in ("low", "high")])


def quality(df: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, kept, lang, source.

    A null or empty text has no words and fails the base rules; null ids,
    languages and sources are kept as they are; repeated rows count each; an
    empty table gives none; other columns are ignored. A row on a fence is
    kept."""
    counts = written(text_counts(df), "quality-counts")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = counts.withColumn("base_failed", failed)
    fences = thresholds(rows.filter(~F.col("base_failed"))).withColumnsRenamed(
        {"lang": "_lang", "source": "_source"})
    joined = rows.join(fences, F.col("lang").eqNullSafe(F.col("_lang"))
                       & F.col("source").eqNullSafe(F.col("_source")), "left")
    within = reduce(lambda a, b: a & b, [
        (c <= F.col(f"high_{r}")) & ((c >= F.col(f"low_{r}")) if RATES[r][1] else F.lit(True))
        for r, c in _rates().items()])
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", (~F.col("base_failed") & F.coalesce(within, F.lit(True))).alias("kept"),
        "lang", "source")


def _bucket_sql(v: str) -> str:
    drop = f"greatest(length(bin({v})) - {SKETCH_BITS}, 0)::INT"
    return f"(({v} >> {drop}) << {drop})"


def _fences_sql(table: str, keys: str) -> str:
    part = ", ".join(x for x in (keys, "rate") if x)
    slack = "CASE rate " + " ".join(f"WHEN '{r}' THEN {s}" for r, (s, _) in RATES.items()) + " END"
    return f"""
 SELECT {part}, docs, q1 - {SPREAD} * (q3 - q1) - {slack} AS low,
        q3 + {SPREAD} * (q3 - q1) + {slack} AS high FROM (
  SELECT {part}, max(total) AS docs, min(CASE WHEN upto * 4 >= total THEN bucket END) AS q1,
         min(CASE WHEN upto * 4 >= total * 3 THEN bucket END) AS q3 FROM (
   SELECT *, sum(n) OVER (PARTITION BY {part} ORDER BY bucket) AS upto,
          sum(n) OVER (PARTITION BY {part}) AS total FROM {table}) GROUP BY {part})"""


def oracle() -> str:
    """The same result in DuckDB SQL, by counting windows as rows."""
    rates = {"word_length": "1000 * word_chars // n_words", "symbols": "1000 * n_symbols // n_words",
             "dup_lines": "1000 * n_dup_lines // n_lines",
             "repeats": "1000 * n_repeat_words // n_words"}
    long = " UNION ALL ".join(
        f"SELECT lang, source, '{r}' AS rate, {_bucket_sql(f'({e})')} AS bucket FROM ok"
        for r, e in rates.items())
    tests = " AND ".join(
        f"({e}) <= high_{r}" + (f" AND ({e}) >= low_{r}" if RATES[r][1] else "")
        for r, e in rates.items())
    wide = ", ".join(f"max(CASE WHEN rate = '{r}' THEN {x} END) AS {x}_{r}"
                     for r in rates for x in ("low", "high"))
    cols = "doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed"
    return rf"""
WITH t AS (SELECT doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, [x FOR x IN string_split_regex(text, '[\x20\x09-\x0D]+') IF x <> ''] AS words,
      [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
      FROM t),
g AS (SELECT doc_id, i, list_aggregate(words[i:i + 2], 'string_agg', ' ') AS gram
      FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
r AS (SELECT doc_id, count(DISTINCT p)::BIGINT AS n_repeat_words FROM (
      SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM (
       SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM g) WHERE c > 1) GROUP BY doc_id),
m AS (SELECT doc_id, lang, source, len(words)::BIGINT AS n_words,
      length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
      length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
      (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines) AS n_lines,
      coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
ok AS (SELECT * FROM b WHERE NOT base_failed),
s0 AS (SELECT lang, source, rate, bucket, count(*)::BIGINT AS n FROM ({long}) GROUP BY ALL),
s1 AS (SELECT lang, rate, bucket, sum(n)::BIGINT AS n FROM s0 GROUP BY ALL),
s2 AS (SELECT rate, bucket, sum(n)::BIGINT AS n FROM s1 GROUP BY ALL),
f0 AS ({_fences_sql("s0", "lang, source")}), f1 AS ({_fences_sql("s1", "lang")}),
f2 AS ({_fences_sql("s2", "")}),
f AS (SELECT f0.lang, f0.source, f0.rate,
      CASE WHEN f0.docs >= {LEAST_DOCS} THEN f0.low WHEN f1.docs >= {LEAST_DOCS} THEN f1.low
           ELSE f2.low END AS low,
      CASE WHEN f0.docs >= {LEAST_DOCS} THEN f0.high WHEN f1.docs >= {LEAST_DOCS} THEN f1.high
           ELSE f2.high END AS high
      FROM f0 JOIN f1 ON f0.lang IS NOT DISTINCT FROM f1.lang AND f0.rate = f1.rate
      JOIN f2 ON f0.rate = f2.rate),
p AS (SELECT lang, source, {wide} FROM f GROUP BY ALL),
v AS (SELECT doc_id, {tests} AS verdict FROM ok JOIN p
      ON ok.lang IS NOT DISTINCT FROM p.lang AND ok.source IS NOT DISTINCT FROM p.source)
SELECT {cols}, coalesce(v.verdict, false) AS kept, b.lang, b.source
FROM b LEFT JOIN (SELECT doc_id AS _id, verdict FROM v) v ON b.doc_id = v._id"""
