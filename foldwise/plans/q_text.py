"""Queries on the ``clf`` view (documents with quality labels): the title and
first-letter rules over whole texts, and label rates / MI with a real label."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import profile as P
from ..operators.select import class_counts, mutual_information
from .q_features import round_doubles
from ..sources.tables import table
from .registry import query
from .views import oracle_with, view

_TITLE_RAW = "regexp_replace(regexp_extract(text, ',\\s*([^.]*)\\.', 1), '^\\s+|\\s+$', '', 'g')"
_MAPPED = (f"(CASE {_TITLE_RAW} WHEN 'Mlle' THEN 'Miss' WHEN 'Ms' THEN 'Miss' WHEN 'Mme' THEN 'Mrs' "
           f"ELSE {_TITLE_RAW} END)")


@query("f1_f3_text_titles", oracle=f"""
SELECT lang, CASE WHEN COALESCE({_MAPPED}, '') IN ('Mr', 'Miss', 'Mrs', 'Master')
                  THEN {_MAPPED} ELSE 'Rare' END AS title,
       CAST(length({_TITLE_RAW}) AS INTEGER) AS raw_title_length, COUNT(*) AS n
FROM documents GROUP BY ALL""")
def q_text_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1-F3 + F19 on whole documents: the text between the first comma and the
    next dot, normalised; counts per language and raw title length."""
    c = table(spark, sf_dir, "documents")
    t = c.select("lang", X.title_b("text").alias("title"),
                 F.length(X.extract_title("text")).cast("int").alias("raw_title_length"))
    return t.groupBy("lang", "title", "raw_title_length").agg(F.count(F.lit(1)).alias("n"))


@query("a11_quality_rate_by_source", oracle=oracle_with("clf", """
SELECT source, COUNT(*) AS count, round(AVG(quality) * 100, 2) AS rate_pct FROM clf GROUP BY source"""))
def q_quality_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality-label rate per document source."""
    c = view(spark, sf_dir, "clf")
    return P.count_and_rate(c, F.col("source"), "source", "quality")


@query("e5a_document_mi", oracle=oracle_with("clf", """,
lg AS (SELECT doc_id, quality, 'lang_' || lang AS feature, 1.0 AS value FROM clf
       UNION ALL SELECT doc_id, quality, 'source_' || source, 1.0 FROM clf
       UNION ALL SELECT doc_id, quality, 'deck', CASE WHEN upper(substr(text, 1, 1)) IN ('A','E','I','O','U') THEN 1.0 ELSE 0.0 END FROM clf),
c0 AS (SELECT feature, value, quality, COUNT(*) AS c FROM lg GROUP BY ALL),
cls AS (SELECT quality, COUNT(*) AS ny FROM clf GROUP BY quality),
seen AS (SELECT feature, quality, SUM(c) AS s FROM c0 GROUP BY ALL),
c AS (SELECT feature, value, quality, SUM(c) AS c FROM (
        SELECT * FROM c0 UNION ALL
        SELECT feature, 0.0, seen.quality, ny - s FROM seen JOIN cls ON seen.quality = cls.quality WHERE ny - s > 0)
      GROUP BY ALL),
px AS (SELECT feature, value, SUM(c) AS cx FROM c GROUP BY ALL),
tot AS (SELECT SUM(ny) AS n FROM cls)
SELECT c.feature, round(GREATEST(SUM(c.c / n * ln(c.c * n / (cx * ny))), 0), 6) AS mi
FROM c JOIN px ON c.feature = px.feature AND c.value = px.value
JOIN cls ON c.quality = cls.quality CROSS JOIN tot GROUP BY c.feature"""))
def q_document_mi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5a with a real label: MI of one-hot language and source, and of a
    first-letter flag of the whole text, with the quality label."""
    c = view(spark, sf_dir, "clf")
    vowel = X.flag(F.upper(F.substring("text", 1, 1)).isin("A", "E", "I", "O", "U")).cast("double")
    long = c.select("doc_id", "quality", F.explode(F.array(
        F.struct(F.concat(F.lit("lang_"), F.col("lang")).alias("feature"), F.lit(1.0).alias("value")),
        F.struct(F.concat(F.lit("source_"), F.col("source")).alias("feature"), F.lit(1.0).alias("value")),
        F.struct(F.lit("deck").alias("feature"), vowel.alias("value")))).alias("_s")).select("doc_id", "quality", "_s.*")
    return round_doubles(mutual_information(long, "quality", class_counts(c, "quality")))
