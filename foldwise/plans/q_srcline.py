"""Queries: the earlier code line (E10, E2, J3, F10, F12, F23, P8) on ``pax``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.preprocess import create_all_features, fit_src, transform_src
from .pax import PAX_ROLES, pax, pax_split
from .q_features import round_doubles
from .registry import query
from .views import VIEW_SQL

SRC_TITLE_SQL = """CASE WHEN regexp_matches(name, ',\\s*[^.]+\\.') THEN
  CASE trim(regexp_extract(name, ',\\s*([^.]+)\\.', 1))
    WHEN 'Mlle' THEN 'Miss' WHEN 'Ms' THEN 'Miss' WHEN 'Mme' THEN 'Mrs'
    WHEN 'Lady' THEN 'Royalty' WHEN 'Countess' THEN 'Royalty' WHEN 'Sir' THEN 'Royalty'
    WHEN 'Jonkheer' THEN 'Royalty' WHEN 'Don' THEN 'Royalty' WHEN 'Dona' THEN 'Royalty'
    WHEN 'Capt' THEN 'Officer' WHEN 'Col' THEN 'Officer' WHEN 'Major' THEN 'Officer'
    ELSE trim(regexp_extract(name, ',\\s*([^.]+)\\.', 1)) END
  ELSE 'Unknown' END"""

_DECK = "CASE WHEN cabin IS NULL OR trim(cabin) = '' THEN 'M' ELSE upper(substr(cabin, 1, 1)) END"


def _edges_sql(col: str, src: str, q: int) -> str:
    probs = ", ".join(str(i / q) for i in range(q + 1))
    return f"""qe AS (SELECT list_sort(list_distinct(quantile_cont({col}, [{probs}]))) AS e FROM {src}),
edges AS (SELECT CASE WHEN len(e) <= 2 THEN []::DOUBLE[] ELSE list_slice(e, 2, len(e) - 1) END AS ie FROM qe)"""


_SCALED = ["pclass", "age_f", "sibsp", "parch", "fare_f"]

E10_SQL = f"""WITH pax AS ({VIEW_SQL['pax']}),
p AS (SELECT *, {SRC_TITLE_SQL} AS title FROM pax),
tr AS (SELECT * FROM p WHERE pid % 5 <> 0),
am AS (SELECT title, sex, pclass, quantile_cont(age, 0.5) AS m FROM tr WHERE age IS NOT NULL GROUP BY ALL),
a0 AS (SELECT quantile_cont(age, 0.5) AS m FROM tr WHERE age IS NOT NULL),
fm AS (SELECT quantile_cont(fare, 0.5) AS m FROM tr WHERE fare IS NOT NULL),
pm AS (SELECT embarked AS m FROM tr WHERE embarked IS NOT NULL GROUP BY embarked ORDER BY COUNT(*) DESC, embarked LIMIT 1),
ls AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT COALESCE(sex, 'missing') AS v FROM tr)),
le AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT COALESCE(embarked, 'missing') AS v FROM tr)),
filled AS (SELECT p.*, COALESCE(p.age, am.m, a0.m) AS age_f, COALESCE(p.fare, fm.m) AS fare_f,
                  COALESCE(p.embarked, pm.m, 'S') AS emb_f
           FROM p LEFT JOIN am ON p.title = am.title AND p.sex = am.sex AND p.pclass = am.pclass
           CROSS JOIN a0 CROSS JOIN fm CROSS JOIN pm),
trf AS (SELECT * FROM filled WHERE pid % 5 <> 0),
sc AS (SELECT {', '.join(f'AVG({c}) AS mu_{c}, STDDEV_POP({c}) AS sd_{c}' for c in _SCALED)} FROM trf),
{_edges_sql('fare_f', 'trf', 5)}
SELECT pid, {', '.join(f'round(({c} - mu_{c}) / COALESCE(NULLIF(sd_{c}, 0), 1), 6) AS {c.replace("_f", "")}' for c in _SCALED)},
       emb_f AS embarked, title AS Title, {_DECK} AS Deck,
       CAST(COALESCE(ls.code, -1) AS INTEGER) AS sex_encoded, CAST(COALESCE(le.code, -1) AS INTEGER) AS embarked_encoded,
       CAST(sibsp + parch + 1 AS INTEGER) AS FamilySize, CAST(CASE WHEN sibsp + parch + 1 = 1 THEN 1 ELSE 0 END AS INTEGER) AS IsAlone,
       CAST(len(list_filter(ie, lambda x: x < fare_f)) AS INTEGER) AS FareBin,
       CAST(CASE WHEN age_f > 0 AND age_f <= 12 THEN 0 WHEN age_f > 12 AND age_f <= 20 THEN 1 WHEN age_f > 20 AND age_f <= 40 THEN 2
                 WHEN age_f > 40 AND age_f <= 60 THEN 3 WHEN age_f > 60 AND age_f <= 100 THEN 4 ELSE 2 END AS INTEGER) AS AgeBand
FROM filled CROSS JOIN sc CROSS JOIN edges
LEFT JOIN ls ON COALESCE(filled.sex, 'missing') = ls.v LEFT JOIN le ON COALESCE(filled.emb_f, 'missing') = le.v"""


@query("e10_src_preprocessor", oracle=E10_SQL)
def q_src_preprocessor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E10+E2+J3+F10+F12: the configurable preprocessor, fitted on training rows."""
    r = PAX_ROLES
    raw = pax(spark, sf_dir, materialized=True)
    train, _ = pax_split(spark, sf_dir, raw)
    params = fit_src(train, r)
    out = transform_src(raw, params, r)
    return round_doubles(out.select(
        "pid", "pclass", "age", "sibsp", "parch", "fare", "embarked", "Title", "Deck",
        F.col("sex_encoded"), F.col("embarked_encoded"), "FamilySize", "IsAlone", "FareBin", "AgeBand"))


F23_SQL = f"""WITH pax AS ({VIEW_SQL['pax']}),
med AS (SELECT quantile_cont(fare, 0.5) AS fm, quantile_cont(age, 0.5) AS am FROM pax),
f AS (SELECT pax.*, COALESCE(fare, fm) AS fare_f, COALESCE(age, am) AS age_f, {SRC_TITLE_SQL} AS title FROM pax CROSS JOIN med),
{_edges_sql('fare_f', 'f', 5)}
SELECT pid, title AS Title, CAST(sibsp + parch + 1 AS INTEGER) AS FamilySize,
       CAST(CASE WHEN sibsp + parch + 1 = 1 THEN 1 ELSE 0 END AS INTEGER) AS IsAlone,
       (['VeryLow', 'Low', 'Medium', 'High', 'VeryHigh'])[len(list_filter(ie, lambda x: x < fare_f)) + 1] AS FareBin,
       CASE WHEN age_f > 0 AND age_f <= 12 THEN 'Child' WHEN age_f > 12 AND age_f <= 20 THEN 'Teen'
            WHEN age_f > 20 AND age_f <= 40 THEN 'Adult' WHEN age_f > 40 AND age_f <= 60 THEN 'MiddleAge'
            WHEN age_f > 60 AND age_f <= 120 THEN 'Senior' END AS AgeBand,
       {_DECK} AS Deck, sex || '_' || CAST(pclass AS VARCHAR) AS Sex_Pclass,
       title || '_' || CAST(pclass AS VARCHAR) AS Title_Pclass,
       round(age_f * pclass, 6) + 0.0 AS Age_x_Pclass, CAST((sibsp + parch + 1) * pclass AS INTEGER) AS FamilySize_x_Pclass
FROM f CROSS JOIN edges"""


@query("f23_all_features", oracle=F23_SQL)
def q_all_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F23+P8: the batch feature set with interactions (profiling operator)."""
    out = create_all_features(pax(spark, sf_dir), PAX_ROLES)
    return round_doubles(out.select("pid", "Title", "FamilySize", "IsAlone", "FareBin", "AgeBand", "Deck",
                                    "Sex_Pclass", "Title_Pclass", "Age_x_Pclass", "FamilySize_x_Pclass"))
