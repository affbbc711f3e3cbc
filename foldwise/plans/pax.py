"""The ``pax`` role view bound to the feature-row operator, plus SQL twins.

Train rows are ``pid % 5 <> 0`` (80 %), the rest is the held-out batch.  The
rule parameters that depend on the measure's scale (age-band edges and the
child threshold on the account-balance role, the two status codes) are set
here; every other value is the reference's default.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.features import Roles
from ..session import materialize
from .views import VIEW_SQL, view

PAX_ROLES = Roles(
    key="pid", label="survived", cls="pclass", name="name", sex="sex", age="age",
    sibsp="sibsp", parch="parch", ticket="ticket", fare="fare", cabin="cabin",
    embarked="embarked",
    sex_codes={"F": 0, "O": 1},
    priority_value="O",
    child_below=0.0,
    age_edges=(float("-inf"), 0, 2000, 4000, 6000, 8000, float("inf")),
)

TRAIN_RULE = "pid % 5 <> 0"


def pax(spark: SparkSession, sf_dir: str, materialized: bool = False) -> DataFrame:
    """The raw record.  ``materialized`` writes the joined view once when a
    query reads it several times (fit and apply), instead of re-joining."""
    v = view(spark, sf_dir, "pax")
    return materialize(v) if materialized else v


def pax_split(spark: SparkSession, sf_dir: str, source: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    p = source if source is not None else pax(spark, sf_dir)
    return p.where(F.expr(TRAIN_RULE)), p.where(~F.expr(TRAIN_RULE))


# ---- DuckDB twins ---------------------------------------------------------

TITLE_SQL = """CASE WHEN COALESCE(CASE trim(regexp_extract(name, ',\\s*([^.]*)\\.', 1))
                     WHEN 'Mlle' THEN 'Miss' WHEN 'Ms' THEN 'Miss' WHEN 'Mme' THEN 'Mrs'
                     ELSE trim(regexp_extract(name, ',\\s*([^.]*)\\.', 1)) END, '')
                 IN ('Mr', 'Miss', 'Mrs', 'Master')
            THEN CASE trim(regexp_extract(name, ',\\s*([^.]*)\\.', 1))
                     WHEN 'Mlle' THEN 'Miss' WHEN 'Ms' THEN 'Miss' WHEN 'Mme' THEN 'Mrs'
                     ELSE trim(regexp_extract(name, ',\\s*([^.]*)\\.', 1)) END
            ELSE 'Rare' END"""

PREFIX_SQL = """CASE WHEN upper(regexp_replace(COALESCE(ticket, ''), '[0-9./\\s]', '', 'g')) = '' THEN 'NONE'
            ELSE upper(regexp_replace(COALESCE(ticket, ''), '[0-9./\\s]', '', 'g')) END"""


def fit_ctes(train_where: str = "pid % 5 <> 0") -> str:
    """CTEs ``tr`` (training rows) and every fitted statistic, DuckDB dialect."""
    return f"""pax AS ({VIEW_SQL['pax']}),
allp AS (SELECT *, {TITLE_SQL} AS title, {PREFIX_SQL} AS prefix FROM pax),
tr AS (SELECT * FROM allp WHERE {train_where}),
a3 AS (SELECT title, pclass, sex, quantile_cont(age, 0.5) AS m FROM tr WHERE age IS NOT NULL GROUP BY title, pclass, sex),
a2 AS (SELECT title, pclass, quantile_cont(age, 0.5) AS m FROM tr WHERE age IS NOT NULL GROUP BY title, pclass),
a1 AS (SELECT pclass, quantile_cont(age, 0.5) AS m FROM tr WHERE age IS NOT NULL GROUP BY pclass),
a0 AS (SELECT quantile_cont(age, 0.5) AS m FROM tr WHERE age IS NOT NULL),
f1 AS (SELECT pclass, quantile_cont(fare, 0.5) AS m FROM tr WHERE fare IS NOT NULL GROUP BY pclass),
f0 AS (SELECT quantile_cont(fare, 0.5) AS m FROM tr WHERE fare IS NOT NULL),
pm AS (SELECT embarked AS m FROM tr WHERE embarked IS NOT NULL GROUP BY embarked
       ORDER BY COUNT(*) DESC, embarked LIMIT 1),
fp AS (SELECT prefix FROM tr GROUP BY prefix HAVING COUNT(*) >= 10),
trf AS (SELECT COALESCE(tr.fare, f1.m, f0.m) AS ff FROM tr LEFT JOIN f1 ON tr.pclass = f1.pclass CROSS JOIN f0),
qe AS (SELECT list_sort(list_distinct([min(ff), quantile_cont(ff, 0.25), quantile_cont(ff, 0.5),
                                        quantile_cont(ff, 0.75), max(ff)])) AS e FROM trf),
edges AS (SELECT CASE WHEN len(e) <= 2 THEN []::DOUBLE[] ELSE list_slice(e, 2, len(e) - 1) END AS inner_edges FROM qe)"""


def clean_rows_sql(train_where: str = "pid % 5 <> 0", extra: str = "", rounded: bool = True) -> str:
    def rnd(x: str) -> str:
        return f"round({x}, 6)" if rounded else x
    return f"""WITH {fit_ctes(train_where)},
j AS (
  SELECT p.*, COALESCE(p.age, a3.m, a2.m, a1.m, a0.m) AS af,
         COALESCE(p.fare, f1.m, f0.m) AS ff, p.sibsp + p.parch + 1 AS fs,
         pm.m AS port_mode, edges.inner_edges
  FROM allp p
  LEFT JOIN a3 ON p.title = a3.title AND p.pclass = a3.pclass AND p.sex = a3.sex
  LEFT JOIN a2 ON p.title = a2.title AND p.pclass = a2.pclass
  LEFT JOIN a1 ON p.pclass = a1.pclass
  CROSS JOIN a0
  LEFT JOIN f1 ON p.pclass = f1.pclass
  CROSS JOIN f0 CROSS JOIN pm CROSS JOIN edges)
SELECT {extra} pid AS PassengerId, pclass AS Pclass, sex AS Sex,
       CAST(CASE WHEN sex = 'F' THEN 0 WHEN sex = 'O' THEN 1 ELSE -1 END AS INTEGER) AS SexEncoded,
       {rnd('af')} AS AgeFilled,
       CASE WHEN af <= 0 THEN 'Child' WHEN af <= 2000 THEN 'Teen' WHEN af <= 4000 THEN 'Young'
            WHEN af <= 6000 THEN 'Middle' WHEN af <= 8000 THEN 'Senior' ELSE 'Elder' END AS AgeBand,
       sibsp AS SibSp, parch AS Parch, CAST(fs AS INTEGER) AS FamilySize,
       CASE WHEN fs > 0 AND fs <= 1 THEN 'Solo' WHEN fs > 1 AND fs <= 4 THEN 'Small'
            WHEN fs > 4 AND fs <= 6 THEN 'Medium' WHEN fs > 6 THEN 'Large' END AS FamilyGroup,
       CAST(CASE WHEN fs = 1 THEN 1 ELSE 0 END AS INTEGER) AS IsAlone,
       {rnd('ff')} AS FareFilled,
       {rnd('CASE WHEN ff > -1 THEN ln(1 + ff) END')} AS FareLog,
       {rnd('ff / fs')} AS FarePerPerson,
       'Q' || CAST(len(list_filter(inner_edges, lambda e: e < ff)) + 1 AS VARCHAR) AS FareBand,
       COALESCE(embarked, port_mode) AS EmbarkedFilled,
       title AS Title,
       CASE WHEN cabin IS NULL OR trim(cabin) = '' THEN 'U' ELSE upper(substr(cabin, 1, 1)) END AS CabinDeck,
       CAST(CASE WHEN cabin IS NOT NULL THEN 1 ELSE 0 END AS INTEGER) AS HasCabin,
       CASE WHEN prefix IN (SELECT prefix FROM fp) THEN prefix ELSE 'OTHER' END AS TicketPrefix,
       sex || '_P' || CAST(pclass AS VARCHAR) AS SexPclass,
       {rnd('af * pclass')} + 0.0 AS AgePclass,
       CAST(length(name) AS INTEGER) AS NameLength,
       CAST(CASE WHEN sex = 'O' THEN 1 WHEN af < 0 THEN 1 ELSE 0 END AS INTEGER) AS WomenChildPriority,
       CAST(CASE WHEN age IS NULL THEN 1 ELSE 0 END AS INTEGER) AS AgeMissing,
       CAST(CASE WHEN fare IS NULL THEN 1 ELSE 0 END AS INTEGER) AS FareMissing,
       CAST(CASE WHEN cabin IS NULL THEN 1 ELSE 0 END AS INTEGER) AS CabinMissing
FROM j"""
