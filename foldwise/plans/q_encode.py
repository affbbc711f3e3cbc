"""Queries: encoding and feature selection on the ``pax`` feature rows
(A24, A25, E1-E8, E5a, E5b, E6, E7, O1, O3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.encode import align_columns, dictionary, encode_long, encode_sparse, encode_wide, fit_encoder, one_hot_union
from ..operators.features import (CATEGORICAL_COLUMNS, PASSTHROUGH_COLUMNS, SCALED_COLUMNS,
                                  apply_features, fit_features)
from ..operators.select import class_counts, mi_of_cells, value_cells
from ..session import materialize
from .pax import PAX_ROLES, clean_rows_sql, pax, pax_split
from .splits import CONTINUOUS, MI_BINS, score_features
from .q_features import round_doubles
from .registry import query
from .views import VIEW_SQL

TRAIN_PID = "PassengerId % 5 <> 0"
SELECT_K = 20


def clean_pax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean rows of all rows with the label, fitted on the training rows."""
    raw = pax(spark, sf_dir, materialized=True)
    train, _ = pax_split(spark, sf_dir, raw)
    fp = fit_features(train, PAX_ROLES)
    return materialize(apply_features(raw, fp, PAX_ROLES, keep=["survived"]))


def clean_train(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Raw and clean training rows, for queries that read the clean rows once: these are
    worked out in that read and not stored."""
    train, _ = pax_split(spark, sf_dir, pax(spark, sf_dir, materialized=True))
    return train, apply_features(train, fit_features(train, PAX_ROLES), PAX_ROLES, keep=["survived"])


def encoded_pax(spark: SparkSession, sf_dir: str):
    """Fit feature row + encoder on the training rows; return (clean rows of all
    rows with the label, encoder params, feature names)."""
    clean = clean_pax(spark, sf_dir)
    ctrain = clean.where(F.expr(TRAIN_PID))
    enc = fit_encoder(ctrain, SCALED_COLUMNS, PASSTHROUGH_COLUMNS, CATEGORICAL_COLUMNS)
    names = list(SCALED_COLUMNS) + list(PASSTHROUGH_COLUMNS) + [f"{c}_{v}" for c, v in one_hot_union(enc)]
    return clean, enc, names


def _feature_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean, enc, names = encoded_pax(spark, sf_dir)
    return score_features(clean.where(F.expr(TRAIN_PID)), PAX_ROLES, names)


# ---- DuckDB twins -----------------------------------------------------------

_CLEAN = f"clean AS ({clean_rows_sql(extra='survived,', rounded=False)}),\nctr AS (SELECT * FROM clean WHERE {TRAIN_PID})"


def _long_sql(source: str) -> str:
    parts = []
    for c in SCALED_COLUMNS:
        parts.append(f"""SELECT PassengerId, survived, '{c}' AS feature,
  ({c} - (SELECT AVG({c}) FROM ctr)) / COALESCE(NULLIF((SELECT STDDEV_POP({c}) FROM ctr), 0), 1) AS value FROM {source}""")
    for c in PASSTHROUGH_COLUMNS:
        parts.append(f"SELECT PassengerId, survived, '{c}', CAST({c} AS DOUBLE) FROM {source}")
    for c in CATEGORICAL_COLUMNS:
        parts.append(f"""SELECT PassengerId, survived, '{c}_' || CAST({c} AS VARCHAR), 1.0 FROM {source}
  WHERE {c} IN (SELECT {c} FROM ctr)""")
    return "\nUNION ALL ".join(parts)


_ENCODED_LONG_SQL = f"""WITH {_CLEAN}
SELECT PassengerId, feature, round(value, 6) AS value FROM ({_long_sql('clean')}) t"""

_probs = ", ".join(str(i / MI_BINS) for i in range(MI_BINS + 1))
_cont = ", ".join(f"'{c}'" for c in CONTINUOUS)

_MI_CTES = f"""{_CLEAN},
lg AS ({_long_sql('ctr')}),
qe AS (SELECT feature, list_sort(list_distinct(quantile_cont(value, [{_probs}]))) AS e
       FROM lg WHERE feature IN ({_cont}) GROUP BY feature),
inner_e AS (SELECT feature, CASE WHEN len(e) <= 2 THEN []::DOUBLE[] ELSE list_slice(e, 2, len(e) - 1) END AS ie FROM qe),
binned AS (SELECT lg.survived, lg.feature,
                  CASE WHEN ie IS NULL THEN lg.value ELSE CAST(len(list_filter(ie, lambda x: x < lg.value)) AS DOUBLE) END AS value
           FROM lg LEFT JOIN inner_e ON lg.feature = inner_e.feature),
c0 AS (SELECT feature, value, survived, COUNT(*) AS c FROM binned GROUP BY ALL),
cls AS (SELECT survived, COUNT(*) AS ny FROM ctr GROUP BY survived),
seen AS (SELECT feature, survived, SUM(c) AS s FROM c0 GROUP BY ALL),
c AS (SELECT feature, value, survived, SUM(c) AS c FROM (
        SELECT * FROM c0 UNION ALL
        SELECT feature, 0.0, seen.survived, ny - s FROM seen JOIN cls ON seen.survived = cls.survived WHERE ny - s > 0)
      GROUP BY ALL),
px AS (SELECT feature, value, SUM(c) AS cx FROM c GROUP BY ALL),
tot AS (SELECT SUM(ny) AS n FROM cls),
mi AS (SELECT c.feature, GREATEST(SUM(c.c / n * ln(c.c * n / (cx * ny))), 0) AS mi
       FROM c JOIN px ON c.feature = px.feature AND c.value = px.value
       JOIN cls ON c.survived = cls.survived CROSS JOIN tot GROUP BY c.feature)"""

# position of each encoded feature: scaled, passthrough, one-hot by column then category order
_pos_parts = [f"SELECT '{c}' AS feature, {i} AS position" for i, c in enumerate(SCALED_COLUMNS + PASSTHROUGH_COLUMNS)]
_pos_cats = "\nUNION ALL ".join(
    f"SELECT '{c}_' || CAST(v AS VARCHAR), {j} AS col_idx, v_key FROM (SELECT DISTINCT {c} AS v, "
    f"{'LPAD(CAST(' + c + ' AS VARCHAR), 12, ' + chr(39) + '0' + chr(39) + ')' if c == 'Pclass' else c} AS v_key FROM ctr)"
    for j, c in enumerate(CATEGORICAL_COLUMNS))
_POSITIONS = f"""pos_num AS ({' UNION ALL '.join(_pos_parts)}),
pos_cat AS (SELECT feature, {len(SCALED_COLUMNS) + len(PASSTHROUGH_COLUMNS)} - 1
                   + row_number() OVER (ORDER BY col_idx, v_key) AS position
            FROM ({_pos_cats}) t(feature, col_idx, v_key)),
pos AS (SELECT * FROM pos_num UNION ALL SELECT feature, CAST(position AS INTEGER) FROM pos_cat)"""


@query("a24_a25_encoder_params", oracle=f"""WITH {_CLEAN}
SELECT 'AgeFilled' AS feature, round(AVG(AgeFilled), 6) AS mean, round(STDDEV_POP(AgeFilled), 6) AS std FROM ctr
UNION ALL SELECT 'FareFilled', round(AVG(FareFilled), 6), round(STDDEV_POP(FareFilled), 6) FROM ctr""")
def q_encoder_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standardisation parameters (population std) learned on training rows."""
    _, enc, _ = encoded_pax(spark, sf_dir)
    return round_doubles(enc.scale)


@query("a25_category_lists", oracle=f"""WITH {_CLEAN}
""" + "\nUNION ALL ".join(f"SELECT DISTINCT '{c}' AS feature, CAST({c} AS VARCHAR) AS category FROM ctr"
                          for c in CATEGORICAL_COLUMNS))
def q_category_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sorted category list of every one-hot column (training rows only)."""
    _, enc, _ = encoded_pax(spark, sf_dir)
    return enc.categories.select("feature", "category")


@query("e4_encoded_long", oracle=_ENCODED_LONG_SQL)
def q_encoded_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1+E3+E4: every row encoded (scaled, passthrough, one-hot; unseen -> no row)."""
    clean, enc, _ = encoded_pax(spark, sf_dir)
    return round_doubles(encode_long(clean, enc, keys=["PassengerId"]))


@query("e4_sparse_cells", oracle=f"""WITH {_CLEAN}
SELECT feature, COUNT(*) AS rows, round(AVG(value), 4) AS mean FROM ({_long_sql('clean')}) t WHERE value <> 0 GROUP BY feature""")
def q_sparse_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1+E4+E8: the sparse rows by encoded column: entries and their mean, named by the dictionary."""
    clean, enc, _ = encoded_pax(spark, sf_dir)
    ids = dictionary(enc)
    rows = encode_sparse(clean, enc, ids, keep=["PassengerId"])
    entries = rows.select(F.explode(F.arrays_zip("indices", "values")).alias("e")).groupBy(F.col("e.indices").alias("id")).agg(
        F.count(F.lit(1)).alias("rows"), F.avg("e.values").alias("mean"))
    named = entries.join(ids, "id").withColumn("feature", F.concat_ws("_", "feature", "category"))
    return named.select("feature", "rows", F.round("mean", 4).alias("mean"))


@query("e8_model_ready_width", oracle=f"""WITH {_CLEAN},
{_POSITIONS}
SELECT (SELECT COUNT(*) FROM clean) AS rows, CAST((SELECT COUNT(*) FROM pos) + 2 AS INTEGER) AS columns,
       CAST(0 AS BIGINT) AS missing_cells, true AS aligned, true AS all_numeric""")
def q_model_ready_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E4+E8+D3+D4+D5: the wide model-ready matrix (key, label, all encoded
    features): shape, missing cells, train/test feature alignment, all numeric."""
    from ..operators.contract import aligned, non_numeric
    from ..operators.profile import total_nulls
    clean, enc, names = encoded_pax(spark, sf_dir)
    wide = align_columns(encode_wide(clean, enc, keep=["PassengerId", "survived"]), names,
                         keep=["PassengerId", "survived"])
    train_m = wide.where(F.expr(TRAIN_PID))
    test_m = align_columns(wide.where(~F.expr(TRAIN_PID)).drop("survived"), names, keep=["PassengerId"])
    same = aligned(train_m, test_m, ignore=["PassengerId", "survived"])
    numeric = not non_numeric(wide)
    n = wide.agg(F.count(F.lit(1)).alias("rows"))
    return n.crossJoin(total_nulls(wide)).select(
        "rows", F.lit(len(wide.columns)).alias("columns"), "missing_cells",
        F.lit(same).alias("aligned"), F.lit(numeric).alias("all_numeric"))


@query("e5_mutual_information", oracle=f"WITH {_MI_CTES}\nSELECT feature, round(mi, 6) AS mi FROM mi")
def q_mutual_information(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5a+E5b: mutual information of every encoded feature with the label."""
    train, clean = clean_train(spark, sf_dir)
    cells = value_cells(clean, "survived", [*SCALED_COLUMNS, *PASSTHROUGH_COLUMNS], CATEGORICAL_COLUMNS)
    return round_doubles(mi_of_cells(cells, "survived", class_counts(train, "survived"), CONTINUOUS, MI_BINS).select("feature", "mi"))


@query("e7_feature_scores", oracle=f"""WITH {_MI_CTES},
{_POSITIONS},
r AS (SELECT mi.feature, mi.mi, row_number() OVER (ORDER BY round(mi.mi, 12) DESC, pos.position DESC) AS rank
      FROM mi JOIN pos ON mi.feature = pos.feature)
SELECT feature, round(mi, 6) AS mutual_information, rank <= {SELECT_K} AS selected, CAST(rank AS INTEGER) AS rank FROM r""")
def q_feature_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E6+E7+O3+O1: score report with the top-20 selection (ties -> later
    column), sorted selected first, then by score, then by name."""
    r = _feature_scores(spark, sf_dir)
    out = r.select("feature", F.col("mi").alias("mutual_information"),
                   (F.col("rank") <= SELECT_K).alias("selected"), F.col("rank").cast("int").alias("rank"))
    return round_doubles(out).orderBy(F.desc("selected"), F.desc("mutual_information"), F.asc("feature"))


_RANKED_SQL = f"""WITH {_MI_CTES},
{_POSITIONS},
r AS (SELECT mi.feature, row_number() OVER (ORDER BY round(mi.mi, 12) DESC, pos.position DESC) AS rank
      FROM mi JOIN pos ON mi.feature = pos.feature),
sel AS (SELECT feature FROM r WHERE rank <= {SELECT_K})"""


@query("e8_model_ready_selected", oracle=f"""{_RANKED_SQL},
every AS ({_long_sql('clean')})
SELECT c.PassengerId, c.survived, sel.feature, round(COALESCE(e.value, 0), 6) AS value
FROM clean c CROSS JOIN sel LEFT JOIN every e ON e.PassengerId = c.PassengerId AND e.feature = sel.feature""")
def q_model_ready_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E8+E6: the model-ready table (key, label at position 1, the 20 selected
    columns in column order), returned cell by cell."""
    clean, enc, every = encoded_pax(spark, sf_dir)
    ranked = score_features(clean.where(F.expr(TRAIN_PID)), PAX_ROLES, every).where(F.col("rank") <= SELECT_K)
    names = [r["feature"] for r in ranked.orderBy("position").collect()]      # 20 rows
    ready = align_columns(encode_wide(clean, enc, keep=["PassengerId", "survived"]), names, keep=["PassengerId", "survived"])
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").alias("value")) for c in names]))
    return round_doubles(ready.select("PassengerId", "survived", cells.alias("_s")).select("PassengerId", "survived", "_s.*"))


_RAW = ["pid", "survived", "pclass", "name", "sex", "age", "sibsp", "parch", "ticket", "fare", "cabin", "embarked"]
_nulls = lambda where: "(SELECT SUM(" + " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in _RAW) + f") FROM pax WHERE {where})"
_clean_nulls = "(SELECT SUM(" + " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in [*SCALED_COLUMNS, *PASSTHROUGH_COLUMNS, *CATEGORICAL_COLUMNS]) + ") FROM clean)"


@query("d8_quality_metrics", oracle=f"""WITH pax AS ({VIEW_SQL['pax']}), {_RANKED_SQL.removeprefix('WITH ')}
SELECT metric, CAST(value AS BIGINT) AS value FROM (
  SELECT 'raw_train_rows' AS metric, (SELECT COUNT(*) FROM pax WHERE pid % 5 <> 0) AS value
  UNION ALL SELECT 'raw_test_rows', (SELECT COUNT(*) FROM pax WHERE pid % 5 = 0)
  UNION ALL SELECT 'raw_columns', {len(_RAW)}
  UNION ALL SELECT 'raw_train_nulls', {_nulls('pid % 5 <> 0')}
  UNION ALL SELECT 'raw_test_nulls', {_nulls('pid % 5 = 0')}
  UNION ALL SELECT 'clean_rows', (SELECT COUNT(*) FROM clean)
  UNION ALL SELECT 'clean_model_nulls', {_clean_nulls}
  UNION ALL SELECT 'encoded_features', (SELECT COUNT(*) FROM pos)
  UNION ALL SELECT 'selected_features', (SELECT COUNT(*) FROM sel)
  UNION ALL SELECT 'unique_keys', (SELECT COUNT(DISTINCT pid) FROM pax)) t""")
def q_quality_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model-free part of the quality report as (metric, value): shapes,
    missing cells before and after cleaning, feature counts, key uniqueness."""
    from ..operators.profile import total_nulls
    raw = pax(spark, sf_dir, materialized=True)
    train, test = pax_split(spark, sf_dir, raw)
    clean, enc, names = encoded_pax(spark, sf_dir)
    used = clean.select(*SCALED_COLUMNS, *PASSTHROUGH_COLUMNS, *CATEGORICAL_COLUMNS)
    selected = _feature_scores(spark, sf_dir).where(F.col("rank") <= SELECT_K)
    measured = [("raw_train_rows", train.agg(F.count(F.lit(1)).alias("value"))), ("raw_test_rows", test.agg(F.count(F.lit(1)).alias("value"))),
                ("raw_columns", raw.agg(F.max(F.lit(len(raw.columns))).alias("value"))),
                ("raw_train_nulls", total_nulls(train).select(F.col("missing_cells").alias("value"))),
                ("raw_test_nulls", total_nulls(test).select(F.col("missing_cells").alias("value"))),
                ("clean_rows", clean.agg(F.count(F.lit(1)).alias("value"))),
                ("clean_model_nulls", total_nulls(used).select(F.col("missing_cells").alias("value"))),
                ("encoded_features", clean.agg(F.max(F.lit(len(names))).alias("value"))),
                ("selected_features", selected.agg(F.count(F.lit(1)).alias("value"))),
                ("unique_keys", raw.agg(F.count_distinct("pid").alias("value")))]
    out = None
    for name, one in measured:
        row = one.select(F.lit(name).alias("metric"), F.col("value").cast("long").alias("value"))
        out = row if out is None else out.unionByName(row)
    return out


def _psi_sql(n: str) -> str:
    small = " ".join(f"WHEN {n} = {m} THEN {sum(1.0 / i for i in range(1, m)) - 0.5772156649015329!r}"
                     for m in range(1, 10))
    x = f"CAST({n} AS DOUBLE)"
    return (f"(CASE {small} ELSE ln({x}) - 1 / (2 * {x}) - 1 / (12 * {x} * {x}) + 1 / (120 * pow({x}, 4))"
            f" - 1 / (252 * pow({x}, 6)) + 1 / (240 * pow({x}, 8)) END)")


def _d(c: str) -> str:
    return f"COALESCE(ABS({c} - value), CAST('inf' AS DOUBLE))"


_KNN_SQL = f"""WITH {_CLEAN},
lg AS ({' UNION ALL '.join(f"SELECT PassengerId AS id, survived AS y, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM ctr" for c in CONTINUOUS)}),
ny AS (SELECT feature, y, COUNT(*) AS n FROM lg GROUP BY feature, y),
p AS (SELECT lg.*, ny.n, LEAST(3, ny.n - 1) AS k FROM lg JOIN ny ON lg.feature = ny.feature AND lg.y = ny.y WHERE ny.n > 1),
w AS (SELECT *, lag(value, 1) OVER wi AS m1, lag(value, 2) OVER wi AS m2, lag(value, 3) OVER wi AS m3,
             lead(value, 1) OVER wi AS p1, lead(value, 2) OVER wi AS p2, lead(value, 3) OVER wi AS p3
      FROM p WINDOW wi AS (PARTITION BY feature, y ORDER BY value, id)),
r AS (SELECT *, CASE k WHEN 1 THEN LEAST({_d('m1')}, {_d('p1')})
                       WHEN 2 THEN LEAST({_d('m2')}, GREATEST({_d('m1')}, {_d('p1')}), {_d('p2')})
                       ELSE LEAST({_d('m3')}, GREATEST({_d('m2')}, {_d('p1')}), GREATEST({_d('m1')}, {_d('p2')}), {_d('p3')}) END AS r
      FROM w),
m AS (SELECT r.feature, r.id, r.n, r.k,
             (SELECT COUNT(*) FROM p q WHERE q.feature = r.feature AND
                ((r.r > 0 AND q.value > r.value - r.r AND q.value < r.value + r.r) OR (r.r = 0 AND q.value = r.value))) AS m
      FROM r),
agg AS (SELECT feature, COUNT(*) AS big_n, AVG({_psi_sql('k')}) AS pk, AVG({_psi_sql('n')}) AS pn, AVG({_psi_sql('m')}) AS pm
        FROM m GROUP BY feature)
SELECT feature, round(GREATEST({_psi_sql('big_n')} + pk - pn - pm, 0), 6) AS mi FROM agg"""


@query("e5c_knn_mutual_information", oracle=_KNN_SQL)
def q_knn_mi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """3-nearest-neighbour MI of the continuous clean features with the label."""
    from ..operators.select import knn_mutual_information
    _, clean = clean_train(spark, sf_dir)
    narrow = materialize(clean.select("PassengerId", "survived", *CONTINUOUS))  # read twice below
    long = narrow.select("PassengerId", "survived", F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in CONTINUOUS]))
        .alias("_s")).select("PassengerId", "survived", "_s.*")
    return round_doubles(knn_mutual_information(long, "PassengerId", "survived"))
