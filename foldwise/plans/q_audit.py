"""Queries: audit, reproducibility, sinks."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import audit as A
from ..operators.features import CLEAN_COLUMNS, FeatureParams, apply_features, fit_features
from ..operators.profile import total_nulls
from ..session import materialize, scratch_path
from ..sources import sinks
from ..sources.tables import table
from .pax import PAX_ROLES, clean_rows_sql, fit_ctes, pax, pax_split
from .q_profile import PAX_COLS
from .registry import query
from .views import oracle_with

FP_TABLES = {
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
}


def _fp_sql(name: str, cols: list[str]) -> str:
    row = ", ".join(f"COALESCE(CAST(length(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '{A.NULL_TOKEN}')" for c in cols)
    return (f"SELECT '{name}' AS artifact, COUNT(*) AS rows, "
            f"CAST(SUM(CAST(('0x' || substr(md5(concat_ws('|', {row})), 1, {A.DIGEST_DIGITS})) AS BIGINT)) AS VARCHAR) AS fingerprint FROM {name}")


@query("d9_table_fingerprints", oracle="\nUNION ALL ".join(_fp_sql(n, c) for n, c in FP_TABLES.items()))
def q_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-insensitive fingerprints of four tables."""
    return A.fingerprints({n: table(spark, sf_dir, n).select(*c) for n, c in FP_TABLES.items()}, spark)


@query("j9_compare_runs", oracle="\nUNION ALL ".join(
    f"SELECT '{n}' AS artifact, COUNT(*) AS left_rows, COUNT(*) AS right_rows, {'false' if n == 'orders' else 'true'} AS identical FROM {n}" for n in FP_TABLES))
def q_compare_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J9+D9: a second read of each table, reordered, against the first; the
    orders table of the second run has one changed cell."""
    first = A.fingerprints({n: table(spark, sf_dir, n).select(*c) for n, c in FP_TABLES.items()}, spark)
    second = {}
    for n, c in FP_TABLES.items():
        t = table(spark, sf_dir, n).select(*c).orderBy(F.desc(c[0]))
        if n == "orders":
            t = t.withColumn("o_orderstatus", F.when(F.col("o_orderkey") == 1, F.lit("X"))
                             .otherwise(F.col("o_orderstatus")))
        second[n] = t
    cmp = A.compare_fingerprints(first, A.fingerprints(second, spark))
    return cmp.select("artifact", "left_rows", "right_rows", "identical")


# rows of every fitted table, and that both sides of the comparison agree
_PARAMS_SQL = f"""WITH {fit_ctes()}
SELECT 'age' AS artifact, (SELECT COUNT(*) FROM a3) + (SELECT COUNT(*) FROM a2) + (SELECT COUNT(*) FROM a1) + (SELECT COUNT(*) FROM a0) AS left_rows, true AS identical
UNION ALL SELECT 'fare', (SELECT COUNT(*) FROM f1) + (SELECT COUNT(*) FROM f0), true
UNION ALL SELECT 'port_mode', (SELECT COUNT(*) FROM pm), true
UNION ALL SELECT 'prefixes', (SELECT COUNT(*) FROM fp), true
UNION ALL SELECT 'fare_edges', (SELECT COUNT(*) FROM edges), true"""


def _clean_train_test(spark: SparkSession, sf_dir: str):
    train, test = pax_split(spark, sf_dir, pax(spark, sf_dir, materialized=True))
    fp = fit_features(train, PAX_ROLES)
    return train, test, apply_features(train, fp, PAX_ROLES), apply_features(test, fp, PAX_ROLES)


def _missing_sql() -> str:
    raw = "\nUNION ALL ".join(
        f"SELECT '{c}' AS field, COUNT(*) FILTER (WHERE {c} IS NULL AND pid % 5 <> 0) AS tr, "
        f"COUNT(*) FILTER (WHERE {c} IS NULL AND pid % 5 = 0) AS te FROM pax" for c in PAX_COLS)
    clean = "\nUNION ALL ".join(f"SELECT '{c}', 0, 0" for c in CLEAN_COLUMNS)
    return oracle_with("pax", f"""SELECT field, CAST(tr AS BIGINT) AS train_raw_missing, CAST(te AS BIGINT) AS test_raw_missing,
  CAST(CASE WHEN field IN ({', '.join(repr(c) for c in CLEAN_COLUMNS)}) THEN 0 ELSE 0 END AS BIGINT) AS train_clean_missing,
  CAST(0 AS BIGINT) AS test_clean_missing FROM ({raw}
UNION ALL {clean}) t""")


@query("d6_missing_before_after", oracle=_missing_sql())
def q_missing_before_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D6+J4+D3: missing values per field in raw and clean train/test, full outer aligned."""
    train, test, ctrain, ctest = _clean_train_test(spark, sf_dir)
    return A.missing_before_after({"train_raw_missing": train, "test_raw_missing": test.drop("survived"),
                                   "train_clean_missing": ctrain, "test_clean_missing": ctest})


@query("d10_unseen_categories", oracle=oracle_with("pax", "SELECT COUNT(*) AS rows, CAST(0 AS BIGINT) AS missing_cells FROM pax"))
def q_unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit without classes 3 and 4, apply to every row: the clean rows of
    unseen classes still have no missing value (the fallbacks answer)."""
    p = pax(spark, sf_dir)
    fp = fit_features(p.where((F.col("pclass") < 3) & (F.col("pid") % 5 != 0)), PAX_ROLES)
    clean = apply_features(p, fp, PAX_ROLES)
    return clean.agg(F.count(F.lit(1)).alias("rows")).crossJoin(total_nulls(clean))


@query("d11_label_flip_invariance", oracle=_PARAMS_SQL)
def q_label_flip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fitted parameter tables do not change when the label is flipped."""
    train, _ = pax_split(spark, sf_dir)
    a = fit_features(train, PAX_ROLES).tables()
    b = fit_features(train.withColumn("survived", 1 - F.col("survived")), PAX_ROLES).tables()
    return A.compare_fingerprints(A.fingerprints(a, spark), A.fingerprints(b, spark)).select("artifact", "left_rows", "identical")


@query("s6_params_round_trip", oracle=_PARAMS_SQL)
def q_params_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parameter tables written and read back are identical."""
    train, _ = pax_split(spark, sf_dir)
    t = fit_features(train, PAX_ROLES).tables()
    path = scratch_path(spark, "params")
    sinks.write_params(t, path)
    back = sinks.read_params(spark, path, list(t))
    return A.compare_fingerprints(A.fingerprints(t, spark), A.fingerprints(back, spark)).select("artifact", "left_rows", "identical")


@query("s6_json_parameters", oracle=f"""WITH {fit_ctes()}
SELECT 'fare' AS artifact, 0 AS tier, CAST(pclass AS VARCHAR) AS key, round(m, 6) AS value FROM f1
UNION ALL SELECT 'fare', 1, NULL, round(m, 6) FROM f0
UNION ALL SELECT 'fare_edges', CAST(i - 1 AS INTEGER), NULL, round(inner_edges[i], 6) FROM edges, generate_series(1, len(inner_edges)) t(i)
UNION ALL SELECT 'prefixes', CAST(COUNT(*) AS INTEGER), prefix, NULL FROM tr GROUP BY prefix HAVING COUNT(*) >= 10""")
def q_json_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned parameters as they come back from their JSON files."""
    train, _ = pax_split(spark, sf_dir)
    back = _json_back(spark, fit_features(train, PAX_ROLES).tables())
    cls, none = PAX_ROLES.cls, F.lit(None).cast("string")
    fare = back["fare"].select(F.lit("fare").alias("artifact"), F.col("_tier").cast("int").alias("tier"), F.col(cls).cast("string").alias("key"), F.round("median", 6).alias("value"))
    edges = back["fare_edges"].select(F.posexplode("edges").alias("tier", "value")).select(F.lit("fare_edges").alias("artifact"), "tier", none.alias("key"), F.round("value", 6).alias("value"))
    prefixes = back["prefixes"].select(F.lit("prefixes").alias("artifact"), F.col("count").cast("int").alias("tier"), F.col("_prefix").alias("key"), F.lit(None).cast("double").alias("value"))
    return fare.unionByName(edges).unionByName(prefixes)


@query("s6_json_apply", oracle=oracle_with("pax", "SELECT COUNT(*) AS rows, true AS same_rows FROM pax WHERE pid % 5 = 0"))
def q_json_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit, JSON, read, apply: the clean rows equal those of the parameters that never left."""
    train, test = pax_split(spark, sf_dir)
    fitted = fit_features(train, PAX_ROLES)
    back = FeatureParams(**_json_back(spark, fitted.tables()))
    direct, read = (A.fingerprint(apply_features(test, p, PAX_ROLES)).select("rows", F.col("fingerprint").alias(n)) for p, n in ((fitted, "a"), (back, "b")))
    return direct.join(read.withColumnRenamed("rows", "rows_read"), F.col("rows") == F.col("rows_read"), "left").select("rows", F.coalesce(F.col("a") == F.col("b"), F.lit(False)).alias("same_rows"))


def _json_back(spark: SparkSession, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    path = scratch_path(spark, "params")
    sinks.write_params_json(tables, path)
    return sinks.read_params_json(spark, path, list(tables))


@query("s4_s9_written_artifacts", oracle=oracle_with("pax", """
SELECT * FROM (VALUES ('train_clean', (SELECT COUNT(*) FROM pax WHERE pid % 5 <> 0)),
                      ('test_clean', (SELECT COUNT(*) FROM pax WHERE pid % 5 = 0)),
                      ('missing_report', 39)) v(artifact, rows)"""))
def q_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4+S5: clean tables (partitioned parquet, CSV) and a report written and
    read back; rows per artifact."""
    train, test, ctrain, ctest = _clean_train_test(spark, sf_dir)
    ctrain, ctest = materialize(ctrain), materialize(ctest)  # each is written and counted
    base = scratch_path(spark, "artifacts")
    sinks.write_table(ctrain, f"{base}/train_clean", "parquet")
    sinks.write_table(ctest, f"{base}/test_clean", "csv")
    rep = A.missing_before_after({"train_raw_missing": train, "test_raw_missing": test,
                                  "train_clean_missing": ctrain, "test_clean_missing": ctest})
    sinks.write_report(rep, f"{base}/missing_report")
    parts = [spark.read.parquet(f"{base}/train_clean").agg(F.count(F.lit(1)).alias("rows")).select(F.lit("train_clean").alias("artifact"), "rows"),
             spark.read.option("header", True).csv(f"{base}/test_clean").agg(F.count(F.lit(1)).alias("rows")).select(F.lit("test_clean").alias("artifact"), "rows"),
             spark.read.option("header", True).csv(f"{base}/missing_report").agg(F.count(F.lit(1)).alias("rows")).select(F.lit("missing_report").alias("artifact"), "rows")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("s12_file_checksums")
def q_checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SHA-256 of the input parquet files, computed on the executors."""
    return sinks.file_checksums(spark, os.path.join(sf_dir, "*.parquet"))


PAX_SCHEMA = ("pid long, survived int, pclass int, name string, sex string, age double, sibsp int, "
              "parch int, ticket string, fare double, cabin string, embarked string")


@query("s1_s3_csv_contract", oracle=oracle_with("pax", """
SELECT "check", CAST(violations AS BIGINT) AS violations FROM (VALUES ('train_columns', 0), ('test_columns', 0),
  ('train_unique_key', 0), ('test_unique_key', 0), ('disjoint_keys', 0), ('label_domain', 0), ('row_counts', 0))
  v("check", violations)"""))
def q_csv_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1-S3 + D1: the raw train/test pair written as CSV, scanned back with an
    explicit, header-checked schema, and validated (row counts included)."""
    from pyspark.sql.types import _parse_datatype_string
    from ..operators.contract import validate_raw
    from ..sources.tables import load_train_test
    train, test = pax_split(spark, sf_dir)
    n_train, n_test = train.count(), test.count()
    base = scratch_path(spark, "csv")
    sinks.write_table(train, f"{base}/train", "csv")
    sinks.write_table(test.drop("survived"), f"{base}/test", "csv")
    schema = _parse_datatype_string(PAX_SCHEMA)
    tr, te = load_train_test(spark, f"{base}/train", f"{base}/test", schema, "survived")
    checks = validate_raw(tr, te, tr.columns, "pid", "survived", expected_rows=(n_train, n_test))
    return checks.select("check", "violations")


def _dictionary() -> list[tuple[str, str, str, str, str]]:
    from ..operators.features import CATEGORICAL_COLUMNS, PASSTHROUGH_COLUMNS, SCALED_COLUMNS
    role = {**{c: "scaled" for c in SCALED_COLUMNS}, **{c: "passthrough" for c in PASSTHROUGH_COLUMNS},
            **{c: "one-hot" for c in CATEGORICAL_COLUMNS}}
    return [(c, "key" if c == "PassengerId" else ("category" if role.get(c) == "one-hot" else "number"),
             "derived", f"clean feature {c}", role.get(c, "not a model input")) for c in CLEAN_COLUMNS]


@query("d7_field_dictionary", oracle=f"WITH clean AS ({clean_rows_sql(rounded=False)})\n" + "\nUNION ALL ".join(
    f"SELECT '{f}' AS field, '{t}' AS type, '{s}' AS source, '{d}' AS definition, '{g}' AS modeling_guidance, "
    f"COUNT(*) FILTER (WHERE {f} IS NULL) AS missing FROM clean WHERE PassengerId % 5 <> 0" for f, t, s, d, g in _dictionary()))
def q_field_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Field dictionary of the clean feature row, with null counts measured
    on the clean training rows."""
    from ..operators.profile import null_counts
    d = A.field_dictionary(spark, _dictionary())
    _, _, ctrain, _ = _clean_train_test(spark, sf_dir)
    return d.join(null_counts(ctrain), "field", "left")


@query("d7_cleaning_rules", oracle="""SELECT CAST(step AS INTEGER) AS step, item, rule, status FROM (VALUES
  (1, 'structure', 'raw key unique, train and test keys disjoint', 'PASS'),
  (2, 'age', 'tiered median fill: no missing AgeFilled', 'PASS'),
  (3, 'fare', 'class median fill: no missing FareFilled', 'PASS'),
  (4, 'port', 'mode fill: no missing EmbarkedFilled', 'PASS'),
  (5, 'cabin', 'deck letter or U, HasCabin = 1 - CabinMissing', 'PASS'),
  (6, 'title', 'title in Mr, Miss, Mrs, Master, Rare', 'PASS'),
  (7, 'family', 'FamilySize = SibSp + Parch + 1, IsAlone = (FamilySize = 1)', 'PASS'),
  (8, 'bands', 'AgeBand, FareBand and FamilyGroup assigned', 'PASS')) v(step, item, rule, status)""")
def q_cleaning_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaning-rule table, each status measured on the clean rows of
    train and test in one aggregation (PASS when no row violates the rule)."""
    train, test, ctrain, ctest = _clean_train_test(spark, sf_dir)
    clean = ctrain.unionByName(ctest)
    c = F.col
    rules = [
        (2, "age", "tiered median fill: no missing AgeFilled", c("AgeFilled").isNull()),
        (3, "fare", "class median fill: no missing FareFilled", c("FareFilled").isNull()),
        (4, "port", "mode fill: no missing EmbarkedFilled", c("EmbarkedFilled").isNull()),
        (5, "cabin", "deck letter or U, HasCabin = 1 - CabinMissing",
         c("CabinDeck").isNull() | (c("HasCabin") != 1 - c("CabinMissing"))),
        (6, "title", "title in Mr, Miss, Mrs, Master, Rare",
         ~F.coalesce(c("Title").isin("Mr", "Miss", "Mrs", "Master", "Rare"), F.lit(False))),
        (7, "family", "FamilySize = SibSp + Parch + 1, IsAlone = (FamilySize = 1)",
         (c("FamilySize") != c("SibSp") + c("Parch") + 1) | (c("IsAlone") != (c("FamilySize") == 1).cast("int"))),
        (8, "bands", "AgeBand, FareBand and FamilyGroup assigned",
         c("AgeBand").isNull() | c("FareBand").isNull() | c("FamilyGroup").isNull()),
    ]
    counts = clean.agg(*[F.count_if(cond).alias(f"r{step}") for step, _, _, cond in rules])
    dup = train.unionByName(test).groupBy("pid").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    structure = dup.agg(F.count(F.lit(1)).alias("r1"))
    wide = counts.crossJoin(structure)
    allr = [(1, "structure", "raw key unique, train and test keys disjoint")] + [(s, i, r) for s, i, r, _ in rules]
    stacked = F.explode(F.array(*[
        F.struct(F.lit(s).alias("step"), F.lit(i).alias("item"), F.lit(r).alias("rule"),
                 F.when(F.col(f"r{s}") == 0, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"))
        for s, i, r in allr]))
    return wide.select(stacked.alias("_s")).select("_s.*")
