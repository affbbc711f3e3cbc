"""Queries: profiling, audit, projections, set operations (A5-A26, D1-D3, P*, U*, J5, J7, F5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import contract as C
from ..operators import profile as P
from ..operators.fit import frequencies, frequent_values
from ..operators.lookup import keep_if_listed
from ..sources.tables import table
from .q_features import round_doubles
from .registry import query
from .views import oracle_with, view

PAX_COLS = ["pid", "survived", "pclass", "name", "sex", "age", "sibsp", "parch", "ticket", "fare",
            "cabin", "embarked"]
PAX_TYPES = ["bigint", "int", "int", "string", "string", "double", "int", "int", "string", "double",
             "string", "string"]
LINE_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _nulls_union(view_name: str, cols: list[str], extra: str = "") -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS field, CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS missing{extra} FROM {view_name}"
        for c in cols)


@query("a8_null_counts", oracle=oracle_with("pax", _nulls_union("pax", PAX_COLS)))
def q_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing values per column of the raw record, one pass."""
    return P.null_counts(view(spark, sf_dir, "pax"))


@query("a9_null_share", oracle=oracle_with("pax", f"""
SELECT field, missing, round(missing * 100.0 / (SELECT COUNT(*) FROM pax), 2) AS missing_pct
FROM ({_nulls_union('pax', PAX_COLS)}) t WHERE missing > 0"""))
def q_null_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of missing values, columns with any, largest first."""
    return P.null_share(view(spark, sf_dir, "pax"))


@query("a10_total_nulls", oracle=oracle_with("pax", f"""
SELECT CAST(SUM(missing) AS BIGINT) AS missing_cells FROM ({_nulls_union('pax', PAX_COLS)}) t"""))
def q_total_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: missing cells in the whole raw table."""
    return P.total_nulls(view(spark, sf_dir, "pax"))


@query("a11_label_rate", oracle=oracle_with("olab", """
SELECT o_orderpriority, round(AVG(label) * 100, 6) AS rate_pct FROM olab GROUP BY o_orderpriority"""))
def q_label_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label rate in percent per priority."""
    r = P.label_rate(view(spark, sf_dir, "olab"), "o_orderpriority", "label")
    return round_doubles(r)


@query("a12_label_rate_pivot", oracle=oracle_with("olab", "SELECT o_orderstatus, " + ", ".join(
    f"round(AVG(CASE WHEN c_mktsegment = '{s}' THEN label END) * 100, 6) AS {s}" for s in SEGMENTS) +
    " FROM olab GROUP BY o_orderstatus"))
def q_label_rate_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label rate by status x segment, segments pivoted to columns."""
    r = P.label_rate_pivot(view(spark, sf_dir, "olab"), "o_orderstatus", "c_mktsegment", "label", SEGMENTS)
    return round_doubles(r)


@query("a13_count_rate_by_family", oracle=oracle_with("pax", """
SELECT CAST(sibsp + parch + 1 AS INTEGER) AS family_size, COUNT(*) AS count,
       round(AVG(survived) * 100, 2) AS rate_pct FROM pax GROUP BY 1"""))
def q_count_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count and rounded label rate per derived family size."""
    p = view(spark, sf_dir, "pax")
    return P.count_and_rate(p, X.family_size("sibsp", "parch"), "family_size", "survived")


@query("a14_describe", oracle="\nUNION ALL ".join(
    f"""SELECT '{c}' AS feature, COUNT({c}) AS count, round(AVG({c}), 6) AS mean, round(STDDEV_SAMP({c}), 6) AS std,
       round(MIN({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50,
       round(quantile_cont({c}, 0.75), 6) AS q75, round(MAX({c}), 6) AS max FROM lineitem""" for c in LINE_NUM))
def q_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact describe() of the lineitem measures."""
    return round_doubles(P.describe(table(spark, sf_dir, "lineitem"), LINE_NUM))


@query("a15_info", oracle=oracle_with("pax", "\nUNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS column, COUNT({c}) AS non_null, '{t}' AS dtype FROM pax"
    for i, (c, t) in enumerate(zip(PAX_COLS, PAX_TYPES)))))
def q_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-null counts and types per column."""
    return P.info(view(spark, sf_dir, "pax"))


@query("a16_shape", oracle="SELECT COUNT(*) AS rows, 11 AS columns FROM lineitem")
def q_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows x columns."""
    return P.shape(table(spark, sf_dir, "lineitem"))


@query("a17_correlations", oracle="\nUNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr FROM lineitem"
    for i, a in enumerate(LINE_NUM) for j, b in enumerate(LINE_NUM) if i > j))
def q_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pearson correlations, lower triangle, long form."""
    return round_doubles(P.correlations(table(spark, sf_dir, "lineitem"), LINE_NUM))


def _hist_sql(bins: int, where: str) -> str:
    return f"""WITH r AS (SELECT o_totalprice AS v FROM orders WHERE o_totalprice IS NOT NULL {where}),
m AS (SELECT MIN(v) AS lo, MAX(v) AS hi FROM r),
b AS (SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE LEAST(FLOOR((v - lo) / (hi - lo) * {bins}), {bins - 1}) END AS INTEGER) AS bin,
             lo, hi FROM r CROSS JOIN m)
SELECT bin, round(lo + bin * ((hi - lo) / {bins}), 6) AS lower, round(lo + (bin + 1) * ((hi - lo) / {bins}), 6) AS upper,
       COUNT(*) AS count FROM b GROUP BY bin, lo, hi"""


@query("a18_histogram", oracle=_hist_sql(30, ""))
def q_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """30 equal-width bins of the order price."""
    return round_doubles(P.histogram(table(spark, sf_dir, "orders"), "o_totalprice", 30))


@query("a18_histogram_clipped", oracle=_hist_sql(30, "AND o_totalprice < 200000"))
def q_histogram_clipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A18 + P5: the clipped view (price < 200,000)."""
    o = table(spark, sf_dir, "orders")
    return round_doubles(P.histogram(o, "o_totalprice", 30, where=F.col("o_totalprice") < 200000))


@query("a19_box_stats", oracle="""
WITH q AS (SELECT o_orderpriority, quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.5) AS median,
                  quantile_cont(o_totalprice, 0.75) AS q3 FROM orders GROUP BY o_orderpriority),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lf, q3 + 1.5 * (q3 - q1) AS uf FROM q)
SELECT o.o_orderpriority, round(f.q1, 6) AS q1, round(f.median, 6) AS median, round(f.q3, 6) AS q3,
       round(MIN(CASE WHEN o_totalprice BETWEEN lf AND uf THEN o_totalprice END), 6) AS whisker_low,
       round(MAX(CASE WHEN o_totalprice BETWEEN lf AND uf THEN o_totalprice END), 6) AS whisker_high,
       COUNT(*) FILTER (WHERE NOT (o_totalprice BETWEEN lf AND uf)) AS outliers
FROM orders o JOIN f ON o.o_orderpriority = f.o_orderpriority
GROUP BY o.o_orderpriority, f.q1, f.median, f.q3""")
def q_box_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Box-plot statistics of the price per priority."""
    return round_doubles(P.box_stats(table(spark, sf_dir, "orders"), "o_totalprice", ["o_orderpriority"]))


@query("a19_box_stats_two_keys", oracle="""
WITH q AS (SELECT o_orderpriority, o_orderstatus, quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.5) AS median,
                  quantile_cont(o_totalprice, 0.75) AS q3 FROM orders GROUP BY o_orderpriority, o_orderstatus),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lf, q3 + 1.5 * (q3 - q1) AS uf FROM q)
SELECT o.o_orderpriority, o.o_orderstatus, round(f.q1, 6) AS q1, round(f.median, 6) AS median, round(f.q3, 6) AS q3,
       round(MIN(CASE WHEN o_totalprice BETWEEN lf AND uf THEN o_totalprice END), 6) AS whisker_low,
       round(MAX(CASE WHEN o_totalprice BETWEEN lf AND uf THEN o_totalprice END), 6) AS whisker_high,
       COUNT(*) FILTER (WHERE NOT (o_totalprice BETWEEN lf AND uf)) AS outliers
FROM orders o JOIN f ON o.o_orderpriority = f.o_orderpriority AND o.o_orderstatus = f.o_orderstatus
GROUP BY o.o_orderpriority, o.o_orderstatus, f.q1, f.median, f.q3""")
def q_box_stats_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Box-plot statistics of the price, split by two keys."""
    return round_doubles(P.box_stats(table(spark, sf_dir, "orders"), "o_totalprice", ["o_orderpriority", "o_orderstatus"]))


@query("a20_mean_median", oracle="""
SELECT o_orderstatus, round(AVG(o_totalprice), 6) AS mean, round(quantile_cont(o_totalprice, 0.5), 6) AS median
FROM orders GROUP BY o_orderstatus""")
def q_mean_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and median reference lines per status."""
    return round_doubles(P.mean_median(table(spark, sf_dir, "orders"), "o_totalprice", ["o_orderstatus"]))


@query("a21_duplicate_keys", oracle="""
SELECT l_orderkey, l_linenumber, COUNT(*) AS count FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1""")
def q_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(order, line number) pairs that are not unique."""
    return P.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("a22_domain_violations", oracle="""
SELECT DISTINCT CAST(l_linenumber % 3 AS INTEGER) AS label FROM lineitem WHERE l_linenumber % 3 NOT IN (0, 1)""")
def q_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of a would-be label outside {0, 1}."""
    li = table(spark, sf_dir, "lineitem").select((F.col("l_linenumber") % 3).cast("int").alias("label"))
    return P.domain_violations(li, "label", [0, 1])


@query("a23_mean_std_pop", oracle="""
SELECT o_orderstatus, round(AVG(o_totalprice), 6) AS mean, round(STDDEV_POP(o_totalprice), 6) AS std
FROM orders GROUP BY o_orderstatus""")
def q_mean_std_pop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and population standard deviation per group."""
    return round_doubles(P.mean_std_pop(table(spark, sf_dir, "orders"), "o_totalprice", ["o_orderstatus"]))


@query("a26_prediction_summary", oracle=oracle_with("olab", """
SELECT COUNT(*) AS rows, COUNT(*) FILTER (WHERE o_totalprice / 500000 > 0.5) AS positives,
       COUNT(*) FILTER (WHERE NOT (o_totalprice / 500000 > 0.5)) AS negatives,
       round(AVG(CASE WHEN o_totalprice / 500000 > 0.5 THEN 1.0 ELSE 0.0 END), 6) AS positive_rate FROM olab"""))
def q_prediction_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summary of a thresholded score column."""
    o = view(spark, sf_dir, "olab").select(
        (F.col("o_totalprice") / 500000 > 0.5).cast("int").alias("prediction"))
    return round_doubles(P.prediction_summary(o, "prediction"))


_WORD = "split_part(p_name, ' ', 1)"


@query("a5_value_counts", oracle=f"SELECT {_WORD} AS word, COUNT(*) AS count FROM part GROUP BY 1")
def q_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: frequency table of the first word of the part name."""
    p = table(spark, sf_dir, "part").select(F.split("p_name", " ")[0].alias("word"))
    return frequencies(p, "word")


@query("a6_frequent_words", oracle=f"SELECT {_WORD} AS word, COUNT(*) AS count FROM part GROUP BY 1 HAVING COUNT(*) >= 250")
def q_frequent_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First words seen at least 250 times."""
    p = table(spark, sf_dir, "part").select(F.split("p_name", " ")[0].alias("word"))
    return frequent_values(p, "word", 250)


@query("f5_pool_rare_words", oracle=f"""
WITH w AS (SELECT p_partkey, {_WORD} AS word FROM part),
k AS (SELECT word FROM w GROUP BY word HAVING COUNT(*) >= 250)
SELECT p_partkey, CASE WHEN word IN (SELECT word FROM k) THEN word ELSE 'OTHER' END AS word_pooled FROM w""")
def q_pool_rare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rare first words pooled to OTHER (learned list, broadcast join)."""
    p = table(spark, sf_dir, "part").select("p_partkey", F.split("p_name", " ")[0].alias("word"))
    kept = frequent_values(p, "word", 250)
    return keep_if_listed(p, kept, "word", "word", "word_pooled").select("p_partkey", "word_pooled")


@query("o4_top_words", oracle=f"""
SELECT {_WORD} AS word, COUNT(*) AS count FROM part GROUP BY 1 ORDER BY count DESC, word LIMIT 3""")
def q_top_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three most frequent first words (a top-k report)."""
    p = table(spark, sf_dir, "part").select(F.split("p_name", " ")[0].alias("word"))
    return P.top_values(p, "word", 3)


_LI_SPLIT = """WITH tr AS (SELECT l_orderkey, CAST(l_linenumber % 3 AS INTEGER) AS label FROM lineitem WHERE l_linenumber % 2 = 1),
te AS (SELECT l_orderkey FROM lineitem WHERE l_linenumber % 2 = 0)"""


@query("d1_raw_contract", oracle=_LI_SPLIT + """
SELECT * FROM (
  SELECT 'train_columns' AS "check", CAST(0 AS BIGINT) AS violations
  UNION ALL SELECT 'test_columns', 0
  UNION ALL SELECT 'train_unique_key', (SELECT COUNT(*) FROM (SELECT l_orderkey FROM tr GROUP BY 1 HAVING COUNT(*) > 1))
  UNION ALL SELECT 'test_unique_key', (SELECT COUNT(*) FROM (SELECT l_orderkey FROM te GROUP BY 1 HAVING COUNT(*) > 1))
  UNION ALL SELECT 'disjoint_keys', (SELECT COUNT(DISTINCT l_orderkey) FROM tr WHERE l_orderkey IN (SELECT l_orderkey FROM te))
  UNION ALL SELECT 'label_domain', (SELECT COUNT(*) FROM tr WHERE label NOT IN (0, 1))
) t""".replace('SELECT * FROM (', 'SELECT "check", violations, violations = 0 AS passed FROM ('))
def q_raw_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract of a train/test pair cut from lineitem (odd / even line numbers)."""
    li = table(spark, sf_dir, "lineitem")
    tr = li.where(F.col("l_linenumber") % 2 == 1).select(
        "l_orderkey", (F.col("l_linenumber") % 3).cast("int").alias("label"))
    te = li.where(F.col("l_linenumber") % 2 == 0).select("l_orderkey")
    return C.validate_raw(tr, te, ["l_orderkey", "label"], "l_orderkey", "label")


@query("d3_remaining_nulls", oracle=oracle_with("pax", f"""
SELECT * FROM ({_nulls_union('pax', PAX_COLS)}) t WHERE missing > 0"""))
def q_remaining_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3: columns with missing values (the no-null assertion's evidence)."""
    return C.no_nulls(view(spark, sf_dir, "pax"))


@query("p4_p5_filter", oracle=oracle_with("pax", """
SELECT pid, age, fare FROM pax WHERE age IS NOT NULL AND fare < 200000"""))
def q_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4+P5+P2: drop rows with a missing age, keep fare below 200,000 (pushed to the scan)."""
    p = view(spark, sf_dir, "pax")
    return p.dropna(subset=["age"]).where(F.col("fare") < 200000).select("pid", "age", "fare")


@query("p3_p6_numeric_projection", oracle=oracle_with("pax", """
SELECT survived, pclass, age, sibsp, parch, fare FROM pax"""))
def q_numeric_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric columns only, key excluded."""
    p = view(spark, sf_dir, "pax")
    return p.select(*P.numeric_columns(p, exclude=["pid"]))


@query("u2_column_difference", oracle=oracle_with("pax", """
SELECT 'survived' AS name, 'left_only' AS side, COUNT(survived) AS filled, COUNT(DISTINCT survived) AS values FROM pax WHERE pid % 5 <> 0
UNION ALL SELECT 'embarked', 'left_only', COUNT(embarked), COUNT(DISTINCT embarked) FROM pax WHERE pid % 5 <> 0
UNION ALL SELECT 'kin', 'right_only', COUNT(sibsp + parch), COUNT(DISTINCT sibsp + parch) FROM pax WHERE pid % 5 = 0"""))
def q_column_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns that only one of two batches has, with their filled cells and distinct values there."""
    p = view(spark, sf_dir, "pax")
    left = p.where("pid % 5 <> 0")
    right = p.where("pid % 5 = 0").withColumn("kin", F.col("sibsp") + F.col("parch")).drop("survived", "embarked")
    out = None
    for side, df, other in (("left_only", left, right), ("right_only", right, left)):
        only = [c for c in df.columns if c not in other.columns]
        cells = df.agg(*[g(c).alias(f"{n}{i}") for i, c in enumerate(only) for n, g in (("f", F.count), ("d", F.count_distinct))])
        rows = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(f"f{i}").alias("filled"), F.col(f"d{i}").alias("values")) for i, c in enumerate(only)]))
        part = cells.select(rows.alias("_c")).select("_c.*").join(C.column_difference(left, right).where(F.col("side") == side), "name")
        out = part if out is None else out.unionByName(part)
    return out.select("name", "side", "filled", "values")


@query("j7_key_overlap", oracle="""
SELECT DISTINCT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)""")
def q_key_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer keys that also occur in orders (semi join)."""
    cu = table(spark, sf_dir, "customer").select("c_custkey")
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return C.key_overlap(cu, o, "c_custkey")


@query("u3_not_subset", oracle="""
SELECT DISTINCT o_custkey FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def q_not_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordering customers outside the BUILDING segment (anti join)."""
    o = table(spark, sf_dir, "orders")
    cu = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "BUILDING")
    return C.not_subset(o, "o_custkey", cu, "c_custkey")




_SKEW_SQL = """SELECT l_returnflag, COUNT(*) AS rows,
       round(quantile_cont(l_extendedprice, 0.1), 6) AS p10, round(quantile_cont(l_extendedprice, 0.5), 6) AS p50,
       round(quantile_cont(l_extendedprice, 0.9), 6) AS p90 FROM lineitem GROUP BY l_returnflag"""


def _skewed_quantiles(spark: SparkSession, sf_dir: str, slices: int | None = None) -> DataFrame:
    from ..operators.quantiles import quantiles_from_counts, value_counts
    li = table(spark, sf_dir, "lineitem")
    counts = value_counts(li, ["l_returnflag"], "l_extendedprice")
    q = quantiles_from_counts(counts, ["l_returnflag"], "l_extendedprice", [0.1, 0.5, 0.9],
                              slices=slices)
    n = li.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("rows"))
    return round_doubles(n.join(q, "l_returnflag").select(
        "l_returnflag", "rows", F.col("q0").alias("p10"), F.col("q1").alias("p50"), F.col("q2").alias("p90")))


@query("a1_skewed_group_quantiles", oracle=_SKEW_SQL)
def q_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1/A2 on a hot key: exact deciles of the line price per return flag over
    all lineitem rows (flag N holds about half of them)."""
    return _skewed_quantiles(spark, sf_dir)


@query("a1_skewed_group_quantiles_sliced", oracle=_SKEW_SQL)
def q_skewed_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same statistics with the range cut into 64 slices whatever the
    session's shuffle partitions: the hot group spans many of them."""
    return _skewed_quantiles(spark, sf_dir, 64)
