"""Edge rows of FIXTURES part C for the scalar functions."""

from pyspark.sql import functions as F

from foldwise.functions import exprs as X


def one_col(spark, values, typ, expr):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_title_formal_line(spark):
    names = ["X, Mr. Y", "X, Mlle. Y", "X, Ms. Y", "X, Mme. Y", "X, Dr. Y", "X, the Countess. Y",
             "X, Col. Y", "NoComma", None, "X, . Y"]
    assert one_col(spark, names, "string", X.title_b) == [
        "Mr", "Miss", "Miss", "Mrs", "Rare", "Rare", "Rare", "Rare", "Rare", "Rare"]


def test_title_earlier_line(spark):
    names = ["X, Mr. Y", "X, Dr. Y", "X, the Countess. Y", "X, Col. Y", "NoComma", None, "X, . Y"]
    assert one_col(spark, names, "string", X.title_src) == [
        "Mr", "Dr", "the Countess", "Officer", "Unknown", "Unknown", ""]


def test_ticket_prefix(spark):
    t = ["A/5 21171", "PC 17599", "STON/O2. 3101282", "SC/Paris 2123", "W./C. 6608", "113803", "LINE"]
    assert one_col(spark, t, "string", X.ticket_prefix) == ["A", "PC", "STONO", "SCPARIS", "WC", "NONE", "LINE"]


def test_first_letter(spark):
    assert one_col(spark, ["C85", "F G73", "b5", None], "string", lambda c: X.first_letter(c, "U")) == ["C", "F", "B", "U"]
    assert one_col(spark, [None, "  "], "string", lambda c: X.first_letter(c, "M")) == ["M", "M"]


def test_family_and_age_bands(spark):
    fam = one_col(spark, [1, 2, 4, 5, 6, 7], "int", lambda c: X.cut_right(c, X.FAMILY_EDGES, X.FAMILY_LABELS))
    assert fam == ["Solo", "Small", "Small", "Medium", "Medium", "Large"]
    ages = [12.0, 12.5, 18.0, 18.5, 35.0, 50.0, 65.0, 65.5]
    got = one_col(spark, ages, "double", lambda c: X.cut_right(c, X.AGE_EDGES, X.AGE_LABELS))
    assert got == ["Child", "Teen", "Teen", "Young", "Young", "Middle", "Senior", "Elder"]


def test_coded_band(spark):
    vals = [0.0, 0.5, 12.0, 20.0, 40.0, 60.0, 100.0, 101.0, None]
    got = one_col(spark, vals, "double", lambda c: X.cut_right(c, X.SRC_AGE_CODE_EDGES, list(range(5)), 2))
    assert got == [2, 0, 0, 1, 2, 3, 4, 2, 2]


def test_learned_bin(spark):
    edges = F.array(F.lit(7.9104), F.lit(14.4542), F.lit(31.0))
    got = one_col(spark, [0.0, 7.9104, 7.92, 14.4542, 31.0, 31.01], "double", lambda c: X.learned_bin(c, edges))
    assert got == ["Q1", "Q1", "Q2", "Q2", "Q3", "Q4"]


def test_two_value_log_ratio_rule(spark):
    assert one_col(spark, ["male", "female", "unknown", None], "string", X.two_value_code) == [0, 1, -1, -1]
    assert one_col(spark, [0.0, -1.0], "double", X.log1p) == [0.0, None]
    df = spark.createDataFrame([(3.0, 0), (3.0, 2)], "a double, b int")
    assert [r[0] for r in df.select(X.ratio("a", "b")).collect()] == [None, 1.5]
    df = spark.createDataFrame([("female", 60.0), ("male", 15.9), ("male", 16.0)], "s string, a double")
    assert [r[0] for r in df.select(X.priority_rule("s", "a")).collect()] == [1, 1, 0]


def test_safe_cast_dirty_input(spark):
    assert one_col(spark, ["12", "x", None], "string", lambda c: X.safe_cast(c, "int")) == [12, None, None]
