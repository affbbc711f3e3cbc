"""Queries that fit and apply work out the joined record, and the clean rows, once."""

import pytest

from foldwise.plans import pax as pax_module
from foldwise.plans import q_audit, q_encode, q_search, q_srcline


@pytest.mark.parametrize("module,build", [(q_srcline, q_srcline.q_src_preprocessor), (q_audit, q_audit.q_written), (q_search, q_search.q_saved_pipeline)])
def test_joined_record_is_stored_once(spark, sf_dir, monkeypatch, module, build):
    calls, real = [], pax_module.pax

    def seen(spark, sf_dir, materialized=False):
        calls.append(materialized)
        return real(spark, sf_dir, materialized)

    monkeypatch.setattr(pax_module, "pax", seen)
    monkeypatch.setattr(module, "pax", seen)
    assert build(spark, sf_dir).count() > 0
    assert calls == [True]


def test_selected_table_fits_once(spark, sf_dir, monkeypatch):
    calls, real = [], q_encode.fit_features
    monkeypatch.setattr(q_encode, "fit_features", lambda *a: calls.append(1) or real(*a))
    assert q_encode.q_model_ready_selected(spark, sf_dir).count() > 0
    assert len(calls) == 1


@pytest.mark.parametrize("build", [q_encode.q_mutual_information, q_encode.q_knn_mi])
def test_clean_rows_that_are_read_once_are_not_stored_whole(spark, sf_dir, monkeypatch, build):
    widths, real = [], q_encode.materialize
    monkeypatch.setattr(q_encode, "materialize", lambda df: widths.append(len(df.columns)) or real(df))
    assert build(spark, sf_dir).count() > 0
    assert max(widths, default=0) <= 2 + len(q_encode.CONTINUOUS)


@pytest.mark.parametrize("ticket,want", [(None, "NONE"), ("", "NONE"), ("12 3./ ", "NONE"), ("a/5 $1\\", "A$\\")])
def test_prefix_and_title_are_worked_out_once(spark, ticket, want):
    from pyspark.sql import functions as F

    from foldwise.functions import exprs as X
    df = spark.createDataFrame([(ticket, "Doe, Mlle. X")], "t string, n string").repartition(1)
    out = df.select(X.ticket_prefix("t").alias("p"), X.title_b("n").alias("n"), X.title_b(F.lit(None).cast("string")).alias("none"))
    assert tuple(out.first()) == (want, "Miss", "Rare")
    plan = df.select(X.ticket_prefix("t").alias("p"), X.title_b("n").alias("n"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract(") == 1 and plan.count("upper(") == 1


def test_bins_from_bounded_edges(spark):
    from pyspark.sql import functions as F

    from foldwise.functions import exprs as X
    rows = [(v, e) for v in (None, -1.0, 2.0, 2.5, float("nan")) for e in ([], [2.0], [-3.0, 2.0, 2.25], None)]
    df = spark.createDataFrame(rows, "v double, e array<double>")
    got = df.select(X.learned_bin("v", F.col("e")).alias("a"), X.learned_bin("v", F.col("e"), most=3).alias("b"),
                    X.learned_bin_code("v", F.col("e")).alias("c"), X.learned_bin_code("v", F.col("e"), 3).alias("d")).collect()
    assert all(r["a"] == r["b"] and r["c"] == r["d"] for r in got)
    plan = df.select(X.learned_bin_code("v", F.col("e"), 3))._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan
