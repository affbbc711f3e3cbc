import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make(spark):
    """Documents from (doc_id, text[, lang, source]) rows, spread over partitions."""
    def frame(rows, parts=3, extra=""):
        full = [(*r, *("en", "s")[len(r) - 2:], None)[:5] if len(r) < 5 else r for r in rows]
        df = spark.createDataFrame(full, SCHEMA)
        for name in extra.split():
            df = df.selectExpr("*", f"concat('x', doc_id) AS `{name}`")
        return df.repartition(parts) if rows else df
    return frame


@pytest.fixture(scope="session")
def duck():
    import duckdb
    return duckdb.connect
