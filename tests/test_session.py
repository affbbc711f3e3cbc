"""Stored intermediate tables: read back, and dropped on request."""

import os

from foldwise.session import checkpoint_dir, drop_materialized, materialize


def test_materialized_tables_are_dropped(spark):
    drop_materialized(spark)
    a = materialize(spark.range(5))
    assert a.count() == 5
    where = os.path.dirname(a.inputFiles()[0]).removeprefix("file://").removeprefix("file:")
    assert os.path.isdir(where) and where.startswith(checkpoint_dir(spark).removeprefix("file://").removeprefix("file:"))
    assert drop_materialized(spark) == 1 and not os.path.exists(where)
    assert drop_materialized(spark) == 0
