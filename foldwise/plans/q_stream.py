"""Query: tiered fill learned on the events batch, applied to the events stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.fit import tiered_quantile
from ..operators.lookup import apply_tiered
from ..session import materialize
from ..sources.tables import table
from ..streaming.apply_stream import drain_to_table, file_stream
from .registry import query

EVENT_TIERS = [["event_type"], []]


def with_gaps(df: DataFrame) -> DataFrame:
    """Events with NULL values injected by a fixed rule (every 9th event, all errors)."""
    v = F.when((F.col("event_id") % 9 == 0) | (F.col("event_type") == "error"), F.lit(None)).otherwise(F.col("value"))
    return df.select("event_id", "event_type", v.alias("value"))


_ORACLE = """WITH ev AS (SELECT event_id, event_type,
                   CASE WHEN event_id % 9 = 0 OR event_type = 'error' THEN NULL ELSE value END AS value FROM events),
m1 AS (SELECT event_type, quantile_cont(value, 0.5) AS m FROM ev WHERE value IS NOT NULL GROUP BY event_type),
m0 AS (SELECT quantile_cont(value, 0.5) AS m FROM ev WHERE value IS NOT NULL)
SELECT event_id, CASE WHEN ev.value IS NOT NULL THEN -1 WHEN m1.m IS NOT NULL THEN 0 ELSE 1 END AS tier,
       round(COALESCE(ev.value, m1.m, m0.m), 6) AS value_filled
FROM ev LEFT JOIN m1 ON ev.event_type = m1.event_type CROSS JOIN m0"""


@query("stream_frozen_fill", oracle=_ORACLE)
def q_stream_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parameters fitted on the batch table, applied to the table streamed
    file by file (stream-static broadcast joins, append to a parquet sink)."""
    batch = with_gaps(table(spark, sf_dir, "events"))
    params = materialize(tiered_quantile(batch, EVENT_TIERS, "value"))
    schema = table(spark, sf_dir, "events").schema
    stream = with_gaps(file_stream(spark, sf_dir, "events.parquet", schema))
    filled = apply_tiered(stream, params, EVENT_TIERS, "value", "value_filled", tier_out="tier")
    out = drain_to_table(filled.select("event_id", "tier", F.round("value_filled", 6).alias("value_filled")))
    return out
