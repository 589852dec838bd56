"""Queries over hot keys (problem 2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.operators.hotkeys import gap_profile, heavy_keys, key_counts
from lexloom.tables import load


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    parts = []
    for table, key in (("chunks", "source"), ("provision_mentions", "statute_id")):
        parts.append(heavy_keys(load(spark, d, table), key).select(F.lit(table).alias("table_name"), "key_value"))
    return parts[0].unionByName(parts[1])


def p2_counts(spark: SparkSession, d: str) -> DataFrame:
    parts = []
    for table, key in (("chunks", "source"), ("provision_mentions", "statute_id")):
        parts.append(key_counts(load(spark, d, table), key).select(F.lit(table).alias("table_name"), F.col(key).alias("key_value"), "n_rows"))
    return parts[0].unionByName(parts[1])


def p2_gaps(spark: SparkSession, d: str) -> DataFrame:
    return gap_profile(load(spark, d, "provision_mentions"), "statute_id", "loaded_at", "mention_id")


QUERIES = {"p2_found": p2_found, "p2_counts": p2_counts, "p2_gaps": p2_gaps}

SQL = {
    "p2_found": """
        SELECT 'chunks' AS table_name, source AS key_value FROM chunks WHERE source IS NOT NULL GROUP BY source
        HAVING count(*) >= 0.05 * (SELECT count(*) FROM chunks)
        UNION ALL
        SELECT 'provision_mentions', statute_id FROM provision_mentions WHERE statute_id IS NOT NULL GROUP BY statute_id
        HAVING count(*) >= 0.05 * (SELECT count(*) FROM provision_mentions)""",
    "p2_counts": """
        SELECT 'chunks' AS table_name, source AS key_value, count(*) AS n_rows FROM chunks GROUP BY source
        UNION ALL SELECT 'provision_mentions', statute_id, count(*) FROM provision_mentions GROUP BY statute_id""",
    "p2_gaps": """
        WITH g AS (SELECT statute_id, epoch_us(loaded_at) AS t,
          epoch_us(loaded_at) - lag(epoch_us(loaded_at)) OVER (PARTITION BY statute_id ORDER BY loaded_at NULLS FIRST, mention_id) AS gap
          FROM provision_mentions)
        SELECT statute_id AS key_value, count(*) AS n_rows, min(t) AS first_us, max(t) AS last_us, coalesce(max(gap), 0) AS longest_gap_us
        FROM g GROUP BY statute_id""",
}
