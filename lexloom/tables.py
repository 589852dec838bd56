"""Access to the test tables by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings doc_text segments paras chunks "
    "statute_index provision_mentions candidates cite_pairs mix_targets name_glossary generic_parties"
).split()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder; the Parquet footer carries the schema, nothing is inferred from values."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
