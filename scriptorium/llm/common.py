"""What the operators of this subpackage share: tables, intermediate tables in the shared folder, hold-out remainders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.sources.shared import stored  # noqa: F401

DOC_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc32_of(col) -> F.Column:
    """crc32 of an id written as text."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")))
