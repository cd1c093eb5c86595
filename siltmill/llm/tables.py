"""Input tables and the words of the contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltmill.storage import new_path, written

__all__ = ["WORD", "new_path", "table", "written"]

#: Words as the contracts define them: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
