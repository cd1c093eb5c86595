"""Tables written a few partitions at a time, so that a job that stops goes on where it was."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltmill.storage import exists

MANIFEST = "_finished"  # readers of the table pass over names that begin so


def finished(spark: SparkSession, path: str, by: T.StructField) -> DataFrame:
    """The partitions that are whole: their value and n_rows; none where nothing has been written."""
    schema = T.StructType([T.StructField(by.name, by.dataType), T.StructField("n_rows", T.LongType())])
    where = f"{path}/{MANIFEST}"
    return spark.read.schema(schema).parquet(where).groupBy(by.name).agg(F.max("n_rows").alias("n_rows")) if exists(spark, where) else spark.createDataFrame([], schema)


def _among(by: str, values: list) -> Column:
    """Whether the column is one of the values, of which one may be null, in a form that a scan prunes by."""
    there = [v for v in values if v is not None]
    tests = ([F.col(by).isin(there)] if there else []) + ([F.col(by).isNull()] if len(there) < len(values) else [])
    return reduce(lambda a, b: a | b, tests)


def write_partitions(df: DataFrame, path: str, by: str, at_once: int = 64, most: int | None = None) -> int:
    """Parquet in folders by one column; partitions that an earlier run finished are neither computed nor written again.
    Returns how many this run wrote; the table is whole once a run without `most` ends.

    A group of at_once partitions replaces what an unfinished run left of them and nothing else (dynamic overwrite), is
    then read back and counted, and only then named in the manifest, so that a job may be stopped at any point. Values
    are taken in their order; `most` ends a run early, as a time budget would. A null value has a folder too; an empty
    table writes nothing. Values are expected in the thousands (days, languages): their list passes the driver, the
    rows do not. Each group computes df for its own values alone, so df should be a table or a plan into which the
    filter on `by` can be pushed. Text values that the folder names would turn into numbers read back as numbers,
    unless the reader gives the schema.
    """
    spark = df.sparkSession
    field = df.schema[by]
    done = finished(spark, path, field).select(F.col(by).alias("__done"), F.lit(True).alias("__is_done"))
    open_ = df.select(by).distinct().join(done, F.col(by).eqNullSafe(F.col("__done")), "left").filter("__is_done IS NULL").select(by).orderBy(by)
    left = [r[0] for r in open_.collect()]
    left = left if most is None else left[:most]
    for i in range(0, len(left), at_once):
        group = left[i : i + at_once]
        df.filter(_among(by, group)).repartition(by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy").partitionBy(by).parquet(path)
        rows = spark.read.schema(df.schema).parquet(path).filter(_among(by, group)).groupBy(by).agg(F.count(F.lit(1)).alias("n_rows"))
        rows.coalesce(1).write.mode("append").parquet(f"{path}/{MANIFEST}")
    return len(left)
