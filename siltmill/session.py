"""Sessions for one machine. On a cluster, submit with its own configuration and use getOrCreate()."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cpus: int = 8, memory: str = "4g", warehouse: str | None = None, checkpoints: str | None = None) -> SparkSession:
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.sql.adaptive.enabled": "true",
        "spark.driver.memory": memory,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if warehouse:
        conf["spark.sql.warehouse.dir"] = warehouse
    if checkpoints:
        conf["spark.checkpoint.dir"] = checkpoints
    spark = SparkSession.builder.master(f"local[{cpus}]").config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
