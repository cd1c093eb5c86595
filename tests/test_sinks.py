from pyspark.sql import functions as F

from siltmill.sources import sinks


def test_folders_get_more_files_where_rows_are_many(spark, tmp_path):
    rows = spark.range(0, 4000, 1, 16).select("id", (F.col("id") % 2).alias("p"), F.sha2(F.col("id").cast("string"), 512).alias("text"))
    size, name = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes"), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    try:
        for most, path in (("64m", tmp_path / "few"), ("32k", tmp_path / "many")):
            spark.conf.set(name, most)
            sinks.parquet(rows, str(path), files=2, by=["p"])
            assert sorted(map(tuple, spark.read.parquet(str(path)).select("id", "p", "text").collect())) == sorted(map(tuple, rows.collect()))
        few, many = (max(len(list(d.glob("*.parquet"))) for d in (tmp_path / x).glob("p=*")) for x in ("few", "many"))
        assert few <= 2 < many and many >= 4
    finally:
        spark.conf.set(name, size)
