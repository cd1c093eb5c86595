"""Files with the licenses that hold for them, one per blob, typed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltmill.functions.licenses import license_type
from siltmill.operators.dedup import first_by
from siltmill.operators.joins import prefix_join


def typed_files(paths: DataFrame, contents: DataFrame, repos: DataFrame, permissive: Sequence[str]) -> DataFrame:
    """directory_id, path, content_id, blob_id, detected_licenses, the repository's columns, license_type.

    paths: directory_id, path, content_id, blob_id; contents: blob_id, licenses; repos: directory_id, license id
    (gha_license_id), star and fork counts, dates. Licenses are gathered over all files before copies go; of a blob's
    copies that of the permissively licensed, most starred and latest repository stays.
    """
    files = paths.join(contents.select("blob_id", "licenses"), "blob_id")
    folders = files.filter(F.size("licenses") > 0).groupBy("directory_id", F.regexp_extract("path", "^(.*/)", 1).alias("base_path"))
    found = folders.agg(F.array_distinct(F.flatten(F.collect_list("licenses"))).alias("found"))
    ranked = files.drop("licenses").join(repos, "directory_id").withColumn("__good", F.col("gha_license_id").isin(*permissive))
    order = [F.col(c).desc_nulls_last() for c in ("__good", "star_events_count", "fork_events_count", "revision_date", "visit_date")]
    one = first_by(ranked, ["blob_id"], [*order, F.col("directory_id"), F.col("path")]).drop("__good")
    key = ["directory_id", "path", "content_id", "blob_id"]
    joined = prefix_join(one.select(*key), found, ["directory_id"], "path", "base_path")
    detected = joined.groupBy(*key).agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("found")))).alias("detected_licenses"))
    full = detected.join(repos, "directory_id")
    return full.withColumn("license_type", license_type(F.col("gha_license_id"), F.col("detected_licenses"), permissive))
