"""Repositories with their activity, metadata and archived revisions, one per root directory."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltmill.functions.text import repo_of_url, utf8_text
from siltmill.operators.dedup import first_by

BRANCHES = ("HEAD", "refs/heads/master", "refs/heads/main")


def activity(events: DataFrame) -> DataFrame:
    """github_id, full_name and their star and fork events, null where there are none: one pass and one shuffle."""
    named = events.select(F.col("repo.id").alias("github_id"), F.col("repo.name").alias("full_name"), "type").filter("github_id IS NOT NULL AND full_name IS NOT NULL")
    some = lambda kind: F.nullif(F.count_if(F.col("type") == kind), F.lit(0))
    return named.groupBy("github_id", "full_name").agg(some("WatchEvent").alias("star_events_count"), some("ForkEvent").alias("fork_events_count"))


def latest_metadata(events: DataFrame) -> DataFrame:
    """github_id, full_name, license_spdx_id, github_metadata: each repository as its last event describes it."""
    pulls = events.filter("type = 'PullRequestEvent'").select("created_at", F.col("payload.pull_request.base.repo").alias("r"))
    forks = events.filter("type = 'ForkEvent'").select("created_at", F.col("payload.forkee").alias("r"))
    last = pulls.union(forks).filter("r.id IS NOT NULL").groupBy("r.id").agg(F.max_by("r", F.struct("created_at", F.xxhash64("r"))).alias("r"))
    rest = [F.col(f"r.{f.name}") for f in events.schema["payload"].dataType["forkee"].dataType.fields if f.name not in ("id", "full_name")]
    return last.select(F.col("r.id").alias("github_id"), F.col("r.full_name").alias("full_name"), F.col("r.license.spdx_id").alias("license_spdx_id"), F.struct(*rest).alias("github_metadata"))


def repositories(events: DataFrame) -> DataFrame:
    return activity(events).join(latest_metadata(events), ["github_id", "full_name"], "left").withColumn("default_branch", F.concat(F.lit("refs/heads/"), F.col("github_metadata.default_branch")))


def origins(visits: DataFrame) -> DataFrame:
    """The last full visit of each hosted repository."""
    full = visits.filter("origin LIKE 'https://github.com/%' AND status = 'full'")
    last = first_by(full, ["origin"], [F.col("visit").desc(), F.col("date").desc(), F.col("snapshot")])
    return last.select("origin", F.col("date").alias("visit_date"), F.col("snapshot").alias("snapshot_id"), repo_of_url(F.col("origin")).alias("full_name"))


def branches(snapshot_branches: DataFrame) -> DataFrame:
    return snapshot_branches.filter("target_type = 'revision'").select("snapshot_id", utf8_text(F.col("name")).alias("branch_name"), F.col("target").alias("revision_id"))


def revisions(raw: DataFrame) -> DataFrame:
    return raw.filter("type = 'git'").select(F.col("id").alias("revision_id"), F.col("date").alias("revision_date"), "committer_date", F.col("directory").alias("directory_id"))


def merge(events: DataFrame, visits: DataFrame, snapshot_branches: DataFrame, raw_revisions: DataFrame) -> DataFrame:
    """One row per root directory: of the repositories that share it the licensed, then most starred, most forked,
    oldest one. A repository's default branch counts, or a usual name where that is unknown."""
    repos = repositories(events)
    named = first_by(repos, ["full_name"], [F.col("default_branch").asc_nulls_last(), F.col("github_id")])  # renamed repositories share names
    known = origins(visits).join(branches(snapshot_branches), "snapshot_id").join(named, "full_name", "left")
    default = F.col("default_branch")
    on_branch = known.filter((F.col("branch_name") == default) | (default.isNull() & F.col("branch_name").isin(*BRANCHES)))
    dated = on_branch.join(revisions(raw_revisions), "revision_id")
    one = first_by(dated, ["revision_id"], [F.col("revision_date").desc(), F.col("branch_name").desc(), F.col("origin")])
    filled = one.fillna(0, ["star_events_count", "fork_events_count"])
    order = [
        F.col("license_spdx_id").asc_nulls_last(), F.col("star_events_count").desc(), F.col("fork_events_count").desc(), F.col("revision_date").asc(),
        F.col("github_id").asc(), F.col("visit_date").asc(), F.col("revision_id"), F.col("origin"),
    ]
    return first_by(filled, ["directory_id"], order)
