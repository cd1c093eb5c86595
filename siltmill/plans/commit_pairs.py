"""Commit pairs of pull requests: licensed, not opted out, with files on both sides, not too large, of valid content."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltmill.functions.content import valid_files
from siltmill.operators.diffs import RANGE, range_of
from siltmill.operators.joins import paired

STEPS = ("original", "licensed", "not_opted_out", "with_diffs", "not_too_big", "valid")


class Steps(dict):
    """The table after each step, by STEPS; judged holds every pair once with `reached`, the last step it passes."""

    def __init__(self, judged: DataFrame) -> None:
        self.judged = judged
        super().__init__({step: judged.filter(F.col("reached") >= i).drop("reached") for i, step in enumerate(STEPS)})


def _ranges(pairs: Column) -> Column:
    """Of each pair of files in an array what the diff says, in their order."""

    def ranges(lists: pd.Series) -> pd.Series:
        names = [c.split()[0] for c in RANGE.split(", ")]
        return pd.Series([None if files is None else [dict(zip(names, range_of(f["base"], f["head"]), strict=True)) for f in files] for files in lists], dtype=object)

    texts = F.transform(pairs, lambda p: F.struct(p["base"]["content"].alias("base"), p["head"]["content"].alias("head")))
    # called nondeterministic so that it stays in a projection of its own, computed once however often its columns are used
    return F.pandas_udf(ranges, f"array<struct<{RANGE.replace(' long', ': bigint')}>>").asNondeterministic()(texts)


def judged(pairs: DataFrame, licenses: DataFrame, repos: DataFrame, users: DataFrame, most_changes: int = 1_000_000) -> DataFrame:
    """Every pair once with license_type, head_base_files (pairs of files by path), num_diff_files, files (the valid ones,
    with base_change_start and base_change_end) and `reached`, the place in STEPS of the last step that it passes.

    One scan of the pairs: repositories' licenses and opt-outs are joined as marks, a pair's files are laid side by side
    within its row, and only pairs that come so far are diffed, once. Counting `reached` counts all steps. It is a
    column rather than observed metrics because those count a shuffled stage again that is run again for a lost
    executor. No file content is shuffled for the pairing.

    licenses: one row a repository (of several any one counts). Sizes count the characters of changed base lines over
    all files of a pair. Null repositories have no license; null file arrays have no pairs; an empty table stays empty.
    """
    kinds = licenses.groupBy("repo_name").agg(F.max("license_type").alias("license_type"))
    listed = repos.select("repo_name").distinct().withColumn("__listed_repo", F.lit(True))
    owners = users.select(F.col("user").alias("__user")).distinct().withColumn("__listed_user", F.lit(True))
    marked = pairs.join(kinds, "repo_name", "left").join(listed, "repo_name", "left")
    marked = marked.join(owners, F.split_part("repo_name", F.lit("/"), F.lit(1)) == F.col("__user"), "left")
    licensed = F.coalesce(F.col("license_type") != "non_permissive", F.lit(False))
    is_open = licensed & F.col("__listed_repo").isNull() & F.col("__listed_user").isNull()
    both = F.when(F.col("__open"), paired(F.col("base_files"), F.col("head_files")))
    sides = marked.withColumns({"__licensed": licensed, "__open": is_open}).withColumn("head_base_files", both)
    sides = sides.withColumn("head_base_files", F.when(F.size("head_base_files") > 0, F.col("head_base_files")))
    diffed = sides.withColumn("__ranges", _ranges(F.col("head_base_files")))
    told = F.zip_with("head_base_files", "__ranges", lambda f, r: F.struct(f.alias("f"), r.alias("r")))

    def size(x: Column) -> Column:
        start = F.least(x["r"]["old_start"], F.lit(1 << 30)).cast("int") + 1
        lines = F.slice(F.split(x["f"]["base"]["content"], "\r?\n", -1), start, F.greatest(x["r"]["old_end"] - x["r"]["old_start"], F.lit(0)).cast("int"))
        return F.coalesce(F.aggregate(lines, F.lit(0).cast("long"), lambda a, line: a + F.length(line)), F.lit(0).cast("long"))

    def flat(x: Column) -> Column:
        file = [x["f"][side][c].alias(f"{side}_{c}") for side in ("base", "head") for c in ("path", "content", "language")]
        return F.struct(*file, x["r"]["old_start"].alias("base_change_start"), x["r"]["old_end"].alias("base_change_end"))

    changed = F.aggregate(F.transform("__told", size), F.lit(0).cast("long"), lambda a, n: a + n)
    sized = diffed.withColumn("__told", told).withColumn("__small", changed <= most_changes)
    files = valid_files(F.when(F.col("__small"), F.transform("__told", flat)))
    whole = sized.withColumn("files", files)
    steps = ["__licensed", "__open", F.col("head_base_files").isNotNull(), "__small", F.col("files").isNotNull()]
    passed = F.lit(0)
    for step in steps:  # each step's mark is only true where the one before it is
        passed = passed + F.coalesce(F.col(step) if isinstance(step, str) else step, F.lit(False)).cast("int")
    n = F.size("head_base_files").cast("long")
    kept = [c for c in pairs.columns if c not in ("base_files", "head_files")]
    return whole.select(*[F.col(f"`{c}`") for c in kept], "license_type", "head_base_files", n.alias("num_diff_files"), "files", passed.alias("reached"))


def prepared(pairs: DataFrame, licenses: DataFrame, repos: DataFrame, users: DataFrame, most_changes: int = 1_000_000) -> Steps:
    """The table after each step, as judged() has it.

    pairs: pull_guid, head_commit_id, repo_name, base_files, head_files.
    """
    return Steps(judged(pairs, licenses, repos, users, most_changes))


def funnel(steps: Steps) -> DataFrame:
    """position, step, n_rows: how many pairs pass each step, from one pass over them."""
    counts = steps.judged.groupBy("reached").agg(F.count(F.lit(1)).alias("n"))
    passes = F.explode(F.array(*[F.struct(F.lit(i).alias("position"), F.lit(step).alias("step"), F.when(F.col("reached") >= i, F.col("n")).otherwise(0).alias("n")) for i, step in enumerate(STEPS)]))
    none = steps.judged.sparkSession.range(1).select(F.lit(0).alias("reached"), F.lit(0).cast("long").alias("n"))  # so that an empty table has its steps
    return counts.unionByName(none).select(passes.alias("x")).groupBy("x.position", "x.step").agg(F.sum("x.n").alias("n_rows"))
