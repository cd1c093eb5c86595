"""Joins of the corpus jobs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltmill.functions.text import once
from siltmill.operators.dedup import first_by


def ancestors(path: Column) -> Column:
    """All prefixes of a path that end in `/`; none for a path without one."""
    parts = F.split(path, "/", -1)
    prefix = lambda i: F.concat(F.array_join(F.slice(parts, F.lit(1), i), "/"), F.lit("/"))
    return F.when(F.size(parts) > 1, F.transform(F.sequence(F.lit(1), F.size(parts) - 1), prefix)).otherwise(F.array().cast("array<string>"))


def prefix_join(left: DataFrame, right: DataFrame, keys: Sequence[str], path: str, base: str) -> DataFrame:
    """left joined to the rows of right with equal keys whose base is an ancestor of the path; a left row that has
    none stays, with nulls.

    `path starts with base` over bases that end in `/` is the same as `base is an ancestor of path`: a row meets its
    matches by equality on (keys, base), at the cost of the path's depth and not of the key's bases.
    """
    deep = left.withColumn("__base", F.explode_outer(ancestors(F.col(path))))
    on = [*keys, "__base"]
    joined = deep.join(right.withColumnRenamed(base, "__base"), on, "left")
    return joined.withColumnRenamed("__base", base)


def propagate(files: DataFrame, keys: Sequence[str], path: str = "path", values: str = "licenses", out: str = "detected", identity: Sequence[str] = ()) -> DataFrame:
    """Every file with the distinct values found in its own and all enclosing folders, sorted; [] if there are none."""
    files = files.withColumn("__base_path", F.regexp_extract(path, "^(.*/)", 1))
    found = files.filter(F.size(values) > 0).groupBy(*keys, "__base_path").agg(F.array_distinct(F.flatten(F.collect_list(values))).alias("__found"))
    one = [*keys, path, *identity]
    joined = prefix_join(files.select(*one), found, keys, path, "__base_path")
    return joined.groupBy(*one).agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("__found")))).alias(out))


def opted_out(df: DataFrame, repos: DataFrame, users: DataFrame, repo: str = "repo_name") -> DataFrame:
    """df without the repositories that are listed (column repo_name) or whose owner is (column user)."""
    left = df.join(repos.select(F.col("repo_name").alias("__repo")).distinct(), F.col(repo) == F.col("__repo"), "left_anti")
    return left.join(users.select(F.col("user").alias("__user")).distinct(), F.split_part(F.col(repo), F.lit("/"), F.lit(1)) == F.col("__user"), "left_anti")


def opt_out_lists(opt_outs: DataFrame) -> DataFrame:
    """user, scopes -> kind (repo, user_repos, user_commits, user_issues), name. Scopes that are no label are
    repositories; `all` stands for the three labels."""
    labels = {"user_repos": ("all",), "user_commits": ("all", "Commits"), "user_issues": ("all", "GitHub issue")}
    kinds = F.array_compact(F.array(*[F.when(F.arrays_overlap("scopes", F.array(*map(F.lit, on))), F.lit(kind)) for kind, on in labels.items()]))
    users = opt_outs.select(F.explode(kinds).alias("kind"), F.col("user").alias("name"))
    repos = opt_outs.select(F.lit("repo").alias("kind"), F.explode(F.array_except("scopes", F.array(*map(F.lit, ("all", "Commits", "GitHub issue"))))).alias("name"))
    return users.unionByName(repos).distinct()


def licensed(df: DataFrame, licenses: DataFrame, repo: str = "repo_name") -> DataFrame:
    """df with its repository's license_type, without non-permissive repositories and those without a license row."""
    return df.join(licenses.select(F.col("repo_name").alias(repo), "license_type"), repo).filter("license_type <> 'non_permissive'")


def full_outer_once(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Full outer join after each side is cut to one row per key: of several, that of the smallest digest."""
    one = lambda df: first_by(df, [key], [F.xxhash64(*[F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind])])
    return one(left).join(one(right), key, "full")


def paired_files(df: DataFrame, key: Sequence[str], base: str = "base_files", head: str = "head_files", out: str = "head_base_files") -> DataFrame:
    """Files of two arrays with equal paths side by side: an array of struct(base, head) by path, and num_diff_files.
    Of files that share a path in one array the last counts; rows without a pair go. key identifies a row."""
    side = lambda c: df.select(*key, F.posexplode(c).alias("pos", "file"))
    none = F.lit(None)
    both = side(base).select(*key, "pos", F.col("file").alias("b"), none.alias("h")).unionByName(side(head).select(*key, "pos", none.alias("b"), F.col("file").alias("h")))
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("pos")))
    pairs = both.groupBy(*key, F.coalesce("b.path", "h.path").alias("path")).agg(last("b").alias("base"), last("h").alias("head")).filter("base IS NOT NULL AND head IS NOT NULL")
    lists = pairs.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("path", "base", "head"))).alias("__pairs"))
    paired = lists.select(*key, F.transform("__pairs", lambda p: F.struct(p["base"].alias("base"), p["head"].alias("head"))).alias(out), F.size("__pairs").cast("long").alias("num_diff_files"))
    return df.drop(base, head).join(paired, list(key))


def paired(base: Column, head: Column) -> Column:
    """Files of two arrays with equal paths side by side within the row: an array of struct(base, head) by path; null if
    an array is. Of files that share a path in one array the last counts. Work and memory are those of sorting the row's
    files, and nothing is shuffled."""
    tagged = lambda files, side: F.transform(files, lambda f, i: F.struct(f["path"].alias("path"), F.lit(side).alias("side"), i.alias("pos"), f.alias("file")))
    follows = lambda all_of, x, i, side: F.coalesce(F.get(all_of, i + 1)["path"].eqNullSafe(x["path"]) & (F.get(all_of, i + 1)["side"] == side), F.lit(False))
    by_path = F.array_sort(F.concat(tagged(base, 0), tagged(head, 1)))
    last = once(by_path, lambda all_of: F.filter(all_of, lambda x, i: (i == F.size(all_of) - 1) | ~follows(all_of, x, i, x["side"])))
    met = lambda all_of: F.transform(all_of, lambda x, i: F.when((x["side"] == 0) & follows(all_of, x, i, 1), F.struct(x["file"].alias("base"), F.get(all_of, i + 1)["file"].alias("head"))))
    return F.filter(once(last, met), lambda p: p.isNotNull())


def without_listed(df: DataFrame, files: str, listed: Sequence[tuple[str, str]], language: str = "base_language", path: str = "base_path") -> DataFrame:
    """df's file arrays without files whose (language, extension) is listed; rows whose files all go, go.

    The list is configuration, of the size of the languages that there are, and part of the plan.
    """
    names = F.array(*[F.struct(F.lit(x).alias("language"), F.lit(e).alias("extension")) for x, e in listed])
    tag = lambda f: F.struct(f[language].alias("language"), F.regexp_extract(f[path], r"[^/]\.([^./]*)$", 1).alias("extension"))
    kept = df.withColumn(files, F.filter(files, lambda f: ~F.array_contains(names, tag(f)))) if listed else df
    return kept.filter(F.size(files) > 0)


def first_match_chain(df: DataFrame, hops: Sequence[tuple[DataFrame, str, str, Mapping[str, str]]], records: Sequence[str] = ()) -> DataFrame:
    """Follows keys from table to table. Each hop is (table, the column of df to look up, the table's key, columns to
    add: new name by table column); of several rows with a key, the smallest counts. Every row of df stays.

    records: names, a hop each, of columns for all of its table's rows with the key, as a JSON list of records in the
    rows' order; null without one.
    """
    for i, (table, here, there, columns) in enumerate(hops):
        kept = {"__row": F.min(F.struct(*columns))}
        if i < len(records):
            kept[records[i]] = F.to_json(F.sort_array(F.collect_list(F.struct(*table.columns))), {"ignoreNullFields": "false"})
        one = table.filter(F.col(there).isNotNull()).groupBy(F.col(there).alias("__key")).agg(*[c.alias(name) for name, c in kept.items()])
        df = df.join(one, F.col(here) == F.col("__key"), "left")
        df = df.withColumns({new: F.col(f"__row.{old}") for old, new in columns.items()}).drop("__key", "__row")
    return df
