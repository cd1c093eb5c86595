"""Conversations as raw events of pull requests and issues, through the history operators; events as repositories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltmill.operators import histories
from siltmill.plans import commit_pairs, repo_merge
from siltmill.sources import readers
from siltmill.sources.readers import table

QUERIES, ORACLE = {}, {}


def query(sql: str | None):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _raw(turns: DataFrame) -> DataFrame:
    return turns.select(F.from_json(F.to_json(F.struct(*turns.columns)), histories.RAW).alias("e")).select("e.*")


#: Of each turn: the event's kind (pull request, review, review comment, issue comment, opening of an issue), action, user, and what else the
#: statistics read. Both engines read these columns the same way.
_TURNS = """
  CASE WHEN turn IN (2, 6) AND conv_id % 8 = 3 THEN 'O' WHEN conv_id % 11 = 5 THEN 'I' WHEN turn % 4 = 0 THEN 'P' WHEN turn % 4 = 1 THEN 'R' WHEN turn % 4 = 2 THEN 'I' ELSE 'C' END AS k,
  turn % 4 = 2 OR conv_id % 11 = 5 AS iss,
  CASE WHEN turn IN (2, 6) AND conv_id % 8 = 3 THEN 'opened' WHEN turn % 4 <> 0 THEN 'created' WHEN turn = 0 AND conv_id % 3 <> 0 THEN 'opened' WHEN turn = 0 THEN 'edited' WHEN conv_id % 2 = 0 THEN 'closed' ELSE 'synchronize' END AS action,
  CASE role WHEN 'system' THEN 'sys-bot' ELSE concat(role, CAST(turn % 3 AS STRING)) END AS login,
  turn > 0 AND turn % 4 = 0 AND conv_id % 4 = 0 AS merged,
  concat('b', CAST(CASE WHEN turn > 3 THEN conv_id % 3 ELSE 0 END AS STRING)) AS base,
  concat('h', CAST(CASE WHEN turn > 2 THEN 1 ELSE 0 END AS STRING)) AS head,
  CASE WHEN conv_id % 2 = 0 THEN 0 ELSE turn END AS review,
  CASE (conv_id + turn) % 5 WHEN 0 THEN 'approved' WHEN 1 THEN 'dismissed' WHEN 2 THEN 'commented' WHEN 3 THEN 'changes_requested' ELSE 'pending' END AS state,
  CASE WHEN conv_id % 7 > 0 THEN concat('Title ', CAST(conv_id AS STRING)) END AS title"""


def pull_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as raw events, the way an archive has them."""
    t = table(spark, sf_dir, "conversations").selectExpr("conv_id", "turn", "text", *_split(_TURNS))
    n = F.col("conv_id").cast("string")
    c = F.col
    url = F.concat(F.lit("https://api.host/repos/o"), (c("conv_id") % 9).cast("string"), F.lit("/r/pulls/"), n)
    kind = F.expr("CASE k WHEN 'P' THEN 'PullRequestEvent' WHEN 'R' THEN 'PullRequestReviewEvent' WHEN 'C' THEN 'PullRequestReviewCommentEvent' WHEN 'O' THEN 'IssuesEvent' ELSE 'IssueCommentEvent' END")
    repo = lambda mod: F.struct(F.concat(F.lit("o"), (c("conv_id") % mod).cast("string"), F.lit("/r")).alias("full_name"))
    login = lambda x: F.struct(x.alias("login"))
    pull = F.struct(
        url.alias("url"), "merged", F.lit("2019-01-01T00:00:00Z").alias("created_at"), "title", c("text").alias("body"), login(F.concat(F.lit("owner"), n)).alias("user"),
        F.struct(c("head").alias("sha"), repo(13).alias("repo")).alias("head"), F.struct(c("base").alias("sha"), repo(9).alias("repo")).alias("base"),
    )
    user_type = F.struct(F.when(c("conv_id") % 5 == 0, "Bot").otherwise("User").alias("type"))
    payload = F.struct(
        c("action").alias("action"),
        F.when(~c("iss"), pull).alias("pull_request"),
        F.struct(c("turn").alias("id"), c("text").alias("body"), F.concat(F.lit("src/"), c("state")).alias("path")).alias("comment"),
        F.struct(c("review").alias("id"), c("text").alias("body"), "state", user_type.alias("user")).alias("review"),
        F.when(c("iss"), F.struct(c("conv_id").alias("id"), F.struct(url.alias("url")).alias("pull_request"))).alias("issue"),
    )
    at = F.format_string("2020-01-01T00:00:%02dZ", "turn")
    return _raw(t.select(kind.alias("type"), at.alias("created_at"), login(c("login")).alias("actor"), F.struct(F.lit("a/b").alias("name")).alias("repo"), payload.alias("payload")))


def _split(columns: str) -> list[str]:
    """The columns of an SQL list that ends each with a name in a line of its own."""
    return [x.strip().rstrip(",") for x in columns.strip().split("\n")]


#: Events of pull requests with the openings that are made up for those that lack one.
_PULLS = f"""
t AS (SELECT conv_id, turn, text, {_TURNS} FROM conversations),
b AS (SELECT *, CASE WHEN k = 'R' THEN conv_id % 5 = 0 ELSE login = 'sys-bot' END AS bot FROM t WHERE conv_id % 11 <> 5 AND NOT (k = 'O' AND turn = 2)),
f AS (SELECT * FROM b WHERE turn = 0 AND action <> 'opened'),
e AS (SELECT * EXCLUDE (bot), bot FROM b UNION ALL SELECT conv_id, -1, text, 'P', false, 'opened', 'owner' || conv_id, merged, base, head, review, state, title, bot FROM f)"""


@query("SELECT 'o' || (conv_id % 9) || '/r/pull/' || conv_id AS group_id, k, action, login, CASE WHEN k = 'R' THEN conv_id % 5 = 0 ELSE login = 'sys-bot' END AS is_bot, CASE WHEN k = 'P' THEN title END AS title, text, "
       "CASE k WHEN 'R' THEN review WHEN 'C' THEN turn END AS review_id, CASE WHEN k = 'R' THEN state END AS state, CASE WHEN k = 'C' THEN 'src/' || state END AS path, CASE WHEN NOT iss THEN merged END AS merged, "
       f"CASE WHEN NOT iss THEN base END AS base, turn FROM (SELECT conv_id, turn, text, {_TURNS} FROM conversations)")  # fmt: skip
def flat_pull_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown_events(histories.flat_events(pull_events(spark, sf_dir)))


def shown_events(flat: DataFrame) -> DataFrame:
    """What the query of flat events shows of them."""
    k = F.expr("CASE type WHEN 'PullRequestEvent' THEN 'P' WHEN 'PullRequestReviewEvent' THEN 'R' WHEN 'PullRequestReviewCommentEvent' THEN 'C' WHEN 'IssuesEvent' THEN 'O' ELSE 'I' END")
    return flat.select(
        "group_id", k.alias("k"), "action", F.col("actor_login").alias("login"), F.col("actor_is_bot").alias("is_bot"), "title", "text", F.col("review_comment_id").alias("review_id"), F.col("review_state").alias("state"),
        F.col("comment_path").alias("path"), F.col("pull_merged").alias("merged"), F.col("base_commit_id").alias("base"), F.substring("created_at", 18, 2).cast("long").alias("turn"),
    )


def _histories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histories.pull_histories(histories.routed(histories.flat_events(pull_events(spark, sf_dir)))[1])


@query(f"""
WITH {_PULLS},
l AS (SELECT conv_id, review, arg_max(state, turn) AS state FROM e WHERE k = 'R' GROUP BY ALL),
r AS (SELECT conv_id, count(*) FILTER (state = 'approved') AS approved, count(*) FILTER (state = 'dismissed') AS dismissed, count(*) FILTER (state = 'commented') AS commented,
  count(*) FILTER (state = 'changes_requested') AS changes_requested, count(*) FILTER (state = 'pending') AS other FROM l GROUP BY conv_id)
SELECT 'o' || (conv_id % 9) || '/r/pull/' || conv_id AS pull_guid,
  max((k = 'P' AND bot AND action = 'opened')::INT) AS is_bot_opened, max((NOT iss AND action = 'closed')::INT) AS is_closed, max((NOT iss AND merged)::INT) AS is_merged,
  count(DISTINCT login) FILTER (NOT bot) AS n_non_bot_users, count(DISTINCT login) FILTER (bot) AS n_bot_users, count(*) FILTER (k = 'P') AS n_pre, count(*) FILTER (k = 'P' AND bot) AS n_pre_bot,
  count(*) FILTER (k IN ('R', 'C')) AS n_cre, count(*) FILTER (k IN ('R', 'C') AND bot) AS n_cre_bot, count(*) FILTER (iss) AS n_ie, count(*) FILTER (iss AND bot) AS n_ie_bot,
  count(DISTINCT base || head) FILTER (NOT iss) AS n_commit_pairs, greatest(count(DISTINCT base) FILTER (NOT iss) - 1 - max((NOT iss AND merged)::INT), 0)::BIGINT AS n_rebases,
  coalesce(length((list(text ORDER BY turn) FILTER (k = 'P'))[1]), 0) AS pr_desc_len, coalesce(length((list(title ORDER BY turn) FILTER (k = 'P'))[1]), 0) AS pr_title_len,
  coalesce(any_value(approved), 0) AS review_n_approved, coalesce(any_value(dismissed), 0) AS review_n_dismissed, coalesce(any_value(commented), 0) AS review_n_commented,
  coalesce(any_value(changes_requested), 0) AS review_n_changes_requested, coalesce(any_value(other), 0) AS review_n_other
FROM e LEFT JOIN r USING (conv_id) GROUP BY conv_id""")
def pull_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histories.with_stats(_histories(spark, sf_dir)).drop("events")


@query(f"""
WITH {_PULLS} SELECT 'o' || (conv_id % 9) || '/r/pull/' || conv_id AS pull_guid FROM e GROUP BY conv_id
HAVING max((k = 'P' AND bot AND action = 'opened')::INT) = 0 AND coalesce(length((list(text ORDER BY turn) FILTER (k = 'P'))[1]), 0) > 0 AND (count(*) FILTER (k IN ('R', 'C') AND NOT bot) > 0 OR count(*) FILTER (iss AND NOT bot) > 0)""")
def discussed_pulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histories.discussed(histories.with_stats(_histories(spark, sf_dir))).select("pull_guid")


@query(f"""
WITH {_PULLS},
v AS (SELECT DISTINCT conv_id FROM e WHERE k = 'P' AND action = 'opened' AND (login IN ('sys-bot', 'user1', 'owner9', 'o3') OR 'o' || (conv_id % 13) IN ('o3') OR 'o' || (conv_id % 9) IN ('o3')))
SELECT 'o' || (conv_id % 9) || '/r/pull/' || conv_id AS pull_guid, count(*) AS n_events, string_agg(k || ':' || login, ' ' ORDER BY turn) AS events FROM e
WHERE conv_id NOT IN (SELECT conv_id FROM v) AND login NOT IN ('sys-bot', 'user1', 'owner9', 'o3') GROUP BY conv_id""")
def unlisted_pulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = spark.range(1).select(F.explode(F.array(*map(F.lit, ("sys-bot", "user1", "owner9", "o3")))).alias("user"))
    k = lambda x: F.when(x["type"] == "PullRequestEvent", "P").when(x["type"] == "PullRequestReviewEvent", "R").when(x["type"] == "PullRequestReviewCommentEvent", "C").when(x["type"] == "IssuesEvent", "O").otherwise("I")
    shown = F.transform("events", lambda x: F.concat(k(x), F.lit(":"), x["actor_login"]))
    return histories.without_users(_histories(spark, sf_dir), users).select("pull_guid", F.size("events").cast("long").alias("n_events"), F.array_join(shown, " ").alias("events"))


@query(f"""
WITH {_PULLS}, o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS seen FROM e),
u AS (SELECT conv_id, login, dense_rank() OVER (PARTITION BY conv_id ORDER BY min(seen)) - 1 AS number FROM o GROUP BY conv_id, login)
SELECT 'o' || (conv_id % 9) || '/r/pull/' || conv_id AS pull_guid, string_agg('username_' || number, ' ' ORDER BY turn) AS users FROM o JOIN u USING (conv_id, login) GROUP BY conv_id""")
def masked_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    masked = histories.with_placeholders(_histories(spark, sf_dir))
    return masked.select("pull_guid", F.array_join(F.transform("events", lambda x: x["actor_login"]), " ").alias("users"))


@query(f"""
WITH {_PULLS} SELECT 'o' || (conv_id % 9) || '/r/pull/' || conv_id AS pull_guid, arg_min(head, turn) FILTER (NOT iss) AS head, arg_min(base, turn) FILTER (NOT iss) AS base,
  count(*) FILTER (k = 'R' AND state = 'approved') AS n_approvals, bool_or(NOT iss AND merged) AS is_merged, greatest(count(DISTINCT base) FILTER (NOT iss) - 1 - bool_or(NOT iss AND merged)::INT, 0)::INT AS n_rebases
FROM e GROUP BY conv_id""")
def first_commit_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = histories.first_commits(F.col("events"))
    return _histories(spark, sf_dir).select("pull_guid", first["head"].alias("head"), first["base"].alias("base"), histories.approvals(F.col("events")).cast("long").alias("n_approvals"), histories.is_merged(F.col("events")).alias("is_merged"), histories.rebases(F.col("events")).alias("n_rebases"))


@query("""
WITH t AS (SELECT conv_id, turn, role, text, turn % 3 = 0 AS is_issue, format('2020-01-01T00:00:{:02d}Z', turn) AS told,
    CASE WHEN turn % 3 > 0 THEN CASE WHEN turn % 4 = 1 THEN 'deleted' ELSE 'created' END WHEN turn > 0 THEN 'closed' WHEN conv_id % 2 = 0 THEN 'opened' ELSE 'edited' END AS action FROM conversations),
e AS (SELECT conv_id, turn, is_issue, action, told, role AS author, 'Title ' || conv_id AS title, CASE WHEN is_issue THEN 'body ' || turn WHEN action <> 'deleted' THEN text END AS text FROM t
  UNION ALL SELECT conv_id, -1, true, 'opened', '2019', 'opener', 'Title ' || conv_id, 'body 0' FROM t WHERE turn = 0 AND action <> 'opened')
SELECT conv_id AS issue_id, count(*) AS n_events, 'REPO: o/r' || chr(10) || CASE WHEN conv_id % 5 = 0 THEN '' ELSE 'ORG: org' || chr(10) END || 'ISSUE NUMBER: ' || (conv_id % 50) || chr(10) || chr(10) || string_agg(
  CASE WHEN is_issue THEN 'ISSUE ' ELSE 'COMMENT ' END || upper(action) || ' [' || told || '] BY ' || author || chr(10) || CASE WHEN NOT is_issue THEN coalesce(text || chr(10), '')
    WHEN action IN ('opened', 'edited') THEN 'TITLE: ' || title || chr(10) || 'DESCRIPTION: ' || text || chr(10) ELSE '' END, chr(10) ORDER BY turn) AS text FROM e GROUP BY conv_id""")
def issue_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    turn, n = F.col("turn"), F.col("conv_id")
    action = F.expr("CASE WHEN turn % 3 > 0 THEN CASE WHEN turn % 4 = 1 THEN 'deleted' ELSE 'created' END WHEN turn > 0 THEN 'closed' WHEN conv_id % 2 = 0 THEN 'opened' ELSE 'edited' END")
    issue = F.struct(n.alias("id"), (n % 50).alias("number"), F.concat(F.lit("Title "), n.cast("string")).alias("title"), F.concat(F.lit("body "), turn.cast("string")).alias("body"), F.lit("2019").alias("created_at"), F.struct(F.lit("opener").alias("login")).alias("user"))
    comment = F.when(turn % 3 > 0, F.struct(turn.alias("id"), F.col("text").alias("body")))
    raw = table(spark, sf_dir, "conversations").select(
        F.when(turn % 3 == 0, "IssuesEvent").otherwise("IssueCommentEvent").alias("type"), F.format_string("2020-01-01T00:00:%02dZ", "turn").alias("created_at"), F.struct(F.col("role").alias("login")).alias("actor"),
        F.struct(F.lit("o/r").alias("name")).alias("repo"), F.when(n % 5 > 0, F.struct(F.lit("org").alias("login"))).alias("org"), F.struct(action.alias("action"), comment.alias("comment"), issue.alias("issue")).alias("payload"),
    )
    made = histories.issue_histories(histories.routed(histories.flat_events(_raw(raw)))[0])
    return made.select("issue_id", F.size("events").cast("long").alias("n_events"), histories.issue_text().alias("text"))


@query("""
WITH e AS (SELECT event_id, user_id AS id, 'o/' || (user_id % 120) AS name, event_type, CASE event_id % 4 WHEN 0 THEN 'dev' WHEN 1 THEN 'main' END AS branch, CASE event_id % 3 WHEN 0 THEN 'MIT' WHEN 1 THEN 'GPL-3.0' END AS license FROM events),
a AS (SELECT id, name, nullif(count(*) FILTER (event_type = 'view'), 0) AS stars, nullif(count(*) FILTER (event_type = 'error'), 0) AS forks FROM e GROUP BY ALL),
m AS (SELECT id, arg_max(struct_pack(branch, license), event_id) AS x FROM e WHERE event_type IN ('error', 'purchase') GROUP BY id),
r AS (SELECT a.*, 'refs/heads/' || x.branch AS branch, x.license AS license FROM a LEFT JOIN m USING (id)),
n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY branch NULLS LAST, id) AS i FROM r) WHERE i = 1),
v AS (SELECT * FROM (SELECT 'o/' || (c_custkey % 120) AS name, c_custkey AS c, row_number() OVER (PARTITION BY c_custkey % 120 ORDER BY c_custkey DESC) AS i FROM customer WHERE c_custkey % 7 > 0) WHERE i = 1),
b AS (SELECT v.name, c, 3 * c + k AS v, ['HEAD', 'refs/heads/main', 'refs/heads/dev'][k + 1] AS branch FROM v, (SELECT unnest([0, 1, 2]) AS k)),
o AS (SELECT b.name, b.c, b.v, b.branch, id, license, coalesce(stars, 0) AS stars, coalesce(forks, 0) AS forks, n.branch AS main FROM b LEFT JOIN n USING (name)),
d AS (SELECT *, v % 40 AS directory, v % 17 AS date FROM o WHERE (branch = main OR (main IS NULL AND branch IN ('HEAD', 'refs/heads/main'))) AND v % 10 <> 4)
SELECT 'd' || directory AS directory_id, name AS full_name, 'v' || v AS revision_id, license AS license_spdx_id, stars AS star_events_count, forks AS fork_events_count, branch AS branch_name
FROM (SELECT *, row_number() OVER (PARTITION BY directory ORDER BY license NULLS LAST, stars DESC, forks DESC, date, id NULLS FIRST, c, 'v' || v, name) AS i FROM d) WHERE i = 1""")
def merged_repositories(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = lambda c: F.concat(F.lit("o/"), (F.col(c) % 120).cast("string"))
    kind = F.expr("CASE event_type WHEN 'view' THEN 'WatchEvent' WHEN 'error' THEN 'ForkEvent' WHEN 'purchase' THEN 'PullRequestEvent' ELSE 'PushEvent' END")
    branch = F.expr("CASE event_id % 4 WHEN 0 THEN 'dev' WHEN 1 THEN 'main' END")
    spdx = F.struct(F.expr("CASE event_id % 3 WHEN 0 THEN 'MIT' WHEN 1 THEN 'GPL-3.0' END").alias("spdx_id"))
    repo = F.struct(F.col("user_id").alias("id"), key("user_id").alias("full_name"), branch.alias("default_branch"), spdx.alias("license"))
    payload = F.struct(F.when(kind == "PullRequestEvent", F.struct(F.struct(repo.alias("repo")).alias("base"))).alias("pull_request"), F.when(kind == "ForkEvent", repo).alias("forkee"))
    raw = table(spark, sf_dir, "events").select(kind.alias("type"), F.timestamp_seconds(F.lit(1_600_000_000) + F.col("event_id")).alias("created_at"), F.struct(F.col("user_id").alias("id"), key("user_id").alias("name")).alias("repo"), payload.alias("payload"))
    events = raw.select(F.from_json(F.to_json(F.struct(*raw.columns)), readers.EVENTS).alias("e")).select("e.*")
    c = F.col("c_custkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    date = F.format_string("%010d", c)
    visits = customers.select(F.concat(F.lit("https://github.com/"), key("c_custkey")).alias("origin"), c.alias("visit"), F.when(c % 7 == 0, "partial").otherwise("full").alias("status"), date.alias("date"), F.concat(F.lit("s"), c.cast("string")).alias("snapshot"))
    names = customers.select("c_custkey", F.posexplode(F.array(*map(F.lit, ("HEAD", "refs/heads/main", "refs/heads/dev")))).alias("k", "branch")).withColumn("v", 3 * c + F.col("k"))
    revision = F.concat(F.lit("v"), F.col("v").cast("string"))
    branches = names.select(F.concat(F.lit("s"), c.cast("string")).alias("snapshot_id"), F.col("branch").cast("binary").alias("name"), F.lit("revision").alias("target_type"), revision.alias("target"))
    revisions = names.select(revision.alias("id"), F.when(F.col("v") % 10 == 4, "svn").otherwise("git").alias("type"), (F.col("v") % 17).alias("date"), (F.col("v") % 17).alias("committer_date"), F.concat(F.lit("d"), (F.col("v") % 40).cast("string")).alias("directory"))
    merged = repo_merge.merge(events, visits, branches, revisions)
    return merged.select("directory_id", "full_name", "revision_id", "license_spdx_id", "star_events_count", "fork_events_count", "branch_name")


def _commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A commit per conversation: of twenty lines the one that its number names is changed."""
    n = F.col("conv_id")
    first = table(spark, sf_dir, "conversations").filter("turn = 0").select("conv_id", F.replace("text", F.lit("\n"), F.lit(" ")).alias("text"))
    line = F.when(n % 6 == 0, F.repeat(F.lit("#"), 90)).otherwise(F.substring("text", 1, 90))
    lines = F.transform(F.sequence(F.lit(0), F.lit(19)), lambda i: F.when(i == n % 20, line).otherwise(F.concat(F.when(n % 6 == 0, F.lit("## # ")).otherwise(F.lit("line ")), i.cast("string"))))
    base = F.array_join(lines, "\n")
    file = lambda path, text: F.struct(path.alias("path"), text.alias("content"), F.lit("Python").alias("language"))
    head = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(19)), lambda i: F.when(i == n % 20, F.lit("new")).otherwise(F.get(lines, i))), "\n")
    path = F.when(n % 5 == 0, F.lit("other")).otherwise(F.lit("src/a.py"))
    return first.select(
        F.concat(F.lit("p"), n.cast("string")).alias("pull_guid"), F.lit("h").alias("head_commit_id"), F.concat(F.lit("o"), (n % 8).cast("string"), F.lit("/r"), (n % 3).cast("string")).alias("repo_name"),
        F.array(file(F.lit("src/a.py"), base), file(F.lit("gone"), F.lit("x"))).alias("base_files"), F.array(file(path, head)).alias("head_files"),
    )


@query("""
WITH c AS (SELECT conv_id AS n, left(replace(text, chr(10), ' '), 90) AS line FROM conversations WHERE turn = 0),
s AS (SELECT *, n % 3 <> 1 AS licensed, n % 3 <> 1 AND n % 8 <> 6 AND NOT (n % 8 = 2 AND n % 3 = 0) AS open FROM c),
x AS (SELECT *, open AND n % 5 > 0 AS pair, CASE WHEN n % 6 = 0 THEN 90 ELSE length(line) END AS size FROM s)
SELECT step, n_rows FROM (SELECT count(*) AS a, count(*) FILTER (licensed) AS b, count(*) FILTER (open) AS c, count(*) FILTER (pair) AS d, count(*) FILTER (pair AND size <= 80 OR pair AND n % 6 = 0 AND 90 <= 80) AS e,
  count(*) FILTER (pair AND size <= 80 AND n % 6 > 0) AS f FROM x) UNPIVOT (n_rows FOR step IN (a AS 'original', b AS 'licensed', c AS 'not_opted_out', d AS 'with_diffs', e AS 'not_too_big', f AS 'valid'))""")
def commit_pair_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _commits(spark, sf_dir)
    kinds = F.expr("CASE WHEN repo_name LIKE '%r1' THEN 'non_permissive' WHEN repo_name LIKE '%r2' THEN 'no_license' ELSE 'permissive' END")
    licenses = pairs.select("repo_name", kinds.alias("license_type")).distinct()
    repos = spark.range(1).select(F.lit("o2/r0").alias("repo_name"))
    users = spark.range(1).select(F.lit("o6").alias("user"))
    return commit_pairs.funnel(commit_pairs.prepared(pairs, licenses, repos, users, most_changes=80)).select("step", "n_rows")


@query("""
SELECT 'p' || conv_id AS pull_guid, (conv_id % 20)::BIGINT AS base_change_start, (conv_id % 20 + 1)::BIGINT AS base_change_end FROM conversations
WHERE turn = 0 AND conv_id % 3 <> 1 AND conv_id % 8 <> 6 AND NOT (conv_id % 8 = 2 AND conv_id % 3 = 0) AND conv_id % 5 > 0 AND conv_id % 6 > 0 AND length(left(replace(text, chr(10), ' '), 90)) <= 80""")
def commit_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _commits(spark, sf_dir)
    kinds = F.expr("CASE WHEN repo_name LIKE '%r1' THEN 'non_permissive' ELSE 'permissive' END")
    licenses = pairs.select("repo_name", kinds.alias("license_type")).distinct()
    valid = commit_pairs.prepared(pairs, licenses, spark.range(1).select(F.lit("o2/r0").alias("repo_name")), spark.range(1).select(F.lit("o6").alias("user")), most_changes=80)["valid"]
    return valid.select("pull_guid", F.explode("files").alias("f")).select("pull_guid", "f.base_change_start", "f.base_change_end")
